"""The corpus pipeline against a plain version of its stages."""

import collections
import re

from pyspark.sql import functions as F

import corpus_pipeline as C
from tessera.llm.common import documents

from .test_dedup import brute_links

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages_in_order(spark, sf):
    docs = documents(spark, sf)
    kept = {r.doc_id for r in C.language(spark, docs, sf).collect()}
    assert kept == {r.doc_id for r in docs.where(F.col("text").rlike(r"\p{L}")).collect()}
    exact = C.exact(spark, docs, sf)
    assert exact.columns == COLUMNS
    rows = exact.collect()
    bare = lambda t: re.sub(r"[\x20\x09-\x0D]", "", t or "")
    assert sorted(bare(r.text) for r in rows) == sorted({bare(r.text) for r in docs.collect()})
    near = C.near(spark, exact, sf)
    want = brute_links([(r.doc_id, r.text) for r in rows])
    assert {r.doc_id for r in near.collect()} == {c for _, c in want.values()}


def test_run(spark, sf):
    out = C.run(spark, sf).collect()
    copies = collections.Counter(r.doc_id for r in out)
    assert out and max(copies.values()) <= 3 and all(r.round_trip for r in out)


def test_odd_and_empty_tables(spark, odd, no_docs, sf):
    for _, stage in C.STAGES:
        assert stage(spark, no_docs, sf).collect() == []
    docs = odd
    for name, stage in C.STAGES:
        docs = stage(spark, docs, sf)
        if name != "pieces":
            assert docs.columns == COLUMNS
    assert docs.count() > 0
