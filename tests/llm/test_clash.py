"""Inputs with columns named like results and inner columns of the operators give the same results."""

import pytest
from pyspark.sql import functions as F

from tessera.llm.bayes_join import bayes_join
from tessera.llm.lang_gru import identify, train_on
from tessera.llm.pii_surrogate import pii_surrogate
from tessera.llm.quality_cascade import quality_cascade
from tessera.llm.radix_dedup import radix_dedup
from tessera.llm.suffix_dedup import suffix_dedup

INNER = ("h", "id", "uid", "rid", "fp", "sig", "key", "seg", "lo", "more", "w", "sid", "cell", "row", "table", "salt", "wid", "wh",
         "_letter", "lang_pred", "score", "kept", "links", "class_id", "n_removed", "norm", "digit", "next", "group_size",
         "entities", "n_entities", "n_words", "base_failed", "c", "n", "root", "size", "head", "reps", "places")


@pytest.fixture(scope="module")
def wide(odd):
    return odd.select("*", *[F.lit("x").alias(c) for c in INNER])


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


@pytest.mark.parametrize("run,cols", [
    (lambda d: pii_surrogate(d, b"k"), ("doc_id", "text", "n_entities")),
    (lambda d: quality_cascade(d), ("doc_id", "n_words", "n_dup_lines", "n_repeat_words", "base_failed", "kept")),
    (bayes_join, ("doc_id", "class_id", "links", "kept")),
    (lambda d: suffix_dedup(d, carry=False), ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")),
    (radix_dedup, ("doc_id", "text", "keep_id", "group_size", "kept")),
], ids=["op1", "op2", "op3", "op5", "op7"])
def test_clashing_columns(odd, wide, run, cols):
    assert rows(run(wide), *cols) == rows(run(odd), *cols)


def test_language_of_clashing_columns(odd, wide):
    model, langs = train_on(odd)
    want = rows(identify(odd, model, langs), "doc_id", "lang_pred")
    got = identify(wide, model, langs)
    assert rows(got, "doc_id", "lang_pred") == want
    assert {r["_letter"] for r in got.collect()} == {"x"}
