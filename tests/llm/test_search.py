"""Ranked search against a plain scoring of every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import mask_search as M

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, k=20):
    counts = [(d, Counter(terms(t))) for d, t in docs]
    counts = [(d, c) for d, c in counts if c]
    total, length = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    w = {t: math.floor(1000 * math.log((2 * total + 2) / (2 * n + 1))) for t, n in df.items()}
    out = []
    for item, text in set(items):
        scored = []
        for d, c in counts:
            m = 75 + (25 * sum(c.values()) * total) // length
            s = sum(w[t] * ((1000000000 * c[t]) // (1000 * c[t] + 12 * m)) for t in terms(text) if t in c)
            if s > 0:
                scored.append((-s, d is None, d or 0))
        for r, (s, no, d) in enumerate(sorted(scored)[:k], 1):
            out.append((item, r, None if no else d, -s))
    return sorted(out, key=repr)


def got(spark, docs, items, k=20):
    d = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    q = spark.createDataFrame(items, "item_id long, text string")
    rows = M.lexical_search(d, q, k).collect()
    return sorted(((r.item_id, r["rank"], r.doc_id, r.score) for r in rows), key=repr)


def corpus(seed, n, words=40):
    rnd = random.Random(seed)
    names = [f"w{i}" for i in range(words)] + ["Été", "naïve", "ÄB", "x1y2z3" * 5, "x1y2z3" * 5 + "q", "the"]
    weights = [1 / (i + 1) for i in range(len(names))]

    def text():
        return " ".join(rnd.choices(names, weights, k=rnd.randint(0, 60))).replace(" w3 ", ", W3-")
    return [(i, text()) for i in range(n)]


def test_brute_force(spark):
    docs = corpus(1, 400)
    docs += docs[:30] + [(1000 + i, docs[7][1]) for i in range(40)] + [(None, docs[7][1]), (2000, None), (2001, " .,-"), (2002, "")]
    items = [(i, t) for i, t in corpus(2, 25)] + [(90, None), (91, "?!"), (None, "w1 w2"), (92, "unknown"), (1, "w5"), (1, "w5")]
    items = [x for x in items if x[0] != 1] + [(1, "w5"), (1, "w5")]
    assert got(spark, docs, items) == brute(docs, items)
    assert got(spark, docs, items, 3) == brute(docs, items, 3)


def test_many_terms_and_blocks(spark, monkeypatch):
    """Items of more terms than a mask word holds, and more items than a block."""
    docs = corpus(3, 150, 300)
    items = [(1, " ".join(f"w{i}" for i in range(200))), (2, "w1 w1 w1 w200"), *corpus(4, 9, 300)[3:]]
    monkeypatch.setattr(M, "ITEMS", 3)
    assert got(spark, docs, items) == brute(docs, items)


def test_odd_rows(spark, odd, clash, no_docs):
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    q = odd.select(F.col("doc_id").alias("item_id"), "text", "lang")
    want = brute(docs, docs)
    for d in (odd, clash.withColumn("terms", F.lit(1)).withColumn("item_id", F.lit(2)).withColumn("rank", F.lit(1))):
        rows = M.lexical_search(d, q).collect()
        assert sorted((tuple(r) for r in rows), key=repr) == want
    assert M.lexical_search(no_docs, q).collect() == [] and M.lexical_search(odd, q.limit(0)).collect() == []


def batches(docs, index):
    for some in (docs[:70], docs[70:71], docs[71:]):
        lists = [Counter(index[t] for t in terms(x)) for _, x in some]
        yield pa.RecordBatch.from_pydict({
            "id": pa.array([d for d, _ in some], pa.int64()), "n": pa.array([sum(c.values()) for c in lists], pa.int64()),
            "terms": pa.array([sorted(c) for c in lists], pa.list_(pa.int32())),
            "tfs": pa.array([[c[t] for t in sorted(c)] for c in lists], pa.list_(pa.int32()))})


def test_chunks_carry_the_best(monkeypatch):
    """The same answer whatever the chunks; masks under the last place are left unscored."""
    docs = [(i, t) for i, t in corpus(5, 300) if terms(t)]
    vocabulary = sorted({t for _, x in docs for t in terms(x)})
    index = {t: i for i, t in enumerate(vocabulary)}
    total, length = len(docs), sum(len(terms(x)) for _, x in docs)
    df = Counter(index[t] for _, x in docs for t in set(terms(x)))
    items = []
    for n, (_, text) in enumerate(corpus(6, 20)):
        c = Counter(index[t] for t in terms(text) if t in index)
        ids = np.array(sorted(c), np.int64)
        items.append(M.Item(n, ids, np.array([c[t] * math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1)))
                                              for t in ids.tolist()], np.int64)))
    seen = []
    plain = M.scores_of
    monkeypatch.setattr(M, "scores_of", lambda *a: (seen.append(len(a[3])), plain(*a))[1])

    def run(size, entries):
        monkeypatch.setattr(M, "DOCS", size)
        monkeypatch.setattr(M, "POSTINGS", entries)
        seen.clear()
        out = [b.to_pydict() for b in M._rank_rows(items, total, length, 5)(batches(docs, index))]
        return out, sum(seen)

    want, scored = run(10_000, 10**9)
    assert scored < 0.9 * sum(len(docs) for i in items if len(i.terms))
    for size, entries in ((7, 10**9), (64, 10**9), (10_000, 90), (10_000, 3)):
        assert run(size, entries)[0] == want


def test_lookup_compares_bytes():
    """A term is found by its bytes, not by its hash alone."""
    v, names = M.Vocabulary.of([b"a", b"abcdefgh", b"abcdefghi", "é".encode(), b"x" * 40])
    v.code[:] = v.code[0]
    v.twins = len(names)
    buf = np.frombuffer(b"abcdefghi a b " + b"x" * 40 + b" abcdefgh", np.uint8)
    low, start, end, _ = M.terms_of(buf, np.array([0, len(buf)]))
    real = M.span_code
    M.span_code = lambda s, a, b: np.full(len(a), v.code[0])
    try:
        found = v.find(low, start, end)
    finally:
        M.span_code = real
    assert [names[f] if f >= 0 else None for f in found] == [b"abcdefghi", b"a", None, b"x" * 40, b"abcdefgh"]
