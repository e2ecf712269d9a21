"""Positive-unlabelled learning: descriptions against plain Python, gradients, prior, held-out accuracy."""

import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import pu_quality as Q
from tessera.llm.queries import QUERIES

WORD = re.compile(rb"[^\x20\x09-\x0D]+")
TEXTS = ["", " \n\n ", "One", "two two\nthree!! THREE $$$", "a b c a b c\n\nx\nx\n", "é ñ é", "tail\n", "a b c"]


def plain(text):
    data = text.encode()
    n = max(len(data), 1)
    uni, kinds = Counter(data), [int(Q.CLASS_OF[b]) for b in data]
    pairs = Counter(zip(kinds, kinds[1:]))
    words = WORD.findall(data)
    one = max(len(words), 1)
    count = Counter(words)
    three = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(three)
    lines = [x for x in data.split(b"\n") if x]
    return np.array(
        [(uni[b] / n) ** 0.5 for b in range(256)]
        + [(pairs[i, j] / n) ** 0.5 for i in range(Q.CLASSES) for j in range(Q.CLASSES)]
        + [np.log1p(len(words)) / 8, sum(map(len, words)) / one / 10, len(count) / one,
           sum(c for c in count.values() if c > 1) / one, sum(a == b for a, b in zip(words, words[1:])) / one,
           sum(often[t] > 1 for t in three) / one, (len(lines) - len(set(lines))) / max(len(lines), 1),
           np.log1p(len(lines) / one)])


def test_description():
    data = [t.encode() for t in TEXTS]
    off = np.concatenate([[0], np.cumsum([len(d) for d in data])])
    got = Q.describe(np.frombuffer(b"".join(data), np.uint8), off)
    assert np.allclose(got, [plain(t) for t in TEXTS], atol=1e-5)


@pytest.mark.parametrize("shift", [0.0, -6.0])
def test_gradient_of_the_non_negative_risk(shift):
    """By differences; with ``shift`` the estimate on bad texts is negative and the step turns round."""
    rnd = np.random.default_rng(1)
    zp, zu, prior = rnd.normal(-shift, 1, 7), rnd.normal(shift, 1, 9), 0.7

    def objective(a, b):
        good, bad = Q.risk(a, b, prior)
        return good + bad if Q.risk(zp, zu, prior)[1] >= 0 else -bad

    assert (Q.risk(zp, zu, prior)[1] < 0) == (shift < 0)
    dp, du = Q.output_gradient(zp, zu, prior)
    for z, d, other in ((zp, dp, lambda x: objective(x, zu)), (zu, du, lambda x: objective(zp, x))):
        for i in range(len(z)):
            e = np.eye(len(z))[i] * 1e-6
            assert abs((other(z + e) - other(z - e)) / 2e-6 - d[i]) < 1e-6


def test_network_gradient():
    rnd = np.random.default_rng(2)
    spec = Q.Spec(hidden=3)
    w, x, d = Q._start(spec, rnd), rnd.normal(0, 1, (5, Q.WIDTH)), rnd.normal(0, 1, 5)
    grad = Q.backward(w, x, Q.forward(w, x)[1], d)
    for k, at in ((0, (4, 1)), (1, (2,)), (2, (0,)), (3, (0,))):
        up, down = [a.copy() for a in w], [a.copy() for a in w]
        up[k][at] += 1e-6
        down[k][at] -= 1e-6
        want = ((Q.forward(up, x)[0] - Q.forward(down, x)[0]) * d).sum() / 2e-6
        assert abs(grad[k][at] - want) < 1e-5


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.9])
def test_prior_and_learning(prior):
    """Two clouds: the share of good ones among the unlabelled is found, and both are told apart."""
    rnd = np.random.default_rng(3)

    def cloud(n, good):
        x = rnd.normal(0, 1, (n, Q.WIDTH)) * 0.1
        x[:, 5] += np.where(good, 1.0, -1.0)
        x[:, 9] += np.where(good, -1.0, 1.0)
        return x

    truth = rnd.random(4000) < prior
    model = Q.learn(cloud(2000, True), cloud(4000, truth), Q.Spec())
    assert abs(model.prior - prior) < 0.06
    test = rnd.random(1000) < prior
    assert ((model.score(cloud(1000, test)) >= 0.5) == test).mean() > 0.9


def test_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    got = {r.doc_id: r for r in QUERIES["op12_pu_quality"](spark, sf).collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [d for d in got if zlib.crc32(str(d).encode()) % 3 == 1]
    assert {d for d, r in got.items() if r.held_out} == set(held)
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())
    right = [got[d].predicted == labels[d] for d in held if d in labels]
    bad = [got[d].predicted == 0 for d in held if labels.get(d) == 0]
    assert np.mean(right) > 0.95 and np.mean(bad) > 0.8


def test_held_out_rows_and_other_columns_decide_nothing(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    spec = Q.Spec(epochs=3)
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    a = Q.train_on(docs, labels, spec)
    b = Q.train_on(docs.withColumn("text", F.when(out, F.lit("???")).otherwise(F.col("text"))).withColumn("lang", F.lit("x")),
                   labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality"))), spec)
    assert a.prior == b.prior and all((x == y).all() for x, y in zip(a.weights, b.weights))


def test_odd_rows(spark, odd, clash, no_docs):
    labels = spark.createDataFrame([(3, 1), (4, 1), (4, 0), (5, 1), (6, 1), (6, 1), (8, 0), (None, 1), (77, 1), (9, None), (10, 1)],
                                   "doc_id long, quality int")
    spec = Q.Spec(epochs=2)
    model = Q.train_on(odd, labels, spec)
    rows = Q.score_quality(odd, model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert {(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in rows} == {tuple(r) for r in odd.collect()}
    wide = clash.withColumn("trusted", F.lit(1)).withColumn("x", F.lit("y")).withColumn("quality", F.lit(0))
    again = Q.score_quality(wide, Q.train_on(wide, labels, spec))
    assert set(again.columns) == set(wide.columns) | {"predicted"}
    assert sorted(r.score for r in again.collect()) == sorted(r.score for r in rows)
    assert Q.train_on(no_docs, labels, spec) is None and Q.train_on(odd, labels.limit(0), spec) is None
    none = Q.score_quality(odd, None).collect()
    assert len(none) == odd.count() and {(r.score, r.predicted) for r in none} == {(0.0, 0)}
    assert Q.score_quality(no_docs, model).collect() == []
