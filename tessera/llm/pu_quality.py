"""Quality classifier by positive-unlabelled learning.

Only texts labelled good are trusted; everything else is unlabelled web text, good and bad.
With the share ``prior`` of good texts in it, the risk of a classifier is

    prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))

where R_p and R_u are mean losses over trusted and unlabelled texts, taken as good (+) or
bad (-).  The part in ``max`` estimates the loss on bad texts without bias; it cannot be
negative in truth, so where a batch makes it negative the step goes the other way
(non-negative risk).  The loss is logistic, so a score is a probability under that prior.

The prior is estimated, too: a first network tells trusted from unlabelled texts on one half
of the sample; on the other half, the least ratio of the shares of both that lie over a
threshold (with a margin for small shares) is the share of good texts, as over the best
threshold there is no bad text left.

A text is described by the frequencies of its bytes and of neighbouring byte classes, and by
how much of it repeats (words, windows of three words, lines); a small network in numpy is
fitted on the driver on a bounded sample of texts' descriptions (``Spec``), and tasks score
whole texts.  Language, source, id and labels are no inputs of a score.

Defined results: null counts as empty, and an empty text has a score like any other;
without a trusted text nothing is learned, every score is 0 and every text is predicted 0; an id
with labels of both kinds is not trusted; repeated rows are sampled once; an empty table gives
an empty result; other columns pass through (``score`` and ``predicted`` are replaced).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tessera.llm.common import counts_by_row, prefix_code, raw_bytes, slices, span_code, windows, word_spans
from tessera.llm.lang_gru import held_out

SLICE = 1 << 20
#: Byte classes: lower, upper, digit, blank, line end, stops, calls, signs, other ASCII, beyond ASCII.
CLASSES = 10
CLASS_OF = np.full(256, 8, np.int64)
for _n, _members in enumerate(("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t\r\v\f", "\n",
                               ".,;:", "!?", "#$%&*|<>@^~=+_\\")):
    CLASS_OF[[ord(c) for c in _members]] = _n
CLASS_OF[128:] = 9
EXTRA = 8
WIDTH = 256 + CLASSES * CLASSES + EXTRA


@dataclass(frozen=True)
class Spec:
    """Bounds of the sample and of the training."""

    trusted: int = 6000
    unlabelled: int = 12000
    hidden: int = 24
    epochs: int = 40
    batch: int = 512
    rate: float = 0.003
    decay: float = 1e-2
    seed: int = 11


# ------------------------------------------------------------------ description

def _again(code: np.ndarray, row: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For hashes in rows: which occur in their row before or after too, and how many differ in each row."""
    order = np.lexsort((code, row))
    same = np.zeros(len(code) + 1, bool)
    same[1:-1] = (code[order[1:]] == code[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
    twice = np.empty(len(code), bool)
    twice[order] = same[1:] | same[:-1]
    return twice, counts_by_row(row[order[~same[:-1]]], n)


def describe(buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of ``WIDTH`` numbers for each text."""
    n, length = len(off) - 1, np.diff(off)
    out = np.zeros((n, WIDTH), np.float32)
    row = np.repeat(np.arange(n), length)
    per = np.maximum(length, 1)[:, None]
    out[:, :256] = np.sqrt(np.bincount(row * 256 + buf, minlength=n * 256).reshape(n, 256) / per)
    kind = CLASS_OF[buf]
    pair = (row[:-1] == row[1:])
    both = (row[:-1] * CLASSES * CLASSES + kind[:-1] * CLASSES + kind[1:])[pair]
    cells = CLASSES * CLASSES
    out[:, 256:256 + cells] = np.sqrt(np.bincount(both, minlength=n * cells).reshape(n, cells) / per)
    start, end, owner = word_spans(buf, off)
    words = counts_by_row(owner, n)
    one = np.maximum(words, 1)
    sums = prefix_code(buf)
    code = span_code(sums, start, end)
    twice, different = _again(code, owner, n)
    follows = np.flatnonzero((code[1:] == code[:-1]) & (owner[1:] == owner[:-1]))
    extra = out[:, 256 + cells:]
    extra[:, 0] = np.log1p(words) / 8
    extra[:, 1] = np.bincount(owner, end - start, n) / one / 10
    extra[:, 2] = different / one
    extra[:, 3] = np.bincount(owner[twice], minlength=n) / one
    extra[:, 4] = np.bincount(owner[follows], minlength=n) / one
    h, at = windows(code, owner, 3)
    repeated, _ = _again(h, owner[at], n)
    extra[:, 5] = np.bincount(owner[at[repeated]], minlength=n) / one
    # lines with a byte, by their hash
    ends = np.flatnonzero(buf == 10)
    edges = np.unique(np.concatenate([off, ends, ends + 1]))
    a, b = edges[:-1], edges[1:]
    line = (buf[np.minimum(a, max(len(buf) - 1, 0))] != 10) if len(buf) else np.zeros(len(a), bool)
    a, b = a[line], b[line]
    of = np.searchsorted(off, a, side="right") - 1
    lines = counts_by_row(of, n)
    _, distinct = _again(span_code(sums, a, b), of, n)
    extra[:, 6] = (lines - distinct) / np.maximum(lines, 1)
    extra[:, 7] = np.log1p(lines / one)
    return out


def _describe_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text", SLICE):
        x = describe(*raw_bytes(b.column("text")))
        yield pa.RecordBatch.from_arrays([b.column("trusted"), pa.array([r.tobytes() for r in x], pa.binary())],
                                         names=["trusted", "x"])


# ------------------------------------------------------------------ the network

def _start(spec: Spec, rnd: np.random.Generator) -> list[np.ndarray]:
    return [rnd.normal(0, WIDTH ** -0.5, (WIDTH, spec.hidden)), np.zeros(spec.hidden),
            rnd.normal(0, spec.hidden ** -0.5, spec.hidden), np.zeros(1)]


def forward(w: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    h = np.tanh(x @ w[0] + w[1])
    return h @ w[2] + w[3][0], h


def backward(w: list[np.ndarray], x: np.ndarray, h: np.ndarray, d: np.ndarray) -> list[np.ndarray]:
    """Gradients from the gradient ``d`` of each output."""
    dh = d[:, None] * w[2] * (1 - h * h)
    return [x.T @ dh, dh.sum(axis=0), h.T @ d, np.array([d.sum()])]


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * np.tanh(0.5 * z)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.maximum(z, 0) + np.log1p(np.exp(-np.abs(z)))


def risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """(risk of trusted texts as good, unbiased estimate of the risk of bad texts)."""
    return (prior * softplus(-zp).mean(), softplus(zu).mean() - prior * softplus(zp).mean())


def output_gradient(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Gradient of the non-negative risk by the outputs of trusted and unlabelled texts."""
    as_good, as_bad_p, as_bad_u = -prior * sigmoid(-zp) / len(zp), prior * sigmoid(zp) / len(zp), sigmoid(zu) / len(zu)
    if risk(zp, zu, prior)[1] < 0:
        return as_bad_p, -as_bad_u  # back until the estimate is no longer negative
    return as_good - as_bad_p, as_bad_u


def fit(xp: np.ndarray, xu: np.ndarray, gradient, spec: Spec) -> list[np.ndarray]:
    """Adam over batches of both kinds; ``gradient`` maps their outputs to the gradients by them."""
    rnd = np.random.default_rng(spec.seed)
    w = _start(spec, rnd)
    m, v = [np.zeros_like(a) for a in w], [np.zeros_like(a) for a in w]
    steps = max(1, -(-max(len(xp), len(xu)) // spec.batch))
    t, last = 0, [np.zeros_like(a) for a in w]
    for epoch in range(spec.epochs):
        p, u = rnd.permutation(len(xp)), rnd.permutation(len(xu))
        for ip, iu in zip(np.array_split(np.resize(p, max(len(p), steps)), steps),
                          np.array_split(np.resize(u, max(len(u), steps)), steps)):
            zp, hp = forward(w, xp[ip])
            zu, hu = forward(w, xu[iu])
            dp, du = gradient(zp, zu)
            t += 1
            rate = spec.rate * np.sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)
            for i, (gp, gu) in enumerate(zip(backward(w, xp[ip], hp, dp), backward(w, xu[iu], hu, du))):
                g = gp + gu + spec.decay * w[i]
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                w[i] = w[i] - rate * m[i] / (np.sqrt(v[i]) + 1e-8)
            if epoch >= spec.epochs // 2:
                last = [a + b for a, b in zip(last, w)]
    # the mean of the second half is steadier than the last step
    return [a / (steps * (spec.epochs - spec.epochs // 2)) for a in last]


def estimate_prior(zp: np.ndarray, zu: np.ndarray, slack: float = 0.01, doubt: float = 0.1) -> float:
    """Share of good texts among the unlabelled: the best ratio of the shares above a threshold."""
    cut = np.unique(np.concatenate([zp, zu]))
    over_p = 1 - np.searchsorted(np.sort(zp), cut) / len(zp)
    over_u = 1 - np.searchsorted(np.sort(zu), cut) / len(zu)
    some = over_p > 0
    over_p, over_u = over_p[some], over_u[some]
    margin = np.sqrt(np.log(4 / doubt) / 2 / len(zp)) + np.sqrt(np.log(4 / doubt) / 2 / len(zu))
    best = np.argmin((over_u + (1 + slack) * margin) / over_p)
    return float(np.clip(over_u[best] / over_p[best], 0.01, 0.99))


def _plain_gradient(zp: np.ndarray, zu: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return -sigmoid(-zp) / len(zp), sigmoid(zu) / len(zu)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: list[np.ndarray]
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        return sigmoid(forward(self.weights, np.clip((x - self.mean) / self.scale, -8, 8))[0])


def learn(xp: np.ndarray, xu: np.ndarray, spec: Spec = Spec()) -> Model:
    """The model of trusted and unlabelled descriptions."""
    mean, scale = xu.mean(axis=0), xu.std(axis=0) + 0.01
    xp, xu = (np.clip((x - mean) / scale, -8, 8) for x in (xp, xu))
    half_p, half_u = (np.arange(len(x)) % 2 == 0 for x in (xp, xu))
    prior = 0.5
    if half_p.sum() < len(half_p) and half_u.sum() < len(half_u):
        first = fit(xp[half_p], xu[half_u], _plain_gradient, spec)
        prior = estimate_prior(forward(first, xp[~half_p])[0], forward(first, xu[~half_u])[0])
    w = fit(xp, xu, lambda zp, zu: output_gradient(zp, zu, prior), spec)
    return Model(mean, scale, w, prior)


# ------------------------------------------------------------------ on DataFrames

def sample(df: DataFrame, labels: DataFrame, spec: Spec, text_col: str, id_col: str, label_col: str
           ) -> tuple[np.ndarray, np.ndarray]:
    """Descriptions of trusted and of unlabelled texts, drawn by hash from the rows that are not held out."""
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")).where(~held_out(F.col("id")))
    drawn = F.xxhash64("id", F.lit(spec.seed))

    def part(h, wanted: int, n: int):
        return F.pmod(h, F.lit(1 << 30)) < int((1 << 30) * min(1.0, 1.5 * wanted / max(n, 1)))

    good = (labels.select(F.col(f"`{id_col}`").alias("of"), F.col(f"`{label_col}`").alias("label"))
            .where(F.col("label").isNotNull() & ~held_out(F.col("of")))
            .groupBy("of").agg(F.min("label").alias("least")).where("least = 1").select("of"))
    few = good.where(part(F.xxhash64("of", F.lit(spec.seed)), spec.trusted, good.count()))
    # at most ``spec.trusted`` ids
    few = few.orderBy(F.xxhash64("of", F.lit(spec.seed)), "of").limit(spec.trusted)
    trusted = (src.join(F.broadcast(few), F.col("id") == F.col("of"))
               .groupBy("id").agg(F.max("text").alias("text")).select("text", F.lit(True).alias("trusted")))
    row = src.withColumn("h", F.xxhash64("id", "text", F.lit(spec.seed)))
    unlabelled = (row.where(part(F.col("h"), spec.unlabelled, src.count())).groupBy("h").agg(F.max("text").alias("text"))
                  .orderBy("h").limit(spec.unlabelled).select("text", F.lit(False).alias("trusted")))
    rows = trusted.unionByName(unlabelled).mapInArrow(_describe_rows, "trusted boolean, x binary").collect()
    # in an order that no task decides
    xs = {kind: sorted(bytes(r.x) for r in rows if r.trusted == kind) for kind in (True, False)}
    read = [np.frombuffer(b"".join(xs[k]), np.float32).reshape(-1, WIDTH).astype(np.float64) for k in (True, False)]
    rnd = np.random.default_rng(spec.seed)
    return tuple(x[rnd.permutation(len(x))] for x in read)


def train_on(df: DataFrame, labels: DataFrame, spec: Spec = Spec(), text_col: str = "text", id_col: str = "doc_id",
             label_col: str = "quality") -> Model | None:
    """The model, learned from trusted and unlabelled texts of rows that are not held out; None without a trusted one."""
    xp, xu = sample(df, labels, spec, text_col, id_col, label_col)
    return learn(xp, xu, spec) if len(xp) and len(xu) else None


def score_quality(df: DataFrame, model: Model | None, text_col: str = "text", carry: bool = True) -> DataFrame:
    """The input with ``score`` and ``predicted``; ``carry=False`` leaves the text out of the result."""
    names = [c for c in df.columns if c not in ("score", "predicted")]
    src = df.select(*[F.col(f"`{c}`") for c in names])
    keep = [c for c in names if carry or c != text_col]
    if model is None:
        return src.select(*[F.col(f"`{c}`") for c in keep], F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    schema = StructType([*[src.schema[c] for c in keep], StructField("score", DoubleType()),
                         StructField("predicted", IntegerType())])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, SLICE):
            s = model.score(describe(*raw_bytes(b.column(text_col))))
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in keep], pa.array(s, pa.float64()),
                                              pa.array((s >= 0.5).astype(np.int32))], names=[*keep, "score", "predicted"])

    return src.mapInArrow(work, schema)
