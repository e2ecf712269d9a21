"""Language identification by a bidirectional gated recurrent network over bytes.

The network reads a text as UTF-8 bytes in windows of ``WINDOW`` bytes, one gated
recurrent layer from the left and one from the right; it labels every byte position with
probabilities over the learned languages, and a document's probabilities are the means
over all its positions.  Gates and states use the soft sign ``x / (1 + |x|)`` (shifted to
(0, 1) for gates), which costs a third of a hyperbolic tangent.

Training is numpy on the driver: back-propagation through time with Adam, over a bounded
sample of labelled rows (``SampleSpec``: at most ``docs`` documents, ``spans`` windows
of each; languages are drawn with equal weight).  Weights (some 10 kB) go to the tasks.

Defined results: a text that is null or has no letter is ``und`` with score 0 (also when
nothing was learned); equal texts get equal results; an empty table gives an empty
result; other columns pass through (those named like the results are replaced).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from tessera.llm.common import raw_bytes, slices, unused

WINDOW, HIDDEN = 128, 8
UND = "und"
#: Bytes of text a task works on at once (a longer single text is worked on alone).
SLICE = 1 << 19
#: Windows read side by side.
BATCH = 4096
MOST_LANGUAGES = 500


@dataclass(frozen=True)
class SampleSpec:
    """Bound of the training sample: documents, windows of a document, bytes of a window."""

    docs: int = 1600
    spans: int = 4
    span_bytes: int = 64
    epochs: int = 6
    batch: int = 256
    rate: float = 0.03
    seed: int = 7


# ------------------------------------------------------------------ the network

def softsign(x: np.ndarray) -> np.ndarray:
    t = np.abs(x)
    t += 1
    return np.divide(x, t, out=x)


def gate(x: np.ndarray) -> np.ndarray:
    x = softsign(x)
    x *= 0.5
    x += 0.5
    return x


def new_model(n_langs: int, hidden: int, rng: np.random.Generator) -> dict[str, np.ndarray]:
    m = {}
    for d in "fb":
        m[f"Wg{d}"] = rng.normal(0, 0.3, (256, 2 * hidden))
        m[f"Wn{d}"] = rng.normal(0, 0.3, (256, hidden))
        m[f"Ug{d}"] = rng.normal(0, 0.4, (hidden, 2 * hidden))
        m[f"Un{d}"] = rng.normal(0, 0.4, (hidden, hidden))
        m[f"bn{d}"] = np.zeros(hidden)
    m["V"] = rng.normal(0, 0.3, (2 * hidden, n_langs))
    m["c"] = np.zeros(n_langs)
    return {k: v.astype(np.float32) for k, v in m.items()}


def run_layer(m: dict, d: str, x: np.ndarray, live: np.ndarray | None, keep: list | None = None) -> np.ndarray:
    """States of one direction for byte columns ``x`` (time, batch); steps that are not live give 0."""
    t_all, b = x.shape
    hidden = m[f"Un{d}"].shape[0]
    out = np.empty((t_all, b, hidden), np.float32)
    h = np.zeros((b, hidden), np.float32)
    for t in range(t_all) if d == "f" else range(t_all - 1, -1, -1):
        g = m[f"Wg{d}"].take(x[t], axis=0)
        g += h @ m[f"Ug{d}"]
        g = gate(g)
        r, z = g[:, :hidden], g[:, hidden:]
        a = h @ m[f"Un{d}"]
        a += m[f"bn{d}"]
        n = a * r
        n += m[f"Wn{d}"].take(x[t], axis=0)
        n = softsign(n)
        if keep is not None:
            keep.append((t, h, r, z, n, a))
        h = (h - n) * z
        h += n
        if live is not None:
            h *= live[t][:, None]
        out[t] = h
    return out


def for_reading(m: dict) -> dict:
    """The weights as ``read_windows`` wants them: small contiguous matrices for gate, state and label."""
    k = m["Unf"].shape[0]
    out = {"langs": len(m["c"]), "hidden": k, "c": m["c"]}
    for d in "fb":
        wg, ug = m[f"Wg{d}"], m[f"Ug{d}"]
        parts = {"Wr": wg[:, :k], "Wz": wg[:, k:], "Wn": m[f"Wn{d}"], "Ur": ug[:, :k], "Uz": ug[:, k:],
                 "Un": 0.5 * m[f"Un{d}"], "V": m["V"][:k] if d == "f" else m["V"][k:]}
        out |= {name + d: np.ascontiguousarray(v) for name, v in parts.items()}
        out["bn" + d] = 0.5 * m[f"bn{d}"]
    out["sum"] = np.ones((len(m["c"]), len(m["c"])), np.float32)
    out["bound"] = float(np.abs(m["V"]).sum(axis=0).max() + np.abs(m["c"]).max())  # states are within (-1, 1)
    return out


def read_windows(w: dict, x: np.ndarray, live: np.ndarray | None) -> np.ndarray:
    """Probabilities (time, batch, language) at every position of byte columns ``x`` (time, batch)."""
    t_all, b = x.shape
    k = w["hidden"]
    logit = np.empty((t_all, b, w["langs"]), np.float32)
    r, z, new, u, a = (np.empty((b, k), np.float32) for _ in range(5))
    part = np.empty((b, w["langs"]), np.float32)
    bias = np.tile(w["c"], (b, 1))  # full arrays: a short broadcast row costs a loop a row
    for d in "fb":
        wr, wz, wn, ur, uz, un, v = (w[n + d] for n in ("Wr", "Wz", "Wn", "Ur", "Uz", "Un", "V"))
        bn = np.tile(w["bn" + d], (b, 1))
        h = np.zeros((b, k), np.float32)
        for t in range(t_all) if d == "f" else range(t_all - 1, -1, -1):
            c = x[t]
            for g, wg, ug in ((r, wr, ur), (z, wz, uz)):  # twice the gates: 1 + softsign
                np.take(wg, c, axis=0, out=g, mode="clip")
                g += np.matmul(h, ug, out=u)
                np.abs(g, out=a)
                a += 1
                g /= a
                g += 1
            np.matmul(h, un, out=u)  # half of the recurrent part, times twice the gate
            u += bn
            u *= r
            np.take(wn, c, axis=0, out=new, mode="clip")
            new += u
            np.abs(new, out=a)
            a += 1
            new /= a
            h -= new
            z *= 0.5
            h *= z
            h += new
            if live is not None:
                h *= live[t][:, None]
            if d == "f":
                np.matmul(h, v, out=logit[t])
            else:
                np.matmul(h, v, out=part)
                part += bias
                logit[t] += part
    if w["bound"] > 60:
        logit -= logit.max(axis=2, keepdims=True)
    np.exp(logit, out=logit)
    logit /= logit @ w["sum"]
    return logit


def loss_and_gradient(m: dict, x: np.ndarray, live: np.ndarray, y: np.ndarray) -> tuple[float, dict]:
    """Mean cross entropy over live positions and its gradient (back-propagation through time)."""
    keep = {"f": [], "b": []}
    h = {d: run_layer(m, d, x, live, keep[d]) for d in "fb"}
    k = h["f"].shape[2]
    both = np.concatenate([h["f"], h["b"]], axis=2).reshape(-1, 2 * k)
    logit = both @ m["V"] + m["c"]
    logit -= logit.max(axis=1, keepdims=True)
    p = np.exp(logit)
    p /= p.sum(axis=1, keepdims=True)
    rows = np.arange(len(p))
    lab = np.broadcast_to(y, x.shape).reshape(-1)
    w = (live.reshape(-1) / live.sum()).astype(m["V"].dtype)
    loss = float(-(np.log(p[rows, lab] + 1e-12) * w).sum())
    p[rows, lab] -= 1
    p *= w[:, None]
    grad = {"V": both.T @ p, "c": p.sum(axis=0)}
    dboth = (p @ m["V"].T).reshape(*x.shape, 2 * k)
    for d in "fb":
        dout = dboth[:, :, :k] if d == "f" else dboth[:, :, k:]
        ug, un = m[f"Ug{d}"], m[f"Un{d}"]
        g_ug, g_un, g_bn = np.zeros_like(ug), np.zeros_like(un), np.zeros_like(m[f"bn{d}"])
        d_gate = np.zeros((*x.shape, 2 * k), ug.dtype)
        d_new = np.zeros((*x.shape, k), ug.dtype)
        dh = np.zeros(dout.shape[1:], ug.dtype)
        for t, before, r, z, n, a in reversed(keep[d]):
            dh = (dh + dout[t]) * live[t][:, None]
            dn = dh * (1 - z)
            dz = dh * (before - n)
            dpre = dn * (1 - np.abs(n)) ** 2
            da = dpre * r
            dg = np.concatenate([dpre * a * 0.5 * (1 - np.abs(2 * r - 1)) ** 2,
                                 dz * 0.5 * (1 - np.abs(2 * z - 1)) ** 2], axis=1)
            g_ug += before.T @ dg
            g_un += before.T @ da
            g_bn += da.sum(axis=0)
            d_gate[t], d_new[t] = dg, dpre
            dh = dh * z + dg @ ug.T + da @ un.T
        grad |= {f"Ug{d}": g_ug, f"Un{d}": g_un, f"bn{d}": g_bn}
        flat = x.reshape(-1)
        for name, dd in ((f"Wg{d}", d_gate), (f"Wn{d}", d_new)):
            dd = dd.reshape(len(flat), -1)
            grad[name] = np.stack([np.bincount(flat, weights=dd[:, j], minlength=256)
                                   for j in range(dd.shape[1])], axis=1).astype(ug.dtype)
    return loss, grad


def train(spans: list[bytes], labels: list[int], n_langs: int, spec: SampleSpec,
          hidden: int = HIDDEN) -> dict[str, np.ndarray]:
    rng = np.random.Generator(np.random.PCG64(spec.seed))
    m = new_model(n_langs, hidden, rng)
    x = np.zeros((len(spans), spec.span_bytes), np.uint8)
    live = np.zeros(x.shape, np.float32)
    for i, s in enumerate(spans):
        x[i, :len(s)] = np.frombuffer(s, np.uint8)
        live[i, :len(s)] = 1
    y = np.asarray(labels)
    first = {k: np.zeros_like(v) for k, v in m.items()}
    second = {k: np.zeros_like(v) for k, v in m.items()}
    step, steps = 0, spec.epochs * -(-len(spans) // spec.batch)
    for _ in range(spec.epochs):
        order = rng.permutation(len(spans))
        for at in range(0, len(order), spec.batch):
            pick = order[at: at + spec.batch]
            _, grad = loss_and_gradient(m, x[pick].T, live[pick].T, y[pick])
            size = np.sqrt(sum(float((g * g).sum()) for g in grad.values()))
            scale = min(1.0, 1.0 / (size + 1e-12))
            step += 1
            rate = spec.rate * (1 - (step - 1) / steps) + 1e-4
            for k, g in grad.items():
                g = g * scale
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                m[k] -= (rate * (first[k] / (1 - 0.9 ** step))
                         / (np.sqrt(second[k] / (1 - 0.99 ** step)) + 1e-8)).astype(np.float32)
    return m


# ---------------------------------------------------------------- on DataFrames

def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def held_out(doc_id: Column) -> Column:
    """True for rows that no training may read: crc32 of the id as text, remainder 1 by 3."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample_spans(labelled: DataFrame, spec: SampleSpec) -> tuple[list[bytes], list[int], list[str]]:
    """Windows of at most ``spec.docs`` documents of (key, text, lang), languages weighing alike."""
    spark = labelled.sparkSession
    rows = labelled.where(F.col("lang").isNotNull() & has_letter(F.col("text")))
    # of more languages the most frequent are learned
    counts = (rows.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
              .limit(MOST_LANGUAGES).collect())
    if not counts:
        return [], [], []
    langs = sorted(r.lang for r in counts)
    weight = spark.createDataFrame([(r.lang, float(r.n)) for r in counts], "lang string, n double")
    data = F.col("text").cast("binary")
    span = [F.substr(data, (F.pmod(F.xxhash64("key", F.lit(j + spec.seed)), F.greatest(
        F.length(data) - spec.span_bytes, F.lit(0)) + 1) + 1).cast("int"), F.lit(spec.span_bytes))
        for j in range(spec.spans)]
    uniform = (F.pmod(F.xxhash64("key", F.lit(spec.seed)), F.lit(1 << 40)) + 0.5) / float(1 << 40)
    # ranks are exponential with rate 1 / n; a cut that some 2 * docs + 100 rows pass keeps the rest in its tasks
    low, high = 0.0, 1e3 * max(r.n for r in counts)
    for _ in range(200):
        mid = (low + high) / 2
        if sum(r.n * -math.expm1(-mid / r.n) for r in counts) < 2 * spec.docs + 100:
            low = mid
        else:
            high = mid
    drawn = (rows.join(F.broadcast(weight), "lang")  # one row per language, at most MOST_LANGUAGES
             .withColumn("rank", -F.log(uniform) * F.col("n")).where(F.col("rank") <= high)
             .select("lang", "key", "rank", F.array(*span).alias("spans"))
             .orderBy("rank", "key").limit(spec.docs).collect())
    spans, labels = [], []
    for r in drawn:
        for s in r.spans:
            if s:
                spans.append(bytes(s))
                labels.append(langs.index(r.lang))
    return spans, labels, langs


def label_texts(w: dict, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Mean probabilities over all byte positions of each text (texts, languages)."""
    n = len(off) - 1
    length = np.diff(off)
    per = -(-length // WINDOW)
    owner = np.repeat(np.arange(n), per)
    first = np.arange(len(owner)) - np.repeat(np.cumsum(per) - per, per)
    start = off[owner] + first * WINDOW
    size = np.minimum(WINDOW, off[owner + 1] - start)
    out = np.zeros((n, w["langs"]))
    for only_full in (True, False):
        pick = np.flatnonzero((size == WINDOW) == only_full)
        for at in range(0, len(pick), BATCH):
            some = pick[at: at + BATCH]
            where = np.arange(WINDOW)[:, None] + start[some]
            live = None if only_full else (np.arange(WINDOW)[:, None] < size[some])
            x = buf[where if only_full else np.where(live, where, 0)]
            p = read_windows(w, x, None if only_full else live.astype(np.float32))
            if not only_full:
                p *= live[:, :, None]
            np.add.at(out, owner[some], p.sum(axis=0))
    return out / np.maximum(length, 1)[:, None]


def identify(df: DataFrame, model: dict | None, langs: list[str], text_col: str = "text",
             carry: bool = True) -> DataFrame:
    """The input with ``lang_pred`` and ``score``; ``carry=False`` leaves the text out of the result."""
    names = [c for c in df.columns if c not in ("lang_pred", "score")]
    src = df.select(*[F.col(f"`{c}`") for c in names])
    keep = [c for c in names if carry or c != text_col]
    if model is None:
        return src.select(*[F.col(f"`{c}`") for c in keep], F.lit(UND).alias("lang_pred"), F.lit(0.0).alias("score"))
    # texts without a letter are told apart by a JVM expression
    flag = unused(src, "_letter")
    ask = src.withColumn(flag, has_letter(F.col(f"`{text_col}`")))
    schema = StructType([*[src.schema[c] for c in keep], StructField("lang_pred", StringType()),
                         StructField("score", DoubleType())])
    weights = for_reading(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches, text_col, SLICE):
            letter = b.column(flag)
            buf, off = raw_bytes(b.column(text_col))
            probs = label_texts(weights, buf, off)
            best = probs.argmax(axis=1)
            none = ~letter.to_numpy(zero_copy_only=False).astype(bool)
            pred = [UND if e else langs[k] for k, e in zip(best.tolist(), none.tolist())]
            score = np.where(none, 0.0, np.clip(probs[np.arange(len(best)), best], 0.0, 1.0))
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in keep], pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                names=[*keep, "lang_pred", "score"])

    return ask.mapInArrow(work, schema)


def train_on(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             spec: SampleSpec = SampleSpec()) -> tuple[dict | None, list[str]]:
    """Model and languages, learned from a bounded sample of the rows that are not held out."""
    labelled = df.where(~held_out(F.col(id_col))).select(
        F.col(id_col).alias("key"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    spans, labels, langs = sample_spans(labelled, spec)
    if not spans:
        return None, []
    return train(spans, labels, len(langs), spec), langs
