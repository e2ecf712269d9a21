"""Similarity join on word n-grams with Bayesian candidate pruning.

Two texts are linked when the Jaccard similarity of their sets of five-word windows is
0.8 or more.  Steps, all on Spark:

1. Each text gets ``HASHES`` MinHash values; texts of one word sequence are one class
   from here on (a map-side count), so copies are never compared with one another.
2. Candidates share a band of ``ROWS`` values (a pair at 0.8 shares none of the bands
   with probability 3e-6).  Only buckets of two classes or more are kept.
3. Inside a bucket MinHash values are compared ``STEP`` at a time.  After each step a
   pair is dropped when the posterior probability that its similarity reaches the
   threshold (uniform prior, binomial likelihood) is below ``TOLERANCE``.  Survivors
   give a spanning forest, never all pairs; large buckets are split into cells.
4. Connected groups of survivors are verified exactly: for the pairs that share a band
   and survive the pruning, the window sets are intersected (cells of ``CELL`` texts).
5. Components of verified links are the classes; a row counts its links.

Defined results: texts of one to four words have one window, all their words; a text
without a word (or null) links to nothing and is a class of its own; the class id is the
smallest id in the class (null ids last); the row with that id stays (``kept``), one row
of a class even when ids repeat; columns but id and text are left out; an empty table gives
an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (U64, Scratch, components, mix, prefix_code, raw_bytes, slices, span_code,
                                whole_groups, windows, word_spans)

SHINGLE, THRESHOLD, TOLERANCE = 5, 0.8, 1e-6
BANDS, ROWS, STEP = 24, 4, 16
HASHES = BANDS * ROWS
#: Texts side by side in a bucket cell (signatures only) and in a verification cell.
BUCKET, CELL = 8192, 1024
SLICE = 1 << 18

_rng = np.random.Generator(np.random.PCG64(41))
MULT = _rng.integers(1, 2**63, HASHES, dtype=np.int64).astype(U64) * U64(2) + U64(1)
PLUS = _rng.integers(0, 2**63, HASHES, dtype=np.int64).astype(U64)


# ------------------------------------------------------------------- one text

def shingles(buf: np.ndarray, off: np.ndarray, k: int = SHINGLE):
    """Windows of ``k`` words: (hash, row), plus word hashes and their rows."""
    start, end, row = word_spans(buf, off)
    code = span_code(prefix_code(buf), start, end)
    h, at = windows(code, row, k)
    hrow = row[at]
    n_words = np.bincount(row, minlength=len(off) - 1)
    for few in range(1, k):
        short = np.flatnonzero(n_words == few)
        if len(short):
            g, at = windows(code, row, few)
            own = np.isin(row[at], short)
            h, hrow = np.concatenate([h, g[own]]), np.concatenate([hrow, row[at][own]])
    if len(hrow) and np.any(np.diff(hrow) < 0):
        order = np.argsort(hrow, kind="stable")
        h, hrow = h[order], hrow[order]
    return h, hrow, code, row


def sketches(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(has words, two 64-bit codes of the word sequence, MinHash values) of each row."""
    n = len(off) - 1
    h, hrow, code, row = shingles(buf, off)
    has = np.bincount(row, minlength=n) > 0
    first = np.flatnonzero(np.diff(row, prepend=-1) > 0)
    place = (np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))).astype(U64)
    ids = np.zeros((n, 2), U64)
    sig = np.full((n, HASHES), 0xFFFFFFFF, np.uint32)
    if len(row):
        for j, c in enumerate((U64(0x9E3779B97F4A7C15), U64(0xC2B2AE3D27D4EB4F))):
            ids[has, j] = np.add.reduceat(mix(code * c + place * U64(0xA0761D6478BD642F) + U64(j)), first)
        hfirst = np.flatnonzero(np.diff(hrow, prepend=-1) > 0)
        v = np.empty_like(h)
        for i in range(HASHES):
            np.multiply(h, MULT[i], out=v)
            v += PLUS[i]
            sig[has, i] = np.minimum.reduceat(v, hfirst) >> U64(32)
    return has, ids, sig


# ------------------------------------------------------------ Bayesian pruning

def least_matches(threshold: float = THRESHOLD, tolerance: float = TOLERANCE,
                  step: int = STEP, hashes: int = HASHES) -> list[int]:
    """For each number of values compared, the fewest matches at which a pair goes on.

    With a uniform prior the similarity given m matches of n is Beta(m + 1, n - m + 1),
    whose tail above t is P(Binomial(n + 1, t) <= m).
    """
    out = []
    for n in range(step, hashes + 1, step):
        tail, m = 0.0, 0
        while True:
            tail += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
            if tail >= tolerance or m == n:
                break
            m += 1
        out.append(m)
    return out


def survivors(sig: np.ndarray, a: np.ndarray, b: np.ndarray, need: list[int]) -> np.ndarray:
    """Index of the pairs (a, b) of rows of ``sig`` that no step drops."""
    alive = np.arange(len(a))
    match = np.zeros(len(a), np.int16)
    for k, least in enumerate(need):
        lo, hi = k * STEP, (k + 1) * STEP
        match = match + (sig[a[alive], lo:hi] == sig[b[alive], lo:hi]).sum(axis=1)
        go = match >= least
        alive, match = alive[go], match[go]
        if not len(alive):
            break
    return alive


def all_pairs(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j), i < j, within each run [first, last) of rows (small runs only)."""
    row = np.concatenate([np.arange(f, e) for f, e in zip(first, last)]) if len(first) else np.zeros(0, int)
    end = np.repeat(last, last - first)
    n = end - row - 1
    a = np.repeat(row, n)
    b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(n) - n, n)
    return a, b


def forest(sig: np.ndarray, side: np.ndarray | None, need: list[int]) -> list[tuple[int, int]]:
    """Spanning forest of the surviving pairs of one large cell: each row meets unvisited rows only."""
    open_ = np.arange(len(sig))
    edges = []
    while len(open_):
        queue, open_ = [int(open_[0])], open_[1:]
        while queue and len(open_):
            x = queue.pop()
            meet = open_ if side is None else open_[side[open_] != side[x]]
            if not len(meet):
                continue
            hit = meet[survivors(sig, np.full(len(meet), x), meet, need)]
            if len(hit):
                edges += [(x, int(y)) for y in hit]
                queue += hit.tolist()
                open_ = open_[~np.isin(open_, hit)]
    return edges


def bucket_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, band, side, rid, sig) sorted by cell -> edges (a, b) of surviving pairs."""
    need = least_matches()
    for t in whole_groups(batches, "cell"):
        cell = t.column("cell").to_numpy()
        rid, band = t.column("rid").to_numpy(), t.column("band").to_numpy()
        side = t.column("side").to_numpy()
        buf, _ = raw_bytes(t.column("sig"))
        sig = buf.view(np.uint32).reshape(-1, HASHES)
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        last = np.append(first[1:], len(cell))
        size = last - first
        small = size <= 48
        a, b = all_pairs(first[small], last[small])
        for lo in range(0, len(a), 1 << 18):
            x, y = a[lo: lo + (1 << 18)], b[lo: lo + (1 << 18)]
            ok = survivors(sig, x, y, need)
            x, y = x[ok], y[ok]
            # a pair is dealt with in the first band that it shares
            same = (sig[x] == sig[y]).reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1) == band[x]
            yield _edges(rid[x[same]], rid[y[same]])
        for f, e in zip(first[~small], last[~small]):
            s = side[f:e]
            got = forest(sig[f:e], s if s.any() else None, need)
            if got:
                g = np.array(got) + f
                yield _edges(rid[g[:, 0]], rid[g[:, 1]])


def _edges(x: np.ndarray, y: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y))], names=["a", "b"])


# ---------------------------------------------------------------- verification

def share_band(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (x == y).reshape(-1, BANDS, ROWS).all(axis=2).any(axis=1)


def common_sizes(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets ``rows`` with sets ``cols`` as a matrix product."""
    used = np.unique(np.concatenate([rows, cols]))
    flat = np.concatenate([sets[i] for i in used])
    owner = np.repeat(used, [len(sets[i]) for i in used])
    _, word, n = np.unique(flat, return_inverse=True, return_counts=True)
    keep = n[word] > 1
    word, owner = word[keep], owner[keep]
    vocab, word = np.unique(word, return_inverse=True)
    order = np.argsort(word, kind="stable")
    word, owner = word[order], owner[order]
    at_row = np.full(len(sets), -1)
    at_row[rows] = np.arange(len(rows))
    at_col = np.full(len(sets), -1)
    at_col[cols] = np.arange(len(cols))
    out = np.zeros((len(rows), len(cols)), np.float32)
    for lo in range(0, len(vocab), 2048):
        f, e = np.searchsorted(word, [lo, lo + 2048])
        m = [np.zeros((len(r), 2048), np.float32) for r in (rows, cols)]
        for mat, at in zip(m, (at_row, at_col)):
            own = at[owner[f:e]]
            ok = own >= 0
            mat[own[ok], word[f:e][ok] - lo] = 1
        out += m[0] @ m[1].T
    return out


def linked(sig: np.ndarray, sets: list[np.ndarray], side: np.ndarray, need: list[int],
           threshold: float = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """Verified pairs of one cell (across its two sides if it has two)."""
    n = len(sig)
    size = np.array([len(s) for s in sets])
    two = bool(side.any())
    got_a, got_b = [], []
    if n <= 48:
        a, b = all_pairs(np.array([0]), np.array([n]))
        if two:
            across = side[a] != side[b]
            a, b = a[across], b[across]
        ok = survivors(sig, a, b, need)
        a, b = a[ok], b[ok]
        ok = share_band(sig[a], sig[b])
        for x, y in zip(a[ok], b[ok]):
            s, t = sets[x], sets[y]
            at = np.minimum(np.searchsorted(t, s), len(t) - 1)
            both = int((t[at] == s).sum())
            if both >= threshold * (len(s) + len(t) - both) - 1e-9:
                got_a.append(x)
                got_b.append(y)
        return np.array(got_a, int), np.array(got_b, int)
    left, right = (np.flatnonzero(side == 0), np.flatnonzero(side == 1)) if two else (np.arange(n),) * 2
    for lo in range(0, len(left), 128):
        rows = left[lo: lo + 128]
        match = np.zeros((len(rows), len(right)), np.int16)
        shared = np.zeros(match.shape, bool)
        alive = np.ones(match.shape, bool)
        for k, least in enumerate(need):
            eq = sig[rows, None, k * STEP:(k + 1) * STEP] == sig[None, right, k * STEP:(k + 1) * STEP]
            match += eq.sum(axis=2, dtype=np.int16)
            shared |= eq.reshape(*match.shape, STEP // ROWS, ROWS).all(axis=3).any(axis=2)
            alive &= match >= least
            if not alive.any():
                break
        alive &= shared
        if not two:
            alive &= rows[:, None] < right[None, :]
        if not alive.any():
            continue
        r, c = np.flatnonzero(alive.any(axis=1)), np.flatnonzero(alive.any(axis=0))
        both = common_sizes(sets, rows[r], right[c])
        either = size[rows[r]][:, None] + size[right[c]][None, :] - both
        i, j = np.nonzero((both >= threshold * either - 1e-9) & alive[np.ix_(r, c)])
        got_a.append(rows[r[i]])
        got_b.append(right[c[j]])
    z = np.zeros(0, int)
    return (np.concatenate(got_a) if got_a else z), (np.concatenate(got_b) if got_b else z)


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member index of the component of each of ``n`` rows."""
    lab = np.arange(n)
    while True:
        old = lab.copy()
        low = np.minimum(lab[a], lab[b])
        np.minimum.at(lab, a, low)
        np.minimum.at(lab, b, low)
        lab = lab[lab]
        if np.array_equal(old, lab):
            return lab


def verify_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, side, rid, n, sig, text) sorted by cell -> (rid, links, root) of rows with a link."""
    need = least_matches()
    for t in whole_groups(batches, "cell", rows=64):
        cell = t.column("cell").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        for f, e in zip(first, np.append(first[1:], len(cell))):
            g = t.slice(f, e - f)
            rid, at = np.unique(g.column("rid").to_numpy(), return_index=True)  # repeated rows come twice
            g = g.take(pa.array(at))
            weight, side = g.column("n").to_numpy(), g.column("side").to_numpy()
            buf, _ = raw_bytes(g.column("sig"))
            sig = buf.view(np.uint32).reshape(-1, HASHES)
            sets = []
            for i in range(len(rid)):
                h, _, _, _ = shingles(*raw_bytes(g.column("text").slice(i, 1)))
                sets.append(np.unique(h))
            a, b = linked(sig, sets, side, need)
            if not len(a):
                continue
            links = np.bincount(a, weights=weight[b], minlength=len(rid))
            links += np.bincount(b, weights=weight[a], minlength=len(rid))
            root = local_roots(len(rid), a, b)
            hit = np.flatnonzero(links)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rid[hit]), pa.array(links[hit].astype(np.int64)), pa.array(rid[root[hit]])],
                names=["rid", "links", "root"])


# ---------------------------------------------------------------- on DataFrames

def _sketch_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text", SLICE):
        has, ids, sig = sketches(*raw_bytes(b.column("text")))
        fixed = [pa.array([r.tobytes() for r in m], pa.binary(), mask=~has) for m in (ids, sig)]
        yield pa.RecordBatch.from_arrays([b.column("id"), b.column("h"), *fixed], names=["id", "h", "fp", "sig"])


def _band_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        buf, _ = raw_bytes(b.column("sig"))
        sig = buf.view(np.uint32).reshape(-1, BANDS, ROWS).astype(U64)
        key = np.zeros(sig.shape[:2], U64)
        for r in range(ROWS):
            key = mix(key * U64(31) + sig[:, :, r] + U64(r))
        key += np.arange(BANDS, dtype=U64)[None, :] * U64(0x9E3779B97F4A7C15)
        n = b.num_rows
        yield pa.RecordBatch.from_arrays(
            [pa.array(mix(key.reshape(-1)).view(np.int64)), pa.array(np.tile(np.arange(BANDS, dtype=np.int32), n)),
             pa.array(np.repeat(b.column("rid").to_numpy(), BANDS))], names=["key", "band", "rid"])


def _cells(members: DataFrame, group: str, size: str, most: int, keep: list[str]) -> DataFrame:
    """Deal members to cells: one of a group of up to ``most``, else one for each pair of its blocks."""
    blocks = F.ceil(F.col(size) / float(most)).cast("int")
    dealt = (members.withColumn("nb", blocks)
             .withColumn("mine", F.when(F.col("nb") > 1, F.pmod(F.xxhash64("rid"), F.col("nb"))).otherwise(0).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("nb") - 1))))
    low, high = F.least("mine", "other"), F.greatest("mine", "other")
    side = F.when(F.col("mine") > F.col("other"), 1).otherwise(0)
    return dealt.select(F.xxhash64(group, low, high).alias("cell"), side.alias("side"), *keep)


def bayes_join(df: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(id, h, class_id, links, kept) for every row; ``h`` is ``xxhash64`` of the text.

    ``links`` counts the other rows at or above the threshold, copies included.  The id
    column keeps its name.
    """
    scratch = Scratch(df.sparkSession, "bayes")
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"),
                    F.col(f"`{text_col}`").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    rows = scratch.put(src.mapInArrow(_sketch_rows, f"id {id_type}, h long, fp binary, sig binary")
                       .withColumn("uid", F.monotonically_increasing_id()))
    # one class for each word sequence; its first row stands for it
    head = F.min(F.struct(F.col("id").isNull().alias("no"), F.col("id").alias("id"),
                          F.col("uid").alias("uid"), F.col("h").alias("h")))
    reps = scratch.put(rows.where("fp is not null").groupBy("fp", "sig")
                       .agg(F.count("*").alias("n"), head.alias("head"))
                       .withColumn("rid", F.monotonically_increasing_id()))
    bands = reps.select("rid", "sig").mapInArrow(_band_rows, "key long, band int, rid long")
    buckets = scratch.put(bands.groupBy("key").agg(F.count("*").alias("size")).where("size > 1")
                          .withColumnRenamed("key", "bucket"))
    members = scratch.put(bands.join(buckets, F.col("key") == F.col("bucket")).select("key", "band", "rid", "size"))
    cells = _cells(members, "key", "size", BUCKET, ["band", "rid"])
    cells = cells.join(reps.select(F.col("rid").alias("r"), "sig"), F.col("rid") == F.col("r")).drop("r")
    edges = (cells.repartition("cell").sortWithinPartitions("cell")
             .mapInArrow(bucket_edges, "a long, b long").distinct())
    maybe = components(edges, scratch)  # (node, root)
    sizes = scratch.put(maybe.groupBy(F.col("root").alias("of")).agg(F.count("*").alias("size")))
    near = (maybe.join(sizes, F.col("root") == F.col("of"))
            .join(reps.select(F.col("rid").alias("r"), "sig", "n", F.col("head.id").alias("rep_id"),
                              F.col("head.h").alias("rep_h")), F.col("node") == F.col("r"))
            .select(F.col("node").alias("rid"), "root", "size", "sig", "n", "rep_id", "rep_h"))
    near = scratch.put(near)
    # rows alike in id and text lend their text once
    texts = (src.join(near, F.col("id").eqNullSafe(F.col("rep_id")) & (F.col("h") == F.col("rep_h")))
             .groupBy("rid", "root", "size", "sig", "n").agg(F.first("text").alias("text")))
    texts = scratch.put(texts)
    cells = _cells(texts, "root", "size", CELL, ["rid", "n", "sig", "text"])
    found = scratch.put(cells.repartition("cell").sortWithinPartitions("cell")
                        .mapInArrow(verify_cells, "rid long, links long, root long"))
    scratch.drop(buckets, members, texts)
    final = components(found.where("rid != root").select(F.col("root").alias("a"), F.col("rid").alias("b")), scratch)
    links = found.groupBy(F.col("rid").alias("lr")).agg(F.sum("links").alias("links"))
    named = (reps.join(final, F.col("rid") == F.col("node"), "left")
             .join(links, F.col("rid") == F.col("lr"), "left")
             .select("fp", "n", "head", F.coalesce("root", "rid").alias("root"),
                     (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("links")))
    named = scratch.put(named)
    best = named.groupBy(F.col("root").alias("of")).agg(F.min("head").alias("best"))
    classes = scratch.put(named.join(best, F.col("root") == F.col("of"))
                          .select(F.col("fp").alias("f"), "links", F.col("best.id").alias("class_id"),
                                  F.col("best.uid").alias("best_uid")))
    alone = F.col("f").isNull()
    return rows.join(classes, F.col("fp") == F.col("f"), "left").select(
        F.col("id").alias(id_col), "h",
        F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("links", F.lit(0)).cast("long").alias("links"),
        (alone | (F.col("uid") == F.col("best_uid"))).alias("kept"))
