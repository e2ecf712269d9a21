"""Removal of repeated substrings: threshold-bounded interval expansion on a Burrows-Wheeler transform.

A byte goes when a ``WIN``-byte string that covers it starts anywhere else too.  Matches
never cross texts.  The work is split by content, so no task holds the corpus:

1. Each window of ``WIN`` bytes has a key, the least hash of its ``GRAM``-byte grams, so
   equal windows have equal keys.  Neighbouring windows of one key form a segment (some
   70 windows; a longer one, of a periodic run, is cut into segments of ``PART`` windows);
   a segment is one narrow row.
2. Only keys of two segments or more (or of a segment that may repeat itself) go on, and
   equal segments of a key become one, with their number.
3. The bytes of these segments are laid out in blocks; a key stays in one block unless
   its segments exceed ``HOT`` bytes, and no block exceeds ``BLOCK``.  In a block the suffixes are sorted to ``WIN``
   bytes, which gives the Burrows-Wheeler transform; intervals of suffixes are extended
   backward, breadth first, so that common prefixes come to light by increasing length;
   the expansion stops at ``WIN``.  Neighbours that no interval has parted by then share
   a window.
4. A key too large for one block lies in several; their windows meet once more by hash,
   in as many ranges, so that none is lost.
5. Repeated windows go back to all places of their segment and are cut out of the texts.

Defined results: a null text counts as empty; texts under ``WIN`` bytes lose nothing;
rows alike in id and text are two places each; columns but id and text are left out; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import U64, Scratch, mix, power_down, prefix_code, raw_bytes, slices, span_code, whole_groups

WIN, GRAM = 200, 64
GRAMS = WIN - GRAM + 1
#: Bytes of text a task works on at once; segment bytes of a block (its arrays stay in a core's cache); of a key
#: before it is split.
SLICE, BLOCK, HOT = 1 << 19, 1 << 17, 1 << 19
#: Windows of a segment at most.
PART = 1 << 12
IDX = 21
MASK = (1 << IDX) - 1


# ------------------------------------------------------------------- segments

def sliding(op, x: np.ndarray, k: int) -> np.ndarray:
    """Minimum or maximum of each ``k`` neighbours of ``x``: of ever wider neighbourhoods, then of two that overlap."""
    n, width, y = len(x) - k + 1, 1, x
    while 2 * width <= k:
        y = op(y[:-width], y[width:])
        width *= 2
    return op(y[:n], y[k - width: k - width + n])


def gram_hashes(sums: np.ndarray) -> np.ndarray:
    """Hash of each ``GRAM`` bytes from the running sums of the text; never 0."""
    h = sums[GRAM:] - sums[:-GRAM]
    h *= power_down(len(h))
    h ^= h >> U64(32)
    h *= U64(0x94D049BB133111EB)
    h |= U64(1)
    return h


def segments(sums: np.ndarray, off: np.ndarray):
    """(row, first window, last window, key, weight) of each segment, from the running sums of the texts.

    Weight 2 marks a segment that may repeat itself: its key gram occurs twice in it.
    """
    length = np.diff(off)
    rows = np.flatnonzero(length >= WIN)
    z = np.zeros(0, np.int64)
    if not len(rows):
        return z, z, z, np.zeros(0, U64), z
    h = gram_hashes(sums)
    low = sliding(np.minimum, h, GRAMS)
    n = length[rows] - WIN + 1
    start = np.repeat(off[rows] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
    owner = np.repeat(rows, n)
    key = low[start]
    new = np.ones(len(start), bool)
    new[1:] = (key[1:] != key[:-1]) | (owner[1:] != owner[:-1])
    at = np.flatnonzero(new)
    lo = start[at]
    hi = start[np.append(at[1:], len(start)) - 1]
    k, row = key[at], owner[at]
    weight = 1 + (hi - lo >= GRAMS).astype(np.int64)
    # grams that are the least of some window; two equal ones near each other mark their segments
    valid = np.zeros(len(low), U64)
    valid[start] = key
    top = sliding(np.maximum, np.concatenate([np.zeros(GRAMS - 1, U64), valid, np.zeros(GRAMS - 1, U64)]), GRAMS)
    spot = np.flatnonzero(h == top[:len(h)])
    twin = np.flatnonzero((h[spot[1:]] == h[spot[:-1]]) & (np.diff(spot) <= GRAMS))
    if len(twin):
        p, q, g = spot[twin], spot[twin + 1], h[spot[twin]]
        first = np.maximum(np.searchsorted(lo, q - GRAMS, side="right") - 1, 0)
        last = np.searchsorted(lo, p, side="right") - 1
        for step in range(int((last - first).max()) + 1 if len(twin) else 0):
            r = np.minimum(first + step, last)
            ok = (r >= 0) & (k[r] == g)
            weight[r[ok]] = 2
    # the parts of a long segment share its key and each window is in one of them
    parts = (hi - lo) // PART + 1
    if len(parts) and parts.max() > 1:
        nth = np.arange(int(parts.sum())) - np.repeat(np.cumsum(parts) - parts, parts)
        row, lo, hi, k, weight = (np.repeat(x, parts) for x in (row, lo, hi, k, weight))
        lo = lo + nth * PART
        hi = np.minimum(lo + PART - 1, hi)
    return row, lo, hi, k, weight


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in slices(batches, "text", SLICE):
        buf, off = raw_bytes(b.column("text"))
        sums = prefix_code(buf)
        row, lo, hi, key, weight = segments(sums, off)
        if not len(row):
            continue
        code = span_code(sums, lo, hi + WIN)
        pick = pa.array(row)
        yield pa.RecordBatch.from_arrays(
            [b.column("id").take(pick), b.column("h").take(pick), pa.array((lo - off[row]).astype(np.int32)),
             pa.array((hi - lo).astype(np.int32)), pa.array(mix(key).view(np.int64)),
             pa.array(code.view(np.int64)), pa.array(weight.astype(np.int8))],
            names=["id", "h", "lo", "more", "key", "seg", "w"])


# ------------------------------------------------- transform and interval expansion

def sort_suffixes(sym: np.ndarray, bits: int, depth: int) -> np.ndarray:
    """Suffix order of ``sym`` (0 pads) by at least the first ``depth`` symbols: prefix doubling on packed keys."""
    n = len(sym)
    if n > MASK:
        raise ValueError("block too large")
    idx = np.arange(n, dtype=np.int64)
    k = (62 - IDX) // bits
    padded = np.concatenate([sym.astype(np.int64), np.zeros(k, np.int64)])
    key = np.zeros(n, np.int64)
    for j in range(k):
        key = (key << bits) | padded[j: j + n]
    packed = (key << IDX) | idx
    while True:
        packed.sort()
        order = packed & MASK
        part = packed >> IDX
        new = np.empty(n, bool)
        new[0] = False
        np.not_equal(part[1:], part[:-1], out=new[1:])
        rank = np.cumsum(new)
        if k >= depth or rank[-1] == n - 1:
            return order
        place = np.zeros(n + k, np.int64)
        place[order] = rank + 1
        packed = (place[:n] << (2 * IDX)) | (place[k:] << IDX) | idx
        k *= 2


def parted(bwt: np.ndarray, depth: int) -> np.ndarray:
    """Breadth-first backward extension: True at each boundary of rows whose common prefix is under ``depth``.

    ``bwt`` holds symbols, 0 the end of a segment (never extended over).  Boundary i
    stands before row i.  An interval of all suffixes that start with a string is
    extended by each symbol in front of it; the right end of the new interval, if not
    seen before, parts two rows whose common prefix is the present level.
    """
    n = len(bwt)
    order = np.argsort(bwt, kind="stable")
    lf = np.empty(n, np.int64)
    lf[order] = np.arange(n)
    same = bwt[order[1:]] == bwt[order[:-1]]
    following = np.full(n, n, np.int64)
    following[order[:-1][same]] = order[1:][same]
    previous = np.full(n, -1, np.int64)
    previous[order[1:][same]] = order[:-1][same]
    seen = np.zeros(n + 1, bool)
    seen[[0, n]] = True
    ends = np.cumsum(np.bincount(bwt))
    ends = np.unique(ends[ends < n])
    # level 0: strings of one symbol
    lb, rb = np.concatenate([[0], ends[:-1]]) if len(ends) else np.zeros(0, np.int64), ends
    seen[ends] = True
    for _ in range(1, depth):
        if not len(lb):
            break
        size = rb - lb
        total = int(size.sum())
        head = np.cumsum(size) - size
        row = np.repeat(lb - head, size) + np.arange(total)
        live = bwt[row] != 0
        right = following[row] >= np.repeat(rb, size)
        right &= live
        end = lf[row[right]] + 1
        left = previous[row] < np.repeat(lb, size)
        left &= live
        begin = lf[row[left]]
        end.sort()
        begin.sort()
        fresh = ~seen[end]
        lb, rb = begin[fresh], end[fresh]
        seen[rb] = True
    return seen


def repeated_windows(data: np.ndarray, off: np.ndarray, many: np.ndarray):
    """For segments ``data[off[i]:off[i+1]]``: which windows occur twice, and one row group id for equal windows.

    Returns (segment, window, repeated, group) over all windows of all segments; ``many``
    marks segments that stand for two places or more.
    """
    n_seg = len(off) - 1
    size = np.diff(off)
    # an end mark (0) after each segment
    present = np.zeros(256, bool)
    present[data] = True
    code = np.cumsum(present).astype(np.uint8 if present.sum() < 256 else np.int16)
    sym = np.zeros(len(data) + n_seg, code.dtype)
    seg = np.repeat(np.arange(n_seg), size)
    pos = np.arange(len(data)) + seg
    sym[pos] = code[data]
    bits = int(present.sum()).bit_length()
    order = sort_suffixes(sym, bits, WIN)
    seen = parted(sym[order - 1], WIN)  # in front of the first suffix stands the last end mark
    left = np.zeros(len(sym), np.int64)  # bytes to the end of the segment
    left[pos] = off[seg + 1] - np.arange(len(data))
    is_window = left[order] >= WIN
    at = order[is_window]
    owner_all = np.zeros(len(sym), np.int64)
    owner_all[pos] = seg
    owner = owner_all[at]
    twice = ~seen[:-1][is_window] | ~seen[1:][is_window]
    group = np.cumsum(seen[:-1])[is_window]
    window = at - (off[owner] + owner)
    return owner, window, twice | many[owner], group


def covered_runs(window: np.ndarray) -> np.ndarray:
    """Sorted window starts -> [first byte, end) runs as an int32 array of pairs."""
    if not len(window):
        return np.zeros(0, np.int32)
    gap = np.flatnonzero(np.diff(window) > WIN)
    first = window[np.concatenate([[0], gap + 1])]
    last = window[np.concatenate([gap, [len(window) - 1]])] + WIN
    return np.stack([first, last], axis=1).astype(np.int32).reshape(-1)


def _block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cell, sid, key, nb, n, bytes) sorted by cell and sid -> repeated runs (sid, runs), and for split keys their windows."""
    for piece in _pieces(_once(whole_groups(batches, "cell", rows=512))):
        data, off = raw_bytes(piece.column("data"))
        sid, many = piece.column("sid").to_numpy(), piece.column("n").to_numpy() > 1
        nb = piece.column("nb").to_numpy()
        seg, win, twice, group = repeated_windows(data, off, many)
        order = np.lexsort((win, seg))
        s, w, t = seg[order], win[order], twice[order]
        s, w = s[t], w[t]
        ids, first = np.unique(s, return_index=True)
        runs = [covered_runs(x).tobytes() for x in np.split(w, first[1:])] if len(ids) else []
        zero = pa.nulls(len(ids), pa.int64())
        yield _found(pa.array(sid[ids]), runs, zero, pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.binary()))
        split = np.flatnonzero(nb[seg] > 1)
        if len(split):
            yield from _split_rows(piece, data, off, seg[split], win[split], twice[split], group[split])


def _found(sid, runs, key, part, packed) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([sid, pa.array(runs, pa.binary()), key, part, packed],
                                      names=["sid", "runs", "key", "part", "packed"])


def _split_rows(piece, data, off, seg, win, twice, group) -> Iterator[pa.RecordBatch]:
    """Windows of split keys as packed (hash, segment id or -1, window), dealt to ranges of the hash."""
    sid, key, nb = (piece.column(c).to_numpy() for c in ("sid", "key", "nb"))
    once = np.ones(len(seg), bool)  # of windows repeated here one is enough: it only speaks for its string
    idx = np.flatnonzero(twice)
    _, first = np.unique(np.stack([group[idx], key[seg[idx]]]), axis=1, return_index=True)
    once[idx] = False
    once[idx[first]] = True
    seg, win, twice = seg[once], win[once], twice[once]
    start = off[seg] + win
    code = span_code(prefix_code(data), start, start + WIN)
    rec = np.zeros(len(seg), [("code", "<u8"), ("sid", "<i8"), ("win", "<i4")])
    rec["code"], rec["sid"], rec["win"] = code, np.where(twice, -1, sid[seg]), win
    part = (code % nb[seg].astype(U64)).astype(np.int64)
    order = np.lexsort((part, key[seg]))
    rec, part, k = rec[order], part[order], key[seg][order]
    at = np.flatnonzero(np.concatenate([[True], (np.diff(part) != 0) | (np.diff(k) != 0)]))
    packed = [r.tobytes() for r in np.split(rec, at[1:])]
    none = pa.nulls(len(at), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [none, pa.nulls(len(at), pa.binary()), pa.array(k[at]), pa.array(part[at].astype(np.int32)),
         pa.array(packed, pa.binary())], names=["sid", "runs", "key", "part", "packed"])


def _meet_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(meet, packed) sorted by meet -> runs of windows that stand in two blocks of a split key."""
    kind = np.dtype([("code", "<u8"), ("sid", "<i8"), ("win", "<i4")])
    for t in whole_groups(batches, "meet", rows=64):
        meet = t.column("meet").to_numpy()
        first = np.flatnonzero(np.concatenate([[True], meet[1:] != meet[:-1]]))
        for f, e in zip(first, np.append(first[1:], len(meet))):
            rec = np.concatenate([np.frombuffer(x.as_py(), kind) for x in t.column("packed").slice(f, e - f)])
            _, which, n = np.unique(rec["code"], return_inverse=True, return_counts=True)
            rec = rec[(n[which] > 1) & (rec["sid"] >= 0)]
            rec = rec[np.lexsort((rec["win"], rec["sid"]))]
            ids, at = np.unique(rec["sid"], return_index=True)
            if len(ids):
                runs = [covered_runs(x).tobytes() for x in np.split(rec["win"], at[1:])]
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(runs, pa.binary())], names=["sid", "runs"])


def _once(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each segment once: rows alike in id and text have given theirs twice."""
    for t in groups:
        sid = t.column("sid").to_numpy()
        yield t.filter(pa.array(np.concatenate([[True], sid[1:] != sid[:-1]])))


def _pieces(groups: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Whole cells, packed into pieces of up to ``BLOCK`` bytes; a larger cell is cut, as windows of split keys meet again."""
    held: list[pa.RecordBatch] = []
    size = 0
    for t in groups:
        cell, nb = t.column("cell").to_numpy(), t.column("nb").to_numpy()
        _, off = raw_bytes(t.column("data"))
        first = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1]]))
        at, start = 0, 0
        ends = np.append(first[1:], len(cell))
        while at < len(ends):
            room = BLOCK - size
            upto = int(np.searchsorted(off[ends], off[start] + room, side="right"))
            if upto <= at and held:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, size = [], 0
                continue
            if upto <= at and nb[start] > 1:
                stop = max(int(np.searchsorted(off, off[start] + BLOCK, side="right")) - 1, start + 1)
                yield t.slice(start, stop - start)
                at, start = at + (stop == ends[at]), stop
                continue
            upto = max(upto, at + 1)
            stop = int(ends[upto - 1])
            held.append(t.slice(start, stop - start))
            size += int(off[stop] - off[start])
            at, start = upto, stop
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


# ------------------------------------------------------------------ on DataFrames

def _extract_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the segments they stand for -> (cell, sid, key, nb, n, data)."""
    for b in slices(batches, "text", SLICE):
        buf, off = raw_bytes(b.column("text"))
        out: list[tuple] = []
        for begin, reps in zip(off[:-1].tolist(), b.column("reps").to_pylist()):
            for r in reps:
                a = begin + r["lo"]
                out.append((r["cell"], r["sid"], r["key"], r["nb"], r["n"], buf[a: a + r["more"] + WIN].tobytes()))
        if out:
            types = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)],
                                             names=["cell", "sid", "key", "nb", "n", "data"])


def merge_spans(places: list[dict]) -> np.ndarray:
    """Runs of the segments of one text -> disjoint removed spans [start, end)."""
    runs = [np.frombuffer(p["runs"], np.int32).reshape(-1, 2) + p["lo"] for p in places]
    r = np.concatenate(runs) if runs else np.zeros((0, 2), np.int64)
    r = r[np.argsort(r[:, 0], kind="stable")].astype(np.int64)
    if not len(r):
        return r
    end = np.maximum.accumulate(r[:, 1])
    cut = np.flatnonzero(r[1:, 0] > end[:-1])
    return np.stack([r[np.concatenate([[0], cut + 1]), 0], end[np.concatenate([cut, [len(r) - 1]])]], axis=1)


def _cut_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with the runs of their segments -> what is removed and what is kept."""
    for b in slices(batches, "text", SLICE):
        buf, off = raw_bytes(b.column("text"))
        removed, spans, sha, packed, kept = [], [], [], [], []
        for a, e, places in zip(off[:-1].tolist(), off[1:].tolist(), b.column("places").to_pylist()):
            r = merge_spans(places)
            keep = np.ones(e - a, bool)
            for f, t in r.tolist():
                keep[f:t] = False
            rest = buf[a:e][keep].tobytes()
            removed.append(int((r[:, 1] - r[:, 0]).sum()))
            spans.append(len(r))
            sha.append(hashlib.sha256(rest).hexdigest())
            packed.append([{"start": f, "end": t} for f, t in r.tolist()])
            kept.append(rest)
        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [b.column("id"), b.column("h"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()),
             pa.array(sha, pa.string()), pa.array(packed, span), pa.array(kept, pa.binary())],
            names=["id", "h", "n_removed", "n_spans", "kept_sha256", "spans", "kept"])


def suffix_dedup(df: DataFrame, text_col: str = "text", id_col: str = "doc_id", carry: bool = True) -> DataFrame:
    """(id, h, n_bytes, n_removed, n_spans, kept_sha256, spans[, kept]) of every row.

    ``h`` is ``xxhash64`` of the text; ``kept`` holds the remaining bytes (a cut may fall
    inside a character); ``carry=False`` leaves it out.
    """
    scratch = Scratch(df.sparkSession, "suffix")
    src = df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(F.col(f"`{text_col}`")).alias("h"),
                    F.col(f"`{text_col}`").alias("text"))
    id_type = src.schema["id"].dataType.simpleString()
    cut_up = scratch.put(src.mapInArrow(
        _segment_rows, f"id {id_type}, h long, lo int, more int, key long, seg long, w byte"))
    keys = scratch.put(cut_up.groupBy(F.col("key").alias("k")).agg(F.sum("w").alias("w")).where("w > 1").select("k"))
    places = scratch.put(cut_up.join(keys.hint("merge"), F.col("key") == F.col("k")).drop("k", "w"))
    scratch.drop(keys, cut_up)
    # equal segments of a key become one; its first place (by id) lends the bytes
    head = F.min(F.struct(F.col("id").isNull().alias("no"), "id", "h", "lo", "more"))
    distinct = scratch.put(places.groupBy("key", "seg").agg(F.count("*").alias("n"), head.alias("head"))
                           .withColumn("sid", F.monotonically_increasing_id()))
    large = scratch.put(distinct.groupBy(F.col("key").alias("k")).agg(F.sum(F.col("head.more") + WIN).alias("bytes"))
                        .where(F.col("bytes") > HOT).select("k", F.ceil(F.col("bytes") / HOT).cast("int").alias("blocks")))
    nb = F.coalesce("blocks", F.lit(1))
    ask = (distinct.join(large.hint("merge"), F.col("key") == F.col("k"), "left")
           .select(F.col("head.id").alias("id"), F.col("head.h").alias("h"), F.struct(
               F.col("head.lo").alias("lo"), F.col("head.more").alias("more"), "sid", "key", nb.alias("nb"), "n",
               F.xxhash64("key", F.pmod("sid", nb)).alias("cell")).alias("rep")))
    # rows alike in id and text lend their text once
    again = scratch.put(src.groupBy(F.col("id").alias("cid"), F.col("h").alias("ch")).agg(F.count("*").alias("rows"))
                        .where("rows > 1"))
    none = F.lit(None).cast(ask.schema["rep"].dataType)
    wanted = (places.select("id", "h", none.alias("rep")).unionByName(ask)
              .groupBy(F.col("id").alias("wid"), F.col("h").alias("wh")).agg(F.collect_list("rep").alias("reps"))
              .join(again.hint("merge"), F.col("wid").eqNullSafe(F.col("cid")) & (F.col("wh") == F.col("ch")), "left")
              .drop("cid", "ch"))
    same = F.col("id").eqNullSafe(F.col("wid")) & (F.col("h") == F.col("wh"))
    texts = scratch.put(src.join(wanted.hint("merge"), same).drop("wid", "wh"))
    first = [F.first(c).alias(c) for c in ("text", "reps")]
    once = (texts.where("rows is null").select("id", "h", "text", "reps")
            .unionByName(texts.where("rows > 1").groupBy("id", "h").agg(*first)))
    rows = once.where(F.size("reps") > 0).select("text", "reps").mapInArrow(
        _extract_rows, "cell long, sid long, key long, nb int, n long, data binary")
    found = scratch.put(rows.repartition("cell").sortWithinPartitions("cell", "sid")
                        .mapInArrow(_block_rows, "sid long, runs binary, key long, part int, packed binary"))
    met = (found.where("packed is not null").select(F.xxhash64("key", "part").alias("meet"), "packed")
           .repartition("meet").sortWithinPartitions("meet").mapInArrow(_meet_rows, "sid long, runs binary"))
    runs = found.where("runs is not null").select("sid", "runs").unionByName(met)
    seg_runs = scratch.put(distinct.join(runs.hint("merge"), "sid")
                           .select(F.col("key").alias("k"), F.col("seg").alias("s"), "runs"))
    back = (places.join(seg_runs.hint("merge"), (F.col("key") == F.col("k")) & (F.col("seg") == F.col("s")))
            .groupBy(F.col("id").alias("wid"), F.col("h").alias("wh"))
            .agg(F.collect_set(F.struct("lo", "runs")).alias("places")))
    cut = (once.select("id", "h", "text").join(back.hint("merge"), same).select("id", "h", "text", "places")
           .mapInArrow(_cut_rows, f"id {id_type}, h long, n_removed long, n_spans long, kept_sha256 string, "
                                  "spans array<struct<start:long,end:long>>, kept binary"))
    if not carry:
        cut = cut.drop("kept")
    cut = scratch.put(cut.dropDuplicates(["id", "h"]))
    scratch.drop(places, distinct, large, again, texts, found, seg_runs)
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    whole = src.select("id", "h", F.length(data).cast("long").alias("n_bytes"), F.sha2(data, 256).alias("sha"),
                       *([data.alias("data")] if carry else []))
    cut = cut.withColumnsRenamed({"id": "wid", "h": "wh"})
    return whole.join(cut.hint("merge"), same, "left").select(
        F.col("id").alias(id_col), "h", "n_bytes", F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "sha").alias("kept_sha256"), F.coalesce("spans", F.array().cast(
            cut.schema["spans"].dataType)).alias("spans"),
        *([F.coalesce("kept", "data").alias("kept")] if carry else []))
