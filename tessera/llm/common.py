"""Helpers shared by the operators: scratch tables, byte slices, vectorised words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import scratch_path

#: White space of every contract here: blank, tab, line feed, VT, FF, CR.
SPACE_BYTES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_CLASS = r"[^\x20\x09-\x0D]+"

IS_SPACE = np.zeros(256, dtype=bool)
IS_SPACE[list(SPACE_BYTES)] = True

U64 = np.uint64


class Scratch:
    """Written tables of one operator call, in the shared checkpoint folder.

    ``put`` writes a DataFrame as Parquet and reads it back, which cuts the lineage
    and survives lost executors.  ``drop`` removes tables that no later step reads.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, scratch_path(spark, name), 0
        self.paths: dict[int, str] = {}

    def put(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n:03d}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = path
        out._scratch_path = path
        return out

    def drop(self, *tables: DataFrame) -> None:
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for t in tables:
            path = jvm.org.apache.hadoop.fs.Path(t._scratch_path)
            path.getFileSystem(conf).delete(path, True)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")


def word_count(text: Column) -> Column:
    """Number of words of a text, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD_CLASS)), F.lit(0)).cast("long")


def unused(df: DataFrame, name: str) -> str:
    """``name``, or with line marks behind it until no column is called so."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# ----------------------------------------------------------------- Arrow slices

def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that a slice holds at most ``most`` bytes of ``column``, or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = raw_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(off, off[start] + most, side="right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def raw_bytes(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column (null counts as empty) and their row offsets from 0."""
    if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
        col, kind, wide = col.cast(pa.large_binary()), np.int64, True
    else:
        col, kind, wide = col.cast(pa.binary()), np.int32, False
    if col.null_count:
        col = col.fill_null(b"")
    n = len(col)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offs, data = col.buffers()
    off = np.frombuffer(offs, dtype=kind)[col.offset: col.offset + n + 1].astype(np.int64)
    if data is None or off[-1] == off[0]:
        return np.zeros(0, np.uint8), off - off[0]
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]: off[-1]]
    return buf, off - off[0]


# ------------------------------------------------------------- vectorised words

_rng = np.random.Generator(np.random.PCG64(20240917))
BYTE_CODE = _rng.integers(1, 2**63, 256, dtype=np.int64).astype(U64) | U64(1)
BASE = U64(0x9E3779B97F4A7C15)
BASE_INV = U64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def _power(base: np.uint64, name: str, n: int) -> np.ndarray:
    p = _powers.get(name)
    if p is None or len(p) < n:
        size = max(n, 1 << 21)
        p = np.empty(size, U64)
        p[0] = 1
        p[1:] = base
        np.multiply.accumulate(p, out=p)
        if n <= 1 << 23:
            _powers[name] = p
    return p[:n]


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (xor-shift and multiply)."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x ^= x >> U64(33)
    x *= U64(0xC4CEB9FE1A85EC53)
    x ^= x >> U64(33)
    return x


def power_down(n: int) -> np.ndarray:
    """Powers that bring sums at 0, 1, ... to one place."""
    return _power(BASE_INV, "down", n)


def prefix_code(buf: np.ndarray) -> np.ndarray:
    """Running sums from which ``span_code`` hashes any span of ``buf``."""
    s = np.empty(len(buf) + 1, U64)
    s[0] = 0
    np.cumsum(BYTE_CODE[buf] * _power(BASE, "up", len(buf)), out=s[1:])
    return s


def span_code(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span [start, end): equal bytes give equal hashes wherever they stand."""
    inv = power_down(len(s))
    return mix((s[end] - s[start]) * inv[start] + (end - start).astype(U64))


def word_spans(buf: np.ndarray, off: np.ndarray, gap: np.ndarray = IS_SPACE
               ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and the row it belongs to; rows never share a word.

    ``gap`` marks the byte values that stand between words.
    """
    if not len(buf):
        z = np.zeros(0, np.int64)
        return z, z, z
    space = gap[buf]
    before = np.empty(len(buf), bool)
    before[0] = True
    before[1:] = space[:-1]
    cut = off[:-1][off[:-1] < len(buf)]
    before[cut] = True
    start = np.flatnonzero(before & ~space)
    after = np.empty(len(buf), bool)
    after[-1] = True
    after[:-1] = space[1:]
    after[cut[cut > 0] - 1] = True
    end = np.flatnonzero(after & ~space) + 1
    return start, end, np.searchsorted(off, start, side="right") - 1


def windows(code: np.ndarray, row: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each window of ``k`` neighbouring words of one row: (hash, index of its first word)."""
    n = len(code) - k + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, np.int64)
    h = code[:n].copy()
    for j in range(1, k):
        h *= U64(0xD6E8FEB86659FD93)
        h += code[j: n + j]
    at = np.flatnonzero(row[:n] == row[k - 1:])
    return mix(h[at]), at


def counts_by_row(row: np.ndarray, n: int, weights: np.ndarray | None = None) -> np.ndarray:
    c = np.bincount(row, weights=weights, minlength=n)
    return c.astype(np.int64)


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Batches of rows sorted by ``key``, regrouped so that no key is spread over two of them."""
    held: list[pa.RecordBatch] = []
    n, least = 0, rows
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < least:
            continue
        t = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        k = t.column(key).to_numpy()
        change = np.flatnonzero(k[1:] != k[:-1])
        if not len(change):
            held, least = [t], 2 * n
            continue
        cut = int(change[-1]) + 1
        yield t.slice(0, cut)
        held, n, least = [t.slice(cut)], t.num_rows - cut, rows
    if n:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


# -------------------------------------------------------------- components

def components(edges: DataFrame, scratch: Scratch) -> DataFrame:
    """(node, root) for every node of the edges (a, b): root is the smallest node it is connected to.

    Alternating large-star and small-star steps: grouped minima and joins, written out,
    until the edges no longer change.
    """
    up, down = F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")
    e = scratch.put(edges.where("a != b").select(up, down).distinct())
    mark = None
    while True:
        n = e.agg(F.count("*"), F.sum(F.pmod(F.xxhash64("u", "v"), F.lit(1 << 40)))).first()
        if tuple(n) == mark or not n[0]:
            break
        mark = tuple(n)
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # written out, so that both join sides come from tables and a hot star can be split
        low = scratch.put(both.groupBy(F.col("u").alias("w")).agg(F.least(F.min("v"), F.col("w")).alias("m")))
        large = (both.join(low.hint("merge"), F.col("u") == F.col("w")).where("v > u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy(F.col("u").alias("w")).agg(F.min("v").alias("m"))
        met = large.join(low, F.col("u") == F.col("w"))
        small = (met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(low.select(F.col("w").alias("u"), F.col("m").alias("v"))).distinct())
        last, e = e, scratch.put(small)
        scratch.drop(last)
    own = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return scratch.put(e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(own))
