"""Mixing sources to target weights by cube-method balanced sampling.

Targets: sources in code-point order (null last) weigh 5, 2, 1, repeating, and share the
words of all documents; a target stops at ``most`` times its source's words and the
excess is shared again by weight until none is above.

Takes: a source of ratio r = target / words takes every document floor(r) times and one
more time with probability r - floor(r).  The extra takes are drawn by the cube method:
the vector of inclusion probabilities moves along the null space of the constraints
(number of documents, number of words), one step for three fractional documents, until a
document is settled at 0 or 1; the next document then takes its place.  At most two
documents stay fractional.  The flight runs in blocks of (source, hash), so a hot source
is split; what each block leaves over flies again with the leftovers of other blocks,
until one block per source is left.  There the landing problem (the two documents left
fractional and ``LANDING`` documents of evenly spread sizes that did not fly) is solved
by trying all its outcomes: the one nearest in words and documents is taken.  Draws are
seeded by source and block: reruns agree.

Defined results: a null text has size 0 and takes 0 words; a source without words has
target 0; equal rows are drawn one by one; an empty table gives an empty result; other
columns pass through (those named like the results are replaced).
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructType

from tessera.llm.common import Scratch

#: Weights in turn, the most a document may count, documents in a block of the flight.
WEIGHTS, MOST, BLOCK = (5, 2, 1), 3, 2_048
#: Documents of a source, of evenly spread sizes, that wait for its landing problem.
LANDING = 12
EPS = 1e-9


def source_targets(rows: DataFrame, scratch: Scratch, weights=WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, n_docs, source_size, target) of rows (source, size)."""
    spark = rows.sparkSession
    per = scratch.put(rows.groupBy("source").agg(F.count("*").alias("n_docs"),
                                                 F.sum("size").alias("source_size")))
    # rank by code point without one global window: sorted ranges, then offsets of the ranges
    parts = scratch.put(per.where("source is not null")
                        .repartitionByRange(F.col("source")).sortWithinPartitions("source")
                        .select("*", F.spark_partition_id().alias("pid"),
                                F.monotonically_increasing_id().alias("mid")))
    before, seen = [], 0
    for pid, n in sorted((r.pid, r.n) for r in parts.groupBy("pid").agg(F.count("*").alias("n")).collect()):
        before.append((pid, seen))
        seen += n
    offsets = spark.createDataFrame(before or [(0, 0)], "pid int, before long")
    named = parts.join(F.broadcast(offsets), "pid").select(  # one row per sorted range
        "source", "n_docs", "source_size",
        (F.col("before") + F.col("mid").bitwiseAND((1 << 33) - 1)).alias("at"))
    nulls = per.where("source is null").select("*", F.lit(seen).cast("long").alias("at"))
    turn = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                        (F.col("at") % len(weights) + 1).cast("int"))
    ranked = scratch.put(named.unionByName(nulls).withColumn("weight", turn)
                         .withColumn("cap", F.col("source_size") * float(most)))
    # level of the water: share = what uncapped sources have a unit of weight
    total = ranked.agg(F.sum("source_size")).first()[0] or 0
    share, capped = None, -1
    while True:
        above = (F.col("weight") * F.lit(share) >= F.col("cap")) if share is not None else F.lit(False)
        cap, weight, n = ranked.agg(F.sum(F.when(above, F.col("cap"))), F.sum(F.when(~above, F.col("weight"))),
                                    F.count(F.when(above, 1))).first()
        if n == capped or not weight:
            break
        share, capped = (float(total) - (cap or 0.0)) / weight, n
    target = F.least(F.col("cap"), F.col("weight") * F.lit(share or 0.0))
    return scratch.put(ranked.select("source", "n_docs", "source_size", target.alias("target")))


def fly(size: np.ndarray, p: np.ndarray, draw: np.ndarray) -> list[int]:
    """Move ``p`` in place along the null space of (1, size); the indices left fractional (two at most)."""
    s, p_, at, n, k = size.tolist(), p.tolist(), 0, len(p), 0
    left: list[int] = []
    while True:
        while len(left) < 3 and at < n:
            if EPS < p_[at] < 1 - EPS:
                left.append(at)
            else:
                p_[at] = float(round(p_[at]))
            at += 1
        if len(left) < 3:
            break
        i, j, m = left
        u = (s[j] - s[m], s[m] - s[i], s[i] - s[j])
        if not any(u):
            u = (1.0, -1.0, 0.0)
        up = down = float("inf")
        for x, v in zip(left, u):
            if v > 0:
                up, down = min(up, (1 - p_[x]) / v), min(down, p_[x] / v)
            elif v < 0:
                up, down = min(up, -p_[x] / v), min(down, (p_[x] - 1) / v)
        step = up if draw[k] * (up + down) < down else -down
        k += 1
        for x, v in zip(left, u):
            p_[x] += step * v
        stay = []
        for x in left:
            if p_[x] <= EPS or p_[x] >= 1 - EPS:
                p_[x] = float(round(p_[x]))
            else:
                stay.append(x)
        left = stay
    p[:] = p_
    return left


def land(size: np.ndarray, p: np.ndarray, left: np.ndarray) -> None:
    """Settle the landing problem: of all outcomes the one nearest in words and documents."""
    bits = (np.arange(1 << len(left))[:, None] >> np.arange(len(left))) & 1
    move = bits - p[left]
    miss = np.abs(move @ size[left]) + np.abs(move.sum(axis=1))
    p[left] = bits[int(np.argmin(miss))]


def _settle(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
    """One block: fly; land too if it is the only block of its source. Undecided rows keep 0 < p < 1."""
    source, block = key[0], key[1]
    group = group.sort_values(["size", "order"], ascending=[False, True], kind="stable")
    size, p = group["size"].to_numpy(float), group["p"].to_numpy(float).copy()
    seed = zlib.crc32(f"{source}|{block}|{int(group['level'].iloc[0])}".encode())
    draw = np.random.Generator(np.random.PCG64(seed)).random(len(p) + 3)
    if group["blocks"].iloc[0] > 1:
        fly(size, p, draw)
        return group.assign(p=p)
    # the only block: documents of evenly spread sizes wait for the landing
    open_ = np.flatnonzero((p > EPS) & (p < 1 - EPS))
    wait = open_[np.unique(np.linspace(0, len(open_) - 1, LANDING).astype(int))] if len(open_) else open_
    go = np.setdiff1d(np.arange(len(p)), wait)
    flown = p[go]
    rest = fly(size[go], flown, draw)
    p[go] = flown
    left = np.concatenate([go[rest].astype(int), wait])
    if len(left):
        land(size, p, left)
    return group.assign(p=p)


def ordered(rows: DataFrame, scratch: Scratch) -> DataFrame:
    """Written rows (row, no) with ``order``: the hash of the row, salted with its number among its equals.

    Rows of one input partition are numbered side by side; their offsets are sums of small counts.
    """
    rows = rows.withColumn("order", F.xxhash64("row")).withColumn("part", F.shiftright("no", 33))
    ahead = Window.partitionBy("o").orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    ahead = scratch.put(rows.groupBy(F.col("order").alias("o"), F.col("part").alias("p")).agg(F.count("*").alias("n"))
                        .withColumn("ahead", F.sum("n").over(ahead)).where("ahead > 0").drop("n"))
    nth = F.row_number().over(Window.partitionBy("order", "part").orderBy("no")) - 1
    return (rows.withColumn("nth", nth)
            .join(ahead.hint("merge"), (F.col("order") == F.col("o")) & (F.col("part") == F.col("p")), "left")
            .withColumn("nth", F.col("nth") + F.coalesce("ahead", F.lit(0)))
            .withColumn("order", F.when(F.col("nth") > 0, F.xxhash64("order", "nth")).otherwise(F.col("order")))
            .drop("o", "p", "ahead", "nth", "part", "no"))


def cube_mix(df: DataFrame, source_col: str = "source", size_col: str = "size",
             weights=WEIGHTS, most: int = MOST, block: int = BLOCK) -> DataFrame:
    """Rows with ``source_size``, ``target`` and ``copies`` (how often the mix takes the row).

    Keep the input narrow (ids and sizes): it passes through Arrow.
    """
    spark, scratch = df.sparkSession, Scratch(df.sparkSession, "cube")
    names = [c for c in df.columns if c not in ("source_size", "target", "copies")]
    rows = scratch.put(df.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.col(f"`{source_col}`").alias("source"),
        F.coalesce(F.col(f"`{size_col}`").cast("long"), F.lit(0).cast("long")).alias("size"),
        F.monotonically_increasing_id().alias("no")))
    targets = source_targets(rows.select("source", "size"), scratch, weights, most)
    t = targets.select(F.col("source").alias("src"), "n_docs", "source_size", "target")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    cur = (ordered(rows, scratch).join(t, F.col("source").eqNullSafe(F.col("src")))
           .withColumn("whole", F.floor(ratio + EPS).cast("int"))
           .withColumn("p", F.greatest(F.lit(0.0), ratio - F.col("whole")))
           .withColumn("blocks", F.ceil(F.col("n_docs") / float(block)).cast("int"))
           .select("row", "source", "size", "source_size", "target", "whole", "p", "order", "blocks"))
    settled: list[DataFrame] = []
    level = 0
    while True:
        cur = (cur.withColumn("block", F.pmod(F.xxhash64("order", F.lit(level)), F.col("blocks")))
               .withColumn("level", F.lit(level)))
        schema = StructType(cur.schema.fields)
        out = scratch.put(cur.groupBy("source", "block").applyInPandas(_settle, schema))
        undecided = (F.col("p") > EPS) & (F.col("p") < 1 - EPS)
        settled.append(out.where(~undecided))
        left = out.where(undecided)
        if left.isEmpty():
            break
        n = scratch.put(left.groupBy("source").agg(F.count("*").alias("n")))
        n = n.select(F.col("source").alias("src"), F.ceil(F.col("n") / float(block)).cast("int").alias("b"))
        cur = (left.join(n, F.col("source").eqNullSafe(F.col("src")))
               .withColumn("blocks", F.col("b")).drop("src", "b", "block", "level"))
        level += 1
    done = settled[0]
    for s in settled[1:]:
        done = done.unionByName(s)
    return done.select(*[F.col(f"row.`{c}`").alias(c) for c in names],
                       F.col("source_size").cast("long").alias("source_size"),
                       F.col("target").cast(DoubleType()).alias("target"),
                       (F.col("whole") + F.round("p").cast("int")).cast(IntegerType()).alias("copies"))
