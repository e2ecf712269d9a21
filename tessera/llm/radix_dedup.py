"""Exact dedup by distributed MSD radix partitioning.

Rows are split by the leading bytes of their normalised text (white space deleted),
then each group that still holds two rows or more by the bytes after those, and so on,
until a group is a singleton or its text has ended.  A digit is a run of successive
bytes; its width grows by ``growth`` a level, so the number of levels is logarithmic in
the longest text.  Rows are told apart by their bytes alone, never by a digest.

A level is a count by (group, digit), which map tasks pre-aggregate, and a join of the
rows with the groups of two rows or more.  A third of all rows may be one text: a group
of more than ``CELL`` rows and of more than one in ``MOST_HOT`` rows is dealt to cells of
about that size, each with a copy of the group's one row.  So at most ``MOST_HOT`` groups
are hot, which bounds the broadcast list of them, and at most twice as many copies are
made.  (The list holds hashes, which only deal rows to cells; the joins compare the bytes.)
Rows leave at the level that settles them; only the rest are read again, and rows alone
in their group take part in no later join.

Defined results: a null text counts as empty; empty texts equal each other; a null id
loses to any id of an equally long text; of rows alike in text and id one is kept; an
empty table gives an empty result; other columns pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SPACE_CLASS, Scratch

FIRST_WIDTH, GROWTH = 64, 16
CELL, MOST_HOT = 1024, 1000


def normal_bytes(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_CLASS + "+", "").cast("binary")


def dealt(rows: DataFrame, groups: DataFrame, on: list[str], size: str) -> tuple[DataFrame, DataFrame]:
    """Both with a ``cell`` to join on besides ``on``: hot groups are spread over cells, all else is in cell 0.

    ``groups`` is a written table of one row per group with its number of rows in ``size``.
    """
    total = groups.agg(F.sum(size)).first()[0] or 0
    most = max(CELL, -(-total // MOST_HOT))
    key = F.xxhash64(*on)
    hot = F.broadcast(groups.where(F.col(size) > most).groupBy(key.alias("key"))
                      .agg(F.ceil(F.sum(size) / most).cast("int").alias("cells")))
    cells = F.coalesce("cells", F.lit(1))
    # the same cell for a row whenever its task runs again
    at = F.pmod(F.xxhash64("id", F.spark_partition_id()), cells.cast("long")).cast("int")
    return (rows.withColumn("key", key).join(hot, "key", "left").withColumn("cell", at).drop("key", "cells"),
            groups.withColumn("key", key).join(hot, "key", "left")
            .withColumn("cell", F.explode(F.sequence(F.lit(0), cells - 1))).drop("key", "cells"))


def radix_dedup(df: DataFrame, text_col: str = "text", id_col: str = "doc_id",
                first_width: int = FIRST_WIDTH, growth: int = GROWTH,
                carry: bool = True) -> DataFrame:
    """One row per input row: its columns, ``keep_id``, ``group_size`` and ``kept``.

    Of equal texts the one of most code points stays, then the smallest id.  With
    ``carry=False`` the text column is left out of the result and settled rows shuffle no
    text again.  Columns of the input named like the results are replaced.
    """
    scratch = Scratch(df.sparkSession, "radix")
    names = [c for c in df.columns if c not in ("keep_id", "group_size", "kept")]
    row = F.struct(*[F.col(f"`{c}`") for c in names if c != text_col])
    rows = df.select(row.alias("row"), F.col(f"`{text_col}`").alias("text"),
                     F.length(F.coalesce(F.col(f"`{text_col}`"), F.lit(""))).alias("n_points"),
                     F.col(f"`{id_col}`").alias("id"), F.lit(0).cast("long").alias("gid"))
    start, width, level = 0, first_width, 0
    settled: list[DataFrame] = []
    while True:
        cur = rows.withColumn("digit", F.substring(normal_bytes(F.col("text")), start + 1, width))
        mark = F.monotonically_increasing_id() + F.lit(level << 56)
        groups = scratch.put(cur.groupBy("gid", "digit").agg(F.count("*").alias("n")).where("n > 1")
                             .select("gid", "digit", "n", mark.alias("next")))
        more = F.col("next").isNotNull() & (F.length("digit") == width)
        # both sides grow with the input: a merge join at every size, never a broadcast
        left, right = dealt(cur, groups, ["gid", "digit"], "n")
        out = scratch.put(left.join(right.hint("merge"), ["gid", "digit", "cell"], "left").select(
            "row", "id", "n_points", "next", more.alias("more"),
            (F.col("text") if carry else F.when(more, F.col("text"))).alias("text")).withColumn("uid", mark))
        scratch.drop(groups)
        settled.append(out.where(~F.col("more")))
        rows = out.where("more").select("row", "text", "n_points", "id", F.col("next").alias("gid"))
        start, width, level = start + width, width * growth, level + 1
        if rows.isEmpty():
            break
    done = settled[0]
    for s in settled[1:]:
        done = done.unionByName(s)
    cols = [F.col(f"row.`{c}`").alias(c) if c != text_col else F.col("text").alias(c)
            for c in names if carry or c != text_col]
    alone = done.where("next is null").select(
        *cols, F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"))
    # the winner of each class: most code points, then smallest id (null last)
    best = F.min(F.struct((-F.col("n_points")).alias("n"), F.col("id").isNull().alias("no"),
                          F.col("id").alias("id"), F.col("uid").alias("uid")))
    together = done.where("next is not null")
    classes = scratch.put(together.groupBy("next").agg(F.count("*").alias("size"), best.alias("best")))
    left, right = dealt(together, classes, ["next"], "size")
    return alone.unionByName(left.join(right.hint("merge"), ["next", "cell"]).select(
        *cols, F.col("best.id").alias("keep_id"), F.col("size").alias("group_size"),
        (F.col("uid") == F.col("best.uid")).alias("kept")))
