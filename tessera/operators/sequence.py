"""Ordered columns per key that stay parallel when one key is huge.

``Window.partitionBy(key)`` sends every row of a key to one task.  Here a key's rows are
split by ranges of the order column (a column expression that never decreases along the
order: a span of offsets, a day, a prefix of a text).  Windows run inside a (key, range);
what stands before a range is summed up in one row per (key, range), aggregated on the
map side, and put in front of the range's rows as a head row.  Everything is built-in
expressions, lazy, and keeps the types of its columns.

* ``with_previous``  values of the key's previous row (lag), and whether there is one,
* ``running_sum``, ``running_max``  running aggregates,
* ``number_rows``    1-based numbers,
* ``number_sampled`` 1-based numbers over equi-depth ranges, whatever the order column holds.

NULL keys are one key; NULL orders come first, as in a Spark window.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import scratch_path

#: Offsets of one range; first characters of a text order that make a range.
SPAN, PREFIX = 1 << 20, 2
_RANGE, _REAL, _CARRY = "_seq_range", "_seq_real", "_seq_carry"


def _names(cols) -> list[str]:
    return [cols] if isinstance(cols, str) else list(cols)


def order_range(df: DataFrame, order: Sequence[str] | str, span: int = SPAN) -> Column:
    """The range of each row: never decreasing along ``order`` (its first column decides)."""
    first = _names(order)[0]
    kind, c = df.schema[first].dataType, F.col(first)
    if isinstance(kind, T.NumericType):
        return F.floor(c / F.lit(span))
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.to_date(c)
    if isinstance(kind, T.StringType):
        return F.substring(c, 1, PREFIX)
    return F.lit(0)


def _with_heads(df: DataFrame, keys: list[str], order: list[str], part: Column,
                carry: Callable[[Column], Column], ranges: Column | None) -> DataFrame:
    """``df`` and, in front of each (key, range), a head row with ``carry`` of the parts before it."""
    base = df.withColumn(_RANGE, order_range(df, order) if ranges is None else ranges)
    parts = base.groupBy(*keys, _RANGE).agg(part.alias("_part"))
    heads = (parts.withColumn(_CARRY, carry(F.col("_part"))(Window.partitionBy(*keys).orderBy(_RANGE)))
             .where(F.col(_CARRY).isNotNull()).select(*keys, _RANGE, _CARRY, F.lit(0).alias(_REAL)))
    return base.withColumn(_REAL, F.lit(1)).unionByName(heads, allowMissingColumns=True)


def _inside(keys: list[str], order: list[str]):
    return Window.partitionBy(*keys, _RANGE).orderBy(_REAL, *order)


def with_previous(df: DataFrame, keys, order, cols, prefix: str = "prev_", first: str | None = None,
                  ranges: Column | None = None) -> DataFrame:
    """Adds ``<prefix><col>`` for each of ``cols``; ``first`` names a flag of rows without a previous one."""
    keys, order, cols = _names(keys), _names(order), _names(cols)
    here = F.struct(*[F.col(c) for c in cols])
    rows = _with_heads(df, keys, order, F.max_by(here, F.struct(*[F.col(c) for c in order])),
                       lambda p: lambda w: F.lag(p).over(w), ranges)
    value = F.when(F.col(_REAL) == 0, F.col(_CARRY)).otherwise(here)
    rows = rows.withColumn("_prev", F.lag(value).over(_inside(keys, order))).where(F.col(_REAL) == 1)
    out = [F.col(f"_prev.{c}").alias(prefix + c) for c in cols]
    flag = [F.col("_prev").isNull().alias(first)] if first else []
    return rows.select(*df.columns, *out, *flag)


def _running(df: DataFrame, keys, order, col: str, out: str, op, ranges: Column | None) -> DataFrame:
    keys, order = _names(keys), _names(order)
    before = lambda p: lambda w: op(p).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = _with_heads(df, keys, order, op(F.col(col)), before, ranges)
    value = F.when(F.col(_REAL) == 0, F.col(_CARRY)).otherwise(F.col(col))
    frame = _inside(keys, order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return rows.withColumn(out, op(value).over(frame)).where(F.col(_REAL) == 1).select(*df.columns, out)


def running_sum(df: DataFrame, keys, order, col: str, out: str, ranges: Column | None = None) -> DataFrame:
    """Adds ``out``: the sum of ``col`` up to and with the row (NULLs ignored)."""
    return _running(df, keys, order, col, out, F.sum, ranges)


def running_max(df: DataFrame, keys, order, col: str, out: str, ranges: Column | None = None) -> DataFrame:
    """Adds ``out``: the largest ``col`` up to and with the row (NULLs ignored)."""
    return _running(df, keys, order, col, out, F.max, ranges)


def number_rows(df: DataFrame, order, keys=(), name: str = "row_number", ranges: Column | None = None) -> DataFrame:
    """Adds ``name``: 1-based number of the row among its key's rows (``keys`` empty: among all).

    Texts often share their first characters, so an order that begins with a text is numbered
    over sampled ranges (``number_sampled``) unless ``ranges`` are given.
    """
    if ranges is None and isinstance(df.schema[_names(order)[0]].dataType, T.StringType):
        return number_sampled(df, order, keys, name)
    one = df.withColumn("_one", F.lit(1).cast("bigint"))
    return running_sum(one, keys, order, "_one", name, ranges).drop("_one")


#: Bits of ``monotonically_increasing_id`` that count rows inside a task.
_POS_BITS = 33


def sampled_ranges(df: DataFrame, by: list[str]) -> DataFrame:
    """``df`` written in equi-depth ranges of ``by``, with the range and the place (``_seq_at``, growing by one) of each row."""
    plain = [f.name for f in df.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    tied = df.withColumn("_seq_tie", F.xxhash64(*plain)).withColumn("_seq_row", F.monotonically_increasing_id())
    by = [*by, "_seq_tie", "_seq_row"]
    path = scratch_path(df.sparkSession, "ranges")
    (tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_seq_tie", "_seq_row")
     .withColumn("_seq_at", F.monotonically_increasing_id()).write.parquet(path))
    schema = T.StructType([*df.schema.fields, T.StructField("_seq_at", T.LongType())])
    rows = df.sparkSession.read.schema(schema).parquet(path)
    return rows.withColumn(_RANGE, F.shiftright("_seq_at", _POS_BITS))


def number_sampled(df: DataFrame, order, keys=(), name: str = "row_number", total: str | None = None) -> DataFrame:
    """Adds ``name``: 1-based number of the row among its key's rows in ``order`` (and ``total``: how many there are).

    For orders whose values bunch up (a common prefix, a clustered id), where fixed ranges would
    put all rows into one task.  Spark samples the rows and cuts the whole table, ordered by
    ``keys`` and ``order``, into ranges of about equal size; rows that tie are cut apart by a hash
    and their place, so a hot value is spread too.  Each task sorts its range and numbers it; one
    row per (range, key) then says how many rows of the key stand before.  The sorted table is
    written to the checkpoint folder, so that the ranges stand once and for all.  ``df`` is run
    twice (sample and sort): pass a written or cheap one.  Ties in ``order`` are numbered in any order.
    """
    keys, order = _names(keys), _names(order)
    rows = sampled_ranges(df, [*keys, *order])
    w = Window.partitionBy(*keys)
    upto = F.sum("_n").over(w.orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1))
    heads = (rows.groupBy(*keys, _RANGE).agg(F.count(F.lit(1)).alias("_n"), F.min("_seq_at").alias("_first"))
             .select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(_RANGE).alias("_r"), "_first",
                     F.coalesce(upto, F.lit(0)).alias("_before"), F.sum("_n").over(w).alias("_total")))
    same = F.col(_RANGE) == F.col("_r")
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    number = F.col("_seq_at") - F.col("_first") + F.col("_before") + 1
    return rows.join(heads, same).select(*df.columns, number.alias(name),
                                         *([F.col("_total").alias(total)] if total else []))
