"""Batch twins of the stream operators: same results over a bounded log, computed with
skew-safe building blocks (used for checking streams and for backfills)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.sequence import running_max, running_sum, with_previous


def _us(c):
    return F.unix_micros(c.cast("timestamp"))


def sessions(df: DataFrame, key: str, ts: str, order: str, gap_s: int) -> DataFrame:
    """STM-3 twin: a new session starts when the gap to the key's previous event
    (by event time) is ``gap_s`` or more; a session ends ``gap_s`` after its last event.

    Gap detection and session numbering run inside (key, day), so a user with a third of
    all events is still processed by many tasks; the per-session aggregate combines
    map-side."""
    p = with_previous(df.select(key, ts, order), [key], [ts, order], [ts])
    gap = (_us(F.col(ts)) - _us(F.col("prev_" + ts))) / 1e6
    flagged = p.withColumn("_new", F.when(F.col("prev_" + ts).isNull() | (gap >= gap_s), 1).otherwise(0))
    numbered = running_sum(flagged, [key], [ts, order], "_new", "session_no")
    return numbered.groupBy(key, "session_no").agg(
        F.min(ts).alias("session_start"),
        (F.max(ts) + F.make_dt_interval(secs=F.lit(gap_s))).alias("session_end"),
        F.count(F.lit(1)).alias("events"))


def windowed_counts(df: DataFrame, ts: str, size: str, slide: str | None = None,
                    by: tuple[str, ...] = ("topic",)) -> DataFrame:
    """STM-4 twin: ``window()`` works the same on bounded data."""
    w = F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)
    return df.groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("messages")).select(
        F.col("w.start").alias("window_start"), *by, "messages")


def late_rows(df: DataFrame, ts: str, order: str, delay_s: int) -> DataFrame:
    """STM-10 twin: rows whose event time is more than ``delay_s`` behind the newest
    event time seen before them in log order (what a watermark would drop)."""
    m = running_max(df, [], [order], ts, "_max_ts")
    lag = (_us(F.col("_max_ts")) - _us(F.col(ts))) / 1e6
    return m.filter(lag > delay_s).drop("_max_ts")


def dedup(df: DataFrame, cols: list[str], order: str) -> DataFrame:
    """STM-12 twin: first occurrence (in log order) of each distinct ``cols``."""
    rest = [c for c in df.columns if c not in cols]
    return df.groupBy(*cols).agg(F.min_by(F.struct(*rest), F.col(order)).alias("_r")).select(*cols, "_r.*")
