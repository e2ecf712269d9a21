"""Health metrics computed from the log itself (AGG-5, AGG-6, AGG-7, AGG-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.sequence import with_previous


def _micros(c):
    return F.unix_micros(c.cast("timestamp"))


def throughput_mbps(log: DataFrame, value: str = "value", ts: str = "ts") -> DataFrame:
    """AGG-5: total value bytes per second of the log's span, in MB/s (1 MB = 1e6 bytes)."""
    agg = log.agg(F.sum(F.octet_length(F.col(value))).alias("_bytes"),
                  F.min(ts).alias("_t0"), F.max(ts).alias("_t1"))
    secs = (_micros(F.col("_t1")) - _micros(F.col("_t0"))) / 1e6
    return agg.select(F.when(secs > 0, F.col("_bytes") / secs / 1e6).otherwise(F.lit(0.0))
                      .alias("total_throughput_mbps"))


def latency_gaps(log: DataFrame, key: str = "key", order: str = "offset", ts: str = "ts") -> DataFrame:
    """Gap in ms between each message and the same key's previous one (NULL on the first)."""
    seq = with_previous(log.select(key, order, ts), [key], [order], [ts], prefix="prev_")
    gap = (_micros(F.col(ts)) - _micros(F.col("prev_" + ts))) / 1e3
    return seq.withColumn("gap_ms", gap)


def avg_latency_ms(log: DataFrame, key: str = "key", order: str = "offset", ts: str = "ts") -> DataFrame:
    """AGG-6: mean end-to-end latency, here the gap to the same key's previous event (ms).

    The gaps of one key telescope: their sum is ts(last offset) − ts(first offset) and
    there are n − 1 of them.  So the mean needs only a per-key aggregate (combined
    map-side, safe for a hot key) and a global sum — no ordered scan, no shuffle of
    rows.  ``latency_gaps`` gives the individual gaps when they are needed."""
    per_key = latency_parts(log, key, order, ts)
    return per_key.agg((F.sum("span_us") / F.nullif(F.sum("gaps"), F.lit(0)) / 1e3).alias("_avg")) \
                  .select(F.coalesce(F.col("_avg"), F.lit(0.0)).alias("avg_latency_ms"))


def latency_parts(log: DataFrame, key: str = "key", order: str = "offset", ts: str = "ts") -> DataFrame:
    """Per key: span (µs) between the events at its first and last offset, and gap count."""
    return log.groupBy(key).agg(
        (_micros(F.max_by(F.col(ts), F.col(order))) - _micros(F.min_by(F.col(ts), F.col(order))))
        .alias("span_us"),
        (F.count(F.lit(1)) - 1).alias("gaps"))


def error_rate(log: DataFrame, is_error=None, topic: str = "topic",
               error_topic: str = "error") -> DataFrame:
    """AGG-7: errors / all, 0.0 when the log is empty."""
    cond = is_error if is_error is not None else (F.col(topic) == error_topic)
    agg = log.agg(F.count_if(cond).alias("_err"), F.count(F.lit(1)).alias("_n"))
    return agg.select(F.coalesce(F.col("_err") / F.nullif(F.col("_n"), F.lit(0)), F.lit(0.0))
                      .alias("error_rate"))


def storage_gb(df: DataFrame, col: str) -> DataFrame:
    """AGG-9: stored bytes / 1e9 (NULL when there is nothing stored)."""
    return df.agg((F.sum(F.octet_length(F.col(col))) / 1e9).alias("storage_used_gb"))
