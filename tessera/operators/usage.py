"""Usage and lag roll-ups (AGG-3, AGG-4, AGG-8, SRT-4, SRT-5, JN-9)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.operators.sequence import number_rows

#: Offsets of one range when messages are counted against consumer marks.
LAG_SPAN = 1 << 16


def _seconds(ts_max, ts_min):
    return (F.unix_micros(ts_max.cast("timestamp")) - F.unix_micros(ts_min.cast("timestamp"))) / 1e6


def consumer_counts(members: DataFrame, group: str = "group", member: str = "key") -> DataFrame:
    """AGG-3: number of consumer groups and of active consumers (distinct group members)."""
    return members.agg(F.countDistinct(group).cast("int").alias("consumer_groups"),
                       F.countDistinct(group, member).cast("int").alias("active_consumers"))


def topic_consumption(members: DataFrame, topic: str = "topic", group: str = "group",
                      ts: str = "ts") -> DataFrame:
    """AGG-4: per topic, consumer-group count and messages per second over the topic's span."""
    agg = members.groupBy(topic).agg(
        F.countDistinct(group).cast("int").alias("consumer_count"),
        F.count(F.lit(1)).alias("messages"),
        F.min(ts).alias("_t0"), F.max(ts).alias("_t1"))
    secs = _seconds(F.col("_t1"), F.col("_t0"))
    return agg.select(F.col(topic).alias("topic_name"), "consumer_count", "messages",
                      F.when(secs > 0, F.col("messages") / secs).otherwise(F.lit(0.0))
                      .alias("messages_per_second"))


def top_topics(usage: DataFrame, n: int = 10) -> DataFrame:
    """SRT-4: topics ranked by consumption (top-n)."""
    return usage.orderBy(F.col("messages_per_second").desc(), F.col("topic_name")).limit(n)


def positions(log: DataFrame, topic: str = "topic", partition: str = "partition",
              order: str = "offset") -> DataFrame:
    """Position of every message inside its topic partition (1-based), numbered
    inside ranges of offsets, so a hot partition is spread over many tasks."""
    return number_rows(log, [order], keys=[topic, partition], name="position")


def consumer_lag(log: DataFrame, topic: str = "topic", partition: str = "partition",
                 group: str = "group", order: str = "offset", span: int = LAG_SPAN) -> DataFrame:
    """AGG-8: lag per (topic, group) = Σ over partitions of (end − committed), kept when > 0.

    With positions numbered by ``order`` inside a partition, end − committed is the
    number of the partition's messages above the group's mark (its highest offset):

    1. messages are counted per (topic, partition, range of ``span`` offsets), map-side;
       a suffix sum over the ranges gives the messages in ranges above a mark's;
    2. only inside a range that holds a mark are messages compared with marks, joined on
       (topic, partition, range).

    No step keys on the partition alone, so one that holds a third of the log is spread
    over its ranges at any size."""
    rng = F.floor(F.col(order) / span)
    marks = (log.groupBy(topic, partition, group).agg(F.max(order).alias("_mark"))
             .withColumn("_r", F.floor(F.col("_mark") / span)))
    counts = log.groupBy(topic, partition, rng.alias("_r")).agg(F.count(F.lit(1)).alias("_n"))
    later = Window.partitionBy(topic, partition).orderBy(F.col("_r").desc())
    above = counts.select(topic, partition, "_r", F.coalesce(
        F.sum("_n").over(later.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_above"))
    here = [topic, partition, "_r"]
    inside = (log.select(topic, partition, rng.alias("_r"), F.col(order).alias("_o")).join(marks, here)
              .groupBy(*here, group).agg(F.count_if(F.col("_o") > F.col("_mark")).alias("_in")))
    lag = (inside.join(above, here).groupBy(topic, group)
           .agg(F.sum(F.col("_above") + F.col("_in")).alias("lag_messages")))
    return lag.filter(F.col("lag_messages") > 0).select(
        F.col(topic).alias("topic_name"), F.col(group).alias("consumer_group"),
        F.col("lag_messages").cast("bigint").alias("lag_messages"))


def consumer_lag_positioned(positioned: DataFrame, topic: str = "topic",
                            partition: str = "partition", group: str = "group") -> DataFrame:
    """AGG-8 over a log that already carries ``position`` (see ``positions``).

    committed = highest position the group has read in the partition, end = the
    partition's highest position.  Every message belongs to a group, so the ends are
    the maxima of the commits: the positioned log is aggregated once."""
    commits = positioned.groupBy(topic, partition, group).agg(
        F.max("position").alias("committed_position"))
    ends = commits.groupBy(topic, partition).agg(F.max("committed_position").alias("end_position"))
    lag = (commits.join(ends, [topic, partition])
           .groupBy(topic, group)
           .agg(F.sum(F.col("end_position") - F.col("committed_position")).alias("lag_messages")))
    return lag.filter(F.col("lag_messages") > 0).select(
        F.col(topic).alias("topic_name"), F.col(group).alias("consumer_group"),
        F.col("lag_messages").cast("bigint").alias("lag_messages"))


def top_lag(lag: DataFrame, n: int = 5) -> DataFrame:
    """SRT-5: lag entries, largest first (top-n)."""
    return lag.orderBy(F.col("lag_messages").desc(), "topic_name", "consumer_group").limit(n)


def topic_health(catalog: DataFrame, usage: DataFrame, lag: DataFrame,
                 topic: str = "topic_name") -> DataFrame:
    """JN-9: one line per catalog topic — rate, consumers, total lag, idle flag."""
    lag_t = lag.groupBy(topic).agg(F.sum("lag_messages").alias("total_lag"),
                                   F.count(F.lit(1)).alias("lagging_groups"))
    j = catalog.select(topic).join(usage, topic, "left").join(lag_t, topic, "left")
    return j.select(
        topic,
        F.coalesce(F.col("messages_per_second"), F.lit(0.0)).alias("messages_per_second"),
        F.coalesce(F.col("consumer_count"), F.lit(0)).alias("consumer_count"),
        F.coalesce(F.col("total_lag"), F.lit(0)).cast("bigint").alias("total_lag"),
        F.coalesce(F.col("lagging_groups"), F.lit(0)).cast("bigint").alias("lagging_groups"),
        F.col("consumer_count").isNull().alias("idle"))
