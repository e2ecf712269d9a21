"""Structured Streaming operators over keyed logs (STM-1..12, SNK-4).

Event time must be TIMESTAMP (the driver tables hold TIMESTAMP_NTZ; ``event_time``
casts).  Every stateful operator takes a watermark so its state is bounded; state
survives restarts through the query's checkpoint location (``resume``).  Each has a
batch twin used for checking (``tessera.streaming.batch``).
"""

from __future__ import annotations

from typing import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.log import latest_per_key


def event_time(df: DataFrame, ts: str = "ts", out: str = "event_time") -> DataFrame:
    """Add a TIMESTAMP event-time column (watermarks reject TIMESTAMP_NTZ)."""
    return df.withColumn(out, F.col(ts).cast("timestamp"))


def current_table(stream: DataFrame, key: str = "key", order: str = "offset") -> DataFrame:
    """STM-1: continuously maintained latest version per key (emit with outputMode 'update').

    State is one row per key (infinite retention, as a compacted topic); for a log with
    deletes see ``tessera.streaming.state.current_changes``."""
    rest = [c for c in stream.columns if c != key]
    return stream.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_r")) \
                 .select(key, "_r.*")


def route(stream: DataFrame, predicate: Column, columns: Iterable[str | Column],
          topic: str | None = None) -> DataFrame:
    """STM-2: stateless filter + projection into a new topic."""
    out = stream.filter(predicate).select(*columns)
    return out.withColumn("topic", F.lit(topic)) if topic else out


def sessions(stream: DataFrame, key: str, ts: str = "event_time", gap: str = "30 minutes",
             watermark: str = "1 hour") -> DataFrame:
    """STM-3: session windows per key (a session ends ``gap`` after its last event)."""
    return (stream.withWatermark(ts, watermark)
            .groupBy(F.session_window(F.col(ts), gap).alias("session"), F.col(key))
            .agg(F.count(F.lit(1)).alias("events"))
            .select(key, F.col("session.start").alias("session_start"),
                    F.col("session.end").alias("session_end"), "events"))


def windowed_agg(stream: DataFrame, ts: str = "event_time", size: str = "1 hour",
                 slide: str | None = None, by: Iterable[str] = ("topic",),
                 aggs: list[Column] | None = None, watermark: str = "1 hour") -> DataFrame:
    """STM-4: tumbling (``slide=None``) or sliding window aggregation."""
    w = F.window(F.col(ts), size, slide) if slide else F.window(F.col(ts), size)
    aggs = aggs or [F.count(F.lit(1)).alias("messages")]
    s = stream.withWatermark(ts, watermark) if watermark else stream
    g = s.groupBy(w.alias("window"), *by).agg(*aggs)
    return g.select(F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"),
                    *[c for c in g.columns if c != "window"])


def rate_per_topic(stream: DataFrame, ts: str = "event_time", size: str = "1 hour",
                   value: str = "value", topic: str = "topic", watermark: str = "1 hour") -> DataFrame:
    """STM-9: messages/s and bytes/s per topic per window."""
    secs = F.lit(_seconds(size))
    return windowed_agg(stream, ts, size, None, [topic],
                        [(F.count(F.lit(1)) / secs).alias("messages_per_second"),
                         (F.sum(F.octet_length(F.col(value))) / secs).alias("bytes_per_second")],
                        watermark)


def _seconds(size: str) -> float:
    n, unit = size.split()
    mult = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    return float(n) * mult[unit.rstrip("s")]


def stream_join(a: DataFrame, b: DataFrame, key: str, a_ts: str, b_ts: str,
                within: str = "10 minutes", a_watermark: str = "1 hour",
                b_watermark: str = "1 hour", how: str = "inner") -> DataFrame:
    """STM-5: stream–stream join by key with ``b`` within ``within`` after ``a``.

    Both sides carry watermarks and the time bound, so Spark can drop old state;
    ``how='leftOuter'`` emits unmatched ``a`` rows once the watermark passes."""
    aw = a.withWatermark(a_ts, a_watermark).alias("a")
    bw = b.withWatermark(b_ts, b_watermark).alias("b")
    cond = F.expr(f"a.{key} = b.{key} AND b.{b_ts} >= a.{a_ts} AND "
                  f"b.{b_ts} <= a.{a_ts} + interval {within}")
    return aw.join(bw, cond, how)


def enrich(stream: DataFrame, dim: DataFrame, key: str | list, how: str = "left") -> DataFrame:
    """STM-6: stream–static join with reference data (no hint: Spark sizes the static side)."""
    return stream.join(dim, key, how)


def dedup(stream: DataFrame, cols: list[str], ts: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """STM-12: a record republished with the same ``cols`` is seen once (state bounded by
    the watermark)."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(cols)


def on_time(stream: DataFrame, ids: list[str], ts: str = "event_time", delay: str = "1 hour") -> DataFrame:
    """STM-10: each record (by ``ids``) that arrives before the watermark has passed it.

    Later records are dropped by the state operator, which counts them; ``arrived`` and
    ``on_time`` are observed on both sides of it (``late_counts``).
    """
    seen = stream.observe("arrived", F.count(F.lit(1)).alias("rows")).withWatermark(ts, delay)
    return seen.dropDuplicatesWithinWatermark(ids).observe("on_time", F.count(F.lit(1)).alias("rows"))


def late_counts(query) -> dict[str, int]:
    """What a finished run of an ``on_time`` stream observed: rows arrived, on time, dropped as late.

    Sums over the progress reports that the session keeps (``spark.sql.streaming.numRecentProgressUpdates``)."""
    out = {"arrived": 0, "on_time": 0, "dropped": 0}
    for p in query.recentProgress:
        for name in ("arrived", "on_time"):
            row = p.observedMetrics.get(name)
            out[name] += (row["rows"] or 0) if row else 0
        out["dropped"] += sum(s.numRowsDroppedByWatermark for s in p.stateOperators)
    return out


# ---------------------------------------------------------------- sinks


def upsert_current(batch: DataFrame, batch_id: int, path: str, key: str = "key",
                   order: str = "offset") -> None:
    """SNK-4 / STM-7 ``foreachBatch`` body: append the micro-batch, reduced to the newest
    version per key, to the table's change log under ``batch=<id>``.  Rewriting the same batch id overwrites only that
    partition, so a retried batch is idempotent; the current table is the
    latest-per-key view of the log (``read_current``), compacted by ``compact``."""
    (latest_per_key(batch, key, order, value=None).withColumn("batch", F.lit(int(batch_id)))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("batch").parquet(f"{path}/log"))


def _snapshots(spark, path: str) -> list[tuple[int, str]]:
    """Committed compaction snapshots as (covered batch id, folder), newest last."""
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(f"{path}/snapshots")
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if name.startswith("upto=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append((int(name.split("=", 1)[1]), st.getPath().toString()))
    return sorted(out)


def read_current(spark, path: str, key: str = "key", order: str = "offset",
                 value: str | None = None) -> DataFrame:
    """The materialised view: newest version per key over the newest compaction snapshot
    plus the change-log batches written after it (partition pruning on ``batch``)."""
    log = spark.read.parquet(f"{path}/log")
    snaps = _snapshots(spark, path)
    if snaps:
        upto, folder = snaps[-1]
        log = spark.read.parquet(folder).unionByName(log.filter(F.col("batch") > upto))
    return latest_per_key(log.drop("batch"), key, order, value)


def read_live(spark, path: str, key: str = "key", order: str = "offset", deleted: str = "deleted") -> DataFrame:
    """The materialised view of a log with deletes: newest version per key that is no delete."""
    return read_current(spark, path, key, order).filter(~F.col(deleted)).drop(deleted)


def compact(spark, path: str, key: str = "key", order: str = "offset") -> str:
    """Write the current view as a snapshot covering every batch so far (a batch job run
    off the streaming path) and expire the change-log batches that the snapshot before it
    covers; later reads start from the new one.  Readers that still hold the older view
    keep its snapshot and the batches after it."""
    log = spark.read.parquet(f"{path}/log")
    upto = log.agg(F.max("batch")).first()[0]
    if upto is None:
        return ""
    current = read_current(spark, path, key, order)
    folder = f"{path}/snapshots/upto={int(upto)}"
    older = _snapshots(spark, path)
    current.withColumn("batch", F.lit(int(upto))).write.mode("overwrite").parquet(folder)
    if older:
        expire(spark, path, older[-1][0])
    return folder


def expire(spark, path: str, upto: int) -> int:
    """Remove the change-log batches up to ``upto`` (a compaction snapshot must cover them)."""
    if not any(covered >= upto for covered, _ in _snapshots(spark, path)):
        raise ValueError(f"no snapshot covers batch {upto}")
    jvm = spark._jvm
    log = jvm.org.apache.hadoop.fs.Path(f"{path}/log")
    fs = log.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = 0
    for st in fs.listStatus(log):
        name = st.getPath().getName()
        if name.startswith("batch=") and int(name.split("=", 1)[1]) <= upto:
            gone += bool(fs.delete(st.getPath(), True))
    return gone


def materialise(stream: DataFrame, path: str, checkpoint: str, key: str = "key",
                order: str = "offset", trigger: dict | None = None, mode: str = "append"):
    """STM-7: keep a queryable latest-per-key table up to date from a stream (``mode="update"``
    for a stream that is itself an aggregate, such as ``current_table``).  Started again with
    the same ``checkpoint`` it continues after the last committed batch (STM-11)."""
    w = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
         .foreachBatch(lambda df, bid: upsert_current(df, bid, path, key, order)))
    return w.trigger(**(trigger or {"availableNow": True})).start()


def stage(stream_in: DataFrame, build: Callable[[DataFrame], DataFrame], out_path: str,
          checkpoint: str, status: str | None = None, status_col: str = "status",
          trigger: dict | None = None):
    """STM-8: read → keep a status → build the next record → append to the next log.

    ``availableNow`` drains what is there and stops; the checkpoint makes a rerun
    continue where it stopped (STM-11)."""
    s = stream_in.filter(F.col(status_col) == status) if status else stream_in
    out = build(s)
    return (out.writeStream.format("parquet").option("path", out_path)
            .option("checkpointLocation", checkpoint).outputMode("append")
            .trigger(**(trigger or {"availableNow": True})).start())


def run_to_end(query) -> None:
    """Wait for an ``availableNow`` query (or drain a running one) and stop it."""
    query.processAllAvailable()
    query.stop()
