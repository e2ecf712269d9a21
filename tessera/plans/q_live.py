"""Stream operators on real streams: the driver tables written as a log in the checkpoint folder,
read with ``readStream``, in several micro-batches and runs where restarts or late rows matter."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import streaming as S
from tessera.functions.text import iso_utc
from tessera.plans import oracle_text as T
from tessera.plans.q_stream import ISO, _drain, _event_stream
from tessera.plans.registry import query
from tessera.session import scratch_path
from tessera.sources.log import stream_log
from tessera.streaming import chain as CH
from tessera.streaming import state as ST

# --- fixed values: parameters of the queries ---
LATE_CHUNKS, LATE_DELAY_DAYS = 4, 1000
DELETE_STATUS = "APPROVED"
KEYS_IN_GROUP = 256  # keys that share a state of stream_transitions


def _clock():
    """An event time that grows along the log (a time of 0 would count as late from the start)."""
    return F.timestamp_seconds(F.col("offset") + 1)


@query("stream_route", "STM-2", views=("v1",), sql="""
SELECT "offset", key, round(value, 2) AS value, 'big_purchases' AS topic FROM v1 WHERE topic = 'purchase' AND value > 100
""")
def stream_route(v):
    """Large purchases filtered and projected into a new topic on a stream."""
    log = _event_stream(v, "route-src", "topic", "offset", "key", "value")
    big = S.route(log, (F.col("topic") == "purchase") & (F.col("value") > 100),
                  ["offset", "key", F.round("value", 2).alias("value")], topic="big_purchases")
    return _drain(v, big, "route-out")


@query("stream_enrich", "STM-6", views=("v1",), sql="""
SELECT "offset", topic, c_mktsegment, c_nationkey FROM v1 LEFT JOIN customer ON user_id = c_custkey
""")
def stream_enrich(v):
    """A stream of activity joined with customer reference data."""
    dim = v.t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey")
    log = _event_stream(v, "enrich-src", "offset", "topic", "user_id")
    return _drain(v, S.enrich(log, dim, "user_id").drop("user_id"), "enrich-out")


def _closed(width: str) -> str:
    """Windows that the last watermark (newest event less an hour) has passed."""
    return f"ws + {width} <= (SELECT max(ts) - INTERVAL 1 HOUR FROM v1)"


@query("stream_tumbling", "STM-4", views=("v1",), sql=f"""
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ws, topic, count(*) AS messages FROM v1 GROUP BY 1, 2)
SELECT {ISO.format(c='ws')} AS window_start, topic, messages FROM w WHERE {_closed('INTERVAL 1 HOUR')}
""")
def stream_tumbling(v):
    """Messages per topic per hour on a stream, a window written once when it closes."""
    w = S.windowed_agg(_event_stream(v, "tumble-src", "topic", "event_time"))
    return _drain(v, w, "tumble-out").select(iso_utc("window_start").alias("window_start"), "topic", "messages")


@query("stream_sliding", "STM-4", views=("v1",), sql=f"""
WITH b AS (SELECT topic, time_bucket(INTERVAL 30 MINUTE, ts) AS b30 FROM v1),
s AS (SELECT topic, b30 AS ws FROM b UNION ALL SELECT topic, b30 - INTERVAL 30 MINUTE FROM b),
w AS (SELECT ws, topic, count(*) AS messages FROM s GROUP BY 1, 2)
SELECT {ISO.format(c='ws')} AS window_start, topic, messages FROM w WHERE {_closed('INTERVAL 1 HOUR')}
""")
def stream_sliding(v):
    """One-hour windows that slide by half an hour, on a stream."""
    w = S.windowed_agg(_event_stream(v, "slide-src", "topic", "event_time"), slide="30 minutes")
    return _drain(v, w, "slide-out").select(iso_utc("window_start").alias("window_start"), "topic", "messages")


@query("stream_rate", "STM-9", views=("v1",), sql=f"""
WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS ws, topic, count(*) AS n, sum(strlen(props)) AS b FROM v1 GROUP BY 1, 2)
SELECT {ISO.format(c='ws')} AS window_start, topic, round(n / 3600.0, 9) AS messages_per_second,
  round(b / 3600.0, 9) AS bytes_per_second
FROM w WHERE {_closed('INTERVAL 1 HOUR')}
""")
def stream_rate(v):
    """Messages and bytes a second per topic and hour on a stream, with a watermark."""
    r = S.rate_per_topic(_event_stream(v, "rate-src", "topic", "event_time", "props"), value="props")
    return _drain(v, r, "rate-out").select(
        iso_utc("window_start").alias("window_start"), "topic", F.round("messages_per_second", 9).alias("messages_per_second"),
        F.round("bytes_per_second", 9).alias("bytes_per_second"))


@query("stream_late_rows", "STM-10 STM-11", views=("v2",), sql=f"""
WITH c AS (SELECT key, "offset", ts, "offset" * {LATE_CHUNKS} // ((SELECT max("offset") FROM v2) + 1) AS chunk FROM v2),
m AS (SELECT chunk, max(ts) AS newest FROM c GROUP BY chunk),
w AS (SELECT a.chunk, max(b.newest) - INTERVAL {LATE_DELAY_DAYS} DAY AS watermark FROM m a JOIN m b ON b.chunk < a.chunk GROUP BY a.chunk)
SELECT key, "offset", count(*) OVER () AS dropped FROM c JOIN w USING (chunk) WHERE ts <= watermark
""")
def stream_late_rows(v):
    """Rows that a watermark drops: the lifecycle log arrives in four parts, each read by a restarted
    query; what never came out is late, and their number is what the query reports as dropped."""
    src, out = scratch_path(v.spark, "late-src"), scratch_path(v.spark, "late-out")
    log = S.event_time(v.v2).select("key", "offset", "event_time")
    chunk = F.floor(F.col("offset") * LATE_CHUNKS / (log.agg(F.max("offset")).scalar() + 1))
    schema, dropped = log.schema, 0
    for i in range(LATE_CHUNKS):
        log.filter(chunk == i).write.mode("append").parquet(src)
        kept = S.on_time(stream_log(v.spark, src, schema), ["offset"], delay=f"{LATE_DELAY_DAYS} days")
        run = (kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", f"{out}/_checkpoint")
               .trigger(availableNow=True).start())
        run.awaitTermination()
        dropped += S.late_counts(run)["dropped"]
    late = v.spark.read.schema(schema).parquet(src).join(
        v.spark.read.schema(schema).parquet(out).select("offset"), "offset", "left_anti")
    return late.select("key", "offset", F.lit(dropped).cast("long").alias("dropped"))


@query("current_with_deletes", "STM-1 STM-7 STM-11 FLT-4 SNK-4", views=("v2",), sql=f"""
SELECT key, "offset", status FROM (SELECT key, max("offset") AS "offset", arg_max(status, "offset") AS status FROM v2 GROUP BY key)
WHERE status <> '{DELETE_STATUS}'
""")
def current_with_deletes(v):
    """Open items as a materialised view of a log with deletes (an approved item's value is null):
    half of the log is read, the query stops, and a new one reads the rest."""
    src, out = scratch_path(v.spark, "deletes-src"), scratch_path(v.spark, "deletes-out")
    value = F.when(F.col("status") != DELETE_STATUS, F.col("status"))
    log = v.v2.select("key", "offset", value.alias("status"), _clock().alias("event_time"))
    half = F.floor(log.agg(F.max("offset")).scalar() / 2)
    for part in (F.col("offset") <= half, F.col("offset") > half):
        log.filter(part).write.mode("append").parquet(src)
        changes = ST.current_changes(stream_log(v.spark, src, log.schema), value="status")
        with ST.rocksdb(v.spark):
            S.materialise(changes, out, f"{out}/_checkpoint", mode="update").awaitTermination()
    return S.read_live(v.spark, out).select("key", "offset", "status")


@query("stream_transitions", "WIN-9 STM-11", views=("v2",), sql="""
SELECT key, "offset", prev_status, status FROM (
  SELECT key, "offset", status, lag(status) OVER (PARTITION BY key ORDER BY "offset") AS prev_status FROM v2)
WHERE prev_status IS NULL OR prev_status <> status
""")
def stream_transitions(v):
    """Status changes on a stream whose versions arrive out of order: a part of the first half comes
    with the second, after a restart; versions wait until the watermark has passed them."""
    src, out = scratch_path(v.spark, "trans-src"), scratch_path(v.spark, "trans-out")
    log = v.v2.select("key", "offset", "status", _clock().alias("event_time"))
    top, keys = log.agg(F.max("offset"), F.approx_count_distinct("key")).first()
    top, groups = top or 0, max(64, keys // KEYS_IN_GROUP)
    o = F.col("offset")
    first = (o < 0.4 * top) | ((o < 0.6 * top) & (o % 2 == 0))
    # the clock of an idle log goes on, so that the last versions come out too
    beat = v.spark.range(1).select(F.lit(None).cast("string").alias("key"), F.lit(3 * top + 10).cast("long").alias("offset"),
                                   F.lit(None).cast("string").alias("status"),
                                   F.timestamp_seconds(F.lit(3 * top + 10)).alias("event_time"))
    for part in (log.filter(first), log.filter(~first), beat):
        part.select(log.columns).write.mode("append").parquet(src)
        moved = ST.transitions(stream_log(v.spark, src, log.schema), delay=f"{int(0.2 * top) + 2} seconds", groups=groups)
        with ST.rocksdb(v.spark):
            run = (moved.writeStream.format("parquet").option("path", out).outputMode("append")
                   .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start())
            run.awaitTermination()
    return v.spark.read.schema(moved.schema).parquet(out)


@query("stream_chain", "PIPE-1 STM-8 STM-11", views=("v4",), sql=f"""
WITH f AS (SELECT id, user_id, {T.strip_fences('text')} AS clean FROM v4), p AS (SELECT *, {T.is_object('clean')} AS ok FROM f)
SELECT id, CAST(user_id AS VARCHAR) AS idea_id, 0.7::DOUBLE AS scope_score, 'RECONSIDER' AS recommendation,
  'PENDING_APPROVAL' AS status
FROM p WHERE ok
""")
def stream_chain(v):
    """Responses to scopes to accepted scopes to decisions, as three streams joined by their logs. The
    chain stops after the second stage with half of the responses read; a restarted one takes all."""
    from tessera.operators.records import build_decision, build_scope

    def accepted(df):
        return df.select("id", "idea_id", "idea_title", "confidence_score")

    def decided(df):
        none = [F.lit("").alias(c) for c in ("scope_challenge_id", "time_challenge_id", "cost_challenge_id")]
        given = df.select("*", F.lit(None).cast("string").alias("response"), *none,
                          F.col("confidence_score").alias("scope_score"))
        return build_decision(given, title="idea_title", keep=("id", "scope_score")).select(
            "id", "idea_id", "scope_score", "recommendation", "status")

    stages = [CH.Stage("scope", lambda df: build_scope(df, order="id", keep=("id",))),
              CH.Stage("accepted", accepted, F.col("confidence_score") >= 0.6), CH.Stage("decision", decided)]
    src, root = scratch_path(v.spark, "chain-src"), scratch_path(v.spark, "chain")
    log = v.v4.select("id", F.col("user_id").cast("string").alias("idea_id"), F.col("event_type").alias("title"),
                      F.col("text").alias("response"))
    for part, upto in ((F.col("id") % 2 == 0, "accepted"), (F.col("id") % 2 == 1, None)):
        log.filter(part).write.mode("append").parquet(src)
        CH.run_chain(v.spark, src, log.schema, stages, root, upto)
    return CH.read_stage(v.spark, root, "decision", CH.schemas(v.spark, log.schema, stages)[-1])
