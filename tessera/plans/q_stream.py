"""Stream operator queries: batch twins over V1/V2, and streams over the same logs (more streams,
with restarts and late rows, are in ``q_live``)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera import streaming as S
from tessera.functions.text import iso_utc
from tessera.operators.intervals import interval_join
from tessera.plans import oracle_text as T
from tessera.plans.registry import query
from tessera.streaming import batch as B

ISO = "strftime({c}, '%Y-%m-%dT%H:%M:%S.%f+00:00')"


@query("sessions", "STM-3", views=("v1",), bench=True, sql=f"""
WITH g AS (SELECT key, ts, "offset", epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY key ORDER BY ts, "offset")) AS gap FROM v1),
f AS (SELECT key, ts, sum(CASE WHEN gap IS NULL OR gap >= 1800000000 THEN 1 ELSE 0 END)
        OVER (PARTITION BY key ORDER BY ts, "offset" ROWS UNBOUNDED PRECEDING) AS session_no FROM g)
SELECT key, session_no, {ISO.format(c='min(ts)')} AS session_start,
  {ISO.format(c='max(ts) + INTERVAL 30 MINUTE')} AS session_end, count(*) AS events
FROM f GROUP BY key, session_no
""")
def sessions_q(v):
    """User sessions with a 30-minute inactivity gap."""
    s = B.sessions(v.v1, "key", "ts", "offset", 1800)
    return s.select("key", "session_no", iso_utc("session_start").alias("session_start"),
                    iso_utc("session_end").alias("session_end"), "events")


@query("tumbling_counts", "STM-4", views=("v1",), sql=f"""
SELECT {ISO.format(c="time_bucket(INTERVAL 1 HOUR, ts)")} AS window_start, topic, count(*) AS messages
FROM v1 GROUP BY 1, 2
""")
def tumbling_counts(v):
    """Messages per topic per hour (tumbling windows)."""
    w = B.windowed_counts(v.v1, "ts", "1 hour")
    return w.select(iso_utc("window_start").alias("window_start"), "topic", "messages")


@query("sliding_counts", "STM-4", views=("v1",), sql=f"""
WITH b AS (SELECT topic, time_bucket(INTERVAL 30 MINUTE, ts) AS b30 FROM v1),
w AS (SELECT topic, b30 AS ws FROM b UNION ALL SELECT topic, b30 - INTERVAL 30 MINUTE FROM b)
SELECT {ISO.format(c='ws')} AS window_start, topic, count(*) AS messages FROM w GROUP BY 1, 2
""")
def sliding_counts(v):
    """Messages per topic in 1-hour windows sliding every 30 minutes."""
    w = B.windowed_counts(v.v1, "ts", "1 hour", "30 minutes")
    return w.select(iso_utc("window_start").alias("window_start"), "topic", "messages")


@query("rate_per_topic", "STM-9", views=("v1",), sql=f"""
SELECT {ISO.format(c="time_bucket(INTERVAL 1 HOUR, ts)")} AS window_start, topic,
  round(count(*) / 3600.0, 9) AS messages_per_second, round(sum(strlen(props)) / 3600.0, 9) AS bytes_per_second
FROM v1 GROUP BY 1, 2
""")
def rate_per_topic_q(v):
    """Messages/s and bytes/s per topic per hour."""
    r = S.rate_per_topic(v.v1, "ts", "1 hour", value="props", watermark=None)
    return r.select(iso_utc("window_start").alias("window_start"), "topic",
                    F.round("messages_per_second", 9).alias("messages_per_second"),
                    F.round("bytes_per_second", 9).alias("bytes_per_second"))


@query("stream_join", "STM-5", views=("v1",), sql="""
SELECT c."offset" AS click_offset, p."offset" AS purchase_offset, c.key
FROM v1 c JOIN v1 p ON c.key = p.key AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 10 MINUTE
WHERE c.topic = 'click' AND p.topic = 'purchase'
""")
def stream_join_q(v):
    """Clicks followed by a purchase of the same user within 10 minutes (bucketed
    interval join: equi-join on (user, time bucket), then the exact bound)."""
    clicks = v.v1.filter(F.col("topic") == "click").select(
        "key", F.col("offset").alias("click_offset"), F.col("ts").alias("click_ts"))
    buys = v.v1.filter(F.col("topic") == "purchase").select(
        "key", F.col("offset").alias("purchase_offset"), F.col("ts").alias("purchase_ts"))
    j = interval_join(clicks, buys, "key", "click_ts", "purchase_ts", 0, 600)
    return j.select("click_offset", "purchase_offset", "key")


@query("enrich", "STM-6", views=("v1",), sql="""
SELECT "offset", topic, c_mktsegment, c_nationkey FROM v1 LEFT JOIN customer ON user_id = c_custkey
""")
def enrich_q(v):
    """Activity enriched with customer reference data (missing reference → NULLs)."""
    dim = v.t.customer.select(F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_nationkey")
    return S.enrich(v.v1.select("offset", "topic", "user_id"), dim, "user_id").drop("user_id")


@query("route", "STM-2", views=("v1",), sql="""
SELECT "offset", key, round(value, 2) AS value, 'big_purchases' AS topic FROM v1 WHERE topic = 'purchase' AND value > 100
""")
def route_q(v):
    """Stateless filter/projection of large purchases into a new topic."""
    return S.route(v.v1, (F.col("topic") == "purchase") & (F.col("value") > 100),
                   ["offset", "key", F.round("value", 2).alias("value")], topic="big_purchases")


@query("late_rows", "STM-10", views=("v2",), sql="""
WITH m AS (SELECT key, "offset", ts, max(ts) OVER (ORDER BY "offset" ROWS UNBOUNDED PRECEDING) AS mx FROM v2)
SELECT key, "offset" FROM m WHERE epoch_us(mx) - epoch_us(ts) > 2592000000000
""")
def late_rows_q(v):
    """Versions whose time is more than 30 days behind the newest time already seen in log
    order (what a 30-day watermark would drop); global running max, range-partitioned."""
    return B.late_rows(v.v2.select("key", "offset", "ts"), "ts", "offset", 30 * 86400).select("key", "offset")


@query("dedup", "STM-12", views=("v1",), sql="""
SELECT key, props, min("offset") AS "offset" FROM v1 GROUP BY key, props
""")
def dedup_q(v):
    """Republished payloads seen once: first occurrence of each (key, payload)."""
    return B.dedup(v.v1.select("key", "props", "offset"), ["key", "props"], "offset")


def _log_copy(v, name: str) -> str:
    """The lifecycle log written to the shared scratch folder, for a file stream to read."""
    from tessera.session import scratch_path

    src = scratch_path(v.spark, name)
    v.v2.select("key", "offset", "ts", "status", "domain").write.parquet(src)
    return src


@query("materialised_current", "STM-7 SNK-4 SRC-2 STM-1", views=("v2",), sql="""
SELECT key, max("offset") AS "offset", arg_max(status, "offset") AS status FROM v2 GROUP BY key
""")
def materialised_current(v):
    """The lifecycle log streamed from files into a materialised
    latest-per-key view via the idempotent foreachBatch upsert, then read back."""
    from tessera.session import scratch_path
    from tessera.sources.log import stream_log

    src = _log_copy(v, "mv-src")
    out = scratch_path(v.spark, "mv")
    schema = v.spark.read.parquet(src).schema
    stream = stream_log(v.spark, src, schema)
    S.run_to_end(S.materialise(stream, out, f"{out}/_checkpoint", key="key", order="offset"))
    S.compact(v.spark, out)
    return S.read_current(v.spark, out, "key", "offset").select("key", "offset", "status")


@query("staged_approvals", "STM-8 STM-11", views=("v2",), sql="""
SELECT key, "offset" FROM v2 WHERE status = 'APPROVED'
""")
def staged_approvals(v):
    """A stage (read → keep APPROVED → next log) drained with availableNow, then resumed
    from the same checkpoint: the second run finds no new input and adds nothing."""
    from tessera.session import scratch_path
    from tessera.sources.log import stream_log

    src = _log_copy(v, "stage-src")
    out = scratch_path(v.spark, "stage-out")
    schema = v.spark.read.parquet(src).schema

    def start(ckpt):
        return S.stage(stream_log(v.spark, src, schema), lambda df: df.select("key", "offset"),
                       out, ckpt, status="APPROVED")

    S.run_to_end(start(f"{out}/_checkpoint"))
    S.run_to_end(start(f"{out}/_checkpoint"))
    return v.spark.read.parquet(out).select("key", "offset")


def _event_stream(v, name: str, *cols: str):
    """The message log written to scratch and read back as a stream, with event time."""
    from tessera.session import scratch_path
    from tessera.sources.log import stream_log

    src = scratch_path(v.spark, name)
    S.event_time(v.v1).select(*cols).write.parquet(src)
    return stream_log(v.spark, src, v.spark.read.parquet(src).schema)


def _drain(v, stream, name: str, mode: str = "append"):
    """Run a stream to its end into a parquet folder and read the folder."""
    from tessera.session import scratch_path

    out = scratch_path(v.spark, name)
    S.run_to_end(stream.writeStream.format("parquet").option("path", out).outputMode(mode)
                 .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start())
    return v.spark.read.schema(stream.schema).parquet(out)


@query("stream_current", "STM-1 SNK-4 STM-7", views=("v2",), sql="""
SELECT key, max("offset") AS "offset", arg_max(status, "offset") AS status FROM v2 GROUP BY key
""")
def stream_current(v):
    """``current_table`` on a real stream, in update mode, kept by the upsert sink."""
    from tessera.session import scratch_path
    from tessera.sources.log import stream_log

    src, out = _log_copy(v, "current-src"), scratch_path(v.spark, "current")
    stream = stream_log(v.spark, src, v.spark.read.parquet(src).schema).select("key", "offset", "status")
    S.run_to_end(S.materialise(S.current_table(stream), out, f"{out}/_checkpoint", mode="update"))
    return S.read_current(v.spark, out).select("key", "offset", "status")


@query("stream_sessions", "STM-3", views=("v1",), sql=f"""
WITH g AS (SELECT key, ts, "offset", epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY key ORDER BY ts, "offset")) AS gap FROM v1),
f AS (SELECT key, ts, sum(CASE WHEN gap IS NULL OR gap >= 1800000000 THEN 1 ELSE 0 END)
        OVER (PARTITION BY key ORDER BY ts, "offset" ROWS UNBOUNDED PRECEDING) AS session_no FROM g)
SELECT key, {ISO.format(c='min(ts)')} AS session_start, {ISO.format(c='max(ts) + INTERVAL 30 MINUTE')} AS session_end,
  count(*) AS events
FROM f GROUP BY key, session_no HAVING max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) - INTERVAL 1 HOUR FROM v1)
""")
def stream_sessions(v):
    """Session windows on a real stream: the sessions that the last watermark has closed."""
    s = S.sessions(_event_stream(v, "sess-src", "key", "event_time"), "key")
    out = _drain(v, s, "sess-out")
    return out.select("key", iso_utc("session_start").alias("session_start"),
                      iso_utc("session_end").alias("session_end"), "events")


@query("stream_stream_join", "STM-5", views=("v1",), sql="""
SELECT c."offset" AS click_offset, p."offset" AS purchase_offset, c.key
FROM v1 c JOIN v1 p ON c.key = p.key AND p.ts >= c.ts AND p.ts <= c.ts + INTERVAL 10 MINUTE
WHERE c.topic = 'click' AND p.topic = 'purchase'
""")
def stream_stream_join(v):
    """Two real streams joined by key within ten minutes, both with watermarks."""
    log = _event_stream(v, "join-src", "topic", "key", "offset", "event_time")
    click = log.filter("topic = 'click'").select("key", F.col("offset").alias("click_offset"),
                                                 F.col("event_time").alias("click_ts"))
    buy = log.filter("topic = 'purchase'").select("key", F.col("offset").alias("purchase_offset"),
                                                  F.col("event_time").alias("buy_ts"))
    j = S.stream_join(click, buy, "key", "click_ts", "buy_ts")
    return _drain(v, j.select("click_offset", "purchase_offset", F.col("a.key").alias("key")), "join-out")


@query("stream_dedup", "STM-12", views=("v1",), sql="""
SELECT DISTINCT key, props FROM v1
""")
def stream_dedup(v):
    """Republished payloads dropped on a real stream; the state is kept for an hour of event time
    (the log arrives as one micro-batch, within which all copies meet)."""
    log = _event_stream(v, "dedup-src", "key", "props", "event_time")
    return _drain(v, S.dedup(log, ["key", "props"], delay="1 hour").select("key", "props"), "dedup-out")


@query("staged_scope", "STM-8 PRJ-2", views=("v4",), sql=f"""
WITH f AS (SELECT id, {T.strip_fences('text')} AS clean FROM v4), p AS (SELECT *, {T.is_object('clean')} AS ok FROM f)
SELECT id, CAST(CASE WHEN ok THEN 0.7 ELSE 0.5 END AS DOUBLE) AS confidence_score FROM p
""")
def staged_scope(v):
    """A stage that runs a record builder on a real stream of responses."""
    from tessera.operators.records import build_scope
    from tessera.session import scratch_path
    from tessera.sources.log import stream_log

    src, out = scratch_path(v.spark, "resp-src"), scratch_path(v.spark, "scope-out")
    v.v4.select("id", F.col("user_id").cast("string").alias("idea_id"), F.col("event_type").alias("title"),
                F.col("text").alias("response")).write.parquet(src)
    stream = stream_log(v.spark, src, v.spark.read.parquet(src).schema)
    S.run_to_end(S.stage(stream, lambda df: build_scope(df, order="id", keep=("id",)), out, f"{out}/_checkpoint"))
    return v.spark.read.parquet(out).select("id", "confidence_score")
