"""Usage, lag, health and snapshot queries over V1/V7 (message log, consumer progress)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import iso_utc, topic_of
from tessera.operators import catalog as C
from tessera.operators import health as H
from tessera.operators import snapshot as S
from tessera.operators import usage as U
from tessera.plans.q_catalog import REG_LATEST_SQL, TOPIC_SQL, registry_latest
from tessera.plans.registry import query
from tessera.schemas import CLUSTER_KEY

SECS = "((epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6)"


def _lag_input(v):
    return v.v7_members.select("topic", "partition", "offset", "group")


@query("consumer_counts", "AGG-3", views=("v7",), sql="""
SELECT CAST(count(DISTINCT "group") AS INTEGER) AS consumer_groups,
       CAST(count(DISTINCT ("group", key)) AS INTEGER) AS active_consumers FROM v7
""")
def consumer_counts_q(v):
    """Number of consumer groups and of active consumers (distinct group members)."""
    return U.consumer_counts(v.v7_members)


@query("topic_consumption", "AGG-4", views=("v7",), sql=f"""
SELECT topic AS topic_name, CAST(count(DISTINCT "group") AS INTEGER) AS consumer_count, count(*) AS messages,
       round(CASE WHEN {SECS} > 0 THEN count(*) / {SECS} ELSE 0.0 END, 6) AS messages_per_second
FROM v7 GROUP BY topic
""")
def topic_consumption_q(v):
    """Per topic: consuming groups and messages per second over the topic's time span."""
    return U.topic_consumption(v.v7_members).withColumn(
        "messages_per_second", F.round("messages_per_second", 6))


@query("top_topics", "SRT-4", views=("v7",), sql=f"""
SELECT topic AS topic_name, round(count(*) / {SECS}, 6) AS messages_per_second
FROM v7 GROUP BY topic ORDER BY messages_per_second DESC, topic_name LIMIT 3
""")
def top_topics_q(v):
    """Top-3 topics by consumption rate."""
    return U.top_topics(U.topic_consumption(v.v7_members), 3).select(
        "topic_name", F.round("messages_per_second", 6).alias("messages_per_second"))


@query("throughput", "AGG-5", views=("v1",), sql=f"""
SELECT round(sum(strlen(props)) / {SECS} / 1e6, 9) AS total_throughput_mbps FROM v1
""")
def throughput_q(v):
    """Total value bytes per second of the log span, MB/s."""
    return H.throughput_mbps(v.v1, value="props").select(
        F.round("total_throughput_mbps", 9).alias("total_throughput_mbps"))


@query("avg_latency", "AGG-6", views=("v1",), sql="""
SELECT round(avg(gap_ms), 3) AS avg_latency_ms FROM (
  SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY key ORDER BY "offset"))) / 1e3 AS gap_ms FROM v1)
""")
def avg_latency_q(v):
    """Mean gap (ms) between an event and the same user's previous event."""
    return H.avg_latency_ms(v.v1).select(F.round("avg_latency_ms", 3).alias("avg_latency_ms"))


@query("error_rate", "AGG-7", views=("v1",), sql="""
SELECT coalesce(count(*) FILTER (WHERE topic = 'error') / nullif(count(*), 0), 0.0) AS error_rate FROM v1
""")
def error_rate_q(v):
    """Share of error events."""
    return H.error_rate(v.v1)


@query("consumer_lag", "AGG-8", views=("v7",), bench=True, sql="""
WITH pos AS (SELECT topic, "partition", "group",
                    row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS position FROM v7),
ends AS (SELECT topic, "partition", max(position) AS end_position FROM pos GROUP BY 1, 2),
commits AS (SELECT topic, "partition", "group", max(position) AS committed_position FROM pos GROUP BY 1, 2, 3)
SELECT topic AS topic_name, "group" AS consumer_group, CAST(sum(end_position - committed_position) AS BIGINT) AS lag_messages
FROM commits JOIN ends USING (topic, "partition") GROUP BY topic, "group"
HAVING sum(end_position - committed_position) > 0
""")
def consumer_lag_q(v):
    """Lag per (topic, group) summed over partitions: messages above the group's highest offset."""
    return U.consumer_lag(_lag_input(v))


@query("top_lag", "SRT-5", views=("v7",), sql="""
WITH pos AS (SELECT topic, "partition", "group",
                    row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS position FROM v7),
ends AS (SELECT topic, "partition", max(position) AS end_position FROM pos GROUP BY 1, 2),
commits AS (SELECT topic, "partition", "group", max(position) AS committed_position FROM pos GROUP BY 1, 2, 3),
lag AS (SELECT topic AS topic_name, "group" AS consumer_group, CAST(sum(end_position - committed_position) AS BIGINT) AS lag_messages
  FROM commits JOIN ends USING (topic, "partition") GROUP BY topic, "group")
SELECT * FROM lag WHERE lag_messages > 0 ORDER BY lag_messages DESC, topic_name, consumer_group LIMIT 5
""")
def top_lag_q(v):
    """Top-5 lag entries."""
    return U.top_lag(U.consumer_lag(_lag_input(v)), 5)


@query("storage_gb", "AGG-9", sql="""
SELECT sum(strlen(text)) / 1e9 AS storage_used_gb FROM documents
""")
def storage_gb_q(v):
    """Stored document bytes in GB."""
    return H.storage_gb(v.t.documents, "text")


@query("topic_health", "JN-9", views=("v3", "v7"), sql=f"""
WITH pos AS (SELECT topic, "partition", "group",
                    row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS position FROM v7),
ends AS (SELECT topic, "partition", max(position) AS end_position FROM pos GROUP BY 1, 2),
commits AS (SELECT topic, "partition", "group", max(position) AS committed_position FROM pos GROUP BY 1, 2, 3),
lag AS (SELECT topic AS topic_name, "group", sum(end_position - committed_position) AS lag_messages
  FROM commits JOIN ends USING (topic, "partition") GROUP BY topic, "group"
  HAVING sum(end_position - committed_position) > 0),
lag_t AS (SELECT topic_name, sum(lag_messages) AS total_lag, count(*) AS lagging_groups FROM lag GROUP BY 1),
use AS (SELECT topic AS topic_name, count(DISTINCT "group") AS consumer_count,
   CASE WHEN {SECS} > 0 THEN count(*) / {SECS} ELSE 0.0 END AS mps FROM v7 GROUP BY topic),
cat AS (SELECT DISTINCT topic AS topic_name FROM v1 UNION SELECT DISTINCT {TOPIC_SQL} FROM v3)
SELECT cat.topic_name, round(coalesce(mps, 0.0), 6) AS messages_per_second,
  CAST(coalesce(consumer_count, 0) AS INTEGER) AS consumer_count, CAST(coalesce(total_lag, 0) AS BIGINT) AS total_lag,
  CAST(coalesce(lagging_groups, 0) AS BIGINT) AS lagging_groups, consumer_count IS NULL AS idle
FROM cat LEFT JOIN use USING (topic_name) LEFT JOIN lag_t USING (topic_name)
""")
def topic_health_q(v):
    """One line per catalog topic (log topics ∪ registry topics): rate, consumers, lag, idle."""
    catalog = (v.v1.select(F.col("topic").alias("topic_name"))
               .union(v.v3.select(topic_of(F.col("subject")).alias("topic_name"))).distinct())
    usage = U.topic_consumption(v.v7_members)
    lag = U.consumer_lag(_lag_input(v))
    return U.topic_health(catalog, usage, lag).withColumn(
        "messages_per_second", F.round("messages_per_second", 6))


# ------------------------------------------------------------------ snapshot

def platform_state(v):
    """The three state summaries of the platform as struct columns over a one-row base
    (one scalar subquery per source): the message log is aggregated once for every
    log-level figure, per-key latency parts included, the registry once, and the consumer
    lag by offset ranges.  Returns the base and the structs, which refer to the base's
    columns."""
    # one pass over the log: counts, bytes, times and first/last event per key and topic, then
    # per key (the mean gap telescopes), then over all keys
    # (min_by/max_by of fixed-width columns stay hash aggregates)
    cells = v.v7_members.groupBy("key", "group", "topic").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("props")).alias("bytes"),
        F.min("ts").alias("t0"), F.max("ts").alias("t1"), F.min("offset").alias("o0"), F.max("offset").alias("o1"),
        F.min_by("ts", "offset").alias("first"), F.max_by("ts", "offset").alias("last"))
    span = (F.unix_micros(F.max_by("last", "o1").cast("timestamp"))
            - F.unix_micros(F.min_by("first", "o0").cast("timestamp")))
    keys = cells.groupBy("key").agg(
        F.sum("n").alias("n"), F.sum("bytes").alias("bytes"), F.min("t0").alias("t0"), F.max("t1").alias("t1"),
        F.coalesce(F.sum(F.when(F.col("topic") == "error", F.col("n"))), F.lit(0)).alias("errors"), span.alias("span_us"))
    # how many topics, groups and readers (keys in groups) there are: hash aggregates of the same cells, no sets
    distinct = cells.agg(
        F.countDistinct("topic").cast("int").alias("producers"), F.countDistinct("group").cast("int").alias("consumer_groups"),
        F.countDistinct(F.struct("key", "group")).cast("int").alias("active_consumers"))
    stats = keys.agg(
        F.max("t1").alias("t1"), F.min("t0").alias("t0"), F.sum("bytes").alias("bytes"), F.sum("n").alias("n"),
        F.sum("errors").alias("errors"),
        (F.sum("span_us") / F.nullif(F.sum(F.col("n") - 1), F.lit(0)) / 1e3).alias("latency"))
    lg = F.struct(*[F.col(c) for c in stats.columns])
    log = stats.select(lg).scalar()
    names = distinct.select(F.struct(*[F.col(c) for c in distinct.columns])).scalar()
    reg = C.schema_topics(registry_latest(v)).agg(F.struct(
        F.countDistinct("topic").cast("int").alias("total_topics"),
        F.count(F.lit(1)).cast("int").alias("total_schemas"),
        F.countDistinct("domain").cast("int").alias("domain_count"))).scalar()
    catalog = v.v3.select(topic_of(F.col("subject")).alias("topic")).distinct()
    consumed = v.t.labels.select(F.concat(F.lit("doc_"), F.floor(F.col("doc_id") / 6)
                                          .cast("string")).alias("topic"))
    idle_n = C.idle_topics(catalog, consumed).agg(F.count(F.lit(1))).scalar()
    lag_n = U.consumer_lag(_lag_input(v)).agg(F.count(F.lit(1))).scalar()
    # every subquery once, as a column of a one-row base: a field access on a subquery
    # expression would copy the whole subquery into the plan at each use
    base = v.spark.range(1).select(log.alias("_log"), names.alias("_names"), reg.alias("_reg"), idle_n.alias("_idle"),
                                   lag_n.alias("_lag"))
    log, names, reg, idle_n, lag_n = (F.col(c) for c in ("_log", "_names", "_reg", "_idle", "_lag"))
    secs = (F.unix_micros(log["t1"].cast("timestamp")) - F.unix_micros(log["t0"].cast("timestamp"))) / 1e6
    as_of = iso_utc(log["t1"])
    dep = F.struct(as_of.alias("timestamp"), F.lit(CLUSTER_KEY).alias("cluster_id"),
                   reg["total_topics"].alias("total_topics"), reg["total_schemas"].alias("total_schemas"),
                   names["producers"].alias("total_connectors"), reg["domain_count"].alias("domain_count"))
    use = F.struct(as_of.alias("timestamp"), names["consumer_groups"].alias("consumer_groups"),
                   names["active_consumers"].alias("active_consumers"),
                   idle_n.cast("int").alias("idle_topic_count"))
    met = F.struct(as_of.alias("timestamp"),
                   F.when(secs > 0, log["bytes"] / secs / 1e6).otherwise(F.lit(0.0)).alias("total_throughput_mbps"),
                   F.coalesce(log["latency"], F.lit(0.0)).alias("avg_latency_ms"),
                   F.coalesce(log["errors"] / F.nullif(log["n"], F.lit(0)), F.lit(0.0)).alias("error_rate"),
                   lag_n.cast("int").alias("topics_with_lag_count"))
    return base, dep, use, met, as_of


PLATFORM_SQL = f"""
WITH {REG_LATEST_SQL},
sch AS (SELECT {"replace(replace(subject, '-value', ''), '-key', '')"} AS topic,
               split_part(coalesce(nullif(namespace, ''), 'unknown'), '.', 1) AS domain FROM reg_latest),
idle AS (SELECT DISTINCT replace(replace(subject, '-value', ''), '-key', '') AS topic FROM v3
         EXCEPT SELECT 'doc_' || CAST(doc_id // 6 AS VARCHAR) FROM labels),
pos AS (SELECT topic, "partition", "group",
               row_number() OVER (PARTITION BY topic, "partition" ORDER BY "offset") AS position FROM v7),
ends AS (SELECT topic, "partition", max(position) AS end_position FROM pos GROUP BY 1, 2),
commits AS (SELECT topic, "partition", "group", max(position) AS committed_position FROM pos GROUP BY 1, 2, 3),
lag AS (SELECT topic, "group" FROM commits JOIN ends USING (topic, "partition") GROUP BY topic, "group"
        HAVING sum(end_position - committed_position) > 0),
gaps AS (SELECT (epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY key ORDER BY "offset"))) / 1e3 AS gap_ms FROM v1)
SELECT 'data-mesh-cluster' AS cluster_id,
  (SELECT CAST(count(DISTINCT topic) AS INTEGER) FROM sch) AS total_topics,
  (SELECT CAST(count(*) AS INTEGER) FROM sch) AS total_schemas,
  (SELECT CAST(count(DISTINCT topic) AS INTEGER) FROM v1) AS total_connectors,
  (SELECT CAST(count(DISTINCT domain) AS INTEGER) FROM sch) AS domain_count,
  (SELECT CAST(count(DISTINCT "group") AS INTEGER) FROM v7) AS consumer_groups,
  (SELECT CAST(count(DISTINCT ("group", key)) AS INTEGER) FROM v7) AS active_consumers,
  (SELECT CAST(count(*) AS INTEGER) FROM idle) AS idle_topic_count,
  (SELECT round(sum(strlen(props)) / {SECS} / 1e6, 9) FROM v1) AS total_throughput_mbps,
  (SELECT round(avg(gap_ms), 3) FROM gaps) AS avg_latency_ms,
  (SELECT count(*) FILTER (WHERE topic = 'error') / count(*) FROM v1) AS error_rate,
  (SELECT CAST(count(*) AS INTEGER) FROM lag) AS topics_with_lag_count,
  'No synthesis available' AS summary, 0 AS observation_count
"""


@query("platform_snapshot", "JN-5 PRJ-8 AGG-2", views=("v3", "v7"), bench=True, sql=PLATFORM_SQL)
def platform_snapshot(v):
    """Flagship: the current state of the platform — catalog, usage and health rolled up
    from the logs and assembled into one CurrentState row (flattened)."""
    base, dep, use, met, _ = platform_state(v)
    snap = S.assemble_snapshot(v.spark, dep, use, met, base=base)
    out = S.flatten_snapshot(snap)
    return out.withColumn("total_throughput_mbps", F.round("total_throughput_mbps", 9)) \
              .withColumn("avg_latency_ms", F.round("avg_latency_ms", 3))


@query("snapshot_defaults", "JN-5 PRJ-8", views=("v2",), sql="""
SELECT 'unknown' AS cluster_id, 0 AS total_topics, 0 AS total_schemas, 0 AS total_connectors, 0 AS domain_count,
  CAST(count(DISTINCT key) AS INTEGER) AS consumer_groups, 0 AS active_consumers, 0 AS idle_topic_count,
  0.0 AS total_throughput_mbps, 0.0 AS avg_latency_ms, 0.0 AS error_rate, 0 AS topics_with_lag_count,
  'No synthesis available' AS summary, 0 AS observation_count FROM v2 WHERE status = 'REJECTED'
""")
def snapshot_defaults(v):
    """Missing sides take defaults: no deployment or metrics state, usage from a log whose
    filter leaves it empty (consumer groups 0)."""
    use = v.v2.filter(F.col("status") == "REJECTED").agg(
        F.countDistinct("key").cast("int").alias("consumer_groups")).select(
        F.lit(CLUSTER_KEY).alias("_k"), F.lit(None).cast("string").alias("timestamp"),
        "consumer_groups", F.lit(0).alias("active_consumers"), F.lit(0).alias("idle_topic_count"))
    snap = S.build_snapshot(v.spark, None, use, None)
    return S.flatten_snapshot(snap)


@query("run_report", "AGG-16", views=("v2", "v3", "v7"), sql=f"""
WITH {REG_LATEST_SQL},
sch AS (SELECT DISTINCT replace(replace(subject, '-value', ''), '-key', '') AS topic,
               split_part(coalesce(nullif(namespace, ''), 'unknown'), '.', 1) AS domain FROM reg_latest),
ideas AS (SELECT key FROM v2 GROUP BY key HAVING arg_max(status, "offset") = 'RAW')
SELECT (SELECT count(DISTINCT topic) FROM sch) AS topic_count,
  (SELECT string_agg(topic, ', ' ORDER BY topic) FROM (SELECT DISTINCT topic FROM sch ORDER BY topic LIMIT 5)) AS first_topics,
  (SELECT count(DISTINCT domain) FROM sch) AS domain_count,
  (SELECT CAST(count(DISTINCT "group") AS INTEGER) FROM v7) AS consumer_groups,
  (SELECT count(*) FROM ideas) AS idea_count,
  (SELECT string_agg(key, ', ' ORDER BY key) FROM (SELECT key FROM ideas ORDER BY key LIMIT 3)) AS first_ideas
""")
def run_report_q(v):
    """One-row run summary: topic count + first 5 names, domains, groups, idea count + first 3."""
    from tessera.operators.log import latest_per_key, with_status

    sch = C.schema_topics(registry_latest(v)).select("topic", "domain")
    topics = sch.select("topic").distinct()
    first5 = topics.orderBy("topic").limit(5).agg(
        F.array_join(F.array_sort(F.collect_list("topic")), ", ")).scalar()
    ideas = with_status(latest_per_key(v.v2, "key", value="status"), "RAW").select("key")
    first3 = ideas.orderBy("key").limit(3).agg(
        F.array_join(F.array_sort(F.collect_list("key")), ", ")).scalar()
    return sch.agg(F.countDistinct("topic").alias("topic_count"),
                   F.countDistinct("domain").alias("domain_count")).select(
        "topic_count", first5.alias("first_topics"), "domain_count",
        U.consumer_counts(v.v7_members).select("consumer_groups").scalar().alias("consumer_groups"),
        ideas.agg(F.count(F.lit(1))).scalar().alias("idea_count"), first3.alias("first_ideas"))


@query("quick_start", "AGG-17", views=("v3",), sql="""
WITH t AS (SELECT DISTINCT replace(replace(subject, '-value', ''), '-key', '') AS name FROM v3)
SELECT name, 'datagen-' || name AS connector, count(*) OVER () AS total_topics, count(*) OVER () AS total_connectors
FROM t
""")
def quick_start_q(v):
    """Every topic with its connector (topic list and connector map as rows), and the totals."""
    # counts and the first names need no schema ids: distinct names, not the numbered catalog
    cat = (v.v3.select(topic_of(F.col("subject")).alias("name")).distinct()
           .withColumn("connector", C.connector_name(F.col("name"))))
    totals = cat.agg(F.struct(F.count(F.lit(1)).alias("t"), F.count("connector").alias("c"))).scalar()
    return cat.withColumn("_n", totals).select(
        "name", "connector", F.col("_n.t").alias("total_topics"), F.col("_n.c").alias("total_connectors"))


@query("pipeline_run", "PIPE-1 AGG-15", views=("v2", "v7"), sql="""
WITH n AS (SELECT count(*) AS n FROM (SELECT key FROM v2 GROUP BY key HAVING arg_max(status, "offset") = 'APPROVED'))
SELECT stage, CASE WHEN stage = 'monitoring' THEN 1 ELSE n END AS rows
FROM n, (SELECT unnest(['monitoring', 'ideas', 'idea_review', 'scope', 'time', 'cost', 'decision', 'decision_review',
                        'solution', 'solution_review', 'implementation']) AS stage)
""")
def pipeline_run(v):
    """The whole chain over a scratch folder: monitoring state of the log, one idea for each
    approved item, the idea review left out, no responder (fallback records)."""
    from tessera.operators.log import latest_per_key, with_status
    from tessera.plans.pipeline import run_pipeline
    from tessera.session import scratch_path

    usage = U.consumer_counts(v.v7_members).select(
        F.lit(CLUSTER_KEY).alias("_k"), F.lit("now").alias("timestamp"), "consumer_groups", "active_consumers",
        F.lit(0).alias("idle_topic_count"))
    items = with_status(latest_per_key(v.v2, "key", value="status"), "APPROVED")
    idea = F.struct(F.concat(F.lit("Item "), F.col("key")).alias("title"), F.col("domain").alias("domain"))
    responses = items.select(F.col("key").alias("id"),
                             F.to_json(F.struct(F.array(idea).alias("ideas"))).alias("response"))
    counts = run_pipeline(v.spark, responses, scratch_path(v.spark, "pipeline"), skip={"idea_review"}, usage=usage)
    return v.spark.createDataFrame(sorted(counts.items()), "stage string, rows long")


@query("deployment_state", "PRJ-11 AGG-1", views=("v3",), sql="""
WITH t AS (SELECT DISTINCT replace(replace(subject, '-value', ''), '-key', '') AS name FROM v3),
n AS (SELECT name, row_number() OVER (ORDER BY name) AS no FROM t)
SELECT name, 6::INTEGER AS partitions, name || '-value' AS subject, (no + 100000)::INTEGER AS schema_id,
       'datagen-' || name AS connector, 'source' AS connector_type
FROM n
""")
def deployment_state(v):
    """The nested deployment row (topics, schemas, connectors), read back as one row a topic."""
    cat = C.catalog_topics(v.v3.select(topic_of(F.col("subject")).alias("name")))
    schemas = cat.select("subject", F.lit(1).alias("version"), "schema_id", F.lit("AVRO").alias("schema_type"),
                         F.lit("none.x").alias("namespace"))
    row = C.deployment_record(cat, schemas, "c", "e", "t")
    t = row.select(F.explode("topics").alias("t")).select("t.name", "t.partitions")
    s = row.select(F.explode("schemas").alias("s")).select(
        topic_of(F.col("s.subject")).alias("name"), "s.subject", "s.schema_id")
    c = row.select(F.explode("connectors").alias("c")).select(
        F.regexp_replace("c.name", "^datagen-", "").alias("name"), F.col("c.name").alias("connector"),
        F.col("c.type").alias("connector_type"))
    return t.join(s, "name").join(c, "name").select("name", "partitions", "subject", "schema_id", "connector",
                                                    "connector_type")
