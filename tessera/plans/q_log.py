"""Log-semantics queries over V1 (message log) and V2 (lifecycle log)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.jsontext import is_json_object
from tessera.functions.text import iso_utc
from tessera.operators import log as L
from tessera.operators.sequence import number_rows, running_sum
from tessera.plans.registry import query
from tessera.schemas import IDEA_STATUS
from tessera.sources.log import decode_value


@query("log_scan_by_topic", "SRC-1", views=("v1",), sql="""
SELECT topic, "partition", count(*) AS messages, min("offset") AS first_offset,
       max("offset") AS last_offset, count(DISTINCT key) AS keys
FROM v1 GROUP BY topic, "partition"
""")
def log_scan_by_topic(v):
    """The whole log written as a topic-foldered log, read back by ``read_log``, and the
    extents of each topic partition."""
    from tessera.session import scratch_path
    from tessera.sources.log import read_log

    path = scratch_path(v.spark, "log")
    v.v1.select("topic", "partition", "offset", "key").write.partitionBy("topic").parquet(path)
    log = read_log(v.spark, path)
    return log.groupBy("topic", "partition").agg(
        F.count(F.lit(1)).alias("messages"), F.min("offset").alias("first_offset"),
        F.max("offset").alias("last_offset"), F.countDistinct("key").alias("keys"))


@query("read_between_offsets", "SRC-1 SRC-2", views=("v1",), sql="""
WITH e AS (SELECT topic, "partition", max("offset") + 1 AS "end" FROM v1 WHERE "offset" % 3 <> 0 GROUP BY ALL)
SELECT v1.topic, v1."partition", v1."offset", v1."offset" >= "end" // 2 AND v1."offset" < "end" AS again
FROM v1 JOIN e USING (topic, "partition") WHERE v1."offset" >= "end" // 2
""")
def read_between_offsets(v):
    """A log read by offsets of its topic partitions, from the middle on: marked rows lie before the
    ends that an earlier, shorter log had."""
    from tessera.session import scratch_path
    from tessera.sources.log import end_offsets, read_log

    path = scratch_path(v.spark, "offsets-log")
    log = v.v1.select("topic", "partition", "offset")
    log.filter("offset % 3 <> 0").write.partitionBy("topic").parquet(path)
    ends = end_offsets(read_log(v.spark, path))
    log.filter("offset % 3 = 0").write.mode("append").partitionBy("topic").parquet(path)
    middle = {t: {p: e // 2 for p, e in ps.items()} for t, ps in ends.items()}
    known = F.lit(False)
    for t, ps in ends.items():
        known = known | ((F.col("topic") == t) & F.col("partition").isin(sorted(ps)))
    new = read_log(v.spark, path, list(ends), starting=ends).filter(known).withColumn("again", F.lit(False))
    old = read_log(v.spark, path, list(ends), starting=middle, ending=ends).filter(known).withColumn("again", F.lit(True))
    return old.unionByName(new).select("topic", "partition", "offset", "again")


@query("decode_value", "SRC-3", views=("v1",), sql="""
SELECT "offset", topic, CAST(props->>'k' AS INTEGER) AS k FROM v1
""")
def decode_value_q(v):
    """Typed decode of each message's JSON value with a reader schema."""
    return decode_value(v.v1.select("offset", "topic", "props"), "k INT", value="props")


@query("split_errors", "FLT-5", views=("v4",), sql="""
SELECT id, kind,
  NOT coalesce(CASE WHEN json_valid(text) THEN json_type(text) = 'OBJECT'
    AND NOT regexp_matches(text, ',\\s*[}\\]]') ELSE FALSE END, FALSE) AS rejected
FROM v4
""")
def split_errors_q(v):
    """Raw responses marked good / rejected (not one JSON object) in one pass."""
    return L.mark_errors(v.v4, "text").select("id", "kind", "rejected")


@query("latest_in_topic", "WIN-1 FLT-4", views=("v1",), sql="""
SELECT topic, arg_max("offset", "offset") AS "offset", arg_max(key, "offset") AS key,
       arg_max(props, "offset") AS props
FROM v1 WHERE props IS NOT NULL GROUP BY topic
""")
def latest_in_topic_q(v):
    """Last non-null value of each topic regardless of key (tombstones skipped)."""
    return L.latest_in_topic(v.v1.select("topic", "offset", "key", "props"), value="props",
                             by=["topic"])


@query("latest_per_key", "WIN-2 STM-1", views=("v2",), bench=True, sql="""
SELECT key, max("offset") AS "offset", arg_max(status, "offset") AS status,
       arg_max(domain, "offset") AS domain, round(arg_max(score, "offset"), 2) AS score
FROM v2 GROUP BY key
""")
def latest_per_key_q(v):
    """Compaction view of the lifecycle log: newest version of every key."""
    out = L.latest_per_key(v.v2.select("key", "offset", "status", "domain", "score"), "key",
                           value="status")
    return out.withColumn("score", F.round("score", 2))


@query("first_per_key", "WIN-3", views=("v2",), sql="""
SELECT key, min("offset") AS "offset", arg_min(status, "offset") AS status FROM v2 GROUP BY key
""")
def first_per_key_q(v):
    """First version of every key (explicit order column, T3)."""
    return L.first_per_key(v.v2.select("key", "offset", "status"), "key", value="status")


@query("first_per_topic", "SRT-3", views=("v1",), sql="""
SELECT topic, min("offset") AS "offset", arg_min(key, "offset") AS key FROM v1 GROUP BY topic
""")
def first_per_topic_q(v):
    """Demo mode: first usable record of each topic."""
    return L.first_per_topic(v.v1.select("topic", "offset", "key", "props"), value="props") \
        .select("topic", "offset", "key")


@query("most_recent_approved", "WIN-4 SRT-2", views=("v2",), sql="""
SELECT key, "offset", status FROM v2 WHERE status = 'APPROVED'
ORDER BY ts DESC, "offset" DESC LIMIT 5
""")
def most_recent_q(v):
    """Top-5 newest APPROVED versions (ts, then offset) — a top-k report."""
    return L.most_recent(L.with_status(v.v2, "APPROVED"), 5).select("key", "offset", "status")


@query("approved_raw_versions", "FLT-1", views=("v2",), sql="""
SELECT key, "offset" FROM v2 WHERE status = 'APPROVED'
""")
def approved_raw_versions(v):
    """Reference behaviour (T2): status filter applied to every version in the log."""
    return L.with_status(v.v2, "APPROVED").select("key", "offset")


@query("approved_latest", "FLT-1 WIN-2", views=("v2",), sql="""
SELECT key, "offset" FROM (SELECT key, max("offset") AS "offset", arg_max(status, "offset") AS status
  FROM v2 GROUP BY key) WHERE status = 'APPROVED'
""")
def approved_latest(v):
    """Our default (T2): latest version per key first, then the status filter."""
    return L.with_status(L.latest_per_key(v.v2, "key", value="status"), "APPROVED") \
        .select("key", "offset")


@query("unprocessed", "FLT-2", views=("v2",), sql="""
SELECT key, status FROM (SELECT key, arg_max(status, "offset") AS status FROM v2 GROUP BY key)
WHERE status NOT IN ('APPROVED', 'REJECTED')
""")
def unprocessed_q(v):
    """Latest items not yet decided."""
    return L.unprocessed(L.latest_per_key(v.v2, "key", value="status")).select("key", "status")


@query("by_id", "FLT-3", views=("v2",), sql="""
SELECT key, "offset", status FROM v2
WHERE key = (SELECT arg_max(key, "offset") FROM v2)
""")
def by_id_q(v):
    """Point lookup of one id (the id of the newest version, found by a scalar subquery)."""
    newest = v.v2.agg(F.max_by("key", "offset")).scalar()
    return L.by_id(v.v2, "key", newest).select("key", "offset", "status")


@query("limit_one", "SRT-2", views=("v2",), sql="""
SELECT key, "offset", status FROM v2 WHERE status = 'RAW' ORDER BY ts DESC, "offset" DESC LIMIT 1
""")
def limit_one_q(v):
    """The one newest open item (the feature: a stage that processes a single item)."""
    return L.limit_one(L.with_status(v.v2, "RAW")).select("key", "offset", "status")


@query("read_topics", "SRC-8 SET-1", views=("v1",), sql="""
SELECT topic, count(*) AS messages, count(value) AS with_value, count(props) AS with_props FROM (
  SELECT topic, "offset", CASE WHEN topic <> 'error' THEN value END AS value,
         CASE WHEN topic = 'error' THEN props END AS props FROM v1) GROUP BY topic
""")
def read_topics_q(v):
    """Topics with different columns, one folder each, read by one contract: error records
    carry a payload, the others a value; missing columns come back as NULL."""
    from tessera.session import scratch_path
    from tessera.sources.log import read_topics

    base = scratch_path(v.spark, "topics")
    # one write for each layout, foldered by topic; the topics of a log are its catalog
    for layout, is_layout in (("props", F.col("topic") == "error"), ("value", F.col("topic") != "error")):
        v.v1.filter(is_layout).select("topic", "offset", layout).write.mode("append").partitionBy("topic").parquet(base)
    names = v.v1.select("topic").distinct().collect()
    log = read_topics(v.spark, {r.topic: f"{base}/topic={r.topic}" for r in names})
    return log.groupBy("topic").agg(F.count(F.lit(1)).alias("messages"), F.count("value").alias("with_value"),
                                    F.count("props").alias("with_props"))


@query("read_json_docs", "SRC-4", views=("v2",), sql="""
SELECT key, max("offset") AS "offset", arg_max(status, "offset") AS status FROM v2 GROUP BY key
""")
def read_json_docs_q(v):
    """The newest versions written as JSON documents of bounded size, in folders by status, and
    read back by pattern."""
    from tessera.session import scratch_path
    from tessera.sinks import write_json_parts
    from tessera.sources.docs import read_json_docs

    folder = scratch_path(v.spark, "docs")
    latest = L.latest_per_key(v.v2, "key", value="status").select("key", "offset", "status")
    write_json_parts(latest, folder, ["key"], by=["status"])
    return read_json_docs(v.spark, f"{folder}/*/*.txt", "key STRING, offset BIGINT, status STRING",
                          with_file=False).select("key", "offset", "status")


@query("json_document_index", "SNK-2 SRC-4", views=("v2",), sql="""
WITH q AS (SELECT key, arg_max(status, "offset") AS status FROM v2 GROUP BY key),
p AS (SELECT status, key, (row_number() OVER (PARTITION BY status ORDER BY key) - 1) // 100 AS part FROM q)
SELECT status, count(*) AS records, min(key) AS "first", max(key) AS "last" FROM p GROUP BY status, part
""")
def json_document_index(v):
    """Index of JSON documents of at most 100 records each: which keys stand in which document."""
    from tessera.session import scratch_path
    from tessera.sinks import write_json_parts

    latest = L.latest_per_key(v.v2, "key", value="status").select("key", "offset", "status")
    index = write_json_parts(latest, scratch_path(v.spark, "indexed"), ["key"], by=["status"], per_document=100)
    return index.select("status", "records", "first", "last")


@query("publish_twice", "SNK-1 SRC-1 WIN-2", views=("v2",), sql="""
SELECT key, arg_max(status, "offset") AS status FROM v2 GROUP BY key
""")
def publish_twice(v):
    """A topic published in two writes (open versions, then the newest ones) and read back: the
    default latest-per-key gives the second write's version."""
    from tessera.session import scratch_path
    from tessera.sinks import publish
    from tessera.sources.log import read_log

    target = scratch_path(v.spark, "published")
    first = L.first_per_key(v.v2, "key", value="status").select("key", F.lit("OPEN").alias("status"))
    publish(first, "ideas", "key", target)
    publish(L.latest_per_key(v.v2, "key", value="status").select("key", "status"), "ideas", "key", target)
    log = decode_value(read_log(v.spark, target, topics=["ideas"]).drop("key"), "key STRING, status STRING")
    return L.latest_per_key(log, "key", value="status").select("key", "status")


@query("check_domain_status", "FLT-7", views=("v2",), sql="""
SELECT key, "offset", status FROM v2
WHERE status IS NULL OR status NOT IN ('RAW', 'REFINED', 'APPROVED', 'REJECTED')
""")
def check_domain_q(v):
    """Enum check: lifecycle statuses outside the idea status symbols."""
    return L.check_domain(v.v2, "status", IDEA_STATUS).select("key", "offset", "status")


@query("confidence_between", "FLT-8", sql="""
SELECT l_orderkey, l_linenumber, l_discount FROM lineitem
WHERE l_discount IS NULL OR NOT (l_discount BETWEEN 0.0 AND 0.05)
""")
def confidence_between_q(v):
    """Range check of a documented 0..x score (l_discount vs [0, 0.05]): violations."""
    li = v.t.lineitem.select("l_orderkey", "l_linenumber", "l_discount")
    return L.confidence_between(li, "l_discount", 0.0, 0.05)


@query("newest_first", "SRT-1", views=("v2",), sql="""
SELECT key, "offset", count(*) OVER (ORDER BY t) - count(*) OVER (PARTITION BY t) AS older
FROM (SELECT key, "offset", coalesce(strftime(ts, '%Y-%m-%dT%H:%M:%S.%f+00:00'), '') AS t FROM v2)
""")
def newest_first_q(v):
    """The whole listing newest first by ISO text timestamp, stable by offset; ``older`` is the
    number of items with a lower timestamp, which never rises along the listing."""
    df = v.v2.select("key", "offset", F.coalesce(iso_utc("ts"), F.lit("")).alias("ts_text"))
    per = df.groupBy("ts_text").agg(F.count(F.lit(1)).alias("n"))
    older = running_sum(per, [], ["ts_text"], "n", "upto", ranges=F.substring("ts_text", 1, 7)) \
        .select("ts_text", (F.col("upto") - F.col("n")).alias("older"))
    return L.newest_first(df.join(older, "ts_text"), "ts_text").select("key", "offset", "older")


@query("compact_with_lag", "WIN-7", views=("v2",), sql="""
WITH c AS (SELECT max(ts) - INTERVAL 30 DAY AS cutoff FROM v2),
latest AS (SELECT key, max("offset") AS "offset" FROM v2 GROUP BY key)
SELECT v2.key, v2."offset" FROM v2, c WHERE v2.ts > c.cutoff
UNION ALL
SELECT v2.key, v2."offset" FROM v2 JOIN latest USING (key, "offset"), c WHERE NOT (v2.ts > c.cutoff)
""")
def compact_with_lag_q(v):
    """What a compacted topic holds: newest per key plus everything younger than the lag
    (30 days here, since the lifecycle log has day-resolution timestamps)."""
    out = L.compact_with_lag(v.v2.select("key", "offset", "ts", "status"), value="status",
                             lag_ms=30 * 86_400_000)
    return out.select("key", "offset")


@query("apply_retention", "WIN-6", views=("v1",), sql="""
WITH c AS (SELECT max(ts) AS clock FROM v1)
SELECT topic, "offset" FROM v1, c
WHERE CASE topic WHEN 'signup' THEN TRUE
                 WHEN 'error' THEN ts >= clock - INTERVAL 2 DAY
                 ELSE ts >= clock - INTERVAL 7 DAY END
""")
def apply_retention_q(v):
    """7-day retention with per-topic overrides (error: 2 days, signup: keep forever)."""
    out = L.apply_retention(v.v1, overrides={"error": 2 * 86_400_000, "signup": -1})
    return out.select("topic", "offset")


@query("status_transitions", "WIN-9", views=("v2",), sql="""
SELECT key, "offset", prev_status, status FROM (
  SELECT key, "offset", status, lag(status) OVER (PARTITION BY key ORDER BY "offset") AS prev_status FROM v2)
WHERE prev_status IS NULL OR prev_status <> status
""")
def status_transitions_q(v):
    """Audit trail: versions whose status differs from the previous version of the key."""
    out = L.status_transitions(v.v2.select("key", "offset", "status"))
    return out.select("key", "offset", "prev_status", "status")


@query("numbered_queue", "WIN-8", views=("v2",), sql="""
WITH q AS (SELECT key, max("offset") AS "offset", arg_max(status, "offset") AS status,
                  arg_max(ts, "offset") AS ts FROM v2 GROUP BY key)
SELECT key, item_no, '[' || CAST(item_no AS VARCHAR) || '/' || CAST(n AS VARCHAR) || ']' AS progress
FROM (SELECT key, row_number() OVER (ORDER BY ts, key) AS item_no, count(*) OVER () AS n
      FROM q WHERE status = 'APPROVED')
""")
def numbered_queue(v):
    """1-based numbering and '[i/n]' progress over the approved queue (numbered by day ranges)."""
    q = L.with_status(L.latest_per_key(v.v2, "key", value="status"), "APPROVED")
    n = q.agg(F.count(F.lit(1))).scalar()
    out = number_rows(q.select("key", "ts"), ["ts", "key"], name="item_no")
    return out.select("key", "item_no",
                      F.concat(F.lit("["), F.col("item_no").cast("string"), F.lit("/"),
                               n.cast("string"), F.lit("]")).alias("progress"))


@query("ids_in_all", "SET-2", views=("v6",), sql="""
SELECT idea_id FROM v6_scope INTERSECT SELECT idea_id FROM v6_time INTERSECT SELECT idea_id FROM v6_cost
""")
def ids_in_all_q(v):
    """Ideas present in every evaluation topic."""
    return L.ids_in_all(v.v6_scope, v.v6_time, v.v6_cost)


@query("unique_ids", "AGG-18", views=("v6",), sql="""
SELECT DISTINCT idea_id FROM v6_time
""")
def unique_ids_q(v):
    """Distinct ids in one evaluation log."""
    return L.unique_ids(v.v6_time)


@query("stage_counts", "AGG-15", views=("v2", "v6"), sql="""
SELECT 'scope' AS stage, count(*) AS "rows" FROM v6_scope
UNION ALL SELECT 'time', count(*) FROM v6_time
UNION ALL SELECT 'cost', count(*) FROM v6_cost
UNION ALL SELECT 'approved', count(*) FROM v2 WHERE status = 'APPROVED'
""")
def stage_counts_q(v):
    """Rows produced per stage."""
    kinds = F.create_map(*[F.lit(x) for kv in (("click", "scope"), ("view", "time"), ("purchase", "cost"))
                           for x in kv])
    evaluations = L.stage_counts(v.t.events.select(F.element_at(kinds, F.col("event_type")).alias("stage")),
                                 F.col("stage"), ["scope", "time", "cost"])
    return evaluations.unionByName(L.stage_counts(v.v2, F.lower("status"), ["approved"]))


@query("documents_by_name", "SRT-7", sql="""
SELECT source || '/' || CAST(doc_id AS VARCHAR) || '.json' AS name, lang FROM documents
ORDER BY name
""")
def documents_by_name(v):
    """Documents listed in file-name order."""
    docs = v.t.documents.select(F.concat(F.col("source"), F.lit("/"), F.col("doc_id").cast("string"),
                                         F.lit(".json")).alias("name"), "lang")
    return L.by_name(docs, "name")


@query("publish_envelope", "SNK-1 SCL-14", views=("v2",), sql="""
SELECT 'ideas' AS topic, key, to_json(struct_pack(key := key, status := status, domain := domain)) AS value
FROM (SELECT key, arg_max(status, "offset") AS status, arg_max(domain, "offset") AS domain FROM v2 GROUP BY key)
""")
def publish_envelope(v):
    """The (topic, key, value) records a publish appends: whole record as compact JSON."""
    from tessera.sinks import envelope

    latest = L.latest_per_key(v.v2, "key", value="status").select("key", "status", "domain")
    return envelope(latest, "ideas", "key")


@query("edits_or_empty", "SRC-5", views=("v2",), sql="""
SELECT key, arg_max(status, "offset") AS status, FALSE AS edited FROM v2 GROUP BY key
""")
def edits_or_empty(v):
    """Current items joined with an edits state that does not exist yet: an absent input
    is an empty typed table, so every item comes through unedited."""
    from tessera.session import scratch_path
    from tessera.sources.log import read_or_empty

    edits = read_or_empty(v.spark, scratch_path(v.spark, "absent-edits"), "key STRING, title STRING")
    latest = L.latest_per_key(v.v2, "key", value="status").select("key", "status")
    return latest.join(edits.withColumn("edited", F.lit(True)), "key", "left") \
                 .select("key", "status", F.coalesce("edited", F.lit(False)).alias("edited"))


@query("keyed_json_snapshot", "SNK-2 SRC-5", views=("v2",), sql="""
SELECT key, max("offset") AS "offset", arg_max(status, "offset") AS status FROM v2 GROUP BY key
""")
def keyed_json_snapshot(v):
    """Keyed JSON snapshots in the shared checkpoint folder: the open versions are written
    first, then the approved versions are merged in (newest per key replaces), and the
    second snapshot is read back.  Each write goes to a new folder, never the one read."""
    from tessera import sinks
    from tessera.session import scratch_path
    from tessera.sources.log import read_or_empty

    rows = v.v2.select("key", "offset", "status")
    base = scratch_path(v.spark, "json-snapshots")
    approved = F.coalesce(F.col("status") == "APPROVED", F.lit(False))
    first = sinks.write_json_docs(v.spark, rows.filter(~approved), base, None, "key", "offset")
    second = sinks.write_json_docs(v.spark, rows.filter(approved), base, first, "key", "offset")
    return read_or_empty(v.spark, second, rows.schema).select("key", "offset", "status")
