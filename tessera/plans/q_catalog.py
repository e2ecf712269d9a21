"""Catalog queries over V3 (registry listing) and the driver dimension tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import topic_of
from tessera.operators import catalog as C
from tessera.plans.registry import query
from tessera.sources.listing import explode_json, parse_connectors, parse_listing, parse_registry

REG_LATEST_SQL = """reg AS (SELECT subject, max(version) AS version,
    arg_max(struct_pack(sid := schema_id, ns := namespace), version) AS pick FROM v3 GROUP BY subject),
  reg_latest AS (SELECT subject, version, pick.sid AS schema_id, 'AVRO' AS schema_type, pick.ns AS namespace FROM reg)"""

TOPIC_SQL = "replace(replace(subject, '-value', ''), '-key', '')"
DOMAIN_SQL = "split_part(coalesce(nullif(namespace, ''), 'unknown'), '.', 1)"


def registry_latest(v):
    return parse_registry(v.v3_listing, "listing")


@query("parse_registry", "SRC-7 WIN-5", views=("v3",), sql=f"""
WITH {REG_LATEST_SQL}
SELECT subject, version, schema_id, schema_type, namespace FROM reg_latest
""")
def parse_registry_q(v):
    """Registry listing JSON → one row per subject at its highest version, namespace from
    the embedded schema text."""
    return registry_latest(v)


@query("parse_registry_first", "WIN-5", views=("v3",), sql="""
SELECT subject, arg_min(version, doc_id) AS version FROM v3 GROUP BY subject
""")
def parse_registry_first_q(v):
    """Reference mode: element 0 of each subject's version list (not always the newest, T14)."""
    return parse_registry(v.v3_listing, "listing", mode="first").select("subject", "version")


@query("domains", "AGG-1 SCL-1 SCL-2", views=("v3",), sql=f"""
WITH {REG_LATEST_SQL}
SELECT {DOMAIN_SQL} AS domain, count(DISTINCT {TOPIC_SQL}) AS topic_count, count(*) AS subject_count
FROM reg_latest GROUP BY 1
""")
def domains_q(v):
    """Topics grouped by the first namespace segment (NULL → 'unknown'); key and value
    subjects collapse into one topic."""
    return C.domains(registry_latest(v))


@query("domain_topics", "SET-4", views=("v3",), sql=f"""
WITH {REG_LATEST_SQL}
SELECT DISTINCT {DOMAIN_SQL} AS domain, {TOPIC_SQL} AS topic FROM reg_latest
""")
def domain_topics_q(v):
    """Distinct (domain, topic) pairs."""
    return C.domain_topics(registry_latest(v))


@query("topic_of_modes", "SCL-2", views=("v3",), sql=f"""
SELECT DISTINCT subject, {TOPIC_SQL} AS topic, regexp_replace(subject, '-(key|value)$', '') AS strict_topic
FROM v3
""")
def topic_of_modes(v):
    """Subject → topic in reference mode (suffix removed anywhere) and strict mode."""
    return v.v3.select("subject", topic_of(F.col("subject")).alias("topic"),
                       topic_of(F.col("subject"), strict=True).alias("strict_topic")).distinct()


def _nation_listing(v, marker, quoted):
    n = v.t.nation.join(v.t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    names = F.array_join(F.array_sort(F.collect_list("n_name")), ", ")
    body = F.concat(F.lit('"'), names, F.lit(', ,"')) if quoted else F.concat(names, F.lit(", ,"))
    return n.groupBy("r_name").agg(F.concat(F.lit(marker + " "), body).alias("listing"))


@query("parse_listing", "SRC-6 SCL-10", sql="""
SELECT r_name, CAST(row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1 AS INTEGER) AS position,
       n_name AS name
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def parse_listing_q(v):
    """Tool listing text 'Kafka topics: a, b, ,' per region → one row per listed name."""
    return parse_listing(_nation_listing(v, "Kafka topics:", False), "listing", keep=("r_name",))


@query("parse_connectors", "SRC-6", sql="""
SELECT r_name, CAST(row_number() OVER (PARTITION BY r_name ORDER BY n_name) - 1 AS INTEGER) AS position,
       n_name AS name, 'source' AS type, 'RUNNING' AS status
FROM nation JOIN region ON n_regionkey = r_regionkey
""")
def parse_connectors_q(v):
    """Connector listing (quoted) → RUNNING source connectors."""
    return parse_connectors(_nation_listing(v, "Active Connectors:", True), "listing",
                            keep=("r_name",))


@query("catalog_topics", "PRJ-11", views=("v3",), sql=f"""
SELECT name, 6 AS partitions, 3 AS replication_factor, name || '-value' AS subject,
  CAST(row_number() OVER (ORDER BY name) + 100000 AS INTEGER) AS schema_id,
  'datagen-' || name AS connector, 'source' AS connector_type, 'RUNNING' AS connector_status
FROM (SELECT DISTINCT {TOPIC_SQL} AS name FROM v3)
""")
def catalog_topics_q(v):
    """Topic list → catalog rows: schema ids from 100001 in name order, subjects, connectors."""
    topics = v.v3.select(topic_of(F.col("subject")).alias("name"))
    return C.catalog_topics(topics)


def _doc_topic(col):
    return F.concat(F.lit("doc_"), F.floor(col / 6).cast("string"))


@query("idle_topics", "SET-3", views=("v3",), sql=f"""
SELECT DISTINCT {TOPIC_SQL} AS topic FROM v3
EXCEPT SELECT 'doc_' || CAST(doc_id // 6 AS VARCHAR) FROM labels
""")
def idle_topics_q(v):
    """Catalog topics nobody consumes (no document of the topic carries a label)."""
    catalog = v.v3.select(topic_of(F.col("subject")).alias("topic")).distinct()
    consumed = v.t.labels.select(_doc_topic(F.col("doc_id")).alias("topic"))
    return C.idle_topics(catalog, consumed)


@query("check_topics", "JN-8", sql="""
WITH refs AS (SELECT doc_id, unnest(['t' || CAST(doc_id AS VARCHAR), 't' || CAST(doc_id + 1 AS VARCHAR)]) AS topic
              FROM documents)
SELECT doc_id, topic, topic IN (SELECT 't' || CAST(doc_id AS VARCHAR) FROM labels) AS known FROM refs
""")
def check_topics_q(v):
    """Related-topic references checked against the catalog (labelled documents): known / unknown."""
    docs = v.t.documents.select(
        F.col("doc_id"),
        F.array(F.concat(F.lit("t"), F.col("doc_id").cast("string")),
                F.concat(F.lit("t"), (F.col("doc_id") + 1).cast("string"))).alias("related_topics"))
    catalog = v.t.labels.select(F.concat(F.lit("t"), F.col("doc_id").cast("string")).alias("name"))
    known, unknown = C.check_topics(docs, catalog, id_col="doc_id")
    return (known.select("doc_id", "topic", F.lit(True).alias("known"))
            .unionByName(unknown.select("doc_id", "topic", F.lit(False).alias("known"))))


@query("nested_counts", "AGG-2", views=("v4",), sql="""
SELECT id, CAST(coalesce(CASE WHEN json_valid(text) THEN CASE WHEN json_type(text) = 'OBJECT'
                     AND NOT regexp_matches(text, ',\\s*[}\\]]') THEN json_array_length(json_keys(text)) END END, 0)
                AS INTEGER) AS keys_count,
       CAST(len(string_split(text, chr(10))) AS INTEGER) AS lines_count
FROM v4
""")
def nested_counts_q(v):
    """Sizes of nested collections per record, 0 when absent (map of a response, its lines)."""
    from tessera.functions.jsontext import is_json_object

    df = v.v4.select("id",
                     F.when(is_json_object("text"), F.from_json("text", "map<string,string>")).alias("keys"),
                     F.split("text", "\n", -1).alias("lines"))
    return C.nested_counts(df, arrays=["lines"], maps=["keys"]).select("id", "keys_count", "lines_count")


@query("json_members", "SRC-7 SCL-15", sql="""
WITH t AS (SELECT event_id AS id, CASE event_id % 6
    WHEN 0 THEN props WHEN 1 THEN '[' || props || ',' || user_id || ',"x"]' WHEN 2 THEN user_id::VARCHAR
    WHEN 3 THEN 'sorry: ' || props WHEN 4 THEN '{"a":' || props || ',"b":[true,null],"c":null}' END AS text FROM events),
j AS (SELECT id, CASE WHEN json_valid(text) THEN text::JSON END AS v FROM t),
k AS (SELECT id, v, CASE json_type(v) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array' WHEN 'VARCHAR' THEN 'string'
    WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE CASE WHEN v IS NULL THEN 'bad' ELSE 'number' END END AS shape FROM j),
o AS (SELECT id, shape, unnest(json_keys(v)) AS name, generate_subscripts(json_keys(v), 1) - 1 AS pos, v FROM k WHERE shape = 'object'),
a AS (SELECT id, shape, NULL AS name, unnest(range(json_array_length(v)::BIGINT)) AS pos, v FROM k WHERE shape = 'array'),
m AS (SELECT id, shape, pos, name, json_extract(v, '$."' || name || '"') AS x FROM o
      UNION ALL SELECT id, shape, pos, name, json_extract(v, '$[' || pos || ']') FROM a)
SELECT id, shape, pos::INTEGER AS pos, name, CASE json_type(x) WHEN 'OBJECT' THEN 'object' WHEN 'ARRAY' THEN 'array'
    WHEN 'VARCHAR' THEN 'string' WHEN 'BOOLEAN' THEN 'boolean' WHEN 'NULL' THEN 'null' ELSE 'number' END AS kind, replace(x::VARCHAR, ' ', '') AS value FROM m
UNION ALL SELECT id, shape, NULL, NULL, NULL, NULL FROM k WHERE shape NOT IN ('object', 'array')
""")
def json_members(v):
    """Members of JSON texts of mixed shapes (objects, arrays, scalars, no JSON at all), read as VARIANT."""
    e, p, u = v.t.events, F.col("props"), F.col("user_id").cast("string")
    kind = F.col("event_id") % 6
    text = (F.when(kind == 0, p).when(kind == 1, F.concat(F.lit("["), p, F.lit(","), u, F.lit(',"x"]')))
            .when(kind == 2, u).when(kind == 3, F.concat(F.lit("sorry: "), p))
            .when(kind == 4, F.concat(F.lit('{"a":'), p, F.lit(',"b":[true,null],"c":null}'))))
    return explode_json(e.select(F.col("event_id").alias("id"), text.alias("text")), "text", ("id",))
