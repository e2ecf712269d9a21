"""Catalog roll-ups: domains, topic rows, idle topics, related-topic checks (AGG-1/2/17, PRJ-11,
SET-3/4, JN-8).

Everything is an aggregation or a join; arrays are only built for catalog-sized
outputs (``domains_map``, ``deployment_record``), never for data-sized groups.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import domain_of, topic_of
from tessera.operators.sequence import number_rows
from tessera.schemas import DEFAULT_PARTITIONS, DEFAULT_REPLICATION, FIRST_SCHEMA_ID


def schema_topics(schemas: DataFrame, subject: str = "subject", namespace: str = "namespace",
                  strict: bool = False) -> DataFrame:
    """Each schema row with its topic (SCL-2) and domain (SCL-1)."""
    return schemas.withColumn("topic", topic_of(F.col(subject), strict)) \
                  .withColumn("domain", domain_of(F.col(namespace)))


def domain_topics(schemas: DataFrame, **kw) -> DataFrame:
    """SET-4: distinct (domain, topic) pairs; key and value subjects collapse to one topic."""
    return schema_topics(schemas, **kw).select("domain", "topic").distinct()


def domains(schemas: DataFrame, **kw) -> DataFrame:
    """AGG-1: per domain, the number of distinct topics and of schema subjects."""
    st = schema_topics(schemas, **kw)
    return st.groupBy("domain").agg(F.countDistinct("topic").alias("topic_count"),
                                    F.count(F.lit(1)).alias("subject_count"))


def domains_map(schemas: DataFrame, **kw) -> DataFrame:
    """AGG-1 as the DeploymentState ``domains`` map (one row).

    Builds arrays of topic names, so only for catalog-sized inputs (the set of
    topics of a cluster), never for data-sized ones.
    """
    pairs = domain_topics(schemas, **kw)
    per = pairs.groupBy("domain").agg(F.array_sort(F.collect_list("topic")).alias("topics"))
    entry = F.struct(F.col("domain"), F.struct(F.col("topics"),
                                               F.size("topics").alias("topic_count")))
    return per.agg(F.map_from_entries(F.collect_list(entry)).alias("domains"))


def nested_counts(df: DataFrame, arrays: list[str] = (), maps: list[str] = ()) -> DataFrame:
    """AGG-2: sizes of nested arrays/maps, 0 when absent."""
    cols = [F.coalesce(F.size(F.col(a)), F.lit(0)).alias(f"{a}_count") for a in arrays]
    cols += [F.coalesce(F.size(F.map_keys(F.col(m))), F.lit(0)).alias(f"{m}_count") for m in maps]
    return df.select("*", *cols)


def connector_name(topic: Column) -> Column:
    """The source connector feeding a topic: 'datagen-<topic>'."""
    return F.concat(F.lit("datagen-"), topic)


def catalog_topics(topics: DataFrame, name: str = "name") -> DataFrame:
    """PRJ-11: topic list → catalog rows in name order: partitions 6, replication 3,
    subject '<t>-value', schema ids from 100001 in order, connector 'datagen-<t>'.

    Ids come from sampled ranges of the names, so a common prefix does not put them into one task."""
    t = topics.select(F.col(name).alias("name")).distinct()
    n = number_rows(t, ["name"], name="_pos")
    return n.select(
        "name",
        F.lit(DEFAULT_PARTITIONS).alias("partitions"),
        F.lit(DEFAULT_REPLICATION).alias("replication_factor"),
        F.concat(F.col("name"), F.lit("-value")).alias("subject"),
        (F.col("_pos") + F.lit(FIRST_SCHEMA_ID - 1)).cast("int").alias("schema_id"),
        connector_name(F.col("name")).alias("connector"),
        F.lit("source").alias("connector_type"),
        F.lit("RUNNING").alias("connector_status"))


def deployment_record(catalog: DataFrame, schemas: DataFrame, cluster_id: str,
                      environment_id: str, timestamp: Column | str) -> DataFrame:
    """PRJ-11 assembled: one DeploymentState row (catalog-sized inputs only)."""
    ts = F.lit(timestamp) if isinstance(timestamp, str) else timestamp
    topics = catalog.agg(F.array_sort(F.collect_list(F.struct(
        "name", "partitions", "replication_factor")))).scalar()
    connectors = catalog.agg(F.array_sort(F.collect_list(F.struct(
        F.col("connector").alias("name"), F.col("connector_type").alias("type"),
        F.col("connector_status").alias("status"))))).scalar()
    sch = schemas.agg(F.array_sort(F.collect_list(F.struct(
        "subject", "version", "schema_id", "schema_type", "namespace")))).scalar()
    # one row; the other parts arrive as scalar subqueries (no join)
    return domains_map(schemas).select(
        ts.alias("timestamp"), F.lit(cluster_id).alias("cluster_id"),
        F.lit(environment_id).alias("environment_id"), topics.alias("topics"),
        sch.alias("schemas"), connectors.alias("connectors"), "domains")


def idle_topics(catalog: DataFrame, consumed: DataFrame, topic: str = "topic",
                consumed_topic: str | None = None) -> DataFrame:
    """SET-3: catalog topics with no active consumer (anti-join, no collect)."""
    ct = consumed_topic or topic
    c = consumed.select(F.col(ct).alias(topic)).distinct()
    return catalog.join(c, topic, "left_anti")


def check_topics(items: DataFrame, catalog: DataFrame, related: str = "related_topics",
                 id_col: str = "idea_id", topic: str = "name") -> tuple[DataFrame, DataFrame]:
    """JN-8: (known, unknown) related-topic references of each item."""
    refs = items.select(id_col, F.explode_outer(F.col(related)).alias("topic")) \
                .filter(F.col("topic").isNotNull())
    cat = catalog.select(F.col(topic).alias("topic")).distinct()
    return refs.join(cat, "topic", "left_semi"), refs.join(cat, "topic", "left_anti")
