"""Platform snapshot: three state rows side by side with defaults (JN-5, PRJ-8, AGG-16).

State rows are small (one per cluster key).  Each side is read as a scalar subquery of its
newest row, so a missing side yields defaults instead of dropping the snapshot, and no
join is planned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schemas import CLUSTER_KEY

# --- fixed values: snapshot defaults ---
NO_SYNTHESIS = "No synthesis available"
SYNTHESIS_FAILED = "Automated synthesis unavailable. Platform has basic deployment state."
UNKNOWN_CLUSTER = "unknown"

DEPLOYMENT_COLS = ["timestamp", "cluster_id", "total_topics", "total_schemas", "total_connectors",
                   "domain_count"]
USAGE_COLS = ["timestamp", "consumer_groups", "active_consumers", "idle_topic_count"]
METRICS_COLS = ["timestamp", "total_throughput_mbps", "avg_latency_ms", "error_rate",
                "topics_with_lag_count"]


def deployment_summary_from_record(dep: DataFrame) -> DataFrame:
    """DeploymentState record rows → summary counts (AGG-2: absent arrays count 0)."""
    return dep.select(
        F.lit(CLUSTER_KEY).alias("_k"), "timestamp", "cluster_id",
        F.coalesce(F.size("topics"), F.lit(0)).alias("total_topics"),
        F.coalesce(F.size("schemas"), F.lit(0)).alias("total_schemas"),
        F.coalesce(F.size("connectors"), F.lit(0)).alias("total_connectors"),
        F.coalesce(F.size(F.map_keys("domains")), F.lit(0)).alias("domain_count"))


def usage_summary_from_record(usage: DataFrame) -> DataFrame:
    return usage.select(
        F.lit(CLUSTER_KEY).alias("_k"), "timestamp", "consumer_groups", "active_consumers",
        F.coalesce(F.size("idle_topics"), F.lit(0)).alias("idle_topic_count"))


def metrics_summary_from_record(metrics: DataFrame) -> DataFrame:
    return metrics.select(
        F.lit(CLUSTER_KEY).alias("_k"), "timestamp", "total_throughput_mbps", "avg_latency_ms",
        "error_rate", F.coalesce(F.size("topics_with_lag"), F.lit(0)).alias("topics_with_lag_count"))


def _empty(spark: SparkSession, ddl: str) -> DataFrame:
    return spark.createDataFrame([], "_k STRING, " + ddl)


def build_snapshot(spark: SparkSession, deployment: DataFrame | None, usage: DataFrame | None,
                   metrics: DataFrame | None, synthesis: DataFrame | None = None,
                   now: Column | None = None) -> DataFrame:
    """PRJ-8 over JN-5: one CurrentState row.

    Inputs are summary rows (see ``*_summary_from_record``); any may
    be ``None``/empty.  Missing values take the record defaults: cluster 'unknown',
    counts 0, rates 0.0, timestamps = ``now``, summary 'No synthesis available'.
    """
    now = now if now is not None else F.date_format(F.current_timestamp(),
                                                     "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    dep = deployment if deployment is not None else _empty(
        spark, "timestamp STRING, cluster_id STRING, total_topics INT, total_schemas INT, "
               "total_connectors INT, domain_count INT")
    use = usage if usage is not None else _empty(
        spark, "timestamp STRING, consumer_groups INT, active_consumers INT, idle_topic_count INT")
    met = metrics if metrics is not None else _empty(
        spark, "timestamp STRING, total_throughput_mbps DOUBLE, avg_latency_ms DOUBLE, "
               "error_rate DOUBLE, topics_with_lag_count INT")
    syn = synthesis if synthesis is not None else _empty(
        spark, "summary STRING, observations ARRAY<STRING>")
    def newest(df: DataFrame, cols: list[str]) -> Column:
        # the newest row of a state input as one struct (NULL when the input is empty);
        # a scalar subquery, so the snapshot plans no join at all
        order = F.coalesce(F.col("timestamp"), F.lit("")) if "timestamp" in df.columns else F.lit(0)
        return df.agg(F.max_by(F.struct(*[F.col(c) for c in cols]), order)).scalar()

    # each subquery is referenced once, in a one-row base; fields are read from its columns
    base = spark.range(1).select(
        newest(dep, DEPLOYMENT_COLS).alias("_d"), newest(use, USAGE_COLS).alias("_u"),
        newest(met, METRICS_COLS).alias("_m"), newest(syn, ["summary", "observations"]).alias("_s"))
    return assemble_snapshot(spark, F.col("_d"), F.col("_u"), F.col("_m"), F.col("_s"), now,
                             base=base)


def assemble_snapshot(spark: SparkSession, d: Column, u: Column, m: Column,
                      sy: Column | None = None, now: Column | None = None,
                      base: DataFrame | None = None) -> DataFrame:
    """JN-5 + PRJ-8 over struct columns (deployment / usage / metrics / synthesis), each
    NULL when absent: one CurrentState row with every default applied.

    The structs are evaluated over ``base`` (a one-row DataFrame, ``range(1)`` when not
    given).  When they come from scalar subqueries, reference each subquery once as a
    column of ``base`` and pass column references here: every field access on a
    subquery expression would otherwise copy the whole subquery into the plan."""
    now = now if now is not None else F.date_format(F.current_timestamp(),
                                                     "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    none = F.lit(None)
    sy = sy if sy is not None else F.struct(none.cast("string").alias("summary"),
                                            none.cast("array<string>").alias("observations"))
    j = (base if base is not None else spark.range(1)).select(
        *[d[c].alias("d_" + c) for c in DEPLOYMENT_COLS],
        *[u[c].alias("u_" + c) for c in USAGE_COLS],
        *[m[c].alias("m_" + c) for c in METRICS_COLS],
        sy["summary"].alias("s_summary"), sy["observations"].alias("s_observations"))
    z = F.lit(0)
    return j.select(
        now.alias("timestamp"),
        F.struct(F.coalesce("d_timestamp", now).alias("timestamp"),
                 F.coalesce("d_cluster_id", F.lit(UNKNOWN_CLUSTER)).alias("cluster_id"),
                 F.coalesce("d_total_topics", z).cast("int").alias("total_topics"),
                 F.coalesce("d_total_schemas", z).cast("int").alias("total_schemas"),
                 F.coalesce("d_total_connectors", z).cast("int").alias("total_connectors"),
                 F.coalesce("d_domain_count", z).cast("int").alias("domain_count")).alias("deployment"),
        F.struct(F.coalesce("u_timestamp", now).alias("timestamp"),
                 F.coalesce("u_consumer_groups", z).cast("int").alias("consumer_groups"),
                 F.coalesce("u_active_consumers", z).cast("int").alias("active_consumers"),
                 F.coalesce("u_idle_topic_count", z).cast("int").alias("idle_topic_count")).alias("usage"),
        F.struct(F.coalesce("m_timestamp", now).alias("timestamp"),
                 F.coalesce("m_total_throughput_mbps", F.lit(0.0)).alias("total_throughput_mbps"),
                 F.coalesce("m_avg_latency_ms", F.lit(0.0)).alias("avg_latency_ms"),
                 F.coalesce("m_error_rate", F.lit(0.0)).alias("error_rate"),
                 F.coalesce("m_topics_with_lag_count", z).cast("int").alias("topics_with_lag_count")
                 ).alias("metrics"),
        F.coalesce("s_summary", F.lit(NO_SYNTHESIS)).alias("summary"),
        F.coalesce("s_observations", F.array().cast("array<string>")).alias("notable_observations"))


def flatten_snapshot(snap: DataFrame) -> DataFrame:
    """The CurrentState row as flat columns (for reports and oracle comparison)."""
    return snap.select(
        F.col("deployment.cluster_id").alias("cluster_id"),
        F.col("deployment.total_topics").alias("total_topics"),
        F.col("deployment.total_schemas").alias("total_schemas"),
        F.col("deployment.total_connectors").alias("total_connectors"),
        F.col("deployment.domain_count").alias("domain_count"),
        F.col("usage.consumer_groups").alias("consumer_groups"),
        F.col("usage.active_consumers").alias("active_consumers"),
        F.col("usage.idle_topic_count").alias("idle_topic_count"),
        F.col("metrics.total_throughput_mbps").alias("total_throughput_mbps"),
        F.col("metrics.avg_latency_ms").alias("avg_latency_ms"),
        F.col("metrics.error_rate").alias("error_rate"),
        F.col("metrics.topics_with_lag_count").alias("topics_with_lag_count"),
        F.col("summary"), F.size("notable_observations").alias("observation_count"))
