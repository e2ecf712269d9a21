"""Catalog, usage and health rows and the snapshot built from them."""

import pytest
from pyspark.sql import functions as F

from tessera.operators import catalog as C
from tessera.operators import snapshot as S
from tessera.sources.listing import parse_registry

# invented names; 12 domains of these sizes make 37 topics
SIZES = [3, 3, 3, 5, 1, 7, 3, 3, 4, 1, 1, 3]
CATALOG = {f"zone{i}": [f"zone{i}_feed{j}" for j in range(n)] for i, n in enumerate(SIZES)}
LAG = [(f"zone{i}_feed0", f"reader-{i}", 10 * i + 1) for i in range(6)]
USAGE = [(f"zone{i}_feed0", i + 1, 100.0 * i) for i in range(6)]
IDLE = ["zone2_feed1", "zone4_feed0", "zone10_feed0"]


@pytest.fixture(scope="module")
def registry(spark):
    import json

    rows = []
    for ns, topics in CATALOG.items():
        for t in topics:
            rows.append((json.dumps({f"{t}-value": [{"version": 1, "id": 0,
                                                      "schema": json.dumps({"namespace": ns})}]}),))
    return spark.createDataFrame(rows, "listing string")


def test_catalog_counts(spark, registry):
    schemas = parse_registry(registry, "listing")
    d = {r.domain: r.topic_count for r in C.domains(schemas).collect()}
    assert len(d) == 12 and sorted(d.values()) == sorted(SIZES)
    topics = schemas.select(F.regexp_replace("subject", "-value$", "").alias("name"))
    cat = C.catalog_topics(topics)
    ids = sorted(r.schema_id for r in cat.collect())
    assert ids == list(range(100001, 100038))
    rec = C.deployment_record(cat, schemas, "lkc-1", "env-1", "2024-01-01T00:00:00").first()
    assert (len(rec.topics), len(rec.schemas), len(rec.connectors), len(rec.domains)) == (37, 37, 37, 12)


def test_snapshot_from_constants(spark, registry):
    schemas = parse_registry(registry, "listing")
    cat = C.catalog_topics(schemas.select(F.regexp_replace("subject", "-value$", "").alias("name")))
    dep = S.deployment_summary_from_record(C.deployment_record(cat, schemas, "lkc-1", "e", "t0"))
    usage = spark.createDataFrame(
        [("t0", 7, sum(u[1] for u in USAGE), [], IDLE)],
        "timestamp string, consumer_groups int, active_consumers int, "
        "top_topics_by_consumption array<struct<topic_name:string,consumer_count:int,messages_per_second:double>>, "
        "idle_topics array<string>")
    metrics = spark.createDataFrame(
        [("t0", 12.5, 40.0, [dict(topic_name=a, consumer_group=b, lag_messages=c) for a, b, c in LAG], 0.01, 300.0)],
        "timestamp string, total_throughput_mbps double, avg_latency_ms double, "
        "topics_with_lag array<struct<topic_name:string,consumer_group:string,lag_messages:bigint>>, "
        "error_rate double, storage_used_gb double")
    snap = S.build_snapshot(spark, dep, S.usage_summary_from_record(usage),
                            S.metrics_summary_from_record(metrics)).first()
    assert (snap.deployment.total_topics, snap.deployment.total_schemas, snap.deployment.total_connectors,
            snap.deployment.domain_count) == (37, 37, 37, 12)
    assert (snap.usage.consumer_groups, snap.usage.active_consumers, snap.usage.idle_topic_count) == (7, 21, 3)
    assert (snap.metrics.total_throughput_mbps, snap.metrics.avg_latency_ms, snap.metrics.error_rate,
            snap.metrics.topics_with_lag_count) == (12.5, 40.0, 0.01, 6)


def test_snapshot_all_absent(spark):
    snap = S.build_snapshot(spark, None, None, None).first()
    assert snap.deployment.cluster_id == "unknown" and snap.deployment.total_topics == 0
    assert snap.metrics.total_throughput_mbps == 0.0 and snap.summary == "No synthesis available"
    assert snap.notable_observations == []
    assert snap.deployment.timestamp == snap.usage.timestamp == snap.timestamp


def test_registry_modes(spark):
    import json

    listing = json.dumps({"s-value": [{"version": 1, "schema": "{bad"}, {"version": 3, "id": 7}]})
    df = spark.createDataFrame([(listing,)], "listing string")
    first = parse_registry(df, "listing", mode="first").first()
    latest = parse_registry(df, "listing").first()
    assert (first.version, first.schema_id, first.namespace) == (1, 0, None)
    assert (latest.version, latest.schema_id) == (3, 7)
