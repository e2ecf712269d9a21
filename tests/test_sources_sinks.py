"""Readers and writers: JSON document folders, absent inputs, log round trip, keyed overwrite."""

import json
import os

from pyspark.sql import functions as F

from tessera import sinks
from tessera.schemas import RAW_IDEA, record_type
from tessera.sources import decode_value, read_json_docs, read_log, read_or_empty


def test_json_docs_and_empty(spark, tmp_dir):
    for i in range(3):
        with open(os.path.join(tmp_dir, f"scope_{i}.json"), "w") as f:
            json.dump({"idea_id": f"i{i}", "title": f"T{i}", "status": "APPROVED",
                       "related_topics": ["a"], "confidence_score": 0.5}, f, indent=2)
    df = read_json_docs(spark, f"{tmp_dir}/scope_*.json", RAW_IDEA)
    assert sorted(r.idea_id for r in df.collect()) == ["i0", "i1", "i2"]
    assert df.filter(F.col("_file").endswith("scope_1.json")).first().title == "T1"
    empty = read_or_empty(spark, f"{tmp_dir}/missing", RAW_IDEA)
    assert empty.count() == 0 and empty.schema == record_type("raw-ideas")


def test_publish_read_roundtrip(spark, tmp_dir):
    ideas = spark.createDataFrame([("i1", "A", "RAW"), ("i2", "B", "RAW")], "idea_id string, title string, status string")
    sinks.publish(ideas, "ideas", "idea_id", f"{tmp_dir}/log")
    sinks.publish(ideas.withColumn("status", F.lit("APPROVED")).filter("idea_id = 'i1'"), "ideas", "idea_id", f"{tmp_dir}/log")
    log = read_log(spark, f"{tmp_dir}/log", topics=["ideas"])
    assert log.count() == 3
    dec = decode_value(log, "idea_id string, title string, status string")
    from tessera.operators.log import latest_per_key

    cur = latest_per_key(dec, "idea_id", value="status")
    assert {r.idea_id: r.status for r in cur.collect()} == {"i1": "APPROVED", "i2": "RAW"}
    assert sorted(r.offset for r in log.collect()) == [0, 1, 2] and "partition" in log.columns


def test_keyed_json_overwrite(spark, tmp_dir):
    v1 = spark.createDataFrame([("a", 1, "x"), ("b", 1, "y")], "id string, version int, body string")
    p1 = sinks.write_json_docs(spark, v1, tmp_dir, None, "id", "version")
    v2 = spark.createDataFrame([("a", 2, "x2")], "id string, version int, body string")
    p2 = sinks.write_json_docs(spark, v2, tmp_dir, p1, "id", "version")
    got = {r.id: r.body for r in spark.read.json(p2).collect()}
    assert got == {"a": "x2", "b": "y"} and p1 != p2


def test_read_topics_aligns_columns(spark, tmp_dir):
    from tessera.sources import read_topics

    spark.createDataFrame([("k1", 1)], "key string, a int").write.parquet(f"{tmp_dir}/t1")
    spark.createDataFrame([("k2", "x")], "key string, b string").write.parquet(f"{tmp_dir}/t2")
    df = read_topics(spark, {"clicks": f"{tmp_dir}/t1", "views": f"{tmp_dir}/t2"})
    rows = {r.topic: (r.key, r.a, r.b) for r in df.collect()}
    assert rows == {"clicks": ("k1", 1, None), "views": ("k2", None, "x")}


def test_published_log_is_foldered_by_date_and_retention_prunes(spark, tmp_dir):
    """SNK-1 writes topic=/date= folders; WIN-6 on such a log keeps exactly the rows within
    retention and bounds the scan's date partitions (expired folders are not read)."""
    from tessera.operators.log import apply_retention

    df = spark.range(50).select(F.col("id").cast("string").alias("k"), F.col("id").alias("v"))
    sinks.publish(df, "t", "k", f"{tmp_dir}/log")
    old = (spark.read.parquet(f"{tmp_dir}/log")
           .withColumn("ts", F.col("ts") - F.expr("INTERVAL 30 DAYS"))
           .withColumn("date", F.to_date("ts")))
    old.write.mode("append").partitionBy("topic", "date").parquet(f"{tmp_dir}/log")
    log = read_log(spark, f"{tmp_dir}/log", topics=["t"])
    assert log.select("date").distinct().count() == 2
    kept = apply_retention(log, date="date")
    assert kept.count() == 50
    assert apply_retention(log, date="date", overrides={"t": -1}).count() == 100
    assert apply_retention(log, 60 * 86_400_000, date="date").count() == 100
    import re

    jvm = spark.sparkContext._jvm
    text = jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        kept._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[[^\n]*date#\d+ >= date_sub", text)


def test_compaction_on_date_foldered_log_reads_recent_folders(spark, tmp_dir):
    """WIN-7 with ``date``: same rows as without it, and the young part's scan is bounded
    to recent date folders."""
    import re

    from tessera.operators.log import compact_with_lag

    df = spark.range(40).select((F.col("id") % 10).cast("string").alias("k"), F.col("id").alias("v"))
    sinks.publish(df, "t", "k", f"{tmp_dir}/log")
    old = (spark.read.parquet(f"{tmp_dir}/log")
           .withColumn("ts", F.col("ts") - F.expr("INTERVAL 10 DAYS"))
           .withColumn("date", F.to_date("ts")))
    old.write.mode("append").partitionBy("topic", "date").parquet(f"{tmp_dir}/log")
    log = decode_value(read_log(spark, f"{tmp_dir}/log", topics=["t"]), "k string, v bigint") \
        .withColumn("ord", F.struct("ts", "offset"))
    a = compact_with_lag(log, key="key", order="ord", value="v", lag_ms=86_400_000, date="date")
    b = compact_with_lag(log, key="key", order="ord", value="v", lag_ms=86_400_000)
    cols = ["key", "ts", "offset"]
    got = sorted(tuple(r) for r in a.select(*cols).collect())
    assert got == sorted(tuple(r) for r in b.select(*cols).collect()) and len(got) == 40
    text = spark.sparkContext._jvm.org.apache.spark.sql.api.python.PythonSQLUtils.explainString(
        a._jdf.queryExecution(), "formatted")
    assert re.search(r"PartitionFilters: \[[^\n]*date#\d+ >= date_sub", text)


def test_json_documents_of_bounded_size(spark, tmp_dir):
    """No document holds more records than asked for, and the index tells where a key stands."""
    df = spark.range(1050).select(F.format_string("k%04d", F.col("id")).alias("key"), F.col("id").alias("n"),
                                  F.when(F.col("id") < 1000, F.lit("hot")).otherwise(F.lit("cold")).alias("status"))
    index = sinks.write_json_parts(df, f"{tmp_dir}/docs", ["key"], by=["status"], per_document=64).collect()
    assert max(r.records for r in index) <= 64 and sum(r.records for r in index) == 1050
    assert len([r for r in index if r.status == "hot"]) == 16
    docs = read_json_docs(spark, f"{tmp_dir}/docs/*/*.txt", "key STRING, n BIGINT, status STRING")
    assert docs.count() == 1050
    where = {r.key: r._file for r in docs.collect()}
    for r in index:
        assert where[r["first"]] == where[r["last"]] == r._file


def test_publish_spreads_a_common_prefix(spark, tmp_dir, all_ranges):
    df = spark.range(4000, numPartitions=4).select(F.format_string("user-%06d", F.col("id")).alias("k"), F.col("id").alias("v"))
    sinks.publish(df, "t", "k", f"{tmp_dir}/log")
    files = read_log(spark, f"{tmp_dir}/log", ["t"]).groupBy(F.input_file_name()).count().collect()
    assert len(files) >= 4 and max(r["count"] for r in files) <= 2 * 4000 / len(files)
    assert sorted(r.offset for r in read_log(spark, f"{tmp_dir}/log").collect()) == list(range(4000))


def test_offsets_bound_the_scan(spark, tmp_dir):
    from tessera.sources.log import end_offsets, offsets_json

    rows = [(t, p, o) for t in ("a", "b") for p in (0, 1) for o in range(10 * (p + 1))]
    df = spark.createDataFrame(rows, "topic string, partition int, offset long")
    df.write.partitionBy("topic").parquet(f"{tmp_dir}/log")
    ends = end_offsets(read_log(spark, f"{tmp_dir}/log"))
    assert ends == {"a": {0: 10, 1: 20}, "b": {0: 10, 1: 20}}
    cut = read_log(spark, f"{tmp_dir}/log", starting={"a": {0: 7}}, ending={"a": {0: 9, 1: 2}, "b": {0: 0}})
    got = sorted(tuple(r) for r in cut.select("topic", "partition", "offset").collect())
    assert got == [("a", 0, 7), ("a", 0, 8), ("a", 1, 0), ("a", 1, 1)] + [("b", 1, o) for o in range(20)]
    assert read_log(spark, f"{tmp_dir}/log", starting=ends).count() == 0
    one = read_log(spark, f"{tmp_dir}/log", topics=["a"], starting={"a": {0: 7, 1: 18}})
    plan = one._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(offset,7)" in plan and "PartitionFilters: [" in plan
    assert offsets_json({"a": {0: 7}}, "earliest") == '{"a": {"0": 7}}' and offsets_json(None, "latest") == "latest"


def test_json_of_any_shape(spark):
    from tessera.sources.listing import explode_json

    texts = ['{"a": 1, "b": [2], "c": null}', "[true, \"x\", 1.5, {}]", "7", '"s"', "null", "{oops", None, "{}", "[]"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    got = sorted((tuple(r) for r in explode_json(df, "text", ("id",)).collect()), key=repr)
    assert got == sorted([
        (0, "object", 0, "a", "number", "1"), (0, "object", 1, "b", "array", "[2]"), (0, "object", 2, "c", "null", "null"),
        (1, "array", 0, None, "boolean", "true"), (1, "array", 1, None, "string", '"x"'), (1, "array", 2, None, "number", "1.5"),
        (1, "array", 3, None, "object", "{}"), (2, "number", None, None, None, None), (3, "string", None, None, None, None),
        (4, "null", None, None, None, None), (5, "bad", None, None, None, None), (6, "bad", None, None, None, None),
        (7, "object", None, None, None, None), (8, "array", None, None, None, None)], key=repr)
