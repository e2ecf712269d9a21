"""Ordered columns split by ranges equal key-partitioned windows, also when one key holds
most of the rows, its values exceed 2^53, or keys, orders and values are NULL."""

from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tessera.operators.sequence import number_rows, running_max, running_sum, with_previous


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def hot_log(spark, n=20000):
    o = F.col("id")
    return spark.range(n).select(
        F.when(o % 10 < 7, F.lit("hot")).when(o % 50 == 8, F.lit(None)).otherwise((o % 97).cast("string")).alias("k"),
        o.alias("o"), F.when(o % 11 != 0, (o * 7919) % 1000 + (1 << 60)).alias("v"))


def test_hot_key_equals_window(spark):
    df = hot_log(spark)
    span = F.floor(F.col("o") / 777)
    got = with_previous(df, ["k"], ["o"], ["v"], first="first", ranges=span)
    w = W.partitionBy("k").orderBy("o")
    exp = df.withColumn("prev_v", F.lag("v").over(w)).withColumn("first", F.row_number().over(w) == 1)
    assert rows(got, "k", "o", "prev_v", "first") == rows(exp, "k", "o", "prev_v", "first")
    got = number_rows(df, ["o"], ["k"], name="n", ranges=span)
    assert rows(got, "k", "o", "n") == rows(df.withColumn("n", F.row_number().over(w).cast("bigint")), "k", "o", "n")
    small = df.withColumn("v", F.col("v") % 1000)
    got = running_sum(small, ["k"], ["o"], "v", "s", ranges=span)
    exp = small.withColumn("s", F.sum("v").over(w.rowsBetween(W.unboundedPreceding, 0)))
    assert rows(got, "k", "o", "s") == rows(exp, "k", "o", "s")


def test_no_python_and_no_job_while_building(spark):
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    plan = number_rows(hot_log(spark), ["o"], ["k"])._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before


def test_big_keys_stay_apart(spark):
    base = 1 << 60
    df = spark.createDataFrame([(base, 1), (base + 1, 2), (base + 2, 3)], "k long, o long")
    assert [r.row_number for r in number_rows(df, ["o"], ["k"]).collect()] == [1, 1, 1]


def test_global_order(spark):
    df = spark.range(5000).select(F.col("id").alias("o"), ((F.col("id") * 37) % 1001).alias("v"))
    got = running_max(df, [], ["o"], "v", "mx", ranges=F.floor(F.col("o") / 400))
    exp = df.withColumn("mx", F.max("v").over(W.orderBy("o").rowsBetween(W.unboundedPreceding, 0)))
    assert rows(got, "o", "mx") == rows(exp, "o", "mx")
    days = df.select(F.make_date(F.lit(2024), (F.col("o") % 12 + 1).cast("int"), F.lit(3)).alias("d"), "o")
    got = number_rows(days, ["d", "o"], name="n")
    exp = days.withColumn("n", F.row_number().over(W.orderBy("d", "o")).cast("bigint"))
    assert rows(got, "d", "o", "n") == rows(exp, "d", "o", "n")
    text = df.select(F.hex("o").alias("t"))
    got = number_rows(text, ["t"], name="n")
    assert rows(got, "t", "n") == rows(text.withColumn("n", F.row_number().over(W.orderBy("t")).cast("bigint")), "t", "n")


def test_null_status_is_a_status(spark):
    from tessera.operators.log import status_transitions

    df = spark.createDataFrame([("a", 1, "RAW"), ("a", 2, None), ("a", 3, None), ("a", 4, "RAW"), ("a", 5, "RAW")],
                               "key string, offset long, status string")
    assert sorted(r.offset for r in status_transitions(df).collect()) == [1, 2, 4]


def test_undated_records(spark):
    import datetime

    from tessera.operators.log import apply_retention, compact_with_lag

    t = datetime.datetime(2024, 1, 1)
    df = spark.createDataFrame([("a", 1, t), ("b", 1, t), ("b", 2, None), ("c", 1, None)],
                               "key string, offset long, ts timestamp").withColumn("value", F.lit("x"))
    got = sorted((r.key, r.offset) for r in compact_with_lag(df).collect())
    assert got == [("a", 1), ("b", 1), ("b", 2), ("c", 1)]
    old = compact_with_lag(df, as_of="2024-02-01")
    assert sorted((r.key, r.offset) for r in old.collect()) == [("a", 1), ("b", 2), ("c", 1)]
    kept = apply_retention(df.withColumn("topic", F.lit("t")), as_of="2024-02-01")
    assert sorted((r.key, r.offset) for r in kept.collect()) == [("b", 2), ("c", 1)]


def test_interval_join_left_with_nulls(spark):
    import datetime

    from tessera.operators.intervals import interval_join

    t = datetime.datetime(2024, 1, 1)
    left = spark.createDataFrame([("k", t, None), ("z", t, None)], "key string, l_ts timestamp, note string")
    right = spark.createDataFrame([("k", t)], "key string, r_ts timestamp")
    out = interval_join(left, right, "key", "l_ts", "r_ts", 0, 60, how="left").collect()
    assert sorted((r.key, r.r_ts is None) for r in out) == [("k", False), ("z", True)]


def test_one_action_per_item(spark):
    from tessera.operators.review import apply_actions

    items = spark.createDataFrame([("i", "RAW")], "id string, status string")
    acts = spark.createDataFrame([("i", "r", 1), ("i", "a", 2)], "id string, action string, offset long")
    assert [r.new_status for r in apply_actions(items, acts, "idea").collect()] == ["APPROVED"]


def test_consumer_lag_without_positions_equals_numbered(spark):
    """AGG-8 from group marks and bucket counts equals the lag from row numbers, with a
    partition holding 70 % of the log and a group that stopped right after the start
    (offsets are unique inside a partition, as in a Kafka log)."""
    from tessera.operators.usage import consumer_lag, consumer_lag_positioned, positions

    n = 12000
    o = F.col("id")
    log = spark.range(n).select(
        F.when(o % 10 < 7, F.lit("hot")).otherwise(F.concat(F.lit("t"), (o % 3).cast("string"))).alias("topic"),
        (o % 4).cast("int").alias("partition"),
        (o * 2).alias("offset"),
        F.concat(F.lit("g"), ((o * 7919) % 5).cast("string")).alias("group"))
    early = log.groupBy("topic", "partition").agg((F.min("offset") + 1).alias("offset")) \
               .withColumn("group", F.lit("g_early"))
    log = log.unionByName(early)
    got = sorted(tuple(r) for r in consumer_lag(log, span=500).collect())
    exp = sorted(tuple(r) for r in consumer_lag_positioned(positions(log)).collect())
    assert got == exp and len(got) > 10


def test_sessions_hot_key_equals_window(spark):
    """STM-3 twin equals the window-function
    definition when one user holds 70 % of the events and spans many partitions."""
    from tessera.streaming.batch import sessions

    n = 20000
    o = F.col("id")
    df = spark.range(n).select(
        F.when(o % 10 < 7, F.lit("hot")).otherwise((o % 53).cast("string")).alias("key"),
        o.alias("offset"),
        (F.lit("2024-01-01").cast("timestamp")
         + F.make_dt_interval(secs=((o * 7919) % 200000).cast("decimal(18,6)") * 60)).alias("ts"))
    got = sessions(df, "key", "ts", "offset", 1800)
    w = W.partitionBy("key").orderBy("ts", "offset")
    gap = F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(w))
    flagged = df.withColumn("_new", F.when(gap.isNull() | (gap >= 1800 * 10 ** 6), 1).otherwise(0))
    numbered = flagged.withColumn("session_no", F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    exp = numbered.groupBy("key", "session_no").agg(
        F.min("ts").alias("session_start"),
        (F.max("ts") + F.expr("INTERVAL 30 MINUTES")).alias("session_end"),
        F.count(F.lit(1)).alias("events"))
    cols = ["key", "session_no", "session_start", "session_end", "events"]
    g = sorted(tuple(r) for r in got.select(*cols).collect())
    e = sorted(tuple(r) for r in exp.select(*cols).collect())
    assert g == e and len(g) > 100


def test_sampled_ranges_of_one_prefix(spark, all_ranges):
    """Keys that share their first characters, one of them with a third of the rows, are dealt to ranges alike."""
    from tessera.operators.catalog import catalog_topics
    from tessera.operators.sequence import number_sampled, sampled_ranges

    n = 12000
    df = spark.range(n, numPartitions=4).select(F.when(F.col("id") % 3 == 0, F.lit("user-0000500")).otherwise(
        F.concat(F.lit("user-"), F.lpad(F.col("id").cast("string"), 7, "0"))).alias("key"), F.lit("v").alias("value"))
    sizes = [r["count"] for r in sampled_ranges(df, ["key"]).groupBy("_seq_range").count().collect()]
    assert len(sizes) >= 4 and max(sizes) <= 2 * n / len(sizes)
    got = [(r.key, r.no) for r in number_sampled(df, "key", name="no").orderBy("no").collect()]
    assert [no for _, no in got] == list(range(1, n + 1)) and [k for k, _ in got] == sorted(k for k, _ in got)
    names = spark.range(900).select(F.format_string("doc_%05d", F.col("id")).alias("name"))
    assert {r.name: r.schema_id for r in catalog_topics(names).collect()} == {
        f"doc_{i:05d}": 100001 + i for i in range(900)}


def test_sampled_numbers_inside_keys(spark):
    from tessera.operators.sequence import number_sampled

    df = spark.range(5000).select(F.when(F.col("id") % 10 < 7, F.lit("hot")).when(F.col("id") % 10 < 9, F.lit(None))
                                  .otherwise((F.col("id") % 41).cast("string")).alias("k"), (F.col("id") * 7919 % 5000).alias("o"))
    w = W.partitionBy("k").orderBy("o")
    exp = df.withColumn("n", F.row_number().over(w).cast("bigint")).withColumn("of", F.count("*").over(W.partitionBy("k")))
    got = number_sampled(df, "o", "k", name="n", total="of")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, exp.collect()), key=repr)
    assert number_sampled(df.limit(0), "o", "k").collect() == []
