"""Stateful stream operators: restarts, out-of-order arrival, deletes, late rows, chained stages."""

import datetime as dt

from pyspark.sql import functions as F

from tessera import streaming as S
from tessera.streaming import chain as CH
from tessera.streaming import state as ST

T0 = dt.datetime(2024, 1, 1)
LOG = "key string, offset long, status string, event_time timestamp"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def drain(spark, stream, out, mode="append"):
    with ST.rocksdb(spark):
        q = (stream.writeStream.format("parquet").option("path", out).outputMode(mode)
             .option("checkpointLocation", f"{out}/_checkpoint").trigger(availableNow=True).start())
        q.awaitTermination()
    return q


def arrive(spark, rows, src):
    spark.createDataFrame(rows, LOG).coalesce(1).write.mode("append").parquet(src)
    return spark.readStream.schema(LOG).parquet(src)


def test_deletes_survive_a_restart(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/table"
    seen = []
    for rows in ([("a", 1, "x", at(1)), ("b", 2, "y", at(2)), ("c", 3, "z", at(3)), ("b", 4, None, at(4))],
                 [("a", 6, None, at(6)), ("b", 5, "again", at(5)), ("c", 2, "older", at(4))],
                 [("a", 3, "late older", at(6)), ("d", 9, None, at(9)), ("e", 10, "w", at(10))],
                 [("a", 11, "back", at(400))]):
        changes = ST.current_changes(arrive(spark, rows, src), value="status")
        with ST.rocksdb(spark):
            S.materialise(changes, out, f"{out}/_checkpoint", mode="update").awaitTermination()
        seen.append({r.key: (r.offset, r.status) for r in S.read_live(spark, out).collect()})
    assert seen == [{"a": (1, "x"), "c": (3, "z")}, {"b": (5, "again"), "c": (3, "z")},
                    {"b": (5, "again"), "c": (3, "z"), "e": (10, "w")},
                    {"a": (11, "back"), "b": (5, "again"), "c": (3, "z"), "e": (10, "w")}]


def test_transitions_reorder_inside_the_watermark(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    for rows in ([("k", 1, "RAW", at(1)), ("k", 3, "DONE", at(30)), ("n", 1, None, at(1))],
                 [("k", 2, "RAW", at(20)), ("k", 5, "RAW", at(50)), ("n", 2, None, at(40)), ("n", 3, "RAW", at(45))],
                 [("k", 4, "DONE", at(40)), ("z", 0, None, at(10000))]):
        drain(spark, ST.transitions(arrive(spark, rows, src), delay="30 minutes"), out)
    got = sorted((r.key, r.offset, r.prev_status, r.status) for r in spark.read.parquet(out).collect())
    assert got == [("k", 1, None, "RAW"), ("k", 3, "RAW", "DONE"), ("k", 5, "DONE", "RAW"), ("n", 1, None, None), ("n", 3, None, "RAW")]


def test_late_rows_are_counted(spark, tmp_dir):
    src, out = f"{tmp_dir}/src", f"{tmp_dir}/out"
    total = {"arrived": 0, "on_time": 0, "dropped": 0}
    for rows in ([("a", 1, "x", at(0)), ("a", 2, "x", at(300))],
                 [("a", 3, "x", at(10)), ("a", 4, "x", at(250)), ("a", 4, "x", at(250)), ("a", 5, "x", at(239))],
                 [("a", 6, "x", at(300)), ("a", 7, "x", at(240))]):
        q = drain(spark, S.on_time(arrive(spark, rows, src), ["offset"], delay="1 hour"), out)
        total = {k: n + S.late_counts(q)[k] for k, n in total.items()}
    assert sorted(r.offset for r in spark.read.parquet(out).collect()) == [1, 2, 4, 6]
    assert total == {"arrived": 8, "on_time": 4, "dropped": 3}  # and one copy of 4


def test_chain_goes_on_where_it_stopped(spark, tmp_dir):
    schema = "id long, text string"
    stages = [CH.Stage("upper", lambda df: df.select("id", F.upper("text").alias("text"))),
              CH.Stage("kept", lambda df: df, F.col("text") != "NO"),
              CH.Stage("last", lambda df: df.select("id", F.length("text").alias("n")))]
    src, root = f"{tmp_dir}/src", f"{tmp_dir}/chain"
    assert [s.simpleString() if not isinstance(s, str) else s for s in CH.schemas(spark, schema, stages)][-1] == "struct<id:bigint,n:int>"
    for i, upto in enumerate(("upper", "kept", None, None)):
        spark.createDataFrame([(i, "no"), (10 + i, "yes" * (i + 1))], schema).write.mode("append").parquet(src)
        CH.run_chain(spark, src, schema, stages, root, upto)
        if i == 1:
            assert CH.read_stage(spark, root, "last", "id long, n int").count() == 0
    out = CH.read_stage(spark, root, "last", "id long, n int")
    assert sorted(map(tuple, out.collect())) == [(10, 3), (11, 6), (12, 9), (13, 12)]


def test_transitions_of_keys_that_share_a_group(spark, tmp_dir, monkeypatch):
    calls = f"{tmp_dir}/calls"
    kept = ST._Transitions.handleInputRows

    def counted(self, key, rows, timers):
        with open(calls, "a") as f:
            f.write(f"{key[0]}\n")
        return kept(self, key, rows, timers)

    monkeypatch.setattr(ST._Transitions, "handleInputRows", counted)
    big = 2**60
    log = "key long, offset long, status string, event_time timestamp"
    keys = [None, *(big + k for k in range(60))]
    parts = [[(k, big + o, s, at(o)) for k in keys for o, s in ((1, "a"), (4, "a"), (9, "b"))],
             [(k, big + o, s, at(o)) for k in keys for o, s in ((3, None), (2, "a"), (2, "a"))],
             [(-1, 0, None, at(10000))]]
    for rows in parts:
        spark.createDataFrame(rows, log).coalesce(1).write.mode("append").parquet(f"{tmp_dir}/src")
        stream = spark.readStream.schema(log).parquet(f"{tmp_dir}/src")
        drain(spark, ST.transitions(stream, delay="8 minutes", groups=4), f"{tmp_dir}/out")
    out = spark.read.parquet(f"{tmp_dir}/out")
    assert out.dtypes == [("key", "bigint"), ("offset", "bigint"), ("prev_status", "string"), ("status", "string")]
    got = {}
    for r in sorted(out.collect(), key=lambda r: r.offset):
        got.setdefault(r.key, []).append((r.offset - big, r.prev_status, r.status))
    assert got == {k: [(1, None, "a"), (3, "a", None), (4, None, "a"), (9, "a", "b")] for k in keys}
    assert len(open(calls).readlines()) <= 4 + 4 + 1  # a call for a group of keys, not for a key
