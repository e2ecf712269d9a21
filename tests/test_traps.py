"""SURVEY §2.13 traps not pinned elsewhere: T4, T10, T15, T16, T22."""

import pytest
from pyspark.sql import functions as F

from tessera.functions import jsontext as J
from tessera.operators import evaluate as E
from tessera.operators import log as L
from tessera.operators import records as R
from tessera.operators import review as RV


def test_t4_demo_mode_join_is_empty(spark):
    mk = lambda rows: spark.createDataFrame(rows, "idea_id string, offset bigint, challenge_id string")
    scope, time, cost = mk([("a", 0, "s"), ("b", 5, "s2")]), mk([("b", 1, "t"), ("a", 6, "t2")]), mk([("c", 2, "c")])
    firsts = [L.first_per_key(df.withColumn("topic", F.lit(n)), "topic", value=None).drop("topic")
              for n, df in (("s", scope), ("t", time), ("c", cost))]
    assert E.join_evaluations(*firsts).count() == 0            # one record per topic, three ideas
    assert E.join_evaluations(scope, time, cost).count() == 0    # 'c' has no scope/time either


def test_t10_character_class(spark):
    # a value ending in a letter of true/false/null, or a quote, gets the comma too
    df = spark.createDataFrame([('{"a": "x"\n "b": true\n "c": 1}',)], "t string")
    r = df.select(J.repair_kind(F.col("t")).alias("k"), J.repair_json(F.col("t")).alias("j")).first()
    assert r.k == "commas" and '"x",' in r.j and "true," in r.j


def test_t15_named_system_and_prompt(spark):
    df = spark.createDataFrame([("i1", "Title")], "idea_id string, title string")
    out = R.render_prompts(df, "Analyse %s", [F.col("title")], system="You are a reviewer").first()
    assert (out.system, out.prompt) == ("You are a reviewer", "Analyse Title")


def test_t16_write_failures_raise(spark, tmp_dir):
    from tessera import sinks

    df = spark.createDataFrame([("k", 1)], "key string, v int")
    sinks.publish(df, "t", "key", f"{tmp_dir}/log")
    with pytest.raises(Exception):
        sinks.publish(df, "t", "missing_column", f"{tmp_dir}/log")


def test_t22_edit_then_approve_counts_twice(spark):
    acts = spark.createDataFrame([("i1", "e+a"), ("i2", "a"), ("i3", "e")], "id string, action string")
    c = RV.action_counts(acts).first()
    assert (c.approved, c.rejected, c.modified) == (2, 0, 2)
    items = spark.createDataFrame([("i1", "RAW"), ("i2", "RAW"), ("i3", "RAW")], "id string, status string")
    s = RV.lifecycle_counts(RV.apply_actions(items, acts, "idea"), "new_status").first()
    assert (s.approved, s.modified) == (2, 1)                    # by status, i1 is APPROVED only
