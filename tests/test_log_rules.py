"""FIXTURES §5.1 (lifecycle log) and §5.2 (evaluations)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tessera.operators import evaluate as E
from tessera.operators import log as L
from tessera.operators import review as RV

T0 = dt.datetime(2024, 1, 1)


def ts(s):
    return T0 + dt.timedelta(seconds=s)


@pytest.fixture(scope="module")
def lifecycle(spark):
    rows = [(0, ts(0), "i1", "RAW"), (1, ts(1), "i2", "RAW"), (2, ts(2), "i1", "APPROVED"),
            (3, ts(30), "i2", "REFINED"), (4, ts(40), "i1", "REJECTED"), (5, ts(50), "i3", None),
            (6, ts(120), "i2", "APPROVED")]
    return spark.createDataFrame(rows, "offset bigint, ts timestamp, key string, status string")


def offsets(df):
    return sorted(r["offset"] for r in df.select("offset").collect())


def test_latest_in_topic(lifecycle):
    r = L.latest_in_topic(lifecycle, value="status").collect()
    assert [(x.key, x.status, x.offset) for x in r] == [("i2", "APPROVED", 6)]


def test_latest_per_key(lifecycle):
    r = {x.key: x.status for x in L.latest_per_key(lifecycle, value="status").collect()}
    assert r == {"i1": "REJECTED", "i2": "APPROVED"}


def test_status_filters(lifecycle):
    assert offsets(L.with_status(lifecycle, "APPROVED")) == [2, 6]            # reference (T2)
    latest = L.latest_per_key(lifecycle, value="status")
    assert offsets(L.with_status(latest, "APPROVED")) == [6]                  # our default
    assert offsets(L.most_recent(L.with_status(lifecycle, "APPROVED"), 1)) == [6]


def test_compaction_lag(lifecycle):
    out = L.compact_with_lag(lifecycle, value="status", as_of=ts(120))
    assert offsets(out) == [4, 6]
    early = lifecycle.filter("offset <= 4")
    assert offsets(L.compact_with_lag(early, value="status", as_of=ts(50))) == [0, 1, 2, 3, 4]


def test_transitions_and_counts(lifecycle):
    tr = L.status_transitions(lifecycle.filter(F.col("status").isNotNull()))
    paths = {}
    for r in tr.orderBy("offset").collect():
        paths.setdefault(r.key, []).append(r.status)
    assert paths == {"i1": ["RAW", "APPROVED", "REJECTED"], "i2": ["RAW", "REFINED", "APPROVED"]}
    c = RV.lifecycle_counts(L.latest_per_key(lifecycle, value="status")).first()
    assert (c.approved, c.rejected, c.modified, c.remaining) == (1, 1, 0, 0)


def test_retention(spark):
    day = 86_400_000
    rows = [("a", ts(0)), ("a", ts(9 * 86400)), ("b", ts(0)), ("c", ts(0))]
    df = spark.createDataFrame(rows, "topic string, ts timestamp")
    out = L.apply_retention(df, 7 * day, overrides={"b": -1})
    assert sorted((r.topic, r.ts) for r in out.collect()) == [("a", ts(9 * 86400)), ("b", ts(0))]


@pytest.fixture(scope="module")
def evals(spark):
    mk = lambda rows: spark.createDataFrame(rows, "idea_id string, offset bigint, challenge_id string")
    scope = mk([("a", 0, "s-a"), ("b", 1, "s-b"), ("c", 2, "s-c"), ("a", 3, "s-a2")])
    time = mk([("a", 0, "t-a"), ("b", 1, "t-b"), ("d", 2, "t-d")])
    cost = mk([("a", 0, "c-a"), ("b", 1, "c-b"), ("c", 2, "c-c")])
    return scope, time, cost


def test_join_evaluations(evals):
    j = {r.idea_id: r.scope.challenge_id for r in E.join_evaluations(*evals).collect()}
    assert j == {"a": "s-a2", "b": "s-b"}
    complete, skipped = E.join_evaluations_from(*evals)
    assert sorted(r.idea_id for r in complete.collect()) == ["a", "b"]
    assert [(r.idea_id, r.missing_time, r.missing_cost) for r in skipped.collect()] == [("c", True, False)]
    assert sorted(r.idea_id for r in E.complete_only(E.tag_kinds(*evals)).collect()) == ["a", "b"]
    first = {r.topic: r.idea_id for r in L.first_per_topic(
        E.tag_kinds(*evals).withColumnRenamed("kind", "topic"), value="idea_id").collect()}
    assert first == {"scope": "a", "time": "a", "cost": "a"}
    piv = {r.idea_id: (r.scope, r.time, r.cost) for r in E.group_evaluations(E.tag_kinds(*evals)).collect()}
    assert piv["a"] == ("s-a2", "t-a", "c-a") and piv["d"] == (None, "t-d", None)


def test_with_context_keeps_rows_when_state_empty(spark):
    items = spark.createDataFrame([("x",), ("y",)], "id string")
    empty = spark.createDataFrame([], "as_of string, n bigint")
    out = E.with_context(items, empty, order=empty.columns[0]).collect()
    assert len(out) == 2 and all(r.context is None for r in out)
