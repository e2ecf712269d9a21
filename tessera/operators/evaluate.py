"""Evaluations joined into decisions and work items (JN-1..4, JN-6, FLT-6, AGG-14).

Every "latest version per id" is an aggregation that combines map-side, so each
side of a join holds one row per id: the joins are id-to-id, never skewed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.log import latest_per_key

KINDS = ("scope", "time", "cost")


def _packed(df: DataFrame, key: str, order: str, name: str, pick: str = "latest") -> DataFrame:
    """One row per id with the chosen version packed into a struct column ``name``."""
    rest = [c for c in df.columns if c != key]
    agg = F.max_by if pick == "latest" else F.min_by
    return df.groupBy(key).agg(agg(F.struct(*rest), F.col(order)).alias(name))


def join_evaluations(scope: DataFrame, time: DataFrame, cost: DataFrame, key: str = "idea_id",
                     order: str = "offset") -> DataFrame:
    """JN-1: last value per id in each log, ids present in all three (two inner equi-joins)."""
    s = _packed(scope, key, order, "scope")
    t = _packed(time, key, order, "time")
    c = _packed(cost, key, order, "cost")
    return s.join(t, key).join(c, key)


def join_evaluations_from(driver: DataFrame, time: DataFrame, cost: DataFrame,
                          key: str = "idea_id", order: str = "offset",
                          pick: str = "first") -> tuple[DataFrame, DataFrame]:
    """JN-2: ids come from the driver (scope) set; each other side is looked up (first match
    in ``order``); ids missing any side are skipped and reported.

    Returns (complete, skipped) where skipped carries which side was missing."""
    s = _packed(driver, key, order, "scope", "latest")
    t = _packed(time, key, order, "time", pick)
    c = _packed(cost, key, order, "cost", pick)
    j = s.join(t, key, "left").join(c, key, "left")
    complete = j.filter(F.col("time").isNotNull() & F.col("cost").isNotNull())
    skipped = j.filter(F.col("time").isNull() | F.col("cost").isNull()).select(
        key, F.col("time").isNull().alias("missing_time"), F.col("cost").isNull().alias("missing_cost"))
    return complete, skipped


def tag_kinds(scope: DataFrame, time: DataFrame, cost: DataFrame) -> DataFrame:
    """The three logs as one keyed set with a ``kind`` column (SET-1)."""
    return (scope.withColumn("kind", F.lit("scope"))
            .unionByName(time.withColumn("kind", F.lit("time")), allowMissingColumns=True)
            .unionByName(cost.withColumn("kind", F.lit("cost")), allowMissingColumns=True))


def complete_only(tagged: DataFrame, key: str = "idea_id") -> DataFrame:
    """FLT-6: ids having all three evaluation kinds."""
    return (tagged.groupBy(key).agg(F.countDistinct("kind").alias("_kinds"))
            .filter(F.col("_kinds") == len(KINDS)).select(key))


def group_evaluations(tagged: DataFrame, key: str = "idea_id", order: str = "offset",
                      value: str = "challenge_id") -> DataFrame:
    """AGG-14: one row per id with the latest value of each kind as a column (pivot with
    the kinds listed, so no extra pass to discover them)."""
    return (tagged.groupBy(key).pivot("kind", list(KINDS))
            .agg(F.max_by(F.col(value), F.col(order))))


def join_decision_idea(decisions: DataFrame, ideas: DataFrame, key: str = "idea_id",
                       order: str | None = None) -> DataFrame:
    """JN-3: decisions with their original idea (latest idea version when ``order`` given)."""
    idea = latest_per_key(ideas, key, order, value=None) if order else ideas
    # both sides grow with the ideas: not broadcast, whatever size Spark takes them for
    return decisions.join(idea.hint("merge"), key, "inner")


def missing_side(left: DataFrame, right: DataFrame, left_key: str,
                 right_key: str | None = None) -> DataFrame:
    """JN-4: rows of ``left`` whose partner is absent from ``right``."""
    rk = right_key or left_key
    r = right.select(F.col(rk).alias(left_key)).distinct() if rk != left_key else \
        right.select(left_key)
    return left.join(r, left_key, "left_anti")


def with_context(df: DataFrame, state: DataFrame, order: str, name: str = "context") -> DataFrame:
    """JN-6: attach the single current-state row (or NULL) to every row.

    The state is read as a scalar subquery of one struct (the row of the greatest
    ``order``), so no join is planned and an empty state cannot drop rows."""
    newest = state.agg(F.max_by(F.struct(*state.columns), F.col(order))).scalar()
    return df.withColumn(name, newest)
