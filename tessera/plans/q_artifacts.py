"""Artifact and nested roll-up queries over V5 (documents, pages) and lineitem."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.text import line_count
from tessera.operators import artifacts as A
from tessera.plans.registry import query

LINES = "len(string_split({c}, chr(10)))"


@query("explode_artifacts", "SNK-3 SCL-18", views=("v5",), sql=f"""
SELECT path, type, {LINES.format(c='content')} AS lines FROM v5
UNION ALL SELECT path || '.md', 'DOCUMENTATION', {LINES.format(c="'Summary of ' || path || chr(10) || content")} FROM v5
""")
def explode_artifacts_q(v):
    """Each item carries a nested artifacts array (its content + a summary document);
    exploded to one row per artifact with its line count."""
    items = v.v5.select(F.array(
        F.struct("path", "type", "content", F.lit("source").alias("description")),
        F.struct(F.concat("path", F.lit(".md")).alias("path"), F.lit("DOCUMENTATION").alias("type"),
                 F.concat(F.lit("Summary of "), F.col("path"), F.lit("\n"), F.col("content"))
                 .alias("content"),
                 F.lit("summary").alias("description"))).alias("artifacts"))
    rows = A.explode_artifacts(items)
    return rows.select("path", "type", line_count(F.col("content")).alias("lines"))


@query("artifact_totals", "AGG-13", views=("v5",), sql=f"""
SELECT type, count(*) AS files, sum({LINES.format(c='content')}) AS total_lines FROM v5 GROUP BY type
""")
def artifact_totals_q(v):
    """Files and total lines per artifact type."""
    return A.artifact_totals(v.v5)


def _order_lines(v):
    li = v.t.lineitem
    # an order has at most seven lines: the nested arrays are bounded by the data model
    return li.groupBy("l_orderkey").agg(
        F.collect_list(F.struct(F.concat(F.lit("part "), F.col("l_partkey").cast("string")).alias("component"),
                                F.col("l_extendedprice").alias("monthly_usd"))).alias("breakdown"),
        F.collect_list(F.struct(F.lit("engineer").alias("type"), F.col("l_quantity").alias("count"),
                                (F.col("l_discount") * 100).alias("duration_weeks"))).alias("resources"),
        F.collect_list(F.struct(F.col("l_linenumber").alias("order"),
                                F.concat(F.lit("ship line "), F.col("l_linenumber").cast("string")).alias("description"),
                                F.lit("deploy").alias("command"), F.lit("1 day").alias("estimated_duration")))
        .alias("steps"))


@query("cost_rollup", "AGG-19 SCL-24", sql="""
SELECT l_orderkey, round(sum(l_extendedprice), 2) AS monthly_usd, round(sum(l_extendedprice) * 60, 2) AS five_year_usd
FROM lineitem GROUP BY l_orderkey
""")
def cost_rollup_q(v):
    """Monthly total over each order's nested cost breakdown, and over five years."""
    o = _order_lines(v)
    m = A.cost_rollup("breakdown")
    return o.select("l_orderkey", F.round(m, 2).alias("monthly_usd"),
                    F.round(A.annualised(m, 5), 2).alias("five_year_usd"))


@query("effort_rollup", "AGG-20", sql="""
SELECT l_orderkey, round(sum(l_quantity * (l_discount * 100)), 4) AS person_weeks FROM lineitem GROUP BY l_orderkey
""")
def effort_rollup_q(v):
    """Person-weeks = Σ count × duration over each order's nested resources."""
    o = _order_lines(v)
    return o.select("l_orderkey", F.round(A.effort_rollup("resources"), 4).alias("person_weeks"))


@query("ordered_steps", "SRT-8", sql="""
SELECT l_orderkey, string_agg(CAST(l_linenumber AS VARCHAR), ',' ORDER BY l_linenumber) AS step_order,
       'ship line ' || CAST(min(l_linenumber) AS VARCHAR) AS first_step
FROM lineitem GROUP BY l_orderkey
""")
def ordered_steps_q(v):
    """Deployment steps sorted by their order field."""
    o = _order_lines(v)
    s = A.ordered_steps("steps")
    return o.select("l_orderkey",
                    F.array_join(F.transform(s, lambda x: x["order"].cast("string")), ",").alias("step_order"),
                    s[0]["description"].alias("first_step"))
