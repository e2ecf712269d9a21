"""Record builders over responses that carry every field (built from orders).

A response is one JSON object with the order's values; some orders leave fields out, some
wrap it in a fence, and some answer with something that is not one object: the text
``null``, two objects joined by ``] , [``, or prose.  Both sides compare the values.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import records as R
from tessera.operators import review as RV
from tessera.plans.registry import query

# kind of a response by o_orderkey % 6 (orders leave out optional fields by o_orderkey % 4 = 0)
RESP = """r AS (SELECT o_orderkey AS id, CAST(o_custkey AS VARCHAR) AS idea_id, o_orderkey % 6 < 3 AS ok,
  o_orderkey % 4 <> 0 AS given, o_orderpriority AS prio, o_orderstatus AS st, o_totalprice AS price,
  o_orderkey % 4 AS q FROM orders)"""


def _responses(v, **fields):
    """(id, idea_id, title, response): ``fields`` are columns over the order; NULL leaves a field out."""
    o = v.t.orders
    obj = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    kind = F.col("o_orderkey") % 6
    text = (F.when(kind == 0, obj).when(kind == 1, F.concat(F.lit("```json\n"), obj, F.lit("\n```")))
            .when(kind == 2, F.concat(F.lit(" "), obj, F.lit("\n")))
            .when(kind == 3, F.lit("null")).when(kind == 4, F.concat(obj, F.lit('] , [{"b":2}')))
            .otherwise(F.lit("I would rather not say.")))
    return o.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").cast("string").alias("idea_id"),
                    F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
                    text.alias("response"))


def _given(c):
    return F.when(F.col("o_orderkey") % 4 != 0, c)


@query("scope_values", "PRJ-2 SCL-21", sql=f"""
WITH {RESP}
SELECT id, CASE WHEN ok THEN prio ELSE 'MODERATE' END AS complexity_rating,
  CASE WHEN ok AND given THEN st ELSE 'MODERATE' END AS scope_creep_risk,
  CASE WHEN ok THEN prio || ',' || st ELSE 'Unable to parse detailed analysis' END AS technical_challenges,
  CASE WHEN ok AND given THEN st ELSE '' END AS integration_points,
  CASE WHEN NOT ok THEN 0.5 WHEN given THEN q / 10.0 ELSE 0.7 END::DOUBLE AS confidence_score,
  CASE WHEN ok THEN 'because ' || st ELSE 'Scope analysis failed to parse. Manual review recommended.' END AS reasoning
FROM r
""")
def scope_values(v):
    """ScopeChallenge fields read from full responses (scores given as text)."""
    d = R.build_scope(_responses(
        v, complexity_rating=F.col("o_orderpriority"), scope_creep_risk=_given(F.col("o_orderstatus")),
        technical_challenges=F.array("o_orderpriority", "o_orderstatus"),
        integration_points=_given(F.array("o_orderstatus")),
        confidence_score=_given(F.concat(F.lit("0."), (F.col("o_orderkey") % 4).cast("string"))),
        reasoning=F.concat(F.lit("because "), F.col("o_orderstatus"))), order="id", keep=("id",))
    return d.select("id", "complexity_rating", "scope_creep_risk",
                    F.array_join("technical_challenges", ",").alias("technical_challenges"),
                    F.array_join("integration_points", ",").alias("integration_points"), "confidence_score", "reasoning")


@query("time_values", "PRJ-3", sql=f"""
WITH {RESP}
SELECT id, CASE WHEN ok THEN q + 0.5 ELSE 6.0 END::DOUBLE AS estimated_duration_weeks,
  CASE WHEN ok AND given THEN q ELSE 4.0 END::DOUBLE AS best_case_weeks,
  CASE WHEN ok THEN q + 9 ELSE 10.0 END::DOUBLE AS worst_case_weeks,
  CASE WHEN ok AND given THEN prio ELSE 'MODERATE' END AS schedule_risk,
  CASE WHEN ok THEN 'build:' || st ELSE '' END AS phases,
  CASE WHEN ok THEN st ELSE 'Unable to parse detailed analysis' END AS time_risk_factors,
  CASE WHEN ok THEN 0.7 ELSE 0.5 END::DOUBLE AS confidence_score
FROM r
""")
def time_values(v):
    """TimeChallenge fields read from full responses, nested phases included."""
    q = F.col("o_orderkey") % 4
    d = R.build_time(_responses(
        v, estimated_duration_weeks=q + 0.5, best_case_weeks=_given(q), worst_case_weeks=q + 9,
        schedule_risk=_given(F.col("o_orderpriority")),
        implementation_phases=F.array(F.struct(F.lit("build").alias("name"), (q * 1.0).alias("duration_weeks"),
                                               F.col("o_orderstatus").alias("description"))),
        time_risk_factors=F.array("o_orderstatus")), order="id", keep=("id",))
    return d.select("id", "estimated_duration_weeks", "best_case_weeks", "worst_case_weeks", "schedule_risk",
                    F.array_join(F.transform("implementation_phases", lambda p: F.concat(
                        p["name"], F.lit(":"), p["description"])), ",").alias("phases"),
                    F.array_join("time_risk_factors", ",").alias("time_risk_factors"), "confidence_score")


@query("cost_values", "PRJ-4", sql=f"""
WITH {RESP}
SELECT id, CASE WHEN ok AND given THEN q * 1000 ELSE 20000.0 END::DOUBLE AS dev_low,
  CASE WHEN ok AND given THEN q * 3000 ELSE 50000.0 END::DOUBLE AS dev_high,
  CASE WHEN ok THEN q * 100.5 ELSE 400.0 END::DOUBLE AS monthly_operational_cost,
  CASE WHEN ok THEN st ELSE 'MODERATE' END AS cost_risk,
  CASE WHEN ok AND given THEN prio ELSE 'MODERATE' END AS roi_potential,
  CASE WHEN ok THEN 'engineer' ELSE '' END AS resource,
  CASE WHEN ok THEN 'why ' || st ELSE 'Cost analysis failed to parse. Manual review recommended.' END AS reasoning
FROM r
""")
def cost_values(v):
    """CostChallenge fields read from full responses, nested estimate and resources included."""
    q = F.col("o_orderkey") % 4
    d = R.build_cost(_responses(
        v, development_cost_estimate=_given(F.struct((q * 1000.0).alias("low"), (q * 2000.0).alias("medium"),
                                                     (q * 3000.0).alias("high"))),
        monthly_operational_cost=q * 100.5, cost_risk=F.col("o_orderstatus"), roi_potential=_given(F.col("o_orderpriority")),
        resource_requirements=F.array(F.struct(F.lit("engineer").alias("type"), F.lit(2.0).alias("count"))),
        reasoning=F.concat(F.lit("why "), F.col("o_orderstatus"))), order="id", keep=("id",))
    return d.select("id", F.col("development_cost_estimate.low").alias("dev_low"),
                    F.col("development_cost_estimate.high").alias("dev_high"), "monthly_operational_cost", "cost_risk",
                    "roi_potential", F.array_join(F.transform("resource_requirements", lambda x: x["type"]), ",")
                    .alias("resource"), "reasoning")


@query("decision_values", "PRJ-5", sql=f"""
WITH {RESP}
SELECT id, CASE WHEN ok AND given THEN 'APPROVE' ELSE 'RECONSIDER' END AS recommendation,
  CASE WHEN NOT ok THEN 'HIGH' WHEN given THEN st ELSE 'MODERATE' END AS overall_risk,
  CASE WHEN ok THEN prio || ';' || st ELSE 'Decision synthesis failed to parse' END AS key_findings,
  CASE WHEN ok AND given THEN 'if ' || st ELSE '' END AS conditions,
  CASE WHEN ok THEN 'sum ' || st ELSE 'Failed to generate decision. Manual review required.' END AS summary,
  CASE WHEN NOT ok THEN 0.3 WHEN given THEN q / 4.0 ELSE 0.7 END::DOUBLE AS confidence_score,
  'PENDING_APPROVAL' AS status
FROM r
""")
def decision_values(v):
    """Decision fields read from full responses."""
    q = F.col("o_orderkey") % 4
    resp = _responses(
        v, recommendation=_given(F.lit("APPROVE")), overall_risk=_given(F.col("o_orderstatus")),
        key_findings=F.array("o_orderpriority", "o_orderstatus"),
        conditions=_given(F.array(F.concat(F.lit("if "), F.col("o_orderstatus")))),
        summary=F.concat(F.lit("sum "), F.col("o_orderstatus")), confidence_score=_given(q / 4.0))
    ids = [F.lit(k).alias(f"{k}_challenge_id") for k in ("scope", "time", "cost")]
    d = R.build_decision(resp.select("*", *ids), keep=("id",))
    return d.select("id", "recommendation", "overall_risk", F.array_join("key_findings", ";").alias("key_findings"),
                    F.array_join("conditions", ";").alias("conditions"), "summary", "confidence_score", "status")


@query("decision_queue", "PRJ-13 WIN-8", sql=f"""
WITH {RESP}, n AS (SELECT *, row_number() OVER (ORDER BY id) AS item_no, count(*) OVER () AS total FROM r)
SELECT id, item_no, '[' || item_no || '/' || total || ']' AS progress,
  CASE WHEN NOT ok THEN '30%' WHEN given THEN (q * 25) || '%' ELSE '70%' END AS confidence,
  CASE WHEN ok THEN prio || chr(10) || st ELSE 'Decision synthesis failed to parse' END AS findings,
  CASE WHEN ok THEN 2 ELSE 1 END::INTEGER AS findings_count,
  CASE WHEN ok AND given THEN 1 ELSE 0 END::INTEGER AS conditions_count,
  CASE WHEN ok THEN st ELSE '' END AS alternatives
FROM n
""")
def decision_queue(v):
    """Decisions as a numbered review list: findings, conditions and alternatives."""
    q = F.col("o_orderkey") % 4
    resp = _responses(
        v, key_findings=F.array("o_orderpriority", "o_orderstatus"),
        conditions=_given(F.array(F.concat(F.lit("if "), F.col("o_orderstatus")))),
        alternative_approaches=F.array("o_orderstatus"), confidence_score=_given(q / 4.0))
    ids = [F.lit(k).alias(f"{k}_challenge_id") for k in ("scope", "time", "cost")]
    d = R.build_decision(resp.select("*", *ids), keep=("id",))
    view = RV.decision_view(d.withColumn("decision_id", F.col("id")), ["decision_id"])
    return view.select(F.col("decision_id").alias("id"), "item_no", "progress", "confidence", "findings",
                       "findings_count", "conditions_count", "alternatives")


@query("solution_queue", "PRJ-13 WIN-8 SCL-17", sql=f"""
WITH {RESP}, n AS (SELECT *, row_number() OVER (ORDER BY id) AS item_no, count(*) OVER () AS total FROM r)
SELECT id, item_no, '[' || item_no || '/' || total || ']' AS progress, CASE WHEN ok THEN '70%' ELSE '50%' END AS confidence,
  CASE WHEN ok THEN 'topic.' || st || ' (' || (q + 1) || ' partitions)' ELSE 'sales.order-' || id || ' (6 partitions)' END AS topics,
  1::INTEGER AS topics_count, CASE WHEN ok AND given THEN 2 ELSE 0 END::INTEGER AS connectors_count,
  CASE WHEN ok AND given THEN prio || ', s3' ELSE '' END AS connectors,
  CASE WHEN ok THEN 'N/A' ELSE 'data-mesh-team' END AS owner
FROM n
""")
def solution_queue(v):
    """Solutions as a numbered review list: topics, connectors and governance."""
    q = F.col("o_orderkey") % 4
    resp = _responses(
        v, new_topics=F.array(F.struct(F.concat(F.lit("topic."), F.col("o_orderstatus")).alias("name"),
                                       (q + 1).cast("int").alias("partitions"))),
        infrastructure_requirements=_given(F.struct(F.array(F.col("o_orderpriority"), F.lit("s3"))
                                                    .alias("connectors_required"))))
    s = R.build_solution(resp.withColumn("domain", F.lit("sales")), keep=("id",))
    view = RV.solution_view(s.withColumn("solution_id", F.col("id")), ["solution_id"])
    return view.select(F.col("solution_id").alias("id"), "item_no", "progress", "confidence", "topics", "topics_count",
                       "connectors_count", F.coalesce("connectors", F.lit("")).alias("connectors"), "owner")


@query("solution_values", "PRJ-6", sql=f"""
WITH {RESP}
SELECT id, CASE WHEN ok THEN 'use ' || st ELSE 'Basic ksqlDB solution aggregating data from 0 source topics' END AS technical_approach,
  CASE WHEN ok AND given THEN 'FLINK' ELSE 'KSQLDB' END AS processing_engine,
  CASE WHEN ok THEN 'topic.' || st ELSE 'sales.order-' || id END AS first_topic,
  CASE WHEN ok THEN q + 1 ELSE 6 END::INTEGER AS partitions,
  CASE WHEN NOT ok THEN 'data-mesh-team' WHEN given THEN prio END AS owner,
  CASE WHEN ok THEN q * 8 ELSE 40.0 END::DOUBLE AS estimated_effort_hours,
  CASE WHEN ok THEN 0.7 ELSE 0.5 END::DOUBLE AS confidence_score
FROM r
""")
def solution_values(v):
    """Solution fields read from full responses, nested topics and governance included."""
    q = F.col("o_orderkey") % 4
    resp = _responses(
        v, technical_approach=F.concat(F.lit("use "), F.col("o_orderstatus")), processing_engine=_given(F.lit("FLINK")),
        new_topics=F.array(F.struct(F.concat(F.lit("topic."), F.col("o_orderstatus")).alias("name"),
                                    (q + 1).cast("int").alias("partitions"))),
        data_governance=_given(F.struct(F.col("o_orderpriority").alias("owner"))),
        estimated_effort_hours=q * 8)
    s = R.build_solution(resp.withColumn("domain", F.lit("sales")), keep=("id",))
    first = F.get("new_topics", 0)
    return s.select("id", "technical_approach", "processing_engine", first["name"].alias("first_topic"),
                    first["partitions"].alias("partitions"), F.col("data_governance.owner").alias("owner"),
                    "estimated_effort_hours", "confidence_score")


@query("synthesis_values", "PRJ-9", sql=f"""
WITH {RESP}
SELECT id, CASE WHEN ok AND given THEN 'state ' || prio WHEN ok THEN NULL WHEN id % 6 = 3 THEN 'null'
    WHEN id % 6 = 5 THEN 'I would rather not say.' END AS summary,
  CASE WHEN ok THEN st ELSE '' END AS observations
FROM r WHERE id % 6 <> 4
""")
def synthesis_values(v):
    """State synthesis read from full responses (a text that is no object is quoted itself)."""
    resp = _responses(v, summary=_given(F.concat(F.lit("state "), F.col("o_orderpriority"))),
                      observations=F.array("o_orderstatus"))
    d = R.build_synthesis(resp.filter(F.col("id") % 6 != 4))
    return d.select("id", "summary", F.array_join("observations", ",").alias("observations"))


@query("idea_simple_values", "PRJ-10", sql=f"""
WITH {RESP}
SELECT id, CASE WHEN ok THEN 'T' || st ELSE 'Generated Idea' END AS title,
  CASE WHEN NOT ok THEN 'Unknown' WHEN given THEN prio END AS rationale,
  CASE WHEN ok THEN st ELSE 'other' END AS category, ok AS parsed
FROM r
""")
def idea_simple_values(v):
    """Simple ideas read from full responses (a field left out stays NULL)."""
    resp = _responses(v, title=F.concat(F.lit("T"), F.col("o_orderstatus")), rationale=_given(F.col("o_orderpriority")),
                      category=F.col("o_orderstatus")).select("id", "response")
    return R.build_idea_simple(resp).select("id", "title", "rationale", "category", "parsed")
