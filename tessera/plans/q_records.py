"""Response handling and record-builder queries over V4 (raw responses), V2 and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import jsontext as J
from tessera.functions.text import iso_utc
from tessera.operators import records as R
from tessera.operators.log import latest_per_key, with_status
from tessera.plans import oracle_text as T
from tessera.plans.registry import query

EXTRACT = T.extract_steps("v4", "ex")
REPAIR = T.repair_steps("ex", "obj", "rp")


@query("repair_responses", "SCL-7 SCL-8", views=("v4",), bench=True, sql=f"""
WITH {EXTRACT},
{REPAIR}
SELECT id, kind, repair, CAST(repaired->>'k' AS INTEGER) AS k, CAST(repaired->>'m' AS BIGINT) AS m FROM rp
""")
def repair_responses(v):
    """Extract the JSON object of each response, repair it (first repair that parses wins),
    read it typed."""
    d = J.with_repaired(J.with_extracted(v.v4, "text", "obj"), "obj", "fixed", kind="repair")
    parsed = F.from_json(F.col("fixed"), "k INT, m BIGINT")
    return d.select("id", "kind", "repair", parsed.k.alias("k"), parsed.m.alias("m"))


@query("parse_or_fallback", "SCL-9", views=("v4",), sql=f"""
WITH {EXTRACT},
{REPAIR}
SELECT id, repaired IS NOT NULL AS ok, CAST(repaired->>'k' AS INTEGER) AS k,
  CASE WHEN repaired IS NULL THEN 'Failed to parse or repair JSON' END AS error,
  CASE WHEN repaired IS NULL THEN coalesce(left(text, 500), '') END AS raw_response_preview FROM rp
""")
def parse_or_fallback_q(v):
    """Typed parse with the error record (message + 500-char preview) when nothing parses."""
    d = J.with_parsed(v.v4, "text", "k INT")
    return d.select("id", F.col("parse_ok").alias("ok"), F.col("parsed.k").alias("k"),
                    F.col("parse_error").alias("error"), "raw_response_preview")


@query("strip_fences", "SCL-5", views=("v4",), sql=f"""
SELECT id, {T.strip_fences('text')} AS stripped, {T.is_object(T.strip_fences('text'))} AS parses FROM v4
""")
def strip_fences_q(v):
    """Fence stripping of the evaluation agents, and whether the rest parses strictly."""
    s = J.strip_fences(F.col("text"))
    return v.v4.select("id", s.alias("stripped"), J.is_json_object(s).alias("parses"))


@query("between_fences", "SCL-6", views=("v4",), sql=f"""
SELECT id, {T.between_fences('text')} AS inner_text FROM v4
""")
def between_fences_q(v):
    """Inside of the first ```json (else ```) block, else the whole text, trimmed."""
    return v.v4.select("id", J.between_fences(F.col("text")).alias("inner_text"))


def _idea_ctx(v):
    return v.v4.select("id", F.col("user_id").cast("string").alias("idea_id"),
                       F.concat(F.lit("Idea "), F.col("user_id").cast("string")).alias("title"),
                       F.col("text").alias("response"), "event_type")


FENCED = f"""f AS (SELECT id, CAST(user_id AS VARCHAR) AS idea_id, {T.strip_fences('text')} AS clean FROM v4),
p AS (SELECT *, {T.is_object('clean')} AS ok FROM f)"""


@query("build_scope", "PRJ-2", views=("v4",), sql=f"""
WITH {FENCED}
SELECT id, idea_id, {T.record_id('scope-', 'idea_id', "'scope'", 'id')} AS challenge_id,
  'MODERATE' AS complexity_rating, 'MODERATE' AS scope_creep_risk,
  CASE WHEN ok THEN 0 ELSE 1 END AS technical_challenges,
  CAST(CASE WHEN ok THEN 0.7 ELSE 0.5 END AS DOUBLE) AS confidence_score,
  CASE WHEN ok THEN '' ELSE 'Scope analysis failed to parse. Manual review recommended.' END AS reasoning
FROM p
""")
def build_scope_q(v):
    """ScopeChallenge per response: parsed → defaults for missing fields, else the fallback."""
    d = R.build_scope(_idea_ctx(v), order="id", keep=("id",))
    return d.select("id", "idea_id", "challenge_id", "complexity_rating", "scope_creep_risk",
                    F.size("technical_challenges").alias("technical_challenges"),
                    "confidence_score", "reasoning")


@query("build_time", "PRJ-3", views=("v4",), sql=f"""
WITH {FENCED}
SELECT id, 6.0::DOUBLE AS estimated_duration_weeks, 4.0::DOUBLE AS best_case_weeks, 10.0::DOUBLE AS worst_case_weeks,
  'MODERATE' AS schedule_risk, CASE WHEN ok THEN 0 ELSE 1 END AS time_risk_factors,
  CAST(CASE WHEN ok THEN 0.7 ELSE 0.5 END AS DOUBLE) AS confidence_score,
  CASE WHEN ok THEN '' ELSE 'Timeline analysis failed to parse. Manual review recommended.' END AS reasoning
FROM p
""")
def build_time_q(v):
    """TimeChallenge per response (defaults 6/4/10 weeks)."""
    d = R.build_time(_idea_ctx(v), order="id", keep=("id",))
    return d.select("id", "estimated_duration_weeks", "best_case_weeks", "worst_case_weeks",
                    "schedule_risk", F.size("time_risk_factors").alias("time_risk_factors"),
                    "confidence_score", "reasoning")


@query("build_cost", "PRJ-4", views=("v4",), sql=f"""
WITH {FENCED}
SELECT id, 20000.0::DOUBLE AS dev_low, 35000.0::DOUBLE AS dev_medium, 50000.0::DOUBLE AS dev_high,
  400.0::DOUBLE AS monthly_operational_cost, 'MODERATE' AS cost_risk, 'MODERATE' AS roi_potential,
  CASE WHEN ok THEN 0 ELSE 1 END AS cost_optimization_opportunities,
  CAST(CASE WHEN ok THEN 0.7 ELSE 0.5 END AS DOUBLE) AS confidence_score
FROM p
""")
def build_cost_q(v):
    """CostChallenge per response (nested development-cost default)."""
    d = R.build_cost(_idea_ctx(v), order="id", keep=("id",))
    return d.select(
        "id", F.col("development_cost_estimate.low").alias("dev_low"),
        F.col("development_cost_estimate.medium").alias("dev_medium"),
        F.col("development_cost_estimate.high").alias("dev_high"),
        "monthly_operational_cost", "cost_risk", "roi_potential",
        F.size("cost_optimization_opportunities").alias("cost_optimization_opportunities"),
        "confidence_score")


def _idea_json(o):
    """Idea objects built from orders (fields left out where the order says so)."""
    return F.to_json(F.struct(
        F.concat(F.lit("Order "), F.col("o_orderkey").cast("string")).alias("title"),
        F.when(F.col("o_orderstatus") != "F", F.col("o_orderpriority")).alias("domain"),
        F.array(F.col("o_orderpriority"), F.col("o_orderstatus")).alias("related_topics"),
        F.when(F.col("o_orderstatus") == "O", F.lit("HIGH")).alias("estimated_complexity"),
        (F.col("o_totalprice") / 1e6).alias("confidence_score")))


@query("build_raw_ideas", "PRJ-1 SCL-12 SCL-13 SCL-20 SCL-21", sql=f"""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%f+00:00') AS timestamp,
  {T.record_id('idea-', 'o_orderkey')} AS idea_id, 'Order ' || CAST(o_orderkey AS VARCHAR) AS title,
  'No description provided' AS description,
  CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority ELSE 'unknown' END AS domain,
  2 AS related_topics, 'No reasoning provided' AS reasoning, 0 AS potential_users,
  CASE WHEN o_orderstatus = 'O' THEN 'HIGH' ELSE 'MEDIUM' END AS estimated_complexity,
  o_totalprice / 1e6 AS confidence_score, 'RAW' AS status
FROM orders
""")
def build_raw_ideas_q(v):
    """RawIdea records from idea objects: given fields kept, missing ones defaulted, RAW."""
    o = v.t.orders.select("o_orderkey", "o_orderdate", _idea_json(v.t.orders).alias("idea"))
    r = R.build_raw_ideas(o, "idea", ts=F.col("o_orderdate"), id_cols=("o_orderkey",))
    return r.select("o_orderkey", "timestamp", "idea_id", "title", "description", "domain",
                    F.size("related_topics").alias("related_topics"), "reasoning",
                    F.size("potential_users").alias("potential_users"), "estimated_complexity",
                    "confidence_score", "status")


BETWEEN = f"""b AS (SELECT id, text, {T.between_fences('text')} AS clean FROM v4),
p AS (SELECT *, {T.is_object('clean')} AS ok FROM b)"""


@query("build_idea_simple", "PRJ-10", views=("v4",), sql=f"""
WITH {BETWEEN}
SELECT id, CASE WHEN ok THEN json_extract_string(clean, '$.title') ELSE 'Generated Idea' END AS title,
  CASE WHEN ok THEN json_extract_string(clean, '$.description') ELSE left(text, 300) END AS description,
  CASE WHEN ok THEN json_extract_string(clean, '$.rationale') ELSE 'Unknown' END AS rationale,
  CASE WHEN ok THEN json_extract_string(clean, '$.category') ELSE 'other' END AS category, ok AS parsed
FROM p
""")
def build_idea_simple_q(v):
    """Simple idea per response; failure → 'Generated Idea', first 300 chars, 'other'."""
    d = R.build_idea_simple(v.v4.select("id", F.col("text").alias("response")))
    return d.select("id", "title", "description", "rationale", "category", "parsed")


@query("build_synthesis", "PRJ-9 SCL-11", views=("v4",), sql=f"""
WITH {BETWEEN}
SELECT id, CASE WHEN ok THEN json_extract_string(clean, '$.summary') ELSE left(text, 500) END AS summary,
  0 AS observations FROM p
""")
def build_synthesis_q(v):
    """State synthesis per response; failure → first 500 chars, no observations."""
    d = R.build_synthesis(v.v4.select("id", F.col("text").alias("response")))
    return d.select("id", "summary", F.size("observations").alias("observations"))


SOLUTION_CTX = """ctx AS (SELECT id, text, CAST(user_id AS VARCHAR) AS idea_id, 'Stream ' || event_type AS title,
  event_type AS domain FROM v4)"""


@query("build_solutions", "PRJ-6 SCL-3", views=("v4",), sql=f"""
WITH {SOLUTION_CTX},
{T.extract_steps("ctx", "ex")},
{T.repair_steps("ex", "obj", "rp")}
SELECT id, {T.record_id('solution-', 'idea_id')} AS solution_id,
  CASE WHEN repaired IS NOT NULL THEN '' ELSE 'Basic ksqlDB solution aggregating data from 0 source topics' END
    AS technical_approach,
  'KSQLDB' AS processing_engine,
  CASE WHEN repaired IS NOT NULL THEN 0 ELSE 1 END AS new_topics,
  CASE WHEN repaired IS NULL THEN domain || '.' || replace(lower(title), ' ', '-') END AS first_topic,
  40.0::DOUBLE AS estimated_effort_hours,
  CAST(CASE WHEN repaired IS NOT NULL THEN 0.7 ELSE 0.5 END AS DOUBLE) AS confidence_score,
  CASE WHEN repaired IS NULL THEN 'data-mesh-team' END AS owner,
  CASE WHEN repaired IS NOT NULL THEN 0 ELSE 1 END AS success_metrics
FROM rp
""")
def build_solutions_q(v):
    """Solutions from responses with extract + repair; unrepairable → fallback design with
    a derived topic name '<domain>.<slug>'."""
    ctx = v.v4.select("id", F.col("text").alias("response"),
                      F.col("user_id").cast("string").alias("idea_id"),
                      F.concat(F.lit("Stream "), F.col("event_type")).alias("title"),
                      F.col("event_type").alias("domain"))
    s = R.build_solution(ctx, keep=("id",))
    return s.select("id", "solution_id", "technical_approach", "processing_engine",
                    F.size("new_topics").alias("new_topics"),
                    F.get(F.col("new_topics"), 0)["name"].alias("first_topic"),
                    "estimated_effort_hours", "confidence_score",
                    F.col("data_governance.owner").alias("owner"),
                    F.size("success_metrics").alias("success_metrics"))


def _fallback_solutions(v):
    items = with_status(latest_per_key(v.v2, "key", value="status"), "APPROVED")
    ctx = items.select(F.col("key").alias("idea_id"),
                       F.concat(F.lit("Product "), F.col("key")).alias("title"),
                       F.lower(F.regexp_extract("domain", r"-(.*)$", 1)).alias("domain"),
                       F.array(F.col("domain")).alias("related_topics"))
    return R.build_solution(ctx, response=None)


APPROVED_CTX = """ap AS (SELECT key AS idea_id, 'Product ' || key AS title,
    lower(regexp_extract(arg_max(domain, "offset"), '-(.*)$', 1)) AS domain
  FROM v2 GROUP BY key HAVING arg_max(status, "offset") = 'APPROVED')"""


@query("solutions_no_responder", "UDF-2 PRJ-6", views=("v2",), sql=f"""
WITH {APPROVED_CTX}
SELECT idea_id, 'Basic ksqlDB solution aggregating data from 1 source topics' AS technical_approach,
  domain || '.' || replace(lower(title), ' ', '-') AS first_topic, CAST(0.5 AS DOUBLE) AS confidence_score,
  domain AS governance_domain, 'INTERNAL' AS classification
FROM ap
""")
def solutions_no_responder(v):
    """No responder configured: every approved item takes the deterministic fallback design."""
    s = _fallback_solutions(v)
    return s.select("idea_id", "technical_approach", F.col("new_topics")[0]["name"].alias("first_topic"),
                    "confidence_score", F.col("data_governance.domain").alias("governance_domain"),
                    F.col("data_governance.classification").alias("classification"))


def _impl_lines() -> int:
    tf = R.TF_HEADER.count("\n") + R.TF_TOPIC_BLOCK.count("\n") + 1
    readme = R.README_TEMPLATE.count("\n") + 2 + 1      # one topic: '[', '  "name"', ']'
    return tf + readme


@query("build_implementations", "PRJ-7 SCL-4", views=("v2",), sql=f"""
WITH {APPROVED_CTX}
SELECT idea_id, 'terraform/data-products/' || domain || '-' || replace(lower(title), ' ', '-') || '.tf' AS tf_path,
  'feat/data-product-' || replace(lower(title), ' ', '-') AS branch_name,
  replace(replace(domain || '.' || replace(lower(title), ' ', '-'), '.', '_'), '-', '_') AS resource_name,
  2 AS artifacts, {_impl_lines()} AS total_lines_of_code, TRUE AS has_topic_block
FROM ap
""")
def build_implementations(v):
    """Fallback implementation per solution: Terraform + README artifacts, resources, PR."""
    impl = R.build_implementation(_fallback_solutions(v))
    first = F.col("artifacts")[0]
    return impl.select(
        "idea_id", first["path"].alias("tf_path"), F.col("pull_request.branch_name").alias("branch_name"),
        F.col("terraform_resources")[0]["resource_name"].alias("resource_name"),
        F.size("artifacts").alias("artifacts"),
        F.col("metadata.total_lines_of_code").alias("total_lines_of_code"),
        first["content"].contains('resource "confluent_kafka_topic"').alias("has_topic_block"))


@query("render_prompts", "PRJ-12 SCL-14 SCL-19", views=("v2",), sql="""
WITH l AS (SELECT key, arg_max(status, "offset") AS status, arg_max(domain, "offset") AS domain,
                  arg_max(score, "offset") AS score FROM v2 GROUP BY key)
SELECT key, 'Evaluate idea ' || key || ' (' || domain || '), value $' || format('{:,.0f}', score)
  || ', tags ' || to_json([status, domain]) AS prompt FROM l
""")
def render_prompts_q(v):
    """One request text per latest item: scalar fields, JSON-encoded array, formatted money."""
    items = latest_per_key(v.v2, "key", value="status")
    p = R.render_prompts(items, "Evaluate idea %s (%s), value $%s, tags %s",
                         [F.col("key"), F.col("domain"), F.format_number("score", 0),
                          F.to_json(F.array("status", "domain"))])
    return p.select("key", "prompt")
