"""Record builders: model responses (or none) → typed records with defaults and fallbacks
(PRJ-1..7, PRJ-9, PRJ-10, PRJ-12, UDF-2).

Each builder takes a DataFrame holding a response text column plus the context
columns of the item, and returns the record's columns.  Parsing never leaves the
JVM: the response is cleaned with the caller's rule (fences / between fences /
extract+repair), checked to be exactly one JSON object, and read with ``from_json``.
Scalars are read as text and cast (``try_cast``) so a number given as "0.8" still
counts, as Python's ``float()`` would.  A NULL field counts as missing (SURVEY T9).
A response that is not one object takes the record's fallback (SURVEY T21).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.functions.jsontext import (between_fences, extract_object, is_json_object,
                                        repair_json, strip_fences, with_extracted, with_repaired)
from tessera.functions.text import default_if_missing, iso_utc, record_id, safe_ident, slug

# --- fixed values: record defaults and fallback texts ---
PARSE_FAILED = "Unable to parse detailed analysis"
SCOPE_FALLBACK_REASON = "Scope analysis failed to parse. Manual review recommended."
TIME_FALLBACK_REASON = "Timeline analysis failed to parse. Manual review recommended."
COST_FALLBACK_REASON = "Cost analysis failed to parse. Manual review recommended."
DECISION_FALLBACK_FINDING = "Decision synthesis failed to parse"
DECISION_FALLBACK_SUMMARY = "Failed to generate decision. Manual review required."
DECISION_FALLBACK_REASON = "Decision analysis failed to parse. Manual review recommended."
IDEA_DEFAULTS = {"title": "Untitled Idea", "description": "No description provided",
                 "domain": "unknown", "reasoning": "No reasoning provided",
                 "estimated_complexity": "MEDIUM", "confidence_score": 0.5}
SIMPLE_IDEA_FALLBACK = {"title": "Generated Idea", "rationale": "Unknown", "category": "other"}
SOLUTION_FALLBACK = {
    "approach": "Basic ksqlDB solution aggregating data from {n} source topics",
    "engine": "KSQLDB",
    "rationale": "ksqlDB chosen for simple SQL-based transformations and aggregations",
    "topic_description": "Aggregated data for {title}",
    "ksqldb_notes": "Use existing ksqlDB cluster",
    "owner": "data-mesh-team",
    "classification": "INTERNAL",
    "retention_policy": "7 days",
    "tag": "data-product",
    "testing": "Manual validation of query results against source data",
    "deployment": "Deploy ksqlDB queries incrementally, monitor for errors",
    "metric": "Data product successfully deployed and queryable",
}
SYNTHESIS_FAILED = "Automated synthesis unavailable. Platform has basic deployment state."

ARR = "array<string>"


def clean_response(text, mode: str) -> Column:
    """The candidate JSON text of a response under one of the callers' rules."""
    if mode == "fences":
        return strip_fences(text)
    if mode == "between":
        return between_fences(text)
    if mode == "repair":
        return repair_json(extract_object(text))
    raise ValueError(mode)


def _parse(df: DataFrame, response: str, mode: str, schema: str) -> DataFrame:
    """Adds ``_ok`` (the response holds one JSON object under ``mode``) and ``_a`` (typed)."""
    if mode == "repair":
        d = with_repaired(with_extracted(df, response, "_clean_x"), "_clean_x", "_clean")
        d = d.drop("_clean_x").withColumn("_ok", F.col("_clean").isNotNull())
    else:
        d = df.withColumn("_clean", clean_response(F.col(response), mode))
        d = d.withColumn("_ok", F.coalesce(is_json_object(F.col("_clean")), F.lit(False)))
    return d.withColumn("_a", F.when(F.col("_ok"), F.from_json(F.col("_clean"), schema))).drop("_clean")


def _g(field: str) -> Column:
    return F.col("_a." + field)


def _num(field: str, default: float) -> Column:
    return default_if_missing(_g(field).try_cast("double"), default)


def _txt(field: str, default: str) -> Column:
    return default_if_missing(_g(field), default)


def _arr(field: str) -> Column:
    return default_if_missing(_g(field), F.array().cast(ARR))


def _lit_arr(*items: str) -> Column:
    return F.array(*[F.lit(i) for i in items]) if items else F.array().cast(ARR)


def _pick(ok: Column, parsed: Column, fallback: Column) -> Column:
    return F.when(ok, parsed).otherwise(fallback)


# ------------------------------------------------------------------ ideas


def build_raw_ideas(df: DataFrame, idea: str = "idea", ts: Column | None = None,
                    id_cols: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-1: one idea object (JSON text) per row → RawIdea with defaults, status RAW."""
    schema = ("title STRING, description STRING, domain STRING, related_topics ARRAY<STRING>, "
              "reasoning STRING, potential_users ARRAY<STRING>, estimated_complexity STRING, "
              "confidence_score STRING")
    d = df.withColumn("_a", F.from_json(F.col(idea), schema))
    ts = ts if ts is not None else F.current_timestamp()
    return d.select(
        *id_cols,
        iso_utc(ts).alias("timestamp"),
        record_id(*(id_cols or (idea,)), prefix="idea-").alias("idea_id"),
        _txt("title", IDEA_DEFAULTS["title"]).alias("title"),
        _txt("description", IDEA_DEFAULTS["description"]).alias("description"),
        _txt("domain", IDEA_DEFAULTS["domain"]).alias("domain"),
        _arr("related_topics").alias("related_topics"),
        _txt("reasoning", IDEA_DEFAULTS["reasoning"]).alias("reasoning"),
        _arr("potential_users").alias("potential_users"),
        _txt("estimated_complexity", IDEA_DEFAULTS["estimated_complexity"]).alias("estimated_complexity"),
        _num("confidence_score", IDEA_DEFAULTS["confidence_score"]).alias("confidence_score"),
        F.lit("RAW").alias("status"))


def explode_ideas(df: DataFrame, response: str = "response", keep: tuple[str, ...] = ()) -> DataFrame:
    """Response {"ideas": [...]} (between-fences rule) → one JSON idea per row; an
    unparsable response yields no idea."""
    clean = between_fences(F.col(response))
    ideas = F.from_json(clean, "struct<ideas: array<string>>")
    return (df.withColumn("_ok", is_json_object(clean)).filter("_ok")
            .select(*keep, F.posexplode(ideas.ideas).alias("idea_no", "idea")))


def build_idea_simple(df: DataFrame, response: str = "response") -> DataFrame:
    """PRJ-10: response → title/description/rationale/category; failure → first 300 chars."""
    d = _parse(df, response, "between", "title STRING, description STRING, rationale STRING, category STRING")
    ok = F.col("_ok")
    return d.select(
        *[c for c in df.columns],
        _pick(ok, _g("title"), F.lit(SIMPLE_IDEA_FALLBACK["title"])).alias("title"),
        _pick(ok, _g("description"), F.substring(F.col(response), 1, 300)).alias("description"),
        _pick(ok, _g("rationale"), F.lit(SIMPLE_IDEA_FALLBACK["rationale"])).alias("rationale"),
        _pick(ok, _g("category"), F.lit(SIMPLE_IDEA_FALLBACK["category"])).alias("category"),
        ok.alias("parsed"))


def build_synthesis(df: DataFrame, response: str = "response") -> DataFrame:
    """PRJ-9: response → {summary, observations}; unparsable → first 500 chars and [];
    no response (upstream failure) → the fixed 'unavailable' sentence."""
    d = _parse(df, response, "between", "summary STRING, observations ARRAY<STRING>")
    ok = F.col("_ok")
    missing = F.col(response).isNull()
    return d.select(
        *[c for c in df.columns],
        F.when(missing, F.lit(SYNTHESIS_FAILED))
         .when(ok, _g("summary"))
         .otherwise(F.substring(F.col(response), 1, 500)).alias("summary"),
        F.when(ok & ~missing, _arr("observations")).otherwise(_lit_arr()).alias("observations"))


# ------------------------------------------------------------- challenges


def _challenge_head(idea_id: str, title: str, ts: Column | None, kind: str, order: str | None):
    ts = ts if ts is not None else F.current_timestamp()
    rid = record_id(idea_id, F.lit(kind), *( [order] if order else []), prefix=kind + "-")
    return [iso_utc(ts).alias("timestamp"), rid.alias("challenge_id"),
            F.col(idea_id).alias("idea_id"), F.col(title).alias("idea_title")]


def build_scope(df: DataFrame, response: str = "response", idea_id: str = "idea_id",
                title: str = "title", ts: Column | None = None, order: str | None = None,
                keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-2: ScopeChallenge; unparsable → MODERATE/MODERATE, confidence 0.5."""
    d = _parse(df, response, "fences",
               "complexity_rating STRING, scope_creep_risk STRING, technical_challenges ARRAY<STRING>, "
               "integration_points ARRAY<STRING>, dependencies ARRAY<STRING>, "
               "recommended_scope_adjustments ARRAY<STRING>, confidence_score STRING, reasoning STRING")
    ok = F.col("_ok")
    return d.select(
        *keep, *_challenge_head(idea_id, title, ts, "scope", order),
        _pick(ok, _txt("complexity_rating", "MODERATE"), F.lit("MODERATE")).alias("complexity_rating"),
        _pick(ok, _txt("scope_creep_risk", "MODERATE"), F.lit("MODERATE")).alias("scope_creep_risk"),
        _pick(ok, _arr("technical_challenges"), _lit_arr(PARSE_FAILED)).alias("technical_challenges"),
        _pick(ok, _arr("integration_points"), _lit_arr()).alias("integration_points"),
        _pick(ok, _arr("dependencies"), _lit_arr()).alias("dependencies"),
        _pick(ok, _arr("recommended_scope_adjustments"), _lit_arr()).alias("recommended_scope_adjustments"),
        _pick(ok, _num("confidence_score", 0.7), F.lit(0.5)).alias("confidence_score"),
        _pick(ok, _txt("reasoning", ""), F.lit(SCOPE_FALLBACK_REASON)).alias("reasoning"))


def build_time(df: DataFrame, response: str = "response", idea_id: str = "idea_id",
               title: str = "title", ts: Column | None = None, order: str | None = None,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-3: TimeChallenge; defaults 6/4/10 weeks, MODERATE."""
    phases = "ARRAY<STRUCT<name: STRING, duration_weeks: DOUBLE, description: STRING>>"
    d = _parse(df, response, "fences",
               "estimated_duration_weeks STRING, best_case_weeks STRING, worst_case_weeks STRING, "
               f"schedule_risk STRING, implementation_phases {phases}, time_risk_factors ARRAY<STRING>, "
               "parallel_work_opportunities ARRAY<STRING>, confidence_score STRING, reasoning STRING")
    ok = F.col("_ok")
    no_phases = F.array().cast(phases.lower())
    return d.select(
        *keep, *_challenge_head(idea_id, title, ts, "time", order),
        _pick(ok, _num("estimated_duration_weeks", 6.0), F.lit(6.0)).alias("estimated_duration_weeks"),
        _pick(ok, _num("best_case_weeks", 4.0), F.lit(4.0)).alias("best_case_weeks"),
        _pick(ok, _num("worst_case_weeks", 10.0), F.lit(10.0)).alias("worst_case_weeks"),
        _pick(ok, _txt("schedule_risk", "MODERATE"), F.lit("MODERATE")).alias("schedule_risk"),
        _pick(ok, F.coalesce(_g("implementation_phases"), no_phases), no_phases).alias("implementation_phases"),
        _pick(ok, _arr("time_risk_factors"), _lit_arr(PARSE_FAILED)).alias("time_risk_factors"),
        _pick(ok, _arr("parallel_work_opportunities"), _lit_arr()).alias("parallel_work_opportunities"),
        _pick(ok, _num("confidence_score", 0.7), F.lit(0.5)).alias("confidence_score"),
        _pick(ok, _txt("reasoning", ""), F.lit(TIME_FALLBACK_REASON)).alias("reasoning"))


def build_cost(df: DataFrame, response: str = "response", idea_id: str = "idea_id",
               title: str = "title", ts: Column | None = None, order: str | None = None,
               keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-4: CostChallenge; development estimate 20000/35000/50000, 400/month."""
    res = "ARRAY<STRUCT<type: STRING, count: DOUBLE, duration_weeks: DOUBLE>>"
    infra = "ARRAY<STRUCT<component: STRING, monthly_cost: DOUBLE, notes: STRING>>"
    d = _parse(df, response, "fences",
               "development_cost_estimate STRUCT<low: DOUBLE, medium: DOUBLE, high: DOUBLE>, "
               f"monthly_operational_cost STRING, resource_requirements {res}, infrastructure_costs {infra}, "
               "cost_risk STRING, roi_potential STRING, cost_optimization_opportunities ARRAY<STRING>, "
               "confidence_score STRING, reasoning STRING")
    ok = F.col("_ok")
    dev_default = F.struct(F.lit(20000.0).alias("low"), F.lit(35000.0).alias("medium"),
                           F.lit(50000.0).alias("high"))
    no_res, no_infra = F.array().cast(res.lower()), F.array().cast(infra.lower())
    return d.select(
        *keep, *_challenge_head(idea_id, title, ts, "cost", order),
        _pick(ok, F.coalesce(_g("development_cost_estimate"), dev_default), dev_default)
        .alias("development_cost_estimate"),
        _pick(ok, _num("monthly_operational_cost", 400.0), F.lit(400.0)).alias("monthly_operational_cost"),
        _pick(ok, F.coalesce(_g("resource_requirements"), no_res), no_res).alias("resource_requirements"),
        _pick(ok, F.coalesce(_g("infrastructure_costs"), no_infra), no_infra).alias("infrastructure_costs"),
        _pick(ok, _txt("cost_risk", "MODERATE"), F.lit("MODERATE")).alias("cost_risk"),
        _pick(ok, _txt("roi_potential", "MODERATE"), F.lit("MODERATE")).alias("roi_potential"),
        _pick(ok, _arr("cost_optimization_opportunities"), _lit_arr(PARSE_FAILED))
        .alias("cost_optimization_opportunities"),
        _pick(ok, _num("confidence_score", 0.7), F.lit(0.5)).alias("confidence_score"),
        _pick(ok, _txt("reasoning", ""), F.lit(COST_FALLBACK_REASON)).alias("reasoning"))


def build_decision(df: DataFrame, response: str = "response", idea_id: str = "idea_id",
                   title: str = "title", scope_id: str = "scope_challenge_id",
                   time_id: str = "time_challenge_id", cost_id: str = "cost_challenge_id",
                   ts: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-5: Decision over joined evaluations; default RECONSIDER/MODERATE/0.7, fallback
    RECONSIDER/HIGH/0.3; status PENDING_APPROVAL."""
    d = _parse(df, response, "fences",
               "recommendation STRING, overall_risk STRING, key_findings ARRAY<STRING>, "
               "conditions ARRAY<STRING>, alternative_approaches ARRAY<STRING>, summary STRING, "
               "detailed_reasoning STRING, confidence_score STRING")
    ok = F.col("_ok")
    ts = ts if ts is not None else F.current_timestamp()
    return d.select(
        *keep, iso_utc(ts).alias("timestamp"),
        record_id(idea_id, scope_id, time_id, cost_id, prefix="decision-").alias("decision_id"),
        F.col(idea_id).alias("idea_id"), F.col(title).alias("idea_title"),
        F.col(scope_id).alias("scope_challenge_id"), F.col(time_id).alias("time_challenge_id"),
        F.col(cost_id).alias("cost_challenge_id"),
        _pick(ok, _txt("recommendation", "RECONSIDER"), F.lit("RECONSIDER")).alias("recommendation"),
        _pick(ok, _txt("overall_risk", "MODERATE"), F.lit("HIGH")).alias("overall_risk"),
        _pick(ok, _arr("key_findings"), _lit_arr(DECISION_FALLBACK_FINDING)).alias("key_findings"),
        _pick(ok, _arr("conditions"), _lit_arr()).alias("conditions"),
        _pick(ok, _arr("alternative_approaches"), _lit_arr()).alias("alternative_approaches"),
        _pick(ok, _txt("summary", ""), F.lit(DECISION_FALLBACK_SUMMARY)).alias("summary"),
        _pick(ok, _txt("detailed_reasoning", ""), F.lit(DECISION_FALLBACK_REASON)).alias("detailed_reasoning"),
        _pick(ok, _num("confidence_score", 0.7), F.lit(0.3)).alias("confidence_score"),
        F.lit("PENDING_APPROVAL").alias("status"))


# -------------------------------------------------------------- solutions

SOLUTION_ANALYSIS = (
    "technical_approach STRING, processing_engine STRING, processing_rationale STRING, "
    "new_topics ARRAY<STRUCT<name: STRING, partitions: INT, retention_ms: BIGINT, description: STRING>>, "
    "schemas ARRAY<STRUCT<subject: STRING, schema_definition: STRING, description: STRING>>, "
    "query_specifications ARRAY<STRUCT<name: STRING, type: STRING, sql_template: STRING, description: STRING>>, "
    "infrastructure_requirements STRUCT<compute_pool_required: BOOLEAN, ksqldb_cluster_required: BOOLEAN, connectors_required: ARRAY<STRING>, estimated_csu_hours: DOUBLE, additional_notes: STRING>, "
    "data_governance STRUCT<owner: STRING, domain: STRING, classification: STRING, retention_policy: STRING, tags: ARRAY<STRING>>, "
    "api_specifications ARRAY<STRUCT<endpoint_pattern: STRING, method: STRING, description: STRING>>, "
    "testing_strategy STRING, deployment_considerations STRING, estimated_effort_hours STRING, "
    "risks_and_mitigations ARRAY<STRUCT<risk: STRING, mitigation: STRING, severity: STRING>>, "
    "success_metrics ARRAY<STRING>, confidence_score STRING")


def _typed_empty(field: str) -> Column:
    return F.array().cast(StructType.fromDDL(SOLUTION_ANALYSIS)[field].dataType.simpleString())


def _null_struct(field: str) -> Column:
    """``{}`` read back through the record type: a struct whose fields are all NULL."""
    dt = StructType.fromDDL(SOLUTION_ANALYSIS)[field].dataType
    return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in dt.fields])


def build_solution(df: DataFrame, response: str | None = "response", idea_id: str = "idea_id",
                   title: str = "title", domain: str = "domain", related: str = "related_topics",
                   ts: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """PRJ-6: Solution (extract + repair parse).  ``response=None`` = no responder (UDF-2):
    every row takes the deterministic fallback design."""
    if response is None:
        df = df.withColumn("_no_response", F.lit(None).cast("string"))
        response = "_no_response"
    d = _parse(df, response, "repair", SOLUTION_ANALYSIS)
    ok = F.col("_ok")
    t = F.coalesce(F.col(title), F.lit("Unknown"))
    dom = F.coalesce(F.col(domain), F.lit("unknown"))
    n_rel = F.coalesce(F.size(F.col(related)), F.lit(0)) if related in df.columns else F.lit(0)
    fb = SOLUTION_FALLBACK
    fb_topic = F.array(F.struct(
        F.concat(dom, F.lit("."), slug(t, keep_slash=True)).alias("name"),
        F.lit(6).alias("partitions"), F.lit(604800000).cast("bigint").alias("retention_ms"),
        F.concat(F.lit(fb["topic_description"].split("{")[0]), t).alias("description")))
    fb_infra = F.struct(F.lit(False).alias("compute_pool_required"),
                        F.lit(True).alias("ksqldb_cluster_required"),
                        F.array().cast(ARR).alias("connectors_required"),
                        F.lit(None).cast("double").alias("estimated_csu_hours"),
                        F.lit(fb["ksqldb_notes"]).alias("additional_notes"))
    fb_gov = F.struct(F.lit(fb["owner"]).alias("owner"), dom.alias("domain"),
                      F.lit(fb["classification"]).alias("classification"),
                      F.lit(fb["retention_policy"]).alias("retention_policy"),
                      F.array(dom, F.lit(fb["tag"])).alias("tags"))
    empty_infra = _null_struct("infrastructure_requirements")
    empty_gov = _null_struct("data_governance")
    ts = ts if ts is not None else F.current_timestamp()
    approach = F.format_string(fb["approach"].replace("{n}", "%d"), n_rel)

    def arr(field):
        return F.coalesce(_g(field), _typed_empty(field))

    return d.select(
        *keep, iso_utc(ts).alias("timestamp"),
        record_id(idea_id, prefix="solution-").alias("solution_id"),
        F.col(idea_id).alias("idea_id"), F.col(title).alias("idea_title"),
        _pick(ok, _txt("technical_approach", ""), approach).alias("technical_approach"),
        _pick(ok, _txt("processing_engine", "KSQLDB"), F.lit(fb["engine"])).alias("processing_engine"),
        _pick(ok, _txt("processing_rationale", ""), F.lit(fb["rationale"])).alias("processing_rationale"),
        _pick(ok, arr("new_topics"), fb_topic).alias("new_topics"),
        _pick(ok, arr("schemas"), _typed_empty("schemas")).alias("schemas"),
        _pick(ok, arr("query_specifications"), _typed_empty("query_specifications")).alias("query_specifications"),
        _pick(ok, F.coalesce(_g("infrastructure_requirements"), empty_infra), fb_infra)
        .alias("infrastructure_requirements"),
        _pick(ok, F.coalesce(_g("data_governance"), empty_gov), fb_gov).alias("data_governance"),
        _pick(ok, arr("api_specifications"), _typed_empty("api_specifications")).alias("api_specifications"),
        _pick(ok, _txt("testing_strategy", ""), F.lit(fb["testing"])).alias("testing_strategy"),
        _pick(ok, _txt("deployment_considerations", ""), F.lit(fb["deployment"]))
        .alias("deployment_considerations"),
        _pick(ok, _num("estimated_effort_hours", 40.0), F.lit(40.0)).alias("estimated_effort_hours"),
        _pick(ok, arr("risks_and_mitigations"), _typed_empty("risks_and_mitigations")).alias("risks_and_mitigations"),
        _pick(ok, _arr("success_metrics"), _lit_arr(fb["metric"])).alias("success_metrics"),
        _pick(ok, _num("confidence_score", 0.7), F.lit(0.5)).alias("confidence_score"),
        F.lit("PENDING_APPROVAL").alias("status"))


# --------------------------------------------------------- implementation

# --- fixed values: fallback artifact templates (one Terraform block per new topic) ---
TF_HEADER = "# %s Data Product\n# Auto-generated by Implementation Agent\n\n"
TF_TOPIC_BLOCK = (
    'resource "confluent_kafka_topic" "%s" {\n'
    "  kafka_cluster {\n"
    "    id = confluent_kafka_cluster.datagen_cluster.id\n"
    "  }\n"
    "\n"
    "  rest_endpoint = confluent_kafka_cluster.datagen_cluster.rest_endpoint\n"
    "\n"
    '  topic_name       = "%s"\n'
    "  partitions_count = %d\n"
    "\n"
    "  config = {\n"
    '    "cleanup.policy" = "delete"\n'
    '    "retention.ms"   = "%d"\n'
    "  }\n"
    "\n"
    "  credentials {\n"
    "    key    = confluent_api_key.cluster_admin_api_key.id\n"
    "    secret = confluent_api_key.cluster_admin_api_key.secret\n"
    "  }\n"
    "}\n\n")
README_TEMPLATE = ("# %s\n\nAuto-generated data product.\n\n## Topics\n\n%s\n\n## Deployment\n\n"
                   "```bash\ncd terraform\nterraform apply\n```\n")
IMPL = {"step": "Apply Terraform changes", "command": "cd terraform && terraform apply",
        "duration": "10 minutes", "rollback": "terraform destroy",
        "validation": "Verify topics in Confluent Cloud UI", "cost_component": "Kafka topics",
        "monthly_usd": 50.0, "agent_version": "1.0.0", "base_branch": "main"}


def _json_list_indent2(names: Column) -> Column:
    """``json.dumps(list_of_names, indent=2)``: '[]' or '[\\n  "a",\\n  "b"\\n]'."""
    quoted = F.transform(names, lambda n: F.when(n.isNull(), F.lit("null"))
                         .otherwise(F.to_json(F.array(n)).substr(F.lit(2), F.length(F.to_json(F.array(n))) - 2)))
    return F.when(F.size(names) == 0, F.lit("[]")).otherwise(
        F.concat(F.lit("[\n  "), F.array_join(quoted, ",\n  "), F.lit("\n]")))


def build_implementation(solutions: DataFrame, ts: Column | None = None) -> DataFrame:
    """PRJ-7: fallback implementation of each solution — Terraform text with one block per
    new topic, README, resources, PR info, plan, cost and metadata (no code generator)."""
    s = solutions
    title = F.coalesce(F.col("idea_title"), F.lit("Unknown"))
    domain = F.coalesce(F.col("data_governance.domain"), F.lit("unknown"))
    topics = F.coalesce(F.col("new_topics"), F.array().cast(
        "array<struct<name:string,partitions:int,retention_ms:bigint,description:string>>"))
    blocks = F.transform(topics, lambda t: F.format_string(
        TF_TOPIC_BLOCK, safe_ident(F.coalesce(t["name"], F.lit("unknown"))),
        F.coalesce(t["name"], F.lit("unknown")), F.coalesce(t["partitions"], F.lit(6)),
        F.coalesce(t["retention_ms"], F.lit(604800000).cast("bigint"))))
    terraform = F.concat(F.format_string(TF_HEADER, title), F.array_join(blocks, ""))
    readme = F.format_string(README_TEMPLATE, title,
                             _json_list_indent2(F.transform(topics, lambda t: t["name"])))
    s_title = slug(title, keep_slash=True)
    ts = ts if ts is not None else F.current_timestamp()
    lines = F.size(F.split(terraform, "\n", -1)) + F.size(F.split(readme, "\n", -1))
    return s.select(
        iso_utc(ts).alias("timestamp"),
        record_id("solution_id", prefix="impl-").alias("implementation_id"),
        "solution_id", "idea_id", title.alias("idea_title"),
        F.array(
            F.struct(F.concat(F.lit("terraform/data-products/"), domain, F.lit("-"), s_title, F.lit(".tf")).alias("path"),
                     F.lit("TERRAFORM").alias("type"), terraform.alias("content"),
                     F.concat(F.lit("Terraform configuration for "), title).alias("description")),
            F.struct(F.concat(F.lit("docs/data-products/"), s_title, F.lit("-README.md")).alias("path"),
                     F.lit("DOCUMENTATION").alias("type"), readme.alias("content"),
                     F.concat(F.lit("Documentation for "), title).alias("description"))).alias("artifacts"),
        F.transform(topics, lambda t: F.struct(
            F.lit("confluent_kafka_topic").alias("resource_type"),
            safe_ident(F.coalesce(t["name"], F.lit(""))).alias("resource_name"),
            F.coalesce(t["description"], F.lit("")).alias("description"))).alias("terraform_resources"),
        F.struct(F.concat(F.lit("feat/data-product-"), s_title).alias("branch_name"),
                 F.concat(F.lit("Add "), title, F.lit(" Data Product")).alias("title"),
                 F.concat(F.lit("Auto-generated implementation for "), title, F.lit(" data product."))
                 .alias("description"),
                 F.lit(IMPL["base_branch"]).alias("base_branch"), F.array().cast(ARR).alias("labels"),
                 F.lit(None).cast("string").alias("url")).alias("pull_request"),
        F.struct(F.array(F.struct(F.lit(1).alias("order"), F.lit(IMPL["step"]).alias("description"),
                                  F.lit(IMPL["command"]).alias("command"),
                                  F.lit(IMPL["duration"]).alias("estimated_duration"))).alias("steps"),
                 F.lit(IMPL["rollback"]).alias("rollback_procedure"),
                 F.array(F.lit(IMPL["validation"])).alias("validation_steps")).alias("deployment_plan"),
        F.struct(readme.alias("readme_content"), F.array().cast(ARR).alias("usage_examples"),
                 F.lit("").alias("api_documentation")).alias("documentation"),
        F.struct(F.lit(IMPL["monthly_usd"]).alias("monthly_usd"),
                 F.array(F.struct(F.lit(IMPL["cost_component"]).alias("component"),
                                  F.lit(IMPL["monthly_usd"]).alias("monthly_usd"))).alias("breakdown"))
        .alias("estimated_cost"),
        F.array().cast("array<struct<name:string,description:string,test_type:string>>").alias("test_plan"),
        F.struct(F.lit(IMPL["agent_version"]).alias("agent_version"),
                 F.lit(0.0).alias("generation_time_seconds"), F.lit(2).alias("files_generated"),
                 lines.alias("total_lines_of_code")).alias("metadata"),
        F.lit(0.5).alias("confidence_score"), F.lit("GENERATED").alias("status"))


# ----------------------------------------------------------------- prompts


def render_prompts(df: DataFrame, template: str, args: list[Column], system: str = "") -> DataFrame:
    """PRJ-12: one request per record — ``template`` is a printf format over ``args``
    (use ``to_json`` for arrays, ``format_number`` for money).  System text and
    prompt are separate named columns (SURVEY T15)."""
    return df.select("*", F.lit(system).alias("system"),
                     F.format_string(template, *args).alias("prompt"))
