"""PIPE-1: the stage chain as plain composition of DataFrame functions.

monitoring → current state → ideas → review → scope/time/cost → decision → review →
solution → review → implementation.  Each stage's output is written as a table under
``out`` (so a lost executor recomputes from the last written stage, not from the
start); a stage runs only when its input has rows; ``skip`` names stages to leave out.
"""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tessera.operators import evaluate as E
from tessera.operators import records as R
from tessera.operators import review as RV
from tessera.operators.respond import respond
from tessera.operators.snapshot import build_snapshot

STAGES = ["monitoring", "ideas", "idea_review", "scope", "time", "cost", "decision", "decision_review",
          "solution", "solution_review", "implementation"]


def _save(spark: SparkSession, df: DataFrame, out: str, name: str) -> tuple[DataFrame, int]:
    """The written stage and its number of rows, counted while it is written."""
    seen = Observation(name)
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").parquet(f"{out}/{name}")
    return spark.read.parquet(f"{out}/{name}"), seen.get["rows"]


def idea_prompts(state: DataFrame) -> DataFrame:
    """One request for ideas from the current state (counts and summary of the platform)."""
    return state.select(F.lit("state").alias("id"), F.format_string(
        "Suggest data products for cluster %s: %d topics in %d domains, %d consumer groups. %s",
        F.col("deployment.cluster_id"), F.col("deployment.total_topics"), F.col("deployment.domain_count"),
        F.col("usage.consumer_groups"), F.col("summary")).alias("prompt"))


def run_pipeline(spark: SparkSession, idea_responses: DataFrame | None, out: str,
                 responder: Callable | None = None, idea_actions: DataFrame | None = None,
                 decision_actions: DataFrame | None = None,
                 solution_actions: DataFrame | None = None, skip: set[str] = frozenset(),
                 deployment: DataFrame | None = None, usage: DataFrame | None = None,
                 metrics: DataFrame | None = None) -> dict:
    """Run the chain; returns {stage: row count} (AGG-15).

    With ``deployment``, ``usage`` or ``metrics`` (summary rows of the monitoring stages) the
    chain starts at monitoring: they become the current state.  ``idea_responses`` has
    (id, response): model output holding {"ideas": [...]}; without it the responder is
    asked for ideas with the current state.  Actions tables have (id, action) and default
    to 'approve everything'; a review named in ``skip`` approves everything too, any
    other skipped stage ends the chain.

    Both sides of every join hold one row an idea, so all are sort-merge joins: Spark takes the
    64-character ids of a written stage for 20 bytes and would broadcast them through the driver."""
    counts: dict[str, int] = {}

    def gate(name: str, rows: int) -> bool:
        return (name not in skip or name.endswith("_review")) and rows > 0

    def actions(name: str, given: DataFrame | None, items: DataFrame) -> DataFrame:
        if given is None or name in skip:
            return items.select("id", F.lit("a").alias("action"))
        return given

    if any(x is not None for x in (deployment, usage, metrics)):
        state, counts["monitoring"] = _save(spark, build_snapshot(spark, deployment, usage, metrics), out, "current_state")
        if idea_responses is None:
            idea_responses = respond(idea_prompts(state), responder, "id").select("id", "response")
    if idea_responses is None:
        return counts
    idea_responses, _ = _save(spark, idea_responses, out, "idea_responses")
    ideas = R.explode_ideas(idea_responses, keep=("id",))
    ideas = R.build_raw_ideas(ideas.withColumn("idea_key", F.concat_ws("-", "id", "idea_no")),
                              "idea", id_cols=("idea_key",))
    ideas, counts["ideas"] = _save(spark, ideas, out, "ideas")
    if not gate("idea_review", counts["ideas"]):
        return counts
    items = ideas.withColumnRenamed("idea_id", "id")
    reviewed = RV.apply_actions(items, actions("idea_review", idea_actions, items), "idea").withColumn("status", F.col("new_status"))
    approved, counts["idea_review"] = _save(spark, reviewed.filter(F.col("status") == "APPROVED")
                                            .withColumnRenamed("id", "idea_id"), out, "approved_ideas")
    if not gate("scope", counts["idea_review"]):
        return counts

    def answers(prompts: DataFrame, kind: str) -> DataFrame:
        # answers are written before they are parsed: a lost executor does not ask again
        resp = respond(prompts, responder, "idea_id").withColumnRenamed("id", "idea_id")
        return _save(spark, resp, out, f"{kind}_responses")[0]

    def evaluate(kind: str, builder):
        prompts = R.render_prompts(approved, f"Challenge the {kind} of idea %s: %s",
                                   [F.col("idea_id"), F.col("title")])
        resp = answers(prompts, kind)
        rows = builder(approved.join(resp.hint("merge"), "idea_id"), response="response")
        return _save(spark, rows, out, kind)

    scope, counts["scope"] = evaluate("scope", R.build_scope)
    time_, counts["time"] = evaluate("time", R.build_time) if "time" not in skip else (None, 0)
    cost, counts["cost"] = evaluate("cost", R.build_cost) if "cost" not in skip else (None, 0)
    if time_ is None or cost is None or not gate("decision", counts["scope"]):
        return counts
    ids = (scope.select("idea_id", F.col("challenge_id").alias("scope_challenge_id"), "idea_title")
           .join(time_.select("idea_id", F.col("challenge_id").alias("time_challenge_id")).hint("merge"), "idea_id")
           .join(cost.select("idea_id", F.col("challenge_id").alias("cost_challenge_id")).hint("merge"), "idea_id"))
    prompts = R.render_prompts(ids, "Decide on idea %s", [F.col("idea_id")])
    resp = answers(prompts, "decision")
    decisions, counts["decision"] = _save(spark, R.build_decision(ids.join(resp.hint("merge"), "idea_id"), title="idea_title"),
                                          out, "decisions")
    if not gate("decision_review", counts["decision"]):
        return counts
    d_items = decisions.withColumnRenamed("decision_id", "id")
    d_rev = RV.apply_actions(d_items, actions("decision_review", decision_actions, d_items), "decision").withColumn("status", F.col("new_status"))
    d_ok, counts["decision_review"] = _save(spark, d_rev.filter(F.col("status") == "APPROVED"), out, "approved_decisions")
    if not gate("solution", counts["decision_review"]):
        return counts
    ctx = E.join_decision_idea(d_ok.select("idea_id"), approved.select(
        "idea_id", "title", "domain", "related_topics"), "idea_id")
    prompts = R.render_prompts(ctx, "Design a data product for %s", [F.col("title")])
    resp = answers(prompts, "solution")
    solutions, counts["solution"] = _save(spark, R.build_solution(ctx.join(resp.hint("merge"), "idea_id")), out, "solutions")
    if not gate("solution_review", counts["solution"]):
        return counts
    s_items = solutions.withColumn("id", F.col("solution_id"))
    s_rev = RV.apply_actions(s_items, actions("solution_review", solution_actions, s_items), "solution").withColumn("status", F.col("new_status"))
    s_ok, counts["solution_review"] = _save(
        spark, s_rev.filter(F.col("status") == "APPROVED").drop("id", "new_status", "written"), out, "approved_solutions")
    if not gate("implementation", counts["solution_review"]):
        return counts
    _, counts["implementation"] = _save(spark, R.build_implementation(s_ok), out, "implementations")
    return counts

