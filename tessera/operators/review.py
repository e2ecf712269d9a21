"""Review lifecycle: actions → new statuses, edits, review queues and counts
(JN-7, PRJ-13, PRJ-14, AGG-10, AGG-11, AGG-12, SRT-9).

The reference collects these decisions at a terminal; here they arrive as a table
of actions/edits keyed by item id and are applied with one left join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import csv_list, enum_rank, join_list, normalise_choice, preview
from tessera.operators.sequence import number_rows
from tessera.schemas import IDEA_COMPLEXITY

# --- fixed values: review state machines (action → new status; None = unchanged, not written) ---
IDEA_MACHINE = {"a": "APPROVED", "r": "REJECTED", "e": "REFINED", "e+a": "APPROVED", "s": None}
DECISION_MACHINE = {"a": "APPROVED", "r": "REJECTED", "d": "DEFERRED", "s": "DEFERRED"}
SOLUTION_MACHINE = {"a": "APPROVED", "r": "REJECTED", "v": "REVISION_REQUESTED", "s": None}
MACHINES = {"idea": IDEA_MACHINE, "decision": DECISION_MACHINE, "solution": SOLUTION_MACHINE}
# statuses an item must be in for an action to apply
OPEN_STATUS = {"idea": None, "decision": ["PENDING_APPROVAL"], "solution": ["PENDING_APPROVAL"]}
DONE_IDEA = ["APPROVED", "REJECTED"]


def latest_action(actions: DataFrame, key: str = "id", order: str = "offset") -> DataFrame:
    """One action per item: the newest (aggregation, combines map-side)."""
    rest = [c for c in actions.columns if c != key]
    return actions.groupBy(key).agg(F.max_by(F.struct(*rest), F.col(order)).alias("_a")) \
                  .select(key, "_a.*")


def apply_actions(items: DataFrame, actions: DataFrame, machine: str, key: str = "id",
                  status: str = "status", action: str = "action",
                  reason: str | None = "reason", order: str = "offset") -> DataFrame:
    """JN-7: new status per item from its action; ``written`` marks rows to publish.

    Ideas: a→APPROVED, r→REJECTED (+reason), e→REFINED, e+a→APPROVED, s→unchanged;
    ideas already APPROVED/REJECTED never change.  Decisions: a/r/d, skip→DEFERRED.
    Solutions: a/r/v→REVISION_REQUESTED, s→unchanged.  Other statuses: unchanged.
    One action counts per item: the newest by ``order`` (without that column, the greatest
    action letter, so a rerun decides alike).
    """
    m = MACHINES[machine]
    by = order if order in actions.columns else action
    act = latest_action(actions, key, by).select(key, F.col(action).alias("_act"),
                         *( [F.col(reason).alias("_reason")] if reason and reason in actions.columns else []))
    # both sides grow with the items: not broadcast, whatever size Spark takes them for
    j = items.join(act.hint("merge"), key, "left")
    a = normalise_choice(F.col("_act"))
    new: Column = F.lit(None).cast("string")
    for k, s in m.items():
        if s is not None:
            new = F.when(a == k, F.lit(s)).otherwise(new)
    cur = F.col(status)
    if machine == "idea":
        open_ = ~cur.isin(DONE_IDEA) | cur.isNull()
    else:
        open_ = cur.isin(OPEN_STATUS[machine])
    changed = open_ & new.isNotNull()
    out = j.withColumn("new_status", F.when(changed, new).otherwise(cur)) \
           .withColumn("written", changed)
    if machine == "idea":
        rr = F.col("_reason") if "_reason" in j.columns else F.lit(None).cast("string")
        out = out.withColumn("rejection_reason",
                             F.when(changed & (F.col("new_status") == "REJECTED"), rr))
    return out.drop("_act", "_reason")


def apply_edits(items: DataFrame, edits: DataFrame, key: str = "id") -> DataFrame:
    """PRJ-14: overwrite title/description/domain/complexity/topics only where an edit is
    given; complexity only when it is a valid symbol (after upper-casing); topics from a
    comma list (empty items kept, as the edit prompt does)."""
    e = edits.select(key, *[F.col(c).alias("_e_" + c) for c in edits.columns if c != key])
    j = items.join(e, key, "left")
    cx = F.upper(F.trim(F.col("_e_complexity"))) if "_e_complexity" in j.columns else F.lit(None)
    sets = {
        "title": F.coalesce(F.nullif(F.col("_e_title"), F.lit("")), F.col("title")),
        "description": F.coalesce(F.nullif(F.col("_e_description"), F.lit("")), F.col("description")),
        "domain": F.coalesce(F.nullif(F.col("_e_domain"), F.lit("")), F.col("domain")),
        "estimated_complexity": F.when(cx.isin(IDEA_COMPLEXITY), cx).otherwise(F.col("estimated_complexity")),
        "related_topics": F.when(F.coalesce(F.col("_e_topics"), F.lit("")) != "",
                                 csv_list(F.col("_e_topics"), drop_empty=False))
                           .otherwise(F.col("related_topics")),
    }
    out = j
    for c, expr in sets.items():
        out = out.withColumn(c, expr)
    return out.drop(*[c for c in out.columns if c.startswith("_e_")])


def review_queue(items: DataFrame, order: list[str], key: str = "id", title: str = "title",
                 lists: dict[str, str] | None = None, preview_len: int = 50) -> DataFrame:
    """PRJ-13 + WIN-8: a flat reviewable view — item number, '[i/n]', title preview,
    joined lists and their item counts (numbered inside ranges of the first order column)."""
    n = items.agg(F.count(F.lit(1))).scalar()
    q = number_rows(items, order, name="item_no")
    cols = [F.col(key), F.col("item_no"),
            F.concat(F.lit("["), F.col("item_no").cast("string"), F.lit("/"), n.cast("string"),
                     F.lit("]")).alias("progress"),
            preview(F.col(title), preview_len, ellipsis=True).alias("title_preview")]
    for name, arr in (lists or {}).items():
        cols += [join_list(F.col(arr)).alias(name), F.size(F.col(arr)).alias(name + "_count")]
    return q.select(*cols)


def decision_view(decisions: DataFrame, order: list[str]) -> DataFrame:
    """PRJ-13 for decisions: number, '[i/n]', title, recommendation, risk, confidence as a
    percentage, summary, and findings, conditions and alternatives with their counts."""
    n = decisions.agg(F.count(F.lit(1))).scalar()
    q = number_rows(decisions, order, name="item_no")
    lists = [("findings", "key_findings"), ("conditions", "conditions"), ("alternatives", "alternative_approaches")]
    return q.select(
        "decision_id", "idea_id", "item_no", _progress(n), F.col("idea_title").alias("title"), "status",
        "recommendation", "overall_risk", _percent("confidence_score"), "summary",
        *[c for name, arr in lists for c in (F.array_join(arr, "\n").alias(name),
                                             F.coalesce(F.size(arr), F.lit(0)).alias(name + "_count"))],
        "detailed_reasoning")


def solution_view(solutions: DataFrame, order: list[str]) -> DataFrame:
    """PRJ-13 for solutions: number, '[i/n]', title, approach, engine, topics, schemas, queries
    and connectors with their counts, effort, risks and metrics, governance fields."""
    n = solutions.agg(F.count(F.lit(1))).scalar()
    q = number_rows(solutions, order, name="item_no")
    topic = F.transform("new_topics", lambda t: F.concat(
        t["name"], F.lit(" ("), t["partitions"].cast("string"), F.lit(" partitions)")))
    connectors = F.col("infrastructure_requirements.connectors_required")
    gov = [F.coalesce(F.col(f"data_governance.{f}"), F.lit("N/A")).alias(f)
           for f in ("owner", "domain", "classification", "retention_policy")]

    def count(c, name):
        return F.coalesce(F.size(c), F.lit(0)).alias(name)

    return q.select(
        "solution_id", "idea_id", "item_no", _progress(n), F.col("idea_title").alias("title"), "status",
        _percent("confidence_score"), "technical_approach", "processing_engine",
        F.array_join(topic, "\n").alias("topics"), count(F.col("new_topics"), "topics_count"),
        count(F.col("schemas"), "schemas_count"), count(F.col("query_specifications"), "queries_count"),
        join_list(connectors).alias("connectors"), count(connectors, "connectors_count"), *gov,
        "estimated_effort_hours", count(F.col("risks_and_mitigations"), "risks_count"),
        F.array_join("success_metrics", "\n").alias("metrics"))


def _progress(n: Column) -> Column:
    return F.concat(F.lit("["), F.col("item_no").cast("string"), F.lit("/"), n.cast("string"),
                    F.lit("]")).alias("progress")


def _percent(score: str) -> Column:
    return F.concat(F.round(F.col(score) * 100).cast("int").cast("string"), F.lit("%")).alias("confidence")


def lifecycle_counts(items: DataFrame, status: str = "status") -> DataFrame:
    """AGG-10: approved / rejected / modified (REFINED) / remaining (RAW)."""
    s = F.col(status)
    return items.agg(F.count_if(s == "APPROVED").alias("approved"),
                     F.count_if(s == "REJECTED").alias("rejected"),
                     F.count_if(s == "REFINED").alias("modified"),
                     F.count_if(s == "RAW").alias("remaining"))


def action_counts(actions: DataFrame, action: str = "action") -> DataFrame:
    """AGG-10 (actions variant, SURVEY T22): counts of the actions themselves."""
    a = normalise_choice(F.col(action))
    return actions.agg(F.count_if(a.isin("a", "e+a")).alias("approved"),
                       F.count_if(a == "r").alias("rejected"),
                       F.count_if(a.isin("e", "e+a")).alias("modified"))


def approval_summary(solutions: DataFrame, status: str = "status") -> DataFrame:
    """AGG-11: approved / rejected / revision requested."""
    s = F.col(status)
    return solutions.agg(F.count_if(s == "APPROVED").alias("approved"),
                         F.count_if(s == "REJECTED").alias("rejected"),
                         F.count_if(s == "REVISION_REQUESTED").alias("revision_requested"))


def approved_listing(items: DataFrame, title: str = "title", domain: str = "domain",
                     status: str = "status") -> DataFrame:
    """AGG-12: approved titles with their domain ('<title> (<domain>)')."""
    return items.filter(F.col(status) == "APPROVED").select(
        "*", F.concat(F.col(title), F.lit(" ("), F.col(domain), F.lit(")")).alias("listing"))


def by_rank(df: DataFrame, col: str, symbols: list[str], name: str = "rank") -> DataFrame:
    """SRT-9: enum rank column (declaration order, 0 = unknown) for ordering by severity."""
    return df.withColumn(name, enum_rank(F.col(col), symbols))
