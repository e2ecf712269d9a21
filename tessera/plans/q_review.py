"""Review lifecycle queries over V2 with actions and edits derived from the data."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import review as RV
from tessera.operators.log import first_per_key, latest_per_key
from tessera.plans.registry import query
from tessera.plans.views import ACTION_OF_PRIORITY
from tessera.schemas import IDEA_COMPLEXITY

EDIT_THRESHOLD = 250000.0   # an edit on a high-value item is approved in the same step


def _items(v):
    return latest_per_key(v.v2, "key", value="status").select(
        F.col("key").alias("id"), "status", "domain", "score", "ts")


def _actions(v, third: str):
    """One review action per item, from the item's first version: 1-URGENT a, 2-HIGH r,
    3-MEDIUM edit/defer/revise, 4-NOT SPECIFIED skip, 5-LOW none."""
    f = first_per_key(v.v2, "key", value="status")
    m = F.create_map(*[x for k, a in ACTION_OF_PRIORITY.items() for x in (F.lit(k), F.lit(a))])
    act = F.element_at(m, F.col("domain"))
    if third == "idea":
        act = F.when(act == "e", F.when(F.col("score") > EDIT_THRESHOLD, F.lit("e+a")).otherwise("e")).otherwise(act)
    else:
        act = F.when(act == "e", F.lit(third)).otherwise(act)
    return f.select(F.col("key").alias("id"), act.alias("action"),
                    F.when(act == "r", F.lit("low value")).alias("reason"))


BASE = """items AS (SELECT key AS id, arg_max(status, "offset") AS status, arg_max(domain, "offset") AS domain
    FROM v2 GROUP BY key),
fv AS (SELECT key, arg_min(domain, "offset") AS pr, arg_min(score, "offset") AS sc FROM v2 GROUP BY key),
acts AS (SELECT key AS id, CASE pr WHEN '1-URGENT' THEN 'a' WHEN '2-HIGH' THEN 'r'
    WHEN '3-MEDIUM' THEN {third} WHEN '4-NOT SPECIFIED' THEN 's' END AS action FROM fv),
j AS (SELECT items.*, acts.action FROM items LEFT JOIN acts USING (id))"""

IDEA_SQL = BASE.replace("{third}", "CASE WHEN sc > 250000.0 THEN 'e+a' ELSE 'e' END") + """,
r AS (SELECT *, coalesce((status IS NULL OR status NOT IN ('APPROVED', 'REJECTED')) AND action IN ('a', 'r', 'e', 'e+a'), FALSE)
    AS written FROM j),
ideas AS (SELECT id, status, domain, written,
  CASE WHEN NOT written THEN status WHEN action IN ('a', 'e+a') THEN 'APPROVED' WHEN action = 'r' THEN 'REJECTED'
       ELSE 'REFINED' END AS new_status,
  CASE WHEN written AND action = 'r' THEN 'low value' END AS rejection_reason FROM r)"""


@query("apply_idea_actions", "JN-7 SCL-22", views=("v2",), sql=f"""
WITH {IDEA_SQL}
SELECT id, status, new_status, written, rejection_reason FROM ideas
""")
def apply_idea_actions(v):
    """Idea review: approve / reject (with reason) / edit (→ REFINED, or APPROVED when the
    edit is approved too) / skip; decided ideas never change."""
    out = RV.apply_actions(_items(v), _actions(v, "idea"), "idea")
    return out.select("id", "status", "new_status", "written", "rejection_reason")


@query("apply_decision_actions", "JN-7", views=("v2",), sql="""
WITH """ + BASE.replace("{third}", "'d'") + """
SELECT id, status,
  CASE WHEN status = 'PENDING_APPROVAL' AND action IS NOT NULL THEN
    CASE action WHEN 'a' THEN 'APPROVED' WHEN 'r' THEN 'REJECTED' ELSE 'DEFERRED' END ELSE status END AS new_status,
  coalesce(status = 'PENDING_APPROVAL' AND action IS NOT NULL, FALSE) AS written
FROM j
""")
def apply_decision_actions(v):
    """Decision review: approve / reject / defer; skip also writes DEFERRED."""
    out = RV.apply_actions(_items(v), _actions(v, "d"), "decision")
    return out.select("id", "status", "new_status", F.coalesce("written", F.lit(False)).alias("written"))


@query("apply_solution_actions", "JN-7", views=("v2",), sql="""
WITH """ + BASE.replace("{third}", "'v'") + """
SELECT id, status,
  CASE WHEN status = 'PENDING_APPROVAL' AND action IN ('a', 'r', 'v') THEN
    CASE action WHEN 'a' THEN 'APPROVED' WHEN 'r' THEN 'REJECTED' ELSE 'REVISION_REQUESTED' END ELSE status END AS new_status,
  coalesce(status = 'PENDING_APPROVAL' AND action IN ('a', 'r', 'v'), FALSE) AS written
FROM j
""")
def apply_solution_actions(v):
    """Solution review: approve / reject / request revision; skip leaves the row unchanged."""
    out = RV.apply_actions(_items(v), _actions(v, "v"), "solution")
    return out.select("id", "status", "new_status", F.coalesce("written", F.lit(False)).alias("written"))


@query("lifecycle_counts", "AGG-10", views=("v2",), sql=f"""
WITH {IDEA_SQL}
SELECT count(*) FILTER (WHERE new_status = 'APPROVED') AS approved,
  count(*) FILTER (WHERE new_status = 'REJECTED') AS rejected,
  count(*) FILTER (WHERE new_status = 'REFINED') AS modified,
  count(*) FILTER (WHERE new_status = 'RAW') AS remaining FROM ideas
""")
def lifecycle_counts_q(v):
    """Counts by status after the idea review."""
    out = RV.apply_actions(_items(v), _actions(v, "idea"), "idea")
    return RV.lifecycle_counts(out, "new_status")


@query("action_counts", "AGG-10", views=("v2",), sql="""
WITH """ + BASE.replace("{third}", "CASE WHEN sc > 250000.0 THEN 'e+a' ELSE 'e' END") + """
SELECT count(*) FILTER (WHERE action IN ('a', 'e+a')) AS approved, count(*) FILTER (WHERE action = 'r') AS rejected,
  count(*) FILTER (WHERE action IN ('e', 'e+a')) AS modified FROM acts
""")
def action_counts_q(v):
    """Counts of review actions (an edited-then-approved idea is in both totals, T22)."""
    return RV.action_counts(_actions(v, "idea"))


@query("approval_summary", "AGG-11", views=("v2",), sql="""
WITH """ + BASE.replace("{third}", "'v'") + """,
s AS (SELECT CASE WHEN status = 'PENDING_APPROVAL' AND action IN ('a', 'r', 'v') THEN
    CASE action WHEN 'a' THEN 'APPROVED' WHEN 'r' THEN 'REJECTED' ELSE 'REVISION_REQUESTED' END ELSE status END AS st FROM j)
SELECT count(*) FILTER (WHERE st = 'APPROVED') AS approved, count(*) FILTER (WHERE st = 'REJECTED') AS rejected,
  count(*) FILTER (WHERE st = 'REVISION_REQUESTED') AS revision_requested FROM s
""")
def approval_summary_q(v):
    """Solution review totals."""
    out = RV.apply_actions(_items(v), _actions(v, "v"), "solution")
    return RV.approval_summary(out, "new_status")


@query("approved_listing", "AGG-12", views=("v2",), sql=f"""
WITH {IDEA_SQL}
SELECT id, 'Idea ' || id || ' (' || domain || ')' AS listing FROM ideas WHERE new_status = 'APPROVED'
""")
def approved_listing_q(v):
    """Approved idea titles with their domain."""
    out = RV.apply_actions(_items(v), _actions(v, "idea"), "idea") \
        .withColumn("title", F.concat(F.lit("Idea "), F.col("id")))
    return RV.approved_listing(out, status="new_status").select("id", "listing")


@query("apply_edits", "PRJ-14 SCL-10", views=("v2",), sql="""
WITH items AS (SELECT key AS id, 'Idea ' || key AS title, arg_max(domain, "offset") AS domain FROM v2 GROUP BY key),
e AS (SELECT CAST(c_custkey AS VARCHAR) AS id, CASE WHEN c_acctbal > 5000 THEN c_name END AS title,
  CASE WHEN c_acctbal > 0 THEN c_mktsegment END AS domain,
  CASE c_nationkey % 4 WHEN 0 THEN 'low' WHEN 1 THEN ' High ' WHEN 2 THEN 'very_high' ELSE 'extreme' END AS complexity,
  c_mktsegment || ', ' || c_name || ' ,, x' AS topics FROM customer)
SELECT id, coalesce(e.title, items.title) AS title, coalesce(e.domain, items.domain) AS domain,
  CASE WHEN upper(trim(complexity)) IN ('LOW', 'MEDIUM', 'HIGH', 'VERY_HIGH') THEN upper(trim(complexity)) ELSE 'MEDIUM' END
    AS estimated_complexity,
  CASE WHEN topics IS NULL THEN 0 ELSE 4 END AS related_topics,
  CASE WHEN topics IS NULL THEN NULL ELSE trim(split_part(topics, ',', 2)) END AS second_topic
FROM items LEFT JOIN e USING (id)
""")
def apply_edits_q(v):
    """Edits (from customers) overwrite only the given fields; invalid complexity ignored."""
    items = latest_per_key(v.v2, "key", value="status").select(
        F.col("key").alias("id"), F.concat(F.lit("Idea "), F.col("key")).alias("title"),
        F.lit(None).cast("string").alias("description"), "domain",
        F.lit("MEDIUM").alias("estimated_complexity"), F.array().cast("array<string>").alias("related_topics"))
    c = v.t.customer
    comp = F.element_at(F.array(F.lit("low"), F.lit(" High "), F.lit("very_high"), F.lit("extreme")),
                        (c.c_nationkey % 4 + 1).cast("int"))
    edits = c.select(F.col("c_custkey").cast("string").alias("id"),
                     F.when(F.col("c_acctbal") > 5000, F.col("c_name")).alias("title"),
                     F.lit(None).cast("string").alias("description"),
                     F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment")).alias("domain"),
                     comp.alias("complexity"),
                     F.concat_ws(", ", "c_mktsegment", F.concat(F.col("c_name"), F.lit(" ,, x"))).alias("topics"))
    out = RV.apply_edits(items, edits, "id")
    return out.select("id", "title", "domain", "estimated_complexity",
                      F.size("related_topics").alias("related_topics"),
                      F.get(F.col("related_topics"), 1).alias("second_topic"))


@query("review_queue", "PRJ-13 WIN-8 SCL-11 SCL-16", views=("v2",), sql="""
WITH q AS (SELECT key AS id, arg_max(status, "offset") AS status, arg_max(domain, "offset") AS domain,
                  arg_max(ts, "offset") AS ts FROM v2 GROUP BY key HAVING arg_max(status, "offset") = 'PENDING_APPROVAL'),
n AS (SELECT row_number() OVER (ORDER BY ts, id) AS item_no, count(*) OVER () AS total, * FROM q)
SELECT id, item_no, '[' || item_no || '/' || total || ']' AS progress,
  CASE WHEN length('Pending item ' || id || ' in ' || domain || ' awaiting review') > 50
    THEN left('Pending item ' || id || ' in ' || domain || ' awaiting review', 50) || '...'
    ELSE 'Pending item ' || id || ' in ' || domain || ' awaiting review' END AS title_preview,
  domain || ', ' || status AS tags, 2 AS tags_count
FROM n
""")
def review_queue_q(v):
    """Pending items as a numbered review list with previews and joined tag lists."""
    items = latest_per_key(v.v2, "key", value="status").filter(F.col("status") == "PENDING_APPROVAL") \
        .select(F.col("key").alias("id"), "ts",
                F.concat(F.lit("Pending item "), F.col("key"), F.lit(" in "), F.col("domain"),
                         F.lit(" awaiting review")).alias("title"),
                F.array("domain", "status").alias("tag_list"))
    return RV.review_queue(items, ["ts", "id"], key="id", lists={"tags": "tag_list"})


@query("by_risk", "SRT-9", views=("v2",), sql="""
WITH l AS (SELECT key, arg_max(domain, "offset") AS domain, arg_max(score, "offset") AS score FROM v2 GROUP BY key),
r AS (SELECT key, regexp_extract(domain, '-(.*)$', 1) AS level, round(score, 2) AS score,
  CAST(coalesce(list_position(['LOW', 'MEDIUM', 'HIGH', 'VERY_HIGH'], regexp_extract(domain, '-(.*)$', 1)), 0) AS INTEGER) AS rank FROM l)
SELECT * FROM r
""")
def by_risk(v):
    """All items ordered by enum rank of their level (rank order ≠ alphabetical), then score."""
    items = latest_per_key(v.v2, "key", value="status").select(
        "key", F.regexp_extract("domain", "-(.*)$", 1).alias("level"), F.round("score", 2).alias("score"))
    r = RV.by_rank(items, "level", IDEA_COMPLEXITY)
    return r.orderBy(F.col("rank").desc(), F.col("score").desc(), "key")
