"""FIXTURES §5.3–5.5: text rules, response repair, missing fields."""

import json

import pytest
from pyspark.sql import functions as F

from tessera.functions import jsontext as J
from tessera.functions import text as X
from tessera.operators import records as R


def one(spark, value, expr, ddl="x string"):
    return spark.createDataFrame([(value,)], ddl).select(expr.alias("r")).first()["r"]


@pytest.mark.parametrize("ns,expected", [("com.acme.x", "com"), ("gaming", "gaming"), (None, "unknown"), ("", "unknown")])
def test_domain_of(spark, ns, expected):
    assert one(spark, ns, X.domain_of(F.col("x"))) == expected


def test_topic_of(spark):
    assert one(spark, "orders-value", X.topic_of(F.col("x"))) == "orders"
    assert one(spark, "orders-key", X.topic_of(F.col("x"))) == "orders"
    assert one(spark, "my-keyboard-value", X.topic_of(F.col("x"))) == "myboard"
    assert one(spark, "my-keyboard-value", X.topic_of(F.col("x"), strict=True)) == "my-keyboard"


def test_slug_ident(spark):
    assert one(spark, "A/B Test Hub", X.slug(F.col("x"))) == "a-b-test-hub"
    assert one(spark, "A/B Test Hub", X.slug(F.col("x"), keep_slash=True)) == "a/b-test-hub"
    assert one(spark, "gaming.analytics.user-sessions", X.safe_ident(F.col("x"))) == "gaming_analytics_user_sessions"


def test_listing_and_csv(spark):
    from tessera.sources.listing import parse_listing

    df = spark.createDataFrame([("Kafka topics: a, b ,, c",)], "t string")
    assert [r["name"] for r in parse_listing(df, "t").orderBy("position").collect()] == ["a", "b", "c"]
    assert one(spark, "a, b ,, c", X.csv_list(F.col("x"), drop_empty=False)) == ["a", "b", "", "c"]
    none = spark.createDataFrame([("no marker here",)], "t string")
    assert parse_listing(none, "t").count() == 0


def test_lines_money(spark):
    assert one(spark, "one\ntwo\n", X.line_count(F.col("x"))) == 3
    assert one(spark, 500.0, X.annualise(F.col("x"), 1), "x double") == 6000.0
    assert one(spark, 500.0, X.annualise(F.col("x"), 5), "x double") == 30000.0
    assert one(spark, 1234.4, X.fmt_money(F.col("x")), "x double") == "1,234"
    assert one(spark, 0.85, X.fmt_pct(F.col("x")), "x double") == "85%"
    assert one(spark, 0.002, X.fmt_pct1(F.col("x")), "x double") == "0.2%"
    assert one(spark, 0.125, X.fmt_score(F.col("x")), "x double") == "0.12"   # Python rounds the tie to even
    assert one(spark, 0.5, X.fmt_score(F.col("x")), "x double") == "0.50"


# FIXTURES §5.4: (text, expected repair, expected object or None)
RESPONSES = [
    ("J1", '{"k": 1}', "as_is", {"k": 1}),
    ("J2", '```json\n{"k": 1}\n```', "as_is", {"k": 1}),
    ("J3", '```\n{"k": 1}\n```', "as_is", {"k": 1}),
    ("J4", '## Answer\n{"k": 1}', "as_is", {"k": 1}),
    ("J5", '{"k": 1}\nHope this helps', "as_is", {"k": 1}),
    ("J6", '{"k": 1,}', "trailing", {"k": 1}),
    ("J7", '{"k": 1\n "m": 2}', "commas", {"k": 1, "m": 2}),
    ("J8", '{"k": 1\n "m": 2,}', "both", {"k": 1, "m": 2}),
    ("J9", '{"k": 1, "m": [1, 2,]}', "trailing", {"k": 1, "m": [1, 2]}),
    ("J10", '{"k": "x\n"}', "none", None),
    ("J11", "{'k': 1}", "none", None),
    ("J12", "no json here", "none", None),
    ("J13", '```json\n{"k": 1}', "as_is", {"k": 1}),
    ("J14", '{"k": 1} and {"m": 2}', "none", None),
    ("J15", '{"s": "a,}", "k": 1,}', "trailing", {"s": "a}", "k": 1}),
    ("J16", "[1, 2]", "none", None),          # deviation: a record is required (T21)
    ("J17", '{"k": 1, "k": 2}', "as_is", {"k": 2}),
    ("J18", "", "none", None),
]


@pytest.mark.parametrize("case,text,repair,expected", RESPONSES)
def test_extract_and_repair(spark, case, text, repair, expected):
    df = spark.createDataFrame([(text,)], "text string")
    staged = J.with_repaired(J.with_extracted(df, "text", "obj"), "obj", "fixed", kind="kind").first()
    col_form = df.select(J.repair_json(J.extract_object(F.col("text"))).alias("fixed"),
                         J.repair_kind(J.extract_object(F.col("text"))).alias("kind")).first()
    for row in (staged, col_form):
        assert row["kind"] == repair, case
        if expected is None:
            assert row["fixed"] is None, case
        else:
            got = json.loads(row["fixed"], object_pairs_hook=lambda p: dict(p))
            assert got == expected, case


def test_parse_or_fallback_error(spark):
    df = spark.createDataFrame([("x" * 600,)], "text string")
    r = J.with_parsed(df, "text", "k int").first()
    assert r["parse_ok"] is False and r["parse_error"] == "Failed to parse or repair JSON"
    assert len(r["raw_response_preview"]) == 500


def test_strip_and_between(spark):
    assert one(spark, ' ```json\n{"a": 1}\n``` ', J.strip_fences(F.col("x"))) == '{"a": 1}'
    assert one(spark, 'text ```json {"a": 1}``` more', J.between_fences(F.col("x"))) == '{"a": 1}'
    assert one(spark, 'x ``` {"a": 1}', J.between_fences(F.col("x"))) == '{"a": 1}'
    assert one(spark, '  plain  ', J.between_fences(F.col("x"))) == "plain"


def test_missing_fields(spark):
    df = spark.createDataFrame([("i1", "T", "{}"), ("i2", "T", "nonsense")],
                               "idea_id string, title string, response string")
    ideas = R.build_raw_ideas(spark.createDataFrame([("{}",)], "idea string"), "idea").first()
    assert (ideas.title, ideas.description, ideas.domain, ideas.related_topics, ideas.reasoning,
            ideas.potential_users, ideas.estimated_complexity, ideas.confidence_score, ideas.status) == (
        "Untitled Idea", "No description provided", "unknown", [], "No reasoning provided", [],
        "MEDIUM", 0.5, "RAW")
    s = {r.idea_id: r for r in R.build_scope(df).collect()}
    assert (s["i1"].complexity_rating, s["i1"].scope_creep_risk, s["i1"].confidence_score, s["i1"].reasoning) == (
        "MODERATE", "MODERATE", 0.7, "")
    assert s["i2"].confidence_score == 0.5 and s["i2"].technical_challenges == ["Unable to parse detailed analysis"]
    t = {r.idea_id: r for r in R.build_time(df).collect()}["i1"]
    assert (t.estimated_duration_weeks, t.best_case_weeks, t.worst_case_weeks, t.schedule_risk, t.confidence_score) == (
        6.0, 4.0, 10.0, "MODERATE", 0.7)
    c = {r.idea_id: r for r in R.build_cost(df).collect()}["i1"]
    assert (c.development_cost_estimate.low, c.development_cost_estimate.medium, c.development_cost_estimate.high,
            c.monthly_operational_cost, c.confidence_score) == (20000.0, 35000.0, 50000.0, 400.0, 0.7)
    dd = df.withColumn("scope_challenge_id", F.lit("s")).withColumn("time_challenge_id", F.lit("t")) \
           .withColumn("cost_challenge_id", F.lit("c"))
    d = {r.idea_id: r for r in R.build_decision(dd).collect()}
    assert (d["i1"].recommendation, d["i1"].overall_risk, d["i1"].confidence_score, d["i1"].status) == (
        "RECONSIDER", "MODERATE", 0.7, "PENDING_APPROVAL")
    assert (d["i2"].recommendation, d["i2"].overall_risk, d["i2"].confidence_score) == ("RECONSIDER", "HIGH", 0.3)
    sol = df.withColumn("domain", F.lit("gaming")).withColumn("related_topics", F.array(F.lit("a")))
    so = {r.idea_id: r for r in R.build_solution(sol).collect()}
    assert (so["i1"].processing_engine, so["i1"].estimated_effort_hours, so["i1"].confidence_score) == ("KSQLDB", 40.0, 0.7)
    assert so["i2"].confidence_score == 0.5 and so["i2"].new_topics[0].name == "gaming.t"
    assert so["i2"].data_governance.tags == ["gaming", "data-product"]


def test_non_object_takes_fallback(spark):
    df = spark.createDataFrame([("i1", "T", "[1, 2]")], "idea_id string, title string, response string")
    assert R.build_scope(df).first().confidence_score == 0.5


def test_synthesis_and_simple_idea(spark):
    df = spark.createDataFrame([('{"summary": "ok", "observations": ["a"]}',), ("y" * 700,), (None,)], "response string")
    rows = R.build_synthesis(df).collect()
    assert rows[0].summary == "ok" and rows[0].observations == ["a"]
    assert rows[1].summary == "y" * 500 and rows[1].observations == []
    assert rows[2].summary.startswith("Automated synthesis unavailable")
    simple = R.build_idea_simple(spark.createDataFrame([("z" * 400,)], "response string")).first()
    assert (simple.title, len(simple.description), simple.rationale, simple.category) == ("Generated Idea", 300, "Unknown", "other")


def test_implementation_fallback(spark):
    sol = R.build_solution(spark.createDataFrame([("i1", "My Product", "gaming", None)],
                                                 "idea_id string, title string, domain string, response string"))
    impl = R.build_implementation(sol).first()
    tf, readme = impl.artifacts[0], impl.artifacts[1]
    assert tf.path == "terraform/data-products/gaming-my-product.tf"
    assert readme.path == "docs/data-products/my-product-README.md"
    assert 'topic_name       = "gaming.my-product"' in tf.content
    assert '"gaming_my_product"' in tf.content
    assert '[\n  "gaming.my-product"\n]' in readme.content
    assert impl.metadata.total_lines_of_code == len(tf.content.split("\n")) + len(readme.content.split("\n"))
    assert impl.pull_request.branch_name == "feat/data-product-my-product"
