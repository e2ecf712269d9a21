"""FIXTURES §5.6: review actions per state machine; edits."""

from pyspark.sql import functions as F

from tessera.operators import review as RV


def run(spark, machine, status, actions):
    items = spark.createDataFrame([(f"i{n}", status) for n in range(len(actions))], "id string, status string")
    acts = spark.createDataFrame([(f"i{n}", a) for n, a in enumerate(actions)], "id string, action string")
    out = RV.apply_actions(items, acts, machine).orderBy("id").collect()
    return [(r.new_status, r.written) for r in out]


def test_idea_machine(spark):
    assert run(spark, "idea", "RAW", ["a", "r", "e", "e+a", "s"]) == [
        ("APPROVED", True), ("REJECTED", True), ("REFINED", True), ("APPROVED", True), ("RAW", False)]
    assert run(spark, "idea", "APPROVED", ["r", "e"]) == [("APPROVED", False), ("APPROVED", False)]


def test_decision_machine(spark):
    assert run(spark, "decision", "PENDING_APPROVAL", ["a", "r", "d", "s"]) == [
        ("APPROVED", True), ("REJECTED", True), ("DEFERRED", True), ("DEFERRED", True)]


def test_solution_machine(spark):
    assert run(spark, "solution", "PENDING_APPROVAL", ["a", "r", "v", "s"]) == [
        ("APPROVED", True), ("REJECTED", True), ("REVISION_REQUESTED", True), ("PENDING_APPROVAL", False)]


def test_rejection_reason(spark):
    items = spark.createDataFrame([("i1", "RAW")], "id string, status string")
    acts = spark.createDataFrame([("i1", " R ", "too big")], "id string, action string, reason string")
    r = RV.apply_actions(items, acts, "idea").first()
    assert (r.new_status, r.rejection_reason) == ("REJECTED", "too big")


def test_edits(spark):
    items = spark.createDataFrame(
        [("i1", "Old", "d", "dom", "LOW", ["t"])],
        "id string, title string, description string, domain string, estimated_complexity string, related_topics array<string>")
    edits = spark.createDataFrame([("i1", "New", None, "", "very_high", "a, b ,, c")],
                                  "id string, title string, description string, domain string, complexity string, topics string")
    r = RV.apply_edits(items, edits).first()
    assert (r.title, r.description, r.domain, r.estimated_complexity, r.related_topics) == (
        "New", "d", "dom", "VERY_HIGH", ["a", "b", "", "c"])
    bad = edits.withColumn("complexity", F.lit("extreme"))
    assert RV.apply_edits(items, bad).first().estimated_complexity == "LOW"
