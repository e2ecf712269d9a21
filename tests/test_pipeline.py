"""PIPE-1 end to end with a responder, and with no responder (fallbacks everywhere)."""

import json

from tessera.plans.pipeline import run_pipeline


def test_pipeline(spark, tmp_dir):
    # defined inside the test so it ships by value to the Python workers
    def responder(prompts, systems):
        import json as j
        return prompts.map(lambda p: j.dumps({"recommendation": "APPROVE", "confidence_score": 0.9})
                           if p.startswith("Decide") else "{}")

    ideas = [{"title": "Fraud Radar", "domain": "payments", "related_topics": ["transactions"]},
             {"title": "Churn Map", "domain": "crm"}]
    text = "```json\n" + json.dumps({"ideas": ideas}) + "\n```"
    resp = spark.createDataFrame([("r1", text), ("r2", "no ideas today")], "id string, response string")
    counts = run_pipeline(spark, resp, f"{tmp_dir}/run", responder=responder)
    assert counts["ideas"] == 2 and counts["implementation"] == 2
    impl = spark.read.parquet(f"{tmp_dir}/run/implementations")
    assert impl.count() == 2
    dec = spark.read.parquet(f"{tmp_dir}/run/decisions").first()
    assert dec.recommendation == "APPROVE"


def test_pipeline_skip_and_gate(spark, tmp_dir):
    resp = spark.createDataFrame([("r1", "nothing parsable")], "id string, response string")
    counts = run_pipeline(spark, resp, f"{tmp_dir}/run2")
    assert counts == {"ideas": 0}


def test_pipeline_from_monitoring_without_review(spark, tmp_dir):
    def responder(prompts, systems):
        import json as j
        return prompts.map(lambda p: j.dumps({"ideas": [{"title": "From state"}]}) if p.startswith("Suggest") else "{}")

    usage = spark.createDataFrame([("k", "t", 7, 20, 3)], "_k string, timestamp string, consumer_groups int, "
                                                          "active_consumers int, idle_topic_count int")
    counts = run_pipeline(spark, None, f"{tmp_dir}/run3", responder=responder, usage=usage,
                          skip={"idea_review", "solution_review"})
    assert counts["monitoring"] == counts["ideas"] == counts["scope"] == counts["implementation"] == 1
    assert spark.read.parquet(f"{tmp_dir}/run3/current_state").first().usage.consumer_groups == 7
    counts = run_pipeline(spark, None, f"{tmp_dir}/run4", responder=responder, usage=usage, skip={"scope"})
    assert counts == {"monitoring": 1, "ideas": 1, "idea_review": 1}


def test_no_stage_broadcasts_the_ideas(spark, tmp_dir, monkeypatch):
    from tessera.plans import pipeline as P

    plans, save = {}, P._save

    def kept(spark, df, out, name):
        plans[name] = df._jdf.queryExecution().sparkPlan().toString()
        return save(spark, df, out, name)

    monkeypatch.setattr(P, "_save", kept)
    resp = spark.createDataFrame([(f"r{i}", json.dumps({"ideas": [{"title": f"Idea {i}"}]})) for i in range(5)],
                                 "id string, response string")
    counts = run_pipeline(spark, resp, f"{tmp_dir}/run5")
    assert counts == dict.fromkeys(P.STAGES[1:], 5)
    joined = {name for name, plan in plans.items() if "SortMergeJoin" in plan}
    assert joined == {"approved_ideas", "scope", "time", "cost", "decision_responses", "decisions", "approved_decisions",
                      "solution_responses", "solutions", "approved_solutions"}
    assert not [name for name, plan in plans.items() if "Broadcast" in plan]
