"""Record types carried in the state logs, as Spark DDL, plus their enum domains.

Avro ``float`` is held as DOUBLE in the engine, enums as STRING checked against
their symbols (``check_domain``), nullable unions as nullable columns.
"""

from __future__ import annotations

from pyspark.sql.types import StructType

# Log envelope shared by every topic (value is the JSON text of one record).
LOG_ENVELOPE = ("topic STRING, partition INT, offset BIGINT, ts TIMESTAMP, "
                "key STRING, value STRING")

# --- fixed values: record layouts, field order as declared by the record schemas ---
DEPLOYMENT_STATE = (
    "timestamp STRING, cluster_id STRING, environment_id STRING, "
    "topics ARRAY<STRUCT<name: STRING, partitions: INT, replication_factor: INT>>, "
    "schemas ARRAY<STRUCT<subject: STRING, version: INT, schema_id: INT, schema_type: STRING, namespace: STRING>>, "
    "connectors ARRAY<STRUCT<name: STRING, type: STRING, status: STRING>>, "
    "domains MAP<STRING, STRUCT<topics: ARRAY<STRING>, topic_count: INT>>")
USAGE_STATE = (
    "timestamp STRING, consumer_groups INT, active_consumers INT, "
    "top_topics_by_consumption ARRAY<STRUCT<topic_name: STRING, consumer_count: INT, messages_per_second: DOUBLE>>, "
    "idle_topics ARRAY<STRING>")
METRICS_STATE = (
    "timestamp STRING, total_throughput_mbps DOUBLE, avg_latency_ms DOUBLE, "
    "topics_with_lag ARRAY<STRUCT<topic_name: STRING, consumer_group: STRING, lag_messages: BIGINT>>, "
    "error_rate DOUBLE, storage_used_gb DOUBLE")
CURRENT_STATE = (
    "timestamp STRING, "
    "deployment STRUCT<timestamp: STRING, cluster_id: STRING, total_topics: INT, total_schemas: INT, total_connectors: INT, domain_count: INT>, "
    "usage STRUCT<timestamp: STRING, consumer_groups: INT, active_consumers: INT, idle_topic_count: INT>, "
    "metrics STRUCT<timestamp: STRING, total_throughput_mbps: DOUBLE, avg_latency_ms: DOUBLE, error_rate: DOUBLE, topics_with_lag_count: INT>, "
    "summary STRING, notable_observations ARRAY<STRING>")
RAW_IDEA = (
    "timestamp STRING, idea_id STRING, title STRING, description STRING, domain STRING, "
    "related_topics ARRAY<STRING>, reasoning STRING, potential_users ARRAY<STRING>, "
    "estimated_complexity STRING, confidence_score DOUBLE, status STRING")
SCOPE_CHALLENGE = (
    "timestamp STRING, challenge_id STRING, idea_id STRING, idea_title STRING, "
    "complexity_rating STRING, scope_creep_risk STRING, technical_challenges ARRAY<STRING>, "
    "integration_points ARRAY<STRING>, dependencies ARRAY<STRING>, "
    "recommended_scope_adjustments ARRAY<STRING>, confidence_score DOUBLE, reasoning STRING")
TIME_CHALLENGE = (
    "timestamp STRING, challenge_id STRING, idea_id STRING, idea_title STRING, "
    "estimated_duration_weeks DOUBLE, best_case_weeks DOUBLE, worst_case_weeks DOUBLE, "
    "schedule_risk STRING, "
    "implementation_phases ARRAY<STRUCT<name: STRING, duration_weeks: DOUBLE, description: STRING>>, "
    "time_risk_factors ARRAY<STRING>, parallel_work_opportunities ARRAY<STRING>, "
    "confidence_score DOUBLE, reasoning STRING")
COST_CHALLENGE = (
    "timestamp STRING, challenge_id STRING, idea_id STRING, idea_title STRING, "
    "development_cost_estimate STRUCT<low: DOUBLE, medium: DOUBLE, high: DOUBLE>, "
    "monthly_operational_cost DOUBLE, "
    "resource_requirements ARRAY<STRUCT<type: STRING, count: DOUBLE, duration_weeks: DOUBLE>>, "
    "infrastructure_costs ARRAY<STRUCT<component: STRING, monthly_cost: DOUBLE, notes: STRING>>, "
    "cost_risk STRING, roi_potential STRING, cost_optimization_opportunities ARRAY<STRING>, "
    "confidence_score DOUBLE, reasoning STRING")
DECISION = (
    "timestamp STRING, decision_id STRING, idea_id STRING, idea_title STRING, "
    "scope_challenge_id STRING, time_challenge_id STRING, cost_challenge_id STRING, "
    "recommendation STRING, overall_risk STRING, key_findings ARRAY<STRING>, "
    "conditions ARRAY<STRING>, alternative_approaches ARRAY<STRING>, summary STRING, "
    "detailed_reasoning STRING, confidence_score DOUBLE, status STRING")
SOLUTION = (
    "timestamp STRING, solution_id STRING, idea_id STRING, idea_title STRING, "
    "technical_approach STRING, processing_engine STRING, processing_rationale STRING, "
    "new_topics ARRAY<STRUCT<name: STRING, partitions: INT, retention_ms: BIGINT, description: STRING>>, "
    "schemas ARRAY<STRUCT<subject: STRING, schema_definition: STRING, description: STRING>>, "
    "query_specifications ARRAY<STRUCT<name: STRING, type: STRING, sql_template: STRING, description: STRING>>, "
    "infrastructure_requirements STRUCT<compute_pool_required: BOOLEAN, ksqldb_cluster_required: BOOLEAN, connectors_required: ARRAY<STRING>, estimated_csu_hours: DOUBLE, additional_notes: STRING>, "
    "data_governance STRUCT<owner: STRING, domain: STRING, classification: STRING, retention_policy: STRING, tags: ARRAY<STRING>>, "
    "api_specifications ARRAY<STRUCT<endpoint_pattern: STRING, method: STRING, description: STRING>>, "
    "testing_strategy STRING, deployment_considerations STRING, estimated_effort_hours DOUBLE, "
    "risks_and_mitigations ARRAY<STRUCT<risk: STRING, mitigation: STRING, severity: STRING>>, "
    "success_metrics ARRAY<STRING>, confidence_score DOUBLE, status STRING")
IMPLEMENTATION = (
    "timestamp STRING, implementation_id STRING, solution_id STRING, idea_id STRING, idea_title STRING, "
    "artifacts ARRAY<STRUCT<path: STRING, type: STRING, content: STRING, description: STRING>>, "
    "terraform_resources ARRAY<STRUCT<resource_type: STRING, resource_name: STRING, description: STRING>>, "
    "pull_request STRUCT<branch_name: STRING, title: STRING, description: STRING, base_branch: STRING, labels: ARRAY<STRING>, url: STRING>, "
    "deployment_plan STRUCT<steps: ARRAY<STRUCT<order: INT, description: STRING, command: STRING, estimated_duration: STRING>>, rollback_procedure: STRING, validation_steps: ARRAY<STRING>>, "
    "documentation STRUCT<readme_content: STRING, usage_examples: ARRAY<STRING>, api_documentation: STRING>, "
    "estimated_cost STRUCT<monthly_usd: DOUBLE, breakdown: ARRAY<STRUCT<component: STRING, monthly_usd: DOUBLE>>>, "
    "test_plan ARRAY<STRUCT<name: STRING, description: STRING, test_type: STRING>>, "
    "metadata STRUCT<agent_version: STRING, generation_time_seconds: DOUBLE, files_generated: INT, total_lines_of_code: INT>, "
    "confidence_score DOUBLE, status STRING")

RECORDS = {
    "deployment-state": DEPLOYMENT_STATE,
    "usage-state": USAGE_STATE,
    "metrics-state": METRICS_STATE,
    "current-state": CURRENT_STATE,
    "raw-ideas": RAW_IDEA,
    "scope-challenge": SCOPE_CHALLENGE,
    "time-challenge": TIME_CHALLENGE,
    "cost-challenge": COST_CHALLENGE,
    "decision": DECISION,
    "solution": SOLUTION,
    "implementation": IMPLEMENTATION,
}

# --- fixed values: enum symbols, declaration order = rank order ---
IDEA_COMPLEXITY = ["LOW", "MEDIUM", "HIGH", "VERY_HIGH"]
IDEA_STATUS = ["RAW", "REFINED", "APPROVED", "REJECTED"]
COMPLEXITY_RATING = ["TRIVIAL", "SIMPLE", "MODERATE", "COMPLEX", "VERY_COMPLEX"]
RISK = ["MINIMAL", "LOW", "MODERATE", "HIGH", "CRITICAL"]
ROI_POTENTIAL = ["MINIMAL", "LOW", "MODERATE", "HIGH", "VERY_HIGH"]
RECOMMENDATION = ["STRONGLY_APPROVE", "APPROVE", "APPROVE_WITH_CONDITIONS", "RECONSIDER", "REJECT"]
DECISION_STATUS = ["PENDING_APPROVAL", "APPROVED", "REJECTED", "DEFERRED"]
PROCESSING_ENGINE = ["KAFKA_STREAMS", "KSQLDB", "FLINK", "SPARK", "CONNECTOR_ONLY", "MIXED"]
QUERY_KIND = ["STREAM", "TABLE", "MATERIALIZED_VIEW", "STREAMING_JOIN", "AGGREGATION"]
CLASSIFICATION = ["PUBLIC", "INTERNAL", "CONFIDENTIAL", "RESTRICTED"]
SEVERITY = ["LOW", "MEDIUM", "HIGH", "CRITICAL"]
SOLUTION_STATUS = ["PENDING_APPROVAL", "APPROVED", "REJECTED", "REVISION_REQUESTED"]
ARTIFACT_TYPE = ["TERRAFORM", "KSQLDB", "FLINK_SQL", "SCHEMA", "DOCUMENTATION", "CONFIG", "TEST"]
TEST_TYPE = ["UNIT", "INTEGRATION", "E2E", "PERFORMANCE", "VALIDATION"]
IMPLEMENTATION_STATUS = ["GENERATED", "PR_CREATED", "UNDER_REVIEW", "APPROVED", "DEPLOYED",
                         "REJECTED", "FAILED"]

# --- fixed values: platform constants ---
CLUSTER_KEY = "data-mesh-cluster"      # message key of the four state records
DEFAULT_PARTITIONS = 6
DEFAULT_REPLICATION = 3
RETENTION_MS = 604_800_000              # 7 days
COMPACTION_LAG_MS = 60_000
FIRST_SCHEMA_ID = 100001


def record_type(name: str) -> StructType:
    """StructType of a record by its schema name; unknown names raise (as the registry does)."""
    try:
        ddl = RECORDS[name]
    except KeyError:
        raise KeyError(f"unknown record schema {name!r}; known: {sorted(RECORDS)}") from None
    return StructType.fromDDL(ddl)
