"""Declared record layout of every topic. Times arrive as text and are parsed by ``parse_ts``."""

from __future__ import annotations

LOGS_RAW = "timestamp string, service string, level string, message string, trace_id string"

LOGS_PARSED = (
    "timestamp string, service string, message string, severity string, trace_id string, original_level string"
)

METRICS_RAW = (
    "timestamp string, service string, severity string, cpu_percent double, memory_percent double, "
    "disk_io bigint, network_latency_ms double, request_rate bigint, error_rate double"
)

METRICS_ENRICHED = (
    "timestamp string, service string, severity string, cpu_percent double, cpu_avg_5 double, "
    "memory_percent double, memory_avg_5 double, network_latency_ms double, latency_avg_5 double, "
    "cpu_to_memory_ratio double, is_high_cpu boolean, is_high_memory boolean, is_high_latency boolean"
)

ML_OUTPUT = (
    "timestamp string, service string, severity string, anomaly_type string, anomaly_score double, "
    "is_anomaly boolean, cpu_avg_5 double, memory_avg_5 double, latency_avg_5 double"
)

INCIDENTS = (
    "event_type string, incident_id string, correlation_id string, timestamp string, ts string, service string, "
    "severity string, incident_type string, source string, details string, test_id string, trace_id string"
)

ACTION_INTENT = (
    "event_type string, timestamp string, service string, severity string, action_id string, "
    "correlation_id string, test_id string, trace_id string, incident_id string, rule_id string, status string, "
    "action_type string, target_service string, parameters string, source string, incident string"
)

ACTION_APPROVAL = "event_type string, action_id string, decision string, approver string, ts string"

ACTION_RESULT = (
    "event_type string, action_id string, action_type string, target_service string, status string, "
    "message string, ts bigint, incident_id string, test_id string, correlation_id string, rule_id string, "
    "source string, source_event_id string, executed_action string, approver string"
)

# One topic carries intents, approvals and results; its layout is the union of the three.
ACTIONS = (
    "event_type string, timestamp string, ts string, service string, severity string, action_id string, "
    "correlation_id string, test_id string, trace_id string, incident_id string, rule_id string, status string, "
    "action_type string, target_service string, parameters string, source string, incident string, "
    "decision string, approver string, message string, source_event_id string, executed_action string"
)

TOPICS = {
    "logs_raw": LOGS_RAW,
    "logs_parsed": LOGS_PARSED,
    "metrics_raw": METRICS_RAW,
    "metrics_enriched": METRICS_ENRICHED,
    "ml_output": ML_OUTPUT,
    "incidents": INCIDENTS,
    "actions": ACTIONS,
}

# Topics that end up in the labelled log store.
STORED_TOPICS = ("logs_parsed", "metrics_enriched", "ml_output", "incidents", "actions")
