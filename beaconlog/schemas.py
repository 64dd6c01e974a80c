"""Declared schemas; nothing in the library infers one."""

from __future__ import annotations

RAW_LOGS_COLUMNS = [
    ("ingest_ts", "timestamp"),
    ("source_ts", "timestamp"),
    ("service", "string"),
    ("environment", "string"),
    ("deployment_sha", "string"),
    ("severity", "string"),
    ("event_type", "string"),
    ("method", "string"),
    ("route", "string"),
    ("status_code", "int"),
    ("duration_ms", "double"),
    ("trace_id", "string"),
    ("request_id", "string"),
    ("error_type", "string"),
    ("error_message", "string"),
    ("error_signature", "string"),
    ("page", "string"),
    ("api_status", "string"),
    ("source", "string"),
    ("raw_envelope", "variant"),
    ("insert_id", "string"),
    ("pubsub_message_id", "string"),
]

SIGNAL_COLUMNS = [
    ("time_bin", "timestamp"),
    ("signal_type", "string"),
    ("service", "string"),
    ("route", "string"),
    ("requests", "bigint"),
    ("errors", "double"),
    ("actual", "double"),
    ("baseline_mean", "double"),
    ("baseline_stddev", "double"),
    ("anomaly_score", "double"),
]

ML_DETECTION_COLUMNS = [
    ("detected_at", "timestamp"),
    ("model_name", "string"),
    ("ts", "timestamp"),
    ("series_key", "string"),
    ("service", "string"),
    ("route", "string"),
    ("y", "double"),
    ("forecast", "double"),
    ("lower_bound", "double"),
    ("upper_bound", "double"),
    ("is_anomaly", "boolean"),
    ("percentile", "double"),
    ("distance", "double"),
    ("signal_type", "string"),
]

ALERT_LOG_COLUMNS = [
    ("fired_at", "timestamp"),
    ("signal_count", "bigint"),
    ("top_signal", "string"),
    ("top_service", "string"),
    ("top_route", "string"),
    ("top_score", "double"),
    ("total_count", "bigint"),
]

OUTBOX_COLUMNS = [
    ("fired_at", "timestamp"),
    ("payload", "string"),
]

LOAD_HISTORY_COLUMNS = [
    ("last_load_time", "timestamp"),
    ("status", "string"),
    ("first_error_message", "string"),
    ("file_name", "string"),
    ("row_count", "bigint"),
    ("error_count", "bigint"),
    ("bad_values", "bigint"),
]

ARTICLE_COLUMNS = [
    ("article_id", "string"),
    ("title", "string"),
    ("category", "string"),
    ("service", "string"),
    ("tags", "array<string>"),
    ("body", "string"),
    ("authored_at", "timestamp"),
    ("updated_at", "timestamp"),
]

INCIDENT_COLUMNS = [
    ("title", "string"),
    ("signal_type", "string"),
    ("service", "string"),
    ("route", "string"),
    ("deployment_sha", "string"),
    ("anomaly_score", "double"),
    ("body", "string"),
    ("labels", "string"),
    ("fired_at", "timestamp"),
    ("incident_id", "string"),
    ("signals", "bigint"),
]

CLOSED_INCIDENT_COLUMNS = [
    ("service", "string"),
    ("route", "string"),
    ("deployment_sha", "string"),
    ("closed_at", "timestamp"),
]

FIXED_ALERT_COLUMNS = [
    ("alert", "string"),
    ("time_bin", "timestamp"),
    ("service", "string"),
    ("route", "string"),
    ("requests", "bigint"),
    ("value", "double"),
]

OPEN_INCIDENT_COLUMNS = [
    ("service", "string"),
    ("route", "string"),
    ("deployment_sha", "string"),
]


def ddl(columns: list[tuple[str, str]]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns)


def names(columns: list[tuple[str, str]]) -> list[str]:
    return [name for name, _ in columns]
