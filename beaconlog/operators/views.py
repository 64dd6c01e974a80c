"""Logical views over the raw log table: a filter and a projection each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ERROR_SEVERITIES, ObsConfig
from ..functions import sql_list, sql_text


def is_http_request() -> Column:
    return F.expr("event_type = 'http_request' AND service IS NOT NULL AND route IS NOT NULL")


def is_application_error() -> Column:
    return F.expr(f"severity IN {sql_list(ERROR_SEVERITIES)} AND error_signature IS NOT NULL")


def is_deployment() -> Column:
    return F.expr(
        "event_type = 'deployment' OR (event_type = 'forwarder_start' AND deployment_sha IS NOT NULL)"
    )


def is_forwarder_event(cfg: ObsConfig) -> Column:
    return F.expr(
        f"service = {sql_text(cfg.forwarder_service)}"
        " OR event_type IN ('forwarder_start', 'batch_sent', 'message_skipped')"
    )


def http_requests(raw: DataFrame) -> DataFrame:
    return raw.filter(is_http_request()).select(
        "ingest_ts", "source_ts", "service", "environment", "deployment_sha", "severity",
        "method", "route", "status_code", "duration_ms", "trace_id", "request_id",
    )


def application_errors(raw: DataFrame) -> DataFrame:
    return raw.filter(is_application_error()).select(
        "ingest_ts", "source_ts", "service", "environment", "deployment_sha", "severity",
        "error_type", "error_message", "error_signature", "route", "trace_id", "request_id",
    )


def frontend_telemetry(raw: DataFrame, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return raw.filter(F.col("service") == cfg.frontend_service).select(
        "ingest_ts", "source_ts", "service", "environment", "page", "api_status",
        "duration_ms", "trace_id",
    )


def deployments(raw: DataFrame) -> DataFrame:
    """Includes ``event_type``, which the deployments tile shows."""
    return raw.filter(is_deployment()).select(
        "ingest_ts", "source_ts", "service", "environment", "deployment_sha", "severity",
        "source", "event_type",
    )


def forwarder_health(raw: DataFrame, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return raw.filter(is_forwarder_event(cfg)).select(
        "ingest_ts", "source_ts", "service", "environment", "event_type", "severity", "source",
    )
