"""Dashboard tile queries over raw logs, roll-ups and signals.

Descending orders put NULLs first and ascending ones last; every limited
query ends in columns that make its order total.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ObsConfig
from ..functions import div0, is_error, time_bin, value_percentile
from ..operators import views
from ..operators.detect import anomaly_score_trend
from ..operators.rollups import since


def _down(column: str) -> Column:
    return F.desc_nulls_first(column)


def _up(column: str) -> Column:
    return F.asc_nulls_last(column)


def _error_measures(total: str, errors: str) -> list[Column]:
    flag = is_error()
    return [F.count("*").alias(total), F.sum(flag).alias(errors)]


def _pct(errors: str, total: str) -> Column:
    return F.round(div0(errors, total) * 100, 2).alias("error_rate_pct")


def tile_error_rate_by_service(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return (
        views.http_requests(since(raw, as_of, cfg.tile_window, cfg))
        .groupBy("service")
        .agg(*_error_measures("total_requests", "error_count"))
        .select("*", _pct("error_count", "total_requests"))
        .orderBy(_down("error_rate_pct"), "service")
    )


def tile_request_rate(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return (
        views.http_requests(since(raw, as_of, cfg.tile_rate_window, cfg))
        .groupBy(time_bin("ingest_ts", cfg.bin_seconds).alias("time_bin"), "service")
        .agg(F.count("*").alias("requests"))
        .orderBy("time_bin", "service")
    )


def tile_p95_by_route(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(), limit: int = 20) -> DataFrame:
    rows = views.http_requests(since(raw, as_of, cfg.tile_window, cfg)).filter("duration_ms IS NOT NULL")
    grouped = value_percentile(rows, ["route", "service"], "duration_ms", cfg.percentile, "p95_ms", "requests", "avg_ms")
    return (
        grouped.select("route", "service", "requests", F.round("avg_ms", 1).alias("avg_ms"),
                       F.round("p95_ms", 1).alias("p95_ms"))
        .orderBy(_down("p95_ms"), "route", "service")
        .limit(limit)
    )


def error_signature_summary(errors: DataFrame) -> DataFrame:
    """Per service and signature: count, first and last seen, sorted SHA list.

    Grouped per SHA first, so the list is built from distinct SHAs only.
    """
    per_sha = errors.groupBy("service", "error_signature", "deployment_sha").agg(
        F.count("*").alias("n"), F.min("ingest_ts").alias("lo"), F.max("ingest_ts").alias("hi")
    )
    return per_sha.groupBy("service", "error_signature").agg(
        F.sum("n").alias("error_count"),
        F.min("lo").alias("first_seen"),
        F.max("hi").alias("last_seen"),
        F.array_join(F.array_sort(F.collect_list("deployment_sha")), ", ").alias("deployment_shas"),
    )


def tile_top_error_signatures(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(), limit: int = 25) -> DataFrame:
    errors = views.application_errors(since(raw, as_of, cfg.tile_window, cfg))
    return (
        error_signature_summary(errors)
        .orderBy(_down("error_count"), _up("service"), "error_signature")
        .limit(limit)
    )


def tile_current_signals(signals: DataFrame) -> DataFrame:
    return signals.orderBy(_down("anomaly_score"), "signal_type", _up("service"), _up("route"), "time_bin").select(
        "time_bin",
        "signal_type",
        "service",
        "route",
        F.round("anomaly_score", 2).alias("anomaly_score"),
        F.round("actual", 4).alias("actual"),
        F.round("baseline_mean", 4).alias("baseline"),
        "requests",
    )


def tile_recent_deployments(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(), limit: int = 30) -> DataFrame:
    return (
        views.deployments(since(raw, as_of, cfg.tile_deploy_window, cfg))
        .select("ingest_ts", "service", "environment", "deployment_sha", "event_type")
        .orderBy(_down("ingest_ts"), _up("service"), _up("environment"), _up("deployment_sha"), "event_type")
        .limit(limit)
    )


def tile_forwarder_health(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return (
        views.forwarder_health(since(raw, as_of, cfg.tile_rate_window, cfg), cfg)
        .groupBy(time_bin("ingest_ts", cfg.bin_seconds).alias("time_bin"), "event_type")
        .agg(F.count("*").alias("event_count"))
        .orderBy("time_bin", _up("event_type"))
    )


def tile_error_rate_by_route_sha(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(), limit: int = 30) -> DataFrame:
    return (
        views.http_requests(since(raw, as_of, cfg.tile_sha_window, cfg))
        .filter("deployment_sha IS NOT NULL")
        .groupBy("service", "deployment_sha", "route")
        .agg(*_error_measures("requests", "errors"))
        .filter(F.col("requests") >= cfg.tile_min_requests)
        .select("*", _pct("errors", "requests"))
        .orderBy(_down("error_rate_pct"), "service", "deployment_sha", "route")
        .limit(limit)
    )


def tile_anomaly_trend(ts: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return anomaly_score_trend(ts, as_of, cfg).orderBy("time_bin", _down("z_score"), "series_key")
