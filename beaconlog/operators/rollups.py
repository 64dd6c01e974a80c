"""Time-binned roll-ups of the raw logs.

Each count-type roll-up is a two-phase aggregation, so a hot service or route
is combined on the map side before anything is shuffled. ``signal_rollup``
computes all of them in one scan and one shuffle for the detectors.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    ERROR_SEVERITIES,
    KEY_DROPS,
    KEY_FRESHNESS,
    SIG_DEPLOY,
    SIG_DROPS,
    SIG_ERROR_RATE,
    SIG_FRESHNESS,
    SIG_LATENCY,
    SIG_SIGNATURE,
    ObsConfig,
    ts_lit,
)
from ..functions import (
    div0,
    is_error,
    series_key,
    sql_list,
    sql_text,
    time_bin,
    value_percentile,
)
from . import views


def since(
    df: DataFrame,
    as_of: datetime,
    window: timedelta,
    cfg: ObsConfig,
    column: str = "ingest_ts",
) -> DataFrame:
    """Rows of the last ``window``; prunes day partitions when the table has them.

    Rows are stored by the day of their ingest time, which says nothing certain
    about their source time, so only a window of ingest times prunes.
    """
    start = as_of - window
    out = df.filter(F.col(column) >= ts_lit(start))
    if cfg.replay:
        out = out.filter(F.col(column) <= ts_lit(as_of))
    if column == "ingest_ts" and "ingest_date" in df.columns:
        out = out.filter(F.col("ingest_date") >= F.to_date(ts_lit(start)))
        if cfg.replay:
            out = out.filter(F.col("ingest_date") <= F.to_date(ts_lit(as_of)))
    return out


def _history(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig) -> DataFrame:
    """``as_of=None`` keeps the whole input, as the day-wise refresh needs."""
    return raw if as_of is None else since(raw, as_of, cfg.history, cfg)


def _bin(cfg: ObsConfig) -> Column:
    return time_bin("ingest_ts", cfg.bin_seconds)


def is_healthy_batch(cfg: ObsConfig) -> Column:
    """A NULL severity is neither healthy nor failed."""
    sent = F.expr(f"event_type = 'batch_sent' AND severity NOT IN {sql_list(ERROR_SEVERITIES)}")
    return views.is_forwarder_event(cfg) & sent


def is_forwarder_drop(cfg: ObsConfig) -> Column:
    lost = F.expr(f"event_type = 'message_skipped' OR severity IN {sql_list(ERROR_SEVERITIES)}")
    return views.is_forwarder_event(cfg) & lost


def ts_http_error_rate(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return (
        _history(raw, as_of, cfg)
        .filter(views.is_http_request())
        .groupBy(_bin(cfg).alias("time_bin"), "service", "route")
        .agg(F.count("*").alias("requests"), F.sum(is_error()).alias("errors"))
        .select(
            "time_bin",
            series_key("service", "route").alias("series_key"),
            "service",
            "route",
            "requests",
            "errors",
            div0("errors", "requests").alias("error_rate"),
        )
    )


_LATENCY_KEYS = ["time_bin", "service", "route"]


def _latency_rows(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig) -> DataFrame:
    return (
        _history(raw, as_of, cfg)
        .filter(views.is_http_request() & F.col("duration_ms").isNotNull())
        .select(_bin(cfg).alias("time_bin"), "service", "route", "duration_ms")
    )


def ts_route_latency(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return value_percentile(
        _latency_rows(raw, as_of, cfg), _LATENCY_KEYS, "duration_ms", cfg.percentile,
        "p95_duration_ms", "requests", "avg_duration_ms",
    ).select(
        "time_bin",
        series_key("service", "route").alias("series_key"),
        "service",
        "route",
        "requests",
        "avg_duration_ms",
        "p95_duration_ms",
    )


def ts_error_signatures(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return (
        _history(raw, as_of, cfg)
        .filter(views.is_application_error())
        .groupBy(_bin(cfg).alias("time_bin"), "service", "error_signature")
        .agg(F.count("*").alias("error_count"))
        .select(
            "time_bin",
            series_key("service", "error_signature").alias("series_key"),
            "service",
            "error_signature",
            "error_count",
        )
    )


def ts_forwarder_freshness(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return (
        _history(raw, as_of, cfg)
        .filter(is_healthy_batch(cfg))
        .groupBy(_bin(cfg).alias("time_bin"))
        .agg(F.count("*").alias("healthy_events"))
        .select("time_bin", F.lit(KEY_FRESHNESS).alias("series_key"), "healthy_events")
    )


def ts_forwarder_drops(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return (
        _history(raw, as_of, cfg)
        .filter(is_forwarder_drop(cfg))
        .groupBy(_bin(cfg).alias("time_bin"))
        .agg(F.count("*").alias("drop_count"))
        .select("time_bin", F.lit(KEY_DROPS).alias("series_key"), "drop_count")
    )


def ts_deployment_error_rate(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return (
        _history(raw, as_of, cfg)
        .filter(views.is_http_request() & F.col("deployment_sha").isNotNull())
        .groupBy(_bin(cfg).alias("time_bin"), "service", "deployment_sha")
        .agg(F.count("*").alias("requests"), F.sum(is_error()).alias("_errors"))
        .select(
            "time_bin",
            series_key("service", "deployment_sha").alias("series_key"),
            "service",
            "deployment_sha",
            "requests",
            div0("_errors", "requests").alias("error_rate"),
        )
    )


def latest_shas(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """The SHA of each service's newest request; of SHAs in the same instant the greater one."""
    return (
        _history(raw, as_of, cfg)
        .filter(views.is_http_request() & F.col("deployment_sha").isNotNull())
        .groupBy("service")
        .agg(F.max_by("deployment_sha", F.struct("ingest_ts", "deployment_sha")).alias("deployment_sha"))
    )


ROLLUPS = {
    "ts_http_error_rate": ts_http_error_rate,
    "ts_route_latency": ts_route_latency,
    "ts_error_signatures": ts_error_signatures,
    "ts_forwarder_freshness": ts_forwarder_freshness,
    "ts_forwarder_drops": ts_forwarder_drops,
    "ts_deployment_error_rate": ts_deployment_error_rate,
}


def count_bins(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """The five count series in one long table, from one scan and one shuffle.

    Columns: time_bin, signal_type, series_key, service, route, requests,
    errors, last_seen. A log row belongs to up to five series; it is expanded and combined
    again on the map side before the shuffle.
    """
    forwarder = sql_text(cfg.forwarder_service)

    def member(rule: Column, signal: str, key: str, service: str, route: str) -> Column:
        fields = f"'{signal}' AS signal_type, {key} AS series_key, {service} AS service, {route} AS route"
        return F.when(rule, F.expr(f"struct({fields})"))

    def own(signal: str, route: str, rule: Column) -> Column:
        return member(rule, signal, f"concat(service, '::', {route})", "service", route)

    http = views.is_http_request()
    members = F.array(
        own(SIG_ERROR_RATE, "route", http),
        own(SIG_SIGNATURE, "error_signature", views.is_application_error()),
        own(SIG_DEPLOY, "deployment_sha", http & F.expr("deployment_sha IS NOT NULL")),
        member(is_healthy_batch(cfg), SIG_FRESHNESS, f"'{KEY_FRESHNESS}'", forwarder, f"'{KEY_FRESHNESS}'"),
        member(is_forwarder_drop(cfg), SIG_DROPS, f"'{KEY_DROPS}'", forwarder, f"'{KEY_DROPS}'"),
    )
    return (
        _history(raw, as_of, cfg)
        .select("ingest_ts", _bin(cfg).alias("time_bin"), is_error().alias("_e"), F.explode(members).alias("_m"))
        .filter("_m IS NOT NULL")
        .groupBy("time_bin", "_m.signal_type", "_m.series_key", "_m.service", "_m.route")
        .agg(
            F.expr("count(*) AS requests"), F.expr("CAST(sum(_e) AS DOUBLE) AS errors"), F.expr("max(ingest_ts) AS last_seen")
        )
    )


def series_frame(counts: DataFrame, latency: DataFrame) -> DataFrame:
    """Count bins and latency bins as one frame with the scored ``value``."""
    rates = sql_list((SIG_ERROR_RATE, SIG_DEPLOY))
    value = f"CASE WHEN signal_type IN {rates} THEN errors / requests ELSE CAST(requests AS DOUBLE) END"
    return counts.drop("last_seen").selectExpr("*", f"{value} AS value").unionByName(
        latency.selectExpr(
            "time_bin",
            f"'{SIG_LATENCY}' AS signal_type",
            "series_key",
            "service",
            "route",
            "requests",
            "CAST(NULL AS DOUBLE) AS errors",
            "p95_duration_ms AS value",
        )
    )


def signal_rollup(raw: DataFrame, as_of: datetime | None, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """All six series straight from raw logs: one pass for the counts, one for the latency."""
    return series_frame(count_bins(raw, as_of, cfg), ts_route_latency(raw, as_of, cfg))


def rollups_from_bins(counts: DataFrame, latency: DataFrame) -> dict[str, DataFrame]:
    """The six roll-ups read back from stored count bins and latency bins."""

    def of(signal: str) -> DataFrame:
        return counts.filter(F.col("signal_type") == signal)

    rate = div0("errors", "requests").alias("error_rate")
    errors = F.col("errors").cast("bigint").alias("errors")
    return {
        "ts_http_error_rate": of(SIG_ERROR_RATE).select(
            "time_bin", "series_key", "service", "route", "requests", errors, rate
        ),
        "ts_route_latency": latency.select(
            "time_bin", "series_key", "service", "route", "requests", "avg_duration_ms", "p95_duration_ms"
        ),
        "ts_error_signatures": of(SIG_SIGNATURE).select(
            "time_bin", "series_key", "service", F.col("route").alias("error_signature"),
            F.col("requests").alias("error_count"),
        ),
        "ts_forwarder_freshness": of(SIG_FRESHNESS).select(
            "time_bin", "series_key", F.col("requests").alias("healthy_events")
        ),
        "ts_forwarder_drops": of(SIG_DROPS).select(
            "time_bin", "series_key", F.col("requests").alias("drop_count")
        ),
        "ts_deployment_error_rate": of(SIG_DEPLOY).select(
            "time_bin", "series_key", "service", F.col("route").alias("deployment_sha"), "requests", rate
        ),
    }
