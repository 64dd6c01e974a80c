"""Alert conditions, the audit row, the payload and the evaluation cycle."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import ObsConfig, ts_lit
from ..functions import iso_z
from ..schemas import SIGNAL_COLUMNS, names
from ..sources.tables import write_alert_log, write_outbox
from . import views
from .rollups import since

# Fields of a signal in the payload, in this order, upper case.
PAYLOAD_FIELDS = (
    "signal_type", "service", "route", "requests", "errors", "actual",
    "baseline_mean", "baseline_stddev", "anomaly_score", "time_bin",
)
PAYLOAD_SOURCE = "anomaly_alert"


def alert_source(zscore: DataFrame, forecast: DataFrame | None = None, use: str = "zscore") -> DataFrame:
    """The signals that drive both the condition and the payload."""
    if use not in ("zscore", "forecast"):
        raise ValueError("use is 'zscore' or 'forecast'")
    chosen = zscore if use == "zscore" else forecast
    if chosen is None:
        raise ValueError("no forecast signals given")
    return chosen.select(*names(SIGNAL_COLUMNS))


def _firing(signals: DataFrame, cfg: ObsConfig) -> DataFrame:
    return signals.filter(F.col("anomaly_score") >= cfg.z_threshold)


def alert_condition(signals: DataFrame, cfg: ObsConfig = ObsConfig()) -> bool:
    return not _firing(signals, cfg).select(F.lit(1)).isEmpty()


def alert_condition_row(signals: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """The condition as a table: always one row."""
    first = _firing(signals, cfg).select(F.lit(1).alias("hit")).limit(1)
    return first.agg(F.count("*").alias("n")).select(ts_lit(as_of).alias("checked_at"), (F.col("n") > 0).alias("fires"))


def top_signals(signals: DataFrame, cfg: ObsConfig = ObsConfig(), limit: int = 10) -> DataFrame:
    """Highest scores first; ties are broken by the naming columns."""
    return (
        _firing(signals, cfg)
        .orderBy(F.desc("anomaly_score"), "signal_type", "service", "route", "time_bin")
        .limit(limit)
        .select(*[iso_z(F.col(c)).alias(c) if c == "time_bin" else c for c in PAYLOAD_FIELDS])
    )


def _rank() -> Column:
    # smallest of (-score, names...) is the first row of the ordered top list
    return F.struct((-F.col("anomaly_score")).alias("o"), "signal_type", "service", "route", "time_bin")


def alert_log_row(
    signals: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(), limit: int = 10
) -> DataFrame:
    """One audit row, or none without signals.

    ``signal_count`` counts the signals listed in the payload, so it stops at
    its limit; ``total_count`` counts all signals above the threshold.
    """
    named = ["signal_type", "service", "route", "anomaly_score"]
    row = (
        _firing(signals, cfg)
        .agg(F.count("*").alias("total_count"), F.min_by(F.struct(*named), _rank()).alias("_top"))
        .filter("total_count > 0")
    )
    return row.select(
        ts_lit(as_of).alias("fired_at"),
        F.least(F.col("total_count"), F.lit(limit)).cast("bigint").alias("signal_count"),
        F.coalesce(F.col("_top.signal_type"), F.lit("")).alias("top_signal"),
        F.coalesce(F.col("_top.service"), F.lit("")).alias("top_service"),
        F.coalesce(F.col("_top.route"), F.lit("")).alias("top_route"),
        F.col("_top.anomaly_score").alias("top_score"),
        "total_count",
    )


def alert_payload(top: DataFrame, as_of: datetime, source: str = PAYLOAD_SOURCE) -> DataFrame:
    """JSON text with every field kept, also the NULL ones; no row without signals."""
    upper = F.struct(*[F.col(c).alias(c.upper()) for c in PAYLOAD_FIELDS])
    listed = top.agg(
        F.array_sort(F.collect_list(F.struct(_rank().alias("order"), upper.alias("signal")))).alias("_all")
    ).filter(F.size("_all") > 0)
    body = F.struct(
        F.lit(source).alias("source"),
        iso_z(ts_lit(as_of)).alias("fired_at"),
        F.transform("_all", lambda s: s["signal"]).alias("signals"),
        F.col("_all")[0]["signal"].alias("top_signal"),
    )
    return listed.select(
        ts_lit(as_of).alias("fired_at"), F.to_json(body, {"ignoreNullFields": "false"}).alias("payload")
    )


def alert_backend_error_rate(ts: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """Error-rate bins of the last minutes above the fixed limit."""
    return ts.filter(
        (F.col("time_bin") >= ts_lit(as_of - cfg.holdback))
        & (F.col("error_rate") > cfg.alert_error_rate)
        & (F.col("requests") >= cfg.min_requests_error_rate)
    )


def alert_route_latency_high(ts: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return ts.filter(
        (F.col("time_bin") >= ts_lit(as_of - cfg.holdback))
        & (F.col("p95_duration_ms") > cfg.alert_p95_ms)
        & (F.col("requests") >= cfg.min_requests_latency)
    )


def alert_forwarder_silent(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """One row when no batch was sent lately, also when there are no rows at all."""
    sent = since(raw, as_of, cfg.holdback, cfg).filter(
        views.is_forwarder_event(cfg) & (F.col("event_type") == "batch_sent")
    )
    return sent.agg(F.count("*").alias("batches")).filter("batches = 0").select(
        ts_lit(as_of).alias("checked_at"), "batches"
    )


def fixed_alerts(
    errors: DataFrame, latency: DataFrame, raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()
) -> DataFrame:
    """What the three fixed limits find: error rate, latency, and a forwarder that is silent."""
    rate = alert_backend_error_rate(errors, as_of, cfg).select(
        F.lit("backend_error_rate").alias("alert"), "time_bin", "service", "route", "requests",
        F.col("error_rate").cast("double").alias("value"),
    )
    slow = alert_route_latency_high(latency, as_of, cfg).select(
        F.lit("route_latency_high").alias("alert"), "time_bin", "service", "route", "requests",
        F.col("p95_duration_ms").alias("value"),
    )
    silent = alert_forwarder_silent(raw, as_of, cfg).select(
        F.lit("forwarder_silent").alias("alert"), F.col("checked_at").alias("time_bin"),
        F.lit(cfg.forwarder_service).alias("service"), F.lit(None).cast("string").alias("route"),
        F.col("batches").alias("requests"), F.lit(None).cast("double").alias("value"),
    )
    return rate.unionByName(slow).unionByName(silent)


def evaluate_alerts(
    spark: SparkSession,
    signals: DataFrame,
    as_of: datetime,
    log_path: str,
    outbox_path: str,
    cfg: ObsConfig = ObsConfig(),
    limit: int = 10,
) -> bool:
    """One alert cycle: audit row first, payload second, nothing without signals.

    ``signals`` should be a stored table (see ``plans.cycle``), since it is
    read more than once. Repeating a cycle replaces its own two rows.
    """
    if not alert_condition(signals, cfg):
        return False
    ordered = top_signals(signals, cfg, limit)
    # the report itself: at most ``limit`` rows
    top = spark.createDataFrame(ordered.collect(), ordered.schema)
    write_alert_log(alert_log_row(signals, as_of, cfg, limit), log_path, as_of)
    write_outbox(alert_payload(top, as_of), outbox_path, as_of)
    return True
