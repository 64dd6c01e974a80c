"""Baseline + z-score detectors over the roll-ups.

All six detectors share one shape, so they share one implementation that works
on a long *series frame* (time_bin, signal_type, series_key, service, route,
requests, errors, value). A detector is the mapping of its roll-up onto that
frame; scoring the union of the frames scores all signals in one pass.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    EPOCH,
    KEY_DROPS,
    KEY_FRESHNESS,
    SIG_DEPLOY,
    SIG_DROPS,
    SIG_ERROR_RATE,
    SIG_FRESHNESS,
    SIG_LATENCY,
    SIG_SIGNATURE,
    ObsConfig,
    as_utc,
    ts_lit,
)
from ..functions import div0, join_same, time_bin
from ..schemas import SIGNAL_COLUMNS
from ..session import materialize
from .rollups import latest_shas, signal_rollup, since

FRAME = ["time_bin", "signal_type", "series_key", "service", "route", "requests", "errors", "value"]


# ── splitting at the holdback ───────────────────────────────────────────────

def first_recent_bin(as_of: datetime, cfg: ObsConfig) -> datetime:
    """Start of the first bin of the detection window (cuts compare bin starts)."""
    cut = as_utc(as_of) - cfg.holdback
    size = timedelta(seconds=cfg.bin_seconds)
    return EPOCH - ((EPOCH - cut) // size) * size


def split_logs(raw: DataFrame, as_of: datetime, cfg: ObsConfig) -> tuple[DataFrame, DataFrame]:
    """Raw logs before and inside the detection window.

    Splitting the log rows at a bin start equals splitting the bins, and lets
    the scan of the short detection window skip all older days and row groups.
    """
    edge = ts_lit(first_recent_bin(as_of, cfg))
    past = raw.filter(F.col("ingest_ts") < edge)
    recent = raw.filter(F.col("ingest_ts") >= edge)
    if "ingest_date" in raw.columns:
        past = past.filter(F.col("ingest_date") <= F.to_date(edge))
        recent = recent.filter(F.col("ingest_date") >= F.to_date(edge))
    return past, recent


def stored_bins(ts: DataFrame, as_of: datetime, cfg: ObsConfig) -> DataFrame:
    """Bins of the history window from a stored roll-up table."""
    out = ts.filter(F.col("time_bin") >= ts_lit(as_of - cfg.history))
    if "bin_date" in ts.columns:
        out = out.filter(F.col("bin_date") >= F.to_date(ts_lit(as_of - cfg.history))).drop("bin_date")
    return out


# ── roll-ups as series frames ───────────────────────────────────────────────

def _frame(ts: DataFrame, signal: str, service: Column, route: Column, requests: Column,
           errors: Column, value: Column) -> DataFrame:
    return ts.select(
        "time_bin",
        F.lit(signal).alias("signal_type"),
        "series_key",
        service.alias("service"),
        route.alias("route"),
        requests.cast("bigint").alias("requests"),
        errors.cast("double").alias("errors"),
        value.cast("double").alias("value"),
    )


def error_rate_frame(ts: DataFrame) -> DataFrame:
    return _frame(ts, SIG_ERROR_RATE, F.col("service"), F.col("route"), F.col("requests"),
                  F.col("errors"), F.col("error_rate"))


def latency_frame(ts: DataFrame) -> DataFrame:
    return _frame(ts, SIG_LATENCY, F.col("service"), F.col("route"), F.col("requests"),
                  F.lit(None), F.col("p95_duration_ms"))


def signature_frame(ts: DataFrame) -> DataFrame:
    n = F.col("error_count")
    return _frame(ts, SIG_SIGNATURE, F.col("service"), F.col("error_signature"), n, n, n)


def freshness_frame(ts: DataFrame, cfg: ObsConfig) -> DataFrame:
    n = F.col("healthy_events")
    return _frame(ts, SIG_FRESHNESS, F.lit(cfg.forwarder_service), F.lit(KEY_FRESHNESS), n, F.lit(0), n)


def drops_frame(ts: DataFrame, cfg: ObsConfig) -> DataFrame:
    n = F.col("drop_count")
    return _frame(ts, SIG_DROPS, F.lit(cfg.forwarder_service), F.lit(KEY_DROPS), n, n, n)


def deployment_frame(ts: DataFrame) -> DataFrame:
    return _frame(ts, SIG_DEPLOY, F.col("service"), F.col("deployment_sha"), F.col("requests"),
                  F.lit(None), F.col("error_rate"))


# ── scoring ─────────────────────────────────────────────────────────────────

# Deployments are judged against the whole service, other series against themselves.
_BASELINE_RULES = {
    "base_key": f"IF(signal_type = '{SIG_DEPLOY}', service, series_key)",
    "_service": "service",
    "_route": f"IF(signal_type = '{SIG_DEPLOY}', NULL, route)",
}
_BASELINE_KEY = f"{_BASELINE_RULES['base_key']} AS base_key"


def _gate(cfg: ObsConfig) -> str:
    return f"""requests >= CASE signal_type WHEN '{SIG_ERROR_RATE}' THEN {cfg.min_requests_error_rate}
        WHEN '{SIG_LATENCY}' THEN {cfg.min_requests_latency}
        WHEN '{SIG_SIGNATURE}' THEN {cfg.min_errors_signature}
        WHEN '{SIG_DEPLOY}' THEN {cfg.min_requests_deploy} ELSE 0 END"""


def zscore_detect(
    past: DataFrame,
    as_of: datetime,
    cfg: ObsConfig = ObsConfig(),
    recent: DataFrame | None = None,
    latest: DataFrame | None = None,
    spans: DataFrame | None = None,
) -> DataFrame:
    """Signals of a series frame: bins of the holdback window against older bins.

    A deployment is judged by its mean over the window's bins and reported at
    ``as_of``; for every other series a bin stands for itself.

    ``recent`` may hold the detection bins when they were computed apart from
    the baseline bins; by default both come from ``past``.

    With ``cfg.latest_sha_only``, ``latest`` names the newest SHA per service
    (``rollups.latest_shas``). Bins do not tell the order of SHAs within a bin, so
    without it the greatest SHA of the newest bin is taken.

    ``spans`` may hold the moments (:func:`span_moments`) of bins that are not in ``past``; they
    join the baseline.
    """
    recent = past if recent is None else recent
    cut = ts_lit(as_of - cfg.holdback)
    past = past.filter(F.col("time_bin") < cut)
    recent = recent.filter(F.col("time_bin") >= cut)
    if cfg.drop_partial_bin:
        whole = ts_lit(as_of - timedelta(seconds=cfg.bin_seconds))
        recent = recent.filter(F.col("time_bin") <= whole)
    if cfg.latest_sha_only:
        if latest is None:
            latest = _newest_bin_shas(recent)
        past, recent = _latest_sha_only(past, recent, latest)
        spans = None if spans is None else _without(spans, latest)

    baseline = _baseline(past) if spans is None else merge_moments(
        span_moments(past, cfg).unionByName(spans.select(*MOMENTS))
    )
    detection = (
        recent.withColumn("time_bin", F.when(F.expr(f"signal_type = '{SIG_DEPLOY}'"), ts_lit(as_of)).otherwise(F.col("time_bin")))
        .groupBy("signal_type", F.expr(_BASELINE_KEY), "service", "route", "time_bin")
        .agg(F.expr("avg(value) AS actual"), F.expr("sum(requests) AS requests"), F.expr("sum(errors) AS errors"))
        .filter(_gate(cfg))
    )
    sign = f"IF(signal_type = '{SIG_FRESHNESS}', -1, 1)"
    limit = f"IF(signal_type = '{SIG_DEPLOY}', {cfg.deploy_threshold}D, {cfg.z_threshold}D)"
    return (
        detection.join(baseline, ["signal_type", "base_key"])
        .selectExpr("*", f"{sign} * (actual - baseline_mean) / baseline_stddev AS anomaly_score")
        .filter(f"anomaly_score >= {limit}")
        .selectExpr(
            "time_bin",
            "signal_type",
            "service",
            "route",
            f"""CASE signal_type WHEN '{SIG_SIGNATURE}' THEN NULL WHEN '{SIG_DROPS}' THEN 0L
                ELSE requests END AS requests""",
            f"""CASE WHEN signal_type IN ('{SIG_LATENCY}', '{SIG_DEPLOY}') THEN NULL
                WHEN signal_type = '{SIG_FRESHNESS}' THEN 0.0D
                WHEN signal_type IN ('{SIG_SIGNATURE}', '{SIG_DROPS}') THEN actual ELSE errors END AS errors""",
            "actual",
            "baseline_mean",
            "baseline_stddev",
            "anomaly_score",
        )
    )


def _baseline(past: DataFrame) -> DataFrame:
    return (
        past.groupBy("signal_type", *[F.expr(rule).alias(name) for name, rule in _BASELINE_RULES.items()])
        .agg(F.expr("avg(value) AS baseline_mean"), F.expr("stddev_samp(value) AS baseline_stddev"))
        .filter("baseline_stddev > 0")
        .drop("_service", "_route")
    )


MOMENTS = ["span_start", "signal_type", "series_key", "service", "route", "n", "mean", "m2"]


def span_moments(frame: DataFrame, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """Per series and refresh span the number of bins, their mean and sum of squared distances from it.

    Moments of spans merge to those of any longer time (:func:`merge_moments`), so a
    baseline reads one row per span instead of its bins.
    """
    return (
        frame.filter("value IS NOT NULL")
        .groupBy(time_bin("time_bin", cfg.refresh_span).alias("span_start"), "signal_type", "series_key", "service", "route")
        .agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.expr("var_pop(value) * count(value) AS m2"))
    )


def merge_moments(spans: DataFrame) -> DataFrame:
    """Baselines from moments; the distances of the spans' means are taken from the merged mean, so nothing cancels out."""
    keyed = spans.withColumns({name: F.expr(rule) for name, rule in _BASELINE_RULES.items()})
    keys = list(_BASELINE_RULES)
    whole = keyed.groupBy("signal_type", *keys).agg(F.sum("n").alias("_all"), (F.sum(F.col("mean") * F.col("n")) / F.sum("n")).alias("_mean"))
    same = join_same(keyed.select("signal_type", *keys, "n", "mean", "m2"), whole, ["signal_type", *keys])
    apart = F.col("m2") + F.col("n") * (F.col("mean") - F.col("_mean")) * (F.col("mean") - F.col("_mean"))
    merged = same.groupBy("signal_type", *keys).agg(F.sum(apart).alias("_m2"), F.max("_all").alias("_n"), F.max("_mean").alias("baseline_mean"))
    spread = F.when(F.col("_n") > 1, F.sqrt(F.col("_m2") / (F.col("_n") - 1)))
    return merged.select("signal_type", "base_key", "baseline_mean", spread.alias("baseline_stddev")).filter("baseline_stddev > 0")


def _newest_bin_shas(recent: DataFrame) -> DataFrame:
    return (
        recent.filter(F.col("signal_type") == SIG_DEPLOY)
        .groupBy("service")
        .agg(F.max_by("route", F.struct("time_bin", "route")).alias("deployment_sha"))
    )


def _without(rows: DataFrame, latest: DataFrame) -> DataFrame:
    """Rows of all series but the deployments of the newest SHAs."""
    keys = ["signal_type", "service", "route"]
    newest = latest.select(F.lit(SIG_DEPLOY).alias("signal_type"), "service", F.col("deployment_sha").alias("route"))
    return rows.join(newest, keys, "left_anti").select(*rows.columns)


def _latest_sha_only(past: DataFrame, recent: DataFrame, latest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Judge only the newest SHA of a service, against the bins of its other SHAs."""
    deploy = F.col("signal_type") == SIG_DEPLOY
    newest = latest.select(F.lit(SIG_DEPLOY).alias("signal_type"), "service", F.col("deployment_sha").alias("route"))
    kept = recent.filter(deploy).join(newest, ["signal_type", "service", "route"], "left_semi").select(*recent.columns)
    return _without(past, latest), recent.filter(~deploy).unionByName(kept)


# ── detectors ───────────────────────────────────────────────────────────────

def _both(frame, ts, recent, *args):
    return frame(ts, *args), None if recent is None else frame(recent, *args)


def backend_http_error_rate_anomalies(ts, as_of, cfg=ObsConfig(), recent=None) -> DataFrame:
    past, now = _both(error_rate_frame, ts, recent)
    return zscore_detect(past, as_of, cfg, now)


def route_latency_anomalies(ts, as_of, cfg=ObsConfig(), recent=None) -> DataFrame:
    past, now = _both(latency_frame, ts, recent)
    return zscore_detect(past, as_of, cfg, now)


def error_signature_spike_anomalies(ts, as_of, cfg=ObsConfig(), recent=None) -> DataFrame:
    past, now = _both(signature_frame, ts, recent)
    return zscore_detect(past, as_of, cfg, now)


def forwarder_freshness_drop_anomalies(ts, as_of, cfg=ObsConfig(), recent=None) -> DataFrame:
    past, now = _both(freshness_frame, ts, recent, cfg)
    return zscore_detect(past, as_of, cfg, now)


def forwarder_drop_failure_anomalies(ts, as_of, cfg=ObsConfig(), recent=None) -> DataFrame:
    past, now = _both(drops_frame, ts, recent, cfg)
    return zscore_detect(past, as_of, cfg, now)


def post_deployment_regression_anomalies(ts, as_of, cfg=ObsConfig(), recent=None) -> DataFrame:
    past, now = _both(deployment_frame, ts, recent)
    return zscore_detect(past, as_of, cfg, now)


def recent_anomaly_signals(rollups: dict[str, DataFrame], as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """All signals from (stored) roll-up tables, keyed by roll-up name."""
    frames = [
        error_rate_frame(rollups["ts_http_error_rate"]),
        latency_frame(rollups["ts_route_latency"]),
        signature_frame(rollups["ts_error_signatures"]),
        freshness_frame(rollups["ts_forwarder_freshness"], cfg),
        drops_frame(rollups["ts_forwarder_drops"], cfg),
        deployment_frame(rollups["ts_deployment_error_rate"]),
    ]
    union = frames[0]
    for frame in frames[1:]:
        union = union.unionByName(frame)
    return zscore_detect(union, as_of, cfg)


def signals_from_logs(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """All signals straight from raw logs: each row is read once for the counts and once for the latency.

    The bins of the whole history are stored first, far fewer rows than the logs; the baseline
    and the detection window are both read from there.
    """
    latest = latest_shas(split_logs(raw, as_of, cfg)[1], as_of, cfg) if cfg.latest_sha_only else None
    bins = materialize(signal_rollup(raw, as_of, cfg), "signal-bins")
    return zscore_detect(bins, as_of, cfg, latest=latest)


def empty_signals(spark) -> DataFrame:
    return spark.createDataFrame([], ", ".join(f"{n} {t}" for n, t in SIGNAL_COLUMNS))


def anomaly_score_trend(
    ts: DataFrame,
    as_of: datetime,
    cfg: ObsConfig = ObsConfig(),
    recent: DataFrame | None = None,
) -> DataFrame:
    """Score of every error-rate bin of the display window, without a threshold."""
    recent = ts if recent is None else recent
    cut = ts_lit(as_of - cfg.holdback)
    baseline = (
        ts.filter(F.col("time_bin") < cut)
        .groupBy("series_key")
        .agg(F.avg("error_rate").alias("_mean"), F.stddev_samp("error_rate").alias("_stddev"))
        .filter(F.col("_stddev") > 0)
    )
    shown = recent.filter(
        (F.col("time_bin") >= ts_lit(as_of - cfg.tile_rate_window))
        & (F.col("requests") >= cfg.min_requests_trend)
    )
    return shown.join(baseline, "series_key").select(
        "time_bin",
        "series_key",
        "service",
        "route",
        "requests",
        F.round(div0("error_rate - _mean", "_stddev"), 2).alias("z_score"),
    )


__all__ = [
    "FRAME",
    "anomaly_score_trend",
    "backend_http_error_rate_anomalies",
    "empty_signals",
    "error_signature_spike_anomalies",
    "first_recent_bin",
    "forwarder_drop_failure_anomalies",
    "forwarder_freshness_drop_anomalies",
    "post_deployment_regression_anomalies",
    "recent_anomaly_signals",
    "route_latency_anomalies",
    "signals_from_logs",
    "since",
    "split_logs",
    "stored_bins",
    "zscore_detect",
]
