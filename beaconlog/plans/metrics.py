"""Declarative metrics: named measures and dimensions over four tables.

The model is data. A query names a table, measures and dimensions; it becomes
one filter and one aggregation. Note that ``error_count`` of requests counts
5xx or error severities while ``error_rate`` counts 5xx only, as defined.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import ObsConfig
from ..functions import div0, grouped_percentile, is_error, join_same, time_bin
from ..operators import views
from ..operators.rollups import since


@dataclass(frozen=True)
class MetricTable:
    rows: Callable[[DataFrame], DataFrame]
    time: tuple[str, ...]
    dimensions: tuple[str, ...]
    measures: Mapping[str, Callable[[], Column]] = field(default_factory=dict)
    # measures answered by the exact percentile: name -> (column, share)
    percentiles: Mapping[str, tuple[str, float]] = field(default_factory=dict)


METRICS = {
    "http_requests": MetricTable(
        rows=views.http_requests,
        time=("ingest_ts", "source_ts"),
        dimensions=("service", "route", "method", "status_code", "deployment_sha", "environment"),
        measures={
            "request_count": lambda: F.count("*"),
            "error_count": lambda: F.sum(is_error()),
            "error_rate": lambda: div0("count_if(status_code >= 500)", "count(*)"),
            "avg_latency_ms": lambda: F.avg("duration_ms"),
        },
        percentiles={"p95_latency_ms": ("duration_ms", 0.95)},
    ),
    "application_errors": MetricTable(
        rows=views.application_errors,
        time=("ingest_ts",),
        dimensions=("service", "error_signature", "error_type", "error_message", "deployment_sha", "severity"),
        measures={"error_count": lambda: F.count("*")},
    ),
    "deployments": MetricTable(
        rows=views.deployments,
        time=("ingest_ts",),
        dimensions=("service", "deployment_sha", "environment"),
    ),
    "signals": MetricTable(
        rows=lambda signals: signals,
        time=("time_bin",),
        dimensions=("signal_type", "service", "route"),
        measures={
            "anomaly_score": lambda: F.max("anomaly_score"),
            "signal_count": lambda: F.count("*"),
        },
    ),
}


def metric_query(
    source: DataFrame,
    table: str,
    measures: Sequence[str] = (),
    dims: Sequence[str] = (),
    as_of: datetime | None = None,
    window: timedelta | None = None,
    filters: Sequence[Column] = (),
    grain_seconds: int | None = None,
    time: str | None = None,
    order: Sequence[Column] = (),
    limit: int | None = None,
    cfg: ObsConfig = ObsConfig(),
) -> DataFrame:
    """Aggregate ``table`` (built from ``source``: raw logs, or signals).

    Without measures the rows' dimensions and times are listed. With
    ``grain_seconds`` the time dimension, cut into bins, joins the grouping.
    """
    model = METRICS[table]
    time = time or model.time[0]
    unknown = [m for m in measures if m not in model.measures and m not in model.percentiles]
    unknown += [d for d in dims if d not in model.dimensions]
    unknown += [] if time in model.time else [time]
    if unknown:
        raise KeyError(f"{table} does not define {', '.join(unknown)}")

    # filter the source first, so that day partitions can be pruned
    if window is not None:
        if as_of is None:
            raise ValueError("a window needs as_of")
        source = since(source, as_of, window, cfg, time)
    rows = model.rows(source)
    for rule in filters:
        rows = rows.filter(rule)

    keys = list(dims)
    if grain_seconds:
        rows = rows.withColumn("_bin", time_bin(time, grain_seconds))
        keys.append("_bin")
    if not measures:
        out = rows.select(*dims, F.col("_bin" if grain_seconds else time).alias(time))
    else:
        plain = [model.measures[m]().alias(m) for m in measures if m in model.measures]
        shares: dict[str, dict[str, float]] = {}
        for m in measures:
            if m in model.percentiles:
                column, share = model.percentiles[m]
                shares.setdefault(column, {})[m] = share
        if shares:
            out = _with_percentiles(rows, keys, shares, plain)
        else:
            out = rows.groupBy(*keys).agg(*plain)
        bins = [F.col("_bin").alias(time)] if grain_seconds else []
        out = out.select(*dims, *bins, *measures)
    if order:
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)


def _with_percentiles(rows: DataFrame, keys: list[str], shares: dict[str, dict[str, float]], plain: list[Column]) -> DataFrame:
    """Percentiles of any number of columns next to the plain measures."""
    frames = []
    for column, wanted in shares.items():
        frames.append(grouped_percentile(rows, keys, column, wanted, aggs=plain if not frames else ()))
    out = frames[0]
    for frame in frames[1:]:
        out = join_same(out, frame, keys)
    return out


# ── verified queries ────────────────────────────────────────────────────────

def vq_error_rate_last_hour(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(),
                            window: timedelta = timedelta(hours=1)) -> DataFrame:
    out = metric_query(raw, "http_requests", ["request_count", "error_count", "error_rate"], ["service"],
                       as_of, window, cfg=cfg)
    return out.select(
        "service",
        F.col("request_count").alias("requests"),
        F.col("error_count").alias("errors"),
        F.round(F.col("error_rate") * 100, 2).alias("error_rate_pct"),
    ).orderBy(F.desc_nulls_first("error_rate_pct"), "service")


def vq_top_errors_last_30min(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(),
                             window: timedelta = timedelta(minutes=30), limit: int = 10) -> DataFrame:
    return (
        views.application_errors(since(raw, as_of, window, cfg))
        .groupBy("service", "error_signature")
        .agg(F.count("*").alias("error_count"), F.max("ingest_ts").alias("last_seen"))
        .orderBy(F.desc("error_count"), F.asc_nulls_last("service"), "error_signature")
        .limit(limit)
    )


def vq_recent_deployments(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(),
                          window: timedelta = timedelta(hours=24)) -> DataFrame:
    out = metric_query(raw, "deployments", (), ["service", "deployment_sha", "environment"], as_of, window, cfg=cfg)
    return out.select("service", "deployment_sha", "ingest_ts", "environment").orderBy(F.desc("ingest_ts"))


def vq_active_signals(signals: DataFrame) -> DataFrame:
    return signals.orderBy(F.desc_nulls_first("anomaly_score")).select(
        "signal_type",
        "service",
        "route",
        F.round("anomaly_score", 2).alias("anomaly_score"),
        F.round("actual", 4).alias("actual"),
        F.round("baseline_mean", 4).alias("baseline"),
    )
