"""Low-latency tumbling windows with a watermark.

These give running counts within seconds, but rows later than the watermark
are dropped. The exact, late-tolerant way is ``streaming.refresh``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import KEY_DROPS, KEY_FRESHNESS, ObsConfig
from ..functions import counted_percentile, div0, is_error, series_key
from ..operators import views
from ..operators.rollups import is_forwarder_drop, is_healthy_batch


def _window(rows: DataFrame, cfg: ObsConfig, watermark: str, *keys: str):
    bins = F.window("ingest_ts", f"{cfg.bin_seconds} seconds").alias("_w")
    return rows.withWatermark("ingest_ts", watermark).groupBy(bins, *keys)


def _errors():
    return F.sum(is_error()).alias("errors")


def stream_http_error_rate(logs: DataFrame, watermark: str = "15 minutes", cfg: ObsConfig = ObsConfig()) -> DataFrame:
    rows = logs.filter(views.is_http_request())
    out = _window(rows, cfg, watermark, "service", "route").agg(F.count("*").alias("requests"), _errors())
    return out.select(
        F.col("_w.start").alias("time_bin"), series_key("service", "route").alias("series_key"),
        "service", "route", "requests", "errors", div0("errors", "requests").alias("error_rate"),
    )


def stream_deployment_error_rate(logs: DataFrame, watermark: str = "15 minutes", cfg: ObsConfig = ObsConfig()) -> DataFrame:
    rows = logs.filter(views.is_http_request() & F.col("deployment_sha").isNotNull())
    out = _window(rows, cfg, watermark, "service", "deployment_sha").agg(F.count("*").alias("requests"), _errors())
    return out.select(
        F.col("_w.start").alias("time_bin"),
        series_key("service", "deployment_sha").alias("series_key"),
        "service", "deployment_sha", "requests", div0("errors", "requests").alias("error_rate"),
    )


def stream_error_signatures(logs: DataFrame, watermark: str = "15 minutes", cfg: ObsConfig = ObsConfig()) -> DataFrame:
    rows = logs.filter(views.is_application_error())
    out = _window(rows, cfg, watermark, "service", "error_signature").agg(F.count("*").alias("error_count"))
    return out.select(
        F.col("_w.start").alias("time_bin"),
        series_key("service", "error_signature").alias("series_key"),
        "service", "error_signature", "error_count",
    )


def stream_forwarder_freshness(logs: DataFrame, watermark: str = "15 minutes", cfg: ObsConfig = ObsConfig()) -> DataFrame:
    out = _window(logs.filter(is_healthy_batch(cfg)), cfg, watermark).agg(F.count("*").alias("healthy_events"))
    return out.select(F.col("_w.start").alias("time_bin"), F.lit(KEY_FRESHNESS).alias("series_key"), "healthy_events")


def stream_forwarder_drops(logs: DataFrame, watermark: str = "15 minutes", cfg: ObsConfig = ObsConfig()) -> DataFrame:
    out = _window(logs.filter(is_forwarder_drop(cfg)), cfg, watermark).agg(F.count("*").alias("drop_count"))
    return out.select(F.col("_w.start").alias("time_bin"), F.lit(KEY_DROPS).alias("series_key"), "drop_count")


def stream_latency_counts(logs: DataFrame, watermark: str = "15 minutes", cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """Requests per bin, route and distinct duration.

    Streaming state is spread by duration as well, so a busy route never sits
    in one state row; ``latency_from_counts`` turns the counts into T2.
    """
    rows = logs.filter(views.is_http_request() & F.col("duration_ms").isNotNull())
    out = _window(rows, cfg, watermark, "service", "route", "duration_ms").agg(F.count("*").alias("n"))
    return out.select(F.col("_w.start").alias("time_bin"), "service", "route", "duration_ms", "n")


def latency_from_counts(counts: DataFrame, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """T2 from duration counts (a batch read of the stream's output table)."""
    keys = ["time_bin", "service", "route"]
    out = counted_percentile(
        counts, keys, "duration_ms", "n", cfg.percentile, "p95_duration_ms", "requests", "avg_duration_ms"
    )
    return out.select(
        "time_bin", series_key("service", "route").alias("series_key"), "service", "route",
        "requests", "avg_duration_ms", "p95_duration_ms",
    )
