"""Exact incremental roll-ups: recompute the time spans that new rows touch."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import EPOCH, SIG_DEPLOY, ObsConfig, as_utc, ts_lit
from ..functions import time_bin
from ..operators.detect import first_recent_bin, span_moments, stored_bins, zscore_detect
from ..operators.rollups import count_bins, rollups_from_bins, series_frame, ts_route_latency
from ..session import materialize
from ..sources.snapshots import added_by, commit, place, stream_commits
from ..sources.tables import bin_changes, read_count_bins, read_latency_bins, read_moments, read_raw_logs, read_raw_paths


def touched_spans(rows: DataFrame, cfg: ObsConfig = ObsConfig()) -> list[datetime]:
    """Starts of the refresh spans that ``rows`` fall into (a few instants)."""
    start = F.unix_seconds(time_bin("ingest_ts", cfg.refresh_span))
    found = rows.select(start.alias("s")).distinct().collect()
    return sorted(EPOCH + timedelta(seconds=r.s) for r in found if r.s is not None)


def refresh_bins(
    spark: SparkSession,
    raw_path: str,
    bins_path: str,
    spans: Sequence[datetime],
    cfg: ObsConfig = ObsConfig(),
) -> None:
    """Recompute every bin of the given spans from the raw table and replace them.

    Whole spans are recomputed, so late rows are absorbed without a watermark
    and a repeated call changes nothing. Bins never straddle spans. The scan
    is limited to the days of the spans and to their outer time range. Counts and
    latency appear together, in one commit.
    """
    if not spans:
        return
    first, last = min(spans), max(spans) + timedelta(seconds=cfg.refresh_span)
    raw = read_raw_logs(spark, raw_path).filter(
        F.col("ingest_date").between(F.lit(first.date()), F.lit(last.date()))
        & (F.col("ingest_ts") >= ts_lit(first))
        & (F.col("ingest_ts") < ts_lit(last))
    )
    if len(spans) * timedelta(seconds=cfg.refresh_span) < last - first:
        # spans between them that nothing touched; a handful of numbers per day
        wanted = spark.createDataFrame([((s - EPOCH) // timedelta(seconds=1),) for s in spans], "_span bigint")
        raw = raw.withColumn("_span", F.unix_seconds(time_bin("ingest_ts", cfg.refresh_span))).join(
            wanted, "_span", "left_semi"
        ).drop("_span")
    # stored before use: bins are read again for their moments
    counts, latency = materialize(count_bins(raw, None, cfg), "counts"), materialize(ts_route_latency(raw, None, cfg), "latency")
    moments = span_moments(series_frame(counts, latency), cfg)
    changes = bin_changes(counts, latency, moments, bins_path, spans, cfg.refresh_span)
    commit(spark, place(bins_path)[0], changes)


def stored_rollups(spark: SparkSession, bins_path: str) -> dict[str, DataFrame]:
    """T1 to T6 by name, read from the stored bins."""
    return rollups_from_bins(read_count_bins(spark, bins_path), read_latency_bins(spark, bins_path))


def stored_signals(
    spark: SparkSession, bins_path: str, as_of: datetime, cfg: ObsConfig = ObsConfig()
) -> DataFrame:
    """All signals from stored bins and moments.

    The baseline comes from the moments of the spans that lie whole between the start of the history and the
    holdback; bins are read for the detection window and the two spans at the ends only.
    """
    span, start, cut = timedelta(seconds=cfg.refresh_span), as_utc(as_of) - cfg.history, as_utc(as_of) - cfg.holdback
    first, last = EPOCH - ((EPOCH - start) // span) * span, EPOCH + ((cut - EPOCH) // span) * span
    first = first if first >= start else first + span
    last = max(first, last)

    def ends(bins: DataFrame) -> DataFrame:
        days = (F.col("bin_date") <= F.lit(first.date())) | (F.col("bin_date") >= F.lit(last.date()))
        return bins.filter(days & ((F.col("time_bin") < ts_lit(first)) | (F.col("time_bin") >= ts_lit(last))))

    counts = stored_bins(ends(read_count_bins(spark, bins_path)), as_of, cfg)
    latency = stored_bins(ends(read_latency_bins(spark, bins_path)), as_of, cfg)
    moments = read_moments(spark, bins_path).filter(
        F.col("bin_date").between(F.lit(first.date()), F.lit(last.date()))
        & (F.col("span_start") >= ts_lit(first)) & (F.col("span_start") < ts_lit(last))
    )
    latest = None
    if cfg.latest_sha_only:
        latest = latest_stored_shas(counts.filter(F.col("time_bin") >= ts_lit(first_recent_bin(as_of, cfg))))
    return zscore_detect(series_frame(counts, latency), as_of, cfg, latest=latest, spans=moments)


def latest_stored_shas(counts: DataFrame) -> DataFrame:
    """The SHA of each service's newest request, from stored bins; as ``rollups.latest_shas`` tells it from logs."""
    newest = F.max_by("route", F.struct("last_seen", "route")).alias("deployment_sha")
    return counts.filter(F.col("signal_type") == SIG_DEPLOY).groupBy("service").agg(newest)


def stream_refresh(
    spark: SparkSession,
    raw_path: str,
    bins_path: str,
    checkpoint: str,
    cfg: ObsConfig = ObsConfig(),
    trigger: dict | None = None,
) -> StreamingQuery:
    """Follow the commits of the raw table and refresh the spans their rows touch."""
    root, table = place(raw_path)
    commits = stream_commits(spark, root)

    def apply(batch: DataFrame, batch_id: int) -> None:
        session, parts = batch.sparkSession, added_by(batch, table)
        if parts:
            rows = read_raw_paths(session, raw_path, parts)
            refresh_bins(session, raw_path, bins_path, touched_spans(rows, cfg), cfg)

    writer = commits.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "5 minutes"})).start()
