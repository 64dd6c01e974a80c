"""One evaluation cycle: signals, alert, evidence, articles, incidents.

Signals are written to the cycle's own folder first. Everything after reads
that small table, so the logs are scanned once and Spark sees its true size.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import ObsConfig, ts_lit, utc_now
from ..operators import forecast
from ..operators.article_index import StoredIndex, search_index
from ..operators.alerts import alert_source, evaluate_alerts, fixed_alerts
from ..operators.detect import stored_bins
from ..operators.incidents import (
    KEY,
    attach_deployment,
    dedup_incidents,
    group_incidents,
    incident_report,
    remediation_candidates,
    still_open,
)
from ..operators.search import search_articles, search_snippet, signal_search_queries
from ..schemas import CLOSED_INCIDENT_COLUMNS, FIXED_ALERT_COLUMNS, INCIDENT_COLUMNS, names
from ..session import materialize, scratch
from ..sources.snapshots import added_by, pinned, place, stream_commits
from ..sources.tables import (
    COUNT_BINS,
    append_ml_detections,
    read_cycles,
    read_cycle_signals,
    read_ml_detections,
    read_raw_logs,
    write_cycle,
    write_signals,
)
from ..streaming.refresh import stored_rollups, stored_signals
from .evidence import evidence_errors, evidence_release, evidence_shas, matched_errors


@dataclass(frozen=True)
class Store:
    """Folders of one installation, all below ``root``."""

    root: str

    def __getattr__(self, name: str) -> str:
        if name.startswith("_"):
            raise AttributeError(name)
        return f"{self.root}/{name}"


def best_articles(signals: DataFrame, articles: DataFrame | StoredIndex) -> DataFrame:
    """The best article per signal series, with a snippet of its body."""
    queries = materialize(signal_search_queries(signals), "queries")
    asked = queries.select("query_id", "query").distinct()
    if isinstance(articles, StoredIndex):
        hits = search_index(articles, asked, k=1, snippet=True).select("query_id", "title", "snippet")
    else:
        hits = materialize(search_articles(asked, articles, k=1), "hits")
        bodies = articles.select("article_id", search_snippet(F.col("body")).alias("snippet"))
        hits = hits.select("query_id", "article_id", "title").join(bodies, "article_id")
    return queries.join(hits, "query_id").select("signal_type", "service", "route", "title", "snippet")


def build_incidents(
    signals: DataFrame,
    raw: DataFrame,
    open_incidents: DataFrame,
    as_of: datetime,
    cfg: ObsConfig = ObsConfig(),
    articles: DataFrame | StoredIndex | None = None,
    grouped: bool = False,
) -> DataFrame:
    """Incident rows for stored ``signals``: one per service, route and SHA, or one per cause (``grouped``)."""
    matched = materialize(matched_errors(signals, raw, as_of, cfg), "matched")
    shas = evidence_shas(signals, raw, as_of, cfg, matched=matched)
    attached = attach_deployment(signals, shas)
    if grouped:
        strong = remediation_candidates(attached, open_incidents.limit(0), cfg)
        chosen = materialize(group_incidents(strong, open_incidents), "incidents")
    else:
        chosen = materialize(dedup_incidents(remediation_candidates(attached, open_incidents, cfg)), "incidents")
    evidence = evidence_errors(chosen, raw, as_of, cfg, matched=matched)
    release = evidence_release(chosen, raw, as_of, cfg, matched=matched)
    hits = None if articles is None else best_articles(chosen, articles)
    return incident_report(chosen, evidence, hits, as_of, cfg, release)


def fit_models(spark: SparkSession, store: Store, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> None:
    """Train and store all models from the stored bins."""
    for name, (rollup, value, _) in forecast.MODELS.items():
        with scratch(spark, "fit"):
            ts = stored_bins(stored_rollups(spark, store.bins)[rollup], as_of, cfg)
            train = materialize(forecast.ml_train_input(ts, value, as_of, cfg), "train")
            forecast.save_model(forecast.fit_series_model(train, as_of, cfg), f"{store.models}/{name}")


def detect_with_models(
    spark: SparkSession, store: Store, as_of: datetime, cfg: ObsConfig = ObsConfig(), names=forecast.SCHEDULED
) -> DataFrame:
    """Run the stored models on the latest bins and keep what they flag."""
    for name in names:
        rollup, value, _ = forecast.MODELS[name]
        ts = stored_bins(stored_rollups(spark, store.bins)[rollup], as_of, cfg)
        recent = forecast.ml_detect_input(ts, value, as_of, cfg)
        model = forecast.load_model(spark, f"{store.models}/{name}")
        found = forecast.run_detection(name, model, recent, as_of, cfg)
        append_ml_detections(found, store.ml_detections, as_of, name)
    return forecast.recent_anomaly_signals_ml(read_ml_detections(spark, store.ml_detections), as_of, cfg)


def run_cycle(
    spark: SparkSession,
    store: Store,
    as_of: datetime,
    cfg: ObsConfig = ObsConfig(),
    use: str = "zscore",
    articles: DataFrame | StoredIndex | None = None,
    open_incidents: DataFrame | None = None,
    incidents: bool = False,
) -> bool:
    """Detect, alert and assemble incidents at ``as_of``; True when an alert fired.

    With ``incidents`` (or with ``open_incidents`` from elsewhere) incident rows are
    written, one per cause, except for causes of what the store remembers as open: incidents of earlier cycles
    that ``close_incidents`` has not closed. ``articles`` are best given as a stored index. The fixed limits are checked in every
    cycle, also when no signal and no log row has arrived.

    Everything is read as of one commit, the newest at the start: both kinds of bins belong to one
    refresh, and rows that arrive meanwhile wait for the next cycle.
    """
    with pinned(spark, store.root), scratch(spark, "cycle"):
        zscore = stored_signals(spark, store.bins, as_of, cfg)
        ml = detect_with_models(spark, store, as_of, cfg) if use == "forecast" else None
        write_signals(alert_source(zscore, ml, use), store.signals, as_of)
        signals = read_cycle_signals(spark, store.signals, as_of)
        fired = evaluate_alerts(spark, signals, as_of, store.alert_log, store.outbox, cfg)
        raw = read_raw_logs(spark, store.raw_logs)
        bins = stored_rollups(spark, store.bins)
        fixed = fixed_alerts(
            stored_bins(bins["ts_http_error_rate"], as_of, cfg), stored_bins(bins["ts_route_latency"], as_of, cfg), raw, as_of, cfg
        )
        write_cycle(fixed.select(*names(FIXED_ALERT_COLUMNS)), store.fixed_alerts, as_of)
        if fired and (incidents or open_incidents is not None):
            known = remembered_incidents(spark, store, as_of)
            if open_incidents is not None:
                known = known.unionByName(open_incidents.select(*KEY))
            rows = build_incidents(signals, raw, known, as_of, cfg, articles, grouped=True)
            write_cycle(rows.select(*names(INCIDENT_COLUMNS)), store.incidents, as_of)
        return fired


def remembered_incidents(spark: SparkSession, store: Store, as_of: datetime) -> DataFrame:
    """Service, route and SHA of the store's incidents that are open at ``as_of``."""
    return still_open(
        read_cycles(spark, store.incidents, INCIDENT_COLUMNS),
        read_cycles(spark, store.closed_incidents, CLOSED_INCIDENT_COLUMNS),
        as_of,
    )


def close_incidents(closed: DataFrame, store: Store, as_of: datetime) -> None:
    """Remember that the incidents of ``closed`` (service, route, SHA) were closed at ``as_of``."""
    write_cycle(closed.select(*KEY, ts_lit(as_of).alias("closed_at")), store.closed_incidents, as_of)


def stream_cycle(
    spark: SparkSession,
    store: Store,
    checkpoint: str,
    cfg: ObsConfig = ObsConfig(),
    clock=utc_now,
    trigger: dict | None = None,
    **options,
) -> StreamingQuery:
    """Run a cycle whenever a commit brings new bins, at most once per trigger.

    In silence no bins arrive; ``clock_cycle`` runs on time alone.
    """
    table = place(store.bins, COUNT_BINS)[1]

    def apply(batch: DataFrame, batch_id: int) -> None:
        if added_by(batch, table):
            run_cycle(batch.sparkSession, store, clock(), cfg, **options)

    writer = stream_commits(spark, store.root).writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "5 minutes"})).start()


def clock_cycle(
    spark: SparkSession, store: Store, checkpoint: str, cfg: ObsConfig = ObsConfig(), clock=utc_now,
    every: str = "5 minutes", **options,
) -> StreamingQuery:
    """Run a cycle at every tick, whether or not anything has arrived."""
    ticks = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def apply(batch: DataFrame, batch_id: int) -> None:
        run_cycle(batch.sparkSession, store, clock(), cfg, **options)

    return ticks.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(processingTime=every).start()
