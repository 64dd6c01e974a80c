"""Evidence for signals: errors, routes, deployments and neighbouring signals.

Every query answers all signals at once. The log side is grouped before it
meets the signals, so the joins see group rows, not log rows.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import SIG_DEPLOY, SIG_SIGNATURE, ObsConfig
from ..functions import div0, is_error
from ..operators import views
from ..operators.rollups import since

SERIES = ["signal_type", "service", "route"]


def matched_errors(
    signals: DataFrame, raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(), literal: bool = False
) -> DataFrame:
    """Error groups (signature and SHA) that belong to each signal.

    All evidence about errors is drawn from these; stored once, they serve for every kind of it (``matched``).

    ``route`` of a signature signal holds the signature, that of a deployment
    signal the SHA; each is matched against the field it names. ``literal``
    compares it with the error's route for every signal.
    """
    groups = (
        views.application_errors(since(raw, as_of, cfg.evidence_window, cfg))
        .groupBy("service", "route", "error_signature", "deployment_sha")
        .agg(F.count("*").alias("n"), F.max("ingest_ts").alias("last_seen"))
    )
    kinds = ["route"] if literal else ["route", "error_signature", "deployment_sha"]
    named = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("named")) for k in kinds]))
    groups = groups.withColumn("_m", named).select(
        "service", "_m.kind", "_m.named", "error_signature", "deployment_sha", "n", "last_seen"
    )
    kind = F.lit("route")
    if not literal:
        kind = (
            F.when(F.col("signal_type") == SIG_SIGNATURE, "error_signature")
            .when(F.col("signal_type") == SIG_DEPLOY, "deployment_sha")
            .otherwise("route")
        )
    series = signals.select(*SERIES).distinct().withColumn("kind", kind).withColumn("named", F.col("route"))
    return (
        series.join(groups, ["service", "kind", "named"])
        .groupBy(*SERIES, "error_signature", "deployment_sha")
        .agg(F.sum("n").alias("n"), F.max("last_seen").alias("last_seen"))
    )


def _groups(signals, raw, as_of, cfg, literal, matched: DataFrame | None) -> DataFrame:
    """The error groups of ``signals``, from ``matched`` if given."""
    if matched is None:
        return matched_errors(signals, raw, as_of, cfg, literal)
    return matched.join(signals.select(*SERIES).distinct(), SERIES, "left_semi")


def evidence_errors(
    signals: DataFrame,
    raw: DataFrame,
    as_of: datetime,
    cfg: ObsConfig = ObsConfig(),
    limit: int = 10,
    literal: bool = False,
    matched: DataFrame | None = None,
) -> DataFrame:
    """Most frequent error signatures of each signal, with the SHAs they occurred on."""
    per_signature = (
        _groups(signals, raw, as_of, cfg, literal, matched)
        .groupBy(*SERIES, "error_signature")
        .agg(
            F.sum("n").alias("error_count"),
            F.max("last_seen").alias("last_seen"),
            F.array_join(F.array_sort(F.collect_list("deployment_sha")), ", ").alias("deployment_shas"),
        )
    )
    order = Window.partitionBy(*SERIES).orderBy(F.desc("error_count"), "error_signature")
    return per_signature.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= limit)


def evidence_shas(
    signals: DataFrame, raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(), literal: bool = False,
    matched: DataFrame | None = None,
) -> DataFrame:
    """The SHA most errors of a signal occurred on."""
    per_sha = (
        _groups(signals, raw, as_of, cfg, literal, matched)
        .filter("deployment_sha IS NOT NULL")
        .groupBy(*SERIES, "deployment_sha")
        .agg(F.sum("n").alias("n"))
    )
    return per_sha.groupBy(*SERIES).agg(
        F.max_by("deployment_sha", F.struct("n", "deployment_sha")).alias("deployment_sha")
    )


def evidence_release(
    signals: DataFrame, raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(), literal: bool = False,
    matched: DataFrame | None = None,
) -> DataFrame:
    """What the release behind a signal tells: one row per series and ``deployment_sha`` of ``signals``.

    ``errors`` of the signal in all, ``sha_errors`` on its SHA, ``previous_errors`` on the SHA that the service
    deployed first before it (``previous_sha``); ``deployed_at`` is the SHA's first deployment within the
    history, ``environment`` that of its newest one. A SHA that was not deployed within the history has neither.
    """
    counted = _groups(signals, raw, as_of, cfg, literal, matched).groupBy(*SERIES, F.col("deployment_sha").alias("_sha"))
    counted = counted.agg(F.sum("n").alias("n"))
    deployed = (
        views.deployments(since(raw, as_of, cfg.history, cfg)).filter("deployment_sha IS NOT NULL")
        .groupBy("service", "deployment_sha")
        .agg(F.min("ingest_ts").alias("deployed_at"), F.max(F.struct("ingest_ts", "environment"))["environment"].alias("environment"))
    )
    order = Window.partitionBy("service").orderBy("deployed_at", "deployment_sha")
    released = deployed.withColumn("previous_sha", F.lag("deployment_sha").over(order))
    own = signals.select(*SERIES, "deployment_sha").distinct().join(released, ["service", "deployment_sha"], "left")
    errors = lambda rule: F.coalesce(F.sum(F.when(rule, F.col("n"))), F.lit(0)).cast("long")
    return own.join(counted, SERIES, "left").groupBy(
        *SERIES, "deployment_sha", "deployed_at", "environment", "previous_sha"
    ).agg(
        errors(F.lit(True)).alias("errors"),
        errors(F.col("_sha") == F.col("deployment_sha")).alias("sha_errors"),
        errors(F.col("_sha") == F.col("previous_sha")).alias("previous_errors"),
    )


def evidence_top_routes(raw: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig(), limit: int = 10) -> DataFrame:
    flag = is_error()
    return (
        views.http_requests(since(raw, as_of, cfg.holdback, cfg))
        .groupBy("service", "route")
        .agg(F.count("*").alias("requests"), F.sum(flag).alias("errors"))
        .withColumn("error_rate_pct", F.round(div0("errors", "requests") * 100, 2))
        .orderBy(F.desc("error_rate_pct"), F.desc("requests"), "service", "route")
        .limit(limit)
    )


def evidence_sha_trend(ts: DataFrame, latest: DataFrame) -> DataFrame:
    """Error-rate bins of the SHA each service ran last (``latest``: see ``latest_shas``)."""
    return ts.join(latest, ["service", "deployment_sha"]).select(
        "time_bin", "service", "deployment_sha", "requests", "error_rate"
    )


def related_signals(signals: DataFrame) -> DataFrame:
    """Other kinds of signal on the same service and route.

    Signals are first reduced to one row per kind, so a service and route
    contributes at most one row for every ordered pair of the six kinds.
    """
    kinds = signals.groupBy(*SERIES).agg(
        F.count("*").alias("bins"), F.max("anomaly_score").alias("max_score")
    )
    other = kinds.select(
        "service",
        "route",
        F.col("signal_type").alias("related_type"),
        F.col("bins").alias("related_bins"),
        F.col("max_score").alias("related_max_score"),
    )
    return (
        kinds.select(*SERIES)
        .join(other, ["service", "route"])
        .filter(F.col("signal_type") != F.col("related_type"))
        .select(*SERIES, "related_type", "related_bins", "related_max_score")
    )


