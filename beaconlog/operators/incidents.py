"""From signals and evidence to de-duplicated incident rows."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import (
    SIG_DEPLOY,
    SIG_DROPS,
    SIG_ERROR_RATE,
    SIG_FRESHNESS,
    SIG_LATENCY,
    SIG_SIGNATURE,
    ObsConfig,
    ts_lit,
)
from ..functions import iso_z
from ..session import materialize

KEY = ["service", "route", "deployment_sha"]
LABELS = "observability, anomaly, critical"
# How a signal is called in a title.
TITLES = {
    SIG_ERROR_RATE: "Backend HTTP Error Rate",
    SIG_LATENCY: "Route Latency p95",
    SIG_SIGNATURE: "Error Signature Spike",
    SIG_FRESHNESS: "Forwarder Freshness Drop",
    SIG_DROPS: "Forwarder Drop Failure",
    SIG_DEPLOY: "Post Deployment Regression",
}


def attach_deployment(signals: DataFrame, shas: DataFrame) -> DataFrame:
    """Signals with a SHA: their own for deployment signals, else that of most errors."""
    series = ["signal_type", "service", "route"]
    found = shas.select(*series, F.col("deployment_sha").alias("_sha"))
    own = F.when(F.col("signal_type") == SIG_DEPLOY, F.col("route"))
    return signals.join(found, series, "left").select(
        *signals.columns, F.coalesce(own, F.col("_sha")).alias("deployment_sha")
    )


def remediation_candidates(
    signals: DataFrame, open_incidents: DataFrame, cfg: ObsConfig = ObsConfig()
) -> DataFrame:
    """Signals worth acting on: strong, code-related, with a SHA, not open already."""
    strong = signals.filter(
        F.lit(cfg.remediation_enabled)
        & (F.col("anomaly_score") >= cfg.incident_min_score)
        & F.col("signal_type").isin(*cfg.incident_types)
        & F.col("deployment_sha").isNotNull()
    )
    known = open_incidents.select(*KEY)
    same = None
    for key in KEY:
        rule = strong[key].eqNullSafe(known[key])
        same = rule if same is None else same & rule
    return strong.join(known, same, "left_anti")


def still_open(incidents: DataFrame, closed: DataFrame, as_of: datetime) -> DataFrame:
    """Keys of stored incidents that fired before ``as_of`` and were not closed since."""
    before = incidents.filter(F.col("fired_at") < ts_lit(as_of))
    newest = before.groupBy(*KEY).agg(F.max("fired_at").alias("_fired"))
    done = closed.filter(F.col("closed_at") <= ts_lit(as_of)).groupBy(*KEY).agg(F.max("closed_at").alias("_closed"))
    done = done.select(*[F.col(k).alias(f"_{k}") for k in KEY], "_closed")
    same = F.col("_closed") >= F.col("_fired")
    for key in KEY:
        same = same & F.col(key).eqNullSafe(F.col(f"_{key}"))
    return newest.join(done, same, "left_anti").select(*KEY)


def dedup_incidents(candidates: DataFrame) -> DataFrame:
    """The strongest signal per service, route and SHA (combined before the shuffle)."""
    rest = [c for c in candidates.columns if c not in KEY]
    order = F.struct("anomaly_score", F.col("time_bin"), "signal_type")
    return (
        candidates.groupBy(*KEY)
        .agg(F.max_by(F.struct(*rest), order).alias("_row"))
        .select(*KEY, "_row.*")
        .select(*candidates.columns)
    )


# ── one incident per cause ──────────────────────────────────────────────────

def _clues(rows: DataFrame) -> DataFrame:
    """``node, clue``: what a signal tells about its cause. Signals with a clue in common belong together.

    A clue is a SHA or a route of a service. A signature names the route behind its last colon, and
    a deployment signal carries its SHA in ``route``, so neither is a route itself.
    """
    kind, route = F.col("signal_type"), F.col("route")
    behind = F.regexp_extract("route", ":(/.*)$", 1)
    place = F.when(kind == SIG_DEPLOY, F.lit(None)).when(kind == SIG_SIGNATURE, F.nullif(behind, F.lit(""))).otherwise(route)
    clue = lambda name, value: F.when(value.isNotNull(), F.struct(F.lit(name).alias("kind"), "service", value.alias("value")))
    clues = F.array_compact(F.array(clue("sha", F.col("deployment_sha")), clue("route", place)))
    return rows.select("node", F.explode(clues).alias("clue"))


def connected(edges: DataFrame) -> DataFrame:
    """``node, cause``: the least node that can be reached over shared clues, for nodes with any clue.

    Labels go from nodes to clues and back, each time two-phase minima; a node then takes the label of its label
    as well, so long chains are halved. Rounds are stored, so they neither grow the plan nor hang on an executor.
    """
    labels = materialize(edges.groupBy("node").agg(F.col("node").alias("cause")).distinct(), "causes")
    while True:
        met = edges.join(labels, "node").groupBy("clue").agg(F.min("cause").alias("cause"))
        least = edges.join(met, "clue").groupBy("node").agg(F.min("cause").alias("_near"))
        far = labels.select(F.col("node").alias("_near"), F.col("cause").alias("_far"))
        step = labels.join(least, "node").join(far, "_near", "left")
        step = step.select("node", F.least("cause", "_near", "_far").alias("_new"), "cause")
        moved = materialize(step, "causes")
        labels = moved.select("node", F.col("_new").alias("cause"))
        if moved.filter("_new <> cause").isEmpty():
            return labels


def group_incidents(candidates: DataFrame, open_incidents: DataFrame) -> DataFrame:
    """One row per cause: the strongest signal, ``incident_id``, and the number of signals behind it.

    Signals and open incidents that share a SHA or a route of a service, directly or over others, have
    one cause. A cause with an open incident gets no row, so a later cycle adds none to it.
    ``open_incidents`` has service, route, SHA and, if known, ``signal_type``; their ``route`` is taken for a route or a
    SHA as it is. The id is a hash of the cause's least clue and of the first bin in which it was seen.
    """
    own = candidates.columns
    told = open_incidents
    if "signal_type" not in told.columns:
        told = told.withColumn("signal_type", F.when(F.col("route") == F.col("deployment_sha"), SIG_DEPLOY).otherwise(
            F.when(F.col("route").rlike("^[^/].*:/"), SIG_SIGNATURE)))
    told = told.select("signal_type", "service", "route", "deployment_sha").distinct()
    node = F.sha2(F.to_json(F.struct("_open", "signal_type", "service", "route", "deployment_sha")), 256)
    both = materialize(
        candidates.withColumn("_open", F.lit(False)).unionByName(told.withColumn("_open", F.lit(True)), allowMissingColumns=True)
        .withColumn("node", node), "signal-nodes",
    )
    clues = materialize(_clues(both).distinct(), "clues")
    causes = connected(clues)
    known = both.filter("_open").join(causes, "node").select("cause").distinct()
    signals = both.filter("NOT _open").join(causes, "node").join(known, "cause", "left_anti")
    first = clues.join(causes, "node").groupBy("cause").agg(F.min("clue").alias("_clue"))
    # rounded, so that two signals of one spike tie whatever order their baselines are summed in
    order = F.struct(F.round("anomaly_score", 9), "time_bin", "signal_type", "route")
    best = signals.groupBy("cause").agg(
        F.max_by(F.struct(*own), order).alias("_row"), F.count_distinct("node").alias("signals"), F.min("time_bin").alias("_seen")
    )
    key = F.sha2(F.to_json(F.struct("_clue", F.unix_seconds("_seen").alias("seen"))), 256)
    return best.join(first, "cause").select("_row.*", F.substring(key, 1, 32).alias("incident_id"), "signals")


def _span(window: timedelta) -> str:
    seconds = int(window.total_seconds())
    for size, unit in ((86400, "day"), (3600, "hour"), (60, "min")):
        if seconds % size == 0:
            count = seconds // size
            return f"{count} {unit}" + ("s" if count != 1 and unit != "min" else "")
    return f"{seconds} s"


def _shown(value: Column) -> Column:
    """Rates as percentages, other values as numbers."""
    rate = F.col("signal_type").isin(SIG_ERROR_RATE, SIG_DEPLOY)
    return F.when(rate, F.format_string("%.1f%%", F.round(value * 100, 1))).otherwise(
        F.format_string("%.1f", F.round(value, 1))
    )


def _release_lines() -> Column:
    """Two lines on a release: the errors on its SHA, and where and after which other one it was deployed."""
    share = F.when(F.col("errors") > 0, F.concat(F.lit(" ("), F.format_string("%.1f%%", F.round(100 * F.col("sha_errors") / F.col("errors"), 1)), F.lit(")")))
    on_sha = F.concat(
        F.lit("Errors on SHA "), F.coalesce("deployment_sha", F.lit("unknown")), F.lit(": "), F.col("sha_errors").cast("string"),
        F.lit(" of "), F.col("errors").cast("string"), F.coalesce(share, F.lit("")),
    )
    when = F.coalesce(F.concat(iso_z(F.col("deployed_at")), F.lit(" to "), F.coalesce("environment", F.lit("unknown"))), F.lit("unknown"))
    before = F.coalesce(
        F.concat(F.col("previous_sha"), F.lit(" with "), F.col("previous_errors").cast("string"), F.lit(" errors")), F.lit("none")
    )
    return F.concat(on_sha, F.lit("\nDeployed: "), when, F.lit(" | Previous SHA: "), before)


def incident_report(
    incidents: DataFrame,
    evidence: DataFrame,
    hits: DataFrame | None,
    as_of: datetime,
    cfg: ObsConfig = ObsConfig(),
    release: DataFrame | None = None,
) -> DataFrame:
    """One row per incident: title, text, labels, SHA.

    ``evidence`` has ranked error rows per signal; ``hits`` (optional) the best
    article per signal in columns signal_type, service, route, title, snippet; ``release`` (optional)
    one row per signal and SHA about the deployment behind it.
    """
    series = ["signal_type", "service", "route"]
    line = F.format_string(
        "- %s: %s errors, last seen %s, SHAs %s",
        "error_signature", F.col("error_count").cast("string"), iso_z(F.col("last_seen")), "deployment_shas",
    )
    # evidence is ranked, so at most its limit of lines per signal
    lines = evidence.groupBy(*series).agg(
        F.array_join(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", line.alias("line")))), lambda r: r["line"]),
            "\n",
        ).alias("_evidence")
    )
    out = incidents.join(lines, series, "left")
    if hits is not None:
        out = out.join(hits.select(*series, F.col("title").alias("_title"), F.col("snippet").alias("_snippet")),
                       series, "left")
    else:
        out = out.withColumn("_title", F.lit(None).cast("string")).withColumn("_snippet", F.lit(None).cast("string"))
    facts = []
    if release is not None:
        told = release.select(*series, F.col("deployment_sha").alias("_sha"), _release_lines().alias("_release"))
        same = F.col("_sha").eqNullSafe(F.col("deployment_sha"))
        for key in series:
            same = same & out[key].eqNullSafe(told[key])
        out = out.join(told, same, "left").select(*[out[c] for c in out.columns], "_release")
        facts = [F.col("_release")]
    name = F.col("signal_type")
    for signal, text in TITLES.items():
        name = F.when(F.col("signal_type") == signal, text).otherwise(name)
    z = F.format_string("%.2f", F.round("anomaly_score", 2))
    article = F.concat(F.lit("Related article: "), F.col("_title"), F.lit("\n"), F.col("_snippet"))
    more = [F.concat(F.lit("Signals of this cause: "), F.col("signals").cast("string"))] if "signals" in out.columns else []
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Signal: "), F.col("signal_type")),
        *more,
        F.concat(F.lit("Service: "), F.col("service"), F.lit(" | Route: "), F.col("route")),
        F.concat(F.lit("Anomaly score: "), z, F.lit(f" (threshold {cfg.z_threshold})")),
        F.concat(F.lit("Actual: "), _shown(F.col("actual")), F.lit(" | Baseline mean: "),
                 _shown(F.col("baseline_mean")), F.lit(" | Baseline stddev: "), _shown(F.col("baseline_stddev"))),
        F.lit(f"Detection window: last {_span(cfg.holdback)} | Baseline window: last {_span(cfg.history)}"),
        F.concat(F.lit("Fired at: "), iso_z(ts_lit(as_of))),
        F.lit("Evidence:"),
        F.coalesce(F.col("_evidence"), F.lit("no matching errors")),
        *facts,
        F.coalesce(article, F.lit("Related article: none")),
    )
    return out.select(
        F.concat(F.lit("[Anomaly] "), name, F.lit(" - "), F.col("route"), F.lit(" (z="), z, F.lit(")")).alias("title"),
        "signal_type",
        "service",
        "route",
        "deployment_sha",
        "anomaly_score",
        text.alias("body"),
        F.lit(LABELS).alias("labels"),
        ts_lit(as_of).alias("fired_at"),
        *[c for c in ("incident_id", "signals") if c in out.columns],
    )
