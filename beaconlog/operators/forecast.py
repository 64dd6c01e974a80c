"""Forecast-based detector: linear trend + time-of-day level + residual spread.

The model of a series is a handful of aggregates, so fitting and applying it
are ordinary group-bys and equi-joins; no series is handled on the driver.

* ``coef``: per series slope, intercept, residual spread, number of points
* ``phase``: per series and time-of-day phase the mean offset from the trend
* ``resid``: the training residuals, for ranking a new residual among them
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime
from statistics import NormalDist

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import ObsConfig, ts_lit
from ..schemas import ML_DETECTION_COLUMNS, names
from ..sources.snapshots import KEY, Change, commit, pinned, place, read

# Model names, the roll-up and column each learns from, and the
# signal type of its detections. The third model is trained but not scheduled.
MODELS = {
    "HTTP_ERROR_RATE_ANOMALY_MODEL": ("ts_http_error_rate", "error_rate", "backend_http_error_rate_ml"),
    "ROUTE_LATENCY_ANOMALY_MODEL": ("ts_route_latency", "p95_duration_ms", "route_latency_ml"),
    "ERROR_SIGNATURE_ANOMALY_MODEL": ("ts_error_signatures", "error_count", "error_signature_ml"),
}
SCHEDULED = ("HTTP_ERROR_RATE_ANOMALY_MODEL", "ROUTE_LATENCY_ANOMALY_MODEL")


@dataclass(frozen=True)
class SeriesModel:
    coef: DataFrame
    phase: DataFrame
    resid: DataFrame


def _route(ts: DataFrame) -> Column:
    return F.col("error_signature" if "error_signature" in ts.columns else "route").alias("route")


def _input(ts: DataFrame, value: str, rule: Column) -> DataFrame:
    return ts.filter(rule).select(
        "time_bin", "series_key", "service", _route(ts), F.col(value).cast("double").alias("y")
    )


def ml_train_input(ts: DataFrame, value: str, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    """Bins old enough never to overlap a detection run."""
    return _input(ts, value, F.col("time_bin") < ts_lit(as_of - cfg.ml_holdback))


def ml_detect_input(ts: DataFrame, value: str, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    return _input(ts, value, F.col("time_bin") >= ts_lit(as_of - cfg.ml_holdback))


def _days(as_of: datetime) -> Column:
    """Time in days relative to the clock; small numbers keep the fit stable."""
    return (F.unix_seconds("time_bin") - F.unix_seconds(ts_lit(as_of))) / F.lit(86400.0)


def _phase(cfg: ObsConfig) -> Column:
    return F.floor(F.pmod(F.unix_seconds("time_bin"), F.lit(86400)) / cfg.ml_phase_seconds)


def fit_series_model(train: DataFrame, as_of: datetime, cfg: ObsConfig = ObsConfig()) -> SeriesModel:
    """Fit every series at once; series shorter than the needed history have no model."""
    points = train.filter(F.col("y").isNotNull()).select(
        "series_key", "y", _days(as_of).alias("x"), _phase(cfg).alias("phase"), "time_bin"
    )
    need = cfg.ml_min_history.total_seconds() - cfg.ml_holdback.total_seconds() - cfg.bin_seconds
    covered = F.max(F.unix_seconds("time_bin")) - F.min(F.unix_seconds("time_bin"))
    line = (
        points.groupBy("series_key")
        .agg(
            F.regr_slope("y", "x").alias("slope"),
            F.regr_intercept("y", "x").alias("intercept"),
            covered.alias("_covered"),
        )
        .filter((F.col("_covered") >= need) & F.col("slope").isNotNull())
        .drop("_covered")
    )
    off_trend = points.join(line, "series_key").withColumn(
        "off", F.col("y") - (F.col("intercept") + F.col("slope") * F.col("x"))
    )
    phase = off_trend.groupBy("series_key", "phase").agg(F.avg("off").alias("phase_level"))
    resid = off_trend.join(phase, ["series_key", "phase"]).select(
        "series_key", (F.col("off") - F.col("phase_level")).alias("resid")
    )
    spread = resid.groupBy("series_key").agg(
        F.stddev_samp("resid").alias("sigma"), F.count("*").alias("points")
    )
    coef = line.join(spread, "series_key").withColumn("fitted_at", ts_lit(as_of))
    return SeriesModel(coef, phase, resid)


# stored tables of a model
_MODEL_TABLES = {
    "coef": "series_key string, slope double, intercept double, sigma double, points bigint, fitted_at timestamp",
    "phase": "series_key string, phase bigint, phase_level double",
    "resid": "series_key string, resid double",
}


def save_model(model: SeriesModel, path: str) -> None:
    """The tables of the new model replace those of the old one in one commit."""
    root, name = place(path)
    changes = [Change(f"{name}/{t}", getattr(model, t).withColumn(KEY, F.lit("model")), {"model"}) for t in _MODEL_TABLES]
    commit(model.coef.sparkSession, root, changes)


def load_model(spark, path: str) -> SeriesModel:
    root, name = place(path)
    with pinned(spark, root):
        return SeriesModel(**{t: read(spark, root, f"{name}/{t}", s).drop(KEY) for t, s in _MODEL_TABLES.items()})


def detect_anomalies(
    model: SeriesModel,
    recent: DataFrame,
    cfg: ObsConfig = ObsConfig(),
    interval: float | None = None,
) -> DataFrame:
    """Forecast, band, flag, percentile and distance for every recent bin.

    A phase never seen in training has level 0. The percentile is the share of
    training residuals not above the new one, found by a running count over
    the merged residuals of the series (no pairing of rows).
    """
    z = NormalDist().inv_cdf((1 + (cfg.ml_interval if interval is None else interval)) / 2)
    x = (F.unix_seconds("time_bin") - F.unix_seconds("fitted_at")) / F.lit(86400.0)
    scored = (
        recent.filter(F.col("y").isNotNull())
        .withColumn("phase", _phase(cfg))
        .join(model.coef, "series_key")
        .join(model.phase, ["series_key", "phase"], "left")
        .withColumn(
            "forecast",
            F.col("intercept") + F.col("slope") * x + F.coalesce(F.col("phase_level"), F.lit(0.0)),
        )
        .withColumn("resid", F.col("y") - F.col("forecast"))
        .select("series_key", "time_bin", "service", "route", "y", "forecast", "sigma", "resid",
                F.lit(0).alias("_train"))
    )
    train = model.resid.join(scored.select("series_key").distinct(), "series_key", "left_semi").select(
        "series_key", "resid", F.lit(1).alias("_train")
    )
    merged = scored.unionByName(train, allowMissingColumns=True)
    series = Window.partitionBy("series_key")
    upto = series.orderBy("resid").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = merged.withColumn(
        "percentile", F.sum("_train").over(upto) / F.sum("_train").over(series)
    ).filter(F.col("_train") == 0)
    half = F.lit(z) * F.col("sigma")
    return ranked.select(
        F.col("time_bin").alias("ts"),
        "series_key",
        "service",
        "route",
        "y",
        "forecast",
        (F.col("forecast") - half).alias("lower_bound"),
        (F.col("forecast") + half).alias("upper_bound"),
        (F.abs("resid") > half).alias("is_anomaly"),
        "percentile",
        F.when(F.col("sigma") > 0, F.col("resid") / F.col("sigma")).alias("distance"),
    )


def run_detection(
    name: str,
    model: SeriesModel,
    recent: DataFrame,
    as_of: datetime,
    cfg: ObsConfig = ObsConfig(),
) -> DataFrame:
    """Rows for the detection table: flagged bins of the last minutes."""
    found = detect_anomalies(model, recent, cfg)
    return (
        found.filter(F.col("is_anomaly") & (F.col("ts") >= ts_lit(as_of - cfg.ml_keep)))
        .withColumn("detected_at", ts_lit(as_of))
        .withColumn("model_name", F.lit(name))
        .withColumn("signal_type", F.lit(MODELS[name][2]))
        .select(*names(ML_DETECTION_COLUMNS))
    )


def recent_anomaly_signals_ml(
    detections: DataFrame,
    as_of: datetime,
    cfg: ObsConfig = ObsConfig(),
    dedup: bool = True,
) -> DataFrame:
    """Recent detections in signal shape.

    Overlapping runs report a bin several times; the latest run counts unless
    ``dedup`` is off.
    """
    rows = detections.filter(F.col("is_anomaly") & (F.col("ts") >= ts_lit(as_of - cfg.ml_keep)))
    if "day" in rows.columns:
        rows = rows.filter(F.col("day") >= F.to_date(ts_lit(as_of - cfg.ml_keep)))
    if dedup:
        key = ["model_name", "series_key", "ts"]
        rest = [c for c in rows.columns if c not in key]
        rows = rows.groupBy(*key).agg(
            F.max_by(F.struct(*rest), F.struct("detected_at", "distance")).alias("_row")
        ).select(*key, "_row.*")
    return rows.select(
        F.col("ts").alias("time_bin"),
        "signal_type",
        "service",
        "route",
        F.lit(None).cast("bigint").alias("requests"),
        F.lit(None).cast("double").alias("errors"),
        F.col("y").alias("actual"),
        F.col("forecast").alias("baseline_mean"),
        F.lit(None).cast("double").alias("baseline_stddev"),
        F.col("distance").alias("anomaly_score"),
        "model_name",
        "is_anomaly",
        "percentile",
    )
