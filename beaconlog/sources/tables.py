"""Stored tables: raw logs, bins, detections, audit log, outbox, load history.

All are parquet folders in shared storage with declared schemas, read and written
through the commit log of their common parent (:mod:`snapshots`). A write replaces exactly
the batch, spans or cycle a job is responsible for, so running a job again
(after a lost executor, a restart or a backfill) leaves no second copy.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EPOCH, as_utc
from ..schemas import (
    ALERT_LOG_COLUMNS,
    LOAD_HISTORY_COLUMNS,
    ML_DETECTION_COLUMNS,
    OUTBOX_COLUMNS,
    RAW_LOGS_COLUMNS,
    SIGNAL_COLUMNS,
    ddl,
    names,
)
from . import snapshots
from .snapshots import KEY, Change, place

# Columns of the stored bins.
COUNT_BIN_COLUMNS = [
    ("time_bin", "timestamp"),
    ("signal_type", "string"),
    ("series_key", "string"),
    ("service", "string"),
    ("route", "string"),
    ("requests", "bigint"),
    ("errors", "double"),
    ("last_seen", "timestamp"),
]
LATENCY_BIN_COLUMNS = [
    ("time_bin", "timestamp"),
    ("series_key", "string"),
    ("service", "string"),
    ("route", "string"),
    ("requests", "bigint"),
    ("avg_duration_ms", "double"),
    ("p95_duration_ms", "double"),
]
MOMENT_COLUMNS = [
    ("span_start", "timestamp"),
    ("signal_type", "string"),
    ("series_key", "string"),
    ("service", "string"),
    ("route", "string"),
    ("n", "bigint"),
    ("mean", "double"),
    ("m2", "double"),
]


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A stored table, or no rows when nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def replace_partitions(df: DataFrame, path: str, *by: str) -> None:
    """Overwrite only the partitions present in ``df``.

    The rebalance hint lets AQE split a crowded partition over several tasks
    and merge sparse ones, so neither one hot day nor many tiny files result.
    """
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*by)
        .parquet(path)
    )


# ── raw logs and load history ───────────────────────────────────────────────

RAW_SCHEMA, RAW_DAY = ddl(RAW_LOGS_COLUMNS), "ingest_date"


def raw_change(rows: DataFrame, path: str, key: str) -> Change:
    """Log files arrive in time order, so tasks write their days without a shuffle."""
    out = rows.select(*names(RAW_LOGS_COLUMNS), F.to_date("ingest_ts").alias(RAW_DAY), F.lit(key).alias(KEY))
    return Change(place(path)[1], out, {key}, RAW_DAY)


def history_change(records: DataFrame, path: str, key: str) -> Change:
    return Change(place(path)[1], records.select(*names(LOAD_HISTORY_COLUMNS), F.lit(key).alias(KEY)), {key})


def write_raw_logs(rows: DataFrame, path: str, batch_id: int | str) -> None:
    snapshots.commit(rows.sparkSession, place(path)[0], [raw_change(rows, path, str(batch_id))])


def read_raw_logs(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read(spark, *place(path), RAW_SCHEMA, RAW_DAY).drop(KEY)


def read_raw_batch(spark: SparkSession, path: str, batch_id: int | str) -> DataFrame:
    """Rows of one batch, from its own parts."""
    key = str(batch_id)
    rows = snapshots.read(spark, *place(path), RAW_SCHEMA, RAW_DAY, only=lambda p: key in p.keys, newest=True)
    return rows.filter(F.col(KEY) == key).drop(KEY)


def read_raw_paths(spark: SparkSession, path: str, parts: Sequence[str]) -> DataFrame:
    return snapshots.read_paths(spark, *place(path), parts, RAW_SCHEMA, RAW_DAY).drop(KEY)


def read_load_history(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read(spark, *place(path), ddl(LOAD_HISTORY_COLUMNS)).drop(KEY)


# ── per-cycle tables ────────────────────────────────────────────────────────

def _cycle(as_of: datetime) -> tuple[str, str]:
    moment = as_utc(as_of)
    return f"{moment:%Y-%m-%d}", f"{moment:%H%M%S%f}"


def write_cycle(df: DataFrame, path: str, as_of: datetime, variant: str = "") -> None:
    """Rows of one evaluation cycle; the same cycle (and variant) replaces its own rows."""
    day, key = _cycle(as_of)
    key += variant
    rows = df.withColumns({"day": F.lit(day).cast("date"), KEY: F.lit(key)})
    snapshots.commit(df.sparkSession, place(path)[0], [Change(place(path)[1], rows, {day: {key}}, "day")])


def read_cycles(spark: SparkSession, path: str, columns: list[tuple[str, str]], newest: bool = False) -> DataFrame:
    return snapshots.read(spark, *place(path), ddl(columns), "day", newest=newest).drop(KEY)


def write_alert_log(row: DataFrame, path: str, as_of: datetime) -> None:
    write_cycle(row.select(*names(ALERT_LOG_COLUMNS)), path, as_of)


def read_alert_log(spark: SparkSession, path: str) -> DataFrame:
    return read_cycles(spark, path, ALERT_LOG_COLUMNS).drop("day")


def write_outbox(payload: DataFrame, path: str, as_of: datetime) -> None:
    write_cycle(payload.select(*names(OUTBOX_COLUMNS)), path, as_of)


def read_outbox(spark: SparkSession, path: str) -> DataFrame:
    return read_cycles(spark, path, OUTBOX_COLUMNS).drop("day")


def write_signals(signals: DataFrame, path: str, as_of: datetime) -> None:
    write_cycle(signals.select(*names(SIGNAL_COLUMNS)), path, as_of)


def read_cycle_signals(spark: SparkSession, path: str, as_of: datetime) -> DataFrame:
    day, key = _cycle(as_of)
    rows = snapshots.read(
        spark, *place(path), ddl(SIGNAL_COLUMNS), "day", only=lambda p: p.day == day and key in p.keys, newest=True
    )
    return rows.filter(F.col(KEY) == key).drop("day", KEY)


def append_ml_detections(detections: DataFrame, path: str, as_of: datetime, model: str = "") -> None:
    """Flagged anomalies of one run; the same run of a model replaces its rows."""
    write_cycle(detections.select(*names(ML_DETECTION_COLUMNS)), path, as_of, f"/{model}")


def read_ml_detections(spark: SparkSession, path: str) -> DataFrame:
    return read_cycles(spark, path, ML_DETECTION_COLUMNS, newest=True)


# ── bins ────────────────────────────────────────────────────────────────────

COUNT_BINS, LATENCY_BINS, MOMENTS, BIN_DAY = "count_bins", "latency_bins", "moments", "bin_date"


def bin_changes(
    counts: DataFrame, latency: DataFrame, moments: DataFrame, path: str, spans: Sequence[datetime], span_seconds: int
) -> list[Change]:
    """Bins and their moments that replace all of ``spans``, in the three tables.

    The rebalance hint lets AQE split a crowded day over several tasks
    and merge sparse ones, so neither one hot day nor many tiny files result.
    """
    keys: dict[str, set[str]] = {}
    for start in spans:
        second = (start - EPOCH) % timedelta(days=1) // timedelta(seconds=1)
        keys.setdefault(f"{start:%Y-%m-%d}", set()).add(str(second // span_seconds))
    out = []
    for name, rows, columns in (
        (COUNT_BINS, counts, COUNT_BIN_COLUMNS), (LATENCY_BINS, latency, LATENCY_BIN_COLUMNS), (MOMENTS, moments, MOMENT_COLUMNS)
    ):
        time = columns[0][0]
        second = F.pmod(F.unix_seconds(time), F.lit(86400))
        own = {BIN_DAY: F.to_date(time), KEY: F.floor(second / span_seconds).cast("int").cast("string")}
        rows = rows.select(*names(columns)).withColumns(own).hint("rebalance", F.col(BIN_DAY))
        out.append(Change(place(path, name)[1], rows, keys, BIN_DAY))
    return out


def read_count_bins(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read(spark, *place(path, COUNT_BINS), ddl(COUNT_BIN_COLUMNS), BIN_DAY).drop(KEY)


def read_latency_bins(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read(spark, *place(path, LATENCY_BINS), ddl(LATENCY_BIN_COLUMNS), BIN_DAY).drop(KEY)


def read_moments(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read(spark, *place(path, MOMENTS), ddl(MOMENT_COLUMNS), BIN_DAY).drop(KEY)


# ── upkeep ──────────────────────────────────────────────────────────────────

# day columns of the tables below a store's root, for compaction
DAYS = {
    "raw_logs": RAW_DAY, "load_history": None, f"bins/{COUNT_BINS}": BIN_DAY, f"bins/{LATENCY_BINS}": BIN_DAY, f"bins/{MOMENTS}": BIN_DAY,
    "signals": "day", "alert_log": "day", "outbox": "day", "fixed_alerts": "day", "ml_detections": "day",
    "incidents": "day", "closed_incidents": "day",
}


def compact_store(spark: SparkSession, root: str, **options) -> int:
    """Merge the small parts of all tables of a store; how many parts were merged."""
    return snapshots.compact(spark, root, DAYS, **options)
