"""Silence as a stream of events: one when a forwarder falls silent, one when it is heard again.

State per forwarder is the newest time it sent and a timer at which its silence would begin. In processing
time the timer runs without any input, so a stream that stops is noticed; in event time it runs with the
watermark, so a replay gives the same events as the live run.

Rows are reduced to the first and last time per bin of the silence limit where they are read: no gap
longer than the limit lies inside a bin, and a forwarder with a third of all rows shuffles as a few rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from ..config import ObsConfig
from ..operators import views
from ..session import materialize, scratch
from ..sources import snapshots
from ..sources.snapshots import KEY, Change, place

SILENT, HEARD = "silent", "heard"
_EVENTS = "service string, kind string, at timestamp, last_seen timestamp"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def _spans(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.table({"service": batch["service"], "us": batch["us"], "bin": pc.divide(batch["us"], limit)})
            spans = rows.group_by(["service", "bin"]).aggregate([("us", "min"), ("us", "max")])
            spans = pa.table({"service": spans["service"], "lo": spans["us_min"], "hi": spans["us_max"]})
            yield from spans.to_batches()

    return run


class _Silence(StatefulProcessor):
    """Times are microseconds; ``told`` says that the silence after ``last`` is known already."""

    def __init__(self, limit: int):
        self.limit = limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("seen", "last long, told boolean, due long")

    def _event(self, key, kind: str, at: int, last: int) -> tuple:
        return key[0], kind, at, last

    def _frame(self, events: list[tuple]) -> pd.DataFrame:
        return pd.DataFrame(events, columns=["service", "kind", "at", "last_seen"]).astype({"at": "int64", "last_seen": "int64"})

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        spans = sorted((int(lo), int(hi)) for frame in rows for lo, hi in zip(frame["lo"], frame["hi"]))
        last, told, due = self.state.get() if self.state.exists() else (None, False, None)
        events = []
        for lo, hi in spans:
            if last is not None and hi <= last:
                continue
            if last is not None and (told or lo - last > self.limit):
                if not told:
                    events.append(self._event(key, SILENT, last + self.limit, last))
                events.append(self._event(key, HEARD, lo if lo > last else hi, last))
                told = False
            last = hi
        begins = (last + self.limit) // 1000 + 1
        if not told and begins != due:
            if due is not None:
                self.handle.deleteTimer(due)
            self.handle.registerTimer(begins)
            due = begins
        self.state.update((last, told, due))
        yield self._frame(events)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        last, told, due = self.state.get()
        if told or expiredTimerInfo.getExpiryTimeInMs() != due:
            return
        self.state.update((last, True, None))
        yield self._frame([self._event(key, SILENT, last + self.limit, last)])

    def close(self) -> None:
        pass


def silence_events(logs: DataFrame, cfg: ObsConfig = ObsConfig(), late: str | None = None) -> DataFrame:
    """``service, kind, at, last_seen`` for a stream of logs.

    ``silent``: nothing was sent for longer than the holdback after ``last_seen``, so silence began ``at`` its end.
    ``heard``: that silence ended with the row ``at``. Without ``late`` the clock tells silence; with it
    (a watermark's delay) the watermark does. Rows without a time are left out; rows older than the newest
    one of their service change nothing, so a silence once told stays told.
    """
    limit = round(cfg.holdback.total_seconds() * 1e6)
    sent = logs.filter(views.is_forwarder_event(cfg) & (F.col("event_type") == "batch_sent") & F.col("ingest_ts").isNotNull())
    spans = sent.select("service", F.unix_micros("ingest_ts").alias("us")).mapInArrow(_spans(limit), "service string, lo long, hi long")
    if late is not None:
        spans = spans.withColumn("time", F.timestamp_micros("hi")).withWatermark("time", late)
    found = spans.groupBy("service").transformWithStateInPandas(
        _Silence(limit), "service string, kind string, at long, last_seen long", "Append",
        "ProcessingTime" if late is None else "EventTime",
    )
    return found.select("service", "kind", F.timestamp_micros("at").alias("at"), F.timestamp_micros("last_seen").alias("last_seen"))


@contextmanager
def _rocksdb(spark: SparkSession):
    """Timers need this state store; a query keeps the settings it was started with."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _ROCKSDB)
    try:
        yield
    finally:
        spark.conf.unset(_PROVIDER) if before is None else spark.conf.set(_PROVIDER, before)


def track_silence(
    logs: DataFrame, path: str, checkpoint: str, cfg: ObsConfig = ObsConfig(), trigger: dict | None = None, late: str | None = None
) -> StreamingQuery:
    """Append the events to a table; a batch that is repeated replaces its own rows, one without events commits nothing."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with scratch(spark, "silence"):
            rows = materialize(batch.withColumn(KEY, F.lit(str(batch_id))), "events")
            if not rows.isEmpty():
                snapshots.commit(spark, place(path)[0], [Change(place(path)[1], rows, {str(batch_id)})])

    with _rocksdb(logs.sparkSession):
        writer = silence_events(logs, cfg, late).writeStream.outputMode("append").foreachBatch(apply)
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"processingTime": "1 minute"})).start()


def read_silence(spark: SparkSession, path: str) -> DataFrame:
    return snapshots.read(spark, *place(path), _EVENTS).drop(KEY)


def silent_now(spark: SparkSession, path: str) -> DataFrame:
    """``service, since, last_seen`` of the forwarders whose last told silence has no end yet."""
    order = F.struct("last_seen", F.col("kind") == HEARD)
    newest = read_silence(spark, path).groupBy("service").agg(F.max_by(F.struct("kind", "at", "last_seen"), order).alias("e"))
    return newest.filter(F.col("e.kind") == SILENT).select("service", F.col("e.at").alias("since"), "e.last_seen")
