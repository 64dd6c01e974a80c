"""Absence detection: remember when each forwarder was last heard of.

A stream keeps a small table of last-seen times, for a check that is a separate
scheduled read; ``silence`` tells the same by timers of its own.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import ObsConfig, ts_lit
from ..operators import views
from ..sources import snapshots
from ..sources.snapshots import KEY, Change, place

_SEEN = "service string, last_seen timestamp"


def last_seen(rows: DataFrame, cfg: ObsConfig = ObsConfig()) -> DataFrame:
    sent = rows.filter(views.is_forwarder_event(cfg) & (F.col("event_type") == "batch_sent"))
    return sent.groupBy("service").agg(F.max("ingest_ts").alias("last_seen"))


def _read(spark: SparkSession, path: str, newest: bool = False) -> DataFrame:
    return snapshots.read(spark, *place(path), _SEEN, newest=newest).drop(KEY)


def track_last_seen(
    logs: DataFrame, path: str, checkpoint: str, cfg: ObsConfig = ObsConfig(), trigger: dict | None = None
) -> StreamingQuery:
    """Keep the newest time per service in a table of one row per service.

    A batch replaces the table by one commit, merged with its own rows: a repeated batch gives the
    same result, and readers meet the table before or after it.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        spark, (root, table) = batch.sparkSession, place(path)
        merged = _read(spark, path, newest=True).unionByName(last_seen(batch, cfg))
        merged = merged.groupBy("service").agg(F.max("last_seen").alias("last_seen")).withColumn(KEY, F.lit("seen"))
        snapshots.commit(spark, root, [Change(table, merged, {"seen"})])

    writer = logs.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def silent_forwarders(
    spark: SparkSession, path: str, as_of: datetime, cfg: ObsConfig = ObsConfig()
) -> DataFrame:
    """One row when nothing was sent within the holdback, also if nothing ever was."""
    return (
        _read(spark, path).agg(F.max("last_seen").alias("last_seen"))
        .filter(F.col("last_seen").isNull() | (F.col("last_seen") < ts_lit(as_of - cfg.holdback)))
        .select(ts_lit(as_of).alias("checked_at"), "last_seen")
    )
