"""Continuous and polled loading of log files, each file once."""

from __future__ import annotations

import math
import re
import uuid
from collections.abc import Callable, Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import ts_lit
from ..functions import iff
from ..schemas import LOAD_HISTORY_COLUMNS, names
from ..session import materialize
from ..sources.json_logs import parse_lines, read_log_files, stream_log_files
from ..sources.snapshots import commit, place
from ..sources.tables import history_change, raw_change, read_load_history, read_raw_batch

# Load states of a file.
LOADED, PARTIAL, FAILED = "Loaded", "Partially loaded", "Load failed"


# characters of a broken line that its message repeats
MESSAGE_CHARS = 200
# files that a rescan loads in one commit, about
RESCAN_FILES = 1000


def load_record(parsed: DataFrame, skip_bad_files: bool = False) -> DataFrame:
    """One row per file: what was read, what failed, when.

    ``parsed`` holds the lines in the order of their files, a split of a file in one
    task, or their numbers as ``_line``; the first bad line is the one with the least
    split and place in it.
    """
    bad = F.col("is_bad")
    message = F.concat(F.lit("Error parsing JSON: "), F.substring("value", 1, MESSAGE_CHARS))
    block = F.col("file_block") if "file_block" in parsed.columns else F.lit(0)
    first = F.min_by(message, F.when(bad, F.struct(block, "_line")))
    if "_line" not in parsed.columns:
        parsed = parsed.withColumn("_line", F.monotonically_increasing_id())
    per_file = parsed.groupBy("file_name").agg(
        F.current_timestamp().alias("last_load_time"),
        F.count("*").alias("_lines"),
        F.count_if(bad).alias("error_count"),
        first.alias("first_error_message"),
        F.sum("bad_values").cast("bigint").alias("bad_values"),
    )
    good = F.col("_lines") - F.col("error_count")
    failed = (F.col("error_count") > 0) & ((good == 0) | F.lit(skip_bad_files))
    status = F.when(failed, FAILED).when(F.col("error_count") > 0, PARTIAL).otherwise(LOADED)
    return per_file.withColumn("status", status).withColumn(
        "row_count", iff(F.col("status") == FAILED, 0, good).cast("bigint")
    ).select(*names(LOAD_HISTORY_COLUMNS))


def load_batch(
    parsed: DataFrame, raw_path: str, history_path: str, batch_id: int | str, skip_bad_files: bool = False
) -> int:
    """Write one batch of parsed lines and its load records; how many files it held.

    Tables of one folder appear together, in one commit; otherwise the rows come first and
    the records last, so that a file never counts as loaded without its rows. The
    batch replaces what an earlier attempt of it left behind.
    """
    spark, key = parsed.sparkSession, str(batch_id)
    # kept without the lines themselves, the largest column: only the start of a broken one is read again
    start = F.when(F.col("is_bad"), F.substring("value", 1, MESSAGE_CHARS))
    parsed = parsed.withColumn("value", start).drop("file_time").persist()
    try:
        # a small stored table, which Spark broadcasts by its real size
        records = materialize(load_record(parsed, skip_bad_files), "load-records")
        rows = parsed.filter(~F.col("is_bad"))
        if skip_bad_files:
            rows = rows.join(records.filter(F.col("status") == FAILED), "file_name", "left_anti")
        changes = [(raw_path, raw_change(rows, raw_path, key)), (history_path, history_change(records, history_path, key))]
        roots = list(dict.fromkeys(place(path)[0] for path, _ in changes))
        for root in roots:
            commit(spark, root, [change for path, change in changes if place(path)[0] == root])
        return records.count()
    finally:
        parsed.unpersist()


def stream_ingest(
    spark: SparkSession,
    source: str,
    raw_path: str,
    history_path: str,
    checkpoint: str,
    trigger: dict | None = None,
    max_files: int = 1000,
    refresh: bool = True,
    started_at: datetime | None = None,
    skip_bad_files: bool = False,
    null_if: Sequence[str] = (),
    keep_envelope: bool = False,
    on_rows: Callable[[DataFrame], None] | None = None,
) -> StreamingQuery:
    """Load new files as they appear; the checkpoint remembers which were read.

    A batch takes ``max_files`` files at most, also the first one over a full prefix.
    ``refresh=False`` leaves out files older than ``started_at`` (those a pipe
    would only load on request); ``refresh_files`` can fetch them later.
    ``on_rows`` is called after each batch with the rows it wrote, for instance
    to refresh the bins they fall into.
    """
    lines = stream_log_files(spark, source, max_files)
    if not refresh:
        if started_at is None:
            raise ValueError("refresh=False needs started_at")
        lines = lines.filter(F.col("file_time") >= ts_lit(started_at))
    # parsed before foreachBatch: the load time then belongs to the batch and
    # stays the same when the batch is run again
    parsed = parse_lines(lines, null_if, keep_envelope)

    def write(batch: DataFrame, batch_id: int) -> None:
        load_batch(batch, raw_path, history_path, batch_id, skip_bad_files)
        if on_rows is not None:
            on_rows(read_raw_batch(batch.sparkSession, raw_path, batch_id))

    writer = parsed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return writer.trigger(**(trigger or {"processingTime": "1 minute"})).start()


def ingest_available(spark: SparkSession, source: str, raw_path: str, history_path: str,
                     checkpoint: str, **options) -> None:
    """Polled load: read whatever is new, then stop. Run it at any cadence."""
    query = stream_ingest(spark, source, raw_path, history_path, checkpoint,
                          trigger={"availableNow": True}, **options)
    query.awaitTermination()


def refresh_files(spark: SparkSession, source: str, raw_path: str, history_path: str,
                  run_id: int, group_files: int = RESCAN_FILES, **options) -> int:
    """Batch rescan: load files of the prefix that have no load record yet; how many.

    The prefix is listed by name; only files without a record are opened, about ``group_files`` in one
    commit of rows and records. A rescan that fails leaves what it has committed and
    loads the rest the next time. ``run_id`` names the rescan in the batches' names.
    """
    known = read_load_history(spark, history_path).select(F.col("file_name").alias("_known")).distinct()
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(source)
    # names only: the content is not read. Empty files have no lines and no record
    named = found.filter("length > 0").select("path", F.col("_metadata.file_path").alias("file_name"))
    new = named.join(known, _plain_path("file_name") == _plain_path("_known"), "left_anti").select("path")
    new = materialize(new, "new-files")
    groups, loaded = math.ceil(new.count() / group_files), 0
    for number in range(groups):
        paths = [r.path for r in new.filter(F.pmod(F.xxhash64("path"), F.lit(groups)) == number).collect()]
        if paths:
            lines = read_log_files(spark, [_no_glob(p) for p in paths])
            loaded += load_batch(parse_lines(lines), raw_path, history_path, f"{run_id}/{uuid.uuid4().hex}", **options)
    return loaded


def _no_glob(path: str) -> str:
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def _plain_path(name: str) -> Column:
    return F.regexp_replace(name, "^file:/+", "/")


def recent_load_errors(
    history: DataFrame,
    as_of: datetime,
    window: timedelta = timedelta(hours=24),
    limit: int = 25,
    statuses: Sequence[str] = (FAILED,),
) -> DataFrame:
    """Failed loads of the last day, newest first."""
    return (
        history.filter(F.col("last_load_time") >= ts_lit(as_of - window))
        .filter(F.col("status").isin(*statuses))
        .select(*[n for n, _ in LOAD_HISTORY_COLUMNS if n != "bad_values"])
        .orderBy(F.desc("last_load_time"), "file_name")
        .limit(limit)
    )
