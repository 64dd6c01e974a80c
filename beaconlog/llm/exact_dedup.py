"""Exact de-duplication by a tree of merges of sorted digest runs (DataFrame functions only).

Every input partition becomes a run: its rows reduced to a digest, a byte length
and an identifier, copies combined in the task that reads them, ordered by run and digest
when they are stored. Runs are merged in rounds,
``2 ** bits`` at a time: in round r the runs whose numbers agree without their
lowest ``r * bits`` bits become one. A merged run is as large as its parts together,
so it lies in ``2 ** (r * bits)`` ranges of digests (the leading bits, which are evenly
spread): each of the merging runs sends every range to the task that merges it. The
number of tasks stays that of the input's partitions in every round, and a
task holds a part of a run that does not grow with the round.

A merging task reads its range of all its runs in one order by digest and length, and lets of
neighbours that agree in the full SHA-256 and the byte length the best identifier and the
number of rows survive, as a stream. (Spark has one operator that puts rows in order, the
sort of a partition; it does so here for the merge as well.) So a level is again one
sorted run per tree node, cut at range borders.

The results travel down the same tree to the rows: a text that fills a third of the
table is one row per run on the way up, at most ``2 ** bits`` rows in a merge, and on the way
down no key is shared by more than one run's rows or ``2 ** bits`` nodes.

No row is dropped and no group is gathered: all steps are merges and
equi-joins over rows of about 60 bytes; texts are read once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, store

ROUND_BITS = 4
RANGE_BITS = 32  # leading bits of a digest that ranges are cut by
SAME = ["digest", "n_bytes"]


def _range(bits: int) -> Column:
    """The range of a digest by its leading ``bits`` bits."""
    lead = F.conv(F.hex(F.substring("digest", 1, RANGE_BITS // 8)), 16, 10).cast("long")
    return F.shiftright(lead, RANGE_BITS - min(bits, RANGE_BITS))


def merge_runs(rows: DataFrame, bits: int) -> DataFrame:
    """``run, part, digest, n_bytes, best, n``: one row per digest and run, runs in order within ranges of ``bits`` bits.

    The exchange is by run and range alone. A maximum over structs is aggregated over sorted rows, so
    the planner orders each task's rows by run, range, digest and length and reduces them as a stream.
    """
    placed = rows.select("run", _range(bits).alias("part"), *SAME, "best", "n").repartition("run", "part")
    return placed.groupBy("run", "part", *SAME).agg(F.max("best").alias("best"), F.sum("n").alias("n"))


def tree_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    keep: str = "smallest",
    round_bits: int = ROUND_BITS,
) -> DataFrame:
    """One row per input row: ``id, keep_id, group_size, kept, text_sha256, n_bytes``.

    ``keep`` is ``smallest`` or ``largest``: which identifier of equal texts stays.

    A null text equals the empty text. A null id sorts below every number: with
    ``largest`` it stays only when the group has no other, with ``smallest`` it
    is likewise taken last. Rows that repeat id and text count as separate rows;
    exactly one row of a group has ``kept``. Other columns are ignored, whatever
    their names. An empty table gives an empty result.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError("keep is 'smallest' or 'largest'")
    text = F.coalesce(F.col(text_col), F.lit(""))
    # a larger rank wins; nulls sort first and so lose
    rank = F.col("id") if keep == "largest" else -F.col("id")
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.unhex(F.sha2(text, 256)).alias("digest"),
        F.octet_length(text).cast("long").alias("n_bytes"),
        F.spark_partition_id().alias("run"),
        F.monotonically_increasing_id().alias("row"),
    ).withColumn("best", F.struct(rank.alias("rank"), F.col("row"), F.col("id").alias("keep_id")))
    rows = store(rows, "dedup-rows")

    last_run = rows.agg(F.max("run")).first()[0] or 0
    # copies within a run are combined before they travel
    own = rows.groupBy("run", *SAME).agg(F.max("best").alias("best"), F.count("*").alias("n"))
    levels, bits = [store(own.withColumn("part", F.lit(0).cast("long")), "dedup-level")], 0
    while last_run > 0:
        last_run >>= round_bits
        bits += round_bits
        levels.append(store(merge_runs(levels[-1].withColumn("run", F.shiftright("run", round_bits)), bits), "dedup-level"))

    answer = levels.pop()
    while levels:
        below = levels.pop().select(*SAME, "run", F.shiftright("run", round_bits).alias("up"))
        above = answer.select(*SAME, F.col("run").alias("up"), "best", "n")
        answer = below.join(above, [*SAME, "up"]).drop("up")
    found = answer.select(*SAME, "run", F.col("best").alias("winner"), "n")
    return rows.join(found, [*SAME, "run"]).select(
        F.col("id").alias(id_col),
        F.col("winner.keep_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row") == F.col("winner.row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        "n_bytes",
    )


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "largest") -> DataFrame:
    """The input's rows and columns, one row of each group of equal texts.

    A null text is an empty one. Of rows with the id that stays one is kept, any of
    them if they differ in other columns. A null id stays only where its group has no other. Columns
    of any name go through unchanged. An empty table gives no rows.
    """
    own_id, own_digest, keep_id, keep_digest = free_names(docs, "_id", "_digest", "_keep_id", "_keep_digest")
    kept = (
        tree_dedup(docs, id_col, text_col, keep)
        .where("kept")
        .select(F.col(id_col).alias(keep_id), F.unhex("text_sha256").alias(keep_digest))
    )
    digest = F.unhex(F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
    out = docs.withColumn(own_digest, digest).withColumn(own_id, F.col(id_col).cast("long"))
    same = F.col(own_id).eqNullSafe(F.col(keep_id)) & (F.col(own_digest) == F.col(keep_digest))
    # rows that repeat id and text both match their group's winner
    return out.join(kept, same, "left_semi").dropDuplicates([own_id, own_digest]).select(*docs.columns)
