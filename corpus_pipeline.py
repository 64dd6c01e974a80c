"""A training corpus from raw documents: quality, copies, near copies, benchmark leaks, windows.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is stored
and read again as the next one's documents. All but the last return rows of the
input with the columns of ``documents``.

In every stage a null text counts as an empty one, ids may be null or repeat, further columns go through
whatever their names, and an empty table gives an empty result.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from beaconlog.llm import decontaminate, exact_dedup, near_dup, packing, quality_rank, queries
from beaconlog.llm.common import store, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that the quality model, fitted on the labels, does not reject; texts without words are judged like any other."""
    model = queries.quality_model(docs, table(spark, sf_dir, "labels"))
    return docs.where(quality_rank.scorer(model)(F.col("text")) >= model.threshold)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id; empty texts are equal, repeated rows are one."""
    return exact_dedup.drop_copies(docs, keep="largest")


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by a similarity of 0.8 over five-word shingles the row with the smallest id; texts without words stay."""
    return near_dup.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows without any ten-word window of a benchmark item, or a whole shorter item; texts without words stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of near-equal training windows, with their token ids; an empty text is its end id alone."""
    pieces = packing.pack_windows(docs, public_tokenizers.path(queries.PACK_FILE), queries.PACK_END)
    return pieces.withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

# a learned model decides in the first stage
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
