"""Sharding by a two-pass external shuffle.

Pass one scatters the rows uniformly into buckets that fit in memory: a seeded
hash of the row's id, text and place in the input picks the bucket, so neither
repeated ids nor a frequent text gather in one bucket. Pass two loads one bucket
at a time, puts it into a canonical order, shuffles it with a seeded Fisher-Yates
permutation and writes it. Buckets one after the other are then one uniformly
shuffled sequence, and shard k is the k-th of equally long stretches of it: row
counts differ by at most one. Buckets are written once; a shard is a range of
buckets in a small manifest.

A task that is run again draws the same permutation from (seed, bucket).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import running_base, store

BUCKET_BYTES = 32 << 20
# beyond, buckets grow instead: the manifest stays below 16 MB, and 100 TB make buckets of 100 MB
MAX_BUCKETS = 1_000_000
ROW_OVERHEAD = 64


def _shuffled(seed: int):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("_bucket")[0].as_py()
        # arrival order depends on the shuffle; the hash and the place make it canonical
        table = table.take(pa.compute.sort_indices(table, sort_keys=[("_hash", "ascending"), ("_place", "ascending")]))
        order = np.arange(table.num_rows)
        rng = np.random.default_rng([seed, bucket])
        rng.shuffle(order)  # Fisher-Yates
        table = table.take(pa.array(order))
        return table.append_column("_index", pa.array(np.arange(table.num_rows, dtype="int64")))

    return run


def external_shuffle(
    docs: DataFrame, seed: int = 17, bucket_bytes: int = BUCKET_BYTES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The stored, shuffled rows: all input columns, ``_bucket`` and ``_index`` in it, and ``_position`` overall.

    Rows with null ids or texts, repeated rows and rows that tie in the hash are
    rows like any other. Input columns keep their names, except that names
    beginning with an underscore are reserved. An empty table gives no rows.
    """
    clash = [c for c in docs.columns if c in ("_bucket", "_hash", "_place", "_index", "_position", "_base")]
    if clash:
        raise ValueError(f"reserved column names: {clash}")
    text = F.coalesce(F.col(text_col), F.lit(""))
    total = docs.agg(F.sum(F.octet_length(text) + F.lit(ROW_OVERHEAD)).cast("long")).first()[0] or 0
    buckets = min(max(1, -(-total // bucket_bytes)), MAX_BUCKETS)
    placed = docs.withColumn("_place", F.monotonically_increasing_id())
    placed = placed.withColumn("_hash", F.xxhash64(F.lit(seed), F.col(id_col), text, F.col("_place")))
    placed = placed.withColumn("_bucket", F.pmod("_hash", F.lit(buckets)).cast("int"))
    schema = T.StructType([*placed.schema.fields, T.StructField("_index", T.LongType())])
    shuffled = placed.groupBy("_bucket").applyInArrow(_shuffled(seed), schema).drop("_hash", "_place")
    stored = store(shuffled, "shuffled-buckets")
    sizes = stored.groupBy("_bucket").agg(F.count("*").alias("_n"))
    base = running_base(sizes, "_bucket", "_n", "_base").select("_bucket", "_base")
    # at most MAX_BUCKETS rows of two numbers: the texts need not move again
    return stored.join(F.broadcast(base), "_bucket").withColumn("_position", F.col("_base") + F.col("_index")).drop("_base")


def shards(shuffled: DataFrame, count: int) -> DataFrame:
    """Adds ``shard`` and ``slot``: ``count`` equal stretches of the shuffled order.

    Shard k holds the positions from ceil(k n / count) up to ceil((k + 1) n / count).
    """
    clash = [c for c in shuffled.columns if c in ("shard", "slot")]
    if clash:
        raise ValueError(f"rename these columns first: {clash}")
    n = shuffled.count()
    shard = F.expr(f"_position * {count} div {max(n, 1)}")
    start = F.expr(f"(shard * {n} + {count - 1}) div {count}")
    return shuffled.withColumn("shard", shard.cast("int")).withColumn("slot", F.col("_position") - start)
