"""Connected components by alternating stars, and nothing but joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store


# a node with more than this part of all rows meets them by a broadcast; there are fewer than HUBS of them
HUBS = 1000


def _tell(rows: DataFrame, least: DataFrame, count: int) -> DataFrame:
    """``u, v, m``: rows with the minimum of their ``u``. ``least`` is ``u, m, n``, the numbers ``n`` of rows add up to ``count``."""
    hub = F.col("n") * HUBS > count
    hubs, others = F.broadcast(least.where(hub).drop("n")), least.where(~hub).drop("n")
    return rows.join(hubs, "u").unionByName(rows.join(hubs, "u", "left_anti").join(others, "u"))


def components(edges: DataFrame, label: str = "components") -> DataFrame:
    """``node, component``: the smallest node reachable, for every node of ``edges`` (``a``, ``b`` long).

    Large star: every node tells its larger neighbours the smallest node it knows.
    Small star: every node tells its smaller neighbours and itself. Both keep what is
    connected connected; when nothing changes, every node hangs on the smallest one of
    its component. The smallest neighbour is a two-phase minimum, so a hub with a
    third of all edges is one row per task before the shuffle. Telling it to the neighbours
    is a join, in which hubs are broadcast and never the key of an exchange. Every round is stored.
    """
    pairs = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    pairs, before = store(pairs, label), None
    count = pairs.count()
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"), F.count("*").alias("n"))
        large = _tell(both.where("v > u"), least, 2 * count).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = store(large.distinct(), label)
        # here u is the larger end: its smaller neighbours and itself learn their minimum
        lowest = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = _tell(large, lowest, large.count()).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        small = small.unionByName(lowest.select("u", F.col("m").alias("v"))).distinct()
        pairs = store(small, label)
        now = pairs.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before, count = now, now[0]
    nodes = pairs.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return nodes.unionByName(roots).groupBy("node").agg(F.min("component").alias("component"))
