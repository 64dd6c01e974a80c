"""URL block and allow rules by a sort-merge range join (DataFrame functions only).

A host is written with its labels reversed (``a.example.net`` as
``net.example.a.``), so a rule for a host and its subdomains is the interval of
keys that begin with the rule's key. Rule starts, rule ends and URLs are sorted
together and swept. The stack of rules that are open at a position is carried
from event to event: a start pushes its rule, an end pops it, a URL reads it.
The sweep is distributed: the sorted events are cut into ranges of rows (inside
one host if need be, so a hot host is spread), each range is swept on its own,
and the stack that is open at its beginning is the last one of an earlier range.

Hosts are swept first. For each rule host that is open at a URL, a second sweep
over rule host and path finds the innermost, that is longest, path rule.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, store

# order of events at one key
START, POINT, END = 0, 1, 2


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each closed by a dot, as bytes."""
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit(".")).cast("binary")


def _stacks(keys: DataFrame) -> DataFrame:
    """``key, parents, stack``: the keys that are prefixes of each key, outermost first.

    A key of n bytes is looked up under its n proper prefixes, so the work is the
    size of the rule list, not its square.
    """
    keys = keys.select("key").distinct()
    size = F.octet_length("key")
    prefixes = keys.where(size > 1).select(
        "key", F.explode(F.sequence(F.lit(1), size - 1)).alias("n")
    ).select("key", F.expr("substring(key, 1, n)").alias("outer_key"))
    parents = (
        prefixes.join(keys.select(F.col("key").alias("outer_key")), "outer_key")
        .groupBy("key")
        .agg(F.sort_array(F.collect_list("outer_key")).alias("parents"))
    )
    none = F.array().cast("array<binary>")
    out = keys.join(parents, "key", "left").withColumn("parents", F.coalesce("parents", none))
    return out.withColumn("stack", F.concat("parents", F.array("key")))


def interval_sweep(points: DataFrame, keys: DataFrame, label: str) -> DataFrame:
    """Adds ``stack`` to ``points``: all ``keys`` that are prefixes of the point's ``key``.

    ``points`` has a binary column ``key`` and a column ``point`` that may hold
    anything; ``keys`` has a binary column ``key``. Every point comes back once.
    """
    kind, stack = F.lit, "array<binary>"
    rules = _stacks(keys)
    nothing = F.lit(None).cast(points.schema["point"].dataType)
    opened = rules.select("key", kind(START).alias("kind"), F.col("stack").alias("open"), nothing.alias("point"))
    # 0xFF does not occur in UTF-8: the end sorts behind every key with the prefix
    closed = rules.select(
        F.concat("key", F.unhex(F.lit("FF"))).alias("key"), kind(END).alias("kind"),
        F.col("parents").alias("open"), nothing.alias("point"),
    )
    met = points.select("key", kind(POINT).alias("kind"), F.lit(None).cast(stack).alias("open"), "point")
    events = opened.unionByName(closed).unionByName(met)
    ranged = (
        events.repartitionByRange("key", "kind", F.xxhash64("point"))
        .sortWithinPartitions("key", "kind")
        .withColumn("part", F.spark_partition_id())
    )
    ranged = store(ranged, label)

    # the last stack of every range, then what is open where the next one begins
    ends = ranged.groupBy("part").agg(
        F.max_by("open", F.when(F.col("open").isNotNull(), F.struct("key", "kind"))).alias("final")
    )
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select("part", F.last("final", ignorenulls=True).over(earlier).alias("carried"))
    so_far = Window.partitionBy("part").orderBy("key", "kind").rowsBetween(Window.unboundedPreceding, 0)
    swept = ranged.withColumn("seen", F.last("open", ignorenulls=True).over(so_far)).where(F.col("kind") == POINT)
    none = F.array().cast(stack)
    # one row per range: as many as the sort has tasks
    return swept.join(F.broadcast(carried), "part").select(
        "key", "point", F.coalesce("seen", "carried", none).alias("stack")
    )


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """One row per page: ``id, host, path, rule, verdict``.

    ``rules`` has ``host``, ``path`` and ``verdict`` (allow or block). A rule fits
    its host and all subdomains if the path begins with its path; the longest
    rule wins (host and path together, then the longer host). A URL without a
    fitting rule gets a null rule and the ``default`` verdict.

    A null URL, an empty one or one without ``://`` has empty host and path. Null
    ids are kept as they are; repeated rows are judged one by one. Rules with a
    null or empty host are ignored, a null path is empty, and of two equal rules
    with different verdicts block wins. Other columns of either table are
    ignored. Without pages or without rules the result is empty or all default.
    """
    rules = (
        rules.select(ascii_lower(F.col("host")).alias("rule_host"), F.coalesce("path", F.lit("")).alias("rule_path"), "verdict")
        .where("rule_host <> ''")
        .groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
        .withColumn("host_key", host_key(F.col("rule_host")))
        .withColumn("key", F.concat("host_key", F.unhex(F.lit("00")), F.col("rule_path").cast("binary")))
    )
    rules = store(rules, "url-rules")

    url = F.col(url_col)
    hosts = pages.select(F.col(id_col).alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    points = hosts.select(
        host_key(F.col("host")).alias("key"),
        F.struct("id", "host", "path", F.monotonically_increasing_id().alias("row")).alias("point"),
    )
    by_host = store(interval_sweep(points, rules.select(F.col("host_key").alias("key")), "url-hosts"), "url-open")

    inside = by_host.select("point", F.explode("stack").alias("open")).select(
        F.concat("open", F.unhex(F.lit("00")), F.col("point.path").cast("binary")).alias("key"), "point"
    )
    by_path = interval_sweep(inside, rules.select("key"), "url-paths")
    best = by_path.select("point", F.try_element_at("stack", F.lit(-1)).alias("key")).where("key is not null")
    # an outermost element would belong to another host only if a path held the separator: it ends the host
    fits = best.join(rules.select("key", "rule_host", "rule_path", "verdict"), "key").select(
        "point",
        F.struct(
            (F.length("rule_host") + F.length("rule_path")).alias("size"), F.length("rule_host").alias("host_size"),
            F.concat("rule_host", "rule_path").alias("rule"), "verdict",
        ).alias("fit"),
    )
    none = F.lit(None).cast(fits.schema["fit"].dataType).alias("fit")
    judged = (
        by_host.select("point", none).unionByName(fits)
        .groupBy(F.col("point.row").alias("row"))
        .agg(F.max("fit").alias("fit"), F.first("point").alias("point"))
    )
    return judged.select(
        F.col("point.id").alias(id_col), F.col("point.host").alias("host"), F.col("point.path").alias("path"),
        F.col("fit.rule").alias("rule"), F.coalesce("fit.verdict", F.lit(default)).alias("verdict"),
    )
