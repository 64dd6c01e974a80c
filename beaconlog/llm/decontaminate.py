"""Benchmark decontamination by a prefix-filtered set join (DataFrame functions only).

Benchmark items are cut into windows of ``window`` consecutive words; an item
with fewer words is one window. A window is the sequence of its shingles, and it
can only occur in a document that has all of them, so it is enough to look for
one, the necessary prefix of a containment join: the rarest, by the number of
times that each benchmark shingle occurs in the whole corpus.

The corpus is read twice. Its shingles are produced inside generated code and meet
the benchmark's in a hash join, verified word by word. The first reading only
counts how often each benchmark shingle occurs, on the map side, and stores one row
per shingle. The second one joins the rarest shingle of each window and nothing
else; only these meetings leave the scan, as narrow rows with the words around
them, next to one row per document. A meeting fixes where the window would have to
start (positional bound) and whether it can end inside the document (length
bound). What remains is verified exactly, against all words of the window.

The benchmark is the side that does not grow with the corpus. It is joined in
blocks of at most ``block_shingles`` shingles, so a broadcast never exceeds what
one block can hold; a larger benchmark takes more passes, never another method.
Documents are never shuffled.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import ascii_lower, free_names, store, text_key

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
SHINGLE = 5
BLOCK_SHINGLES = 200_000


def words_of(text: Column) -> Column:
    """Runs of digits, lower-cased letters and non-ASCII characters; none for a null text."""
    words = F.regexp_extract_all(ascii_lower(text), F.lit(WORD), F.lit(0))
    return F.coalesce(words, F.array().cast("array<string>"))


def _shingle_at(size: int, at: str = "at") -> Column:
    """Hash of the ``size`` words of ``w`` from position ``at`` on, without building an array."""
    return F.xxhash64(F.lit(size), *[F.get("w", F.col(at) + k) for k in range(size)])


def benchmark_windows(benchmark: DataFrame, window: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """``(window_id, w, size)`` for every distinct window, and ``(window_id, item)``."""
    items = benchmark.select(F.col(id_col).cast("string").alias("item"), words_of(F.col(text_col)).alias("all"))
    items = items.where(F.size("all") > 0)
    starts = F.sequence(F.lit(0), F.greatest(F.size("all") - window, F.lit(0)))
    cut = items.select("item", "all", F.explode(starts).alias("at")).select(
        "item", F.slice("all", F.col("at") + 1, F.lit(window)).alias("w")
    )
    cut = cut.withColumn("window_id", F.sha2(F.array_join("w", " "), 256)).distinct()
    cut = store(cut, "bench-windows")
    windows = cut.groupBy("window_id").agg(F.first("w").alias("w")).withColumn("size", F.size("w"))
    return windows, cut.select("window_id", "item")


def _shingles(rows: DataFrame, sizes: list[int], *keep: str) -> DataFrame:
    """``keep``, ``w``, ``at``, ``n``, ``shingle``: a row for every shingle of every size, and one
    with a null shingle for a row of too few words."""
    at = rows.select(*keep, "w", F.explode_outer(F.when(F.size("w") > 0, F.sequence(F.lit(0), F.size("w") - 1))).alias("at"))
    hashes = [F.when(F.col("at") + n <= F.size("w"), _shingle_at(n)) for n in sizes]
    if len(sizes) == 1:
        return at.select(*keep, "w", "at", F.lit(sizes[0]).alias("n"), hashes[0].alias("shingle"))
    each = F.array(*[F.struct(F.lit(n).alias("n"), h.alias("shingle")) for n, h in zip(sizes, hashes)])
    return at.select(*keep, "w", "at", F.explode(each).alias("e")).select(*keep, "w", "at", "e.n", "e.shingle")


def _blocks(shingles: DataFrame, most: int) -> list[DataFrame]:
    """The table in blocks of about ``most`` rows, one block at least."""
    blocks = max(1, -(-shingles.count() // most))
    return [shingles.where(F.pmod(F.xxhash64("shingle"), F.lit(blocks)) == k) for k in range(blocks)]


HITS = "id long, key string, start int, size int, window_id string"


def occurrences(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_shingles: int = BLOCK_SHINGLES,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Every occurrence, every document, every window's items.

    ``(id, key, start, size, window_id)`` distinct, ``start`` counting words from 0;
    ``(id, key, n_words)`` per input row; ``(window_id, item)``. ``(id, key)`` names
    a row by its id and text, so rows that repeat both share their occurrences.
    """
    windows, owners = benchmark_windows(benchmark, window, item_id, item_text)
    # shingles have `shingle` words; a window with fewer is one shingle
    windows = store(windows.withColumn("n", F.least("size", F.lit(shingle))), "bench-distinct")
    sizes = sorted(r[0] for r in windows.select("n").distinct().collect())  # at most `shingle` numbers
    read = docs.select(F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("key"),
                       words_of(F.col(text_col)).alias("w"))
    if not sizes:
        rows = read.select("id", "key", F.size("w").alias("n_words"))
        return docs.sparkSession.createDataFrame([], HITS), rows, owners

    cut = _shingles(windows.withColumnRenamed("n", "own"), sizes, "window_id", "size", "own")
    cut = cut.where((F.col("n") == F.col("own")) & F.col("shingle").isNotNull())
    words = F.slice("w", F.col("at") + 1, F.col("n"))
    every = store(cut.select("window_id", "size", "n", "at", "shingle", words.alias("words")), "bench-shingles")
    wanted = store(every.select("shingle", "n", "words").distinct(), "bench-wanted")

    scanned = _shingles(read, sizes, "id", "key")
    agree = F.slice("w", F.col("at") + 1, F.col("n")) == F.col("words")
    counts = [
        scanned.join(F.broadcast(side), ["shingle", "n"]).where(agree).groupBy("n", "shingle").agg(F.count("*").alias("times"))
        for side in _blocks(wanted, block_shingles)
    ]
    frequency = store(functools.reduce(DataFrame.unionByName, counts), "bench-frequency")
    # a shingle that no document has rules its windows out
    rank = F.struct(F.coalesce("times", F.lit(0)).alias("times"), F.col("at"), F.col("shingle"))
    rarest = every.join(frequency, ["n", "shingle"], "left").groupBy("window_id", "size", "n").agg(F.min(rank).alias("r"))
    prefix = rarest.where(F.col("r.times") > 0).select(
        "window_id", "size", "n", F.col("r.shingle").alias("shingle"), F.col("r.at").alias("before")
    )
    prefix = store(prefix.join(windows.select("window_id", F.col("w").alias("all")), "window_id"), "bench-prefix")
    rare = store(wanted.join(prefix.select("shingle", "n"), ["shingle", "n"], "left_semi"), "bench-rare")

    # one row for every meeting, and from the first pass one for the first word of every document
    passes = []
    first = F.coalesce(F.col("at"), F.lit(0)) == 0
    left = F.greatest(F.col("at") - (window - 1), F.lit(0))
    for k, side in enumerate(_blocks(rare, block_shingles)):
        met = scanned.join(F.broadcast(side), ["shingle", "n"], "left" if k == 0 else "inner")
        met = met.withColumn("hit", F.coalesce(F.when(F.col("words").isNotNull(), agree), F.lit(False)))
        opens = (first & (F.col("n") == sizes[0])) if k == 0 else F.lit(False)
        around = F.when(F.col("hit"), F.slice("w", left + 1, F.lit(2 * window - 1)))
        passes.append(
            met.where(F.col("hit") | opens).select(
                "id", "key", F.size("w").alias("n_words"), "at", "n", "shingle", left.alias("left"), around.alias("around"),
                "hit", opens.alias("opens"),
            )
        )
    met = store(functools.reduce(DataFrame.unionByName, passes), "bench-meetings")
    # two shingles with one hash would open a document twice; equal rows open it once each
    rows = met.where("opens").select("id", "key", "n_words")
    start = F.col("at") - F.col("before")
    verified = (
        met.where("hit").join(prefix, ["n", "shingle"])
        .withColumn("start", start)
        .where((F.col("start") >= 0) & (F.col("start") + F.col("size") <= F.col("n_words")))
        .where(F.slice("around", F.greatest(F.col("start") - F.col("left"), F.lit(0)) + 1, F.col("size")) == F.col("all"))
        .select("id", "key", "start", "size", "window_id").distinct()
    )
    return verified, rows, owners


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: ``id, n_words, n_hit, n_items, items, contaminated``.

    ``n_hit`` counts the words that lie inside any occurrence of any window,
    ``items`` lists the ids (as text, sorted) of the items whose windows occur.

    Null or empty texts have no words and no hits; so have null or empty items.
    Items that repeat a text are separate items with the same windows; an item
    with a null id marks words but is not listed. Rows that repeat id and text get
    equal results. A null document id is a value like any other. Other columns of
    either table are ignored. An empty benchmark leaves every row clean.
    """
    found, rows, owners = occurrences(docs, benchmark, id_col, text_col, **options)
    found = store(found, "bench-hits")
    spans = found.groupBy("id", "key", "start").agg(F.max("size").alias("size"))
    row = Window.partitionBy("id", "key").orderBy("start")
    end = F.col("start") + F.col("size")
    reached = F.coalesce(F.max(end).over(row.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    covered = spans.withColumn("new", F.greatest(end - F.greatest("start", reached), F.lit(0)))
    words = covered.groupBy("id", "key").agg(F.sum("new").cast("long").alias("n_hit"))
    items = (
        found.select("id", "key", "window_id").distinct().join(owners, "window_id")
        .groupBy("id", "key")
        .agg(F.sort_array(F.collect_set("item")).alias("items"))
    )
    hit = words.join(items, words["id"].eqNullSafe(items["id"]) & (words["key"] == items["key"])).select(
        words["id"].alias("id"), words["key"].alias("key"), "n_hit", "items"
    )
    hit = store(hit, "bench-verdicts")
    joined = rows.join(hit, rows["id"].eqNullSafe(hit["id"]) & (rows["key"] == hit["key"]), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    return joined.select(
        rows["id"].alias(id_col), F.col("n_words").cast("long").alias("n_words"), F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.size(items).cast("long").alias("n_items"), items.alias("items"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows, with all their columns, in which no window of the benchmark occurs.

    Null and empty texts have no words and stay, as does everything when the benchmark has none.
    Rows may repeat and ids be null: a row is judged by its id and text. Columns of any name go
    through unchanged. An empty table gives no rows.
    """
    own_id, own_key, hit_id, hit_key = free_names(docs, "_id", "_key", "_hit_id", "_hit_key")
    found, _, _ = occurrences(docs, benchmark, id_col, text_col, **options)
    hit = store(found.select(F.col("id").alias(hit_id), F.col("key").alias(hit_key)).distinct(), "bench-hit-rows")
    out = docs.withColumn(own_id, F.col(id_col).cast("long")).withColumn(own_key, text_key(text_col))
    same = F.col(own_id).eqNullSafe(F.col(hit_id)) & (F.col(own_key) == F.col(hit_key))
    return out.join(hit, same, "left_anti").select(*docs.columns)
