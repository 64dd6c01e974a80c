"""A stored article index, partitioned by term, and exact top-k search that skips what cannot win.

The index is a set of immutable segments. A segment holds, of the articles it
was made from,

* ``docs``: per article its number in the segment, attributes, length, and its words with their counts;
* ``postings``: per term blocks of at most ``BLOCK`` articles (their numbers), those with the greatest
  share in a score first, with the greatest count and least length of the block;
* ``terms``: per term how many articles have it, and the bounds of all its blocks;
* ``stats``: number and length of the articles.

``postings`` and ``terms`` are cut by a hash of the term, ``docs`` by the task that numbered the article, so a search
opens the files of its own terms and hits. Bodies are read and cut into words once, for ``docs``, which are written without a shuffle.
Postings are made from them: what a task gives for one cut of the terms travels as one compressed run. An update
writes a segment of the changed articles, names
the rows that are dead now (``dead``), and takes them off the counts with negative rows, so
frequencies are always those of a full rebuild. All tables of a segment appear in one commit;
:func:`merge_segments` joins small segments by size.

A search is exact. The scores that a few blocks give already bound the k-th best from
below (every share of a score is positive). Terms are then weighed by their greatest possible
share: an article that has only terms whose shares together stay below that bound cannot win, nor
can one in a block whose bound and the other terms' together do not reach it. Blocks that some query needs are dealt
once, whatever the number of queries, to ranges of articles, where blocks of queries meet them in arrays. What is left is
scored from the word counts of its own row.
"""

from __future__ import annotations

import math
import uuid
import zlib
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, shuffles_removed
from ..sources import snapshots
from ..sources.snapshots import KEY, Change
from .search import ATTRIBUTES, K1, QUERY_BLOCK, B, _apply_filters, _top, search_snippet, tokens

BLOCK = 128
BUCKETS = 256
# articles of a term up to which all its blocks are read for the first bound
RARE = 1024
# bounds are sums in another order than the scores, which are rounded to six places, and of shares in single precision
SLACK, RELATIVE = 1e-5, 1e-6
# bytes of text that are cut at once; postings that a task sorts at once, and those a task of a cut of terms gets, about
TEXT_BYTES, RUN, TASK_WORDS = 4 << 20, 1 << 21, 3 << 20
# postings of a term in one run from which its runs go to several tasks
HOT = 1024
# articles that meet a block of queries at once, as a power of two; a number is a task's and a row's
RANGE_BITS, TASK_BITS = 14, 33
# candidates that are scored from their own words, and sent to all tasks for that, without all blocks being read first, at most
FEW = 20_000

FORMAT = 2
DOCS = "article_id string, title string, category string, service string, tags array<string>, snippet string, doc_len bigint, words string, tfs array<int>, number bigint"
POSTINGS = "term string, block int, n int, max_tf bigint, min_len bigint, articles array<bigint>, tfs array<int>, lens array<int>"
TERMS = "term string, df bigint, max_tf bigint, min_len bigint"
STATS = "articles bigint, words bigint"
DEAD = "article_id string, segment string, number bigint"
LAYOUT = "buckets int, format int"
TERM_BUCKET, DOC_BUCKET = "term_bucket int", "doc_bucket int"
# tables and the columns they are cut by, for merging
CUTS = {"docs": "doc_bucket", "postings": "term_bucket", "terms": "term_bucket", "stats": None, "dead": None}
CODEC = "zstd"


@dataclass(frozen=True)
class StoredIndex:
    spark: SparkSession
    path: str
    buckets: int

    def table(self, name: str, schema: str, cut: str | None = None, buckets: set[str] | None = None) -> DataFrame:
        only = None if buckets is None else lambda part: part.day in buckets
        return snapshots.read(self.spark, self.path, name, schema, cut, only)

    @property
    def dead(self) -> DataFrame:
        return self.table("dead", DEAD).select("segment", "number")

    def live(self, rows: DataFrame) -> DataFrame:
        """Rows of articles (their ``number`` and the segment's key) that no update has replaced."""
        dead = self.dead.select(F.col("number").alias("_n"), F.col("segment").alias("_s"))
        return rows.join(dead, (F.col("number") == F.col("_n")) & (F.col(KEY) == F.col("_s")), "left_anti")

    @property
    def docs(self) -> DataFrame:
        return self.live(self.table("docs", DOCS, DOC_BUCKET))

    def size(self) -> tuple[int, float]:
        """Number of articles and their mean length."""
        n, words = self.table("stats", STATS).agg(F.sum("articles"), F.sum("words")).first()
        return n or 0, (words or 0) / n if n else 1.0


def _bucket(term: str, buckets: int) -> Column:
    return F.pmod(F.crc32(F.encode(term, "UTF-8")), F.lit(buckets)).cast("int")


def _doc_bucket(buckets: int) -> Column:
    return F.pmod(F.shiftright("number", TASK_BITS), F.lit(buckets)).cast("int")


def _share(tf, doc_len, mean: float):
    """The part of a score that the frequency of a term does not decide; of columns or arrays."""
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * doc_len / (mean or 1.0)))


# ── words ───────────────────────────────────────────────────────────────────

_LETTERS = np.isin(np.arange(256), np.frombuffer(b"abcdefghijklmnopqrstuvwxyz0123456789", "uint8"))


def _cut(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of ASCII letters and digits of lower-case texts, one after another, and how many each text has."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, "int64")[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, "uint8")[offsets[0] : offsets[-1]] if data else np.zeros(0, "uint8")
    offsets = offsets - offsets[0]
    inside = _LETTERS[data]
    begins = np.zeros(len(data) + 1, bool)  # a word, or none, after the end
    begins[0], begins[1:-1] = True, ~inside[:-1]
    begins[offsets] = True
    first = np.flatnonzero(inside & begins[:-1])
    begins[1:-1] |= ~inside[1:]
    begins[-1] = True
    last = np.flatnonzero(inside & begins[1:])
    ends = np.zeros(len(first) + 1, "int64")
    np.cumsum(last - first + 1, out=ends[1:])
    words = pa.LargeStringArray.from_buffers(len(first), pa.py_buffer(ends), pa.py_buffer(data[inside]))
    return words, np.diff(np.searchsorted(first, offsets))


def _lists(values: np.ndarray | pa.Array, sizes: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(sizes)), pa.int32()), values)


def _flat(lists: pa.Array) -> np.ndarray:
    return lists.flatten().to_numpy(zero_copy_only=False)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Articles with their lower-case body to the columns of ``docs`` but the number."""
    for batch in batches:
        sizes = np.cumsum(pc.binary_length(batch["_text"]).to_numpy(zero_copy_only=False))
        begin = 0
        while begin < len(batch):
            before = sizes[begin - 1] if begin else 0
            end = max(begin + 1, int(np.searchsorted(sizes, before + TEXT_BYTES, "right")))
            rows = batch.slice(begin, end - begin)
            words, lengths = _cut(rows["_text"])
            coded = words.dictionary_encode()
            most = max(1, len(coded.dictionary))
            pairs = np.repeat(np.arange(len(rows)) * most, lengths) + coded.indices.to_numpy()
            pairs.sort()
            at = np.flatnonzero(np.diff(pairs, prepend=-1))
            counts, row = np.diff(np.append(at, len(pairs))), pairs[at] // most
            distinct = np.bincount(row, minlength=len(rows))
            named = pc.binary_join(_lists(coded.dictionary.take(pa.array(pairs[at] % most)).cast(pa.string()), distinct), " ")
            kept = [c for c in rows.schema.names if c != "_text"]
            yield pa.RecordBatch.from_arrays(
                [*[rows[c] for c in kept], pa.array(lengths, pa.int64()), named, _lists(pa.array(counts, pa.int32()), distinct)],
                [*kept, "doc_len", "words", "tfs"],
            )
            begin = end


def _docs(articles: DataFrame, buckets: int) -> DataFrame:
    """Articles with a body as rows of ``docs``: one pass over the bodies."""
    shown = articles.select(*ATTRIBUTES, search_snippet(F.col("body")).alias("snippet"), F.lower("body").alias("_text"))
    rows = shown.mapInArrow(_count_words, DOCS.removesuffix(", number bigint"))
    return rows.withColumn("number", F.monotonically_increasing_id()).withColumn("doc_bucket", _doc_bucket(buckets))


# ── segments ────────────────────────────────────────────────────────────────

def _packed(table: pa.RecordBatch) -> bytes:
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as stream:
        stream.write_batch(table)
    return out.getvalue().to_pybytes()


def _crc(terms: pa.Array) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, terms.cast(pa.large_binary()).to_pylist()), "int64", len(terms))


def _slots(buckets: int, tasks: int) -> int:
    """So many tasks as sorted runs go to: whole buckets of terms, or equal shares of each."""
    return tasks if tasks <= buckets else buckets * math.ceil(tasks / buckets)


def _runs(buckets: int, slots: int):
    """Rows of ``docs`` to runs: for each slot the postings of about ``RUN`` at once, by term, as one value."""

    def sort(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        words, sizes = _cut(pa.concat_arrays(rows["words"].chunks))
        coded = words.dictionary_encode()
        codes, known = coded.indices.to_numpy(), coded.dictionary
        tf = _flat(pa.concat_arrays(rows["tfs"].chunks))
        crc, seen = _crc(known), np.bincount(codes, minlength=len(known))
        slot = crc % buckets
        if slots <= buckets:
            slot %= slots
        else:  # runs of a frequent term go to the tasks of its bucket in turn
            turn = np.where(seen >= HOT, rows["number"][0].as_py() >> TASK_BITS, 0)
            slot += buckets * ((crc // buckets + turn) % (slots // buckets))
        order = np.argsort(slot, kind="stable")
        rank = np.empty(len(order), "int64")
        rank[order] = np.arange(len(order))
        keys = (rank[codes] << 32) | np.arange(len(codes))
        keys.sort()
        at = keys & 0xFFFFFFFF
        article = np.repeat(np.arange(len(rows)), sizes)[at]
        number, length = rows["number"].to_numpy()[article], rows["doc_len"].to_numpy()[article]
        tf, seen, known, slot = tf[at], seen[order], known.take(pa.array(order)), slot[order]
        ends, out = np.append(0, np.cumsum(seen)), []
        bounds = np.append(np.flatnonzero(np.diff(slot, prepend=-1)), len(slot))
        for a, b in zip(bounds[:-1], bounds[1:]):
            x = slice(ends[a], ends[b])
            columns = [pa.array(v, t) for v, t in ((number[x], pa.int64()), (tf[x], pa.int32()), (length[x], pa.int32()))]
            run = [known.slice(a, b - a), *[_lists(c, seen[a:b]) for c in columns]]
            out.append(_packed(pa.RecordBatch.from_arrays(run, ["term", "articles", "tfs", "lens"])))
        return pa.RecordBatch.from_arrays([pa.array(slot[bounds[:-1]], pa.int32()), pa.array(out, pa.binary())], ["slot", "run"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            while len(batch):
                sizes = np.cumsum(pc.list_value_length(batch["tfs"]).to_numpy(zero_copy_only=False))
                fits = max(1, int(np.searchsorted(sizes, RUN - size, "right")))
                held.append(batch.slice(0, fits))
                size += sizes[min(fits, len(batch)) - 1]
                batch = batch.slice(fits)
                if size >= RUN or len(batch):
                    if size:
                        yield sort(held)
                    held, size = [], 0
        if size:
            yield sort(held)

    return cut


def _blocks(buckets: int, mean: float, block: int):
    """The runs of a slot to blocks of postings, in the order of the terms."""
    names = ["term_bucket", "term", "block", "n", "max_tf", "min_len", "articles", "tfs", "lens"]

    def merge(runs: list[bytes]) -> Iterator[pa.RecordBatch]:
        read = pa.Table.from_batches([pa.ipc.open_stream(r).read_next_batch() for r in runs])
        number, tf, length = (np.concatenate([_flat(c) for c in read[n].chunks]) for n in ("articles", "tfs", "lens"))
        sizes = np.concatenate([pc.list_value_length(c).to_numpy(zero_copy_only=False) for c in read["articles"].chunks])
        coded = pa.concat_arrays(read["term"].chunks).dictionary_encode()
        known = coded.dictionary
        by_term = pc.sort_indices(known).to_numpy()
        bucket = _crc(known) % buckets
        order = by_term[np.argsort(bucket[by_term], kind="stable")]
        rank = np.empty(len(order), "int64")
        rank[order] = np.arange(len(order))
        term = np.repeat(rank[coded.indices.to_numpy()], sizes)
        # a float that is not negative has the order of its bits: the greatest share of a term comes first
        share = _share(tf, length, mean).astype("float32").view("int32").astype("int64")
        at = np.argsort((term << 32) | (0x7FFFFFFF - share), kind="stable")
        term, number, tf, length = term[at], number[at], tf[at], length[at]
        begins = np.flatnonzero(np.diff(term, prepend=-1))
        place = np.arange(len(term)) - np.repeat(begins, np.diff(np.append(begins, len(term))))
        first = np.flatnonzero(place % block == 0)
        ends = np.append(first, len(term))
        most, least = np.maximum.reduceat(tf, first), np.minimum.reduceat(length, first)
        for a in range(0, len(first), 8192):
            b = min(a + 8192, len(first))
            x, n, of = slice(ends[a], ends[b]), np.diff(ends[a : b + 1]), order[term[first[a:b]]]
            columns = [
                pa.array(bucket[of], pa.int32()), known.take(pa.array(of)).cast(pa.string()),
                pa.array(place[first[a:b]] // block, pa.int32()), pa.array(n, pa.int32()),
                pa.array(most[a:b], pa.int64()), pa.array(least[a:b], pa.int64()),
                _lists(pa.array(number[x]), n), _lists(pa.array(tf[x], pa.int32()), n), _lists(pa.array(length[x], pa.int32()), n),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[bytes]] = {}
        for batch in batches:
            for slot, run in zip(batch["slot"].to_pylist(), batch["run"].to_pylist()):
                held.setdefault(slot, []).append(run)
        while held:
            yield from merge(held.pop(min(held)))

    return cut


def _segment(articles: DataFrame, path: str, segment: str, buckets: int, mean: float | None, everything: bool = False) -> dict[str, Change]:
    """The tables of a segment, from articles with a body; ``docs`` and ``postings`` are written, no record names them yet.

    ``mean``: length by which postings are put in order, by default that of the articles.
    """
    spark = articles.sparkSession

    def written(name: str, rows: DataFrame, schema: str, cut: str) -> tuple[Change, DataFrame]:
        change = snapshots.stage(spark, path, _change(name, rows, segment, everything))
        return change, snapshots.read_paths(spark, path, name, [p.path for p in change.parts], schema, cut)

    docs, rows = written("docs", _docs(articles, buckets), DOCS, DOC_BUCKET)
    n, words = rows.agg(F.count("*"), F.coalesce(F.sum("doc_len"), F.lit(0))).first()
    slots = _slots(buckets, max(spark.sparkContext.defaultParallelism, math.ceil(words / TASK_WORDS)))
    runs = rows.select("number", "doc_len", "words", "tfs").mapInArrow(_runs(buckets, slots), "slot int, run binary")
    blocks = runs.repartitionById(slots, "slot").mapInArrow(
        _blocks(buckets, (mean if mean is not None else words / n if n else 1.0) or 1.0, BLOCK), f"{TERM_BUCKET}, {POSTINGS}"
    )
    postings, rows = written("postings", blocks, POSTINGS, TERM_BUCKET)
    terms = rows.groupBy("term_bucket", "term").agg(
        F.sum("n").alias("df"), F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len")
    )
    stats = spark.createDataFrame([(n, words)], STATS)
    made = {name: _change(name, rows, segment, everything) for name, rows in (("terms", terms), ("stats", stats))}
    return {"docs": docs, "postings": postings, **made}


def _change(name: str, rows: DataFrame, segment: str, everything: bool = False) -> Change:
    rows, cut = rows.withColumn(KEY, F.lit(segment)), CUTS[name]
    if name == "terms":  # files are cut by bucket: rows of a bucket are brought together, sparse ones in one task
        rows = rows.hint("rebalance", F.col(cut))
    return Change(name, rows, {segment}, cut, everything, CODEC)


def _with_body(articles: DataFrame) -> DataFrame:
    return articles.filter("body IS NOT NULL AND article_id IS NOT NULL")


def save_article_index(articles: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Write the whole index as one segment, in place of whatever was there.

    Articles without id or body are not indexed; of an id that occurs more than once every row is.
    """
    spark, segment = articles.sparkSession, uuid.uuid4().hex
    with shuffles_removed(spark):
        tables = _segment(_with_body(articles), path, segment, buckets, None, True)
        tables["dead"] = _change("dead", spark.createDataFrame([], DEAD), segment, True)
        layout = spark.createDataFrame([(buckets, FORMAT)], LAYOUT).withColumn(KEY, F.lit("layout"))
        snapshots.commit(spark, path, [*tables.values(), Change("layout", layout, {"layout"}, None, True)])


def load_article_index(spark: SparkSession, path: str) -> StoredIndex:
    first = snapshots.read(spark, path, "layout", LAYOUT).first()
    if first and first.format != FORMAT:
        raise ValueError(f"{path}: an index of another format; write it again with save_article_index")
    return StoredIndex(spark, path, first.buckets if first else BUCKETS)


def refresh_article_index(articles: DataFrame, path: str, changed_since: Column) -> int:
    """Bring the index up to date; how many articles were new, updated at or after ``changed_since``, or gone.

    Ids are compared in full, which tells deletions; all else is done for the changed
    articles alone: a segment of their new texts, and negative counts of their old words.
    """
    with shuffles_removed(articles.sparkSession):
        return _refresh(articles, path, changed_since)


def _refresh(articles: DataFrame, path: str, changed_since: Column) -> int:
    spark, segment = articles.sparkSession, uuid.uuid4().hex
    index = load_article_index(spark, path)
    now = _with_body(articles)
    recent = F.col("updated_at") >= changed_since
    stored = index.docs.select("article_id", KEY, "number")
    there = now.select("article_id", recent.alias("_new"))
    both = stored.withColumnRenamed(KEY, "segment").join(there, "article_id", "full_outer")
    touched = materialize(
        both.filter("segment IS NULL OR _new IS NULL OR _new").select("article_id", "segment", "number"), "changed-articles"
    )
    number = touched.select("article_id").distinct().count()
    if not number:
        return 0
    dead = touched.filter("segment IS NOT NULL").distinct()
    # updated articles are told by their own row; only other rows are compared with the ids, and their bodies stay where they are
    changed, others = F.coalesce(recent, F.lit(False)), touched.select("article_id").distinct()
    ids = materialize(now.filter(~changed).select("article_id").join(others, "article_id", "left_semi").distinct(), "other-articles")
    count, fresh = ids.count(), now.filter(changed)
    if count:
        fresh = fresh.unionByName(now.filter(~changed).join(F.broadcast(ids) if count <= FEW else ids, "article_id", "left_semi"))
    n, mean = index.size()
    tables = _segment(fresh, path, segment, index.buckets, mean)
    found = {str(r.b) for r in dead.select(_doc_bucket(index.buckets).alias("b")).distinct().collect()}
    old = index.table("docs", DOCS, DOC_BUCKET, found).withColumnRenamed(KEY, "segment")
    old = old.join(dead.select("segment", "number"), ["segment", "number"], "left_semi")
    lost = old.filter("doc_len > 0").select(F.explode(F.split("words", " ")).alias("term"))
    lost = lost.groupBy("term").agg((-F.count("*")).alias("df")).select(
        _bucket("term", index.buckets).alias("term_bucket"), "term", "df",
        F.lit(None).cast("bigint").alias("max_tf"), F.lit(None).cast("bigint").alias("min_len"),
    )
    gone = old.agg((-F.count("*")).alias("articles"), (-F.coalesce(F.sum("doc_len"), F.lit(0))).alias("words"))
    for name, rows in (("terms", lost), ("stats", gone)):
        tables[name] = _change(name, tables[name].rows.drop(KEY).unionByName(rows), segment)
    tables["dead"] = _change("dead", dead, segment)
    snapshots.commit(spark, path, list(tables.values()))
    return number


def merge_segments(spark: SparkSession, path: str, **options) -> int:
    """Merge small parts of the index by size; searches and results stay as they are."""
    return snapshots.compact(spark, path, CUTS, codec=CODEC, **options)


# ── search ──────────────────────────────────────────────────────────────────

def _asked(index: StoredIndex, queries: DataFrame, n: int, mean: float) -> DataFrame:
    """``query_id, term, df, idf, bound``: the terms of the queries that some article has."""
    terms = queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term"))
    terms = materialize(terms.withColumn("term_bucket", _bucket("term", index.buckets)), "asked-terms")
    # no more numbers than the index has buckets
    buckets = {str(r.term_bucket) for r in terms.select("term_bucket").distinct().collect()}
    known = index.table("terms", TERMS, TERM_BUCKET, buckets).join(terms.select("term").distinct(), "term", "left_semi")
    known = known.groupBy("term").agg(F.sum("df").alias("df"), F.max("max_tf").alias("max_tf"), F.min("min_len").alias("min_len"))
    idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = terms.join(known.filter("df > 0"), "term").withColumn("idf", idf)
    bound = F.col("idf") * _share(F.col("max_tf"), F.col("min_len"), mean)
    return materialize(weighed.select("query_id", "term", "term_bucket", "df", "idf", bound.alias("bound")), "weighed-terms")


DEALT = f"{KEY} string, range bigint, term string, rows array<int>, shares array<float>"


def _deal(mean: float):
    """Blocks of postings to ranges of articles: what a range has of a term, about ``RUN`` postings at once."""

    def sort(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        sizes = np.concatenate([pc.list_value_length(b["articles"]).to_numpy(zero_copy_only=False) for b in held])
        number, tf, length = (np.concatenate([_flat(b[c]) for b in held]) for c in ("articles", "tfs", "lens"))
        term, segment = (pa.concat_arrays(rows[c].chunks).dictionary_encode() for c in ("term", KEY))
        source = np.repeat(np.arange(len(sizes)), sizes)
        home, code = segment.indices.to_numpy()[source], term.indices.to_numpy()[source]
        block = number >> RANGE_BITS
        blocks, place = np.unique(block, return_inverse=True)
        group = (home.astype("int64") * len(blocks) + place) * len(term.dictionary) + code
        at = np.argsort(group)
        home, code, block, number, share = home[at], code[at], block[at], number[at], _share(tf[at], length[at], mean)
        new = np.diff(group[at], prepend=-1) != 0
        first = np.flatnonzero(new)
        n = np.diff(np.append(first, len(at)))
        return pa.RecordBatch.from_arrays(
            [segment.dictionary.take(pa.array(home[first])), pa.array(block[first]), term.dictionary.take(pa.array(code[first])),
             _lists(pa.array(number & ((1 << RANGE_BITS) - 1), pa.int32()), n), _lists(pa.array(share.astype("float32")), n)],
            [KEY, "range", "term", "rows", "shares"],
        )

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if len(batch):
                held.append(batch)
                size += len(batch["articles"].flatten())
            if size >= RUN:
                yield sort(held)
                held, size = [], 0
        if held:
            yield sort(held)

    return deal


def _meet(k: int, filtered: bool, best_only: bool):
    """Sums of a block of queries over a range of articles: those that reach the floor and the range's k-th best, or just the best ``k``."""

    def meet(asked: pa.Table, dealt: pa.Table) -> pa.Table:
        query = pa.concat_arrays(asked["query_id"].chunks).dictionary_encode(null_encoding="encode") if len(asked) else None
        names, chosen, rows, sums = asked.schema.field("query_id").type, [], [], []
        if query is not None and len(dealt):
            size = 1 << RANGE_BITS
            total, able = np.zeros((len(query.dictionary), size)), np.full(size, not filtered)
            by_term: dict[str, list[tuple[int, float]]] = {}
            for q, term, idf in zip(query.indices.to_pylist(), asked["term"].to_pylist(), asked["idf"].to_pylist()):
                by_term.setdefault(term, []).append((q, idf))
            floor, others = np.zeros(len(total)), np.zeros(len(total))
            if not best_only:
                floor[query.indices.to_numpy()], others[query.indices.to_numpy()] = asked["floor"].to_numpy(), asked["_others"].to_numpy()
            gone = []
            for chunk in dealt.to_batches():
                at, share, terms = _flat(chunk["rows"]), _flat(chunk["shares"]), chunk["term"].to_pylist()
                ends = np.append(0, np.cumsum(pc.list_value_length(chunk["rows"]).to_numpy(zero_copy_only=False)))
                low = 0  # of the shares: the other rows have none
                for i, term in enumerate(terms):
                    here = at[ends[i] : ends[i + 1]]
                    if term is None:
                        gone.append(here)
                    elif not term:
                        able[here] = True
                    else:
                        part = share[low : low + len(here)].astype("float64")
                        low += len(here)
                        for q, idf in by_term.get(term, ()):
                            total[q, here] += idf * part
            for here in gone:
                able[here] = False
            for q, line in enumerate(total):
                met = np.flatnonzero((line > 0) & able)
                if len(met) >= k:
                    least = np.partition(line[met], len(met) - k)[len(met) - k]
                    if best_only:
                        met = met[np.argsort(-line[met], kind="stable")[:k]]
                    else:
                        floor[q] = max(floor[q], _lower(least))
                met = met[line[met] * (1 + RELATIVE) + others[q] >= floor[q]]
                chosen.append(np.full(len(met), q))
                rows.append(met)
                sums.append(line[met])
        if not sum(map(len, rows)):
            empty = [pa.array([], t) for t in (names, pa.string(), pa.int64(), pa.float64())]
            return pa.Table.from_arrays(empty, ["query_id", KEY, "number", "score"])
        rows = np.concatenate(rows)
        number = (dealt["range"][0].as_py() << RANGE_BITS) + rows
        return pa.table({
            "query_id": query.dictionary.take(pa.array(np.concatenate(chosen))),
            KEY: pa.array([dealt[KEY][0].as_py()], pa.string()).take(pa.array(np.zeros(len(rows), "int32"))),
            "number": number, "score": np.concatenate(sums),
        })

    return meet


def _lower(score):
    """What a sum of shares in single precision is worth at least."""
    return score * (1 - RELATIVE) - SLACK


def candidates(
    index: StoredIndex, queries: DataFrame, k: int = 5, filters: Mapping[str, object] | None = None,
) -> tuple[DataFrame, DataFrame, float]:
    """Articles (segment's key and number) that may be among the best ``k`` of a query, its weighed terms, and the mean length."""
    with shuffles_removed(index.spark):
        return _candidates(index, queries, k, filters)


def _candidates(
    index: StoredIndex, queries: DataFrame, k: int, filters: Mapping[str, object] | None,
) -> tuple[DataFrame, DataFrame, float]:
    n, mean = index.size()
    asked = _asked(index, queries, n, mean)
    buckets = {str(r.term_bucket) for r in asked.select("term_bucket").distinct().collect()}
    blocks = index.table("postings", POSTINGS, TERM_BUCKET, buckets)
    sides = math.ceil(asked.select("query_id").distinct().count() / QUERY_BLOCK) or 1
    low = F.col("number").bitwiseAND((1 << RANGE_BITS) - 1).cast("int")
    block = F.shiftright("number", RANGE_BITS).alias("range")
    ranges = materialize(index.table("docs", DOCS, DOC_BUCKET).select(KEY, block).distinct(), "ranges")

    def marked(rows: DataFrame, mark: Column) -> DataFrame:
        rows = rows.groupBy(KEY, block).agg(F.collect_list(low).alias("rows"))  # as many as a range has
        return rows.select(KEY, "range", mark.cast("string").alias("term"), "rows", F.expr("cast(array() AS array<float>)").alias("shares"))

    marks = marked(index.dead.withColumnRenamed("segment", KEY), F.lit(None))
    if filters:
        marks = marks.unionByName(marked(_apply_filters(index.docs, filters), F.lit("")))
    marks = materialize(marks, "marked-articles")

    def met(asked: DataFrame, blocks: DataFrame, best_only: bool) -> DataFrame:
        keys = [KEY, "range", "_q"]
        dealt = blocks.select(KEY, "term", "articles", "tfs", "lens").mapInArrow(_deal(mean), DEALT).unionByName(marks)
        dealt = dealt.withColumn("_q", F.explode(F.sequence(F.lit(0), F.lit(sides - 1))))
        asked = asked.withColumn("_q", F.pmod(F.xxhash64("query_id"), F.lit(sides)).cast("int")).crossJoin(ranges)
        kind = dict(queries.dtypes)["query_id"]
        return asked.groupBy(*keys).cogroup(dealt.groupBy(*keys)).applyInArrow(
            _meet(k, bool(filters), best_only), f"query_id {kind}, {KEY} string, number bigint, score double"
        )

    def kth(scores: DataFrame) -> DataFrame:
        best = Window.partitionBy("query_id").orderBy(F.desc("score"))
        ranked = scores.withColumn("_r", F.row_number().over(best)).filter(F.col("_r") <= k)
        least = ranked.groupBy("query_id").agg(F.min("score").alias("_least"), F.count("*").alias("_n"))
        return least.select("query_id", F.when(F.col("_n") == k, _lower(F.col("_least"))).otherwise(0.0).alias("floor"))

    # the k-th best of what the first blocks give is a bound from below
    # words are stored before they meet blocks, so that the planner knows that they are few and leaves the blocks where they are
    words = materialize(asked.groupBy("term").agg(F.max("df").alias("df")), "asked-words")
    first = blocks.join(words, "term").filter((F.col("block") == 0) | (F.col("df") <= RARE))
    least = kth(met(asked.select("query_id", "term", "idf"), first, True))

    # terms by bound: those that cannot reach the floor together bring no article of their own
    up = Window.partitionBy("query_id").orderBy("bound", "term").rowsBetween(Window.unboundedPreceding, 0)
    weighed = asked.join(least, "query_id", "left").fillna({"floor": 0.0})
    weighed = weighed.withColumn("_below", F.sum("bound").over(up))
    weighed = weighed.withColumn("leads", F.col("_below") >= F.col("floor")).withColumn(
        "_total", F.sum("bound").over(Window.partitionBy("query_id"))
    ).withColumn("_others", F.sum(F.when(~F.col("leads"), F.col("bound")).otherwise(0.0)).over(Window.partitionBy("query_id")))
    weighed = materialize(weighed, "leading-terms")
    leading = weighed.filter("leads")
    leading = weighed.filter("leads").select("query_id", "term", "idf", "bound", "floor", "_total", "_others")
    bounds = weighed.select("query_id", "_others").distinct()

    def reaching(asked: DataFrame, bounds: DataFrame) -> DataFrame:
        # a block is read if it reaches the floor of some query; what that adds to the sums of others is theirs as well
        needed = asked.groupBy("term").agg(F.min((F.col("floor") - F.col("_total") + F.col("bound")) / F.col("idf")).alias("_needed"))
        useful = blocks.join(materialize(needed, "needed-shares"), "term").filter(_share(F.col("max_tf"), F.col("min_len"), mean) >= F.col("_needed") - SLACK)
        found = materialize(met(asked.select("query_id", "term", "idf", "floor", "_others"), useful, False), "met-articles")
        # the k-th best sum is a better bound
        found = found.join(bounds.join(kth(found), "query_id"), "query_id")
        found = found.filter(F.col("score") * (1 + RELATIVE) + F.col("_others") >= F.col("floor"))
        return materialize(found.select("query_id", KEY, "number", "floor"), "candidates")

    found = reaching(leading, bounds)
    if found.count() > FEW:  # the other terms decide: all are summed, which leaves the best and what ties with them
        better = found.select("query_id", "floor").distinct()
        every = weighed.drop("floor", "_others").join(better, "query_id").withColumn("_others", F.lit(0.0))
        found = reaching(every, every.select("query_id", "_others").distinct())
    return found.drop("floor"), asked, mean


def _exact(mean: float, kept: list[str]):
    """Candidates with the words of their article and the weights of their query to their score."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch[c].to_pylist() for c in ("words", "tfs", "doc_len", "terms", "idfs")]
            parts = []
            for words, tfs, length, terms, idfs in zip(*columns):
                counts = dict(zip(words.split(), tfs))
                parts.append(sum(idf * _share(counts[t], length, mean) for t, idf in zip(terms, idfs) if t in counts))
            rows = pa.RecordBatch.from_arrays([*[batch[c] for c in kept], pa.array(parts, pa.float64())], [*kept, "score"])
            yield rows.filter(pc.greater(rows["score"], 0))

    return score


def search_index(
    index: StoredIndex, queries: DataFrame, k: int = 5, filters: Mapping[str, object] | None = None, snippet: bool = False,
) -> DataFrame:
    """Top ``k`` articles per query (``query_id``, ``query``): the hits of ``search.search_articles`` from a stored index.

    Filters narrow the hits, not the word statistics. Ties go to the smaller article id.
    """
    found, asked, mean = candidates(index, queries, k, filters)
    shown = [*ATTRIBUTES, *(["snippet"] if snippet else [])]
    buckets = {str(r.b) for r in found.select(_doc_bucket(index.buckets).alias("b")).distinct().collect()}
    docs = index.table("docs", DOCS, DOC_BUCKET, buckets).select(KEY, "number", *shown, "doc_len", "words", "tfs")
    weights = asked.groupBy("query_id").agg(F.collect_list(F.struct("term", "idf")).alias("_w"))
    weights = materialize(weights.select("query_id", F.col("_w.term").alias("terms"), F.col("_w.idf").alias("idfs")), "weights")
    rows = docs.join(F.broadcast(found) if found.count() <= FEW else found, [KEY, "number"]).join(weights, "query_id")
    rows = rows.select("query_id", *shown, "doc_len", "words", "tfs", "terms", "idfs")
    kinds = dict(rows.dtypes)
    scored = rows.mapInArrow(
        _exact(mean, ["query_id", *shown]), ", ".join([*[f"{c} {kinds[c]}" for c in ("query_id", *shown)], "score double"])
    )
    # rounded, so that equal articles tie whatever order the parts are summed in
    return _top(scored.withColumn("score", F.round("score", 6)), k).select("query_id", "rank", *shown, "score")
