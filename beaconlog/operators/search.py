"""Ranked search over knowledge articles: BM25 over words, cosine over vectors."""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize

K1, B = 1.2, 0.75
# queries and articles that meet in one matrix product, about, and terms that it adds up at once
QUERY_BLOCK, ARTICLE_BLOCK, TERM_CHUNK = 512, 4096, 512
# query vectors and vectors that meet in one matrix product, about
DENSE_BLOCK, VECTOR_BLOCK = 1024, 8192
# vectors from which cells are made, and the most cells
CELL_SAMPLE, MOST_CELLS = 4096, 256

# The search texts of a signal; its name stands between the two parts of a variant.
SERIES_TEXT = "runbook remediation root cause"
VARIANT_TEXTS = [
    ("", " failure root cause"),
    ("", " runbook remediation steps"),
    ("similar incidents ", ""),
]

ATTRIBUTES = ["article_id", "title", "category", "service", "tags"]


@dataclass(frozen=True)
class ArticleIndex:
    """``docs``: attributes and length per article; ``postings``: term counts."""

    docs: DataFrame
    postings: DataFrame | None


def tokens(text: Column) -> Column:
    """Lower-case runs of ASCII letters and digits."""
    return F.array_remove(F.split(F.lower(text), "[^a-z0-9]+"), "")


def _tokenised(articles: DataFrame) -> DataFrame:
    # explode() of a one-element array keeps later steps from cutting the body again
    rows = articles.filter(F.col("body").isNotNull()).withColumn("_tokens", F.explode(F.array(tokens(F.col("body")))))
    return rows.withColumn("doc_len", F.size("_tokens").cast("bigint"))


def build_article_index(articles: DataFrame, extra: Sequence[str] = ()) -> ArticleIndex:
    """Index all bodies; ``extra`` columns of the articles go with their attributes.

    An article's words are sorted and counted as runs inside its own row, so
    building postings shuffles nothing. explode() of a one-element array pins
    each step, which the next one refers to many times.
    """
    rows = _tokenised(articles)
    runs = (
        rows.select("article_id", "doc_len", F.explode(F.array(F.sort_array("_tokens"))).alias("_s"))
        .filter("doc_len > 0")
        .select(
            "*",
            F.expr("explode(array(filter(sequence(0, size(_s) - 1), i -> i = 0 OR _s[i] <> _s[i - 1])))").alias("_at"),
        )
        .selectExpr(
            "article_id",
            "doc_len",
            """inline(transform(_at, (p, j) -> struct(_s[p] AS term,
                CAST(coalesce(get(_at, j + 1), size(_s)) - p AS BIGINT) AS tf)))""",
        )
    )
    return ArticleIndex(
        rows.select(*ATTRIBUTES, *extra, "doc_len"), runs.select("term", "article_id", "tf", "doc_len")
    )


def queried_postings(articles: DataFrame, terms: DataFrame) -> DataFrame:
    """Postings of the given terms only, for searching articles without an index.

    Other words are dropped before counting. An article is split inside one
    task, so its counts are complete before the (small) shuffle. Every article
    has the empty word once, which tells the length also of those without any term.
    """
    terms = terms.union(terms.sparkSession.sql("SELECT '' AS term"))
    words = _tokenised(articles).select("article_id", "doc_len", F.explode(F.concat("_tokens", F.array(F.lit("")))).alias("term"))
    counted = words.join(terms, "term", "left_semi").groupBy("term", "article_id", "doc_len")
    return counted.agg(F.count("*").alias("tf"))


# ── word search ─────────────────────────────────────────────────────────────

def _apply_filters(docs: DataFrame, filters: Mapping[str, object] | None) -> DataFrame:
    for name, wanted in (filters or {}).items():
        if name == "tags":
            docs = docs.filter(F.array_contains("tags", wanted))
        elif isinstance(wanted, (list, tuple, set)):
            docs = docs.filter(F.col(name).isin(list(wanted)))
        else:
            docs = docs.filter(F.col(name) == wanted)
    return docs


def search_articles(
    queries: DataFrame,
    articles: DataFrame | None = None,
    k: int = 5,
    filters: Mapping[str, object] | None = None,
    index: ArticleIndex | None = None,
) -> DataFrame:
    """Top ``k`` articles per query (``query_id``, ``query``), all queries at once.

    Give the ``articles`` to search them directly (only the queried terms are
    then counted), or an ``index`` in memory; :mod:`article_index` searches a stored one. Filters narrow the hits, not the
    word statistics. Ties go to the smaller article id.
    """
    terms = materialize(
        queries.select("query_id", F.explode(F.array_distinct(tokens(F.col("query")))).alias("term")), "asked-terms"
    )
    # stored, so that the planner knows its size before words are compared with it
    wanted = materialize(terms.select("term").distinct(), "asked-words")
    if index is None:
        # the only reading of the bodies, needed several times: stored once, in its real size
        found = materialize(queried_postings(articles, wanted), "postings")
        lengths, postings = found.filter("term = ''"), found.filter("term <> ''")
        n, mean_len = lengths.agg(F.sum("tf"), F.sum(F.col("tf") * F.col("doc_len")) / F.sum("tf")).first()  # two numbers
        docs = articles.filter(F.col("body").isNotNull()).select(*ATTRIBUTES)
    else:
        postings, docs = index.postings.join(wanted, "term", "left_semi"), index.docs
        n, mean_len = docs.agg(F.count("*"), F.avg("doc_len")).first()
    if not n:
        n, mean_len = 0, 1.0

    frequency = postings.groupBy("term").agg(F.count("*").alias("df"))
    weighted = terms.join(frequency, "term").select(
        "query_id", "term", F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf")
    )
    weighted = materialize(weighted, "weighted-terms")
    kept = postings
    if filters:
        kept = postings.join(_apply_filters(docs, filters).select("article_id"), "article_id", "left_semi")
    # a frequent term is met by every block of articles, so none gathers its rows in one task
    sides = math.ceil(queries.count() / QUERY_BLOCK) or 1, math.ceil(n / ARTICLE_BLOCK) or 1
    asked = _blocks_of(weighted, "query_id", "_q", sides[0], "_a", sides[1])
    met = _blocks_of(kept.select("article_id", "term", "tf", "doc_len"), "article_id", "_a", sides[1], "_q", sides[0])
    kinds = dict(queries.dtypes)["query_id"], dict(docs.dtypes)["article_id"]
    scores = asked.groupBy("_q", "_a").cogroup(met.groupBy("_q", "_a")).applyInArrow(
        _score_words(k, mean_len or 1.0), f"query_id {kinds[0]}, article_id {kinds[1]}, score double"
    )
    hits = materialize(_top(scores, k), "hits")
    return docs.join(hits, "article_id").select(
        "query_id", "rank", "article_id", "title", "category", "service", "tags", "score"
    )


def _blocks_of(rows: DataFrame, key: str, own: str, blocks: int, other: str, others: int) -> DataFrame:
    """Rows with the block of their key, once for every block of the other side."""
    rows = rows.withColumn(own, F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int"))
    return rows.withColumn(other, F.explode(F.sequence(F.lit(0), F.lit(others - 1))))


def _score_words(k: int, mean_len: float):
    """Scores of a block of queries in a block of articles; the best ``k`` of each query leave it."""

    def score(asked: pa.Table, postings: pa.Table) -> pa.Table:
        words = pc.unique(asked["term"])
        postings = postings.filter(pc.is_in(postings["term"], value_set=words))
        query = asked["query_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        article = postings["article_id"].combine_chunks().dictionary_encode(null_encoding="encode")
        ids, queries = article.dictionary, query.dictionary
        q, a = query.indices.to_numpy(), article.indices.to_numpy()
        here = pc.unique(postings["term"])  # terms without an article in this block are left out
        term, found = (pc.index_in(t["term"], value_set=here) for t in (asked, postings))
        term, found = term.fill_null(-1).to_numpy(), found.to_numpy()
        tf, length = (postings[c].to_numpy() for c in ("tf", "doc_len"))
        share = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean_len))
        idf, total = asked["idf"].to_numpy(), np.zeros((len(queries), len(ids)))
        for low in range(0, len(here), TERM_CHUNK):
            n = min(TERM_CHUNK, len(here) - low)
            x, y = (term >= low) & (term < low + n), (found >= low) & (found < low + n)
            left = np.bincount(q[x] * n + term[x] - low, idf[x], len(queries) * n).reshape(-1, n)
            right = np.bincount((found[y] - low) * len(ids) + a[y], share[y], n * len(ids)).reshape(n, -1)
            total += left @ right
        # rounded, so that equal articles tie whatever order the parts are summed in
        order = pc.sort_indices(pa.table({"id": ids}), [("id", "ascending")], null_placement="at_start").to_numpy()
        matched, ranked = total[:, order] > 0, np.round(total[:, order], 6)
        best = [np.flatnonzero(m)[np.argsort(-row[m], kind="stable")[:k]] for m, row in zip(matched, ranked)]
        rows = np.repeat(np.arange(len(best)), [len(b) for b in best])
        columns = np.concatenate(best).astype("int64") if best else rows
        return pa.table({
            "query_id": queries.take(pa.array(rows)), "article_id": ids.take(pa.array(order[columns])), "score": ranked[rows, columns],
        })

    return score


def _top(scores: DataFrame, k: int) -> DataFrame:
    """Best ``k`` per query; Spark keeps only k rows per task before shuffling."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "article_id")
    return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)


def signal_search_queries(signals: DataFrame, variants: bool = False) -> DataFrame:
    """Search texts for each signal series; identical texts share one query."""
    series = signals.select("signal_type", "service", "route").distinct()
    name = F.col("signal_type")
    texts = [F.concat_ws(" ", "signal_type", "service", "route", F.lit(SERIES_TEXT))]
    if variants:
        texts += [F.concat(F.lit(before), name, F.lit(after)) for before, after in VARIANT_TEXTS]
    return (
        series.select("signal_type", "service", "route", F.posexplode(F.array(*texts)).alias("variant", "query"))
        .withColumn("query_id", F.sha2("query", 256))
    )


def search_snippet(body: Column, length: int = 300) -> Column:
    cut = F.concat(F.substring(body, 1, length), F.lit("..."))
    return F.when(body.isNull() | (body == ""), "(no body)").otherwise(cut)


# ── vector search ───────────────────────────────────────────────────────────

def _unit(vectors: Sequence) -> np.ndarray:
    rows = np.stack([np.asarray(v, dtype="float64") for v in vectors])
    return rows / np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)


def fit_cells(vectors: DataFrame, id_column: str, vector_column: str, sample: int = CELL_SAMPLE, most: int = MOST_CELLS) -> np.ndarray:
    """Centres of cells by k-means over at most ``sample`` vectors (those with the least hash of their id).

    The centres only decide how much is compared, never what is found.
    """
    some = vectors.filter(F.col(vector_column).isNotNull()).select(id_column, vector_column)
    picked = some.orderBy(F.xxhash64(id_column), id_column).limit(sample).toPandas()  # bounded
    if picked.empty:
        return np.zeros((0, 0))
    rows = _unit(picked[vector_column])
    centres = rows[:: max(1, len(rows) // min(most, max(1, int(len(rows) ** 0.5))))][:most].copy()
    for _ in range(8):
        nearest = (rows @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
        for c in np.unique(nearest):
            centres[c] = rows[nearest == c].mean(axis=0)
    return centres


def _assign(centres: np.ndarray, id_column: str, vector_column: str):
    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch[vector_column].notna()]
            if batch.empty:
                continue
            rows = _unit(batch[vector_column])
            cell = (rows @ centres.T - (centres**2).sum(axis=1) / 2).argmax(axis=1)
            gap = np.linalg.norm(rows - centres[cell], axis=1)
            yield pd.DataFrame({id_column: batch[id_column], vector_column: batch[vector_column], "cell": cell.astype("int32"), "gap": gap})

    return assign


def _able_cells(centres: np.ndarray, stats: dict[int, tuple[int, float]], k: int):
    """Rows of queries to the cells that may hold one of their best ``k``.

    The product with a vector lies within the cell's radius of that with its centre. Cells in the order of
    their lower bounds that hold ``k`` vectors give a floor; a cell whose upper bound is below it cannot win.
    """
    cells = np.array(sorted(stats), dtype="int32")
    count = np.array([stats[c][0] for c in cells])
    radius = np.array([stats[c][1] for c in cells])

    def able(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch = batch[batch["vector"].notna()]
            if batch.empty:
                continue
            middle = _unit(batch["vector"]) @ centres[cells].T
            for query_id, vector, row in zip(batch["query_id"], batch["vector"], middle):
                order = np.argsort(-(row - radius), kind="stable")
                enough = np.searchsorted(np.cumsum(count[order]), k)
                floor = (row - radius)[order[enough]] if enough < len(order) else -np.inf
                chosen = cells[row + radius >= floor - 1e-9]
                yield pd.DataFrame({"query_id": query_id, "vector": [vector] * len(chosen), "cell": chosen})

    return able


def _score_block(k: int, id_column: str, vector_column: str):
    def score(queries: pd.DataFrame, vectors: pd.DataFrame) -> pd.DataFrame:
        empty = pd.DataFrame({"query_id": queries["query_id"][:0], id_column: vectors[id_column][:0], "score": np.zeros(0)})
        if queries.empty or vectors.empty:
            return empty
        # rounded, so that equal directions tie whatever order the parts are summed in
        sims = np.round(_unit(queries["vector"]) @ _unit(vectors[vector_column]).T, 9)
        keys = vectors[id_column].to_numpy()
        # by score, then id, so that equal scores keep the smaller ids
        best = [np.lexsort((keys, -row))[:k] for row in sims]
        return pd.DataFrame({
            "query_id": np.repeat(queries["query_id"].to_numpy(), [len(b) for b in best]),
            id_column: np.concatenate([keys[b] for b in best]),
            "score": np.concatenate([row[b] for row, b in zip(sims, best)]),
        })

    return score


def able_pairs(queries: DataFrame, vectors: DataFrame, k: int, id_column: str, vector_column: str) -> tuple[DataFrame, DataFrame, dict]:
    """Queries with the cells that may win, vectors with their cell, and ``cell -> (vectors, radius)``."""
    centres = fit_cells(vectors, id_column, vector_column)
    kind = f"`{id_column}` {dict(vectors.dtypes)[id_column]}, `{vector_column}` {dict(vectors.dtypes)[vector_column]}"
    placed = vectors.select(id_column, vector_column).mapInPandas(
        _assign(centres, id_column, vector_column), f"{kind}, cell int, gap double"
    )
    placed = materialize(placed, "cells")
    found = placed.groupBy("cell").agg(F.count("*").alias("n"), F.max("gap").alias("r")).collect()  # a row per cell
    stats = {r.cell: (r.n, r.r) for r in found}
    types = dict(queries.dtypes)
    schema = f"query_id {types['query_id']}, vector {types['vector']}, cell int"
    asked = queries.select("query_id", "vector")
    if not stats:
        return queries.sparkSession.createDataFrame([], schema), placed, stats
    return materialize(asked.mapInPandas(_able_cells(centres, stats, k), schema), "able-cells"), placed, stats


def search_articles_dense(
    queries: DataFrame,
    vectors: DataFrame,
    k: int = 5,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Exact cosine top ``k`` per query vector (``query_id``, ``vector``).

    Vectors lie in cells of near directions. A query meets only the cells that can
    still win by the triangle inequality. Cells are cut into blocks of bounded size on both
    sides, a block is one matrix product, and what leaves it is k rows per
    query, not every pair. Neither side goes through the driver.

    Null vectors find nothing and are not found; one of zeros has the score 0 with all. Hits of
    equal query ids are ranked together. Scores are rounded to nine places, ties go to the smaller id.
    """
    spark = queries.sparkSession
    able, placed, stats = able_pairs(queries, vectors, k, id_column, vector_column)
    schema = f"query_id {dict(queries.dtypes)['query_id']}, `{id_column}` {dict(vectors.dtypes)[id_column]}, score double"
    if not stats:
        return spark.createDataFrame([], schema + ", rank int")
    asked = {r.cell: r.n for r in able.groupBy("cell").agg(F.count("*").alias("n")).collect()}  # a row per cell
    sizes = [(c, math.ceil(n / VECTOR_BLOCK), math.ceil(asked.get(c, 0) / DENSE_BLOCK)) for c, (n, _) in stats.items()]
    blocks = F.broadcast(spark.createDataFrame(sizes, "cell int, vector_blocks int, query_blocks int"))  # a row per cell

    def dealt(rows: DataFrame, own: str, other: str) -> DataFrame:
        """Rows with a random block of their own side, once for every block of the other."""
        rows = rows.join(blocks, "cell").filter("query_blocks > 0")
        chance = F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.col(f"{own}_blocks"))
        rows = rows.withColumn(f"{own}_block", chance.cast("int"))
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_blocks") - 1))
        return rows.withColumn(f"{other}_block", every).drop("vector_blocks", "query_blocks")

    keys = ["cell", "vector_block", "query_block"]
    left, right = dealt(able, "query", "vector"), dealt(placed.drop("gap"), "vector", "query")
    found = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(_score_block(k, id_column, vector_column), schema)
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), id_column)
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
