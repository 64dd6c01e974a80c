"""Language of texts by word-first backoff.

A word that the model knows is scored by its relative frequency in each language,
as a negative logarithm; a language that lacks it gets a fixed penalty. A word that no
language knows is taken apart into character n-grams with its ends marked, the
longest first: the first length of which any gram is known gives the word's score,
the mean over its grams. A text's score in a language is the mean over its
words, and the least one wins.

The model is fitted on a bounded sample of labelled rows and has a bounded number of
entries (``entries`` over all languages and lengths, the most frequent of each), so it
can be sent to every task. Texts are scored where they lie, without a shuffle.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import store, worker_memo

SAMPLE_ROWS = 5_000
ENTRIES = 400_000
LONGEST = 5
UNKNOWN = "und"
# words beyond which the score does not get surer, and words that a worker remembers
SURE_WORDS = 20
MEMO_WORDS = 400_000
# different words that a counting task holds before it passes them and their grams on
HELD = 50_000

WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    """Runs of letters, lower-cased; empty for a text without letters."""
    return WORD.findall(text.lower())


def grams(word: str, size: int) -> list[str]:
    """Character n-grams of the word with a space at either end; single characters without."""
    marked = word if size == 1 else f" {word} "
    return [marked[k:k + size] for k in range(len(marked) - size + 1)]


@dataclass
class Model:
    langs: list[str]
    keys: list[list[str]]  # known words, then known grams of length 1, 2, ...
    values: list[np.ndarray]  # one row per key, one column per language
    penalty: float
    name: str = ""

    def tables(self) -> list[dict[str, int]]:
        """Key -> row, built once per worker."""
        memo = worker_memo("language_id")
        if ("language", self.name) not in memo:
            memo["language", self.name] = [{k: n for n, k in enumerate(keys)} for keys in self.keys]
        return memo["language", self.name]


class Scorer:
    """Remembers the scores of words; made anew when it knows too many."""

    def __init__(self, model: Model):
        self.model, self.tables = model, model.tables()
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.matrix = np.empty((1024, len(self.model.langs)))

    def word(self, word: str) -> np.ndarray:
        known, values = self.tables, self.model.values
        row = known[0].get(word)
        if row is not None:
            return values[0][row]
        for size in range(len(known) - 1, 0, -1):
            parts = grams(word, size)
            found = [r for r in map(known[size].get, parts) if r is not None]
            if found:
                missing = (len(parts) - len(found)) * self.model.penalty
                return (np.add.reduce(values[size].take(found, axis=0)) + missing) / len(parts)
        return np.full(len(self.model.langs), self.model.penalty)

    def place(self, word: str) -> int:
        row = self.rows[word] = len(self.rows)
        if row == len(self.matrix):
            self.matrix = np.concatenate([self.matrix, np.empty_like(self.matrix)])
        self.matrix[row] = self.word(word)
        return row

    def text(self, text: str | None) -> tuple[str, float]:
        """The language and how sure it is, between 0 and 1."""
        words = words_of(text or "")
        langs = self.model.langs
        if not words or not langs:
            return UNKNOWN, 0.0
        if len(self.rows) > MEMO_WORDS:
            self.clear()
        counts = Counter(words)
        at = [self.rows[w] if w in self.rows else self.place(w) for w in counts]
        times = np.fromiter(counts.values(), "float64", len(counts))
        mean = times @ self.matrix[at] / len(words)
        best = int(np.argmin(mean))  # of equal ones the most frequent in training
        odds = 10.0 ** -((mean - mean[best]) * min(len(words), SURE_WORDS))
        return langs[best], float(1 / odds.sum())


# ── training ────────────────────────────────────────────────────────────────

def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``lang, size, gram, n``: words as size 0, and the grams of each different word; added up within a task as memory allows."""
    names = ["lang", "size", "gram", "n"]
    held: Counter = Counter()

    def flush():
        found: Counter = Counter()
        for (lang, word), n in held.items():
            found[lang, 0, word] += n
            for size in range(1, LONGEST + 1):
                for gram in grams(word, size):
                    found[lang, size, gram] += n
        held.clear()
        lang, size, gram = zip(*found)
        return pa.RecordBatch.from_arrays([
            pa.array(lang, pa.string()), pa.array(size, pa.int32()), pa.array(gram, pa.string()),
            pa.array(list(found.values()), pa.int64()),
        ], names)

    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
            for word, n in Counter(words_of(text)).items():
                held[lang, word] += n
            if len(held) > HELD:
                yield flush()
    if held:
        yield flush()


def quota_of(sizes: list[int], total: int) -> float:
    """Rows of a language such that all languages together, each at most with what it has, give ``total``."""
    left, rest = float(total), sorted(sizes)
    while rest and rest[0] <= left / len(rest):
        left -= rest.pop(0)
    return left / len(rest) if rest else float("inf")


def train(
    docs: DataFrame, sample_rows: int = SAMPLE_ROWS, entries: int = ENTRIES, id_col: str = "doc_id",
    text_col: str = "text", lang_col: str = "lang",
) -> Model:
    """Fit on the labelled rows of ``docs``: about ``sample_rows`` ids and no more, as many of each language as there are.

    Every language has a quota of rows, the same for all that have as many, and its ids are taken by a
    hash below the quota's share, so a rare language is not crowded out and the order of rows
    is of no account. Rows with a null id or language are left out; an id that occurs more than once
    counts with every row of its language. Without any row the model knows no language, and every text
    is ``und``. The languages themselves are taken to be few: the model holds a column for each.
    """
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"), F.col(lang_col).cast("string").alias("lang"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).where("id is not null and lang is not null")
    spark = docs.sparkSession
    sizes = {r.lang: r.n for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    quota = quota_of(list(sizes.values()), sample_rows)
    shares = spark.createDataFrame([(x, min(1.0, quota / n)) for x, n in sizes.items()], "lang string, share double")
    chance = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / (1 << 30)
    chosen = rows.select("id", "lang", chance.alias("chance")).join(F.broadcast(shares), "lang").where("chance < share")
    wanted = chosen.select("id", "lang", "chance").distinct().orderBy("chance", "id", "lang").limit(sample_rows).select("id", "lang")
    sample = rows.join(F.broadcast(wanted), ["id", "lang"]).select("lang", "text")
    counted = sample.mapInArrow(_counts, "lang string, size int, gram string, n long")
    counts = store(counted.groupBy("lang", "size", "gram").agg(F.sum("n").alias("n")), "language-counts")
    totals = counts.groupBy("lang", "size").agg(F.sum("n").alias("total"))
    sums = {(r.lang, r.size): r.total for r in totals.collect()}  # a row per language and length
    langs = sorted({lang for lang, _ in sums}, key=lambda x: (-sums[x, 0], x))
    each = max(1, entries // (max(1, len(langs)) * (LONGEST + 1)))
    most = F.row_number().over(Window.partitionBy("lang", "size").orderBy(F.desc("n"), "gram"))
    kept = counts.withColumn("rank", most).where(F.col("rank") <= each).select("gram", "size").distinct()
    # every count of a kept gram, also where another language has it below its own limit
    table = counts.join(kept, ["gram", "size"]).select("lang", "size", "gram", "n").toArrow()
    return build(langs, sums, table)


def build(langs: list[str], sums: dict[tuple[str, int], int], table: pa.Table) -> Model:
    place = {lang: k for k, lang in enumerate(langs)}
    penalty = float(np.log10(max(sums.values(), default=1))) + 1.0
    keys: list[dict[str, int]] = [{} for _ in range(LONGEST + 1)]
    cells: list[list[tuple[int, int, float]]] = [[] for _ in range(LONGEST + 1)]
    order = table.sort_by([("size", "ascending"), ("gram", "ascending")]) if table.num_rows else table
    for lang, size, gram, n in zip(*(order[c].to_pylist() for c in ("lang", "size", "gram", "n"))):
        row = keys[size].setdefault(gram, len(keys[size]))
        cells[size].append((row, place[lang], -np.log10(n / sums[lang, size])))
    values = []
    for known, own in zip(keys, cells):
        matrix = np.full((len(known), len(langs)), penalty)
        if own:
            row, column, value = zip(*own)
            matrix[list(row), list(column)] = value
        values.append(matrix)
    name = hashlib.sha256(repr((langs, penalty, [v.tobytes() for v in values], [list(k) for k in keys])).encode()).hexdigest()
    return Model(langs, [list(k) for k in keys], values, penalty, name)


# ── prediction ──────────────────────────────────────────────────────────────

def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: ``id, lang_pred, score``.

    A null text or one without a letter is ``und`` with the score 0, as is any text when the model knows
    no language. The score is the share of the best language: 1 where no other comes near, one over the
    number of languages where none is told apart. Ids may be null or repeat; other
    columns are ignored. An empty table gives no rows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = worker_memo("language_id")
        if ("scorer", model.name) not in memo:
            memo["scorer", model.name] = Scorer(model)
        score = memo["scorer", model.name].text
        for batch in batches:
            found = [score(t) for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["id"], pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())],
                [id_col, "lang_pred", "score"],
            )

    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(run, f"`{id_col}` {kind}, lang_pred string, score double")
