"""Quality scores learned from preferences by Bradley-Terry pairwise ranking.

A document with label 1 is preferred to one with label 0. The strength of a
document is a weighted sum of its text's features, and the probability that one
document beats another is the logistic function of the difference of their
strengths, so the weights come from logistic loss on feature differences of
preference pairs. Strengths have no zero point of their own: the threshold is the
quantile of the training strengths that leaves as large a share above it as the
preferred documents are, and strengths are mapped to scores from 0 to 1 such that
this quantile has the score ``threshold``.

The model is fitted on every labelled row. Rows are dealt to blocks of about
``BLOCK_ROWS`` by a hash, and in a block every preferred text is paired with every
other one; of a rare label rows go to several blocks, so that none is without
it. Centres, spreads, gradients, the quantile and the slope are sums over stored
features of all these rows, which tasks add up; only the sums, whose length does not
depend on the input, come to the driver. Every whole text is read where it
lies: its 25 features are joined with the labels, never the text, so what is shuffled and
stored does not depend on the length of texts. :func:`measure` stores the features of a table
once, for the fit and the scores.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import store, worker_memo

# labelled rows that are paired with one another, about, and rows of the rarer label among them at least
BLOCK_ROWS, BLOCK_RARE = 1024, 64
RIDGE = 1e-3
THRESHOLD = 0.7
# parts that a range of strengths is cut into, again and again, until the quantile's stands alone
CUTS = 4096

FEATURES = [
    "words", "word_length", "upper", "symbols", "digits", "spaces", "distinct_words", "top_word", "distinct_pairs",
    "repeats_next", "distinct_lines", "line_words", "stops", "odd_endings", "plain_words", "caps_words", "short_words",
    "long_words", "marks_run", "bars", "length_spread", "first_upper", "sentence_words", "letters", "empty",
]


def features(text: str) -> list[float]:
    """Numbers that describe how a text is written; all zero but the last for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * (len(FEATURES) - 1) + [1.0]
    n, chars = len(words), len(text)
    lines = [x for x in text.split("\n") if x.strip()]
    counts = Counter(words)
    pairs = len(set(zip(words, words[1:])))
    letters = sum(map(str.isalpha, text)) if not text.isascii() else len(re.findall("[A-Za-z]", text))
    upper = len(re.findall("[A-ZÀ-ÖØ-Þ]", text))
    symbols = len(re.findall(r"[^\w\s.,;:'\"-]", text))
    stops = len(re.findall(r"[.!?](?:\s|$)", text))
    lengths = np.fromiter(map(len, words), "float64", n)
    odd = sum(1 for w in words if not (w[-1].isalnum() or w[-1] in ".,;:'\")"))
    plain = sum(map(str.isalpha, words))
    return [
        np.log1p(n), lengths.mean(), upper / max(letters, 1), symbols / chars,
        len(re.findall(r"\d", text)) / chars, (chars - int(lengths.sum())) / chars,
        len(counts) / n, max(counts.values()) / n, pairs / max(n - 1, 1),
        sum(a == b for a, b in zip(words, words[1:])) / n, len(set(lines)) / max(len(lines), 1),
        np.log1p(n / max(len(lines), 1)), stops / n, odd / n, plain / n, sum(map(str.isupper, words)) / n,
        float((lengths <= 3).mean()), float((lengths >= 12).mean()),
        len(re.findall(r"[^\w\s]{2,}", text)) / n, words.count("|") / n, float(lengths.std()),
        sum(1 for w in words if w[0].isupper()) / n, np.log1p(n / max(stops, 1)), letters / chars, 0.0,
    ]


def expand(rows: np.ndarray) -> np.ndarray:
    """Features with their squares and steps, so that a weighted sum can bend."""
    return np.concatenate([rows, rows**2, np.sqrt(np.abs(rows))], axis=1)


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    quantile: float
    slope: float
    threshold: float

    def strength(self, rows: np.ndarray) -> np.ndarray:
        x = np.clip((expand(rows) - self.center) / self.scale, -8, 8)
        return x @ self.weights

    def score(self, rows: np.ndarray) -> np.ndarray:
        base = np.log(self.threshold / (1 - self.threshold))
        z = np.clip(self.slope * (self.strength(rows) - self.quantile) + base, -40, 40)
        return 1 / (1 + np.exp(-z))


# adds up a function that makes one array of features and labels
Sums = Callable[[Callable[[np.ndarray, np.ndarray], np.ndarray]], np.ndarray]


def _scaled(x: np.ndarray, center: np.ndarray, scale: np.ndarray) -> np.ndarray:
    return np.clip((expand(x) - center) / scale, -8, 8)


def _newton_sums(center: np.ndarray, scale: np.ndarray, weights: np.ndarray):
    """Pairs, gradient and Hessian of the pairwise loss over all pairs of a block."""

    def sums(x: np.ndarray, label: np.ndarray) -> np.ndarray:
        z = _scaled(x, center, scale)
        good, bad = z[label == 1], z[label == 0]
        lost = 1 / (1 + np.exp(np.clip((good @ weights)[:, None] - (bad @ weights)[None, :], -40, 40)))
        gradient = good.T @ lost.sum(axis=1) - bad.T @ lost.sum(axis=0)
        bend = lost * (1 - lost)
        cross = good.T @ bend @ bad
        hessian = (good.T * bend.sum(axis=1)) @ good + (bad.T * bend.sum(axis=0)) @ bad - cross - cross.T
        return np.concatenate([[lost.size], gradient, hessian.ravel()])

    return sums


def fit_sums(paired: Sums, rows: Sums, n_good: int, n_bad: int, threshold: float = THRESHOLD) -> Model:
    """Bradley-Terry weights from all pairs of ``paired`` blocks; quantile and slope from all ``rows``.

    Both add up a function of features and labels over their blocks. Newton's
    method on the pairwise logistic loss with a small ridge. Without
    both labels there is no preference: every text then scores ``threshold`` (all
    preferred, or no label) or just below it (none preferred).
    """
    n, wide = n_good + n_bad, 3 * len(FEATURES)
    center, scale, weights = np.zeros(wide), np.ones(wide), np.zeros(wide)
    if n:
        center = rows(lambda x, _: expand(x).sum(axis=0)) / n
        scale = np.sqrt(rows(lambda x, _: ((expand(x) - center) ** 2).sum(axis=0)) / n) + 1e-6
    if not (n_good and n_bad):
        return Model(center, scale, weights, -1e-9 if n_good or not n_bad else 1.0, 1.0, threshold)
    for _ in range(15):
        pairs, *found = np.split(paired(_newton_sums(center, scale, weights)), [1, 1 + wide])
        ridge = RIDGE * pairs[0] * np.eye(wide)
        step = np.linalg.solve(found[1].reshape(wide, wide) + ridge, found[0] - ridge @ weights)
        weights += step
        if np.abs(step).max() < 1e-4:
            break

    def strength(x: np.ndarray) -> np.ndarray:
        return _scaled(x, center, scale) @ weights

    # the strength of the rank at the share of the texts that are not preferred: its range is cut until it holds no other
    rank, below = int((n - 1) * n_bad / n), 0
    low, high = -8 * np.abs(weights).sum() - 1, 8 * np.abs(weights).sum() + 1
    for _ in range(5):
        edges = np.linspace(low, high, CUTS + 1)
        counts = rows(lambda x, _: np.histogram(strength(x), edges)[0].astype("float64"))
        part = int(np.searchsorted(below + np.cumsum(counts), rank, side="right"))
        below += int(counts[:part].sum())
        low, high = edges[part], edges[part + 1]
        if counts[part] <= 1 or high - low < 1e-12:
            break
    quantile = float((low + high) / 2)
    # the slope fits the scores to the labels around the fixed point of the quantile
    base, slopes = np.log(threshold / (1 - threshold)), np.geomspace(0.05, 20, 60)

    def losses(x: np.ndarray, label: np.ndarray) -> np.ndarray:
        sign, off = np.where(label == 1, 1.0, -1.0), strength(x) - quantile
        return np.array([np.logaddexp(0, -sign * (s * off + base)).sum() for s in slopes])

    return Model(center, scale, weights, quantile, float(slopes[int(np.argmin(rows(losses)))]), threshold)


def fit(rows: np.ndarray, labels: np.ndarray, threshold: float = THRESHOLD) -> Model:
    """The model of rows at hand, which are one block."""
    rows, labels = np.asarray(rows, "float64"), np.asarray(labels)
    return fit_sums(lambda f: f(rows, labels), lambda f: f(rows, labels), int((labels == 1).sum()), int((labels == 0).sum()), threshold)


# ── on Spark ────────────────────────────────────────────────────────────────

def _measured(texts: pa.Array) -> np.ndarray:
    """Features of texts, one at a time; the worker lets go what it remembers of an earlier step."""
    worker_memo("quality_rank")
    return np.array([features(t.as_py() or "") for t in texts], "<f8").reshape(-1, len(FEATURES))


def _unpack(rows: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(rows), "<f8").reshape(-1, len(FEATURES))


def _block(rows: pa.Table) -> pa.Table:
    """A block's rows as one; the blocks are what the passes of the fit read."""
    x, label = rows["x"].to_pylist(), rows["label"].to_numpy().astype("i1")
    return pa.table({"x": pa.array([b"".join(x)], pa.binary()), "label": pa.array([label.tobytes()], pa.binary())})


def _adder(blocks: DataFrame) -> Sums:
    """Adds a function of features and labels up over stored blocks; tasks give one row of sums each."""

    def add(of) -> np.ndarray:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = 0.0
            for batch in batches:
                for x, label in zip(batch["x"], batch["label"]):
                    total = total + of(_unpack([x.as_py()]), np.frombuffer(label.as_py(), "i1"))
            if not np.isscalar(total):
                yield pa.RecordBatch.from_pydict({"at": pa.array(np.arange(total.size), pa.int32()), "v": pa.array(total)})

        sums = blocks.mapInArrow(run, "at int, v double").groupBy("at").agg(F.sum("v").alias("v")).toArrow()
        out = np.zeros(sums.num_rows)
        out[sums["at"].to_numpy()] = sums["v"].to_numpy()
        return out

    return add


def measure(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One stored row per input row: id and ``x``, the features of the whole text; a null text counts as an empty one."""

    @F.arrow_udf("binary")
    def measured(texts: pa.Array) -> pa.Array:
        return pa.array([row.tobytes() for row in _measured(texts)], pa.binary())

    return store(docs.select(F.col(id_col).alias(id_col), measured(F.col(text_col)).alias("x")), "quality-measures")


def train(
    docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD,
    id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", x_col: str | None = None,
) -> Model:
    """Fit on all labelled documents.

    Rows with a null id or a label other than 0 and 1 are left out. An id
    that is labelled or occurs more than once counts once per match. With ``x_col``,
    ``docs`` holds features as :func:`measure` stores them, not texts.
    """
    if x_col is None:
        docs, x_col = measure(docs, id_col, text_col), "x"
    # stored in its real size, by which Spark chooses the join
    wanted = store(
        labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
        .where("id is not null and label in (0, 1)"), "quality-labels",
    )
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(x_col).alias("x"))
    found = store(rows.join(wanted, "id").select("id", "label", "x"), "quality-features")
    number = {r.label: r.n for r in found.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    good, bad = number.get(1, 0), number.get(0, 0)
    blocks = -(-(good + bad) // BLOCK_ROWS) or 1
    place = F.pmod(F.xxhash64("id", "x"), F.lit(blocks))
    rare, times = (1 if good < bad else 0), min(blocks, -(-BLOCK_RARE * blocks // max(1, min(good, bad))))
    # row of a rare label: one block after another, evenly apart, beginning with its own
    step = max(1, blocks // times)
    more = F.expr(f"transform(sequence(0, IF(label = {rare}, {times}, 1) - 1), i -> i * {step})")

    def dealt(frame: DataFrame, label: str) -> DataFrame:
        return store(frame.groupBy("block").applyInArrow(_block, "x binary, label binary"), label)

    once = dealt(found.select(place.alias("block"), "x", "label"), "quality-rows")
    paired = once
    if times > 1:
        each = found.select(place.alias("_at"), F.explode(more).alias("_i"), "x", "label")
        paired = dealt(each.select(F.pmod(F.col("_at") + F.col("_i"), F.lit(blocks)).alias("block"), "x", "label"), "quality-pairs")
    return fit_sums(_adder(paired), _adder(once), good, bad, threshold)


def scorer(model: Model):
    """An Arrow UDF from text to score; a null text is scored as an empty one."""

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.score(_measured(texts)), pa.float64())

    return score


def measured_scorer(model: Model):
    """An Arrow UDF from stored features to score."""

    @F.arrow_udf("double")
    def score(rows: pa.Array) -> pa.Array:
        return pa.array(model.score(_unpack(rows.to_pylist())), pa.float64())

    return score


def score_documents(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", x_col: str | None = None
) -> DataFrame:
    """One row per input row: ``id, score, predicted`` (1 from the threshold up).

    Null and empty texts get the score of a text without words, never null. Ids
    may be null or repeat; other columns are ignored. An empty table gives no rows. With ``x_col``,
    ``docs`` holds features as :func:`measure` stores them, not texts.
    """
    score = scorer(model)(F.col(text_col)) if x_col is None else measured_scorer(model)(F.col(x_col))
    out = docs.select(F.col(id_col).alias(id_col), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= model.threshold).cast("int"))
