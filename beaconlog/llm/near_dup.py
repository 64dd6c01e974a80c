"""Near-duplicates by MinHash bands, checked by odd sketches and confirmed on full sets.

Every text becomes its set of word shingles, the set a row of MinHash samples, and
the samples band keys and an odd sketch: a bitmap of parities whose XOR with
another one counts the samples in which two sets differ. Texts with equal sets
are one node from here on, so copies cost nothing further.

Nodes that share a band key meet in a bucket. First every member of a bucket is
proposed with its smallest and with its largest member; a proposal must have
sizes that allow the similarity and a sketch distance that does, and links only
after the full sets have been compared. So a group of thousands of near copies
becomes one component with one or two comparisons per member.

What is left are buckets with members of several components. Their members are
compared by sketches in blocks, without a row per pair: a block tells only which
members are connected by allowed pairs of different components. Members that are
connected form a cluster, meet once more in blocks that hold their texts, and all
allowed pairs of different components are compared on full sets there; a block
tells only the links that join components. Blocks of one large component do not
meet each other, so a large group costs as much as it has members. Every allowed
pair of a bucket is thus either compared or already inside one component.

With 40 bands of 4 samples, a pair at a similarity of 0.8 misses all buckets with
a chance below 1e-9; the sketch bound lies six standard deviations beyond 0.8.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_names, store, text_key
from .components import components
from .odd_sketch import Family, largest_distance, shingles

SHINGLE = 5
PERCENT = 80
SAMPLES, BANDS, ROWS, BITS, SEED = 256, 40, 4, 1024, 20
GROUP = 64  # texts that are compared with one other in a task at a time
BLOCK = 8192  # members of a bucket whose sketches are compared with one another in a task at a time
TEXT_BLOCK, TEXT_BLOCK_SHINGLES = 512, 500_000  # the same for full sets: members and their shingles in all


def _describe(size: int, samples: int, bands: int, rows: int, bits: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = Family(samples, bands, rows, bits, seed)
        for batch in batches:
            n, digest, keys, sketches = [], [], [], []
            for text in batch["text"].to_pylist():
                found = shingles(text, size)
                n.append(found.size)
                if found.size:
                    least = family.samples(found)
                    digest.append(hashlib.sha256(found.tobytes()).digest()[:16])
                    keys.append(family.band_keys(least))
                    sketches.append(np.frombuffer(family.sketch(least), "<i8"))
                else:
                    digest.append(None)
                    keys.append(None)
                    sketches.append(None)
            yield pa.RecordBatch.from_pydict({
                "id": batch["id"], "text_key": batch["text_key"], "n": pa.array(n, pa.int64()),
                "digest": pa.array(digest, pa.binary()), "keys": pa.array(keys, pa.list_(pa.int64())),
                "sketch": pa.array(sketches, pa.list_(pa.int64())),
            })

    return run


DESCRIBED = "id long, text_key string, n long, digest binary, keys array<long>, sketch array<long>"


def _distance(left: str, right: str, words: int) -> Column:
    """Ones in the XOR of two sketches."""
    ones = [F.expr(f"bit_count({left}[{k}] ^ {right}[{k}])") for k in range(words)]
    return functools.reduce(Column.__add__, ones)


def _fits(n_left: str, n_right: str, percent: int) -> Column:
    """Sizes between which the similarity is possible."""
    return F.least(n_left, n_right) * 100 >= F.greatest(n_left, n_right) * percent


# ── confirmation on full sets ───────────────────────────────────────────────

def _compare(size: int):
    def run(table: pa.Table) -> pa.Table:
        a = table.column("a")[0].as_py()
        seen, own = {}, None
        for node, text in zip(table.column("node").to_pylist(), table.column("text").to_pylist()):
            if node == a:
                own = shingles(text, size)
            elif node not in seen:
                seen[node] = shingles(text, size)
        shared = [np.intersect1d(own, other, assume_unique=True).size for other in seen.values()]
        total = [own.size + other.size - k for other, k in zip(seen.values(), shared)]
        return pa.table({
            "a": pa.array([a] * len(seen), pa.int64()), "b": pa.array(list(seen), pa.int64()),
            "shared": pa.array(shared, pa.int64()), "total": pa.array(total, pa.int64()),
        })

    return run


def _texts_of(texts: DataFrame, nodes: DataFrame) -> DataFrame:
    """``node, text``, by the ``id`` and ``text_key`` of ``nodes``; rows that repeat both count once."""
    same = F.col("t.id").eqNullSafe(F.col("p.id")) & (F.col("t.text_key") == F.col("p.text_key"))
    found = texts.alias("t").join(nodes.alias("p"), same).select("p.node", "t.text")
    return found.dropDuplicates(["node"])


def confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b, linked`` for distinct pairs of nodes, from the full sets of both; ``texts`` is ``node, text``.

    The texts of all partners of a node meet its own in groups of ``GROUP``, so a node
    with any number of partners is spread over as many tasks as it needs.
    """
    counted = pairs.groupBy("a").agg(F.ceil(F.count("*") / GROUP).alias("groups"))
    partners = pairs.join(counted, "a").select("a", F.pmod(F.xxhash64("b"), F.col("groups")).alias("salt"), F.col("b").alias("node"))
    centers = counted.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("groups") - 1)).alias("salt"), F.col("a").alias("node"))
    places = store(partners.unionByName(centers), "near-places")
    found = places.join(texts, "node").groupBy("a", "salt").applyInArrow(_compare(size), "a long, b long, shared long, total long")
    return found.select("a", "b", (F.col("shared") * 100 >= F.col("total") * percent).alias("linked"))


# ── proposals ───────────────────────────────────────────────────────────────

def _star(members: DataFrame, nodes: DataFrame, pick, words: int, cut: int, percent: int) -> DataFrame:
    """Every member of a bucket with the smallest or largest one, once; the closest center per member."""
    centers = members.groupBy("key").agg(pick("node").alias("center"))
    met = members.join(centers, "key").where("node <> center").select("center", "node").distinct()
    left = nodes.select(F.col("node").alias("center"), F.col("n").alias("n1"), F.col("sketch").alias("s1"))
    right = nodes.select("node", F.col("n").alias("n2"), F.col("sketch").alias("s2"))
    near = (
        met.join(left, "center").join(right, "node").where(_fits("n1", "n2", percent))
        .withColumn("d", _distance("s1", "s2", words)).where(F.col("d") <= cut)
    )
    best = near.groupBy("node").agg(F.min(F.struct("d", "center")).alias("best"))
    return best.select(F.least("node", "best.center").alias("a"), F.greatest("node", "best.center").alias("b")).distinct()


def _allowed(table: dict, left: np.ndarray, right: np.ndarray, cut: int, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places of pairs of different components that sizes and sketches allow, in bounded portions."""
    comp, n, sketch = table["component"], table["n"], table["sketch"]
    step = max(1, (1 << 20) // max(right.size, 1))
    for at in range(0, left.size, step):
        part = left[at:at + step]
        ok = comp[part][:, None] != comp[right][None, :]
        sizes = n[part][:, None], n[right][None, :]
        ok &= np.minimum(*sizes) * 100 >= np.maximum(*sizes) * percent
        x, y = np.nonzero(ok)
        x, y = part[x], right[y]
        d = np.zeros(x.size, "i4")
        for w in range(sketch.shape[1]):
            d += np.bitwise_count(sketch[x, w] ^ sketch[y, w])
        yield x[d <= cut], y[d <= cut]


def _columns(table: pa.Table) -> dict:
    out = {c: table.column(c).to_numpy() for c in ("node", "component", "n", "side")}
    out["sketch"] = np.stack(table.column("sketch").to_numpy(zero_copy_only=False)).astype("i8").view("u8")
    return out


def _sides(columns: dict) -> tuple[np.ndarray, np.ndarray]:
    """Places that meet: all with all in a block of its own, else side 0 with side 1."""
    side = columns["side"]
    if side.max() == 0:
        return (np.arange(side.size),) * 2
    return np.flatnonzero(side == 0), np.flatnonzero(side == 1)


class _Forest:
    """Union-find that keeps the pairs that joined something."""

    def __init__(self):
        self.above: dict = {}
        self.pairs: list[tuple[int, int]] = []

    def root(self, x):
        while (up := self.above.get(x, x)) != x:
            self.above[x] = x = self.above.get(up, up)
        return x

    def join(self, x, y, pair) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.above[max(x, y)] = min(x, y)
            self.pairs.append(pair)

    def table(self) -> pa.Table:
        a, b = zip(*self.pairs) if self.pairs else ((), ())
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _connect(cut: int, percent: int):
    """A forest of the members of a block that allowed pairs connect."""

    def run(table: pa.Table) -> pa.Table:
        columns, forest = _columns(table), _Forest()
        node = columns["node"]
        for x, y in _allowed(columns, *_sides(columns), cut, percent):
            for a, b in zip(node[x].tolist(), node[y].tolist()):
                forest.join(a, b, (a, b))
        return forest.table()

    return run


def _link(size: int, cut: int, percent: int):
    """A forest of the components of a block of texts that links on full sets join."""

    def run(table: pa.Table) -> pa.Table:
        columns, forest = _columns(table), _Forest()
        node, comp = columns["node"], columns["component"]
        texts, sets = table.column("text").to_pylist(), {}
        for x, y in _allowed(columns, *_sides(columns), cut, percent):
            for a in np.unique(x).tolist():
                # each pair of a block of its own comes twice; once is enough
                others = [b for b in y[x == a].tolist() if (node[b] > node[a] or columns["side"].max() > 0)
                          and forest.root(("c", int(comp[a]))) != forest.root(("c", int(comp[b])))]
                for b in others:
                    for k in (a, b):
                        if k not in sets:
                            sets[k] = shingles(texts[k], size)
                if not others:
                    continue
                ends = np.cumsum([sets[b].size for b in others])
                values = np.concatenate([sets[b] for b in others])
                place = np.minimum(np.searchsorted(sets[a], values), sets[a].size - 1)
                found = np.concatenate([[0], np.cumsum(sets[a][place] == values)])
                shared = found[ends] - found[np.concatenate([[0], ends[:-1]])]
                for b, k in zip(others, shared.tolist()):
                    if k * 100 >= (sets[a].size + sets[b].size - k) * percent:
                        forest.join(("c", int(comp[a])), ("c", int(comp[b])), (int(node[a]), int(node[b])))
        return forest.table()

    return run


def _blocked(members: DataFrame, nodes: DataFrame, block: int) -> DataFrame:
    """Members of buckets with several components, dealt to pairs of blocks of at most about ``block``."""
    open_keys = (
        members.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size"))
        .where("lo < hi").select("key", F.ceil(F.col("size") / block).alias("blocks"))
    )
    dealt = members.join(open_keys, "key").withColumn("own", F.pmod(F.xxhash64("node", F.lit(1)), F.col("blocks")))
    # block i meets every block j >= i: as side 0 of (i, j) and side 1 of (j, i)
    others = F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)
    spread = dealt.withColumn("other", F.explode(others)).select(
        "key", "node", "component", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        (F.col("own") > F.col("other")).cast("int").alias("side"),
    )
    return spread.join(nodes.select("node", "n", "sketch"), "node")


def _text_blocks(active: DataFrame) -> DataFrame:
    """Members of clusters (``node, cluster, component, n``), dealt to pairs of blocks of texts.

    A component with many active members has blocks of its own; the rest of a cluster
    shares blocks. Two blocks of one component have nothing to compare.
    """
    size = lambda: F.greatest(
        F.ceil(F.count("*") / TEXT_BLOCK), F.ceil(F.sum("n") / TEXT_BLOCK_SHINGLES)
    ).alias("blocks")
    per_comp = active.groupBy("cluster", "component").agg((F.count("*") >= TEXT_BLOCK / 8).alias("large"))
    owned = active.join(per_comp, ["cluster", "component"]).withColumn("owner", F.when(F.col("large"), F.col("component")).otherwise(-1))
    sizes = store(owned.groupBy("cluster", "owner").agg(size()), "near-blocks")
    blocks = sizes.select("cluster", "owner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    place = F.struct("owner", "block")
    left = blocks.select("cluster", place.alias("i"))
    right = blocks.select("cluster", place.alias("j"))
    met = left.join(right, "cluster").where("i <= j AND (i.owner = -1 OR i.owner <> j.owner)")
    sides = met.select("cluster", "i", "j", F.col("i").alias("own"), F.lit(0).alias("side")).unionByName(
        met.where("i <> j").select("cluster", "i", "j", F.col("j").alias("own"), F.lit(1).alias("side"))
    )
    dealt = owned.join(sizes, ["cluster", "owner"]).withColumn("block", F.pmod(F.xxhash64("node", F.lit(2)), F.col("blocks")))
    dealt = dealt.select("cluster", F.struct("owner", "block").alias("own"), "node", "component", "n")
    return dealt.join(sides, ["cluster", "own"]).select("cluster", "i", "j", "side", "node", "component", "n")


def _classes(
    docs: DataFrame, id_col: str, text_col: str, shingle: int, percent: int, samples: int, bands: int, rows: int,
    bits: int, seed: int,
) -> DataFrame:
    """``id, text_key, n, component, component_id`` per input row; ``component`` is null without shingles."""
    if bits % 64:
        raise ValueError("bits is a multiple of 64")
    words, cut = bits // 64, largest_distance(samples, bits, percent)
    texts = docs.select(
        F.col(id_col).cast("long").alias("id"), text_key(text_col).alias("text_key"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    )
    described = texts.mapInArrow(_describe(shingle, samples, bands, rows, bits, seed), DESCRIBED)
    described = store(described.withColumn("row", F.monotonically_increasing_id()), "near-described")

    nodes = described.where("digest is not null").groupBy("digest").agg(
        F.min_by(F.struct("id", "text_key", "n", "keys", "sketch"), "row").alias("r"),
        F.min("row").alias("node"), F.min("id").alias("low"),
    )
    nodes = store(nodes.select("node", "digest", "low", "r.*"), "near-nodes")
    met = nodes.select("node", F.explode("keys").alias("key"))
    shared = met.groupBy("key").agg(F.count("*").alias("size")).where("size > 1").select("key")
    members = store(met.join(shared, "key"), "near-members")
    nodes_only = nodes.drop("keys", "digest")

    # the only other pass over the texts: of nodes that share a bucket with another one
    sharing = members.select("node").distinct().join(nodes.select("node", "id", "text_key"), "node")
    held = store(_texts_of(texts, sharing), "near-texts")

    links: list[DataFrame] = []
    merged: DataFrame | None = None

    def labelled() -> DataFrame:
        if merged is None:
            return members.withColumn("component", F.col("node"))
        own = members.join(merged, "node", "left")
        return own.withColumn("component", F.coalesce("component", "node"))

    stars = [_star(members, nodes_only, pick, words, cut, percent) for pick in (F.min, F.max)]
    pairs = store(stars[0].unionByName(stars[1]).distinct(), "near-pairs")
    if not pairs.isEmpty():
        found = store(confirm(pairs, held, shingle, percent), "near-tested")
        links.append(found.where("linked").select("a", "b"))
        merged = store(components(links[0]), "near-merged")

    blocks = _blocked(labelled(), nodes_only, BLOCK)
    joined = blocks.groupBy("key", "i", "j").applyInArrow(_connect(cut, percent), "a long, b long")
    joined = store(joined.distinct(), "near-connected")
    if not joined.isEmpty():
        active = components(joined, "near-clusters").withColumnRenamed("component", "cluster")
        own = active.join(merged, "node", "left") if merged is not None else active.withColumn("component", F.lit(None).cast("long"))
        own = own.withColumn("component", F.coalesce("component", "node")).join(nodes_only.select("node", "n"), "node")
        dealt = _text_blocks(store(own, "near-active")).drop("n")
        dealt = store(dealt.join(nodes_only.select("node", "n", "sketch"), "node"), "near-dealt")
        found = dealt.join(held, "node").groupBy("cluster", "i", "j").applyInArrow(_link(shingle, cut, percent), "a long, b long")
        links.append(store(found, "near-linked"))
        merged = store(components(functools.reduce(DataFrame.unionByName, links)), "near-merged")

    if merged is None:
        merged = docs.sparkSession.createDataFrame([], "node long, component long")
    placed = nodes.select("node", "digest", "low").join(merged, "node", "left")
    placed = placed.withColumn("component", F.coalesce("component", "node"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    by_set = placed.join(lowest, "component").select("digest", "component", "component_id")
    return described.select("id", "text_key", "n", "digest").join(by_set, "digest", "left").drop("digest")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    percent: int = PERCENT,
    samples: int = SAMPLES,
    bands: int = BANDS,
    rows: int = ROWS,
    bits: int = BITS,
    seed: int = SEED,
) -> DataFrame:
    """One row per input row: ``id, n_shingles, component_id, kept``.

    Words are separated by white space (space, 0x09 to 0x0D), A-Z is lower-cased. Two
    rows are linked if their sets of distinct shingles of ``shingle`` words have a
    Jaccard similarity of at least ``percent`` in a hundred; equal sets always are.
    ``component_id`` is the smallest id that links lead to, ``kept`` says that it is the
    row's own.

    Null, empty and blank texts have no shingles, are linked with nothing and are kept;
    a text with fewer words is a single shingle. A null id never becomes a
    ``component_id`` unless the whole component has none; such rows are not kept as long
    as another row of the component is. Rows that repeat an id are separate rows with
    the same ``component_id`` if their texts are linked. Other columns are ignored. An
    empty table gives no rows.
    """
    out = _classes(docs, id_col, text_col, shingle, percent, samples, bands, rows, bits, seed)
    component = F.when(F.col("component").isNull(), F.col("id")).otherwise(F.col("component_id"))
    return out.select(
        F.col("id").alias(id_col), F.col("n").alias("n_shingles"), component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )


def drop_near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """The input's rows and columns, of every group of linked rows the one with the smallest id.

    Of rows with that id the one with the smallest text hash stays; rows that repeat id
    and text are one row. Null and empty texts are linked with nothing and stay; a null id stays
    only where its group has no other. Columns of any name go through unchanged. An empty table gives no rows.
    """
    out = _classes(docs, id_col, text_col, shingle, percent, SAMPLES, BANDS, ROWS, BITS, SEED)
    # nulls last: a row without id stays only if its group has no other
    rank = F.struct(F.col("id").isNull(), "id", "text_key")
    best = out.where("component is not null").groupBy("component").agg(F.min(rank).alias("r")).select("r.id", "r.text_key")
    alone = out.where("component is null").select("id", "text_key")
    own_id, own_key, stay_id, stay_key = free_names(docs, "_id", "_key", "_stay_id", "_stay_key")
    stay = store(best.unionByName(alone).distinct().toDF(stay_id, stay_key), "near-stay")
    rows = docs.withColumn(own_id, F.col(id_col).cast("long")).withColumn(own_key, text_key(text_col))
    same = F.col(own_id).eqNullSafe(F.col(stay_id)) & (F.col(own_key) == F.col(stay_key))
    return rows.join(stay, same, "left_semi").dropDuplicates([own_id, own_key]).select(*docs.columns)
