"""A Merkle manifest of a dataset, proofs by butterfly exchange.

Leaves are hashes of rows, numbered within their group in order. ``FANOUT ** LEVELS``
consecutive leaves are a block, aligned to the tree, so a block's own levels need no
other block. Blocks then work like the lines of a butterfly network. In round r the
``FANOUT`` blocks whose numbers differ in digit r alone swap the subtree roots they
have, and each of them hashes the parent for itself. After round r a block knows its
ancestor ``LEVELS + r + 1`` levels up and all siblings on the way; after the last one
it knows the root of its group and its whole proof. Nothing is sent back down.

The last subtree of a level may hold fewer blocks than its siblings. It then answers
for the partners it does not have: its blocks send their root to the free lines in
turn, which adds less rows to a round than there are blocks.

A block is a bounded number of leaves and an exchange at most ``FANOUT`` rows, so a
group with a third of all rows only makes more blocks. The roots of the groups are
the leaves of one more tree, built in the same way.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.window import Window

from .common import ascii_lower, store

FANOUT = 8
LEVELS = 3

# the siblings of a node in its run, joined: those before it and those after it
STEP = "struct<before:string,after:string>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ── leaves ──────────────────────────────────────────────────────────────────

def field(value: Column) -> Column:
    """``-`` for null, else the UTF-8 length, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(columns: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, columns)), 256)


# ── numbering and blocks ────────────────────────────────────────────────────

def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds ``inside``, the running number of a row within its group and task."""
    last, n = object(), 0
    for batch in batches:
        inside = []
        for group in batch["group"].to_pylist():
            n = n + 1 if group == last else 0
            last = group
            inside.append(n)
        yield batch.append_column("inside", pa.array(inside, pa.int64()))


def numbered(nodes: DataFrame) -> DataFrame:
    """Adds ``at``, the place of a row in its group, and ``total``, the group's size.

    ``nodes`` (``group, order, hash`` and more) must be stored: the range sampling
    reads it once more. Null orders come first, equal ones follow their hash.
    """
    order = ["group", "order", "hash", "tie"]  # repeated rows need not stay in one range
    rows = nodes.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.withColumn("part", F.spark_partition_id())
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema) + ", inside long"
    rows = store(rows.mapInArrow(_number, schema), "merkle-numbers")
    # a task holds a range, so there are no more of these than tasks and groups together
    parts = rows.groupBy("group", "part").agg((F.max("inside") + 1).alias("n"))
    whole = Window.partitionBy("group")
    before = whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        F.col("group").alias("_g"), F.col("part").alias("_p"),
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"), F.sum("n").over(whole).alias("total"),
    )
    same = F.col("group").eqNullSafe(F.col("_g")) & (F.col("part") == F.col("_p"))
    return rows.join(parts, same).withColumn("at", F.col("base") + F.col("inside")).drop("_g", "_p", "base", "inside", "part", "tie")


def levels_of(hashes: list[str], height: int) -> list[list[str]]:
    """The levels of an aligned block, leaves first; at most ``height`` of them above the leaves."""
    out = [hashes]
    for _ in range(height):
        row = out[-1]
        out.append([digest("".join(row[k:k + FANOUT])) for k in range(0, len(row), FANOUT)])
    return out


def steps_of(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """``(before, after)`` of the leaf ``at`` for every level but the last."""
    out = []
    for row in levels[:-1]:
        first = at - at % FANOUT
        out.append(("".join(row[first:at]), "".join(row[at + 1:first + FANOUT])))
        at //= FANOUT
    return out


def height_in_block(total: int, levels: int = LEVELS) -> int:
    """Levels of a group's tree that lie inside blocks of ``FANOUT ** levels`` leaves."""
    height = 0
    while height < levels and FANOUT**height < total:
        height += 1
    return height


def _blocks(levels: int, fields: list[str]):
    """Rows of consecutive leaves to one row per block, from a task's sorted rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, key, schema = [], None, None

        def flush():
            group, block, total = key
            root = levels_of([r["hash"] for r in held], height_in_block(total, levels))[-1][0]
            columns = {"group": [group], "block": [block], "total": [total], "root": [root]}
            columns |= {f: [[r[f] for r in held]] for f in fields}
            return pa.RecordBatch.from_pydict(columns, schema=schema)

        for batch in batches:
            if schema is None:
                types = {f.name: f.type for f in batch.schema}
                schema = pa.schema(
                    [("group", types["group"]), ("block", pa.int64()), ("total", pa.int64()), ("root", pa.string())]
                    + [(f, pa.list_(types[f])) for f in fields]
                )
            for row in batch.to_pylist():
                here = (row["group"], row["block"], row["total"])
                if here != key and held:
                    yield flush()
                    held = []
                key = here
                held.append(row)
        if held:
            yield flush()

    return run


def blocks(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One stored row per aligned block: ``group, block, total, root`` and the leaves' columns as arrays.

    ``nodes`` has ``group, order, hash`` and any further columns.
    """
    fields = [c for c in nodes.columns if c != "group"]
    rows = numbered(nodes).withColumn("block", F.floor(F.col("at") / FANOUT**levels))
    rows = rows.repartition("group", "block").sortWithinPartitions("group", "block", "at")
    types = {f.name: f.dataType.simpleString() for f in nodes.schema}
    schema = f"`group` {types['group']}, block long, total long, root string, "
    schema += ", ".join(f"`{f}` array<{types[f]}>" for f in fields)
    return store(rows.select("group", "block", "total", *fields).mapInArrow(_blocks(levels, fields), schema), "merkle-blocks")


# ── the butterfly ───────────────────────────────────────────────────────────

def exchange(lines: DataFrame, round_: int, count: Column) -> DataFrame:
    """One round: every line gets the roots of its ``FANOUT`` partners and hashes their parent.

    ``lines``: ``group, block, lines, root, path``; ``lines`` is the number of blocks
    in the group. Lines of groups that are done go through unchanged.
    """
    span = FANOUT**round_
    node, low = F.floor(F.col("block") / span), F.col("block") % span
    held = F.least(F.lit(span).cast("long"), count - node * span)  # blocks in this line's subtree
    # the last subtree answers on the lines it does not have
    sent = lines.withColumn("_low", F.explode(F.sequence(low, F.lit(span - 1).cast("long"), held)))
    sent = sent.withColumn("_node", node).withColumn("_own", F.col("_low") == low)
    group = Window.partitionBy("group", F.floor(F.col("_node") / FANOUT), "_low")
    met = F.array_sort(F.collect_list(F.struct("_node", "root")).over(group))
    swapped = sent.withColumn("_met", met).where("_own")

    def joined(rule) -> Column:
        return F.array_join(F.transform(F.filter("_met", rule), lambda m: m["root"]), "")

    step = F.struct(
        joined(lambda m: m["_node"] < F.col("_node")).alias("before"), joined(lambda m: m["_node"] > F.col("_node")).alias("after")
    )
    parent = F.sha2(joined(lambda m: F.lit(True)), 256)
    going = count > span  # more than one node on this level
    return swapped.select(
        "group", "block", "lines",
        F.when(going, parent).otherwise(F.col("root")).alias("root"),
        F.when(going, F.concat("path", F.array(step))).otherwise(F.col("path")).alias("path"),
    )


def butterfly(made: DataFrame) -> DataFrame:
    """``group, block, root, path``: the group's root and the steps above the block, for every block."""
    sizes = made.groupBy("group").agg(F.count("*").alias("lines")).withColumnRenamed("group", "_g")
    lines = made.select("group", "block", "root").join(sizes, F.col("group").eqNullSafe(F.col("_g"))).drop("_g")
    lines = lines.withColumn("path", F.expr(f"cast(array() as array<{STEP}>)"))
    most = sizes.agg(F.max("lines")).first()[0] or 0  # one number
    round_ = 0
    while FANOUT**round_ < most:
        lines = exchange(lines, round_, F.col("lines"))
        round_ += 1
    return store(lines.drop("lines"), "merkle-lines")


# ── results per leaf ────────────────────────────────────────────────────────

def fold(node: str, steps: list[tuple[str, str]]) -> str:
    for before, after in steps:
        node = digest(before + node + after)
    return node


def _pairs(path) -> list[tuple[str, str]]:
    return [(s["before"], s["after"]) for s in path]


def _paths(levels: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                inner, upper = levels_of(row["hash"], height_in_block(row["total"], levels)), _pairs(row["path"])
                paths = [[{"before": b, "after": a} for b, a in steps_of(inner, k) + upper] for k in range(len(row["hash"]))]
                yield pa.RecordBatch.from_pydict({
                    "order": row["order"], "root": [row["root"]] * len(paths),
                    "path": pa.array(paths, pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
                }, schema=pa.schema([
                    ("order", batch.schema.field("order").type.value_type), ("root", pa.string()),
                    ("path", pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))),
                ]))

    return run


def paths(nodes: DataFrame, levels: int = LEVELS) -> DataFrame:
    """``order, root, path`` of every node of one tree."""
    made = blocks(nodes.withColumn("group", F.lit(0)).select("group", "order", "hash"), levels)
    lines = butterfly(made).select("block", F.col("root").alias("top"), "path")
    rows = made.join(lines, "block").select("order", "hash", "total", F.col("top").alias("root"), "path")
    kind = dict(nodes.dtypes)["order"]
    return rows.mapInArrow(_paths(levels), f"`order` {kind}, root string, path array<{STEP}>")


def _proofs(levels: int, group_type: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                inner = levels_of(row["hash"], height_in_block(row["total"], levels))
                upper = _pairs(row["path"]) + _pairs(row["top_path"])
                above = "".join(b + a for b, a in upper)
                out = {"proof_sha256": [], "folded_root": []}
                for k, (own, changed) in enumerate(zip(row["hash"], row["changed"])):
                    steps = steps_of(inner, k)
                    out["proof_sha256"].append(digest("".join(b + a for b, a in steps) + above))
                    out["folded_root"].append(fold(changed or own, steps + upper))
                n = len(row["hash"])
                yield pa.RecordBatch.from_arrays([
                    pa.array([row["group"]] * n, group_type), pa.array(row["order"], pa.int64()), pa.array(row["hash"]),
                    pa.array([row["subroot"]] * n), pa.array([row["root"]] * n), pa.array(out["proof_sha256"]),
                    pa.array(out["folded_root"]),
                ], ["lang", "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

    return run


def tampered(id_col: str = "doc_id") -> Column:
    """True for the rows whose text the check of the manifest changes: 3 divides the checksum of the id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 0, F.lit(False))


def manifest(
    docs: DataFrame, changed: Column | None = None, id_col: str = "doc_id", group_col: str = "lang",
    text_col: str = "text", other_cols: tuple[str, ...] = ("source", "lang", "n_chars"), levels: int = LEVELS,
) -> DataFrame:
    """One row per document: ``lang, doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    A leaf is the hash of the id, ``other_cols`` and the text, in that order. Rows
    with one value of ``group_col`` form a tree in ascending order of the id, and the
    trees' roots, in the order of the value, form the upper one. ``proof_sha256`` is the hash of
    all siblings from the leaf up; ``folded_root`` is what they give with the leaf of the text
    that is there now: rows where ``changed`` holds have A-Z of their text
    lower-cased since the manifest was made. ``verified`` tells whether that is the root.

    Null groups are one group and come first, as null ids do. Rows with equal ids
    follow one another in the order of their leaves; repeated rows are leaves of
    their own. A null text is not an empty one. An empty table gives no rows. Other
    columns are ignored, whatever their names.
    """
    text = F.col(text_col)
    before = [F.col(id_col), *map(F.col, other_cols)]
    changed = F.lit(False) if changed is None else F.coalesce(changed, F.lit(False))
    nodes = store(docs.select(
        F.col(group_col).alias("group"), F.col(id_col).cast("long").alias("order"), leaf([*before, text]).alias("hash"),
        F.when(changed, leaf([*before, ascii_lower(text)])).alias("changed"),
    ), "merkle-leaves")
    made = blocks(nodes, levels)
    lines = butterfly(made)
    # every block of a group holds its root; the first one speaks for it
    tops = paths(store(lines.where("block = 0").select(F.col("group").alias("order"), F.col("root").alias("hash")), "merkle-subroots"))
    tops = tops.select(F.col("order").alias("_t"), F.col("root").alias("top"), F.col("path").alias("top_path"))
    lines = lines.select(F.col("group").alias("_g"), F.col("block").alias("_b"), F.col("root").alias("subroot"), "path")
    rows = (
        made.drop("root")
        .join(lines, F.col("group").eqNullSafe(F.col("_g")) & (F.col("block") == F.col("_b")))
        .join(tops, F.col("group").eqNullSafe(F.col("_t")))
        .select("group", "order", "hash", "changed", "total", "subroot", "path", F.col("top").alias("root"), "top_path")
    )
    kind = nodes.schema["group"].dataType
    schema = (
        f"lang {kind.simpleString()}, doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string"
    )
    out = rows.mapInArrow(_proofs(levels, to_arrow_type(kind)), schema)
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
