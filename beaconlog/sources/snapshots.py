"""Stored tables that change together: immutable folders and a numbered record of which of them count.

Spark writes every change to a folder of its own, which nobody reads yet. A commit is
one small file with the next number, created by a rename that fails when the
number is taken. It names, for every table below one root, the day folders that
hold its rows now. A reader looks at the newest record first and hands Spark exactly those folders,
so it sees the tables of one commit, whatever is written meanwhile, and a writer that dies
leaves nothing but an unused folder.

A part is one day folder of one change with the keys (batches, spans, cycles) it
holds. Writing a key again replaces it: parts with no other keys are left out of the next record,
the other keys of a merged part are copied. :func:`compact` merges parts of like size,
``fan_in`` at a time, so a day holds a number of parts that grows with the logarithm of its
size, not with the number of batches; :func:`expire` deletes what no kept record names.

The driver handles names and sizes of parts, never rows.
"""

from __future__ import annotations

import json
import math
import time
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field, replace

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEY = "part_key"
RECORDS = "commits"
FAN_IN = 8
SMALLEST_BYTES = 1 << 20
FILE_BYTES = 256 << 20
WRITE, MERGE = "write", "merge"


class CommitConflict(RuntimeError):
    """Another writer took the number of this commit."""


@dataclass(frozen=True)
class Part:
    path: str  # below the table's folder
    day: str  # "" in a table without days
    keys: tuple[str, ...]
    files: int
    bytes: int


@dataclass
class Manifest:
    version: int = 0
    kind: str = WRITE
    tables: dict[str, list[Part]] = field(default_factory=dict)
    added: dict[str, list[str]] = field(default_factory=dict)  # paths that this commit brought

    def dump(self) -> str:
        return json.dumps(asdict(self), separators=(",", ":"))

    @staticmethod
    def load(text: str) -> Manifest:
        raw = json.loads(text)
        tables = {t: [Part(**{**p, "keys": tuple(p["keys"])}) for p in parts] for t, parts in raw["tables"].items()}
        return Manifest(raw["version"], raw["kind"], tables, raw["added"])


def place(path: str, name: str = "") -> tuple[str, str]:
    """Root and table of a folder: tables side by side share the record of their common parent."""
    root, table = path.rstrip("/").rsplit("/", 1)
    return root, f"{table}/{name}" if name else table


# ── files ───────────────────────────────────────────────────────────────────

def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()), folder


def _names(spark: SparkSession, path: str) -> list:
    fs, folder = _fs(spark, path)
    return list(fs.listStatus(folder)) if fs.exists(folder) else []


def _record(version: int) -> str:
    return f"{version:020d}.json"


def _read_text(spark: SparkSession, path: str) -> str:
    fs, file = _fs(spark, path)
    stream = fs.open(file)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def _create_once(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """The file appears whole or not at all, and only where there is none."""
    jvm = spark._jvm
    hidden = f"{folder}/.{uuid.uuid4().hex}"
    fs, draft = _fs(spark, hidden)
    out = fs.create(draft, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(draft).toUri(), spark._jsc.hadoopConfiguration())
    never = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    never[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
    try:
        context.rename(fs.makeQualified(draft), fs.makeQualified(jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")), never)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "AlreadyExists" in error.java_exception.getClass().getName():
            raise CommitConflict(name) from None
        raise


def versions(spark: SparkSession, root: str) -> list[int]:
    names = [s.getPath().getName() for s in _names(spark, f"{root}/{RECORDS}")]
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and not n.startswith("."))


def manifest(spark: SparkSession, root: str, version: int | None = None) -> Manifest:
    """The record with the number ``version``, by default the newest; an empty one before the first commit."""
    if version is None:
        known = versions(spark, root)
        if not known:
            return Manifest()
        version = known[-1]
    return Manifest() if version == 0 else Manifest.load(_read_text(spark, f"{root}/{RECORDS}/{_record(version)}"))


# ── reading ─────────────────────────────────────────────────────────────────

def _pin(root: str) -> str:
    return f"beaconlog.snapshot.{root}"


@contextmanager
def pinned(spark: SparkSession, root: str, version: int | None = None) -> Iterator[int]:
    """Inside the block all tables below ``root`` are read as of one commit (by default the newest one now)."""
    held = manifest(spark, root, version).version
    outer = spark.conf.get(_pin(root), None)
    spark.conf.set(_pin(root), str(held))
    try:
        yield held
    finally:
        spark.conf.unset(_pin(root)) if outer is None else spark.conf.set(_pin(root), outer)


def _frame(spark: SparkSession, root: str, table: str, parts: Sequence[str], schema: str, day: str | None) -> DataFrame:
    columns = f"{schema}, {KEY} string, c string" + (f", {day if ' ' in day else day + ' date'}" if day else "")
    base = f"{root}/{table}"
    if not parts:
        return spark.createDataFrame([], columns).drop("c")
    return spark.read.schema(columns).option("basePath", base).parquet(*[f"{base}/{p}" for p in parts]).drop("c")


def read(
    spark: SparkSession, root: str, table: str, schema: str, day: str | None = None,
    only: Callable[[Part], bool] | None = None, newest: bool = False,
) -> DataFrame:
    """A table as of the pinned or newest commit, with its key and day; no rows before the first one.

    ``only`` chooses parts, ``newest`` overrides a pin. The day is a partition column, so a filter on it prunes folders;
    tables that are not cut by days name another column and its type.
    """
    pin = None if newest else spark.conf.get(_pin(root), None)
    found = manifest(spark, root, None if pin is None else int(pin))
    parts = [p.path for p in found.tables.get(table, []) if only is None or only(p)]
    return _frame(spark, root, table, parts, schema, day)


def read_paths(spark: SparkSession, root: str, table: str, paths: Sequence[str], schema: str, day: str | None = None) -> DataFrame:
    """Rows of certain parts, as a commit's ``added`` names them."""
    return _frame(spark, root, table, paths, schema, day)


# ── writing ─────────────────────────────────────────────────────────────────

@dataclass
class Change:
    """New rows of a table that replace all rows with ``keys``.

    ``keys``: the same for every day, or per day (only those days are then replaced).
    ``rows`` hold their key in the column ``part_key`` and their day in ``day``.
    """

    table: str
    rows: DataFrame
    keys: set[str] | dict[str, set[str]]
    day: str | None = None
    everything: bool = False  # replace all rows of the table
    codec: str | None = None  # of its files, by default the session's
    parts: list[Part] | None = None  # where :func:`stage` has written the rows

    def replaced(self, part: Part) -> set[str]:
        if self.everything:
            return set(part.keys)
        keys = self.keys.get(part.day, set()) if isinstance(self.keys, dict) else self.keys
        return keys & set(part.keys)

    def of(self, day: str) -> tuple[str, ...]:
        return tuple(sorted(self.keys.get(day, ()) if isinstance(self.keys, dict) else self.keys))


def _stage(
    root: str, table: str, rows: DataFrame, day: str | None, keys: Callable[[str], Iterable[str]], codec: str | None = None,
) -> list[Part]:
    """Write rows to a folder that no record names yet; its parts."""
    spark, name = rows.sparkSession, f"c={uuid.uuid4().hex}"
    writer = rows.write.mode("errorifexists")
    if codec:
        writer = writer.option("compression", codec)
    if day:
        writer = writer.partitionBy(day)
    writer.parquet(f"{root}/{table}/{name}")
    folders = [(name, "")]
    if day:
        found = [s.getPath().getName() for s in _names(spark, f"{root}/{table}/{name}") if s.isDirectory()]
        folders = [(f"{name}/{f}", f.split("=", 1)[1]) for f in found if f.startswith(f"{day}=")]
    parts = []
    for path, value in folders:
        files = [s for s in _names(spark, f"{root}/{table}/{path}") if s.getPath().getName().endswith(".parquet")]
        if files:
            parts.append(Part(path, value, tuple(sorted(keys(value))), len(files), sum(s.getLen() for s in files)))
    return parts


def stage(spark: SparkSession, root: str, change: Change) -> Change:
    """Write the rows of a change before its commit, which other tables of that commit may be made from (see :func:`read_paths`)."""
    return replace(change, parts=_stage(root, change.table, change.rows, change.day, change.of, change.codec))


def commit(spark: SparkSession, root: str, changes: Sequence[Change], attempts: int = 20) -> int:
    """Write the rows of all changes and make them count together; the commit's number.

    Rows are written once. If another writer takes the number, the change is applied to what
    that one left and tried again. Until the record exists, nothing has changed for any reader.
    """
    staged = [(c if c.parts is not None else stage(spark, root, c)).parts for c in changes]
    _names_folder(spark, root)
    for _ in range(attempts):
        base = manifest(spark, root)
        tables, added = dict(base.tables), {}
        for change, parts in zip(changes, staged):
            kept = []
            for part in tables.get(change.table, []):
                gone = change.replaced(part)
                rest = set(part.keys) - gone
                if not gone:
                    kept.append(part)
                elif rest:  # a merged part: its other keys are copied
                    kept += _copy(spark, root, change, part, rest)
            tables[change.table] = kept + parts
            added[change.table] = [p.path for p in parts]
        try:
            _publish(spark, root, Manifest(base.version + 1, WRITE, tables, added))
        except CommitConflict:
            continue
        return base.version + 1
    raise CommitConflict(f"{root}: no free number after {attempts} attempts")


def _copy(spark: SparkSession, root: str, change: Change, part: Part, rest: set[str]) -> list[Part]:
    rows = spark.read.parquet(f"{root}/{change.table}/{part.path}").filter(F.col(KEY).isin(sorted(rest)))
    if change.day:
        rows = rows.withColumn(change.day, F.lit(part.day))
    return _stage(root, change.table, rows, change.day, lambda _: rest, change.codec)


def _names_folder(spark: SparkSession, root: str) -> None:
    fs, folder = _fs(spark, f"{root}/{RECORDS}")
    fs.mkdirs(folder)


def _publish(spark: SparkSession, root: str, new: Manifest) -> None:
    _create_once(spark, f"{root}/{RECORDS}", _record(new.version), new.dump())


# ── upkeep ──────────────────────────────────────────────────────────────────

def mergeable(parts: Sequence[Part], fan_in: int = FAN_IN, smallest: int = SMALLEST_BYTES) -> list[list[Part]]:
    """Groups of at least ``fan_in`` parts of one day and one size tier; tiers are powers of ``fan_in``."""
    tiers: dict[tuple[str, int], list[Part]] = {}
    for part in parts:
        tier = max(0, math.ceil(math.log(max(part.bytes, 1) / smallest, fan_in)))
        tiers.setdefault((part.day, tier), []).append(part)
    return [group for group in tiers.values() if len(group) >= fan_in]


def compact(
    spark: SparkSession, root: str, days: dict[str, str | None], fan_in: int = FAN_IN, smallest: int = SMALLEST_BYTES,
    attempts: int = 5, codec: str | None = None,
) -> int:
    """Merge small parts of the tables named in ``days`` (table: day column); how many parts were merged.

    One pass over a table writes all its merges. What a writer replaces meanwhile is
    merged the next time. Readers of older commits keep their files until they expire.
    """
    merged = 0
    for table, day in days.items():
        for _ in range(attempts):
            groups = mergeable(manifest(spark, root).tables.get(table, []), fan_in, smallest)
            if not groups:
                break
            gone = {p.path for g in groups for p in g}
            keys: dict[str, set[str]] = {}
            for group in groups:
                for part in group:
                    keys.setdefault(part.day, set()).update(part.keys)
            rows = spark.read.option("basePath", f"{root}/{table}").parquet(*[f"{root}/{table}/{p}" for p in sorted(gone)]).drop("c")
            files = max(1, math.ceil(sum(p.bytes for g in groups for p in g) / FILE_BYTES))
            rows = rows.hint("rebalance", F.col(day)) if day else rows.repartition(files)
            parts = _stage(root, table, rows, day, lambda value: keys[value], codec)
            base = manifest(spark, root)
            there = base.tables.get(table, [])
            if not gone <= {p.path for p in there}:
                continue
            tables = {**base.tables, table: [p for p in there if p.path not in gone] + parts}
            try:
                _publish(spark, root, Manifest(base.version + 1, MERGE, tables, {table: [p.path for p in parts]}))
            except CommitConflict:
                continue
            merged += len(gone)
            break
    return merged


def expire(spark: SparkSession, root: str, keep: int = 100, min_age_seconds: float = 86400.0) -> int:
    """Delete all records but the newest ``keep``, and folders that none of these names; how many folders.

    Folders younger than ``min_age_seconds`` stay: a writer may be about to commit them. Take it longer
    than any job that reads or writes.
    """
    known = versions(spark, root)
    kept = [manifest(spark, root, v) for v in known[-keep:]]
    used = {(t, p.path.split("/")[0]) for m in kept for t, parts in m.tables.items() for p in parts}
    tables = {t for m in kept for t in m.tables}
    for version in known[:-keep]:
        fs, file = _fs(spark, f"{root}/{RECORDS}/{_record(version)}")
        fs.delete(file, False)
    limit, deleted = (time.time() - min_age_seconds) * 1000, 0
    for table in tables:
        for status in _names(spark, f"{root}/{table}"):
            name = status.getPath().getName()
            if name.startswith("c=") and (table, name) not in used and status.getModificationTime() <= limit:
                fs, folder = _fs(spark, f"{root}/{table}/{name}")
                fs.delete(folder, True)
                deleted += 1
    return deleted


def stream_commits(spark: SparkSession, root: str) -> DataFrame:
    """New records as a stream of lines, for :func:`added_by`."""
    _names_folder(spark, root)
    return spark.readStream.schema("value string").text(f"{root}/{RECORDS}")


def added_by(batch: DataFrame, table: str) -> list[str]:
    """Paths of the parts that the commits of a batch brought to a table; merges bring nothing new."""
    shape = "kind string, added map<string, array<string>>"
    found = batch.select(F.from_json("value", shape).alias("m")).filter(F.col("m.kind") == WRITE)
    paths = found.select(F.explode(F.coalesce(F.col("m.added").getItem(table), F.array())).alias("path"))
    return sorted(r.path for r in paths.collect())
