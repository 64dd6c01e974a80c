"""Cheapest repair of conversations by a suffix-shared automaton.

What a repair costs depends only on a conversation's signature: one letter per row
for its role and fault. Distinct signatures, read from the end and put in order, are
swept with a stack that holds one node per suffix, so a suffix that many signatures
share is one node, met once. Each node is given, for every state of the role grammar, the
least cost of mending the rest and the first letter of the best audit of the rest; the
rest of that audit is its successor's, so it is shared as well. An audit is then
read off from the first node on.

Within a node an edit of every kind leads to one grammar state only, so candidates
of equal cost differ in their first letter, and the least letter gives the least audit.

Signatures are made and audits applied by sorted streams: a task sees the rows of its
conversations in order and holds one letter for a row. The hash of a
repaired conversation is one SHA-256 over its text in order, so by definition a
conversation, however long, is read by one task; its texts are never held together.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

SPACE = "\\x20\\x09-\\x0D"

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
TRUNCATED_COST = 3

# Grammar of role initials, (s?(ua)+)?: states and where a letter leads.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
AFTER = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ACCEPTING = (START, ASSISTANT)
# the turn that an insertion or a new role gives in a state
NEXT_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
NEXT_STATE = [AFTER[g][NEXT_ROLE[g][0]] for g in range(STATES)]

# Letters of a signature: a row that must go, else the role's initial (o: any other), as a capital when truncated.
GONE, OTHER = "x", "o"


# ── the automaton ───────────────────────────────────────────────────────────

class Sweep:
    """Nodes of the suffixes of one signature; shared with the signature before."""

    def __init__(self):
        self.reversed = ""
        self.costs = array("q")  # per node and state: cost of mending the suffix
        self.letters = bytearray()  # and the first letter of its best audit, 0 at the end
        self.built = 0
        self._node([(0, 0) if g in ACCEPTING else None for g in range(STATES)])

    def _node(self, candidates: list) -> None:
        """Add a node from the best edits that use up the row, inserting where that is cheaper."""
        insert, cost = ord(INSERT), COST[INSERT]
        far = 1 << 60
        best = [c or (far, 0) for c in candidates]
        # an insertion leads to the user or the assistant state, and two in a row never return with gain
        turned = {USER: min(best[USER], (best[ASSISTANT][0] + cost, insert)), ASSISTANT: min(best[ASSISTANT], (best[USER][0] + cost, insert))}
        for g in range(STATES):
            c, letter = min(best[g], (turned[NEXT_STATE[g]][0] + cost, insert))
            self.costs.append(c)
            self.letters.append(letter)
        self.built += 1

    def _extend(self, symbol: str) -> None:
        rest = self.costs[-STATES:]
        candidates = []
        for g in range(STATES):
            options = [(COST[DELETE] + rest[g], ord(DELETE))]
            if symbol != GONE:
                extra = TRUNCATED_COST if symbol.isupper() else 0
                after = AFTER[g].get(symbol.lower())
                if after is not None:
                    options.append((COST[KEEP] + extra + rest[after], ord(KEEP)))
                options.append((COST[REROLE] + extra + rest[NEXT_STATE[g]], ord(REROLE)))
            candidates.append(min(options))
        self._node(candidates)

    def audit(self, signature: str) -> tuple[int, str]:
        """Least cost and the ASCII-least of the cheapest audits. Signatures may come in any order."""
        word, kept = signature[::-1], 0
        limit = min(len(word), len(self.reversed))
        if word[:limit] == self.reversed[:limit]:
            kept = limit
        else:
            low, high = 0, limit  # length of the common part
            while low < high:
                middle = (low + high + 1) // 2
                if word[:middle] == self.reversed[:middle]:
                    low = middle
                else:
                    high = middle - 1
            kept = low
        del self.costs[STATES * (kept + 1):]
        del self.letters[STATES * (kept + 1):]
        for symbol in word[kept:]:
            self._extend(symbol)
        self.reversed = word
        out, node, state = bytearray(), len(word), START
        while letter := self.letters[STATES * node + state]:
            out.append(letter)
            if letter == ord(INSERT):
                state = NEXT_STATE[state]
                continue
            if letter == ord(KEEP):
                state = AFTER[state][word[node - 1].lower()]
            elif letter == ord(REROLE):
                state = NEXT_STATE[state]
            node -= 1
        return self.costs[STATES * len(word) + START], out.decode()


def _audits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sweep = Sweep()
    for batch in batches:
        words = batch["backwards"].to_pylist()
        found = [sweep.audit(w[::-1]) for w in words]
        yield pa.RecordBatch.from_pydict({
            "signature": pa.array([w[::-1] for w in words], pa.string()),
            "cost": pa.array([c for c, _ in found], pa.int64()), "audit": pa.array([a for _, a in found], pa.string()),
        })


def audits(signatures: DataFrame) -> DataFrame:
    """``signature, cost, audit`` of every different signature, each suffix worked out once per range."""
    words = signatures.select(F.reverse("signature").alias("backwards")).distinct()
    ranges = store(words, "repair-signatures").repartitionByRange("backwards").sortWithinPartitions("backwards")
    return store(ranges.mapInArrow(_audits, "signature string, cost long, audit string"), "repair-audits")


# ── signatures ──────────────────────────────────────────────────────────────

FOUND = "conv string, signature string, turns_missing long, blank long, duplicate long, truncated long, illegal long"
LEGAL = {"su", "ua", "au"}


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per conversation from a task's sorted rows."""
    names = [c.split()[0] for c in FOUND.split(", ")]
    out, held = [], None

    def close():
        letters, low, high, distinct = held["letters"], held["low"], held["high"], held["distinct"]
        gaps = 0 if low is None else high - low + 1 - distinct
        out.append((
            held["conv"], letters.decode(), gaps, held["blank"], held["duplicate"], held["truncated"], held["illegal"],
        ))

    def flush():
        rows = pa.RecordBatch.from_arrays(
            [pa.array(c, pa.string() if k < 2 else pa.int64()) for k, c in enumerate(zip(*out))], names
        )
        out.clear()
        return rows

    for batch in batches:
        columns = [batch[c].to_pylist() for c in ("conv", "lost", "turn", "digest", "first_turn", "initial", "blank", "truncated")]
        for conv, lost, turn, digest, first_turn, initial, blank, truncated in zip(*columns):
            if held is None or conv != held["conv"]:
                if held is not None:
                    close()
                held = {"conv": conv, "letters": bytearray(), "low": None, "high": None, "distinct": 0, "blank": 0,
                        "duplicate": 0, "truncated": 0, "illegal": 0, "initial": None, "row": None}
            if lost:
                continue
            if turn is not None and turn != held["high"]:  # rows come in the order of turns
                held["low"] = turn if held["low"] is None else held["low"]
                held["high"] = turn
                held["distinct"] += 1
            row = (turn, digest)
            # the same role and text in an earlier turn, or in this turn just before
            again = turn != first_turn or row == held["row"]
            if held["row"] is not None and held["initial"] + initial not in LEGAL:
                held["illegal"] += 1
            held["row"], held["initial"] = row, initial
            letter = initial if initial in ("s", "u", "a") else OTHER
            if blank:
                held["blank"] += 1
                letter = GONE
            elif again:
                held["duplicate"] += 1
                letter = GONE
            elif truncated:
                held["truncated"] += 1
                letter = letter.upper()
            held["letters"] += letter.encode()
        if len(out) >= 4096:
            yield flush()
    if held is not None:
        close()
    if out:
        yield flush()


def _seen_first(rows: DataFrame) -> DataFrame:
    """Adds ``first_turn``, the least turn (null first) of the rows with the same role and text."""
    # groups of one need no look-up, so only real copies are joined
    place = F.struct(F.col("turn").isNotNull().alias("later"), "turn")
    copies = (
        rows.where("not lost").groupBy("conv", "digest").agg(F.min(place).alias("first"), F.count("*").alias("n")).where("n > 1")
        .select(F.col("conv").alias("_c"), F.col("digest").alias("_d"), F.col("first.turn").alias("_turn"))
    )
    same = F.col("conv").eqNullSafe(F.col("_c")) & (F.col("digest") == F.col("_d"))
    joined = rows.join(copies, same, "left")
    return joined.withColumn("first_turn", F.when(F.col("_d").isNull(), F.col("turn")).otherwise(F.col("_turn"))).drop("_c", "_d", "_turn")


ORDER = ["conv", "turn", "role", "digest", "copy"]


def prepare(turns: DataFrame) -> DataFrame:
    """Adds the letters' ingredients to rows with ``conv, turn, role, text, copy, lost``."""
    text = F.col("text")
    last = F.regexp_extract(text, f"([^{SPACE}])[{SPACE}]*\\z", 1)
    return turns.select(
        "conv", "turn", "role", "text", "copy", "lost",
        F.substring("role", 1, 1).alias("initial"),
        F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", text), 256).alias("digest"),
        (~text.rlike(f"[^{SPACE}]")).alias("blank"),
        (~last.isin(".", "!", "?")).alias("truncated"),
    )


# ── repaired conversations ──────────────────────────────────────────────────

DONE = FOUND.replace("turns_missing", "gaps") + ", cost long, audit string, repaired_sha256 string"


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A conversation's row with its audit, then its rows in order, to the hash of what the audit makes of them."""
    names = [c.split()[0] for c in DONE.split(", ")]
    out, head = [], None

    def put(line: str):
        nonlocal first
        if not first:
            sha.update(b"\n")
        sha.update(line.encode())
        first = False

    def insertions():
        nonlocal at, state
        while audit[at:at + 1] == INSERT:
            put(NEXT_ROLE[state] + ":")
            state, at = NEXT_STATE[state], at + 1

    def close():
        insertions()
        out.append((*head, sha.hexdigest()))

    def flush():
        kinds = [pa.string() if c.split()[1] == "string" else pa.int64() for c in DONE.split(", ")]
        rows = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), kinds)], names)
        out.clear()
        return rows

    for batch in batches:
        for row in batch.to_pylist():
            if row["kind"] == 0:
                if head is not None:
                    close()
                head, audit = [row[c] for c in names[:-1]], row["audit"]
                sha, first, at, state = hashlib.sha256(), True, 0, START
                continue
            insertions()
            edit, at = audit[at], at + 1
            if edit == KEEP:
                put(f"{row['role']}:{row['text']}")
                state = AFTER[state][row["role"][0]]
            elif edit == REROLE:
                put(f"{NEXT_ROLE[state]}:{row['text']}")
                state = NEXT_STATE[state]
        if len(out) >= 4096:
            yield flush()
    if head is not None:
        close()
    if out:
        yield flush()


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation: its faults, the cost and audit of the cheapest repair, and the hash of the result.

    ``turns`` has ``conv`` (string), ``turn`` (long), ``role``, ``text``, ``copy`` (int, tells
    repeats of a row apart) and ``lost`` (boolean: the row is not there, but its conversation is).
    Returns ``conv, signature, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``.

    Rows are taken by turn, null turns first; within a turn by role and then by the hash of
    role and text, so that equal rows follow one another and other layouts change
    nothing. A null role or text counts as one space, a null ``conv`` is one
    conversation. Empty and white texts are blank. A conversation of lost rows alone has zeros, an
    empty audit and the hash of nothing. An empty table gives no rows; other columns are ignored.
    """
    blank = F.lit(" ")
    rows = store(prepare(turns.select(
        F.col("conv").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", blank).alias("role"), F.coalesce("text", blank).alias("text"),
        F.coalesce(F.col("copy").cast("int"), F.lit(0)).alias("copy"), F.coalesce("lost", F.lit(False)).alias("lost"),
    )), "repair-rows")
    small = _seen_first(rows.drop("text"))
    ordered = small.repartition("conv").sortWithinPartitions(*ORDER)
    found = store(
        ordered.select("conv", "lost", "turn", "digest", "first_turn", "initial", "blank", "truncated").mapInArrow(_signatures, FOUND),
        "repair-found",
    )
    heads = found.join(audits(found), "signature").withColumnRenamed("turns_missing", "gaps")
    fields = [c.split()[0] for c in DONE.split(", ")][:-1]
    types = dict(c.split() for c in DONE.split(", "))
    lines = rows.where("not lost")
    both = heads.select(F.lit(0).alias("kind"), *fields, *[F.lit(None).cast(lines.schema[c].dataType).alias(c) for c in ("turn", "role", "text", "digest", "copy")])
    both = both.unionByName(lines.select(
        F.lit(1).alias("kind"), "conv", *[F.lit(None).cast(types[c]).alias(c) for c in fields if c != "conv"],
        "turn", "role", "text", "digest", "copy",
    ))
    stream = both.repartition("conv").sortWithinPartitions("conv", "kind", *ORDER[1:])
    return stream.select("kind", *fields, "role", "text").mapInArrow(_repaired, DONE)


# ── known damage ────────────────────────────────────────────────────────────

DAMAGES = 20


def damage(conversations: DataFrame) -> DataFrame:
    """``conversations`` (``conv_id, turn, role, text``) with a fault in one of four rows, for :func:`repair`.

    The checksum of ``conv_id:turn`` (null: one space) chooses: drop the row, empty its text,
    take ``.``, ``!`` and ``?`` from it, repeat it, or make its role ``user``.
    """
    space = F.lit(" ")
    key = F.concat(*[
        F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space)
    ])
    kind = F.crc32(key.cast("binary")) % DAMAGES
    role, text = F.coalesce("role", space), F.coalesce("text", space)

    def when(k: int, changed: Column, plain: Column) -> Column:
        return F.when(F.col("_kind") == k, changed).otherwise(plain)

    rows = conversations.select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("long").alias("turn"),
        role.alias("role"), text.alias("text"), kind.alias("_kind"),
    )
    return rows.select(
        "conv", "turn", when(4, F.lit("user"), F.col("role")).alias("role"),
        F.when(F.col("_kind") == 1, "").when(F.col("_kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text")).alias("text"),
        F.explode(when(3, F.array(F.lit(0), F.lit(1)), F.array(F.lit(0)))).alias("copy"),
        (F.col("_kind") == 0).alias("lost"),
    )
