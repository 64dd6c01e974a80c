"""Merkle manifest, conversation repair and language ID: against brute force, held-out rows and odd input."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from beaconlog.llm import language_id, merkle, queries, turn_repair
from beaconlog.llm.common import table


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def ascii_low(text):
    return text and "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


# ── Merkle manifest ─────────────────────────────────────────────────────────

def _tree(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([sha("".join(levels[-1][k:k + 8])) for k in range(0, len(levels[-1]), 8)])
    return levels


def _sides(levels, at):
    out = []
    for row in levels[:-1]:
        first = at - at % 8
        out.append(("".join(row[first:at]), "".join(row[at + 1:first + 8])))
        at //= 8
    return out


def _manifest(rows):
    def leaf(r, text):
        values = [r[0], r[3], r[2], r[4], text]
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    by = {}
    for r in rows:
        by.setdefault(r[2], []).append(((r[0] is not None, r[0] or 0, leaf(r, r[1])), r))
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda x: x[0])
        trees[lang] = _tree([x[0][2] for x in by[lang]])
    top = _tree([trees[lang][-1][0] for lang in langs])
    out = []
    for k, lang in enumerate(langs):
        for at, ((_, _, own), r) in enumerate(by[lang]):
            sides = _sides(trees[lang], at) + _sides(top, k)
            node = leaf(r, ascii_low(r[1])) if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 else own
            for before, after in sides:
                node = sha(before + node + after)
            proof = sha("".join(b + a for b, a in sides))
            out.append((lang, r[0], own, trees[lang][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return out


def _rows(n):
    rng = random.Random(n)
    rows = [
        (k, f"Text {k} É", rng.choice(["en"] * 6 + ["de", None, ""]), None if k % 7 == 0 else "s", k % 5) for k in range(n)
    ]
    rows += [(None, "x", "en", "s", 1), (None, None, "en", "s", 1), (5, "dup", "en", "s", 1), (5, "dup", "en", "s", 1)]
    return rows + [(1000 + k, "L", f"L{k:03}", "s", 1) for k in range(12)]


DOCS = "doc_id long, text string, lang string, source string, n_chars long"


# blocks of 8 leaves take two or three rounds with ragged last subtrees, larger ones none
@pytest.mark.parametrize("rows,levels", [(_rows(640), 1), (_rows(70), 3), (_rows(0)[:1], 1)])
def test_manifest(spark, rows, levels):
    docs = spark.createDataFrame(rows, DOCS).repartition(5).withColumns({k: F.lit(1) for k in ("group", "block", "root", "at")})
    got = merkle.manifest(docs, merkle.tampered(), levels=levels).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, _manifest(rows)))


def test_manifest_of_nothing(no_docs):
    assert merkle.manifest(no_docs).count() == 0


@pytest.mark.parametrize("lines", [1, 8, 9, 64, 65, 71, 130])
def test_rounds_send_few_rows(spark, lines):
    """Every line learns its root in whole rounds, and ragged subtrees add fewer rows than there are lines."""
    leaves = [sha(str(k)) for k in range(lines)]
    made = spark.createDataFrame([("g", k, h, []) for k, h in enumerate(leaves)], f"group string, block long, root string, path array<{merkle.STEP}>")
    made = made.withColumn("lines", F.lit(lines).cast("long"))
    tree, round_ = _tree(leaves), 0
    while 8**round_ < lines:
        made, round_ = merkle.exchange(made, round_, F.col("lines")), round_ + 1
    for r in made.collect():
        assert r.root == tree[-1][0]
        assert [tuple(s) for s in r.path] == _sides(tree, r.block)


# ── conversation repair ─────────────────────────────────────────────────────

GRAMMAR = re.compile("(s?(ua)+)?")


def _every_repair(word):
    """Least cost, least audit and the roles given, from all edits with up to two insertions in every gap."""
    best = None
    gaps = [[()], [("I", "u")], [("I", "a")], [("I", "u"), ("I", "a")], [("I", "a"), ("I", "u")]]
    gaps = [[]] + [list(g) for g in gaps[1:]]
    options = []
    for c in word:
        if c == "x":
            options.append([("D", None, 4)])
            continue
        extra = 3 if c.isupper() else 0
        options.append([("D", None, 4), ("K", c.lower(), extra), ("R", "u", 3 + extra), ("R", "a", 3 + extra)])
    for edits in itertools.product(*options):
        for fill in itertools.product(gaps, repeat=len(word) + 1):
            cost, audit, roles = 0, "", ""
            for k in range(len(word) + 1):
                for letter, role in fill[k]:
                    cost, audit, roles = cost + 3, audit + letter, roles + role
                if k < len(word):
                    letter, role, price = edits[k]
                    cost, audit, roles = cost + price, audit + letter, roles + (role or "")
            if GRAMMAR.fullmatch(roles) and (best is None or (cost, audit) < best):
                best = (cost, audit)
    return best


def test_audits_are_the_least():
    letters = "xsuaoSUAO"
    sweep = turn_repair.Sweep()
    for size in range(4):
        for word in itertools.product(letters, repeat=size):
            if size == 3 and zlib.crc32("".join(word).encode()) % 9:
                continue
            assert sweep.audit("".join(word)) == _every_repair("".join(word)), word


def test_suffixes_are_met_once():
    rng = random.Random(1)
    words = sorted({"".join(rng.choices("xuaS", k=rng.randint(0, 7))) for _ in range(500)}, key=lambda w: w[::-1])
    sweep = turn_repair.Sweep()
    for w in words:
        assert sweep.audit(w) == turn_repair.Sweep().audit(w)
    assert sweep.built == len({w[k:] for w in words for k in range(len(w) + 1)} | {""})


def _repair(rows):
    """Per conversation from damaged rows ``(conv, turn, role, text)`` in order."""
    out = {}
    for conv, own in rows.items():
        own = sorted(own, key=lambda r: (r[0] is not None, r[0] or 0, r[1], sha(f"{len(r[1])}:{r[1]}{r[2]}")))
        turns = {r[0] for r in own if r[0] is not None}
        seen, word, faults = set(), "", [0, 0, 0]
        for _, role, text in own:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            kind = 0 if not last else 1 if (role, text) in seen else 2 if last[0] not in ".!?" else None
            seen.add((role, text))
            letter = role[:1] if role[:1] in ("s", "u", "a") else "o"
            if kind is not None:
                faults[kind] += 1
                letter = letter.upper() if kind == 2 else "x"
            word += letter
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
        cost, audit = turn_repair.Sweep().audit(word)
        lines, rest, last = [], list(own), None
        for edit in audit:
            row = None if edit == "I" else rest.pop(0)
            if edit == "D":
                continue
            turned = "assistant" if last == "u" else "user"
            role, text = (turned, "") if edit == "I" else (row[1] if edit == "K" else turned, row[2])
            lines.append(f"{role}:{text}")
            last = role[0]
        assert not rest
        gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
        out[conv] = (gaps, *faults, illegal, cost, audit, sha("\n".join(lines)))
    return out


def test_repair(spark):
    rng = random.Random(5)
    texts = ["Good.", "Cut", "", " \t\n", None, "Why?", "naïve é", "x" * 200_000 + "!"]
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rng.randint(1, 9)):
            place = rng.choice([turn, turn, turn + 1, None])
            rows.append((conv, place, rng.choice(["user", "assistant", "system", "tool", "", None]), rng.choice(texts), "z"))
    rows += [(77, k, ["user", "assistant"][k % 2], f"Turn {k}.", "z") for k in range(3000)]
    rows += rows[:20]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, digest string").withColumn("kind", F.lit(9))
    got = turn_repair.repair(turn_repair.damage(turns.repartition(6))).drop("signature").collect()
    damaged = {}
    for conv, turn, role, text, _ in rows:
        own = damaged.setdefault(conv, [])
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        own += [] if kind == 0 else [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    want = _repair(damaged)
    assert {r.conv and int(r.conv) if r.conv is not None else None: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_repair_of_nothing(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert turn_repair.repair(turn_repair.damage(empty)).count() == 0


def test_conversation_of_lost_rows(spark):
    lost = next(k for k in range(1000) if zlib.crc32(f"{k}:0".encode()) % 20 == 0)
    one = spark.createDataFrame([(lost, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")
    (row,) = turn_repair.repair(turn_repair.damage(one)).drop("conv").collect()
    assert tuple(row) == ("", 0, 0, 0, 0, 0, 0, "", sha(""))


# ── language ID ─────────────────────────────────────────────────────────────

def test_language_of_held_out_rows(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    named = queries.QUERIES["op11_language_id"](spark, sf_dir)
    rows = named.join(docs.select("doc_id", "lang", "text"), "doc_id").where("lang is not null and text is not null").collect()
    held = [r for r in rows if r.held_out]
    assert held and len(rows) > len(held)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)


def test_backoff_goes_to_shorter_grams():
    sums = {(lang, size): 100 for lang in "ab" for size in range(6)}
    import pyarrow as pa

    entries = [("a", 0, "word", 10), ("b", 0, "word", 1), ("b", 3, "ord", 50), ("a", 2, "or", 90), ("a", 1, "q", 1)]
    model = language_id.build(["a", "b"], sums, pa.Table.from_pydict(dict(zip(["lang", "size", "gram", "n"], map(list, zip(*entries))))))
    scorer = language_id.Scorer(model)
    assert list(scorer.word("word")) == [1.0, 2.0]  # known: its own frequency
    p = model.penalty
    assert list(scorer.word("lords")) == pytest.approx([p, (4 * p + 0.30103) / 5], abs=1e-4)  # unseen: the longest known grams
    assert list(scorer.word("or")) == pytest.approx([(2 * p + 0.04576) / 3, p], abs=1e-4)  # " or ": no known gram of three
    assert list(scorer.word("q")) == [2.0, p] and list(scorer.word("ж")) == [p, p]
    assert scorer.text("ж")[0] == "a" and scorer.text("ж")[1] == pytest.approx(0.5)
    assert scorer.text("12 !") == scorer.text(None) == scorer.text("") == ("und", 0.0)


@pytest.mark.parametrize("sizes,total,taken", [([], 5, 0), ([3, 4], 10, 7), ([2, 100, 1000], 20, 20), ([5, 5], 6, 6)])
def test_quotas(sizes, total, taken):
    quota = language_id.quota_of(sizes, total)
    assert sum(min(n, quota) for n in sizes) == pytest.approx(taken)


def test_rare_languages_are_learned(spark):
    rows = [(k, "common words here", "aa") for k in range(3000)] + [(5000 + k, "seldom heard voices", "bb") for k in range(9)]
    model = language_id.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), sample_rows=60)
    assert sorted(model.langs) == ["aa", "bb"]
    scorer = language_id.Scorer(model)
    assert (scorer.text("heard voices")[0], scorer.text("words")[0]) == ("bb", "aa")


def test_identify_odd_rows(spark, odd_docs, no_docs):
    docs = odd_docs.withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "zz").otherwise(F.lit("yy")))
    model = language_id.train(docs)
    got = language_id.identify(docs, model).collect()
    assert len(got) == docs.count()
    named = [(r.doc_id, bool(r.text and re.search(r"[^\W\d_]", r.text))) for r in docs.collect()]
    assert sorted((repr(r.doc_id), r.lang_pred != "und") for r in got) == sorted((repr(i), k) for i, k in named)
    assert language_id.identify(no_docs, model).count() == 0
    nothing = language_id.train(no_docs)
    assert {(r.lang_pred, r.score) for r in language_id.identify(docs, nothing).collect()} == {("und", 0.0)}
