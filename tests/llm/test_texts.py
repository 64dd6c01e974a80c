"""Pseudonyms, quality ranking, near duplicates, the pipeline: brute force, round trips, held-out accuracy."""

import zlib

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import corpus_pipeline
from beaconlog.llm import components, near_dup, odd_sketch, pii, quality_rank, queries

KEY = b"test key"


# ── pseudonyms ──────────────────────────────────────────────────────────────

@settings(max_examples=200, deadline=None)
@given(st.integers(1, 10**20), st.data())
def test_permutation_and_inverse(size, data):
    value = data.draw(st.integers(0, size - 1))
    moved = pii.permute(value, size, KEY, "x")
    assert 0 <= moved < size and pii.permute(moved, size, KEY, "x", back=True) == value


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 1000])
def test_permutation_is_one_to_one(size):
    assert sorted(pii.permute(v, size, KEY, "x") for v in range(size)) == list(range(size))


SAMPLES = {
    "card": ["4111 1111 1111 1111", "4111-1111-1111-1111", "4111111111111111", "378282246310005"],
    "phone": ["+1 (652) 555-4544", "+1 652 555 4544", "+49 30 901820", "(652) 555-4544"],
    "ssn": ["123-45-6789"],
    "ip": ["10.0.0.1", "255.255.255.255"],
    "date": ["1980-02-28", "28.02.1980", "2/28/1980", "1/2/2003"],
    "iban": ["GB82 WEST 1234 5698 7654 32", "DE89370400440532013000"],
    "email": ["jane.doe+x9@mail1.example.com", "Être.31@example.org"],
}


@pytest.mark.parametrize("kind", SAMPLES)
def test_formats(kind):
    for value in SAMPLES[kind]:
        text = f"ü before, {value}. After"
        new, spans = pii.pseudonymize(text, KEY)
        assert [s[0] for s in spans] == [kind], value
        made = new[spans[0][1]:spans[0][2]]
        assert made != value and value not in new
        shape = lambda t: [c if not c.isalnum() else "#" for c in t]
        if kind not in ("ip", "date"):
            assert len(made) == len(text) - len(new) + spans[0][2] - spans[0][1] and shape(new) == shape(text)
        if value != "2/28/1980":  # month first cannot be told from the pseudonym
            assert pii.pseudonymize(new, KEY, back=True)[0].replace("/0", "/").replace(" 0", " ") == text
        assert pii.pseudonymize(text, b"another")[0] != new


def test_equal_dates_stay_linked():
    iso, german, american = (pii.pseudonymize(v, KEY)[0] for v in SAMPLES["date"][:3])
    y, m, d = map(int, iso.split("-"))
    assert german == f"{d:02d}.{m:02d}.{y}" and american == f"{m}/{d}/{y}"


def test_equal_values_stay_linked():
    plain = [pii.pseudonymize(v, KEY)[0] for v in SAMPLES["card"][:3]]
    assert len({"".join(c for c in p if c.isdigit()) for p in plain}) == 1
    digits = "".join(c for c in plain[0] if c.isdigit())
    assert pii.luhn_digit(digits[:-1]) == int(digits[-1])
    assert pii.iban_number((b := pii.pseudonymize(SAMPLES["iban"][1], KEY)[0])[4:] + b[:4]) % 97 == 1


@pytest.mark.parametrize("text", [
    "", "4111 1111 1111 1112", "1980-02-30", "300.1.1.1", "version 1.2.3", "000-45-6789", "GB82 WEST 1234 5698 7654 33",
    "no@dots", "Licensed under CC BY-NC 4.0.", "123456", "0000000000000000", "1.2.3.4.5",
])
def test_what_fails_its_check_stays(text):
    assert pii.pseudonymize(text, KEY) == (text, [])


# planted by hand, with the kind of each value; none comes from the patterns of the module
PLANTED = [
    ("phone", "+1 (826) 555-4081"), ("phone", "+1 652 555 4544"), ("phone", "+49 30 1234567"), ("phone", "+33 1 23 45 67 89"),
    ("phone", "(652) 555-4544"), ("ip", "190.137.223.204"), ("ip", "10.0.0.1"), ("date", "2024-01-05"), ("date", "28.02.1980"),
    ("card", "4111 1111 1111 1111"), ("card", "378282246310005"), ("card", "5500-0000-0000-0004"), ("ssn", "123-45-6789"),
    ("iban", "BE68 5390 0754 7034"), ("iban", "GB82 WEST 1234 5698 7654 32"), ("iban", "DE89370400440532013000"),
]


def _planted(text, *values):
    """All values are found, as themselves, and nothing else; the pseudonym of each is the one it has alone."""
    new, spans = pii.pseudonymize(text, KEY)
    assert [s[0] for s in spans] == [kind for kind, _ in values], text
    assert [new[a:b] for _, a, b in spans] == [pii.pseudonymize(v, KEY)[0] for _, v in values], text
    assert pii.restore(new, spans, KEY) == text


@pytest.mark.parametrize("left", PLANTED)
def test_adjacent_values(left):
    for right in PLANTED:
        _planted(f"x {left[1]} {right[1]} y", left, right)


@pytest.mark.parametrize("kind, value, behind", [
    ("phone", "+1 652 555 4544", "2021"), ("phone", "+33 1 23 45 67 89", "12"), ("card", "4111 1111 1111 1111", "123"),
    ("card", "4111111111111111", "12"), ("card", "378282246310005", "2021"), ("iban", "BE68 5390 0754 7034", "2021"),
    ("iban", "BE68 5390 0754 7034", "EURO"), ("iban", "NO93 8601 1117 947", "PAID"), ("card", "4111 1111 1111 1111", "7@example.org"),
])
def test_what_follows_a_value_stays(kind, value, behind):
    new, spans = pii.pseudonymize(f"x {value} {behind}", KEY)
    assert spans[0] == (kind, 2, 2 + len(value)) and new[2:2 + len(value)] == pii.pseudonymize(value, KEY)[0]
    assert "@" in behind or (len(spans) == 1 and new.endswith(f" {behind}"))


@pytest.mark.parametrize("text,span", [
    ("an иван@example.com bitte", "иван"), ("李雷@example.com", "李雷"), ("иван1984@example.org", "иван1984"),
    ("o'brien@example.com", "o'brien"), ("first%last@example.com", "first%last"), ("at 2024-01-05T10:00:00Z", "2024-01-05"),
    ("call 555-123-4567 now", "555-123-4567"), ("μαρία@example.gr", "μαρ"),
])
def test_values_in_other_scripts_and_forms(text, span):
    new, spans = pii.pseudonymize(text, KEY)
    assert len(new) == len(text) and len(spans) == 1
    kept = [a for a, b in zip(text, new) if a == b]
    start = text.index(span)
    assert new[:start] == text[:start] and sum(a != b for a, b in zip(text[start:], new[start:])) >= len(span) // 2, kept
    assert all(a.isalnum() == b.isalnum() for a, b in zip(text, new))
    assert pii.pseudonymize(f"x {text} y", KEY)[0] == f"x {new} y"


def test_what_precedes_a_value_stays():
    _planted("no 12 4111 1111 1111 1111", ("card", "4111 1111 1111 1111"))
    _planted("AB12 3456 7890 BE68 5390 0754 7034", ("iban", "BE68 5390 0754 7034"))
    numbers = " ".join(map(str, range(1, 60)))
    assert pii.pseudonymize(numbers, KEY) == (numbers, [])


def test_pseudonymize_documents(spark, sf_dir, odd_docs, no_docs):
    rows = odd_docs.withColumn("text", F.concat("text", F.lit(" 10.0.0.1"))).withColumn("spans", F.lit(1))
    got = pii.pseudonymize_documents(rows, KEY).collect()
    want = [(r.doc_id, r.text and pii.pseudonymize(r.text, KEY)[0]) for r in rows.collect()]
    assert sorted(map(repr, ((r.doc_id, r.text) for r in got))) == sorted(map(repr, want))
    assert all(r.n_replaced == len(r.spans) == (r.text is not None) for r in got)
    assert pii.pseudonymize_documents(no_docs, KEY).count() == 0
    back = queries.QUERIES["op1_pii_pseudonyms"](spark, sf_dir).collect()
    given = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())
    assert len(back) == len(given)
    for r in back:
        assert (r.text is None) == (given[r.doc_id] is None)
        assert r.text is None or pii.pseudonymize(r.text, queries.PSEUDONYM_KEY, back=True)[0] == given[r.doc_id]


# ── quality ─────────────────────────────────────────────────────────────────

def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    got = queries.QUERIES["op5_quality_rank"](spark, sf_dir).toPandas().set_index("doc_id")
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet'").df().set_index("doc_id")["quality"]
    assert all(h == (zlib.crc32(str(i).encode()) % 4 == 2) for i, h in got["held_out"].items())
    both = got[got["held_out"]].join(labels, how="inner")
    assert (both["predicted"] == both["quality"]).mean() > 0.95
    assert got["score"].between(0, 1).all() and (got["predicted"] == (got["score"] >= 0.7)).all()


def test_fit_without_preferences():
    rows = np.array([quality_rank.features(t) for t in ("a b c", "", "D E!")])
    for labels, good in ((np.ones(3), True), (np.zeros(3), False)):
        score = quality_rank.fit(rows, labels).score(rows)
        assert ((score >= quality_rank.THRESHOLD) == good).all()
    none = quality_rank.fit(np.zeros((0, len(quality_rank.FEATURES))), np.zeros(0))
    assert (none.score(rows) >= quality_rank.THRESHOLD).all()


def test_threshold_is_the_quantile():
    rng = np.random.default_rng(1)
    labels = (rng.random(400) < 0.8).astype(int)
    rows = rng.normal(size=(400, len(quality_rank.FEATURES))) + labels[:, None]
    score = quality_rank.fit(rows, labels).score(rows)
    assert abs((score >= 0.7).mean() - labels.mean()) < 0.02


def test_fit_takes_every_labelled_row(spark, monkeypatch):
    monkeypatch.setattr(quality_rank, "BLOCK_ROWS", 16)
    monkeypatch.setattr(quality_rank, "BLOCK_RARE", 4)
    rng = np.random.default_rng(2)
    rows = [(k, " ".join(rng.choice(["One", "two", "|", "3."], rng.integers(1, 30), p=[.7, .2, .05, .05] if k % 5 else [.1, .1, .5, .3]))) for k in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 5 > 0)) for k in range(90)], "doc_id long, quality int")
    seen, fit_sums = [], quality_rank.fit_sums

    def watched(paired, all_rows, good, bad, threshold):
        seen.append((all_rows(lambda x, label: np.array([len(x), label.sum(), x.sum()])), good, bad))
        seen.append(paired(lambda x, label: np.array([1, (label == 1).any() and (label == 0).any(), (label == 1).sum()])))
        return fit_sums(paired, all_rows, good, bad, threshold)

    monkeypatch.setattr(quality_rank, "fit_sums", watched)
    model = quality_rank.train(docs, labels)
    x = np.array([quality_rank.features(t) for _, t in rows])
    (sums, good, bad), (blocks, both, good_pairs) = seen
    assert (good, bad) == (72, 18) and good_pairs == 72 and blocks == both == 6  # every block has pairs
    assert sums[:2].tolist() == [90, 72] and abs(sums[2] - x.sum()) < 1e-6
    assert np.allclose(model.center, quality_rank.expand(x).mean(axis=0))
    scores = model.score(x)
    assert abs((scores >= 0.7).mean() - 0.8) <= 2 / 90
    assert all((s >= 0.7) == (k % 5 > 0) for (k, t), s in zip(rows, scores) if len(t.split()) > 8)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (None, 1, 0), (8, None, 0), (7, 0, 0)], "doc_id long, quality int, toxic int")
    model = quality_rank.train(odd_docs, labels)
    got = quality_rank.score_documents(odd_docs, model).collect()
    assert len(got) == odd_docs.count() and all(r.score is not None for r in got)
    assert quality_rank.score_documents(no_docs, quality_rank.train(no_docs, labels)).count() == 0


def test_fit_moves_features_not_texts(spark, monkeypatch):
    """What is joined with labels is 25 numbers, whatever the length of a text."""
    rng = np.random.default_rng(3)
    rows = [(k, " ".join(f"{w:x}" for w in rng.integers(0, 2**60, 3000))) for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(k, k % 2) for k in range(100)], "doc_id long, quality int")
    joined, join = [], type(docs).join

    def watched(left, right, *args, **kw):
        joined.extend([left.columns, right.columns])
        return join(left, right, *args, **kw)

    monkeypatch.setattr(type(docs), "join", watched)
    texts = quality_rank.train(docs, labels)
    assert joined and not any("text" in columns for columns in joined)
    stored = quality_rank.measure(docs)
    model = quality_rank.train(stored, labels, x_col="x")
    # features stored once give the same model and scores as texts
    assert np.allclose(model.weights, texts.weights) and abs(model.quantile - texts.quantile) < 1e-9
    once = {r.doc_id: r.score for r in quality_rank.score_documents(stored, model, x_col="x").collect()}
    again = {r.doc_id: r.score for r in quality_rank.score_documents(docs, model).collect()}
    assert once.keys() == again.keys() and all(abs(once[k] - again[k]) < 1e-12 for k in once)


# ── near duplicates ─────────────────────────────────────────────────────────

def _classes(rows, size, percent):
    sets = []
    for _, text in rows:
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = [w for w in __import__("re").split("[\x20\x09-\x0d]+", words) if w]
        sets.append({tuple(words[k:k + size]) for k in range(max(len(words) - size, 0) + 1)} if words else set())
    above = list(range(len(rows)))

    def root(k):
        while above[k] != k:
            k = above[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                above[root(a)] = root(b)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root(j) == root(k) and rows[j][0] is not None]
        out.append((i, len(sets[k]), min(ids) if ids else None))
    return out


def _chained(seed, groups, copies):
    """Near copies around the threshold, chains of them, and passages that many share."""
    rng = np.random.default_rng(seed)
    word = lambda n: [f"v{x}" for x in rng.integers(0, 5000, n)]
    passage, texts = word(60), []
    for _ in range(groups):
        base = word(int(rng.integers(20, 200)))
        for _ in range(copies):
            new = list(base)
            for _ in range(int(rng.integers(0, 4))):
                new[int(rng.integers(0, len(new)))] = "changed" + str(rng.integers(0, 99))
            base = new if rng.random() < 0.5 else base
            texts.append(" ".join(new + (passage if rng.random() < 0.3 else [])))
    order = rng.permutation(len(texts))
    return [(int(k) * 3, texts[k]) for k in order]


@pytest.mark.parametrize("seed,block,text_block,group", [(1, 8192, 512, 64), (2, 4, 3, 2), (3, 5, 16, 2)])
def test_near_duplicates(spark, monkeypatch, seed, block, text_block, group):
    monkeypatch.setattr(near_dup, "BLOCK", block)
    monkeypatch.setattr(near_dup, "TEXT_BLOCK", text_block)
    monkeypatch.setattr(near_dup, "GROUP", group)
    rows = _chained(seed, 14, 9)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = near_dup.near_duplicates(docs, shingle=4).collect()
    want = _classes(rows, 4, 80)
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in got) == sorted(want)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    got = near_dup.near_duplicates(odd_docs).collect()
    want = [(i, n, i if n == 0 else c) for i, n, c in _classes(rows, 5, 80)]
    assert sorted(map(repr, ((r.doc_id, r.n_shingles, r.component_id) for r in got))) == sorted(map(repr, want))
    left = near_dup.drop_near_duplicates(odd_docs)
    assert left.columns == odd_docs.columns
    assert sorted(map(repr, (r.doc_id for r in left.collect()))) == sorted(map(repr, [1, 4, 5, None, 6, 7, 8, 10]))
    assert near_dup.near_duplicates(no_docs).count() == near_dup.drop_near_duplicates(no_docs).count() == 0


def test_sketch_distances():
    family, rng = odd_sketch.Family(256, 40, 4, 1024, 1), np.random.default_rng(2)
    cut = odd_sketch.largest_distance(256, 1024, 80)
    for j, inside in ((0.8, True), (0.95, True), (0.4, False)):
        n = 500
        shared = int(2 * n * j / (1 + j))
        for _ in range(20):
            pool = np.unique(rng.integers(0, 1 << 63, 2 * n - shared, "u8"))
            a, b = (np.frombuffer(family.sketch(family.samples(s)), "u1") for s in (pool[:n], pool[-n:]))
            assert (np.bitwise_count(a ^ b).sum() <= cut) == inside


@pytest.mark.parametrize("hub", [0, 9999])
def test_components_of_hubs(spark, hub):
    # a star around the smallest or the largest node, 1,500 pairs beside it, and a chain
    star = spark.range(1, 3001).selectExpr(f"cast({hub} as long) a", "id b")
    pairs = spark.range(10000, 13000, 2).selectExpr("id a", "id + 1 b")
    chain = spark.range(20000, 20030).selectExpr("id + 1 a", "id b")
    edges = star.unionByName(pairs).unionByName(chain)
    got = dict(map(tuple, components.components(edges).collect()))
    want = {n: min(hub, 1) for n in [*range(1, 3001), hub]} | {n: n // 2 * 2 for n in range(10000, 13000)}
    assert got == want | {n: 20000 for n in range(20000, 20031)}


def test_hubs_are_no_key_of_an_exchange(spark, tmp_path):
    rows = spark.range(4000).selectExpr("if(id < 3000, 7L, id) u", "id v")
    least = rows.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
    told = components._tell(rows, least, 4000)
    assert {(r.u, r.v): r.m for r in told.collect()} == {(7 if v < 3000 else v, v): 0 if v < 3000 else v for v in range(4000)}
    plan = told._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
    assert plan.count("BroadcastHashJoin") >= 2


def test_components(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 299)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 160)}, 299: 299, 300: 299}


# ── pipeline ────────────────────────────────────────────────────────────────

def test_pipeline_equals_stages_by_hand(spark, sf_dir):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = corpus_pipeline.keep_good(spark, docs, sf_dir)
    assert kept.columns == names
    rows = [(r.doc_id, r.text) for r in kept.collect()]
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{sf_dir}/labels.parquet'").fetchall())
    assert np.mean([labels[i] for i, _ in rows if i in labels]) > 0.9
    best = {}
    for i, text in rows:
        best[text or ""] = max(best.get(text or "", i), i)
    rows = sorted((i, t) for t, i in best.items())
    rows = [(i, t) for (i, t), (_, n, c) in zip(rows, _classes(rows, 5, 80)) if n == 0 or c == i]
    items = duckdb.sql(f"SELECT item_id, text FROM '{sf_dir}/benchmark.parquet'").fetchall()
    from test_rows import _words

    windows = {tuple(w[k:k + 10]) for _, t in items for w in [_words(t)] for k in range(max(len(w) - 10, 0) + 1) if w}
    sizes = {len(w) for w in windows}
    clean = []
    for i, t in rows:
        w = _words(t)
        if not any(tuple(w[k:k + s]) in windows for s in sizes for k in range(len(w) - s + 1)):
            clean.append(i)
    packed = corpus_pipeline.run(spark, sf_dir).toPandas()
    assert sorted(packed["doc_id"].unique()) == sorted(clean)
    assert packed.groupby("sequence_id")["length"].sum().max() <= 4096
