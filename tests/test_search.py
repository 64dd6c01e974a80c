import math
import random
import re
from datetime import datetime

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from beaconlog.operators import article_index, search
from beaconlog.schemas import ARTICLE_COLUMNS, ddl

WORDS = "alpha beta gamma delta error rate timeout pool backend route deploy cache".split()


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        body = " ".join(rng.choices(WORDS, weights=range(12, 0, -1), k=rng.randint(3, 40)))
        rows.append((f"a{i:02d}", f"T{i}", ["runbook", "faq"][i % 2], "backend" if i % 3 else None, ["x", str(i % 5)],
                     body, datetime(2026, 1, 1), datetime(2026, 1, 1)))
    rows[7] = rows[7][:5] + (None,) + rows[7][6:]
    rows[8] = rows[8][:5] + ("",) + rows[8][6:]
    rows[10] = rows[10][:5] + (rows[9][5],) + rows[10][6:]  # an exact copy
    return rows, spark.createDataFrame(rows, ddl(ARTICLE_COLUMNS))


def brute(rows, query, k, keep=lambda r: True):
    docs = {r[0]: [t for t in re.split("[^a-z0-9]+", r[5].lower()) if t] for r in rows if r[5] is not None}
    mean = sum(map(len, docs.values())) / len(docs)
    scores = {}
    for term in {t for t in re.split("[^a-z0-9]+", query.lower()) if t}:
        df = sum(term in d for d in docs.values())
        for key, d in docs.items():
            tf = d.count(term)
            if tf:
                idf = math.log(1 + (len(docs) - df + 0.5) / (df + 0.5))
                scores[key] = scores.get(key, 0) + idf * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(d) / mean))
    kept = {r[0] for r in rows if keep(r)}
    best = sorted((-round(s, 6), key) for key, s in scores.items() if key in kept)
    return [(key, -s) for s, key in best[:k]]


QUERIES = [("q1", "Backend error-rate!"), ("q2", "cache"), ("q3", "unknown words"), ("q4", "alpha beta alpha")]


def hits(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.article_id, r.score))
    return out


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_word_search_equals_brute_force(spark, corpus, threshold):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)  # -1: without broadcasts
    rows, articles = corpus
    asked = spark.createDataFrame(QUERIES, "query_id string, query string")
    want = {q: brute(rows, text, 5) for q, text in QUERIES if brute(rows, text, 5)}
    assert hits(search.search_articles(asked, articles)) == want
    runbooks = {q: brute(rows, text, 3, lambda r: r[2] == "runbook" and "1" in r[4]) for q, text in QUERIES}
    got = hits(search.search_articles(asked, articles, 3, {"category": "runbook", "tags": "1"}))
    assert got == {q: v for q, v in runbooks.items() if v}
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_word_search_in_blocks(spark, corpus, monkeypatch):
    # a word that every article has is met block by block, not in the one task of the word
    for name, size in (("QUERY_BLOCK", 2), ("ARTICLE_BLOCK", 8), ("TERM_CHUNK", 3)):
        monkeypatch.setattr(search, name, size)
    rows, articles = corpus
    texts = QUERIES + [("q5", " ".join(WORDS)), ("q6", ""), (None, "alpha cache")]
    asked = spark.createDataFrame(texts, "query_id string, query string")
    want = {q: brute(rows, text, 5) for q, text in texts if brute(rows, text, 5)}
    got = {}
    for r in search.search_articles(asked, articles).collect():
        got.setdefault(r.query_id, {})[r.rank] = (r.article_id, r.score)
    assert {q: [v[k] for k in sorted(v)] for q, v in got.items()} == want
    assert search.search_articles(asked, articles, index=search.build_article_index(articles)).count() == sum(map(len, want.values()))
    assert search.search_articles(asked, articles.limit(0)).count() == 0
    assert search.search_articles(asked.limit(0), articles).count() == 0


def test_stored_index_and_refresh(spark, corpus, tmp_path):
    rows, articles = corpus
    asked = spark.createDataFrame(QUERIES, "query_id string, query string")
    path = str(tmp_path / "index")
    found = lambda k=5, **f: hits(article_index.search_index(article_index.load_article_index(spark, path), asked, k, **f))
    article_index.save_article_index(articles, path, buckets=4)
    assert found() == hits(search.search_articles(asked, articles))
    changed = [r[:5] + ("cache cache cache", r[6], datetime(2026, 2, 1)) if r[0] == "a20" else r for r in rows]
    now = spark.createDataFrame(changed, ddl(ARTICLE_COLUMNS))
    assert article_index.refresh_article_index(now, path, F.lit(datetime(2026, 1, 15))) == 1
    after = found()
    assert after == hits(search.search_articles(asked, now)) and after["q2"][0][0] == "a20"
    assert article_index.refresh_article_index(now, path, F.lit(datetime(2027, 1, 1))) == 0
    assert article_index.merge_segments(spark, path, fan_in=2) > 0 and found() == after
    runbooks = {"category": "runbook", "tags": "1"}
    assert found(3, filters=runbooks) == hits(search.search_articles(asked, now, 3, runbooks))
    # deleted articles leave the index, also the last ones of a bucket
    few = now.filter("article_id IN ('a03', 'a04')")
    assert article_index.refresh_article_index(few, path, F.lit(datetime(2027, 1, 1))) == 57
    index = article_index.load_article_index(spark, path)
    assert sorted(r.article_id for r in index.docs.collect()) == ["a03", "a04"] and index.size()[0] == 2
    assert found() == hits(search.search_articles(asked, few))


def test_index_opens_the_files_of_its_terms_and_skips_blocks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(article_index, "RARE", 10)
    monkeypatch.setattr(article_index, "BLOCK", 8)
    rng = random.Random(4)
    rows = []
    for i in range(600):
        body = " ".join(["common"] * rng.randint(1, 4) + [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(2, 30))])
        rows.append((f"a{i:03}", "t", "faq", None, ["x"], body + (" needle" * (i % 97 == 0)), datetime(2026, 1, 1), datetime(2026, 1, 1)))
    articles, path = spark.createDataFrame(rows, ddl(ARTICLE_COLUMNS)), str(tmp_path / "index")
    asked = spark.createDataFrame([("q1", "common needle"), ("q2", "common w5 w6"), ("q3", "nowhere")], "query_id string, query string")
    article_index.save_article_index(articles, path, buckets=32)
    index = article_index.load_article_index(spark, path)
    opened, table = [], article_index.StoredIndex.table

    def watched(self, name, schema, cut=None, buckets=None):
        opened.append((name, buckets))
        return table(self, name, schema, cut, buckets)

    monkeypatch.setattr(article_index.StoredIndex, "table", watched)
    assert hits(article_index.search_index(index, asked, 3)) == {q: brute(rows, text, 3) for q, text in asked.collect() if brute(rows, text, 3)}
    assert all(b is not None and len(b) <= 5 for name, b in opened if name in ("postings", "terms"))
    matching = sum(1 for r in rows for q in ({"common", "needle"}, {"common", "w5", "w6"}) if q & set(r[5].split()))
    assert article_index.candidates(index, asked, 3)[0].count() < 0.1 * matching


def test_snippet_and_queries(spark):
    df = spark.createDataFrame([("x" * 400,), ("short",), ("",), (None,)], "body string")
    got = [r[0] for r in df.select(search.search_snippet(F.col("body"))).collect()]
    assert got == ["x" * 300 + "...", "short...", "(no body)", "(no body)"]
    signals = spark.createDataFrame([("s", "svc", "/r"), ("s", "svc", "/r")], "signal_type string, service string, route string")
    texts = [r.query for r in search.signal_search_queries(signals, variants=True).orderBy("variant").collect()]
    assert texts == ["s svc /r runbook remediation root cause", "s failure root cause",
                     "s runbook remediation steps", "similar incidents s"]


@pytest.mark.parametrize("block", [search.DENSE_BLOCK, 4])
def test_dense_search_equals_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(search, "DENSE_BLOCK", block)  # 4: several blocks of queries and of vectors
    monkeypatch.setattr(search, "VECTOR_BLOCK", 8 * block)
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 8)).astype("float32")
    vectors[7] = vectors[3] * 2  # same direction: a tie
    queries = rng.normal(size=(11, 8))
    queries[0] = vectors[3]
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)] + [(999, None)],
                               "vec_id long, embedding array<float>").repartition(5)
    asked = spark.createDataFrame([(i, [float(x) for x in q]) for i, q in enumerate(queries)],
                                  "query_id long, vector array<double>")
    got = {}
    for r in search.search_articles_dense(asked, df, 3).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, round(r.score, 6)))
    norm = lambda m: m / np.linalg.norm(m, axis=1, keepdims=True)
    sims = norm(queries) @ norm(vectors.astype("float64")).T
    for q in range(11):
        best = np.argsort(-sims[q], kind="stable")[:3]
        assert sorted(got[q]) == sorted((int(i), round(float(sims[q][i]), 6)) for i in best)


def test_dense_search_skips_cells(spark):
    """Of well separated directions a query meets its own and few others; odd vectors do no harm."""
    rng = np.random.default_rng(6)
    middles = rng.normal(size=(20, 16))
    vectors = [middles[k % 20] + 0.05 * rng.normal(size=16) for k in range(1000)] + [np.zeros(16)]
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in enumerate(vectors)] + [(5000, None)], "vec_id long, embedding array<double>")
    asked = df.filter("vec_id % 50 = 0").selectExpr("vec_id AS query_id", "embedding AS vector")
    able, _, stats = search.able_pairs(asked, df, 5, "vec_id", "embedding")
    met = sum(stats[r.cell][0] for r in able.filter("query_id < 1000").collect())
    assert met < 0.4 * 20 * len(vectors)
    found = search.search_articles_dense(asked, df, 5).collect()
    got = {}
    for r in sorted(found, key=lambda r: (r.query_id, r.rank)):
        got.setdefault(r.query_id, []).append(r.vec_id)
    rows = np.stack(vectors)
    rows /= np.maximum(np.linalg.norm(rows, axis=1, keepdims=True), 1e-300)
    for q in range(0, 1001, 50):
        want = np.lexsort((np.arange(len(rows)), -np.round(rows @ rows[q], 9)))[:5]
        assert got[q] == want.tolist(), q
    nothing = df.limit(0)
    assert search.search_articles_dense(asked, nothing, 5).count() == 0
    assert search.search_articles_dense(nothing.selectExpr("vec_id AS query_id", "embedding AS vector"), df, 5).count() == 0


ODD = ["", "...", "Alpha alphaKelvin İstanbul", "a1-b2\nA1 straße Ångström", "x" * 70000, "café", "\U0001f600q\U0001f600", "end", "begin end", " 7 7 7"]


def test_words_are_cut_as_in_a_search_of_raw_articles(spark):
    rows = [(f"o{i}", "t", "faq", None, ["x"], body, datetime(2026, 1, 1), datetime(2026, 1, 1)) for i, body in enumerate(ODD)]
    articles = spark.createDataFrame(rows, ddl(ARTICLE_COLUMNS))
    want = sorted(tuple(r) for r in search.build_article_index(articles).postings.select("article_id", "term", "tf", "doc_len").collect())
    docs = article_index._docs(articles, 4).collect()
    assert sorted((r.article_id, w, tf, r.doc_len) for r in docs for w, tf in zip(r.words.split(), r.tfs)) == want
    assert sorted(r.article_id for r in docs) == [r[0] for r in rows] and len({r.number for r in docs}) == len(rows)


@pytest.mark.parametrize("buckets, slots", [(3, 2), (2, 8)])
def test_runs_give_every_posting_once_in_blocks_by_share(monkeypatch, buckets, slots):
    for name, size in (("RUN", 50), ("HOT", 4), ("TEXT_BYTES", 100)):  # many runs, terms that go to several tasks
        monkeypatch.setattr(article_index, name, size)
    rng = random.Random(5)
    texts = [" ".join(rng.choices(WORDS, weights=range(12, 0, -1), k=rng.randint(0, 30))) for _ in range(80)]
    held = pa.RecordBatch.from_pydict({"article_id": [f"a{i}" for i in range(80)], "_text": texts})
    docs = [b.append_column("number", pa.array([((r // 20) << 33) + r for r in rows], pa.int64()))
            for b, rows in _numbered(article_index._count_words(iter([held])))]
    runs = list(article_index._runs(buckets, slots)(iter(docs)))
    assert sum(map(len, runs)) > slots
    got, tasks, by_slot = [], {}, {}
    for batch in runs:
        for slot, run in zip(batch["slot"].to_pylist(), batch["run"].to_pylist()):
            by_slot.setdefault(slot, []).append(pa.RecordBatch.from_pydict({"slot": [slot], "run": [run]}))
    assert set(by_slot) <= set(range(article_index._slots(buckets, slots)))
    for slot, mine in by_slot.items():
        last = {}
        for row in (r for b in article_index._blocks(buckets, 15.0, 8)(iter(mine)) for r in b.to_pylist()):
            assert row["n"] == len(row["articles"]) <= 8 and row["block"] == last.get(row["term"], (-1, 0))[0] + 1
            assert (row["max_tf"], row["min_len"]) == (max(row["tfs"]), min(row["lens"]))
            shares = [round(article_index._share(tf, n, 15.0), 5) for tf, n in zip(row["tfs"], row["lens"])]
            assert shares == sorted(shares, reverse=True) and (not row["block"] or shares[0] <= last[row["term"]][1])
            last[row["term"]] = row["block"], shares[-1]
            tasks.setdefault(row["term"], set()).add(slot)
            got += [(row["term"], number, tf, n) for number, tf, n in zip(row["articles"], row["tfs"], row["lens"])]
    want = [(t, ((i // 20) << 33) + i, text.split().count(t), len(text.split())) for i, text in enumerate(texts) for t in set(text.split())]
    assert sorted(got) == sorted(want)
    assert (max(map(len, tasks.values())) > 1) == (slots > buckets)


def _numbered(batches):
    at = 0
    for batch in batches:
        yield batch, range(at, at + len(batch))
        at += len(batch)


def test_saving_an_index_stores_no_bodies_and_no_postings_besides_it(spark, corpus, tmp_path, monkeypatch):
    stored, real = [], article_index.materialize
    monkeypatch.setattr(article_index, "materialize", lambda df, label: stored.append(label) or real(df, label))
    article_index.save_article_index(corpus[1], str(tmp_path / "index"), buckets=4)
    assert not stored


@pytest.mark.parametrize("few", [0, 20_000])
def test_many_queries_meet_ranges_of_articles(spark, corpus, tmp_path, monkeypatch, few):
    # articles of several tasks, queries in several blocks, and all terms summed where the bounds leave too many articles
    monkeypatch.setattr(article_index, "FEW", few)
    monkeypatch.setattr(article_index, "QUERY_BLOCK", 2)
    rows, articles = corpus
    texts = QUERIES + [("q5", " ".join(WORDS)), ("q6", "")]
    asked, path = spark.createDataFrame(texts, "query_id string, query string"), str(tmp_path / "index")
    article_index.save_article_index(articles.repartition(5), path, buckets=4)
    index = article_index.load_article_index(spark, path)
    assert hits(article_index.search_index(index, asked, 4)) == {q: brute(rows, text, 4) for q, text in texts if brute(rows, text, 4)}
    want = {q: brute(rows, text, 2, lambda r: r[2] == "faq") for q, text in texts}
    assert hits(article_index.search_index(index, asked, 2, {"category": "faq"})) == {q: v for q, v in want.items() if v}
    if not few:  # what is scored from the words of an article is the best of a query and what ties with them
        assert article_index.candidates(index, asked, 4)[0].count() <= 4 * 5 + 2


def test_refresh_reads_bodies_of_changed_articles_where_they_are(spark, corpus, tmp_path, monkeypatch):
    rows, articles = corpus
    asked, path = spark.createDataFrame(QUERIES, "query_id string, query string"), str(tmp_path / "index")
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting, None)
    article_index.save_article_index(articles.filter("article_id <> 'a30'"), path, buckets=4)
    changed = [r[:5] + ("cache cache cache", r[6], datetime(2026, 2, 1)) if r[0] == "a20" else r for r in rows if r[0] != "a40"]
    changed = [r[:5] + ("timeout", r[6], None) if r[0] == "a21" else r for r in changed]
    now = spark.createDataFrame(changed, ddl(ARTICLE_COLUMNS))
    stored, real = {}, article_index.materialize
    monkeypatch.setattr(article_index, "materialize", lambda df, label: stored.setdefault(label, df.columns) and real(df, label))
    # updated, without a time, new with an old time, gone
    assert article_index.refresh_article_index(now, path, F.lit(datetime(2026, 1, 15))) == 4
    assert not any({"body", "counts", "words", "term"} & set(columns) for columns in stored.values())
    index = article_index.load_article_index(spark, path)
    got = hits(article_index.search_index(index, asked, 5))
    assert got == hits(search.search_articles(asked, now)) and got["q2"][0][0] == "a20"
    assert spark.conf.get(setting, None) == before
    terms = {r.term: r.df for r in index.table("terms", article_index.TERMS, "term_bucket int").groupBy("term").agg(F.sum("df").alias("df")).collect()}
    want = {w: sum(w in set(r[5].split()) for r in changed if r[5]) for w in WORDS}
    assert {w: terms[w] for w in WORDS} == want
