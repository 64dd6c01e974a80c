"""Exact dedup, URL rules, sharding, decontamination: against SQL, brute force and odd input."""

import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from beaconlog.llm import decontaminate, exact_dedup, near_dup, queries, shard_shuffle, url_rules
from check import TABLES, canonical


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, sf_dir, name):
    db = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            db.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, sf_dir).toPandas(), db.sql(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert canonical(got) == canonical(want)


@pytest.mark.parametrize("keep,winner", [("largest", 2), ("smallest", 1)])
@pytest.mark.parametrize("bits", [1, 4])
def test_tree_dedup(spark, odd_docs, keep, winner, bits):
    rows = exact_dedup.tree_dedup(odd_docs.repartition(7), keep=keep, round_bits=bits).collect()
    assert len(rows) == odd_docs.count()
    groups = {}
    for r in rows:
        groups.setdefault(r.text_sha256, []).append(r)
    for members in groups.values():
        assert sum(r.kept for r in members) == 1
        assert {r.group_size for r in members} == {len(members)}
    copies = next(g for g in groups.values() if {r.doc_id for r in g} == {1, 2, None})
    assert {r.keep_id for r in copies} == {winner}
    blank = groups[hashlib.sha256(b"").hexdigest()]
    assert {r.doc_id for r in blank} == {4, 5, None}


def test_runs_are_merged_in_order_by_ranges(spark, tmp_path):
    rows = spark.range(6000).selectExpr(
        "unhex(sha2(cast(id % 900 as string), 256)) digest", "cast(3 as long) n_bytes", "cast(id % 8 as int) run",
        "struct(id as rank, id as row, id as keep_id) best", "1L n",
    )
    level = exact_dedup.merge_runs(rows, 0)
    for bits in (2, 4):
        level = exact_dedup.merge_runs(level.withColumn("run", F.shiftright("run", 2)), bits)
        plan = level._jdf.queryExecution().executedPlan().toString()
        last = plan[:plan.index("REPARTITION_BY_COL")]
        # one exchange a round, by run and range; the merge itself reads sorted rows
        assert last.count("Exchange") == 1 and "SortAggregate" in last and "Sort [run" in last
        path = str(tmp_path / str(bits))
        level.write.parquet(path)
        level = spark.read.parquet(path)
        for file in level.inputFiles():
            found = [(r.run, r.part, bytes(r.digest)) for r in spark.read.parquet(file).collect()]
            assert found == sorted(found) and len(set(found)) == len(found)
            assert all(digest[0] >> (8 - bits) == part for _, part, digest in found)
    got = {bytes(r.digest): (r.best.keep_id, r.n) for r in level.collect()}
    assert level.count() == len(got) == 900 and sum(n for _, n in got.values()) == 6000
    for k in range(900):
        ids = range(k, 6000, 900)
        assert got[hashlib.sha256(str(k).encode()).digest()] == (max(ids), len(ids))


def test_drop_copies_keeps_columns(odd_docs, no_docs):
    left = exact_dedup.drop_copies(odd_docs)
    assert left.columns == odd_docs.columns
    assert left.count() == odd_docs.select(F.coalesce("text", F.lit(""))).distinct().count()
    assert exact_dedup.drop_copies(no_docs).count() == 0


def _judge(url, rules, default="allow"):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host, rest = rest[:cut], rest[cut:]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
        path = rest[:min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    fits = [r for r in rules if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    best = max(fits, key=lambda r: (len(r[0] + r[1]), len(r[0])), default=None)
    return host, path, best and best[0] + best[1], best[2] if best else default


URLS = [
    None, "", "no scheme", "://", "http://", "http://NET/", "http://a.net", "http://a.net/", "http://anet/",
    "http://x.example.net/en/1?q#f", "http://example.net/en/", "http://example.net/en", "https://b.example.com/de/x",
    "http://deep.a.b.example.com/de/sub/page", "http://example.com/de/sub/other", "http://é.org/fr/é", "ftp://org/fr/://x",
    "http://h.org?x=/fr/", "http://a..net/x", "http://user@host.net:80/p", "http://net\n/x", "http://zz/",
]
RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
    ("b.example.com", "", "allow"), ("example.com", "/de/sub/", "allow"), ("example.com", "/de/sub/page", "block"),
]


@pytest.mark.parametrize("parts", ["1", "5"])
def test_url_rules(spark, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        pages = spark.createDataFrame([(k % 20, u, "x") for k, u in enumerate(URLS * 3)], "page_id long, url string, host string")
        rules = spark.createDataFrame([*RULES, ("", "/", "block"), (None, "/", "block")], "host string, path string, verdict string")
        got = url_rules.judge_urls(pages.repartition(6), rules).collect()
        want = [(k % 20, *_judge(u, RULES)) for k, u in enumerate(URLS * 3)]
        assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_url_rules_empty(spark):
    pages = spark.createDataFrame([(1, "http://a.net/")], "page_id long, url string")
    rules = spark.createDataFrame([], "host string, path string, verdict string")
    assert [tuple(r) for r in url_rules.judge_urls(pages, rules, default="block").collect()] == [(1, "a.net", "/", None, "block")]
    assert url_rules.judge_urls(pages.limit(0), rules).count() == 0


def test_shards(spark, odd_docs, no_docs):
    docs = odd_docs.drop("kept").repartition(5)
    made = [shard_shuffle.shards(shard_shuffle.external_shuffle(docs, bucket_bytes=1000), 4).collect() for _ in range(2)]
    rows = made[0]
    assert len(rows) == docs.count()
    by = {}
    for r in rows:
        by.setdefault(r.shard, []).append(r.slot)
    assert max(map(len, by.values())) - min(map(len, by.values())) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in by.values())
    key = lambda r: (r._position, r.doc_id, r.text)
    assert sorted(map(repr, map(key, rows))) == sorted(map(repr, map(key, made[1])))
    assert shard_shuffle.shards(shard_shuffle.external_shuffle(no_docs), 3).count() == 0
    with pytest.raises(ValueError):
        shard_shuffle.external_shuffle(docs.withColumn("_bucket", F.lit(1)))


def _words(text):
    import re

    text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", text)


def _hits(text, items, window):
    words, hit, owners = _words(text), set(), set()
    for item, other in items:
        w = _words(other)
        for at in range(max(len(w) - window, 0) + 1 if w else 0):
            part = w[at:at + window]
            for k in range(len(words) - len(part) + 1):
                if words[k:k + len(part)] == part:
                    hit.update(range(k, k + len(part)))
                    owners.add(str(item))
    return len(words), len(hit), sorted(owners)


@pytest.mark.parametrize("blocks", [200_000, 3])
def test_decontaminate(spark, odd_docs, no_docs, blocks):
    items = [(1, "Word3 word4, word5 word6 word7 word8 word9 word10 word11 word12 word13"), (2, "one"), (3, None), (4, ""),
             (5, "naïve École"), (6, "naïve ÉCOLE"), (7, "w1x1 w2x2 w3x3 w4x4 w5x5 w6x6 w7x7"), (8, "one"), (9, "word1 word3")]
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("key", F.lit("x"))
    got = decontaminate.decontaminate(odd_docs.repartition(3), bench, block_shingles=blocks).collect()
    want = []
    for r in odd_docs.collect():
        n, h, own = _hits(r.text, items, 10)
        want.append((r.doc_id, n, h, len(own), own, h > 0))
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    clean = decontaminate.drop_contaminated(odd_docs, bench)
    assert clean.columns == odd_docs.columns and clean.count() == sum(not w[-1] for w in want)
    assert decontaminate.decontaminate(no_docs, bench).count() == 0
    assert not decontaminate.decontaminate(odd_docs, bench.limit(0)).where("contaminated").count()


def test_only_the_rarest_shingle_is_joined(spark, monkeypatch):
    common, rare = "a b c d e f g", "a b c d e f g x y z"
    docs = spark.createDataFrame([(k, common) for k in range(50)] + [(50, f"o {rare} o"), (51, "a b c d e x y z")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, rare)], "item_id long, text string")
    stored, store = {}, decontaminate.store
    monkeypatch.setattr(decontaminate, "store", lambda df, label: stored.setdefault(label, store(df, label)))
    got = decontaminate.decontaminate(docs, bench).where("contaminated").collect()
    assert [(r.doc_id, r.n_hit, r.items) for r in got] == [(50, 10, ["1"])]
    # a row for each document and one for the window's rarest shingle, none for the three common ones
    assert stored["bench-meetings"].where("hit").count() == 1 and stored["bench-meetings"].count() == 53


def test_columns_of_any_name_go_through(spark, odd_docs, no_docs):
    """The filtering functions give back their input's columns, also those that look like their own."""
    import corpus_pipeline

    names = ["_digest", "_keep_id", "_row_id", "_row_key", "_id", "_key", "_hit_id", "_stay_id", "id"]
    docs = odd_docs.select("doc_id", "text").withColumns({n: F.lit(f"mine {n}") for n in names})
    bench = spark.createDataFrame([(1, "no such words")], "item_id long, text string")
    for kept in (exact_dedup.drop_copies(docs), near_dup.drop_near_duplicates(docs), decontaminate.drop_contaminated(docs, bench)):
        rows = kept.collect()
        assert kept.columns == docs.columns and rows
        assert all(r[n] == f"mine {n}" for r in rows for n in names)
    assert exact_dedup.drop_copies(no_docs).count() == near_dup.drop_near_duplicates(no_docs).count() == 0
    assert corpus_pipeline.pack(spark, no_docs, "").count() == 0
