"""The commit log: what readers see while writers write, die, conflict, merge and expire."""

import threading

import pytest
from pyspark.sql import functions as F

from beaconlog.sources import snapshots
from beaconlog.sources.snapshots import KEY, Change

SCHEMA = "v long"


def change(spark, table, values, key, day="2026-01-01"):
    rows = spark.createDataFrame([(v, key, day) for v in values], f"v long, {KEY} string, day string")
    return Change(table, rows.withColumn("day", F.col("day").cast("date")).coalesce(1), {key}, "day")


def values(spark, root, table, **options):
    return sorted(r.v for r in snapshots.read(spark, root, table, SCHEMA, "day", **options).collect())


def test_tables_change_together_and_keys_are_replaced(spark, tmp_path):
    root = str(tmp_path)
    assert values(spark, root, "a") == [] and snapshots.manifest(spark, root).version == 0
    snapshots.commit(spark, root, [change(spark, "a", [1, 2], "k"), change(spark, "b", [3], "k")])
    assert (values(spark, root, "a"), values(spark, root, "b")) == ([1, 2], [3])
    snapshots.commit(spark, root, [change(spark, "a", [9], "k"), change(spark, "a", [], "other")])
    assert (values(spark, root, "a"), values(spark, root, "b")) == ([9], [3])
    # one day only
    late = change(spark, "a", [7], "k", "2026-01-02")
    snapshots.commit(spark, root, [Change("a", late.rows, {"2026-01-02": {"k"}}, "day")])
    assert values(spark, root, "a") == [7, 9]
    assert values(spark, root, "a", only=lambda p: p.day == "2026-01-02") == [7]


def test_a_writer_that_dies_leaves_nothing(spark, tmp_path, monkeypatch):
    root, stage = str(tmp_path), snapshots._stage
    snapshots.commit(spark, root, [change(spark, "a", [1], "k"), change(spark, "b", [1], "k")])

    def dies(root, table, *rest):
        if table == "b":
            raise OSError("executor lost")
        return stage(root, table, *rest)

    monkeypatch.setattr(snapshots, "_stage", dies)
    with pytest.raises(OSError):
        snapshots.commit(spark, root, [change(spark, "a", [2], "k"), change(spark, "b", [2], "k")])
    assert (values(spark, root, "a"), values(spark, root, "b")) == ([1], [1])
    # what the first write left is deleted once it is old
    monkeypatch.setattr(snapshots, "_stage", stage)
    assert snapshots.expire(spark, root) == 0 and snapshots.expire(spark, root, min_age_seconds=-5) == 1
    assert values(spark, root, "a") == [1]


def test_pinned_readers_see_one_commit(spark, tmp_path):
    root = str(tmp_path)
    snapshots.commit(spark, root, [change(spark, "a", [1], "k")])
    with snapshots.pinned(spark, root) as version:
        held = snapshots.read(spark, root, "a", SCHEMA, "day")
        for n in range(9):
            snapshots.commit(spark, root, [change(spark, "a", [10 + n], f"n{n}"), change(spark, "a", [2], "k")])
        assert snapshots.compact(spark, root, {"a": "day"}) == 10
        assert values(spark, root, "a") == [1] and values(spark, root, "a", newest=True) == [2, *range(10, 19)]
    assert version == 1 and values(spark, root, "a") == [2, *range(10, 19)]
    assert [r.v for r in held.collect()] == [1]


def test_two_writers_both_count(spark, tmp_path, monkeypatch):
    root, create, raced = str(tmp_path), snapshots._create_once, []

    def race(spark, folder, name, text):
        if not raced:
            raced.append(name)
            snapshots.commit(spark, root, [change(spark, "a", [2], "other")])  # takes the number first
        create(spark, folder, name, text)

    monkeypatch.setattr(snapshots, "_create_once", race)
    assert snapshots.commit(spark, root, [change(spark, "a", [1], "k")]) == 2
    assert values(spark, root, "a") == [1, 2]
    with pytest.raises(snapshots.CommitConflict):
        create(spark, f"{root}/commits", raced[0], "again")


def test_writers_in_threads(spark, tmp_path):
    root = str(tmp_path)
    work = [threading.Thread(target=snapshots.commit, args=(spark, root, [change(spark, "a", [n], f"k{n}")])) for n in range(4)]
    [t.start() for t in work]
    [t.join() for t in work]
    assert values(spark, root, "a") == [0, 1, 2, 3] and snapshots.versions(spark, root) == [1, 2, 3, 4]


def test_many_commits_leave_few_parts(spark, tmp_path):
    root, most = str(tmp_path), 0
    for n in range(40):
        snapshots.commit(spark, root, [change(spark, "a", [n], f"k{n}")])
        snapshots.compact(spark, root, {"a": "day"}, fan_in=4, smallest=3000)
        most = max(most, len(snapshots.manifest(spark, root).tables["a"]))
    assert values(spark, root, "a") == list(range(40))
    assert most <= 3 * 4 and sum(p.files for p in snapshots.manifest(spark, root).tables["a"]) <= 12
    # a key inside a merged part is replaced alone
    snapshots.commit(spark, root, [change(spark, "a", [100], "k3")])
    assert values(spark, root, "a") == sorted([*range(40), 100])[:3] + [*range(4, 40), 100]
    assert snapshots.expire(spark, root, keep=1, min_age_seconds=-5) > 40
    assert values(spark, root, "a")[-1] == 100 and len(snapshots.versions(spark, root)) == 1


def test_merge_gives_way_to_a_writer(spark, tmp_path, monkeypatch):
    """A part that is replaced while it is merged does not come back."""
    root, stage, done = str(tmp_path), snapshots._stage, []
    for n in range(8):
        snapshots.commit(spark, root, [change(spark, "a", [n], f"k{n}")])

    def meanwhile(*args):
        parts = stage(*args)
        if not done:
            done.append(1)
            snapshots.commit(spark, root, [change(spark, "a", [50], "k0")])
        return parts

    monkeypatch.setattr(snapshots, "_stage", meanwhile)
    assert snapshots.compact(spark, root, {"a": "day"}) == 8
    assert values(spark, root, "a") == [*range(1, 8), 50]


def test_tiers_bound_the_parts():
    part = lambda day, size: snapshots.Part("p", day, ("k",), 1, size)
    small = [part("d", 1000)] * 7
    assert snapshots.mergeable(small) == []
    assert [len(g) for g in snapshots.mergeable(small + [part("d", 2000)])] == [8]
    assert snapshots.mergeable(small + [part("e", 1000), part("d", 1 << 30)]) == []
