"""Commits over several tables, and compaction of key ranges."""

import random

import pytest
from pyspark.sql import functions as F

from recordtide.sources.cache import Cache, range_of
from tests.test_cache_sync import changes, note, rows, schedule, site, world  # noqa: F401


def test_a_batch_shows_in_all_tables_or_none(spark, tmp_path):
    cache = Cache(spark, str(tmp_path))
    with cache.transaction(0):
        cache.write_changes("leads", changes(spark, (1, "a", False)), 0)
        assert rows(cache.scan("leads")) == []
        cache.write_changes("quotes", changes(spark, (5, "q", False)), 0)
    before = cache.snapshot(["leads", "quotes"])
    with pytest.raises(RuntimeError), cache.transaction(1):
        cache.write_changes("leads", changes(spark, (1, "A", False), (2, "b", False)), 1)
        raise RuntimeError("lost between two tables")
    assert rows(cache.scan("leads")) == [(1, "a")] and not cache.committed(1) and cache.compact("leads") == 0
    with cache.transaction(1):  # the replay
        cache.write_changes("leads", changes(spark, (1, "A", False), (2, "b", False)), 1)
        cache.write_changes("quotes", changes(spark, (5, None, True)), 1)
    assert rows(cache.scan("leads")) == [(1, "A"), (2, "b")] and rows(cache.scan("quotes")) == []
    # A reader that began earlier still sees the state of then, in all tables.
    assert rows(before.scan("leads")) == [(1, "a")] and rows(before.scan("quotes")) == [(5, "q")]
    assert cache.compact("leads") == 1 and rows(before.scan("leads")) == [(1, "a")]


def test_killed_before_the_commit(world):  # noqa: F811
    """All tables are written, the commit is not: nothing shows, the pending list of before counts, and the replay is whole."""
    world.notify(note("schedule.created", {"scheduleID": 100}), note("site.created", {"siteID": 777}))
    commit = world.cache._commit

    def broken(batch_id, written):
        assert len(written) > 5
        raise RuntimeError("killed")

    world.cache._commit = broken
    with pytest.raises(Exception, match="killed"):
        world.drain()
    assert all(world.cache.scan(t).isEmpty() for t in ("schedules", "jobs", "sites", "employees")) and world.cache.pending().isEmpty()
    world.cache._commit = commit
    assert world.drain() == [0]
    assert world.ids("schedules") == [100] and world.ids("jobs") == [10] and world.ids("sites") == [1]
    assert [r.id for r in world.cache.pending().collect()] == [777]


def test_a_committed_batch_is_not_done_again(world):  # noqa: F811
    world.notify(note("site.created", {"siteID": 1}))
    assert world.drain() == [0]
    world.land("site", site(1, "Later", "2024-06-01T00:00:00Z"))
    actions = world.spark.createDataFrame([("site", 1, "updated")], "resource string, id long, operation string")
    world.sync.apply(actions, 0)
    assert [r.address_city for r in world.cache.scan("sites").collect()] == ["Town"]
    world.sync.apply(actions, 1)
    assert [r.address_city for r in world.cache.scan("sites").collect()] == ["Later"]


def files(cache, table):
    return {row["path"]: row for row in cache.snapshot([table]).bases[table]}


def leads(spark, low, high, name="x", deleted=False):
    return spark.range(low, high).select("id", F.lit(name).alias("name"), F.lit(deleted).alias("deleted"))


def test_few_changes_rewrite_few_files(spark, tmp_path):
    cache = Cache(spark, str(tmp_path), rows_per_file=500)
    cache.write_changes("leads", leads(spark, 0, 100_000), 0)
    cache.compact("leads")
    old = files(cache, "leads")
    assert len(old) >= 200 and sum(f["n_rows"] for f in old.values()) == 100_000
    cache.write_changes("leads", leads(spark, 40_000, 40_100, "new"), 1)  # 0.1 percent, side by side
    want = rows(cache.scan("leads"))
    assert cache.compact("leads") == 1
    new = files(cache, "leads")
    assert len(set(old) - set(new)) <= 0.05 * len(old) and len(set(new) - set(old)) <= 0.05 * len(old)
    assert rows(cache.scan("leads")) == want and cache.scan("leads").where("name = 'new'").count() == 100
    ranges = sorted((f["low"], f["high"]) for f in new.values())
    assert all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))
    # A delete and keys beyond both ends.
    cache.write_changes("leads", leads(spark, 7, 8, None, True).union(leads(spark, 200_000, 201_700)).union(leads(spark, -5, 0)), 2)
    want = rows(cache.scan("leads"))
    cache.compact("leads")
    assert rows(cache.scan("leads")) == want and len(set(new) - set(files(cache, "leads"))) <= 4
    cache.write_changes("leads", leads(spark, 0, 1, None, True), 3)
    assert cache.compact("leads", whole=True) == 3 and not set(new) & set(files(cache, "leads"))
    assert cache.scan("leads").count() == len(want) - 1


@pytest.mark.parametrize("seed", range(3))
def test_any_changes_fold_as_they_read(spark, tmp_path, seed):
    """Blocks are clustered by schedule: deletes name no schedule, a hot schedule fills files, blocks move."""
    choose, cache = random.Random(seed), Cache(spark, str(tmp_path), rows_per_file=20)
    kinds = "id long, schedule_id long, iso8601_start_time timestamp, iso8601_end_time timestamp, schedule_rate long, deleted boolean"
    for batch in range(4):
        some = []
        for key in choose.sample(range(300), 300 if batch == 0 else choose.choice([1, 40])):
            gone = batch > 0 and choose.random() < 0.4
            some.append((key, None if gone else 77 if key % 3 == 0 else choose.randrange(100), None, None, batch, gone))
        cache.write_changes("schedule_blocks", spark.createDataFrame(some, kinds), batch)
        want = rows(cache.scan("schedule_blocks"))
        cache.compact("schedule_blocks")
        assert rows(cache.scan("schedule_blocks")) == want and cache.snapshot(["schedule_blocks"]).logs["schedule_blocks"] == []


def test_range_of_a_key(spark):
    lows = [-3, 4, 9, 100, 101]
    keys = spark.createDataFrame([(None,)] + [(k,) for k in range(-10, 110)], "k long")
    got = {r.k: r.n for r in keys.select("k", range_of(F.col("k"), lows).alias("n")).collect()}
    assert got == {k: max([0, *(n for n, low in enumerate(lows) if k is not None and low <= k)]) for k in got}
    assert {r.n for r in keys.select(range_of(F.col("k"), [5]).alias("n")).collect()} == {0}
