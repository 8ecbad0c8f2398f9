"""The index of references, and what a batch orphans."""

import random

from pyspark.sql import functions as F

from recordtide.operators.joins import orphan_check
from recordtide.schemas import CACHE_TABLES, edges_of
from recordtide.session import cut_lineage
from recordtide.sources.cache import REFERENCES, Cache
from recordtide.sources.references import ReferenceIndex, batch_orphans
from tests.test_cache_sync import note, rows, world  # noqa: F401

_PARENTS = ("sites", "job_statuses", "schedule_rates", "employees", "quotes")


def _write(spark, cache, batch, changes):
    """``changes``: table -> list of (id, values by column, or None for a delete)."""
    with cache.transaction(batch):
        for table, some in changes.items():
            names = [name for name in CACHE_TABLES[table].names if name != "id"]
            kinds = ", ".join(f"{n} {CACHE_TABLES[table][n].dataType.simpleString()}" for n in ["id", *names])
            lines = [(key, *((values or {}).get(n) for n in names), values is None) for key, values in some]
            cache.write_changes(table, spark.createDataFrame(lines, f"{kinds}, deleted boolean"), batch)
        ReferenceIndex(cache).log_batch(batch)


def _some(choose, batch):
    """Random changes of one batch. Half the references name target 1; some targets never exist."""
    changes = {}
    for table in ("jobs", "schedules", "schedule_blocks", *_PARENTS):
        some = []
        for key in choose.sample(range(1, 9), 8 if batch == 0 else choose.choice([0, 1, 3])):
            gone = choose.random() < (0.2 if batch == 0 else 0.5)
            refs = {e.column: choose.choice([1, 1, 1, choose.randrange(1, 10), None]) for e in edges_of(table)}
            some.append((key, None if gone else refs))
        changes[table] = some
    return changes


def test_report_is_the_difference_of_full_checks(spark, tmp_path):
    choose, cache = random.Random(3), Cache(spark, str(tmp_path), rows_per_file=3)
    index, before = ReferenceIndex(cache), set()
    for batch in range(3):
        _write(spark, cache, batch, _some(choose, batch))
        after = set(rows(orphan_check(cache.tables())))
        assert set(rows(batch_orphans(cache, batch))) == after - before, batch
        before = after
        for table in choose.sample(["jobs", "schedules", "schedule_blocks", *_PARENTS], 2):
            cache.compact(table)
        (index.compact if batch == 0 else index.rebuild)()


def test_moved_blocks_and_renewed_targets(spark, tmp_path):
    cache = Cache(spark, str(tmp_path), rows_per_file=1)
    blocks = [(1, {"schedule_id": 10, "schedule_rate": 7}), (2, {"schedule_id": 20, "schedule_rate": 7})]
    _write(spark, cache, 0, {"schedules": [(10, {}), (20, {})], "schedule_rates": [(8, {})], "schedule_blocks": blocks})
    assert rows(batch_orphans(cache, 0)) == [("schedule_blocks", k, "schedule_rate", "schedule_rates", 7) for k in (1, 2)]
    cache.compact("schedule_blocks")
    # The block moves and keeps its missing rate; nothing is new. Deleting an id that never was orphans nothing.
    _write(spark, cache, 1, {"schedule_blocks": [(1, {"schedule_id": 20, "schedule_rate": 7})], "schedule_rates": [(7, None)]})
    assert rows(batch_orphans(cache, 1)) == []
    _write(spark, cache, 2, {"schedule_rates": [(7, {})], "schedules": [(10, None)]})
    assert rows(batch_orphans(cache, 2)) == []
    _write(spark, cache, 3, {"schedules": [(20, None)], "schedule_rates": [(7, None)], "schedule_blocks": [(2, None)]})
    want = [("schedule_blocks", 1, "schedule_id", "schedules", 20), ("schedule_blocks", 1, "schedule_rate", "schedule_rates", 7)]
    assert rows(batch_orphans(cache, 3)) == want
    _write(spark, cache, 4, {"leads": []})
    assert rows(batch_orphans(cache, 4)) == [] and rows(batch_orphans(cache, 99)) == []


def test_holders_and_files_read(spark, tmp_path):
    cache = Cache(spark, str(tmp_path), rows_per_file=200)
    jobs = spark.range(10_000).select("id", (F.col("id") % 5000).alias("site_id"), F.lit(3).cast("long").alias("status_id"))
    for name in CACHE_TABLES["jobs"].names[1:]:
        if name not in jobs.columns:
            jobs = jobs.withColumn(name, F.lit(None).cast(CACHE_TABLES["jobs"][name].dataType))
    with cache.transaction(0):
        cache.write_changes("jobs", jobs.withColumn("deleted", F.lit(False)), 0)
        ReferenceIndex(cache).log_batch(0)
    cache.compact("jobs")
    index = ReferenceIndex(cache)
    assert index.compact() == 0 and index.compact() == 0
    pairs = spark.createDataFrame([("sites", 17), ("sites", 9999), (None, 5), ("sites", None)], "target string, fk long")
    assert rows(index.holders(pairs)) == [("sites", 17, "jobs", k, "site_id") for k in (17, 5017)]
    now = cache.snapshot([REFERENCES, "jobs"])
    spot = cut_lineage(pairs.limit(1).select(F.xxhash64("target", "fk").alias("spot")))
    assert len(now.bases[REFERENCES]) > 50 and len(now.near(REFERENCES, spot).inputFiles()) <= 2
    near = now.near("jobs", cut_lineage(spark.createDataFrame([(17,), (5017,)], "id long")))
    assert len(now.bases["jobs"]) >= 50 and len(near.inputFiles()) == 2
    # One status is named by all rows: a hot id.
    assert index.holders(spark.createDataFrame([("job_statuses", 3)], "target string, fk long")).count() == 10_000


def test_index_of_an_older_cache(spark, tmp_path):
    cache = Cache(spark, str(tmp_path))
    index = ReferenceIndex(cache)
    cache.write_changes("jobs", spark.createDataFrame([(1, 5, False)], "id long, site_id long, deleted boolean").withColumns(
        {n: F.lit(None) for n in CACHE_TABLES["jobs"].names if n not in ("id", "site_id")}), 0)
    asked = spark.createDataFrame([("sites", 5)], "target string, fk long")
    assert rows(index.holders(asked)) == [] and index.rebuild() == 0
    assert rows(index.holders(asked)) == [("sites", 5, "jobs", 1, "site_id")]


def test_sync_keeps_the_index(world):  # noqa: F811
    world.notify(note("schedule.created", {"scheduleID": 100}))
    world.drain()
    world.notify(note("job.deleted", {"jobID": 10}))
    world.drain()
    last = 1
    assert rows(batch_orphans(world.cache, last)) == [("schedules", 100, "job_id", "jobs", 10)]


def test_a_hot_target_fills_several_files_and_one_batch_moves_once(spark, tmp_path):
    cache = Cache(spark, str(tmp_path), rows_per_file=100_000)
    blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in CACHE_TABLES["jobs"] if f.name not in ("id", "status_id")]
    jobs = spark.range(20_000).select("id", F.lit(3).cast("long").alias("status_id"), *blank, F.lit(False).alias("deleted"))
    with cache.transaction(0):
        cache.write_changes("jobs", jobs, 0)
        ReferenceIndex(cache).log_batch(0)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ReferenceIndex(cache).compact()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    files = cache.snapshot([REFERENCES]).bases[REFERENCES]
    assert len(files) == 8 and sum(f["n_rows"] for f in files) == 20_000
    assert max(f["n_rows"] for f in files) < 10_000  # one key, and no task had most of it
    _write(spark, cache, 1, {"jobs": [(1, {"status_id": 3})], "job_statuses": [(3, None)]})
    ReferenceIndex(cache).compact()
    assert cache.snapshot([REFERENCES]).base(REFERENCES).count() == 20_000  # each entry once
