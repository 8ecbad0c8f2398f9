"""The cache on storage and the streaming drain that fills it."""

import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from recordtide.operators.joins import orphan_check
from recordtide.operators.read_api import within_range
from recordtide.schemas import CACHE_TABLES, LOAD_LEVELS
from recordtide.session import cut_lineage, shared_folder, work_folder
from recordtide.sources.cache import Cache, cache_scan
from recordtide.sources.notifications import notification_source
from recordtide.sources.records import record_scan
from recordtide.streaming.drain import CacheSync, cache_upsert_sink, drain_batch

SECRET = "test key"
STAMP = "2024-05-01T00:00:00Z"


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def note(identifier, reference, stamp=STAMP, secret=SECRET):
    body = json.dumps({"ID": identifier, "reference": reference, "date_triggered": stamp})
    return {"signature": hmac.new(secret.encode(), body.encode(), hashlib.sha1).hexdigest(), "body": body}


def job(number, site, stamp=STAMP, **changes):
    return {
        "ID": str(number), "Name": f"Job {number}", "DateModified": stamp, "Stage": "Open", "Type": "Service",
        "Customer": {"ID": "1", "CompanyName": "Acme"}, "Site": {"ID": str(site), "Name": "s"},
        "Status": {"ID": "5", "Name": "New", "Color": "red"}, **changes,
    }


def site(number, city="Town", stamp=STAMP):
    return {
        "ID": str(number), "Name": "s", "DateModified": stamp,
        "Address": {"Address": "1 Road", "City": city, "Country": "AU", "PostalCode": "4000"},
    }


def schedule(number, kind, reference, blocks=0, staff=2, stamp=STAMP):
    rate = {"ID": "9", "Name": "Normal"}
    items = [
        {"ISO8601StartTime": f"2024-05-01T0{i}:00:00Z", "ISO8601EndTime": f"2024-05-01T0{i}:30:00Z", "ScheduleRate": rate}
        for i in range(blocks)
    ]
    return {
        "ID": str(number), "Date": "2024-05-01", "DateModified": stamp, "Notes": "", "Reference": reference, "Type": kind,
        "Staff": {"ID": str(staff), "Name": f"Staff {staff}"}, "Blocks": items,
    }


class World:
    """Landing folders, cache and sync job of one test."""

    def __init__(self, spark, root):
        self.spark, self.root, self.files = spark, root, 0
        self.cache = Cache(spark, f"{root}/cache")
        for resource in ("job", "site", "schedule", "employee", "activity", "cost_center", "quote", "lead"):
            (root / "records" / resource).mkdir(parents=True)
        (root / "landed").mkdir()
        self.sync = CacheSync(
            self.cache, lambda name: record_scan(spark, f"{root}/records", name, landed=True), SECRET, f"{root}/rejects"
        )

    def _write(self, folder, items):
        self.files += 1
        hidden = self.root / folder / f"_{self.files}"
        hidden.write_text("\n".join(json.dumps(item) for item in items))
        hidden.rename(self.root / folder / f"{self.files:04d}.json")

    def land(self, resource, *records):
        self._write(f"records/{resource}", records)

    def notify(self, *notes):
        self._write("landed", notes)

    def drain(self, handle=None):
        stream = notification_source(self.spark, f"{self.root}/landed", stream=True)
        start = cache_upsert_sink if handle is None else drain_batch
        query = start(stream, handle or self.sync, f"{self.root}/checkpoint")
        query.awaitTermination()
        return [p["batchId"] for p in query.recentProgress if p["numInputRows"]]

    def ids(self, table):
        return [r.id for r in self.cache.scan(table).orderBy("id").collect()]


@pytest.fixture
def world(spark, tmp_path):
    made = World(spark, tmp_path)
    made.land("employee", {"ID": "2", "Name": "Kim", "Position": "x"})
    made.land("site", site(1), site(2))
    made.land("job", job(10, 1), job(11, 2), job(12, 99))
    made.land("cost_center", {"ID": "40", "Name": "Labour"})
    made.land("activity", {"ID": "30", "Name": "Lunch"})
    made.land("lead", {"ID": "60", "Name": "Lead"})
    made.land("quote", {"ID": "70", "Name": "Quote"})
    made.land(
        "schedule", schedule(100, "job", "10-40", 2), schedule(101, "activity", "30"), schedule(102, "lead", "60", staff=3),
        schedule(103, "quote", "70-40", 1), schedule(104, "activity", "3x"),
    )
    return made


def test_one_batch_loads_everything_referenced(world):
    world.notify(*[note("schedule.created", {"scheduleID": i}) for i in (100, 101, 102, 103, 104, 999)])
    assert world.drain() == [0]
    want = {
        "schedules": [100, 101, 102, 103], "jobs": [10], "sites": [1], "employees": [2, 3], "activities": [30],
        "cost_centers": [40], "quotes": [70], "leads": [60], "job_statuses": [5], "schedule_rates": [9],
    }
    assert {name: world.ids(name) for name in want} == want
    assert rows(world.cache.scan("employees")) == [(2, "Kim"), (3, "Staff 3")]
    assert world.cache.scan("schedule_blocks").count() == 3
    assert rows(orphan_check(world.cache.tables())) == []
    bad = world.spark.read.parquet(f"{world.root}/rejects/records").select("table", "id", "reject_columns")
    assert rows(bad) == [("schedules", 104, ["reference"])]


def test_batches_update_delete_and_recreate(world):
    world.notify(note("schedule.created", {"scheduleID": 100}), note("site.created", {"siteID": 2}))
    assert world.drain() == [0] and world.ids("sites") == [1, 2]
    assert world.drain() == []

    later = "2024-05-02T00:00:00Z"
    world.land("site", site(2, "New Town", later))
    world.land("schedule", schedule(100, "job", "11-40", 1, stamp=later))
    world.notify(
        note("site.updated", {"siteID": 2}, later), note("schedule.updated", {"scheduleID": 100}, later),
        note("site.deleted", {"siteID": 1}, later),
    )
    assert world.drain() == [1]
    assert rows(world.cache.scan("sites").select("id", "address_city")) == [(2, "New Town")]
    assert rows(world.cache.scan("schedules").select("id", "job_id")) == [(100, 11)]
    assert world.cache.scan("schedule_blocks").count() == 1

    world.notify(note("site.created", {"siteID": 1}), note("schedule.deleted", {"scheduleID": 100}))
    assert world.drain() == [2]
    assert world.ids("sites") == [1, 2] and world.ids("schedules") == []
    assert world.cache.scan("schedule_blocks").count() == 0


def test_collapse_decides_within_a_batch(world):
    world.notify(
        note("site.deleted", {"siteID": 1}, "2024-05-01T00:00:02Z"), note("site.updated", {"siteID": 1}, "2024-05-01T00:00:01Z"),
        note("job.updated", {"jobID": 10}),
    )
    world.drain()
    assert world.ids("sites") == [] and world.ids("jobs") == [10]
    assert rows(orphan_check(world.cache.tables())) == [("jobs", 10, "site_id", "sites", 1)]


def test_rejects_go_to_the_dead_letter_table(world):
    world.notify(
        note("site.created", {"siteID": 1}), note("site.created", {"siteID": 2}, secret="wrong"), {"body": "{}"},
        note("quote.created", {"siteID": 1}), note("site.created", {"siteID": 2, "companyID": 4}),
    )
    world.drain()
    reasons = world.spark.read.parquet(f"{world.root}/rejects/notifications").select("reject_reason")
    assert rows(reasons) == [("missing_resource",), ("missing_signature",), ("signature_mismatch",)]
    assert world.ids("sites") == [1]


def test_a_lost_batch_comes_back_whole(world):
    """Fails after half of the tables are written; the replay ends as if nothing happened."""
    world.notify(note("schedule.created", {"scheduleID": 100}), note("site.created", {"siteID": 2}))
    write, seen = world.cache.write_changes, []

    def broken(table, changes, batch_id):
        if table == "jobs":
            raise RuntimeError("lost")
        seen.append(table)
        write(table, changes, batch_id)

    world.cache.write_changes = broken
    with pytest.raises(Exception, match="lost"):
        world.drain()
    assert set(seen) <= set(LOAD_LEVELS[0]) and world.ids("jobs") == []
    world.cache.write_changes = write
    assert world.drain() == [0]
    assert world.ids("jobs") == [10] and world.ids("sites") == [1, 2] and world.ids("schedules") == [100]
    assert world.drain() == []


def test_stream_equals_batch(world, spark, tmp_path_factory):
    notes = [note("schedule.created", {"scheduleID": i}) for i in (100, 101, 103)] + [note("job.updated", {"jobID": 11})]
    world.notify(*notes)
    world.drain()
    other = Cache(spark, str(tmp_path_factory.mktemp("batch")))
    sync = CacheSync(other, world.sync.records, SECRET, f"{other.root}/rejects")
    sync(notification_source(spark, f"{world.root}/landed"), 0)
    sync(notification_source(spark, f"{world.root}/landed"), 0)
    for name in CACHE_TABLES:
        assert rows(other.scan(name)) == rows(world.cache.scan(name)), name


def test_drain_hands_over_each_notification_once(world):
    batches = []
    handle = lambda batch, number: batches.append((number, batch.count()))
    world.notify(*[note("site.created", {"siteID": i}) for i in range(3)])
    world.drain(handle)
    world.notify(note("site.created", {"siteID": 9}))
    world.drain(handle)
    world.drain(handle)
    assert batches == [(0, 3), (1, 1)]


def test_timed_drain_runs_until_stopped(world):
    counts = []
    stream = notification_source(world.spark, f"{world.root}/landed", stream=True)
    world.notify(note("site.created", {"siteID": 1}))
    query = drain_batch(stream, lambda batch, _: counts.append(batch.count()), f"{world.root}/timed", minutes=0.01)
    query.processAllAvailable()
    assert query.isActive and counts == [1]
    query.stop()


def changes(spark, *items):
    return spark.createDataFrame(list(items), "id long, name string, deleted boolean")


def test_cache_replay_and_compaction(spark, tmp_path):
    cache = Cache(spark, str(tmp_path))
    assert rows(cache.scan("leads")) == []
    cache.write_changes("leads", changes(spark, (1, "a", False), (2, "b", False)), 0)
    cache.write_changes("leads", changes(spark, (1, None, True), (3, "c", False)), 1)
    want = [(2, "b"), (3, "c")]
    assert rows(cache.scan("leads")) == want
    cache.write_changes("leads", changes(spark, (1, None, True), (3, "c", False)), 1)
    assert rows(cache.scan("leads")) == want and cache.log("leads").count() == 4
    assert rows(cache.scan("leads", before=1)) == [(1, "a"), (2, "b")]

    assert cache.compact("leads") == 1 and rows(cache.scan("leads")) == want
    cache.write_changes("leads", changes(spark, (1, "again", False), (2, "B", False)), 2)
    assert rows(cache_scan(spark, cache.root, "leads")) == [(1, "again"), (2, "B"), (3, "c")]
    assert cache.compact("leads") == 2 and cache.compact("leads") == 2
    assert rows(cache.scan("leads")) == [(1, "again"), (2, "B"), (3, "c")]


def test_compacted_log_is_not_read(spark, tmp_path, capsys):
    cache = Cache(spark, str(tmp_path))
    cache.write_changes("leads", changes(spark, (1, "a", False)), 0)
    cache.compact("leads")
    cache.write_changes("leads", changes(spark, (2, "b", False)), 1)
    cache.scan("leads").explain("formatted")
    shown = capsys.readouterr().out
    assert "PartitionFilters: [isnotnull(batch_id" in shown and "(batch_id" in shown
    assert "BroadcastHashJoin" in shown, "changed keys are small by file size, so the base is not shuffled"


def test_working_folders(spark):
    assert work_folder(spark, "x").startswith(shared_folder(spark)) and work_folder(spark, "x") != work_folder(spark, "x")
    cut = cut_lineage(spark.range(5).where("id > 7"))
    assert cut.count() == 0 and cut.columns == ["id"]

    class Remote:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Remote)
    Remote.sparkContext.master = "local[2]"
    assert shared_folder(Remote).startswith("/tmp/run-")


def test_key_range_reaches_the_base_scan(spark, tmp_path, capsys):
    cache = Cache(spark, str(tmp_path))
    blocks = spark.range(2000).selectExpr(
        "id", "pmod(xxhash64(id), 500) schedule_id", "timestamp_micros(id) iso8601_start_time",
        "timestamp_micros(id) iso8601_end_time", "1L schedule_rate", "false deleted",
    )
    cache.write_changes("schedule_blocks", blocks, 0)
    cache.compact("schedule_blocks")
    some = spark.createDataFrame([(7,), (9,)], "id long")
    near = within_range(cache.scan("schedule_blocks"), "schedule_id", some)
    assert rows(near.select("id")) == rows(blocks.where("schedule_id between 7 and 9").select("id"))
    near.explain("formatted")
    assert "GreaterThanOrEqual(schedule_id,7), LessThanOrEqual(schedule_id,9)" in capsys.readouterr().out
    assert rows(within_range(cache.scan("schedule_blocks"), "schedule_id", some.where("id < 0"))) == []


def test_record_that_lands_after_its_notification(world):
    """An accepted id without a record waits; replaying the batch changes nothing; a delete clears it."""
    world.notify(note("site.created", {"siteID": 777}), note("site.created", {"siteID": 778}))
    world.drain()
    assert world.ids("sites") == [] and {r.id for r in world.cache.pending().collect()} == {777, 778}
    world.land("site", site(777), site(778))
    world.notify(note("site.deleted", {"siteID": 778}))
    world.drain()
    assert world.ids("sites") == [777] and world.cache.pending().collect() == []


def test_later_landed_version_wins_without_a_modification_date(world):
    world.land("employee", {"ID": "2", "Name": "Amy", "Position": "x"})
    world.notify(note("schedule.created", {"scheduleID": 100}))
    world.drain()
    assert [r.name for r in world.cache.scan("employees").where("id = 2").collect()] == ["Amy"]
