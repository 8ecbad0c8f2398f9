"""The catalogue once more where one key, text or source holds a third of all rows."""

import duckdb
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as contract
from recordtide.operators.dedup import rewrite_refs
from recordtide.operators.joins import _schedules_with_blocks, fk_join, orphan_check
from recordtide.schemas import edges_of
from recordtide.session import cut_lineage
from tests.conftest import TABLES
from tests.test_catalogue import _rows

SOURCE = "/root/testdata/sf0.001"
HOT = {
    "events": "* REPLACE (CASE WHEN event_id % 3 = 0 THEN 4 ELSE user_id END AS user_id)",
    "orders": "* REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)",
    "lineitem": """* REPLACE (CASE WHEN l_linenumber % 3 = 0 THEN 5 ELSE l_orderkey END AS l_orderkey,
                   CASE WHEN l_linenumber % 3 = 0 THEN 6 ELSE l_partkey END AS l_partkey,
                   CASE WHEN l_linenumber % 3 = 0 THEN 2 ELSE l_suppkey END AS l_suppkey)""",
    "documents": """* REPLACE (CASE WHEN doc_id % 3 = 0 THEN 'the same text' ELSE text END AS text,
                    CASE WHEN doc_id % 3 = 0 THEN 'en' ELSE lang END AS lang)""",
}
HEAVY = (
    "collapse_batch bucket_events dense_buckets sync_sites upsert delete_by_id source_key_conflict fk_join star_join "
    "missing_refs orphan_check fk_closure distinct_fk_ids duplicate_groups pk_duplicates merge_existing_wins "
    "fold_partial_views elect_canonical rewrite_refs dedup_fixpoint constraint_report array_to_junction id_in_list"
).split()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        connection.execute(
            f"COPY (SELECT {HOT.get(name, '*')} FROM '{SOURCE}/{name}.parquet') TO '{folder}/{name}.parquet' (FORMAT parquet)"
        )
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return str(folder), connection


@pytest.mark.parametrize("shuffled", [False, True], ids=["auto", "shuffled"])
@pytest.mark.parametrize("name", HEAVY)
def test_skewed(name, shuffled, spark, skewed):
    folder, connection = skewed
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    if shuffled:
        for key in keys:
            spark.conf.set(key, "-1")
    try:
        frame = contract.queries()[name](spark, folder)
        got = _rows(frame.columns, frame.collect())
    finally:
        for key in keys:
            spark.conf.unset(key)
    expected = connection.execute(contract.oracle_sql()[name])
    assert got == _rows([item[0] for item in expected.description], expected.fetchall())


@pytest.fixture
def sensitive(spark):
    """Adaptive execution that calls 20 kB skewed and broadcasts nothing."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield spark
    for key in settings:
        spark.conf.unset(key)


def _final_plan(frame, capsys):
    frame.collect()
    capsys.readouterr()
    frame.explain()
    return capsys.readouterr().out.split("Initial Plan")[0]


def _hot(spark, column, rows=60_000):
    """A third of the rows has key 1."""
    return spark.range(0, rows, numPartitions=8).selectExpr("id", f"CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS {column}")


@pytest.mark.parametrize("optional", [False, True])
def test_hot_foreign_key_is_split(sensitive, capsys, optional):
    parent = sensitive.range(0, 60_000, numPartitions=8).selectExpr("id", "id * 2 AS v")
    joined = fk_join(_hot(sensitive, "fk"), parent, "fk", "p", optional)
    assert joined.count() == 60_000 and "skew=true" in _final_plan(joined, capsys)


def test_schedule_with_a_third_of_all_blocks_is_split(sensitive, capsys):
    schedules = sensitive.range(0, 70_000, numPartitions=8).selectExpr("id", "'n' AS notes")
    joined = _schedules_with_blocks(schedules, _hot(sensitive, "schedule_id"))
    assert joined.where("block_id IS NOT NULL").count() == 60_000
    assert joined.select("id").distinct().count() == 70_000 and "skew=true" in _final_plan(joined, capsys)


def test_rewritten_hot_reference_is_split(sensitive, capsys):
    remap = cut_lineage(sensitive.range(1, 30_000, 2, numPartitions=8).selectExpr("id AS old", "id - 1 AS new"))
    done = rewrite_refs(_hot(sensitive, "target"), "target", remap, "id")
    assert done.where("target = 0").count() == 20_001 and "skew=true" in _final_plan(done, capsys)


def test_orphans_of_one_hot_missing_key_are_split(sensitive, capsys):
    tables = {"jobs": _hot(sensitive, "site_id").withColumn("status_id", F.lit(None).cast("bigint"))}
    targets = {"sites": sensitive.range(2, 60_000), "job_statuses": sensitive.range(1)}
    found = orphan_check(tables, edges_of("jobs"), targets)
    assert found.count() == 20_001 and "skew=true" in _final_plan(found, capsys)
