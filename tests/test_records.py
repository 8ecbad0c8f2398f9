import datetime as dt
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from recordtide.operators.nested import (
    accepted_rows,
    array_to_child,
    array_to_junction,
    declared_junction,
    derived_rows,
    explode_blocks,
    rejected_rows,
    rows_from_record,
)
from recordtide.operators.project import (
    columns_to_include,
    exclude_columns,
    field_allowlist,
    flatten_struct,
    json_fallback,
    normalise_names,
    promote_temporal,
    select_columns,
    struct_to_fk,
    to_columns,
)
from recordtide.schemas import CACHE_TABLES, RECORDS, RESOURCE_TABLES
from recordtide.sources.records import land_records, record_scan

STAMP = "2024-05-01T10:00:00+10:00"
UTC = dt.datetime(2024, 5, 1)

JOB = {
    "ID": "7", "Name": "Roof", "DateModified": STAMP, "Description": None, "Stage": "Open", "Type": "Service",
    "Customer": {"ID": "3", "CompanyName": "Acme"}, "Site": {"ID": "4", "Name": "Yard"},
    "Status": {"ID": "5", "Name": "New", "Color": "red"},
}
BLOCK = {
    "ISO8601StartTime": STAMP, "ISO8601EndTime": "2024-05-01T12:00:00+10:00", "StartTime": "10:00", "EndTime": "12:00",
    "Hrs": 2, "ScheduleRate": {"ID": "9", "Name": "Normal"},
}
SCHEDULE = {
    "ID": "11", "Date": "2024-05-01", "DateModified": STAMP, "Notes": "n", "Reference": "7-8", "Type": "job",
    "Staff": {"ID": "2", "Name": "Kim"}, "Blocks": [BLOCK, BLOCK],
}
SITE = {
    "ID": "4", "Name": "Yard", "DateModified": STAMP,
    "Address": {"Address": "1 Road", "City": "Town", "Country": None, "PostalCode": "4000", "State": "QLD"},
}


@pytest.fixture
def land(spark, tmp_path):
    def write(resource, *records):
        folder = tmp_path / resource
        folder.mkdir(exist_ok=True)
        name = f"{len(list(folder.iterdir()))}.json"
        (folder / name).write_text("\n".join(json.dumps(record) for record in records))
        return record_scan(spark, str(tmp_path), resource)

    return write


def test_record_scan_reads_lines_and_pages(spark, land, tmp_path):
    assert land("job", JOB, {**JOB, "ID": "8", "Unknown": 1}).count() == 2
    (tmp_path / "site").mkdir()
    (tmp_path / "site" / "page.json").write_text(json.dumps([SITE, SITE], indent=1))
    pages = record_scan(spark, str(tmp_path), "site", pages=True)
    assert pages.count() == 2 and pages.schema == RECORDS["site"]


def test_all_nine_resources_have_a_schema():
    assert set(RECORDS) == {*RESOURCE_TABLES, "customer"}


def test_job_row(land):
    row = rows_from_record(land("job", JOB), "job").first()
    assert row.asDict() == {
        "id": 7, "customer_company_name": "Acme", "date_modified": UTC, "description": "", "name": "Roof", "site_id": 4,
        "stage": "Open", "status_id": 5, "job_type": "Service", "reject_columns": [],
    }


def test_schedule_row(land):
    row = rows_from_record(land("schedule", SCHEDULE), "schedule").first()
    assert row.asDict() == {
        "id": 11, "date_modified": UTC, "staff_id": 2, "schedule_type": "job", "notes": "n", "job_id": 7,
        "cost_center_id": 8, "activity_id": None, "quote_id": None, "lead_id": None, "reject_columns": [],
    }


def test_site_row_allows_what_the_table_allows(land):
    row = rows_from_record(land("site", {**SITE, "DateModified": None}), "site").first()
    assert row.address_country is None and row.date_modified is None and row.reject_columns == []
    bad = {**SITE, "Address": {**SITE["Address"], "PostalCode": None}}
    assert rejected_rows(rows_from_record(land("site", bad), "site")).first().reject_columns == ["address_postal_code"]


@pytest.mark.parametrize("resource", ["activity", "employee", "cost_center", "quote", "lead"])
def test_named_rows(land, resource):
    rows = rows_from_record(land(resource, {"ID": "1", "Name": "x"}, {"ID": "1.5", "Name": None}), resource)
    assert accepted_rows(rows).columns == CACHE_TABLES[RESOURCE_TABLES[resource]].names
    assert rejected_rows(rows).first().reject_columns == ["id", "name"]


def test_one_bad_row_does_not_stop_the_rest_unless_asked(land):
    jobs = land("job", JOB, {**JOB, "ID": "x", "Type": "Other", "DateModified": "2024-05-01"})
    rows = rows_from_record(jobs, "job")
    assert accepted_rows(rows).count() == 1
    assert rejected_rows(rows).first().reject_columns == ["id", "date_modified", "job_type"]
    with pytest.raises(PySparkException, match="bad job record: id,date_modified,job_type"):
        rows_from_record(jobs, "job", "fail").collect()


def test_unreadable_line_is_rejected(spark, tmp_path):
    (tmp_path / "quote").mkdir()
    (tmp_path / "quote" / "a.json").write_text('{"ID": "1", "Name": "x"}\n{"ID": \n{"ID": 2, "Name": 3}\n')
    rows = rows_from_record(record_scan(spark, str(tmp_path), "quote"), "quote")
    assert sorted(map(tuple, accepted_rows(rows).collect())) == [(1, "x"), (2, "3")]
    assert [r.reject_columns for r in rejected_rows(rows).collect()] == [["id", "name"]]


def test_bad_reference_rejects(land):
    rows = rows_from_record(land("schedule", {**SCHEDULE, "Type": "activity", "Reference": "4x"}), "schedule")
    assert rejected_rows(rows).first().reject_columns == ["reference"]


def test_blocks(land):
    schedules = land("schedule", SCHEDULE, {**SCHEDULE, "ID": "12", "Blocks": []}, {**SCHEDULE, "ID": "13", "Blocks": None})
    blocks = explode_blocks(schedules).collect()
    assert len(blocks) == 2 and len({b.id for b in blocks}) == 2
    assert blocks[0].schedule_id == 11 and blocks[0].iso8601_start_time == UTC and blocks[0].schedule_rate == 9
    assert {b.id for b in blocks} == {b.id for b in explode_blocks(schedules).collect()}


def test_block_as_child_table(land):
    child = array_to_child(land("schedule", SCHEDULE), "Blocks", "schedule", "ScheduleBlock")
    assert dict(child.dtypes) == {
        "id": "bigint", "schedule_id": "bigint", "iso8601_start_time": "timestamp", "iso8601_end_time": "timestamp",
        "start_time": "string", "end_time": "string", "hrs": "decimal(38,10)", "schedule_rate_id": "bigint",
    }
    assert child.first().schedule_rate_id == 9


def test_derived_rows(land):
    jobs = land("job", JOB, {**JOB, "ID": "8"}, {**JOB, "ID": "9", "Status": {"ID": "x", "Name": "?", "Color": "?"}})
    assert [tuple(r) for r in derived_rows(jobs, "job")["job_statuses"].collect()] == [(5, "red", "New")]
    found = derived_rows(land("schedule", SCHEDULE), "schedule")
    assert set(found) == {"schedule_rates", "schedule_blocks", "employees"}
    assert tuple(found["schedule_rates"].first()) == (9, "Normal")


def test_array_to_junction(spark):
    jobs = spark.sql(
        """SELECT '1' ID, array(named_struct('ID', '5'), named_struct('ID', '5'), named_struct('ID', 'x')) Staff
           UNION ALL SELECT '1', array(named_struct('ID', '6')) UNION ALL SELECT '2', array()"""
    )
    pairs = array_to_junction(jobs, "Staff", "job", "employee")
    assert pairs.columns == ["job_id", "employee_id"] and sorted(map(tuple, pairs.collect())) == [(1, 5), (1, 6)]


def test_declared_junctions(spark):
    schedules = spark.sql("SELECT 1L id, 7L job_id, null activity_id UNION ALL SELECT 2L, null, 8L")
    assert [tuple(r) for r in declared_junction(schedules, "job_schedules").collect()] == [(1, 7)]
    assert [tuple(r) for r in declared_junction(schedules, "activity_schedules").collect()] == [(8, 2)]


def test_columns_to_include(land):
    assert columns_to_include(land("job", JOB), "job").columns == [
        "ID", "Name", "Description", "DateModified", "Type", "Site", "Stage", "Status"
    ]


def test_included_columns_reach_the_scan(land, capsys):
    columns_to_include(land("site", SITE), "activity").explain()
    assert "ReadSchema: struct<ID:string,Name:string>" in capsys.readouterr().out


def test_field_allowlist_prunes_nested_fields(spark):
    df = spark.sql("SELECT '1' ID, named_struct('ID', '2', 'Name', 'n', 'Phone', 'p') Staff, 'x' Extra, cast(null as string) Type")
    kept = field_allowlist(df, "Schedule")
    assert kept.columns == ["ID", "Staff", "Type"] and kept.schema["Staff"].dataType.names == ["ID", "Name"]
    assert field_allowlist(df, "Unlisted").columns == df.columns


def test_exclude_columns(spark):
    df = spark.sql("SELECT 1 Reference, 2 CreatedBy, 3 Name, 4 Other")
    assert exclude_columns(df, "Job").columns == ["Name", "Other"]
    assert exclude_columns(df, "Job", {"*": ["Name"], "Job": ["Other"], "Site": ["Reference"]}).columns == ["Reference", "CreatedBy"]


def test_flatten_struct(spark):
    df = spark.sql(
        """SELECT 1 ID, named_struct('ID', 5, 'PostalCode', 'x', 'IsAuthorised', true, 'IsAuthorized', false,
                  'ZoneID', 7, 'Geo', named_struct('Lat', 1)) Address, 2 Z"""
    )
    flat = flatten_struct(df, "Address")
    assert flat.columns == ["ID", "address_postal_code", "address_is_authorised", "address_zone_id", "address_geo", "Z"]
    assert flat.first().address_geo == '{"Lat":1}' and flat.first().address_is_authorised is True
    assert "address_postal_code" not in flatten_struct(df, "Address", taken=["address_postal_code"]).columns


def test_struct_to_fk_and_names(spark):
    df = spark.sql("SELECT named_struct('ID', '5') Site, named_struct('ID', 'x') OwnerID, 'a' Type")
    keyed = struct_to_fk(struct_to_fk(df, "Site"), "OwnerID")
    assert normalise_names(keyed).columns == ["site_id", "owner_id", "_type"] and tuple(keyed.first()) == (5, None, "a")


def test_promote_temporal(spark):
    df = spark.sql(f"SELECT '{STAMP}' date_modified, '2024-05-01' _date, 'x' name, 5 update_count")
    promoted = promote_temporal(df)
    assert [kind for _, kind in promoted.dtypes] == ["timestamp", "timestamp", "string", "int"]
    assert tuple(promoted.first()) == (UTC, None, "x", 5)


def test_json_fallback(spark):
    df = spark.sql("SELECT '{ \"a\": [1, 2] }' t, array(1, 2) a, '{' bad")
    row = json_fallback(df, "t", "a", "bad").select(F.to_json("t"), F.to_json("a"), F.col("bad").isNull()).first()
    assert tuple(row) == ('{"a":[1,2]}', "[1,2]", True)


def test_to_columns(land):
    flat = to_columns(land("job", JOB), "Job")
    assert dict(flat.dtypes) == {
        "id": "bigint", "name": "string", "date_modified": "timestamp", "description": "string", "stage": "string",
        "_type": "string", "customer_id": "bigint", "site_id": "bigint", "status_id": "bigint",
    }
    schedule = to_columns(land("schedule", SCHEDULE), "Schedule")
    assert "reference" not in schedule.columns and dict(schedule.dtypes)["blocks"] == "variant"


def test_id_text_of_a_known_entity_becomes_a_key(spark):
    df = spark.sql("SELECT '1' ID, '5' SiteID, '6' ZoneID")
    assert dict(to_columns(df, "Job").dtypes) == {"id": "bigint", "site_id": "bigint", "zone_id": "string"}


def test_select_columns(spark):
    df = spark.sql("SELECT 1 a, 2 b, 3 c")
    assert select_columns(df, " c, a ").columns == ["c", "a"]
    assert select_columns(df, ["b"]).columns == ["b"]
    assert select_columns(df, None).columns == select_columns(df, "").columns == ["a", "b", "c"]


def test_landed_records_are_compressed_in_short_files(spark, tmp_path):
    spark.range(450_000).select(F.col("id").cast("string").alias("ID"), F.lit("a quote").alias("Name")).coalesce(1).write.parquet(f"{tmp_path}/flat")
    land_records(spark.read.parquet(f"{tmp_path}/flat"), str(tmp_path), "quote")
    parts = [part for part in (tmp_path / "quote").iterdir() if part.name.startswith("part-")]
    assert len(parts) >= 3 and sum(part.stat().st_size for part in parts) < 450_000 * 15
    found = record_scan(spark, str(tmp_path), "quote")
    assert found.count() == found.distinct().count() == 450_000
