import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from recordtide.functions.names import column_name, snake_case, spelling_key
from recordtide.functions.scalars import (
    content_hash,
    decode_reference,
    enum_domain,
    is_stale,
    parse_id,
    parse_rfc3339_utc,
    split_once,
)
from recordtide.schemas import JOB_TYPES


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")


def column(df, expression):
    return [row[1] for row in sorted(df.select("i", expression.alias("v")).collect())]


def test_parse_id(spark):
    cases = {
        "7": 7, "+7": 7, "-7": -7, "007": 7, "-0": 0, "": None, "+": None, " 7": None, "7 ": None, "7\n": None,
        "1.5": None, "1e3": None, "x": None, "٣": None, None: None,
        "9223372036854775807": 2**63 - 1, "9223372036854775808": None, "-9223372036854775808": -(2**63),
    }
    assert column(texts(spark, cases), parse_id(F.col("t"))) == list(cases.values())


def test_parse_id_fails_the_job_on_request(spark):
    assert column(texts(spark, ["12"]), parse_id(F.col("t"), "fail")) == [12]
    for bad in ("x", None):
        with pytest.raises(PySparkException, match="not a 64-bit integer"):
            column(texts(spark, [bad]), parse_id(F.col("t"), "fail"))


def test_parse_rfc3339(spark):
    def at(*parts):
        return dt.datetime(*parts, tzinfo=dt.timezone.utc)

    cases = {
        "2024-05-01T10:00:00+10:00": at(2024, 5, 1),
        "2024-05-01T10:00:00Z": at(2024, 5, 1, 10),
        "2024-05-01t10:00:00z": at(2024, 5, 1, 10),
        "2024-05-01 10:00:00-00:30": at(2024, 5, 1, 10, 30),
        "2024-05-01T10:00:00.5Z": at(2024, 5, 1, 10, 0, 0, 500000),
        "2024-05-01T10:00:00.123456789012345Z": at(2024, 5, 1, 10, 0, 0, 123456),
        "2024-05-01t10:00:00.123456789z": at(2024, 5, 1, 10, 0, 0, 123456),
        "2024-05-01T10:00:00+23:59": at(2024, 4, 30, 10, 1),
        "2024-05-01T10:00:00-18:30": at(2024, 5, 2, 4, 30),
        "2024-05-01T10:00:00−10:00": at(2024, 5, 1, 20),
        "2016-12-31T23:59:60Z": at(2017, 1, 1),
        "2016-12-31T23:59:60.25+00:00": at(2017, 1, 1, 0, 0, 0, 250000),
        "2024-05-01T10:00:00": None,
        "2024-05-01": None,
        "": None,
        None: None,
        "2024-05-01T10:00Z": None,
        "2024-05-01T10:00:00+1000": None,
        "2024-05-01T10:00:00+24:00": None,
        "2024-05-01T10:00:00+10:60": None,
        "2024-05-01T24:00:00Z": None,
        "2024-02-30T10:00:00Z": None,
        "2024-13-01T10:00:00Z": None,
        "2024-05-01T10:00:61Z": None,
        "2024-05-01T10:00:00.Z": None,
        "2024-05-01T10:00:00Z\n": None,
        "24-05-01T10:00:00Z": None,
    }
    for zone in ("UTC", "America/New_York"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        try:
            got = column(texts(spark, cases), F.unix_micros(parse_rfc3339_utc(F.col("t"))))
        finally:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        epoch = at(1970, 1, 1)
        want = [None if v is None else (v - epoch) // dt.timedelta(microseconds=1) for v in cases.values()]
        assert dict(zip(cases, got)) == dict(zip(cases, want))


def test_split_once(spark):
    cases = {
        "12-34": (12, 34), "12-34-5": (12, None), "-5-3": (None, None), "x-34": (None, 34), "1234": (None, None),
        "12-": (12, None), "": (None, None), "-": (None, None), "12--3": (12, -3), None: (None, None),
    }
    first, second = split_once(F.col("t"))
    assert list(zip(column(texts(spark, cases), first), column(texts(spark, cases), second))) == list(cases.values())


def test_decode_reference(spark):
    cases = [
        ("activity", "42", (None, None, 42, None, None, True)),
        ("lead", "42", (None, None, None, None, 42, True)),
        ("activity", "4x", (None, None, None, None, None, False)),
        ("lead", "", (None, None, None, None, None, False)),
        ("activity", " 42", (None, None, None, None, None, False)),
        ("activity", None, (None, None, None, None, None, False)),
        ("job", "12-34", (12, 34, None, None, None, True)),
        ("job", "12-34-5", (12, None, None, None, None, True)),
        ("job", "1234", (None, None, None, None, None, True)),
        ("quote", "x-34", (None, 34, None, None, None, True)),
        ("quote", "7-34", (None, 34, None, 7, None, True)),
    ]
    df = spark.createDataFrame([(i, k, r) for i, (k, r, _) in enumerate(cases)], "i int, k string, r string")
    decoded = decode_reference(F.col("k"), F.col("r"))
    rows = df.select("i", *[c.alias(n) for n, c in decoded.items()]).orderBy("i").collect()
    assert [tuple(row)[1:] for row in rows] == [want for *_, want in cases]


def test_enum_domain(spark):
    df = texts(spark, ["Project", "project", "", None])
    assert column(df, enum_domain(F.col("t"), JOB_TYPES)) == ["Project", None, None, None]
    with pytest.raises(PySparkException, match="not in domain: project"):
        column(texts(spark, ["project"]), enum_domain(F.col("t"), JOB_TYPES, "fail"))


def test_is_stale(spark):
    now = F.lit("2024-05-11T00:00:00Z").cast("timestamp")
    cases = {
        "2024-05-01T00:00:00Z": False, "2024-04-30T23:59:59Z": True, "2024-04-30T23:59:59": True,
        "2024-05-01T10:00:00+10:00": False, "2024-05-01T09:59:59+10:00": True, "2024-04-30": True, "2024-05-01": False,
        "2030-01-01T00:00:00Z": False, "": False, "null": False, "soon": False, None: False,
    }
    assert dict(zip(cases, column(texts(spark, cases), is_stale(F.col("t"), now)))) == cases


def test_content_hash_ignores_field_order_but_not_nulls(spark):
    a = spark.sql("SELECT 1 AS x, named_struct('p', 1, 'q', array(named_struct('m', 1, 'n', 'é'))) AS s")
    b = spark.sql("SELECT named_struct('q', array(named_struct('n', 'é', 'm', 1)), 'p', 1) AS s, 1 AS x")
    c = spark.sql("SELECT named_struct('q', array(named_struct('n', 'é', 'm', 1)), 'p', null) AS s, 1 AS x")
    d = spark.sql("SELECT named_struct('q', array(named_struct('n', 'é', 'm', 1))) AS s, 1 AS x")
    digests = [df.select(content_hash(df)).first()[0] for df in (a, b, c, d)]
    assert digests[0] == digests[1] and len(set(digests)) == 3


@pytest.mark.parametrize(
    "name, want",
    [
        ("SiteID", "site_id"), ("Name", "name"), ("default", "_default"), ("EndDate", "end_date"), ("Type", "_type"),
        ("ISO8601StartTime", "iso8601_start_time"), ("WorkOrder", "work_order"), ("companyId", "company_id"),
        ("XMLParser", "xml_parser"), ("ID", "id"), ("Date", "_date"), ("DateModified", "date_modified"),
    ],
)
def test_column_name(name, want):
    assert column_name(name) == want


def test_spelling():
    assert spelling_key(snake_case("IsAuthorized")) == spelling_key(snake_case("IsAuthorised"))
