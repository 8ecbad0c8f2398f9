"""Strict scalar parsing over texts derived from the sample tables."""

from pyspark.sql import functions as F

from recordtide.functions.scalars import (
    content_hash,
    decode_reference,
    enum_domain,
    is_stale,
    parse_id,
    parse_rfc3339_utc,
    split_once,
)
from recordtide.plans.registry import query
from recordtide.plans.sql import SCHEDULE_ROWS, with_ctes
from recordtide.plans.standins import job_records, micros, schedule_records, table
from recordtide.schemas import JOB_TYPES

# Every spelling the parser must tell apart, chosen per row.
_ID_TEXT = """CASE l_linenumber WHEN 1 THEN concat('+', l_orderkey) WHEN 2 THEN concat('-', l_orderkey)
    WHEN 3 THEN concat(' ', l_orderkey) WHEN 4 THEN concat(l_orderkey, '.5') WHEN 5 THEN concat(l_orderkey, 'x')
    WHEN 6 THEN concat('00', l_orderkey) ELSE concat(l_orderkey, '99999999999999999999') END"""


@query(
    "parse_id",
    f"""SELECT l_linenumber, l_orderkey, id_text,
               CASE WHEN regexp_full_match(id_text, '[+-]?[0-9]+') THEN try_cast(id_text AS BIGINT) END AS id
        FROM (SELECT l_linenumber, l_orderkey, {_ID_TEXT} AS id_text FROM lineitem)""",
)
def ids(spark, sf_dir):
    texts = table(spark, sf_dir, "lineitem").select("l_linenumber", "l_orderkey", F.expr(_ID_TEXT).alias("id_text"))
    return texts.withColumn("id", parse_id(F.col("id_text")))


@query(
    "parse_rfc3339_utc",
    """SELECT event_id, CASE event_id % 8
          WHEN 0 THEN epoch_us(date_trunc('second', ts))
          WHEN 1 THEN epoch_us(ts)
          WHEN 2 THEN epoch_us(date_trunc('second', ts)) - 36000000000
          WHEN 3 THEN epoch_us(date_trunc('second', ts)) + 82800000000
          WHEN 4 THEN epoch_us(date_trunc('second', ts)) - 34200000000
          ELSE NULL END AS instant FROM events""",
)
def stamps(spark, sf_dir):
    text = """CASE event_id % 8
        WHEN 0 THEN concat(lower(second), 'z') WHEN 1 THEN concat(full, '9Z') WHEN 2 THEN concat(second, '+10:00')
        WHEN 3 THEN concat(replace(second, 'T', ' '), '-23:00') WHEN 4 THEN concat(second, '+09:30')
        WHEN 5 THEN second WHEN 6 THEN substr(second, 1, 10) ELSE concat(second, '+1000') END"""
    parts = table(spark, sf_dir, "events").select(
        "event_id",
        F.expr("replace(substr(cast(ts AS string), 1, 19), ' ', 'T')").alias("second"),
        F.expr("replace(rpad(concat(cast(ts AS string), CASE WHEN length(cast(ts AS string)) = 19 THEN '.' ELSE '' END), 26, '0'), ' ', 'T')").alias("full"),
    )
    return parts.select("event_id", micros(parse_rfc3339_utc(F.expr(text))).alias("instant"))


_SPLIT_TEXT = """CASE l_linenumber WHEN 1 THEN concat(l_orderkey, '-', l_partkey, '-5') WHEN 2 THEN concat('-', l_orderkey, '-3')
    WHEN 3 THEN concat('x-', l_partkey) WHEN 4 THEN cast(l_orderkey AS varchar(40)) WHEN 5 THEN concat(l_orderkey, '-')
    ELSE concat(l_orderkey, '-', l_partkey) END"""


@query(
    "split_once",
    """SELECT l_linenumber, l_orderkey, l_partkey,
              CASE WHEN l_linenumber NOT IN (2, 3, 4) THEN l_orderkey END AS first_id,
              CASE WHEN l_linenumber NOT IN (1, 2, 4, 5) THEN l_partkey END AS second_id FROM lineitem""",
)
def split(spark, sf_dir):
    first, second = split_once(F.col("text"))
    return table(spark, sf_dir, "lineitem").withColumn("text", F.expr(_SPLIT_TEXT)).select(
        "l_linenumber", "l_orderkey", "l_partkey", first.alias("first_id"), second.alias("second_id")
    )


@query(
    "decode_reference",
    with_ctes(SCHEDULE_ROWS)
    + """SELECT id, job_id, cost_center_id, activity_id, quote_id, lead_id,
                NOT contains(reject_columns, 'reference') AS reference_valid FROM schedule_rows""",
)
def reference(spark, sf_dir):
    decoded = decode_reference(F.col("Type"), F.col("Reference"))
    return schedule_records(spark, sf_dir).select(
        parse_id(F.col("ID")).alias("id"), *[column.alias(name) for name, column in decoded.items()]
    )


@query(
    "enum_domain",
    """SELECT o_orderkey::VARCHAR AS id, CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'Project'
              WHEN o_orderkey % 3 = 1 THEN 'Service' ELSE 'Prepaid' END AS job_type FROM orders""",
)
def domain(spark, sf_dir):
    return job_records(spark, sf_dir).select(F.col("ID").alias("id"), enum_domain(F.col("Type"), JOB_TYPES).alias("job_type"))


@query(
    "is_stale",
    """SELECT event_id, event_id % 11 <> 0 AND event_id % 13 <> 0 AND
              epoch(TIMESTAMP '2024-01-20 12:00:00') - epoch(date_trunc('second', ts)) > 864000 AS stale FROM events""",
)
def stale(spark, sf_dir):
    text = """CASE WHEN event_id % 11 = 0 THEN 'null' WHEN event_id % 13 = 0 THEN ''
                   ELSE concat(replace(cast(ts AS string), ' ', 'T'), 'Z') END"""
    now = F.lit("2024-01-20T12:00:00Z").cast("timestamp")
    return table(spark, sf_dir, "events").select("event_id", is_stale(F.expr(text), now).alias("stale"))


@query(
    "content_hash",
    """SELECT o_orderkey, sha256('{"nested":{"a":"' || o_orderstatus || '","b":' || o_custkey || '},"o_custkey":' || o_custkey
              || ',"o_orderkey":' || o_orderkey || ',"o_orderpriority":' ||
              CASE WHEN o_orderkey % 5 = 0 THEN 'null' ELSE '"' || o_orderpriority || '"' END || '}') AS digest FROM orders""",
)
def digest(spark, sf_dir):
    content = table(spark, sf_dir, "orders").select(
        F.expr("CASE WHEN o_orderkey % 5 <> 0 THEN o_orderpriority END").alias("o_orderpriority"),
        "o_orderkey",
        F.struct(F.col("o_custkey").alias("b"), F.col("o_orderstatus").alias("a")).alias("nested"),
        "o_custkey",
    )
    return content.select("o_orderkey", content_hash(content).alias("digest"))
