"""Domain inputs built from the sample tables: notifications, nested records, cache tables.

Sample events stand for notifications, orders for jobs, line items for schedules,
customers for sites and leads, suppliers for employees, parts for activities and
cost centres. Faults of every kind are worked into the inputs by fixed rules.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtide.functions.signing import hmac_sha1
from recordtide.operators.mutate import source_key_conflict
from recordtide.session import cut_lineage

# Shared key of the sample notifications; not a real secret.
SAMPLE_SECRET = "sample-notification-key"
# Added to a key so that nothing refers to it.
MOVED = 1_000_000_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def micros(column: str | Column) -> Column:
    return F.unix_micros(column)


def _utc(local: Column) -> Column:
    """Zone-less stamp, read as UTC whatever the session zone is. By its fields: writing it out and parsing it takes three times as long."""
    seconds = F.unix_date(local.cast("date")).cast("bigint") * 86_400 + F.hour(local) * 3600 + F.minute(local) * 60
    return F.timestamp_micros(seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), local) * 1_000_000).cast("bigint"))


# --- Notifications ----------------------------------------------------------


def notifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One envelope per event: ``event_id``, ``signature``, ``body``."""
    events = table(spark, sf_dir, "events")
    parts = events.select(
        "event_id",
        F.expr(
            """CASE user_id % 4 WHEN 0 THEN 'job' WHEN 1 THEN 'site' WHEN 2 THEN 'schedule' ELSE 'quote' END"""
        ).alias("word"),
        F.expr(
            """CASE WHEN event_id % 53 = 0 THEN 'archived' WHEN event_type = 'signup' THEN 'created'
                    WHEN event_type = 'error' THEN 'deleted' ELSE 'updated' END"""
        ).alias("op"),
        F.expr("CASE event_id % 10 WHEN 0 THEN '1' WHEN 1 THEN 'null' ELSE '0' END").alias("company"),
        F.expr(
            """CASE WHEN event_id % 59 = 0 THEN 'null' WHEN event_id % 61 = 0 THEN concat('"', user_id, '"')
                    ELSE cast(user_id AS string) END"""
        ).alias("ref"),
        F.expr("concat(replace(substr(cast(ts AS string), 1, 19), ' ', 'T'), 'Z')").alias("stamp"),
    )
    identifier = """concat(CASE WHEN event_id % 5 = 0 THEN 'company.' ELSE '' END, word,
                           CASE WHEN word = 'job' AND event_id % 7 = 0 THEN '.schedule' ELSE '' END, '.', op)"""
    bodies = parts.select(
        "event_id",
        F.expr(
            f"""concat('{{"ID":', CASE WHEN event_id % 73 = 0 THEN '5' ELSE concat('"', {identifier}, '"') END,
                       ',"reference":{{"companyID":', company,
                       ',"jobID":', CASE WHEN word = 'job' THEN ref ELSE 'null' END,
                       ',"scheduleID":', CASE WHEN word = 'schedule' THEN ref ELSE 'null' END,
                       ',"siteID":', CASE WHEN word = 'site' THEN ref ELSE 'null' END,
                       ',"extra":1}},"date_triggered":"', stamp, '"',
                       CASE WHEN event_id % 50 = 0 THEN '' WHEN event_id % 71 = 0 THEN '}} x' ELSE '}}' END)"""
        ).alias("body"),
    )
    signed = bodies.withColumn("digest", hmac_sha1(spark, SAMPLE_SECRET, F.col("body")))
    signature = F.expr(
        """CASE WHEN event_id % 37 = 0 THEN repeat('0', 40)
                WHEN event_id % 41 = 0 THEN NULL
                WHEN event_id % 43 = 0 THEN concat('zz', digest)
                WHEN event_id % 47 = 0 THEN substr(digest, 1, 39)
                WHEN event_id % 67 = 0 THEN concat(digest, 'é')
                WHEN event_id % 2 = 0 THEN upper(digest)
                ELSE digest END"""
    )
    return signed.select("event_id", signature.alias("signature"), "body")


# --- Nested records ---------------------------------------------------------


def _struct(**fields: str) -> Column:
    return F.struct(*[F.expr(text).alias(name) for name, text in fields.items()])


def site_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.expr("cast(c_custkey AS string)").alias("ID"),
        F.col("c_name").alias("Name"),
        F.expr("concat('2024-01-', lpad(cast(c_custkey % 28 + 1 AS string), 2, '0'), 'T10:00:00+10:00')").alias(
            "DateModified"
        ),
        _struct(
            Address="c_name",
            City="concat('City ', c_nationkey)",
            Country="CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END",
            PostalCode="CASE WHEN c_custkey % 113 = 0 THEN NULL ELSE lpad(cast(c_custkey % 10000 AS string), 4, '0') END",
            State="cast(NULL AS string)",
        ).alias("Address"),
    )


def job_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.expr("cast(o_orderkey AS string)").alias("ID"),
        F.expr("concat('Order ', o_orderkey)").alias("Name"),
        F.expr(
            """concat(cast(cast(o_orderdate AS date) AS string), 'T10:30:00.25',
                      CASE WHEN o_orderkey % 109 = 0 THEN '' ELSE '+10:00' END)"""
        ).alias("DateModified"),
        F.expr("CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE concat('Priority ', o_orderpriority) END").alias(
            "Description"
        ),
        F.col("o_orderpriority").alias("Stage"),
        F.expr(
            """CASE WHEN o_orderkey % 103 = 0 THEN 'Unknown' WHEN o_orderkey % 3 = 0 THEN 'Project'
                    WHEN o_orderkey % 3 = 1 THEN 'Service' ELSE 'Prepaid' END"""
        ).alias("Type"),
        _struct(
            ID="cast(o_custkey AS string)", CompanyName="concat('Customer#', lpad(cast(o_custkey AS string), 9, '0'))"
        ).alias("Customer"),
        _struct(
            ID="CASE WHEN o_orderkey % 107 = 0 THEN concat(o_custkey, '.5') ELSE cast(o_custkey AS string) END",
            Name="concat('Site ', o_custkey)",
        ).alias("Site"),
        _struct(
            ID="CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END",
            Name="o_orderstatus",
            Color="CASE o_orderstatus WHEN 'F' THEN 'green' WHEN 'O' THEN 'blue' ELSE 'grey' END",
        ).alias("Status"),
    )


def _line_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("day", F.expr("cast(cast(l_shipdate AS date) AS string)"))


_TYPE = """CASE WHEN l_partkey % 101 = 0 THEN 'visit' WHEN l_linenumber % 4 = 0 THEN 'lead'
                WHEN l_linenumber % 4 = 1 THEN 'quote' WHEN l_linenumber % 4 = 2 THEN 'job' ELSE 'activity' END"""
_RATE = "CASE l_returnflag WHEN 'A' THEN '1' WHEN 'N' THEN '2' ELSE '3' END"


def schedule_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Not unique by id, as the line items are not unique by (order, line number)."""
    def block(hour: int) -> str:
        return f"""named_struct(
            'ISO8601StartTime', concat(day, 'T0{hour}:00:00Z'), 'ISO8601EndTime', concat(day, 'T0{hour}:30:00Z'),
            'StartTime', '0{hour}:00', 'EndTime', '0{hour}:30', 'Hrs', cast(0.5 AS decimal(38, 10)),
            'ScheduleRate', named_struct('ID', {_RATE}, 'Name', l_returnflag))"""

    blocks = f"""CASE WHEN l_linenumber = 6 THEN NULL WHEN l_linenumber % 3 = 1 THEN array({block(8)})
                      WHEN l_linenumber % 3 = 2 THEN array({block(8)}, {block(9)}) ELSE array() END"""
    return _line_items(spark, sf_dir).select(
        F.expr("cast(l_orderkey * 10 + l_linenumber AS string)").alias("ID"),
        F.col("day").alias("Date"),
        F.expr("concat(day, 'T10:00:00+10:00')").alias("DateModified"),
        F.expr("CASE WHEN l_linenumber = 7 THEN NULL ELSE concat(l_returnflag, l_linestatus) END").alias("Notes"),
        F.expr(
            f"""CASE {_TYPE}
                WHEN 'lead' THEN cast(l_suppkey AS string)
                WHEN 'activity' THEN concat(l_partkey, CASE WHEN l_partkey % 97 = 0 THEN 'x' ELSE '' END)
                ELSE CASE WHEN l_partkey % 89 = 0 THEN cast(l_orderkey AS string)
                          WHEN l_partkey % 83 = 0 THEN concat('x-', l_partkey)
                          ELSE concat(l_orderkey, '-', l_partkey) END END"""
        ).alias("Reference"),
        F.expr(_TYPE).alias("Type"),
        _struct(ID="cast(l_suppkey AS string)", Name="concat('Supplier ', l_suppkey)").alias("Staff"),
        F.expr(blocks).alias("Blocks"),
    )


def _named(spark: SparkSession, sf_dir: str, name: str, key: str, label: str) -> DataFrame:
    return table(spark, sf_dir, name).select(F.col(key).cast("string").alias("ID"), F.expr(label).alias("Name"))


def records(spark: SparkSession, sf_dir: str, resource: str) -> DataFrame:
    """Nested records of any resource."""
    if resource == "site":
        return site_records(spark, sf_dir)
    if resource == "job":
        return job_records(spark, sf_dir)
    if resource == "schedule":
        return schedule_records(spark, sf_dir)
    if resource == "customer":
        return _named(spark, sf_dir, "customer", "c_custkey", "c_name").withColumnRenamed("Name", "CompanyName")
    source = {
        "employee": ("supplier", "s_suppkey", "s_name"),
        "activity": ("part", "p_partkey", "p_name"),
        "cost_center": ("part", "p_partkey", "p_brand"),
        "quote": ("orders", "o_orderkey", "concat('Quote ', o_orderkey)"),
        "lead": ("customer", "c_custkey", "c_name"),
    }[resource]
    named = _named(spark, sf_dir, *source)
    return named.withColumn("Position", F.lit(None).cast("string")) if resource == "employee" else named


# --- Flat cache tables ------------------------------------------------------


def schedule_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items keyed by schedule id, which is not unique."""
    return table(spark, sf_dir, "lineitem").select(
        F.expr("l_orderkey * 10 + l_linenumber").alias("id"),
        "l_shipdate", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus", "l_orderkey", "l_linenumber",
    )


LINE_ORDER = ("l_shipdate", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")


def cache_tables(spark: SparkSession, sf_dir: str, stored: bool = False) -> dict[str, DataFrame]:
    """The eleven cache tables. Quotes and leads lack some referenced rows.

    ``stored`` writes the unique schedule lines out, for plans that read them often.
    """
    customer, orders, part, supplier, lineitem = (
        table(spark, sf_dir, name) for name in ("customer", "orders", "part", "supplier", "lineitem")
    )
    lines = source_key_conflict(schedule_lines(spark, sf_dir), "id", LINE_ORDER)
    if stored:
        lines = cut_lineage(lines)
    kind = "l_linenumber % 4"
    schedules = lines.select(
        "id",
        _utc(F.col("l_shipdate")).alias("date_modified"),
        F.col("l_suppkey").alias("staff_id"),
        F.expr(f"CASE {kind} WHEN 0 THEN 'lead' WHEN 1 THEN 'quote' WHEN 2 THEN 'job' ELSE 'activity' END").alias(
            "schedule_type"
        ),
        F.expr("concat(l_returnflag, l_linestatus)").alias("notes"),
        F.expr(f"CASE WHEN {kind} = 2 THEN l_orderkey END").alias("job_id"),
        F.expr(f"CASE WHEN {kind} IN (1, 2) THEN l_partkey END").alias("cost_center_id"),
        F.expr(f"CASE WHEN {kind} = 3 THEN l_partkey END").alias("activity_id"),
        F.expr(f"CASE WHEN {kind} = 1 THEN l_orderkey END").alias("quote_id"),
        F.expr(f"CASE WHEN {kind} = 0 THEN l_suppkey END").alias("lead_id"),
    )
    hour = 3_600_000_000
    blocks = lines.where("l_linenumber % 3 > 0").select(
        F.col("id").alias("schedule_id"), "l_shipdate", "l_returnflag",
        F.explode(F.expr("sequence(1, l_linenumber % 3)")).alias("pos"),
    )
    starts = F.unix_micros(_utc(F.col("l_shipdate"))) + (F.col("pos") + 7) * hour
    return {
        "employees": supplier.select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        "sites": customer.select(
            F.col("c_custkey").alias("id"),
            F.col("c_name").alias("address_address"),
            F.expr("concat('City ', c_nationkey)").alias("address_city"),
            F.col("c_mktsegment").alias("address_country"),
            F.expr("lpad(cast(c_custkey % 10000 AS string), 4, '0')").alias("address_postal_code"),
            F.expr("timestamp_micros(1704067200000000 + (c_custkey % 28) * 86400000000)").alias("date_modified"),
        ),
        "activities": part.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")),
        # Keys moved out of reach leave gaps: finished orders among the quotes, customers in debt among the leads.
        "quotes": orders.select(
            F.expr(f"o_orderkey + CASE WHEN o_orderstatus = 'F' THEN {MOVED} ELSE 0 END").alias("id"),
            F.expr("concat('Quote ', o_orderkey)").alias("name"),
        ),
        "leads": customer.select(
            F.expr(f"c_custkey + CASE WHEN c_acctbal < 0 THEN {MOVED} ELSE 0 END").alias("id"), F.col("c_name").alias("name")
        ),
        "cost_centers": part.select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("name")),
        "job_statuses": orders.select(
            F.expr("cast(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS bigint)").alias("id"),
            F.expr("CASE o_orderstatus WHEN 'F' THEN 'green' WHEN 'O' THEN 'blue' ELSE 'grey' END").alias("color"),
            F.col("o_orderstatus").alias("name"),
        ).distinct(),
        "jobs": orders.select(
            F.col("o_orderkey").alias("id"),
            F.expr("concat('Customer#', lpad(cast(o_custkey AS string), 9, '0'))").alias("customer_company_name"),
            _utc(F.col("o_orderdate")).alias("date_modified"),
            F.expr("concat('Priority ', o_orderpriority)").alias("description"),
            F.expr("concat('Order ', o_orderkey)").alias("name"),
            F.col("o_custkey").alias("site_id"),
            F.col("o_orderpriority").alias("stage"),
            F.expr("cast(CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS bigint)").alias("status_id"),
            F.expr("CASE o_orderkey % 3 WHEN 0 THEN 'Project' WHEN 1 THEN 'Service' ELSE 'Prepaid' END").alias(
                "job_type"
            ),
        ),
        "schedule_rates": lineitem.select(
            F.expr("cast(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS bigint)").alias("id"),
            F.col("l_returnflag").alias("name"),
        ).distinct(),
        "schedules": schedules,
        "schedule_blocks": blocks.select(
            F.xxhash64("schedule_id", "pos").alias("id"),
            "schedule_id",
            F.timestamp_micros(starts).alias("iso8601_start_time"),
            F.timestamp_micros(starts + hour // 2).alias("iso8601_end_time"),
            F.expr("cast(CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS bigint)").alias(
                "schedule_rate"
            ),
        ),
    }
