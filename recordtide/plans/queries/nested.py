"""Nested records to rows, child tables and junctions."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordtide.operators.nested import (
    array_to_child,
    array_to_junction,
    declared_junction,
    explode_blocks,
    nested_entity,
    rows_from_record,
)
from recordtide.operators.shred import KEY, PARENT, shred
from recordtide.plans.registry import query
from recordtide.plans.sql import CACHE, JOB_ROWS, SCHEDULE_ROWS, SITE_ROWS, with_ctes
from recordtide.plans.standins import cache_tables, micros, records, schedule_records, table
from recordtide.schemas import DECLARED_JUNCTIONS
from recordtide.session import work_folder
from recordtide.sources.records import land_records, record_scan


@query(
    "record_scan",
    with_ctes(SCHEDULE_ROWS)
    + """SELECT id::VARCHAR AS id, notes, l_suppkey::VARCHAR AS staff, 'Supplier ' || l_suppkey AS staff_name,
                CASE WHEN l_linenumber = 6 THEN NULL ELSE l_linenumber % 3 END AS n_blocks,
                (CASE WHEN l_linenumber = 6 THEN 0 ELSE l_linenumber % 3 END) * 5 AS tenth_hours FROM schedule_rows""",
)
def scan(spark, sf_dir):
    folder = work_folder(spark, "records")
    land_records(schedule_records(spark, sf_dir), folder, "schedule")
    landed = record_scan(spark, folder, "schedule")
    hours = F.aggregate(
        F.coalesce("Blocks", F.array()), F.lit(0).cast("bigint"), lambda sum_, b: sum_ + (b["Hrs"] * 10).cast("bigint")
    )
    return landed.select(
        F.col("ID").alias("id"), F.col("Notes").alias("notes"), F.col("Staff.ID").alias("staff"),
        F.col("Staff.Name").alias("staff_name"), F.when(F.col("Blocks").isNotNull(), F.size("Blocks")).alias("n_blocks"),
        hours.alias("tenth_hours"),
    )


_BLOCKS = """
blocks AS (
  SELECT id AS schedule_id, epoch_us(l_shipdate) + (7 + pos) * 3600000000 AS iso8601_start_time,
    epoch_us(l_shipdate) + (7 + pos) * 3600000000 + 1800000000 AS iso8601_end_time,
    '0' || (7 + pos) || ':00' AS start_time, '0' || (7 + pos) || ':30' AS end_time, 5 AS tenth_hours,
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS rate
  FROM schedule_rows, unnest(generate_series(1, l_linenumber % 3)) AS g(pos))
"""


@query(
    "explode_blocks",
    with_ctes(SCHEDULE_ROWS, _BLOCKS)
    + "SELECT schedule_id, iso8601_start_time, iso8601_end_time, rate AS schedule_rate FROM blocks",
)
def explode(spark, sf_dir):
    return explode_blocks(schedule_records(spark, sf_dir)).select(
        "schedule_id", micros("iso8601_start_time").alias("iso8601_start_time"),
        micros("iso8601_end_time").alias("iso8601_end_time"), "schedule_rate",
    )


@query(
    "array_to_child",
    with_ctes(SCHEDULE_ROWS, _BLOCKS)
    + """SELECT schedule_id, iso8601_start_time, iso8601_end_time, start_time, end_time, tenth_hours,
                rate AS schedule_rate_id FROM blocks""",
)
def child(spark, sf_dir):
    blocks = array_to_child(schedule_records(spark, sf_dir), "Blocks", "schedule", "ScheduleBlock")
    return blocks.select(
        "schedule_id", micros("iso8601_start_time").alias("iso8601_start_time"),
        micros("iso8601_end_time").alias("iso8601_end_time"), "start_time", "end_time",
        (F.col("hrs") * 10).cast("bigint").alias("tenth_hours"), "schedule_rate_id",
    )


@query(
    "array_to_junction",
    """SELECT DISTINCT l_orderkey AS job_id, unnest([l_suppkey, l_suppkey + 1]) AS employee_id FROM lineitem""",
)
def junction(spark, sf_dir):
    crews = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").cast("string").alias("ID"),
        F.expr(
            """array(named_struct('ID', cast(l_suppkey AS string), 'Name', 'lead'),
                     named_struct('ID', cast(l_suppkey + 1 AS string), 'Name', 'mate'),
                     named_struct('ID', 'n/a', 'Name', 'unknown'))"""
        ).alias("Staff"),
    )
    return array_to_junction(crews, "Staff", "job", "employee")


@query(
    "declared_junction",
    with_ctes(CACHE)
    + """SELECT 'activity_schedules' AS junction, activity_id AS first_id, id AS second_id
         FROM schedules WHERE activity_id IS NOT NULL
         UNION ALL SELECT 'job_schedules', id, job_id FROM schedules WHERE job_id IS NOT NULL""",
)
def declared(spark, sf_dir):
    schedules = cache_tables(spark, sf_dir)["schedules"]
    pairs = [
        declared_junction(schedules, name).toDF("first_id", "second_id").select(
            F.lit(name).alias("junction"), "first_id", "second_id"
        )
        for name in DECLARED_JUNCTIONS
    ]
    return pairs[0].unionAll(pairs[1])


def row_text(rows):
    """All columns of a row as one text, so that rows of several tables fit one result."""
    parts = [
        (micros(field.name) if isinstance(field.dataType, T.TimestampType) else F.col(field.name)).cast("string")
        for field in rows.schema
        if field.name != "reject_columns"
    ]
    return F.concat_ws("|", *[F.coalesce(part, F.lit("~")) for part in parts])


def sql_text(*columns: str) -> str:
    return " || '|' || ".join(f"coalesce({name}::VARCHAR, '~')" for name in columns)


_SITE = sql_text("id", "address_address", "address_city", "address_country", "address_postal_code", "date_modified")
_JOB = sql_text(
    "id", "customer_company_name", "date_modified", "description", "name", "site_id", "stage", "status_id", "job_type"
)
_SCHEDULE = sql_text(
    "id", "date_modified", "staff_id", "schedule_type", "notes", "job_id", "cost_center_id", "activity_id", "quote_id",
    "lead_id",
)
_NAMED = "id::VARCHAR || '|' || name"


@query(
    "rows_from_record",
    with_ctes(SITE_ROWS, JOB_ROWS, SCHEDULE_ROWS)
    + f"""SELECT 'site' AS resource, {_SITE} AS row_text, reject_columns FROM site_rows
          UNION ALL SELECT 'job', {_JOB}, reject_columns FROM job_rows
          UNION ALL SELECT 'schedule', {_SCHEDULE}, reject_columns FROM schedule_rows
          UNION ALL SELECT 'employee', s_suppkey || '|' || s_name, '' FROM supplier
          UNION ALL SELECT 'activity', p_partkey || '|' || p_name, '' FROM part
          UNION ALL SELECT 'cost_center', p_partkey || '|' || p_brand, '' FROM part
          UNION ALL SELECT 'quote', o_orderkey || '|Quote ' || o_orderkey, '' FROM orders
          UNION ALL SELECT 'lead', c_custkey || '|' || c_name, '' FROM customer""",
)
def rows(spark, sf_dir):
    parts = []
    for resource in ("site", "job", "schedule", "employee", "activity", "cost_center", "quote", "lead"):
        flat = rows_from_record(records(spark, sf_dir, resource), resource)
        parts.append(
            flat.select(
                F.lit(resource).alias("resource"), row_text(flat).alias("row_text"),
                F.array_join("reject_columns", ",").alias("reject_columns"),
            )
        )
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


@query(
    "merge_mentions",
    """SELECT id, name, color FROM (
         SELECT o_custkey AS id, o_orderstatus AS name, o_orderpriority AS color, row_number() OVER (
           PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderstatus DESC, o_orderpriority DESC) AS rn FROM orders)
       WHERE rn = 1""",
)
def merge_mentions(spark, sf_dir):
    """Mentions of one entity that differ: that of the record modified last counts as a whole."""
    status = F.struct(F.col("o_custkey").cast("string").alias("ID"), F.col("o_orderstatus").alias("Name"), F.col("o_orderpriority").alias("Color"))
    stamp = F.date_format("o_orderdate", "yyyy-MM-dd'T'00:00:00'Z'")
    mentioned = table(spark, sf_dir, "orders").select(status.alias("Status"), stamp.alias("DateModified"))
    return nested_entity(mentioned, "Status", {"name": "Name", "color": "Color"})


_NESTED = """
nested_orders AS (
  SELECT *, o_custkey || '/' || (row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1) AS order_path FROM orders),
nested_lines AS (
  SELECT l.*, order_path, order_path || '/' || (row_number() OVER (PARTITION BY l_orderkey
    ORDER BY l_linenumber, l_partkey, l_suppkey, l_returnflag, l_linestatus) - 1) AS line_path
  FROM lineitem l JOIN nested_orders ON l_orderkey = o_orderkey)
"""


@query(
    "shred_records",
    with_ctes(_NESTED)
    + """SELECT 'customers' AS table_name, c_custkey::VARCHAR AS row_key, NULL::VARCHAR AS parent_key, c_name AS label FROM customer
         UNION ALL SELECT 'customers_orders', order_path, o_custkey::VARCHAR, o_orderkey || ' ' || o_orderpriority FROM nested_orders
         UNION ALL SELECT 'customers_orders_lines', line_path, order_path, l_partkey || ' ' || l_suppkey FROM nested_lines
         UNION ALL SELECT 'customers_orders_lines_flags', line_path || '/' || i, line_path, [l_returnflag, l_linestatus][i + 1]
           FROM nested_lines, unnest([0, 1]) AS g(i)""",
)
def shredded(spark, sf_dir):
    """Customers with orders with lines with flags: arrays four tables deep."""
    line = F.struct(*[F.col(c) for c in ("l_linenumber", "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")])
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(line)).alias("lines"))
    lines = lines.withColumn("lines", F.expr("transform(lines, x -> struct(x.l_partkey AS part, x.l_suppkey AS supplier, array(x.l_returnflag, x.l_linestatus) AS flags))"))
    orders = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    order = F.struct(F.col("o_orderkey").alias("number"), F.col("o_orderpriority").alias("priority"), "lines")
    orders = orders.groupBy("o_custkey").agg(F.sort_array(F.collect_list(order)).alias("orders"))
    customers = table(spark, sf_dir, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left")
    shape, tables = shred(customers.select(F.col("c_custkey").alias("ID"), F.col("c_name").alias("name"), "orders"), "customers")
    labels = {
        "customers": F.col("name"), "customers_orders": F.concat_ws(" ", "number", "priority"),
        "customers_orders_lines": F.concat_ws(" ", "part", "supplier"), "customers_orders_lines_flags": F.col("value"),
    }
    parts = [
        tables[own.name].select(
            F.lit(own.name).alias("table_name"), F.col(KEY).alias("row_key"),
            (F.col(PARENT) if own is not shape else F.lit(None).cast("string")).alias("parent_key"), labels[own.name].alias("label"),
        )
        for own in shape.walk()
    ]
    return parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
