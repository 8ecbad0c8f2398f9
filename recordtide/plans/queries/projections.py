"""Projection rules over nested sample records."""

from pyspark.sql import functions as F

from recordtide.operators.project import (
    columns_to_include,
    exclude_columns,
    field_allowlist,
    fill_default,
    flatten_struct,
    json_fallback,
    normalise_names,
    promote_temporal,
    select_columns,
    struct_to_fk,
)
from recordtide.plans.registry import query
from recordtide.plans.standins import job_records, micros, schedule_records, site_records, table

_JOB_TYPE = """CASE WHEN o_orderkey % 103 = 0 THEN 'Unknown' WHEN o_orderkey % 3 = 0 THEN 'Project'
                    WHEN o_orderkey % 3 = 1 THEN 'Service' ELSE 'Prepaid' END"""
_JOB_STAMP = """strftime(o_orderdate, '%Y-%m-%d') || 'T10:30:00.25' ||
                CASE WHEN o_orderkey % 109 = 0 THEN '' ELSE '+10:00' END"""
_JOB_TEXT = "CASE WHEN o_orderkey % 5 <> 0 THEN 'Priority ' || o_orderpriority END"
_SITE_REF = "CASE WHEN o_orderkey % 107 = 0 THEN o_custkey || '.5' ELSE o_custkey::VARCHAR END"
_STATUS = "CASE o_orderstatus WHEN 'F' THEN '1' WHEN 'O' THEN '2' ELSE '3' END"
_COLOR = "CASE o_orderstatus WHEN 'F' THEN 'green' WHEN 'O' THEN 'blue' ELSE 'grey' END"
_SITE_STAMP = "'2024-01-' || lpad((c_custkey % 28 + 1)::VARCHAR, 2, '0') || 'T10:00:00+10:00'"
_COUNTRY = "CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END"
_POSTCODE = "CASE WHEN c_custkey % 113 <> 0 THEN lpad((c_custkey % 10000)::VARCHAR, 4, '0') END"
_LINE_TYPE = """CASE WHEN l_partkey % 101 = 0 THEN 'visit' WHEN l_linenumber % 4 = 0 THEN 'lead'
                     WHEN l_linenumber % 4 = 1 THEN 'quote' WHEN l_linenumber % 4 = 2 THEN 'job' ELSE 'activity' END"""
_LINE_NOTES = "CASE WHEN l_linenumber <> 7 THEN l_returnflag || l_linestatus END"


@query(
    "columns_to_include",
    f"""SELECT o_orderkey::VARCHAR AS id, 'Order ' || o_orderkey AS name, {_JOB_TEXT} AS description,
               {_JOB_STAMP} AS date_modified, {_JOB_TYPE} AS job_type, {_SITE_REF} AS site_id,
               o_orderpriority AS stage, {_STATUS} AS status_id FROM orders""",
)
def included(spark, sf_dir):
    kept = columns_to_include(job_records(spark, sf_dir), "job")
    return kept.select(
        F.col("ID").alias("id"), F.col("Name").alias("name"), F.col("Description").alias("description"),
        F.col("DateModified").alias("date_modified"), F.col("Type").alias("job_type"),
        F.col("Site.ID").alias("site_id"), F.col("Stage").alias("stage"), F.col("Status.ID").alias("status_id"),
    )


@query(
    "field_allowlist",
    """SELECT o_orderkey::VARCHAR AS id, 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS company,
              'CompanyName,ID' AS customer_fields, 'Customer,DateModified,Description,ID,Name,Site,Stage,Status,Type' AS fields
       FROM orders""",
)
def allowlist(spark, sf_dir):
    """Extra fields, top-level and nested, are pruned by the lists."""
    jobs = job_records(spark, sf_dir).withColumns(
        {
            "Priority": F.col("Stage"),
            "Customer": F.struct("Customer.*", F.col("Stage").alias("Rating")),
        }
    )
    kept = field_allowlist(jobs, "Job")
    return kept.select(
        F.col("ID").alias("id"), F.col("Customer.CompanyName").alias("company"),
        F.lit(",".join(sorted(kept.schema["Customer"].dataType.names))).alias("customer_fields"),
        F.lit(",".join(sorted(kept.columns))).alias("fields"),
    )


@query(
    "exclude_columns",
    f"""SELECT (l_orderkey * 10 + l_linenumber)::VARCHAR AS id, {_LINE_TYPE} AS type, {_LINE_NOTES} AS notes,
               'Blocks,Date,DateModified,ID,Notes,Staff,Type' AS fields FROM lineitem""",
)
def excluded(spark, sf_dir):
    kept = exclude_columns(schedule_records(spark, sf_dir), "Schedule")
    return kept.select(
        F.col("ID").alias("id"), F.col("Type").alias("type"), F.col("Notes").alias("notes"),
        F.lit(",".join(sorted(kept.columns))).alias("fields"),
    )


@query(
    "flatten_struct",
    f"""SELECT c_custkey::VARCHAR AS ID, c_name AS Name, {_SITE_STAMP} AS DateModified, c_name AS address_address,
               'City ' || c_nationkey AS address_city, {_COUNTRY} AS address_country,
               {_POSTCODE} AS address_postal_code, NULL::VARCHAR AS address_state FROM customer""",
)
def flatten(spark, sf_dir):
    return flatten_struct(site_records(spark, sf_dir), "Address")


@query(
    "struct_to_fk",
    f"""SELECT o_orderkey::VARCHAR AS ID, CASE WHEN o_orderkey % 107 <> 0 THEN o_custkey END AS site_id,
               {_STATUS}::BIGINT AS status_id, o_custkey AS customer_id FROM orders""",
)
def to_fk(spark, sf_dir):
    keyed = job_records(spark, sf_dir)
    for name in ("Site", "Status", "Customer"):
        keyed = struct_to_fk(keyed, name)
    return keyed.select("ID", "site_id", "status_id", "customer_id")


@query(
    "normalise_names",
    f"""SELECT (l_orderkey * 10 + l_linenumber)::VARCHAR AS id, strftime(l_shipdate, '%Y-%m-%d') AS _date,
               strftime(l_shipdate, '%Y-%m-%d') || 'T10:00:00+10:00' AS date_modified, {_LINE_NOTES} AS notes,
               {_LINE_TYPE} AS _type FROM lineitem""",
)
def names(spark, sf_dir):
    return normalise_names(schedule_records(spark, sf_dir).drop("Blocks", "Staff", "Reference"))


@query(
    "promote_temporal",
    """SELECT o_orderkey::VARCHAR AS id, 'Order ' || o_orderkey AS name,
              CASE WHEN o_orderkey % 109 <> 0 THEN epoch_us(o_orderdate) + 1800250000 END AS date_modified FROM orders""",
)
def temporal(spark, sf_dir):
    promoted = promote_temporal(normalise_names(job_records(spark, sf_dir).select("ID", "Name", "DateModified")))
    return promoted.withColumn("date_modified", micros("date_modified"))


@query(
    "json_fallback",
    """SELECT event_id, json(props)::VARCHAR AS props, (props ->> '$.k')::BIGINT AS k,
              '{"event_type":"' || event_type || '"}' AS nested FROM events""",
)
def fallback(spark, sf_dir):
    shapeless = table(spark, sf_dir, "events").select("event_id", "props", F.struct("event_type").alias("nested"))
    kept = json_fallback(shapeless, "props", "nested")
    return kept.select(
        "event_id", F.to_json("props").alias("props"), F.try_variant_get("props", "$.k", "bigint").alias("k"),
        F.to_json("nested").alias("nested"),
    )


@query(
    "fill_default",
    f"SELECT o_orderkey::VARCHAR AS id, coalesce({_JOB_TEXT}, '') AS description FROM orders",
)
def default(spark, sf_dir):
    return job_records(spark, sf_dir).select(F.col("ID").alias("id"), fill_default(F.col("Description")).alias("description"))


@query("select_columns", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def chosen(spark, sf_dir):
    return select_columns(table(spark, sf_dir, "orders"), "o_orderkey, o_custkey,o_orderpriority")
