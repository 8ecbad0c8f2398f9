"""Nested records to cache rows, child tables and junction tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.functions.once import with_columns_once
from recordtide.functions.scalars import decode_reference, enum_domain, parse_id, parse_rfc3339_utc
from recordtide.operators.project import fill_default, to_columns
from recordtide.schemas import (
    DECLARED_JUNCTIONS,
    JOB_TYPES,
    RESOURCE_TABLES,
    SCHEDULE_TYPES,
    required_columns,
)


def _named(prefix: str = "") -> dict[str, Column]:
    return {"id": parse_id(F.col(f"{prefix}ID")), "name": F.col(f"{prefix}Name")}


def _site() -> dict[str, Column]:
    address = F.col("Address")
    return {
        "id": parse_id(F.col("ID")),
        "address_address": address["Address"],
        "address_city": address["City"],
        "address_country": address["Country"],
        "address_postal_code": address["PostalCode"],
        "date_modified": parse_rfc3339_utc(F.col("DateModified")),
    }


def _job() -> dict[str, Column]:
    return {
        "id": parse_id(F.col("ID")),
        "customer_company_name": F.col("Customer.CompanyName"),
        "date_modified": parse_rfc3339_utc(F.col("DateModified")),
        "description": fill_default(F.col("Description")),
        "name": F.col("Name"),
        "site_id": parse_id(F.col("Site.ID")),
        "stage": F.col("Stage"),
        "status_id": parse_id(F.col("Status.ID")),
        "job_type": enum_domain(F.col("Type"), JOB_TYPES),
    }


def _schedule() -> dict[str, Column]:
    return {
        "id": parse_id(F.col("ID")),
        "date_modified": parse_rfc3339_utc(F.col("DateModified")),
        "staff_id": parse_id(F.col("Staff.ID")),
        "schedule_type": enum_domain(F.col("Type"), SCHEDULE_TYPES),
        "notes": F.col("Notes"),
        **decode_reference(F.col("Type"), F.col("Reference")),
    }


_ROW_RULES = {"site": _site, "job": _job, "schedule": _schedule}


def rows_from_record(records: DataFrame, resource: str, policy: str = "reject") -> DataFrame:
    """Flatten nested records of a resource to rows of its cache table.

    ``policy='reject'`` adds ``reject_columns``, the columns that are missing or
    malformed (empty for a good row); ``policy='fail'`` fails the job on the first
    bad record.
    """
    table = RESOURCE_TABLES[resource]
    rules = _ROW_RULES.get(resource, _named)()
    valid = rules.pop("reference_valid", F.lit(True))
    rows = records.select(*[rule.alias(name) for name, rule in rules.items()], valid.alias("_valid"))
    wrong = [F.when(F.col(name).isNull(), F.lit(name)) for name in required_columns(table)]
    wrong.append(F.when(~F.col("_valid"), F.lit("reference")))
    rows = with_columns_once(rows, {"reject_columns": F.array_compact(F.array(*wrong))}).drop("_valid")
    if policy == "reject":
        return rows
    message = F.concat(F.lit(f"bad {resource} record: "), F.array_join("reject_columns", ","))
    sound = F.when(F.size("reject_columns") == 0, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return rows.where(sound).drop("reject_columns")


def accepted_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("reject_columns") == 0).drop("reject_columns")


def rejected_rows(rows: DataFrame) -> DataFrame:
    return rows.where(F.size("reject_columns") > 0)


def explode_blocks(schedules: DataFrame) -> DataFrame:
    """One row per block of a schedule record.

    The key is a hash of parent and position: unlike a sequence it is the same on
    every replay. Null and empty arrays give no rows.
    """
    items = schedules.select(parse_id(F.col("ID")).alias("schedule_id"), F.posexplode("Blocks").alias("pos", "block"))
    return items.select(
        F.xxhash64("schedule_id", "pos").alias("id"),
        "schedule_id",
        parse_rfc3339_utc(F.col("block.ISO8601StartTime")).alias("iso8601_start_time"),
        parse_rfc3339_utc(F.col("block.ISO8601EndTime")).alias("iso8601_end_time"),
        parse_id(F.col("block.ScheduleRate.ID")).alias("schedule_rate"),
    )


def nested_entity(records: DataFrame, path: str, columns: Mapping[str, str]) -> DataFrame:
    """Rows of an entity that only occurs nested in other records, one per id.

    ``columns`` maps cache column -> field under ``path``. Mentions of one id may
    differ; that of the record modified last is kept as a whole, equal times being
    settled by the greater one. Partial aggregation settles it before the shuffle.
    """
    modified = parse_rfc3339_utc(F.col("DateModified")) if "DateModified" in records.columns else F.lit(None).cast("timestamp")
    mentions = records.select(
        parse_id(F.col(f"{path}.ID")).alias("id"), modified.alias("_modified"),
        *[F.col(f"{path}.{field}").alias(name) for name, field in columns.items()],
    ).where(F.col("id").isNotNull())
    return mentions.groupBy("id").agg(F.max(F.struct("_modified", *columns)).alias("_last")).select("id", *[f"_last.{c}" for c in columns])


def derived_rows(records: DataFrame, resource: str) -> dict[str, DataFrame]:
    """Rows of the tables without a record list of their own, found inside other records."""
    if resource == "job":
        return {"job_statuses": nested_entity(records, "Status", {"color": "Color", "name": "Name"})}
    if resource == "schedule":
        blocks = records.select("DateModified", F.explode("Blocks").alias("block"))
        rates = nested_entity(blocks, "block.ScheduleRate", {"name": "Name"})
        return {
            "schedule_rates": rates,
            "schedule_blocks": explode_blocks(records),
            "employees": nested_entity(records, "Staff", {"name": "Name"}),
        }
    return {}


def array_to_child(parents: DataFrame, array: str, parent: str, entity: str = "") -> DataFrame:
    """An array of objects without ids -> child table.

    Adds a surrogate ``id`` and ``<parent>_id``; nested entities become foreign keys.
    """
    items = parents.select(parse_id(F.col("ID")).alias("_parent"), F.posexplode(array).alias("_pos", "_item"))
    flat = to_columns(items.select("_parent", "_pos", "_item.*").drop("ID", "id"), entity)
    fields = [name for name in flat.columns if name not in ("_parent", "_pos")]
    return flat.select(F.xxhash64("_parent", "_pos").alias("id"), F.col("_parent").alias(f"{parent}_id"), *fields)


def array_to_junction(parents: DataFrame, array: str, parent: str, item: str) -> DataFrame:
    """An array of entities -> distinct ``(<parent>_id, <item>_id)`` pairs."""
    pairs = parents.select(parse_id(F.col("ID")).alias(f"{parent}_id"), F.explode(array).alias("_item")).select(
        f"{parent}_id", parse_id(F.col("_item.ID")).alias(f"{item}_id")
    )
    return pairs.dropna().distinct()


def declared_junction(schedules: DataFrame, name: str) -> DataFrame:
    """One of the named pair tables, from flat schedule rows."""
    first, second = DECLARED_JUNCTIONS[name]
    keyed = schedules.withColumnRenamed("id", "schedule_id")
    return keyed.select(first, second).dropna().distinct()
