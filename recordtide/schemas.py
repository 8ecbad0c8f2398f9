"""Record types, cache tables, domains and foreign-key edges.

Everything here is a constant. Nothing is inferred from data.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import types as T

# --- Fixed values: closed domains, in ordinal order -------------------------

RESOURCES = ("job", "site", "schedule", "activity", "employee", "cost_center", "quote", "lead")
OPERATIONS = ("created", "updated", "deleted")

# Only these three may appear in a notification; each has its own reference id.
NOTIFIED_RESOURCES = {"schedule": "scheduleID", "job": "jobID", "site": "siteID"}
REFERENCE_IDS = ("companyID", "costCenterID", "jobID", "scheduleID", "sectionID", "siteID")

JOB_TYPES = ("Project", "Service", "Prepaid")
SCHEDULE_TYPES = ("lead", "quote", "job", "activity")

DEFAULT_COMPANY = 0
STALE_AFTER_DAYS = 10

# --- Notifications ----------------------------------------------------------

ENVELOPE = T.StructType([T.StructField("signature", T.StringType()), T.StructField("body", T.StringType())])


# --- Nested records, as the remote service returns them (ids are text) ------


def _record(*names: str, **nested: T.DataType) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in names]
    return T.StructType(fields + [T.StructField(name, kind) for name, kind in nested.items()])


_NAMED = _record("ID", "Name")

SCHEDULE_BLOCK = _record(
    "ISO8601StartTime", "ISO8601EndTime", "StartTime", "EndTime", Hrs=T.DecimalType(38, 10), ScheduleRate=_NAMED
)

RECORDS: dict[str, T.StructType] = {
    "customer": _record("ID", "CompanyName"),
    "employee": _record("ID", "Name", "Position"),
    "cost_center": _NAMED,
    "job": _record(
        "ID", "Name", "DateModified", "Description", "Stage", "Type",
        Customer=_record("ID", "CompanyName"), Site=_NAMED, Status=_record("ID", "Name", "Color"),
    ),
    "schedule": _record(
        "ID", "Date", "DateModified", "Notes", "Reference", "Type",
        Staff=_NAMED, Blocks=T.ArrayType(SCHEDULE_BLOCK),
    ),
    "activity": _NAMED,
    "site": _record(
        "ID", "Name", "DateModified", Address=_record("Address", "City", "Country", "PostalCode", "State")
    ),
    "lead": _NAMED,
    "quote": _NAMED,
}

# Top-level columns asked for per resource.
RESOURCE_COLUMNS = {
    "activity": ("ID", "Name"),
    "site": ("ID", "Name", "DateModified", "Address"),
    "job": ("ID", "Name", "Description", "DateModified", "Type", "Site", "Notes", "Stage", "Status"),
    "employee": ("ID", "Name", "Position", "DateModified"),
    "schedule": ("ID", "Type", "Notes", "Reference", "TotalHours", "Staff", "Blocks", "DateModified"),
    "quote": ("ID", "Name"),
    "cost_center": ("ID", "Name"),
    "lead": ("ID", "Name"),
}

# Fields kept per entity, top-level or nested.
FIELD_ALLOWLIST = {
    "Schedule": ("Blocks", "Date", "DateModified", "ID", "Notes", "Reference", "Staff", "Type"),
    "Staff": ("ID", "Name", "Position"),
    "Employee": ("ID", "Name", "Position"),
    "Activity": ("ID", "Name"),
    "Job": ("ID", "Description", "Name", "Customer", "Site", "Stage", "Status", "Type", "DateModified"),
    "Site": ("ID", "Name", "Address", "DateModified"),
    "CostCenter": ("ID", "Name", "Section", "DateModified"),
    "Customer": ("ID", "CompanyName", "DateModified"),
    "Quote": ("ID", "Name"),
    "Lead": ("ID", "Name"),
}

# Fields that never become a column; "*" means in every entity.
EXCLUDED_COLUMNS = {"*": ("Reference", "AssignedTo", "CreatedBy", "ConvertedFrom")}

# Nested entity -> cache table, where a field names an entity.
ENTITY_TABLES = {
    "Customer": "customers", "Site": "sites", "Status": "job_statuses", "Staff": "employees",
    "Activity": "activities", "CostCenter": "cost_centers", "Quote": "quotes", "Lead": "leads",
    "Job": "jobs", "Schedule": "schedules", "ScheduleRate": "schedule_rates",
}

# Declared pair tables and the schedule column behind each.
DECLARED_JUNCTIONS = {
    "activity_schedules": ("activity_id", "schedule_id"),
    "job_schedules": ("schedule_id", "job_id"),
}

# --- Cache tables -----------------------------------------------------------


def _table(**columns: tuple[T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, not required) for name, (kind, required) in columns.items()])


_ID, _REF = (T.LongType(), True), (T.LongType(), False)
_TEXT, _OPTIONAL_TEXT = (T.StringType(), True), (T.StringType(), False)
_TIME, _OPTIONAL_TIME = (T.TimestampType(), True), (T.TimestampType(), False)

CACHE_TABLES: dict[str, T.StructType] = {
    "employees": _table(id=_ID, name=_TEXT),
    "sites": _table(
        id=_ID, address_address=_OPTIONAL_TEXT, address_city=_OPTIONAL_TEXT, address_country=_OPTIONAL_TEXT,
        address_postal_code=_TEXT, date_modified=_OPTIONAL_TIME,
    ),
    "activities": _table(id=_ID, name=_TEXT),
    "quotes": _table(id=_ID, name=_TEXT),
    "leads": _table(id=_ID, name=_TEXT),
    "cost_centers": _table(id=_ID, name=_TEXT),
    "job_statuses": _table(id=_ID, color=_TEXT, name=_TEXT),
    "jobs": _table(
        id=_ID, customer_company_name=_TEXT, date_modified=_TIME, description=_TEXT, name=_TEXT,
        site_id=_ID, stage=_TEXT, status_id=_ID, job_type=_TEXT,
    ),
    "schedule_rates": _table(id=_ID, name=_TEXT),
    "schedules": _table(
        id=_ID, date_modified=_TIME, staff_id=_ID, schedule_type=_TEXT, notes=_OPTIONAL_TEXT,
        job_id=_REF, cost_center_id=_REF, activity_id=_REF, quote_id=_REF, lead_id=_REF,
    ),
    "schedule_blocks": _table(
        id=_ID, schedule_id=_ID, iso8601_start_time=_TIME, iso8601_end_time=_TIME, schedule_rate=_ID
    ),
}

ENUM_COLUMNS = {("jobs", "job_type"): JOB_TYPES, ("schedules", "schedule_type"): SCHEDULE_TYPES}


class Edge(NamedTuple):
    """A foreign key: ``child.column`` holds an ``id`` of ``parent``."""

    child: str
    column: str
    parent: str

    @property
    def optional(self) -> bool:
        return CACHE_TABLES[self.child][self.column].nullable


FK_EDGES = (
    Edge("jobs", "status_id", "job_statuses"),
    Edge("jobs", "site_id", "sites"),
    Edge("schedule_blocks", "schedule_rate", "schedule_rates"),
    Edge("schedule_blocks", "schedule_id", "schedules"),
    Edge("schedules", "activity_id", "activities"),
    Edge("schedules", "cost_center_id", "cost_centers"),
    Edge("schedules", "staff_id", "employees"),
    Edge("schedules", "job_id", "jobs"),
    Edge("schedules", "lead_id", "leads"),
    Edge("schedules", "quote_id", "quotes"),
)

# Every table comes after all tables it references.
LOAD_LEVELS = (
    ("employees", "sites", "activities", "quotes", "leads", "cost_centers", "job_statuses", "schedule_rates"),
    ("jobs",),
    ("schedules",),
    ("schedule_blocks",),
)

RESOURCE_TABLES = {
    "job": "jobs", "site": "sites", "schedule": "schedules", "activity": "activities",
    "employee": "employees", "cost_center": "cost_centers", "quote": "quotes", "lead": "leads",
}


def edges_of(child: str) -> list[Edge]:
    return [edge for edge in FK_EDGES if edge.child == child]


def required_columns(table: str) -> list[str]:
    return [field.name for field in CACHE_TABLES[table] if not field.nullable]


def payload_columns(table: str) -> list[str]:
    """The columns an upsert overwrites: all but the key."""
    return [name for name in CACHE_TABLES[table].names if name != "id"]
