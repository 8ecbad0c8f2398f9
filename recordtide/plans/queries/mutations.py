"""Upserts, deletes, ordered loads and constraint reports."""

from pyspark.sql import functions as F

from recordtide.operators.mutate import apply_changes, constraint_report, ordered_load, source_key_conflict, upsert
from recordtide.operators.nested import rows_from_record
from recordtide.plans.registry import query
from recordtide.plans.sql import CACHE, JOB_ROWS, SCHEDULE_ROWS, with_ctes
from recordtide.plans.standins import LINE_ORDER, cache_tables, job_records, schedule_lines, schedule_records, table
from recordtide.schemas import LOAD_LEVELS
from recordtide.session import cut_lineage, work_folder
from recordtide.sources.cache import Cache


def _base(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )


def _event_rows(spark, sf_dir):
    """One incoming row per event: sign-ups make new keys, errors carry a null name."""
    return table(spark, sf_dir, "events").select(
        F.expr("CASE WHEN event_type = 'signup' THEN user_id + 1000000 ELSE user_id END").alias("id"),
        F.expr("CASE WHEN event_type <> 'error' THEN event_type END").alias("name"),
        F.lit("incoming").alias("segment"), "event_id", "event_type",
        F.expr("cast(date_format(ts, 'dd') AS bigint)").alias("batch"),
    )


@query(
    "upsert",
    """WITH incoming AS (
         SELECT CASE WHEN event_type = 'signup' THEN user_id + 1000000 ELSE user_id END AS id,
           CASE WHEN event_type <> 'error' THEN event_type END AS name, event_id FROM events),
       delta AS (SELECT * FROM incoming QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id DESC) = 1)
       SELECT coalesce(c.c_custkey, d.id) AS id, CASE WHEN d.id IS NULL THEN c.c_name ELSE d.name END AS name,
         coalesce(c.c_mktsegment, 'incoming') AS segment
       FROM customer c FULL JOIN delta d ON c.c_custkey = d.id""",
)
def up(spark, sf_dir):
    incoming = _event_rows(spark, sf_dir).select("id", "name", "segment", "event_id")
    delta = source_key_conflict(incoming, "id", ["event_id"]).drop("event_id")
    return upsert(_base(spark, sf_dir), delta, "id", ["name"])


@query(
    "delete_by_id",
    """WITH incoming AS (
         SELECT CASE WHEN event_type = 'signup' THEN user_id + 1000000 ELSE user_id END AS id,
           CASE WHEN event_type <> 'error' THEN event_type END AS name, event_type = 'error' AS deleted,
           day(ts) AS batch, event_id FROM events),
       log AS (
         SELECT * FROM incoming QUALIFY row_number() OVER (PARTITION BY id, batch ORDER BY event_id DESC) = 1),
       drops AS (SELECT id, max(batch) AS dropped FROM log WHERE deleted GROUP BY id),
       last_state AS (
         SELECT l.id, l.name, l.deleted, d.dropped,
           (SELECT 'batch ' || min(f.batch) FROM log f WHERE f.id = l.id AND NOT f.deleted
              AND f.batch > coalesce(d.dropped, -1)) AS first_segment
         FROM (SELECT * FROM log QUALIFY row_number() OVER (PARTITION BY id ORDER BY batch DESC) = 1) l
         LEFT JOIN drops d USING (id))
       SELECT coalesce(c.c_custkey, s.id) AS id, CASE WHEN s.id IS NULL THEN c.c_name ELSE s.name END AS name,
         CASE WHEN s.id IS NULL OR (s.dropped IS NULL AND c.c_custkey IS NOT NULL) THEN c.c_mktsegment
              ELSE s.first_segment END AS segment
       FROM customer c FULL JOIN last_state s ON c.c_custkey = s.id
       WHERE s.deleted IS NOT TRUE""",
)
def delete(spark, sf_dir):
    """A log of daily batches with deletes and re-creations over the stored rows."""
    daily = source_key_conflict(_event_rows(spark, sf_dir), ["id", "batch"], ["event_id"])
    log = daily.withColumns(
        {"deleted": F.col("event_type") == "error", "segment": F.concat(F.lit("batch "), "batch")}
    )
    return apply_changes(_base(spark, sf_dir), cut_lineage(log), "id", F.col("batch"), ["name"], ["segment"])


@query(
    "source_key_conflict",
    with_ctes(CACHE)
    + "SELECT id, epoch_us(l_shipdate) AS shipped, l_partkey, l_suppkey, l_returnflag, l_linestatus FROM schedule_lines",
)
def conflict(spark, sf_dir):
    lines = source_key_conflict(schedule_lines(spark, sf_dir), "id", LINE_ORDER)
    shipped = F.unix_micros(F.concat(F.col("l_shipdate").cast("string"), F.lit("Z")).cast("timestamp"))
    return lines.select("id", shipped.alias("shipped"), "l_partkey", "l_suppkey", "l_returnflag", "l_linestatus")


_TABLES = [name for level in LOAD_LEVELS for name in level]


@query(
    "ordered_load",
    with_ctes(CACHE)
    + " UNION ALL ".join(
        f"SELECT {level} AS level, '{name}' AS table_name, count(*) AS n_rows, "
        f"{'sum(id)' if name != 'schedule_blocks' else 'sum(schedule_id)'}::BIGINT AS key_sum FROM {name}"
        for level, names in enumerate(LOAD_LEVELS)
        for name in names
    ),
)
def load(spark, sf_dir):
    """All eleven tables written level by level, then read back."""
    cache = Cache(spark, work_folder(spark, "load"))
    tables = {name: rows.withColumn("deleted", F.lit(False)) for name, rows in cache_tables(spark, sf_dir, stored=True).items()}
    with cache.transaction(0):
        order = ordered_load(tables, lambda name, rows: cache.write_changes(name, rows, 0))
    now = cache.snapshot()
    levels = {name: number for number, names in enumerate(LOAD_LEVELS) for name in names}
    parts = []
    for name in order:
        key = "id" if name != "schedule_blocks" else "schedule_id"
        counted = now.scan(name).agg(F.count("*").alias("n_rows"), F.sum(key).alias("key_sum"))
        parts.append(counted.select(F.lit(levels[name]).alias("level"), F.lit(name).alias("table_name"), "n_rows", "key_sum"))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result


@query(
    "constraint_report",
    with_ctes(CACHE, JOB_ROWS, SCHEDULE_ROWS)
    + """SELECT 'not_null' AS rule, 'jobs' AS table_name, unnest(string_split(reject_columns, ',')) AS column_name,
                id::VARCHAR AS key FROM job_rows WHERE reject_columns NOT IN ('', 'job_type')
                  AND NOT contains(reject_columns, ',job_type')
         UNION ALL SELECT 'not_null', 'jobs', c, id::VARCHAR
           FROM (SELECT id, unnest(string_split(reject_columns, ',')) AS c FROM job_rows
                 WHERE contains(reject_columns, ',job_type')) WHERE c <> 'job_type'
         UNION ALL SELECT 'enum', 'jobs', 'job_type', id::VARCHAR FROM job_rows WHERE job_type IS NULL
         UNION ALL SELECT 'not_null', 'schedules', 'schedule_type', id::VARCHAR FROM schedule_rows WHERE schedule_type IS NULL
         UNION ALL SELECT 'primary_key', 'schedules', 'id', id::VARCHAR FROM schedule_rows GROUP BY id HAVING count(*) > 1
         UNION ALL SELECT 'foreign_key', 'schedules', 'quote_id', id::VARCHAR FROM schedule_rows
           WHERE quote_id IS NOT NULL AND quote_id NOT IN (SELECT id FROM quotes)
         UNION ALL SELECT 'foreign_key', 'schedules', 'lead_id', id::VARCHAR FROM schedule_rows
           WHERE lead_id IS NOT NULL AND lead_id NOT IN (SELECT id FROM leads)""",
)
def report(spark, sf_dir):
    """Unfiltered job and schedule rows as the batch, the other tables as stored."""
    jobs = rows_from_record(job_records(spark, sf_dir), "job").drop("reject_columns")
    jobs = jobs.withColumn("job_type", F.coalesce("job_type", F.lit("Unknown")))
    schedules = rows_from_record(schedule_records(spark, sf_dir), "schedule").drop("reject_columns")
    stored = cache_tables(spark, sf_dir)
    for name in ("jobs", "schedules", "schedule_blocks"):
        stored.pop(name)
    found = constraint_report({"jobs": jobs, "schedules": schedules}, stored)
    return found.withColumnsRenamed({"table": "table_name", "column": "column_name"})
