"""Joins, reference checks and closure over the eleven cache tables."""

from pyspark.sql import functions as F

from recordtide.operators.joins import fk_closure, fk_join, missing_refs, orphan_check, star_join
from recordtide.plans.queries.buffers import accepted
from recordtide.operators.buffer import collapse_batch
from recordtide.operators.notify import tenant_scope
from recordtide.plans.registry import query
from recordtide.plans.sql import CACHE, NOTIFICATIONS, with_ctes
from recordtide.plans.standins import cache_tables, micros, table
from recordtide.schemas import FK_EDGES, edges_of
from recordtide.session import work_folder
from recordtide.sources.cache import Cache, cache_scan
from recordtide.sources.references import ReferenceIndex
from recordtide.sources.references import batch_orphans as orphans_of_batch


_CHANGED_SITES = """SELECT s.id, s.address_address,
                CASE WHEN a.id IS NULL THEN s.address_country ELSE a.operation END AS address_country,
                CASE WHEN a.id IS NULL THEN s.date_modified ELSE epoch_us(a.date_triggered::TIMESTAMPTZ) END AS date_modified
         FROM sites s LEFT JOIN (SELECT * FROM actions WHERE resource = 'site') a USING (id)
         WHERE a.operation IS DISTINCT FROM 'deleted'"""


@query(
    "cache_scan",
    with_ctes(CACHE, *NOTIFICATIONS) + _CHANGED_SITES,
)
def scan(spark, sf_dir):
    """Seed, compact, log a second batch of changes, then read through the view."""
    cache = Cache(spark, work_folder(spark, "cache"))
    sites = cache_tables(spark, sf_dir)["sites"]
    cache.write_changes("sites", sites.withColumn("deleted", F.lit(False)), 0)
    cache.compact("sites")
    actions = collapse_batch(tenant_scope(accepted(spark, sf_dir))).where("resource = 'site'")
    touched = sites.join(actions, "id").withColumns(
        {
            "deleted": F.col("operation") == "deleted",
            "address_country": F.col("operation"),
            "date_modified": F.col("triggered_at"),
        }
    )
    cache.write_changes("sites", touched, 1)
    return cache_scan(spark, cache.root, "sites").select(
        "id", "address_address", "address_country", micros("date_modified").alias("date_modified")
    )


@query(
    "cache_snapshot",
    with_ctes(CACHE, *NOTIFICATIONS)
    + f"""SELECT 'sites' AS target, id, address_country AS label FROM ({_CHANGED_SITES})
         UNION ALL SELECT 'leads', id, name FROM leads
         UNION ALL SELECT 'jobs', id, name FROM jobs""",
)
def snapshot(spark, sf_dir):
    """A committed batch over a compacted base shows in all tables, one that stopped before its commit in none."""
    cache = Cache(spark, work_folder(spark, "snapshot"))
    tables = {name: cache_tables(spark, sf_dir)[name] for name in ("sites", "leads", "jobs")}
    with cache.transaction(0):
        cache.write_changes("sites", tables["sites"].withColumn("deleted", F.lit(False)), 0)
        cache.write_changes("leads", tables["leads"].withColumn("deleted", F.lit(False)), 0)
    cache.compact("sites")
    actions = collapse_batch(tenant_scope(accepted(spark, sf_dir))).where("resource = 'site'")
    changed = tables["sites"].join(actions, "id").withColumn("deleted", F.col("operation") == "deleted")
    with cache.transaction(1):
        cache.write_changes("sites", changed.withColumn("address_country", F.col("operation")), 1)
        cache.write_changes("jobs", tables["jobs"].withColumn("deleted", F.lit(False)), 1)
    try:
        with cache.transaction(2):
            cache.write_changes("leads", tables["leads"].withColumn("deleted", F.lit(True)), 2)
            raise InterruptedError
    except InterruptedError:
        pass
    labels = {"sites": "address_country", "leads": "name", "jobs": "name"}
    now = cache.snapshot(labels)
    parts = [now.scan(name).select(F.lit(name).alias("target"), "id", F.col(label).alias("label")) for name, label in labels.items()]
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query(
    "cache_compaction",
    with_ctes(CACHE)
    + """SELECT id, schedule_type, CASE WHEN id IN (SELECT event_id FROM events) THEN 'changed' ELSE notes END AS notes
         FROM schedules WHERE id NOT IN (SELECT user_id FROM events WHERE user_id IS NOT NULL)""",
)
def compaction(spark, sf_dir):
    """All schedules in a base of small files, then two rounds of changes folded into the files they touch."""
    cache = Cache(spark, work_folder(spark, "compaction"), rows_per_file=5000)
    schedules = cache_tables(spark, sf_dir, stored=True)["schedules"]
    events = table(spark, sf_dir, "events")
    cache.write_changes("schedules", schedules.withColumn("deleted", F.lit(False)), 0)
    cache.compact("schedules")
    named = schedules.join(events.select(F.col("event_id").alias("id")), "id", "left_semi")
    cache.write_changes("schedules", named.withColumns({"notes": F.lit("changed"), "deleted": F.lit(False)}), 1)
    cache.compact("schedules")
    gone = schedules.join(events.select(F.col("user_id").alias("id")).distinct(), "id", "left_semi")
    cache.write_changes("schedules", gone.withColumn("deleted", F.lit(True)), 2)
    cache.compact("schedules")
    return cache.scan("schedules").select("id", "schedule_type", "notes")


@query(
    "fk_join",
    with_ctes(CACHE)
    + """SELECT s.id, s.schedule_type, e.name AS staff_name, j.name AS job_name, j.site_id AS job_site_id
         FROM schedules s JOIN employees e ON s.staff_id = e.id LEFT JOIN jobs j ON s.job_id = j.id""",
)
def join(spark, sf_dir):
    cache = cache_tables(spark, sf_dir)
    staffed = fk_join(cache["schedules"], cache["employees"], "staff_id", "staff")
    return fk_join(staffed, cache["jobs"], "job_id", "job", optional=True).select(
        "id", "schedule_type", "staff_name", "job_name", "job_site_id"
    )


@query(
    "star_join",
    with_ctes(CACHE)
    + """SELECT s.id, s.schedule_type, e.name AS staff_name, j.name AS job_name, t.address_city AS site_address_city,
                st.color AS status_color, a.name AS activity_name, c.name AS cost_center_name, q.name AS quote_name,
                l.name AS lead_name, b.iso8601_start_time, r.name AS rate_name
         FROM schedules s
         LEFT JOIN jobs j ON s.job_id = j.id LEFT JOIN sites t ON j.site_id = t.id
         LEFT JOIN job_statuses st ON j.status_id = st.id LEFT JOIN employees e ON s.staff_id = e.id
         LEFT JOIN activities a ON s.activity_id = a.id LEFT JOIN cost_centers c ON s.cost_center_id = c.id
         LEFT JOIN quotes q ON s.quote_id = q.id LEFT JOIN leads l ON s.lead_id = l.id
         LEFT JOIN schedule_blocks b ON b.schedule_id = s.id LEFT JOIN schedule_rates r ON b.schedule_rate = r.id""",
)
def star(spark, sf_dir):
    wide = star_join(cache_tables(spark, sf_dir, stored=True))
    return wide.select(
        "id", "schedule_type", "staff_name", "job_name", F.col("job_site_address_city").alias("site_address_city"),
        F.col("job_status_color").alias("status_color"), "activity_name",
        "cost_center_name", "quote_name", "lead_name", micros("iso8601_start_time").alias("iso8601_start_time"),
        "rate_name",
    )


def _absent(edge) -> str:
    return f"{edge.column} NOT IN (SELECT id FROM {edge.parent})"


@query(
    "missing_refs",
    with_ctes(CACHE)
    + " UNION ALL ".join(
        f"SELECT DISTINCT '{edge.parent}' AS target, {edge.column} AS id FROM schedules "
        f"WHERE {edge.column} IS NOT NULL AND {_absent(edge)}"
        for edge in edges_of("schedules")
    ),
)
def missing(spark, sf_dir):
    cache = cache_tables(spark, sf_dir)
    return missing_refs(cache["schedules"], edges_of("schedules"), cache)


@query(
    "orphan_check",
    with_ctes(CACHE)
    + " UNION ALL ".join(
        f"SELECT '{edge.child}' AS child, id, '{edge.column}' AS fk_column, '{edge.parent}' AS target, {edge.column} AS fk "
        f"FROM {edge.child} WHERE {edge.column} IS NOT NULL AND {_absent(edge)}"
        for edge in FK_EDGES
        if edge.child != "schedule_blocks"
    ),
)
def orphans(spark, sf_dir):
    return orphan_check(cache_tables(spark, sf_dir, stored=True)).withColumnRenamed("column", "fk_column")


_CLOSURE = """
seed AS (SELECT * FROM schedules),
seed_jobs AS (SELECT DISTINCT job_id AS id FROM seed WHERE job_id IS NOT NULL),
job_refs AS (SELECT * FROM jobs WHERE id IN (SELECT id FROM seed_jobs)),
needed AS (
  SELECT 'schedules' AS target, id FROM seed
  UNION SELECT 'jobs', id FROM seed_jobs
  UNION SELECT 'sites', site_id FROM job_refs
  UNION SELECT 'job_statuses', status_id FROM job_refs
  UNION SELECT 'employees', staff_id FROM seed
  UNION SELECT 'activities', activity_id FROM seed WHERE activity_id IS NOT NULL
  UNION SELECT 'cost_centers', cost_center_id FROM seed WHERE cost_center_id IS NOT NULL
  UNION SELECT 'quotes', quote_id FROM seed WHERE quote_id IS NOT NULL
  UNION SELECT 'leads', lead_id FROM seed WHERE lead_id IS NOT NULL),
stored AS (
  SELECT 'schedules' AS target, id FROM schedules UNION ALL SELECT 'jobs', id FROM jobs
  UNION ALL SELECT 'sites', id FROM sites UNION ALL SELECT 'job_statuses', id FROM job_statuses
  UNION ALL SELECT 'employees', id FROM employees UNION ALL SELECT 'activities', id FROM activities
  UNION ALL SELECT 'cost_centers', id FROM cost_centers UNION ALL SELECT 'quotes', id FROM quotes
  UNION ALL SELECT 'leads', id FROM leads)
"""


@query(
    "fk_closure",
    with_ctes(CACHE, _CLOSURE)
    + """SELECT n.target, n.id, s.id IS NOT NULL AS present
         FROM needed n LEFT JOIN stored s ON n.target = s.target AND n.id = s.id""",
)
def closure(spark, sf_dir):
    cache = cache_tables(spark, sf_dir, stored=True)
    return fk_closure(cache, {"schedules": cache["schedules"]})


_BATCH_REFS = """
         SELECT 'jobs' AS child, j.id, 'site_id' AS column_name, 'sites' AS target, j.site_id AS fk, n.site_id AS new_fk
           FROM jobs j JOIN new_jobs n USING (id)
         UNION ALL SELECT 'schedules', id, 'quote_id', 'quotes', quote_id, quote_id FROM schedules
         UNION ALL SELECT 'schedules', id, 'staff_id', 'employees', staff_id, staff_id FROM schedules"""


@query(
    "batch_orphans",
    with_ctes(CACHE)
    + f""", new_jobs AS (
           SELECT id, CASE WHEN status_id = 3 THEN site_id + 1000000000000 ELSE site_id END AS site_id FROM jobs),
         refs AS ({_BATCH_REFS}),
         old_ids AS (
           SELECT 'sites' AS target, id FROM sites UNION ALL SELECT 'quotes', id FROM quotes
           UNION ALL SELECT 'employees', id FROM employees),
         new_ids AS (
           SELECT 'sites' AS target, id FROM sites WHERE address_country <> 'BUILDING'
           UNION ALL SELECT 'quotes', id FROM quotes WHERE id NOT IN (SELECT o_orderkey FROM orders WHERE o_orderpriority = '1-URGENT')
           UNION ALL SELECT 'employees', id FROM employees)
         SELECT child, id, column_name, target, new_fk AS fk FROM refs r
         WHERE new_fk IS NOT NULL
           AND NOT EXISTS (SELECT 1 FROM new_ids n WHERE n.target = r.target AND n.id = r.new_fk)
           AND (fk IS DISTINCT FROM new_fk OR EXISTS (SELECT 1 FROM old_ids o WHERE o.target = r.target AND o.id = r.fk))""",
)
def batch_orphans(spark, sf_dir):
    """A batch deletes sites and quotes and moves jobs to sites that do not exist; references broken before are not reported."""
    cache = Cache(spark, work_folder(spark, "orphans"))
    tables = cache_tables(spark, sf_dir, stored=True)
    with cache.transaction(0):
        for name in ("sites", "employees", "quotes", "leads", "activities", "cost_centers", "job_statuses", "jobs", "schedules"):
            cache.write_changes(name, tables[name].withColumn("deleted", F.lit(False)), 0)
        ReferenceIndex(cache).log_batch(0)
    for name in ("sites", "quotes", "jobs", "schedules"):
        cache.compact(name)
    ReferenceIndex(cache).compact()
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_orderkey").alias("id"))
    moved = tables["jobs"].where("status_id = 3").withColumn("site_id", F.col("site_id") + 1_000_000_000_000)
    with cache.transaction(1):
        cache.write_changes("sites", tables["sites"].where("address_country = 'BUILDING'").withColumn("deleted", F.lit(True)), 1)
        cache.write_changes("quotes", tables["quotes"].join(urgent, "id", "left_semi").withColumn("deleted", F.lit(True)), 1)
        cache.write_changes("jobs", moved.withColumn("deleted", F.lit(False)), 1)
        ReferenceIndex(cache).log_batch(1)
    return orphans_of_batch(cache, 1).withColumnRenamed("column", "column_name")
