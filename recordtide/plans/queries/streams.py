"""Streaming runs over landed notifications, drained to the end."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordtide.operators.notify import classify_rejects, split_accept_reject
from recordtide.plans.registry import query
from recordtide.plans.sql import ACCEPTED, CLASSIFIED, DECODED, JOB_ROWS, NOTES, NOTIFICATIONS, SCHEDULE_ROWS, SITE_ROWS, with_ctes
from recordtide.plans.standins import SAMPLE_SECRET, micros, notifications, records, table
from recordtide.schemas import CACHE_TABLES
from recordtide.session import work_folder
from recordtide.sources.cache import Cache
from recordtide.sources.notifications import land_notifications, notification_source
from recordtide.sources.records import land_records, record_scan
from recordtide.streaming.drain import CacheSync, cache_upsert_sink, drain_batch, reject_sink

_EVENT_ID = T.StructType([T.StructField("event_id", T.LongType())])


def _land(spark, sf_dir, purpose):
    root = work_folder(spark, purpose)
    land_notifications(notifications(spark, sf_dir), f"{root}/landed")
    return root


def _drain(spark, root, handle):
    stream = notification_source(spark, f"{root}/landed", stream=True, extra=_EVENT_ID)
    drain_batch(stream, handle, f"{root}/checkpoint").awaitTermination()


@query(
    "notification_source",
    with_ctes(NOTES) + "SELECT event_id, lower(signature) AS signature, length(body) AS n_chars FROM notes",
)
def source(spark, sf_dir):
    root = _land(spark, sf_dir, "source")
    _drain(
        spark, root,
        lambda batch, batch_id: batch.withColumn("batch_id", F.lit(batch_id)).write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("batch_id").parquet(f"{root}/seen"),
    )
    return spark.read.parquet(f"{root}/seen").select(
        "event_id", F.lower("signature").alias("signature"), F.length("body").alias("n_chars")
    )


@query(
    "drain_batch",
    with_ctes(NOTES, DECODED, CLASSIFIED, ACCEPTED)
    + """SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 0 ELSE 1 END AS batch_id, resource, operation,
                count(*) AS n, sum(id)::BIGINT AS id_sum
         FROM accepted JOIN events USING (event_id) GROUP BY ALL""",
)
def drain(spark, sf_dir):
    """Two drains: the second one sees only what landed after the first."""
    root = work_folder(spark, "drain")
    early = table(spark, sf_dir, "events").where("ts < timestamp_ntz '2024-01-16 00:00:00'").select("event_id")
    envelopes = notifications(spark, sf_dir)

    def handle(batch, batch_id):
        accepted, _ = split_accept_reject(classify_rejects(batch, SAMPLE_SECRET))
        accepted.select("event_id", "resource", "operation", "id", F.lit(batch_id).cast("bigint").alias("batch_id")).write.mode(
            "overwrite"
        ).option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(f"{root}/drained")

    for how in ("left_semi", "left_anti"):
        land_notifications(envelopes.join(early, "event_id", how), f"{root}/landed")
        _drain(spark, root, handle)
    drained = spark.read.parquet(f"{root}/drained")
    return drained.groupBy("batch_id", "resource", "operation").agg(
        F.count("*").alias("n"), F.sum("id").alias("id_sum")
    )


@query(
    "reject_sink",
    with_ctes(NOTES, DECODED, CLASSIFIED)
    + "SELECT event_id, reject_reason FROM classified WHERE reject_reason IS NOT NULL",
)
def rejects(spark, sf_dir):
    root = _land(spark, sf_dir, "rejects")

    def handle(batch, batch_id):
        _, rejected = split_accept_reject(classify_rejects(batch, SAMPLE_SECRET))
        reject_sink(rejected, f"{root}/rejects", batch_id)

    _drain(spark, root, handle)
    return spark.read.parquet(f"{root}/rejects").select("event_id", "reject_reason")


# The row shown per cache table.
_LABELS = {
    "employees": "name", "sites": "address_address", "activities": "name", "quotes": "name", "leads": "name",
    "cost_centers": "name", "job_statuses": "color", "jobs": "name", "schedule_rates": "name",
    "schedules": "schedule_type",
}

_SYNC = """
wanted AS (SELECT resource, id FROM actions WHERE operation <> 'deleted'),
gone AS (SELECT resource, id FROM actions WHERE operation = 'deleted'),
versions AS (
  SELECT r.*, coalesce(r.schedule_type, 'visit') AS raw_type,
    CASE WHEN r.schedule_type = 'lead' THEN l_suppkey::VARCHAR
         WHEN r.schedule_type = 'activity' THEN v.l_partkey || CASE WHEN v.l_partkey % 97 = 0 THEN 'x' ELSE '' END
         WHEN v.l_partkey % 89 = 0 THEN v.l_orderkey::VARCHAR
         WHEN v.l_partkey % 83 = 0 THEN 'x-' || v.l_partkey
         ELSE v.l_orderkey || '-' || v.l_partkey END AS raw_reference
  FROM (SELECT *, row_number() OVER () AS rn FROM schedule_rows) r
  JOIN (SELECT l_orderkey, l_partkey, row_number() OVER () AS rn FROM lineitem) v USING (rn)),
latest AS (
  SELECT * FROM versions WHERE id IN (SELECT id FROM wanted WHERE resource = 'schedule')
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY date_modified DESC, notes DESC NULLS LAST, raw_reference DESC,
    raw_type DESC, l_suppkey::VARCHAR DESC) = 1),
sched AS (SELECT * FROM latest WHERE reject_columns = ''),
job_ids AS (
  SELECT id FROM wanted WHERE resource = 'job' UNION SELECT job_id FROM sched WHERE job_id IS NOT NULL),
job AS (
  SELECT * FROM job_rows WHERE reject_columns = '' AND id IN (SELECT id FROM job_ids)
    AND id NOT IN (SELECT id FROM gone WHERE resource = 'job')),
site_ids AS (SELECT id FROM wanted WHERE resource = 'site' UNION SELECT site_id FROM job),
site AS (
  SELECT * FROM site_rows WHERE reject_columns = '' AND id IN (SELECT id FROM site_ids)
    AND id NOT IN (SELECT id FROM gone WHERE resource = 'site'))
"""


@query(
    "cache_upsert_sink",
    with_ctes(*NOTIFICATIONS, SITE_ROWS, JOB_ROWS, SCHEDULE_ROWS, _SYNC)
    + """SELECT 'schedules' AS target, id, schedule_type AS label FROM sched
         UNION ALL SELECT 'jobs', id, name FROM job
         UNION ALL SELECT 'sites', id, address_address FROM site
         UNION ALL SELECT DISTINCT 'job_statuses', status_id,
           CASE status_id WHEN 1 THEN 'green' WHEN 2 THEN 'blue' ELSE 'grey' END FROM job
         UNION ALL SELECT DISTINCT 'schedule_rates', CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END,
           l_returnflag FROM sched WHERE l_linenumber % 3 > 0
         UNION ALL SELECT 'schedule_blocks', id, (epoch_us(l_shipdate) + (7 + pos) * 3600000000)::VARCHAR
           FROM sched, unnest(generate_series(1, l_linenumber % 3)) AS g(pos)
         UNION ALL SELECT 'employees', s_suppkey, s_name FROM supplier WHERE s_suppkey IN (SELECT staff_id FROM sched)
         UNION ALL SELECT 'activities', p_partkey, p_name FROM part WHERE p_partkey IN (SELECT activity_id FROM sched)
         UNION ALL SELECT 'cost_centers', p_partkey, p_brand FROM part
           WHERE p_partkey IN (SELECT cost_center_id FROM sched)
         UNION ALL SELECT 'quotes', o_orderkey, 'Quote ' || o_orderkey FROM orders
           WHERE o_orderkey IN (SELECT quote_id FROM sched)
         UNION ALL SELECT 'leads', c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT lead_id FROM sched)""",
)
def sync(spark, sf_dir):
    """Notifications and records land as JSON; one streaming drain fills the whole cache."""
    root = _land(spark, sf_dir, "sync")
    for resource in ("site", "job", "schedule", "employee", "activity", "cost_center", "quote", "lead"):
        land_records(records(spark, sf_dir, resource), f"{root}/records", resource)
    cache = Cache(spark, f"{root}/cache")
    job = CacheSync(
        cache, lambda resource: record_scan(spark, f"{root}/records", resource, landed=True), SAMPLE_SECRET, f"{root}/rejects"
    )
    stream = notification_source(spark, f"{root}/landed", stream=True)
    cache_upsert_sink(stream, job, f"{root}/checkpoint").awaitTermination()
    parts = [
        cache.scan(name).select(F.lit(name).alias("target"), "id", F.col(label).alias("label"))
        for name, label in _LABELS.items()
    ]
    parts.append(
        cache.scan("schedule_blocks").select(
            F.lit("schedule_blocks").alias("target"), F.col("schedule_id").alias("id"),
            micros("iso8601_start_time").cast("string").alias("label"),
        )
    )
    assert len(parts) == len(CACHE_TABLES)
    result = parts[0]
    for part in parts[1:]:
        result = result.unionAll(part)
    return result
