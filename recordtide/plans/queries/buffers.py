"""Pending buckets and their collapse."""

from pyspark.sql import functions as F

from recordtide.operators.buffer import bucket_events, bucket_index, collapse_batch, dense_buckets, reverse_index
from recordtide.operators.notify import classify_rejects, split_accept_reject, tenant_scope
from recordtide.plans.registry import query
from recordtide.plans.sql import ACCEPTED, CLASSIFIED, COLLAPSED, DECODED, NOTES, SCOPED, with_ctes
from recordtide.plans.standins import SAMPLE_SECRET, micros, notifications

_BASE = (NOTES, DECODED, CLASSIFIED, ACCEPTED)

_CHUNKS = """
arrivals AS (SELECT resource, operation, id, count(*) AS n FROM accepted GROUP BY ALL),
chunks AS (
  SELECT resource, operation, id // 4096 AS chunk, string_agg(id || 'x' || n, ',' ORDER BY id) AS ids,
    sum(n)::BIGINT AS n_events
  FROM arrivals GROUP BY ALL)
"""

_DOMAIN = """
domain_pairs AS (
  SELECT resource, operation
  FROM (SELECT unnest(['job', 'site', 'schedule', 'activity', 'employee', 'cost_center', 'quote', 'lead']) AS resource),
       (SELECT unnest(['created', 'updated', 'deleted']) AS operation))
"""


def accepted(spark, sf_dir):
    return split_accept_reject(classify_rejects(notifications(spark, sf_dir), SAMPLE_SECRET))[0]


def _as_text(chunks):
    shown = F.transform("ids", lambda x: F.concat(x["id"].cast("string"), F.lit("x"), x["n"].cast("string")))
    return chunks.withColumn("ids", F.array_join(shown, ","))


@query("bucket_events", with_ctes(*_BASE, _CHUNKS) + "SELECT resource, operation, chunk, ids, n_events FROM chunks")
def buckets(spark, sf_dir):
    return _as_text(bucket_events(accepted(spark, sf_dir)))


@query(
    "bucket_index",
    with_ctes(*_BASE)
    + """SELECT event_id, code // 3 * 3 + code % 3 AS bucket, resource AS back_resource, operation AS back_operation
         FROM (SELECT *, CASE resource WHEN 'job' THEN 0 WHEN 'site' THEN 3 ELSE 6 END
                 + CASE operation WHEN 'created' THEN 0 WHEN 'updated' THEN 1 ELSE 2 END AS code FROM accepted)""",
)
def index(spark, sf_dir):
    coded = accepted(spark, sf_dir).select(
        "event_id", bucket_index(F.col("resource"), F.col("operation")).alias("bucket")
    )
    resource, operation = reverse_index(F.col("bucket"))
    return coded.select("event_id", "bucket", resource.alias("back_resource"), operation.alias("back_operation"))


@query(
    "dense_buckets",
    with_ctes(*_BASE, _CHUNKS, _DOMAIN)
    + """SELECT resource, operation, coalesce(chunk, 0) AS chunk, coalesce(ids, '') AS ids,
                coalesce(n_events, 0) AS n_events
         FROM domain_pairs LEFT JOIN chunks USING (resource, operation)""",
)
def dense(spark, sf_dir):
    return _as_text(dense_buckets(bucket_events(accepted(spark, sf_dir))))


@query(
    "collapse_batch",
    with_ctes(*_BASE, SCOPED, COLLAPSED)
    + "SELECT resource, id, operation, epoch_us(date_triggered::TIMESTAMPTZ) AS triggered_at FROM actions",
)
def collapse(spark, sf_dir):
    actions = collapse_batch(tenant_scope(accepted(spark, sf_dir)))
    return actions.withColumn("triggered_at", micros("triggered_at"))
