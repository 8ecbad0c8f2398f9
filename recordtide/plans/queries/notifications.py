"""Signature, decoding and routing over the sample notifications."""

from pyspark.sql import functions as F

from recordtide.operators.notify import (
    classify_rejects,
    extract_operation,
    extract_resource,
    parse_notification,
    route_id,
    split_accept_reject,
    tenant_scope,
    verify_signature,
)
from recordtide.plans.registry import query
from recordtide.plans.sql import ACCEPTED, CLASSIFIED, DECODED, NOTES, SCOPED, with_ctes
from recordtide.plans.standins import SAMPLE_SECRET, notifications
from recordtide.session import cut_lineage


def classified(spark, sf_dir):
    return classify_rejects(notifications(spark, sf_dir), SAMPLE_SECRET)


@query("verify_signature", with_ctes(NOTES) + "SELECT event_id, signature_error FROM signed")
def verify(spark, sf_dir):
    return verify_signature(notifications(spark, sf_dir), SAMPLE_SECRET).select("event_id", "signature_error")


@query(
    "parse_notification",
    with_ctes(NOTES, DECODED)
    + "SELECT event_id, note_id, date_triggered, company_id, job_id, schedule_id, site_id FROM decoded",
)
def parse(spark, sf_dir):
    reference = F.col("payload.reference")
    return parse_notification(notifications(spark, sf_dir)).select(
        "event_id", F.col("payload.ID").alias("note_id"), "payload.date_triggered",
        reference["companyID"].alias("company_id"), reference["jobID"].alias("job_id"),
        reference["scheduleID"].alias("schedule_id"), reference["siteID"].alias("site_id"),
    )


@query("extract_resource", with_ctes(NOTES, DECODED, CLASSIFIED) + "SELECT event_id, note_id, resource FROM named")
def resource(spark, sf_dir):
    parsed = parse_notification(notifications(spark, sf_dir)).select("event_id", F.col("payload.ID").alias("note_id"))
    return parsed.withColumn("resource", extract_resource(F.col("note_id")))


@query("extract_operation", with_ctes(NOTES, DECODED, CLASSIFIED) + "SELECT event_id, note_id, operation FROM named")
def operation(spark, sf_dir):
    parsed = parse_notification(notifications(spark, sf_dir)).select("event_id", F.col("payload.ID").alias("note_id"))
    return parsed.withColumn("operation", extract_operation(F.col("note_id")))


@query("route_id", with_ctes(NOTES, DECODED, CLASSIFIED) + "SELECT event_id, resource, id FROM routed")
def route(spark, sf_dir):
    parsed = parse_notification(notifications(spark, sf_dir)).withColumn(
        "resource", extract_resource(F.col("payload.ID"))
    )
    return parsed.select("event_id", "resource", route_id(F.col("resource"), F.col("payload.reference")).alias("id"))


@query(
    "classify_rejects",
    with_ctes(NOTES, DECODED, CLASSIFIED) + "SELECT event_id, resource, operation, id, reject_reason FROM classified",
)
def rejects(spark, sf_dir):
    return classified(spark, sf_dir).select("event_id", "resource", "operation", "id", "reject_reason")


@query(
    "split_accept_reject",
    with_ctes(NOTES, DECODED, CLASSIFIED)
    + """SELECT event_id, CASE WHEN reject_reason IS NULL THEN 'accepted' ELSE 'rejected' END AS side, reject_reason
         FROM classified""",
)
def split(spark, sf_dir):
    checked = classified(spark, sf_dir).select("event_id", "reject_reason")
    accepted, rejected = split_accept_reject(cut_lineage(checked))
    return accepted.select("event_id", F.lit("accepted").alias("side"), F.lit(None).cast("string").alias("reject_reason")).unionAll(
        rejected.select("event_id", F.lit("rejected"), "reject_reason")
    )


@query(
    "tenant_scope",
    with_ctes(NOTES, DECODED, CLASSIFIED, ACCEPTED, SCOPED)
    + "SELECT event_id, resource, operation, id, company_id FROM scoped",
)
def tenant(spark, sf_dir):
    accepted, _ = split_accept_reject(classified(spark, sf_dir))
    return tenant_scope(accepted).select("event_id", "resource", "operation", "id", "company_id")
