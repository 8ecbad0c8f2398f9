"""Notification checks: signature, strict decoding, routing, rejects, tenant.

Each operator takes rows with ``signature`` and ``body`` text and passes every
other column through. All of it is one projection without a shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.functions.once import with_columns_once
from recordtide.functions.signing import hmac_sha1
from recordtide.schemas import DEFAULT_COMPANY, NOTIFIED_RESOURCES, OPERATIONS, REFERENCE_IDS


def verify_signature(df: DataFrame, secret: str) -> DataFrame:
    """Add ``signature_error``: null when the header holds the HMAC-SHA1 of the body."""
    header = F.col("signature")
    error = (
        F.when(header.isNull(), "missing_signature")
        .when(~header.rlike(r"\A[\t\x20-\x7e]*\z"), "invalid_signature")
        .when(~header.rlike(r"\A([0-9a-fA-F]{2})*\z"), "undecodable_signature")
        .when(F.lower(header) != hmac_sha1(df.sparkSession, secret, F.coalesce("body", F.lit(""))), "signature_mismatch")
    )
    return with_columns_once(df, {"signature_error": error})


def _payload_type(text: str, number: str) -> str:
    ids = ", ".join(f"{name} {number}" for name in REFERENCE_IDS)
    return f"struct<ID {text}, reference struct<{ids}>, date_triggered {text}>"


def _json_kind(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value), F.lit("VOID"))


def parse_notification(df: DataFrame) -> DataFrame:
    """Add ``payload``: the decoded body, or null unless every field has its exact type.

    Unknown keys are fine. Ids must be JSON integers from 0 to 2^63-1, or absent.
    """
    # The JSON reader stops after one value. As an array with a digest behind it,
    # a body with trailing text no longer reads as exactly two elements.
    mark = F.md5(F.coalesce("body", F.lit("")))
    wrapped = F.concat(F.lit("["), "body", F.lit(',"'), "_mark", F.lit('"]'))
    read = df.withColumn("_mark", mark).withColumn("_doc", F.try_parse_json(wrapped))
    # Casts are lenient ("7" and 7.0 read as 7), so the kinds found are checked beside the values.
    read = read.withColumns(
        {
            "_whole": F.try_variant_get("_doc", "$[1]", "string") == F.col("_mark"),
            "_found": F.try_variant_get("_doc", "$[0]", _payload_type("variant", "variant")),
            "_typed": F.try_variant_get("_doc", "$[0]", _payload_type("string", "bigint")),
        }
    )
    found, typed = F.col("_found"), F.col("_typed")
    sound = F.col("_whole") & found["reference"].isNotNull()
    for name in ("ID", "date_triggered"):
        sound = sound & (_json_kind(found[name]) == "STRING")
    for name in REFERENCE_IDS:
        in_range = F.coalesce(typed["reference"][name] >= 0, F.lit(True))
        sound = sound & _json_kind(found["reference"][name]).isin("VOID", "BIGINT") & in_range
    return with_columns_once(read, {"payload": F.when(sound, typed)}).drop("_mark", "_doc", "_whole", "_found", "_typed")


def extract_resource(identifier: Column) -> Column:
    """The first dot-segment that names a notified resource."""
    segment = rf"(?:\A|\.)({'|'.join(NOTIFIED_RESOURCES)})(?=\.|\z)"
    return F.nullif(F.regexp_extract(identifier, segment, 1), F.lit(""))


def extract_operation(identifier: Column) -> Column:
    """The last dot-segment, when it is an operation."""
    segment = rf"(?:\A|\.)({'|'.join(OPERATIONS)})\z"
    return F.nullif(F.regexp_extract(identifier, segment, 1), F.lit(""))


def route_id(resource: Column, reference: Column) -> Column:
    """The reference id that belongs to the resource."""
    return F.coalesce(
        *[F.when(resource == name, reference.getField(field)) for name, field in NOTIFIED_RESOURCES.items()]
    )


def classify_rejects(df: DataFrame, secret: str) -> DataFrame:
    """Validate fully. Adds ``resource``, ``operation``, ``id``, ``company_id``,
    ``date_triggered`` and ``reject_reason``, the first check that failed."""
    checked = parse_notification(verify_signature(df, secret))
    payload = F.col("payload")
    named = checked.withColumns(
        {
            "resource": extract_resource(payload["ID"]),
            "operation": extract_operation(payload["ID"]),
            "company_id": payload["reference"]["companyID"],
            "date_triggered": payload["date_triggered"],
        }
    )
    target = route_id(F.col("resource"), payload["reference"])
    reason = F.coalesce(
        "signature_error",
        F.when(payload.isNull(), "bad_payload"),
        F.when(F.col("resource").isNull(), "missing_resource"),
        F.when(F.col("operation").isNull(), "missing_operation"),
        F.when(target.isNull(), "missing_resource_id"),
    )
    return with_columns_once(named, {"id": target, "reject_reason": reason}).drop("signature_error", "payload")


def split_accept_reject(classified: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected). Persist or write out ``classified`` first when both sides are used."""
    accepted = classified.where(F.col("reject_reason").isNull()).drop("reject_reason")
    return accepted, classified.where(F.col("reject_reason").isNotNull())


def tenant_scope(accepted: DataFrame, company: int = DEFAULT_COMPANY) -> DataFrame:
    """Rows of one company; an absent company counts as the default one."""
    return accepted.where(F.coalesce("company_id", F.lit(DEFAULT_COMPANY)) == company)
