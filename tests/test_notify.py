import hashlib
import hmac
import json

import pytest
from pyspark.sql import functions as F

from recordtide.operators.buffer import (
    BUCKETS,
    bucket_domain,
    bucket_events,
    bucket_index,
    collapse_batch,
    dense_buckets,
    reverse_index,
)
from recordtide.operators.notify import (
    classify_rejects,
    extract_operation,
    extract_resource,
    split_accept_reject,
    tenant_scope,
)

SECRET = "test key"


def sign(body, secret=SECRET):
    return hmac.new(secret.encode(), body.encode(), hashlib.sha1).hexdigest()


def body(identifier="job.created", reference=None, stamp="2024-05-01T10:00:00Z", **extra):
    return json.dumps({"ID": identifier, "reference": reference or {}, "date_triggered": stamp, **extra})


JOB = body(reference={"jobID": 7})
CASES = {
    "accepted": (sign(JOB), JOB, ("job", "created", 7), None),
    "upper-case hex": (sign(JOB).upper(), JOB, ("job", "created", 7), None),
    "no header": (None, JOB, None, "missing_signature"),
    "header not ascii": (sign(JOB) + "é", JOB, None, "invalid_signature"),
    "header with line break": (sign(JOB) + "\n", JOB, None, "invalid_signature"),
    "not hex": ("zz" + sign(JOB)[2:], JOB, None, "undecodable_signature"),
    "odd length": (sign(JOB)[1:], JOB, None, "undecodable_signature"),
    "empty header": ("", JOB, None, "signature_mismatch"),
    "zero bytes": ("00" * 20, JOB, None, "signature_mismatch"),
    "short digest": (sign(JOB)[:38], JOB, None, "signature_mismatch"),
    "other key": (sign(JOB, "other"), JOB, None, "signature_mismatch"),
    "both bad": ("00" * 20, "{", None, "signature_mismatch"),
}
GOOD_BODIES = {
    "first segment wins": (body("job.schedule.created", {"jobID": 7, "scheduleID": 9}), ("job", "created", 7)),
    "prefix skipped": (body("company.site.updated", {"siteID": 3}), ("site", "updated", 3)),
    "schedule": (body("schedule.deleted", {"scheduleID": 0}), ("schedule", "deleted", 0)),
    "extra fields": (body("job.created", {"jobID": 7, "x": [1]}, more={"ID": 5}), ("job", "created", 7)),
    "null ids": (body("job.created", {"jobID": 7, "siteID": None}), ("job", "created", 7)),
    "largest id": (body("job.created", {"jobID": 2**63 - 1}), ("job", "created", 2**63 - 1)),
    "white space": ("  " + JOB.replace(":", " : ") + "\n", ("job", "created", 7)),
    "text outside ascii": (body("é.job.created", {"jobID": 7}), ("job", "created", 7)),
    "unreadable date is still text": (body("job.created", {"jobID": 7}, "soon"), ("job", "created", 7)),
}
BAD_BODIES = {
    "broken json": ('{"ID":"job.created"', "bad_payload"),
    "empty": ("", "bad_payload"),
    "trailing text": (JOB + " x", "bad_payload"),
    "two values": (JOB + "," + JOB, "bad_payload"),
    "closing bracket behind": (JOB + "]", "bad_payload"),
    "single quotes": (JOB.replace('"', "'"), "bad_payload"),
    "not an object": ("[1]", "bad_payload"),
    "text id": (body("job.created", {"jobID": "7"}), "bad_payload"),
    "fraction id": (body("job.created", {"jobID": 7.0}), "bad_payload"),
    "exponent id": (JOB.replace("7", "7e0"), "bad_payload"),
    "negative id": (body("job.created", {"jobID": -7}), "bad_payload"),
    "id too large": (body("job.created", {"jobID": 2**63}), "bad_payload"),
    "bad id that is not needed": (body("job.created", {"jobID": 7, "siteID": "x"}), "bad_payload"),
    "boolean id": (body("job.created", {"jobID": True}), "bad_payload"),
    "number as identifier": (body(5, {"jobID": 7}), "bad_payload"),
    "missing reference": (json.dumps({"ID": "job.created", "date_triggered": "x"}), "bad_payload"),
    "null reference": (json.dumps({"ID": "job.created", "reference": None, "date_triggered": "x"}), "bad_payload"),
    "array reference": (json.dumps({"ID": "job.created", "reference": [7], "date_triggered": "x"}), "bad_payload"),
    "missing date": (json.dumps({"ID": "job.created", "reference": {"jobID": 7}}), "bad_payload"),
    "null date": (body("job.created", {"jobID": 7}, None), "bad_payload"),
    "unknown resource": (body("quote.created", {"jobID": 7}), "missing_resource"),
    "resource inside a word": (body("jobs.created", {"jobID": 7}), "missing_resource"),
    "unknown operation": (body("job.archived", {"jobID": 7}), "missing_operation"),
    "operation not last": (body("job.created.x", {"jobID": 7}), "missing_operation"),
    "operation with line break": (body("job.created\n", {"jobID": 7}), "missing_operation"),
    "wrong id present": (body("job.created", {"siteID": 7}), "missing_resource_id"),
    "resource before operation": (body("quote.archived"), "missing_resource"),
}
ALL = {
    **CASES,
    **{name: (sign(text), text, want, None) for name, (text, want) in GOOD_BODIES.items()},
    **{name: (sign(text), text, None, reason) for name, (text, reason) in BAD_BODIES.items()},
}


def test_classify(spark):
    df = spark.createDataFrame([(n, s, b) for n, (s, b, *_) in ALL.items()], "name string, signature string, body string")
    rows = {row.name: row for row in classify_rejects(df, SECRET).collect()}
    assert {n: r.reject_reason for n, r in rows.items()} == {n: reason for n, (*_, reason) in ALL.items()}
    accepted = {n: (r.resource, r.operation, r.id) for n, r in rows.items() if r.reject_reason is None}
    assert accepted == {n: want for n, (_, _, want, reason) in ALL.items() if reason is None}


def test_accepted_plus_rejected_is_the_input(spark):
    df = spark.createDataFrame([(n, s, b) for n, (s, b, *_) in ALL.items()], "name string, signature string, body string")
    accepted, rejected = split_accept_reject(classify_rejects(df, SECRET))
    assert sorted([r.name for r in accepted.collect()] + [r.name for r in rejected.collect()]) == sorted(ALL)


def test_long_secret_is_hashed_first(spark):
    secret = "s" * 65
    df = spark.createDataFrame([(sign(JOB, secret), JOB)], "signature string, body string")
    assert classify_rejects(df, secret).first().reject_reason is None


def test_secret_is_not_in_the_plan(spark, capsys):
    df = spark.createDataFrame([(sign(JOB), JOB)], "signature string, body string")
    classify_rejects(df, SECRET).explain("extended")
    shown = capsys.readouterr().out
    inner = bytes(b ^ 0x36 for b in SECRET.encode())
    assert SECRET not in shown and inner.hex().upper() not in shown.upper() and "Python" not in shown


def test_work_is_not_repeated_in_filters(spark, capsys):
    df = spark.createDataFrame([(sign(JOB), JOB)], "signature string, body string")
    accepted, _ = split_accept_reject(classify_rejects(df, SECRET))
    tenant_scope(accepted).explain()
    assert capsys.readouterr().out.count("parseJson") == 1


def test_tenant_scope(spark):
    df = spark.createDataFrame([(1, None), (2, 0), (3, 1)], "id long, company_id long")
    assert [r.id for r in tenant_scope(df).orderBy("id").collect()] == [1, 2]
    assert [r.id for r in tenant_scope(df, 1).collect()] == [3]


@pytest.mark.parametrize(
    "identifier, resource, operation",
    [
        ("job.schedule.created", "job", "created"), ("a.b", None, None), ("site", "site", None), ("", None, None),
        ("created", None, "created"), ("job.created.", "job", None), (".site.deleted", "site", "deleted"),
    ],
)
def test_segments(spark, identifier, resource, operation):
    df = spark.createDataFrame([(identifier,)], "t string")
    assert tuple(df.select(extract_resource(F.col("t")), extract_operation(F.col("t"))).first()) == (resource, operation)


def test_bucket_code_and_back(spark):
    domain = bucket_domain(spark).withColumn("code", bucket_index(F.col("resource"), F.col("operation")))
    resource, operation = reverse_index(F.col("code"))
    rows = domain.select("code", "resource", "operation", resource.alias("r"), operation.alias("o")).collect()
    assert sorted(r.code for r in rows) == list(range(BUCKETS))
    assert all((r.resource, r.operation) == (r.r, r.o) for r in rows)


def test_buckets_keep_duplicates_and_stay_small(spark):
    hot = spark.range(3000).selectExpr("'job' resource", "'updated' operation", "7L id")
    wide = spark.range(10000).selectExpr("'job' resource", "'updated' operation", "id")
    chunks = bucket_events(hot.unionAll(wide), bits=8).collect()
    assert max(len(c.ids) for c in chunks) <= 256
    counts = {x.id: x.n for c in chunks for x in c.ids}
    assert counts[7] == 3001 and len(counts) == 10000 and sum(c.n_events for c in chunks) == 13000


def test_dense_buckets_always_have_24_pairs(spark):
    empty = spark.createDataFrame([], "resource string, operation string, id long")
    assert dense_buckets(bucket_events(empty)).count() == BUCKETS
    one = spark.createDataFrame([("job", "created", 7)], empty.schema)
    rows = dense_buckets(bucket_events(one)).collect()
    assert len(rows) == BUCKETS and [len(r.ids) for r in rows if (r.resource, r.operation) == ("job", "created")] == [1]


def test_collapse(spark):
    rows = [
        ("job", 1, "created", "2024-05-01T10:00:00Z"), ("job", 1, "updated", "2024-05-01T10:00:01Z"),
        ("job", 2, "deleted", "2024-05-01T10:00:00Z"), ("job", 2, "created", "2024-05-01T11:00:00+10:00"),
        ("job", 3, "created", "2024-05-01T10:00:00Z"), ("job", 3, "deleted", "2024-05-01T20:00:00+10:00"),
        ("job", 4, "deleted", "soon"), ("job", 4, "updated", "2024-05-01T10:00:00Z"),
        ("site", 1, "updated", "soon"), ("site", 1, "created", "later"),
    ]
    df = spark.createDataFrame(rows, "resource string, id long, operation string, date_triggered string")
    got = {(r.resource, r.id): r.operation for r in collapse_batch(df).collect()}
    assert got == {("job", 1): "updated", ("job", 2): "deleted", ("job", 3): "deleted", ("job", 4): "updated", ("site", 1): "updated"}
