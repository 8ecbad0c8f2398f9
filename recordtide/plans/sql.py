"""The stand-in inputs of ``standins`` as SQL common table expressions, for the result checks."""

from recordtide.functions.signing import key_pads
from recordtide.plans.standins import SAMPLE_SECRET

_INNER, _OUTER = (pad.hex() for pad in key_pads(SAMPLE_SECRET))


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(cte.strip() for cte in ctes) + "\n"


_HMAC = f"sha1(unhex('{_OUTER}') || unhex(sha1(unhex('{_INNER}') || encode(body))))"

NOTES = f"""
note_parts AS (
  SELECT event_id,
    CASE user_id % 4 WHEN 0 THEN 'job' WHEN 1 THEN 'site' WHEN 2 THEN 'schedule' ELSE 'quote' END AS word,
    CASE WHEN event_id % 53 = 0 THEN 'archived' WHEN event_type = 'signup' THEN 'created'
         WHEN event_type = 'error' THEN 'deleted' ELSE 'updated' END AS op,
    CASE event_id % 10 WHEN 0 THEN '1' WHEN 1 THEN 'null' ELSE '0' END AS company,
    CASE WHEN event_id % 59 = 0 THEN 'null' WHEN event_id % 61 = 0 THEN '"' || user_id || '"'
         ELSE user_id::VARCHAR END AS ref,
    strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS stamp
  FROM events),
note_bodies AS (
  SELECT event_id, '{{"ID":' || CASE WHEN event_id % 73 = 0 THEN '5' ELSE '"' ||
      CASE WHEN event_id % 5 = 0 THEN 'company.' ELSE '' END || word ||
      CASE WHEN word = 'job' AND event_id % 7 = 0 THEN '.schedule' ELSE '' END || '.' || op || '"' END ||
    ',"reference":{{"companyID":' || company ||
    ',"jobID":' || CASE WHEN word = 'job' THEN ref ELSE 'null' END ||
    ',"scheduleID":' || CASE WHEN word = 'schedule' THEN ref ELSE 'null' END ||
    ',"siteID":' || CASE WHEN word = 'site' THEN ref ELSE 'null' END ||
    ',"extra":1}},"date_triggered":"' || stamp || '"' ||
    CASE WHEN event_id % 50 = 0 THEN '' WHEN event_id % 71 = 0 THEN '}} x' ELSE '}}' END AS body
  FROM note_parts),
note_digests AS (SELECT event_id, body, {_HMAC} AS digest FROM note_bodies),
notes AS (
  SELECT event_id, body, digest,
    CASE WHEN event_id % 37 = 0 THEN repeat('0', 40)
         WHEN event_id % 41 = 0 THEN NULL
         WHEN event_id % 43 = 0 THEN 'zz' || digest
         WHEN event_id % 47 = 0 THEN substr(digest, 1, 39)
         WHEN event_id % 67 = 0 THEN digest || 'é'
         WHEN event_id % 2 = 0 THEN upper(digest)
         ELSE digest END AS signature
  FROM note_digests),
signed AS (
  SELECT event_id, body, signature,
    CASE WHEN signature IS NULL THEN 'missing_signature'
         WHEN NOT regexp_full_match(signature, '[\\x20-\\x7e]*') THEN 'invalid_signature'
         WHEN NOT regexp_full_match(signature, '([0-9a-fA-F]{{2}})*') THEN 'undecodable_signature'
         WHEN lower(signature) <> digest THEN 'signature_mismatch' END AS signature_error
  FROM notes)
"""


def _id(name: str) -> str:
    return f"json_type(doc, '$.reference.{name}') IS NULL OR json_type(doc, '$.reference.{name}') IN ('UBIGINT', 'NULL')"


DECODED = f"""
documents_or_null AS (
  SELECT event_id, signature_error, CASE WHEN json_valid(body) THEN body END AS doc FROM signed),
checked AS (
  SELECT event_id, signature_error, doc,
    coalesce(json_type(doc, '$.ID') = 'VARCHAR' AND json_type(doc, '$.date_triggered') = 'VARCHAR'
      AND json_type(doc, '$.reference') = 'OBJECT'
      AND ({_id('companyID')}) AND ({_id('jobID')}) AND ({_id('scheduleID')}) AND ({_id('siteID')}), false) AS sound
  FROM documents_or_null),
decoded AS (
  SELECT event_id, signature_error, sound,
    CASE WHEN sound THEN doc ->> '$.ID' END AS note_id,
    CASE WHEN sound THEN doc ->> '$.date_triggered' END AS date_triggered,
    CASE WHEN sound THEN (doc ->> '$.reference.companyID')::BIGINT END AS company_id,
    CASE WHEN sound THEN (doc ->> '$.reference.jobID')::BIGINT END AS job_id,
    CASE WHEN sound THEN (doc ->> '$.reference.scheduleID')::BIGINT END AS schedule_id,
    CASE WHEN sound THEN (doc ->> '$.reference.siteID')::BIGINT END AS site_id
  FROM checked)
"""

CLASSIFIED = """
named AS (
  SELECT *,
    list_filter(string_split(note_id, '.'), lambda w: w IN ('schedule', 'job', 'site'))[1] AS resource,
    CASE WHEN string_split(note_id, '.')[-1] IN ('created', 'updated', 'deleted')
         THEN string_split(note_id, '.')[-1] END AS operation
  FROM decoded),
routed AS (
  SELECT *, CASE resource WHEN 'job' THEN job_id WHEN 'site' THEN site_id WHEN 'schedule' THEN schedule_id END AS id
  FROM named),
classified AS (
  SELECT event_id, resource, operation, id, company_id, date_triggered,
    CASE WHEN signature_error IS NOT NULL THEN signature_error
         WHEN NOT sound THEN 'bad_payload'
         WHEN resource IS NULL THEN 'missing_resource'
         WHEN operation IS NULL THEN 'missing_operation'
         WHEN id IS NULL THEN 'missing_resource_id' END AS reject_reason
  FROM routed)
"""

ACCEPTED = """accepted AS (SELECT * FROM classified WHERE reject_reason IS NULL)"""

SCOPED = """scoped AS (SELECT * FROM accepted WHERE coalesce(company_id, 0) = 0)"""

COLLAPSED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY resource, id ORDER BY date_triggered DESC,
    CASE operation WHEN 'deleted' THEN 2 WHEN 'updated' THEN 1 ELSE 0 END DESC) AS rn
  FROM scoped),
actions AS (
  SELECT resource, id, operation, date_triggered FROM ranked WHERE rn = 1)
"""

NOTIFICATIONS = (NOTES, DECODED, CLASSIFIED, ACCEPTED, SCOPED, COLLAPSED)

# --- Nested records, already flat -------------------------------------------

SITE_ROWS = """
site_rows AS (
  SELECT c_custkey AS id, c_name AS address_address, 'City ' || c_nationkey AS address_city,
    CASE WHEN c_custkey % 11 <> 0 THEN c_mktsegment END AS address_country,
    CASE WHEN c_custkey % 113 <> 0 THEN lpad((c_custkey % 10000)::VARCHAR, 4, '0') END AS address_postal_code,
    epoch_us(TIMESTAMP '2024-01-01') + (c_custkey % 28) * 86400000000 AS date_modified,
    CASE WHEN c_custkey % 113 = 0 THEN 'address_postal_code' ELSE '' END AS reject_columns
  FROM customer)
"""

JOB_ROWS = """
job_values AS (
  SELECT o_orderkey AS id, 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS customer_company_name,
    CASE WHEN o_orderkey % 109 <> 0 THEN epoch_us(o_orderdate) + 1800250000 END AS date_modified,
    CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE 'Priority ' || o_orderpriority END AS description,
    'Order ' || o_orderkey AS name,
    CASE WHEN o_orderkey % 107 <> 0 THEN o_custkey END AS site_id,
    o_orderpriority AS stage,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS status_id,
    CASE WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 3 = 0 THEN 'Project'
         WHEN o_orderkey % 3 = 1 THEN 'Service' ELSE 'Prepaid' END AS job_type
  FROM orders),
job_rows AS (
  SELECT *, concat_ws(',', CASE WHEN date_modified IS NULL THEN 'date_modified' END,
    CASE WHEN site_id IS NULL THEN 'site_id' END, CASE WHEN job_type IS NULL THEN 'job_type' END) AS reject_columns
  FROM job_values)
"""

SCHEDULE_ROWS = """
schedule_values AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, epoch_us(l_shipdate) AS date_modified, l_suppkey AS staff_id,
    CASE WHEN l_partkey % 101 = 0 THEN NULL WHEN l_linenumber % 4 = 0 THEN 'lead' WHEN l_linenumber % 4 = 1 THEN 'quote'
         WHEN l_linenumber % 4 = 2 THEN 'job' ELSE 'activity' END AS schedule_type,
    CASE WHEN l_linenumber <> 7 THEN l_returnflag || l_linestatus END AS notes,
    CASE WHEN l_partkey % 89 <> 0 AND l_partkey % 83 <> 0 THEN l_orderkey END AS first_id,
    CASE WHEN l_partkey % 89 <> 0 THEN l_partkey END AS second_id,
    CASE WHEN l_linenumber % 4 = 0 THEN l_suppkey
         WHEN l_linenumber % 4 = 3 AND l_partkey % 97 <> 0 THEN l_partkey END AS single_id,
    l_linenumber, l_shipdate, l_returnflag, l_suppkey
  FROM lineitem),
schedule_rows AS (
  SELECT id, date_modified, staff_id, schedule_type, notes,
    CASE WHEN schedule_type = 'job' THEN first_id END AS job_id,
    CASE WHEN schedule_type IN ('job', 'quote') THEN second_id END AS cost_center_id,
    CASE WHEN schedule_type = 'activity' THEN single_id END AS activity_id,
    CASE WHEN schedule_type = 'quote' THEN first_id END AS quote_id,
    CASE WHEN schedule_type = 'lead' THEN single_id END AS lead_id,
    concat_ws(',', CASE WHEN schedule_type IS NULL THEN 'schedule_type' END,
      CASE WHEN schedule_type = 'activity' AND single_id IS NULL THEN 'reference' END) AS reject_columns,
    l_linenumber, l_shipdate, l_returnflag, l_suppkey
  FROM schedule_values)
"""

# --- Flat cache tables (date columns as microseconds) -----------------------

CACHE = """
employees AS (SELECT s_suppkey AS id, s_name AS name FROM supplier),
sites AS (
  SELECT c_custkey AS id, c_name AS address_address, 'City ' || c_nationkey AS address_city,
    c_mktsegment AS address_country, lpad((c_custkey % 10000)::VARCHAR, 4, '0') AS address_postal_code,
    1704067200000000 + (c_custkey % 28) * 86400000000 AS date_modified FROM customer),
activities AS (SELECT p_partkey AS id, p_name AS name FROM part),
quotes AS (
  SELECT o_orderkey + CASE WHEN o_orderstatus = 'F' THEN 1000000000000 ELSE 0 END AS id, 'Quote ' || o_orderkey AS name FROM orders),
leads AS (SELECT c_custkey + CASE WHEN c_acctbal < 0 THEN 1000000000000 ELSE 0 END AS id, c_name AS name FROM customer),
cost_centers AS (SELECT p_partkey AS id, p_brand AS name FROM part),
job_statuses AS (
  SELECT DISTINCT CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS id,
    CASE o_orderstatus WHEN 'F' THEN 'green' WHEN 'O' THEN 'blue' ELSE 'grey' END AS color, o_orderstatus AS name
  FROM orders),
jobs AS (
  SELECT o_orderkey AS id, 'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS customer_company_name,
    epoch_us(o_orderdate) AS date_modified, 'Priority ' || o_orderpriority AS description,
    'Order ' || o_orderkey AS name, o_custkey AS site_id, o_orderpriority AS stage,
    CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS status_id,
    CASE o_orderkey % 3 WHEN 0 THEN 'Project' WHEN 1 THEN 'Service' ELSE 'Prepaid' END AS job_type
  FROM orders),
schedule_rates AS (
  SELECT DISTINCT CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS id, l_returnflag AS name
  FROM lineitem),
schedule_lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS id, * FROM lineitem
  QUALIFY row_number() OVER (PARTITION BY l_orderkey * 10 + l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_returnflag DESC, l_linestatus DESC) = 1),
schedules AS (
  SELECT id, epoch_us(l_shipdate) AS date_modified, l_suppkey AS staff_id,
    CASE l_linenumber % 4 WHEN 0 THEN 'lead' WHEN 1 THEN 'quote' WHEN 2 THEN 'job' ELSE 'activity' END AS schedule_type,
    l_returnflag || l_linestatus AS notes,
    CASE WHEN l_linenumber % 4 = 2 THEN l_orderkey END AS job_id,
    CASE WHEN l_linenumber % 4 IN (1, 2) THEN l_partkey END AS cost_center_id,
    CASE WHEN l_linenumber % 4 = 3 THEN l_partkey END AS activity_id,
    CASE WHEN l_linenumber % 4 = 1 THEN l_orderkey END AS quote_id,
    CASE WHEN l_linenumber % 4 = 0 THEN l_suppkey END AS lead_id
  FROM schedule_lines),
schedule_blocks AS (
  SELECT id AS schedule_id, epoch_us(l_shipdate) + (pos + 7) * 3600000000 AS iso8601_start_time,
    epoch_us(l_shipdate) + (pos + 7) * 3600000000 + 1800000000 AS iso8601_end_time,
    CASE l_returnflag WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END AS schedule_rate
  FROM schedule_lines, unnest(generate_series(1, l_linenumber % 3)) AS g(pos))
"""
