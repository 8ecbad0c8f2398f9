"""Distinct references, duplicates, merges and duplicate removal."""

from pyspark.sql import functions as F

from recordtide.operators.dedup import dedup_fixpoint, elect_canonical, remap_table, rewrite_refs
from recordtide.operators.sets import (
    distinct_fk_ids,
    duplicate_groups,
    fold_partial_views,
    merge_existing_wins,
    pk_duplicates,
    union_missing,
)
from recordtide.plans.registry import query
from recordtide.plans.sql import with_ctes
from recordtide.plans.standins import table


@query(
    "distinct_fk_ids",
    """SELECT DISTINCT 'jobs' AS target, l_orderkey AS id FROM lineitem
       UNION ALL SELECT DISTINCT 'cost_centers', l_partkey FROM lineitem
       UNION ALL SELECT DISTINCT 'employees', l_suppkey FROM lineitem""",
)
def fk_ids(spark, sf_dir):
    return distinct_fk_ids(
        table(spark, sf_dir, "lineitem"), {"l_orderkey": "jobs", "l_partkey": "cost_centers", "l_suppkey": "employees"}
    )


@query(
    "duplicate_groups",
    """SELECT sha256(text) AS content, count(*) AS n, min(doc_id) AS first_member FROM documents
       GROUP BY text HAVING count(*) > 1""",
)
def groups(spark, sf_dir):
    return duplicate_groups(table(spark, sf_dir, "documents"), F.sha2("text", 256), F.col("doc_id"))


@query(
    "pk_duplicates",
    """SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem
       GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
)
def pk(spark, sf_dir):
    return pk_duplicates(table(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber")


@query(
    "union_missing",
    """SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, NULL AS nation FROM customer
       UNION ALL SELECT s_suppkey, s_name, NULL, s_nationkey FROM supplier""",
)
def union(spark, sf_dir):
    first = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    second = table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("s_name").alias("name")
    )
    return union_missing(first, second)


@query(
    "merge_existing_wins",
    """SELECT coalesce(c.id, o.o_custkey) AS id, c.c_name AS name,
              coalesce(CASE WHEN c.c_acctbal >= 0 THEN c.c_mktsegment END, o.first_priority) AS label, o.last_status
       FROM (SELECT *, c_custkey + CASE WHEN c_nationkey < 20 THEN 0 ELSE 1000000000 END AS id FROM customer) c
       FULL JOIN (SELECT o_custkey, min(o_orderpriority) AS first_priority, max(o_orderstatus) AS last_status
                  FROM orders GROUP BY o_custkey) o ON c.id = o.o_custkey""",
)
def merge(spark, sf_dir):
    existing = table(spark, sf_dir, "customer").select(
        F.expr("c_custkey + CASE WHEN c_nationkey < 20 THEN 0 ELSE 1000000000 END").alias("id"), F.col("c_name").alias("name"),
        F.expr("CASE WHEN c_acctbal >= 0 THEN c_mktsegment END").alias("label"),
    )
    incoming = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("id")).agg(
        F.min("o_orderpriority").alias("label"), F.max("o_orderstatus").alias("last_status")
    )
    return merge_existing_wins(existing, incoming, "id")


@query(
    "fold_partial_views",
    """WITH known AS (
         SELECT c_custkey + CASE WHEN c_acctbal >= 0 THEN 0 ELSE 1000000000 END AS id, c_name AS name, c_mktsegment AS segment
         FROM customer)
       SELECT * FROM known
       UNION ALL SELECT o_custkey, min('Site ' || o_orderpriority), NULL FROM orders
       WHERE o_custkey NOT IN (SELECT id FROM known) GROUP BY o_custkey""",
)
def fold(spark, sf_dir):
    full = table(spark, sf_dir, "customer").select(
        F.expr("c_custkey + CASE WHEN c_acctbal >= 0 THEN 0 ELSE 1000000000 END").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")
    )
    partial = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.expr("concat('Site ', o_orderpriority)").alias("name")
    )
    return fold_partial_views(full, partial)


# --- Duplicate removal over the documents -----------------------------------

_NAME = "concat('Doc', {id}, CASE WHEN {id} % 2 = 0 THEN 'Ab0c1d' ELSE '' END)"
_SUFFIX = "'[0-9A-F][0-9a-f]{5}$'"


def _rank(name: str) -> str:
    """The canonical order of names as SQL sort columns."""
    cut = f"regexp_replace({name}, {_SUFFIX}, '')"
    return f"length({cut}), regexp_matches({name}, {_SUFFIX}), {cut}, {name}"


_MEMBERS = f"""
members AS (SELECT {_NAME.format(id='doc_id')} AS name, sha256(text) AS content, lang FROM documents),
groups AS (
  SELECT content, count(*) AS n, first(name ORDER BY {_rank('name')}) AS canonical
  FROM members GROUP BY content HAVING count(*) > 1 AND min(lang) = max(lang)),
remap AS (
  SELECT m.name AS old, g.canonical AS new FROM members m JOIN groups g USING (content) WHERE m.name <> g.canonical)
"""


def members(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        F.expr(_NAME.format(id="doc_id")).alias("name"), F.sha2("text", 256).alias("content"), "lang"
    )


@query("elect_canonical", with_ctes(_MEMBERS) + "SELECT content, n, canonical FROM groups")
def elect(spark, sf_dir):
    return elect_canonical(members(spark, sf_dir), "content", "name", "lang")


@query(
    "rewrite_refs",
    with_ctes(_MEMBERS)
    + f"""SELECT l.doc_id, coalesce(r.new, {_NAME.format(id='l.doc_id')}) AS doc_name, l.quality, l.toxic
          FROM labels l LEFT JOIN remap r ON r.old = {_NAME.format(id='l.doc_id')}""",
)
def rewrite(spark, sf_dir):
    labels = table(spark, sf_dir, "labels").withColumn("doc_name", F.expr(_NAME.format(id="doc_id")))
    remap = remap_table(members(spark, sf_dir), "content", "name", "lang")
    return rewrite_refs(labels, "doc_name", remap, "doc_id").select("doc_id", "doc_name", "quality", "toxic")


@query(
    "dedup_fixpoint",
    with_ctes(
        f"""
docs AS (SELECT 'D' || doc_id AS id, text FROM documents),
doc_heads AS (SELECT text, first(id ORDER BY {_rank('id')}) AS head FROM docs GROUP BY text),
doc_map AS (SELECT id AS old, head AS new FROM docs JOIN doc_heads USING (text)),
notes AS (SELECT 'L' || doc_id AS id, m.new AS doc, quality, toxic FROM labels JOIN doc_map m ON m.old = 'D' || doc_id),
note_heads AS (SELECT doc, quality, toxic, first(id ORDER BY {_rank('id')}) AS head FROM notes GROUP BY ALL),
note_map AS (SELECT id AS old, head AS new FROM notes JOIN note_heads USING (doc, quality, toxic))
"""
    )
    + "SELECT old, new FROM doc_map WHERE old <> new UNION ALL SELECT old, new FROM note_map WHERE old <> new",
)
def fixpoint(spark, sf_dir):
    """Labels of equal documents only become equal once the documents have merged."""
    documents, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    nodes = documents.select(
        F.concat(F.lit("D"), "doc_id").alias("id"), F.concat(F.lit("text "), F.sha2("text", 256)).alias("content")
    ).unionAll(labels.select(F.concat(F.lit("L"), "doc_id"), F.concat_ws(" ", F.lit("label"), "quality", "toxic")))
    refs = labels.select(
        F.concat(F.lit("L"), "doc_id").alias("owner"), F.lit("doc").alias("slot"),
        F.concat(F.lit("D"), "doc_id").alias("target"),
    )
    return dedup_fixpoint(nodes, refs)
