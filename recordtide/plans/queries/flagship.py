"""The whole chain in one plan: notifications to an updated, joined table."""

from pyspark.sql import functions as F

from recordtide.operators.buffer import collapse_batch
from recordtide.operators.joins import fk_join
from recordtide.operators.mutate import apply_changes
from recordtide.operators.notify import tenant_scope
from recordtide.plans.queries.buffers import accepted
from recordtide.plans.registry import query
from recordtide.plans.sql import NOTIFICATIONS, with_ctes
from recordtide.plans.standins import table
from recordtide.session import cut_lineage


@query(
    "sync_sites",
    with_ctes(*NOTIFICATIONS)
    + """SELECT c.c_custkey AS id, c.c_name AS name, coalesce(a.operation, 'stored') AS state, n.n_name AS nation_name
         FROM customer c LEFT JOIN (SELECT * FROM actions WHERE resource = 'site') a ON a.id = c.c_custkey
         JOIN nation n ON n.n_nationkey = c.c_nationkey
         WHERE a.operation IS DISTINCT FROM 'deleted'""",
)
def sync_sites(spark, sf_dir):
    """Validate, route, collapse, apply to the stored sites, join to their nation."""
    sites = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_nationkey").alias("nation_id"),
        F.lit("stored").alias("state"),
    )
    actions = cut_lineage(collapse_batch(tenant_scope(accepted(spark, sf_dir)).where("resource = 'site'")))
    changes = sites.drop("state").join(actions, "id").select(
        "id", "name", "nation_id", F.col("operation").alias("state"), (F.col("operation") == "deleted").alias("deleted")
    )
    current = apply_changes(sites, changes, "id", F.lit(0), ["name", "nation_id", "state"])
    nations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"))
    return fk_join(current, nations, "nation_id", "nation").select("id", "name", "state", "nation_name")
