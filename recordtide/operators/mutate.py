"""Upserts, deletes, ordered loads and constraint checks on keyed tables."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.operators.joins import orphan_check
from recordtide.operators.sets import pk_duplicates
from recordtide.schemas import CACHE_TABLES, ENUM_COLUMNS, LOAD_LEVELS, edges_of, required_columns
from recordtide.session import cut_lineage


def source_key_conflict(
    delta: DataFrame, key: str | list[str], order: Iterable[str], policy: str = "latest"
) -> DataFrame:
    """Make the key unique in a batch of incoming rows.

    ``latest`` keeps the greatest row by ``order``, the other columns settling ties;
    ``error`` fails the job when a key comes twice.
    """
    keys = [key] if isinstance(key, str) else list(key)
    first = [name for name in dict.fromkeys(order) if name not in keys]
    rest = [name for name in delta.columns if name not in first and name not in keys]
    grouped = delta.groupBy(*keys).agg(F.max(F.struct(*first, *rest)).alias("_row"), F.count("*").alias("_n"))
    if policy == "error":
        message = F.concat(F.lit("key comes more than once: "), F.concat_ws(",", *[F.col(k).cast("string") for k in keys]))
        unique = F.when(F.col("_n") == 1, F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
        grouped = grouped.where(unique)
    elif policy != "latest":
        raise ValueError("policy must be 'latest' or 'error'")
    return grouped.select(*keys, "_row.*").select(*delta.columns)


def fold_changes(
    changes: DataFrame, key: str, order: Column, listed: Iterable[str], unlisted: Iterable[str] = ()
) -> DataFrame:
    """Net effect per key of a change log with a ``deleted`` flag.

    Gives ``deleted``, ``restarted`` (a delete lies before the last state), the
    listed columns of the last change and the unlisted ones of the first change
    after the last delete. A key has at most one change per batch.
    """
    listed, unlisted = list(listed), list(unlisted)
    last = F.max_by(F.struct("deleted", *listed), F.col("_order")).alias("last")
    ordered = changes.withColumn("_order", order)
    restarted = F.max("deleted").alias("restarted")
    if not unlisted:
        folded = ordered.groupBy(key).agg(last, restarted)
        return folded.select(key, "restarted", "last.*")
    drops = ordered.where("deleted").groupBy(key).agg(F.max("_order").alias("_dropped"))
    current = ordered.join(drops, key, "left").where(
        F.col("_dropped").isNull() | (F.col("_order") >= F.col("_dropped"))
    )
    # A null order is ignored, so deletes do not count as a first state.
    born = F.when(~F.col("deleted"), F.col("_order"))
    first = F.min_by(F.struct(*unlisted), born).alias("first")
    folded = current.groupBy(key).agg(last, restarted, first)
    return folded.select(key, "restarted", "last.*", "first.*")


def apply_changes(
    base: DataFrame, changes: DataFrame, key: str, order: Column, listed: Iterable[str], unlisted: Iterable[str] = ()
) -> DataFrame:
    """The table after a change log: untouched base rows plus the last state of touched keys.

    Listed columns take the incoming value, null included; unlisted ones keep the
    stored value. The base is only probed for keys: when the changes are small by
    their file size, the planner broadcasts their keys and does not shuffle the base.
    """
    listed, unlisted = list(listed), list(unlisted)
    untouched = base.join(changes.select(key).distinct(), key, "left_anti")
    folded = fold_changes(changes, key, order, listed, unlisted)
    alive = folded.where(~F.col("deleted"))
    if unlisted:
        stored = base.select(key, F.struct(*unlisted).alias("_stored"))
        alive = alive.join(stored, key, "left")
        inherit = F.col("_stored").isNotNull() & ~F.col("restarted")
        alive = alive.withColumns(
            {name: F.when(inherit, F.col("_stored")[name]).otherwise(F.col(name)) for name in unlisted}
        )
    return untouched.select(*base.columns).unionByName(alive.select(*base.columns))


def upsert(base: DataFrame, delta: DataFrame, key: str, listed: Iterable[str]) -> DataFrame:
    """Insert by key; where the key exists, overwrite the listed columns with the incoming value.

    ``delta`` must have unique keys (see ``source_key_conflict``). Base rows without
    an incoming one are only probed for their key, as in ``apply_changes``.
    """
    listed = list(listed)
    unlisted = [name for name in base.columns if name != key and name not in listed]
    untouched = base.join(delta.select(key), key, "left_anti")
    if unlisted:
        stored = base.select(key, F.struct(*unlisted).alias("_stored"))
        keep = {name: F.when(F.col("_stored").isNotNull(), F.col("_stored")[name]).otherwise(F.col(name)) for name in unlisted}
        delta = delta.join(stored, key, "left").withColumns(keep)
    return untouched.select(*base.columns).unionByName(delta.select(*base.columns))


def delete_by_id(base: DataFrame, ids: DataFrame, key: str = "id") -> DataFrame:
    """Remove the rows whose key is among ``ids``."""
    return base.join(ids.select(key), key, "left_anti")


def ordered_load(rows: Mapping[str, DataFrame], write: Callable[[str, DataFrame], None]) -> list[str]:
    """Write tables so that every referenced table comes first. Returns the order used.

    Tables of one level do not reference each other, so their jobs run side by side
    and the small ones do not hold up the cluster.
    """
    order = []
    for level in LOAD_LEVELS:
        tables = [table for table in level if table in rows]
        if tables:
            with ThreadPoolExecutor(len(tables)) as pool:
                list(pool.map(lambda table: write(table, rows[table]), tables))
        order += tables
    return order


def constraint_report(batch: Mapping[str, DataFrame], stored: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Violations in a batch of cache rows: ``(rule, table, column, key)``.

    Foreign keys may point into the batch or into the rows already stored.
    """
    stored, found, narrow = stored or {}, [], {}
    for table, rows in batch.items():
        checks = [
            F.when(F.col(name).isNull(), F.struct(F.lit("not_null").alias("rule"), F.lit(name).alias("column")))
            for name in required_columns(table)
        ]
        checks += [
            F.when(~F.col(name).isin(*domain), F.struct(F.lit("enum").alias("rule"), F.lit(name).alias("column")))
            for (owner, name), domain in ENUM_COLUMNS.items()
            if owner == table
        ]
        # One pass over the full rows; what is left is the keys and the rules broken.
        keys = [edge.column for edge in edges_of(table)]
        narrow[table] = cut_lineage(rows.select("id", *keys, F.array_compact(F.array(*checks)).alias("broken")))
        key = F.col("id").cast("string").alias("key")
        hits = narrow[table].select(key, F.explode("broken").alias("hit"))
        found.append(hits.select("hit.rule", F.lit(table).alias("table"), "hit.column", "key"))
        twice = pk_duplicates(narrow[table].where(F.col("id").isNotNull()), "id")
        found.append(
            twice.select(F.lit("primary_key").alias("rule"), F.lit(table).alias("table"), F.lit("id").alias("column"), key)
        )
    edges = [edge for table in batch for edge in edges_of(table)]
    if edges:
        targets = {edge.parent: _all_rows(edge.parent, narrow, stored) for edge in edges}
        found.append(
            orphan_check(narrow, edges, targets).select(
                F.lit("foreign_key").alias("rule"), F.col("child").alias("table"), "column",
                F.col("id").cast("string").alias("key"),
            )
        )
    return reduce(DataFrame.unionAll, found)


def _all_rows(table: str, batch: Mapping[str, DataFrame], stored: Mapping[str, DataFrame]) -> DataFrame:
    parts = [source[table].select("id") for source in (batch, stored) if table in source]
    if not parts:
        spark = next(iter(batch.values())).sparkSession
        parts = [spark.createDataFrame([], CACHE_TABLES[table]).select("id")]
    return reduce(DataFrame.unionAll, parts)
