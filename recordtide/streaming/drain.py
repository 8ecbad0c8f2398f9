"""Micro-batch drain: notifications in, cache changes and rejects out."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from recordtide.functions.scalars import parse_id, parse_rfc3339_utc
from recordtide.operators.buffer import collapse_batch
from recordtide.operators.mutate import ordered_load, source_key_conflict
from recordtide.operators.nested import accepted_rows, derived_rows, rejected_rows, rows_from_record
from recordtide.operators.notify import classify_rejects, split_accept_reject, tenant_scope
from recordtide.operators.read_api import SKETCH_FROM, id_in_list, within_range
from recordtide.operators.sets import fold_partial_views
from recordtide.schemas import (
    CACHE_TABLES,
    DEFAULT_COMPANY,
    LOAD_LEVELS,
    NOTIFIED_RESOURCES,
    RESOURCE_TABLES,
    edges_of,
    payload_columns,
    required_columns,
)
from recordtide.session import cut_lineage
from recordtide.sources.cache import Cache
from recordtide.sources.references import ReferenceIndex

TABLE_RESOURCES = {table: resource for resource, table in RESOURCE_TABLES.items()}
_TOP_DOWN = [table for level in reversed(LOAD_LEVELS) for table in level if table in TABLE_RESOURCES]


def drain_batch(
    notifications: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, minutes: float | None = None
) -> StreamingQuery:
    """Hand everything pending to ``handle`` as one batch, then start empty again.

    With ``minutes`` the query runs on and drains at that interval; without, it
    drains what is there and stops. The checkpoint makes the cut between batches
    exact: a batch lost half way comes back with the same id and the same rows.
    """
    writer = notifications.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if minutes is None:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=f"{round(minutes * 60)} seconds").start()


def reject_sink(rejected: DataFrame, folder: str, batch_id: int) -> None:
    """Write rejected input with its reason to the dead-letter table."""
    rejected.withColumn("batch_id", F.lit(batch_id).cast("bigint")).write.mode("overwrite").option(
        "partitionOverwriteMode", "dynamic"
    ).partitionBy("batch_id").parquet(folder)


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def current_records(records: DataFrame, ids: DataFrame) -> DataFrame:
    """The landed records of the given distinct ids, of each id the version modified last, or else landed last."""
    keyed = records.withColumn("_id", parse_id(F.col("ID")))
    keyed = id_in_list(keyed, ids.select(F.col("id").alias("_id")), "_id", unique=True, sketch_from=SKETCH_FROM)
    if "DateModified" in records.columns:
        keyed = keyed.withColumn("_modified", parse_rfc3339_utc(F.col("DateModified")))
    recency = [name for name in ("_modified", "Landed") if name in keyed.columns]
    return source_key_conflict(keyed, "_id", recency).drop("_id", "_modified", "Landed")


def load_rows(
    records: Callable[[str], DataFrame], wanted: Mapping[str, DataFrame], gone: Mapping[str, DataFrame]
) -> tuple[dict[str, DataFrame], DataFrame, DataFrame]:
    """Cache rows of the wanted ids and of everything they reference, the bad records, and the wanted ids without a record.

    ``wanted`` maps table -> ids; ids in ``gone`` are left out even when referenced.
    Walks down the foreign keys: schedules, then jobs, then the tables without any.
    Each record list is scanned once: what is found in it is written out.
    """
    needed = {table: [ids.select("id")] for table, ids in wanted.items()}
    rows: dict[str, DataFrame] = {}
    mentions: dict[str, DataFrame] = {}
    bad: list[DataFrame] = []
    missing: list[DataFrame] = []
    for table in _TOP_DOWN:
        if table not in needed:
            continue
        resource = TABLE_RESOURCES[table]
        ids = _union(needed[table]).distinct()
        if table in gone:
            ids = ids.join(gone[table].select("id"), "id", "left_anti")
        ids = cut_lineage(ids)
        picked = cut_lineage(current_records(records(resource), ids))
        checked = cut_lineage(rows_from_record(picked, resource))
        if table in wanted:
            absent = ids.join(picked.select(parse_id(F.col("ID")).alias("id")), "id", "left_anti")
            told = wanted[table].select("id").distinct()
            missing.append(absent.join(told, "id", "left_semi").select(F.lit(table).alias("table"), "id"))
        bad.append(rejected_rows(checked).select(F.lit(table).alias("table"), "id", "reject_columns"))
        rows[table] = accepted_rows(checked)
        sound = picked.withColumn("_id", parse_id(F.col("ID"))).join(
            rows[table].select(F.col("id").alias("_id")), "_id", "left_semi"
        )
        mentions |= derived_rows(sound, resource)
        for edge in edges_of(table):
            refs = rows[table].select(F.col(edge.column).alias("id")).where(F.col("id").isNotNull())
            needed.setdefault(edge.parent, []).append(refs)
    for table, found in mentions.items():
        rows[table] = fold_partial_views(rows[table], found) if table in rows else found
    if "schedule_blocks" in rows:
        blocks = rows["schedule_blocks"]
        whole = reduce(and_, [F.col(name).isNotNull() for name in required_columns("schedule_blocks")])
        rows["schedule_blocks"] = blocks.where(whole)
        bad.append(
            blocks.where(~whole).select(
                F.lit("schedule_blocks").alias("table"), "id", F.array(F.lit("block")).alias("reject_columns")
            )
        )
    return rows, _union(bad), _union(missing)


def _changes(table: str, rows: DataFrame | None, dropped: DataFrame | None) -> DataFrame:
    """Incoming rows and tombstones of one table in one frame."""
    parts = []
    if rows is not None:
        parts.append(rows.select("id", *payload_columns(table)).withColumn("deleted", F.lit(False)))
    if dropped is not None:
        kinds = CACHE_TABLES[table]
        blank = [F.lit(None).cast(kinds[name].dataType).alias(name) for name in payload_columns(table)]
        parts.append(dropped.select("id", *blank, F.lit(True).alias("deleted")))
    return _union(parts)


@dataclass
class CacheSync:
    """Applies batches of notifications to a cache.

    ``records`` gives the landed records of a resource, ``rejects`` is the root
    folder of the dead-letter tables.
    """

    cache: Cache
    records: Callable[[str], DataFrame]
    secret: str
    rejects: str
    company: int = DEFAULT_COMPANY

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        """Validate, collapse, read, flatten and load one batch. Safe to repeat."""
        if self.cache.committed(batch_id):
            return
        classified = classify_rejects(batch, self.secret).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            accepted, rejected = split_accept_reject(classified)
            reject_sink(rejected, f"{self.rejects}/notifications", batch_id)
            actions = cut_lineage(collapse_batch(tenant_scope(accepted, self.company)))
        finally:
            classified.unpersist()
        self.apply(actions, batch_id)

    def apply(self, actions: DataFrame, batch_id: int) -> None:
        """Load the rows behind collapsed ``(resource, id, operation)`` actions.

        An id whose record has not landed yet stays pending and is tried again by each later batch, until its record is
        there or it is deleted. All tables become visible together, when the batch is committed; one that is committed
        already is left as it is.
        """
        if self.cache.committed(batch_id):
            return
        wanted, gone = {}, {}
        late = self.cache.pending(before=batch_id)
        for resource in NOTIFIED_RESOURCES:
            own = actions.where(F.col("resource") == resource)
            overdue = late.where(F.col("table") == RESOURCE_TABLES[resource]).select("id")
            wanted[RESOURCE_TABLES[resource]] = own.where(F.col("operation") != "deleted").select("id").union(overdue)
            gone[RESOURCE_TABLES[resource]] = own.where(F.col("operation") == "deleted").select("id")
        rows, bad, missing = load_rows(self.records, wanted, gone)
        reject_sink(bad, f"{self.rejects}/records", batch_id)
        dropped = {**gone, "schedule_blocks": self._stale_blocks(rows, gone["schedules"], batch_id)}
        changes = {
            table: _changes(table, rows.get(table), dropped.get(table)) for table in rows.keys() | dropped.keys()
        }
        with self.cache.transaction(batch_id):
            self.cache.write_pending(missing, batch_id)
            ordered_load(changes, lambda table, frame: self.cache.write_changes(table, frame, batch_id))
            ReferenceIndex(self.cache).log_batch(batch_id)

    def _stale_blocks(self, rows: Mapping[str, DataFrame], gone: DataFrame, batch_id: int) -> DataFrame:
        """Stored blocks of the touched schedules that the new records no longer have."""
        touched = cut_lineage(_union([rows["schedules"].select("id"), gone.select("id")]))
        blocks = self.cache.scan("schedule_blocks", before=batch_id)
        near = within_range(blocks, "schedule_id", touched)
        stored = id_in_list(near, touched.withColumnRenamed("id", "schedule_id"), "schedule_id", unique=True)
        return cut_lineage(stored.select("id").join(rows["schedule_blocks"].select("id"), "id", "left_anti"))


def cache_upsert_sink(
    notifications: DataFrame, sync: CacheSync, checkpoint: str, minutes: float | None = None
) -> StreamingQuery:
    """Keep the cache up to date from a stream of notifications."""
    return drain_batch(notifications, sync, checkpoint, minutes)
