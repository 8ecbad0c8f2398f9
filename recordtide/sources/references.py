"""An index of the references between cache tables, and what one batch orphans, found from the keys it touches.

For each foreign key that a row of any table ever held, the index has an entry: who points there, from which column, and
where that row lies. Entries are only added, in the batch that writes the row and committed with it, and are laid out by a
hash of what they point to. An entry may be out of date, so whoever looks one up reads the row itself, by its key, and
believes the row. That makes entries safe to add twice and in any order, and a key with a third of all rows as its holders
costs a plain append.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.operators.sets import unpivot_fks
from recordtide.schemas import CACHE_TABLES, FK_EDGES, edges_of
from recordtide.session import cut_lineage
from recordtide.sources.cache import REFERENCES, Cache, Snapshot, clustering_key

_CHILDREN = tuple(dict.fromkeys(edge.child for edge in FK_EDGES))
_REPORT = ("child", "id", "column", "target", "fk")
_ENTRY = ("target", "fk", "child", "id", "column")


def _spot() -> Column:
    """Where an entry lies: a hash, so that ids of all targets spread evenly over the files."""
    return F.xxhash64("target", "fk")


def references_of(child: str, rows: DataFrame) -> DataFrame:
    """``(target, fk, child, id, column, cluster)`` for each non-null foreign key of the rows of a table."""
    at = clustering_key(child)
    # The place is carried through in the key of the row.
    keyed = rows.select(F.struct("id", F.col(at).alias("cluster")).alias("row"), *[edge.column for edge in edges_of(child)])
    found = unpivot_fks(keyed, edges_of(child), "row")
    return found.select("target", "fk", F.lit(child).alias("child"), "id.id", "column", "id.cluster")


class ReferenceIndex:
    """Looks up the rows that point to given ids. ``CacheSync`` keeps it up to date; ``rebuild`` starts it on an older cache."""

    def __init__(self, cache: Cache):
        self.cache = cache

    def log_batch(self, batch_id: int) -> None:
        """Inside a transaction: add the references of the rows it has written. Becomes visible with them."""
        parts = [references_of(t, rows.where(~F.col("deleted"))) for t, rows in self.cache.staged(batch_id).items() if t in _CHILDREN]
        if parts:
            added = reduce(DataFrame.unionAll, parts).withColumn("spot", _spot())
            self.cache.stage(REFERENCES, added, batch_id)  # whole logs are read, so they need no order

    def entries(self, pairs: DataFrame, before: int | None = None) -> DataFrame:
        """Index entries of the written, distinct ``(target, fk)``, out-of-date ones included, as of now or before a batch."""
        index = self.cache.snapshot([REFERENCES], before)
        spots = pairs.select(_spot().alias("spot"))
        known = index.near(REFERENCES, spots).unionByName(index.log(REFERENCES).drop("batch_id"))
        return known.join(pairs, ["target", "fk"], "left_semi").select(*_ENTRY, "cluster").distinct()

    def holders(self, pairs: DataFrame, before: int | None = None) -> DataFrame:
        """The rows ``(target, fk, child, id, column)`` that point to one of ``(target, fk)``, now or before a batch."""
        pairs = cut_lineage(pairs.distinct())
        return confirmed(self.cache.snapshot(before=before), cut_lineage(self.entries(pairs, before)))

    def compact(self) -> int:
        """Fold the index log into its base, each entry once. Returns the batch up to which the base holds."""
        now = self.cache.snapshot([REFERENCES])
        if now.logs[REFERENCES]:
            every, unique = now.log(REFERENCES).drop("batch_id"), len(now.logs[REFERENCES]) > 1
            if now.bases[REFERENCES]:
                every, unique = now.base(REFERENCES).unionByName(every), True
            # The rows of one batch have unique ids, so one batch alone has no entry twice.
            self.cache.write_base(REFERENCES, every, now.logs[REFERENCES][-1][0], unique=unique)
            return now.logs[REFERENCES][-1][0]
        return now.upto[REFERENCES]

    def rebuild(self) -> int:
        """Make the index anew from the cache's present rows, without entries that are out of date. Reads the tables whole."""
        now = self.cache.snapshot()
        upto = max([*now.upto.values(), *(log[-1][0] for log in now.logs.values() if log)])
        every = reduce(DataFrame.unionAll, [references_of(child, now.scan(child)) for child in _CHILDREN])
        self.cache.write_base(REFERENCES, every.withColumn("spot", _spot()), upto)
        return upto


def confirmed(state: Snapshot, entries: DataFrame) -> DataFrame:
    """The written entries whose row still has that reference, as ``(target, fk, child, id, column)``."""
    found = [entries.select(*_ENTRY).limit(0)]
    for child in sorted(row["child"] for row in entries.select("child").distinct().collect()):  # tables of the cache
        own = entries.where(F.col("child") == child)
        held = references_of(child, state.rows_of(child, own.select("id", "cluster"))).select(*_ENTRY)
        found.append(held.join(own.select(*_ENTRY), list(_ENTRY), "left_semi"))
    return reduce(DataFrame.unionAll, found)


def absent(state: Snapshot, pairs: DataFrame) -> DataFrame:
    """Those of the written, distinct ``(target, fk)`` that do not exist."""
    targets = sorted(row["target"] for row in pairs.select("target").distinct().collect())  # tables of the cache
    if not targets:
        return pairs
    found = []
    for target in targets:
        asked = pairs.where(F.col("target") == target).select(F.col("fk").alias("id"))
        found.append(state.rows_of(target, asked).select(F.lit(target).alias("target"), F.col("id").alias("fk")))
    return pairs.join(reduce(DataFrame.unionAll, found), ["target", "fk"], "left_anti")


def batch_orphans(cache: Cache, batch_id: int, changes: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """References ``(child, id, column, target, fk)`` without a target after a committed batch that were none before it.

    Equal to a full ``orphan_check`` after the batch minus one before it, but reads the batch's own changes, the index at the
    ids it deletes, and the rows and targets named by these. A row that only changes which missing target it names counts anew.
    """
    changes = cache.changes_of(batch_id) if changes is None else changes
    before, after, index = cache.snapshot(before=batch_id), cache.snapshot(before=batch_id + 1), ReferenceIndex(cache)
    spark = cache.spark
    touched = [rows.select(F.lit(t).alias("child"), "id") for t, rows in changes.items() if t in _CHILDREN]
    own = [references_of(t, rows.where(~F.col("deleted"))).select(*_ENTRY) for t, rows in changes.items() if t in _CHILDREN]
    gone = [rows.where("deleted").select(F.lit(t).alias("target"), F.col("id").alias("fk")) for t, rows in changes.items() if t in CACHE_TABLES]
    if not gone:
        return spark.createDataFrame([], "child string, id long, column string, target string, fk long")
    asked = cut_lineage(reduce(DataFrame.unionAll, gone).distinct())
    entries = index.entries(asked, before=batch_id)
    if touched:
        entries = entries.join(reduce(DataFrame.unionAll, touched), ["child", "id"], "left_anti")
    suspects = cut_lineage(reduce(DataFrame.unionAll, [*own, confirmed(before, cut_lineage(entries))]))
    missing = cut_lineage(absent(after, cut_lineage(suspects.select("target", "fk").distinct())))
    if missing.isEmpty():
        return suspects.limit(0).select(*_REPORT)
    broken = cut_lineage(suspects.join(missing, ["target", "fk"], "left_semi"))
    # What was broken before: the same reference to a target that was missing then too.
    long_missing = cut_lineage(absent(before, missing))
    if long_missing.isEmpty():
        return broken.select(*_REPORT)
    old = index.entries(long_missing, before=batch_id).join(broken.select(*_ENTRY), list(_ENTRY), "left_semi")
    known = confirmed(before, cut_lineage(old))
    return broken.join(known, list(_ENTRY), "left_anti").select(*_REPORT)
