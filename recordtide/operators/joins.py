"""Foreign-key joins and checks over the cache tables.

No join here forces a broadcast of a table: adaptive execution broadcasts a side
whose measured size is small and otherwise shuffles both, splitting hot partitions.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtide.operators.sets import distinct_fk_ids, unpivot_fks
from recordtide.operators.skew import left_lookup
from recordtide.schemas import FK_EDGES, LOAD_LEVELS, Edge, edges_of
from recordtide.session import cut_lineage


def fk_join(
    child: DataFrame,
    parent: DataFrame,
    fk: str,
    prefix: str,
    optional: bool = False,
    key: str = "id",
    row_key: Iterable[str] = ("id",),
) -> DataFrame:
    """Join along a foreign key; parent columns come out as ``<prefix>_<column>``.

    An optional key keeps the child row, and its nulls are spread over the tasks by
    ``row_key``, the columns that tell child rows apart.
    """
    renamed = parent.select(
        F.col(key).alias("_pk"),
        *[F.col(name).alias(f"{prefix}_{name}") for name in parent.columns if name != key],
    )
    if optional:
        return left_lookup(child, fk, renamed, "_pk", F.struct(*row_key))
    return child.join(renamed, F.col(fk) == F.col("_pk"), "inner").drop("_pk")


# Lookups of a schedule block: prefix, table, key column.
_LOOKUPS = (
    ("staff", "employees", "staff_id"),
    ("activity", "activities", "activity_id"),
    ("cost_center", "cost_centers", "cost_center_id"),
    ("quote", "quotes", "quote_id"),
    ("lead", "leads", "lead_id"),
    ("rate", "schedule_rates", "schedule_rate"),
)


def _schedules_with_blocks(schedules: DataFrame, blocks: DataFrame) -> DataFrame:
    """``schedules`` left join ``blocks``, as an inner join plus the schedules without blocks.

    A left join cannot split a schedule that owns a large part of all blocks; the
    inner join can.
    """
    blocks = blocks.withColumnsRenamed({"id": "block_id", "schedule_id": "id"})
    keyed = schedules.where(F.col("id").isNotNull())  # in both joins, so that one shuffle of them serves both
    bare = keyed.join(blocks.select("id").distinct(), "id", "left_anti").unionAll(schedules.where(F.col("id").isNull()))
    return blocks.join(keyed, "id").unionByName(bare, allowMissingColumns=True)


def star_join(tables: Mapping[str, DataFrame], columns: Iterable[str] | None = None) -> DataFrame:
    """One wide row per schedule block (or per schedule without blocks), from all eleven tables.

    Jobs meet their site and status first, so that the far more numerous blocks move
    once less for each. Nulls are spread by schedule and start, which the rows have anyway:
    block ids would go through every shuffle and hardly compress.
    """
    jobs = fk_join(tables["jobs"], tables["sites"], "site_id", "site", optional=True)
    jobs = fk_join(jobs, tables["job_statuses"], "status_id", "status", optional=True)
    wide = _schedules_with_blocks(tables["schedules"], tables["schedule_blocks"])
    for prefix, parent, fk in (("job", jobs, "job_id"), *[(p, tables[name], fk) for p, name, fk in _LOOKUPS]):
        wide = fk_join(wide, parent, fk, prefix, optional=True, row_key=("id", "iso8601_start_time"))
    return wide.select(*columns) if columns else wide


def _targets(tables: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    parts = [tables[name].select(F.lit(name).alias("target"), "id") for name in names]
    return reduce(DataFrame.unionAll, parts)


def missing_refs(child: DataFrame, edges: Iterable[Edge], targets: Mapping[str, DataFrame]) -> DataFrame:
    """Distinct ``(target, id)`` pairs that are referenced but not present.

    Keys are made distinct before the join, so a hot key costs one row per task.
    """
    edges = list(edges)
    present = _targets(targets, sorted({edge.parent for edge in edges}))
    return distinct_fk_ids(child, {edge.column: edge.parent for edge in edges}).join(
        present, ["target", "id"], "left_anti"
    )


def orphan_check(
    tables: Mapping[str, DataFrame], edges: Iterable[Edge] = FK_EDGES, targets: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """Rows whose foreign key has no target: ``(child, id, column, target, fk)``.

    Targets are looked up in ``targets``, by default the tables themselves. The
    missing keys are found first and written out. They are few in a sound cache, and
    then the second join broadcasts them and does not shuffle the child rows.
    """
    edges = list(edges)
    found = []
    for name in dict.fromkeys(edge.child for edge in edges):
        own = [edge for edge in edges if edge.child == name]
        missing = cut_lineage(missing_refs(tables[name], own, targets or tables)).withColumnRenamed("id", "fk")
        rows = unpivot_fks(tables[name], own)
        found.append(
            rows.join(missing, ["target", "fk"], "left_semi").select(
                F.lit(name).alias("child"), "id", "column", "target", "fk"
            )
        )
    return reduce(DataFrame.unionAll, found)


def _with_refs(tables: Mapping[str, DataFrame], names: Iterable[str]) -> DataFrame:
    """Stored rows of several tables as ``(target, id, refs)``, refs being their foreign keys."""
    parts = []
    for name in names:
        refs = [F.struct(F.lit(e.parent).alias("target"), F.col(e.column).alias("id")) for e in edges_of(name)]
        kind = "array<struct<target:string,id:bigint>>"
        parts.append(tables[name].select(F.lit(name).alias("target"), "id", F.array(*refs).cast(kind).alias("refs")))
    return reduce(DataFrame.unionAll, parts)


def fk_closure(tables: Mapping[str, DataFrame], seeds: Mapping[str, DataFrame]) -> DataFrame:
    """Every row that must be present for the seed rows to be: ``(target, id, present)``.

    The edge graph has no cycle, so one pass over the load levels from the top
    follows all references. Each table is scanned once and only ids move; the ids
    reached are written out per level, so that no level is worked out twice.
    """
    reachable = set(seeds)
    for level in reversed(LOAD_LEVELS):
        reachable.update(edge.parent for name in level if name in reachable for edge in edges_of(name))
    levels = [[name for name in level if name in reachable] for level in reversed(LOAD_LEVELS)]
    levels = [level for level in levels if level]

    pending = reduce(DataFrame.unionAll, [ids.select(F.lit(name).alias("target"), "id") for name, ids in seeds.items()])
    pending = pending.where(F.col("id").isNotNull()).distinct()
    closed = []
    for level in levels:
        stored = _with_refs(tables, level).withColumn("present", F.lit(True))
        reached = pending.where(F.col("target").isin(level)).join(stored, ["target", "id"], "left")
        reached = reached.withColumn("present", F.coalesce("present", F.lit(False)))
        if level is not levels[-1]:
            reached = cut_lineage(reached)
            found = reached.select(F.inline("refs")).where(F.col("id").isNotNull())
            pending = pending.where(~F.col("target").isin(level)).unionAll(found).distinct()
        closed.append(reached.select("target", "id", "present"))
    return reduce(DataFrame.unionAll, closed)
