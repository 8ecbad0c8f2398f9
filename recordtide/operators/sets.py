"""Distinct references, duplicates, and unions of several views of one entity."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.schemas import Edge


def unpivot_fks(child: DataFrame, edges: Iterable[Edge], key: str = "id") -> DataFrame:
    """One row ``(id, column, target, fk)`` per non-null foreign key."""
    refs = [
        F.struct(F.lit(edge.column).alias("column"), F.lit(edge.parent).alias("target"), F.col(edge.column).alias("fk"))
        for edge in edges
    ]
    rows = child.select(F.col(key).alias("id"), F.explode(F.array(*refs)).alias("ref")).select("id", "ref.*")
    return rows.where(F.col("fk").isNotNull())


def distinct_fk_ids(child: DataFrame, targets: Mapping[str, str]) -> DataFrame:
    """Distinct non-null ids over several columns, tagged with the table they point to.

    ``targets`` maps column -> table. Duplicates go away before the shuffle.
    """
    refs = [
        F.struct(F.lit(table).alias("target"), F.col(column).cast("bigint").alias("id"))
        for column, table in targets.items()
    ]
    tagged = child.select(F.inline(F.array(*refs)))
    return tagged.where(F.col("id").isNotNull()).distinct()


def duplicate_groups(df: DataFrame, content: Column, member: Column) -> DataFrame:
    """Groups of equal content with more than one member: ``(content, n, first_member)``.

    Counts and the least member aggregate before the shuffle; member lists, which
    grow with the data, are never gathered. ``duplicate_members`` gives them as rows.
    Missing content equals nothing.
    """
    return (
        df.select(content.alias("content"), member.alias("member")).where(F.col("content").isNotNull()).groupBy("content")
        .agg(F.count("*").alias("n"), F.min("member").alias("first_member"))
        .where(F.col("n") > 1)
    )


def pk_duplicates(df: DataFrame, *key: str) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*key).agg(F.count("*").alias("n")).where(F.col("n") > 1)


def union_missing(first: DataFrame, second: DataFrame) -> DataFrame:
    """Union of two shapes of one entity: all fields kept, none required."""
    return first.unionByName(second, allowMissingColumns=True)


def merge_existing_wins(existing: DataFrame, incoming: DataFrame, key: str) -> DataFrame:
    """Per key and column keep the stored value and fill only gaps. Keys are unique on each side."""
    left, right = existing.alias("e"), incoming.alias("i")
    merged = []
    for name in dict.fromkeys([*existing.columns, *incoming.columns]):
        sides = [
            F.col(f"{side}.{name}") for side, df in (("e", existing), ("i", incoming)) if name in df.columns
        ]
        merged.append(F.coalesce(*sides).alias(name))
    return left.join(right, F.col(f"e.{key}") == F.col(f"i.{key}"), "full").select(*merged)


def fold_partial_views(full: DataFrame, partial: DataFrame, key: str = "id") -> DataFrame:
    """Add entities that are only known from a narrower view; known ones stay as they are.

    The narrow view must have a subset of the full columns. Of several mentions of
    one id the one with the fewest gaps counts as a whole, then the least, settled
    before the shuffle.
    """
    extra = set(partial.columns) - set(full.columns)
    rest = [name for name in partial.columns if name != key]
    if extra or not rest:
        raise ValueError(f"not a narrower view of {full.columns}: {partial.columns}")
    gaps = reduce(add, [F.col(name).isNull().cast("int") for name in rest])
    mention = F.min(F.struct(gaps.alias("_gaps"), *rest)).alias("_mention")
    mentions = partial.where(F.col(key).isNotNull()).groupBy(key).agg(mention).select(key, *[f"_mention.{name}" for name in rest])
    unknown = mentions.join(full.select(key), key, "left_anti")
    return union_missing(full, unknown)
