"""Joins that stay balanced when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.session import cut_lineage

NULL_SALTS = 256
HOT_SHARE = 1000


def _zero(key: str) -> Column:
    """0 for every row. A plain literal would be folded out of the join keys, and the salt with it."""
    return F.pmod(F.xxhash64(key), F.lit(1))


def left_lookup(rows: DataFrame, column: str, lookup: DataFrame, key: str, spread: Column) -> DataFrame:
    """Left join to a table with unique ``key`` where ``column`` is often null.

    Nulls match nothing, yet plain hash partitioning would send all of them to one
    task. ``spread``, any value that differs between rows, scatters them. Hot
    non-null keys are split at run time by the adaptive skew join, which applies
    because both sides of this join are plain shuffles.
    """
    salt = F.when(F.col(column).isNull(), F.pmod(F.xxhash64(spread), F.lit(NULL_SALTS))).otherwise(F.lit(0))
    left = rows.withColumn("_salt", salt.cast("bigint"))
    right = lookup.withColumnRenamed(key, "_key").withColumn("_zero", _zero("_key"))
    met = (F.col(column) == F.col("_key")) & (F.col("_salt") == F.col("_zero"))
    return left.join(right, met, "left").drop("_salt", "_zero", "_key")


def join_group_facts(rows: DataFrame, groups: DataFrame, key: str, size: str, spread: Column) -> DataFrame:
    """Inner join of rows to their group's facts, one ``groups`` row per ``key``.

    ``size`` is the number of rows in the group. Fewer than ``HOT_SHARE`` groups can
    each hold more than 1/HOT_SHARE of all rows, so those are broadcast, however
    large the data. Their rows skip the key shuffle: they are scattered by ``spread``
    while all others meet their group by key. The groups are written out first,
    since they are needed three times and their size decides how the join is run.
    """
    groups = cut_lineage(groups)
    facts = F.struct(*[name for name in groups.columns if name != key])
    bar = groups.agg((F.sum(size) / HOT_SHARE).alias("bar")).scalar()
    hot = groups.where(F.col(size) > bar).select(F.col(key).alias("_hot_key"), facts.alias("_hot"))
    cold = groups.select(F.col(key).alias("_cold_key"), facts.alias("_cold"), _zero(key).alias("_zero"))
    tagged = rows.join(F.broadcast(hot), F.col(key) == F.col("_hot_key"), "left").drop("_hot_key")
    is_hot = F.col("_hot").isNotNull()
    tagged = tagged.withColumns(
        {
            "_meet": F.when(~is_hot, F.col(key)),
            "_salt": F.when(is_hot, F.pmod(F.xxhash64(spread), F.lit(NULL_SALTS))).otherwise(F.lit(0)).cast("bigint"),
        }
    )
    met = (F.col("_meet") == F.col("_cold_key")) & (F.col("_salt") == F.col("_zero"))
    joined = tagged.join(cold, met, "left").withColumn("_facts", F.coalesce("_hot", "_cold"))
    return joined.where(F.col("_facts").isNotNull()).select(*rows.columns, "_facts.*")
