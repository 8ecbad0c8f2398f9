"""Pending ids per (resource, operation), and their collapse to one action per id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtide.functions.scalars import parse_rfc3339_utc
from recordtide.schemas import OPERATIONS, RESOURCES
from recordtide.session import cut_lineage

BUCKETS = len(RESOURCES) * len(OPERATIONS)
CHUNK_BITS = 12
_UNREADABLE = -(2**62)


def _ordinal(value: Column, domain: tuple[str, ...]) -> Column:
    position = F.array_position(F.array(*map(F.lit, domain)), value)
    return F.when(position > 0, (position - 1).cast("int"))


def _name(ordinal: Column, domain: tuple[str, ...]) -> Column:
    return F.get(F.array(*map(F.lit, domain)), ordinal.cast("int"))


def bucket_index(resource: Column, operation: Column) -> Column:
    """Row-major code of a (resource, operation) pair, 0 to 23."""
    return _ordinal(resource, RESOURCES) * len(OPERATIONS) + _ordinal(operation, OPERATIONS)


def reverse_index(bucket: Column) -> tuple[Column, Column]:
    """The (resource, operation) pair of a bucket code."""
    width = len(OPERATIONS)
    return _name(F.floor(bucket / width), RESOURCES), _name(bucket % width, OPERATIONS)


def bucket_events(accepted: DataFrame, bits: int = CHUNK_BITS) -> DataFrame:
    """Pending ids per (resource, operation), in chunks of bounded size.

    Every arrival counts: ``ids`` holds ``{id, n}`` with the number of arrivals.
    A chunk covers 2^bits consecutive ids, so no array outgrows that however large a
    bucket is, and arrivals of a hot id are added up before the shuffle.
    """
    arrivals = accepted.groupBy("resource", "operation", "id").agg(F.count("*").alias("n"))
    chunk = F.shiftright("id", bits).alias("chunk")
    return arrivals.groupBy("resource", "operation", chunk).agg(
        F.sort_array(F.collect_list(F.struct("id", "n"))).alias("ids"), F.sum("n").alias("n_events")
    )


def bucket_domain(spark: SparkSession) -> DataFrame:
    """All 24 (resource, operation) pairs."""
    resource, operation = reverse_index(F.col("bucket"))
    buckets = spark.range(BUCKETS).select(F.col("id").alias("bucket"))
    return buckets.select(resource.alias("resource"), operation.alias("operation"))


def dense_buckets(chunks: DataFrame) -> DataFrame:
    """``bucket_events`` output plus one empty chunk for each of the 24 pairs without ids.

    The chunks are written out, as they are needed twice.
    """
    chunks = cut_lineage(chunks)
    pair = ["resource", "operation"]
    seen = chunks.select(*pair).distinct()
    # Both sides of this anti join hold at most 24 rows.
    empty = bucket_domain(chunks.sparkSession).join(F.broadcast(seen), pair, "left_anti")
    blank = empty.select(
        *pair,
        F.lit(0).cast("bigint").alias("chunk"),
        F.array().cast(chunks.schema["ids"].dataType).alias("ids"),
        F.lit(0).cast("bigint").alias("n_events"),
    )
    return chunks.unionByName(blank)


def collapse_batch(accepted: DataFrame) -> DataFrame:
    """One action per (resource, id): the one triggered last.

    Arrival order is not kept anywhere, so equal times are settled by
    deleted > updated > created. An unreadable time sorts first.
    """
    rank = _ordinal(F.col("operation"), OPERATIONS)
    micros = F.unix_micros(parse_rfc3339_utc(F.col("date_triggered")))
    # (instant, rank) fully orders the actions, so the maximum alone is the answer. Packed into one number it is a plain
    # hash aggregate; instants from year 1 to 9999 stay far from the value of an unreadable one.
    moment = F.coalesce(micros * 4, F.lit(_UNREADABLE)) + rank
    last = accepted.select("resource", "id", moment.alias("moment")).groupBy("resource", "id").agg(
        F.max("moment").alias("moment")
    )
    micros = F.shiftright(F.when(F.col("moment") >= _UNREADABLE + 4, F.col("moment")), 2)
    return last.select(
        "resource", "id",
        _name(F.pmod(F.col("moment"), F.lit(4)), OPERATIONS).alias("operation"), F.timestamp_micros(micros).alias("triggered_at"),
    )
