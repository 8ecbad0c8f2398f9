"""Pages of a fixed order by number, at the cost of one page however deep: rows sorted once, in ranges of known counts."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordtide.operators.read_api import sort_columns
from recordtide.session import work_folder

#: Rows of a range at most.
RANGE_ROWS = 100_000
_PLACE_BITS = 33


@dataclass(frozen=True)
class PageIndex:
    """The rows of a table in one order, written in ranges. ``starts[k]`` is the number of rows before range ``k``.

    There is one start per ``RANGE_ROWS`` rows or task.
    """

    schema: T.StructType
    columns: list[str]
    ranges: list[str]
    starts: list[int]
    n_rows: int
    rows: DataFrame

    def page(self, page: int, page_size: int) -> DataFrame:
        """One page, counted from 1, in order; empty beyond the last one. Reads the ranges that hold it."""
        if page < 1 or page_size < 1:
            raise ValueError("page and page_size start at 1")
        first, last = (page - 1) * page_size, min(page * page_size, self.n_rows)
        if first >= last:
            return self.rows.limit(0).select(*self.columns)
        held = range(bisect_right(self.starts, first) - 1, bisect_right(self.starts, last - 1))
        spark = self.rows.sparkSession
        parts = []
        for k in held:  # as many as a page is large
            rows = spark.read.schema(self.schema).parquet(self.ranges[k])
            at = (F.col("_place") + self.starts[k]).alias("_position")
            parts.append(rows.select(*self.columns, at))
        found = parts[0]
        for part in parts[1:]:
            found = found.unionAll(part)
        return found.where(F.col("_position").between(first, last - 1)).orderBy("_position").drop("_position")


def page_index(df: DataFrame, orderby: str | Iterable[str] = "", key: str = "id", range_rows: int = RANGE_ROWS) -> PageIndex:
    """Sort ``df`` as ``order_by`` does, once, and write it in ranges.

    The sort is by range over all tasks. Nulls and ties lie as in ``order_by``: ties are settled by the key.
    """
    order = sort_columns(orderby, key)
    spark, folder = df.sparkSession, work_folder(df.sparkSession, "pages")
    at = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at)
    place = F.col("_at").bitwiseAND((1 << _PLACE_BITS) - 1)
    ranged = dealt.withColumns(
        {"_task": F.shiftright("_at", _PLACE_BITS), "_range": F.expr(f"(_at & {(1 << _PLACE_BITS) - 1}) div {range_rows}"), "_place": place % range_rows}
    ).drop("_at")
    ranged.write.partitionBy("_task", "_range").parquet(folder)
    written = spark.read.schema(ranged.schema).parquet(folder)
    counts = written.groupBy("_task", "_range").agg(F.count("*").alias("n")).orderBy("_task", "_range").collect()
    starts, total = [], 0
    for row in counts:
        starts.append(total)
        total += row["n"]
    schema = T.StructType([f for f in ranged.schema if f.name not in ("_task", "_range")])
    ranges = [f"{folder}/_task={r['_task']}/_range={r['_range']}" for r in counts]
    return PageIndex(schema, df.columns, ranges, starts, total, written)
