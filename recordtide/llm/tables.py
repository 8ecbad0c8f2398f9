"""Reading inputs and cutting lineage for the operators of this subpackage."""

from __future__ import annotations

import gc
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtide.session import cut_lineage

#: Rows of ids that may be broadcast: 16 MB. Larger sides are joined by shuffle.
BROADCAST_IDS = 1_000_000
#: Rows per file of tables whose size is known beforehand.
FILE_ROWS = 20_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def keyed_texts(docs: DataFrame) -> DataFrame:
    """Just id and text, whatever other columns there are."""
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("string").alias("text"))


def small(ids: DataFrame) -> DataFrame:
    """Marks a written table of ids for broadcast if it is small enough, by its counted rows."""
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids


def cut_few(df: DataFrame, most: int, rows: int = FILE_ROWS) -> DataFrame:
    """``cut_lineage`` for a table known to have ``most`` rows at most, in no more files than these need at so many ``rows`` each.

    Each file costs the executors more than some thousand rows do, and a wide shuffle leaves a small table in many.
    """
    return cut_lineage(df.coalesce(max(df.sparkSession.sparkContext.defaultParallelism, -(-most // rows))))


def release(spark: SparkSession) -> None:
    """Lets go of the shuffle files of finished steps, which else stay until the driver happens to collect its garbage."""
    for _ in range(2):  # the second time for what the first one has made free
        gc.collect()
        spark.sparkContext._jvm.System.gc()
        time.sleep(0.2)


def tokenizer_file(name: str) -> str:
    """Path of a public tokenizer's vocabulary, the same on all machines."""
    import public_tokenizers

    return public_tokenizers.path(name)


__all__ = ["cut_few", "cut_lineage", "keyed_texts", "release", "small", "table", "tokenizer_file"]
