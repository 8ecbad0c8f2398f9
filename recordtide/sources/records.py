"""Landed pages of nested records, one folder per resource."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordtide.schemas import RECORDS

#: JSON repeats its field names in every line; lz4 makes files a fifth of the size, at no more time. They cannot be split, so
#: they are kept short.
LANDED_AS = {"compression": "lz4", "maxRecordsPerFile": 200_000}


def record_scan(spark: SparkSession, folder: str, resource: str, pages: bool = False, landed: bool = False) -> DataFrame:
    """Typed records of one of the nine resources.

    ``pages=True`` reads files that each hold one JSON array, a page of a list
    response; otherwise every line is a record, which lets Spark split large files.
    ``landed=True`` adds ``Landed``, the time the record's file was written: of two
    versions of a record without a modification date the later file has the later one.
    """
    records = spark.read.schema(RECORDS[resource]).json(f"{folder}/{resource}", multiLine=pages)
    return records.select("*", F.col("_metadata.file_modification_time").alias("Landed")) if landed else records


def land_records(records: DataFrame, folder: str, resource: str) -> None:
    """Add records to the landing folder of a resource."""
    records.write.mode("append").options(**LANDED_AS).json(f"{folder}/{resource}")
