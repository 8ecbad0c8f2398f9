"""Landed notification envelopes, as a batch or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from recordtide.schemas import ENVELOPE
from recordtide.sources.records import LANDED_AS


def notification_source(
    spark: SparkSession, folder: str, stream: bool = False, extra: T.StructType | None = None, **options
) -> DataFrame:
    """JSON-lines envelopes ``(signature, body)`` under ``folder``.

    ``extra`` names further fields the landing service adds. ``options`` go to the
    reader, for example ``maxFilesPerTrigger``.
    """
    schema = T.StructType(ENVELOPE.fields + (extra.fields if extra else []))
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).options(**options).json(folder)


def land_notifications(envelopes: DataFrame, folder: str) -> None:
    """Add envelopes to the landing folder."""
    envelopes.write.mode("append").option("ignoreNullFields", "false").options(**LANDED_AS).json(folder)
