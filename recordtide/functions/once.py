"""Evaluate costly column expressions once per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_columns_once(df: DataFrame, columns: Mapping[str, Column]) -> DataFrame:
    """Add columns whose expressions are worked out exactly once per row.

    Spark copies the definition of a projected column into every filter on it, which
    would repeat hashing and parsing many times over. It does not do so for the
    output of a generator, so these columns come out of a one-element ``inline``.
    """
    return df.select("*", F.inline(F.array(F.struct(*[value.alias(name) for name, value in columns.items()]))))
