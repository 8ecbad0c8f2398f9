"""Strict scalar parsing as native column expressions.

Spark's own casts accept more than the record formats allow (blanks, fractions,
stamps without an offset), so each parser first guards the text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from recordtide.schemas import STALE_AFTER_DAYS

INTEGER = r"\A[+-]?[0-9]+\z"
_DAY = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}"
RFC3339 = (
    _DAY + r"[Tt ][0-9]{2}:[0-9]{2}:[0-9]{2}(?:\.[0-9]+)?(?:[Zz]|[+\-\x{2212}](?:[01][0-9]|2[0-3]):[0-5][0-9])\z"
)
# The usual spelling, which Spark's own cast reads exactly: no leap second, offset below 18 hours.
_PLAIN_RFC3339 = (
    _DAY + r"[T ][0-9]{2}:[0-9]{2}:[0-5][0-9](?:\.[0-9]+)?(?:Z|[+-](?:0[0-9]|1[0-7]):[0-5][0-9])\z"
)
_MICROS_PER_MINUTE = 60_000_000


def parse_id(text: Column, on_error: str = "null") -> Column:
    """Text -> 64-bit integer; anything else is null, or fails with ``on_error='fail'``."""
    value = F.when(text.rlike(INTEGER), text.try_cast("bigint"))
    if on_error == "null":
        return value
    message = F.concat(F.lit("not a 64-bit integer: "), F.coalesce(text, F.lit("<null>")))
    return F.coalesce(value, F.raise_error(message).cast("bigint"))


def parse_rfc3339_utc(text: Column) -> Column:
    """RFC 3339 text with an offset -> instant in microseconds; null when malformed.

    The session zone plays no part. Lower-case ``t`` and ``z``, offsets up to 23:59
    and leap seconds (the second after :59) are read by parts.
    """
    return F.when(text.rlike(_PLAIN_RFC3339), text.try_cast("timestamp")).when(
        text.rlike(RFC3339), _rfc3339_by_parts(text)
    )


def _rfc3339_by_parts(text: Column) -> Column:
    zulu = F.lower(F.right(text, F.lit(1))) == "z"
    offset = F.when(zulu, F.lit("+00:00")).otherwise(F.right(text, F.lit(6)))
    leap = F.substring(text, 18, 2) == "60"
    fraction = F.regexp_extract(text, r"(\.[0-9]{1,6})", 1)
    clock = F.concat(F.substring(text, 12, 6), F.when(leap, F.lit("59")).otherwise(F.substring(text, 18, 2)))
    local = F.concat(F.substring(text, 1, 10), F.lit("T"), clock, fraction, F.lit("Z"))
    minutes = F.substring(offset, 2, 2).try_cast("int") * 60 + F.substring(offset, 5, 2).try_cast("int")
    east = F.when(F.substring(offset, 1, 1) == "+", F.lit(1)).otherwise(F.lit(-1))
    return F.timestamp_micros(
        F.unix_micros(local.try_cast("timestamp"))
        - east * minutes.cast("bigint") * _MICROS_PER_MINUTE
        + F.when(leap, F.lit(1_000_000)).otherwise(F.lit(0))
    )


def split_once(text: Column, delimiter: str = "-") -> tuple[Column, Column]:
    """Split at the first delimiter; each side is an id or null on its own."""
    split = F.contains(text, F.lit(delimiter))
    left = F.substring_index(text, delimiter, 1)
    right = F.substring(text, F.length(left) + len(delimiter) + 1, F.length(text))
    return F.when(split, parse_id(left)), F.when(split, parse_id(right))


def decode_reference(kind: Column, reference: Column) -> dict[str, Column]:
    """The schedule type decides what its reference text means.

    ``reference_valid`` is false only where a single id was needed and did not parse.
    """
    single = parse_id(reference)
    first, second = split_once(reference)
    paired, alone = kind.isin("job", "quote"), kind.isin("activity", "lead")
    return {
        "job_id": F.when(kind == "job", first),
        "cost_center_id": F.when(paired, second),
        "activity_id": F.when(kind == "activity", single),
        "quote_id": F.when(kind == "quote", first),
        "lead_id": F.when(kind == "lead", single),
        "reference_valid": F.coalesce(~alone | single.isNotNull(), F.lit(False)),
    }


def enum_domain(text: Column, domain: Iterable[str], on_error: str = "null") -> Column:
    """Keep the text when it belongs to a closed set; else null, or fail."""
    value = F.when(text.isin(*domain), text)
    if on_error == "null":
        return value
    message = F.concat(F.lit("not in domain: "), F.coalesce(text, F.lit("<null>")))
    return F.coalesce(value, F.raise_error(message).cast("string"))


def is_stale(stamp: Column, now: Column, max_days: int = STALE_AFTER_DAYS) -> Column:
    """True when ``stamp`` lies more than ``max_days`` before ``now``, in whole seconds.

    Null, empty or unreadable text is not stale. Text without an offset is UTC.
    """
    zoned = (
        F.when(stamp.rlike(r"\A[0-9-]+\z"), F.concat(stamp, F.lit("T00:00:00Z")))
        .when(stamp.rlike(r"([Zz]|[+-][0-9]{2}:?[0-9]{2})\z"), F.upper(stamp))
        .otherwise(F.concat(stamp, F.lit("Z")))
    )
    age = F.unix_seconds(now) - F.unix_seconds(zoned.try_cast("timestamp"))
    return F.coalesce(age > max_days * 86_400, F.lit(False))


def _canonical(value: Column, kind: T.DataType) -> Column:
    """``value`` with struct fields in name order, at every depth."""
    if isinstance(kind, T.StructType):
        fields = [_canonical(value[f.name], f.dataType).alias(f.name) for f in sorted(kind, key=lambda f: f.name)]
        return F.when(value.isNotNull(), F.struct(*fields))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: _canonical(item, kind.elementType))
    return value


def content_hash(df: DataFrame, *columns: str) -> Column:
    """SHA-256 over compact JSON with sorted keys; nulls are part of the content."""
    fields = [_canonical(df[name], df.schema[name].dataType).alias(name) for name in sorted(columns or df.columns)]
    return F.sha2(F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}), 256)
