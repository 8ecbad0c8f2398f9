"""HMAC-SHA1 as native column expressions."""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

_BLOCK = 64


def key_pads(secret: str) -> tuple[bytes, bytes]:
    """Inner and outer pad of RFC 2104; a secret longer than a block is hashed first."""
    key = secret.encode()
    if len(key) > _BLOCK:
        key = hashlib.sha1(key).digest()
    key = key.ljust(_BLOCK, b"\0")
    return bytes(b ^ 0x36 for b in key), bytes(b ^ 0x5C for b in key)


def hmac_sha1(spark: SparkSession, secret: str, body: Column) -> Column:
    """Lower-case hex HMAC-SHA1 of the text in ``body``.

    The pads come from a one-row scalar subquery instead of literals, so the
    secret does not show in query plans.
    """
    inner, outer = key_pads(secret)
    row = spark.createDataFrame([(bytearray(inner), bytearray(outer))], "inner binary, outer binary")
    inner_pad, outer_pad = row.select("inner").scalar(), row.select("outer").scalar()
    digest = F.unhex(F.sha1(F.concat(inner_pad, F.encode(body, "utf-8"))))
    return F.sha1(F.concat(outer_pad, digest))
