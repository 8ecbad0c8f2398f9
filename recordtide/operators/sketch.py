"""A mergeable bit sketch of a set of ids, to thin out a large table before it is shuffled.

A blocked Bloom filter as a table: an id sets four bits of one 64-bit word, the words are combined by ``bit_or``, and a row of
the large table stays if the word of its key has the key's bits. The table has at most ``MOST_WORDS`` rows, whatever the number
of ids, so it may be broadcast; the large side meets it in a broadcast hash join, without a shuffle. A row that should stay
always does; some others do too, so an exact semi join has to follow.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.session import cut_lineage

#: 2 MB of bits.
MOST_WORDS = 1 << 18
BITS_PER_ID = 16
#: Where the four bits of an id lie in its hash, of which they take six bits each. The word is in the lowest ones.
_SHIFTS = (24, 32, 40, 48)


def sketch_words(n_ids: int) -> int:
    """Words of a sketch for so many ids: a power of two."""
    wanted = max(1, n_ids * BITS_PER_ID // 64)
    return min(MOST_WORDS, 1 << (wanted - 1).bit_length())


def worthwhile(n_ids: int) -> bool:
    """Whether a sketch of bounded size still tells ids apart: four bits an id let some 15 percent of other rows through."""
    return n_ids * 4 <= MOST_WORDS * 64


def _word(key: Column, words: int) -> Column:
    return F.xxhash64(key.cast("bigint")).bitwiseAND(words - 1)


def _bits(key: Column) -> Column:
    spread = F.xxhash64(key.cast("bigint"))
    mask = F.lit(0).cast("bigint")
    for shift in _SHIFTS:
        bit = F.shiftrightunsigned(spread, shift).bitwiseAND(63).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return mask


def id_sketch(ids: DataFrame, key: str = "id", n_ids: int | None = None) -> tuple[DataFrame, int]:
    """The sketch ``(_word, _mask)`` of written ids, and its number of words. Sketches of equal size merge by ``bit_or``."""
    words = sketch_words(ids.count() if n_ids is None else n_ids)
    known = ids.where(F.col(key).isNotNull())
    return cut_lineage(known.groupBy(_word(F.col(key), words).alias("_word")).agg(F.bit_or(_bits(F.col(key))).alias("_mask"))), words


def may_be_among(df: DataFrame, sketch: tuple[DataFrame, int], key: str = "id") -> DataFrame:
    """The rows of ``df`` whose key may be among the ids of the sketch. No shuffle."""
    table, words = sketch
    met = df.join(F.broadcast(table), _word(F.col(key), words) == F.col("_word"))
    return met.where(F.col("_mask").bitwiseAND(_bits(F.col(key))) == _bits(F.col(key))).select(*[df[f"`{name}`"] for name in df.columns])
