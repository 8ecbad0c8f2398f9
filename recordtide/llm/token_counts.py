"""Token counts of whole texts; huge ones are encoded in overlapping chunks and spliced where both sides agree.

A document of more than ``CHUNK`` characters is cut into chunks that reach ``OVERLAP`` characters into their neighbours, and
each is encoded with offsets. Two neighbours are spliced at a white space inside their common stretch, as near to the cut as
can be, at which no token of either lies across and behind which both have the same tokens up to the next white space. No
token, special string or composition of characters crosses white space, so that such a place is stable whatever lies farther
away. If the stretch has no such place, it is doubled, in the end up to the ends of the text.

Shorter texts are cut at single spaces, which are stable for the same reason, and the parts' counts are remembered.

A null or empty text has no bytes and no tokens. Null ids pass through, repeated rows are counted each for itself, other
columns are ignored. A document is one row, so one task counts it, chunk by chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from recordtide.llm.encoding import counted_parts, cut_at_spaces, grouped
from recordtide.llm.tables import keyed_texts
from recordtide.llm.words import batches

CHUNK = 32_000
OVERLAP = 200
LIMIT = 2048


class Chunk:
    """A stretch of a text with the spans of its tokens in the text's own positions."""

    def __init__(self, tokenizer, text: str, start: int, end: int):
        self.start, self.end = max(0, start), min(len(text), end)
        encoded = tokenizer.encode(text[self.start : self.end], add_special_tokens=False)
        self.spans = np.array(encoded.offsets, np.int64).reshape(-1, 2) + self.start

    def between(self, low: int, high: int) -> np.ndarray:
        a, b = np.searchsorted(self.spans[:, 0], [low, high])
        return self.spans[a:b]

    def crossed(self, place: int) -> bool:
        """Whether a token lies across ``place``."""
        return bool(((self.spans[:, 0] < place) & (self.spans[:, 1] > place)).any())


def splice(text: str, cut: int, left: Chunk, right: Chunk) -> int | None:
    """A stable boundary common to both chunks, nearest to ``cut``."""
    low, high = max(left.start, right.start), min(left.end, right.end)
    gaps = [p for p in range(low + 1, high) if text[p].isspace()]
    ends = [high] if high == len(text) else []
    places = sorted(zip(gaps, [*gaps[1:], *ends]), key=lambda place: abs(place[0] - cut))
    for place, until in places:
        if left.crossed(place) or right.crossed(place):
            continue
        behind = left.between(place, until)
        if len(behind) and np.array_equal(behind, right.between(place, until)):
            return place
    return None


def count_huge(tokenizer, text: str, chunk: int = CHUNK, overlap: int = OVERLAP) -> int:
    """Tokens of a text, holding the encodings of two chunks at a time."""
    total, low = 0, 0
    cuts = list(range(chunk, len(text), chunk))
    left = Chunk(tokenizer, text, 0, (cuts[0] if cuts else len(text)) + overlap)
    for k, cut in enumerate(cuts):
        end = cuts[k + 1] if k + 1 < len(cuts) else len(text)
        reach = overlap
        while True:
            right = Chunk(tokenizer, text, cut - reach, end + overlap)
            place = splice(text, cut, left, right)
            if place is not None and place >= low:
                total += len(left.between(low, place))
                low, left = place, right
                break
            if cut - reach <= low and left.end >= len(text):
                # No boundary up to both ends: the stretch from the last splice on is one piece.
                left = Chunk(tokenizer, text, low, len(text))
                break
            reach *= 2
            left = Chunk(tokenizer, text, left.start, cut + reach)
        if left.end >= len(text) and place is None:
            break
    return total + len(left.between(low, len(text) + 1))


_COUNTS = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()), ("over_limit", pa.bool_())])


def _count(path: str, limit: int, chunk: int, overlap: int):
    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = counted_parts(path)

        def rows():
            for part in parts:
                for group in grouped(zip(part.column(0).to_pylist(), part.column(1).to_pylist()), 1):
                    short = [cut_at_spaces(text) if text and len(text) <= chunk else [] for _, text in group]
                    for (doc_id, text), values in zip(group, known.look_up(short)):
                        text = text or ""
                        n = sum(values) if len(text) <= chunk else count_huge(known.tokenizer, text, chunk, overlap)
                        yield doc_id, len(text.encode()), n, n > limit

        yield from batches(rows(), _COUNTS)

    return go


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT, chunk: int = CHUNK, overlap: int = OVERLAP) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` for every row."""
    return keyed_texts(docs).mapInArrow(_count(path, limit, chunk, overlap), "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
