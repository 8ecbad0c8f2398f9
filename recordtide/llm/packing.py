"""Best-fit packing of documents into token sequences: exact complements first, then best fit.

Documents become ids followed by an end id, and those longer than a sequence are cut, the first piece taking what is over.
How pieces go together depends on their lengths alone, and there are no more lengths than a sequence has tokens. So the plan
is made on the counts per length: from long to short, a length takes one, two or three others whose sum exactly fills the
gap, looked up in tables of single lengths, pair sums and triple sums, as often as all of them last. What is left goes to the
smallest gap that holds it. The plan is a list of runs: the pieces of one length numbered so and so go to sequences numbered
so and so, at this offset.

Pieces of a length are numbered within salted groups, each group starting behind the ones before it, so that a length shared
by a third of all pieces spreads over many tasks. Full pieces need no partner, but are numbered alike.

A null or empty text is the end id alone. Null ids pass through, and repeated rows are pieces like all others. Other columns
are ignored. An empty table gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recordtide.llm.encoding import encoder, grouped
from recordtide.llm.tables import cut_lineage, keyed_texts
from recordtide.llm.words import batches

CAPACITY = 2048
END_ID = 0
#: Pieces per salted group, on average.
GROUP = 50_000


def cut(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of the pieces of ``n`` tokens."""
    first = (n - 1) % capacity + 1
    starts = [0, *range(first, n, capacity)]
    return [(a, b - a) for a, b in zip(starts, [*starts[1:], n])]


_PIECES = pa.schema(
    [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64()), ("ids", pa.binary())]
)


def _encode(path: str, end_id: int, capacity: int, with_ids: bool):
    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(path), np.array([end_id], "<u4").tobytes()

        def rows():
            for part in parts:
                for group in grouped(zip(part.column(0).to_pylist(), part.column(1).to_pylist()), 1):
                    for (doc_id, _), ids in zip(group, coder.ids([text for _, text in group])):
                        ids += end
                        for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                            piece = ids[4 * start : 4 * (start + length)]
                            yield doc_id, k, start, length, zlib.crc32(piece), piece if with_ids else None

        yield from batches(rows(), _PIECES)

    return go


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, *, with_ids: bool = False) -> DataFrame:
    """One row per piece; ``ids`` holds its tokens as little-endian unsigned 32-bit numbers if asked for."""
    columns = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"
    out = keyed_texts(docs).mapInArrow(_encode(path, end_id, capacity, with_ids), columns)
    return out if with_ids else out.drop("ids")


def _complement(left: np.ndarray, gap: int) -> tuple[int, ...] | None:
    """One, two or three lengths that are left and sum up to ``gap``; longest first."""
    if left[gap]:
        return (gap,)
    there = left > 0
    half = np.arange(1, gap // 2 + 1)
    pair = half[there[half] & there[gap - half] & ((2 * half != gap) | (left[half] > 1))]
    if len(pair):
        return (gap - int(pair[0]), int(pair[0]))
    singles = np.flatnonzero(there[: gap // 3 + 1])
    for least in singles.tolist():
        rest = gap - least
        mid = np.arange(least, rest // 2 + 1)
        good = there[mid] & there[rest - mid]
        for m in mid[good].tolist():
            three = (rest - m, m, least)
            if all(left[x] >= three.count(x) for x in three):
                return three
    return None


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Runs ``(length, first, last, sequence, each, offset)`` for the given number of pieces of each length.

    The pieces of ``length`` numbered from ``first`` up to ``last`` (not included) go to the sequences from ``sequence`` on,
    ``each`` of them to one, one behind the other from ``offset`` on.
    """
    left, used, runs, sequences = np.zeros(capacity + 1, np.int64), np.zeros(capacity + 1, np.int64), [], 0
    for length, n in counts.items():
        left[length] = n

    def take(length: int, n: int, sequence: int, each: int, offset: int) -> None:
        runs.append((length, int(used[length]), int(used[length]) + n * each, sequence, each, offset))
        used[length] += n * each
        left[length] -= n * each

    open_: dict[int, list[tuple[int, int]]] = {}  # gap -> runs of sequences with it: first, number
    for length in range(capacity, 0, -1):
        while left[length]:
            gap, n = capacity - length, int(left[length])
            others: tuple[int, ...] | None = ()
            if gap:
                left[length] -= 1  # a complement may use the same length again
                others = _complement(left, gap)
                left[length] += 1
            if others is None:
                break
            together = (length, *others)
            n = min(int(left[x]) // together.count(x) for x in together)
            offset = 0
            for x in together:
                take(x, n, sequences, 1, offset)
                offset += x
            sequences += n
    for length in range(capacity, 0, -1):
        for gap in sorted(g for g in open_ if g >= length):
            if not left[length]:
                break
            for first, number in open_.pop(gap):
                each = gap // length
                n = min(number, int(left[length]) // each)
                if n:
                    take(length, n, first, each, capacity - gap)
                    open_.setdefault(gap - each * length, []).append((first, n))
                if n < number and left[length]:  # fewer than ``each`` are left
                    rest = int(left[length])
                    take(length, 1, first + n, rest, capacity - gap)
                    open_.setdefault(gap - rest * length, []).append((first + n, 1))
                    n += 1
                if n < number:
                    open_.setdefault(gap, []).append((first + n, number - n))
        each = capacity // length
        n = int(left[length]) // each
        if n:
            take(length, n, sequences, each, 0)
            open_.setdefault(capacity - each * length, []).append((sequences, n))
            sequences += n
        if rest := int(left[length]):
            take(length, 1, sequences, rest, 0)
            open_.setdefault(capacity - rest * length, []).append((sequences, 1))
            sequences += 1
    return runs


def _place(runs: list[tuple], capacity: int):
    """Adds sequence and offset to rows that end in length and number."""

    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(sorted(runs), np.int64).reshape(-1, 6)
        scale = np.int64(2**48)
        keys = table[:, 0] * scale + table[:, 1]
        for part in parts:
            length, number = (part.column(name).to_numpy(zero_copy_only=False) for name in ("length", "number"))
            run = table[np.searchsorted(keys, length * scale + number, side="right") - 1]
            within = number - run[:, 1]
            sequence, offset = run[:, 3] + within // run[:, 4], run[:, 5] + within % run[:, 4] * length
            names = [n for n in part.schema.names if n != "number"]
            yield pa.RecordBatch.from_arrays(
                [*(part.column(n) for n in names), pa.array(sequence), pa.array(offset)], names=[*names, "sequence_id", "offset"]
            )

    return go


def pack(cut_pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to written pieces, which have a ``length`` of at most ``capacity``."""
    salts = max(1, -(-cut_pieces.count() // group))
    salted = cut_pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    groups = cut_lineage(salted.groupBy("length", "salt").agg(F.count("*").alias("n")))
    # At most as many lengths as a sequence has tokens.
    counts = {row["length"]: row["n"] for row in groups.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = plan(counts, capacity)
    behind = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.select("length", "salt", F.coalesce(F.sum("n").over(behind), F.lit(0)).alias("before"))
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    numbered = salted.withColumn("rank", F.row_number().over(within) - 1).join(before, ["length", "salt"])
    numbered = numbered.select(*cut_pieces.columns, (F.col("before") + F.col("rank")).alias("number"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut_pieces.schema.fields)
    return numbered.mapInArrow(_place(runs, capacity), f"{fields}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str, capacity: int = CAPACITY, end_id: int = END_ID, *, with_ids: bool = False) -> DataFrame:
    return pack(cut_lineage(pieces(docs, path, capacity, end_id, with_ids=with_ids)), capacity)
