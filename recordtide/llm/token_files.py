"""Token ids in binary files of patched frame-of-reference blocks, and back.

A segment is one file image, little-endian throughout::

    b"PFR1", block size u32, number of documents u32, number of blocks u32
    documents: id i64 (the least i64 for a null id, so no other id may be that), number of tokens u32
    index: start of each block from the segment's beginning, u64, and the end of the last
    blocks: number of values u16, width u8, unused u8, number of exceptions u32, least value u32,
            values less the least, packed at ``width`` bits into u64 words,
            exceptions: positions u16, then what exceeds the width u32

The width is that which holds a share (``PERCENTILE``) of a block's values; larger ones are exceptions, of which the block
keeps the low bits and the list the rest. A table of segments is written by Spark as Parquet with the image as one binary
column, so that it commits and recovers like any other output and lies in any store Spark can write to. Documents are sorted
by id across and within files by range partitioning; a shard's place in the whole follows from the counts of the shards before.

A null or empty text is the end id alone. Rows with a null id come first; rows of equal id lie together, ordered by text, and
each is a document of its own. Other columns are ignored; an empty table gives no segments.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from recordtide.llm.encoding import encoder, grouped
from recordtide.llm.tables import keyed_texts
from recordtide.llm.words import batches

MAGIC = b"PFR1"
BLOCK = 128
PERCENTILE = 95
END_ID = 2
SEGMENT_TOKENS = 500_000
#: Bytes of text per shard.
SHARD_BYTES = 16_000_000

_HEAD = struct.Struct("<4sIII")
_DOCUMENT = np.dtype([("id", "<i8"), ("n", "<u4")])
_BLOCK_HEAD = np.dtype([("n", "<u2"), ("width", "u1"), ("unused", "u1"), ("over", "<u4"), ("low", "<u4")])
_NO_ID = -(2**63)


def _words(width: int, block: int) -> int:
    return -(-width * block // 64)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of equally many values below ``2**width`` as rows of 64-bit words. Works on columns, which it turns into rows for speed."""
    columns = np.ascontiguousarray(values.T)
    out = np.zeros((_words(width, len(columns)), len(values)), np.uint64)
    for j in range(len(columns) if width else 0):
        word, shift = divmod(j * width, 64)
        out[word] |= columns[j] << np.uint64(shift)
        if shift + width > 64:
            out[word + 1] |= columns[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(out.T)


def _unpack(words: np.ndarray, width: int, block: int) -> np.ndarray:
    columns, mask = np.ascontiguousarray(words.T), np.uint64((1 << width) - 1)
    out = np.zeros((block, len(words)), np.uint64)
    for j in range(block if width else 0):
        word, shift = divmod(j * width, 64)
        out[j] = columns[word] >> np.uint64(shift)
        if shift + width > 64:
            out[j] |= columns[word + 1] << np.uint64(64 - shift)
        out[j] &= mask
    return np.ascontiguousarray(out.T)


def _bit_length(values: np.ndarray) -> np.ndarray:
    return np.frexp(values.astype(np.float64))[1].astype(np.int64)


def encode_segment(documents: list[tuple[int | None, bytes]], block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """The file image of documents given as id and little-endian 32-bit tokens."""
    values = np.frombuffer(b"".join(ids for _, ids in documents), "<u4").astype(np.uint64)
    n_blocks = -(-len(values) // block)
    heads = np.zeros(n_blocks, _BLOCK_HEAD)
    heads["n"] = np.minimum(block, len(values) - np.arange(n_blocks) * block)
    # The last block repeats its last value up to full size; its head tells how many count.
    grid = np.concatenate((values, np.repeat(values[-1:], n_blocks * block - len(values)))).reshape(n_blocks, block)
    low = grid.min(axis=1) if n_blocks else np.zeros(0, np.uint64)
    grid = grid - low[:, None]
    rank = (block - 1) * percentile // 100
    widths = _bit_length(np.partition(grid.astype(np.uint32), rank, axis=1)[:, rank]) if n_blocks else np.zeros(0, np.int64)
    over = grid >> widths[:, None].astype(np.uint64)
    heads["width"], heads["low"], heads["over"] = widths, low, (over > 0).sum(axis=1)
    bodies: list[bytes] = [b""] * n_blocks
    for width in np.unique(widths).tolist():
        which = np.flatnonzero(widths == width)
        packed = _pack(grid[which] & np.uint64((1 << width) - 1), width).astype("<u8")
        for k, row in zip(which.tolist(), packed):
            at = np.flatnonzero(over[k])
            bodies[k] = heads[k].tobytes() + row.tobytes() + at.astype("<u2").tobytes() + over[k][at].astype("<u4").tobytes()
    table = np.array([(_NO_ID if doc_id is None else doc_id, len(ids) // 4) for doc_id, ids in documents], _DOCUMENT)
    begin = _HEAD.size + table.nbytes + 8 * (n_blocks + 1)
    index = begin + np.concatenate(([0], np.cumsum([len(b) for b in bodies], dtype=np.int64))).astype("<u8")
    return _HEAD.pack(MAGIC, block, len(table), n_blocks) + table.tobytes() + index.astype("<u8").tobytes() + b"".join(bodies)


def _read_block(image: bytes, start: int, block: int) -> np.ndarray:
    head = np.frombuffer(image, _BLOCK_HEAD, 1, start)[0]
    width, over = int(head["width"]), int(head["over"])
    at = start + _BLOCK_HEAD.itemsize
    words = np.frombuffer(image, "<u8", _words(width, block), at)
    values = _unpack(words[None, :].astype(np.uint64), width, block)[0]
    at += words.nbytes
    places = np.frombuffer(image, "<u2", over, at)
    values[places] |= np.frombuffer(image, "<u4", over, at + places.nbytes).astype(np.uint64) << np.uint64(width)
    return (values + np.uint64(head["low"]))[: int(head["n"])]


def _layout(image: bytes) -> tuple[int, np.ndarray, np.ndarray]:
    magic, block, n_documents, n_blocks = _HEAD.unpack_from(image)
    if magic != MAGIC:
        raise ValueError("not a token segment")
    table = np.frombuffer(image, _DOCUMENT, n_documents, _HEAD.size)
    return block, table, np.frombuffer(image, "<u8", n_blocks + 1, _HEAD.size + table.nbytes).astype(np.int64)


def read_tokens(image: bytes, start: int, n: int) -> np.ndarray:
    """Tokens ``start`` to ``start + n`` of a segment, reading only the blocks that hold them."""
    block, _, index = _layout(image)
    first, last = start // block, -(-(start + n) // block)
    values = [_read_block(image, int(index[k]), block) for k in range(first, min(last, len(index) - 1))]
    return np.concatenate([np.zeros(0, np.uint64), *values])[start - first * block :][:n].astype("<u4")


def decode_segment(image: bytes) -> Iterator[tuple[int | None, np.ndarray]]:
    """All documents of a segment. Blocks of one width are unpacked together."""
    block, table, index = _layout(image)
    starts = index[:-1]
    raw = np.frombuffer(image, np.uint8)
    size = _BLOCK_HEAD.itemsize
    heads = raw[starts[:, None] + np.arange(size)].copy().view(_BLOCK_HEAD).reshape(-1)
    values = np.zeros((len(starts), block), np.uint64)
    for width in np.unique(heads["width"]).tolist():
        which = np.flatnonzero(heads["width"] == width)
        n = 8 * _words(width, block)
        words = raw[starts[which][:, None] + size + np.arange(n)].copy().view("<u8") if n else np.zeros((len(which), 0), np.uint64)
        values[which] = _unpack(words.astype(np.uint64), width, block)
    over = heads["over"].astype(np.int64)
    if over.sum():
        row = np.repeat(np.arange(len(starts)), over)
        nth = np.arange(over.sum()) - np.repeat(np.cumsum(over) - over, over)
        lists = starts + size + 8 * -(-heads["width"].astype(np.int64) * block // 64)
        place = raw[(lists[row] + 2 * nth)[:, None] + np.arange(2)].copy().view("<u2").reshape(-1)
        rest = raw[(lists[row] + 2 * over[row] + 4 * nth)[:, None] + np.arange(4)].copy().view("<u4").reshape(-1)
        values[row, place] |= rest.astype(np.uint64) << heads["width"][row].astype(np.uint64)
    flat = (values + heads["low"].astype(np.uint64)[:, None]).reshape(-1).astype("<u4")
    ends = np.cumsum(table["n"].astype(np.int64))
    for doc_id, end, n in zip(table["id"].tolist(), ends.tolist(), table["n"].tolist()):
        yield None if doc_id == _NO_ID else doc_id, flat[end - n : end]


_SEGMENTS = pa.schema([("segment", pa.int32()), ("n_tokens", pa.int64()), ("first_id", pa.int64()), ("last_id", pa.int64()), ("image", pa.binary())])


def _write(path: str, end_id: int, segment_tokens: int):
    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, end = encoder(path), np.array([end_id], "<u4").tobytes()

        def documents():
            for part in parts:
                for group in grouped(zip(part.column(0).to_pylist(), part.column(1).to_pylist()), 1):
                    for (doc_id, _), ids in zip(group, coder.ids([text for _, text in group])):
                        yield doc_id, ids + end

        def rows():
            held, n, segment = [], 0, 0
            for doc_id, ids in documents():
                held.append((doc_id, ids))
                n += len(ids) // 4
                if n >= segment_tokens:
                    yield segment, n, held[0][0], doc_id, encode_segment(held)
                    held, n, segment = [], 0, segment + 1
            if held:
                yield segment, n, held[0][0], held[-1][0], encode_segment(held)

        yield from batches(rows(), _SEGMENTS, size=1)

    return go


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int = END_ID, segment_tokens: int = SEGMENT_TOKENS, shard_bytes: int = SHARD_BYTES) -> None:
    """Write the tokens of all texts to ``folder`` in ascending order of ids."""
    keyed = keyed_texts(docs)
    size = keyed.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    sorted_ = keyed.repartitionByRange(max(1, -(-size // shard_bytes)), "doc_id").sortWithinPartitions("doc_id", "text")
    columns = "segment int, n_tokens long, first_id long, last_id long, image binary"
    sorted_.mapInArrow(_write(path, end_id, segment_tokens), columns).select(F.spark_partition_id().alias("shard"), "*").write.parquet(folder)


_READ = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())])


def _read(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for part in parts:
            for before, image in zip(part.column(0).to_pylist(), part.column(1)):
                for doc_id, ids in decode_segment(image.as_py()):
                    yield doc_id, before, len(ids), zlib.crc32(ids.tobytes())
                    before += len(ids)

    yield from batches(rows(), _READ)


def read_documents(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files."""
    segments = spark.read.parquet(folder)
    # Shards are in order of ids, as are the segments of one: first the sums of the shards, then those within each.
    shards = segments.groupBy("shard").agg(F.sum("n_tokens").alias("n"))
    ahead = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = shards.select("shard", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("ahead"))
    within = Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)
    places = segments.select("shard", "segment", "n_tokens").withColumn("inside", F.coalesce(F.sum("n_tokens").over(within), F.lit(0)))
    places = places.join(shards, "shard").select("shard", "segment", (F.col("ahead") + F.col("inside")).alias("start"))
    # One row of a few numbers per segment of some 500,000 tokens, so it is broadcast and the images stay where they are.
    placed = segments.select("shard", "segment", "image").join(F.broadcast(places), ["shard", "segment"]).select("start", "image")
    return placed.mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")
