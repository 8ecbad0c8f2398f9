"""Words of documents that lie in a passage of a benchmark item: winnowed fingerprints, joined and extended.

An item's windows are all its runs of 10 words, or the whole of a shorter item. Of each window the short run of least value
is its fingerprint. A document is winnowed in the same way, so any shared window has the same fingerprint on both sides, and
a document need only look at the places it picks itself. Where a picked run is a fingerprint of the benchmark, the windows
with that fingerprint are laid over the place and compared word by word.

The fingerprints of a benchmark of up to ``BLOCK`` windows go to all tasks in one table. A larger one is cut into blocks by
item, one pass over the documents for each, and the words hit are united per document.

Words are lower-cased runs of ASCII letters and digits and of anything beyond ASCII. Null, empty and wordless texts have no
words, are clean and hit nothing. Repeated rows are judged each for itself; items of equal text all count, and items of equal
id count once. Items without an id cannot be reported and are left out: their passages hit nothing. Other columns are ignored,
null document ids pass through, and an empty benchmark leaves every document clean.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtide.llm import words as W
from recordtide.llm.tables import keyed_texts

WINDOW = 10
RUN = 5
#: Benchmark words per broadcast block: some 100 MB of tables in a task.
BLOCK = 400_000


def run_width(window: int, run: int = RUN) -> int:
    """Words in the fingerprints of a window: fewer in the windows of short items."""
    return run if window >= 2 * run else (window + 1) // 2


def prints(hashes: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of the short runs, and the position each window picks."""
    runs = W.rolling(hashes, run)
    return runs, W.window_minima(runs, window - run + 1)


def index_of(items: list[tuple[str, bytes | None]], window: int = WINDOW) -> dict[int, dict]:
    """Per window length: sorted fingerprints, and for each the windows with their offset and items."""
    known, found = W.WordHashes(), defaultdict(lambda: defaultdict(dict))
    for item, text in items:
        words = W.alnum_words(text)
        if not words:
            continue
        width = min(window, len(words))
        runs, picked = prints(known.of(words), width, run_width(width))
        for start, at in enumerate(picked.tolist()):
            key = (at - start, tuple(words[start : start + width]))
            found[width][int(runs[at])].setdefault(key, set()).add(item)
    return {
        width: {"prints": np.array(sorted(entries), np.uint64), "windows": {value: list(e.items()) for value, e in entries.items()}}
        for width, entries in found.items()
    }


def hits(words: list[bytes], hashes: np.ndarray, index: dict[int, dict]) -> tuple[np.ndarray, set]:
    """Which words lie in a window of the index, and the items of those windows."""
    hit, items = np.zeros(len(words), bool), set()
    for width, entry in index.items():
        runs, picked = prints(hashes, width, run_width(width))
        if not len(picked):
            continue
        picked = np.unique(picked)
        values = runs[picked]
        at = np.minimum(np.searchsorted(entry["prints"], values), len(entry["prints"]) - 1)
        for place in picked[entry["prints"][at] == values].tolist():
            for (offset, window), owners in entry["windows"][int(runs[place])]:
                start = place - offset
                if start >= 0 and tuple(words[start : start + width]) == window:
                    hit[start : start + width] = True
                    items |= owners
    return hit, items


_HITS = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("hit", pa.binary()), ("items", pa.list_(pa.string())), ("digest", pa.binary())])


def _scan(shared, *, alone: bool):
    """Hits of each row in a block, or at once the report if the block is the only one."""

    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, index = W.word_hashes(), shared.value

        def rows():
            for part in parts:
                for doc_id, text in zip(part.column(0).to_pylist(), W.texts(part.column(1))):
                    words = W.alnum_words(text)
                    hit, items = hits(words, known.of(words), index)
                    hit = np.packbits(hit).tobytes() if items else None
                    if alone:
                        yield _reported(doc_id, len(words), [hit] if items else [], items)
                    else:
                        yield doc_id, len(words), hit, sorted(items), xxhash.xxh3_128_digest(text or b"")

        yield from W.batches(rows(), _REPORT if alone else _HITS)

    return go


_REPORT = pa.schema(
    [("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()), ("n_items", pa.int64()), ("items_sha256", pa.string()), ("contaminated", pa.bool_())]
)


def _reported(doc_id: int | None, n_words: int, hit: Iterable[bytes], items: Iterable[str]) -> tuple:
    united = None
    for bits in hit:
        bits = np.frombuffer(bits, np.uint8)
        united = bits if united is None else united | bits
    n_hit = 0 if united is None else int(np.unpackbits(united).sum())
    names = sorted(set(items))
    return doc_id, n_words, n_hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), n_hit > 0


def _report(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows():
        for part in parts:
            for doc_id, n_words, hit, items in zip(*(part.column(i).to_pylist() for i in range(4))):
                yield _reported(doc_id, n_words, hit, items)

    yield from W.batches(rows(), _REPORT)


def blocks(benchmark: DataFrame, most: int) -> list[DataFrame]:
    """The benchmark in parts of about ``most`` words, by item."""
    size = F.size(F.split(F.coalesce("text", F.lit("")), "[^0-9A-Za-z\\x80-\\x{10FFFF}]+"))
    n = benchmark.agg(F.coalesce(F.sum(size.cast("long")), F.lit(0)).alias("n")).first()["n"]
    count = max(1, -(-n // most))
    if count == 1:
        return [benchmark]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    return [benchmark.filter(part == k) for k in range(count)]


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block: int = BLOCK) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` for every row."""
    keyed = keyed_texts(docs)
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text"))
    items = items.filter("item_id is not null")
    columns = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    found, context, parts = [], docs.sparkSession.sparkContext, blocks(items, block)
    for part in parts:
        rows = [(row["item_id"], row["text"] and row["text"].encode()) for row in part.toLocalIterator()]
        shared = context.broadcast(index_of(rows, window))
        if len(parts) == 1:  # in one step: two in a row would take two Python workers for each task
            return keyed.mapInArrow(_scan(shared, alone=True), columns)
        found.append(keyed.mapInArrow(_scan(shared, alone=False), "doc_id long, n_words long, hit binary, items array<string>, digest binary"))
    every = found[0]
    for more in found[1:]:
        every = every.union(more)
    # A group holds a row per block and copy; equal rows hit the same words, so the sets have a member per block at most.
    united = every.groupBy("doc_id", "n_words", "digest").agg(
        F.collect_set("hit").alias("hit"), F.flatten(F.collect_set("items")).alias("items"), (F.count("*") / len(found)).cast("int").alias("copies")
    )
    return united.select("doc_id", "n_words", "hit", "items", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).mapInArrow(_report, columns)
