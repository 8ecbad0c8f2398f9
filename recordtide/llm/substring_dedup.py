"""Removal of passages that occur more than once: every window of 35 words whose word sequence also starts elsewhere.

Rabin-Karp values of all windows of a text are worked out in one pass. Not all of them have to be shuffled to be counted. Of
the short word runs within a window, the one of least value is its anchor; equal windows have equal anchors, so a window
whose anchor run is picked only once in the whole corpus is itself unique. The count of the picked runs (about one in a dozen
words) thus sets aside nearly all unique windows, and just the others are counted by their own value. Neither count
collects anything: both are partial sums which also carry one place, and where the sum is one, that place is the only one.

Windows are told apart by 96 bits of hash. They are judged on the input, and all occurrences go, the first included. Words
are runs of bytes other than space and the control characters 9 to 13, unchanged. Null, empty and short texts have no window
and stay as they are; repeated rows are copies that remove each other. Rows with a null id are kept whole and do not count as a
place. Rows of one id and different texts share their places: where a window of one is unique, the others keep it too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordtide.llm import words as W
from recordtide.llm.tables import cut_lineage, keyed_texts, release

WINDOW = 35
RUN = 12


def anchors(hashes: np.ndarray, window: int, run: int) -> tuple[np.ndarray, np.ndarray]:
    """Values of all short runs, and for each window the position of its anchor."""
    runs = W.rolling(hashes, run)
    return runs, W.window_minima(runs, window - run + 1)


_PLACES = [("doc_id", pa.int64()), ("place", pa.int32())]
_ANCHORS = pa.schema([("value", pa.int64()), *_PLACES])


def _places(ids: pa.Array, words: W.SpacedWords, at: np.ndarray) -> list[np.ndarray]:
    """The ids of the texts that hold the words ``at``, and the places of these words in them."""
    counts = np.diff(np.searchsorted(at, words.first))
    return [np.repeat(ids.to_numpy(zero_copy_only=False), counts), (at - np.repeat(words.first[:-1], counts)).astype(np.int32)]


def _at_places(words: W.SpacedWords, places: pa.Array) -> np.ndarray:
    """Which words are listed, each text having a list of places; a place beyond its words is of another text of that id."""
    counts = pc.fill_null(pc.list_value_length(places), 0).to_numpy(zero_copy_only=False)
    values = places.flatten().to_numpy(zero_copy_only=False)
    within = values < np.repeat(np.diff(words.first), counts)
    listed = np.zeros(len(words), bool)
    listed[(values + np.repeat(words.first[:-1], counts))[within]] = True
    return listed


def _anchor_rows(window: int, run: int):
    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0
        for part in parts:
            for some in W.chunks(part):
                words = W.SpacedWords(W.texts(some.column("text")))
                runs, at = anchors(words.hashes(), window, run)
                at = at[words.windows(window)]
                at = at[np.diff(at, prepend=-1) != 0]  # they never go back
                rows.append([runs[at].view(np.int64), *_places(some.column("doc_id"), words, at)])
                held += len(at)
                if held > 200_000:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], schema=_ANCHORS)
                    rows, held = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*rows)], schema=_ANCHORS)

    return go


def as_runs(starts: np.ndarray) -> bytes:
    """Ascending positions as pairs of a first one and how many follow each other, which is far shorter in copied texts."""
    heads = np.flatnonzero(np.diff(starts, prepend=-2) != 1)
    lengths = np.diff(heads, append=len(starts))
    return np.column_stack((starts[heads], lengths)).astype("<i4").tobytes()


def from_runs(runs: bytes) -> np.ndarray:
    first, lengths = np.frombuffer(runs, "<i4").astype(np.int64).reshape(-1, 2).T
    ends = np.cumsum(lengths)
    return np.arange(lengths.sum()) + np.repeat(first - ends + lengths, lengths)


_TESTED = pa.schema(
    [("doc_id", pa.int64()), ("text", pa.string()), ("runs", pa.binary()), ("n_words", pa.int64()), ("kept_sha256", pa.string())]
)


def _split(window: int, run: int):
    """Rows with a candidate window keep their text and the runs of starts; the others are finished.

    Candidates are the windows whose anchor occurs more than once; ``once`` holds the places of the other anchors.
    """

    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for some in (some for part in parts for some in W.chunks(part)):
                ids, texts = some.column("doc_id"), list(W.texts(some.column("text")))
                words = W.SpacedWords(texts)
                _, at = anchors(words.hashes(), window, run)
                starts = words.windows(window)
                starts = starts[~_at_places(words, some.column("once"))[at[starts]]]
                ends = np.searchsorted(starts, words.first).tolist()
                for k, (doc_id, text, body) in enumerate(zip(ids.to_pylist(), texts, words.joined())):
                    n_words = int(words.first[k + 1] - words.first[k])
                    if doc_id is not None and ends[k] < ends[k + 1]:
                        yield doc_id, text.decode(), as_runs(starts[ends[k] : ends[k + 1]] - words.first[k]), n_words, None
                    else:
                        yield doc_id, None, None, n_words, hashlib.sha256(body).hexdigest()

        yield from W.batches(rows(), _TESTED)

    return go


def _starts(words: W.SpacedWords, runs: pa.Array) -> np.ndarray:
    """The candidate windows of all texts by their first word."""
    return np.concatenate([from_runs(of_text) + first for of_text, first in zip(runs.to_pylist(), words.first.tolist())])


_WINDOWS = pa.schema([("value", pa.int64()), ("check", pa.int32()), *_PLACES])


def _window_rows(window: int):
    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for some in (some for part in parts for some in W.chunks(part)):
            words = W.SpacedWords(W.texts(some.column("text")))
            starts = _starts(words, some.column("runs"))
            value = W.rolling(words.hashes(), window)[starts].view(np.int64)
            check = (W.rolling(words.hashes(1), window)[starts] >> np.uint64(32)).astype(np.uint32).view(np.int32)
            columns = [value, check, *_places(some.column("doc_id"), words, starts)]
            yield pa.RecordBatch.from_arrays([pa.array(column) for column in columns], schema=_WINDOWS)

    return go


_KEPT = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()), ("kept", pa.string())])


def _remove(window: int, with_text: bool):
    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for some in (some for part in parts for some in W.chunks(part)):
                words = W.SpacedWords(W.texts(some.column("text")))
                starts = _starts(words, some.column("runs"))
                starts = starts[~_at_places(words, some.column("once"))[starts]]
                gone = W.covered(starts, window, len(words))
                n_gone = np.diff(np.concatenate(([0], np.cumsum(gone)))[words.first]).tolist()
                for doc_id, n_words, n, body in zip(some.column("doc_id").to_pylist(), np.diff(words.first).tolist(), n_gone, words.joined(~gone)):
                    yield doc_id, n_words, n, hashlib.sha256(body).hexdigest(), body.decode() if with_text and n else None

        yield from W.batches(rows(), _KEPT)

    return go


def _sole_places(rows: DataFrame, *key: str) -> DataFrame:
    """Per document the places of keys that occur once."""
    counted = rows.groupBy(*key).agg(F.count("*").alias("n"), F.max("doc_id").alias("doc_id"), F.max("place").alias("place"))
    return counted.filter("n = 1").groupBy("doc_id").agg(F.collect_list("place").alias("once"))


def removed(docs: DataFrame, window: int = WINDOW, run: int = RUN, *, with_text: bool = False) -> DataFrame:
    """``doc_id, n_words, n_removed, kept_sha256`` and, if asked for, ``kept``: the words left, joined by one space.

    With ``with_text``, ``kept`` is null for documents that lose nothing.
    """
    keyed = keyed_texts(docs)
    places = keyed.filter("doc_id is not null").mapInArrow(_anchor_rows(window, run), "value long, doc_id long, place int")
    sole = _sole_places(places, "value").withColumnRenamed("doc_id", "sole_id")
    tested = keyed.join(sole, keyed["doc_id"] == sole["sole_id"], "left").select("doc_id", "text", "once")
    tested = cut_lineage(tested.mapInArrow(_split(window, run), "doc_id long, text string, runs binary, n_words long, kept_sha256 string"), codec="zstd")
    del places, sole
    release(docs.sparkSession)  # their shuffles are done with
    open_ = tested.filter("runs is not null").select("doc_id", "text", "runs")
    windows = open_.mapInArrow(_window_rows(window), "value long, check int, doc_id long, place int")
    sole = _sole_places(windows, "value", "check").withColumnRenamed("doc_id", "sole_id")
    ended = open_.join(sole, open_["doc_id"] == sole["sole_id"], "left").select("doc_id", "text", "runs", "once")
    columns = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"
    ended = ended.mapInArrow(_remove(window, with_text), columns)
    same = tested.filter("runs is null").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), "kept_sha256", F.lit(None).cast("string").alias("kept"))
    out = same.union(ended)
    return out if with_text else out.drop("kept")
