"""Words, shingles and windows of a text as arrays of 64-bit numbers."""

from __future__ import annotations

from collections.abc import Callable, Hashable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: Words whose hash a worker remembers; words beyond are hashed anew each time.
REMEMBERED = 150_000

_BASE = 0x9E3779B97F4A7C15  # odd, hence invertible modulo 2**64
_BASE_INVERSE = pow(_BASE, -1, 2**64)
_LOWER_ALNUM = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


_HELD: dict[Callable, dict] = {}


def held(make: Callable, key: Hashable):
    """``make(key)``, which this Python worker keeps beyond a task until it is asked for something of another make.

    Workers live on and serve all operators in turn, so what each of them remembers would add up.
    """
    if make not in _HELD:
        _HELD.clear()
    of_make = _HELD.setdefault(make, {})
    if key not in of_make:
        of_make[key] = make(key)
    return of_make[key]


class WordHashes(dict):
    """Word (bytes) to 64-bit number, worked out once per word."""

    def __init__(self, seed: int = 0):
        self.seed = seed

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word, self.seed)
        if len(self) < REMEMBERED:
            self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes(seed: int = 0) -> WordHashes:
    """The hashes of this Python worker, which outlive a task."""
    return held(WordHashes, seed)


class _Powers:
    """Powers of the base and of its inverse, extended as longer texts come along."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) <= n:
            size = max(4096, 2 * n)
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up, self.down


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """Rabin-Karp value of each run of ``width`` neighbours, modulo 2**64."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = _POWERS.upto(n + width)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * down[:n], out=sums[1:])
    return mix((sums[width:] - sums[: n - width + 1]) * up[width - 1 : n])


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values, the position of its smallest one; the last of equals."""
    if len(values) < width:
        return np.empty(0, np.int64)
    best, low, span = np.arange(len(values)), values, 1
    while span < width:
        step = min(span, width - span)
        later = low[step:] <= low[:-step]
        best = np.where(later, best[step:], best[:-step])
        low = np.where(later, low[step:], low[:-step])
        span += step
    return best


def spaced_words(text: bytes | None) -> list[bytes]:
    """Runs of bytes other than space and the control characters 9 to 13."""
    return text.split() if text else []


def alnum_words(text: bytes | None) -> list[bytes]:
    """Runs of ASCII letters, lower-cased, ASCII digits and anything beyond ASCII."""
    return text.translate(_LOWER_ALNUM).split() if text else []


#: Bytes of text that are worked on at once: arrays of that size stay in the processor's cache.
CHUNK = 300_000
#: Words of more bytes are hashed one by one.
_LONG = 64
#: The bytes of a word that are left in a number of eight.
_MASKS = np.array([256**n - 1 for n in range(9)], np.uint64)
_SPREAD = np.uint64(0xD6E8FEB86659FD93)


def chunks(part: pa.RecordBatch, most: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """The batch in slices of whole rows, with about ``most`` bytes of ``text`` beyond one row each."""
    sizes = pc.fill_null(pc.binary_length(part.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    cuts = [0, *(np.flatnonzero(np.diff(np.cumsum(sizes) // most)) + 1).tolist(), len(sizes)]
    for start, end in zip(cuts, cuts[1:]):
        if end > start:
            yield part.slice(start, end - start)


class SpacedWords:
    """The words of several texts, as ``spaced_words`` has them, by their places in all the bytes.

    Word ``k`` lies at ``starts[k]`` to ``ends[k]``; text ``i`` has words ``first[i]`` to ``first[i + 1]``.
    """

    def __init__(self, texts: Iterable[bytes | None]):
        texts = [text or b"" for text in texts]
        self.data = np.frombuffer(b" ".join((b"", *texts, b" " * 8)), np.uint8)
        self.white = (self.data == 32) | (self.data - np.uint8(9) < 5)
        edges = np.flatnonzero(self.white[1:] != self.white[:-1]) + 1
        self.starts, self.ends = edges[::2], edges[1::2]
        self.first = np.searchsorted(self.starts, np.cumsum([1, *(len(text) + 1 for text in texts)]))

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int = 0) -> np.ndarray:
        """A 64-bit number for each word: eight bytes at a time of all words, so that no table of words is needed."""
        key = np.uint64((2 * seed + 1) * int(_SPREAD) % 2**64)
        eights = np.ndarray(len(self.data) - 7, "<u8", self.data, strides=(1,))
        at, left = self.starts, self.ends - self.starts
        values = mix((eights[at] & _MASKS[np.minimum(left, 8)]) ^ key) + left.view(np.uint64) * _SPREAD
        some = np.flatnonzero(left > 8)
        at, left = at[some], left[some]
        for k in np.flatnonzero(left > _LONG).tolist():
            values[some[k]] = xxhash.xxh3_64_intdigest(self.data[at[k] : at[k] + left[k]].tobytes(), seed)
        short = left <= _LONG
        some, at, left = some[short], at[short], left[short]
        while len(some):
            at, left = at + 8, left - 8
            values[some] = mix((values[some] * _SPREAD) ^ (eights[at] & _MASKS[np.minimum(left, 8)]))
            more = left > 8
            some, at, left = some[more], at[more], left[more]
        return values

    def windows(self, width: int) -> np.ndarray:
        """The first word of each run of ``width`` words within a text."""
        counts = np.maximum(np.diff(self.first) - width + 1, 0)
        return np.arange(counts.sum()) + np.repeat(self.first[:-1] - np.cumsum(counts) + counts, counts)

    def joined(self, kept: np.ndarray | None = None) -> list[bytes]:
        """Each text as its words joined by one space; of the words for which ``kept`` is true."""
        lengths = self.ends - self.starts + 1  # with the space before
        taken = ~self.white
        taken[self.starts - 1] = True
        body = np.where(self.white, np.uint8(32), self.data)[taken]
        if kept is not None:
            body = body[np.repeat(kept, lengths)]
            lengths = lengths * kept
        body, ends = body.tobytes(), np.concatenate(([0], np.cumsum(lengths)))[self.first].tolist()
        return [body[start + 1 : end] for start, end in zip(ends, ends[1:])]


def texts(column: pa.Array | pa.ChunkedArray) -> Iterator[bytes | None]:
    """The UTF-8 bytes of a text column, one value at a time."""
    for value in column.cast(pa.binary() if column.type == pa.string() else pa.large_binary()):
        yield value.as_py()


def covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a run of ``width`` that begins at one of ``starts``."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, np.minimum(starts + width, n), -1)
    return np.cumsum(change[:n]) > 0


def batches(rows: Iterable[tuple], schema: pa.Schema, size: int = 2000, values: int = 400_000) -> Iterator[pa.RecordBatch]:
    """Arrow batches of at most ``size`` rows; lists and byte strings count towards ``values`` too."""
    columns, count, held = [[] for _ in schema], 0, 0
    for row in rows:
        for column, value in zip(columns, row):
            column.append(value)
            if isinstance(value, (list, bytes, str, np.ndarray)):
                held += len(value)
        count += 1
        if count >= size or held >= values * 8:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
            columns, count, held = [[] for _ in schema], 0, 0
    if count:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)
