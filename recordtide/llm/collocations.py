"""Phrases of two to four words that occur together more often than their parts, the best of each language.

A phrase is grown word by word behind its prefix. The phrase ``q`` with prefix ``p`` occurs no more often than ``p``, and its
parts no less often than itself, so ``floor(2000000 * f(p) / (f(first word) + f(p)))`` bounds the score of every phrase that grows
from ``p``: the prefix' own count gives an admissible bound. Growth is best-first. The phrases known so far that no longer
phrase covers give a score that each language's list reaches already; only prefixes whose bound reaches it are expanded, that
is, their continuations are counted, and beside them those prefixes that decide whether a phrase in the list is covered from
the left. A phrase is covered if a longer candidate around it has at least 80 percent of its count; such a one has a
continuation by one word, to the left or to the right, that is as frequent or more, so that counts of continuations decide it.
The search ends when no prefix left reaches the last score of any list, ties included, so nothing left could enter it.

The corpus is written once as blocks of word numbers with each block's own word list and counts, from which words are counted.
Pairs of frequent words are first counted by 64-bit hashes. The blocks are written again without the words that are in no frequent
pair, as those can be in no phrase. In what is left pairs are counted by their words, and every expansion is a further pass, for
all prefixes due in any language at once. A task emits each phrase of a block once; Spark adds
them up. Tasks know frequent words, pairs and prefixes through bit fields of at most 2**27 bits (``BITS``), addressed by a hash:
a wrong hit counts some phrases in vain, which counts by words and a join with the true prefixes drop. The search goes four times
as deep as the list in the first round and doubles that in every further one, so that the number of passes grows with the logarithm
at most.

A null text is empty, a null language is ``und``. Ids and other columns are ignored, so repeated rows count each for itself.
An empty table gives no rows. A language whose candidates are fewer than its limit gets them all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordtide.llm.tables import cut_lineage
from recordtide.llm.words import mix

LEAST = 30
LIMIT = 2000
LONGEST = 4
COVER = 80
#: Bits of a field of hashes: 16 MB at most.
BITS = 27
#: Words of a block, beyond which it ends, and words a task knows by number at a time, per language.
BLOCK, KNOWN = 250_000, 100_000
#: Bytes of text split at a time.
SPLIT = 1_000_000
#: Hashes of pairs held at a time.
HELD = 2_000_000

#: Capitals become small, what ends a piece a full stop, a tab a space.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 46 if c in b".,;:!?" or 10 <= c <= 13 else 32 if c == 9 else c for c in range(256))
_TURN = np.uint64(0xD6E8FEB86659FD93)


class Lexicon(dict):
    """Numbers of a language's words, from 1 on; 0 is the end of a piece."""

    def __init__(self, lang: str):
        self.seed = xxhash.xxh3_64_intdigest(lang.encode())
        self.words = [b"."]
        self[b"."] = 0
        self.hashes = np.zeros(1, np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self.words)
        self.words.append(word)
        return number

    def hashed(self) -> np.ndarray:
        new = [xxhash.xxh3_64_intdigest(word, self.seed) for word in self.words[len(self.hashes) :]]
        self.hashes = np.concatenate((self.hashes, np.array(new, np.uint64)))
        return self.hashes


def phrase_hash(parts: list[np.ndarray]) -> np.ndarray:
    """One number for the hashes of a phrase's words."""
    total = parts[0]
    for part in parts[1:]:
        total = mix(total * _TURN + part)
    return total


def has(field: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether the bits of hashes are set."""
    at = (hashes >> np.uint64(64 - (len(field) * 8).bit_length() + 1)).astype(np.int64)
    return (field[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


def numbers(lexicon: Lexicon, texts: list[bytes]) -> np.ndarray:
    """The words of texts by number, 0 between pieces."""
    found = b".".join([*texts, b""]).translate(_FOLD).replace(b".", b" . ").split()
    return np.fromiter(map(lexicon.__getitem__, found), np.int64, len(found))


def _distinct(ids: np.ndarray, starts: np.ndarray, length: int, base: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The distinct runs of ``length`` numbers at ``starts``, a column for each place, and how often each occurs."""
    codes, seen = ids[starts], []
    for k in range(1, length):
        if k > 1:  # by rank, so that a code stays below the number of runs times that of words
            ranks, codes = np.unique(codes, return_inverse=True)
            seen.append(ranks)
        codes = codes * base + ids[starts + k]
    codes, counts = np.unique(codes, return_counts=True)
    columns = []
    for k in range(length - 1, 0, -1):
        codes, last = np.divmod(codes, base)
        columns.append(last)
        if k > 1:
            codes = seen[k - 2][codes]
    return [codes, *reversed(columns)] if length > 1 else [codes], counts


_COUNTED = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("size", pa.int8()), ("n", pa.int64())])
_BLOCKS = pa.schema([("lang", pa.string()), *((name, pa.binary()) for name in ("words", "counts", "hashes", "ids"))])
_BLOCK_COLUMNS = "lang string, words binary, counts binary, hashes binary, ids binary"


def _spelled(lang: str, words: np.ndarray, columns: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Rows of phrases, given as a column of word numbers for each place."""
    for a in range(0, len(counts), 50_000):
        spell = [words[c[a : a + 50_000]] for c in columns]
        phrases = list(map(b" ".join, zip(*spell))) if len(spell) > 1 else list(spell[0])
        m = len(phrases)
        yield pa.RecordBatch.from_arrays(
            [pa.array([lang] * m), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array(np.full(m, len(columns), np.int8)), pa.array(counts[a : a + m])],
            schema=_COUNTED,
        )


def _whole_blocks(parts: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, Lexicon, np.ndarray]]:
    """The words of the texts of one language by number, block by block. Any text lies in one block."""
    lexicons: dict[str, Lexicon] = {}
    raw: dict[str, list[bytes]] = {}
    held: dict[str, list[np.ndarray]] = {}
    n_bytes, n_words = dict[str, int](), dict[str, int]()

    def split(lang: str) -> None:
        ids = numbers(lexicons.setdefault(lang, Lexicon(lang)), raw.pop(lang))
        held.setdefault(lang, []).append(ids)
        n_words[lang] = n_words.get(lang, 0) + len(ids)
        n_bytes[lang] = 0

    def whole(lang: str) -> tuple[str, Lexicon, np.ndarray]:
        if lang in raw:
            split(lang)
        ids, lexicon = np.concatenate(held.pop(lang)), lexicons[lang]
        n_words[lang] = 0
        if len(lexicon.words) > KNOWN or len(lexicons) > 64:
            del lexicons[lang]
        return lang, lexicon, ids

    for part in parts:
        for lang, text in zip(part.column(0).to_pylist(), part.column(1).cast(pa.binary())):
            text = text.as_py()
            if not text:
                continue
            raw.setdefault(lang, []).append(text)
            n_bytes[lang] = n_bytes.get(lang, 0) + len(text)
            if n_bytes[lang] >= SPLIT:
                split(lang)
            if n_words.get(lang, 0) >= BLOCK or (lang in lexicons and lang in held and len(lexicons[lang].words) > KNOWN):
                yield whole(lang)
            elif len(raw.keys() | held.keys()) > 256:  # very many languages: the blocks end early
                for other in [*(raw.keys() | held.keys())]:
                    yield whole(other)
    for lang in [*(raw.keys() | held.keys())]:
        yield whole(lang)
    # The worker goes on to other tasks: what it needs no more should not stay with it.
    lexicons.clear()
    pa.default_memory_pool().release_unused()


def _block(lang: str, words: list[bytes], hashes: np.ndarray, ids: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A block of word numbers, with the list of those that occur, how often each does, and their hashes. Of ends in a row one stays."""
    ids = ids[(ids > 0) | np.append(ids[1:] > 0, False)]
    counts = np.bincount(ids, minlength=1)
    counts[0] = 0
    there = np.flatnonzero(counts)
    if len(there):
        place = np.zeros(len(counts), "<i4")
        place[there] = np.arange(1, len(there) + 1)
        cells = b" ".join([words[k] for k in there.tolist()]), counts[there].astype("<i8").tobytes(), hashes[there].astype("<u8").tobytes(), place[ids].tobytes()
        yield pa.RecordBatch.from_arrays([pa.array([lang]), *(pa.array([cell], pa.binary()) for cell in cells)], schema=_BLOCKS)


def _encode(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for lang, lexicon, ids in _whole_blocks(parts):
        yield from _block(lang, lexicon.words, lexicon.hashed(), ids)


def _count_words(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for lang, words, counts in zip(part.column(0).to_pylist(), part.column(1), part.column(2)):
            spelled = np.array(words.as_py().split(b" "), object)
            yield from _spelled(lang, spelled, [np.arange(len(spelled))], np.frombuffer(counts.as_py(), "<i8"))


def _opened(part: pa.RecordBatch) -> Iterator[tuple[str, list[bytes], np.ndarray, np.ndarray]]:
    """Language, words from number 1 on, hashes from number 0 on, and the numbers of each block. Words may be left out."""
    lists = part.column("words") if "words" in part.schema.names else [None] * part.num_rows
    for lang, words, hashes, ids in zip(part.column("lang").to_pylist(), lists, part.column("hashes"), part.column("ids")):
        known = np.append(np.zeros(1, np.uint64), np.frombuffer(hashes.as_py(), "<u8"))
        yield lang, [b".", *words.as_py().split(b" ")] if words is not None else [], known, np.frombuffer(ids.as_py(), "<i4").astype(np.int64)


def _pair_hashes(ids: np.ndarray, hashes: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    good = has(frequent, hashes)
    good[0] = False
    starts = np.flatnonzero(good[ids[:-1]] & good[ids[1:]])
    return phrase_hash([hashes[ids[starts]], hashes[ids[starts + 1]]])


def _count_pair_hashes(words: Broadcast):
    """How often pairs of frequent words occur, known by their hashes alone."""

    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, held = np.frombuffer(words.value, np.uint8), []

        def told() -> pa.RecordBatch:
            found, counts = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(counts)], names=["hash", "n"])

        for part in parts:
            for _, _, hashes, ids in _opened(part):
                held.append(_pair_hashes(ids, hashes, frequent))
                if sum(map(len, held)) > HELD:
                    yield told()
        if held:
            yield told()

    return go


def _narrow(fields: dict[str, Broadcast]):
    """Blocks without the words that are in no frequent pair. They end a piece, as no phrase can hold one."""

    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {name: np.frombuffer(field.value, np.uint8) for name, field in fields.items()}
        for part in parts:
            for lang, words, hashes, ids in _opened(part):
                _, pair = _pairs(ids, hashes, known)
                kept = np.append(pair, False) | np.append(False, pair)
                yield from _block(lang, words, hashes, np.where(kept, ids, 0))

    return go


def _pairs(ids: np.ndarray, hashes: np.ndarray, known: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each pair of neighbours, and whether it may be frequent."""
    good = has(known["words"], hashes)
    good[0] = False
    good = good[ids]
    starts = np.flatnonzero(good[:-1] & good[1:])
    two = np.zeros(max(len(ids) - 1, 0), np.uint64)
    two[starts] = phrase_hash([hashes[ids[starts]], hashes[ids[starts + 1]]])
    pair = np.zeros(len(two), bool)
    pair[starts] = has(known["pairs"], two[starts])
    return two, pair


def _count_phrases(fields: dict[str, Broadcast]):
    """The pairs that may be frequent, or the phrases that grow from the prefixes due."""

    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {name: np.frombuffer(field.value, np.uint8) for name, field in fields.items()}
        for part in parts:
            for lang, words, hashes, ids in _opened(part):
                spelled = np.array(words, object)
                for length, starts in _due_places(ids, hashes, known):
                    columns, counts = _distinct(ids, starts, length, len(spelled))
                    yield from _spelled(lang, spelled, columns, counts)

    return go


def _due_places(ids: np.ndarray, hashes: np.ndarray, known: dict[str, np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
    """Lengths of phrases to be counted, and where those begin."""
    two, pair = _pairs(ids, hashes, known)
    if "two" not in known and "three" not in known:
        yield 2, np.flatnonzero(pair)
        return
    triple = pair[:-1] & pair[1:]
    if "two" in known:
        starts = np.flatnonzero(triple)
        yield 3, starts[has(known["two"], two[starts])]
    if "three" in known and len(ids) > 3:
        starts = np.flatnonzero(triple[:-1] & pair[2:])
        three = mix(two[starts] * _TURN + hashes[ids[starts + 2]])
        yield 4, starts[has(known["three"], three)]


def _summed(parts: DataFrame) -> DataFrame:
    return parts.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))


_COUNTED_COLUMNS = "lang string, phrase string, size tinyint, n long"


def _bits(bits: int):
    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            seeds: dict[str, int] = {}
            found = []
            for lang, phrase in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                seed = seeds.setdefault(lang, xxhash.xxh3_64_intdigest(lang.encode()))
                words = [np.array([xxhash.xxh3_64_intdigest(w, seed)], np.uint64) for w in phrase.encode().split(b" ")]
                found.append(phrase_hash(words))
            at = (np.concatenate(found) >> np.uint64(64 - bits)).astype(np.int64) if found else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["word", "mask"])

    return go


def _positions(bits: int):
    """Word and mask of given hashes."""

    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            at = (part.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at >> 6), pa.array((np.uint64(1) << (at & 63).astype(np.uint64)).view(np.int64))], names=["word", "mask"])

    return go


def bit_field(rows: DataFrame) -> Broadcast:
    """Written phrases ``(lang, phrase)``, or just their hashes ``(hash)``, as a bit field, broadcast. Its size is bounded by ``BITS``."""
    bits = min(BITS, max(16, (16 * rows.count()).bit_length()))
    marks = rows.select("hash").mapInArrow(_positions(bits), "word long, mask long") if "hash" in rows.columns else None
    marks = rows.select("lang", "phrase").mapInArrow(_bits(bits), "word long, mask long") if marks is None else marks
    found = marks.groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    field = np.zeros(1 << (bits - 6), np.int64)
    field[found["word"].to_numpy()] = found["mask"].to_numpy()
    return rows.sparkSession.sparkContext.broadcast(field.tobytes())


def _score(a: Column, other: Column) -> Column:
    """``floor(2000000 * a / other)``, in decimals, as products may pass 64 bits."""
    return F.call_function("div", a.cast("decimal(19,0)") * F.lit(2_000_000).cast("decimal(7,0)"), other.cast("decimal(20,0)"))


def _sum(x: Column, y: Column) -> Column:
    return x.cast("decimal(19,0)") + y.cast("decimal(19,0)")


def _share(part: Column, whole: Column) -> Column:
    """Whether ``part`` is at least the covering share of ``whole``."""
    return part.cast("decimal(19,0)") * 100 >= whole.cast("decimal(19,0)") * COVER


def _head(column: str) -> Column:
    return F.expr(f"substring({column}, 1, length({column}) - length(substring_index({column}, ' ', -1)) - 1)")


def _tail(column: str) -> Column:
    return F.expr(f"substring({column}, length(substring_index({column}, ' ', 1)) + 2)")


def _scored(found: DataFrame, known: DataFrame) -> DataFrame:
    """Adds heads, tails, score and bound to new phrases ``(lang, phrase, size, n)``, whose parts are among ``known``.

    ``heads[i]`` is the count of the first ``i + 1`` words, ``tails[i]`` that of the last ``i + 1``.
    """
    new = found.withColumns({"__head": _head("phrase"), "__tail": _tail("phrase")})
    heads = known.select(F.col("lang").alias("__lang"), F.col("phrase").alias("__head"), "heads")
    tails = known.select(F.col("lang").alias("__tail_lang"), F.col("phrase").alias("__last"), "tails")
    new = new.join(heads, (F.col("lang") == F.col("__lang")) & (new["__head"] == heads["__head"])).drop("__lang", "__head")
    new = new.join(tails, (F.col("lang") == F.col("__tail_lang")) & (F.col("__tail") == F.col("__last"))).drop("__tail_lang", "__last", "__tail")
    new = new.withColumns({"heads": F.concat("heads", F.array("n")), "tails": F.concat("tails", F.array("n"))})
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("size").cast("int") - 1),
        lambda k: F.struct(
            _score(F.col("n"), _sum(F.get("heads", k - 1), F.get("tails", F.col("size").cast("int") - k - 1))).alias("score"), k.alias("k"),
            F.get("heads", k - 1).alias("l"), F.get("tails", F.col("size").cast("int") - k - 1).alias("r"),
        ),
    )
    bound = _score(F.col("n"), _sum(F.get("heads", F.lit(0)), F.col("n")))
    worst = new.withColumns({"__worst": F.array_min(cuts), "bound": bound})
    return worst.select("lang", "phrase", "size", "n", "heads", "tails", "__worst.score", "__worst.l", "__worst.r", "bound")


def _floors(alive: DataFrame, limit: int, depth: int) -> DataFrame:
    """``lang, floor, deep``: the scores of the language's phrases number ``limit`` and ``depth``, -1 if it has fewer."""
    # A language has as many rows here as distinct scores, which are at most 1,000,000.
    counts = alive.groupBy("lang", "score").agg(F.count("*").alias("times"))
    so_far = counts.withColumn("so_far", F.sum("times").over(Window.partitionBy("lang").orderBy(F.desc("score"))))
    ranks = {"floor": limit, "deep": depth}
    return so_far.groupBy("lang").agg(*[F.coalesce(F.max(F.when(F.col("so_far") >= n, F.col("score"))), F.lit(-1)).alias(name) for name, n in ranks.items()])


def _due(pool: DataFrame, limit: int, depth: int) -> DataFrame:
    """Prefixes ``(lang, phrase, size, needed)`` to be expanded to settle the first ``depth`` phrases of each language.

    ``needed`` marks those that the first ``limit`` ones take.
    """
    seen = pool.join(F.broadcast(_floors(pool.filter("not covered"), limit, depth)), "lang", "left").fillna(-1, ["floor", "deep"])
    closed = seen.filter((F.col("size") < LONGEST) & ~F.col("opened"))
    own = closed.filter("bound >= deep").select("lang", "phrase", "size", F.expr("bound >= floor").alias("needed"))
    wanted = seen.filter((F.col("size") < LONGEST) & ~F.col("covered") & F.expr("score >= deep"))
    # A phrase longer to the left by one word begins with a pair, or a triple, that ends as the phrase begins and is frequent enough.
    joints = F.array(F.substring_index("phrase", " ", 1), F.when(F.col("size") == 3, F.substring_index("phrase", " ", 2)))
    begins = wanted.select("lang", "n", F.when(F.expr("score >= floor"), F.col("n")).alias("first"), F.explode(joints).alias("__joint")).filter("__joint is not null")
    begins = begins.groupBy("lang", "__joint").agg(F.min("n").alias("__least"), F.min("first").alias("__first"))
    ends = closed.withColumn("__joint", _tail("phrase")).join(begins, ["lang", "__joint"]).filter(_share(F.col("n"), F.col("__least")))
    ends = ends.select("lang", "phrase", "size", F.coalesce(_share(F.col("n"), F.col("__first")), F.lit(False)).alias("needed"))
    due = own.union(ends)
    # The second part of a phrase of four words is a triple of its own: its prefix has to be expanded too.
    seconds = due.filter(F.col("size") == 3).select("lang", _tail("phrase").alias("phrase"), F.lit(2).cast("tinyint").alias("size"), "needed")
    seconds = seconds.join(closed.select("lang", "phrase"), ["lang", "phrase"], "left_semi").select(*due.columns)
    return due.union(seconds).groupBy("lang", "phrase", "size").agg(F.max("needed").alias("needed"))


def collocations(docs: DataFrame, limit: int = LIMIT, least: int = LEAST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the first ``limit`` phrases of each language."""
    texts = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), docs["text"].cast("string").alias("text"))
    frequent = F.col("n") >= least
    blocks = cut_lineage(texts.mapInArrow(_encode, _BLOCK_COLUMNS), "zstd")
    words = cut_lineage(_summed(blocks.select("lang", "words", "counts").mapInArrow(_count_words, _COUNTED_COLUMNS)), "zstd")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    words = cut_lineage(words.filter(frequent).select("lang", "phrase", F.array("n").alias("heads"), F.array("n").alias("tails")))
    fields, encoded = {"words": bit_field(words)}, blocks.drop("counts")
    hashes = encoded.drop("words").mapInArrow(_count_pair_hashes(fields["words"]), "hash long, n long").groupBy("hash").agg(F.sum("n").alias("n"))
    fields["pairs"] = bit_field(cut_lineage(hashes.filter(frequent).select("hash")))
    encoded = cut_lineage(encoded.mapInArrow(_narrow(fields), _BLOCK_COLUMNS).drop("counts"), "zstd")
    pairs = cut_lineage(_summed(encoded.mapInArrow(_count_phrases(fields), _COUNTED_COLUMNS)).filter(frequent))
    flags = {"covered": F.lit(False), "opened": F.lit(False)}
    pool = cut_lineage(_scored(pairs, words).withColumns(flags))
    depth = 2 * limit
    while True:
        depth *= 2
        due = cut_lineage(_due(pool, limit, depth))
        if due.filter("needed").isEmpty():
            break
        now = dict(fields)
        for name, size in (("two", 2), ("three", 3)):
            some = due.filter(F.col("size") == size)
            if some.limit(1).count():
                now[name] = bit_field(some)
        found = _summed(encoded.mapInArrow(_count_phrases(now), _COUNTED_COLUMNS)).filter(frequent).withColumn("__head", _head("phrase"))
        mine = due.select(F.col("lang").alias("__lang"), F.col("phrase").alias("__due"))
        found = cut_lineage(found.join(mine, (F.col("lang") == F.col("__lang")) & (F.col("__head") == F.col("__due")), "left_semi").drop("__head"))
        for name in ("two", "three"):
            if name in now:
                now[name].destroy()
        new = found.filter(F.col("size") == 3)
        triples = _scored(new, pool.select("lang", "phrase", "heads", "tails"))
        both = pool.select("lang", "phrase", "heads", "tails").union(triples.select("lang", "phrase", "heads", "tails"))
        new = triples.union(_scored(found.filter(F.col("size") == 4), both)).withColumns(flags)
        around = found.select("lang", _head("phrase").alias("phrase"), "n").union(found.select("lang", _tail("phrase").alias("phrase"), "n"))
        around = around.groupBy("lang", "phrase").agg(F.max("n").alias("__around"))
        after = pool.union(new).join(around, ["lang", "phrase"], "left").join(due.select("lang", "phrase", F.lit(True).alias("__now")), ["lang", "phrase"], "left")
        covered = F.col("covered") | F.coalesce(_share(F.col("__around"), F.col("n")), F.lit(False))
        pool = cut_lineage(
            after.withColumns({"covered": covered, "opened": F.col("opened") | F.coalesce("__now", F.lit(False))}).select(*pool.columns)
        )
    alive = pool.filter("not covered")
    best = alive.join(F.broadcast(_floors(alive, limit, limit)), "lang").filter("score >= floor")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("n"), "phrase")
    ranked = best.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= limit)
    return ranked.join(F.broadcast(totals), "lang").select(
        "lang", "rank", "phrase", F.col("n").alias("a"), "l", "r", F.col("total").alias("n"), F.col("score").cast("long").alias("score")
    )


#: The same in SQL: all runs of words up to four are counted.
SQL = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
), split AS (
    SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
), runs AS (
    SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: w[i : i + k - 1])) AS words
    FROM split, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(w) >= k
), f AS (
    SELECT lang, k, words, count(*) AS a FROM runs GROUP BY ALL HAVING count(*) >= {LEAST}
), cuts AS (
    SELECT p.lang, p.k, p.words, p.a, l.a AS l, r.a AS r, (2000000::HUGEINT * p.a) // (l.a::HUGEINT + r.a) AS score,
        row_number() OVER (PARTITION BY p.lang, p.words ORDER BY (2000000::HUGEINT * p.a) // (l.a::HUGEINT + r.a), p.i) AS worst
    FROM (SELECT *, unnest(range(1, k)) AS i FROM f WHERE k > 1) p
    JOIN f l ON l.lang = p.lang AND l.words = p.words[: p.i] JOIN f r ON r.lang = p.lang AND r.words = p.words[p.i + 1 :]
), covered AS (
    SELECT DISTINCT p.lang, p.words FROM (SELECT *, unnest([0, 1]) AS s FROM f WHERE k > 2) q
    JOIN f p ON p.lang = q.lang AND p.words = q.words[1 + q.s : q.k - 1 + q.s]
    WHERE 100::HUGEINT * q.a >= {COVER}::HUGEINT * p.a
), totals AS (
    SELECT lang, sum(len(w)) AS n FROM split GROUP BY lang
), ranked AS (
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(words, ' '))) AS rank,
        array_to_string(words, ' ') AS phrase, a, l, r, score
    FROM cuts ANTI JOIN covered USING (lang, words) WHERE worst = 1
)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {LIMIT}
"""
