"""Quality scores learned from trusted positives and unlabelled text alone.

Positives are documents labelled 1; no document labelled 0 is learned from as such. The model is a small network over shape
features of the whole text. With p the class prior, it minimises the non-negative unbiased risk: p times the positives' loss
as positives, plus the unlabelled loss as negatives less p times the positives' loss as negatives, the latter difference not
below zero; where a step finds it below, it climbs out instead. The prior is estimated as the share of label 1 among the
labelled rows of the learning folds.

Learning uses bounded samples, those of least hash: ``POSITIVES`` and ``UNLABELLED`` documents, whose features the driver
fits in seconds. Scoring reads every document. Labels, language, source and id are no features. Rows of the held-out fold
(crc32 of the id as text, modulo 4, is 2) take no part in learning.

A null or empty text has all counts zero and gets the score of that. Rows with a null id are scored and not held out. Labels
that are null, of unknown documents or contradict another of the same document are not used. Without any usable positive,
each score is the prior, and 0.5 where there is no label at all.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordtide.llm import words as W
from recordtide.llm.quality_rules import STOP_WORDS, SYMBOLS
from recordtide.llm.tables import cut_lineage, keyed_texts

POSITIVES = 8_000
UNLABELLED = 16_000
THRESHOLD = 0.7

_STOP = frozenset(form.encode() for word in STOP_WORDS for form in (word, word.capitalize()))
_SYMBOLS, _DIGITS, _MARKS, _CAPITALS = SYMBOLS.encode(), b"0123456789", b".,;:!?", bytes(range(65, 91))
_WIDTH = 14


def features(text: bytes | None, known: W.WordHashes) -> list[float]:
    """Shape of a text: lengths, shares of kinds of characters and words, and what repeats."""
    text = text or b""
    words = W.spaced_words(text)
    n, size = max(1, len(words)), max(1, len(text))
    share = lambda kind: (len(text) - len(text.translate(None, kind))) / size
    triples = W.rolling(known.of(words), 3)
    lines = [line for line in text.split(b"\n") if line.strip()]
    return [
        np.log1p(len(words)), np.log1p(len(lines)), np.log1p(n / max(1, len(lines))), sum(map(len, words)) / n,
        share(_SYMBOLS), share(_DIGITS), share(_MARKS), share(_CAPITALS), sum(map(_STOP.__contains__, words)) / n,
        len(set(words)) / n, 1 - len(np.unique(triples)) / max(1, len(triples)), 1 - len(set(lines)) / max(1, len(lines)),
        sum(len(w) == 1 for w in words) / n, max(map(len, words), default=0) / 20,
    ]


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: tuple[np.ndarray, ...]
    prior: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        if not self.weights:
            return np.full(len(x), self.prior)
        return 1 / (1 + np.exp(-np.clip(_forward(self.weights, self.normal(x))[1], -30, 30)))

    def normal(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)


def _forward(weights: tuple[np.ndarray, ...], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    a, b, c, d = weights
    hidden = np.tanh(x @ a + b)
    return hidden, hidden @ c + d


def fit(positive: np.ndarray, unlabelled: np.ndarray, prior: float, *, hidden: int = 24, steps: int = 600, rate: float = 0.02) -> Model:
    """Minimise the non-negative risk by full-batch gradient steps (Adam), from a fixed start."""
    if not len(positive) or not len(unlabelled):
        return Model(np.zeros(_WIDTH), np.ones(_WIDTH), (), prior)
    mean, scale = unlabelled.mean(axis=0), unlabelled.std(axis=0) + 1e-6
    empty = Model(mean, scale, (), prior)
    p, u = empty.normal(positive), empty.normal(unlabelled)
    x = np.concatenate((p, u))
    random = np.random.default_rng(0)
    weights = [random.normal(0, 0.3, (x.shape[1], hidden)), np.zeros(hidden), random.normal(0, 0.3, hidden), np.zeros(())]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    for step in range(1, steps + 1):
        h, out = _forward(tuple(weights), x)
        chance = 1 / (1 + np.exp(-np.clip(out, -30, 30)))
        negative_loss = np.logaddexp(0, out)  # loss as a negative; as a positive it is this less the output
        rest = negative_loss[len(p) :].mean() - prior * negative_loss[: len(p)].mean()
        # Slopes of the logistic loss: chance as a negative, chance - 1 as a positive.
        as_negative = np.concatenate((-prior * chance[: len(p)] / len(p), chance[len(p) :] / len(u)))
        as_positive = np.concatenate((prior * (chance[: len(p)] - 1) / len(p), np.zeros(len(u))))
        slope = as_positive + as_negative if rest >= 0 else -as_negative
        back = np.outer(slope, weights[2]) * (1 - h * h)
        slopes = [x.T @ back, back.sum(axis=0), h.T @ slope, slope.sum()]
        for k, g in enumerate(slopes):
            g = g + 1e-5 * weights[k]
            first[k] = 0.9 * first[k] + 0.1 * g
            second[k] = 0.999 * second[k] + 0.001 * g * g
            weights[k] = weights[k] - rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.999**step)) + 1e-8)
    return Model(mean, scale, tuple(weights), prior)


_FEATURES = pa.schema([("doc_id", pa.int64()), ("x", pa.list_(pa.float64()))])


def _features(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = W.word_hashes()
    for part in parts:
        rows = ((doc_id, features(text, known)) for doc_id, text in zip(part.column(0).to_pylist(), W.texts(part.column(1))))
        yield from W.batches(rows, _FEATURES)


_SCORES = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])


def _score(model: Model):
    def go(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = W.word_hashes()
        for part in parts:
            ids, texts = part.column(0), list(W.texts(part.column(1)))
            if texts:
                x = np.array([features(text, known) for text in texts])
                yield pa.RecordBatch.from_arrays([ids, pa.array(model.scores(x))], schema=_SCORES)

    return go


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, positives: int = POSITIVES, unlabelled: int = UNLABELLED) -> Model:
    keyed = keyed_texts(docs)
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    marked = marked.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id")))
    marked = marked.groupBy("doc_id").agg(F.min("quality").alias("quality"), F.max("quality").alias("most")).filter("quality = most")
    prior = marked.agg(F.avg("quality").alias("prior")).first()["prior"]
    by_hash = F.xxhash64("doc_id")
    first = marked.filter("quality = 1").orderBy(by_hash, "doc_id").limit(positives).select("doc_id", F.lit(True).alias("trusted"))
    other = keyed.filter(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).select("doc_id").distinct()
    other = other.orderBy(by_hash, "doc_id").limit(unlabelled).select("doc_id", F.lit(False).alias("trusted"))
    chosen = cut_lineage(first.union(other))  # bounded by the two sample sizes
    wanted = keyed.join(F.broadcast(chosen.select("doc_id").distinct()), "doc_id", "left_semi").dropDuplicates(["doc_id"])
    rows = wanted.mapInArrow(_features, "doc_id long, x array<double>").join(F.broadcast(chosen), "doc_id").orderBy("doc_id", "trusted")
    rows = rows.select("trusted", "x").collect()
    x = lambda trusted: np.array([r["x"] for r in rows if r["trusted"] == trusted]).reshape(-1, _WIDTH)
    return fit(x(True), x(False), 0.5 if prior is None else float(prior))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row."""
    scored = keyed_texts(docs).mapInArrow(_score(model), "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
