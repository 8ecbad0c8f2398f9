"""Whitening against numpy's own decomposition and Python's integers."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordtide.llm import whitening as W
from recordtide.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>, n string, whitened string, vector string, length string"


def brute(rows, k=8):
    """``{(id, component): ...}`` by the contract's words, for rows with distinct ids."""
    rows = [(i, v) for i, v in rows if v and all(x is not None and math.isfinite(x) for x in v)]
    x = [[math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for _, v in rows]
    n, sums = len(x), [sum(c) for c in zip(*x)]
    centred = np.array([[c - s / n for c, s in zip(row, sums)] for row in x])
    covariance = centred.T @ centred / n
    values, axes = np.linalg.eigh(covariance)
    order = np.argsort(-values)[:k]
    out = {}
    for (i, _), row, z in zip(rows, x, centred):
        away = sum((n * c - s) ** 2 for c, s in zip(row, sums))
        for place, at in enumerate(order, 1):
            out[i, place] = (n, away, float(z @ axes[:, at]) / math.sqrt(values[at]), values[at] / np.trace(covariance))
    return out


def same(rows, wanted):
    assert {(r["vec_id"], r["component"]) for r in rows} == set(wanted) and len(rows) == len(wanted)
    signs = {}
    for r in sorted(rows, key=lambda r: -abs(r["whitened"])):
        n, away, projected, explained = wanted[r["vec_id"], r["component"]]
        sign = signs.setdefault(r["component"], np.sign(projected * r["whitened"]))
        assert (r["n"], int(r["deviation"])) == (n, away)
        assert abs(r["whitened"] * sign - projected) < 1e-7 and abs(r["explained"] - explained) < 1e-9


def test_query_against_brute_force(spark):
    rows = QUERIES["op11_embedding_whitening"](spark, SF).collect()
    vectors = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    same(rows, brute([(r["vec_id"], r["embedding"]) for r in vectors]))
    errors = {r["identity_error"] for r in rows}
    assert len(errors) == 1 and errors.pop() < 1e-9


def odd(spark, rows):
    return spark.createDataFrame([(i, v, "a", "b", "c", "d") for i, v in rows], SCHEMA).repartition(4)


def test_nulls_ties_and_other_lengths(spark):
    random = np.random.default_rng(3)
    base = [(i, random.normal(size=5).tolist()) for i in range(40)]
    strange = [(100, None), (101, []), (102, [1.0, None, 1.0, 1.0, 1.0]), (103, [float("nan")] * 5), (104, [float("inf")] * 5), (105, [1.0, 2.0]), (106, [3e38] * 5)]
    frame = odd(spark, base + strange)
    model = W.fit(frame)
    assert model.n == 40 and model.dimension == 5
    same(W.whiten(frame, model).collect(), brute(base))
    # Repeated rows count each for itself, null ids pass through.
    twice = odd(spark, base + base + [(None, base[0][1])])
    assert W.fit(twice).n == 81
    assert W.whiten(twice, W.fit(twice)).filter("vec_id is null").count() == 5


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    frame = odd(spark, rows)
    model = W.fit(frame)
    found = W.whiten(frame, model)
    assert found.count() == 0 and found.columns == "vec_id component n deviation whitened explained".split()
    assert model is None or W.identity_error(frame, model) == 0.0


def test_fewer_components_than_asked_for(spark):
    """A dimension that repeats another adds no rank."""
    random = np.random.default_rng(5)
    rows = [(i, [a, a, b]) for i, (a, b) in enumerate(random.normal(size=(50, 2)).tolist())]
    model = W.fit(odd(spark, rows))
    assert len(model.eigenvalues) == 2 and W.identity_error(odd(spark, rows), model) < 1e-9


def test_great_entries_stay_exact(spark):
    rows = [(1, [1e15, -1e12]), (2, [-2e15, 0.5]), (3, [4e15, 7.0])]
    got = {r["vec_id"]: int(r["deviation"]) for r in W.whiten(odd(spark, rows), W.fit(odd(spark, rows))).filter("component = 1").collect()}
    x = {i: [math.floor(1024 * float(np.float32(c))) + 100_000 for c in v] for i, v in rows}
    sums = [sum(c) for c in zip(*x.values())]
    assert got == {i: sum((3 * c - s) ** 2 for c, s in zip(v, sums)) for i, v in x.items()}


def test_bands_of_a_large_matrix(spark, monkeypatch):
    monkeypatch.setattr(W, "BAND", 7)
    rows = [(i, v) for i, v in enumerate(np.random.default_rng(7).normal(size=(60, 9)).tolist())]
    same(W.whiten(odd(spark, rows), W.fit(odd(spark, rows))).collect(), brute(rows))


@pytest.mark.parametrize("d, rank", [(1, 1), (2, 2), (7, 7), (40, 40), (33, 12)])
def test_factor_and_rotations(d, rank):
    random = np.random.default_rng(d)
    half = random.normal(size=(d, rank)) * np.logspace(0, -3, rank)
    matrix = half @ half.T
    factor = W.cholesky_factor(matrix)
    assert factor.shape == (d, rank) and np.allclose(factor @ factor.T, matrix, atol=1e-12)
    values, axes = W.jacobi(factor)
    assert np.allclose(values, np.sort(np.linalg.svd(half, compute_uv=False) ** 2)[::-1], rtol=1e-8)
    assert np.allclose(axes.T @ axes, np.eye(rank), atol=1e-12) and np.allclose(matrix @ axes, axes * values, atol=1e-10)


def test_a_vector_length_of_their_own_is_dropped_only_if_rarer(spark):
    rows = [(1, [1.0]), (2, [2.0, 3.0]), (3, [1.0, 5.0]), (4, [9.0])]
    assert W.fit(odd(spark, rows)).dimension == 2  # of equally common lengths the greater
    assert W.fit(odd(spark, rows).filter(F.col("vec_id") != 3)).dimension == 1
