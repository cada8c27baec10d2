"""Whitening against numpy's own decomposition and exact arithmetic."""

import math

import numpy as np
import pytest

from strata.llm import eigen
from strata.llm import whitening as W
from strata.llm.queries import op12_embedding_whitening

from .helpers import SF, frame


def _matrices():
    rng = np.random.default_rng(2)
    q, _ = np.linalg.qr(rng.standard_normal((40, 40)))
    wilkinson = (np.diag(np.abs(np.arange(21) - 10.0)) + np.diag(np.ones(20), 1)
                 + np.diag(np.ones(20), -1))
    x = rng.standard_normal((200, 50))
    return {"one": np.array([[3.0]]), "two": np.array([[2.0, 1.0], [1.0, 2.0]]),
            "random": x.T @ x / 200, "identity": np.eye(30), "zero": np.zeros((5, 5)),
            "clusters": q @ np.diag([5.0] * 10 + [1.0] * 20 + [0.0] * 10) @ q.T,
            "near pairs": wilkinson, "small": 1e-12 * wilkinson, "rank one": np.ones((30, 30))}


@pytest.mark.parametrize("name", _matrices())
def test_leading_pairs(name):
    m = _matrices()[name]
    values, vectors = eigen.leading_pairs(m, 32)
    want = np.linalg.eigvalsh(m)[::-1][:32]
    size = max(np.abs(want).max(), 1e-290)
    assert np.abs(values - want).max() <= 1e-13 * size
    assert np.abs(m @ vectors - vectors * values).max() <= 1e-13 * size
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() <= 1e-13


def test_counts_below():
    rng = np.random.default_rng(4)
    x = rng.standard_normal((30, 30))
    diag, off, _ = eigen.tridiagonal(x + x.T)
    values = np.linalg.eigvalsh(x + x.T)
    shifts = np.linspace(-20, 20, 50)
    assert eigen.counts_below(diag, off, shifts).tolist() == [
        int((values < s).sum()) for s in shifts]


def _check(rows, got, k):
    """``got``: (position in rows, component) -> output row."""
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for v in rows], dtype=object)
    n, sums = len(x), x.sum(axis=0)
    d = n * x - sums
    y = (d / n).astype(float)
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    want = y @ vectors[:, :k] / np.sqrt(values[:k])
    for c in range(k):
        w = np.array([got[i, c + 1].whitened for i in range(n)])
        assert np.abs(w * np.sign(w @ want[:, c]) - want[:, c]).max() < 1e-6
        assert abs(got[0, c + 1].explained - values[c] / values.sum()) < 1e-10
    for (i, _), r in got.items():
        assert r.n == n and r.deviation == int((d[i] ** 2).sum())
        assert r.identity_error < 1e-9


def test_rows_that_take_part(spark):
    rng = np.random.default_rng(1)
    good = [(int(i), rng.normal(size=5).tolist()) for i in range(60)]
    good += [(7, good[3][1]), (7, good[3][1])]  # repeats of an id and a vector
    bad = [(100, None), (101, [1.0, None, 0.0, 0.0, 0.0]), (102, [math.nan] * 5),
           (103, [math.inf] + [0.0] * 4)]
    df = frame(spark, good + bad + [(104, [])], "vec_id long, embedding array<double>")
    fit = W.Whitening(df, "vec_id", "embedding", 32)
    rows = fit.long_rows().collect()
    assert {r.id for r in rows} == {i for i, _ in good} and len(rows) == 62 * 5
    by_vector = {}
    for r in rows:
        by_vector.setdefault((r.id, r.component), []).append(r)
    assert len(by_vector[7, 1]) == 3
    order = [by_vector[i, c].pop() if i != 7 else None for i, _ in good for c in range(1, 6)]
    assert sum(o is not None for o in order) == 59 * 5


def test_against_numpy(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(400, 12)) * np.linspace(3, 0.2, 12)
    rows = (base @ rng.normal(size=(12, 12))).tolist()
    df = spark.createDataFrame(list(enumerate(rows)), "vec_id long, embedding array<double>")
    fit = W.Whitening(df.repartition(5), "vec_id", "embedding", 8)
    _check(rows, {(r.id, r.component): r for r in fit.long_rows().collect()}, 8)


def test_lengths_are_fitted_apart(spark):
    rng = np.random.default_rng(6)
    short, long = rng.normal(size=(40, 3)).tolist(), rng.normal(size=(50, 4)).tolist()
    df = spark.createDataFrame([(i, v) for i, v in enumerate(short)]
                               + [(1000 + i, v) for i, v in enumerate(long)],
                               "vec_id long, embedding array<double>")
    rows = W.Whitening(df, "vec_id", "embedding", 32).long_rows().collect()
    _check(short, {(r.id, r.component): r for r in rows if r.id < 1000}, 3)
    _check(long, {(r.id - 1000, r.component): r for r in rows if r.id >= 1000}, 4)


def test_no_variance_no_component(spark):
    schema = "vec_id long, embedding array<float>"
    for rows, kept in (([], 0), ([(1, [1.0, 2.0])], 0), ([(1, [1.0, 2.0])] * 4, 0),
                       ([(k, [float(k), 2.0 * k, 5.0]) for k in range(9)], 1)):
        got = W.Whitening(spark.createDataFrame(rows, schema), "vec_id", "embedding").long_rows()
        assert got.count() == kept * len(rows)


def test_exact_deviations():
    """Exact up to 64 bits, null beyond, whichever arithmetic is used."""
    rng = np.random.default_rng(8)
    for spread in (10, 10 ** 6, 3 * 10 ** 7, 10 ** 9):
        x = rng.integers(-spread, spread, size=(50, 3))
        sums = [int(s) for s in x.sum(axis=0)]
        want = [sum((50 * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x]
        assert W.Centre(50, sums).deviations(x) == [
            w if w < 2 ** 63 else None for w in want]


def test_query(spark):
    got = op12_embedding_whitening(spark, SF).collect()
    vecs = {r.vec_id: r.embedding for r in
            spark.read.parquet(f"{SF}/embeddings.parquet").collect()}
    ids = sorted(vecs)
    at = {i: k for k, i in enumerate(ids)}
    _check([vecs[i] for i in ids], {(at[r.vec_id], r.component): r for r in got}, 32)
