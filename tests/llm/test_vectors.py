"""Exact top-k and the Hamming index against brute force, with ties and invalid vectors."""

import math

import numpy as np
import pytest

from strata.llm import exact_topk as X
from strata.llm import hamming_index as H
from strata.llm import vectors as V

from .helpers import SF, frame


def _valid(vec, allow_zero):
    return (vec and all(x is not None and math.isfinite(x) for x in vec)
            and (allow_zero or any(vec)))


def brute(rows, every, score, k, largest, allow_zero):
    """(query_id, rank) -> (vec_id, score), by sorting all candidates."""
    rows = [(i, v) for i, v in rows if i is not None and _valid(v, allow_zero)]
    queries = {}
    for i, v in rows:
        if i % every == 0:
            queries[i] = min(v, queries.get(i, v))
    out = {}
    for q, vec in queries.items():
        hits = [(score(vec, v), i) for i, v in rows if i != q and len(v) == len(vec)]
        hits.sort(key=lambda h: (-h[0] if largest else h[0], h[1]))
        out.update({(q, r): (i, s) for r, (s, i) in enumerate(hits[:k], 1)})
    return out


def inner(a, b):
    return sum(math.floor(1024 * x) * math.floor(1024 * y) for x, y in zip(a, b, strict=True))


def euclid(a, b):
    return float(np.sqrt(((np.array(b, float) - np.array(a, float)) ** 2).sum()))


def _got(df):
    rows = df.collect()
    out = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in rows}
    assert len(out) == len(rows)
    return out


ODD = [(0, [1.0, 0.5]), (0, [1.0, 0.5]), (1, [0.0, 0.0]), (2, None), (3, [None, 1.0]),
       (4, [float("nan"), 1.0]), (5, [float("inf"), 1.0]), (6, []), (7, [1.0, 0.5]),
       (8, [1.0, 0.5]), (9, [1.0, 0.5]), (10, [-1.0, 2.0]), (11, [3.0, 1.0, 2.0]),
       (20, [3.0, 1.0, 2.5]), (None, [1.0, 1.0]), (30, [0.0, 0.0]), (31, [-0.2, 0.1])]


def test_exact_on_the_whole_table(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = _got(X.exact_topk(df, "vec_id", "embedding", X.every(100)))
    assert got == brute(rows, 100, inner, 10, True, True)


@pytest.mark.parametrize("k", [1, 2, 50])
def test_exact_odd_rows(spark, monkeypatch, k):
    monkeypatch.setattr(V, "QUERY_BYTES", 64)
    df = frame(spark, ODD, "vec_id long, embedding array<double>")
    got = _got(X.exact_topk(df, "vec_id", "embedding", X.every(10), k=k))
    assert got == brute(ODD, 10, inner, k, True, True)
    assert X.exact_topk(df.where("vec_id < 0"), "vec_id", "embedding", X.every(10)).count() == 0


def test_products_are_exact_at_every_size():
    for scale in (1.0, 1e8, 1e12):
        a = np.floor(np.array([[1.5, -2.25, 3.0], [0.5, 9.0, -7.0]]) * scale)
        want = [[sum(int(x) * int(y) for x, y in zip(r, s, strict=True)) for s in a] for r in a]
        limit = np.iinfo(np.int64).max
        assert X.products(a, a).tolist() == [[max(min(x, limit), -limit + 1) for x in r]
                                             for r in want]


def test_partial_selection_breaks_ties_to_the_left():
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 4, (30, 40))
    row, col = V.smallest_per_row(keys, 5)
    for r in range(30):
        want = sorted(np.argsort(keys[r], kind="stable")[:5].tolist())
        assert sorted(col[row == r].tolist()) == want


def test_index_recall_and_scores(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    want = brute(rows, 100, euclid, 10, False, False)
    got = _got(H.nearest(df, "vec_id", "embedding", X.every(100)))
    assert got.keys() == want.keys()
    vec = dict(rows)
    assert all(s == pytest.approx(euclid(vec[q], vec[i]), rel=1e-12)
               for (q, _), (i, s) in got.items())
    found = {(q, i) for (q, _), (i, _) in got.items()}
    true = {(q, i) for (q, _), (i, _) in want.items()}
    assert len(found & true) >= 0.9 * len(true)


def test_index_odd_rows(spark):
    df = frame(spark, ODD, "vec_id long, embedding array<double>")
    got = _got(H.nearest(df, "vec_id", "embedding", X.every(10)))
    assert got == brute(ODD, 10, euclid, 10, False, False)
    assert H.nearest(df.where("vec_id < 0"), "vec_id", "embedding", X.every(10)).count() == 0


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 1 << 16, (500, 3)).astype("<u2")
    codes[100:200] = codes[0] ^ (1 << rng.integers(0, 16, (100, 3))).astype("<u2")
    index = H.ShardIndex(codes)
    for radius in (0, 1, 3, 7, 20, 48):
        bits = np.bitwise_count(codes ^ codes[0]).sum(axis=1)
        assert index.within(codes[0], radius).tolist() == np.flatnonzero(bits <= radius).tolist()
