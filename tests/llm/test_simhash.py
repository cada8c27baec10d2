"""SimHash fingerprints, linking and components against brute force."""

import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from strata.llm import simhash as S
from strata.llm.components import connected_components

from .helpers import SF, frame, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {k: k + 32 for k in range(65, 91)}


def slow_fingerprint(text, shingle=4):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return 0
    parts = [" ".join(words[k:k + shingle]) for k in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(rows, max_bits=4):
    """Smallest id reachable, per id."""
    ids, fps = [r[0] for r in rows], np.array([r[1] for r in rows], np.uint64)
    label = list(range(len(ids)))
    while True:
        low = [min(label[j] for j in np.flatnonzero(np.bitwise_count(fps ^ f) <= max_bits))
               for f in fps]
        if low == label:
            break
        label = low
    least = {}
    for k, i in zip(label, ids, strict=True):
        least[k] = min(i, least.get(k, i))
    return {i: least[k] for k, i in zip(label, ids, strict=True)}


def test_fingerprints():
    for text in ["", " \t\n", "one", "One two THREE", "a b c d", "a b c d e f g", "É é É é x",
                 "x " * 500, "a\x0bb\x1cc d e f", None]:
        assert S.fingerprint(text, 4) == slow_fingerprint(text), text


def test_spark_hash_is_the_same(spark):
    got = spark.range(1).select(F.xxhash64(F.lit("a b c d"))).first()[0]
    assert got % 2 ** 64 == xxhash.xxh64_intdigest(b"a b c d", 42)


def test_whole_table_against_brute_force(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    want = {r.doc_id: slow_fingerprint(r.text) for r in df.collect()}
    root = slow_components(list(want.items()))
    got = S.near_duplicates(df, "doc_id", "text", 4, 4).collect()
    assert {r.doc_id: r.fp % 2 ** 64 for r in got} == want
    assert {r.doc_id: r.component_id for r in got} == root


def _group(rng, n, most):
    base, out = rng.getrandbits(64), []
    for _ in range(n):
        f = base
        for b in rng.sample(range(64), rng.randint(0, most)):
            f ^= 1 << b
        out.append(f)
    return out


def _linked(spark, fps):
    rows = sorted(set(fps))
    df = spark.createDataFrame([(S._signed(f), k) for k, f in enumerate(rows)], "fp long, node long")
    got = {r.node: r.root for r in connected_components(S.linked_classes(df, 4)).collect()}
    want = slow_components(list(enumerate(rows)))
    assert {k: got.get(k, k) for k in want} == want


def test_groups_of_near_copies(spark):
    rng = random.Random(3)
    _linked(spark, [f for _ in range(6) for f in _group(rng, 60, 7)]
            + [rng.getrandbits(64) for _ in range(300)])


def test_large_buckets_are_tiled(spark, monkeypatch):
    monkeypatch.setattr(S, "TILE", 40)
    rng = random.Random(4)
    _linked(spark, _group(rng, 500, 9) + [0, 1, 3, (1 << 64) - 1])


def test_blocks_follow_the_number_of_classes():
    sizes = [len(S.block_masks(10 ** k, 4)) for k in range(1, 11)]
    assert sizes == sorted(sizes) and sizes[0] == 5
    for masks in (S.block_masks(10, 4), S.block_masks(10 ** 7, 4)):
        rng = random.Random(1)
        for _ in range(200):
            changed = sum(1 << b for b in rng.sample(range(64), 4))
            assert any(not mask & changed for mask in masks)


def test_components_of_random_graphs(spark):
    rng = random.Random(8)
    edges = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(260)]
    edges += [(1000 + k, 1001 + k) for k in range(70)] + [(5, 5), (None, 3), (2000, 2001)] * 2
    got = {r.node: r.root for r in
           connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    assert got == {k: find(k) for k in parent}
    none = spark.createDataFrame([], "a long, b long")
    assert connected_components(none).count() == 0


def test_odd_rows(spark):
    rng = random.Random(2)
    text = prose(rng, 400)
    rows = [(1, text), (2, text + " end"), (2, text + " end"), (3, None), (4, ""), (5, " \n"),
            (6, "one"), (None, text), (None, "alone here"), (7, prose(rng, 60_000))]
    df = frame(spark, rows, "doc_id long, text string")
    got = S.near_duplicates(df, "doc_id", "text", 4, 4).collect()
    assert len(got) == len(rows)
    assert {r.component_id for r in got if r.doc_id in (3, 4, 5)} == {3}
    same = {slow_fingerprint(text), slow_fingerprint(text + " end")}
    apart = bin(min(same) ^ max(same)).count("1") > 4
    assert {r.component_id for r in got if r.doc_id in (1, 2)} == ({1, 2} if apart else {1})
    assert sorted(str(r.component_id) for r in got if r.doc_id is None) == ["1", "None"]
    kept = S.keep_one_each(df, "doc_id", "text", 4, 4)
    assert kept.columns == df.columns
    want = [1, 3, 6, 7] + ([2] if apart else [])
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(want)
    assert kept.where("doc_id is null").count() == 2
    assert S.near_duplicates(df.where("doc_id < 0"), "doc_id", "text", 4, 4).count() == 0


def test_an_id_on_rows_of_several_components(spark):
    """Ids 100+ stand on a copy of a smaller document and on a text of their own."""
    rng = random.Random(8)
    rows = []
    for k in range(12):
        text = prose(rng, 80)
        rows += [(k, text), (100 + k, text), (100 + k, f"own{k} " + prose(rng, 80))]
    df = frame(spark, rows + [(None, "no id")], "doc_id long, text string")
    want = sorted([*rows[::3], *rows[2::3]])
    for given in (df, df.orderBy(F.desc("text")), df.orderBy("text")):
        kept = S.keep_one_each(given.union(given), "doc_id", "text", 4, 4)
        got = kept.where("doc_id is not null").select("doc_id", "text").collect()
        assert sorted(map(tuple, got)) == want
