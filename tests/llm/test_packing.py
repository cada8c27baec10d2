"""Packing: validity and sequence count of plans, and whole rows against the library."""

import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from strata.llm import packing as P

from .helpers import ODD_TEXTS, SF, frame


def _check_plan(counts, capacity, runs, sequences):
    used, fill = defaultdict(int), defaultdict(list)
    for r in runs:
        assert r.first == used[r.length]
        used[r.length] += r.n
        for k in range(r.n):
            fill[r.seq + k].append((r.offset, r.length))
    assert dict(used) == {k: n for k, n in counts.items() if n}
    assert set(fill) == set(range(sequences))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 40), max_size=30),
       st.integers(1, 20), st.integers(0, 40))
def test_plans_are_valid(counts, groups, small):
    runs, sequences = P.plan_packing(counts, 64, small, groups)
    _check_plan(counts, 64, runs, sequences)


def test_near_the_lower_bound():
    rng = np.random.default_rng(1)
    lengths = np.clip(rng.lognormal(6.3, 0.9, 20_000).astype(int), 1, 2048)
    counts = {int(k): int(n) for k, n in zip(*np.unique(lengths, return_counts=True), strict=True)}
    runs, sequences = P.best_plan(counts, 2048, P.GROUPS, P.SMALL_SHARES)
    _check_plan(counts, 2048, runs, sequences)
    assert sequences <= 1.003 * -(-lengths.sum() // 2048)


def test_groups_have_equal_cardinality():
    groups = P.linear_groups({10: 5, 7: 4, 3: 3}, 4)
    assert [(size, sum(n for _, n in m)) for size, m in groups] == [(10, 3), (10, 3), (7, 3), (3, 3)]


def test_plan_size_does_not_follow_the_rows():
    few, _ = P.plan_packing({k: 10 for k in range(1, 2049)}, 2048, 512, 256)
    many, _ = P.plan_packing({k: 10_000_000 for k in range(1, 2049)}, 2048, 512, 256)
    assert len(many) < 2 * len(few) + 2048


def _check_rows(rows, texts, capacity=2048):
    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tok.encode_special_tokens = True
    by_doc = defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
    for doc_id, text in texts.items():
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4").tobytes()
        at = 0
        for k, r in enumerate(sorted(by_doc[doc_id], key=lambda r: r.piece)):
            assert (r.piece, r.start) == (k, at)
            assert r.ids_crc32 == zlib.crc32(ids[4 * at:4 * (at + r.length)])
            assert r.length == capacity or k == 0
            at += r.length
        assert 4 * at == len(ids)
    fill = defaultdict(list)
    for r in rows:
        fill[r.sequence_id].append((r.offset, r.length))
    for parts in fill.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    _check_rows(P.pack_documents(df, "doc_id", "text").collect(),
                {r.doc_id: r.text for r in df.collect()})


def test_odd_rows(spark):
    texts = dict(enumerate([*ODD_TEXTS, None, "long " * 9000, "word " * 2048]))
    df = frame(spark, list(texts.items()), "doc_id long, text string")
    _check_rows(P.pack_documents(df, "doc_id", "text").collect(), texts)
    twice = df.where("doc_id < 3").union(df.where("doc_id < 3"))
    got = P.pack_documents(twice, "doc_id", "text").collect()
    assert len(got) == 6 and len({(r.sequence_id, r.offset) for r in got}) == 6
    unnamed = frame(spark, [(None, "no id")], "doc_id long, text string")
    assert [r.doc_id for r in P.pack_documents(unnamed, "doc_id", "text").collect()] == [None]
    assert P.pack_documents(df.where("doc_id < 0"), "doc_id", "text").count() == 0
