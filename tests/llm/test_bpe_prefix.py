"""Prefix dynamic programming against tiktoken; appends and edits against fresh encodings."""

import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from strata.llm import bpe_prefix as B

from .helpers import ODD_TEXTS, SF, frame

NAME = "byte_bpe_multi_50k.tiktoken"


@pytest.fixture(scope="module")
def bpe():
    return B.prefix_encoder(NAME)


@pytest.fixture(scope="module")
def library(bpe):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN,
                             mergeable_ranks=bpe[0].ranks, special_tokens={})


def test_every_token_is_reached(bpe):
    assert len(bpe[0].right_edge) == len(bpe[0].ranks)


def test_whole_table_against_tiktoken(spark, library, bpe):
    df = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in df.collect()}
    for row in B.encode_documents(df, "doc_id", "text", NAME).collect():
        assert np.frombuffer(row.ids, "<u4").tolist() == library.encode_ordinary(texts[row.doc_id])
        assert bytes(row.decoded) == texts[row.doc_id].encode()


def test_odd_rows(spark, library):
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(0, ""), (None, "no id"), (99, None)]
    got = B.encode_documents(frame(spark, rows, "doc_id long, text string"), "doc_id", "text",
                             NAME).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in got}
    assert by_id[99] == [] and by_id[None] == library.encode_ordinary("no id")
    for k, text in enumerate(ODD_TEXTS):
        assert by_id[k] == library.encode_ordinary(text)
    assert B.encode_documents(frame(spark, [], "doc_id long, text string"), "doc_id", "text",
                              NAME).count() == 0


def test_random_bytes_appends_and_edits(bpe, library):
    rng = random.Random(5)
    letters = b"aabst ething\xc3\xa9\xe2\x80"
    for _ in range(150):
        data = bytes(rng.choice(letters) for _ in range(rng.randint(1, 250)))
        grown = B.PrefixEncoding(bpe[0])
        for byte in data:
            grown.append(bytes([byte]))
        if data not in bpe[0].ranks:
            assert grown.tokens() == library._core_bpe.encode_single_piece(data)
        cut = rng.randint(0, len(data))
        assert grown.tokens(cut) == B.PrefixEncoding(bpe[0], data[:cut]).tokens()
        start = rng.randint(0, len(data))
        stop = rng.randint(start, len(data))
        new = bytes(rng.choice(letters) for _ in range(rng.randint(0, 9)))
        grown.replace(start, stop, new)
        fresh = B.PrefixEncoding(bpe[0], data[:start] + new + data[stop:])
        assert (grown.data, grown.last) == (fresh.data, fresh.last)


def test_an_edit_in_a_long_text_redoes_little(bpe):
    long = B.PrefixEncoding(bpe[0], b"the quick brown fox and so on " * 300)
    assert long.replace(20, 23, b"xyz") < 200
