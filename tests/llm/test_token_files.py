"""Token files: format, round trip, random access, checksums, odd rows."""

import zlib

import numpy as np
import public_tokenizers
import pytest
import zstandard
from tokenizers import Tokenizer

from strata.llm import queries
from strata.llm import token_files as T
from strata.llm.pieces import library_encoder

from .helpers import ODD_TEXTS, frame

NAME = "byte_bpe_50k.json"


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(public_tokenizers.path(NAME))
    tok.encode_special_tokens = True
    return lambda text: np.array(tok.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def test_cached_parts_encode_like_the_library(library):
    encode = library_encoder(NAME).encode
    for text in [*ODD_TEXTS, *(a + b for a in ODD_TEXTS[:9] for b in ODD_TEXTS[:9])]:
        assert encode(text) == library(text), repr(text[:40])


def test_added_tokens_have_their_ids():
    tok = Tokenizer.from_file(public_tokenizers.path(NAME))
    encode = library_encoder(NAME, added_tokens=True).encode
    end = "<|endoftext|>"
    texts = [*ODD_TEXTS, f"a {end} x", end, end * 2, f" {end}\n\n {end}s", f"a  {end}  b", end[:-1],
             f"{end[:5]}{end}", "plain words"]
    for text in [*texts, *(a + end + b for a in ODD_TEXTS for b in ODD_TEXTS)]:
        want = tok.encode(text, add_special_tokens=False).ids
        assert encode(text) == np.array(want, "<u4").tobytes(), repr(text[:40])


def test_the_query_finds_added_tokens(spark, tmp_path):
    texts = [f"a <|endoftext|> x {k}" for k in range(5)]
    rows = [(k, t) for k, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(
        f"file://{tmp_path}/documents.parquet")
    tok = Tokenizer.from_file(public_tokenizers.path(NAME))
    want = [len(tok.encode(t, add_special_tokens=False).ids) + 1 for t in texts]
    files = queries.op9_token_files(spark, f"file://{tmp_path}").collect()
    assert [r.n_tokens for r in sorted(files, key=lambda r: r.doc_id)] == want
    packed = queries.op5_best_fit_packing(spark, f"file://{tmp_path}").collect()
    assert [r.length for r in sorted(packed, key=lambda r: r.doc_id)] == want


def _expected(rows, library):
    out, at = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        data = library(text or "") + bytes(4)
        out.append((doc_id, len(data) // 4, zlib.crc32(data)))
    return out


def test_round_trip_with_odd_rows(spark, library):
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)] + [(7, "twice"), (7, "twice"), (None, "no id"),
                                                        (50, None), (60, "word " * 30_000)]
    df = frame(spark, rows, "doc_id long, text string")
    manifest = T.write_token_files(df, "doc_id", "text", T.token_folder(spark))
    got = sorted(T.read_token_files(manifest).collect(), key=lambda r: r.start)
    at = 0
    for row in got:
        assert row.start == at
        at += row.n_tokens
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted([(r.doc_id, r.n_tokens, r.ids_crc32) for r in got], key=key) == sorted(
        _expected(rows, library), key=key)
    ids = [r.doc_id for r in got]
    assert ids[0] is None and ids[1:] == sorted(ids[1:])


def test_any_reader_and_random_access(spark, library):
    rows = [(k, f"document {k} " * k) for k in range(40)]
    manifest = T.write_token_files(frame(spark, rows, "doc_id long, text string"), "doc_id", "text",
                                   T.token_folder(spark))
    for row in manifest.collect():
        reader = T.TokenFileReader(row.path)
        with open(row.path.removeprefix("file://"), "rb") as f:
            whole = zstandard.ZstdDecompressor().stream_reader(f, read_across_frames=True).read()
        assert whole == b"".join(reader.read(k) for k in range(len(reader)))
        for k, doc_id in enumerate(reader.ids):
            assert reader.find(doc_id) == [k]
            assert reader.read(k) == library(rows[doc_id][1]) + bytes(4)
    wanted = spark.createDataFrame([(3,), (39,), (99,)], "x long")
    got = {r.doc_id: r.ids for r in T.fetch_documents(manifest, wanted).collect()}
    assert set(got) == {3, 39}
    assert np.array(got[39], "<u4").tobytes() == library(rows[39][1]) + bytes(4)


def test_a_changed_byte_is_noticed(tmp_path):
    writer = T.TokenFileWriter(str(tmp_path), "x.zst", 1)
    writer.add(1, bytes(range(200)) * 20)
    writer.add(2, b"abcd" * 9)
    writer.close()
    path = tmp_path / "x.zst"
    data = bytearray(path.read_bytes())
    reader = T.TokenFileReader(str(path))
    data[int(reader.begins[1]) - 1] ^= 0xFF
    path.write_bytes(data)
    broken = T.TokenFileReader(str(path))
    assert broken.read(1) == b"abcd" * 9
    with pytest.raises((ValueError, zstandard.ZstdError)):
        broken.read(0)


def test_empty_table(spark):
    df = frame(spark, [], "doc_id long, text string")
    manifest = T.write_token_files(df, "doc_id", "text", T.token_folder(spark))
    assert T.read_token_files(manifest).count() == 0


def test_fetch_opens_only_files_with_wanted_ids(spark, library, tmp_path):
    rows = [(k // 2, f"text number {k} " * (k % 7)) for k in range(400)] + [(None, "none")]
    folder = f"file://{tmp_path}/files"
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # small partitions stay apart
    try:
        manifest = T.write_token_files(
            spark.createDataFrame(rows, "doc_id long, text string").repartition(8), "doc_id",
            "text", folder)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    spans = [(r.first_id, r.last_id, r.path) for r in manifest.orderBy("file_no").collect()]
    assert len(spans) > 2 and spans[0][0] is None and spans[-1][1] == 199
    unwanted = [p for a, b, p in spans if a is not None and (a > 20 or b < 5)]
    for path in unwanted:  # a file that is opened without need would not be readable
        with open(path.removeprefix("file://"), "r+b") as f:
            f.truncate(4)
    assert unwanted
    wanted = spark.createDataFrame([(k,) for k in (5, 20, 20, 1000, None)], "k long")
    got = sorted((r.doc_id, r.ids) for r in T.fetch_documents(manifest, wanted).collect())
    want = sorted((k, np.frombuffer(library(t) + bytes(4), "<u4").tolist())
                  for k, t in rows if k in (5, 20))
    assert got == want


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError, match="normalizer"):
        library_encoder("word_bpe_49k.json")
