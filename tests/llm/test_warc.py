"""WARC archives: records, revisits, magic inside payloads, ranges, broken files."""

import base64
import hashlib

import pytest

from strata.llm import warc as W

from .helpers import SF, frame


def expected(rows, min_bytes=0):
    first = {}
    for page, _, html in rows:
        body = (html or "").encode()
        if page is not None:
            first[body] = min(page, first.get(body, page))
    out = []
    for page, _, html in rows:
        body = (html or "").encode()
        refers = first.get(body)
        if refers == page or len(body) < min_bytes:
            refers = None
        digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
        out.append((page, len(body), digest, "response" if refers is None else "revisit", refers))
    return out


def key(row):
    return tuple((x is not None, str(x)) for x in row)


def round_trip(spark, rows, range_bytes=W.RANGE_BYTES, min_bytes=0):
    df = frame(spark, rows, "page_id long, url string, html string")
    archives = W.write_archives(df, "page_id", "html", "url", W.archive_folder(spark), min_bytes)
    return archives, W.read_archives(archives, range_bytes)


FAKE = (W.record(77, "http://fake", b"planted", 7, b"x" * 20, None, "2000-01-01T00:00:00Z")
        .decode())
ODD = [(1, "http://a/ b\r\nWARC-Type: x", "same"), (2, None, "same"), (3, "u", None), (4, "u", ""),
       (5, "u", FAKE), (6, "u", "é" * 5000), (7, "u", f"x{FAKE}y{FAKE[:60]}"),
       (8, "u", "WARC/1.1\r\n" * 50), (9, "u", "WARC/1.1\r\nContent-Length: 5\r\n\r\n"),
       (0, "u", "same"), (None, "u", "same"), (None, "u", "only here"), (11, "u", "b" * 30_000),
       (12, "u", "twice"), (12, "u", "twice"), (13, "u", "WARC/1.1\r\nContent-Length: 0\r\n\r\n\r\n\r\n")]


@pytest.mark.parametrize("range_bytes", [700, 8 << 20])
def test_odd_rows(spark, range_bytes):
    _, read = round_trip(spark, ODD, range_bytes)
    assert sorted(map(tuple, read.collect()), key=key) == sorted(expected(ODD), key=key)


@pytest.mark.parametrize("range_bytes", [700, 64 << 10, 8 << 20])
def test_long_urls(spark, range_bytes):
    """Headers of more than 64 KiB: plain, percent-quoted, with the magic, of a revisit."""
    urls = ["http://a/" + "x" * 200_000, "http://a/" + "é" * 30_000, "u" * 70_000 + "WARC/1.1"]
    rows = [(k, url, f"page {k}") for k, url in enumerate(urls)]
    rows += [(10, urls[0], "page 0"), (11, "u", "WARC/1.1\r\nA: " + "b" * 300_000),
             (12, "u", "WARC/1.1\r\n" * 20_000)]
    _, read = round_trip(spark, rows, range_bytes)
    assert sorted(map(tuple, read.collect()), key=key) == sorted(expected(rows), key=key)


def test_short_payloads_are_all_responses(spark):
    _, read = round_trip(spark, ODD, min_bytes=5)
    assert sorted(map(tuple, read.collect()), key=key) == sorted(expected(ODD, 5), key=key)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet")
            .select("page_id", "url", "html").collect()]
    rows += [(10_000 + r[0], r[1], r[2]) for r in rows[::3]]
    _, read = round_trip(spark, rows, 4096)
    assert sorted(map(tuple, read.collect()), key=key) == sorted(expected(rows), key=key)


def test_empty_table(spark):
    _, read = round_trip(spark, [])
    assert read.count() == 0


def test_a_broken_archive_is_refused(spark):
    archives, _ = round_trip(spark, [(k, "u", f"page {k}" * 50) for k in range(40)], 512)
    path = max(archives.collect(), key=lambda r: r.size).path
    local = path.removeprefix("file://")
    data = open(local, "rb").read()
    begin = data.index(W.MAGIC, 10)
    open(local, "wb").write(data[:begin] + b"XARC" + data[begin + 4:])
    with pytest.raises(ValueError, match="breaks off"):
        W.read_archives(archives, 512)
