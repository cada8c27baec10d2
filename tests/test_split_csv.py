"""Byte ranges of multi-line CSV against Spark's multi-line reader."""

import random

import pytest

from strata.lake import filesystem
from strata.sources import files, landing, split_csv

OPTIONS = landing._csv_options(";", True)


def _spark_read(spark, path, header=True):
    return spark.read.options(**landing._csv_options(";", header)).csv(path)


def _same(spark, folder, range_bytes, header=True):
    got = split_csv.read_split_csv(spark, [folder], ";", header, OPTIONS, range_bytes)
    want = _spark_read(spark, folder, header)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    return got


def _write(tmp_path, data, name="part-0.csv"):
    folder = tmp_path / "delivery"
    folder.mkdir(exist_ok=True)
    (folder / name).write_bytes(data if isinstance(data, bytes) else data.encode())
    return f"file://{folder}"


def _quoted(value):
    return '"' + value.replace('"', '""') + '"'


def _records(rng, n):
    parts = ["a", "line\nbreak", '"', '""', ";", "\n", "é", "\r\n", " ", "x;y", '"q"', "\n\n", "日本"]
    rows = []
    for k in range(n):
        cells = [str(k)] + ["".join(rng.choices(parts, k=rng.randrange(0, 9))) for _ in range(2)]
        rows.append(";".join(_quoted(c) if rng.random() < 0.8 or set(c) & set(';"\r\n') else c
                             for c in cells))
    return rows


@pytest.mark.parametrize("range_bytes", [1024, 1500, 4096, 65536])
def test_ranges_equal_the_multi_line_read(spark, tmp_path, range_bytes):
    rng = random.Random(3)
    data = "id;a;b\n" + "\n".join(_records(rng, 1200)) + "\n"
    got = _same(spark, _write(tmp_path, data), range_bytes)
    tasks = {r.part for r in got.selectExpr("spark_partition_id() AS part").distinct().collect()}
    assert len(tasks) > 1 or range_bytes > len(data)


@pytest.mark.parametrize("data", [
    "a;b\n", "a;b", "a;b\n1;2", "\n\na;b\n\n1;2\n\n\n3;4\n", 'a;b\n"1\n\n2";"x"\n',
    'a;b\n1;"open to the end\n and on\n', '"a\nx";"b;c"\n1;2\n"3\n";4\n',
    'a;b\n5" pipe;2\n3;4" x "y\n', 'a;b\n"x"y;2\n"x" ;3\n"p""q"z;4\n', "a;b\r\n1;2\r\n\"3\r\n4\";5\r\n",
    "﻿a;b\n1;2\n", "a;b\n1\n1;2;3\n;\n", "a;;a\n1;2;3\n", "a\n\"\"\n1\n\"\"\n",
    "a;b\n  \n1; 2 \n", 'a;b\n"";""\n' + '"' + "x\n" * 3000 + '";1\n2;3\n', "a;b\n" + "y" * 9000 + ";1\n2;3\n",
])
def test_odd_files(spark, tmp_path, data):
    folder = _write(tmp_path, data.encode())
    for range_bytes in (3, 7, 1024):
        if len(data) / range_bytes < 300:
            got = split_csv.read_split_csv(spark, [folder], ";", True, OPTIONS, range_bytes)
            want = _spark_read(spark, folder)
            if len(want.columns) == 1:
                want = landing.read_csv(spark, folder, multi_line=True)
            assert got.columns == want.columns
            assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_lone_line_feeds_in_a_crlf_file(spark, tmp_path):
    """Where this differs from Spark's reader: the record ends."""
    folder = _write(tmp_path, "a;b\r\n1;2\n3;4\r\n")
    got = split_csv.read_split_csv(spark, [folder], ";", True, OPTIONS)
    assert sorted(map(tuple, got.collect())) == [("1", "2"), ("3", "4")]


def test_without_header(spark, tmp_path):
    _same(spark, _write(tmp_path, '1;"a\nb"\n2;"c"\n' * 50), 64, header=False)


def test_state_maps_compose(spark, tmp_path):
    """Every range begins in the state a walk over the whole file gives it."""
    rng = random.Random(8)
    body = "\n".join(_records(rng, 150)) + '\nx"y;"z"q\n"open\n'
    folder = _write(tmp_path, "id;a;b\n" + body)
    catalog = split_csv.header_catalog(files.listing(spark, [folder]))
    ranges = split_csv.byte_ranges(catalog, True, 50)
    got = {r["at"]: r.entry for r in
           split_csv.entry_states(split_csv.state_maps(ranges, ";")).collect()}
    quotes, state, at, states = split_csv.Quotes(";"), 0, 0, {}
    for line in body.encode().split(b"\n"):
        for k in range(-(-at // 50), -(-(at + len(line) + 1) // 50)):
            states.setdefault(k, None)
        states[at // 50] = state if states.get(at // 50) is None else states[at // 50]
        state, at = quotes.after(line, state), at + len(line) + 1
    for k, want in states.items():
        if want is not None:
            assert got[k] == want, k


def test_header_catalog_reads_headers_only(spark, tmp_path):
    big = "".join(f"{k};{'x' * 50}\n" for k in range(20000))
    wide = '"first\nname";"b;c"\n1;2\n'
    for k in range(3):
        folder = _write(tmp_path, "id;v\n" + big, f"big-{k}.csv")
    _write(tmp_path, wide, "wide.csv")
    _write(tmp_path, "v;id\r\n1;2\r\n", "turned.csv")
    rows = {r.path.rsplit("/", 1)[1]: r for r in
            split_csv.header_catalog(files.listing(spark, [folder])).collect()}
    assert {r.bytes_read for n, r in rows.items() if n.startswith("big")} == {split_csv.STEP}
    assert rows["wide.csv"].header == '"first\nname";"b;c"'
    assert (rows["turned.csv"].header, rows["turned.csv"].line_end) == ("v;id", "\r\n")
    assert split_csv.header_names(rows["wide.csv"].header, ";") == ["first\nname", "b;c"]
    counts = split_csv.header_dictionary(split_csv.header_catalog(files.listing(spark, [folder])))
    assert {r.header: r.files for r in counts.collect()}["id;v"] == 3


def test_long_header(spark, tmp_path):
    names = [f"column_{k:05}" for k in range(3000)]
    folder = _write(tmp_path, ";".join(names) + "\n" + ";".join(map(str, range(3000))) + "\n")
    row = split_csv.header_catalog(files.listing(spark, [folder])).first()
    assert row.header == ";".join(names) and row.bytes_read < 2 * len(row.header) + split_csv.STEP


def test_left_to_spark(spark, tmp_path):
    folder = _write(tmp_path, b"a;b\r1;2\r3;4\r")
    assert split_csv.read_split_csv(spark, [folder], ";", True, OPTIONS) is None
    assert landing.read_csv(spark, folder).count() == 2
    assert split_csv.read_split_csv(spark, [folder], "§", True, OPTIONS) is None
    assert not files.can_open("memory:/x") and files.can_open("file:/x")


def test_large_landed_folder_is_split(spark, tmp_path, monkeypatch):
    """Landed folders beyond one range are read in ranges, with the same rows."""
    rows = [(k, f"a\nb;{k}\"" * 20, None if k % 5 else "") for k in range(500)]
    df = spark.createDataFrame(rows, "k long, text string, gap string").coalesce(1)
    folder = f"file://{tmp_path}/landed"
    landing.land_csv(df, folder)
    whole = landing.read_csv(spark, folder)
    assert len(whole.inputFiles()) == 1
    monkeypatch.setattr(split_csv, "RANGE_BYTES", 4096)
    split = landing.read_csv(spark, folder)
    assert split.selectExpr("spark_partition_id() AS p").distinct().count() > 1
    assert sorted(map(str, split.collect())) == sorted(map(str, whole.collect()))


def test_resolved(spark, tmp_path):
    fs, path = filesystem(spark, f"file://{tmp_path}")
    assert files.resolved(spark, f"file://{tmp_path}") == f"file:{tmp_path}"
