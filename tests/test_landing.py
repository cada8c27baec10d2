"""Landing: CSV fidelity, JSON records, day directories."""

import pytest
from pyspark.sql import functions as F

from strata.operators.silver import conform
from strata.sources.landing import (_csv_options, is_single_line, land_by_day, land_day,
                                    landing_days, latest_day, read_csv, read_day, read_days,
                                    read_json)


def _write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")


def test_quotes_separators_newlines_and_blanks(spark, tmp_path):
    f = tmp_path / "d" / "part-0.csv"
    _write(f, 'id;txt\n1;"He said ""hi"" ; ok"\n2;\n3;""\n4;"two\nlines"\n')
    rows = {r.id: r.txt for r in read_csv(spark, str(f.parent)).collect()}
    assert rows == {"1": 'He said "hi" ; ok', "2": None, "3": None, "4": "two\nlines"}


def test_header_order_differs_binds_by_name(spark, tmp_path):
    f = tmp_path / "d" / "part-0.csv"
    _write(f, "b;a\nB1;A1\n")
    df = conform(read_csv(spark, str(f.parent)), [("a", "STRING"), ("b", "STRING")])
    assert df.columns == ["a", "b"]
    assert df.collect()[0].asDict() == {"a": "A1", "b": "B1"}


def test_csv_round_trip_is_identity(spark, lake):
    rows = [(1, 'q"uote;semi', " lead and trail ", "a\r\nb"), (2, None, "", "x"),
            (3, "\\back\\slash", "tab\there", "ünï©ødé")]
    df = spark.createDataFrame(rows, "id BIGINT, a STRING, b STRING, c STRING")
    base = lake.bronze("s", "t")
    land_day(df, base, "20240101")
    back = conform(read_day(spark, base, "20240101"),
                   [("id", "BIGINT"), ("a", "STRING"), ("b", "STRING"), ("c", "STRING")])
    got = {r.id: (r.a, r.b, r.c) for r in back.collect()}
    # blank text reads back as NULL; everything else is exact
    assert got == {1: ('q"uote;semi', " lead and trail ", "a\r\nb"), 2: (None, None, "x"),
                   3: ("\\back\\slash", "tab\there", "ünï©ødé")}


def test_documents_round_trip(spark, lake):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    base = lake.bronze("corpus", "documents")
    land_day(docs, base, "20240101", max_records_per_file=50)
    back = conform(read_day(spark, base, "20240101"),
                   [(f.name, f.dataType.simpleString()) for f in docs.schema.fields])
    assert back.exceptAll(docs).count() == 0 and docs.exceptAll(back).count() == 0


def test_nested_values_become_json_text_in_csv(spark, lake):
    df = spark.createDataFrame([(1, [1, 2], {"k": 1})], "id INT, xs ARRAY<INT>, m MAP<STRING,INT>")
    base = lake.bronze("s", "nested")
    land_day(df, base, "20240101")
    r = read_day(spark, base, "20240101").collect()[0]
    assert (r.xs, r.m) == ("[1,2]", '{"k":1}')


def test_json_missing_keys_are_null_and_nested_kept(spark, tmp_path):
    f = tmp_path / "j" / "day.json"
    _write(f, '[{"id": 1, "name": "a", "tags": ["x"]}, {"id": 2, "extra": true}]')
    df = read_json(spark, str(f.parent), schema="id BIGINT, name STRING, tags ARRAY<STRING>",
                   multi_line=True)
    got = sorted((r.id, r.name, r.tags) for r in df.collect())
    assert got == [(1, "a", ["x"]), (2, None, None)]


def test_json_keeps_microseconds(spark, lake):
    df = spark.sql("SELECT TIMESTAMP_NTZ'2024-01-01 10:11:12.123456' AS ts")
    base = lake.bronze("s", "ts")
    land_day(df, base, "20240101", ext="json")
    back = read_day(spark, base, "20240101", ext="json", schema="ts TIMESTAMP_NTZ")
    assert back.collect()[0].ts.microsecond == 123456


def test_days_are_listed_and_latest_is_read_alone(spark, lake):
    df = spark.createDataFrame([(1, "20240101"), (2, "20240103"), (3, "20240103"),
                                (4, "20240102")], "id INT, d STRING")
    base = lake.bronze("s", "days")
    land_by_day(df.select("id", "d"), base, F.col("d"), ext="parquet")
    assert landing_days(spark, base) == ["20240101", "20240102", "20240103"]
    day = latest_day(spark, base)
    ids = sorted(r.id for r in read_day(spark, base, day, ext="parquet").collect())
    assert ids == [2, 3]
    assert landing_days(spark, base + "/missing") == []


def test_rerun_of_a_day_replaces_its_files(spark, lake):
    base = lake.bronze("s", "rerun")
    land_day(spark.createDataFrame([(1,), (2,)], "id INT"), base, "20240101")
    land_day(spark.createDataFrame([(3,)], "id INT"), base, "20240101")
    assert [r.id for r in read_day(spark, base, "20240101").collect()] == ["3"]


def test_unknown_format_is_rejected():
    import pytest

    from strata.params import IngestParams, ParamError

    with pytest.raises(ParamError):
        IngestParams.from_dict({"target_schema": "s", "target_table": "t", "ext": "xml"})
    with pytest.raises(ParamError):
        IngestParams.from_dict({"target_schema": "s", "target_table": "t", "mode": "merge"})
    with pytest.raises(ParamError):
        IngestParams.from_dict({"target_table": "t"})


def test_read_several_days_lists_only_those(spark, lake):
    from strata.sources.landing import read_days

    base = lake.bronze("s", "multi")
    for day, ids in [("20240101", [1]), ("20240102", [2, 3]), ("20240103", [4])]:
        land_day(spark.createDataFrame([(i,) for i in ids], "id INT"), base, day)
    df = read_days(spark, base, ["20240101", "20240103"])
    assert sorted((int(r.id), r.ingest_date) for r in df.collect()) == [
        (1, "20240101"), (4, "20240103")]
    files = df.inputFiles()
    assert files and all("ingest_date=20240102" not in f for f in files)


_FLAT_ROWS = [(1, 'q"uote;semi', " lead and trail ", "\\back\\slash"), (2, None, "", "x"),
              (3, "#hash", "tab\there", "ünï©ødé 😀"), (4, '"', ";", "'")]
_FLAT_SCHEMA = [("id", "BIGINT"), ("a", "STRING"), ("b", "STRING"), ("c", "STRING")]


def test_single_line_marker_only_without_line_breaks(spark, lake):
    base = lake.bronze("s", "marker")
    day = f"{base}/ingest_date=20240101"
    df = spark.createDataFrame(_FLAT_ROWS, "id BIGINT, a STRING, b STRING, c STRING")
    land_day(df, base, "20240101")
    assert is_single_line(spark, day)
    # a re-run of the day with a line break (either kind) drops the marker
    for brk in ("two\nlines", "old\rmac"):
        land_day(df.union(spark.createDataFrame([(5, brk, None, None)], df.schema)), base,
                 "20240101")
        assert not is_single_line(spark, day)
        got = {r.id: r.a for r in conform(read_day(spark, base, "20240101"),
                                          _FLAT_SCHEMA).collect()}
        assert got[5] == brk and len(got) == 5
    # a frame without text columns cannot hold a line break
    land_day(spark.range(3), base, "20240102")
    assert is_single_line(spark, f"{base}/ingest_date=20240102")


def test_single_line_read_equals_multi_line_read(spark, lake):
    base = lake.bronze("s", "modes")
    df = spark.createDataFrame(_FLAT_ROWS, "id BIGINT, a STRING, b STRING, c STRING")
    land_day(df, base, "20240101")
    path = f"{base}/ingest_date=20240101"
    assert is_single_line(spark, path)
    line = conform(read_day(spark, base, "20240101"), _FLAT_SCHEMA)
    multi = conform(spark.read.options(**_csv_options(";", True, True)).csv(path), _FLAT_SCHEMA)
    assert sorted(map(tuple, line.collect())) == sorted(map(tuple, multi.collect()))
    assert {r.id: r.b for r in line.collect()} == {1: " lead and trail ", 2: None, 3: "tab\there",
                                                    4: ";"}


def test_single_line_files_are_split_on_read(spark, lake):
    base = lake.bronze("s", "split")
    df = spark.range(200_000).selectExpr("id", "repeat('x', 40) AS pad").coalesce(1)
    land_day(df, base, "20240101", max_records_per_file=1_000_000)
    path = f"{base}/ingest_date=20240101"
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(1 << 20))
    try:
        raw = read_day(spark, base, "20240101")
        assert len(raw.inputFiles()) == 1 and raw.rdd.getNumPartitions() > 1
        assert raw.count() == 200_000
        assert raw.agg({"id": "count"}).collect()[0][0] == 200_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


from hypothesis import HealthCheck, given, settings  # noqa: E402
from hypothesis import strategies as st  # noqa: E402

_TEXT = st.text(alphabet=st.sampled_from(list('ab ;,"\'\\\n\r\t#xé€😀')), max_size=12)


@settings(max_examples=24, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), _TEXT), st.one_of(st.none(), _TEXT)),
                min_size=1, max_size=30))
def test_csv_round_trip_property(spark, lake, rows):
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(rows)],
                               "id BIGINT, a STRING, b STRING")
    base = lake.bronze("p", "prop")
    land_day(df, base, "20240101")
    back = conform(read_day(spark, base, "20240101"),
                   [("id", "BIGINT"), ("a", "STRING"), ("b", "STRING")])
    got = {r.id: (r.a, r.b) for r in back.collect()}
    want = {i: (a or None, b or None) for i, (a, b) in enumerate(rows)}
    assert got == want
    # the line-by-line read is chosen exactly when no value holds a line break
    flat = not any(v and ("\n" in v or "\r" in v) for row in rows for v in row)
    assert is_single_line(spark, f"{base}/ingest_date=20240101") == flat


def test_days_landed_together_are_marked_one_by_one(spark, lake):
    base = lake.bronze("s", "by_day")
    df = spark.createDataFrame(
        [(1, "20240101", "plain"), (2, "20240101", "also plain"), (3, "20240102", "two\nlines"),
         (4, "20240102", "x"), (5, "20240103", "y"), (6, None, "no day")],
        "id INT, d STRING, txt STRING")
    land_by_day(df.select("id", "txt", "d"), base, F.col("d"), ext="csv")
    marked = {d: is_single_line(spark, f"{base}/ingest_date={d}")
              for d in ("20240101", "20240102", "20240103")}
    assert marked == {"20240101": True, "20240102": False, "20240103": True}
    from strata.sources.landing import single_line_days
    assert single_line_days(spark, base) == {"20240101", "20240103"}
    assert single_line_days(spark, base + "/missing") == set()
    # the row without a day is kept, but its folder is not a day
    assert landing_days(spark, base) == ["20240101", "20240102", "20240103"]
    assert latest_day(spark, base) == "20240103"
    for day, want in (("20240101", {1: "plain", 2: "also plain"}),
                      ("20240102", {3: "two\nlines", 4: "x"})):
        got = {int(r.id): r.txt for r in read_day(spark, base, day).collect()}
        assert got == want


def test_balanced_landing_spreads_one_input_partition(spark, lake):
    from strata.sources.landing import balanced

    df = spark.range(50_000).selectExpr("id", "concat('r', CAST(id AS STRING)) AS s",
                                        "array(id) AS xs").coalesce(1)
    from strata.plans.inspect import plan_text

    plan = plan_text(balanced(df))
    keys = plan.split("REBALANCE_PARTITIONS_BY_COL")[0].rsplit("hashpartitioning(", 1)[1]
    assert keys.startswith("id#") and "s#" in keys and "xs#" not in keys
    base = lake.bronze("s", "balance")
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        land_day(df, base, "20240101")
        land_day(df, base, "20240102", balance=True)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    plain = read_day(spark, base, "20240101")
    spread = read_day(spark, base, "20240102")
    assert len(plain.inputFiles()) == 1 and len(spread.inputFiles()) > 1
    assert sorted(map(tuple, spread.collect())) == sorted(map(tuple, plain.collect()))


def test_balanced_landing_with_dotted_names(spark, lake):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "`user.id` INT, `a``b` STRING")
    base = lake.bronze("s", "dotted")
    land_day(df, base, "20240101", balance=True)
    got = sorted((r[0], r[1]) for r in read_day(spark, base, "20240101").collect())
    assert got == [("1", "a"), ("2", "b")]


@pytest.mark.parametrize("width", [1, 2, 3])
def test_gaps_survive_at_every_width(spark, lake, width):
    names = [f"c{k}" for k in range(width)]
    rows = [tuple(v if (n >> k) & 1 else None for k in range(width))
            for n in range(2 ** width) for v in ("x", 'q"; ', "two\nlines")]
    base = lake.bronze("s", f"gaps{width}")
    land_day(spark.createDataFrame(rows, ", ".join(f"{n} STRING" for n in names)), base, "20240101")
    assert sorted(map(tuple, read_day(spark, base, "20240101").collect()), key=str) == sorted(
        rows, key=str)


def test_files_of_one_folder_with_different_headers(spark, tmp_path):
    _write(tmp_path / "d" / "part-0.csv", "a;b\nA1;B1\n")
    _write(tmp_path / "d" / "part-1.csv", '"b";a;c\nB2;A2;C2\n')
    _write(tmp_path / "d" / "part-2.csv", "b\nB3\n\n")
    got = {tuple(r) for r in read_csv(spark, str(tmp_path / "d")).select("a", "b", "c").collect()}
    assert got == {("A1", "B1", None), ("A2", "B2", "C2"), (None, "B3", None)}


def test_reserved_name_in_a_header_is_an_ordinary_column(spark, lake):
    base = lake.bronze("s", "reserved")
    df = spark.createDataFrame([(1, "x", "a")], "id INT, _corrupt_record STRING, v STRING")
    land_day(df, base, "20240101")
    assert read_day(spark, base, "20240101").first().asDict() == {
        "id": "1", "_corrupt_record": "x", "v": "a"}


def test_a_declared_single_line_delivery_is_split(spark, tmp_path):
    """``multi_line`` False makes a large foreign file splittable."""
    _write(tmp_path / "d" / "part-0.csv", "a;b\n" + "some text;more text\n" * 40_000)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        whole = read_csv(spark, str(tmp_path / "d"))
        split = read_csv(spark, str(tmp_path / "d"), multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 < split.rdd.getNumPartitions()
        assert whole.count() == split.count() == 40_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_days_with_and_without_line_breaks_are_read_apart(spark, lake):
    base = lake.bronze("s", "mixed")
    land_day(spark.range(60_000).selectExpr("id", "repeat('t', 20) AS t"), base, "20240101")
    land_day(spark.createDataFrame([(1, "a\nb")], "id INT, t STRING"), base, "20240102")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        df = read_days(spark, base, ["20240101", "20240102"])
        files = len(df.inputFiles())
        assert df.rdd.getNumPartitions() > files
        assert df.count() == 60_001
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("value, text", [
    (10000000.0, "10000000.0"), (12345678.5, "12345678.5"), (1.5e17, "150000000000000000.0"),
    (0.0001, "0.0001"), (1.25e-6, "0.00000125"), (-98765432.125, "-98765432.125"),
    (1e300, "1.0E300"), (0.0, "0.0"), (2.5, "2.5"), (None, None)])
def test_doubles_land_in_plain_notation(spark, lake, value, text):
    base = lake.bronze("s", f"plain{abs(hash(text))}")
    land_day(spark.createDataFrame([(1, value)], "id INT, d DOUBLE"), base, "20240101")
    assert read_day(spark, base, "20240101").first().d == text


@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_balanced_and_daily_landing_with_and_without_adaptive_execution(spark, lake, adaptive):
    base = lake.bronze("s", f"aqe{adaptive}")
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        df = spark.range(4000).selectExpr("id", "CAST(20240101 + id % 2 AS STRING) AS d").coalesce(1)
        land_by_day(df, base, F.col("d"), ext="csv")
        land_day(df, base, "20240109", balance=True)
        if adaptive == "false":
            assert len(read_day(spark, base, "20240109").inputFiles()) > 1
        assert read_days(spark, base, landing_days(spark, base)).count() == 8000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
