"""Quality suite: each check against a brute-force count, suite and gate."""

import math
import re
from datetime import datetime
from decimal import Decimal

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.functions.strftime import matches_strftime, plan_mask
from strata.operators.quality import QualityGateError, enforce, expand, gate, run_suite
from strata.params import ParamError

ROWS = [
    (1, "alpha", 5.0, "2024-01-05", "A1"),
    (2, None, -3.0, "2024-1-5", "A1"),
    (3, "be", float("nan"), "2024-02-30", None),
    (4, "gamma-long-name", 100.0, None, "B2"),
    (5, "delta", None, "2024-01-05 ", "C3"),
    (6, "x,y", 7.5, "20240105", "C3"),
]
SCHEMA = "id BIGINT, name STRING, score DOUBLE, day STRING, code STRING"


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def _report(df, qp):
    return {(r.check_name, r.column_name): r.asDict()
            for r in run_suite(df, {"quality_params": qp}).collect()}


def _parses(v, mask):
    try:
        datetime.strptime(v, mask)
        return True
    except ValueError:
        return False


def test_not_null_counts(frame):
    rep = _report(frame, {"not_null": {"column": "id,name,day"}})
    assert rep[("not_null", "name")]["unexpected_count"] == 1
    assert rep[("not_null", "day")]["unexpected_count"] == 1
    assert rep[("not_null", "id")]["success"] is True
    assert rep[("not_null", "id")]["element_count"] == len(ROWS)
    assert rep[("not_null", "name")]["status"] == "Failed"


def test_unique_ignores_nulls_and_counts_all_duplicated_rows(frame):
    rep = _report(frame, {"unique_vals": {"column": "code,id,score"}})
    assert rep[("unique_vals", "code")]["unexpected_count"] == 4  # A1 x2, C3 x2
    assert rep[("unique_vals", "code")]["element_count"] == 5
    assert rep[("unique_vals", "id")]["unexpected_count"] == 0
    assert rep[("unique_vals", "score")]["success"] is True


def test_unique_single_column_path(frame):
    rep = _report(frame, {"unique_vals": {"column": "code"}})
    assert rep[("unique_vals", "code")]["unexpected_count"] == 4


def test_length_between_text_bounds(frame):
    rep = _report(frame, {"value_lenght_btw": {"column": "name", "min": "3", "max": "10"}})
    expect = sum(1 for r in ROWS if r[1] is not None and not 3 <= len(r[1]) <= 10)
    assert rep[("value_lenght_btw", "name")]["unexpected_count"] == expect
    assert rep[("value_lenght_btw", "name")]["expectation"] == "Size of values between 3 and 10"


def test_values_between_numeric_text_bounds_and_nan(frame):
    rep = _report(frame, {"values_btw": {"column": "score", "min": "0", "max": "10"}})
    expect = sum(1 for r in ROWS if r[2] is not None and (math.isnan(r[2]) or not 0 <= r[2] <= 10))
    assert rep[("values_btw", "score")]["unexpected_count"] == expect == 3


def test_regex_with_comma_and_braces_is_one_rule(frame):
    rx = r"^[a-z]{1,5}$"
    rep = _report(frame, {"value_match_regex": {"column": "name", "regex": rx}})
    expect = sum(1 for r in ROWS if r[1] is not None and not re.search(rx, r[1]))
    assert rep[("value_match_regex", "name")]["unexpected_count"] == expect


def test_regex_is_unanchored_search(frame):
    rep = _report(frame, {"value_match_regex": {"column": "name", "regex": "a"}})
    expect = sum(1 for r in ROWS if r[1] is not None and "a" not in r[1])
    assert rep[("value_match_regex", "name")]["unexpected_count"] == expect


@pytest.mark.parametrize("mask", ["%Y-%m-%d", "%Y%m%d"])
def test_date_mask_matches_strptime(frame, mask):
    rep = _report(frame, {"date_mask_equal": {"column": "day", "date_mask": mask}})
    expect = sum(1 for r in ROWS if r[3] is not None and not _parses(r[3], mask))
    assert rep[("date_mask_equal", "day")]["unexpected_count"] == expect


def test_row_count_ranges(frame):
    rep = run_suite(frame, {"quality_params": {"df_count_btw": {"min": "1,7", "max": "6,9"}}}).collect()
    assert [(r.column_name, r.success, r.element_count, r.unexpected_count) for r in rep] == [
        ("Test on dataset", True, 6, None), ("Test on dataset", False, 6, None)]


def test_suite_order_report_and_gate(frame):
    qp = {"not_null": {"column": "id,name"}, "unique_vals": {"column": "id"},
          "df_count_btw": {"min": "1", "max": "100"}}
    report = run_suite(frame, {"quality_params": qp})
    rows = sorted(report.collect(), key=lambda r: r.check_order)
    assert [(r.check_order, r.check_name, r.column_name) for r in rows] == [
        (0, "not_null", "id"), (1, "not_null", "name"), (2, "unique_vals", "id"),
        (3, "df_count_btw", "Test on dataset")]
    g = gate(report).collect()[0]
    assert (g.checks, g.failed_checks, g.passed) == (4, 1, False)
    with pytest.raises(QualityGateError):
        enforce(report, stop_job=True)
    assert enforce(report, stop_job=False) is False


def test_params_validation(frame):
    with pytest.raises(ParamError):
        expand({"quality_params": {"value_lenght_btw": {"column": "a,b", "min": "1", "max": "2,3"}}})
    with pytest.raises(ParamError):
        expand({"quality_params": {"no_such_check": {"column": "a"}}})
    with pytest.raises(ParamError):
        run_suite(frame, {"quality_params": {"not_null": {"column": "missing"}}})
    with pytest.raises(ParamError):
        run_suite(frame, {"quality_params": {"values_btw": {"column": "score", "min": "x", "max": "1"}}})
    checks = expand({"quality_params": {"value_match_regex": {"column": ["a", "b"], "regex": ["x,y", "z"]}}})
    assert [c.arg("regex") for c in checks] == ["x,y", "z"]


DATE_VALUES = ["2024-01-05", "2024-1-5", "2024-02-30", "2024-02-29", "2023-02-29", "0000-01-01",
               "2024115", "20240105", " 2024-01-05", "2024-01- 5", "2024-01-05 ", "abc", "",
               "05/Jan/2024 10:11:12", "5/JAN/2024 1:2:3", "31/Feb/2024 10:11:12",
               "05/Jan/2024 10:11:60", "240105", "366", "060", "12/31/99 11 PM",
               "2024-366", "2023-366", "9999-366", "9996-366", "2024-367", "2024-0", "0000-5",
               "10:11 +0130", "10:11 +01:30", "10:11 Z", "10:11 z", "10:11 +2400", "10:11 -23:59",
               "10:11 +01:30:15.5", "10:11 +013015", "10:11 +01:3015", "10:11 +0130:15",
               "it's 5", "2024  1", "5% of 2024", "Mon Jan  1 10:11:12 2024", "1 3"]
MASKS = ["%Y-%m-%d", "%Y%m%d", "%d/%b/%Y %H:%M:%S", "%y%m%d", "%m/%d/%y %I %p", "%j",
         "%Y-%j", "%H:%M %z", "it's %d", "%Y %m", "%d%% of %Y", "%c", "%w %u", "%Y-%U-%w"]


def test_strftime_matcher_equals_strptime(spark):
    df = spark.createDataFrame([(v,) for v in DATE_VALUES], "v STRING")
    for mask in MASKS:
        got = {r.v: r.ok for r in df.select("v", matches_strftime(F.col("v"), mask).alias("ok")).collect()}
        assert got == {v: _parses(v, mask) for v in DATE_VALUES}, mask


@pytest.mark.parametrize("mask", ["%Y-%Y", "%Q", "100%"])
def test_impossible_masks_are_refused(mask):
    from strata.functions.strftime import MaskError

    with pytest.raises(MaskError):
        plan_mask(mask)


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bounds_do_not_take_the_type_of_the_column(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        df = spark.createDataFrame(
            [(1, 1, 1, Decimal("0.0"), 0.5), (4, 127, 2**63 - 1, Decimal("3.0"), 4.0),
             (None, -128, -2**63, Decimal("3.1"), None)],
            "i INT, t TINYINT, b BIGINT, d DECIMAL(10,1), f DOUBLE")
        cases = {("i", "0.5", "3.5"): 1, ("i", "0", "3000000000"): 0, ("t", "0", "1000"): 1,
                 ("b", "-1e40", "9223372036854775806.5"): 1, ("b", "-inf", "inf"): 0,
                 ("d", "0.04", "3.04"): 2, ("d", "1e20", "1e30"): 3, ("i", "1.2", "1.8"): 2,
                 ("f", "0.25", "3.9"): 1}
        for (column, low, high), bad in cases.items():
            rep = _report(df, {"values_btw": {"column": column, "min": low, "max": high}})
            assert rep[("values_btw", column)]["unexpected_count"] == bad, (column, low, high)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)
    with pytest.raises(ParamError):
        _report(df, {"value_lenght_btw": {"column": "i", "min": "1", "max": "5.7"}})


WEEK_MASKS = ["%Y-%U-%w", "%Y-%W-%w", "%Y-%W-%u", "%Y %U %a", "%A %W %Y", "%G-%V-%u", "%G-W%V-%w",
              "%G %V %A", "%Y %U", "%y-%W-%u", "%Y-%V-%u", "%G-%u", "%G-%V", "%G-%V-%u %j",
              "%U %W %Y %w", "%G-%V-%u %Y", "%Y-%m-%d %a", "%G %V %u %U", "%w %u %Y %W"]


@pytest.mark.parametrize("mask", WEEK_MASKS)
def test_week_masks_equal_strptime(spark, mask):
    """All first and last weeks of years around every kind of year, and the ends of time."""
    import itertools
    import re

    years = ["0000", "0001", "0002", "1900", "1999", "2000", "2004", "2015", "2016", "2020", "2021",
             "9998", "9999"]
    parts = {"Y": years, "G": years, "y": ["00", "68", "69"], "U": ["0", "00", "1", "52", "53", "54"],
             "W": ["0", "1", "52", "53"], "V": ["0", "01", "1", "52", "53"], "w": list("0167"),
             "u": list("0157"), "a": ["Sun", "mon", "x"], "A": ["SUNDAY", "Thursday"],
             "j": ["1", "366"], "m": ["2"], "d": ["29", "30"]}
    keys = re.findall("%(.)", mask)
    values = []
    for combo in itertools.product(*(parts[k] for k in keys)):
        given = iter(combo)
        values.append(re.sub("%.", lambda _: next(given), mask))
    values = sorted(set(values))[:4000] + ["", "2020", "2020-1", " 2020-01-1", "2020-01-1 "]
    df = spark.createDataFrame([(v,) for v in values], "v STRING")
    got = {r.v: r.ok for r in df.select("v", matches_strftime(F.col("v"), mask).alias("ok")).collect()}
    want = {v: _parses(v, mask) for v in values}
    assert got == want, [(v, want[v]) for v in values if got[v] != want[v]][:5]


def test_zone_names(spark):
    from strata.functions.strftime import zone_names

    values = [f"2024 {z}" for z in ("UTC", "gmt", "CET", "Z", "", *zone_names())]
    df = spark.createDataFrame([(v,) for v in values], "v STRING")
    got = {r.v: r.ok for r in
           df.select("v", matches_strftime(F.col("v"), "%Y %Z").alias("ok")).collect()}
    assert got == {v: _parses(v, "%Y %Z") for v in values}


def test_no_mask_runs_python(spark):
    df = spark.createDataFrame([("2024-01-1",)], "v STRING")
    for mask in (*MASKS, *WEEK_MASKS, "%Y %Z"):
        plan = df.select(matches_strftime(F.col("v"), mask).alias("ok"))._jdf
        assert "Python" not in plan.queryExecution().executedPlan().toString()


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(-5, 5)),
                          st.one_of(st.none(), st.text("ab,", max_size=4))), min_size=1, max_size=40),
       st.sampled_from([1, 3, 8]))
def test_counts_do_not_depend_on_partitioning(spark, rows, parts):
    df = spark.createDataFrame(rows, "n INT, s STRING")
    qp = {"quality_params": {"not_null": {"column": "n,s"}, "unique_vals": {"column": "n,s"},
                             "values_btw": {"column": "n", "min": "-2", "max": "2"},
                             "value_lenght_btw": {"column": "s", "min": "1", "max": "2"}}}
    one = sorted(tuple(r) for r in run_suite(df.coalesce(1), qp).collect())
    many = sorted(tuple(r) for r in run_suite(df.repartition(parts), qp).collect())
    assert one == many
    ns = [r[0] for r in rows if r[0] is not None]
    dup = sum(ns.count(v) for v in set(ns) if ns.count(v) > 1)
    assert [r for r in one if r[2] == "unique_vals" and r[1] == "n"][0][5] == dup


def test_unique_columns_of_one_type_do_not_collide(spark):
    df = spark.createDataFrame([(1, 1, "x", 1.0), (2, 3, "x", 2.0), (3, 2, "y", 2.0)],
                               "a INT, b INT, s STRING, d DOUBLE")
    rep = _report(df, {"unique_vals": {"column": "a,b,s,d"}})
    assert {k[1]: v["unexpected_count"] for k, v in rep.items()} == {"a": 0, "b": 0, "s": 2, "d": 2}


def test_materialized_source_gives_the_same_report(spark, tmp_path):
    from strata.session import storage_root

    storage_root(spark)  # makes sure a checkpoint directory is set
    df = spark.createDataFrame(ROWS, SCHEMA).groupBy("code").agg(F.count("*").alias("n"))
    qp = {"quality_params": {"not_null": {"column": "code"}, "unique_vals": {"column": "code"}}}
    plain = sorted(tuple(r) for r in run_suite(df, qp).collect())
    once = sorted(tuple(r) for r in run_suite(df, qp, materialize_to=str(tmp_path / "frame")).collect())
    assert plain == once


def test_report_text_survives_quotes_and_backslashes_in_both_literal_modes(spark):
    # column names and rules end up as SQL string literals in the report
    df = spark.createDataFrame([("it's", "a\\b")], "`o'k` STRING, `b\\s` STRING")
    rx = r"^[a-z]'s\d{1,3}\\$" + "\n|é"
    qp = {"quality_params": {"value_match_regex": {"column": "o'k", "regex": rx},
                             "not_null": {"column": "b\\s"},
                             "df_count_btw": {"min": "0", "max": "3000000000"}}}
    key = "spark.sql.parser.escapedStringLiterals"
    before = spark.conf.get(key)
    got = {}
    try:
        for mode in ("false", "true"):
            spark.conf.set(key, mode)
            report = run_suite(df, qp)
            got[mode] = (report.schema, [tuple(r) for r in report.collect()])
    finally:
        spark.conf.set(key, before)
    assert got["false"] == got["true"]
    rows = {r[2]: r for r in got["false"][1]}
    assert rows["value_match_regex"][1] == "o'k"
    assert rows["value_match_regex"][3] == f"Column value o'k match with {rx}"
    assert rows["not_null"][1] == "b\\s"
    assert rows["df_count_btw"][6] is True
    assert [f.dataType.simpleString() for f in got["false"][0].fields] == [
        "int", "string", "string", "string", "bigint", "bigint", "boolean", "string"]


def test_unique_with_a_value_holding_a_third_of_the_rows(spark):
    df = spark.range(0, 30_000, numPartitions=8).selectExpr(
        "CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS k",
        "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 7 = 0 THEN NULL "
        "ELSE concat('v', CAST(id DIV 2 AS STRING)) END AS s")
    rep = _report(df, {"unique_vals": {"column": "k,s"}})
    rows = df.collect()
    for col in ("k", "s"):
        values = [r[col] for r in rows if r[col] is not None]
        counts = {}
        for v in values:
            counts[v] = counts.get(v, 0) + 1
        dup = sum(n for n in counts.values() if n > 1)
        got = rep[("unique_vals", col)]
        assert (got["element_count"], got["unexpected_count"], got["success"]) == (
            len(values), dup, dup == 0)
