"""Incremental suites against full ones, with the partitions that are read."""

import pytest

from strata.operators.incremental import incremental_suite
from strata.operators.publish import publish_gated
from strata.operators.quality import run_suite
from strata.operators.tables import ensure_table, write_by_name
from strata.params import ParamError, QualityParams
from strata.session import fresh_name

SUITE = {"quality_params": {
    "not_null": {"column": "name"}, "unique_vals": {"column": "id,name,v"},
    "df_count_btw": {"min": "1,5", "max": "9,50"}, "values_btw": {"column": "v", "min": "0", "max": "9"},
    "date_mask_equal": {"column": "name", "date_mask": "%Y"}}}
SCHEMA = "id BIGINT, name STRING, v DOUBLE, p STRING"


def _rows(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture()
def made(spark, lake):
    table = f"{fresh_name('s')}.t"
    location = lake.location("silver", *table.split("."))
    ensure_table(spark, table, [tuple(c.split()) for c in SCHEMA.split(", ")], "p", location)
    return table, location, f"{lake.root}/_suites/t"


def _same(spark, table, root, suite=SUITE):
    done = incremental_suite(spark, table, suite, root)
    full = run_suite(spark.table(table), suite)
    assert sorted(map(tuple, done.report.collect())) == sorted(map(tuple, full.collect()))
    return done.read, done.kept


def test_equals_the_full_suite(spark, made):
    table, location, root = made
    assert _same(spark, table, root) == ([], [])  # no partition yet
    write_by_name(_rows(spark, [(1, "2020", 1.0, "a"), (2, None, -0.0, "a"), (1, "x", 0.0, "b"),
                                (3, "2020", float("nan"), None), (4, "y", float("nan"), "c d")]),
                  table)
    every = ["__HIVE_DEFAULT_PARTITION__", "a", "b", "c d"]
    assert _same(spark, table, root) == (every, [])
    assert _same(spark, table, root) == ([], every)
    write_by_name(_rows(spark, [(9, "2021", 3.0, "b"), (9, "2021", 30.0, "b")]), table)
    assert _same(spark, table, root) == (["b"], [every[0], "a", "c d"])
    write_by_name(_rows(spark, [(7, "z", None, None)]), table, mode="append")
    assert _same(spark, table, root)[0] == [every[0]]
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (p = 'a')")
    assert _same(spark, table, root)[0] == []
    publish_gated(_rows(spark, [(5, "2024", 5.0, "b")]), table, location, QualityParams.from_dict(
        {"quality_params": {"not_null": {"column": "id"}}}))
    assert _same(spark, table, root)[0] == ["b"]


def test_only_changed_partitions_are_scanned(spark, made):
    table, _, root = made
    write_by_name(_rows(spark, [(k, str(k), 1.0, f"p{k % 5}") for k in range(50)]), table)
    _same(spark, table, root)
    write_by_name(_rows(spark, [(99, "n", 1.0, "p3")]), table)
    scanned = []
    before = spark.table

    def table_of(name):
        rows = before(name)
        scanned.append(rows)
        return rows

    spark.table = table_of
    try:
        from strata.operators.incremental import _changed_rows
        rows = _changed_rows(spark, table, "p", ["p3"], 5)
    finally:
        spark.table = before
    assert len(rows.inputFiles()) < len(before(table).inputFiles())
    assert "PartitionFilters: [p" in rows._jdf.queryExecution().executedPlan().toString() or all(
        "p=p3" in f for f in rows.inputFiles())
    assert _same(spark, table, root)[0] == ["p3"]


def test_another_suite_starts_anew(spark, made):
    table, _, root = made
    write_by_name(_rows(spark, [(1, "a", 1.0, "x"), (2, "b", 2.0, "y")]), table)
    _same(spark, table, root)
    other = {"quality_params": {"not_null": {"column": "id"}}}
    assert _same(spark, table, root, other)[0] == ["x", "y"]
    assert _same(spark, table, root, {"quality_params": {"unique_vals": {"column": "id"}}})[0] == ["x", "y"]
    with pytest.raises(ParamError):
        incremental_suite(spark, table, {"quality_params": {}}, root)


def test_unpartitioned_table(spark, lake):
    table = f"{fresh_name('s')}.plain"
    ensure_table(spark, table, [tuple(c.split()) for c in SCHEMA.split(", ")], None,
                 lake.location("silver", *table.split(".")))
    root = f"{lake.root}/_suites/plain"
    write_by_name(_rows(spark, [(1, "a", 1.0, "x")]), table, mode="append")
    assert _same(spark, table, root) == ([""], [])
    assert _same(spark, table, root) == ([], [""])
    write_by_name(_rows(spark, [(1, "a", 1.0, "x")]), table, mode="append")
    assert _same(spark, table, root) == ([""], [])
