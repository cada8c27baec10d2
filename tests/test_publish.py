"""Write, audit, publish: gates before rows are visible, places that survive sessions."""

import json

import pytest

from strata.lake import read_text, remove_folder, replace_text, subdirectories, write_text
from strata.operators import publish as P
from strata.operators.quality import QualityGateError
from strata.operators.tables import (ensure_table, places_path, register_tables, write_by_name)
from strata.params import IngestParams, QualityParams
from strata.plans.daily import PipelineSpec, run_pipeline
from strata.session import fresh_name

COLUMNS = [("id", "BIGINT"), ("name", "STRING"), ("grp", "STRING")]
SUITE = QualityParams.from_dict({"quality_params": {"not_null": {"column": "name"}}})


def _frame(spark, rows):
    return spark.createDataFrame(rows, "id BIGINT, name STRING, grp STRING")


@pytest.fixture()
def made(spark, lake):
    db = fresh_name("s")
    location = lake.location("silver", db, "t")
    ensure_table(spark, f"{db}.t", COLUMNS, "grp", location)
    return f"{db}.t", location


def _rows(spark, table):
    return sorted(tuple(r) for r in spark.table(table).select("id", "name", "grp").collect())


def test_failed_gate_leaves_the_table(spark, made):
    table, location = made
    P.publish_gated(_frame(spark, [(1, "a", "x"), (2, "b", "y")]), table, location, SUITE)
    before = P.table_versions(spark, location)
    with pytest.raises(QualityGateError):
        P.publish_gated(_frame(spark, [(3, None, "x")]), table, location, SUITE)
    assert _rows(spark, table) == [(1, "a", "x"), (2, "b", "y")]
    assert P.table_versions(spark, location) == before
    assert len(subdirectories(spark, f"{location}/{P.VERSIONS}")) == 0 or set(
        v.split("/")[-2] for v in before.values()) == {
        p.split("/")[-1] for p in _versions(spark, location)}


def _versions(spark, location):
    return [f"{location}/{P.VERSIONS}/{n}" for n in
            subdirectories(spark, f"{location}/{P.VERSIONS}")]


VALUES = ["x", "a b", "it's", "50%", "a/b=c", "ä", None, ""]


@pytest.mark.parametrize("value", VALUES, ids=range(len(VALUES)))
def test_partition_values(spark, made, value):
    table, location = made
    P.publish_gated(_frame(spark, [(1, "a", value), (2, "b", "other")]), table, location, SUITE)
    P.publish_gated(_frame(spark, [(3, "c", value)]), table, location, SUITE)
    kept = value if value else None
    got = sorted(_rows_any(spark, table), key=str)
    assert got == sorted([(2, "b", "other"), (3, "c", kept)], key=str)


def _rows_any(spark, table):
    return [tuple(r) for r in spark.table(table).select("id", "name", "grp").collect()]


def test_readers_of_the_day_before_go_on(spark, made):
    table, location = made
    P.publish_gated(_frame(spark, [(1, "a", "x")]), table, location, SUITE)
    reader = spark.table(table)
    assert reader.count() == 1
    files = reader.inputFiles()
    P.publish_gated(_frame(spark, [(2, "b", "x")]), table, location, SUITE)
    assert spark.read.parquet(*files).count() == 1  # the old version is still there
    P.publish_gated(_frame(spark, [(3, "c", "x")]), table, location, SUITE)
    assert len(_versions(spark, location)) == 2  # the first one has gone
    assert _rows(spark, table) == [(3, "c", "x")]


def test_ordinary_writes_after_a_publication(spark, made):
    table, location = made
    P.publish_gated(_frame(spark, [(1, "a", "x"), (2, "b", "y")]), table, location, SUITE)
    write_by_name(_frame(spark, [(3, "c", "x")]), table, mode="append")
    assert _rows(spark, table) == [(1, "a", "x"), (2, "b", "y"), (3, "c", "x")]
    write_by_name(_frame(spark, [(4, "d", "x"), (5, "e", "z")]), table)
    assert _rows(spark, table) == [(2, "b", "y"), (4, "d", "x"), (5, "e", "z")]
    P.publish_gated(_frame(spark, [(6, "f", "z")]), table, location, SUITE)
    assert _rows(spark, table) == [(2, "b", "y"), (4, "d", "x"), (6, "f", "z")]


def test_places_are_found_again_in_a_new_session(spark, lake, made):
    table, location = made
    write_by_name(_frame(spark, [(1, "a", "x"), (2, "b", "y")]), table)
    P.publish_gated(_frame(spark, [(3, "c", "y"), (4, "d", None)]), table, location, SUITE)
    want = _rows_any(spark, table)
    spark.sql(f"DROP TABLE {table}")  # external: files and records stay
    assert register_tables(spark, lake, lambda d, t: f"{d}.{t}" == table) == [table]
    assert sorted(_rows_any(spark, table), key=str) == sorted(want, key=str)


def test_record_rolls_forward_after_a_crash(spark, lake, made):
    """The record is written, the catalog is not: registering completes the publication."""
    table, location = made
    write_by_name(_frame(spark, [(1, "a", "x")]), table)
    stage = P.stage_rows(_frame(spark, [(2, "b", "x")]), table, location)
    replace_text(spark, places_path(location), json.dumps({"x": f"{stage.folder}/grp=x"}))
    assert _rows(spark, table) == [(1, "a", "x")]
    spark.sql(f"DROP TABLE {table}")
    register_tables(spark, lake, lambda d, t: f"{d}.{t}" == table)
    assert _rows(spark, table) == [(2, "b", "x")]


def test_append_and_unpartitioned(spark, lake, made):
    table, location = made
    for k in range(2):
        P.publish_gated(_frame(spark, [(k, "a", "x")]), table, location, SUITE, mode="append")
    assert _rows(spark, table) == [(0, "a", "x"), (1, "a", "x")]
    db = fresh_name("s")
    place = lake.location("silver", db, "plain")
    ensure_table(spark, f"{db}.plain", COLUMNS, None, place)
    for k in range(3):
        P.publish_gated(_frame(spark, [(k, "a", "x")]), f"{db}.plain", place, SUITE)
    assert _rows(spark, f"{db}.plain") == [(2, "a", "x")]
    spark.sql(f"DROP TABLE {db}.plain")
    register_tables(spark, lake, lambda d, t: t == "plain")
    assert _rows(spark, f"{db}.plain") == [(2, "a", "x")]


def test_empty_stage(spark, made):
    table, location = made
    P.publish_gated(_frame(spark, [(1, "a", "x")]), table, location, SUITE)
    P.publish_gated(_frame(spark, []), table, location, SUITE)
    assert _rows(spark, table) == [(1, "a", "x")]


def test_table_made_again_forgets_its_places(spark, made):
    table, location = made
    P.publish_gated(_frame(spark, [(1, "a", "x")]), table, location, SUITE)
    spark.sql(f"DROP TABLE {table}")
    remove_folder(spark, location)
    ensure_table(spark, table, COLUMNS, "grp", location)
    assert spark.table(table).count() == 0 and P.table_versions(spark, location) == {}


def test_gate_in_the_ordered_run(spark, lake):
    db, logs = fresh_name("s"), fresh_name("l")
    spec = PipelineSpec("shop", "items", "20240101",
                        IngestParams(db, "items", tuple(COLUMNS), "grp"), logs_db=logs, gate=SUITE)
    run_pipeline(spark, lake, _frame(spark, [(1, "a", "x")]), spec)
    spec.day = "20240102"
    with pytest.raises(QualityGateError):
        run_pipeline(spark, lake, _frame(spark, [(2, None, "x")]), spec)
    assert _rows(spark, f"{db}.items") == [(1, "a", "x")]
    done = spark.table(f"{logs}.bronze_to_silver").orderBy("start_exec").collect()
    assert [r.status for r in done] == ["success", "failed"]
    assert done[0].extras["rows"] == "1" and "publish_table" in done[1].error


def test_replaced_text_is_whole(spark, lake):
    path = f"{lake.root}/note.json"
    for text in ("first", "second, longer"):
        replace_text(spark, path, text)
        assert read_text(spark, path) == text
    write_text(spark, path, "third")
    assert read_text(spark, path) == "third"
