"""Run ledger rows and step statistics."""

import pytest

from strata.operators.ledger import LEDGER_SCHEMA, RunLedger, step_stats
from strata.params import IngestParams, ParamError
from strata.plans.jobs import bronze_to_silver, capture
from strata.session import fresh_name


def test_success_and_failure_rows(spark, lake):
    logs = fresh_name("logs")
    with RunLedger(spark, lake, "job_a", "t", "src", database=logs) as log:
        with log.step("one"):
            pass
        log.info("rows", 3)
    with pytest.raises(RuntimeError):
        with RunLedger(spark, lake, "job_a", "t", "src", database=logs) as log:
            with log.step("two"):
                raise RuntimeError("boom")
    rows = sorted(spark.table(f"{logs}.job_a").collect(), key=lambda r: r.status, reverse=True)
    ok, bad = rows
    assert ok.status == "success" and ok.error == "" and ok.extras == {"rows": "3"}
    assert [s.step for s in ok.steps] == ["one"] and ok.info.startswith("one:")
    assert bad.status == "failed" and bad.error == "Error while trying to execute the step two"
    assert bad.error_desc == "boom"
    assert len(ok.date_ref) == 10 and ok.end_exec >= ok.start_exec


def test_jobs_log_rows_counts_and_failures(spark, lake):
    logs = fresh_name("logs")
    db = fresh_name("silver")
    df = spark.createDataFrame([("1", "x"), ("2.0", "y"), ("bad", "x")], "a STRING, p STRING")
    capture(spark, df, lake, "s", "t", "20240101", logs_db=logs)
    bronze_to_silver(spark, lake, "s", "t", "20240101",
                     IngestParams(db, "t", (("a", "INT"), ("p", "STRING")), "p"), logs_db=logs)
    with pytest.raises(ParamError):
        bronze_to_silver(spark, lake, "s", "t", "20240101", IngestParams(db, "u", (), "p"),
                         logs_db=logs)
    cap = spark.table(f"{logs}.capture_api").collect()
    assert cap[0].extras["rows"] == "3"
    b2s = {r.status: r for r in spark.table(f"{logs}.bronze_to_silver").collect()}
    assert b2s["success"].extras["rows"] == "3" and b2s["success"].extras["lost:a"] == "1"
    assert b2s["failed"].error.endswith("cast_df")


def test_step_stats(spark):
    rows = [("j", [("read", 1.0), ("write", 2.0)]), ("j", [("read", 3.0)]),
            ("k", [("read", 5.0)])]
    df = spark.createDataFrame(rows, "job_name STRING, steps ARRAY<STRUCT<step:STRING,seconds:DOUBLE>>")
    got = {(r.job_name, r.step): (r.runs, r.total_seconds, r.avg_seconds, r.max_seconds)
           for r in step_stats(df).collect()}
    assert got == {("j", "read"): (2, 4.0, 2.0, 3.0), ("j", "write"): (1, 2.0, 2.0, 2.0),
                   ("k", "read"): (1, 5.0, 5.0, 5.0)}


def test_schema_has_original_columns_first():
    assert [f.name for f in LEDGER_SCHEMA.fields][:10] == [
        "start_exec", "job_name", "status", "table_name", "source", "info", "error",
        "error_desc", "date_ref", "end_exec"]


@pytest.mark.parametrize("ext", ["csv", "json"])
def test_empty_day_binds_and_logs_no_made_up_count(spark, lake, ext):
    logs = fresh_name("logs")
    empty = spark.createDataFrame([], "a STRING, p STRING")
    capture(spark, empty, lake, "s", "e", "20240101", ext=ext, logs_db=logs)
    out = bronze_to_silver(spark, lake, "s", "e", "20240101",
                           IngestParams(fresh_name("db"), "e", (("a", "INT"), ("p", "STRING")),
                                        "p", ext=ext), logs_db=logs)
    assert out.count() == 0 and out.columns == ["a", "p"]
    rows = spark.table(f"{logs}.bronze_to_silver").collect()
    # no task ran, so nothing was counted: unknown, not zero
    assert rows[0].status == "success" and rows[0].extras["rows"] in (None, "0")


def test_headerless_csv_binds_by_declared_order(spark, lake):
    logs = fresh_name("logs")
    df = spark.createDataFrame([("1", "x", "extra")], "c STRING, d STRING, e STRING")
    capture(spark, df, lake, "s", "nohdr", "20240101", logs_db=logs)
    # re-land the same rows without a header line
    from strata.sources.landing import land_day
    land_day(df, lake.bronze("s", "nohdr"), "20240101", header=False)
    out = bronze_to_silver(spark, lake, "s", "nohdr", "20240101",
                           IngestParams(fresh_name("db"), "t",
                                        (("a", "INT"), ("b", "STRING"), ("z", "DOUBLE")),
                                        None, header=False), logs_db=logs)
    assert [tuple(r) for r in out.collect()] == [(1, "x", None)]
