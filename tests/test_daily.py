"""The ordered daily run: a failing gated suite stops it before gold."""

import pytest

from strata.operators.quality import QualityGateError
from strata.params import GoldParams, IngestParams, QualityParams
from strata.plans.daily import GoldSpec, PipelineSpec, run_pipeline
from strata.session import fresh_name, storage_root


def _spec(db, gold_db, logs, suite):
    return PipelineSpec(
        source="shop", table="items", day="20240102",
        ingest=IngestParams(db, "items", (("id", "BIGINT"), ("name", "STRING"),
                                          ("grp", "STRING")), "grp"),
        golds=[GoldSpec(f"SELECT grp, count(*) AS n FROM {db}.items GROUP BY grp",
                        GoldParams(gold_db, "per_group"))],
        quality=QualityParams.from_dict(suite), logs_db=logs)


def test_gate_failure_stops_before_gold(spark, lake):
    rows = spark.createDataFrame([(1, "a", "x"), (2, None, "y")], "id BIGINT, name STRING, grp STRING")
    db, gold_db, logs = fresh_name("s"), fresh_name("g"), fresh_name("l")
    suite = {"quality_params": {"not_null": {"column": "name"}}, "stop_job": True}
    with pytest.raises(QualityGateError):
        run_pipeline(spark, lake, rows, _spec(db, gold_db, logs, suite))
    assert not spark.catalog.tableExists(f"{gold_db}.per_group")
    dq = spark.table(f"{logs}.data_quality").collect()[0]
    assert dq.status == "failed" and dq.error.endswith("step gate")
    assert spark.table(f"{logs}.quality_results").count() == 1


@pytest.mark.parametrize("balance", [False, True])
def test_passing_run_writes_every_layer(spark, lake, balance):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y"), (3, "c", "x")],
                                 "id BIGINT, name STRING, grp STRING")
    db, gold_db, logs = fresh_name("s"), fresh_name("g"), fresh_name("l")
    suite = {"quality_params": {"not_null": {"column": "name"}, "unique_vals": {"column": "id"}},
             "stop_job": True}
    spec = _spec(db, gold_db, logs, suite)
    spec.balance = balance
    result = run_pipeline(spark, lake, rows, spec)
    assert sorted(tuple(r) for r in result.golds[f"{gold_db}.per_group"].collect()) == [
        ("x", 2), ("y", 1)]
    assert all(r.success for r in result.quality_report.collect())
    jobs = {t: spark.table(f"{logs}.{t}").collect()[0].status
            for t in ("capture_api", "bronze_to_silver", "data_quality", "silver_to_gold")}
    assert set(jobs.values()) == {"success"}


def test_storage_root_is_the_shared_checkpoint_folder(spark):
    root = storage_root(spark)
    shared = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if shared:
        assert root.startswith(shared.rstrip("/"))
    assert storage_root(spark) == root
    assert fresh_name("x") != fresh_name("x")
