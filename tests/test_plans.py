"""Physical-plan properties the design relies on."""

from pyspark.sql import Observation

from strata.operators.quality import run_suite
from strata.operators.silver import conform_observed
from strata.plans import queries as Q
from strata.plans.inspect import count_nodes, plan_text
from strata.sources.landing import land_day, read_day

SF = "/root/testdata/sf0.001"


def test_partition_filter_reaches_the_scan(spark):
    plan = plan_text(Q.gold_partition_pruned(spark, SF))
    assert "PartitionFilters: [isnotnull(c_mktsegment" in plan
    assert "(c_mktsegment" in plan and "= BUILDING)" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string,c_acctbal:double>" in plan


def test_row_level_checks_share_one_scan(spark):
    df = Q._t(spark, SF, "customer")
    qp = {"quality_params": {
        "not_null": {"column": "c_custkey,c_name"},
        "value_lenght_btw": {"column": "c_name", "min": "1", "max": "30"},
        "values_btw": {"column": "c_acctbal", "min": "0", "max": "1"},
        "value_match_regex": {"column": "c_mktsegment", "regex": "^[A-Z]+$"},
        "date_mask_equal": {"column": "c_name", "date_mask": "%Y-%m-%d"},
        "df_count_btw": {"min": "1", "max": "10"}}}
    plan = plan_text(run_suite(df, qp))
    assert count_nodes(plan, "Scan parquet") == 1
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_unique_checks_share_one_shuffle(spark):
    df = Q._t(spark, SF, "orders")
    plan = plan_text(run_suite(df, {"quality_params": {
        "unique_vals": {"column": "o_orderkey,o_custkey,o_totalprice"}}}))
    assert count_nodes(plan, "Scan parquet") == 1
    assert plan.count("hashpartitioning(") == 1
    # map-side partial aggregation before the shuffle
    assert "partial_count" in plan


def test_partitioned_write_is_rebalanced(spark, lake):
    land_day(Q._t(spark, SF, "orders"), lake.bronze("t", "o"), "20240101")
    raw = read_day(spark, lake.bronze("t", "o"), "20240101")
    typed = conform_observed(raw, Q.ORDERS_SCHEMA, "o_orderstatus", Observation("p"))
    plan = plan_text(typed.hint("rebalance", "o_orderstatus"))
    assert "REBALANCE_PARTITIONS_BY_COL" in plan
    assert "CollectMetrics" in plan


def test_gold_join_broadcasts_small_dimensions(spark, lake):
    db = "plan_" + lake.root.rsplit("-", 1)[-1]
    logs = db + "_logs"
    Q._silver(spark, lake, Q._t(spark, SF, "customer"), "customer", Q.CUSTOMER_SCHEMA,
              "c_mktsegment", db, logs)
    Q._silver(spark, lake, Q._t(spark, SF, "nation"), "nation", Q.NATION_SCHEMA, None, db, logs)
    df = spark.sql(f"""SELECT c.c_custkey, n.n_name FROM {db}.customer c
                       JOIN {db}.nation n ON c.c_nationkey = n.n_nationkey""")
    plan = plan_text(df)
    assert "BroadcastHashJoin" in plan
    assert "ReadSchema: struct<c_custkey:bigint,c_nationkey:int>" in plan


def test_partitioned_write_is_salted_without_aqe(spark):
    from strata.operators.tables import spread_by_partition

    df = Q._t(spark, SF, "orders")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plan_text(spread_by_partition(df, ["o_orderstatus"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "hashpartitioning(o_orderstatus" in plan and "xxhash64" in plan


def test_salt_buckets_follow_the_session_setting(spark):
    from strata.operators.tables import SALT_BUCKETS_CONF, spread_by_partition

    df = Q._t(spark, SF, "orders")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set(SALT_BUCKETS_CONF, "500")
    try:
        plan = plan_text(spread_by_partition(df, ["o_orderstatus"]))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset(SALT_BUCKETS_CONF)
    assert ", 500)" in plan and "xxhash64" in plan


def test_backfilled_days_are_each_read_line_by_line(spark):
    from strata.sources.landing import is_single_line

    df = Q.bronze_backfill_days(spark, SF)
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    assert len(folders) == 30
    assert all(is_single_line(spark, d) for d in folders)
    assert df.count() == Q._t(spark, SF, "events").count()
