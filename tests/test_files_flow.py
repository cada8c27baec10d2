"""File-driven jobs in the params/ + query/ layout, on the orders table."""

import json

import pytest
from pyspark.sql import functions as F

from strata.lake import write_text
from strata.params import ParamError
from strata.plans.files import (capture_from_files, gold_from_files, quality_from_files,
                                silver_from_files)
from strata.session import fresh_name

DAY = "20240105"
SF = "/root/testdata/sf0.001"

# Declared with one column the delivery lacks; the delivery has one more.
DECLARED = {"o_orderkey": "BIGINT", "o_custkey": "INT", "o_totalprice": "DECIMAL(12,2)",
            "o_orderdate": "DATE", "o_clerk": "STRING", "o_orderstatus": "STRING"}
GOLD = """
SELECT year(o_orderdate) AS order_year, count(*) AS orders, sum(o_totalprice) AS revenue,
       o_orderstatus
FROM {silver}.orders_in
WHERE o_totalprice > 1000
GROUP BY year(o_orderdate), o_orderstatus;
"""
CHECKS = {"unique_vals": {"column": "o_orderkey"},
          "values_btw": {"column": "o_totalprice", "min": "0.5", "max": "9e9"},
          "not_null": {"column": "o_custkey,o_clerk"}}


def orders(spark):
    """The delivery: keys and amounts as JSON would carry them, the date as text."""
    return spark.read.parquet(f"{SF}/orders.parquet").select(
        "o_orderkey", "o_custkey", "o_totalprice",
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_orderstatus",
        F.array("o_orderpriority").alias("tags"))


def layout(spark, base: str, silver: str, gold: str, **silver_params):
    """Write the parameter and SQL files through the session's file system."""
    files = {
        "params/shop/orders.json": json.dumps({
            "target_schema": silver, "target_table": "orders_in", "schema": DECLARED,
            "partition_column": "o_orderstatus", "mode": "overwrite", **silver_params}),
        "params/silver/revenue.json": json.dumps({
            "target_schema": gold, "target_table": "revenue",
            "partition_column": "o_orderstatus", "mode": "overwrite"}),
        "params/quality/orders_in.json": json.dumps({"quality_params": CHECKS}),
        "query/gold/revenue.sql": GOLD.format(silver=silver),
        "query/quality/orders_in.sql": f"select * from {silver}.orders_in;"}
    for name, text in files.items():
        write_text(spark, f"{base}/{name}", text)


@pytest.fixture()
def shop(spark, lake):
    base, silver, gold, logs = lake.root + "/job", *map(fresh_name, ("silver", "gold", "logs"))
    layout(spark, base, silver, gold)
    orders(spark).write.json(base + "/delivery")
    return base, silver, gold, logs


def test_delivered_json_to_gold_and_quality(spark, lake, shop):
    base, _, _, logs = shop
    capture_from_files(spark, lake, base, "shop", "orders", DAY, base + "/delivery", logs_db=logs)
    silver = silver_from_files(spark, lake, base, "shop", "orders", DAY, logs_db=logs)
    assert silver.columns == [*(c for c in DECLARED if c != "o_orderstatus"), "o_orderstatus"]
    want = orders(spark).select("o_orderkey", "o_custkey",
                                F.col("o_totalprice").cast("decimal(12,2)"),
                                F.col("o_orderdate").cast("date"),
                                F.lit(None).cast("string"), "o_orderstatus")
    assert silver.exceptAll(want).count() == 0 and silver.count() == want.count()
    gold = gold_from_files(spark, lake, base, "revenue", logs_db=logs)
    year = F.year(F.col("o_orderdate").cast("date"))
    expected = (want.toDF(*DECLARED).where("o_totalprice > 1000")
                .groupBy(year.alias("y"), "o_orderstatus").agg(F.count("*").alias("n")))
    assert {(r.order_year, r.o_orderstatus, r.orders) for r in gold.collect()} == {
        tuple(r) for r in expected.collect()}
    report = quality_from_files(spark, lake, base, "orders_in", logs_db=logs).collect()
    assert {(r.check_name, r.column_name): r.status for r in report} == {
        ("unique_vals", "o_orderkey"): "Success", ("values_btw", "o_totalprice"): "Success",
        ("not_null", "o_custkey"): "Success", ("not_null", "o_clerk"): "Failed"}
    ran = spark.table(f"{logs}.bronze_to_silver").first()
    assert ran.extras["rows"] == str(want.count())


def test_malformed_lines_fail_or_are_set_aside(spark, lake, shop):
    base, _, _, logs = shop
    lines = spark.read.text(base + "/delivery")
    cut = F.when(F.crc32(F.col("value").cast("binary")) % 9 == 0,
                 F.expr("substr(value, 1, length(value) - 7)")).otherwise(F.col("value"))
    lines.select(cut.alias("value")).write.text(base + "/cut")
    bad = lines.where(F.crc32(F.col("value").cast("binary")) % 9 == 0).count()
    assert bad > 0
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        capture_from_files(spark, lake, base, "shop", "orders", DAY, base + "/cut", logs_db=logs)
    assert spark.table(f"{logs}.capture_api").first().status == "failed"
    capture_from_files(spark, lake, base, "shop", "orders", DAY, base + "/cut", logs_db=logs,
                       quarantine=True)
    done = spark.table(f"{logs}.capture_api").where("status = 'success'").first()
    assert done.extras["malformed"] == str(bad)
    silver = silver_from_files(spark, lake, base, "shop", "orders", DAY, logs_db=logs)
    assert silver.count() == lines.count() - bad
    assert silver.where("o_orderkey is null").count() == 0


def test_malformed_landed_json_fails_the_silver_job(spark, lake, shop):
    base, silver, gold, logs = shop
    layout(spark, base, silver, gold, ext="json")
    write_text(spark, f"{lake.bronze('shop', 'orders')}/ingest_date={DAY}/a.json",
               '{"o_orderkey": 1, "o_orderstatus": "F"}\n{"o_orderkey": 2, "o_or')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        silver_from_files(spark, lake, base, "shop", "orders", DAY, logs_db=logs)
    assert spark.table(f"{logs}.bronze_to_silver").first().status == "failed"


@pytest.mark.parametrize("sep, header", [(";", True), ("|", True), ("|", False)])
def test_delivered_csv_has_the_declared_separator(spark, lake, shop, sep, header):
    base, silver, gold, logs = shop
    layout(spark, base, silver, gold, sep=sep, header=header)
    df = orders(spark).select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
                              F.lit("c").alias("o_clerk"), "o_orderstatus")
    df.write.options(sep=sep, header=str(header).lower()).csv(base + "/csv")
    capture_from_files(spark, lake, base, "shop", "orders", DAY, base + "/csv", "csv",
                       logs_db=logs)
    got = silver_from_files(spark, lake, base, "shop", "orders", DAY, logs_db=logs)
    assert got.where("o_orderkey is null or o_totalprice is null").count() == 0
    assert got.count() == df.count()


def test_a_day_without_any_declared_column_is_refused(spark, lake, shop):
    base, silver, gold, logs = shop
    layout(spark, base, silver, gold, sep="|")
    spark.createDataFrame([(1, 2)], "a INT, b INT").write.option("header", "true").csv(base + "/x")
    capture_from_files(spark, lake, base, "shop", "orders", DAY, base + "/x", "csv", logs_db=logs)
    with pytest.raises(ParamError, match="none of the declared"):
        silver_from_files(spark, lake, base, "shop", "orders", DAY, logs_db=logs)


def test_materialized_suite_leaves_no_files(spark, lake, shop):
    base, _, _, logs = shop
    capture_from_files(spark, lake, base, "shop", "orders", DAY, base + "/delivery", logs_db=logs)
    silver_from_files(spark, lake, base, "shop", "orders", DAY, logs_db=logs)
    plain = quality_from_files(spark, lake, base, "orders_in", logs_db=logs).collect()
    write_text(spark, f"{base}/params/quality/orders_in.json",
               json.dumps({"quality_params": CHECKS, "materialize": True}))
    again = quality_from_files(spark, lake, base, "orders_in", logs_db=logs).collect()
    assert sorted(map(tuple, plain)) == sorted(map(tuple, again))
    from strata.lake import subdirectories
    assert subdirectories(spark, f"{lake.root}/_runs") == []
