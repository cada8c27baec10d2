"""Registered queries: each operator of the pipeline run over the given tables.

Every query reads the parquet tables under ``sf_dir`` and runs the library's
real jobs on them (landing, binding, table writes, gold SQL, quality suites,
ledger). Queries that write use a fresh folder under the session's storage
root and their own database names, so repeated calls never collide.

``ORACLES`` holds, per query, an ANSI SQL text over the same tables that
states the expected result independently (DuckDB dialect).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lake import Lake
from ..operators.gold import gold_frame
from ..operators.ledger import step_stats
from ..operators.quality import gate, run_suite
from ..operators.silver import cast_losses, conform
from ..operators.tables import list_tables, table_columns
from ..params import GoldParams, IngestParams, ParamError, QualityParams
from ..session import fresh_name
from ..sources.landing import (land_by_day, land_day, landing_days, latest_day, read_day,
                               read_days)
from .jobs import bronze_to_silver, capture, silver_to_gold

DAY = "20240101"
NEXT_DAY = "20240102"

CUSTOMER_SCHEMA = (("c_custkey", "BIGINT"), ("c_name", "STRING"), ("c_nationkey", "INT"),
                   ("c_acctbal", "DOUBLE"), ("c_mktsegment", "STRING"))
ORDERS_SCHEMA = (("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"),
                 ("o_orderstatus", "STRING"), ("o_totalprice", "DOUBLE"),
                 ("o_orderdate", "TIMESTAMP_NTZ"), ("o_orderpriority", "STRING"))
PART_SCHEMA = (("p_partkey", "BIGINT"), ("p_name", "STRING"), ("p_brand", "STRING"),
               ("p_type", "STRING"), ("p_size", "INT"), ("p_retailprice", "DOUBLE"))
NATION_SCHEMA = (("n_nationkey", "INT"), ("n_name", "STRING"), ("n_regionkey", "INT"))
REGION_SCHEMA = (("r_regionkey", "INT"), ("r_name", "STRING"))
DOCUMENTS_SCHEMA = (("doc_id", "BIGINT"), ("text", "STRING"), ("lang", "STRING"),
                    ("source", "STRING"), ("n_chars", "BIGINT"))
LINEITEM_SCHEMA = (("l_orderkey", "BIGINT"), ("l_partkey", "BIGINT"), ("l_suppkey", "BIGINT"),
                   ("l_linenumber", "INT"), ("l_quantity", "DOUBLE"),
                   ("l_extendedprice", "DOUBLE"), ("l_discount", "DOUBLE"), ("l_tax", "DOUBLE"),
                   ("l_returnflag", "STRING"), ("l_linestatus", "STRING"),
                   ("l_shipdate", "TIMESTAMP_NTZ"))
EVENTS_JSON_SCHEMA = ("event_id BIGINT, ts STRING, user_id BIGINT, event_type STRING, "
                      "value DOUBLE, props STRING")
EVENTS_SCHEMA = (("event_id", "BIGINT"), ("ts", "TIMESTAMP_NTZ"), ("user_id", "BIGINT"),
                 ("event_type", "STRING"), ("value", "DOUBLE"), ("props", "STRING"),
                 ("ingest_date", "STRING"))

# Quality frames: defects injected by expression, the same text in Spark SQL
# and in the oracle (the given tables hold no NULLs).
DQ_CUSTOMER_SQL = """
SELECT c_custkey,
       CASE WHEN c_custkey % 7 = 0 THEN NULL
            WHEN c_custkey % 9 = 0 THEN lower(c_name)
            WHEN c_custkey % 10 = 3 THEN 'C' || CAST(c_custkey AS STRING)
            ELSE c_name END AS c_name,
       c_nationkey,
       CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal END AS c_acctbal,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_mktsegment END AS c_mktsegment,
       CASE WHEN c_custkey % 4 = 0 THEN CAST(c_custkey % 97 AS STRING)
            ELSE CAST(c_custkey AS STRING) END AS c_code
FROM customer
"""

DQ_ORDER_DAYS_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 13 = 0 THEN '2024-02-30'
            WHEN o_orderkey % 17 = 0 THEN 'n/a'
            WHEN o_orderkey % 19 = 0 THEN NULL
            WHEN o_orderkey % 23 = 0 THEN CAST(year(o_orderdate) AS STRING) || '-'
                 || CAST(month(o_orderdate) AS STRING) || '-' || CAST(day(o_orderdate) AS STRING)
            WHEN o_orderkey % 29 = 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10) || ' '
            ELSE substr(CAST(o_orderdate AS STRING), 1, 10) END AS order_day,
       CASE WHEN o_orderkey % 31 = 0 THEN CAST(year(o_orderdate) AS STRING)
                 || CAST(month(o_orderdate) AS STRING) || CAST(day(o_orderdate) AS STRING)
            ELSE CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100
                      + day(o_orderdate) AS STRING) END AS order_day_compact
FROM orders
"""

DQ_LINEITEM_SQL = """
SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_discount, l_returnflag, l_linestatus,
       substr(CAST(l_shipdate AS STRING), 1, 10) AS ship_day
FROM lineitem
"""

# The check names and parameter keys of the suites are fixed values.
LINEITEM_SUITE = {"quality_params": {
    "not_null": {"column": "l_orderkey,l_partkey,ship_day"},
    "unique_vals": {"column": "l_orderkey,l_partkey"},
    "values_btw": {"column": "l_discount,l_quantity", "min": "0,1", "max": "0.08,45"},
    "value_lenght_btw": {"column": "l_returnflag", "min": "1", "max": "1"},
    "value_match_regex": {"column": "l_linestatus", "regex": "^[OF]$"},
    "date_mask_equal": {"column": "ship_day", "date_mask": "%Y-%m-%d"},
    "df_count_btw": {"min": "1", "max": "1000000000"},
}}

NAME_REGEX = r"^Customer#0{3}\d{1,6}$"

SUITE = {"quality_params": {
    "not_null": {"column": "c_custkey,c_name,c_mktsegment"},
    "unique_vals": {"column": "c_custkey,c_code,c_acctbal"},
    "value_lenght_btw": {"column": "c_name,c_mktsegment", "min": "5,1", "max": "18,10"},
    "values_btw": {"column": "c_acctbal,c_nationkey", "min": "-500,0", "max": "9000,20"},
    "value_match_regex": {"column": "c_name", "regex": NAME_REGEX},
    "df_count_btw": {"min": "1", "max": "1000000"},
}}

CLEAN_SUITE = {"quality_params": {
    "not_null": {"column": "c_custkey,c_name,c_mktsegment"},
    "unique_vals": {"column": "c_custkey"},
    "value_lenght_btw": {"column": "c_name", "min": "18", "max": "18"},
    "df_count_btw": {"min": "1", "max": "100000000000"},
}, "stop_job": True}

# Balances per nation of two segments, with the customer that comes last by name.
GOLD_BALANCES_SQL = """
SELECT c_nationkey AS nation_key,
       count(*) AS customers,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18, 2))) AS DECIMAL(28, 2)) AS balance,
       max(c_name || ' / ' || c_mktsegment) AS last_customer
FROM {silver}.customer
WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')
GROUP BY c_nationkey
"""


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _views(spark: SparkSession, sf_dir: str, *names: str) -> None:
    for name in names:
        _t(spark, sf_dir, name).createOrReplaceTempView(name)


def _silver(spark: SparkSession, lake: Lake, records: DataFrame, table: str, schema,
            partition_column: str | None, db: str, logs_db: str, day: str = DAY,
            mode: str = "overwrite", source: str = "tpch") -> str:
    capture(spark, records, lake, source, table, day, logs_db=logs_db)
    params = IngestParams(db, table, tuple(schema), partition_column, mode)
    bronze_to_silver(spark, lake, source, table, day, params, logs_db=logs_db)
    return params.table


def _ctx(spark: SparkSession, label: str) -> tuple[Lake, str, str]:
    return Lake.fresh(spark, label), fresh_name("silver"), fresh_name("logs")


# --------------------------------------------------------------------------
# bronze


def bronze_csv_roundtrip(spark, sf_dir):
    lake = Lake.fresh(spark, "bronze_csv_roundtrip")
    base = lake.bronze("corpus", "documents")
    land_day(_t(spark, sf_dir, "documents"), base, DAY)
    return conform(read_day(spark, base, DAY), DOCUMENTS_SCHEMA)


def _events_as_text(spark, sf_dir):
    # timestamp_ntz -> text by cast: independent of the session time zone
    ev = _t(spark, sf_dir, "events")
    return ev.withColumn("ts", F.col("ts").cast("string"))


def _events_typed(raw: DataFrame) -> DataFrame:
    return raw.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "user_id",
                      "event_type", "value", "props")


def ingest_json_landing(spark, sf_dir):
    lake = Lake.fresh(spark, "ingest_json_landing")
    base = lake.bronze("app", "events")
    land_day(_events_as_text(spark, sf_dir), base, DAY, ext="json")
    return _events_typed(read_day(spark, base, DAY, ext="json", schema=EVENTS_JSON_SCHEMA))


def bronze_latest_day(spark, sf_dir):
    lake = Lake.fresh(spark, "bronze_latest_day")
    base = lake.bronze("app", "events")
    ev = _events_as_text(spark, sf_dir)
    land_by_day(ev, base, F.translate(F.substring("ts", 1, 10), "-", ""), ext="json")
    day = latest_day(spark, base)
    return _events_typed(read_day(spark, base, day, ext="json", schema=EVENTS_JSON_SCHEMA))


def bronze_backfill_days(spark, sf_dir):
    # a backfill: every day of the events landed at once as CSV, one folder per
    # day (each marked single-line when it can be), then all days read back
    # together with their day and bound to the declared types
    lake = Lake.fresh(spark, "bronze_backfill_days")
    base = lake.bronze("app", "events")
    land_by_day(_t(spark, sf_dir, "events"), base, F.date_format("ts", "yyyyMMdd"), ext="csv")
    return conform(read_days(spark, base, landing_days(spark, base)), EVENTS_SCHEMA)


# --------------------------------------------------------------------------
# silver


def _orders_with_rank(spark, sf_dir):
    o = _t(spark, sf_dir, "orders")
    return o.withColumn("o_priority_rank",
                        F.concat(F.substring("o_orderpriority", 1, 1), F.lit(".0")))


CAST_SCHEMA = (("o_orderkey", "BIGINT"), ("o_custkey", "BIGINT"), ("o_orderstatus", "STRING"),
               ("o_totalprice", "DOUBLE"), ("o_orderdate", "TIMESTAMP_NTZ"),
               ("o_orderpriority", "INT"), ("o_priority_rank", "INT"))


def silver_schema_cast(spark, sf_dir):
    lake = Lake.fresh(spark, "silver_schema_cast")
    base = lake.bronze("tpch", "orders")
    land_day(_orders_with_rank(spark, sf_dir), base, DAY)
    return conform(read_day(spark, base, DAY), CAST_SCHEMA)


def silver_cast_loss(spark, sf_dir):
    lake = Lake.fresh(spark, "silver_cast_loss")
    base = lake.bronze("tpch", "orders")
    land_day(_orders_with_rank(spark, sf_dir), base, DAY)
    return cast_losses(read_day(spark, base, DAY), CAST_SCHEMA)


def silver_missing_columns(spark, sf_dir):
    lake = Lake.fresh(spark, "silver_missing_columns")
    base = lake.bronze("tpch", "supplier")
    land_day(_t(spark, sf_dir, "supplier"), base, DAY)
    declared = (("s_suppkey", "BIGINT"), ("s_name", "STRING"), ("s_nationkey", "INT"),
                ("s_phone", "STRING"))
    return conform(read_day(spark, base, DAY), declared)


def silver_partition_last(spark, sf_dir):
    lake = Lake.fresh(spark, "silver_partition_last")
    base = lake.bronze("tpch", "orders")
    land_day(_t(spark, sf_dir, "orders"), base, DAY)
    return conform(read_day(spark, base, DAY), ORDERS_SCHEMA, "o_orderstatus")


def silver_partition_overwrite(spark, sf_dir):
    lake, db, logs = _ctx(spark, "silver_partition_overwrite")
    orders = _t(spark, sf_dir, "orders")
    table = _silver(spark, lake, orders, "orders", ORDERS_SCHEMA, "o_orderstatus", db, logs)
    changed = (orders.where(F.col("o_orderstatus") == "F")
               .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    _silver(spark, lake, changed, "orders", ORDERS_SCHEMA, "o_orderstatus", db, logs,
            day=NEXT_DAY)
    return spark.table(table)


def silver_lineitem_by_flag(spark, sf_dir):
    # each of the three return flags holds a third of the rows: the partitioned
    # write must spread every flag over several tasks
    lake, db, logs = _ctx(spark, "silver_lineitem_by_flag")
    table = _silver(spark, lake, _t(spark, sf_dir, "lineitem"), "lineitem", LINEITEM_SCHEMA,
                    "l_returnflag", db, logs)
    return spark.table(table)


def silver_append(spark, sf_dir):
    lake, db, logs = _ctx(spark, "silver_append")
    part = _t(spark, sf_dir, "part")
    table = _silver(spark, lake, part.where(F.col("p_size") <= 25), "part", PART_SCHEMA,
                    "p_brand", db, logs, mode="append")
    _silver(spark, lake, part.where(F.col("p_size") > 25), "part", PART_SCHEMA, "p_brand",
            db, logs, day=NEXT_DAY, mode="append")
    return spark.table(table)


# --------------------------------------------------------------------------
# gold


def gold_filtered_projection(spark, sf_dir):
    lake, db, logs = _ctx(spark, "gold_filtered_projection")
    part = _t(spark, sf_dir, "part")
    gaps = part.select(*[F.when(F.col("p_partkey") % n != 0, F.col(c)).otherwise(F.lit(None)).alias(c)
                         if n else F.col(c) for c, n in
                         {"p_partkey": 0, "p_name": 5, "p_brand": 0, "p_type": 7, "p_size": 0,
                          "p_retailprice": 11}.items()])
    _silver(spark, lake, gaps, "part", PART_SCHEMA, "p_brand", db, logs)
    sql = f"""
    SELECT p_partkey % 100 AS shelf, p_partkey AS item,
           CONCAT('size ', p_size, ': ', upper(p_type)) AS kind,
           CONCAT(p_retailprice, ' for ', p_name) AS offer,
           p_brand
    FROM {db}.part
    WHERE p_type IS NOT NULL AND p_size BETWEEN 5 AND 30
      AND (p_retailprice IS NULL OR p_retailprice > 950)"""
    return silver_to_gold(spark, lake, sql, GoldParams(fresh_name("gold"), "part_offers",
                                                       "shelf"), logs_db=logs)


def gold_alias_shadowing(spark, sf_dir):
    lake, db, logs = _ctx(spark, "gold_alias_shadowing")
    _silver(spark, lake, _t(spark, sf_dir, "customer"), "customer", CUSTOMER_SCHEMA,
            "c_mktsegment", db, logs)
    return gold_frame(spark, f"""
    SELECT c_custkey AS customer_id, c_name AS c_mktsegment, c_mktsegment AS segment
    FROM {db}.customer
    WHERE c_mktsegment = 'BUILDING'""")


def gold_partition_pruned(spark, sf_dir):
    lake, db, logs = _ctx(spark, "gold_partition_pruned")
    _silver(spark, lake, _t(spark, sf_dir, "customer"), "customer", CUSTOMER_SCHEMA,
            "c_mktsegment", db, logs)
    return gold_frame(spark, f"""
    SELECT c_custkey, c_name, c_acctbal, c_mktsegment
    FROM {db}.customer
    WHERE c_mktsegment = 'BUILDING'""")


def gold_joined_dataset(spark, sf_dir):
    lake, db, logs = _ctx(spark, "gold_joined_dataset")
    _silver(spark, lake, _t(spark, sf_dir, "customer"), "customer", CUSTOMER_SCHEMA,
            "c_mktsegment", db, logs)
    _silver(spark, lake, _t(spark, sf_dir, "nation"), "nation", NATION_SCHEMA, None, db, logs)
    _silver(spark, lake, _t(spark, sf_dir, "region"), "region", REGION_SCHEMA, None, db, logs)
    sql = f"""
    SELECT c.c_custkey AS customer_id, c.c_name AS customer_name, n.n_name AS nation,
           r.r_name AS region, c.c_acctbal AS balance, c.c_mktsegment AS segment
    FROM {db}.customer c
    JOIN {db}.nation n ON c.c_nationkey = n.n_nationkey
    JOIN {db}.region r ON n.n_regionkey = r.r_regionkey
    WHERE r.r_name = 'AMERICA'"""
    return silver_to_gold(spark, lake, sql, GoldParams(fresh_name("gold"), "customers_america",
                                                       "nation"), logs_db=logs)


def gold_write_readback(spark, sf_dir):
    lake, db, logs = _ctx(spark, "gold_write_readback")
    _silver(spark, lake, _t(spark, sf_dir, "orders"), "orders", ORDERS_SCHEMA,
            "o_orderstatus", db, logs)
    sql = f"""
    SELECT o_orderkey AS order_id, o_orderstatus AS status, o_custkey AS customer_id,
           o_orderdate AS order_date, o_totalprice AS total_price
    FROM {db}.orders"""
    return silver_to_gold(spark, lake, sql, GoldParams(fresh_name("gold"), "orders_by_status",
                                                       "status"), logs_db=logs)


# --------------------------------------------------------------------------
# data quality


def _dq_customer(spark, sf_dir):
    _views(spark, sf_dir, "customer")
    return gold_frame(spark, DQ_CUSTOMER_SQL)


def _dq_order_days(spark, sf_dir):
    _views(spark, sf_dir, "orders")
    return gold_frame(spark, DQ_ORDER_DAYS_SQL)


def dq_not_null(spark, sf_dir):
    return run_suite(_dq_customer(spark, sf_dir),
                     {"quality_params": {"not_null": {"column": "c_custkey,c_name,c_mktsegment,c_acctbal"}}})


def dq_unique(spark, sf_dir):
    return run_suite(_t(spark, sf_dir, "orders"),
                     {"quality_params": {"unique_vals": {"column": "o_orderkey,o_custkey"}}})


def dq_date_mask(spark, sf_dir):
    return run_suite(_dq_order_days(spark, sf_dir), {"quality_params": {"date_mask_equal": {
        "column": "order_day,order_day_compact", "date_mask": "%Y-%m-%d,%Y%m%d"}}})


def dq_value_length_between(spark, sf_dir):
    return run_suite(_dq_customer(spark, sf_dir), {"quality_params": {"value_lenght_btw": {
        "column": "c_name,c_mktsegment,c_code", "min": "5,1,1", "max": "18,10,2"}}})


def dq_values_between(spark, sf_dir):
    return run_suite(_dq_customer(spark, sf_dir), {"quality_params": {"values_btw": {
        "column": "c_acctbal,c_nationkey,c_custkey", "min": "-500,0,10", "max": "9000,20,1000"}}})


def dq_match_regex(spark, sf_dir):
    return run_suite(_dq_customer(spark, sf_dir), {"quality_params": {"value_match_regex": {
        "column": "c_name", "regex": NAME_REGEX}}})


def dq_row_count_between(spark, sf_dir):
    return run_suite(_t(spark, sf_dir, "lineitem"), {"quality_params": {"df_count_btw": {
        "min": "1,70000", "max": "100000,80000"}}})


def dq_suite_report(spark, sf_dir):
    return run_suite(_dq_customer(spark, sf_dir), SUITE)


def dq_lineitem_suite(spark, sf_dir):
    _views(spark, sf_dir, "lineitem")
    return run_suite(gold_frame(spark, DQ_LINEITEM_SQL), LINEITEM_SUITE)


def dq_gate(spark, sf_dir):
    return gate(run_suite(_dq_customer(spark, sf_dir), SUITE))


# --------------------------------------------------------------------------
# run ledger and catalog


def run_ledger(spark, sf_dir):
    lake, db, logs = _ctx(spark, "run_ledger")
    orders = _t(spark, sf_dir, "orders")
    _silver(spark, lake, orders, "orders", ORDERS_SCHEMA, "o_orderstatus", db, logs)
    no_schema = IngestParams("silver_tpch", "orders_untyped", (), "o_orderstatus")
    try:
        bronze_to_silver(spark, lake, "tpch", "orders", DAY, no_schema, logs_db=logs)
    except ParamError:
        pass  # the failed run is what the ledger must show
    ledger = spark.table(f"{logs}.capture_api").unionByName(
        spark.table(f"{logs}.bronze_to_silver"))
    return ledger.select("job_name", "status", "table_name", "source", "error", "error_desc",
                         F.col("extras")["rows"].cast("bigint").alias("rows_written"),
                         F.array_join(F.transform("steps", lambda s: s["step"]), ",")
                         .alias("step_names"),
                         (F.col("date_ref") == F.date_format("start_exec", "yyyy-MM-dd"))
                         .alias("dated_by_start"),
                         (F.col("end_exec") >= F.col("start_exec")).alias("ends_after_start"),
                         F.size(F.split("info", "\n")).alias("info_lines"))


def run_ledger_steps(spark, sf_dir):
    # Each event is one timed step of a run of job 'events': step = event type,
    # seconds = value. The step statistics are the ledger's analysis query.
    ev = _t(spark, sf_dir, "events")
    ledger = ev.select(F.lit("events").alias("job_name"),
                       F.array(F.struct(F.col("event_type").alias("step"),
                                        F.col("value").alias("seconds"))).alias("steps"))
    stats = step_stats(ledger)
    return stats.select("job_name", "step", "runs",
                        F.round("total_seconds", 6).alias("total_seconds"),
                        F.round("avg_seconds", 6).alias("avg_seconds"),
                        F.round("max_seconds", 6).alias("max_seconds"))


def table_catalog(spark, sf_dir):
    lake, db, logs = _ctx(spark, "table_catalog")
    made = [
        _silver(spark, lake, _t(spark, sf_dir, "customer"), "customer", CUSTOMER_SCHEMA,
                "c_mktsegment", db, logs),
        _silver(spark, lake, _t(spark, sf_dir, "orders"), "orders", ORDERS_SCHEMA,
                "o_orderstatus", db, logs),
        _silver(spark, lake, _t(spark, sf_dir, "nation"), "nation", NATION_SCHEMA, None,
                db, logs),
    ]
    assert spark.catalog.databaseExists(db)
    parts = []
    listed = {name for _, name in list_tables(spark, [db])}
    for table in made:
        assert table.split(".")[1] in listed
        cols = table_columns(spark, table)
        pcols = ",".join(name for name, _, is_partition in cols if is_partition) or None
        parts.append(spark.table(table).agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit("silver").alias("layer"), F.lit(table.split(".")[1]).alias("table_name"),
            F.lit(len(cols)).alias("n_columns"),
            F.lit(pcols).cast("string").alias("partition_column"), "row_count"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def layers_end_to_end(spark, sf_dir):
    """Flagship: capture -> silver -> gated quality suite -> gold."""
    from .daily import GoldSpec, PipelineSpec, run_pipeline

    lake, db, logs = _ctx(spark, "layers_end_to_end")
    spec = PipelineSpec(
        source="tpch", table="customer", day=DAY,
        ingest=IngestParams(db, "customer", CUSTOMER_SCHEMA, "c_mktsegment", "overwrite"),
        golds=[GoldSpec(GOLD_BALANCES_SQL.format(silver=db),
                        GoldParams(fresh_name("gold"), "balances", "nation_key"))],
        quality_sql=f"SELECT * FROM {db}.customer",
        quality=QualityParams.from_dict(CLEAN_SUITE),
        logs_db=logs,
    )
    result = run_pipeline(spark, lake, _t(spark, sf_dir, "customer"), spec)
    return next(iter(result.golds.values()))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bronze_csv_roundtrip": bronze_csv_roundtrip,
    "ingest_json_landing": ingest_json_landing,
    "bronze_latest_day": bronze_latest_day,
    "bronze_backfill_days": bronze_backfill_days,
    "silver_schema_cast": silver_schema_cast,
    "silver_cast_loss": silver_cast_loss,
    "silver_missing_columns": silver_missing_columns,
    "silver_partition_last": silver_partition_last,
    "silver_partition_overwrite": silver_partition_overwrite,
    "silver_append": silver_append,
    "silver_lineitem_by_flag": silver_lineitem_by_flag,
    "gold_filtered_projection": gold_filtered_projection,
    "gold_alias_shadowing": gold_alias_shadowing,
    "gold_partition_pruned": gold_partition_pruned,
    "gold_joined_dataset": gold_joined_dataset,
    "gold_write_readback": gold_write_readback,
    "dq_not_null": dq_not_null,
    "dq_unique": dq_unique,
    "dq_date_mask": dq_date_mask,
    "dq_value_length_between": dq_value_length_between,
    "dq_values_between": dq_values_between,
    "dq_match_regex": dq_match_regex,
    "dq_row_count_between": dq_row_count_between,
    "dq_suite_report": dq_suite_report,
    "dq_gate": dq_gate,
    "dq_lineitem_suite": dq_lineitem_suite,
    "run_ledger": run_ledger,
    "run_ledger_steps": run_ledger_steps,
    "table_catalog": table_catalog,
    "layers_end_to_end": layers_end_to_end,
}
