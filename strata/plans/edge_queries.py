"""Registered queries over deliveries that are out of order, cut or unusual.

Days whose files have other columns or another order, malformed records, days
delivered apart, single columns with gaps, numbers in other notations, bounds
beyond a column's type, and the four jobs driven by files alone. ``EDGE_ORACLES``
states each result as DuckDB SQL over the given tables, without the rules the
library applies (no shared expressions).
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lake import Lake, write_text
from ..operators.gold import gold_frame
from ..operators.quality import run_suite
from ..operators.silver import conform
from ..params import IngestParams
from ..session import fresh_name
from ..sources.landing import (day_dir, land_by_day, land_day, landing_days, read_day, read_days)
from .files import capture_from_files
from .jobs import bronze_to_silver, capture
from .oracles import _row, _union, _values
from .queries import DAY, EVENTS_SCHEMA, _ctx, _t, _views

STATIC_MODE = "spark.sql.sources.partitionOverwriteMode"


def bronze_drifted_days(spark, sf_dir):
    """Days with the same columns in another order, with columns missing and with
    others; two days are delivered by another producer, one of them as two sets
    of files with different headers."""
    base = Lake.fresh(spark, "bronze_drifted_days").bronze("app", "events")
    events = _t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    part = [events.where(F.col("event_id") % 5 == k) for k in range(5)]
    names = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    land_day(part[0].select(names), base, "20240101")
    land_day(part[1].select(names[::-1]), base, "20240102")
    land_day(part[2].select("ts", F.lit("x").alias("extra"), "event_type", "event_id", "user_id"),
             base, "20240103")
    foreign = {"sep": ";", "header": "true", "quote": '"', "escape": '"'}
    part[3].select(names[3:] + names[:3]).write.options(**foreign).csv(day_dir(base, "20240104"))
    for order in (names, ["props", "ts", "value", "event_id", "user_id", "event_type"]):
        half = part[4].where((F.col("user_id") % 2 == 0) == F.lit(order is names))
        half.select(order).write.mode("append").options(**foreign).csv(day_dir(base, "20240105"))
    return conform(read_days(spark, base, landing_days(spark, base)), EVENTS_SCHEMA)


def bronze_two_deliveries(spark, sf_dir):
    """Days landed in two deliveries while the session overwrites statically."""
    base = Lake.fresh(spark, "bronze_two_deliveries").bronze("app", "events")
    events = _t(spark, sf_dir, "events")
    before = spark.conf.get(STATIC_MODE)
    spark.conf.set(STATIC_MODE, "static")
    try:
        for odd in (1, 0):
            land_by_day(events.where(F.dayofmonth("ts") % 2 == odd), base,
                        F.date_format("ts", "yyyyMMdd"), ext="csv")
    finally:
        spark.conf.set(STATIC_MODE, before)
    return conform(read_days(spark, base, landing_days(spark, base)), EVENTS_SCHEMA)


def bronze_single_column(spark, sf_dir):
    """A delivery of one column with gaps."""
    base = Lake.fresh(spark, "bronze_single_column").bronze("crm", "segments")
    segment = F.when(F.col("c_custkey") % 7 != 0, F.col("c_mktsegment")).alias("segment")
    land_day(_t(spark, sf_dir, "customer").select(segment), base, DAY)
    return read_day(spark, base, DAY)


def capture_malformed_json(spark, sf_dir):
    """JSON lines of which some are cut off: the others arrive, those are counted."""
    lake, db, logs = _ctx(spark, "capture_malformed_json")
    base = lake.root + "/job"
    talk = _t(spark, sf_dir, "conversations")
    line = F.to_json(F.struct(*talk.columns))
    cut = (F.col("conv_id") * 7 + F.col("turn")) % 11 == 0
    (talk.select(F.when(cut, F.substring(line, 1, 15)).otherwise(line).alias("value"))
     .write.text(base + "/delivery"))
    write_text(spark, f"{base}/params/app/talk.json", json.dumps({
        "target_schema": db, "target_table": "talk", "mode": "overwrite",
        "schema": {"conv_id": "BIGINT", "turn": "INT", "role": "STRING", "text": "STRING"}}))
    capture_from_files(spark, lake, base, "app", "talk", DAY, base + "/delivery", logs_db=logs,
                       quarantine=True)
    params = IngestParams(db, "talk", (("conv_id", "BIGINT"), ("turn", "INT"), ("role", "STRING"),
                                       ("text", "STRING")))
    rows = bronze_to_silver(spark, lake, "app", "talk", DAY, params, logs_db=logs)
    logged = spark.table(f"{logs}.capture_api").first()
    return rows.withColumn("malformed", F.lit(int(logged.extras["malformed"])).cast("bigint"))


NUMERIC_SCHEMA = (("o_orderkey", "BIGINT"), ("big_long", "BIGINT"), ("big_text", "STRING"),
                  ("big_decimal", "DECIMAL(20,2)"), ("small_text", "STRING"),
                  ("small_double", "DOUBLE"), ("flag", "BOOLEAN"), ("day", "DATE"),
                  ("at", "TIMESTAMP_NTZ"))


def silver_numeric_text(spark, sf_dir):
    """Doubles whose usual text has an exponent, and text of other types."""
    lake, db, logs = _ctx(spark, "silver_numeric_text")
    big = (F.floor("o_totalprice") * 10000).cast("double")
    small = (F.col("o_orderkey") % 997 + 1).cast("double") / 1e6
    kind = F.col("o_orderkey") % 3
    rows = _t(spark, sf_dir, "orders").select(
        "o_orderkey", big.alias("big_long"), big.alias("big_text"), big.alias("big_decimal"),
        small.alias("small_text"), small.alias("small_double"),
        F.when(kind == 0, "true").when(kind == 1, "False").otherwise("perhaps").alias("flag"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("at"))
    capture(spark, rows, lake, "shop", "numbers", DAY, logs_db=logs)
    return bronze_to_silver(spark, lake, "shop", "numbers", DAY,
                            IngestParams(db, "numbers", NUMERIC_SCHEMA), logs_db=logs)


def dq_exact_bounds(spark, sf_dir):
    """Bounds with fractions or beyond the range of the column's type."""
    orders = _t(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("int").alias("cust"), F.col("o_orderkey").alias("okey"),
        (F.col("o_custkey") % 100).cast("tinyint").alias("tiny"),
        F.col("o_totalprice").cast("decimal(12,1)").alias("price"))
    return run_suite(orders, {"quality_params": {"values_btw": {
        "column": "cust,cust,okey,tiny,price",
        "min": "0.5,0,-1e30,10.5,1000.04", "max": "33.5,3000000000,99.99,1000,200000.06"}}})


DAY_OF_YEAR_SQL = """
SELECT o_orderkey,
       CASE WHEN o_orderkey % 13 = 0 THEN '9999-366'
            WHEN o_orderkey % 17 = 0 THEN '2024-000'
            WHEN o_orderkey % 19 = 0 THEN NULL
            WHEN o_orderkey % 23 = 0 THEN '2024-367'
            WHEN o_orderkey % 29 = 0 THEN '2023-366'
            ELSE CAST(year(o_orderdate) AS STRING) || '-'
                 || CAST(dayofyear(o_orderdate) AS STRING) END AS day,
       CASE WHEN o_orderkey % 7 = 0 THEN '+24:00'
            WHEN o_orderkey % 11 = 0 THEN '+01:3015'
            WHEN o_orderkey % 5 = 0 THEN 'Z'
            ELSE '-0' || CAST(o_orderkey % 10 AS STRING) || '30' END AS zone
FROM orders
"""


def dq_day_of_year_mask(spark, sf_dir):
    """Masks with the day of the year and with a zone offset."""
    _views(spark, sf_dir, "orders")
    return run_suite(gold_frame(spark, DAY_OF_YEAR_SQL), {"quality_params": {"date_mask_equal": {
        "column": "day,zone", "date_mask": "%Y-%j,%z"}}})


def file_driven_run(spark, sf_dir):
    """The four jobs by name, from parameter and SQL files in the lake alone."""
    from .cli import main

    lake, silver, logs = _ctx(spark, "file_driven_run")
    gold, base = fresh_name("gold"), lake.root + "/job"
    parts = _t(spark, sf_dir, "part")
    parts.write.json(base + "/delivery")
    declared = {"p_partkey": "BIGINT", "p_name": "STRING", "p_brand": "STRING",
                "p_retailprice": "DECIMAL(12,2)", "p_size": "INT"}
    files = {
        "params/shop/part.json": json.dumps({
            "target_schema": silver, "target_table": "part", "schema": declared,
            "partition_column": "p_brand"}),
        "params/silver/brands.json": json.dumps({
            "target_schema": gold, "target_table": "brands"}),
        "params/quality/part.json": json.dumps({"quality_params": {
            "unique_vals": {"column": "p_partkey"}}, "materialize": True, "stop_job": True}),
        "query/gold/by_size.sql":
            f"SELECT p_size, count(*) AS parts, min(p_retailprice) AS cheapest, "
            f"max(p_name) AS last_name FROM {silver}.part GROUP BY p_size;",
        "query/quality/part.sql": f"SELECT * FROM {silver}.part"}
    for name, text in files.items():
        write_text(spark, f"{base}/{name}", text)
    common = ["--base", base, "--lake", lake.root, "--logs-db", logs, "--day", DAY]
    for job in (["capture", "--source", "shop", "--table", "part", "--records",
                 base + "/delivery"],
                ["bronze_to_silver", "--source", "shop", "--table", "part"],
                ["data_quality", "--table", "part"],
                ["silver_to_gold", "--table", "brands", "--sql-name", "by_size"]):
        if main([*job, *common], spark):
            raise RuntimeError(f"{job[0]} did not pass")
    return spark.table(f"{gold}.brands")


EDGE_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        bronze_drifted_days, bronze_two_deliveries, bronze_single_column, capture_malformed_json,
        silver_numeric_text, dq_exact_bounds, dq_day_of_year_mask, file_driven_run)
}

EDGE_ORACLES: dict[str, str] = {
    "bronze_drifted_days": """
        SELECT event_id, ts, user_id, event_type,
               CASE WHEN event_id % 5 <> 2 THEN value END AS value,
               CASE WHEN event_id % 5 <> 2 THEN props END AS props,
               '2024010' || CAST(event_id % 5 + 1 AS VARCHAR) AS ingest_date
        FROM events""",
    "bronze_two_deliveries": """
        SELECT event_id, ts, user_id, event_type, value, props,
               strftime(ts, '%Y%m%d') AS ingest_date
        FROM events""",
    "bronze_single_column": """
        SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_mktsegment END AS segment FROM customer""",
    "capture_malformed_json": """
        SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS INTEGER) AS turn, role, text,
               (SELECT count(*) FROM conversations WHERE (conv_id * 7 + turn) % 11 = 0)
                 AS malformed
        FROM conversations WHERE (conv_id * 7 + turn) % 11 <> 0""",
    "silver_numeric_text": """
        WITH b AS (SELECT *, CAST(floor(o_totalprice) AS BIGINT) * 10000 AS big,
                          CAST(o_orderkey % 997 + 1 AS BIGINT) AS k FROM orders)
        SELECT o_orderkey, big AS big_long, CAST(big AS VARCHAR) || '.0' AS big_text,
               CAST(big AS DECIMAL(20,2)) AS big_decimal,
               '0.' || rtrim(lpad(CAST(k AS VARCHAR), 6, '0'), '0') AS small_text,
               k / 1e6 AS small_double,
               CASE o_orderkey % 3 WHEN 0 THEN true WHEN 1 THEN false END AS flag,
               CAST(o_orderdate AS DATE) AS day, date_trunc('second', o_orderdate) AS at
        FROM b""",
    "dq_exact_bounds": """
        WITH src AS (SELECT CAST(o_custkey AS INTEGER) AS cust, o_orderkey AS okey,
                            CAST(o_custkey % 100 AS INTEGER) AS tiny,
                            CAST(o_totalprice AS DECIMAL(12,1)) AS price FROM orders)
        """ + _union(
        _values(0, "cust", 0.5, 33.5), _values(1, "cust", 0, 3000000000),
        _values(2, "okey", "-1e30", 99.99), _values(3, "tiny", 10.5, 1000),
        _values(4, "price", 1000.04, 200000.06)),
    "dq_day_of_year_mask": f"WITH src AS ({DAY_OF_YEAR_SQL})\n" + _union(
        _row(0, "day", "date_mask_equal", "Date mask with mask %Y-%j", "count(day)",
             "count(*) FILTER (WHERE day IN ('9999-366', '2024-000', '2024-367'))"),
        _row(1, "zone", "date_mask_equal", "Date mask with mask %z", "count(zone)",
             "count(*) FILTER (WHERE zone IN ('+24:00', '+01:3015'))")),
    "file_driven_run": """
        SELECT CAST(p_size AS INTEGER) AS p_size, count(*) AS parts,
               min(CAST(p_retailprice AS DECIMAL(12,2))) AS cheapest, max(p_name) AS last_name
        FROM part GROUP BY p_size""",
}
