"""Registered queries: large and foreign deliveries, gated and resumed runs.

Multi-line CSV read in byte ranges, files with headers of their own, rows that are
published only after their checks, runs that go on after failures, and the
formats, codecs and places of tables. ``DELIVERY_ORACLES`` states each result as
DuckDB SQL over the given tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import column
from ..lake import Lake
from ..operators.gold import gold_frame
from ..operators.ledger import step_stats
from ..operators.quality import QualityGateError, run_suite
from ..operators.runs import Job, ResumableRun, attempts_of
from ..operators.silver import conform
from ..params import GoldParams, IngestParams
from ..session import fresh_name
from ..sources.landing import land_day, read_csv
from ..sources.schema_state import load_state, read_union
from .daily import GoldSpec, PipelineSpec, run_pipeline
from .files import split_records
from .jobs import bronze_to_silver, capture, data_quality, silver_to_gold
from .oracles import _count, _not_null, _regex, _row, _union, _unique, _values
from .queries import (CUSTOMER_SCHEMA, DAY, EVENTS_SCHEMA, NATION_SCHEMA, NEXT_DAY, ORDERS_SCHEMA,
                      PART_SCHEMA, _ctx, _t, _views)

TEXT_SCHEMA = (("doc_id", "BIGINT"), ("text", "STRING"), ("source", "STRING"))
FOREIGN = {"sep": ";", "header": "true", "quote": '"', "escape": '"'}


def bronze_split_multiline(spark, sf_dir):
    """Texts full of line breaks, quotes and separators, in files of any size, read in
    ranges of 64 KB."""
    base = Lake.fresh(spark, "bronze_split_multiline").bronze("web", "documents")
    docs = _t(spark, sf_dir, "documents").select(
        "doc_id", F.concat("text", F.lit('\n"'), "lang", F.lit('";;""\n')).alias("text"), "source")
    folder = land_day(docs, base, DAY, max_records_per_file=0)
    return conform(read_csv(spark, folder, range_bytes=64 << 10), TEXT_SCHEMA)


def bronze_foreign_headers(spark, sf_dir):
    """One folder of files of another producer: orders of columns, missing and further
    ones, and a header with a line break and quotes in a name."""
    folder = Lake.fresh(spark, "bronze_foreign_headers").bronze("app", "foreign")
    events = _t(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("string"))
    part = [events.where(F.col("event_id") % 4 == k) for k in range(4)]
    odd = 'user\n"id"'
    names = ["event_id", "ts", "user_id", "event_type", "value", "props"]
    for df in (part[0].select(names), part[1].select(names[::-1]),
               part[2].withColumnRenamed("user_id", odd).select(odd, *names[:2], *names[3:]),
               part[3].select("props", F.lit("x;\ny").alias("extra"), "event_id", "ts")):
        df.write.mode("append").options(**FOREIGN).csv(folder)
    rows = read_csv(spark, folder)
    user = F.coalesce("user_id", column(odd))
    return conform(rows.withColumn("user_id", user), EVENTS_SCHEMA[:-1])


def run_headerless(spark, sf_dir):
    """The ordered run of a source whose files have no header line."""
    lake, db, logs = _ctx(spark, "run_headerless")
    spec = PipelineSpec("shop", "orders", DAY, IngestParams(db, "orders", ORDERS_SCHEMA,
                                                            "o_orderstatus", header=False),
                        logs_db=logs)
    return run_pipeline(spark, lake, _t(spark, sf_dir, "orders"), spec).silver


KEYS = {"event_id": "event id", "user_id": "user:id", "event_type": "type.name", "value": "a;b"}


def capture_json_any_keys(spark, sf_dir):
    """JSON lines without a declared schema whose keys hold blanks, colons, dots and
    separators; some lines are cut off and set aside."""
    lake, db, logs = _ctx(spark, "capture_json_any_keys")
    events = _t(spark, sf_dir, "events")
    line = F.to_json(F.struct(*[F.col(c).alias(k) for c, k in KEYS.items()]))
    cut = F.col("event_id") % 13 == 5
    (events.select(F.when(cut, F.substring(line, 1, 12)).otherwise(line).alias("value"))
     .write.text(lake.root + "/delivery"))
    good, bad, seen = split_records(spark, lake.root + "/delivery")
    capture(spark, good, lake, "app", "keys", DAY, logs_db=logs, malformed=bad,
            malformed_seen=seen)
    schema = tuple((KEYS[c], t) for c, t in EVENTS_SCHEMA if c in KEYS)
    rows = bronze_to_silver(spark, lake, "app", "keys", DAY, IngestParams(db, "keys", schema),
                            logs_db=logs)
    malformed = int(spark.table(f"{logs}.capture_api").first().extras["malformed"])
    return rows.select(*[column(k).alias(c) for c, k in KEYS.items()],
                       F.lit(malformed).cast("bigint").alias("malformed"))


CUSTOMER_GATE = {"quality_params": {"not_null": {"column": "c_name"},
                                    "values_btw": {"column": "c_acctbal", "min": "-5000",
                                                   "max": "100000"}}}


def silver_gated_publish(spark, sf_dir):
    """Three days with a gate before the rows are visible: a good one, one that fails (all of
    it stays out), and a good one that replaces some partitions."""
    lake, db, logs = _ctx(spark, "silver_gated_publish")
    customer = _t(spark, sf_dir, "customer")
    params = IngestParams(db, "customer", CUSTOMER_SCHEMA, "c_mktsegment")

    def day(rows: DataFrame, name: str) -> DataFrame:
        capture(spark, rows, lake, "crm", "customer", name, logs_db=logs)
        return bronze_to_silver(spark, lake, "crm", "customer", name, params, logs_db=logs,
                                gate=CUSTOMER_GATE)

    day(customer, DAY)
    spoilt = customer.withColumn("c_name", F.when(F.col("c_custkey") % 50 != 1, F.lit("spoilt")))
    try:
        day(spoilt, NEXT_DAY)
    except QualityGateError:
        pass
    else:
        raise AssertionError("the gate let a spoilt day through")
    later = (customer.where(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
                            & (F.col("c_custkey") % 2 == 0))
             .withColumn("c_nationkey", F.col("c_nationkey") + 100))
    rows = day(later, "20240103")
    failed = spark.table(f"{logs}.bronze_to_silver").where("status = 'failed'").count()
    return rows.withColumn("failed_runs", F.lit(failed).cast("bigint"))


def run_resume(spark, sf_dir):
    """A run whose second job fails twice: the first is done once, the second at the third
    attempt, and a second call of the run does nothing."""
    lake, db, logs = _ctx(spark, "run_resume")
    part = _t(spark, sf_dir, "part")
    calls = {"capture": 0, "silver": 0}
    params = IngestParams(db, "part", PART_SCHEMA, mode="append")

    def landing(_: str) -> str:
        calls["capture"] += 1
        return capture(spark, part, lake, "shop", "part", DAY, logs_db=logs)

    def silver(_: str) -> str:
        calls["silver"] += 1
        if calls["silver"] < 3:
            raise OSError("not yet")
        bronze_to_silver(spark, lake, "shop", "part", DAY, params, logs_db=logs)
        return params.table

    jobs = [Job("capture", landing), Job("bronze_to_silver", silver)]
    for _ in range(2):
        run = ResumableRun(spark, lake, f"part-{DAY}", jobs, attempts=3, wait_seconds=0,
                           database=logs)
        run.run()
    made = {r.job: r for r in attempts_of(run.states()).collect()}
    return spark.table(params.table).select(
        "*", F.lit(made["capture"].attempts).alias("capture_attempts"),
        F.lit(made["bronze_to_silver"].attempts).alias("silver_attempts"),
        F.lit(made["bronze_to_silver"].failures).alias("silver_failures"),
        F.lit(all(r.committed for r in made.values())).alias("committed"))


def _silver_as(spark, sf_dir, label: str, table: str, schema, **settings) -> DataFrame:
    lake, db, logs = _ctx(spark, label)
    params = IngestParams(db, table, schema, **settings)
    capture(spark, _t(spark, sf_dir, table), lake, "shop", table, DAY, ext=params.ext,
            logs_db=logs)
    return bronze_to_silver(spark, lake, "shop", table, DAY, params, logs_db=logs)


def silver_from_json(spark, sf_dir):
    """A day landed as JSON lines, with the format in the parameters."""
    return _silver_as(spark, sf_dir, "silver_from_json", "customer", CUSTOMER_SCHEMA, ext="json",
                      partition_column="c_mktsegment")


def silver_from_parquet(spark, sf_dir):
    """A day landed as Parquet, with the format in the parameters."""
    return _silver_as(spark, sf_dir, "silver_from_parquet", "orders", ORDERS_SCHEMA,
                      ext="parquet", partition_column="o_orderstatus")


def silver_codec(spark, sf_dir):
    """A table with its own Parquet codec; the codec is read off its files."""
    rows = _silver_as(spark, sf_dir, "silver_codec", "part", PART_SCHEMA, compression="zstd")
    return rows.withColumn("codec", F.regexp_extract(
        F.col("_metadata.file_name"), r"\.(\w+)\.parquet$", 1))


def layer_locations(spark, sf_dir):
    """Tables of three layers, each in its layer's folder of the lake."""
    lake, db, logs = _ctx(spark, "layer_locations")
    gold = fresh_name("gold")
    capture(spark, _t(spark, sf_dir, "nation"), lake, "geo", "nation", DAY, logs_db=logs)
    bronze_to_silver(spark, lake, "geo", "nation", DAY,
                     IngestParams(db, "nation", NATION_SCHEMA), logs_db=logs)
    silver_to_gold(spark, lake, f"SELECT n_regionkey, count(*) AS nations FROM {db}.nation "
                   "GROUP BY n_regionkey", GoldParams(gold, "regions"), logs_db=logs)
    out = []
    for name, table in ((f"{db}.nation", "nation"), (f"{gold}.regions", "regions"),
                        (f"{logs}.capture_api", "capture_api")):
        place = F.regexp_extract("_metadata.file_path",
                                 r"/runs/layer_locations-\w+/(\w+)/\w+/(\w+)/[^/]+$", 1)
        out.append(spark.table(name).groupBy(place.alias("layer")).count().select(
            "layer", F.lit(table).alias("table_name"), F.col("count").alias("row_count")))
    return out[0].unionByName(out[1]).unionByName(out[2])


def run_ledger_slow_steps(spark, sf_dir):
    """Step statistics of ledgers that real runs wrote."""
    lake, db, logs = _ctx(spark, "run_ledger_slow_steps")
    params = IngestParams(db, "nation", NATION_SCHEMA)
    for day, odd in ((DAY, 0), (NEXT_DAY, 1)):
        rows = _t(spark, sf_dir, "nation").where(F.col("n_nationkey") % 2 == odd)
        capture(spark, rows, lake, "geo", "nation", day, logs_db=logs)
        bronze_to_silver(spark, lake, "geo", "nation", day, replace(params, mode="append"),
                         logs_db=logs)
    both = spark.table(f"{logs}.capture_api").unionByName(spark.table(f"{logs}.bronze_to_silver"))
    rows = spark.table(params.table).count()
    return step_stats(both).select(
        "job_name", "step", "runs", (F.col("max_seconds") > 0).alias("timed"),
        (F.abs(F.col("avg_seconds") * F.col("runs") - F.col("total_seconds")) < 1e-6)
        .alias("consistent"), F.lit(rows).cast("bigint").alias("silver_rows"))


def ingest_schema_union(spark, sf_dir):
    """Days of JSON whose keys and types drift: a key that is whole, then a fraction, then
    text, a nested key that grows, keys with blanks, colons and dots."""
    base = Lake.fresh(spark, "ingest_schema_union").bronze("app", "drift")
    events = _t(spark, sf_dir, "events")
    day = [events.where(F.col("event_id") % 4 == k) for k in range(4)]
    whole = F.floor("value").cast("bigint")
    nested = F.struct(F.col("user_id").alias("id"))
    wider = F.struct(F.col("user_id").alias("id"), F.col("event_type").alias("kind.of"))
    land_day(day[0].select("event_id", whole.alias("v:1"), nested.alias("who")), base,
             "20240101", ext="json")
    land_day(day[1].select("event_id", (whole + 0.5).alias("v:1"), wider.alias("who")), base,
             "20240102", ext="json")
    land_day(day[2].select("event_id", F.col("event_type").alias("a b.c")), base, "20240103",
             ext="json")
    read_union(spark, base)  # keeps the states of three days
    land_day(day[3].select("event_id", F.col("event_type").alias("v:1"), F.lit(True).alias("late")),
             base, "20240104", ext="json")
    rows = read_union(spark, base)
    kept = sum(load_state(spark, base, f"2024010{k}") is not None for k in range(1, 5))
    return rows.select("event_id", column("v:1").alias("v"), F.col("who.id").alias("who_id"),
                       F.col("who.`kind.of`").alias("who_kind"), column("a b.c").alias("abc"),
                       "late", "ingest_date", F.lit(kept).cast("bigint").alias("states"))


def gold_dependency_run(spark, sf_dir):
    """Three gold tables, each reading the one after it in the list, with a table
    expression, a subquery and a name that hides a table."""
    lake, db, logs = _ctx(spark, "gold_dependency_run")
    gold = fresh_name("gold")
    spec = PipelineSpec(
        "shop", "orders", DAY, IngestParams(db, "orders", ORDERS_SCHEMA, "o_orderstatus"),
        golds=[
            GoldSpec(f"WITH daily AS (SELECT * FROM {gold}.big) SELECT count(*) AS big_customers, "
                     f"max(spent) AS most FROM daily WHERE spent > (SELECT avg(spent) FROM "
                     f"{gold}.spending)", GoldParams(gold, "summary")),
            GoldSpec(f"SELECT * FROM {gold}.spending WHERE orders >= 10", GoldParams(gold, "big")),
            GoldSpec("SELECT o_custkey, count(*) AS orders, CAST(sum(CAST(o_totalprice AS "
                     f"DECIMAL(18,2))) AS DECIMAL(28,2)) AS spent FROM {db}.orders GROUP BY "
                     "o_custkey", GoldParams(gold, "spending")),
        ], logs_db=logs)
    golds = run_pipeline(spark, lake, _t(spark, sf_dir, "orders"), spec).golds
    return golds[f"{gold}.summary"].select(
        "big_customers", "most", F.lit(list(golds)[0].split(".")[1]).alias("first_built"))


def silver_schema_evolution(spark, sf_dir):
    """A table whose declared schema grows: day one as whole numbers, day two with another
    column and wider types, then a declaration that would lose values and is refused."""
    from ..operators.evolution import SchemaEvolutionError

    lake, db, logs = _ctx(spark, "silver_schema_evolution")
    part = _t(spark, sf_dir, "part")
    first = (("p_partkey", "INT"), ("p_size", "SMALLINT"), ("p_brand", "STRING"))
    later = (("p_partkey", "BIGINT"), ("p_size", "STRING"), ("p_name", "STRING"),
             ("p_brand", "STRING"))

    def day(rows: DataFrame, name: str, schema) -> DataFrame:
        capture(spark, rows, lake, "shop", "part", name, logs_db=logs)
        return bronze_to_silver(
            spark, lake, "shop", "part", name,
            IngestParams(db, "part", schema, "p_brand", mode="append", evolve=True), logs_db=logs)

    odd = F.col("p_partkey") % 2 == 1
    day(part.where(odd), DAY, first)
    big = F.col("p_partkey") + 3000000000
    rows = day(part.where(~odd).withColumn("p_partkey", big), NEXT_DAY, later)
    refused = False
    try:
        day(part, "20240103", first)
    except SchemaEvolutionError:
        refused = True
    return rows.withColumn("refused", F.lit(refused))


WEEKS_SQL = """
SELECT event_id,
       CASE WHEN event_id % 17 = 0 THEN CAST(year(ts) AS STRING) || '-54-1'
            WHEN event_id % 19 = 0 THEN CAST(year(ts) AS STRING) || '-10-7'
            WHEN event_id % 23 = 0 THEN NULL
            ELSE CAST(year(ts) AS STRING) || '-' || CAST((dayofyear(ts) + 6) // 7 AS STRING)
                 || '-' || CAST(event_id % 7 AS STRING) END AS week,
       CASE WHEN event_id % 13 = 0 THEN '2021-W53-1' WHEN event_id % 11 = 0 THEN '2020-W53-7'
            WHEN event_id % 7 = 0 THEN '9999-W52-6' WHEN event_id % 5 = 0 THEN '2024-W00-1'
            ELSE '2024-W01-' || CAST(event_id % 7 + 1 AS STRING) END AS iso
FROM events
"""


def dq_week_mask(spark, sf_dir):
    """Weeks of the year with a weekday, and ISO weeks."""
    _views(spark, sf_dir, "events")
    return run_suite(gold_frame(spark, WEEKS_SQL.replace("//", "div")), {"quality_params": {
        "date_mask_equal": {"column": "week,iso", "date_mask": "%Y-%U-%w,%G-W%V-%u"}}})


ORDERS_SUITE = {"quality_params": {
    "not_null": {"column": "o_totalprice"}, "unique_vals": {"column": "o_orderkey,o_custkey"},
    "df_count_btw": {"min": "1", "max": "1000000000"},
    "values_btw": {"column": "o_totalprice", "min": "1000", "max": "300000"},
    "value_match_regex": {"column": "o_orderpriority", "regex": "^[1-3]-"}}}


def dq_incremental_suite(spark, sf_dir):
    """A suite over orders by status, before and after one partition is written again: the
    second run reads that partition only, and its report is that of all rows."""
    lake, db, logs = _ctx(spark, "dq_incremental_suite")
    orders = _t(spark, sf_dir, "orders")
    params = IngestParams(db, "orders", ORDERS_SCHEMA, "o_orderstatus")

    def day(rows: DataFrame, name: str) -> DataFrame:
        capture(spark, rows, lake, "shop", "orders", name, logs_db=logs)
        bronze_to_silver(spark, lake, "shop", "orders", name, params, logs_db=logs)
        return data_quality(spark, lake, "orders", "", ORDERS_SUITE, logs_db=logs,
                            stop_job=False, incremental_table=params.table)

    day(orders, DAY)
    changed = orders.where("o_orderstatus = 'P'").withColumn(
        "o_totalprice", F.when(F.col("o_orderkey") % 3 != 0, F.col("o_totalprice") + 100000))
    report = day(changed.withColumn("o_orderkey", F.floor(F.col("o_orderkey") / 2) * 2), NEXT_DAY)
    read = spark.table(f"{logs}.data_quality").orderBy(F.desc("start_exec")).first().extras
    return report.withColumn("partitions_read", F.lit(int(read["partitions_read"])).cast("bigint"))


def dq_unique_filtered(spark, sf_dir):
    """Unique checks behind the counting filter: keys, nearly unique prices, flags."""
    return run_suite(_t(spark, sf_dir, "lineitem").withColumn(
        "l_key", F.concat_ws("-", "l_orderkey", "l_linenumber")), {"quality_params": {
            "unique_vals": {"column": "l_key,l_extendedprice,l_returnflag,l_shipdate"}}},
        unique_filter_bits=24)


DELIVERY_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        bronze_split_multiline, bronze_foreign_headers, run_headerless, capture_json_any_keys,
        silver_gated_publish, run_resume, silver_from_json, silver_from_parquet, silver_codec,
        layer_locations, run_ledger_slow_steps, ingest_schema_union, gold_dependency_run,
        silver_schema_evolution, dq_week_mask, dq_incremental_suite, dq_unique_filtered)
}

_CUSTOMER = "c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment"

DELIVERY_ORACLES: dict[str, str] = {
    "bronze_split_multiline": """
        SELECT doc_id, text || chr(10) || '"' || lang || '";;""' || chr(10) AS text, source
        FROM documents""",
    "bronze_foreign_headers": """
        SELECT event_id, ts, CASE WHEN event_id % 4 <> 3 THEN user_id END AS user_id,
               CASE WHEN event_id % 4 <> 3 THEN event_type END AS event_type,
               CASE WHEN event_id % 4 <> 3 THEN value END AS value, props
        FROM events""",
    "run_headerless": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "capture_json_any_keys": """
        SELECT event_id, user_id, event_type, value,
               (SELECT count(*) FROM events WHERE event_id % 13 = 5) AS malformed
        FROM events WHERE event_id % 13 <> 5""",
    "silver_gated_publish": f"""
        SELECT {_CUSTOMER}, CAST(1 AS BIGINT) AS failed_runs FROM customer
        WHERE c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
        UNION ALL
        SELECT c_custkey, c_name, CAST(c_nationkey + 100 AS INTEGER), c_acctbal, c_mktsegment, 1
        FROM customer
        WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey % 2 = 0""",
    "run_resume": """
        SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice,
               CAST(1 AS BIGINT) AS capture_attempts, CAST(3 AS BIGINT) AS silver_attempts,
               CAST(2 AS BIGINT) AS silver_failures, true AS committed
        FROM part""",
    "silver_from_json": f"SELECT {_CUSTOMER} FROM customer",
    "silver_from_parquet": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
        FROM orders""",
    "silver_codec": """
        SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice, 'zstd' AS codec
        FROM part""",
    "layer_locations": """
        SELECT 'silver' AS layer, 'nation' AS table_name, count(*) AS row_count FROM nation
        UNION ALL SELECT 'gold', 'regions', count(DISTINCT n_regionkey) FROM nation
        UNION ALL SELECT 'logs', 'capture_api', CAST(1 AS BIGINT)""",
    "run_ledger_slow_steps": """
        SELECT job_name, step, CAST(2 AS BIGINT) AS runs, true AS timed, true AS consistent,
               (SELECT count(*) FROM nation) AS silver_rows
        FROM (VALUES ('capture_api', 'load_csv'), ('bronze_to_silver', 'read_csv'),
                     ('bronze_to_silver', 'cast_df'), ('bronze_to_silver', 'create_table'),
                     ('bronze_to_silver', 'write_table')) AS s(job_name, step)""",
    "ingest_schema_union": """
        SELECT event_id,
               CASE event_id % 4 WHEN 0 THEN CAST(CAST(floor(value) AS BIGINT) AS VARCHAR)
                    WHEN 1 THEN CAST(floor(value) + 0.5 AS VARCHAR)
                    WHEN 3 THEN event_type END AS v,
               CASE WHEN event_id % 4 IN (0, 1) THEN user_id END AS who_id,
               CASE WHEN event_id % 4 = 1 THEN event_type END AS who_kind,
               CASE WHEN event_id % 4 = 2 THEN event_type END AS abc,
               CASE WHEN event_id % 4 = 3 THEN true END AS late,
               '2024010' || CAST(event_id % 4 + 1 AS VARCHAR) AS ingest_date,
               CAST(4 AS BIGINT) AS states
        FROM events""",
    "gold_dependency_run": """
        WITH spending AS (SELECT o_custkey, count(*) AS orders,
                                 sum(CAST(o_totalprice AS DECIMAL(18,2))) AS spent
                          FROM orders GROUP BY o_custkey)
        SELECT count(*) AS big_customers, CAST(max(spent) AS DECIMAL(28,2)) AS most,
               'spending' AS first_built
        FROM spending WHERE orders >= 10 AND spent > (SELECT avg(spent) FROM spending)""",
    "silver_schema_evolution": """
        SELECT CASE WHEN p_partkey % 2 = 1 THEN p_partkey ELSE p_partkey + 3000000000 END
                 AS p_partkey,
               CAST(p_size AS VARCHAR) AS p_size,
               CASE WHEN p_partkey % 2 = 0 THEN p_name END AS p_name, p_brand, true AS refused
        FROM part""",
    "dq_week_mask": f"WITH src AS ({WEEKS_SQL})\n" + _union(
        _row(0, "week", "date_mask_equal", "Date mask with mask %Y-%U-%w", "count(week)",
             "count(*) FILTER (WHERE event_id % 17 = 0 OR event_id % 19 = 0)"),
        _row(1, "iso", "date_mask_equal", "Date mask with mask %G-W%V-%u", "count(iso)",
             "count(*) FILTER (WHERE iso IN ('2021-W53-1', '9999-W52-6', '2024-W00-1'))")),
    "dq_incremental_suite": """
        WITH src AS (
          SELECT CASE WHEN o_orderstatus = 'P' THEN (o_orderkey // 2) * 2 ELSE o_orderkey END
                   AS o_orderkey, o_custkey, o_orderstatus, o_orderpriority,
                 CASE WHEN o_orderstatus <> 'P' THEN o_totalprice
                      WHEN o_orderkey % 3 <> 0 THEN o_totalprice + 100000 END AS o_totalprice
          FROM orders)
        SELECT *, CAST(1 AS BIGINT) AS partitions_read FROM (""" + _union(
        _not_null(0, "o_totalprice"), _unique(1, "o_orderkey"), _unique(2, "o_custkey"),
        _count(3, 1, 1000000000), _values(4, "o_totalprice", 1000, 300000),
        _regex(5, "o_orderpriority", "^[1-3]-")) + ") AS r",
    "dq_unique_filtered": """
        WITH src AS (SELECT *, CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR)
                              AS l_key FROM lineitem)
        """ + _union(_unique(0, "l_key"), _unique(1, "l_extendedprice"),
                     _unique(2, "l_returnflag"), _unique(3, "l_shipdate")),
}
