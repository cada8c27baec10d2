"""The four jobs of a source table, each logged in the run ledger.

``capture``          land the day's records in bronze (CSV, JSON or Parquet)
``bronze_to_silver`` read that day, bind to the declared schema, write silver
``silver_to_gold``   run a SQL text, write the gold table
``data_quality``     run a suite over a SQL text, store the report, gate

Every job takes a ``SparkSession`` and explicit arguments (the day, the SQL
text, the parameters) and returns a DataFrame. Each run appends one row to
``{logs_db}.{job}``, also when the job fails.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.metrics import observed
from ..lake import Lake, remove_folder
from ..operators.evolution import evolve_table, with_table_columns
from ..operators.gold import build_gold, gold_frame
from ..operators.incremental import incremental_suite
from ..operators.ledger import RunLedger
from ..operators.publish import publish_gated
from ..operators.quality import enforce, run_suite
from ..operators.silver import bind_positionally, conform_observed
from ..operators.tables import ensure_table, write_by_name
from ..params import (GoldParams, IngestParams, ParamError, QualityParams,
                      landing_read_schema)
from ..sources.landing import DAY_COLUMN, land_day, read_day

# Job names, which are also the names of their ledger tables.
JOB_CAPTURE = "capture_api"
JOB_BRONZE_TO_SILVER = "bronze_to_silver"
JOB_SILVER_TO_GOLD = "silver_to_gold"
JOB_DATA_QUALITY = "data_quality"


def capture(spark: SparkSession, records: DataFrame, lake: Lake, source: str, table: str,
            day: str, ext: str = "csv", sep: str = ";", logs_db: str = "logs",
            max_records_per_file: int | None = None, balance: bool = False, header: bool = True,
            malformed: DataFrame | None = None,
            malformed_seen: Observation | None = None) -> str:
    """Land ``records`` as the bronze files of ``day``; returns the directory.

    ``balance`` spreads the records over tasks before writing (one shuffle),
    for deliveries that arrive in few or uneven partitions. ``malformed`` holds
    lines that are no records: they go to the ``_malformed`` folder of the day
    and their number to the ledger. ``malformed_seen`` has observed during the
    landing whether there are any; where it saw none they are not looked for.
    """
    with RunLedger(spark, lake, JOB_CAPTURE, table, source, database=logs_db) as log:
        with log.step("load_" + ext):
            kwargs = {} if max_records_per_file is None else {
                "max_records_per_file": max_records_per_file}
            seen = Observation("capture")
            counted = records.observe(seen, F.count(F.lit(1)).alias("rows"))
            path = land_day(counted, lake.bronze(source, table), day, ext=ext, sep=sep,
                            header=header, balance=balance, **kwargs)
        log.info("path", path)
        log.info("rows", observed(seen).get("rows"))
        if malformed is not None:
            log.info("malformed", _set_aside(malformed, lake, source, table, day, malformed_seen,
                                             log))
        return path


def _set_aside(lines: DataFrame, lake: Lake, source: str, table: str, day: str,
               seen: Observation | None, log: RunLedger) -> int | None:
    """Write malformed lines; returns their number, counted where they are written."""
    spark = lines.sparkSession
    folder = f"{lake.bronze(source, table)}/_malformed/{DAY_COLUMN}={day}"
    if seen is not None and observed(seen).get("malformed") == 0:
        remove_folder(spark, folder)  # of an earlier run of the day
        return 0
    with log.step("load_malformed"):
        counted = Observation("malformed rows")
        lines.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite").text(folder)
    return observed(counted).get("rows")


def bronze_to_silver(spark: SparkSession, lake: Lake, source: str, table: str, day: str,
                     params: IngestParams, logs_db: str = "logs",
                     full_overwrite: bool = False,
                     gate: QualityParams | dict | None = None) -> DataFrame:
    """Bind one landed day to the declared schema and write the silver table.

    With ``gate``, the suite checks the rows of this run before they are visible:
    they are staged, checked and published (``operators.publish``). A failed check
    fails the job and the table stays as it was.
    """
    with RunLedger(spark, lake, JOB_BRONZE_TO_SILVER, table, source,
                   database=logs_db) as log:
        with log.step("read_" + params.ext):
            reader_schema = (landing_read_schema(params.schema)
                             if params.ext == "json" and params.schema else None)
            raw = read_day(spark, lake.bronze(source, table), day, ext=params.ext,
                           sep=params.sep, header=params.header, schema=reader_schema,
                           multi_line=params.multi_line)
        with log.step("cast_df"):
            schema = params.require_schema()
            if params.ext == "csv" and not params.header:
                raw = bind_positionally(raw, schema)
            have = {c.lower() for c in raw.columns}
            missing = [name for name, _ in schema if name.lower() not in have]
            if len(missing) == len(schema):
                raise ParamError(f"{params.table}: the landed day has none of the declared "
                                 f"columns (it has: {', '.join(raw.columns)})")
            if missing:
                log.info("missing_columns", ",".join(missing))
            seen = Observation("bronze_to_silver")
            typed = conform_observed(raw, schema, params.partition_column, seen)
        with log.step("create_table"):
            location = lake.location("silver", params.target_schema, params.target_table)
            made = ensure_table(spark, params.table, schema, params.partition_column, location,
                                params.compression)
        if params.evolve and not made:
            with log.step("evolve_table"):
                change = evolve_table(spark, params.table, schema, params.partition_column,
                                      location)
                typed = with_table_columns(typed, params.table)
            for name in ("added", "widened", "undeclared"):
                if getattr(change, name):
                    log.info(f"{name}_columns", ",".join(getattr(change, name)))
        written = Observation("silver_rows")
        if gate is not None:
            with log.step("publish_table"):
                publish_gated(typed, params.table, location, _suite(gate), mode=params.mode, compression=params.compression,
                              rebalance=params.rebalance, written=written)
        else:
            with log.step("write_table"):
                write_by_name(typed, params.table, mode=params.mode,
                              full_overwrite=full_overwrite, rebalance=params.rebalance,
                              written=written)
        log.info("day", day)
        log.info("rows", observed(written).get("rows"))
        for key, value in observed(seen).items():
            if key != "rows":
                log.info(key, value)
        return spark.table(params.table)


def _suite(params: QualityParams | dict) -> QualityParams:
    return QualityParams.from_dict(params) if isinstance(params, dict) else params


def silver_to_gold(spark: SparkSession, lake: Lake, sql_text: str, params: GoldParams,
                   source: str = "silver", logs_db: str = "logs",
                   full_overwrite: bool = False) -> DataFrame:
    with RunLedger(spark, lake, JOB_SILVER_TO_GOLD, params.target_table, source,
                   database=logs_db) as log:
        return build_gold(spark, sql_text, params, lake, ledger=log,
                          full_overwrite=full_overwrite)


def data_quality(spark: SparkSession, lake: Lake, table_name: str, sql_text: str,
                 params: QualityParams | dict, results_table: str | None = None,
                 logs_db: str = "logs", stop_job: bool | None = None,
                 materialize: bool | None = None,
                 incremental_table: str | None = None) -> DataFrame:
    """Evaluate a suite over the rows of ``sql_text``.

    With ``incremental_table`` the suite covers all rows of that table instead, and
    reads only partitions that changed since its last run (``operators.incremental``;
    the counts of the others are kept under the lake's ``_suites``).

    The report is appended to ``results_table`` (created when missing), so it
    is computed once and kept; the gate then reads the stored rows. Raises
    ``QualityGateError`` when a check fails and the suite is gated.
    """
    params = _suite(params)
    gated = params.stop_job if stop_job is None else stop_job
    materialize = params.materialize if materialize is None else materialize
    results_table = results_table or f"{logs_db}.quality_results"
    with RunLedger(spark, lake, JOB_DATA_QUALITY, table_name, "quality",
                   database=logs_db) as log:
        run_id = f"{table_name}-{log.start_exec.strftime('%Y%m%dT%H%M%S%f')}"
        with log.step("run_checks"):
            scratch = f"{lake.root}/_runs/{run_id}" if materialize else None
            if incremental_table:
                done = incremental_suite(spark, incremental_table, params,
                                         f"{lake.root}/_suites/{table_name}")
                report = done.report
                log.info("partitions_read", len(done.read))
                log.info("partitions_kept", len(done.kept))
            else:
                report = run_suite(gold_frame(spark, sql_text), params, materialize_to=scratch)
            stamped = report.select(
                F.lit(run_id).alias("run_id"), F.lit(table_name).alias("table_name"),
                F.lit(log.start_exec).alias("checked_at"), "*",
                F.lit(log.date_ref).alias("run_date"))
            ensure_table(spark, results_table,
                         [(f.name, f.dataType.simpleString()) for f in stamped.schema.fields],
                         "run_date", lake.location("logs", *results_table.split(".", 1)))
            try:
                write_by_name(stamped, results_table, mode="append")
            finally:
                if scratch:
                    remove_folder(spark, scratch)
        # the day's partition only, however long the history is
        stored = spark.table(results_table).where(
            (F.col("run_date") == log.date_ref) & (F.col("run_id") == run_id))
        with log.step("gate"):
            passed = enforce(stored, stop_job=gated)
        log.info("passed", passed)
        return stored.drop("run_id", "table_name", "checked_at", "run_date")
