"""Command line for the four jobs, in the params/ + query/ folder layout.

::

    python -m strata capture          --base DIR --source S --table T --records PATH
                                      [--records-format json|csv|parquet] [--multi-line]
                                      [--all-keys] [--quarantine] [--balance]
    python -m strata bronze_to_silver --base DIR --source S --table T
    python -m strata silver_to_gold   --base DIR --table T [--source silver] [--sql-name N]
    python -m strata data_quality     --base DIR --table T [--stop-job]

Common options: ``--day YYYYMMDD`` (default: today in UTC, as the original
daily jobs take it from the clock), ``--lake ROOT`` (default: ``lake`` under
the session's storage root), ``--logs-db`` (default ``logs``). The session is
the one ``spark-submit`` configures. With a persistent catalog (a metastore)
tables are found there; with Spark's in-memory catalog, which starts empty in
every job process, the table folders the job names are registered first (its
logs, its target, and the databases its SQL text names;
``operators.tables.register_tables``). Exit status: 0, or 1 when a gated
quality suite fails (its report and ledger row are written first).
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from ..lake import Lake
from ..operators.quality import QualityGateError
from ..operators.tables import register_tables
from ..params import load_json, params_path, read_sql_text
from .files import (RECORD_FORMATS, capture_from_files, gold_from_files, quality_from_files,
                    silver_from_files)
from .jobs import JOB_CAPTURE

JOBS = ("capture", "bronze_to_silver", "silver_to_gold", "data_quality")


def _today() -> str:
    return datetime.now(timezone.utc).strftime("%Y%m%d")


def parser() -> argparse.ArgumentParser:
    ap = argparse.ArgumentParser(prog="strata", description=__doc__.split("\n\n")[0])
    ap.add_argument("job", choices=JOBS)
    ap.add_argument("--base", required=True, help="folder holding params/ and query/")
    ap.add_argument("--table", "--table_name", dest="table", required=True)
    ap.add_argument("--source", default=None,
                    help="source folder of the parameters (silver_to_gold: 'silver')")
    ap.add_argument("--day", default=None, help="landing day YYYYMMDD (default: today, UTC)")
    ap.add_argument("--lake", default=None, help="root folder of the lake")
    ap.add_argument("--logs-db", default="logs")
    ap.add_argument("--records", help="capture: the delivered records (file or folder)")
    ap.add_argument("--records-format", default="json", choices=RECORD_FORMATS)
    ap.add_argument("--multi-line", action="store_true",
                    help="capture: JSON arrays / multi-line records")
    ap.add_argument("--all-keys", action="store_true",
                    help="capture: read all JSON keys, not the declared ones (inference pass)")
    ap.add_argument("--quarantine", action="store_true",
                    help="capture: set malformed JSON lines aside and count them")
    ap.add_argument("--balance", action="store_true",
                    help="capture: spread the records over tasks before writing")
    ap.add_argument("--sql-name", default=None, help="silver_to_gold: query/gold/<name>.sql")
    ap.add_argument("--stop-job", action="store_true", default=None,
                    help="data_quality: fail the run when a check fails")
    return ap


def _needed(spark: SparkSession, args: argparse.Namespace) -> Callable[[str, str], bool]:
    """Which (database, table) of the lake the job can touch."""
    job = JOB_CAPTURE if args.job == "capture" else args.job
    names, text = {f"{args.logs_db}.{job}".lower()}, ""
    if args.job == "bronze_to_silver":
        names.add(_target(spark, args, args.source))
    elif args.job == "silver_to_gold":
        names.add(_target(spark, args, args.source or "silver"))
        sql_name = args.sql_name or _sql_name(spark, args)
        text = read_sql_text(spark, args.base, "gold", sql_name)
    elif args.job == "data_quality":
        names.add(f"{args.logs_db}.quality_results".lower())
        text = read_sql_text(spark, args.base, "quality", args.table)
    text = text.lower().replace("`", "")
    return lambda database, table: (f"{database}.{table}".lower() in names
                                    or f"{database}.{table}".lower() in text)


def _target(spark: SparkSession, args: argparse.Namespace, source: str) -> str:
    params = load_json(spark, params_path(args.base, source, args.table))
    return f"{params.get('target_schema')}.{params.get('target_table')}".lower()


def _sql_name(spark: SparkSession, args: argparse.Namespace) -> str:
    """The SQL text's name when none is given: the gold target table."""
    params = load_json(spark, params_path(args.base, args.source or "silver", args.table))
    return str(params.get("target_table"))


def run(args: argparse.Namespace, spark: SparkSession) -> int:
    lake = Lake(args.lake.rstrip("/")) if args.lake else Lake.of(spark)
    day = args.day or _today()
    if args.job in ("capture", "bronze_to_silver") and not args.source:
        raise SystemExit(f"{args.job}: --source is required")
    if spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "in-memory":
        # nothing persists between job processes: take the tables from the lake
        register_tables(spark, lake, _needed(spark, args))
    if args.job == "capture":
        if not args.records:
            raise SystemExit("capture: --records is required")
        path = capture_from_files(spark, lake, args.base, args.source, args.table, day,
                                  args.records, args.records_format, args.multi_line,
                                  logs_db=args.logs_db,
                                  declared_only=False if args.all_keys else None,
                                  balance=args.balance, quarantine=args.quarantine)
        print(path)
    elif args.job == "bronze_to_silver":
        silver_from_files(spark, lake, args.base, args.source, args.table, day,
                          logs_db=args.logs_db)
    elif args.job == "silver_to_gold":
        gold_from_files(spark, lake, args.base, args.table, source=args.source or "silver",
                        sql_name=args.sql_name, logs_db=args.logs_db)
    else:
        try:
            quality_from_files(spark, lake, args.base, args.table, logs_db=args.logs_db,
                               stop_job=args.stop_job)
        except QualityGateError as exc:
            print(f"data quality gate failed: {exc}", file=sys.stderr)
            return 1
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName(f"strata-{args.job}").getOrCreate()
    return run(args, spark)
