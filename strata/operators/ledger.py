"""Run ledger: one append-only row per job run, with step timings.

``RunLedger`` is a context manager. Steps are timed with ``ledger.step(name)``;
any exception inside the ``with`` block (including the final write, DDL or a
failed quality gate) marks the run failed, names the step that failed, and the
row is still written before the exception propagates.

Row layout (table ``{database}.{job_name}``): the ten columns of the original
log tables, ``info`` keeping the ``step:seconds`` text, plus ``steps`` as
``array<struct<step, seconds>>`` for analysis and ``extras`` for any other
facts of the run (row counts, file format, ...). ``date_ref`` is the run's date
as ``yyyy-MM-dd``.
"""

from __future__ import annotations

import time
from contextlib import contextmanager
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DoubleType, MapType, StringType, StructField,
                               StructType, TimestampType)

from ..lake import Lake
from .tables import ensure_table, write_by_name

STEP_TYPE = StructType([StructField("step", StringType()), StructField("seconds", DoubleType())])

# The first ten column names, as the log tables have them.
LEDGER_SCHEMA = StructType([
    StructField("start_exec", TimestampType()),
    StructField("job_name", StringType()),
    StructField("status", StringType()),
    StructField("table_name", StringType()),
    StructField("source", StringType()),
    StructField("info", StringType()),
    StructField("error", StringType()),
    StructField("error_desc", StringType()),
    StructField("date_ref", StringType()),
    StructField("end_exec", TimestampType()),
    StructField("steps", ArrayType(STEP_TYPE)),
    StructField("extras", MapType(StringType(), StringType())),
])

# Fixed texts of a run row (values as the original log tables hold them).
STATUS_SUCCESS = "success"
STATUS_FAILED = "failed"
ERROR_TEXT = "Error while trying to execute the step {step}"


def _utc_now() -> datetime:
    return datetime.now(timezone.utc)


class RunLedger:
    def __init__(self, spark: SparkSession, lake: Lake, job_name: str, table_name: str,
                 source: str, database: str = "logs", date_ref: str | None = None,
                 clock=_utc_now):
        self.spark = spark
        self.lake = lake
        self.job_name = job_name
        self.table_name = table_name
        self.source = source
        self.database = database
        self.clock = clock
        self.start_exec = clock()
        self.date_ref = date_ref or self.start_exec.strftime("%Y-%m-%d")
        self.status = STATUS_SUCCESS
        self.error = ""
        self.error_desc = ""
        self.steps: list[tuple[str, float]] = []
        self.extras: dict[str, str] = {}
        self.current_step: str | None = None
        self.written = False

    @property
    def table(self) -> str:
        return f"{self.database}.{self.job_name}"

    @contextmanager
    def step(self, name: str):
        self.current_step = name
        t0 = time.perf_counter()
        yield self
        self.steps.append((name, round(time.perf_counter() - t0, 6)))

    def info(self, key: str, value) -> None:
        self.extras[str(key)] = None if value is None else str(value)

    def fail(self, exc: BaseException) -> None:
        self.status = STATUS_FAILED
        self.error = ERROR_TEXT.format(step=self.current_step or "start")
        self.error_desc = str(exc)

    def info_text(self) -> str:
        """Fixed form of the ``info`` column: one ``step:seconds`` per line."""
        return "".join(f"{s}:{sec} \n" for s, sec in self.steps)

    def row(self, end_exec: datetime | None = None) -> tuple:
        return (self.start_exec, self.job_name, self.status, self.table_name, self.source,
                self.info_text(), self.error, self.error_desc, self.date_ref,
                end_exec or self.clock(), [tuple(s) for s in self.steps], dict(self.extras))

    def write(self) -> None:
        if self.written:
            return
        self.written = True
        ensure_table(self.spark, self.table,
                     [(f.name, f.dataType.simpleString()) for f in LEDGER_SCHEMA.fields],
                     None, self.lake.location("logs", self.database, self.job_name))
        # one row, one task: the default parallelism would start a task per core
        df = self.spark.createDataFrame([self.row()], LEDGER_SCHEMA).coalesce(1)
        write_by_name(df, self.table, mode="append")

    def __enter__(self) -> "RunLedger":
        return self

    def __exit__(self, exc_type, exc, tb) -> bool:
        if exc is None:
            self.write()
            return False
        self.fail(exc)
        try:
            self.write()
        except Exception as log_exc:  # keep the job's own error as the one raised
            exc.add_note(f"run ledger row not written: {log_exc}")
        return False


def step_stats(ledger: DataFrame) -> DataFrame:
    """Per job and step: runs, total, mean and longest seconds.

    The purpose stated for the log tables: find the steps that take longer
    than expected. One aggregation over the exploded steps.
    """
    steps = ledger.select("job_name", F.explode("steps").alias("s"))
    return (steps.groupBy("job_name", F.col("s.step").alias("step"))
            .agg(F.count("*").alias("runs"),
                 F.sum("s.seconds").alias("total_seconds"),
                 F.avg("s.seconds").alias("avg_seconds"),
                 F.max("s.seconds").alias("max_seconds")))
