"""The ordered run of a source table as a resumable run (``operators.runs``).

The four jobs keep their order. A re-run of a day after a failure skips the jobs
that are committed: records landed once are not landed again, a published silver
day is not written again. A failed gate is not retried by itself.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..lake import Lake
from ..operators.lineage import in_order
from ..operators.quality import QualityGateError
from ..operators.runs import Job, ResumableRun
from .daily import PipelineSpec
from .jobs import bronze_to_silver, capture, data_quality, silver_to_gold


def pipeline_jobs(spark: SparkSession, lake: Lake, records: Callable[[], DataFrame],
                  spec: PipelineSpec) -> list[Job]:
    """The jobs of ``daily.run_pipeline``, each on its own."""
    def landing(_: str) -> str:
        return capture(spark, records(), lake, spec.source, spec.table, spec.day,
                       ext=spec.ingest.ext, sep=spec.ingest.sep, header=spec.ingest.header,
                       logs_db=spec.logs_db, balance=spec.balance)

    def silver(_: str) -> str:
        bronze_to_silver(spark, lake, spec.source, spec.table, spec.day, spec.ingest,
                         logs_db=spec.logs_db, gate=spec.gate)
        return spec.ingest.table

    def quality(_: str) -> None:
        data_quality(spark, lake, spec.table,
                     spec.quality_sql or f"SELECT * FROM {spec.ingest.table}", spec.quality,
                     logs_db=spec.logs_db)

    def gold_job(gold) -> Job:
        def work(_: str) -> str:
            silver_to_gold(spark, lake, gold.sql, gold.params, logs_db=spec.logs_db)
            return gold.params.table

        return Job(f"silver_to_gold:{gold.params.table}", work)

    jobs = [Job("capture", landing), Job("bronze_to_silver", silver)]
    if spec.quality is not None:
        jobs.append(Job("data_quality", quality))
    return jobs + [gold_job(g) for g in in_order(spark, spec.golds)]


def resume_pipeline(spark: SparkSession, lake: Lake, records: Callable[[], DataFrame],
                    spec: PipelineSpec, attempts: int = 3, wait_seconds: float = 30.0,
                    **settings) -> dict[str, str | None]:
    """Run or go on with the day of ``spec``; job -> result text.

    ``records()`` gives the delivery; it is only called when the landing is still to do.
    """
    run = ResumableRun(spark, lake, f"{spec.source}.{spec.table}.{spec.day}",
                       pipeline_jobs(spark, lake, records, spec), attempts=attempts,
                       wait_seconds=wait_seconds, database=spec.logs_db,
                       final=(QualityGateError,), run_date=spec.day, **settings)
    return run.run()
