"""Ordered run of one source table: capture -> silver -> (quality, gold).

The order of the original daily schedule. Quality runs before gold here, so
that a gated suite stops the run before gold tables are rewritten; with
``stop_job=False`` the order makes no difference to the results. ``gate`` holds
checks of the day's rows that run before they are visible in silver. Gold tables
are built in the order in which their texts read each other (``operators.lineage``).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from ..lake import Lake
from ..operators.lineage import in_order
from ..params import GoldParams, IngestParams, QualityParams
from .jobs import bronze_to_silver, capture, data_quality, silver_to_gold


@dataclass
class GoldSpec:
    sql: str
    params: GoldParams


@dataclass
class PipelineSpec:
    source: str
    table: str
    day: str
    ingest: IngestParams
    golds: list[GoldSpec] = field(default_factory=list)
    quality_sql: str | None = None
    quality: QualityParams | None = None
    logs_db: str = "logs"
    balance: bool = False  # spread the records over tasks before landing
    gate: QualityParams | None = None  # checks silver rows must pass before they are visible


@dataclass
class PipelineResult:
    silver: DataFrame
    golds: dict[str, DataFrame]
    quality_report: DataFrame | None


def run_pipeline(spark: SparkSession, lake: Lake, records: DataFrame,
                 spec: PipelineSpec) -> PipelineResult:
    capture(spark, records, lake, spec.source, spec.table, spec.day, ext=spec.ingest.ext,
            sep=spec.ingest.sep, header=spec.ingest.header, logs_db=spec.logs_db,
            balance=spec.balance)
    silver = bronze_to_silver(spark, lake, spec.source, spec.table, spec.day, spec.ingest,
                              logs_db=spec.logs_db, gate=spec.gate)
    report = None
    if spec.quality is not None:
        sql = spec.quality_sql or f"SELECT * FROM {spec.ingest.table}"
        report = data_quality(spark, lake, spec.table, sql, spec.quality,
                              logs_db=spec.logs_db)
    golds = {}
    for g in in_order(spark, spec.golds):
        golds[g.params.table] = silver_to_gold(spark, lake, g.sql, g.params,
                                               logs_db=spec.logs_db)
    return PipelineResult(silver, golds, report)
