"""Write, audit, publish: rows become visible only after their checks.

New rows are written to a folder of their own below the table's folder
(``_versions/<run>/``, which no reader of the table lists), in the table's
partition layout. The suite runs on that folder. When the gate passes, the
catalog's partitions are pointed at the new folders; the old folders stay where
they are until a later publication, so a query that began before goes on reading
them. When it fails, the folder goes and the table is as it was.

The places of published partitions are recorded next to the table's definition
before the catalog is changed. That record is the commit: it is replaced as a
whole, and ``apply_places`` brings a catalog in line with it, after a crash between
the record and the catalog, or when a table folder is registered again in a new
session. Partitions that were never published this way lie in their usual folders
and are not in the record. Other writers (``write_by_name``) go on writing to
wherever a partition lies.

Tables without a partition column are moved as a whole. Appending cannot swap
places: after the gate, the staged rows are inserted. An empty stage publishes
nothing. A partition value NULL is the default partition, as everywhere.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..lake import read_text, remove_folder, replace_text, subdirectories
from .quality import enforce, run_suite
from .tables import (align_to_table, apply_places, definition_of, drop_partitions,
                     partition_columns, places_path, recorded_places, spread_by_partition,
                     write_by_name)

#: Folder, in a table's folder, of what was staged and published.
VERSIONS = "_versions"


@dataclass(frozen=True)
class Stage:
    """Rows of one run, written but not visible."""

    table: str
    location: str  # the table's folder
    run: str
    partition: str | None

    @property
    def folder(self) -> str:
        return f"{self.location}/{VERSIONS}/{self.run}"


def stage_rows(df: DataFrame, table: str, location: str, compression: str | None = None,
               rebalance: bool = True, written: Observation | None = None) -> Stage:
    """Write ``df``, bound by name to the table's columns, to a folder of its own."""
    spark = df.sparkSession
    parts = partition_columns(spark, table)
    out = align_to_table(df, spark.table(table).schema)
    if parts and rebalance:
        out = spread_by_partition(out, parts)
    if written is not None:
        out = out.observe(written, F.count(F.lit(1)).alias("rows"))
    stage = Stage(table, location.rstrip("/"), uuid.uuid4().hex[:12], parts[0] if parts else None)
    writer = out.write.partitionBy(*parts) if parts else out.write
    if compression:
        writer = writer.option("compression", compression.lower())
    writer.parquet(stage.folder)
    return stage


def staged_rows(spark: SparkSession, stage: Stage) -> DataFrame:
    """The staged rows with the table's columns and types."""
    return spark.read.schema(spark.table(stage.table).schema).parquet(stage.folder)


def discard(spark: SparkSession, stage: Stage) -> None:
    remove_folder(spark, stage.folder)


def places_of(spark: SparkSession, stage: Stage) -> dict[str, str]:
    """Partition value as text (the default partition's name for NULL) -> staged folder."""
    if stage.partition is None:
        return {"": stage.folder}
    names = subdirectories(spark, stage.folder)
    return {unquote(n.split("=", 1)[1]): f"{stage.folder}/{n}" for n in names}


def replace_all(rows: DataFrame, table: str, location: str) -> None:
    """Publish ``rows``, in the table's columns, as all of a partitioned table."""
    spark = rows.sparkSession
    definition = definition_of(spark, location)
    stage = Stage(table, location, uuid.uuid4().hex[:12], partition_columns(spark, table)[0])
    writer = rows.write.partitionBy(stage.partition)
    if definition.get("compression"):
        writer = writer.option("compression", definition["compression"].lower())
    writer.parquet(stage.folder)
    new, before = places_of(spark, stage), recorded_places(spark, location)
    replace_text(spark, places_path(location, definition.get("generation", 0)), json.dumps(new))
    apply_places(spark, table, new, stage.partition)
    # folders of the usual layout would be found again by a later registration
    for name in subdirectories(spark, location):
        if "=" in name:
            remove_folder(spark, f"{location}/{name}")
    for value in drop_partitions(spark, table, stage.partition, keep=set(new)):
        before.pop(value, None)
    _clean(spark, stage, before, new)


def publish(spark: SparkSession, stage: Stage) -> list[str]:
    """Make the staged rows visible; returns the partition values that moved."""
    new = places_of(spark, stage)
    before = recorded_places(spark, stage.location)
    generation = definition_of(spark, stage.location).get("generation", 0)
    replace_text(spark, places_path(stage.location, generation), json.dumps(before | new))
    apply_places(spark, stage.table, new, stage.partition)
    _clean(spark, stage, before, before | new)
    return sorted(new)


def _clean(spark: SparkSession, stage: Stage, before: dict[str, str],
           after: dict[str, str]) -> None:
    """Remove versions that neither the record before this publication nor the new one names."""
    kept = {p[len(f"{stage.location}/{VERSIONS}/"):].split("/")[0]
            for p in (*before.values(), *after.values())}
    for run in subdirectories(spark, f"{stage.location}/{VERSIONS}"):
        if run not in kept and read_text(
                spark, f"{stage.location}/{VERSIONS}/{run}/_SUCCESS") is not None:
            remove_folder(spark, f"{stage.location}/{VERSIONS}/{run}")


def publish_gated(df: DataFrame, table: str, location: str, suite, mode: str = "overwrite",
                  compression: str | None = None, rebalance: bool = True,
                  written: Observation | None = None, report_to=None) -> DataFrame:
    """Stage ``df``, run ``suite`` on the stage, publish when it passes.

    Returns the report. Raises ``QualityGateError`` when a check fails; the table then is
    what it was, and the stage is removed. ``report_to(report)`` may store the report and
    return what is stored; the gate reads that.
    """
    spark = df.sparkSession
    stage = stage_rows(df, table, location, compression, rebalance, written)
    try:
        report = run_suite(staged_rows(spark, stage), suite)
        report = report_to(report) if report_to else spark.createDataFrame(
            report.collect(), report.schema)  # one row per check
        enforce(report, stop_job=True)
    except BaseException:
        discard(spark, stage)
        raise
    if mode == "append":
        write_by_name(staged_rows(spark, stage), table, mode="append", rebalance=False)
        discard(spark, stage)
    else:
        publish(spark, stage)
    return report


def table_versions(spark: SparkSession, location: str) -> dict[str, str]:
    """Recorded places of a table's published partitions."""
    return recorded_places(spark, location)

