"""Suites over a partitioned table that read changed partitions only.

Per partition of the table the suite's counts are kept with a fingerprint of the
partition's files (names, sizes, times of change): element and unexpected counts per
row-level check, and for unique checks the number of occurrences of every value.
Both merge by addition. A run compares the fingerprints of today's partitions with
the kept ones, reads the changed partitions from the table (pruned), and merges their
counts with those of the others. Removed partitions drop out. The report equals that
of the full suite.

State lies under ``root``::

    current.json                 suite digest, partition -> fingerprint, run
    counts/run=R/                partition, e0, u0, ...          of the partitions run R read
    values/run=R/                partition, k, v0.., n

``current.json`` is replaced as a whole at the end of a run, so a run that dies leaves
the state before it; runs that nothing refers to are removed. Another suite, or other
column types, start from nothing. The fingerprints come from a listing made by Spark,
one row per file; the driver handles one entry per partition, as the catalog does.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import column
from ..lake import filesystem, read_text, remove_folder, replace_text, subdirectories
from ..params import ParamError, QualityParams
from .quality import (expand, row_level_counts, row_level_report, unique_report, value_counts)
from .tables import NULL_PARTITION, partition_columns

CURRENT = "current.json"


@dataclass(frozen=True)
class IncrementalReport:
    """The suite's report, and which partitions were read from the table for it."""

    report: DataFrame
    read: list[str]
    kept: list[str]


def _items(seq):
    iterator = seq.iterator()
    while iterator.hasNext():
        yield iterator.next()


def partition_folders(spark: SparkSession, table: str) -> dict[str, str]:
    """Partition value as text -> folder, from the catalog (``""`` for a whole table)."""
    jvm, catalog = spark.sparkContext._jvm, spark._jsparkSession.sessionState().catalog()
    parser = spark._jsparkSession.sessionState().sqlParser()
    name = parser.parseTableIdentifier(table)
    path = jvm.org.apache.hadoop.fs.Path
    parts = partition_columns(spark, table)
    if not parts:
        return {"": path(catalog.getTableMetadata(name).location()).toString()}
    if len(parts) > 1:
        raise ParamError(f"{table}: more than one partition column")
    out = {}
    nothing = jvm.scala.Option.apply(None)
    for p in _items(catalog.listPartitions(name, nothing)):
        out[p.spec().apply(parts[0])] = path(p.location()).toString()
    return out


def fingerprints(spark: SparkSession, folders: dict[str, str]) -> dict[str, str]:
    """Partition -> digest of its files' names, sizes and times of change."""
    there = {}
    for value, folder in folders.items():
        fs, path = filesystem(spark, folder)
        if fs.exists(path):
            there[fs.resolvePath(path).toString()] = value
    if not there:
        return {}
    files = spark.read.format("binaryFile").load(list(there)).select(
        F.regexp_replace("path", "/[^/]*$", "").alias("folder"),
        F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)").alias("h"),
        "length")
    rows = files.groupBy("folder").agg(F.sum("h").alias("h"), F.sum("length").alias("bytes"),
                                       F.count(F.lit(1)).alias("files")).collect()
    found = {there[r.folder]: f"{r.files}-{r.bytes}-{r.h}" for r in rows if r.folder in there}
    return {value: found.get(value, "empty") for value in there.values()}


def _suite_digest(spark: SparkSession, table: str, checks) -> str:
    types = sorted((f.name, f.dataType.simpleString()) for f in spark.table(table).schema.fields)
    text = json.dumps([[c.name, c.column, list(map(list, c.args))] for c in checks] + types)
    return hashlib.sha256(text.encode()).hexdigest()


def _value(table_column: str | None) -> Column:
    """A row's partition as the catalog writes it."""
    if table_column is None:
        return F.lit("")
    return F.coalesce(column(table_column).cast("string"), F.lit(NULL_PARTITION))


def _changed_rows(spark: SparkSession, table: str, part: str | None, changed: list[str],
                  all_parts: int) -> DataFrame:
    rows = spark.table(table)
    if part is None or len(changed) == all_parts:
        return rows
    dtype = rows.schema[part].dataType
    wanted = [F.lit(v).cast(dtype) for v in changed if v != NULL_PARTITION]
    hit = column(part).isin(*wanted) if wanted else F.lit(False)
    return rows.where(hit | column(part).isNull() if NULL_PARTITION in changed else hit)


def incremental_suite(spark: SparkSession, table: str, params: QualityParams | dict,
                      root: str) -> IncrementalReport:
    """Run a suite over all rows of ``table``, reading only what changed since the last run."""
    checks = expand(params)
    if not checks:
        raise ParamError("the suite has no checks")
    unique = [c for c in checks if c.name == "unique_vals"]
    row_level = [c for c in checks if c.name != "unique_vals"]
    digest = _suite_digest(spark, table, checks)
    parts = partition_columns(spark, table)
    part = parts[0] if parts else None
    current = json.loads(read_text(spark, f"{root}/{CURRENT}") or "{}")
    known = current.get("partitions", {}) if current.get("suite") == digest else {}
    now = fingerprints(spark, partition_folders(spark, table))
    changed = sorted(v for v, f in now.items() if known.get(v, {}).get("fingerprint") != f)
    run = uuid.uuid4().hex[:12]
    if changed:
        rows = _changed_rows(spark, table, part, changed, len(now))
        if row_level:
            row_level_counts(rows, row_level, _value(part)).write.parquet(
                f"{root}/counts/run={run}")
        if unique:
            value_counts(rows, unique, _value(part)).write.parquet(f"{root}/values/run={run}")
    state = {v: {"fingerprint": f, "run": run if v in changed else known[v]["run"]}
             for v, f in now.items()}
    replace_text(spark, f"{root}/{CURRENT}", json.dumps({"suite": digest, "partitions": state}))
    runs = sorted({s["run"] for s in state.values()})
    for kind in ("counts", "values"):
        for name in subdirectories(spark, f"{root}/{kind}"):
            if name.removeprefix("run=") not in runs:
                remove_folder(spark, f"{root}/{kind}/{name}")
    reports = []
    if row_level:
        names = [f"{x}{i}" for i in range(len(row_level)) for x in "eu"]
        kept = _kept(spark, root, "counts", state, runs)
        if kept is None:  # no partition at all
            kept = spark.createDataFrame([], ", ".join(f"{n} bigint" for n in names))
        one = kept.agg(*[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names])
        reports.append(row_level_report(_without_row_count_misses(one, row_level), row_level))
    if unique:
        kept = _kept(spark, root, "values", state, runs)
        if kept is None:
            kept = spark.createDataFrame([], "k int, n bigint")
        keys = [c for c in kept.columns if c not in ("by", "run", "n")]
        reports.append(unique_report(kept.groupBy(*keys).agg(F.sum("n").alias("n")), unique))
    report = reduce(DataFrame.unionByName, reports)
    return IncrementalReport(report, changed, sorted(set(now) - set(changed)))


def _without_row_count_misses(one: DataFrame, checks: list) -> DataFrame:
    """Row counts have no unexpected rows: NULL, as in the full suite."""
    return one.select(*[
        F.lit(None).cast("bigint").alias(c) if c[0] == "u"
        and checks[int(c[1:])].name == "df_count_btw" else F.col(c) for c in one.columns])


def _kept(spark: SparkSession, root: str, kind: str, state: dict, runs: list[str]):
    """State rows that count: those of each partition's own run."""
    folders = [f"{root}/{kind}/run={r}" for r in runs]
    if not folders:
        return None
    rows = spark.read.option("basePath", f"{root}/{kind}").parquet(*folders)
    own = spark.createDataFrame([(v, s["run"]) for v, s in state.items()],
                                "by string, run string")
    return rows.withColumn("run", F.col("run").cast("string")).join(
        F.broadcast(own), ["by", "run"], "left_semi")
