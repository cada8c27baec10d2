"""Catalog tables: databases, DDL and writes by column name.

Tables are external Parquet tables (``USING parquet ... LOCATION``), created
once when missing, from a declared schema (silver) or from a result schema
(gold, any Spark type). Writes:

* bind columns **by name** to the table's columns (a positional insert shifts
  every column after a partition column that is not last);
* ``overwrite`` replaces only the partitions present in the new data
  (dynamic partition overwrite); ``full_overwrite=True`` replaces the table;
* ``append`` adds files;
* before writing a partitioned table the rows are rebalanced by the partition
  column: AQE sizes the output partitions and splits a value that holds a large
  share of the rows, so each partition gets a few full files, not one small
  file per input task, and no value lands in a single task.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Sequence
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.names import quote
from ..lake import definition_path, filesystem, read_text, write_text
from .silver import partition_last


def qualified(table: str) -> str:
    return ".".join(quote(p) for p in table.split("."))


def ensure_database(spark: SparkSession, database: str, location: str | None = None) -> None:
    """Create ``database`` when missing, in ``location`` when given."""
    if not spark.catalog.databaseExists(database):
        sql = f"CREATE DATABASE IF NOT EXISTS {quote(database)}"
        if location:
            sql += " LOCATION '" + location.replace("'", "\\'") + "'"
        spark.sql(sql)


def columns_of(schema: StructType) -> list[tuple[str, str]]:
    """(name, DDL type) of a result schema; any Spark type is allowed."""
    return [(f.name, f.dataType.simpleString()) for f in schema.fields]


#: Option of partitioned tables: an insert replaces the partitions of its rows only. The
#: table's option counts before the session's mode, so no insert depends on it.
DYNAMIC = {"partitionOverwriteMode": "dynamic"}


def create_table_sql(table: str, columns: Sequence[tuple[str, str]],
                     partition_column: str | None, location: str,
                     compression: str | None = None) -> str:
    names = partition_last([n for n, _ in columns], partition_column)
    types = {n: t for n, t in columns}
    if partition_column and partition_column not in types:
        raise ValueError(f"partition column {partition_column!r} is not a column of {table}")
    body = ",\n  ".join(f"{quote(n)} {types[n]}" for n in names)
    sql = f"CREATE TABLE IF NOT EXISTS {qualified(table)} (\n  {body}\n) USING parquet"
    options = {"compression": compression.lower()} if compression else {}
    if partition_column:
        options |= DYNAMIC
    if options:
        sql += "\nOPTIONS (" + ", ".join(f"'{k}' = '{v}'" for k, v in options.items()) + ")"
    if partition_column:
        sql += f"\nPARTITIONED BY ({quote(partition_column)})"
    loc = location.replace("'", "\\'")
    return sql + f"\nLOCATION '{loc}'"


# Partition columns per (session, table). Tables are created once and never
# altered, so the answer cannot change; ``listColumns`` costs a Spark job.
_PARTITIONS: dict[tuple[int, str], list[str]] = {}


def ensure_table(spark: SparkSession, table: str, columns: Sequence[tuple[str, str]],
                 partition_column: str | None, location: str,
                 compression: str | None = None) -> bool:
    """Create ``table`` when missing; True when it was created."""
    database = table.split(".")[0] if "." in table else None
    if database:
        # the database folder sits next to its tables, under the lake root
        ensure_database(spark, database, location.rstrip("/").rsplit("/", 1)[0])
    if spark.catalog.tableExists(table):
        key = (id(spark), location)
        if key not in _RECORDED:
            fs, path = filesystem(spark, definition_path(location))
            if not fs.exists(path):
                # a table made elsewhere (a metastore, an older run): record it
                # as the catalog has it, so a later registration keeps its types
                parts = partition_columns(spark, table)
                _record(spark, location, columns_of(spark.table(table).schema),
                        parts[0] if parts else None, compression)
            _RECORDED.add(key)
        return False
    spark.sql(create_table_sql(table, columns, partition_column, location, compression))
    _PARTITIONS[(id(spark), table.lower())] = [partition_column] if partition_column else []
    _record(spark, location, columns, partition_column, compression)
    _RECORDED.add((id(spark), location))
    return True


# (session, table folder) pairs whose definition is known to be recorded.
_RECORDED: set[tuple[int, str]] = set()


def _record(spark: SparkSession, location: str, columns: Sequence[tuple[str, str]],
            partition_column: str | None, compression: str | None) -> None:
    """Keep the table's definition and make its folder.

    The folder exists from creation on, also before any row is written, so a
    missing folder means the table was removed: its definition is then not
    used again (``register_tables`` only looks at existing folders), and the
    next creation replaces it.
    """
    write_text(spark, definition_path(location), json.dumps({
        "columns": [list(c) for c in columns], "partition_column": partition_column,
        "compression": compression}))
    fs, folder = filesystem(spark, location)
    if not fs.exists(folder):
        fs.delete(filesystem(spark, places_path(location))[1], False)  # of a removed table
        fs.mkdirs(folder)


def partition_columns(spark: SparkSession, table: str) -> list[str]:
    key = (id(spark), table.lower())
    if key not in _PARTITIONS:
        _PARTITIONS[key] = [c.name for c in spark.catalog.listColumns(table) if c.isPartition]
    return list(_PARTITIONS[key])


def align_to_table(df: DataFrame, target: StructType) -> DataFrame:
    """Columns of ``df`` in the order of ``target``, matched by name."""
    by_lower = {c.lower(): c for c in df.columns}
    missing = [f.name for f in target.fields if f.name.lower() not in by_lower]
    if missing:
        raise ValueError(f"frame lacks table columns {missing}")
    extra = set(by_lower) - {f.name.lower() for f in target.fields}
    if extra:
        raise ValueError(f"frame has columns the table does not have: {sorted(extra)}")
    return df.select(*[F.col(quote(by_lower[f.name.lower()])).alias(f.name)
                       for f in target.fields])


#: Folder name of a NULL partition value.
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_PARTITION_TYPE_INFERENCE = "spark.sql.sources.partitionColumnTypeInference.enabled"

# Without AQE, rows of one partition value are spread over this many shuffle
# partitions by a hash of the whole row (deterministic, so a retried task sends
# every row where the first attempt did). The session setting below overrides
# it: without runtime statistics a value's share is unknown, so size it for the
# largest value expected (a value with a third of the day's volume gets a third
# divided by the buckets per task), against more, smaller files for small values.
SALT_BUCKETS = 32
SALT_BUCKETS_CONF = "spark.strata.write.saltBuckets"


def spread_by_partition(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Shuffle rows so that each output task writes few partition values.

    With AQE (Spark's default) this is a REBALANCE: output partitions are sized
    to ``spark.sql.adaptive.advisoryPartitionSizeInBytes`` and a value holding
    many rows is split over several tasks. Without AQE a hash of the row salts
    each partition value over ``SALT_BUCKETS`` shuffle partitions (session
    setting ``spark.strata.write.saltBuckets``).
    """
    spark = df.sparkSession
    if spark.conf.get("spark.sql.adaptive.enabled", "true").lower() == "true":
        return df.hint("rebalance", *[F.col(quote(p)) for p in parts])
    buckets = int(spark.conf.get(SALT_BUCKETS_CONF, str(SALT_BUCKETS)))
    salt = F.pmod(F.xxhash64(*[F.col(quote(c)) for c in df.columns]), F.lit(buckets))
    return df.repartition(*[F.col(quote(p)) for p in parts], salt)


@contextmanager
def _session_conf(spark: SparkSession, key: str, value: str):
    """Set a runtime SQL setting for the duration of one action."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def write_by_name(df: DataFrame, table: str, mode: str = "overwrite",
                  full_overwrite: bool = False, rebalance: bool = True,
                  written: Observation | None = None) -> None:
    """Insert ``df`` into ``table`` matching columns by name.

    ``written`` receives ``rows``, counted in the stage that writes: a re-run of
    an earlier stage does not count rows twice.

    Overwriting a partitioned table replaces the partitions of its rows, whatever
    the session's mode: that is an option of the table (``insertInto`` reads none
    from the writer), set here for tables made without it. ``full_overwrite`` stages
    the rows and publishes them as the whole table.
    """
    spark = df.sparkSession
    target = spark.table(table).schema
    parts = partition_columns(spark, table)
    out = align_to_table(df, target)
    if parts and rebalance:
        out = spread_by_partition(out, parts)
    if written is not None:
        out = out.observe(written, F.count(F.lit(1)).alias("rows"))
    if parts and mode == "overwrite":
        if full_overwrite:
            from .publish import replace_all  # which writes by this module

            replace_all(out, table, table_location(spark, table))
            return
        _replaces_own_partitions(spark, table)
    out.write.format("parquet").mode(mode).insertInto(table)


def _metadata(spark: SparkSession, table: str):
    """The catalog's entry of a table (a JVM object)."""
    state = spark._jsparkSession.sessionState()
    return state.catalog().getTableMetadata(state.sqlParser().parseTableIdentifier(
        qualified(table)))


def table_location(spark: SparkSession, table: str) -> str:
    """Folder of a table as the catalog has it."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return path(_metadata(spark, table).location()).toString()


def _replaces_own_partitions(spark: SparkSession, table: str) -> None:
    """Give a table made elsewhere the option ``DYNAMIC``."""
    properties = _metadata(spark, table).storage().properties()
    key, value = next(iter(DYNAMIC.items()))
    if properties.get(key).isEmpty() or properties.apply(key) != value:
        spark.sql(f"ALTER TABLE {qualified(table)} SET SERDEPROPERTIES ('{key}' = '{value}')")


def definition_of(spark: SparkSession, location: str) -> dict:
    """The recorded definition of a table (empty without one)."""
    return json.loads(read_text(spark, definition_path(location)) or "{}")


def places_path(location: str, generation: int = 0) -> str:
    """Where the places of a table's published partitions are recorded.

    A change of the table's types begins a new generation (``operators.evolution``);
    the definition says which one counts.
    """
    suffix = f".places.{generation}.json" if generation else ".places.json"
    return definition_path(location).removesuffix(".json") + suffix


def recorded_places(spark: SparkSession, location: str) -> dict[str, str]:
    """Partition value -> folder of the partitions that were published."""
    generation = definition_of(spark, location).get("generation", 0)
    return json.loads(read_text(spark, places_path(location, generation)) or "{}")


def apply_places(spark: SparkSession, table: str, places: dict[str, str],
                 partition_column: str | None) -> None:
    """Point the catalog's partitions (or the whole table, value ``""``) at their folders."""
    there = set()
    if partition_column is not None:
        there = {r[0] for r in spark.sql(f"SHOW PARTITIONS {qualified(table)}").collect()}
    for value, folder in places.items():
        at = "LOCATION '" + folder.replace("'", "\\'") + "'"
        if partition_column is None:
            spark.sql(f"ALTER TABLE {qualified(table)} SET {at}")
            continue
        spec = _partition_spec(partition_column, value)
        spark.sql(f"ALTER TABLE {qualified(table)} ADD IF NOT EXISTS {spec} {at}")
        if there:
            spark.sql(f"ALTER TABLE {qualified(table)} {spec} SET {at}")
    spark.catalog.refreshTable(table)


def partition_values(spark: SparkSession, table: str, partition_column: str) -> list[str]:
    """Values of a table's partitions as text (the default partition's name for NULL)."""
    jvm = spark.sparkContext._jvm
    found = spark._jsparkSession.sessionState().catalog().listPartitions(
        _metadata(spark, table).identifier(), jvm.scala.Option.apply(None))
    iterator, out = found.iterator(), []
    while iterator.hasNext():
        out.append(iterator.next().spec().apply(partition_column))
    return out


def _partition_spec(partition_column: str, value: str) -> str:
    text = "NULL" if value == NULL_PARTITION else "'" + value.replace("'", "\\'") + "'"
    return f"PARTITION ({quote(partition_column)} = {text})"


def drop_partitions(spark: SparkSession, table: str, partition_column: str,
                    keep: set[str]) -> list[str]:
    """Drop the catalog's partitions that are not in ``keep`` (files stay)."""
    gone = [v for v in partition_values(spark, table, partition_column) if v not in keep]
    for value in gone:
        spark.sql(f"ALTER TABLE {qualified(table)} DROP IF EXISTS "
                  + _partition_spec(partition_column, value))
    spark.catalog.refreshTable(table)
    return gone


def table_columns(spark: SparkSession, table: str) -> list[tuple[str, str, bool]]:
    """(name, type, is_partition) of a catalog table, in table order."""
    return [(c.name, c.dataType, c.isPartition) for c in spark.catalog.listColumns(table)]


def list_tables(spark: SparkSession, databases: Iterable[str]) -> list[tuple[str, str]]:
    out = []
    for db in databases:
        for t in spark.catalog.listTables(db):
            out.append((db, t.name))
    return out


def register_tables(spark: SparkSession, lake,
                    needed: Callable[[str, str], bool] = lambda database, table: True,
                    ) -> list[str]:
    """Catalog entries for the lake's table folders that the catalog lacks.

    ``needed(database, table)`` tells which of them the job can touch; the
    others cost no more than the listing.

    With a catalog that does not outlive its session (Spark's in-memory one),
    each job run as a process of its own starts with no tables. Every folder
    ``{layer}/{database}/{table}`` becomes an external table again, with the
    definition recorded when it was created (exact column and partition
    types), then its partitions are recovered. A folder without a recorded
    definition (written before definitions were kept, and never seen by a
    catalog since) takes its schema from the Parquet files and keeps partition
    values as text: no type guessing, so ``007`` stays ``007`` at the price of
    a numeric partition column reading as text; one without data files either
    is skipped. A definition whose folder is gone (a removed table) is not
    used. Returns the names registered. Metadata only: listing, footers, no
    data pass.
    """
    made = []
    for database, table, folder in lake.table_folders(spark):
        name = f"{database}.{table}"
        if not needed(database, table):
            continue
        ensure_database(spark, database, folder.rstrip("/").rsplit("/", 1)[0])
        if spark.catalog.tableExists(name):
            continue
        recorded = read_text(spark, definition_path(folder))
        if recorded is not None:
            d = json.loads(recorded)
            spark.sql(create_table_sql(name, [tuple(c) for c in d["columns"]],
                                       d.get("partition_column"), folder,
                                       d.get("compression")))
        else:
            loc = folder.replace("'", "\\'")
            try:
                with _session_conf(spark, _PARTITION_TYPE_INFERENCE, "false"):
                    spark.sql(f"CREATE TABLE {qualified(name)} USING parquet LOCATION '{loc}'")
            except AnalysisException:  # no data file to take a schema from
                continue
        parts = partition_columns(spark, name)
        if parts:
            spark.sql(f"ALTER TABLE {qualified(name)} RECOVER PARTITIONS")
        places = recorded_places(spark, folder)
        if places:  # published partitions lie elsewhere (operators.publish)
            apply_places(spark, name, places, parts[0] if parts else None)
        made.append(name)
    return made
