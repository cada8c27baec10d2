"""Tables whose declared schema changes.

The recorded definition is compared with the declared one:

* **new columns** are added by DDL, before the partition column; older files have
  no such column and read as NULL;
* **widened types** (``functions.lattice.keeps_values``: every old value is the same
  value, or its text, in the new type) need the files rewritten, since a Parquet file
  keeps the type it was written with. The rows are written once more, partition by
  partition as the table has them, to a stage of their own; then the new definition,
  which names a new generation of partition places, is recorded in one step, and the
  catalog brought in line. Until then, and after a crash before it, the table is the
  old one;
* **columns no longer declared** stay, and are NULL in new rows;
* **narrowed or unrelated types**, another partition column and a partition column of
  another type are refused with all reasons at once, before anything changes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ..functions.lattice import keeps_values
from ..functions.names import column, quote
from ..lake import definition_path, replace_text
from .publish import Stage, places_of
from .tables import (apply_places, columns_of, create_table_sql, definition_of, partition_columns,
                     places_path, qualified, spread_by_partition)


class SchemaEvolutionError(ValueError):
    """A declared schema the table cannot become without losing values."""


@dataclass(frozen=True)
class SchemaChange:
    """Column -> type, in declared order."""

    added: dict[str, str]
    widened: dict[str, str]
    undeclared: list[str]

    def __bool__(self) -> bool:
        return bool(self.added or self.widened)


def _type(name: str) -> DataType:
    return DataType.fromDDL(name)


def schema_change(spark: SparkSession, table: str, declared: Sequence[tuple[str, str]],
                  partition_column: str | None) -> SchemaChange:
    """What ``declared`` changes in ``table``; raises where values would be lost."""
    current = {f.name.lower(): f for f in spark.table(table).schema.fields}
    parts = [p.lower() for p in partition_columns(spark, table)]
    refused, added, widened = [], {}, {}
    if parts != ([partition_column.lower()] if partition_column else []):
        refused.append(f"partition column {partition_column!r} instead of {parts or None}")
    for name, kind in declared:
        own, new = current.get(name.lower()), _type(kind)
        if own is None:
            added[name] = kind
        elif own.dataType != new:
            if name.lower() in parts:
                refused.append(f"partition column {name}: {own.dataType.simpleString()} "
                               f"to {new.simpleString()}")
            elif keeps_values(own.dataType, new):
                widened[own.name] = kind
            else:
                refused.append(f"{name}: {own.dataType.simpleString()} to {new.simpleString()}")
    if refused:
        raise SchemaEvolutionError(f"{table} cannot take the declared schema: "
                                   + "; ".join(refused))
    known = {n.lower() for n, _ in declared}
    return SchemaChange(added, widened, [f.name for k, f in current.items() if k not in known])


def evolve_table(spark: SparkSession, table: str, declared: Sequence[tuple[str, str]],
                 partition_column: str | None, location: str) -> SchemaChange:
    """Bring an existing table to the declared schema."""
    change = schema_change(spark, table, declared, partition_column)
    if change.added:
        columns = ", ".join(f"{quote(n)} {t}" for n, t in change.added.items())
        spark.sql(f"ALTER TABLE {qualified(table)} ADD COLUMNS ({columns})")
        spark.catalog.refreshTable(table)
        definition = definition_of(spark, location) | {
            "columns": [list(c) for c in columns_of(spark.table(table).schema)]}
        replace_text(spark, definition_path(location), json.dumps(definition))
    if change.widened:
        _rewrite(spark, table, change.widened, location.rstrip("/"))
    return change


def _rewrite(spark: SparkSession, table: str, widened: dict[str, str], location: str) -> None:
    rows = spark.table(table)
    parts = partition_columns(spark, table)
    wide = rows.select(*[column(f.name).cast(widened[f.name]).alias(f.name)
                         if f.name in widened else column(f.name) for f in rows.schema.fields])
    definition = definition_of(spark, location)
    generation = definition.get("generation", 0) + 1
    stage = Stage(table, location, f"generation-{generation}", parts[0] if parts else None)
    out = spread_by_partition(wide, parts) if parts else wide
    writer = out.write.mode("overwrite")  # of an attempt that did not get to its record
    writer = writer.partitionBy(*parts) if parts else writer
    if definition.get("compression"):
        writer = writer.option("compression", definition["compression"].lower())
    writer.parquet(stage.folder)
    places = places_of(spark, stage)
    replace_text(spark, places_path(location, generation), json.dumps(places))
    columns = columns_of(wide.schema)
    new = definition | {"columns": [list(c) for c in columns], "generation": generation,
                        "partition_column": stage.partition,
                        "compression": definition.get("compression")}
    replace_text(spark, definition_path(location), json.dumps(new))
    spark.sql(f"DROP TABLE {qualified(table)}")  # the entry; the files are the lake's
    spark.sql(create_table_sql(table, columns, stage.partition, location, new["compression"]))
    apply_places(spark, table, places, stage.partition)


def with_table_columns(df: DataFrame, table: str) -> DataFrame:
    """``df`` with the table's columns that it lacks as NULL."""
    have = {c.lower() for c in df.columns}
    missing = [f for f in df.sparkSession.table(table).schema.fields if f.name.lower() not in have]
    return df.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
