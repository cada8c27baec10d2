"""Schema state of landed JSON: key -> widest type, kept per day and merged.

The keys of a day are found once, by Spark's own inference (a tree aggregate over
the day's records) or from the frame that was landed, and kept next to the day:
``{base}/_schemas/{day}.json``. The union over days merges these states with the
type lattice; records of earlier days are not read again, whatever new keys a later
day brings. A day landed again replaces its state; a state older than its day's
files is not trusted.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.lattice import merge_schemas, without_void
from ..lake import filesystem, read_text, replace_text
from .landing import (DAY_COLUMN, RESERVED_COLUMN, TEXT_TIME_OPTIONS, _json_options, day_dir,
                      landing_days)

STATES = "_schemas"


def state_path(base: str, day: str) -> str:
    return f"{base.rstrip('/')}/{STATES}/{day}.json"


def _newest(spark: SparkSession, folder: str) -> int:
    """Time of the newest data file of a day (0 without files)."""
    fs, path = filesystem(spark, folder)
    if not fs.exists(path):
        return 0
    return max((s.getModificationTime() for s in fs.listStatus(path)
                if not s.getPath().getName().startswith(("_", "."))), default=0)


def store_state(spark: SparkSession, base: str, day: str, schema: StructType) -> None:
    """Keep a day's schema, with the time of the newest file it speaks for."""
    replace_text(spark, state_path(base, day), json.dumps(
        {"newest": _newest(spark, day_dir(base, day)), "schema": schema.jsonValue()}))


def load_state(spark: SparkSession, base: str, day: str) -> StructType | None:
    """A day's schema; None when there is none or files came after it."""
    text = read_text(spark, state_path(base, day))
    if text is None:
        return None
    state = json.loads(text)
    if state["newest"] != _newest(spark, day_dir(base, day)):
        return None
    return StructType.fromJson(state["schema"])


def infer_state(spark: SparkSession, base: str, day: str, multi_line: bool = False) -> StructType:
    """One inference pass over the records of ``day``; a malformed record fails it."""
    reader = spark.read.options(**_json_options(multi_line),
                                columnNameOfCorruptRecord=RESERVED_COLUMN)
    return reader.json(day_dir(base, day)).schema


def day_state(spark: SparkSession, base: str, day: str, multi_line: bool = False) -> StructType:
    """The day's schema: kept, or found and kept now."""
    state = load_state(spark, base, day)
    if state is None:
        state = infer_state(spark, base, day, multi_line)
        store_state(spark, base, day, state)
    return state


def union_schema(spark: SparkSession, base: str, days: list[str] | None = None,
                 multi_line: bool = False) -> StructType:
    """Widest type of every key over days; only days without a state are read."""
    days = landing_days(spark, base) if days is None else days
    return merge_schemas(*(day_state(spark, base, d, multi_line) for d in days))


def read_union(spark: SparkSession, base: str, days: list[str] | None = None,
               multi_line: bool = False) -> DataFrame:
    """The records of several JSON days under one schema, with ``ingest_date`` as text.

    Values whose types differ over days come in the widest type; nested values that
    meet plain ones come as their JSON text. A key named like the day column is
    hidden by it, as in any partitioned read.
    """
    days = landing_days(spark, base) if days is None else days
    if not days:
        raise ValueError("no day to read")
    schema = without_void(union_schema(spark, base, days, multi_line))
    reader = (spark.read.options(**_json_options(multi_line)).options(**TEXT_TIME_OPTIONS)
              .option("basePath", base.rstrip("/")).schema(schema))
    df = reader.json([day_dir(base, d) for d in days])
    return df.withColumn(DAY_COLUMN, F.col(DAY_COLUMN).cast("string"))
