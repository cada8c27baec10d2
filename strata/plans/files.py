"""Jobs driven by parameter and SQL files in the original folder layout.

::

    base/
      params/{source}/{table}.json   landing + silver parameters (schema, target, ext, sep)
      params/silver/{table}.json     gold parameters (source 'silver')
      params/quality/{table}.json    quality suite ({"quality_params": {...}})
      query/gold/{name}.sql          gold SQL, looked up by an explicit name
                                     (default: the gold target table)
      query/quality/{table}.sql      the frame the suite checks

These functions only read the files on the driver and call the jobs in
``plans.jobs``; all data work stays in Spark.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..lake import Lake
from ..operators.silver import bind_positionally
from ..params import (GoldParams, IngestParams, ParamError, QualityParams, landing_read_schema,
                      load_json, params_path, read_sql_text)
from ..sources.landing import RESERVED_COLUMN, read_csv
from .jobs import bronze_to_silver, capture, data_quality, silver_to_gold

# Formats a day's records can be captured from.
RECORD_FORMATS = ("json", "csv", "parquet")


def read_records(spark: SparkSession, path: str, fmt: str = "json",
                 multi_line: bool = False, schema: str | None = None, sep: str = ",",
                 header: bool = True) -> DataFrame:
    """The records a source delivered as files (JSON lines or arrays, CSV, Parquet).

    With a reader schema JSON is read once and undeclared keys are not read.
    Without one its keys are unioned over all records (a missing key is NULL),
    which costs Spark one inference pass over the files; values are kept as the
    text they were delivered as. A malformed JSON record fails the read. CSV is
    read as text, bound by name over files with different headers. Types are
    bound later, in silver.
    """
    if fmt == "json":
        reader = spark.read.options(multiLine=str(bool(multi_line)).lower(), mode="FAILFAST",
                                    primitivesAsString="true")
        if schema is not None:
            reader = reader.schema(schema)
        return reader.json(path)
    if fmt == "csv":
        return read_csv(spark, path, sep=sep, header=header, multi_line=multi_line)
    if fmt == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported record format {fmt!r}; use one of {RECORD_FORMATS}")


def split_records(spark: SparkSession, path: str, schema: str | StructType | None = None,
                  ) -> tuple[DataFrame, DataFrame, Observation]:
    """(good records, malformed lines, number of malformed lines) of JSON lines.

    Lines are read as text and parsed by expression, so that the malformed ones
    keep their text. Without a schema it is inferred from the good lines first,
    one more pass; any key is a column name. The number is observed, as
    ``malformed``, while the good records are read, so a delivery without malformed
    lines is not read again for them.
    """
    if schema is None:
        reader = spark.read.options(mode="DROPMALFORMED", primitivesAsString="true",
                                    columnNameOfCorruptRecord=RESERVED_COLUMN)
        schema = reader.json(path).schema
        if not schema.fields:
            raise ParamError(f"no line of {path} is a JSON record with a key")
    elif isinstance(schema, str):
        schema = StructType.fromDDL(schema)
    wide = StructType([*schema.fields, StructField(RESERVED_COLUMN, StringType())])
    lines = spark.read.text(path).where(F.trim("value") != "")
    parsed = lines.select("value", F.from_json("value", wide, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESERVED_COLUMN}).alias("r"))
    broken = F.col("r").getField(RESERVED_COLUMN).isNotNull()
    seen = Observation("malformed lines")
    good = parsed.observe(seen, F.count_if(broken).alias("malformed")).where(~broken)
    return (good.select(*[F.col("r").getField(f.name).alias(f.name) for f in schema.fields]),
            parsed.where(broken).select("value"), seen)


def capture_from_files(spark: SparkSession, lake: Lake, base: str | Path, source: str,
                       table: str, day: str, records_path: str, records_format: str = "json",
                       multi_line: bool = False, logs_db: str = "logs",
                       declared_only: bool | None = None, balance: bool = False,
                       quarantine: bool = False) -> str:
    """Land delivered records as the bronze files of ``day``.

    The landing format and separator come from ``params/{source}/{table}.json``
    (``ext``, ``sep``, ``header``), as for the silver job that reads them back;
    delivered CSV has the same separator and header. JSON records are read with
    the declared columns (as text; nested ones typed) whenever the parameters
    declare a schema; ``declared_only=False`` reads all keys, at the price of an
    inference pass. A malformed JSON record fails the job; with ``quarantine``
    (JSON lines) it is written to the landing's ``_malformed`` folder instead
    and counted in the ledger.
    """
    params = IngestParams.from_dict(load_json(spark, params_path(base, source, table)))
    declared = bool(params.schema) if declared_only is None else declared_only
    schema = landing_read_schema(params.require_schema()) if declared else None
    malformed, seen = None, None
    if quarantine and records_format == "json":
        if multi_line:
            raise ParamError("only JSON lines can be quarantined one by one")
        records, malformed, seen = split_records(spark, records_path, schema)
    else:
        records = read_records(spark, records_path, records_format, multi_line, schema,
                               params.sep, params.header)
        if records_format == "csv" and not params.header and params.schema:
            records = bind_positionally(records, params.schema)
    return capture(spark, records, lake, source, table, day, ext=params.ext, sep=params.sep,
                   header=params.header, logs_db=logs_db, balance=balance, malformed=malformed,
                   malformed_seen=seen)


def silver_from_files(spark: SparkSession, lake: Lake, base: str | Path, source: str,
                      table: str, day: str, logs_db: str = "logs") -> DataFrame:
    params = IngestParams.from_dict(load_json(spark, params_path(base, source, table)))
    return bronze_to_silver(spark, lake, source, table, day, params, logs_db=logs_db)


def gold_from_files(spark: SparkSession, lake: Lake, base: str | Path, table: str,
                    source: str = "silver", sql_name: str | None = None,
                    logs_db: str = "logs") -> DataFrame:
    params = GoldParams.from_dict(load_json(spark, params_path(base, source, table)))
    sql = read_sql_text(spark, base, "gold", sql_name or params.target_table)
    return silver_to_gold(spark, lake, sql, params, source=source, logs_db=logs_db)


def quality_from_files(spark: SparkSession, lake: Lake, base: str | Path, table: str,
                       logs_db: str = "logs", stop_job: bool | None = None) -> DataFrame:
    params = QualityParams.from_dict(load_json(spark, params_path(base, "quality", table)))
    sql = read_sql_text(spark, base, "quality", table)
    return data_quality(spark, lake, table, sql, params, logs_db=logs_db, stop_job=stop_job)
