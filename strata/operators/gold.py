"""Silver -> gold: one SQL text into one table.

The SQL is handed to ``spark.sql`` unchanged (joins, aggregates, windows: all
of Spark SQL is available and planned by Catalyst). The table is created from
the result schema when missing, with the partition column last, and the rows
are written by column name, so the partition column may sit anywhere in the
SELECT list.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..lake import Lake
from ..params import GoldParams
from .tables import columns_of, ensure_table, write_by_name


def clean_sql(text: str) -> str:
    """SQL text of a file: surrounding blanks and trailing ``;`` removed."""
    body = text.strip()
    while body.endswith(";"):
        body = body[:-1].rstrip()
    return body


def gold_frame(spark: SparkSession, sql_text: str) -> DataFrame:
    return spark.sql(clean_sql(sql_text))


def build_gold(spark: SparkSession, sql_text: str, params: GoldParams, lake: Lake,
               ledger=None, full_overwrite: bool = False) -> DataFrame:
    """Run ``sql_text`` and write its rows into ``params.table``.

    Returns the target table as a DataFrame.
    """
    step = ledger.step if ledger is not None else _no_step
    with step("run_query"):
        df = gold_frame(spark, sql_text)
    with step("create_table"):
        ensure_table(spark, params.table, columns_of(df.schema), params.partition_column,
                     lake.location("gold", params.target_schema, params.target_table),
                     params.compression)
    with step("write_table"):
        write_by_name(df, params.table, mode=params.mode, full_overwrite=full_overwrite)
    return spark.table(params.table)


class _NoStep:
    def __enter__(self):
        return self

    def __exit__(self, *exc):
        return False


def _no_step(_name: str) -> _NoStep:
    return _NoStep()
