"""Column names as Spark identifiers (any character, including dots and backticks)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def quote(name: str) -> str:
    """``name`` as a quoted identifier: a dot is part of the name, not a field path."""
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(quote(name))
