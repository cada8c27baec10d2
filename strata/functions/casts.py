"""Casts from landed text to declared types.

Landed files are all text. The declared type of a column is applied with the
lenient meaning: text that does not parse becomes NULL instead of failing the
job (the behaviour of a non-ANSI ``cast``), independent of
``spark.sql.ansi.enabled``. ``try_cast`` gives that meaning for every type but
integers, where the non-ANSI cast truncates a fraction (``'1.0'`` and ``'1.5'``
give 1) and ``try_cast`` gives NULL. Integer fields with a gap are written as
``1.0`` by common writers, so for integer targets the fraction is removed from
the text first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INTEGRAL_TYPES = frozenset(
    {"tinyint", "byte", "smallint", "short", "int", "integer", "bigint", "long"})

# A trailing fraction (and trailing blanks) on an integer text: '12.0 ' -> '12'.
_FRACTION = r"\.[0-9]*\s*$"


def normalize_type(type_name: str) -> str:
    return " ".join(str(type_name).strip().lower().split())


def lenient_cast(c: Column, type_name: str) -> Column:
    """Cast text to ``type_name``; malformed values become NULL."""
    t = normalize_type(type_name)
    if t in ("string", "varchar", "text"):
        return c.cast("string")
    if t in INTEGRAL_TYPES:
        # the pattern needs a '.', so most values skip the regex engine
        trimmed = F.when(c.contains("."), F.regexp_replace(c, _FRACTION, "")).otherwise(c)
        return trimmed.try_cast(t)
    return c.try_cast(t)


def lost_in_cast(raw: Column, typed: Column) -> Column:
    """True where a present value did not survive the cast."""
    return raw.isNotNull() & typed.isNull()
