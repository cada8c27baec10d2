"""Bronze -> silver: bind landed text to the declared schema.

* declared columns are taken **by name**, in declared order, and cast with the
  lenient cast (``functions.casts``);
* undeclared columns of the file are dropped;
* a declared column missing from the file becomes a typed NULL column (with
  ``strict=False`` it is skipped, as a plain select would do);
* the partition column is moved last, where partitioned tables keep it.

All of it is one projection over the scan: no shuffle, and the scan reads only
the declared columns.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.casts import lenient_cast, lost_in_cast
from ..functions.names import column


def _index(df: DataFrame) -> dict[str, str]:
    return {c.lower(): c for c in df.columns}


def _ref(name: str) -> Column:
    return column(name)


def partition_last(names: Sequence[str], partition_column: str | None) -> list[str]:
    if not partition_column:
        return list(names)
    rest = [n for n in names if n.lower() != partition_column.lower()]
    moved = [n for n in names if n.lower() == partition_column.lower()]
    return rest + moved


def bind_positionally(df: DataFrame, schema: Sequence[tuple[str, str]]) -> DataFrame:
    """Name the columns of a header-less file by declared order.

    Without a header there are no names to bind by; the i-th field is the i-th
    declared column. Extra fields are dropped; missing ones stay absent (and
    become typed NULL columns in ``conform``).
    """
    names = [n for n, _ in schema]
    keep = df.columns[:len(names)]
    return df.select(*[_ref(c).alias(names[i]) for i, c in enumerate(keep)])


def _typed_columns(df: DataFrame, schema: Sequence[tuple[str, str]],
                   partition_column: str | None, strict: bool) -> list[Column]:
    present = _index(df)
    cols: dict[str, Column] = {}
    for name, type_name in schema:
        src = present.get(name.lower())
        if src is not None:
            cols[name] = lenient_cast(_ref(src), type_name).alias(name)
        elif strict:
            cols[name] = F.lit(None).cast(type_name).alias(name)
    return [cols[n] for n in partition_last(list(cols), partition_column)]


def conform(df: DataFrame, schema: Iterable[tuple[str, str]],
            partition_column: str | None = None, strict: bool = True) -> DataFrame:
    """Select and cast ``df`` to the declared ``schema`` (name -> type)."""
    return df.select(*_typed_columns(df, list(schema), partition_column, strict))


def conform_observed(df: DataFrame, schema: Iterable[tuple[str, str]],
                     partition_column: str | None, observation: Observation,
                     strict: bool = True) -> DataFrame:
    """``conform`` plus metrics gathered by the action that consumes the rows.

    ``observation`` receives ``rows`` and, per declared column present in the
    file, ``lost:<column>`` (present values the cast turned into NULL). The
    metrics ride along the write: no second pass over the files.
    """
    schema = list(schema)
    present = _index(df)
    raw_cols = [(n, present[n.lower()]) for n, _ in schema if n.lower() in present]
    typed = _typed_columns(df, schema, partition_column, strict)
    names = [n for n, _ in schema if strict or n.lower() in present]
    names = partition_last(names, partition_column)
    wide = df.select(*typed, *[_ref(src).alias(f"__raw_{i}")
                               for i, (_, src) in enumerate(raw_cols)])
    metrics = [F.count(F.lit(1)).alias("rows")]
    for i, (name, _) in enumerate(raw_cols):
        metrics.append(F.count_if(lost_in_cast(F.col(f"__raw_{i}"), _ref(name)))
                       .alias(f"lost:{name}"))
    return wide.observe(observation, *metrics).select(*[_ref(n) for n in names])


def cast_losses(df: DataFrame, schema: Iterable[tuple[str, str]]) -> DataFrame:
    """Per declared column, how many present values became NULL in the cast.

    One aggregate over the scan; returns ``(column_name, declared_type,
    present, lost)`` with one row per declared column found in ``df``.
    """
    present = _index(df)
    pairs = [(n, t, present[n.lower()]) for n, t in schema if n.lower() in present]
    if not pairs:
        raise ValueError("no declared column is present in the frame")
    aggs = []
    for i, (name, type_name, src) in enumerate(pairs):
        raw = _ref(src)
        aggs.append(F.count(raw).alias(f"p{i}"))
        aggs.append(F.count_if(lost_in_cast(raw, lenient_cast(raw, type_name))).alias(f"l{i}"))
    one = df.agg(*aggs)
    rows = [
        F.named_struct(
            F.lit("column_name"), F.lit(name),
            F.lit("declared_type"), F.lit(type_name),
            F.lit("present"), F.col(f"p{i}"),
            F.lit("lost"), F.col(f"l{i}"),
        )
        for i, (name, type_name, _) in enumerate(pairs)
    ]
    return one.select(F.inline(F.array(*rows)))
