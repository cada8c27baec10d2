"""Data-quality suite as Spark jobs.

A suite is an ordered list of checks read from ``quality_params``
(``{check_name: params}``, as in the original parameter files). Parameters may
be comma-separated strings zipped by position, or JSON lists. When a check
names a single column its other parameters are taken whole, so a regular
expression or mask that contains a comma stays one rule.

Evaluation:

* every row-level check (not null, length between, values between, regex,
  strftime mask) and the row count become aggregate expressions of **one**
  ``agg`` over the frame: one scan, per-task partial aggregation, a one-row
  result;
* all uniqueness checks share **one** shuffle: each row contributes one slot
  per checked column (column number + the value in a field of its own type),
  slots are counted by value with map-side partial
  aggregation (a value that fills a third of the table collapses to one row per
  task before the shuffle), then a global aggregate sums the counts of values
  seen more than once.

The report is a DataFrame, one row per (check, column) in suite order:
``check_order, column_name, check_name, expectation, element_count,
unexpected_count, success, status``. ``element_count`` is the number of values
evaluated (non-NULL values for value checks, all rows for ``not_null`` and the
row count). NULL values never fail a value check. ``gate`` reduces a report to
one row; ``enforce`` raises when the gate fails.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal, InvalidOperation, localcontext
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DataType, DecimalType, DoubleType, FloatType,
                               IntegerType, LongType, ShortType)

from ..functions.names import quote
from ..functions.strftime import mask_columns, mask_valid, plan_mask
from ..params import ParamError, QualityParams
from .unique_filter import repeated_values

# Fixed texts of the report, as the original report shows them.
DATASET_LABEL = "Test on dataset"
STATUS_SUCCESS = "Success"
STATUS_FAILED = "Failed"
EXPECTATION_TEXT = {
    "not_null": "Not Null values",
    "unique_vals": "Unique values",
    "date_mask_equal": "Date mask with mask {date_mask}",
    "value_lenght_btw": "Size of values between {min} and {max}",
    "df_count_btw": "Count between {min} and {max}",
    "value_match_regex": "Column value {column} match with {regex}",
    "values_btw": "Values between {min} and {max}",
}

# Readable spellings accepted for the original check names.
ALIASES = {
    "unique": "unique_vals",
    "value_length_btw": "value_lenght_btw",
    "value_length_between": "value_lenght_btw",
    "values_between": "values_btw",
    "row_count_between": "df_count_btw",
    "match_regex": "value_match_regex",
    "date_mask": "date_mask_equal",
}

# Per check name, the parameter keys zipped with the columns.
_ZIPPED = {
    "not_null": (),
    "unique_vals": (),
    "date_mask_equal": ("date_mask",),
    "value_lenght_btw": ("min", "max"),
    "value_match_regex": ("regex",),
    "values_btw": ("min", "max"),
}

_NUMERIC = (ByteType, ShortType, IntegerType, LongType, FloatType, DoubleType, DecimalType)


@dataclass(frozen=True)
class Check:
    order: int
    name: str
    column: str | None
    args: tuple[tuple[str, str], ...]

    def arg(self, key: str) -> str:
        return dict(self.args)[key]

    @property
    def expectation(self) -> str:
        values = dict(self.args)
        values.setdefault("column", self.column or "")
        return EXPECTATION_TEXT[self.name].format(**values)


def _as_list(value: Any, key: str, split: bool) -> list[str]:
    if isinstance(value, (list, tuple)):
        return [str(v).strip() if key == "column" else str(v) for v in value]
    text = str(value)
    if not split:
        return [text]
    parts = text.split(",")
    return [p.strip() for p in parts] if key in ("column", "min", "max") else parts


def expand(params: QualityParams | dict) -> list[Check]:
    """The suite's checks, one per (check, column), in parameter order."""
    if isinstance(params, dict):
        params = QualityParams.from_dict(params)
    checks: list[Check] = []
    for raw_name, p in params.checks:
        name = ALIASES.get(raw_name, raw_name)
        if name == "df_count_btw":
            lows = _as_list(p["min"], "min", True)
            highs = _as_list(p["max"], "max", True)
            if len(lows) != len(highs):
                raise ParamError(f"{raw_name}: {len(lows)} minimums for {len(highs)} maximums")
            for lo, hi in zip(lows, highs):
                checks.append(Check(len(checks), name, None, (("min", lo), ("max", hi))))
            continue
        if name not in _ZIPPED:
            raise ParamError(f"unknown check {raw_name!r}")
        if "column" not in p:
            raise ParamError(f"{raw_name}: missing 'column'")
        columns = _as_list(p["column"], "column", True)
        many = len(columns) > 1
        zipped = {}
        for key in _ZIPPED[name]:
            if key not in p:
                raise ParamError(f"{raw_name}: missing {key!r}")
            vals = _as_list(p[key], key, many)
            if len(vals) != len(columns):
                raise ParamError(f"{raw_name}: {len(columns)} columns but {len(vals)} {key!r}")
            zipped[key] = vals
        for i, column in enumerate(columns):
            args = tuple((k, zipped[k][i]) for k in _ZIPPED[name])
            checks.append(Check(len(checks), name, column, args))
    return checks


def _number(text: str, check: Check) -> Decimal:
    try:
        return Decimal(text.strip())
    except InvalidOperation as exc:
        raise ParamError(f"{check.name} on {check.column}: bound {text!r} is not a number") from exc


def _int_bound(text: str, check: Check) -> int:
    number = _number(text, check)
    if not number.is_finite() or number != number.to_integral_value():
        raise ParamError(f"{check.name} on {check.column}: bound {text!r} is not a whole number")
    return int(number)


def _between(c: Column, dtype: DataType, check: Check) -> Column:
    """Whether a value lies within the bounds, whatever type they would need.

    For exact types the bounds are moved inwards to the nearest value the type's
    scale can hold, which changes no answer, and cut to just outside its range.
    """
    lo, hi = check.arg("min"), check.arg("max")
    if not isinstance(dtype, _NUMERIC):
        return c.between(F.lit(lo).cast(dtype), F.lit(hi).cast(dtype))
    low, high = _number(lo, check), _number(hi, check)
    if low.is_nan() or high.is_nan():
        raise ParamError(f"{check.name} on {check.column}: a bound is not a number")
    if isinstance(dtype, (FloatType, DoubleType)):
        return c.between(F.lit(float(low)).cast(dtype), F.lit(float(high)).cast(dtype))
    scale = dtype.scale if isinstance(dtype, DecimalType) else 0
    digits = dtype.precision if isinstance(dtype, DecimalType) else 19
    unit, most = Decimal(1).scaleb(-scale), 10 ** digits
    with localcontext() as exact:
        exact.prec = 200
        units = [n * 10 ** scale if n.is_finite() else Decimal(2 * most).copy_sign(n)
                 for n in (low, high)]
        first = units[0].to_integral_value(ROUND_CEILING)
        last = units[1].to_integral_value(ROUND_FLOOR)
        if first > last or first >= most or last <= -most:
            return F.lit(False)
        low, high = max(first, 1 - most) * unit, min(last, most - 1) * unit
    wide = DecimalType(digits, scale)
    return c.cast(wide).between(*(F.lit(f"{n:f}").cast(wide) for n in (low, high)))


def _resolve(df: DataFrame, column: str) -> tuple[Column, DataType]:
    for f in df.schema.fields:
        if f.name.lower() == column.lower():
            return F.col(quote(f.name)), f.dataType
    raise ParamError(f"column {column!r} is not in the checked frame "
                     f"(columns: {', '.join(df.columns)})")


def _row_level(df: DataFrame, check: Check, slot: int) -> tuple[Column, Column, list[Column]]:
    """(element_count, unexpected_count, per-row columns) of one check.

    Per-row columns are computed in a projection before the aggregate, once
    per row (used by the strftime mask, whose fields feed several tests).
    """
    if check.name == "date_mask_equal":
        return _mask_check(df, check, slot)
    element, unexpected = _row_level_counts(df, check)
    return element, unexpected, []


def _row_level_counts(df: DataFrame, check: Check) -> tuple[Column, Column]:
    if check.name == "df_count_btw":
        return F.count(F.lit(1)), F.lit(None).cast("bigint")
    c, dtype = _resolve(df, check.column)
    if check.name == "not_null":
        return F.count(F.lit(1)), F.count_if(c.isNull())
    if check.name == "value_lenght_btw":
        lo = _int_bound(check.arg("min"), check)
        hi = _int_bound(check.arg("max"), check)
        return F.count(c), F.count_if(~F.length(c).between(lo, hi))
    if check.name == "values_btw":
        return F.count(c), F.count_if(c.isNotNull() & ~_between(c, dtype, check))
    if check.name == "value_match_regex":
        return F.count(c), F.count_if(~c.rlike(check.arg("regex")))
    raise ParamError(f"not a row-level check: {check.name}")


def _mask_check(df: DataFrame, check: Check, slot: int) -> tuple[Column, Column, list[Column]]:
    c, _ = _resolve(df, check.column)
    plan = plan_mask(check.arg("date_mask"))
    prefix = f"__mask{slot}"
    pre = mask_columns(c.cast("string"), plan, prefix)
    ok = F.col(f"{prefix}_ok")
    return F.count(c), F.count_if(~mask_valid(plan, ok, F.col(f"{prefix}_f"))), pre


def _report_row(check: Check, element: Column, unexpected: Column,
                success: Column | None = None) -> Column:
    ok = (unexpected == 0) if success is None else success
    ok = F.coalesce(ok, F.lit(False))
    return F.named_struct(
        F.lit("check_order"), F.lit(check.order),
        F.lit("column_name"), F.lit(check.column or DATASET_LABEL),
        F.lit("check_name"), F.lit(check.name),
        F.lit("expectation"), F.lit(check.expectation),
        F.lit("element_count"), F.coalesce(element, F.lit(0)).cast("bigint"),
        F.lit("unexpected_count"), unexpected.cast("bigint"),
        F.lit("success"), ok,
        F.lit("status"), F.when(ok, F.lit(STATUS_SUCCESS)).otherwise(F.lit(STATUS_FAILED)),
    )


def _sql_string(text: str) -> str:
    """A Spark SQL string literal (backslash escapes, the parser's default)."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _report_row_sql(check: Check, element: str, unexpected: str,
                    success: str | None = None) -> str:
    """``_report_row`` as SQL text over the aggregate's columns.

    One expression per row is parsed on the JVM; building the same struct from
    Column calls costs some forty driver round trips per report row.
    """
    ok = f"coalesce({success or f'({unexpected} = 0)'}, false)"
    return (
        "named_struct("
        f"'check_order', {check.order}, "
        f"'column_name', {_sql_string(check.column or DATASET_LABEL)}, "
        f"'check_name', {_sql_string(check.name)}, "
        f"'expectation', {_sql_string(check.expectation)}, "
        f"'element_count', CAST(coalesce({element}, 0) AS BIGINT), "
        f"'unexpected_count', CAST({unexpected} AS BIGINT), "
        f"'success', {ok}, "
        f"'status', CASE WHEN {ok} THEN {_sql_string(STATUS_SUCCESS)} "
        f"ELSE {_sql_string(STATUS_FAILED)} END)"
    )


def _report(one: DataFrame,
            rows: list[tuple[Check, str, str, tuple[int, int] | None]]) -> DataFrame:
    """Report rows from the one-row aggregate ``one``.

    ``rows``: per check, the aggregate's element and unexpected column names and,
    for the row count, its (min, max) bounds.
    """
    raw_literals = one.sparkSession.conf.get(
        "spark.sql.parser.escapedStringLiterals", "false").lower() == "true"
    if raw_literals:  # literals cannot be escaped: build the structs as Columns
        structs = []
        for check, e, u, bounds in rows:
            success = F.col(e).between(*bounds) if bounds else None
            structs.append(_report_row(check, F.col(e), F.col(u), success))
        return one.select(F.inline(F.array(*structs)))
    texts = []
    for check, e, u, bounds in rows:
        success = f"({e} BETWEEN {bounds[0]} AND {bounds[1]})" if bounds else None
        texts.append(_report_row_sql(check, e, u, success))
    return one.select(F.expr("inline(array(" + ", ".join(texts) + "))"))


def _row_level_report(df: DataFrame, checks: list[Check]) -> DataFrame:
    aggs, pre = [], []
    for i, check in enumerate(checks):
        element, unexpected, per_row = _row_level(df, check, i)
        aggs += [element.alias(f"e{i}"), unexpected.alias(f"u{i}")]
        pre += per_row
    source = df.select("*", *pre) if pre else df
    return row_level_report(source.agg(*aggs), checks)


def row_level_counts(df: DataFrame, checks: list[Check], by: Column) -> DataFrame:
    """by, e0, u0, ...: the row-level checks' counts, apart for each value of ``by``."""
    aggs, pre = [], []
    for i, check in enumerate(checks):
        element, unexpected, per_row = _row_level(df, check, i)
        aggs += [element.alias(f"e{i}"), unexpected.alias(f"u{i}")]
        pre += per_row
    return df.select("*", *pre, by.alias("__by")).groupBy(F.col("__by").alias("by")).agg(*aggs)


def row_level_report(one: DataFrame, checks: list[Check]) -> DataFrame:
    """Report of row-level checks from the one row of their counts over all rows."""
    rows = []
    for i, check in enumerate(checks):
        bounds = None
        if check.name == "df_count_btw":
            bounds = (_int_bound(check.arg("min"), check), _int_bound(check.arg("max"), check))
        rows.append((check, f"e{i}", f"u{i}", bounds))
    return _report(one, rows)


def stacked_values(df: DataFrame, checks: list[Check], by: Column | None = None) -> DataFrame:
    """One row per value of the checked columns: k (column number), v0..

    One value field per distinct data type: a row of the stacked frame is
    (column number, one field per type), so its width does not grow with the
    number of checked columns. Values keep their type, so equality is the
    type's own (the same as a GROUP BY on that column). ``by`` comes along as
    the first column.
    """
    resolved = [_resolve(df, c) for c in _columns_of(checks)]
    type_names: list[str] = []
    for _, dtype in resolved:
        if dtype.simpleString() not in type_names:
            type_names.append(dtype.simpleString())
    fields = [f"v{i}" for i in range(len(type_names))]
    slots = []
    for j, (cj, tj) in enumerate(resolved):
        own = type_names.index(tj.simpleString())
        parts = [F.lit(j).alias("k")]
        for i, t in enumerate(type_names):
            parts.append((cj if i == own else F.lit(None).cast(t)).alias(fields[i]))
        slots.append(F.when(cj.isNotNull(), F.struct(*parts)))
    each = [] if by is None else [by.alias("by")]
    slot = slots[0] if len(slots) == 1 else F.explode(F.array(*slots))
    return (df.select(*each, slot.alias("s")).where(F.col("s").isNotNull())
            .select(*(["by"] if each else []), "s.*"))


def value_counts(df: DataFrame, checks: list[Check], by: Column | None = None) -> DataFrame:
    """Occurrences of every value of the checked columns: k, v0.., n; apart for each ``by``."""
    stacked = stacked_values(df, checks, by)
    return stacked.groupBy(*stacked.columns).agg(F.count(F.lit(1)).alias("n"))


def filtered_unique_report(df: DataFrame, checks: list[Check], bits: int) -> DataFrame:
    """The unique checks' report with values seen once kept out of the shuffle.

    Runs the filter's pass at once (``operators.unique_filter``).
    """
    stacked = stacked_values(df, checks)
    maybe, number = repeated_values(stacked, stacked.columns[1:], bits)
    counts = maybe.groupBy(*maybe.columns).agg(F.count(F.lit(1)).alias("n"))
    one = _unique_counts(counts, len(_columns_of(checks)))
    columns = _columns_of(checks)
    one = one.select(*[F.lit(number.get(j, 0)).cast("bigint").alias(f"e{j}")
                       for j in range(len(columns))],
                     *[f"u{j}" for j in range(len(columns))])
    return _unique_rows(one, checks)


def _columns_of(checks: list[Check]) -> list[str]:
    """Distinct columns of the checks, in order."""
    columns: list[str] = []
    for check in checks:
        if check.column.lower() not in [c.lower() for c in columns]:
            columns.append(check.column)
    return columns


def unique_report(counts: DataFrame, checks: list[Check]) -> DataFrame:
    """Report of unique checks from the ``value_counts`` of all rows."""
    return _unique_rows(_unique_counts(counts, len(_columns_of(checks))), checks)


def _unique_counts(counts: DataFrame, columns: int) -> DataFrame:
    """One row: per column the number of values and of values that repeat."""
    aggs = []
    for j in range(columns):
        mine = F.col("k") == j
        aggs.append(F.coalesce(F.sum(F.when(mine, F.col("n"))), F.lit(0)).alias(f"e{j}"))
        aggs.append(F.coalesce(F.sum(F.when(mine & (F.col("n") > 1), F.col("n"))),
                               F.lit(0)).alias(f"u{j}"))
    return counts.agg(*aggs)


def _unique_rows(one: DataFrame, checks: list[Check]) -> DataFrame:
    slot_of = {c.lower(): j for j, c in enumerate(_columns_of(checks))}
    rows = []
    for check in checks:
        j = slot_of[check.column.lower()]
        rows.append((check, f"e{j}", f"u{j}", None))
    return _report(one, rows)


def run_suite(df: DataFrame, params: QualityParams | dict | list[Check],
              materialize_to: str | None = None,
              unique_filter_bits: int | None = None) -> DataFrame:
    """Evaluate a suite over ``df``; returns the report DataFrame (lazy).

    A suite with unique checks and row-level checks reads ``df`` twice (one
    branch each). For a table scan that is the cheapest plan. When ``df`` is
    expensive to compute (joins, aggregates), it is computed once into the
    folder ``materialize_to`` on shared storage; the caller removes the folder
    when the report has been used. With ``unique_filter_bits`` values of the
    unique checks that occur once mostly stay out of the shuffle, at the price of
    one more pass over their columns (``operators.unique_filter``); the counts are
    the same.
    """
    checks = params if isinstance(params, list) else expand(params)
    if not checks:
        raise ParamError("the suite has no checks")
    for check in checks:
        if check.column is not None:
            _resolve(df, check.column)
    unique = [c for c in checks if c.name == "unique_vals"]
    row_level = [c for c in checks if c.name != "unique_vals"]
    if materialize_to and unique and row_level:
        df.write.mode("overwrite").parquet(materialize_to)
        df = df.sparkSession.read.schema(df.schema).parquet(materialize_to)
    parts = []
    if row_level:
        parts.append(_row_level_report(df, row_level))
    if unique:
        parts.append(unique_report(value_counts(df, unique), unique)
                     if unique_filter_bits is None
                     else filtered_unique_report(df, unique, unique_filter_bits))
    return reduce(DataFrame.unionByName, parts)


def gate(report: DataFrame) -> DataFrame:
    """One row: number of checks, number failed, and whether all passed."""
    return report.agg(
        F.count(F.lit(1)).alias("checks"),
        F.count_if(~F.col("success")).alias("failed_checks"),
        F.coalesce(F.bool_and("success"), F.lit(True)).alias("passed"),
    )


class QualityGateError(RuntimeError):
    """Raised when a gated suite has a failed check."""


def enforce(report: DataFrame, stop_job: bool = True) -> bool:
    """Evaluate the gate (one row to the driver); raise if failed and gated."""
    row = gate(report).first()
    if not row["passed"] and stop_job:
        raise QualityGateError(
            f"{row['failed_checks']} of {row['checks']} data quality checks failed")
    return bool(row["passed"])
