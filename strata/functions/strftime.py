"""Does a text parse with a Python ``strftime`` mask?

The rule to match is ``datetime.strptime(value, mask)`` succeeding. Spark's
datetime patterns cannot express it (``%Y%m%d`` accepts ``2024115``; ``%d``
accepts a leading blank; a blank in the mask matches a run of white space), so
the check is built from a regular expression per directive and evaluated on the
JVM:

1. the expression must match at the start of the value and consume all of it
   (Python's ``match`` plus its "unconverted data remains" rule; Java and
   Python regexes are both leftmost-first backtracking, so the first match is
   the same);
2. the captured fields must form a real date: year >= 1, day within the month
   (leap years included), or a day of the year that still lies in year 9999 or
   before; second <= 59; a zone offset under 24 hours.

Per value this costs two regex passes: ``rlike`` (is there a match) and one
``regexp_replace`` that writes every captured field and the unconsumed rest as
a comma-separated text, split once. ``mask_columns`` yields those two columns
for a projection ahead of an aggregate, so they are computed once per row;
``mask_valid`` turns them into the verdict with plain arithmetic.

A week of the year with a weekday gives the day of the year, an ISO year and week
the day itself; day numbers (days since 0001-01-01, which was a Monday) tell
whether it lies in the years 1 to 9999. Zone names are those ``strptime`` knows:
UTC, GMT and the driver's own. All of it runs on the JVM.
"""

from __future__ import annotations

import calendar
import re
import time
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def _names(names) -> str:
    """Alternatives, the longest first."""
    return "|".join(sorted((re.escape(n) for n in names if n), key=len, reverse=True))


# What each directive accepts, as documented for ``strptime``.
DIRECTIVES = {
    "Y": r"\d\d\d\d",
    "y": r"\d\d",
    "m": r"1[0-2]|0[1-9]|[1-9]",
    "d": r"3[0-1]|[1-2]\d|0[1-9]|[1-9]| [1-9]",
    "j": r"36[0-6]|3[0-5]\d|[1-2]\d\d|0[1-9]\d|00[1-9]|[1-9]\d|0[1-9]|[1-9]",
    "H": r"2[0-3]|[0-1]\d|\d",
    "I": r"1[0-2]|0[1-9]|[1-9]| [1-9]",
    "M": r"[0-5]\d|\d",
    "S": r"6[0-1]|[0-5]\d|\d",
    "f": r"[0-9]{1,6}",
    "U": r"5[0-3]|[0-4]\d|\d",
    "W": r"5[0-3]|[0-4]\d|\d",
    "V": r"5[0-3]|0[1-9]|[1-4]\d|\d",
    "G": r"\d\d\d\d",
    "w": r"[0-6]",
    "u": r"[1-7]",
    "z": r"[+-]\d\d:?[0-5]\d(?::?[0-5]\d(?:\.\d{1,6})?)?|(?-i:Z)",
    "p": "am|pm",
    "a": _names(calendar.day_abbr), "A": _names(calendar.day_name),
    "b": _names(calendar.month_abbr[1:]), "B": _names(calendar.month_name[1:]),
}
# Directives that stand for others (C locale).
COMPOSITE = {"c": "%a %b %d %H:%M:%S %Y", "x": "%m/%d/%y", "X": "%H:%M:%S"}
# An offset is read the same way only if its colons are all there or all absent.
_OFFSET = r"(?i)(?-i:Z)|[+-](?:[01]\d|2[0-3])(?::\d\d(?::\d\d(?:\.\d+)?)?|\d\d(?:\d\d(?:\.\d+)?)?)"
# Fields the calendar check reads, in output order; the weekday only with a week.
_FIELDS = ("Y", "y", "m", "b", "B", "d", "j", "S", "z")
_WEEKDAYS = ("a", "A", "w", "u")
_WEEKS = ("U", "W", "V", "G")
# Number of 9999-12-31 in days since 0001-01-01 (which is 1).
_LAST_DAY = 3652059


def zone_names() -> list[str]:
    """Zone names ``strptime`` accepts on the driver."""
    own = time.tzname if time.daylight else time.tzname[:1]
    return sorted({"utc", "gmt", *(n.lower() for n in own)})


class MaskError(ValueError):
    """A mask that Python's ``strptime`` itself rejects."""


@dataclass(frozen=True)
class MaskPlan:
    mask: str
    rx: str                 # anchored match test
    rx_rest: str            # the same, plus a trailing group for the rest
    replacement: str        # "$i,$j,...,$rest"
    fields: tuple[str, ...]
    weekday: str | None = None  # the directives that count: the last of their kind
    week: str | None = None
    never: bool = False     # directives that contradict each other: no value parses


def _check_mask(mask: str) -> None:
    """Raise ``MaskError`` for a mask that ``strptime`` rejects whatever the value."""
    try:
        datetime.strptime("", mask)
    except re.error as exc:
        raise MaskError(f"invalid strftime mask {mask!r}: {exc}") from exc
    except ValueError as exc:
        if "does not match format" not in str(exc) and "unconverted" not in str(exc):
            raise MaskError(f"invalid strftime mask {mask!r}: {exc}") from exc


def plan_mask(mask: str) -> MaskPlan:
    _check_mask(mask)
    out, groups, rest = [], [], mask
    while rest:
        if rest[0] == "%" and len(rest) > 1:
            key, rest = rest[1], rest[2:]
            if key in COMPOSITE:
                rest = COMPOSITE[key] + rest
            elif key == "%":
                out.append("%")
            elif key == "Z":
                groups.append(key)
                out.append(f"({_names(zone_names())})")
            elif key in DIRECTIVES:
                groups.append(key)
                out.append(f"({DIRECTIVES[key]})")
            else:
                raise MaskError(f"directive %{key} of {mask!r} is not known")
        elif rest[0].isspace():
            out.append(r"\s+")
            rest = rest.lstrip()
        else:
            out.append("['\u02bc]" if rest[0] == "'" else re.escape(rest[0]))
            rest = rest[1:]
    # Case-insensitive like strptime; Unicode classes so that \s matches Python's
    # white space. Every group of the expression is one directive, in order.
    rx = "(?iU)^(?:" + "".join(out) + ")"
    weekdays = [g for g in groups if g in _WEEKDAYS]
    weeks = [g for g in groups if g in ("U", "W")]
    # an ISO week needs its year and a weekday, and no day of the year
    never = (("G" in groups and ("j" in groups or "V" not in groups or not weekdays))
             or ("V" in groups and "G" not in groups))
    wanted = _FIELDS + (_WEEKDAYS + _WEEKS if set(groups) & set(_WEEKS) else ())
    fields = tuple(f for f in wanted if f in groups)
    replacement = ",".join([f"${groups.index(f) + 1}" for f in fields] + [f"${len(groups) + 1}"])
    return MaskPlan(mask, rx, rx + "((?s).*)$", replacement, fields,
                    weekdays[-1] if weekdays else None, weeks[-1] if weeks else None, never)


def _numbered(names: list[str]) -> Column:
    """Map from lower-case names to their numbers (from 0)."""
    return F.create_map(*[x for k, n in enumerate(names) for x in (F.lit(n.lower()), F.lit(k))])


def _days_before(year: Column) -> Column:
    """Days before January 1 of a year, since 0001-01-01."""
    y = year - 1
    return y * 365 + F.floor(y / 4) - F.floor(y / 100) + F.floor(y / 400)


def _first_weekday(year: Column) -> Column:
    """Weekday of January 1 (0: Monday)."""
    return F.pmod(_days_before(year), F.lit(7))


def _week_day_number(year: Column, week: Column, weekday: Column, monday: bool) -> Column:
    """Day number of a weekday (0: Monday) in a week counted from the year's first
    Monday or Sunday; days before it are week 0."""
    first = _first_weekday(year)
    if not monday:
        first, weekday = (first + 1) % 7, (weekday + 1) % 7
    in_year = F.when(week == 0, weekday - first).otherwise(
        (7 - first) % 7 + (week - 1) * 7 + weekday)
    return _days_before(year) + in_year + 1


def _iso_day_number(year: Column, week: Column, weekday: Column, leap: Column) -> Column:
    """Day number of an ISO week's weekday; NULL where the year has no such week."""
    first = _first_weekday(year)
    long = (first == 3) | ((first == 2) & leap)
    # the week of January 4 is the first
    begin = _days_before(year) + 1 - first + F.when(first > 3, 7).otherwise(0)
    there = week.between(1, 52) | ((week == 53) & long)
    return F.when(there, begin + (week - 1) * 7 + weekday)


def _month_map(names: list[str]) -> Column:
    pairs = []
    for i in range(1, 13):
        pairs += [F.lit(names[i].lower()), F.lit(i)]
    return F.create_map(*pairs)


def _month_names() -> tuple[list[str], list[str]]:
    return list(calendar.month_abbr), list(calendar.month_name)


def mask_columns(c: Column, plan: MaskPlan, prefix: str) -> list[Column]:
    """Per-row columns the verdict needs: ``{prefix}_ok`` and ``{prefix}_f``."""
    return [
        c.rlike(plan.rx).alias(f"{prefix}_ok"),
        F.split(F.regexp_replace(c, plan.rx_rest, plan.replacement), ",",
                len(plan.fields) + 1).alias(f"{prefix}_f"),
    ]


def mask_valid(plan: MaskPlan, ok: Column, fields: Column | None = None) -> Column:
    """Verdict from the ``mask_columns``: NULL for NULL input, else a boolean."""
    def text(name: str) -> Column:
        return F.try_element_at(fields, F.lit(plan.fields.index(name) + 1))

    def num(name: str) -> Column:
        return F.trim(text(name)).try_cast("int")

    rest = F.try_element_at(fields, F.lit(len(plan.fields) + 1))
    if "Y" in plan.fields:
        year = num("Y")
    elif "y" in plan.fields:
        yy = num("y")
        year = F.when(yy < 69, yy + 2000).otherwise(yy + 1900)
    else:
        year = F.lit(1900)
    if "m" in plan.fields:
        month = num("m")
    elif "b" in plan.fields or "B" in plan.fields:
        abbr, full = _month_names()
        key = "b" if "b" in plan.fields else "B"
        month = F.try_element_at(_month_map(abbr if key == "b" else full),
                                 F.lower(text(key)))
    else:
        month = F.lit(1)
    day = num("d") if "d" in plan.fields else F.lit(1)

    def leap_year(year: Column) -> Column:
        return ((year % 4 == 0) & (year % 100 != 0)) | (year % 400 == 0)

    def weekday() -> Column:
        value = text(plan.weekday)
        if plan.weekday in ("a", "A"):
            names = calendar.day_abbr if plan.weekday == "a" else calendar.day_name
            return F.try_element_at(_numbered(list(names)), F.lower(value))
        number = value.try_cast("int")
        return (number + 6) % 7 if plan.weekday == "w" else number - 1

    leap = leap_year(year)
    month_len = (F.when(month == 2, F.when(leap, 29).otherwise(28))
                 .when(month.isin(4, 6, 9, 11), 30).otherwise(31))
    exists = year >= 1
    if plan.never:
        real = F.lit(False)
    elif "j" not in plan.fields and plan.weekday and plan.week:
        real = _week_day_number(year, num(plan.week), weekday(), plan.week == "W").between(
            1, _LAST_DAY)
    elif "G" in plan.fields:
        exists = num("G") >= 1
        real = _iso_day_number(num("G"), num("V"), weekday(), leap_year(num("G"))).between(
            1, _LAST_DAY)
    elif "j" in plan.fields:  # the day of the year decides; month and day are not looked at
        real = (num("j") <= 365) | leap | (year < 9999)
    else:
        real = month.between(1, 12) & (day >= 1) & (day <= month_len)
    valid = ok & (rest == "") & exists & real
    if "z" in plan.fields:
        valid = valid & text("z").rlike(f"^(?:{_OFFSET})$")
    if "S" in plan.fields:
        valid = valid & (num("S") <= 59)
    return F.when(ok.isNull(), F.lit(None).cast("boolean")).otherwise(
        F.coalesce(valid, F.lit(False)))


def matches_strftime(c: Column, mask: str) -> Column:
    """Boolean column: NULL for NULL input, else whether ``strptime`` accepts it.

    Self-contained form for ad-hoc use; inside an aggregate prefer
    ``mask_columns`` in a projection first (see ``operators.quality``).
    """
    plan = plan_mask(mask)
    ok = c.rlike(plan.rx)
    fields = F.split(F.regexp_replace(c, plan.rx_rest, plan.replacement), ",",
                     len(plan.fields) + 1)
    return mask_valid(plan, ok, fields)
