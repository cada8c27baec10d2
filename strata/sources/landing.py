"""Bronze landing: files of one source table per day.

Layout: ``{root}/bronze/{source}/{table}/ingest_date=YYYYMMDD/part-*``. The day
is always an argument (never the clock), and reading a day goes straight to
that directory, so other days are not even listed.

CSV is written and read with ``"`` as quote *and* escape and with multi-line
records, so text with quotes, separators and newlines survives the round trip.
A multi-line CSV file cannot be split between tasks; the CSV writer can cap
rows per file (``max_records_per_file``) so that parallelism on read comes from
the number of files. JSON lines and Parquet split anyway and are never capped.
Most days hold no line break in any value: the writer
counts values with one during the same write and, when there are none, leaves
a ``_SINGLE_LINE`` marker in the day's folder. Such a day is read line by line,
and its files are split into byte ranges like any text file, whatever their
size. Folders without the marker (other producers, or any line break) are read
multi-line. The marker speaks for the files landed with it: a re-landing of the
day replaces both, and files added to the folder by any other writer are not
covered by it. No schema is given to the CSV reader: with a header it would bind
the schema by position and ignore the header names. Spark takes the header of
one file for all files of a read, so files with other headers would be bound by
position: the landing therefore records the column names (``_HEADER``), and
files are read in one group per header and united by name. Folders of other
producers (no recorded header), and multi-line folders larger than one byte range,
are read in byte ranges, every file with its own header (``split_csv``).
Every column is read as text and bound by name later (``operators.silver``).
"""

from __future__ import annotations

import csv
import json
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, MapType, StringType, StructType

from ..functions.metrics import observed
from ..functions.names import column
from ..lake import filesystem, read_text, write_text
from ..params import SUPPORTED_FORMATS
from . import split_csv
from .files import listing

DAY_COLUMN = "ingest_date"
DEFAULT_MAX_RECORDS_PER_FILE = 100_000
# Marker file of a CSV folder whose values hold no line break (readers skip
# names starting with "_").
SINGLE_LINE_MARKER = "_SINGLE_LINE"
# File with the column names of a landed CSV folder.
HEADER_FILE = "_HEADER"
# Spark reserves one column name for malformed text; no payload can hold this one.
RESERVED_COLUMN = "\u0001malformed"

# Text forms of timestamps in landed files. Spark's default writer forms stop
# at milliseconds; these keep microseconds, and the readers use the same ones.
TEXT_TIME_OPTIONS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def day_dir(base: str, day: str) -> str:
    return f"{base.rstrip('/')}/{DAY_COLUMN}={day}"


def _csv_options(sep: str, header: bool, multi_line: bool = True) -> dict[str, str]:
    return {
        "sep": sep,
        "header": str(bool(header)).lower(),
        "quote": '"',
        "escape": '"',
        "multiLine": str(bool(multi_line)).lower(),
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
        "columnNameOfCorruptRecord": RESERVED_COLUMN,
        **TEXT_TIME_OPTIONS,
    }


def _json_options(multi_line: bool | None) -> dict[str, str]:
    return {"multiLine": str(bool(multi_line)).lower(), "mode": "FAILFAST", **TEXT_TIME_OPTIONS}


def plain_double(c: Column) -> Column:
    """Text of a double without an exponent, digit for digit.

    The shortest text of a double has at most 17 digits, so from 1e7 to 1e18
    and from 1e-7 to 1e-3 a decimal holds all of them; beyond, the exponent
    stays.
    """
    text, size = c.cast("string"), F.abs(c)
    large = F.regexp_replace(text.try_cast("decimal(38,18)").cast("string"), "0+$", "")
    small = F.regexp_replace(text.try_cast("decimal(38,24)").cast("string"), "0+$", "")
    return (F.when((size >= 1e7) & (size < 1e18), F.regexp_replace(large, "[.]$", ".0"))
            .when((size >= 1e-7) & (size < 1e-3), small).otherwise(text))


def flatten_nested(df: DataFrame) -> DataFrame:
    """Values as they are written to text: arrays, maps and structs become JSON,
    doubles get plain notation."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            cols.append(F.to_json(column(f.name)).alias(f.name))
        elif isinstance(f.dataType, DoubleType):
            cols.append(plain_double(column(f.name)).alias(f.name))
        else:
            cols.append(column(f.name))
    return df.select(*cols)


def _has_line_break(df: DataFrame) -> Column:
    """Per row: a line break in any text value (the only type that holds one)."""
    texts = [column(f.name) for f in df.schema.fields
             if isinstance(f.dataType, StringType)]
    if not texts:
        return F.lit(False)
    broken = reduce(Column.__or__, [c.contains("\n") | c.contains("\r") for c in texts])
    return F.coalesce(broken, F.lit(False))


def _clean_names(df: DataFrame) -> bool:
    return not any("\n" in c or "\r" in c for c in df.columns)


def _mark_single_line(spark: SparkSession, path: str) -> None:
    """Put the marker into the folder ``path`` (never creates the folder)."""
    fs, folder = filesystem(spark, path)
    if fs.exists(folder):
        fs.create(filesystem(spark, f"{path.rstrip('/')}/{SINGLE_LINE_MARKER}")[1], True).close()


def _write_header(spark: SparkSession, path: str, columns: list[str]) -> None:
    """Record the column names of the CSV folder ``path`` (never creates it)."""
    fs, folder = filesystem(spark, path)
    if fs.exists(folder):
        write_text(spark, f"{path.rstrip('/')}/{HEADER_FILE}", json.dumps(columns))


def recorded_header(spark: SparkSession, path: str) -> list[str] | None:
    """Column names recorded when ``path`` was landed; None for other producers."""
    text = read_text(spark, f"{path.rstrip('/')}/{HEADER_FILE}")
    return None if text is None else json.loads(text)


def file_headers(spark: SparkSession, paths: list[str], sep: str) -> dict[str, list[str]]:
    """File -> column names, from the first line of every CSV file.

    For files that are to be read line by line, or cannot be split. Only the header's
    bytes are read where tasks can open the files; else one pass of text lines, in
    which the first line of a file's first block is its header (within a block lines
    arrive in order, so it is the first one the partial aggregate keeps).
    """
    if split_csv.can_split(sep) and split_csv.readable(spark, paths):
        catalog = split_csv.header_catalog(listing(spark, paths), sep).where("line_end <> '\\r'")
        found = {r.path: split_csv.header_names(r.header, sep)
                 for r in catalog.select("path", "header").collect()}
        if found:
            return found
    lines = spark.read.text(paths).select("value", "_metadata.file_path",
                                          F.col("_metadata.file_block_start").alias("start"))
    first = lines.where("start = 0").groupBy("file_path").agg(F.first("value").alias("line"))
    return {r.file_path: next(csv.reader([r.line.removeprefix("\ufeff")], delimiter=sep))
            for r in first.collect()}


def one_column_text(df: DataFrame) -> DataFrame:
    """A frame of one column with NULL as empty text.

    A NULL alone on a line would be written as nothing, and the row be lost; an
    empty text is written as a pair of quotes. It is read back as NULL, as is
    an empty text that was there.
    """
    if len(df.columns) != 1:
        return df
    return df.select(F.coalesce(column(df.columns[0]).cast("string"), F.lit(""))
                     .alias(df.columns[0]))


def is_single_line(spark: SparkSession, path: str) -> bool:
    """True when ``path`` was landed by ``land_csv`` without any line break."""
    fs, hpath = filesystem(spark, f"{path.rstrip('/')}/{SINGLE_LINE_MARKER}")
    return bool(fs.exists(hpath))


def single_line_days(spark: SparkSession, base: str) -> set[str]:
    """Days under ``base`` carrying the single-line marker (one glob listing)."""
    fs, pattern = filesystem(spark, f"{base.rstrip('/')}/{DAY_COLUMN}=*/{SINGLE_LINE_MARKER}")
    found = fs.globStatus(pattern) or []
    prefix = f"{DAY_COLUMN}="
    return {st.getPath().getParent().getName()[len(prefix):] for st in found}


def land_csv(df: DataFrame, path: str, sep: str = ";", header: bool = True,
             max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE) -> None:
    """Write ``df`` as delimited text into ``path`` (replacing a re-run).

    Values with a line break are counted during the write; when there are none
    (and no column name holds one) the folder gets the single-line marker. A
    retried task can only raise the count, so the marker is never wrong.
    """
    flat = one_column_text(flatten_nested(df))
    seen = Observation()
    (flat.observe(seen, F.count_if(_has_line_break(flat)).alias("line_breaks"))
     .write.mode("overwrite")
     .options(**_csv_options(sep, header))
     .option("maxRecordsPerFile", str(max_records_per_file))
     .csv(path))
    if header:
        _write_header(df.sparkSession, path, flat.columns)
    if _clean_names(flat) and observed(seen).get("line_breaks") == 0:
        _mark_single_line(df.sparkSession, path)


def land_json(df: DataFrame, path: str) -> None:
    """Write ``df`` as JSON lines into ``path`` (replacing a re-run)."""
    (df.write.mode("overwrite")
     .options(**TEXT_TIME_OPTIONS)
     .option("ignoreNullFields", "true")
     .json(path))


def _read_csv_group(spark: SparkSession, paths: list[str], sep: str, header: bool,
                    multi_line: bool, base: str | None) -> DataFrame:
    """CSV files of one header as one all-text frame."""
    reader = spark.read.options(**_csv_options(sep, header, multi_line))
    if base is not None:
        reader = reader.option("basePath", base)
    df = reader.csv(paths)
    data = [c for c in df.columns if base is None or c != DAY_COLUMN]
    if len(data) == 1:  # see one_column_text
        df = df.withColumn(data[0], F.nullif(column(data[0]), F.lit("")))
    return df


def _bytes_in(spark: SparkSession, paths: list[str]) -> int:
    """Bytes of the folders' files, as the file system counts them."""
    total = 0
    for path in paths:
        fs, hpath = filesystem(spark, path)
        total += fs.getContentSummary(hpath).getLength()
    return total


def read_csv_folders(spark: SparkSession, folders: list[str], sep: str, header: bool,
                     multi_line: bool | None, base: str | None = None,
                     range_bytes: int | None = None) -> DataFrame:
    """Landed CSV folders as one all-text frame, columns bound by name.

    One read per distinct header and, unless ``multi_line`` is given, per way
    of reading (folders with the single-line marker line by line); columns
    missing from a group are NULL.
    """
    frames: list[DataFrame] = []
    groups: dict[tuple[tuple[str, ...], bool], list[str]] = {}
    foreign: dict[bool, list[str]] = {}
    if base is None:
        marked = {f for f in folders if is_single_line(spark, f)}
    else:
        marked = {day_dir(base, d) for d in single_line_days(spark, base)}
    for folder in folders:
        broken = folder not in marked if multi_line is None else multi_line
        known = recorded_header(spark, folder) if header else []
        if known is None:
            foreign.setdefault(broken, []).append(folder)
        else:
            groups.setdefault((tuple(known), broken), []).append(folder)
    day = None if base is None else DAY_COLUMN
    options = _csv_options(sep, header)
    for broken, paths in foreign.items():
        split = (split_csv.read_split_csv(spark, paths, sep, header, options, range_bytes, day)
                 if broken else None)
        if split is not None:
            frames.append(split)
            continue
        for path, names in file_headers(spark, paths, sep).items():
            groups.setdefault((tuple(names), broken), []).append(path)
    if not groups and not frames:  # folders without a file
        groups[(), True] = folders
    for (_, broken), paths in groups.items():
        split = None
        if broken and _bytes_in(spark, paths) > (range_bytes or split_csv.RANGE_BYTES):
            split = split_csv.read_split_csv(spark, paths, sep, header, options, range_bytes, day)
        frames.append(_read_csv_group(spark, paths, sep, header, broken, base)
                      if split is None else split)
    df = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    if base is not None:  # the day comes last, as in a read of one group
        df = df.select(*[column(c) for c in df.columns if c != DAY_COLUMN], column(DAY_COLUMN))
    return df


def read_csv(spark: SparkSession, path: str, sep: str = ";", header: bool = True,
             multi_line: bool | None = None, range_bytes: int | None = None) -> DataFrame:
    """All-text frame of a landed CSV directory; blanks read as NULL.

    Line by line (splittable) when the folder carries the single-line marker or
    ``multi_line`` is False; multi-line otherwise, in byte ranges of ``range_bytes``
    where the folder holds more than that.
    """
    return read_csv_folders(spark, [path], sep, header, multi_line, range_bytes=range_bytes)


def read_json(spark: SparkSession, path: str, schema: StructType | str | None = None,
              multi_line: bool = False) -> DataFrame:
    """Frame of landed JSON: lines, or whole-file arrays with ``multi_line``.

    Keys missing from a record are NULL. With a schema nothing is inferred and
    nested values keep their types. A malformed record fails the read instead
    of becoming a row of NULLs.
    """
    reader = spark.read.options(**_json_options(multi_line))
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_landing(spark: SparkSession, path: str, ext: str = "csv", sep: str = ";",
                 header: bool = True, schema: StructType | str | None = None,
                 multi_line: bool | None = None) -> DataFrame:
    """Read a landed directory by format (csv, json or parquet).

    ``multi_line`` None means: as the landing marked it (CSV), lines (JSON).
    """
    if ext == "csv":
        return read_csv(spark, path, sep=sep, header=header, multi_line=multi_line)
    if ext == "json":
        return read_json(spark, path, schema=schema, multi_line=bool(multi_line))
    if ext == "parquet":
        return spark.read.parquet(path)
    raise ValueError(f"unsupported landing format {ext!r}; use one of {SUPPORTED_FORMATS}")


def balanced(df: DataFrame) -> DataFrame:
    """``df`` with its rows spread evenly over tasks (one shuffle).

    Landing is map-only: each input task writes its own rows, so a delivery
    that arrives in few or uneven partitions (a large unsplittable file) is
    written by few tasks. This rebalances by a hash of the row's scalar values
    (deterministic: a retried task sends every row where the first attempt
    did) and lets AQE size the partitions.
    """
    keys = [column(f.name) for f in df.schema.fields
            if not isinstance(f.dataType, (ArrayType, MapType, StructType))]
    return _dealt(df, keys)


def _dealt(df: DataFrame, keys: list[Column]) -> DataFrame:
    """``df`` rebalanced by ``keys``; without adaptive execution, which the hint
    needs, dealt by a hash of the keys and of the whole row."""
    if df.sparkSession.conf.get("spark.sql.adaptive.enabled") == "true":
        return df.hint("rebalance", *keys)
    return df.repartition(*keys, F.xxhash64(*[column(c) for c in df.columns]) % 32)


def land_day(df: DataFrame, base: str, day: str, ext: str = "csv", sep: str = ";",
             header: bool = True,
             max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE,
             balance: bool = False) -> str:
    """Land ``df`` as the files of one day under ``base``; returns the directory.

    ``balance`` spreads the rows over tasks first (``balanced``).
    ``max_records_per_file`` caps the rows of a CSV file.
    """
    target = day_dir(base, day)
    if balance:
        df = balanced(df)
    if ext == "csv":
        land_csv(df, target, sep=sep, header=header,
                 max_records_per_file=max_records_per_file)
    elif ext == "json":
        land_json(df, target)
    elif ext == "parquet":
        df.write.mode("overwrite").parquet(target)
    else:
        raise ValueError(f"unsupported landing format {ext!r}")
    return target


def land_by_day(df: DataFrame, base: str, day_col: F.Column, ext: str = "json",
                max_records_per_file: int = DEFAULT_MAX_RECORDS_PER_FILE) -> None:
    """Land a frame that spans many days, one directory per day.

    Days come from ``day_col`` (formatted ``yyyyMMdd``). Rows are rebalanced by
    day first (AQE splits a day that holds most of the rows), so each day gets
    a few full files instead of one small file per task. For CSV the write
    observes the days it wrote and the days with a line break (two sets, one
    entry per day); each written day without one gets the single-line marker.
    Days that are not in ``df`` stay as they are, whatever the session's
    overwrite mode. The rebalancing hint needs adaptive execution; without it
    the rows are repartitioned by day and a hash.
    """
    if ext == "csv":
        df = one_column_text(flatten_nested(df))
    broken = _has_line_break(df)
    out = df.withColumn(DAY_COLUMN, day_col)
    seen = Observation()
    if ext == "csv":
        day = F.col(DAY_COLUMN)
        out = out.observe(seen, F.collect_set(day).alias("days"),
                          F.collect_set(F.when(broken, day)).alias("broken"))
    out = _dealt(out, [column(DAY_COLUMN)])
    writer = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
              .partitionBy(DAY_COLUMN))
    if ext == "json":
        writer.options(**TEXT_TIME_OPTIONS).option("ignoreNullFields", "true").json(base)
    elif ext == "csv":
        (writer.options(**_csv_options(";", True))
         .option("maxRecordsPerFile", str(max_records_per_file)).csv(base))
        metrics = observed(seen)
        for d in sorted(metrics.get("days", ())):
            _write_header(df.sparkSession, day_dir(base, d), df.columns)
            if _clean_names(df) and d not in metrics["broken"]:
                _mark_single_line(df.sparkSession, day_dir(base, d))
    elif ext == "parquet":
        writer.parquet(base)
    else:
        raise ValueError(f"unsupported landing format {ext!r}")


# Folder Spark writes rows with a NULL partition value to (not a day).
NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"


def landing_days(spark: SparkSession, base: str) -> list[str]:
    """Days present under ``base`` (directory names only, no file listing).

    Rows landed without a day sit in Spark's NULL-partition folder, which is
    not a day and is left out (it would otherwise sort after every date).
    """
    fs, hpath = filesystem(spark, base)
    if not fs.exists(hpath):
        return []
    prefix = f"{DAY_COLUMN}="
    days = []
    for status in fs.listStatus(hpath):
        name = status.getPath().getName()
        if status.isDirectory() and name.startswith(prefix) and name != prefix + NULL_PARTITION:
            days.append(name[len(prefix):])
    return sorted(days)


def latest_day(spark: SparkSession, base: str) -> str:
    days = landing_days(spark, base)
    if not days:
        raise FileNotFoundError(f"no landed day under {base}")
    return days[-1]


def read_day(spark: SparkSession, base: str, day: str, ext: str = "csv",
             sep: str = ";", header: bool = True,
             schema: StructType | str | None = None,
             multi_line: bool | None = None) -> DataFrame:
    """Read only the files of ``day`` (the directory is addressed directly)."""
    return read_landing(spark, day_dir(base, day), ext=ext, sep=sep, header=header,
                        schema=schema, multi_line=multi_line)


def read_days(spark: SparkSession, base: str, days: list[str], ext: str = "csv",
              sep: str = ";", header: bool = True,
              schema: StructType | str | None = None,
              multi_line: bool | None = None) -> DataFrame:
    """Read several days at once (a backfill), with an ``ingest_date`` column.

    Only the named day directories are listed; the day comes from the
    directory name (partition discovery against ``base``), typed as text. CSV
    days are bound by name, whatever columns each day has and in what order.
    """
    if not days:
        raise ValueError("no day to read")
    paths = [day_dir(base, d) for d in days]
    reader = spark.read.option("basePath", base.rstrip("/")).option(
        "recursiveFileLookup", "false")
    if ext == "csv":
        df = read_csv_folders(spark, paths, sep, header, multi_line, base.rstrip("/"))
    elif ext == "json":
        reader = reader.options(**_json_options(multi_line))
        if schema is not None:
            reader = reader.schema(schema)
        df = reader.json(paths)
    elif ext == "parquet":
        df = reader.parquet(*paths)
    else:
        raise ValueError(f"unsupported landing format {ext!r}")
    return df.withColumn(DAY_COLUMN, F.col(DAY_COLUMN).cast("string"))
