"""Multi-line CSV read in byte ranges, each file with its own header.

Spark gives a file whose values may hold line breaks to one task, since where a
record begins depends on all quotes before it. Here a file is cut into ranges,
and three small steps make them independent:

1. **Header catalog** (one row per file): a task opens the file and reads its
   first record only, quotes and breaks included. It tells the column names, the
   offset of the data and how lines end. Distinct headers form a dictionary, a
   table; the driver sees its rows (one per distinct header), not the files.
2. **State maps** (one row per range): a line starts either outside of quotes or
   inside. A range reports where both lead at its end. Lines without a quote lead
   nowhere else and are not looked at.
3. **Composition**: the maps of a file's earlier ranges, applied in order, tell how
   each range begins. A map on two states keeps, swaps or fixes the state, so what
   counts is the last range that fixes it and the number of swaps since: two
   running window functions over range rows.

Each range is then read again from its first line on. A record belongs to the
range its first line starts in; its task reads on behind the range to the
record's end, and a range that begins inside a record skips to the end of it.
Records are parsed by ``from_csv``, Spark's own parser, with the header's columns.

The rules are those of Spark's multi-line reader with ``"`` as quote and escape: a
quote counts at the start of a field only; after a closing quote, text up to the
separator belongs to the field; empty lines are skipped; a byte order mark is
dropped; where a file's first line ends in CR LF, CR LF counts as one line feed, in
values too. One thing differs: in such a file a lone LF outside of quotes ends the
record here, and is part of the value there. Files must be
UTF-8 (or any encoding that keeps ASCII bytes as they are) and uncompressed, with
LF or CR LF; others are left to Spark's reader.

Null or empty header names become ``_c<n>``, repeated ones get their number, as
in Spark. NULL in a frame of one column is written as an empty text (``landing``),
so there an empty text is read as NULL.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.names import quote
from .files import can_open, listing, open_range, resolved

#: Bytes of a range.
RANGE_BYTES = 64 << 20
#: Bytes read at once where an end is looked for.
STEP = 4096
#: Bytes of lines handled at once.
CHUNK = 1 << 20
#: Longest header record that is looked for.
MOST_HEADER = 16 << 20

OUTSIDE, INSIDE = 0, 1
_BOM = b"\xef\xbb\xbf"


def can_split(sep: str) -> bool:
    return len(sep) == 1 and sep.isascii() and sep not in '"\r\n'


class Quotes:
    """How a line changes the state, for one separator."""

    def __init__(self, sep: str):
        if not can_split(sep):
            raise ValueError(f"a separator is one ASCII character, not {sep!r}")
        s = re.escape(sep).encode()
        not_sep = b"[^" + s + b"]*+"
        body = rb'[^"]*+(?:""[^"]*+)*+'
        field = rb'(?:"' + body + rb'"' + not_sep + rb'|(?!")' + not_sep + rb')'
        opened = rb"(?:" + field + s + rb')*+"' + body
        self._from = (re.compile(opened, re.S),
                      re.compile(body + rb'(?:"' + not_sep + s + opened + rb")?+", re.S))

    def after(self, line: bytes, state: int) -> int:
        """State behind a line that starts in ``state``; the line has no break in it."""
        return INSIDE if self._from[state].fullmatch(line) else OUTSIDE


def _lines(src, at: int, stop: int, size: int) -> Iterator[tuple[int, list[bytes]]]:
    """(offset, lines) in chunks: the lines that start in [at, stop), whole, without LF.

    ``at`` is the start of a line. The last line may end behind ``stop``.
    """
    while at < stop:
        data = src.read_at(min(CHUNK, stop - at), at)
        cut = data.rfind(b"\n") + 1
        if not cut or at + len(data) >= stop:  # the line in hand ends further on
            parts = [data]
            end = at + len(data)
            if not data.endswith(b"\n"):
                while end < size:
                    more = src.read_at(min(max(STEP, len(data)), size - end), end)
                    found = more.find(b"\n") + 1
                    parts.append(more[:found] if found else more)
                    end += len(parts[-1])
                    if found:
                        break
            data = b"".join(parts)
            cut = len(data)
        lines = data[:cut].split(b"\n")
        if data[:cut].endswith(b"\n"):
            lines.pop()
        yield at, lines
        at += cut


def _first_line(src, start: int, stop: int, begin: int) -> int | None:
    """Offset of the first line that starts in [start, stop)."""
    if start <= begin:
        return begin
    at = start - 1
    while at < stop - 1:
        data = src.read_at(min(CHUNK, stop - 1 - at), at)
        found = data.find(b"\n")
        if found >= 0:
            return at + found + 1
        at += len(data)
    return None


def _ends_in_cr(data: bytes, size: int) -> bool:
    """Whether the first line ends in CR without LF."""
    found = re.search(rb"[\r\n]", data)
    if not found or found[0] == b"\n":
        return False
    return data[found.end():found.end() + 1] != b"\n" and (found.end() < len(data)
                                                           or len(data) == size)


def read_header(src, size: int, quotes: Quotes) -> tuple[bytes, int, int]:
    """(first record, offset behind it, bytes read); empty lines before it are skipped."""
    data = b""
    while True:
        data += src.read_at(min(max(STEP, len(data)), size - len(data)), len(data))
        if _ends_in_cr(data, size):
            return data[:data.find(b"\r") + 1], size, len(data)
        done, state, record = len(_BOM) if data.startswith(_BOM) else 0, OUTSIDE, b""
        while True:
            end = data.find(b"\n", done)
            if end < 0 and len(data) < size:
                break  # more bytes are needed
            line = data[done:end] if end >= 0 else data[done:]
            done = end + 1 if end >= 0 else len(data)
            if line.strip(b"\r") or state == INSIDE:
                record += line + (b"\n" if end >= 0 else b"")
                state = quotes.after(line, state)
                if state == OUTSIDE or end < 0:
                    return record, done, len(data)
            elif end < 0:
                return b"", done, len(data)
        if len(data) > MOST_HEADER:
            raise ValueError(f"no end of the header within {MOST_HEADER} bytes")


def safe_names(names: list[str]) -> list[str]:
    """Names Spark gives the columns of such a header."""
    low = [n.lower() for n in names]
    return [f"_c{k}" if not n else f"{n}{k}" if low.count(low[k]) > 1 else n
            for k, n in enumerate(names)]


def header_names(record: str, sep: str) -> list[str]:
    return safe_names(next(csv.reader(io.StringIO(record, newline=""), delimiter=sep), []))


CATALOG = "path string, size long, header string, data_at long, line_end string, bytes_read long"


def header_catalog(files: DataFrame, sep: str = ";") -> DataFrame:
    """Per file its header record, the offset of its data and how its lines end.

    ``files``: path, size. Reads the first record's bytes (in steps of ``STEP``).
    """
    quotes = Quotes(sep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for path, size in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open_range(path) as src:
                    record, data_at, read = read_header(src, size, quotes)
                first = re.search(rb"\r\n|\r|\n", record)
                text = record.decode("utf-8", "replace").removesuffix("\n").removesuffix("\r")
                out.append((path, size, text, data_at, (first[0] if first else b"\n").decode(),
                            read))
            kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)]
                if out else [pa.array([], k) for k in kinds],
                names=[f.split()[0] for f in CATALOG.split(", ")])

    return files.select("path", "size").mapInArrow(run, CATALOG)


def header_dictionary(catalog: DataFrame) -> DataFrame:
    """header, header_id, files: one row per distinct header record."""
    counted = catalog.groupBy("header").agg(F.count(F.lit(1)).alias("files"))
    return counted.withColumn("header_id", F.row_number().over(Window.orderBy("header")) - 1)


def byte_ranges(catalog: DataFrame, header: bool, range_bytes: int) -> DataFrame:
    """path, size, begin, line_end, header, at, start, stop: the ranges of every file."""
    begin = F.col("data_at") if header else F.lit(0).cast("long")
    cut = catalog.select("path", "size", "line_end", "header", begin.alias("begin")).where(
        "begin < size")
    last = F.floor((F.col("size") - F.col("begin") - 1) / F.lit(range_bytes)).cast("long")
    each = cut.withColumn("at", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    start = F.col("begin") + F.col("at") * range_bytes
    return each.withColumn("start", start).withColumn(
        "stop", F.least(F.col("start") + range_bytes, "size"))


def _tasks(catalog: DataFrame, range_bytes: int) -> int:
    """One task per range, where ranges are small one per ``RANGE_BYTES`` or four per core."""
    size = catalog.agg(F.sum("size")).first()[0] or 0
    cores = catalog.sparkSession.sparkContext.defaultParallelism
    return max(1, min(-(-size // range_bytes), max(-(-size // RANGE_BYTES), 4 * cores)))


MAPS = "path string, at long, from_outside int, from_inside int"


def state_maps(ranges: DataFrame, sep: str) -> DataFrame:
    """Where a range's lines lead from outside and from inside of quotes."""
    quotes = Quotes(sep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ends = [OUTSIDE, INSIDE]
                with open_range(row["path"]) as src:
                    first = _first_line(src, row["start"], row["stop"], row["begin"])
                    if first is not None:
                        for at, lines in _lines(src, first, row["stop"], row["size"]):
                            if at == 0 and lines[0].startswith(_BOM):
                                lines[0] = lines[0][len(_BOM):]
                            for line in lines:
                                if b'"' in line:
                                    ends = ([quotes.after(line, ends[0])] * 2 if ends[0] == ends[1]
                                            else [quotes.after(line, s) for s in ends])
                yield pa.RecordBatch.from_pydict(
                    {"path": [row["path"]], "at": [row["at"]], "from_outside": [ends[0]],
                     "from_inside": [ends[1]]},
                    pa.schema([("path", pa.string()), ("at", pa.int64()),
                               ("from_outside", pa.int32()), ("from_inside", pa.int32())]))

    return ranges.mapInArrow(run, MAPS)


def entry_states(maps: DataFrame) -> DataFrame:
    """path, at, entry: the state in which every range begins (its file's first: outside)."""
    order = Window.partitionBy("path").orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    fixes = F.col("from_outside") == F.col("from_inside")
    swaps = (F.col("from_outside") == INSIDE) & (F.col("from_inside") == OUTSIDE)
    counted = maps.withColumn("swaps", F.sum(swaps.cast("long")).over(upto))
    fixed = F.when(fixes, F.struct(F.col("from_outside").alias("state"), "swaps"))
    known = counted.withColumn("fixed", F.last(fixed, ignorenulls=True).over(before))
    since = (F.coalesce(F.lag("swaps").over(order), F.lit(0))
             - F.coalesce("fixed.swaps", F.lit(0)))
    state = (F.coalesce("fixed.state", F.lit(OUTSIDE)) + since) % 2
    return known.select("path", "at", state.cast("int").alias("entry"))


class _Records:
    """Records of one range, in order: ``feed`` lines, take what is complete."""

    def __init__(self, quotes: Quotes, entry: int):
        self.quotes, self.state, self.skipping = quotes, entry, entry == INSIDE
        self.open: list[bytes] = []

    def feed(self, lines: list[bytes]) -> list[bytes]:
        out: list[bytes] = []
        done = 0
        marked = [k for k, line in enumerate(lines) if b'"' in line]
        for k in [*marked, len(lines)]:
            between = lines[done:k]
            if self.state == OUTSIDE:
                out += between
            elif not self.skipping:
                self.open += between
            if k == len(lines):
                break
            done = k + 1
            self.open.append(lines[k])
            self.state = self.quotes.after(lines[k], self.state)
            if self.state == OUTSIDE:
                if not self.skipping:
                    out.append(b"\n".join(self.open))
                self.open, self.skipping = [], False
            elif self.skipping:
                self.open = []
        return out

    def rest(self, ending: bytes) -> list[bytes]:
        """A record the file ends in, with the line feed that is part of it."""
        return [b"\n".join(self.open) + ending] if self.open and not self.skipping else []


def _range_records(src, row: dict, quotes: Quotes) -> Iterator[list[bytes]]:
    first = _first_line(src, row["start"], row["stop"], row["begin"])
    if first is None:
        return
    records, end, size = _Records(quotes, row["entry"]), first, row["size"]
    for at, lines in _lines(src, first, row["stop"], size):
        end = at + sum(map(len, lines)) + len(lines)
        if at == 0 and lines[0].startswith(_BOM):
            lines[0] = lines[0][len(_BOM):]
        yield records.feed(lines)
    # the last record may go on behind the range; only its own lines are taken
    while records.state == INSIDE and not records.skipping and end < size:
        for at, lines in _lines(src, end, min(end + STEP, size), size):
            end = at + sum(map(len, lines)) + len(lines)
            for line in lines:
                found = records.feed([line])
                if records.state == OUTSIDE:
                    yield found
                    return
    yield records.rest(b"\n" if src.read_at(1, size - 1) == b"\n" else b"")


def range_records(ranges: DataFrame, sep: str) -> DataFrame:
    """record, header, path of every record; ``ranges`` with ``entry`` states."""
    quotes = Quotes(sep)
    schema = pa.schema([("record", pa.string()), ("header", pa.string()), ("path", pa.string())])

    def batch_of(row: dict, records: list[bytes]) -> pa.RecordBatch:
        strip = row["line_end"] == "\r\n"
        texts = [(r[:-1] if strip and r.endswith(b"\r") else r) for r in records]
        texts = [(t.replace(b"\r\n", b"\n") if strip else t).decode("utf-8", "replace")
                 for t in texts if t]
        return pa.RecordBatch.from_arrays(
            [pa.array(texts, pa.string()), pa.array([row["header"]] * len(texts), pa.string()),
             pa.array([row["path"]] * len(texts), pa.string())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_range(row["path"]) as src:
                    for records in _range_records(src, row, quotes):
                        yield batch_of(row, records)

    return ranges.mapInArrow(run, "record string, header string, path string")


def readable(spark: SparkSession, folders: list[str]) -> bool:
    """Whether tasks can open the folders' files by range."""
    return all(can_open(resolved(spark, f)) for f in folders)


def _parsed(records: DataFrame, headers: dict[str, list[str]], options: dict[str, str],
            day_column: str | None) -> DataFrame:
    """One text column per name of any header, by Spark's parser; NULL where a header lacks it."""
    names = list(dict.fromkeys(n for own in headers.values() for n in own))
    structs: dict[str, Column] = {}
    for header, own in headers.items():
        schema = ", ".join(f"{quote(n)} STRING" for n in own)
        structs[header] = F.from_csv("record", schema, options)
        if len(own) == 1:
            structs[header] = structs[header].withField(
                quote(own[0]), F.nullif(structs[header].getField(own[0]), F.lit("")))
    df = records.select("*", *[F.when(F.col("header") == h, s).alias(f"h{k}")
                               for k, (h, s) in enumerate(structs.items())])

    def value(name: str) -> Column:
        own = [F.col(f"h{k}").getField(name) for k, h in enumerate(headers) if name in headers[h]]
        return reduce(lambda a, b: F.coalesce(a, b), own).alias(name)

    day = [] if day_column is None else [
        F.regexp_extract("path", rf"/{day_column}=([^/]*)/", 1).alias(day_column)]
    return df.select(*[value(n) for n in names], *day)


def read_split_csv(spark: SparkSession, folders: list[str], sep: str, header: bool,
                   options: dict[str, str], range_bytes: int | None = None,
                   day_column: str | None = None) -> DataFrame | None:
    """CSV folders as one all-text frame, bound by name over files with any headers.

    ``options`` are those of Spark's reader. Files are read in ranges of ``range_bytes``.
    With ``day_column`` the value of that folder level becomes the last column. None where
    the files cannot be split: tasks cannot open them, lines end in CR alone, or the
    separator is not one ASCII character.
    """
    if not can_split(sep) or not readable(spark, folders):
        return None
    range_bytes = range_bytes or RANGE_BYTES
    catalog = header_catalog(listing(spark, folders), sep).persist()
    if not catalog.where(F.col("line_end") == "\r").isEmpty():
        return None
    found = header_dictionary(catalog).collect()
    headers = {r.header: header_names(r.header, sep) for r in found}
    if not header:
        headers = {h: [f"_c{k}" for k in range(len(own))] for h, own in headers.items()}
    tasks = _tasks(catalog, range_bytes)
    ranges = byte_ranges(catalog, header, range_bytes)
    entries = entry_states(state_maps(ranges.repartition(tasks), sep))
    records = range_records(ranges.join(entries, ["path", "at"]).repartition(tasks), sep)
    parser = {k: v for k, v in options.items() if k not in ("header", "multiLine")}
    return _parsed(records, headers, parser, day_column)
