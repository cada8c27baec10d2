"""Conversation repair: the cheapest edits that make the roles of a conversation legal.

A legal conversation has role initials ``(s?(ua)+)?``. Its rows, in order, are
parsed by a grammar in Chomsky normal form whose nonterminals are pairs of
places in that pattern: ``<p,q>`` derives every edited span that leads from
place p to place q. Binary rules are ``<p,q> -> <p,r> <r,q>``; terminal rules
edit one row (keep, rerole, delete); insertions are closed into the cells, so
that a cell already holds the rows put in before, between and behind. A cell
keeps, per nonterminal, the minimum (cost, audit), where the audit is the string
of the edits' initials.

Cells are combined bottom-up by span length: 1, 2, 4 and so on. One split per
span is enough, since every place r is tried at every split: whatever derives a
span does so across any point of it. (Two audits of one cost and one span are
never prefixes of each other: they hold one letter per row, and one more letter
is one more insertion to pay. So the smaller of two stays the smaller whatever
follows, and keeping only the smallest is exact.)

Rows are sorted by (conversation, turn, role, text digest) over all tasks, not
gathered by conversation: a conversation that spans several tasks gives one
cell in each, and the cells are combined in order. Equal rows are counted before
the sort. Only the digest of a repaired conversation, which is defined over its
whole text in order, reads one conversation in one task, as a stream.

Rows with null conversation ids are one conversation. Null turns come first;
null roles and texts are one space. Rows of one turn are ordered by role, then
by a digest of the text. An empty role has no initial and cannot be kept. A
conversation whose rows all go is reported with zeros and an empty audit. An
empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialize

# Places in (s?(ua)+)?: before all rows, behind s, behind u, behind a.
START, SYSTEM, USER, ASSISTANT = range(4)
PLACES = range(4)
#: Where a role initial leads from each place.
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER,
        (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
ROLE_AT = {USER: "user", ASSISTANT: "assistant"}
FINAL = (START, ASSISTANT)
#: Adjacent role initials that are as they should be.
LEGAL_PAIRS = frozenset(("su", "ua", "au"))

# Costs of the edits; a truncated row that is not deleted adds its own.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

#: ``cell[p, q]`` is the least (cost, audit) that leads from p to q.
Cell = dict[tuple[int, int], tuple[int, str]]

NO_FAULT, FAULTY_END, MUST_GO = range(3)


def join_cells(left: Cell, right: Cell) -> Cell:
    """The binary rules: the cell of two neighbouring spans."""
    out: Cell = {}
    for (p, r), (c1, a1) in left.items():
        for q in PLACES:
            other = right.get((r, q))
            if other is None:
                continue
            cost, best = c1 + other[0], out.get((p, q))
            if best is None or cost < best[0]:
                out[p, q] = cost, a1 + other[1]
            elif cost == best[0]:
                audit = a1 + other[1]
                if audit < best[1]:
                    out[p, q] = cost, audit
    return out


def _insertions() -> Cell:
    """Insertion closure of the empty span."""
    empty: Cell = {(p, p): (0, "") for p in PLACES}
    one = dict(empty)
    for (p, initial), q in STEP.items():
        if initial in "ua":
            one[p, q] = INSERT, "I"
    closed = empty
    for _ in PLACES:
        closed = join_cells(closed, one)
    return closed


EMPTY_SPAN = _insertions()


@lru_cache(maxsize=None)
def _one_row(initial: str, fault: int) -> Cell:
    rules: Cell = {(p, p): (DELETE, "D") for p in PLACES}
    if fault != MUST_GO:
        more = TRUNCATED if fault == FAULTY_END else 0
        for (p, letter), q in STEP.items():
            if letter == initial:
                rules[p, q] = KEEP + more, "K"
            elif letter in "ua":
                rules[p, q] = REROLE + more, "R"
    return join_cells(join_cells(EMPTY_SPAN, rules), EMPTY_SPAN)


def row_cell(initial: str, fault: int) -> Cell:
    """The terminal rules of one row; ``initial`` is empty where there is none."""
    return _one_row(initial if initial in ("s", "u", "a") else "", fault)


def deleted_rows(n: int) -> Cell:
    """``n`` rows that must go."""
    return {k: (DELETE * n + c, "D" * n + a) for k, (c, a) in EMPTY_SPAN.items()}


def parse(cells: list[Cell]) -> Cell:
    """The cell of a sequence of spans, combined bottom-up."""
    if not cells:
        return EMPTY_SPAN
    while len(cells) > 1:
        joined = [join_cells(cells[i], cells[i + 1]) for i in range(0, len(cells) - 1, 2)]
        cells = joined + cells[len(cells) - len(cells) % 2:]
    return cells[0]


def cheapest(cell: Cell) -> tuple[int, str]:
    """(cost, audit) of the start symbol."""
    return min(cell[START, q] for q in FINAL if (START, q) in cell)


class Span:
    """What a run of a conversation's rows comes to: its cell and its counts."""

    #: Row cells held before they are combined.
    HELD = 1024
    FIELDS = ("blank", "duplicate", "truncated", "illegal", "turns")

    def __init__(self):
        self.cells: list[Cell] = []
        self.blocks: list[Cell] = []
        self.counts = dict.fromkeys(self.FIELDS, 0)
        self.first = self.last = None
        self.low = self.high = None

    def _adjacent(self, initial: str) -> None:
        if self.last is not None and self.last + initial not in LEGAL_PAIRS:
            self.counts["illegal"] += 1

    def _turns(self, low: int | None, high: int | None, turns: int) -> None:
        if low is None:
            return
        self.counts["turns"] += turns - (self.high == low)
        self.low, self.high = low if self.low is None else self.low, high

    def add_rows(self, turn, initial: str, n: int, blank: bool, truncated: bool,
                 is_first: bool) -> None:
        """``n`` equal rows; all but the first of its kind are duplicates."""
        if not n:
            return
        own = NO_FAULT
        if blank:
            self.counts["blank"] += n
            own = MUST_GO
        elif is_first:
            self.counts["duplicate"] += n - 1
            self.counts["truncated"] += truncated
            own = FAULTY_END if truncated else NO_FAULT
        else:
            self.counts["duplicate"] += n
            own = MUST_GO
        self._adjacent(initial)
        if n > 1 and initial * 2 not in LEGAL_PAIRS:
            self.counts["illegal"] += n - 1
        self.first = initial if self.first is None else self.first
        self.last = initial
        self._turns(turn, turn, 1)
        self.cells.append(row_cell(initial, own))
        if n > 1:
            self.cells.append(deleted_rows(n - 1))
        if len(self.cells) >= self.HELD:
            self._combine()

    def add_span(self, row: dict) -> None:
        """A later span of the same conversation, as written by ``row``."""
        if row["first"] is not None:
            self._adjacent(row["first"])
            self.first = row["first"] if self.first is None else self.first
            self.last = row["last"]
        for name in self.FIELDS[:-1]:
            self.counts[name] += row[name]
        self._turns(row["low"], row["high"], row["turns"])
        self.cells.append({(k // 4, k % 4): (c, a) for k, c, a in
                           zip(row["places"], row["costs"], row["audits"], strict=True)})

    def _combine(self) -> None:
        self.blocks.append(parse(self.cells))
        self.cells = []

    def cell(self) -> Cell:
        return parse(self.blocks + ([parse(self.cells)] if self.cells else []))

    def row(self) -> dict:
        cell = sorted(self.cell().items())
        return self.counts | {
            "first": self.first, "last": self.last, "low": self.low, "high": self.high,
            "places": [p * 4 + q for (p, q), _ in cell], "costs": [c for _, (c, _) in cell],
            "audits": [a for _, (_, a) in cell]}


_COUNTS = "blank long, duplicate long, truncated long, illegal long, turns long"
_SPAN = (f"conv long, part long, {_COUNTS}, first string, last string, low long, high long, "
         "places array<long>, costs array<long>, audits array<string>")
_REPORT = ("conv long, gaps long, blank long, duplicate long, truncated long, illegal long, "
           "cost long, audit string")


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(),
             "array<long>": pa.list_(pa.int64()), "array<string>": pa.list_(pa.string())}
    return pa.schema([(n, kinds[k]) for n, k in (f.split() for f in ddl.split(", "))])


#: Rows a task hands on at once, and characters at most.
OUT_ROWS, OUT_CHARS = 2048, 4 << 20


def _batches(rows: Iterator[dict], ddl: str) -> Iterator[pa.RecordBatch]:
    """Dictionaries as Arrow batches of bounded size."""
    schema, held, size = _arrow(ddl), [], 0
    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row.values() if isinstance(v, str))
        if len(held) >= OUT_ROWS or size >= OUT_CHARS:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _dicts(batches: Iterator[pa.RecordBatch], rows: int = 1024) -> Iterator[dict]:
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield from batch.slice(at, rows).to_pylist()


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One span per conversation of a sorted partition."""
    from pyspark import TaskContext

    part = TaskContext.get().partitionId()

    def rows() -> Iterator[dict]:
        span, conv, some = Span(), None, False
        for r in _dicts(batches):
            if some and r["conv"] != conv:
                yield span.row() | {"conv": conv, "part": part}
                span = Span()
            conv, some = r["conv"], True
            span.add_rows(r["turn"], r["initial"], r["n"], r["blank"], r["truncated"],
                          r["is_first"])
        if some:
            yield span.row() | {"conv": conv, "part": part}

    return _batches(rows(), _SPAN)


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One report per conversation from its spans in order."""
    def report(conv, span: Span) -> dict:
        cost, audit = cheapest(span.cell())
        turns = span.counts["turns"]
        gaps = span.high - span.low + 1 - turns if turns else 0
        return span.counts | {"conv": conv, "gaps": gaps, "cost": cost, "audit": audit}

    def rows() -> Iterator[dict]:
        span, conv = None, None
        for r in _dicts(batches, 64):
            if span is not None and r["conv"] != conv:
                yield report(conv, span)
                span = None
            span, conv = span or Span(), r["conv"]
            span.add_span(r)
        if span is not None:
            yield report(conv, span)

    return _batches(rows(), _REPORT)


#: Characters that do not show.
WHITE = " \t\n\x0b\x0c\r"


def counted_rows(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
                 copies: Column | None = None) -> DataFrame:
    """Equal rows with their number and own faults: conv, turn, role, text, n, ...

    ``copies`` says how often a row stands there (default 1). Rows that stand
    there zero times still tell that their conversation exists.
    """
    rows = df.select(F.col(conv_col).cast("long").alias("conv"),
                     F.col(turn_col).cast("long").alias("turn"),
                     F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
                     (F.lit(1) if copies is None else copies).cast("long").alias("n"))
    same = rows.groupBy("conv", "turn", "role", "text").agg(F.sum("n").alias("n"))
    visible = F.rtrim("text", F.lit(WHITE))
    return same.select(
        "*", F.sha2("text", 256).alias("digest"), F.left("role", F.lit(1)).alias("initial"),
        (visible == "").alias("blank"),
        (~F.right(visible, F.lit(1)).isin(".", "!", "?")).alias("truncated"))


class Repair:
    """Conversations, repaired: ``report`` and ``rows`` or ``digests``."""

    def __init__(self, counted: DataFrame):
        self.counted = materialize(counted, "repair-rows")
        self.report = materialize(self._report(), "repair-report")

    def _report(self) -> DataFrame:
        rows = self.counted.select("conv", "turn", "role", "digest", "n", "initial", "blank",
                                   "truncated")
        key = ["conv", "role", "digest"]
        earliest = (rows.where("n > 0").groupBy(*key)
                    .agg(F.min(F.struct(F.col("turn").isNotNull(), "turn")).alias("e"))
                    .select(*[F.col(k).alias(f"e_{k}") for k in key],
                            F.col("e.turn").alias("e_turn")))
        same = (F.col("conv").eqNullSafe(F.col("e_conv")) & (F.col("role") == F.col("e_role"))
                & (F.col("digest") == F.col("e_digest")))
        marked = rows.join(earliest, same, "left").select(
            "conv", "turn", "role", "digest", "n", "initial", "blank", "truncated",
            F.col("turn").eqNullSafe(F.col("e_turn")).alias("is_first"))
        order = ["conv", "turn", "role", "digest"]
        ordered = marked.repartitionByRange(*order).sortWithinPartitions(*order)
        spans = materialize(ordered.mapInArrow(_spans, _SPAN), "repair-spans")
        return (spans.repartition("conv").sortWithinPartitions("conv", "part")
                .mapInArrow(_reports, _REPORT))

    def _streams(self) -> DataFrame:
        """Per conversation in one stream: its report, then its rows in order."""
        heads = self.report.select("conv", F.lit(0).cast("long").alias("kind"),
                                   *_nulls("turn long, role string, digest string, n long"),
                                   F.col("audit").alias("text"))
        rows = self.counted.where("n > 0").select(
            "conv", F.lit(1).cast("long").alias("kind"), "turn", "role", "digest", "n", "text")
        return (heads.unionByName(rows).repartition("conv")
                .sortWithinPartitions("conv", "kind", "turn", "role", "digest"))

    def rows(self) -> DataFrame:
        """The repaired conversations: conv, at (from 0), edit (K, R or I), role, text."""
        ddl = "conv long, at long, edit string, role string, text string"

        def run(batches):
            def out():
                for conv, edits in repaired(_dicts(batches, 64)):
                    for at, (edit, role, text) in enumerate(edits):
                        yield {"conv": conv, "at": at, "edit": edit, "role": role, "text": text}
            return _batches(out(), ddl)

        return self._streams().mapInArrow(run, ddl)

    def digests(self) -> DataFrame:
        """conv, repaired_sha256 over the repaired ``role:text``, joined by line feeds,
        with the columns of the report."""
        ddl = "conv long, audit string, repaired_sha256 string"

        def run(batches):
            def out():
                for conv, edits in repaired(_dicts(batches, 64)):
                    digest, between = hashlib.sha256(), ""
                    for _, role, text in edits:
                        digest.update(f"{between}{role}:{text}".encode())
                        between = "\n"
                    yield {"conv": conv, "audit": edits.audit,
                           "repaired_sha256": digest.hexdigest()}
            return _batches(out(), ddl)

        digests = self._streams().mapInArrow(run, ddl).select(
            F.col("conv").alias("d_conv"), "repaired_sha256")
        return self.report.join(digests, F.col("conv").eqNullSafe(F.col("d_conv"))).drop("d_conv")


def _nulls(ddl: str) -> list[Column]:
    return [F.lit(None).cast(kind).alias(name)
            for name, kind in (f.split() for f in ddl.split(", "))]


class _Edits:
    """The edits of one conversation, applied while its rows pass by."""

    def __init__(self, audit: str, rows: Iterator[dict]):
        self.audit, self._rows = audit, rows

    def __iter__(self) -> Iterator[tuple[str, str, str]]:
        place, row, left = START, None, 0
        for edit in self.audit:
            if edit == "I":
                place = next(STEP[place, x] for x in "ua" if (place, x) in STEP)
                yield "I", ROLE_AT[place], ""
                continue
            if not left:
                row = next(self._rows)
                left = row["n"]
            left -= 1
            if edit == "K":
                place = STEP[place, row["role"][:1]]
                yield "K", row["role"], row["text"]
            elif edit == "R":
                place = next(STEP[place, x] for x in "ua" if (place, x) in STEP)
                yield "R", ROLE_AT[place], row["text"]


def repaired(stream: Iterator[dict]) -> Iterator[tuple[int | None, _Edits]]:
    """(conversation, edits) of a sorted stream; each is to be read to its end."""
    head = next(stream, None)
    while head is not None:
        following: list[dict] = []

        def rows() -> Iterator[dict]:
            for row in stream:
                if row["kind"] == 0:
                    following.append(row)
                    return
                yield row

        own = rows()
        yield head["conv"], _Edits(head["text"], own)
        for _ in own:
            pass
        head = following[0] if following else None


def repair(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str,
           copies: Column | None = None) -> Repair:
    """Parse and repair every conversation of ``df``."""
    return Repair(counted_rows(df, conv_col, turn_col, role_col, text_col, copies))


def damaged(df: DataFrame, conv_col: str, turn_col: str, role_col: str,
            text_col: str) -> DataFrame:
    """Rows with planted faults by crc32(``conv:turn``) % 20: conv, turn, role, text, copies.

    0: gone (no copies), 1: empty text, 2: no ``.!?``, 3: two copies, 4: role user.
    Nulls count as one space, in the hashed text too.
    """
    def text_of(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    fate = F.crc32(F.concat_ws(":", text_of(conv_col), text_of(turn_col)).cast("binary")) % 20
    role, text = text_of(role_col), text_of(text_col)
    return df.select(
        F.col(conv_col).cast("long").alias("conv"), F.col(turn_col).cast("long").alias("turn"),
        F.when(fate == 4, F.lit("user")).otherwise(role).alias("role"),
        F.when(fate == 1, F.lit("")).when(fate == 2, F.translate(text, ".!?", ""))
        .otherwise(text).alias("text"),
        F.when(fate == 0, 0).when(fate == 3, 2).otherwise(1).alias("copies"))
