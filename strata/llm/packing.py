"""Best-fit packing of token sequences by linear grouping.

Lengths are whole numbers up to the capacity, so all that decides a packing is
the histogram of lengths: at most ``capacity`` numbers, whatever the number of
documents. ``plan_packing`` works on that histogram with runs of equal
sequences instead of single ones:

1. Lengths over a threshold are sorted and cut into groups of equal
   cardinality; each length counts as its group's largest.
2. Configurations over these few sizes are optimised one after another: the
   largest size left is completed to the fullest sum (exact subset-sum over the
   supply) and the configuration is used as often as the supply allows.
3. Actual lengths take the places of the rounded ones, which never overfills.
4. The small lengths go, longest first, each to the sequence with the least
   room that still holds it; only when none does is a sequence opened.

The plan is a list of runs: ``n`` pieces of one length, from an index among the
pieces of that length, go to ``n`` consecutive sequences at one offset. Pieces
find their place by their index, so no task sees more than its own rows.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slices
from .pieces import ids_to_bytes, library_encoder

PIECES = ("doc_id long, piece int, start long, length long, ids_crc32 long, "
          "part int, nth long")

#: Planned each way, since a plan costs a fraction of a second; the fewest sequences win.
GROUPS = (512, 1024)
SMALL_SHARES = (0.2, 0.3, 0.4)


@dataclass(frozen=True)
class Run:
    """Pieces ``first .. first + n - 1`` of a length go to sequences from ``seq`` on."""

    length: int
    first: int
    n: int
    seq: int
    offset: int


class _Packer:
    """Open sequences by room left, as runs (first sequence, count)."""

    def __init__(self, capacity: int):
        self.capacity = capacity
        self.runs: list[Run] = []
        self.rooms: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.has_room = 0  # bit r: some sequence has room r
        self.used: dict[int, int] = defaultdict(int)
        self.sequences = 0

    def open(self, n: int) -> tuple[int, int]:
        self.sequences += n
        return self.sequences - n, n

    def keep(self, room: int, run: tuple[int, int]) -> None:
        if room:
            self.rooms[room].append(run)
            self.has_room |= 1 << room

    def place(self, length: int, room: int, seq: int, n: int) -> None:
        self.runs.append(Run(length, self.used[length], n, seq, self.capacity - room))
        self.used[length] += n

    def best_fit(self, length: int, n: int) -> None:
        """Place ``n`` pieces, each where the least room that holds it is."""
        while n:
            fitting = self.has_room >> length
            if not fitting:
                self.keep(self.capacity, self.open(-(-n // (self.capacity // length))))
                continue
            room = length + (fitting & -fitting).bit_length() - 1
            seq, there = self.rooms[room].pop()
            if not self.rooms[room]:
                self.has_room &= ~(1 << room)
            took = min(n, there)
            self.place(length, room, seq, took)
            self.keep(room - length, (seq, took))
            if took < there:
                self.keep(room, (seq + took, there - took))
            n -= took


def linear_groups(counts: dict[int, int], groups: int) -> list[tuple[int, list[list[int]]]]:
    """Lengths in falling order cut into groups of equal cardinality.

    Each group is (its largest length, [[length, count], ...]).
    """
    size = max(1, -(-sum(counts.values()) // groups))
    out: list[tuple[int, list[list[int]]]] = []
    free = 0
    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if not free:
                out.append((length, []))
                free = size
            take = min(left, free)
            out[-1][1].append([length, take])
            left, free = left - take, free - take
    return out


def fullest_configuration(sizes: list[int], supply: list[int], capacity: int) -> list[int]:
    """How many of each size fill a sequence most, with the first size in supply
    at least once; sums are exact, found as bit sets, one per size and copy."""
    seed = next(k for k, n in enumerate(supply) if n)
    room = capacity - sizes[seed]
    mask = (1 << (room + 1)) - 1
    sums, steps = 1, []
    for k, n in enumerate(supply):
        for _ in range(min(n - (k == seed), room // sizes[k])):
            steps.append((k, sums))
            sums |= (sums << sizes[k]) & mask
        if sums >> room:
            break
    config = [0] * len(sizes)
    config[seed] = 1
    total = sums.bit_length() - 1
    for k, before in reversed(steps):
        if not before >> total & 1:
            config[k] += 1
            total -= sizes[k]
    return config


def plan_packing(counts: dict[int, int], capacity: int, small: int,
                 groups: int) -> tuple[list[Run], int]:
    """Runs that place every piece, and the number of sequences used."""
    packer = _Packer(capacity)
    grouped = linear_groups({k: n for k, n in counts.items() if k > small}, groups)
    sizes = [size for size, _ in grouped]
    supply = [sum(n for _, n in members) for _, members in grouped]
    while any(supply):
        config = fullest_configuration(sizes, supply, capacity)
        times = min(s // c for s, c in zip(supply, config, strict=True) if c)
        open_runs = [(capacity, *packer.open(times))]
        for k, copies in enumerate(config):
            supply[k] -= copies * times
            for _ in range(copies):
                open_runs = _substitute(packer, open_runs, grouped[k][1])
        for room, seq, n in open_runs:
            packer.keep(room, (seq, n))
    for length in sorted((k for k in counts if k <= small), reverse=True):
        packer.best_fit(length, counts[length])
    return packer.runs, packer.sequences


def best_plan(counts: dict[int, int], capacity: int, groups: Iterable[int],
              small_shares: Iterable[float]) -> tuple[list[Run], int]:
    """The plan with the fewest sequences among some group counts and thresholds."""
    plans = (plan_packing(counts, capacity, int(capacity * share), g)
             for g in groups for share in small_shares)
    return min(plans, key=lambda plan: plan[1])


def _substitute(packer: _Packer, open_runs: list[tuple[int, int, int]],
                members: list[list[int]]) -> list[tuple[int, int, int]]:
    """One actual piece of a group into each sequence of the runs."""
    out = []
    for room, seq, n in open_runs:
        while n:
            length, there = members[0]
            took = min(n, there)
            packer.place(length, room, seq, took)
            out.append((room - length, seq, took))
            seq, n = seq + took, n - took
            members[0][1] -= took
            if not members[0][1]:
                members.pop(0)
    return out


def cut_pieces(df: DataFrame, id_col: str, text_col: str, capacity: int, tokenizer: str,
               end_id: int, added_tokens: bool = False) -> DataFrame:
    """Token pieces of every whole text (``PIECES``).

    A document longer than the capacity is cut into full pieces; what is left
    over is its first piece. ``nth`` counts the pieces of a length in the task
    ``part``.
    """
    end = ids_to_bytes([end_id])
    width = 4 * capacity

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(tokenizer, added_tokens).encode
        part, seen = TaskContext.get().partitionId(), defaultdict(int)
        for batch in slices(batches):
            out = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = encode(text) + end if text else end
                cuts = [0, *range(len(data) % width or width, len(data), width), len(data)]
                for piece, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    length = (b - a) // 4
                    out.append((doc_id, piece, a // 4, length, zlib.crc32(data[a:b]), part,
                                seen[length]))
                    seen[length] += 1
            kinds = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(),
                     pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                names=[c.split()[0] for c in PIECES.split(", ")])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, PIECES)


def pack_documents(df: DataFrame, id_col: str, text_col: str, capacity: int = 2048,
                   tokenizer: str = "byte_bpe_50k.json", end_id: int = 0,
                   groups: tuple[int, ...] = GROUPS,
                   small_shares: tuple[float, ...] = SMALL_SHARES,
                   added_tokens: bool = False) -> DataFrame:
    """Pack whole texts into sequences of at most ``capacity`` tokens.

    Returns per piece: doc_id, piece, start, length, ids_crc32, sequence_id,
    offset. Null text is empty (the end id alone); null ids and repeated rows
    are packed like any other; an empty table gives no rows. ``added_tokens``
    tells whether the tokenizer's added tokens are looked for in texts, as the
    library's ``encode`` does. To the driver go
    at most ``capacity`` counts; the plan has some thousand runs and is
    broadcast.
    """
    spark = df.sparkSession
    pieces = materialize(cut_pieces(df, id_col, text_col, capacity, tokenizer, end_id,
                                    added_tokens), "pieces")
    per_task = pieces.groupBy("part", "length").agg((F.max("nth") + 1).alias("n"))
    per_task = materialize(per_task, "piece-counts")
    counts = {r.length: r.n
              for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs, _ = best_plan(counts, capacity, groups, small_shares)
    plan = np.array(sorted((r.length, r.first, r.seq, r.offset) for r in runs),
                    np.int64).reshape(-1, 4)
    shared = spark.sparkContext.broadcast(plan)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        keys = table[:, 0] << 44 | table[:, 1]
        for batch in batches:
            index = batch.column("index").to_numpy()
            row = np.searchsorted(keys, batch.column("length").to_numpy() << 44 | index,
                                  "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(table[row, 2] + index - table[row, 1]),
                 pa.array(table[row, 3])],
                names=[*batch.schema.names[:5], "sequence_id", "offset"])

    earlier = (Window.partitionBy("length").orderBy("part")
               .rowsBetween(Window.unboundedPreceding, -1))
    base = per_task.select("part", "length",
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    indexed = pieces.join(base, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("base") + F.col("nth")).alias("index"))
    return indexed.mapInArrow(
        assign, "doc_id long, piece int, start long, length long, ids_crc32 long, "
                "sequence_id long, offset long")
