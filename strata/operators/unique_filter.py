"""Exact unique checks behind a counting filter: values seen once do not enter the shuffle.

Two passes over the checked columns. The first fills a filter of fixed size, two
bits per place: seen, and seen again. Every task fills its own over the hashes of
its values and hands on the parts of it that are not empty; the parts of all tasks
are merged place by place (seen again: in one of them, or seen in two). The second
pass sends on only values whose place was seen again, and these are counted exactly.
A value that occurs twice always marks its place, so nothing is lost; a value that
occurs once passes only when another value has its place, and is then counted as one.

The filter's size is ``2 ** bits`` places whatever the table's: each task holds two
bits per place, the driver and every task of the second pass one (16 MB at the default).
Beyond about ``2 ** bits / 10`` different values it lets ever more of them pass, which
costs shuffle, never exactness.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Places of the filter, as a power of two.
BITS = 27
#: Bytes of one part of the filter.
PART = 1 << 16

_PARTS = "part int, n long, seen binary, again binary"


def _mark(bits: np.ndarray, places: np.ndarray) -> None:
    """Set bits at sorted, distinct places."""
    if len(places):
        byte = places >> 3
        first = np.r_[0, np.nonzero(np.diff(byte))[0] + 1]
        bits[byte[first]] |= np.bitwise_or.reduceat(
            (1 << (places & 7)).astype(np.uint8), first)


def _marked(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> 3] >> (places & 7).astype(np.uint8)) & 1 == 1


def _parts_of(counts: dict[int, int], seen: np.ndarray, again: np.ndarray,
              ) -> Iterator[pa.RecordBatch]:
    """Numbers of values per column (part -1 - column), then the filter's parts in use."""
    kinds = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("seen", pa.binary()),
                       ("again", pa.binary())])
    yield pa.RecordBatch.from_pylist(
        [{"part": -1 - k, "n": n} for k, n in sorted(counts.items())], kinds)
    for at in range(0, len(seen), PART):
        if seen[at:at + PART].any():
            yield pa.RecordBatch.from_pylist([{
                "part": at // PART, "n": 0, "seen": seen[at:at + PART].tobytes(),
                "again": again[at:at + PART].tobytes()}], kinds)


def _fill(values: DataFrame, bits: int) -> DataFrame:
    """The tasks' filters over k (column number) and h (hash of a value)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, again = (np.zeros(1 << bits - 3, np.uint8) for _ in range(2))
        counts: dict[int, int] = {}
        for batch in batches:
            number = np.bincount(batch.column("k").to_numpy())
            for k in np.nonzero(number)[0].tolist():
                counts[k] = counts.get(k, 0) + int(number[k])
            places, times = np.unique(batch.column("h").to_numpy() & ((1 << bits) - 1),
                                      return_counts=True)
            _mark(again, places[(times > 1) | _marked(seen, places)])
            _mark(seen, places)
        yield from _parts_of(counts, seen, again)

    return values.mapInArrow(run, _PARTS)


def _merge(parts: DataFrame) -> DataFrame:
    """One row per part over all tasks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = pa.schema([("part", pa.int32()), ("n", pa.int64()), ("again", pa.binary())])
        held = None  # part, n, seen, again

        def out():
            return pa.RecordBatch.from_pylist([{
                "part": held[0], "n": held[1],
                "again": None if held[3] is None else held[3].tobytes()}], kinds)

        for batch in batches:
            for row in batch.to_pylist():
                seen, again = (None if row[c] is None else np.frombuffer(row[c], np.uint8)
                               for c in ("seen", "again"))
                if held is None or held[0] != row["part"]:
                    if held is not None:
                        yield out()
                    held = [row["part"], row["n"], seen, again]
                    continue
                held[1] += row["n"]
                if seen is not None:
                    held[3] = held[3] | again | (held[2] & seen)
                    held[2] = held[2] | seen
        if held is not None:
            yield out()

    return (parts.repartition("part").sortWithinPartitions("part")
            .mapInArrow(run, "part int, n long, again binary"))


def repeated_values(stacked: DataFrame, fields: list[str], bits: int = BITS,
                    ) -> tuple[DataFrame, dict[int, int]]:
    """(values that may be repeated, number of values per column).

    ``stacked``: k (column number) and the value fields, one row per value.
    """
    hashed = stacked.withColumn("h", F.xxhash64("k", *fields))
    again = np.zeros(1 << bits - 3, np.uint8)
    counts: dict[int, int] = {}
    for row in _merge(_fill(hashed.select("k", "h"), bits)).toLocalIterator():
        if row.part < 0:
            counts[-1 - row.part] = row.n
        else:
            again[row.part * PART:(row.part + 1) * PART] = np.frombuffer(row.again, np.uint8)
    shared = stacked.sparkSession.sparkContext.broadcast(again)

    @F.pandas_udf("boolean")
    def may_repeat(h: pd.Series) -> pd.Series:
        return pd.Series(_marked(shared.value, h.to_numpy() & ((1 << bits) - 1)))

    return hashed.where(may_repeat("h")).drop("h"), counts
