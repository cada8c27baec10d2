"""SimHash near-duplicates verified through pivot distance tables.

Fingerprints: words are runs of non-white bytes after lower-casing A-Z, each
run of ``shingle`` words is hashed by XXH64, and a bit of the fingerprint is
set where over half the hashes have it. Fingerprints that differ in at most
``max_bits`` bits are linked.

Documents of one fingerprint are one class; only classes are compared:

* Which classes can meet: the 64 bits are cut into blocks; a pair that differs
  in at most ``max_bits`` bits agrees on ``blocks - max_bits`` whole blocks.
  Classes that agree on such a choice of blocks form a bucket. The number of
  blocks follows the number of classes, so that buckets of unlike texts stay at
  a few members at any size; it never decides which pairs are found.
* Pivot table: the distances of every bucket member to fixed reference
  fingerprints. Two members whose distances to any one reference differ by more
  than ``max_bits`` cannot be linked (triangle inequality); in large buckets
  members are sorted by the first distance, so most pairs are never formed.
* Survivors are verified bit by bit.

A bucket with more than ``TILE`` members is dealt out as pairs of chunks, each
a group of its own. A group returns the edges of a spanning forest, not all its
pairs. Components are found on the edges by ``connected_components``.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import materialize, slices
from .components import connected_components

SEED = 42
#: Members of a bucket that one group compares at most, twice over.
TILE = 2048
#: Reference fingerprints of the pivot table.
PIVOTS = np.array([xxhash.xxh64_intdigest(b"pivot", k) for k in range(32)], np.uint64)
#: Unlike classes of a bucket that are compared per class, about.
MEETINGS = 8


def fingerprint(text: str | None, shingle: int) -> int:
    """Unsigned 64-bit SimHash; no words: zero; fewer than ``shingle``: all of them."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = list(itertools.accumulate(len(w) + 1 for w in words))
    begins = [0, *ends[:-1]]
    parts = [joined[a:b - 1] for a, b in zip(begins, ends[min(shingle, len(words)) - 1:],
                                             strict=False)]
    hashes = np.array([xxhash.xxh64_intdigest(p, SEED) for p in parts], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[at:at + 65_536].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int) -> DataFrame:
    """doc_id, fp (the fingerprint as signed long) of every row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            fps = np.array([fingerprint(t, shingle) for t in batch.column(1).to_pylist()],
                           np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps.view(np.int64))],
                                             names=["doc_id", "fp"])

    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, fp long")


def block_masks(classes: int, max_bits: int) -> list[int]:
    """Masks of the block choices: a linked pair agrees on all bits of one of them.

    The fewest blocks with which ``classes`` random fingerprints meet about
    ``MEETINGS`` others each.
    """
    blocks = max_bits
    while True:
        blocks += 1
        keys = list(itertools.combinations(range(blocks), blocks - max_bits))
        bits = 64 * (blocks - max_bits) // blocks
        if classes * len(keys) <= 2 * MEETINGS << bits or blocks == 2 * max_bits + 4:
            break
    edges = [64 * k // blocks for k in range(blocks + 1)]
    parts = [(1 << b) - (1 << a) for a, b in itertools.pairwise(edges)]
    return [sum(parts[k] for k in key) for key in keys]


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def hex_fingerprint(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def pivot_table(fps: np.ndarray) -> np.ndarray:
    """Hamming distances of every fingerprint to every reference fingerprint."""
    return np.bitwise_count(fps[:, None] ^ PIVOTS[None, :]).astype(np.int8)


def _verified(a: np.ndarray, b: np.ndarray, fps: np.ndarray, table: np.ndarray,
              max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs that the pivot table cannot discard and that are within the radius."""
    near = np.abs(table[a] - table[b]).max(axis=1, initial=0) <= max_bits
    a, b = a[near], b[near]
    near = np.bitwise_count(fps[a] ^ fps[b]) <= max_bits
    return a[near], b[near]


def _join_labels(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Labels after joining the classes of every pair; the smallest label stays.

    Labels are members' indexes and point to themselves, before and after.
    """
    a, b = labels[a], labels[b]
    root = np.arange(len(labels))
    while True:
        low = np.minimum(root[a], root[b])
        if (root[a] == low).all() and (root[b] == low).all():
            return root[labels]
        np.minimum.at(root, a, low)
        np.minimum.at(root, b, low)
        while (root != root[root]).any():
            root = root[root]


def _link_large(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """Labels (an index each) of a large bucket's members, linked ones alike.

    Members are sorted by their first pivot distance; a row block is compared
    with the window of members whose distance can match, one pivot after
    another, and the pairs left are verified.
    """
    table = pivot_table(fps)
    order = np.argsort(table[:, 0], kind="stable")
    table, fps = table[order], fps[order]
    labels = np.arange(len(fps))
    for at in range(0, len(fps), 256):
        rows = table[at:at + 256]
        until = np.searchsorted(table[:, 0], rows[-1, 0] + max_bits, "right")
        near = np.ones((len(rows), until - at), bool)
        for k in range(4):
            near &= np.abs(rows[:, k, None] - table[None, at:until, k]) <= max_bits
        a, b = np.nonzero(near)
        a, b = a[a < b] + at, b[a < b] + at
        labels = _join_labels(labels, *_verified(a, b, fps, table, max_bits))
    out = np.empty(len(fps), np.int64)
    out[order] = order[labels]
    return out


def link_groups(group: np.ndarray, fps: np.ndarray, nodes: np.ndarray,
                max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges between nodes of a group (equal numbers, adjacent) that are linked.

    Small groups are compared all at once, large ones each on its own.
    """
    begins = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    sizes = np.diff(np.r_[begins, len(group)])
    ends_u, ends_v = [], []
    small = np.repeat(sizes <= 32, sizes)
    index = np.flatnonzero(small)
    table = pivot_table(fps[index])
    own, numbers = fps[index], group[index]
    for step in range(1, 32):
        a = np.flatnonzero(numbers[step:] == numbers[:-step])
        if not len(a):
            break
        a, b = _verified(a, a + step, own, table, max_bits)
        ends_u.append(nodes[index[a]])
        ends_v.append(nodes[index[b]])
    for begin, size in zip(begins[sizes > 32], sizes[sizes > 32], strict=True):
        labels = _link_large(fps[begin:begin + size], max_bits)
        moved = np.flatnonzero(labels != np.arange(size))
        ends_u.append(nodes[begin + moved])
        ends_v.append(nodes[begin + labels[moved]])
    if not ends_u:
        return nodes[:0], nodes[:0]
    return np.concatenate(ends_u), np.concatenate(ends_v)


def linked_classes(classes: DataFrame, max_bits: int) -> DataFrame:
    """Edges (u, v) that connect all classes (fp, node) within ``max_bits`` bits."""
    keys = F.array(*(F.struct(F.lit(k).alias("block"),
                              F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("bits"))
                     for k, mask in enumerate(block_masks(classes.count(), max_bits))))
    members = classes.select("fp", "node", F.explode(keys).alias("key")).select(
        "fp", "node", "key.block", "key.bits")
    shared = members.groupBy("block", "bits").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / TILE).cast("int")
    tiled = members.join(shared, ["block", "bits"]).withColumn(
        "mine", F.pmod(F.xxhash64("fp"), tiles).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), tiles - 1)))
    tile = ["block", "bits", "low", "high"]
    tiled = tiled.select("block", "bits", F.least("mine", "other").alias("low"),
                         F.greatest("mine", "other").alias("high"), "fp", "node")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(rows: list[np.ndarray], until: int) -> pa.RecordBatch:
            change = np.zeros(until, bool)
            for column in rows[:4]:
                change[1:] |= column[1:until] != column[:until - 1]
            u, v = link_groups(np.cumsum(change), rows[4][:until].view(np.uint64),
                               rows[5][:until], max_bits)
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())],
                                              names=["u", "v"])

        held: list[np.ndarray] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [c.to_numpy() for c in batch.columns]
            held = [np.concatenate(p) for p in zip(held, rows, strict=True)] if held else rows
            last = np.ones(len(held[0]), bool)  # rows of the last, perhaps unfinished, group
            for column in held[:4]:
                last &= column == column[-1]
            until = len(last) - int(last[::-1].argmin()) if not last.all() else 0
            if until:
                yield edges(held, until)
                held = [c[until:] for c in held]
        if held is not None and len(held[0]):
            yield edges(held, len(held[0]))

    return tiled.repartition(*tile).sortWithinPartitions(*tile).mapInArrow(run, "u long, v long")


def near_duplicates(df: DataFrame, id_col: str, text_col: str, shingle: int,
                    max_bits: int) -> DataFrame:
    """Fingerprint and component of every row: doc_id, fp, component_id.

    ``component_id`` is the smallest doc_id reachable over links, the row's own
    included. Null text is empty, and empty texts have fingerprint zero, linked
    like any other. A row with a null id gets the component of its fingerprint
    (null when no row with an id is in it). Rows that repeat come back as often
    as they are there; other columns are not read.
    """
    rows = materialize(fingerprints(df, id_col, text_col, shingle), "fingerprints")
    classes = rows.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("node"))
    classes = materialize(classes, "classes")
    roots = connected_components(linked_classes(classes, max_bits))
    component = classes.join(roots, "node", "left").select(
        "fp", F.coalesce("root", "node").alias("component_id"))
    return rows.join(component, "fp", "left").select("doc_id", "fp", "component_id")


def keep_one_each(docs: DataFrame, id_col: str, text_col: str, shingle: int,
                  max_bits: int) -> DataFrame:
    """The row of each component's smallest id, with all its columns.

    Of rows that repeat an id one of the component stays, the one with the
    smallest hash of the text. Where an id stands on rows with different
    fingerprints (few), these are computed again to tell the component's rows.
    Rows with a null id have no identity to be chosen by and all stay. Columns
    may have any names.
    """
    names = docs.columns
    docs = docs.toDF(*[f"c{k}" for k in range(len(names))])  # no name of theirs clashes
    id_col, text_col = (f"c{names.index(c)}" for c in (id_col, text_col))
    found = materialize(near_duplicates(docs, id_col, text_col, shingle, max_bits), "components")
    kept = found.where("doc_id = component_id").select(
        F.col("doc_id").alias("kept_id"), F.col("fp").alias("kept_fp")).distinct()
    mixed = found.where("doc_id is not null").groupBy(F.col("doc_id").alias("mixed_id")).agg(
        F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high")
    mixed = materialize(mixed.select("mixed_id"), "mixed-ids")

    @pandas_udf("long")
    def fp(texts: pd.Series) -> pd.Series:
        return pd.Series(np.array([fingerprint(t, shingle) for t in texts],
                                  np.uint64).view(np.int64))

    doc_id = docs[id_col].cast("long")
    own = doc_id == kept["kept_id"]
    named = docs.join(kept, own, "left_semi").join(mixed, doc_id == mixed["mixed_id"], "left_anti")
    unclear = docs.join(mixed, doc_id == mixed["mixed_id"], "left_semi")
    unclear = unclear.withColumn("own_fp", fp(F.coalesce(docs[text_col], F.lit(""))))
    unclear = unclear.join(kept, own & (F.col("own_fp") == kept["kept_fp"]), "left_semi")
    named = named.unionByName(unclear.drop("own_fp"))
    row = F.struct(*(named[c] for c in named.columns))
    least = F.struct(F.xxhash64(named[text_col]), named[text_col])
    chosen = named.groupBy(named[id_col].cast("long").alias("kept_id")).agg(
        F.min_by(row, least).alias("row")).select("row.*")
    return chosen.unionByName(docs.where(docs[id_col].isNull())).toDF(*names)
