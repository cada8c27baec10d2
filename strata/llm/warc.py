"""WARC archives: written by tasks, read back by boundary-chain verification.

Writing: every page is one record. Of pages with equal payloads (SHA-1) the one
with the smallest id is a ``response`` with the payload, the others are
``revisit`` records that refer to it. A task writes one archive.

Reading: archives are cut into byte ranges. A range's task lists every place
where the record magic and a full header stand, with the offset of the record
behind it. The magic may also stand inside a payload, so a candidate counts
only if the chain of successors from the start of the file reaches it:

* inside a range, every chain is followed to the first offset behind the range;
  all candidates with the same such exit are one node;
* across ranges, a node's successor is the node that holds its exit, and pointer
  jumping over the nodes doubles the step length every round, so a file of n
  ranges takes log2(n) rounds of joins over about n narrow rows.

Then each range is read once more from its one reached record on. The chain has
to end at the end of the file, or the archive is broken and reading fails.

Edge cases: null payload is empty; a page without id sorts behind all others
and is stored without one; rows that repeat id and payload are alike (all are
responses where their id is the smallest).
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Callable, Iterator
from urllib.parse import quote

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import BinaryType, BooleanType

from ..session import run_root
from .common import CommittedFile, materialize, open_fs

# Fixed values of the format.
MAGIC = b"WARC/1.1\r\n"
BLOCK_END = b"\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"

#: Bytes of one range when reading, and ranges of one task (fewer where that leaves
#: cores idle); bytes read at a time; a header longer than ``HEADER_BYTES`` (by its
#: url) has no more than ``HEADER_LINES`` lines, so that no byte is read for many candidates.
RANGE_BYTES = 8 << 20
RANGES_PER_TASK = 16
READ_BYTES = 1 << 20
HEADER_BYTES = 64 << 10
HEADER_LINES = 16
#: Bits of the filter that tells which payloads may repeat.
FILTER_BITS = 1 << 23

_LENGTH = re.compile(rb"\r\nContent-Length: (\d+)\r\n", re.IGNORECASE)
RECORD = ("page_id long, payload_bytes long, payload_digest string, record_type string, "
          "refers_to long")


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'none' if page_id is None else page_id}>"


def page_of(urn: str) -> int | None:
    """The page id in a record id."""
    number = urn.strip("<>").rpartition(":")[2]
    return None if number == "none" else int(number)


def record(page_id: int | None, url: str | None, payload: bytes, size: int, digest: bytes,
           refers_to: int | None, date: str) -> bytes:
    """One record; ``refers_to`` makes it a revisit, whose payload is left out."""
    revisit = refers_to is not None
    block = HTTP if revisit else HTTP + payload
    fields = [("WARC-Type", "revisit" if revisit else "response"),
              ("WARC-Record-ID", record_id(page_id)),
              ("WARC-Date", date),
              ("WARC-Target-URI", quote(url or "", safe=":/?#[]@!$&'()*+,;=%~")),
              ("WARC-Payload-Digest", f"sha1:{base32_sha1(digest)}"),
              ("WARC-Payload-Length", str(size)),
              ("Content-Type", "application/http;msgtype=response"),
              ("Content-Length", str(len(block)))]
    if revisit:
        fields[2:2] = [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to))]
    head = MAGIC + "".join(f"{k}: {v}\r\n" for k, v in fields).encode() + b"\r\n"
    return head + block + BLOCK_END


@pandas_udf(BinaryType())
def _packed(payloads: pd.Series) -> pd.Series:
    return payloads.map(zstandard.ZstdCompressor(level=1).compress)


def _may_repeat(repeated: DataFrame) -> Callable[[str], Column]:
    """A test of a digest column: false only for digests not in ``repeated``.

    Four bits per digest in ``FILTER_BITS`` bits; at most one row per 64 bits
    comes to the driver.
    """
    places = [F.conv(F.substring(F.hex("sha1"), 8 * k + 1, 8), 16, 10).cast("long")
              % FILTER_BITS for k in range(4)]
    words = (repeated.select(F.explode(F.array(*places)).alias("bit"))
             .groupBy(F.shiftright("bit", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(bit & 63 as int))")).alias("bits")))
    table = np.zeros(FILTER_BITS >> 6, np.int64)
    for word, bits in words.collect():
        table[word] = bits
    shared = repeated.sparkSession.sparkContext.broadcast(table.view(np.uint64))

    @pandas_udf(BooleanType())
    def test(digests: pd.Series) -> pd.Series:
        raw = np.frombuffer(b"".join(digests), ">u4").reshape(-1, 5)[:, :4].astype(np.uint64)
        bit = raw % np.uint64(FILTER_BITS)
        set_ = shared.value[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))
        return pd.Series((set_ & np.uint64(1)).all(axis=1))

    return test


def write_archives(pages: DataFrame, id_col: str, payload_col: str, url_col: str | None,
                   folder: str, min_bytes: int = 0, date: str = "2000-01-01T00:00:00Z",
                   ) -> DataFrame:
    """Write one record per page into archives under ``folder``.

    Returns the committed list of archives: file, path, size. Payloads shorter than
    ``min_bytes`` are never revisits. Only pages whose digest may occur twice or
    more go through the join, found by a filter of fixed size (``FILTER_BITS``;
    what it lets through wrongly is joined and matches nothing); the others are
    written where they are read. Joined payloads travel compressed, and a
    frequent payload's pages are split by the skew join.
    """
    payload = F.coalesce(F.encode(F.col(payload_col).cast("string"), "UTF-8"), F.lit(b""))
    url = F.col(url_col).cast("string") if url_col else F.lit(None).cast("string")
    rows = pages.select(F.col(id_col).cast("long").alias("id"), url.alias("url"),
                        payload.alias("payload"))
    rows = rows.select("id", "url", "payload", F.length("payload").cast("long").alias("size"),
                       F.unhex(F.sha1("payload")).alias("sha1"))
    first = (rows.where(F.col("size") >= min_bytes).groupBy("sha1", "size")
             .agg(F.min("id").alias("first"), F.count("*").alias("n"))
             .where("n > 1 and first is not null").drop("n"))
    first = materialize(first, "repeated-payloads")
    maybe = _may_repeat(first)("sha1")
    alone = rows.where(~maybe).select("id", "url", "payload", "size", "sha1",
                                      F.lit(None).cast("long").alias("refers"))
    rows = rows.where(maybe).withColumn("payload", _packed("payload"))
    refers = F.when(~F.col("first").eqNullSafe(F.col("id")), F.col("first"))
    rows = rows.join(first, ["sha1", "size"], "left").withColumn("refers", refers)
    rows = rows.select("id", "url", F.when(F.col("refers").isNull(), F.col("payload"))
                       .alias("payload"), "size", "sha1", "refers", F.lit(True).alias("packed"))
    rows = rows.unionByName(alone.withColumn("packed", F.lit(False)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, out = TaskContext.get().partitionId(), None
        name = f"pages-{number:06d}.warc"
        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            for k in range(batch.num_rows):
                page, link, body, size, sha1, refers_to, packed = (
                    c[k].as_py() for c in batch.columns)
                out = out or CommittedFile(folder, name)
                body = unpack(body) if body and packed else body or b""
                out.write(record(page, link, body, size, sha1, refers_to, date))
        if out:
            out.commit()
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([f"{folder}/{name}"]),
                 pa.array([out.size], pa.int64())], names=["file", "path", "size"])

    return materialize(rows.mapInArrow(write, "file int, path string, size long"), "archives")


class Archive:
    """Random access to the records of one file."""

    def __init__(self, path: str, size: int):
        self.path, self.size = path, size
        fs, base = open_fs(path)
        self.src = fs.open_input_file(base)

    def header(self, at: int) -> tuple[bytes, int, int] | None:
        """(header, block offset, successor offset) of a record at ``at``, if one
        can stand there."""
        most = 1024
        while True:
            head, stop, _ = self.src.read_at(min(most, self.size - at), at).partition(BLOCK_END)
            if (stop or at + most >= self.size
                    or most >= HEADER_BYTES and head.count(b"\r\n") > HEADER_LINES):
                break
            most *= 8
        found = _LENGTH.search(head + b"\r\n")
        if not head.startswith(MAGIC) or not stop or not found:
            return None
        block = at + len(head) + len(BLOCK_END)
        return head, block, block + int(found[1]) + len(BLOCK_END)

    def candidates(self, begin: int, end: int) -> Iterator[tuple[int, int]]:
        """(offset, successor) of everything in a range that looks like a record."""
        for at in range(begin, end, READ_BYTES):
            until = min(at + READ_BYTES, end)
            data = self.src.read_at(min(until + len(MAGIC) - 1, self.size) - at, at)
            hit = data.find(MAGIC)
            while hit >= 0:
                found = self.header(at + hit)
                if found and found[2] <= self.size:
                    yield at + hit, found[2]
                hit = data.find(MAGIC, hit + 1)

    def row(self, at: int) -> tuple[tuple, int]:
        """Contents (``RECORD``) and successor of the record at ``at``."""
        found = self.header(at)
        if not found:
            raise ValueError(f"no record at {at} of {self.path}")
        head, block, after = found
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        page, kind = page_of(fields["WARC-Record-ID"]), fields["WARC-Type"]
        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
        size = int(fields["WARC-Payload-Length"])
        if kind == "response":
            begin, sha1 = block + len(HTTP), hashlib.sha1()
            end = after - len(BLOCK_END)
            for k in range(begin, end, READ_BYTES):
                sha1.update(self.src.read_at(min(READ_BYTES, end - k), k))
            if (end - begin, base32_sha1(sha1.digest())) != (size, digest):
                raise ValueError(f"payload at {at} of {self.path} does not match its digest")
        refers = page_of(fields["WARC-Refers-To"]) if kind == "revisit" else None
        return (page, size, digest, kind, refers), after


def _ranges(archives: DataFrame, range_bytes: int) -> DataFrame:
    begin = F.explode(F.sequence(F.lit(0), (F.col("size") - 1).cast("long"),
                                 F.lit(range_bytes))).alias("begin")
    return archives.where("size > 0").select("file", "path", "size", begin)


def exits(ranges: DataFrame, range_bytes: int) -> DataFrame:
    """Nodes: per range and exit the candidates that lead there (file, begin, exit, ats).

    Candidates whose chain ends inside the range lead nowhere and are left out.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                archive = Archive(r["path"], r["size"])
                end = min(r["begin"] + range_bytes, r["size"])
                leave: dict[int, int] = {}
                found = list(archive.candidates(r["begin"], end))
                for at, after in reversed(found):  # a successor always lies behind
                    leave[at] = leave.get(after, after)
                nodes: dict[int, list[int]] = {}
                for at, _ in found:
                    if leave[at] >= end:
                        nodes.setdefault(leave[at], []).append(at)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r["file"]] * len(nodes), pa.int32()),
                     pa.array([r["begin"]] * len(nodes), pa.int64()),
                     pa.array(list(nodes), pa.int64()),
                     pa.array(list(nodes.values()), pa.list_(pa.int64()))],
                    names=["file", "begin", "exit", "ats"])

    return ranges.mapInArrow(run, "file int, begin long, exit long, ats array<long>")


def reached(links: DataFrame) -> DataFrame:
    """Nodes (file, begin, exit) on the chain from each file's start.

    The nodes known so far are extended by all jumps, then each jump is joined
    with the jump that starts where it ends.
    """
    node, then = ["file", "begin", "exit"], ["file", "next_begin", "next_exit"]
    links = materialize(links, "links")
    held = links.select(*node, F.explode("ats").alias("at"))
    known = held.where("at = 0").select(*node)
    holder = held.select("file", F.col("begin").alias("next_begin"),
                         F.col("exit").alias("next_exit"), F.col("at").alias("exit"))
    jumps = materialize(links.select(*node).join(holder, ["file", "exit"])
                        .select(*node, *then[1:]), "jumps")
    n = 0
    while True:
        ahead = known.join(jumps, node).select(*then).toDF(*node)
        known = materialize(known.union(ahead).distinct(), "reached")
        if (count := known.count()) == n:
            return known
        n = count
        over = jumps.toDF("file", *then[1:], "over_begin", "over_exit")
        jumps = materialize(jumps.join(over, then).select(*node, "over_begin", "over_exit")
                            .toDF(*node, *then[1:]), "jumps")


def read_archives(archives: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """All records of the archives (``RECORD``), read in byte ranges."""
    ranges = materialize(_ranges(archives, range_bytes), "ranges")
    n, cores = ranges.count(), archives.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n, 4 * cores), n // RANGES_PER_TASK)
    chain = reached(exits(ranges.repartition(tasks), range_bytes))
    ends = chain.groupBy("file").agg(F.max("exit").alias("end"))
    broken = archives.where("size > 0").join(ends, "file", "left").where(
        ~F.col("end").eqNullSafe(F.col("size")))
    if bad := broken.select("path").first():
        raise ValueError(f"the record chain breaks off in {bad.path}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64())
        names = [c.split()[0] for c in RECORD.split(", ")]
        for batch in batches:
            for r in batch.to_pylist():
                archive, at = Archive(r["path"], r["size"]), r["at"]
                end = at - at % range_bytes + range_bytes
                out = []
                while at < min(end, r["size"]):
                    row, at = archive.row(at)
                    out.append(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)],
                    names=names)

    entered = chain.select("file", F.col("exit").alias("at")).union(
        archives.select("file", F.lit(0).cast("long")))
    starts = entered.join(archives, "file").where("at < size")
    return starts.repartition(tasks).mapInArrow(run, RECORD)


def archive_folder(spark, label: str = "warc") -> str:
    """A fresh folder for archives under the shared root."""
    return run_root(spark, label)
