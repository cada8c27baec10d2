"""Token-id files: independent zstandard frames, a trailing seek table, checksums.

A file is ``frame* index seek-table``. Every document is one frame (its ids as
little-endian unsigned 32-bit integers), so a reader decompresses the documents
asked for and nothing else. The seek table follows the public seekable format
of zstandard: per frame the compressed size, the plain size and the low 32 bits
of XXH64 of the plain bytes, in a skippable frame at the end. The index, a
skippable frame before it, holds the document ids in the order of the frames.
Any zstandard reader can decompress the whole file; skippable frames are passed
over.

``write_token_files`` range-partitions by document id, so file k holds smaller
ids than file k + 1, and streams one file per task; a task keeps one document
and 12 bytes per frame in memory. The manifest it returns (a committed table:
one row per file) gives each file's first position in the corpus.

Edge cases: null text is empty; a null id sorts first and is stored as null;
repeated rows are separate frames; an empty table gives an empty manifest.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import run_root
from .common import CommittedFile, materialize, open_fs, slices
from .pieces import ids_to_bytes, library_encoder

# Fixed values of the seekable format and of skippable frames.
SEEK_MAGIC = 0x8F92EAB1
SEEK_FRAME = 0x184D2A5E
INDEX_FRAME = 0x184D2A50
HAS_CHECKSUMS = 0x80
#: Stands for a null document id in the index.
NULL_ID = np.iinfo(np.int64).min

MANIFEST = ("file_no int, path string, n_docs long, n_ids long, n_bytes long, first_id long, "
            "last_id long")


class TokenFileWriter:
    """Writes one file; ``add`` a document's id bytes, then ``close``."""

    def __init__(self, folder: str, name: str, level: int):
        self.file = CommittedFile(folder, name)
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=False)
        self.ids: list[int] = []
        self.frames: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, data: bytes) -> None:
        frame = self.zstd.compress(data)
        self.file.write(frame)
        self.ids.append(NULL_ID if doc_id is None else doc_id)
        self.frames.append((len(frame), len(data), xxhash.xxh64_intdigest(data) & 0xFFFFFFFF))

    def close(self) -> None:
        index = np.array(self.ids, "<i8").tobytes()
        self.file.write(struct.pack("<II", INDEX_FRAME, len(index)) + index)
        table = np.array(self.frames, "<u4").tobytes()
        self.file.write(struct.pack("<II", SEEK_FRAME, len(table) + 9) + table
                        + struct.pack("<IBI", len(self.frames), HAS_CHECKSUMS, SEEK_MAGIC))
        self.file.commit()


class TokenFileReader:
    """Random access to one file: reads its tail, then the frames asked for."""

    def __init__(self, path: str):
        fs, base = open_fs(path)
        self.src = fs.open_input_file(base)
        size = self.src.size()
        count, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != SEEK_MAGIC or not flags & HAS_CHECKSUMS:
            raise ValueError(f"no seek table at the end of {path}")
        table_at = size - 9 - 12 * count
        self.frames = np.frombuffer(self._at(table_at, 12 * count), "<u4").reshape(-1, 3)
        index_at = table_at - 8 - 8 * count
        self.ids = np.frombuffer(self._at(index_at, 8 * count), "<i8")
        self.begins = np.concatenate([[0], np.cumsum(self.frames[:, 0], dtype=np.int64)])
        self.zstd = zstandard.ZstdDecompressor()

    def _at(self, offset: int, size: int) -> bytes:
        return self.src.read_at(size, offset)

    def __len__(self) -> int:
        return len(self.frames)

    def read(self, k: int) -> bytes:
        """Id bytes of the k-th document, checked against the seek table."""
        packed, plain, check = (int(x) for x in self.frames[k])
        data = self.zstd.decompress(self._at(int(self.begins[k]), packed), max_output_size=plain)
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != check:
            raise ValueError(f"checksum of frame {k} does not match")
        return data

    def find(self, doc_id: int) -> list[int]:
        """Frames of a document id, by binary search in the sorted index."""
        return list(range(np.searchsorted(self.ids, doc_id, "left"),
                          np.searchsorted(self.ids, doc_id, "right")))

    def close(self) -> None:
        self.src.close()


def write_token_files(df: DataFrame, id_col: str, text_col: str, folder: str,
                      tokenizer: str = "byte_bpe_50k.json", end_id: int = 0,
                      level: int = 1, added_tokens: bool = False) -> DataFrame:
    """Encode whole texts into token files under ``folder``; returns the manifest.

    The text's hash is a second sort key, so rows that repeat an id are spread
    over files too. Only id and hash are read for the range bounds' sample.
    ``added_tokens`` tells whether the tokenizer's added tokens are looked for in
    texts, as the library's ``encode`` does.
    """
    end = ids_to_bytes([end_id])

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = library_encoder(tokenizer, added_tokens).encode
        number, writer, n_ids = TaskContext.get().partitionId(), None, 0
        for batch in slices(batches):
            for doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("id", "text")),
                                    strict=True):
                writer = writer or TokenFileWriter(folder, f"tokens-{number:06d}.zst", level)
                data = encode(text) + end if text else end
                writer.add(doc_id, data)
                n_ids += len(data) // 4
        if writer:
            writer.close()
            ends = (None if k == NULL_ID else k for k in (writer.ids[0], writer.ids[-1]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int32()), pa.array([f"{folder}/tokens-{number:06d}.zst"]),
                 *(pa.array([n], pa.int64())
                   for n in (len(writer.ids), n_ids, writer.file.size, *ends))],
                names=[f.split()[0] for f in MANIFEST.split(", ")])

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    rows = rows.withColumn("h", F.xxhash64("text"))
    rows = rows.repartitionByRange("id", "h").sortWithinPartitions("id", "h")
    return materialize(rows.mapInArrow(write, MANIFEST), "token-manifest")


def read_token_files(manifest: DataFrame, files_per_task: int = 1) -> DataFrame:
    """Every document of the files: doc_id, start, n_tokens, ids_crc32.

    ``start`` counts the ids of all documents before it over all files, which
    are in id order. The running sum is over the files' rows, not documents.
    """
    before = Window.orderBy("file_no").rowsBetween(Window.unboundedPreceding, -1)
    files = manifest.select("path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("at"))
    tasks = max(1, manifest.count() // files_per_task)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                reader, at = TokenFileReader(row["path"]), row["at"]
                ids, starts, counts, sums = reader.ids, [], [], []
                for k in range(len(reader)):
                    data = reader.read(k)
                    starts.append(at)
                    counts.append(len(data) // 4)
                    sums.append(zlib.crc32(data))
                    at += len(data) // 4
                reader.close()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64(), mask=ids == NULL_ID), pa.array(starts, pa.int64()),
                     pa.array(counts, pa.int64()), pa.array(sums, pa.int64())],
                    names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.repartition(tasks).mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def fetch_documents(manifest: DataFrame, doc_ids: DataFrame) -> DataFrame:
    """Ids of the documents named in ``doc_ids`` (one long column): doc_id, ids.

    The manifest says between which ids a file's documents lie (24 bytes per file go
    to every task). A wanted id goes to the files it can be in, which look it up in
    their index and decompress its frames; files without a wanted id are not opened.
    Null ids are not looked up; an id that stands on several documents gives them all.
    """
    bounds = manifest.select("file_no", "first_id", "last_id").toPandas().sort_values("file_no")
    first, last = (bounds[c].fillna(NULL_ID).to_numpy(np.int64) for c in ("first_id", "last_id"))
    numbers = bounds["file_no"].to_numpy(np.int32)
    shared = manifest.sparkSession.sparkContext.broadcast((numbers, first, last))

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, first, last = shared.value
        for batch in batches:
            ids = batch.column(0).to_numpy()
            begin = np.searchsorted(last, ids, "left")
            many = np.maximum(np.searchsorted(first, ids, "right") - begin, 0)
            at = np.repeat(begin, many) + np.arange(many.sum()) - np.repeat(
                np.cumsum(many) - many, many)
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers[at], pa.int32()), pa.array(np.repeat(ids, many), pa.int64())],
                names=["file_no", "doc_id"])

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = reader = None
        for batch in slices(batches, 64):
            out: tuple[list, list] = [], []
            for new, doc_id in zip(*(batch.column(c).to_pylist() for c in ("path", "doc_id")),
                                   strict=True):
                if new != path:
                    if reader is not None:
                        reader.close()
                    path, reader = new, TokenFileReader(new)
                for k in reader.find(doc_id):
                    out[0].append(doc_id)
                    out[1].append(np.frombuffer(reader.read(k), "<u4").astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64()))],
                names=["doc_id", "ids"])
        if reader is not None:
            reader.close()

    wanted = doc_ids.toDF("doc_id").where("doc_id is not null").distinct()
    places = wanted.mapInArrow(locate, "file_no int, doc_id long")
    found = places.join(manifest.select("file_no", "path"), "file_no").select("path", "doc_id")
    return (found.repartition("path").sortWithinPartitions("path", "doc_id")
            .mapInArrow(fetch, "doc_id long, ids array<long>"))


def token_folder(spark, label: str = "token-files") -> str:
    """A fresh folder for token files under the shared root."""
    return run_root(spark, label)
