"""Helpers shared by the operators: tables in the shared folder, files, columns."""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lake import remove_folder
from ..session import run_root


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, label: str, instead_of: DataFrame | None = None) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared root and read it back.

    Cuts the lineage: a lost executor costs a read of committed files, never a
    second run of what came before. ``instead_of``, a materialized frame that nothing
    reads any more once ``df`` is written, is removed then.
    """
    spark = df.sparkSession
    path = run_root(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.folder_of_run = path
    if instead_of is not None:
        remove_folder(spark, instead_of.folder_of_run)
    return out


def id_in_fold(id_col: Column, mod: int, rem: int) -> Column:
    """Whether crc32 of the id as text has remainder ``rem`` (null id: false)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % mod == rem, F.lit(False))


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Arrow batches cut into short ones, so that what a task makes of whole
    texts is handed on before it grows with the batch size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def open_fs(path: str) -> tuple[pafs.FileSystem, str]:
    """File system and path behind a URI or absolute path, usable inside a task."""
    return pafs.FileSystem.from_uri(path)


class CommittedFile:
    """A binary file a task writes whole or not at all.

    Bytes go to a name of this attempt; ``commit`` moves the file to its final
    name. Contents are a function of the task's input, so a second attempt
    replaces a file with the same bytes.
    """

    def __init__(self, folder: str, name: str):
        self.fs, base = open_fs(folder)
        self.fs.create_dir(base, recursive=True)
        self.final = posixpath.join(base, name)
        ctx = TaskContext.get()
        attempt = ctx.taskAttemptId() if ctx else 0
        self.temp = posixpath.join(base, f"_{name}.{attempt}-{uuid.uuid4().hex[:8]}")
        self.out = self.fs.open_output_stream(self.temp)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.out.write(data)
        self.size += len(data)

    def commit(self) -> None:
        self.out.close()
        self.fs.move(self.temp, self.final)
