"""Files as tables: listings as frames, and reading parts of files inside tasks.

A listing is a DataFrame (path, size), one row per file, so what is done per file
runs in tasks and no list of files is handled on the driver. Tasks open files
with Arrow's file systems; a path of a mount table (``viewfs``) is resolved to
what it stands for first. ``can_open`` tells whether tasks can read a folder
that way; readers of Spark's own are the way for all others.
"""

from __future__ import annotations

import re

from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..lake import filesystem

#: Schemes that Arrow's file systems know.
SCHEMES = ("file", "hdfs", "s3", "s3a", "gs", "gcs")
_URI = re.compile(r"([A-Za-z][A-Za-z0-9+.-]*):(?://([^/]*))?(/.*)", re.S)


def resolved(spark: SparkSession, path: str) -> str:
    """A folder or file with its scheme, mount points followed."""
    fs, hpath = filesystem(spark, path)
    return fs.resolvePath(hpath).toString()


def can_open(uri: str) -> bool:
    found = _URI.fullmatch(uri)
    return bool(found) and found[1] in SCHEMES


def open_range(uri: str):
    """A file opened for reading at any offset (inside a task)."""
    scheme, host, path = _URI.fullmatch(uri).groups()
    if scheme == "file":
        return pafs.LocalFileSystem().open_input_file(path)
    fs, root = pafs.FileSystem.from_uri(f"{scheme.replace('s3a', 's3')}://{host or ''}/")
    return fs.open_input_file(path if scheme == "hdfs" else f"{root.rstrip('/')}{path}")


def listing(spark: SparkSession, folders: list[str]) -> DataFrame:
    """path, size of the data files in folders (or of files): one row per file.

    Spark's own listing: names starting with ``_`` or ``.`` are no data. Contents
    are not read. Empty files are left out.
    """
    frames = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(
        [resolved(spark, f) for f in folders])
    return frames.select("path", F.col("length").alias("size")).where("size > 0")
