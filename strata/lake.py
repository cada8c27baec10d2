"""Where each layer lives under one root folder, and folder listings on it."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from .session import run_root, storage_root


# Layers whose folders hold catalog tables (bronze holds landed files).
TABLE_LAYERS = ("silver", "gold", "logs")
# Folder, in a database folder, of the definitions of its tables.
DEFINITIONS = "_tables"


@dataclass(frozen=True)
class Lake:
    root: str

    @classmethod
    def of(cls, spark: SparkSession) -> "Lake":
        """The lake at the session's storage root."""
        return cls(storage_root(spark) + "/lake")

    @classmethod
    def fresh(cls, spark: SparkSession, label: str) -> "Lake":
        """A lake in a new folder of its own (one run of a query or test)."""
        return cls(run_root(spark, label))

    def bronze(self, source: str, table: str) -> str:
        """Landing base of one source table; days are ``ingest_date=`` folders."""
        return f"{self.root}/bronze/{source}/{table}"

    def location(self, layer: str, schema: str, table: str) -> str:
        """Folder of a silver, gold or logs table."""
        return f"{self.root}/{layer}/{schema}/{table}"

    def table_folders(self, spark: SparkSession,
                      layers: tuple[str, ...] = TABLE_LAYERS) -> list[tuple[str, str, str]]:
        """(database, table, folder) of every table folder under the layers."""
        out = []
        for layer in layers:
            for schema in subdirectories(spark, f"{self.root}/{layer}"):
                for table in subdirectories(spark, f"{self.root}/{layer}/{schema}"):
                    out.append((schema, table, self.location(layer, schema, table)))
        return out


def filesystem(spark: SparkSession, path: str):
    """(Hadoop FileSystem, Path) of ``path``, for listings on the driver."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def subdirectories(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under ``path`` (none when it is missing).

    Names starting with ``_`` or ``.`` (Spark's own bookkeeping) are left out.
    """
    fs, hpath = filesystem(spark, path)
    if not fs.exists(hpath):
        return []
    names = [st.getPath().getName() for st in fs.listStatus(hpath) if st.isDirectory()]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def definition_path(location: str) -> str:
    """Where the definition of the table at ``location`` is kept.

    Next to the table folder, in its database folder (``_tables/<name>.json``):
    an overwrite of the table replaces its folder's contents, not this file,
    and names starting with ``_`` are not taken for tables or data.
    """
    parent, name = location.rstrip("/").rsplit("/", 1)
    return f"{parent}/{DEFINITIONS}/{name}.json"


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder this run made for itself."""
    fs, hpath = filesystem(spark, path)
    fs.delete(hpath, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file (metadata) from the driver, replacing it."""
    fs, hpath = filesystem(spark, path)
    out = fs.create(hpath, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small text file so that readers see the old text or the new one, no part."""
    jvm = spark.sparkContext._jvm
    new = f"{path}.{uuid.uuid4().hex[:12]}"
    write_text(spark, new, text)
    hadoop = jvm.org.apache.hadoop.fs
    overwrite = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 1)
    overwrite[0] = hadoop.Options.Rename.OVERWRITE
    source = hadoop.Path(new)
    context = hadoop.FileContext.getFileContext(
        filesystem(spark, path)[0].getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    context.rename(source, hadoop.Path(path), overwrite)


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small text file (metadata) read on the driver; None when missing."""
    fs, hpath = filesystem(spark, path)
    if not fs.exists(hpath):
        return None
    stream = fs.open(hpath)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
