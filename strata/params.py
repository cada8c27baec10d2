"""Job parameters: the JSON files of a source/table, loaded and validated.

Parameters are plan inputs read on the driver, never data. Validation fails
early with a clear message where the original jobs would have crashed later
(no ``schema`` while the table must be created, unknown ``ext``, bad ``mode``).
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from pathlib import Path
from typing import Any

from pyspark.sql import SparkSession

from .functions.names import quote
from .lake import read_text

SUPPORTED_FORMATS = ("csv", "json", "parquet")
WRITE_MODES = ("overwrite", "append")


class ParamError(ValueError):
    """A parameter file that cannot drive a job."""


def _flag(value: Any) -> bool | None:
    """A true/false parameter, also as text; None when it is absent."""
    if isinstance(value, str):
        return value.strip().lower() in ("true", "1", "yes")
    return None if value is None else bool(value)


def _mode(value: str) -> str:
    mode = str(value).lower()
    if mode not in WRITE_MODES:
        raise ParamError(f"mode must be one of {WRITE_MODES}, got {value!r}")
    return mode


@dataclass(frozen=True)
class IngestParams:
    """Bronze -> silver: landed files of one source table into a typed table."""

    target_schema: str
    target_table: str
    schema: tuple[tuple[str, str], ...] = ()
    partition_column: str | None = None
    mode: str = "overwrite"
    ext: str = "csv"
    sep: str = ";"
    header: bool = True
    multi_line: bool | None = None  # None: as the landing marked it (CSV), lines (JSON)
    compression: str | None = None
    url: str | None = None
    rebalance: bool = True  # False: no shuffle before the write (input already well dealt)
    evolve: bool = False  # let an existing table follow the declared schema

    def __post_init__(self):
        if self.ext not in SUPPORTED_FORMATS:
            raise ParamError(f"ext must be one of {SUPPORTED_FORMATS}, got {self.ext!r}")
        _mode(self.mode)
        names = [c for c, _ in self.schema]
        if len(set(n.lower() for n in names)) != len(names):
            raise ParamError("schema declares a column twice")
        if self.partition_column and self.schema and self.partition_column not in names:
            raise ParamError(
                f"partition column {self.partition_column!r} is not in the declared schema")

    @property
    def table(self) -> str:
        return f"{self.target_schema}.{self.target_table}"

    def require_schema(self) -> tuple[tuple[str, str], ...]:
        if not self.schema:
            raise ParamError(
                f"{self.table}: no 'schema' in the parameters; it is needed to "
                "create the table")
        return self.schema

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> "IngestParams":
        for key in ("target_schema", "target_table"):
            if key not in d:
                raise ParamError(f"missing required parameter {key!r}")
        schema = d.get("schema") or {}
        if not isinstance(schema, dict):
            raise ParamError("'schema' must be an object {column: type}")
        return cls(
            target_schema=d["target_schema"],
            target_table=d["target_table"],
            schema=tuple((str(k), str(v)) for k, v in schema.items()),
            partition_column=d.get("partition_column") or None,
            mode=_mode(d.get("mode", "overwrite")),
            ext=str(d.get("ext", "csv")).lower(),
            sep=d.get("sep", ";"),
            header=_flag(d.get("header", True)) is not False,
            multi_line=_flag(d.get("multi_line", d.get("multiline"))),
            compression=d.get("compression"),
            url=d.get("url"),
            rebalance=_flag(d.get("rebalance")) is not False,
            evolve=_flag(d.get("evolve")) is True,
        )


@dataclass(frozen=True)
class GoldParams:
    """Silver -> gold: one SQL text into one table."""

    target_schema: str
    target_table: str
    partition_column: str | None = None
    mode: str = "overwrite"
    compression: str | None = None

    def __post_init__(self):
        _mode(self.mode)

    @property
    def table(self) -> str:
        return f"{self.target_schema}.{self.target_table}"

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> "GoldParams":
        for key in ("target_schema", "target_table"):
            if key not in d:
                raise ParamError(f"missing required parameter {key!r}")
        return cls(d["target_schema"], d["target_table"],
                   d.get("partition_column") or None, _mode(d.get("mode", "overwrite")),
                   d.get("compression"))


@dataclass(frozen=True)
class QualityParams:
    """Data-quality suite: ordered {check_name: params}."""

    checks: tuple[tuple[str, dict[str, Any]], ...] = field(default_factory=tuple)
    stop_job: bool = False
    materialize: bool = False

    @classmethod
    def from_dict(cls, d: dict[str, Any]) -> "QualityParams":
        qp = d.get("quality_params")
        if not isinstance(qp, dict):
            raise ParamError("missing 'quality_params' object")
        return cls(tuple((k, dict(v)) for k, v in qp.items()), bool(d.get("stop_job", False)),
                   bool(d.get("materialize", False)))


def landing_read_schema(schema: tuple[tuple[str, str], ...]) -> str:
    """Reader schema for self-describing landed files (JSON) from a declared one.

    Scalar columns are read as text, so the declared cast applies exactly as for
    CSV (and no inference pass over the files is needed); nested columns keep
    their declared type.
    """
    parts = []
    for name, type_name in schema:
        t = type_name.strip().lower()
        nested = t.startswith(("array", "map", "struct"))
        parts.append(f"{quote(name)} {type_name if nested else 'STRING'}")
    return ", ".join(parts)


def _read(spark: SparkSession, path: str) -> str:
    text = read_text(spark, path)
    if text is None:
        raise FileNotFoundError(path)
    return text


def load_json(spark: SparkSession, path: str) -> dict[str, Any]:
    """A parameter file, from any file system the session reads."""
    return json.loads(_read(spark, path))


def params_path(base: str | Path, source: str, table: str) -> str:
    """``params/{source}/{table}.json`` under a base folder."""
    return f"{str(base).rstrip('/')}/params/{source}/{table}.json"


def read_sql_text(spark: SparkSession, base: str | Path, layer: str, name: str) -> str:
    """``query/{layer}/{name}.sql`` under a base folder (layer: gold | quality)."""
    return _read(spark, f"{str(base).rstrip('/')}/query/{layer}/{name}.sql")
