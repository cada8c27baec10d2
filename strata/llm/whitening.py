"""Embedding whitening: leading principal components scaled to unit variance.

Four passes over the vectors, none of which gathers rows: exact sums, centred
covariance, projection (written), and the moments of what was projected. A task
reduces its rows to sums or to one matrix of the dimension's size; the rows of
these matrices are added up over tasks, keyed by matrix row. The driver sees
matrices only, whose size is that of the dimension and not of the table, finds
the leading eigenpairs (``eigen``) and sends the projection back.

Entries become whole numbers first, x = floor(scale * c) + shift, so that sums
and deviations are exact. Vectors that are null or hold null or non-finite
entries take no part; rows with a null id do. Repeated rows count as often as
they stand there. Vectors of different lengths are fitted apart, each length by
itself; empty vectors have no components. Entries beyond ``LARGEST`` / scale are
held there. Components without variance (an eigenvalue not above ``RANK`` times
the trace, as with one vector, or equal ones) cannot be scaled and are left out.
A deviation beyond a 64-bit integer is null. An empty table gives no rows; other
columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import eigen
from .common import materialize

#: Largest absolute value of a scaled entry.
LARGEST = 2.0 ** 44
#: Least share of the trace an eigenvalue must have.
RANK = 1e-10
#: Rows handled at once inside a task.
ROWS = 4096

#: Vectors of one length: (batch, rows x length).
Blocks = Iterator[tuple[pa.RecordBatch, np.ndarray]]


def whole_vectors(df: DataFrame, id_col: str, vec_col: str, scale: float,
                  shift: int) -> DataFrame:
    """id, x (array<long>), dim of the vectors that take part."""
    def entry(c: Column) -> Column:
        scaled = F.least(F.greatest(c * scale, F.lit(-LARGEST)), F.lit(LARGEST))
        return F.floor(scaled).cast("long") + F.lit(shift).cast("long")

    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    rows = df.select(F.col(id_col).cast("long").alias("id"),
                     F.col(vec_col).cast("array<double>").alias("vec"))
    return rows.where(F.col("vec").isNotNull() & finite).select(
        "id", F.transform("vec", entry).alias("x"), F.size("vec").alias("dim"))


def _blocks(batches: Iterator[pa.RecordBatch], name: str) -> Blocks:
    """Batches cut to rows of one length, with their vectors as a matrix."""
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            part = batch.slice(at, ROWS)
            dims = part.column("dim").to_numpy()
            for dim in np.unique(dims):
                same = part if len(dims) == np.sum(dims == dim) else part.filter(
                    pa.array(dims == dim))
                vecs = same.column(name).flatten().to_numpy(zero_copy_only=False)
                yield same, vecs.reshape(same.num_rows, -1)


def _exact_sums(rows: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Per length: number of vectors and exact sum of every entry."""
    def run(batches):
        n: dict[int, int] = {}
        total: dict[int, np.ndarray] = {}
        for part, x in _blocks(batches, "x"):
            dim = x.shape[1]
            n[dim] = n.get(dim, 0) + len(x)
            total[dim] = total.get(dim, 0) + x.sum(axis=0).astype(object)
        for dim in sorted(n):
            yield pa.RecordBatch.from_pydict(
                {"dim": [dim] * dim, "at": list(range(dim)), "n": [n[dim]] * dim,
                 "total": [str(v) for v in total[dim]]},
                pa.schema([("dim", pa.int32()), ("at", pa.int32()), ("n", pa.int64()),
                           ("total", pa.string())]))

    parts = rows.mapInArrow(run, "dim int, at int, n long, total string")
    sums = parts.groupBy("dim", "at").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out: dict[int, tuple[int, list[int]]] = {}
    for r in sorted(sums.collect()):
        out.setdefault(r.dim, (r.n, []))[1].append(int(r.total))
    return out


def _added_up(partial: DataFrame) -> dict[int, np.ndarray]:
    """Matrices per length from the tasks' matrices, added row by row in task order."""
    schema = "dim int, at int, vals array<double>"
    kinds = pa.schema([("dim", pa.int32()), ("at", pa.int32()),
                       ("vals", pa.list_(pa.float64()))])

    def run(batches):
        key, total = None, None
        for batch in batches:
            for dim, at, k in zip(*(batch.column(c).to_pylist() for c in ("dim", "at")),
                                  range(batch.num_rows), strict=True):
                vals = batch.column("vals")[k].values.to_numpy()
                if (dim, at) != key:
                    if key is not None:
                        yield _matrix_rows([key], [total], kinds)
                    key, total = (dim, at), np.zeros(len(vals))
                total = total + vals
        if key is not None:
            yield _matrix_rows([key], [total], kinds)

    summed = (partial.repartition("dim", "at").sortWithinPartitions("dim", "at", "task")
              .mapInArrow(run, schema))
    out: dict[int, list] = {}
    for r in sorted(summed.collect(), key=lambda r: (r.dim, r.at)):
        out.setdefault(r.dim, []).append(r.vals)
    return {dim: np.array(vals) for dim, vals in out.items()}


def _matrix_rows(keys, rows, kinds: pa.Schema, **more) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"dim": [k[0] for k in keys], "at": [k[1] for k in keys],
         "vals": [r.tolist() for r in rows]} | more, kinds)


def _task_matrices(rows: DataFrame, name: str,
                   matrix: Callable[[int, np.ndarray], np.ndarray]) -> DataFrame:
    """Sum over a task's blocks of ``matrix(dim, block)``: dim, at, vals, task."""
    kinds = pa.schema([("dim", pa.int32()), ("at", pa.int32()),
                       ("vals", pa.list_(pa.float64())), ("task", pa.int32())])

    def run(batches):
        total: dict[int, np.ndarray] = {}
        for part, block in _blocks(batches, name):
            dim = part.column("dim")[0].as_py()
            total[dim] = total.get(dim, 0) + matrix(dim, block)
        task = TaskContext.get().partitionId()
        for dim, m in sorted(total.items()):
            for at in range(0, len(m), 64):
                some = range(at, min(at + 64, len(m)))
                yield _matrix_rows([(dim, i) for i in some], [m[i] for i in some], kinds,
                                   task=[task] * len(some))

    return rows.mapInArrow(run, "dim int, at int, vals array<double>, task int")


class Centre:
    """n, and S = n * base + rest per entry with 0 <= rest < n."""

    def __init__(self, n: int, sums: list[int]):
        self.n, self.sums = n, sums
        self.base = np.array([s // n for s in sums], dtype=np.int64)
        self.rest = np.array([s % n for s in sums], dtype=np.int64)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S/n in double precision."""
        return (x - self.base).astype(np.float64) - self.rest / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum of (n*x - S)^2 per row, exactly; None beyond a 64-bit integer."""
        near = self.centred(x) * self.n
        size = np.einsum("ij,ij->i", near, near)
        with np.errstate(over="ignore"):
            d = (x - self.base) * np.int64(min(self.n, 2 ** 62)) - self.rest
            out = np.einsum("ij,ij->i", d, d).tolist()
        for i in np.nonzero(size > 4e18)[0]:
            out[i] = None
            if size[i] < 1.9e19:
                exact = sum((self.n * int(v) - s) ** 2
                            for v, s in zip(x[i], self.sums, strict=True))
                out[i] = exact if exact < 2 ** 63 else None
        return out


class Whitening:
    """Fitted on all vectors of ``df``; ``rows`` holds them projected.

    ``rows``: id, dim, n, deviation, w (array<double>). ``values[dim]``,
    ``components[dim]`` (columns), ``explained[dim]`` and ``identity_error[dim]``
    describe the fit of a length.
    """

    def __init__(self, df: DataFrame, id_col: str, vec_col: str, components: int = 32,
                 scale: float = 64.0, shift: int = 1_000_000):
        self.spark = df.sparkSession
        rows = whole_vectors(df, id_col, vec_col, scale, shift)
        self.centres = {dim: Centre(n, sums) for dim, (n, sums) in _exact_sums(rows).items()}
        self.values: dict[int, np.ndarray] = {}
        self.components: dict[int, np.ndarray] = {}
        self.explained: dict[int, np.ndarray] = {}
        for dim, covariance in self._covariances(rows).items():
            values, vectors = eigen.leading_pairs(covariance, min(components, dim))
            trace = float(np.trace(covariance))
            kept = int(np.sum(values > RANK * trace))
            self.values[dim], self.components[dim] = values[:kept], vectors[:, :kept]
            self.explained[dim] = values[:kept] / trace if kept else values[:0]
        self.rows = materialize(self._project(rows), "whitened")
        self.identity_error = self._identity_errors()

    def _covariances(self, rows: DataFrame) -> dict[int, np.ndarray]:
        if not self.centres:
            return {}
        shared = self.spark.sparkContext.broadcast(self.centres)

        def products(dim: int, x: np.ndarray) -> np.ndarray:
            y = shared.value[dim].centred(x)
            return y.T @ y

        summed = _added_up(_task_matrices(rows.where("dim > 0"), "x", products))
        shared.destroy()
        return {dim: m / self.centres[dim].n for dim, m in summed.items()}

    def _project(self, rows: DataFrame) -> DataFrame:
        scaled = {dim: self.components[dim] / np.sqrt(self.values[dim]) for dim in self.values}
        shared = self.spark.sparkContext.broadcast((self.centres, scaled))

        def run(batches):
            centres, projection = shared.value
            for part, x in _blocks(batches, "x"):
                dim = x.shape[1]
                if dim not in projection:  # empty vectors
                    continue
                centre = centres[dim]
                w = centre.centred(x) @ projection[dim]
                offsets = np.arange(len(w) + 1, dtype=np.int32) * w.shape[1]
                yield pa.RecordBatch.from_arrays(
                    [part.column("id"), part.column("dim"),
                     pa.array(np.full(len(x), centre.n), pa.int64()),
                     pa.array(centre.deviations(x), pa.int64()),
                     pa.ListArray.from_arrays(pa.array(offsets), pa.array(w.ravel()))],
                    names=["id", "dim", "n", "deviation", "w"])

        return rows.mapInArrow(run, "id long, dim int, n long, deviation long, w array<double>")

    def _identity_errors(self) -> dict[int, float]:
        """Largest absolute entry of the covariance of ``w`` minus the identity."""
        rows = self.rows.where(F.size("w") > 0).select("dim", "w")
        sums = _added_up(_task_matrices(rows, "w", lambda _, w: w.sum(axis=0, keepdims=True)))
        n = {dim: self.centres[dim].n for dim in sums}
        means = {dim: m[0] / n[dim] for dim, m in sums.items()}

        def products(dim: int, w: np.ndarray) -> np.ndarray:
            y = w - means[dim]
            return y.T @ y

        summed = _added_up(_task_matrices(rows, "w", products))
        return {dim: float(np.abs(m / n[dim] - np.eye(len(m))).max())
                for dim, m in summed.items()}

    def long_rows(self) -> DataFrame:
        """One row per vector and component: id, component (from 1), n, deviation,
        whitened, explained, identity_error."""
        fits = [(dim, self.explained[dim].tolist(), error)
                for dim, error in self.identity_error.items()]
        about = self.spark.createDataFrame(
            fits, "dim int, shares array<double>, identity_error double")
        each = self.rows.join(F.broadcast(about), "dim").select(
            "id", "n", "deviation", "shares", "identity_error",
            F.posexplode("w").alias("at", "whitened"))
        return each.select("id", (F.col("at") + 1).alias("component"), "n", "deviation",
                           "whitened", F.col("shares")[F.col("at")].alias("explained"),
                           "identity_error")
