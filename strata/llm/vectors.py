"""What the two vector searches share: valid vectors, shards, top lists, merging.

The queries are dealt into blocks of at most ``QUERY_BYTES``. Each block is
sent to all tasks; a task answers it from its part of the candidates, one shard
(``SHARD_ROWS`` rows) at a time, and keeps one top list per query. The lists of
the tasks are merged in a tree: first within ``FAN_IN`` branches per query,
then across the branches. Every block's answer is committed before the next
block is fetched.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import run_root

#: Bound of one broadcast block of queries.
QUERY_BYTES = 8 << 20
#: Candidate rows of one shard.
SHARD_ROWS = 4096
#: Branches of the first merge.
FAN_IN = 64

Partial = tuple[np.ndarray, np.ndarray, np.ndarray]
#: (query ids, query vectors, candidate ids in order, their vectors)
#: -> flat partial lists: query row, candidate row, score.
Search = Callable[[np.ndarray, np.ndarray, np.ndarray, np.ndarray], Partial]


def valid_vectors(df: DataFrame, id_col: str, vec_col: str, allow_zero: bool) -> DataFrame:
    """id, vec (double array) of the rows that take part.

    Left out are null ids, null or empty vectors and vectors with a null or
    non-finite component, and zero vectors unless ``allow_zero``.
    """
    finite = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists("vec", lambda x: x != 0)
    rows = df.select(F.col(id_col).cast("long").alias("id"),
                     F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & (F.size("vec") > 0))
    return rows.where(F.coalesce(finite, F.lit(False)) & (F.lit(allow_zero) | some))


def matrix(column) -> np.ndarray:
    """Rows of an Arrow list column whose lists have one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches joined and cut to about ``SHARD_ROWS`` rows."""
    held: list[pa.RecordBatch] = []
    rows = 0
    for batch in batches:
        for at in range(0, batch.num_rows, SHARD_ROWS):
            held.append(batch.slice(at, SHARD_ROWS))
            rows += held[-1].num_rows
            if rows >= SHARD_ROWS:
                yield pa.concat_batches(held)
                held, rows = [], 0
    if rows:
        yield pa.concat_batches(held)


def smallest_per_row(keys: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k smallest entries of each row, ties to the left column."""
    if keys.shape[1] <= k:
        return tuple(np.indices(keys.shape).reshape(2, -1))
    limit = np.partition(keys, k - 1, axis=1)[:, k - 1:k]
    below, tied = keys < limit, keys == limit
    room = k - below.sum(axis=1, keepdims=True)
    return np.nonzero(below | (tied & (np.cumsum(tied, axis=1) <= room)))


def trim(query: np.ndarray, ids: np.ndarray, score: np.ndarray, k: int,
         largest: bool) -> Partial:
    """The k best entries of every query among flat lists; ties to the smaller id."""
    order = np.lexsort((ids, -score if largest else score, query))
    query, ids, score = query[order], ids[order], score[order]
    first = np.searchsorted(query, query, "left")
    kept = np.arange(len(query)) - first < k
    return query[kept], ids[kept], score[kept]


def _answers(candidates: DataFrame, block: tuple[np.ndarray, np.ndarray], search: Search,
             k: int, largest: bool, score_type: str) -> tuple[DataFrame, object]:
    """One list per task and query of a block: task, query_id, vec_id, score."""
    shared = candidates.sparkSession.sparkContext.broadcast(block)
    kind = pa.int64() if score_type == "long" else pa.float64()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_ids, q_vecs = shared.value
        best: Partial | None = None
        for shard in shards(batches):
            ids = shard.column("id").to_numpy()
            order = np.argsort(ids, kind="stable")
            ids, vecs = ids[order], matrix(shard.column("vec"))[order]
            query, row, score = search(q_ids, q_vecs, ids, vecs)
            found = (query, ids[row], score)
            if best is not None:
                found = tuple(np.concatenate(p) for p in zip(best, found, strict=True))
            best = trim(*found, k, largest)
        if best is not None:
            task = np.full(len(best[0]), TaskContext.get().partitionId())
            yield pa.RecordBatch.from_arrays(
                [pa.array(task, pa.int64()), pa.array(q_ids[best[0]], pa.int64()),
                 pa.array(best[1], pa.int64()), pa.array(best[2], kind)],
                names=["task", "query_id", "vec_id", "score"])

    lists = candidates.mapInArrow(
        run, f"task long, query_id long, vec_id long, score {score_type}")
    return lists, shared


def _top(lists: DataFrame, by: list[str], k: int, order: Column) -> DataFrame:
    entry = F.struct(order.alias("o"), F.col("vec_id"), F.col("score"))
    return lists.groupBy(*by).agg(
        F.slice(F.array_sort(F.collect_list(entry)), 1, k).alias("top"))


def merge(lists: DataFrame, k: int, largest: bool) -> DataFrame:
    """Tree merge of the tasks' lists: query_id, rank, vec_id, score."""
    order = -F.col("score") if largest else F.col("score")
    branches = lists.withColumn("branch", F.pmod("task", F.lit(FAN_IN)))
    part = _top(branches, ["query_id", "branch"], k, order)
    final = _top(part.select("query_id", F.inline("top")).drop("o"), ["query_id"], k, order)
    return final.select("query_id", F.posexplode("top").alias("at", "hit")).select(
        "query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score")


def search_blocks(queries: DataFrame, candidates: DataFrame, k: int, largest: bool,
                  score_type: str, search_for: Callable[[int], Search], label: str) -> DataFrame:
    """All queries against all candidates of their dimension, block by block.

    ``search_for(dim)`` gives the search inside a shard. Queries that repeat an
    id count once, with the smallest of their vectors. Blocks are cut by a hash
    of the id into twice as many parts as the bytes ask for.
    """
    spark = candidates.sparkSession
    path = run_root(spark, label)
    schema = f"query_id long, rank int, vec_id long, score {score_type}"
    spark.createDataFrame([], schema).write.parquet(path)
    queries = queries.groupBy("id").agg(F.min("vec").alias("vec"))
    for dim, n in sorted(tuple(r) for r in queries.groupBy(F.size("vec")).count().collect()):
        same = candidates.where(F.size("vec") == dim)
        search = search_for(dim)
        parts = -(-n * dim * 8 // (QUERY_BYTES // 2))
        part = F.pmod(F.xxhash64("id"), F.lit(parts))
        for at in range(parts):
            found = queries.where((F.size("vec") == dim) & (part == at)).toArrow()
            if not found.num_rows:
                continue
            found = found.combine_chunks()
            block = (found.column("id").to_numpy(), matrix(found.column("vec").combine_chunks()))
            lists, shared = _answers(same, block, search, k, largest, score_type)
            merge(lists, k, largest).write.mode("append").parquet(path)
            shared.destroy()
    return spark.read.schema(schema).parquet(path)
