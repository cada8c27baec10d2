"""Exact top-k by integer inner product: tiled matrix products and tree merging.

Every task multiplies tiles of queries with shards of its candidates, selects
the k best of each tile row and keeps one list per query; the lists of the
tasks are merged in a tree (``vectors``). Products are exact: in double
precision where no sum can reach 2**53, with 64-bit integers up to 2**63, and
with unbounded integers (scores cut at the limits of long) beyond.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import Partial, Search, search_blocks, smallest_per_row, valid_vectors

#: Queries of one tile.
TILE_QUERIES = 256
LONG = np.iinfo(np.int64)


def scaled(vecs: np.ndarray, scale: float) -> np.ndarray:
    """floor(scale * x) of every component, as doubles (whole numbers)."""
    return np.floor(scale * vecs)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of two whole-number matrices."""
    bound = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * a.shape[1]
    if bound < 2.0 ** 53:
        return (a @ b.T).astype(np.int64)
    if bound < 2.0 ** 62:
        return a.astype(np.int64) @ b.astype(np.int64).T
    wide = [np.array([[int(x) for x in row] for row in m], object) for m in (a, b)]
    return np.clip(wide[0] @ wide[1].T, LONG.min + 2, LONG.max).astype(np.int64)


def tile_search(k: int, scale: float) -> Search:
    """Partial selection in every tile of ``TILE_QUERIES`` queries by one shard."""
    def search(q_ids: np.ndarray, q_vecs: np.ndarray, ids: np.ndarray,
               vecs: np.ndarray) -> Partial:
        shard, parts = scaled(vecs, scale), []
        for at in range(0, len(q_ids), TILE_QUERIES):
            score = products(scaled(q_vecs[at:at + TILE_QUERIES], scale), shard)
            own = q_ids[at:at + TILE_QUERIES, None] == ids[None, :]
            score[own] = LONG.min + 1
            query, row = smallest_per_row(-score, k)
            other = ~own[query, row]
            query, row = query[other], row[other]
            parts.append((query + at, row, score[query, row]))
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    return search


def exact_topk(df: DataFrame, id_col: str, vec_col: str, is_query: Column, k: int = 10,
               scale: float = 1024.0) -> DataFrame:
    """The k best candidates of every query: query_id, rank, vec_id, score.

    ``is_query`` marks query rows over a column ``id``; candidates are all rows
    but those of the query's own id. Vectors that are null or hold null or
    non-finite components, and rows without id, take no part; a vector meets
    only vectors of its length. Ties go to the smaller vec_id; a candidate row
    that repeats is listed as often as it is there, a repeated query once.
    """
    rows = valid_vectors(df, id_col, vec_col, allow_zero=True)
    return search_blocks(rows.where(is_query), rows, k, True, "long",
                         lambda dim: tile_search(k, scale), "exact-topk")


def every(n: int) -> Column:
    """Query rows: ids divisible by ``n``."""
    return F.col("id") % n == 0
