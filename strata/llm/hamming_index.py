"""Approximate nearest neighbours by multi-index hashing of learned codes.

Codes: vectors are centred and rotated so that the signs of the rotated
components keep as much of them as possible (alternating between signs and the
best rotation towards them). ``ROTATIONS`` such rotations from different starts
give that many bits per component. The model and the search radius are fitted
on a bounded sample (``SAMPLE`` vectors, the smallest id hashes): the radius is
the one that holds ``TARGET`` of the sample's true nearest neighbours.

Index: a code is split into 16-bit substrings, and every shard of the table has
one directory per substring (its values, each with its rows). A code within
radius r of the query's is, by the pigeonhole principle, within r // m (or one
less) of it in one of the m substrings; the directories give all rows whose
substring is that near, the whole codes are compared, and the rows within the
radius are ranked by the Euclidean distance of the original vectors. If a shard
holds fewer than k codes within the radius, it is widened for that query.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .vectors import Partial, Search, matrix, search_blocks, smallest_per_row, valid_vectors

SAMPLE = 4096
ROTATIONS = 2
TARGET = 0.98
SUBSTRING = 16


@dataclass
class CodeModel:
    """Centre, stacked rotations (dim x bits) and the search radius."""

    mean: np.ndarray
    rotation: np.ndarray
    radius: int

    def codes(self, vecs: np.ndarray) -> np.ndarray:
        """Codes as 16-bit substrings, one row per vector; missing bits are zero."""
        bits = (vecs - self.mean) @ self.rotation > 0
        bits = np.pad(bits, ((0, 0), (0, -bits.shape[1] % SUBSTRING)))
        return np.packbits(bits, axis=1, bitorder="little").view("<u2")


def _learn_rotation(x: np.ndarray, rng: np.random.Generator, rounds: int = 25) -> np.ndarray:
    dim = x.shape[1]
    rotation = np.linalg.qr(rng.normal(size=(dim, dim)))[0]
    for _ in range(rounds):
        signs = np.where(x @ rotation > 0, 1.0, -1.0)
        left, _, right = np.linalg.svd(x.T @ signs)
        rotation = left @ right
    return rotation


def fit_codes(sample: np.ndarray, k: int, target: float = TARGET, seed: int = 3) -> CodeModel:
    """Rotations and radius from a sample of vectors."""
    rng = np.random.default_rng(seed)
    scale = np.linalg.norm(sample, axis=1, keepdims=True)
    mean = sample.mean(axis=0) if len(sample) else np.zeros(sample.shape[1])
    rotation = np.hstack([_learn_rotation(sample - mean, rng) for _ in range(ROTATIONS)])
    model = CodeModel(mean, rotation, rotation.shape[1])
    if len(sample) > k + 1 and scale.max(initial=0) > 0:
        asked = sample[:512]
        apart = ((asked ** 2).sum(1)[:, None] + (sample ** 2).sum(1)[None, :]
                 - 2 * asked @ sample.T)
        np.fill_diagonal(apart, np.inf)
        query, near = smallest_per_row(apart, k)
        codes = model.codes(sample)
        bits = np.bitwise_count(codes[query] ^ codes[near]).sum(axis=1)
        model.radius = int(np.quantile(bits, target, method="higher"))
    return model


class ShardIndex:
    """Directories of one shard: per substring its values and their rows."""

    def __init__(self, codes: np.ndarray):
        self.codes = codes
        self.directories = []
        for column in codes.T:
            order = np.argsort(column, kind="stable")
            values, sizes = np.unique(column, return_counts=True)
            self.directories.append((values, sizes, order))

    def within(self, code: np.ndarray, radius: int) -> np.ndarray:
        """Rows of all codes within ``radius`` bits of a code."""
        m = len(self.directories)
        share, rest = divmod(radius, m)
        hit = np.zeros(len(self.codes), bool)
        for k, (values, sizes, order) in enumerate(self.directories):
            reach = share if k <= rest else share - 1
            near = np.bitwise_count(values ^ code[k]) <= reach
            hit[order[np.repeat(near, sizes)]] = True
        rows = np.flatnonzero(hit)
        bits = np.bitwise_count(self.codes[rows] ^ code).sum(axis=1)
        return rows[bits <= radius]


def index_search(model: CodeModel, k: int) -> Search:
    """Probe one shard's index with every query and rank what is within reach."""
    def search(q_ids: np.ndarray, q_vecs: np.ndarray, ids: np.ndarray,
               vecs: np.ndarray) -> Partial:
        index, codes, parts = ShardIndex(model.codes(vecs)), model.codes(q_vecs), []
        bits = model.rotation.shape[1]
        for at, (own, vec, code) in enumerate(zip(q_ids, q_vecs, codes, strict=True)):
            radius = model.radius
            while True:
                rows = index.within(code, radius)
                rows = rows[ids[rows] != own]
                if len(rows) >= k or radius >= bits:
                    break
                radius += max(1, bits // 16)
            far = np.sqrt(((vecs[rows] - vec) ** 2).sum(axis=1))
            best = smallest_per_row(far[None, :], k)[1]
            parts.append((np.full(len(best), at), rows[best], far[best]))
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))

    return search


def nearest(df: DataFrame, id_col: str, vec_col: str, is_query: Column,
            k: int = 10) -> DataFrame:
    """Nearest candidates found for every query: query_id, rank, vec_id, score.

    ``is_query`` marks query rows over a column ``id``; candidates are all rows
    but those of the query's own id. Null and zero vectors, vectors with null
    or non-finite components, and rows without id take no part; a vector meets
    only vectors of its length. ``score`` is the Euclidean distance; ties go to
    the smaller vec_id; a candidate row that repeats is listed as often as it
    is there, a repeated query once.
    """
    rows = valid_vectors(df, id_col, vec_col, allow_zero=False)

    def search_for(dim: int) -> Search:
        picked = (rows.where(F.size("vec") == dim).orderBy(F.xxhash64("id"), "id", "vec")
                  .limit(SAMPLE).select("vec").toArrow().combine_chunks())
        return index_search(fit_codes(matrix(picked.column("vec").combine_chunks()), k), k)

    return search_blocks(rows.where(is_query), rows, k, False, "double", search_for, "nearest")
