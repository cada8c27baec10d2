"""Toxicity by a factorization machine over hashed terms.

Terms of a text are its lower-cased words and the first letters of longer
words (stems, so that inflected forms share a weight), each hashed to one of
``2 ** HASH_BITS`` numbers; a term counts once per text. The score is the
logistic of

    w0 + sum_i w_i + sum_{i<j} <v_i, v_j>      over the text's terms,

so a pair of terms can weigh more (or less) than its parts: an insult next to a
group name, say. Terms have weights when their presence depends on the label
(likelihood ratio of ``MIN_RATIO`` or more), by itself or among the texts that hold
some other term (``PAIR_RATIO``): a word that tells nothing alone, and everything
next to another, is kept with that other. Linear weights are shrunk to zero by an
L1 step, so a long text collects no noise from its many harmless terms.

The machine is fitted on a bounded sample of labelled rows (``positives`` and
``negatives``, the smallest hashes of the id per class); where a bound cuts a
class, the base is moved by the log-ratio of the two classes' sampled shares, so
scores follow the labels' own class ratio. Scoring covers every row and whole
texts.

Edge cases: null or empty text has no terms and scores the base alone; without
labelled rows of both classes the score is that (smoothed) base rate for all;
rows that repeat are scored alike; only id, text and label are read, so extra
columns do not matter.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import slices

HASH_BITS = 22
STEMS = (3, 4, 5)
#: A term in fewer texts of the sample than this gets no weight.
MIN_TEXTS = 4
#: Likelihood-ratio statistic of a term and the label, from which it is used.
MIN_RATIO = 14.0
#: The same statistic of a term and the label among the texts that hold another term, from
#: which the two are taken for a pair (there are many more pairs than terms).
PAIR_RATIO = 40.0
#: The same per text that holds the other term: below, length or language of the texts tell
#: as much (a term that decides the label of half of them has 1.39).
PAIR_GAIN = 0.3
#: Share of the sample's texts from which terms are paired with each other; terms that depend
#: on the label by themselves are paired with all.
PAIR_SHARE = 0.05
#: Tokens whose terms a worker remembers.
CACHE_TOKENS = 150_000

_WORDS = re.compile(r"[^\W\d_]+")


def words(text: str | None) -> set[str]:
    return set(_WORDS.findall((text or "").lower()))


def terms(word: str) -> list[int]:
    """Hashed terms of a word: itself and its stems."""
    parts = [word, *(word[:n] + "*" for n in STEMS if len(word) > n)]
    return [zlib.crc32(p.encode()) & ((1 << HASH_BITS) - 1) for p in parts]


class _TermRows(dict):
    """Rows of the machine's terms per white-space token, made on first use."""

    def __init__(self, ids: np.ndarray):
        super().__init__()
        self.row_of = {int(t): k for k, t in enumerate(ids)}

    def __missing__(self, token: str) -> tuple[int, ...]:
        known = {self.row_of.get(t) for w in words(token) for t in terms(w)}
        rows = tuple(known - {None})
        if len(self) < CACHE_TOKENS:
            self[token] = rows
        return rows


@dataclass
class FactorizationMachine:
    """Weights of the terms that have any: row k of ``w`` and ``v`` for ``ids[k]``."""

    base: float
    ids: np.ndarray
    w: np.ndarray
    v: np.ndarray
    _rows: _TermRows | None = field(default=None, repr=False)

    def score(self, text: str | None) -> float:
        if self._rows is None:
            self._rows = _TermRows(self.ids)
        tokens = set((text or "").lower().split())
        rows = list(set().union(*filter(None, map(self._rows.__getitem__, tokens))))
        logit = self.base
        if rows:
            v = self.v[rows]
            logit += self.w[rows].sum() + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v ** 2).sum())
        return 1.0 / (1.0 + math.exp(-min(max(logit, -30.0), 30.0)))


def label_ratio(rows: list[np.ndarray], label: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Terms of at least ``MIN_TEXTS`` texts and their likelihood ratio with the label."""
    ids, texts = np.unique(np.concatenate(rows), return_counts=True)
    ids, texts = ids[texts >= MIN_TEXTS], texts[texts >= MIN_TEXTS].astype(float)
    of_ones = np.concatenate([r for r, y in zip(rows, label, strict=True) if y])
    at = np.searchsorted(ids, of_ones)
    at = at[ids[np.minimum(at, len(ids) - 1)] == of_ones] if len(ids) else at[:0]
    ones = np.bincount(at, minlength=len(ids)).astype(float)
    return ids, _ratio(texts, ones, float(len(label)), float(label.sum()))


def _ratio(texts, ones, total, total_ones) -> np.ndarray:
    """Likelihood ratio of presence (``texts`` of ``total``) and label (``ones`` of
    ``total_ones``)."""
    share = total_ones / np.maximum(total, 1)

    def part(seen: np.ndarray, expected: np.ndarray) -> np.ndarray:
        return seen * np.log(np.maximum(seen, 1e-12) / np.maximum(expected, 1e-12))

    absent_ones, absent = total_ones - ones, total - texts
    return 2 * (part(ones, texts * share) + part(texts - ones, texts * (1 - share))
                + part(absent_ones, absent * share)
                + part(absent - absent_ones, absent * (1 - share)))


def paired_terms(rows: list[np.ndarray], label: np.ndarray, strong: np.ndarray) -> np.ndarray:
    """Terms that depend on the label among the texts that hold another term, and these.

    ``strong`` (sorted) are paired with every term of ``MIN_TEXTS`` texts among theirs;
    terms in ``PAIR_SHARE`` of the texts with each other, by products of their presence.
    """
    ids, texts = np.unique(np.concatenate(rows), return_counts=True)
    ids, texts = ids[texts >= MIN_TEXTS], texts[texts >= MIN_TEXTS]
    if not len(ids):
        return ids
    total, total_ones = float(len(rows)), float(label.sum())
    at = [np.searchsorted(ids, r) for r in rows]
    at = [a[ids[np.minimum(a, len(ids) - 1)] == r] for a, r in zip(at, rows, strict=True)]
    found: list[np.ndarray] = []
    holders: dict[int, list[int]] = {}
    is_strong = np.isin(ids, strong)
    for k, own in enumerate(at):
        for term in own[is_strong[own]].tolist():
            holders.setdefault(term, []).append(k)
    for term, held in holders.items():
        n, ones = float(len(held)), float(label[held].sum())
        if n * 2 * math.log(2) < PAIR_RATIO or not MIN_TEXTS <= ones <= n - MIN_TEXTS:
            continue
        both = np.bincount(np.concatenate([at[k] for k in held]), minlength=len(ids))
        both_ones = np.bincount(np.concatenate([at[k] for k in held if label[k]]),
                                minlength=len(ids))
        ratio = _ratio(both.astype(float), both_ones.astype(float), n, ones)
        ratio[term] = 0
        found.append(ids[ratio >= max(PAIR_RATIO, PAIR_GAIN * n)])
    often = np.nonzero(texts >= max(MIN_TEXTS, PAIR_SHARE * len(rows)))[0]
    place = np.full(len(ids), -1)
    place[often] = np.arange(len(often))
    there = np.zeros((len(rows), len(often)), np.uint8)
    for k, own in enumerate(at):
        there[k, place[own[place[own] >= 0]]] = 1
    ids = ids[often]
    number = there.sum(axis=0, dtype=np.float64)
    ones = there[label == 1].sum(axis=0, dtype=np.float64)
    for begin in range(0, len(ids), 256):
        some = slice(begin, begin + 256)
        both, both_ones = (np.zeros((len(ids[some]), len(ids)), np.float32) for _ in range(2))
        for first in range(0, len(rows), 1024):
            part = there[first:first + 1024].astype(np.float32)
            both += part[:, some].T @ part
            both_ones += (part[:, some] * label[first:first + 1024, None].astype(np.float32)
                          ).T @ part
        ratio = _ratio(both.astype(np.float64), both_ones.astype(np.float64),
                       number[some, None], ones[some, None])
        # what the second term tells by itself is no effect of the pair
        alone = _ratio(number, ones, total, total_ones)
        least = np.maximum(PAIR_RATIO, PAIR_GAIN * number[some, None])
        left, right = np.nonzero((ratio >= least) & (alone < MIN_RATIO))
        found += [ids[some][left], ids[right]]
    return np.unique(np.concatenate(found)) if found else ids[:0]


def fit(rows: list[np.ndarray], label: np.ndarray, factors: int = 4, epochs: int = 10,
        rate: float = 0.1, shrink: float = 0.0001, decay: float = 0.0005, batch: int = 64,
        seed: int = 7, shift: float = 0.0) -> FactorizationMachine:
    """Adaptive-gradient fit on rows of hashed terms and labels 0/1.

    ``shrink`` is the L1 step on linear weights, ``decay`` the L2 step on factors,
    ``shift`` what the sampling of the classes added to the log-odds (taken off the base).
    """
    base = float(np.log((label.sum() + 0.05) / (len(label) - label.sum() + 0.95)))
    empty = FactorizationMachine(base - shift, np.zeros(0, np.int64), np.zeros(0),
                                 np.zeros((0, factors)))
    if not len(label) or label.min() == label.max():
        return empty
    ids, ratio = label_ratio(rows, label)
    ids = ids[ratio >= MIN_RATIO]
    ids = np.union1d(ids, paired_terms(rows, label, ids))
    if not len(ids):
        return empty
    at = [np.searchsorted(ids, r) for r in rows]
    rows = [a[ids[np.minimum(a, len(ids) - 1)] == r] for a, r in zip(at, rows, strict=True)]
    rng = np.random.default_rng(seed)
    w, v = np.zeros(len(ids)), rng.normal(0, 0.01, (len(ids), factors))
    w_sum, v_sum, base_sum = np.full(len(ids), 1e-2), np.full((len(ids), factors), 1e-1), 1e-2
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for begin in range(0, len(order), batch):
            pick = order[begin:begin + batch]
            sizes = np.array([len(rows[k]) for k in pick])
            starts = np.r_[0, np.cumsum(sizes)[:-1]]
            some = sizes > 0  # texts without a term move the base alone
            own, inverse = np.unique(np.concatenate([rows[k] for k in pick]), return_inverse=True)
            vx = v[own][inverse]
            total, logit = np.zeros((len(pick), factors)), np.full(len(pick), base)
            if some.any():
                starts = starts[some]
                total[some] = np.add.reduceat(vx, starts)
                pairs = (total[some] ** 2).sum(1) - np.add.reduceat((vx ** 2).sum(1), starts)
                logit[some] += np.add.reduceat(w[own][inverse], starts) + 0.5 * pairs
            g = 1 / (1 + np.exp(-np.clip(logit, -30, 30))) - label[pick]
            each = np.repeat(g, sizes)
            gw = np.bincount(inverse, each)
            gv = each[:, None] * (np.repeat(total, sizes, axis=0) - vx)
            gv = np.stack([np.bincount(inverse, gv[:, f]) for f in range(factors)], axis=1)
            w_sum[own] += gw ** 2
            step = rate / np.sqrt(w_sum[own])
            moved = w[own] - step * gw
            w[own] = np.sign(moved) * np.maximum(np.abs(moved) - step * shrink * len(pick), 0)
            v_sum[own] += gv ** 2
            v[own] = (v[own] - 0.5 * rate / np.sqrt(v_sum[own]) * gv) * (1 - decay)
            base_sum += g.sum() ** 2
            base -= rate / np.sqrt(base_sum) * g.sum()
    return FactorizationMachine(float(base - shift), ids, w, v)


def learnable(labels: DataFrame, id_col: str, label_col: str, may_learn: Column) -> DataFrame:
    """Distinct (_id, label) of the labels that may be learnt."""
    return (labels.where(may_learn & F.col(label_col).isNotNull())
            .select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("label"))
            .where("_id is not null").distinct())


def training_rows(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str,
                  label_col: str, may_learn: Column, positives: int, negatives: int) -> DataFrame:
    """A bounded sample of labelled texts: text, label.

    Per class the ids with the smallest hashes; ``may_learn`` (over the label
    table) leaves rows out. The ids sent to every task are at most
    ``positives + negatives``.
    """
    marked = learnable(labels, id_col, label_col, may_learn)
    picked = [marked.where(F.col("label") == kind).orderBy(F.xxhash64("_id"), "_id").limit(most)
              for kind, most in ((1, positives), (0, negatives))]
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("text"))
    return texts.join(F.broadcast(picked[0].union(picked[1])), "_id").select("text", "label")


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                 may_learn: Column, positives: int = 3000,
                 negatives: int = 5000) -> FactorizationMachine:
    """The machine fitted on a sample of ``docs`` that ``labels`` marks."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column(0).to_pylist():
                hashed = {t for w in words(text) for t in terms(w)}
                rows.append(np.array(sorted(hashed), np.int32).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary()), batch.column(1)],
                                             names=["terms", "label"])

    count = dict(learnable(labels, id_col, label_col, may_learn).where("label in (0, 1)")
                 .groupBy("label").count().collect())
    shift = (math.log(max(1.0, count.get(0, 0) / negatives))
             - math.log(max(1.0, count.get(1, 0) / positives)))
    sample = training_rows(docs, labels, id_col, text_col, label_col, may_learn, positives,
                           negatives)
    found = sample.mapInArrow(run, "terms binary, label int").toArrow()
    rows = [np.frombuffer(x, np.int32) for x in found.column("terms").to_pylist()]
    label = found.column("label").to_numpy().astype(float)
    order = sorted(range(len(rows)), key=lambda k: (zlib.crc32(rows[k].tobytes()), label[k]))
    return fit([rows[k] for k in order], label[order], shift=shift)


def toxicity_score(spark: SparkSession, model: FactorizationMachine, text: Column) -> Column:
    """Score of a text column under a fitted machine (0 to 1)."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return texts.map(shared.value.score).astype("float64")

    return score(F.coalesce(text, F.lit("")))
