"""Document quality by a linear-chain conditional random field over lines.

Every line is labelled good or bad. A line's features are its own (share of
capitals, marks, digits; words that repeat; its length; copies of the line in
the text) and the same of the lines before and after it; neighbouring labels
are tied by a transition table. With two labels all messages are log-odds, one
number per line, and forward and backward passes run over many texts at once.

The document's quality is the mean probability of "good" over its lines (from
the forward-backward marginals), weighted by their lengths, mapped to a
probability by a logistic curve of one slope and one offset.

Labels are given per document only. The first fit takes every line of a bad
document as bad; then lines of bad documents that look good are taken as good
(at least the worst stays bad) and the field is fitted again. The fit uses a
bounded sample of labelled rows (``per_class`` documents of each class);
scoring covers every row and whole texts.

Edge cases: null and empty texts are one empty line; without labelled rows of
both classes every score is 1 or the (smoothed) share of good rows; rows that
repeat are scored alike; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from .common import slices
from .toxicity import training_rows

_SYMBOLS = b"!#$%&*+/<=>@[\\]^_`{|}~"
_CLASS = np.zeros((256, 4), np.float32)  # capital, letter, digit, symbol
_CLASS[65:91, :2] = 1
_CLASS[97:123, 1] = 1
_CLASS[128:, 1] = 0.5
_CLASS[48:58, 2] = 1
_CLASS[list(_SYMBOLS), 3] = 1

#: Features of a line by itself.
OWN = 11
#: With those of the lines before and after it, and a constant.
ALL = 3 * OWN + 1


def line_features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Features (lines x OWN) and weights (bytes + 1) of a text's lines."""
    data = (text or "").encode()
    lines = data.split(b"\n")
    sizes = np.array([len(x) for x in lines])
    begins = np.r_[0, np.cumsum(sizes[:-1] + 1)]
    counts = np.zeros((len(lines), 4), np.float32)
    filled = sizes > 0
    if filled.any():
        codes = np.frombuffer(data, np.uint8)
        # a sum from one line's start to the next takes its line break along, which has no class
        starts = begins[filled]
        for k in range(4):
            counts[filled, k] = np.add.reduceat(_CLASS[codes, k], starts)
    copies = Counter(lines)
    rows = []
    for line in lines:
        parts = line.split()
        n = len(parts)
        repeated = 1 - len(set(parts)) / n if n else 0.0
        in_row = sum(map(eq, parts, parts[1:])) / (n - 1) if n > 1 else 0.0
        rows.append((repeated if n >= 6 else 0.0, in_row, repeated * min(n, 60) / 60,
                     copies[line] > 1 and n > 2, n))
    rest = np.array(rows, np.float32).reshape(-1, 5)
    letters, size = np.maximum(counts[:, 1], 1), np.maximum(sizes, 1)
    out = np.empty((len(lines), OWN), np.float32)
    out[:, 0] = counts[:, 0] / letters
    out[:, 1] = counts[:, 0] / letters > 0.5
    out[:, 2] = np.minimum(counts[:, 3] / size, 0.5) * 4
    out[:, 3] = counts[:, 3] / size > 0.05
    out[:, 4] = np.minimum(counts[:, 2] / size, 0.5) * 2
    out[:, 5:9] = rest[:, :4]
    out[:, 9] = np.log1p(sizes) / 8
    out[:, 10] = np.abs(np.minimum(sizes / np.maximum(rest[:, 4], 1), 20) - 5.5) / 8
    return out, sizes + 1.0


def with_neighbours(own: list[np.ndarray]) -> np.ndarray:
    """All lines of many texts (rows x ALL); missing neighbours are zeros."""
    parts = []
    for f in own:
        none = np.zeros((1, OWN), np.float32)
        parts.append(np.hstack([np.ones((len(f), 1), np.float32), f,
                                np.vstack([none, f[:-1]]), np.vstack([f[1:], none])]))
    return np.concatenate(parts) if parts else np.zeros((0, ALL), np.float32)


class Chains:
    """Lines of many texts arranged so that step t of all texts runs at once."""

    def __init__(self, sizes: np.ndarray):
        self.order = np.argsort(-sizes, kind="stable")
        begins = np.r_[0, np.cumsum(sizes)[:-1]].astype(int)
        longest = sizes.max(initial=0)
        active = np.searchsorted(-sizes[self.order], -np.arange(longest), "left")
        self.steps = [begins[self.order[:n]] + t for t, n in enumerate(active)]

    def messages(self, e: np.ndarray, t: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Forward (line included) and backward (line excluded) log-odds of good."""
        forward, backward = e.copy(), np.zeros_like(e)
        for before, now in zip(self.steps, self.steps[1:], strict=False):
            a = forward[before[:len(now)]]
            forward[now] += (np.logaddexp(a + t[1, 1], t[0, 1])
                             - np.logaddexp(a + t[1, 0], t[0, 0]))
        for now, after in zip(self.steps[-2::-1], self.steps[:0:-1], strict=True):
            b = e[after] + backward[after]
            backward[now[:len(after)]] = (np.logaddexp(b + t[1, 1], t[1, 0])
                                          - np.logaddexp(b + t[0, 1], t[0, 0]))
        return forward, backward

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions of all neighbouring lines."""
        both = [(a[:len(b)], b) for a, b in zip(self.steps, self.steps[1:], strict=False)]
        if not both:
            return np.zeros(0, int), np.zeros(0, int)
        return tuple(np.concatenate(x) for x in zip(*both, strict=True))


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class QualityField:
    """Weights of the line features, transition table, and the final curve."""

    theta: np.ndarray
    transition: np.ndarray
    slope: float
    offset: float

    def means(self, own: list[np.ndarray], weights: list[np.ndarray]) -> np.ndarray:
        """Length-weighted probability of good, as log-odds per text."""
        sizes = np.array([len(f) for f in own], int)
        forward, backward = Chains(sizes).messages(with_neighbours(own) @ self.theta,
                                                   self.transition)
        good = _sigmoid(forward + backward)
        weight = np.concatenate(weights)
        begins = np.r_[0, np.cumsum(sizes)[:-1]]
        mean = np.add.reduceat(good * weight, begins) / np.add.reduceat(weight, begins)
        mean = np.clip(mean, 1e-4, 1 - 1e-4)
        return np.log(mean / (1 - mean))

    def scores(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.zeros(0)
        own, weights = zip(*map(line_features, texts), strict=True)
        return _sigmoid(self.slope * self.means(list(own), list(weights)) + self.offset)


def _fit_field(x: np.ndarray, y: np.ndarray, chains: Chains, weight: np.ndarray,
               rounds: int = 120, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Maximum likelihood of the line labels (gradient steps with adaptive moments)."""
    theta, t = np.zeros(x.shape[1]), np.zeros((2, 2))
    a, b = chains.pairs()
    shown = np.zeros((2, 2))
    np.add.at(shown, (y[a].astype(int), y[b].astype(int)), weight[b])
    m, s = np.zeros(len(theta) + 4), np.zeros(len(theta) + 4)
    total = weight.sum()
    for k in range(1, rounds + 1):
        e = x @ theta
        forward, backward = chains.messages(e, t)
        g_theta = x.T @ ((_sigmoid(forward + backward) - y) * weight) / total + 1e-3 * theta
        right = e[b] + backward[b]
        logs = np.stack([np.full(len(a), t[0, 0]), t[0, 1] + right, forward[a] + t[1, 0],
                         forward[a] + t[1, 1] + right])
        logs -= logs.max(axis=0, initial=-np.inf)
        p = np.exp(logs)
        expected = ((p / p.sum(axis=0)) * weight[b]).sum(axis=1).reshape(2, 2)
        g = np.r_[g_theta, ((expected - shown) / total + 1e-3 * t).ravel()]
        m = 0.9 * m + 0.1 * g
        s = 0.99 * s + 0.01 * g ** 2
        step = rate * (m / (1 - 0.9 ** k)) / (np.sqrt(s / (1 - 0.99 ** k)) + 1e-8)
        theta, t = theta - step[:-4], t - step[-4:].reshape(2, 2)
    return theta, t


def _fit_curve(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve (Newton steps, lightly damped)."""
    design = np.stack([x, np.ones_like(x)], axis=1)
    beta = np.array([1.0, 0.0])
    for _ in range(30):
        p = _sigmoid(design @ beta)
        hessian = (design * (weight * p * (1 - p))[:, None]).T @ design + 1e-2 * np.eye(2)
        beta -= np.linalg.solve(hessian, design.T @ (weight * (p - y)) + 1e-2 * (beta - [1, 0]))
        beta[0] = max(beta[0], 0.05)
    return float(beta[0]), float(beta[1])


def fit(own: list[np.ndarray], weights: list[np.ndarray], label: np.ndarray,
        good_share: float) -> QualityField:
    """Field and curve from texts' line features and labels (1: good)."""
    if not len(label) or label.min() == label.max():
        share = (good_share * len(label) + 1) / (len(label) + 1)
        return QualityField(np.zeros(ALL), np.zeros((2, 2)), 0.0,
                            float(np.log(share / max(1 - share, 1e-9))))
    sizes = np.array([len(f) for f in own], int)
    x, chains = with_neighbours(own).astype(np.float64), Chains(sizes)
    begins = np.r_[0, np.cumsum(sizes)[:-1]]
    doc = np.repeat(np.arange(len(own)), sizes)
    y = label[doc]
    # every document counts alike, so that long ones do not decide the fit
    weight = (1 / sizes)[doc]
    theta, t = _fit_field(x, y, chains, weight)
    forward, backward = chains.messages(x @ theta, t)
    good = _sigmoid(forward + backward)
    worst = np.minimum.reduceat(good, begins)[doc]
    theta, t = _fit_field(x, np.where((y == 0) & (good > 0.5) & (good > worst), 1.0, y), chains,
                          weight)
    field = QualityField(theta, t, 1.0, 0.0)
    share = np.where(label == 1, good_share / label.mean(), (1 - good_share) / (1 - label.mean()))
    field.slope, field.offset = _fit_curve(field.means(own, weights), label, share)
    return field


def within_lines(texts: list, most: int) -> list[tuple[int, int]]:
    """(label, hash) of the texts whose lines stay within ``most`` per label.

    In the order of the hashes, each text that still fits is taken; rows that repeat
    a text come and go together.
    """
    lines: dict[tuple[int, int], int] = {}
    for label, h, n in texts:
        lines[label, h] = lines.get((label, h), 0) + n
    left: dict[int, int] = {}
    out = []
    for (label, h), n in sorted(lines.items()):
        if n <= left.setdefault(label, most):
            left[label] -= n
            out.append((label, h))
    return out


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str,
                may_learn: Column, per_class: int = 2500,
                most_lines: int = 400_000) -> QualityField:
    """The field fitted on a sample of ``docs`` that ``labels`` marks (1: good).

    The sample is bounded in texts (``per_class``) and in lines: where the sampled
    texts have more than ``most_lines`` together, each class learns from those that fit
    into half of that, in the order of their hashes. Scoring reads every line of every
    text.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = [line_features(text) for text in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [pa.array([f.tobytes() for f, _ in found], pa.binary()),
                 pa.array([w.tobytes() for _, w in found], pa.binary()), batch.column(1)],
                names=["lines", "weights", "label"])

    marked = labels.where(may_learn & F.col(label_col).isNotNull())
    good_share = marked.agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    sample = training_rows(docs, labels, id_col, text_col, label_col, may_learn, per_class,
                           per_class)
    # lines are counted before any features are made; the driver sees a few numbers per text
    sized = sample.select("text", "label", F.xxhash64("text").alias("h"), F.size(F.split(
        F.coalesce("text", F.lit("")), "\n")).cast("long").alias("n"))
    if (sized.agg(F.sum("n")).first()[0] or 0) > most_lines:
        chosen = within_lines(sized.select("label", "h", "n").collect(), most_lines // 2)
        kept = docs.sparkSession.createDataFrame(chosen, "label int, h long")
        sample = sized.join(F.broadcast(kept), ["label", "h"]).select("text", "label")
    found = sample.mapInArrow(run, "lines binary, weights binary, label int").toArrow().to_pylist()
    found.sort(key=lambda r: (r["lines"], r["weights"], r["label"]))
    own = [np.frombuffer(r["lines"], np.float32).reshape(-1, OWN) for r in found]
    weights = [np.frombuffer(r["weights"], np.float64) for r in found]
    label = np.array([r["label"] for r in found], float)
    return fit(own, weights, label, min(max(good_share or 0.5, 1e-3), 1 - 1e-3))


def quality_score(spark: SparkSession, model: QualityField, text: Column) -> Column:
    """Score of a text column under a fitted field (0 to 1)."""
    shared = spark.sparkContext.broadcast(model)

    @pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        parts = [shared.value.scores(texts.iloc[k:k + 1024].tolist())
                 for k in range(0, len(texts), 1024)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return score(F.coalesce(text, F.lit("")))
