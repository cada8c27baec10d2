"""Leading eigenpairs of a symmetric matrix: Householder, Sturm counts, inverse iteration.

The matrix is reduced to a tridiagonal one by Householder reflections. The
number of eigenvalues below a shift (the negative pivots of the shifted matrix,
Sturm's count) brackets each wanted eigenvalue, and bisection narrows all of
them at once. Inverse iteration gives each eigenvector; vectors whose
eigenvalues lie close together are made orthogonal to each other in every step.
The reflections then take them back.

The size of the work is that of the dimension, whatever the number of rows.
"""

from __future__ import annotations

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: Eigenvalues nearer than this share of the matrix norm form a cluster.
CLUSTER = 1e-3
#: Steps of inverse iteration per vector; the first one or two do the work.
STEPS = 5


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(diagonal, off-diagonal, reflections) with matrix = Q T Qt, Q their product.

    Reflection k acts on the coordinates behind k; None where nothing was left to do.
    """
    a = np.array(matrix, dtype=np.float64)
    d = len(a)
    off = np.zeros(max(d - 1, 0))
    reflections = []
    for k in range(d - 2):
        x = a[k + 1:, k]
        size = np.linalg.norm(x)
        if not np.any(x[1:]):
            off[k] = x[0]
            reflections.append(None)
            continue
        v = x.copy()
        v[0] += np.copysign(size, x[0])
        v /= np.linalg.norm(v)
        off[k] = -np.copysign(size, x[0])
        block = a[k + 1:, k + 1:]
        p = 2 * (block @ v)
        w = p - (v @ p) * v
        block -= np.outer(v, w) + np.outer(w, v)
        reflections.append(v)
    if d > 1:
        off[d - 2] = a[d - 1, d - 2]
    return np.diag(a).copy(), off, reflections


def counts_below(diag: np.ndarray, off: np.ndarray, shifts: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below every shift."""
    tiny = EPS * EPS * max(1.0, float(np.max(off * off, initial=0.0)))
    tiny = max(tiny, np.finfo(np.float64).tiny)
    below, pivot = np.zeros(len(shifts), dtype=np.int64), np.ones(len(shifts))
    for d, e in zip(diag, np.append(0.0, off), strict=True):
        pivot = d - shifts - e * e / pivot
        pivot = np.where(np.abs(pivot) < tiny, -tiny, pivot)  # counted as below
        below += pivot < 0
    return below


def leading_values(diag: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, by bisection on the counts."""
    d = len(diag)
    reach = np.zeros(d)
    reach[:-1] += np.abs(off)
    reach[1:] += np.abs(off)
    low, high = np.min(diag - reach), np.max(diag + reach)
    room = EPS * max(abs(low), abs(high)) * d + np.finfo(np.float64).tiny
    want = d - 1 - np.arange(k)  # eigenvalues below the wanted one
    lo, hi = np.full(k, low - room), np.full(k, high + room)
    while True:
        mid = lo + (hi - lo) / 2
        if np.all((mid <= lo) | (mid >= hi)):
            return mid
        above = counts_below(diag, off, mid) <= want
        lo, hi = np.where(above, mid, lo), np.where(above, hi, mid)


def _solve(diag: np.ndarray, off: np.ndarray, shift: float, rhs: np.ndarray,
           tiny: float) -> np.ndarray:
    """x with (T - shift) x = rhs by elimination with row exchanges."""
    d = len(diag)
    main, upper, second = [0.0] * d, [0.0] * d, [0.0] * d
    y = list(rhs)
    off = [*off, 0.0]
    a, b = diag[0] - shift, off[0]  # the row in hand: entries at i and i + 1
    for i in range(d - 1):
        below, nxt, after = off[i], diag[i + 1] - shift, off[i + 1]
        if abs(a) >= abs(below):
            a = a if a else tiny
            f = below / a
            main[i], upper[i] = a, b
            a, b = nxt - f * b, after
            y[i + 1] -= f * y[i]
        else:
            f = a / below
            main[i], upper[i], second[i] = below, nxt, after
            a, b = b - f * nxt, -f * after
            y[i], y[i + 1] = y[i + 1], y[i] - f * y[i + 1]
    main[-1] = a if abs(a) > tiny else tiny
    for i in range(d - 1, -1, -1):
        rest = y[i]
        if i + 1 < d:
            rest -= upper[i] * y[i + 1]
        if i + 2 < d:
            rest -= second[i] * y[i + 2]
        y[i] = rest / main[i]
        if abs(y[i]) > 1e150:  # only the direction counts
            y = [v * 1e-150 for v in y]
    return np.array(y)


def eigenvectors(diag: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling ``values`` by inverse iteration."""
    d = len(diag)
    norm = float(np.max(np.abs(diag) + np.append(np.abs(off), 0.0)
                        + np.append(0.0, np.abs(off)), initial=0.0))
    tiny = max(EPS * norm, np.finfo(np.float64).tiny)
    out = np.zeros((d, len(values)))
    rng = np.random.default_rng(0)
    first, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            first = j
        # equal eigenvalues get shifts a little apart
        shift = min(float(value), shift - 10 * tiny) if j > first else float(value)
        x = rng.standard_normal(d)
        for _ in range(STEPS):
            x = _solve(diag, off, shift, x / np.linalg.norm(x), tiny)
            x /= np.max(np.abs(x))
            for _ in range(2):
                near = out[:, first:j]
                x -= near @ (near.T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading_pairs(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of the k largest eigenvalues."""
    d = len(matrix)
    if d == 1:
        return np.array(matrix, dtype=np.float64).reshape(1)[:k], np.ones((1, 1))[:, :k]
    diag, off, reflections = tridiagonal(matrix)
    values = leading_values(diag, off, min(k, d))
    vectors = eigenvectors(diag, off, values)
    for at in range(len(reflections) - 1, -1, -1):
        v = reflections[at]
        if v is not None:
            vectors[at + 1:] -= 2 * np.outer(v, v @ vectors[at + 1:])
    return values, vectors
