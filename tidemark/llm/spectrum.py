"""Leading eigenpairs of a symmetric matrix: tridiagonal form, bisection by Sturm counts, inverse iteration.

The matrix is as wide as a vector has components, whatever the number of vectors, so this is driver work.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps

#: Eigenvalues nearer than this share of the norm form a cluster, whose vectors are kept orthogonal.
CLUSTER = 1e-3


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray | None]]:
    """(diagonal, off-diagonal, reflectors): Householder reflections that leave three diagonals."""
    a = np.array(matrix, float)
    n = len(a)
    reflectors: list[np.ndarray | None] = []
    off = np.zeros(max(n - 1, 0))
    for k in range(n - 1):
        u = a[k + 1 :, k].copy()
        length = np.linalg.norm(u)
        if k == n - 2 or not np.linalg.norm(u[1:]):
            off[k] = u[0]
            reflectors.append(None)
            continue
        off[k] = -np.copysign(length, u[0])
        u[0] -= off[k]
        u /= np.linalg.norm(u)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ u
        w = 2 * p - 2 * (u @ p) * u
        rest -= np.outer(u, w) + np.outer(w, u)
        reflectors.append(u)
    return np.diag(a).copy(), off, reflectors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of a tridiagonal matrix lie below each of the given numbers."""
    least = max(np.finfo(float).tiny, EPS * EPS * float(np.max(off * off, initial=0.0)))
    q = np.full(len(at), np.inf)
    below = np.zeros(len(at), np.int64)
    for i in range(len(diagonal)):
        q = diagonal[i] - at - (off[i - 1] ** 2 / q if i else 0.0)
        q = np.where(np.abs(q) < least, -least, q)
        below += q < 0
    return below


def leading_values(diagonal: np.ndarray, off: np.ndarray, k: int) -> np.ndarray:
    """The k largest eigenvalues, falling, each bisected until no double lies between its bounds or they agree to the norm."""
    n = len(diagonal)
    reach = np.abs(np.append(off, 0.0)) + np.abs(np.append(0.0, off))
    low, high = float(np.min(diagonal - reach)), float(np.max(diagonal + reach))
    norm = max(abs(low), abs(high))
    slack = 2 * EPS * norm + np.finfo(float).tiny
    lows, highs = np.full(k, low - slack), np.full(k, high + slack)
    wanted = n - 1 - np.arange(k)  # how many eigenvalues lie below each
    for _ in range(200):
        middle = lows + (highs - lows) / 2
        above = sturm_counts(diagonal, off, middle) <= wanted
        lows, highs = np.where(above, middle, lows), np.where(above, highs, middle)
        if np.all(highs - lows <= EPS * np.maximum(np.abs(lows), np.abs(highs)) + EPS * EPS * norm):
            break
    return lows + (highs - lows) / 2


def _solver(diagonal: np.ndarray, off: np.ndarray, shift: float, norm: float):
    """Solves (T - shift) x = b by elimination with row exchanges; pivots are at least a rounding error of the norm."""
    n = len(diagonal)
    d, u, v = diagonal - shift, np.append(off, 0.0), np.zeros(n)
    factors, swaps = np.zeros(n), np.zeros(n, bool)
    least = EPS * norm
    for i in range(n - 1):
        below = off[i]
        if abs(below) > abs(d[i]):
            swaps[i] = True
            factors[i] = d[i] / below
            d[i], u[i], v[i], d[i + 1], u[i + 1] = below, d[i + 1], u[i + 1], u[i] - factors[i] * d[i + 1], -factors[i] * u[i + 1]
        else:
            if abs(d[i]) < least:
                d[i] = least
            factors[i] = below / d[i]
            d[i + 1] -= factors[i] * u[i]
    if abs(d[n - 1]) < least:
        d[n - 1] = least

    def solve(b: np.ndarray) -> np.ndarray:
        x = b.copy()
        for i in range(n - 1):
            if swaps[i]:
                x[i], x[i + 1] = x[i + 1], x[i] - factors[i] * x[i + 1]
            else:
                x[i + 1] -= factors[i] * x[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                x[i] -= u[i] * x[i + 1]
            if i + 2 < n:
                x[i] -= v[i] * x[i + 2]
            x[i] /= d[i]
            if abs(x[i]) > 1e200:
                x *= 1e-200
        return x

    return solve


def leading_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors of falling eigenvalues as columns; within a cluster each is kept orthogonal to those before."""
    n = len(diagonal)
    norm = float(np.max(np.abs(diagonal), initial=0.0) + 2 * np.max(np.abs(off), initial=0.0)) or 1.0
    vectors = np.zeros((n, len(values)))
    numbers = np.random.default_rng(17)
    cluster, shift = 0, np.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > CLUSTER * norm:
            cluster = j
        # Equal eigenvalues take different shifts, so that each solve meets another matrix.
        shift = min(value, shift - 10 * EPS * norm) if j > cluster else value
        solve = _solver(diagonal, off, shift, norm)
        others = vectors[:, cluster:j]
        x = numbers.uniform(0.5, 1.5, n) * numbers.choice([-1.0, 1.0], n)
        for _ in range(5):
            for _ in range(2):
                x -= others @ (others.T @ x)
            x = solve(x / np.linalg.norm(x))
        for _ in range(2):
            x -= others @ (others.T @ x)
        vectors[:, j] = x / np.linalg.norm(x)
    return vectors


def leading(matrix: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors as columns) of the k largest eigenvalues of a symmetric matrix, falling."""
    n = len(matrix)
    k = min(k, n)
    size = float(np.max(np.abs(matrix), initial=0.0))
    if not k or not size:
        return np.zeros(k), np.eye(n, k)
    matrix = matrix / size
    diagonal, off, reflectors = tridiagonal(matrix)
    vectors = leading_vectors(diagonal, off, leading_values(diagonal, off, k))
    for i in range(len(reflectors) - 1, -1, -1):
        if (u := reflectors[i]) is not None:
            vectors[i + 1 :] -= 2 * np.outer(u, u @ vectors[i + 1 :])
    # The quotient of a vector is twice as near as the vector itself.
    values = np.einsum("ij,ij->j", vectors, matrix @ vectors)
    order = np.argsort(-values, kind="stable")
    return values[order] * size, vectors[:, order]
