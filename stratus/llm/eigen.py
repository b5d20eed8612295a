"""Leading eigenpairs of a symmetric matrix: Householder, Sturm counts, inverse iteration.

The matrix is a covariance with as many rows as a vector has entries, so its size does not
grow with the number of vectors.
"""

from __future__ import annotations

import numpy as np

_EPS = np.finfo(float).eps


def tridiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Householder reduction: diagonal, off-diagonal, and the unit reflectors ``u`` (each ``I - 2 u u'``)."""
    a = np.array(matrix, float)
    d = len(a)
    reflectors = []
    for k in range(d - 2):
        x = a[k + 1:, k]
        u = x.copy()
        u[0] += np.copysign(np.linalg.norm(x), x[0])
        length = np.linalg.norm(u)
        full = np.zeros(d)
        if length > 0:
            full[k + 1:] = u / length
            w = a @ full
            w -= full * (full @ w)
            a -= 2 * (np.outer(full, w) + np.outer(w, full))
        reflectors.append(full)
    return np.diag(a).copy(), np.diag(a, 1).copy(), reflectors


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix are below each point."""
    tiny = max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0), 1e-300) * _EPS * _EPS + 1e-300
    q = diagonal[0] - at
    count = (q < 0).astype(np.int64)
    for k in range(1, len(diagonal)):
        q = np.where(np.abs(q) < tiny, -tiny, q)
        q = diagonal[k] - at - off[k - 1] ** 2 / q
        count += q < 0
    return count


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, wanted: int) -> np.ndarray:
    """The largest eigenvalues, falling, bisected to the last bits of a double."""
    d = len(diagonal)
    radius = np.zeros(d)
    radius[:-1] += np.abs(off)
    radius[1:] += np.abs(off)
    low = np.full(wanted, (diagonal - radius).min())
    high = np.full(wanted, (diagonal + radius).max())
    high += np.abs(high) * 4 * _EPS + 1e-300
    rank = d - 1 - np.arange(wanted)  # the eigenvalue of this rank has so many below it
    while True:
        middle = low + (high - low) / 2
        if ((middle <= low) | (middle >= high) | (high - low <= 2 * _EPS * np.abs(middle))).all():
            return middle
        above = sturm_counts(diagonal, off, middle) <= rank
        low, high = np.where(above, middle, low), np.where(above, high, middle)


def _solve(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, tiny: float) -> np.ndarray:
    """``(T - shift) x = b`` by Gaussian elimination with row exchanges; tiny pivots stand for zeros."""
    d = len(diagonal)
    main, up, up2, x = diagonal - shift, np.append(off, 0.0), np.zeros(d), b.copy()
    for k in range(d - 1):
        low = off[k]
        if abs(low) > abs(main[k]):  # exchange rows k and k + 1
            main[k], low = low, main[k]
            up[k], main[k + 1] = main[k + 1], up[k]
            up2[k], up[k + 1] = up[k + 1], 0.0
            x[k], x[k + 1] = x[k + 1], x[k]
        if main[k] == 0:
            main[k] = tiny
        f = low / main[k]
        main[k + 1] -= f * up[k]
        up[k + 1] -= f * up2[k]
        x[k + 1] -= f * x[k]
    for k in range(d - 1, -1, -1):
        right = x[k] - (up[k] * x[k + 1] if k + 1 < d else 0.0) - (up2[k] * x[k + 2] if k + 2 < d else 0.0)
        x[k] = right / (main[k] if abs(main[k]) > tiny else tiny)
    return x


def inverse_iteration(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, rounds: int = 6) -> np.ndarray:
    """Unit eigenvectors (columns) of the tridiagonal matrix; those of a cluster are made orthogonal in every round."""
    d = len(diagonal)
    norm = max(np.abs(diagonal).max(initial=0), np.abs(off).max(initial=0))
    tiny = max(norm * _EPS, 1e-300)
    out = np.zeros((d, len(values)))
    rng = np.random.default_rng(7)
    first = 0  # of the cluster
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        shift = value - (j - first) * 2 * tiny  # equal shifts would give the same direction again
        x = rng.standard_normal(d)
        for _ in range(rounds):
            x = _solve(diagonal, off, shift, x / np.linalg.norm(x), tiny)
            x /= np.abs(x).max()
            for _ in range(3):
                x -= out[:, first:j] @ (out[:, first:j].T @ x)
        out[:, j] = x / np.linalg.norm(x)
    return out


def leading_pairs(matrix: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns.

    Signs are fixed: the entry of largest size (the first of equals) is positive.
    """
    d = len(matrix)
    wanted = min(wanted, d)
    if not wanted:
        return np.zeros(0), np.zeros((d, 0))
    scale = np.abs(matrix).max(initial=0) or 1.0
    diagonal, off, reflectors = tridiagonal(matrix / scale)
    values = leading_eigenvalues(diagonal, off, wanted)
    vectors = inverse_iteration(diagonal, off, values)
    for u in reversed(reflectors):
        vectors -= 2 * np.outer(u, u @ vectors)
    top = np.abs(vectors).argmax(axis=0)
    vectors *= np.sign(vectors[top, np.arange(wanted)])
    return values * scale, vectors / np.linalg.norm(vectors, axis=0)
