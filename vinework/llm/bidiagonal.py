"""Singular values and right singular vectors of a small square matrix.

Householder reflections make the matrix bidiagonal, the shifted quotient-
difference transform (dqds) finds its singular values to high relative
accuracy, and twisted factorisations of the tridiagonal B'B - s^2 I give the
vectors. The matrix is features by features, so all of it is driver work of
bounded size.
"""

from __future__ import annotations

import numpy as np

EPS = np.finfo(float).eps
NEGLIGIBLE = (8 * EPS) ** 2  # of a squared off-diagonal entry, relative to a squared singular value
CLOSE = 1e-3  # relative gap below which vectors are made orthogonal to each other


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal and superdiagonal of B, and V with matrix = U B V'."""
    a = matrix.astype(float).copy()
    n = len(a)
    v = np.eye(n)
    for k in range(n):
        reflector, length = _reflector(a[k:, k])
        a[k:, k:] -= np.outer(2 * reflector, reflector @ a[k:, k:])
        a[k, k] = length
        if k < n - 1:
            reflector, length = _reflector(a[k, k + 1 :])
            a[k:, k + 1 :] -= np.outer(a[k:, k + 1 :] @ reflector, 2 * reflector)
            a[k, k + 1] = length
            v[:, k + 1 :] -= np.outer(v[:, k + 1 :] @ reflector, 2 * reflector)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """Unit w such that x - 2 w (w'x) is (length, 0, ...)."""
    norm = np.linalg.norm(x)
    if norm == 0 or not x[1:].any():
        return np.zeros(len(x)), float(x[0])
    length = -np.copysign(norm, x[0])
    w = x.copy()
    w[0] -= length
    return w / np.linalg.norm(w), float(length)


def _sweep(q: np.ndarray, e: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One dqds transform: new q and e, and the d of every step (positive while the shift is below all values)."""
    new_q, new_e, steps = np.empty_like(q), np.empty_like(e), np.empty_like(q)
    d = q[0] - shift
    for k in range(len(e)):
        steps[k] = d
        new_q[k] = d + e[k]
        ratio = q[k + 1] / new_q[k]
        new_e[k] = e[k] * ratio
        d = d * ratio - shift
    steps[-1] = new_q[-1] = d
    return new_q, new_e, steps


def squared_values(q: np.ndarray, e: np.ndarray) -> np.ndarray:
    """Squared singular values, descending, from the squared diagonals (q positive).

    A transform without shift yields the diagonal of the inverse, whose trace
    bounds the smallest value from below; the next transform is shifted by that
    bound, so values stay positive and relative accuracy is kept. Converged
    values leave at the end; negligible off-diagonal entries split the rest.
    """
    found, waiting = [], [(q.astype(float), e.astype(float), 0.0)]
    while waiting:
        q, e, moved = waiting.pop()
        while len(q) > 1:
            small = np.flatnonzero(e <= NEGLIGIBLE * (moved + np.minimum(q[:-1], q[1:])))
            if len(small):
                cut = int(small[-1])
                waiting.append((q[: cut + 1], e[:cut], moved))
                q, e = q[cut + 1 :], e[cut + 1 :]
                continue
            if 1.5 * q[0] < q[-1]:
                q, e = q[::-1], e[::-1]
            q, e, steps = _sweep(q, e, 0.0)
            shift = (1 - 1e-8) / (1 / steps).sum()
            while True:
                new_q, new_e, steps = _sweep(q, e, shift)
                if (steps[:-1] > 0).all() and steps[-1] >= 0 and np.isfinite(steps).all():
                    break
                shift = shift / 2 if shift > EPS * moved else 0.0
            if not shift:  # nothing left to gain beside what is already subtracted
                found.extend((moved + q).tolist())
                q = q[:0]
                break
            q, e, moved = new_q, new_e, moved + shift
            if not (q > 0).all():
                q = np.maximum(q, np.finfo(float).tiny)
        found.extend((moved + q).tolist())
    return np.sort(np.array(found))[::-1]


def _guarded(x: float, floor: float) -> float:
    return x if abs(x) > floor else (floor if x >= 0 else -floor)


def twisted_vectors(a: np.ndarray, b: np.ndarray, value: float) -> tuple[np.ndarray, np.ndarray, list[float], list[float]]:
    """Twisted factorisations of B'B - value I: twist terms by place, sizes, and the multipliers from above and below."""
    n = len(a)
    diagonal, lower = a * a, b / a[:-1]
    floor = EPS * EPS * max(value, diagonal.max())
    above, below = [0.0] * (n - 1), [0.0] * (n - 1)
    s, p = np.empty(n), np.empty(n)
    s[0] = -value
    for i in range(n - 1):
        pivot = _guarded(s[i] + diagonal[i], floor)
        above[i] = diagonal[i] * lower[i] / pivot
        s[i + 1] = above[i] * lower[i] * s[i] - value
    p[-1] = diagonal[-1] - value
    for i in range(n - 2, -1, -1):
        pivot = _guarded(diagonal[i] * lower[i] ** 2 + p[i + 1], floor)
        ratio = diagonal[i] / pivot
        below[i] = lower[i] * ratio
        p[i] = p[i + 1] * ratio - value
    twist = s + p + value
    return np.argsort(np.abs(twist), kind="stable"), twist, above, below


def _solved(place: int, above: list[float], below: list[float]) -> np.ndarray:
    z = np.zeros(len(above) + 1)
    z[place] = 1.0
    for i in range(place - 1, -1, -1):
        z[i] = -above[i] * z[i + 1]
    for i in range(place, len(above)):
        z[i + 1] = -below[i] * z[i]
    return z / np.linalg.norm(z)


def right_vectors(matrix: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """All squared singular values, descending, and the first ``most`` right singular vectors, one per row."""
    n = len(matrix)
    scale = float(np.abs(matrix).max(initial=0.0))
    if scale == 0:
        return np.zeros(n), np.eye(n)[:most]
    a, b, v = bidiagonal(matrix / scale)
    size = max(np.abs(a).max(), np.abs(b).max(initial=0.0))
    # Exact zeros on the diagonal move by less than the rounding of the reflections.
    a = np.where(np.abs(a) < EPS * EPS * size, EPS * EPS * size, a)
    found = []  # value, first row of its block, end row
    borders = [0, *(np.flatnonzero(b * b <= NEGLIGIBLE * np.minimum(a[:-1], a[1:]) ** 2) + 1).tolist(), n]
    for first, end in zip(borders[:-1], borders[1:], strict=True):
        found += [(x, first, end) for x in squared_values(a[first:end] ** 2, b[first : end - 1] ** 2).tolist()]
    found.sort(key=lambda f: (-f[0], f[1]))
    vectors: list[np.ndarray] = []
    for value, first, end in found[:most]:
        near = [z for (other, *_), z in zip(found, vectors, strict=False) if other - value <= CLOSE * other]
        places, _, above, below = twisted_vectors(a[first:end], b[first : end - 1], value)
        best, best_left = None, -1.0
        for place in places.tolist():
            z = np.zeros(n)
            z[first:end] = _solved(place, above, below)
            for _ in range(2):
                for other in near:
                    z -= other * (other @ z)
            left = np.linalg.norm(z)
            if left > best_left:
                best, best_left = z, left
            if left > 0.5:
                break
        vectors.append(best / best_left)
    values = np.array([x for x, *_ in found]) * scale * scale
    return values, np.array(vectors).reshape(-1, n) @ v.T
