"""Singular values and right singular vectors of a small matrix through its bidiagonal form.

Householder reflections bring the matrix to an upper bidiagonal; dqds (differential quotient
difference with shifts) finds its singular values to high relative accuracy; twisted
factorisations of the tridiagonal ``B'B``, kept as the products it is made of, give the
vectors. All of it runs on one matrix of fixed size, the triangle that a QR of any number of
rows leaves.
"""

from __future__ import annotations

import math

import numpy as np

EPS = float(np.finfo(np.float64).eps)
#: Eigenvalues closer than this, relatively, are one cluster, whose vectors are found together.
CLOSE = 1e-3


def bidiagonal(matrix: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``a, b, v`` with ``matrix = u @ bidiag(a, b) @ v.T``: ``u`` and ``v`` are orthogonal, ``u`` is not kept."""
    work = np.array(matrix, np.float64)
    n = work.shape[1]
    v = np.eye(n)

    def mirror(x: np.ndarray) -> np.ndarray | None:
        """The unit normal of the reflection that takes ``x`` to its first axis."""
        size = np.abs(x).max(initial=0.0)
        if size == 0 or not np.any(x[1:]):
            return None
        normal = x / size
        normal[0] += math.copysign(np.linalg.norm(normal), normal[0])
        return normal / np.linalg.norm(normal)

    for i in range(n):
        if (w := mirror(work[i:, i])) is not None:
            work[i:, i:] -= 2 * np.outer(w, w @ work[i:, i:])
        if i + 1 < n and (w := mirror(work[i, i + 1 :])) is not None:
            work[i:, i + 1 :] -= 2 * np.outer(work[i:, i + 1 :] @ w, w)
            v[:, i + 1 :] -= 2 * np.outer(v[:, i + 1 :] @ w, w)
    return np.diag(work)[:n].copy(), np.diag(work, 1).copy(), v


def _transform(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float, bool]:
    """One dqds step; the last ``d``, and whether one before it fell below zero."""
    d = q[0] - shift
    q2, e2 = [], []
    for i in range(len(e)):
        if d < 0:
            return q, e, d, True
        q2.append(d + e[i])
        ratio = q[i + 1] / q2[i] if q2[i] > 0 else 0.0
        e2.append(e[i] * ratio)
        d = d * ratio - shift
    q2.append(d)
    return q2, e2, d, not math.isfinite(d)


def _block_values(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of the product with these qd numbers."""
    found, base = [], 0.0
    while q:
        n = len(q)
        if n == 1:
            found.append(q[0] + base)
            break
        cut = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS * EPS * (base + q[i]) or e[i] <= EPS * EPS * (base + q[i + 1])), None)
        if cut == n - 2:
            found.append(q.pop() + base)
            e.pop()
            continue
        if cut is not None:  # two products that do not touch
            found += [x + base for x in _block_values(q[cut + 1 :], e[cut + 1 :])]
            q, e = q[: cut + 1], e[:cut]
            continue
        if q[-1] > 1.5 * q[0]:  # small values belong to the end
            q, e = q[::-1], e[::-1]
        # The smaller eigenvalue of the last two is not below the smallest of all.
        half = (q[-2] + e[-1] + q[-1]) / 2
        guess = max(q[-2] * q[-1], 0.0) / (half + math.sqrt(max(half * half - q[-2] * q[-1], 0.0)))
        shift = guess
        while True:
            q2, e2, last, early = _transform(q, e, shift)
            if not early and last >= 0:
                break
            # A negative last number alone tells how far the shift is too large at most.
            shift = shift + last if not early and shift + last > 0 else shift / 4
            if shift < EPS * guess or shift <= 0:
                shift = 0.0
                q2, e2, last, early = _transform(q, e, 0.0)
                break
        q, e, base = q2, e2, base + shift
    return found


def squared_values(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values of the bidiagonal, falling."""
    scale = float(max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0)))
    if scale == 0:
        return np.zeros(len(a))
    found = _block_values(list((a / scale) ** 2), list((b / scale) ** 2))
    return np.sort(np.maximum(found, 0.0))[::-1] * scale * scale


class _Twisted:
    """``L D L' - value`` in factors from both ends: ``D`` and ``L`` of ``B'B`` are never multiplied out."""

    def __init__(self, d: np.ndarray, low: np.ndarray, value: float):
        n = len(d)
        tiny = EPS * EPS * max(float(np.abs(d).max()), value, 1e-300)
        self.down, self.up = np.zeros(max(n - 1, 0)), np.zeros(max(n - 1, 0))
        self.pivot_down, self.pivot_up = np.zeros(n), np.zeros(n)
        s, p = np.full(n, -value), np.full(n, d[-1] - value)
        for i in range(n - 1):
            pivot = s[i] + d[i]
            self.pivot_down[i] = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
            self.down[i] = d[i] * low[i] / self.pivot_down[i]
            s[i + 1] = self.down[i] * low[i] * s[i] - value
        for i in range(n - 2, -1, -1):
            pivot = d[i] * low[i] ** 2 + p[i + 1]
            self.pivot_up[i + 1] = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
            ratio = d[i] / self.pivot_up[i + 1]
            self.up[i] = low[i] * ratio
            p[i] = p[i + 1] * ratio - value
        middle = s + p + value
        self.at = int(np.argmin(np.abs(middle)))
        self.middle = middle[self.at] if abs(middle[self.at]) > tiny else tiny

    def back(self, y: np.ndarray) -> np.ndarray:
        """``x`` with both factors' transposes undone, from the twist outwards."""
        x = y.copy()
        for i in range(self.at - 1, -1, -1):
            x[i] -= self.down[i] * x[i + 1]
        for i in range(self.at, len(x) - 1):
            x[i + 1] -= self.up[i] * x[i]
        return x

    def null_vector(self) -> np.ndarray:
        start = np.zeros(len(self.pivot_down))
        start[self.at] = 1.0
        x = self.back(start)
        return x / np.linalg.norm(x)

    def solve(self, right: np.ndarray) -> np.ndarray:
        y = right.astype(np.float64).copy()
        n, k = len(y), self.at
        for i in range(k):
            y[i + 1] -= self.down[i] * y[i]
        for i in range(n - 2, k - 1, -1):
            y[i] -= self.up[i] * y[i + 1]
        pivots = np.concatenate([self.pivot_down[:k], [self.middle], self.pivot_up[k + 1 :]])
        x = self.back(y / pivots)
        return x / np.linalg.norm(x)


def _block_vectors(a: np.ndarray, b: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Eigenvectors of ``B'B``, in columns, for the ``count`` first of its falling eigenvalues.

    One that stands alone is the null vector of its twisted factorisation. Those of a cluster
    are the Rayleigh-Ritz vectors of a block that inverse iteration with the same factors
    draws into the space of the cluster.
    """
    d = np.maximum(a * a, (EPS * np.abs(a).max(initial=1e-300)) ** 2)
    low = b / np.sqrt(d[:-1]) * np.where(a[:-1] < 0, -1.0, 1.0)
    noise = EPS * len(d) * values[0]
    draw = np.random.default_rng(11)
    out: list[np.ndarray] = []
    first = 0
    while first < min(count, len(values)):
        end = first + 1
        while end < len(values) and values[end - 1] - values[end] <= max(CLOSE * values[end - 1], noise):
            end += 1
        if end == first + 1:
            out.append(_Twisted(d, low, float(values[first])).null_vector()[:, None])
        else:
            beside = float(values[first]) + max(float(values[first]) * 1e-10, noise)
            factors = _Twisted(d, low, beside)
            block = draw.standard_normal((len(d), end - first))
            for _ in range(4):
                block = np.linalg.qr(np.stack([factors.solve(x) for x in block.T], 1))[0]
            image = a[:, None] * block
            image[:-1] += b[:, None] * block[1:]
            weights, turn = np.linalg.eigh(image.T @ image)
            out.append(block @ turn[:, np.argsort(-weights)])
        first = end
    return np.concatenate(out, 1)[:, :count]


def right_vectors(matrix: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest squared singular values, falling, and their unit vectors in columns.

    Each vector's largest component (the first of equals) is positive.
    """
    n = matrix.shape[1]
    a, b, v = bidiagonal(matrix)
    scale = max(np.abs(a).max(initial=0.0), np.abs(b).max(initial=0.0))
    cuts = np.flatnonzero(np.abs(b) <= 4 * EPS * scale) + 1
    values, vectors = [], []
    for low, high in zip([0, *cuts], [*cuts, n], strict=True):
        some = squared_values(a[low:high], b[low : high - 1])
        parts = _block_vectors(a[low:high], b[low : high - 1], some, count)
        for value, part in zip(some, parts.T, strict=False):
            whole = np.zeros(n)
            whole[low:high] = part
            values.append(value)
            vectors.append(whole)
    best = np.argsort(-np.array(values), kind="stable")[:count]
    columns = v @ np.array(vectors)[best].T
    lead = columns[np.argmax(np.abs(columns).round(12), axis=0), np.arange(columns.shape[1])]
    return np.array(values)[best], columns * np.where(lead < 0, -1.0, 1.0)
