"""NumPy kernels that run inside tasks: distances, nearest points and sums of one Arrow batch.

Inputs may be float32; arithmetic is float64. Rows are taken in slices that keep their
buffers in cache. Where a matrix product ranks pairs, it only narrows the choice: whatever
lies within its rounding error of the winner is measured again by direct differences, so
results equal the brute-force ones.
"""

from __future__ import annotations

import numpy as np

# Error of a row that no point can claim (all distances NaN): the largest float32.
UNREACHABLE = float(np.finfo(np.float32).max)

# Numbers in one cache-sized slice (320 KiB of float64: buffers stay on the heap).
_SLICE = 40_960
# From this many points on a matrix product pays.
_PRODUCT_FROM = 5
# Label of a row that has none.
NO_LABEL = np.iinfo(np.int64).min


def _slices(n: int, width: int):
    step = max(16, _SLICE // max(1, width))
    for start in range(0, n, step):
        yield slice(start, min(n, start + step))


def _square_sums(difference: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", difference, difference)


def _slack(width: int, norms):
    """Twice the rounding bound of ``|a|^2 - 2ab + |b|^2``, with room to spare."""
    return 4e-15 * (width + 8) * norms


def distances(x: np.ndarray, points: np.ndarray, rooted: bool = True) -> np.ndarray:
    """``n x m`` distances by direct differences (no cancellation)."""
    out = np.empty((len(x), len(points)))
    for rows in _slices(len(x), points.shape[1]):
        block = x[rows].astype(np.float64, copy=False)
        for j, point in enumerate(points):
            out[rows, j] = _square_sums(block - point)
    return np.sqrt(out, out=out) if rooted else out


def _closest_direct(block: np.ndarray, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    table = np.empty((len(points), len(block)))
    for j, point in enumerate(points):
        table[j] = _square_sums(block - point)
    if np.isnan(table.sum()):
        table[np.isnan(table)] = np.inf
    best = table.argmin(axis=0)
    return best, table[best, np.arange(len(block))]


def _closest(block: np.ndarray, points: np.ndarray, norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Closest of NaN-free points and its squared distance, per row of a slice."""
    if len(points) < _PRODUCT_FROM:
        return _closest_direct(block, points)
    rough = block @ (-2.0 * points.T)
    rough += norms
    best = rough.argmin(axis=1)
    low = rough[np.arange(len(block)), best]
    slack = _slack(block.shape[1], _square_sums(block) + norms.max())
    square = _square_sums(block - points[best])
    # More than one point within the rounding error (or a NaN row): measure them all.
    open_rows = np.flatnonzero((rough <= (low + slack)[:, None]).sum(axis=1) != 1)
    if len(open_rows):
        best[open_rows], square[open_rows] = _closest_direct(block[open_rows], points)
    return best, square


def _usable(points: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Points without NaN, their positions, their squared norms."""
    positions = np.flatnonzero(~np.isnan(points).any(axis=1)).astype(np.int32)
    points = np.ascontiguousarray(points[positions])
    return points, positions, _square_sums(points)


def nearest(x: np.ndarray, points: np.ndarray, rooted: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Position of the closest point of each row, and its distance.

    Ties go to the lowest position; a point with a NaN never wins.
    """
    best = np.zeros(len(x), dtype=np.int32)
    error = np.full(len(x), np.inf)
    usable, positions, norms = _usable(points)
    if len(usable):
        for rows in _slices(len(x), points.shape[1]):
            found, error[rows] = _closest(x[rows].astype(np.float64, copy=False), usable, norms)
            best[rows] = positions[found]
    lost = np.isinf(error)
    if lost.any():
        best[lost] = 0
    if rooted:
        np.sqrt(error, out=error)
    error[lost] = UNREACHABLE
    return best, error


class ClusterSums:
    """Rows, error sum and column sums per group, fed slice by slice."""

    def __init__(self, groups: int, width: int):
        self.sizes = np.zeros(groups, dtype=np.int64)
        self.errors = np.zeros(groups)
        self.totals = np.zeros((groups, width))

    def add(self, group: np.ndarray, error: np.ndarray, x: np.ndarray) -> None:
        groups = len(self.sizes)
        self.sizes += np.bincount(group, minlength=groups)
        self.errors += np.bincount(group, weights=error, minlength=groups)
        for rows in _slices(len(x), max(x.shape[1], groups)):
            block, of = x[rows].astype(np.float64, copy=False), group[rows]
            if groups <= 64 and np.isfinite(block.sum()):
                member = np.zeros((len(block), groups))
                member[np.arange(len(block)), of] = 1.0
                self.totals += member.T @ block
            else:
                ids, _, sums = sums_by(of, block)
                self.totals[ids] += sums


def assign_and_sum(x: np.ndarray, points: np.ndarray, rooted: bool, into: ClusterSums) -> None:
    """One k-means step over a batch: assign to the closest point, add to its sums."""
    for rows in _slices(len(x), points.shape[1]):
        block = x[rows].astype(np.float64, copy=False)
        cluster, error = nearest(block, points, rooted)
        into.add(cluster, error, block)


def sums_by(groups: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group ids present, rows per group, and float64 column sums per group."""
    order = np.argsort(groups, kind="stable")
    ids, starts, counts = np.unique(groups[order], return_index=True, return_counts=True)
    return ids, counts, np.add.reduceat(x[order], starts, axis=0, dtype=np.float64)


class ClosestK:
    """Exact ``k`` nearest train rows of some queries, ties by train id, fed block by block.

    Holds ``queries x k`` numbers. A block is compared with the ``k``-th distance held so
    far, so later blocks only measure the few rows that can still enter a list. ``within`` is
    a distance for each query beyond which no row is asked for.
    """

    _QUERIES = 256
    _TRAIN = 2048

    def __init__(self, queries: np.ndarray, k: int, within: np.ndarray | None = None):
        self.queries = queries.astype(np.float64, copy=False)
        self.norms = _square_sums(self.queries)
        self.k = k
        self.square = np.full((len(queries), k), np.inf)
        self.ids = np.full((len(queries), k), np.iinfo(np.int64).max)
        self.labels = np.full((len(queries), k), NO_LABEL)
        self.limit = np.full(len(queries), np.inf) if within is None else np.square(within)

    def reach(self, at=slice(None)) -> np.ndarray:
        """The distance within which a row must lie to enter the list of each query."""
        return np.sqrt(np.minimum(self.square[at, -1], self.limit[at]))

    def add(self, train: np.ndarray, ids: np.ndarray, labels: np.ndarray, only: np.ndarray | None = None) -> None:
        """Compare a block with all queries, or with those at the positions ``only``."""
        lines = np.arange(len(self.queries)) if only is None else only
        for start in range(0, len(train), self._TRAIN):
            part = slice(start, start + self._TRAIN)
            block = train[part].astype(np.float64, copy=False)
            norms = _square_sums(block)
            usable = np.isfinite(norms)
            if not usable.all():
                block, norms = block[usable], norms[usable]
            if not len(block):
                continue
            block_ids, block_labels = ids[part][usable], labels[part][usable]
            for first in range(0, len(lines), self._QUERIES):
                self._add_block(lines[first : first + self._QUERIES], block, norms, block_ids, block_labels)

    def _add_block(self, at: np.ndarray, block, norms, ids, labels) -> None:
        queries = self.queries[at]
        rough = queries @ (-2.0 * block.T)
        rough += norms
        rough += self.norms[at][:, None]
        slack = _slack(queries.shape[1], self.norms[at] + norms.max())
        bound = np.minimum(self.square[at, -1], self.limit[at])
        fresh = np.isinf(bound)
        if fresh.any() and len(block) > self.k:
            bound[fresh] = np.partition(rough[fresh], self.k - 1, axis=1)[:, self.k - 1]
        row, pos = np.nonzero(rough <= (bound + slack)[:, None])
        if not len(row):
            return
        exact = np.empty(len(row))
        for part in _slices(len(row), queries.shape[1]):
            exact[part] = _square_sums(queries[row[part]] - block[pos[part]])
        # Merge with the lists held by the queries concerned.
        touched = np.unique(row)
        held = np.repeat(touched, self.k)
        lines = at[touched]
        row = np.concatenate([held, row])
        square = np.concatenate([self.square[lines].ravel(), exact])
        near = np.concatenate([self.ids[lines].ravel(), ids[pos]])
        tags = np.concatenate([self.labels[lines].ravel(), labels[pos]])
        order = np.lexsort((near, square, row))
        row = row[order]
        starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
        rank = np.arange(len(row)) - np.repeat(starts, np.diff(np.r_[starts, len(row)]))
        keep = rank < self.k
        line, place, order = at[row[keep]], rank[keep], order[keep]
        self.square[line, place] = square[order]
        self.ids[line, place] = near[order]
        self.labels[line, place] = tags[order]

    def found(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(list length per query, distances, train ids, labels), lists one after the other."""
        held = np.isfinite(self.square)
        return held.sum(axis=1), np.sqrt(self.square[held]), self.ids[held], self.labels[held]
