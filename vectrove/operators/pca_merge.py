"""Principal components from merged partial decompositions, for rows too wide for a covariance.

A task folds its rows, a slice at a time, into a factor of at most ``rank`` rows whose scatter
is that of the rows seen, and factors merge in a tree of bounded fan-in. No ``d x d`` matrix
is formed: a task holds a few factors, the driver one.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from vectrove.functions.vectors import lists, matrix
from vectrove.operators.pca import PCAModel

# Numbers of a factor, and partials that one task merges.
MAX_FACTOR = 16_000_000
FAN_IN = 16
SCHEMA = "part long, n long, total double, lost double, mean array<double>, factor array<double>"


@dataclass
class Partial:
    """``n`` rows with their mean; ``factor`` has their scatter but for ``lost`` in spectral norm."""

    n: int
    total: float  # trace of the scatter
    lost: float
    mean: np.ndarray
    factor: np.ndarray

    def merged(self, other: Partial, rank: int) -> Partial:
        if len(self.mean) != len(other.mean):
            raise ValueError(f"feature vectors of {len(self.mean)} and {len(other.mean)} numbers")
        n = self.n + other.n
        apart = (other.mean - self.mean) * np.sqrt(self.n / n * other.n)
        total = self.total + other.total + float(apart @ apart)
        factor, dropped = _cut(np.vstack([self.factor, other.factor, apart]), rank)
        mean = self.mean + (other.mean - self.mean) * (other.n / n)
        return Partial(n, total, self.lost + other.lost + dropped, mean, factor)

    def batch(self, part: int) -> pa.RecordBatch:
        numbers = [pa.array([part], pa.int64()), pa.array([self.n], pa.int64()), pa.array([self.total]), pa.array([self.lost])]
        columns = [*numbers, lists(self.mean[None, :]), lists(self.factor.reshape(1, -1))]
        return pa.RecordBatch.from_arrays(columns, ["part", "n", "total", "lost", "mean", "factor"])


def _cut(rows: np.ndarray, rank: int) -> tuple[np.ndarray, float]:
    """At most ``rank`` rows with the leading part of the scatter, and the norm of the rest."""
    if len(rows) <= rank:
        return rows, 0.0
    _, s, vt = np.linalg.svd(rows, full_matrices=False)
    return s[:rank, None] * vt[:rank], float(s[rank] ** 2) if len(s) > rank else 0.0


def _of_rows(x: np.ndarray, rank: int) -> Partial:
    mean = x.mean(axis=0)
    centred = x - mean
    factor, dropped = _cut(centred, rank)
    return Partial(len(x), float((centred * centred).sum()), dropped, mean, factor)


def _partials(batch: pa.RecordBatch) -> Iterator[Partial]:
    for n, total, lost, mean, factor in zip(*(batch.column(c) for c in ("n", "total", "lost", "mean", "factor")), strict=True):
        mean, factor = (v.values.to_numpy(zero_copy_only=False) for v in (mean, factor))
        yield Partial(n.as_py(), total.as_py(), lost.as_py(), mean, factor.reshape(-1, len(mean)))


def fit_pca_merged(df: DataFrame, k: int = 20, rank: int | None = None, features: str = "features") -> tuple[PCAModel, float]:
    """The leading ``k`` components of all rows, and a bound on the error of the variances.

    Factors keep ``rank`` rows (``2 k + 20`` by default). The bound is what all cuts together may
    have taken from the covariance, in spectral norm: no variance is off by more, and it is 0
    where rows or features are no more than ``rank``. Components turn by at most about the
    bound over their variance's distance to the next. An empty table, or one row, is an error.
    """
    rank = 2 * k + 20 if rank is None else rank
    if not 1 <= k <= rank:
        raise ValueError(f"cannot take {k} components of factors of rank {rank}")
    vectors = df.select(features)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            width = len(batch.column(0)[0].values) if batch.column(0)[0].is_valid else None
            if width is not None and rank * width > MAX_FACTOR:
                raise ValueError(f"factors of {rank} rows of {width} numbers; at most {MAX_FACTOR} numbers")
            for start in range(0, batch.num_rows, rank):
                x = matrix(batch.column(0).slice(start, rank), width).astype(np.float64)
                one = _of_rows(x, rank)
                held = one if held is None else held.merged(one, rank)
        if held is not None:
            yield held.batch(TaskContext.get().partitionId() // FAN_IN)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, part = None, 0
        for batch in batches:
            for one in _partials(batch):
                held = one if held is None else held.merged(one, rank)
            part = batch.column("part")[0].as_py() if batch.num_rows else part
        if held is not None:
            yield held.batch(part // FAN_IN)

    tasks = vectors.rdd.getNumPartitions()
    merged = vectors.mapInArrow(fold, SCHEMA)
    while tasks > 1:
        merged = merged.groupBy("part").applyInArrow(merge, SCHEMA)
        tasks = -(-tasks // FAN_IN)
    whole = None
    for batch in merged.toArrow().to_batches():  # one row
        for one in _partials(batch):
            whole = one if whole is None else whole.merged(one, rank)
    if whole is None or whole.n < 2:
        raise ValueError("PCA needs at least two rows")
    if k > min(len(whole.mean), whole.n):
        raise ValueError(f"cannot take {k} components of {whole.n} rows of width {len(whole.mean)}")
    _, s, vt = np.linalg.svd(whole.factor, full_matrices=False)
    s = np.append(s, np.zeros(max(0, k - len(s))))[:k]
    components = vt[:k]
    if len(components) < k:
        raise ValueError(f"the rows span {len(components)} directions, {k} are asked for")
    largest = np.argmax(np.abs(components), axis=1)
    components = components * np.sign(components[np.arange(k), largest])[:, None]
    variance = s * s / (whole.n - 1)
    trace = whole.total / (whole.n - 1)
    return PCAModel(whole.mean, components, variance, variance / trace if trace else np.zeros(k)), whole.lost / (whole.n - 1)
