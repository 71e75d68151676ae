"""Vector columns: JVM-side expressions, and Arrow <-> NumPy views for task kernels.

Row-at-a-time vector work (mask, scale, weight, one-off distances) stays in the JVM as
higher-order functions. Bulk numeric work (distances to many points, partial sums) runs on
Arrow batches inside tasks, where :func:`matrix` gives a NumPy view of a list column.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper bound on the float64 scratch one kernel step may hold (elements, 32 MiB).
SCRATCH_ELEMENTS = 4_000_000


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_doubles(features: Column | str) -> Column:
    """Vector column as ``array<double>``, the type every computation runs in."""
    return col(features).cast("array<double>")


def squared_euclidean(a: Column | str, b: Column | str) -> Column:
    """Sum of squared differences of two vector columns."""
    squares = F.zip_with(as_doubles(a), as_doubles(b), lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v)


def euclidean(a: Column | str, b: Column | str) -> Column:
    """Euclidean distance of two vector columns."""
    return F.sqrt(squared_euclidean(a, b))


def double_literal(values: Sequence[float]) -> Column:
    """Constant ``array<double>``; Catalyst folds it to one literal."""
    return F.lit(np.asarray(values, dtype=np.float64))


def matrix(vectors: pa.Array, dim: int | None = None) -> np.ndarray:
    """Rows of an Arrow list column as an ``n x d`` array (stored type kept, no copy if whole).

    Vectors must be present and of one width: a NULL or ragged row is an error, as a raw
    matrix file cannot hold one.
    """
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    n = len(vectors)
    if n == 0:
        return np.empty((0, dim or 0))
    if vectors.null_count:
        raise ValueError("NULL vector in the features column")
    widths = vectors.value_lengths().to_numpy()
    width = int(widths[0]) if dim is None else dim
    if (widths != width).any():
        raise ValueError(f"vector of width {widths[widths != width][0]}, expected {width}")
    return vectors.flatten().to_numpy(zero_copy_only=False).reshape(n, width)


def lists(values: np.ndarray) -> pa.ListArray:
    """An ``n x d`` array as an Arrow ``list<double>`` column."""
    n, width = values.shape
    offsets = np.arange(n + 1, dtype=np.int32) * width
    flat = np.ascontiguousarray(values, dtype=np.float64).ravel()
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))


def row_slices(n_rows: int, row_elements: int) -> Iterator[slice]:
    """Cut ``n_rows`` so that a slice needs at most :data:`SCRATCH_ELEMENTS` of scratch."""
    step = max(1, SCRATCH_ELEMENTS // max(1, row_elements))
    for start in range(0, n_rows, step):
        yield slice(start, min(n_rows, start + step))
