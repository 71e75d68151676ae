"""What both vector operators share: rows that take part, and rows as numpy blocks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, no null or non-finite component, not all zero."""
    x = vector.cast("array<double>")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(x, lambda v: v != 0), F.lit(False))


def usual_length(df: DataFrame, column: str) -> int:
    """The length most usable vectors have, the smaller of equals; 0 without any."""
    found = df.groupBy(F.size(column).alias("n")).count().orderBy(F.desc("count"), "n").first()
    return found.n if found else 0


def block(column) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of two blocks, row by row; each depends on its two rows only, so equal rows tie."""
    return np.einsum("ij,ij->i", a, b)


def whole(column, length: int, scale: float, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column on an integer grid: which rows take part, and theirs as int64.

    A row takes part if it has ``length`` components, none of them null or non-finite. A
    component ``c`` becomes ``floor(scale * c)``, held within ``-bound .. bound``.
    """
    lists = column.cast(pa.list_(pa.float64()))
    sizes = lists.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    fits = sizes == length
    flat = lists.filter(pa.array(fits)).flatten()
    nulls = flat.is_null().to_numpy(zero_copy_only=False).reshape(-1, length)
    values = flat.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(-1, length)
    good = ~nulls.any(axis=1) & np.isfinite(values).all(axis=1)
    fits[np.flatnonzero(fits)] = good
    return fits, np.clip(np.floor(scale * values[good]), -bound, bound).astype(np.int64)
