"""Whitening of embeddings by a bidiagonal qd solver.

The fit list, every distinct vector once, is centred and reduced to one triangle by blockwise
QR: a task folds its rows into a triangle block by block, and triangles are folded by a few
at a time until one is left. :mod:`vectrove.llm.qd` takes that triangle, of the size of the
vectors, to its singular values and directions. The covariance is never formed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectrove.llm import qd
from vectrove.llm.common import discard, stored
from vectrove.llm.vectors import usual_length, whole

#: Grid steps of a unit, largest grid number, rows of a QR block, triangles that one task folds.
SCALE, BOUND, ROWS, FAN_IN = 256, 1 << 31, 2048, 16


@dataclass
class Whitening:
    """A fitted whitening: ``count`` vectors with exact ``sums``; ``values`` are eigenvalues, falling.

    ``directions`` has unit vectors in columns; ``explained`` are shares of the trace. Where a value is 0 (within rounding), no
    whitened number exists. ``identity_error`` is how far the fit list's whitened covariance is
    from the identity, over the components that exist.
    """

    count: int
    sums: list[int]
    values: np.ndarray
    directions: np.ndarray
    explained: np.ndarray
    identity_error: float | None = None

    @property
    def length(self) -> int:
        return len(self.sums)

    def applied(self, x: np.ndarray) -> np.ndarray:
        """Whitened numbers, a row for each of ``x`` and a column for each component; NaN where none exists."""
        mean = np.array([s / self.count for s in self.sums])
        with np.errstate(divide="ignore", invalid="ignore"):
            return np.where(self.values > 0, ((x - mean) @ self.directions) / np.sqrt(self.values), np.nan)

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of ``(n * x - S) ** 2``, exact; None where it is no long."""
        n, sums = self.count, self.sums
        size = n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums), default=0)
        if size * size * max(len(sums), 1) < 1 << 62:
            return ((n * x - np.array(sums, np.int64)) ** 2).sum(1).tolist()
        exact = (sum((n * int(v) - s) ** 2 for v, s in zip(row, sums, strict=True)) for row in x.tolist())
        return [v if v < 1 << 63 else None for v in exact]


def on_grid(vectors: DataFrame, length: int, keys: list[Column], schema: str) -> DataFrame:
    """``keys`` and ``x`` (32-bit grid numbers as bytes) of the rows that take part; ``schema`` names the keys' types."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, x = whole(batch.column(batch.num_columns - 1), length, SCALE, BOUND - 1)
            data = x.astype("<i4").tobytes()
            width = 4 * length
            rows = pa.array([data[i : i + width] for i in range(0, len(data), width)], pa.binary())
            kept = [c.filter(pa.array(fits)) for c in batch.columns[:-1]]
            yield pa.RecordBatch.from_arrays([*kept, rows], [*batch.schema.names[:-1], "x"])

    return vectors.select(*keys, F.col("embedding").cast("array<double>").alias("_v")).mapInArrow(run, f"{schema}x binary")


def _matrix(column, length: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<i4").reshape(-1, length).astype(np.int64)


def _totals(fit: DataFrame, length: int) -> tuple[int, list[int]]:
    """How many rows, and their exact sums by position."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(length, np.int64), 0
        for batch in batches:
            x = _matrix(batch.column("x"), length)
            total += x.sum(0)
            n += len(x)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, length), pa.int32()), pa.array([n, *total.tolist()], pa.int64())], ["at", "value"])

    found = fit.mapInArrow(run, "at int, value long").groupBy("at").agg(F.sum(F.col("value").cast("decimal(38,0)")).alias("value"))
    by = {r.at: int(r.value) for r in found.collect()}
    return by.get(-1, 0), [by.get(i, 0) for i in range(length)]


def _folded(blocks: Iterator[np.ndarray], length: int) -> np.ndarray:
    """The triangle of all blocks below each other."""
    r = np.zeros((0, length))
    for block in blocks:
        r = np.linalg.qr(np.concatenate([r, block]), mode="r")
    return r


def triangle(fit: DataFrame, count: int, sums: list[int]) -> np.ndarray:
    """``R`` of the QR of the centred fit list, with rows of zeros if there are fewer rows than columns."""
    length = len(sums)
    mean = np.array([s / count for s in sums])
    schema = "part long, r binary"

    def rows(part: int, r: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part], pa.int64()), pa.array([r.tobytes()], pa.binary())], ["part", "r"])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks = (_matrix(b.slice(i, ROWS).column("x"), length) - mean for b in batches for i in range(0, b.num_rows, ROWS))
        r = _folded(blocks, length)
        if len(r):
            yield rows(TaskContext.get().partitionId(), r)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[int] = []

        def blocks():
            for batch in batches:
                for p, data in zip(batch.column("part").to_pylist(), batch.column("r").to_pylist(), strict=True):
                    parts.append(p)
                    yield np.frombuffer(data, np.float64).reshape(-1, length)

        r = _folded(blocks(), length)
        if parts:
            yield rows(min(parts) // FAN_IN, r)

    level = stored(fit.mapInArrow(reduce, schema), "triangles")
    while (most := level.agg(F.max("part")).first()[0] or 0) > 0:
        before = level
        level = stored(level.groupBy((F.col("part") / FAN_IN).cast("long").alias("g")).applyInArrow(fold, schema), "triangles")
        discard(before)
        if most < FAN_IN:
            break
    found = level.first()
    discard(level)
    r = np.frombuffer(found.r, np.float64).reshape(-1, length) if found else np.zeros((0, length))
    return np.concatenate([r, np.zeros((max(length - len(r), 0), length))])


def _identity_error(fit: DataFrame, model: Whitening) -> float | None:
    """Largest entry of the whitened fit list's covariance less the identity."""
    alive = np.flatnonzero(model.values > 0)
    k = len(alive)
    if not k:
        return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(k + k * k)
        for batch in batches:
            w = model.applied(_matrix(batch.column("x"), model.length))[:, alive]
            total += np.concatenate([w.sum(0), (w.T @ w).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(range(len(total)), pa.int32()), pa.array(total)], ["at", "value"])

    by = {r.at: r.value for r in fit.mapInArrow(run, "at int, value double").groupBy("at").agg(F.sum("value").alias("value")).collect()}
    total = np.array([by[i] for i in range(k + k * k)]) / model.count
    mean = total[:k]
    return float(np.abs(total[k:].reshape(k, k) - np.outer(mean, mean) - np.eye(k)).max())


def fit_whitening(vectors: DataFrame, components: int = 4) -> Whitening | None:
    """Whitening fitted on every distinct grid vector of ``embedding`` once; None without any.

    Rows take part whose embedding is not null, has no null or non-finite component and has
    the length that most have (the smaller of equals); a component ``c`` becomes
    ``floor(256 * c)``, held within 32 bits. Zero vectors take part. Copies are one vector
    before anything is shuffled. At most as many components as dimensions are found.
    """
    length = usual_length(vectors.where("embedding is not null"), "embedding")
    if length <= 0:
        return None
    fit = stored(on_grid(vectors, length, [], "").distinct(), "fit")
    count, sums = _totals(fit, length)
    if not count:
        discard(fit)
        return None
    r = triangle(fit, count, sums)
    squares, directions = qd.right_vectors(r, min(components, length))
    trace = float((r**2).sum())
    squares = np.where(squares > qd.EPS * length * max(squares[0], 0.0), squares, 0.0)
    explained = squares / trace if trace > 0 else np.zeros(len(squares))
    model = Whitening(count, sums, squares / count, directions, explained)
    model.identity_error = _identity_error(fit, model)
    discard(fit)
    return model


def whiten(vectors: DataFrame, model: Whitening | None) -> DataFrame:
    """``vec_id, component, n, deviation, whitened, explained, identity_error``: a row for each remaining row and component.

    Rows that :func:`fit_whitening` leaves out are left out; repeated rows come back repeated,
    a null id stays null, other columns are ignored, an empty table gives no rows. The
    deviation is null where it exceeds a long; ``whitened`` is null where the eigenvalue is 0,
    and ``identity_error`` where all are. One map over the table.
    """
    schema = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    names = [c.split()[0] for c in schema.split(", ")]
    if model is None:
        return vectors.sparkSession.createDataFrame([], schema)
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fits, x = whole(batch.column("_v"), model.length, SCALE, BOUND - 1)
            rows = len(x)
            ids = batch.column("vec_id").filter(pa.array(fits)).take(pa.array(np.repeat(np.arange(rows), k)))
            w = model.applied(x).ravel()
            columns = [
                ids,
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                pa.array(np.full(rows * k, model.count)),
                pa.array([d for d in model.deviations(x) for _ in range(k)], pa.int64()),
                pa.array(w, mask=np.isnan(w)),
                pa.array(np.tile(model.explained, rows)),
                pa.array([model.identity_error] * (rows * k), pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)

    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("_v"))
    return rows.mapInArrow(run, schema)
