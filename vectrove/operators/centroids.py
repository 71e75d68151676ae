"""Small point sets (centroids, candidates): checked, brought to the driver, broadcast."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

# Largest point set that is broadcast: 32M float64 numbers (256 MiB). Larger sets go through
# the partitioned join in operators/neighbours.py.
BROADCAST_NUMBERS = 32_000_000

CENTROID_SCHEMA = "cluster int, centroid array<double>"


def point_numbers(points: DataFrame, vector: str) -> int:
    """How many numbers a point set holds."""
    held = points.agg(F.sum(F.size(vector).cast("long"))).first()[0]
    return int(held or 0)


def as_matrix(points, order: str = "cluster", vector: str = "centroid", bounded: bool = False) -> np.ndarray:
    """A point set as an ``m x d`` array, in ``order``; a NULL vector becomes a NaN row.

    The set is counted before it is collected, unless ``bounded`` says that a parameter
    (number of clusters or candidates) already limits it.
    """
    if isinstance(points, DataFrame):
        if not bounded:
            held = point_numbers(points, vector)
            if held > BROADCAST_NUMBERS:
                raise ValueError(f"{held} numbers are too many for a broadcast point set")
        rows = points.select(order, vector).collect()
        points = [row[1] for row in sorted(rows, key=lambda row: row[0])]
    if isinstance(points, np.ndarray):
        if points.size > BROADCAST_NUMBERS:
            raise ValueError(f"{points.size} numbers are too many for a broadcast point set")
        return np.atleast_2d(points.astype(np.float64))
    width = max((len(p) for p in points if p is not None), default=0)
    rows = [np.full(width, np.nan) if p is None else np.asarray(p, dtype=np.float64) for p in points]
    if any(len(row) != width for row in rows):
        raise ValueError("points of different widths")
    return np.vstack(rows) if rows else np.empty((0, 0))


def local_frame(spark: SparkSession, rows: Sequence[tuple], schema: str) -> DataFrame:
    """A small table as a local relation (through Arrow), which later jobs read for free."""
    target = to_arrow_schema(_parse_datatype_string(schema))
    columns = list(zip(*rows)) if rows else [[] for _ in target]
    arrays = [pa.array(values, field.type) for values, field in zip(columns, target)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, schema=target))


def held(table: DataFrame) -> DataFrame:
    """A parameter-sized table computed once and kept as a local relation."""
    return table.sparkSession.createDataFrame(table.toArrow())


def centroid_frame(spark: SparkSession, means: np.ndarray | Sequence) -> DataFrame:
    """``cluster, centroid``; the mean of an empty cluster is NULL."""
    rows = [
        (i, None if np.isnan(m).all() else m.tolist()) for i, m in enumerate(np.asarray(means, dtype=np.float64))
    ]
    return local_frame(spark, rows, CENTROID_SCHEMA)


# Rows of a lookup table that may be collected and broadcast.
LOOKUP_ROWS = 1_000_000


def lookup(table: DataFrame) -> DataFrame:
    """A lookup side for a join: broadcast from a local relation if its rows are few, else as it is.

    The table is computed once, here. Spark's own estimate for an aggregate is the size of
    its input, so without this the large side of the join would be shuffled by a skewed key.
    """
    rows = table.limit(LOOKUP_ROWS + 1).toArrow()
    if rows.num_rows > LOOKUP_ROWS:
        return table
    return F.broadcast(table.sparkSession.createDataFrame(rows))
