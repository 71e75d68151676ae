"""Elementwise sums of large arrays that tasks produce (Gram matrices, gradients).

A task emits its array in chunks ``(chunk, values)``; chunks are summed by key, in two salted
levels so that no reducer reads one chunk from every task, and as a stream of batches, so a
reducer holds one accumulator and not the whole group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.functions.vectors import lists

CHUNK = 65_536
CHUNK_SCHEMA = "chunk int, values array<double>"
# Arrays of one chunk at most may be summed number by number.
SMALL = 16_384
# Partials of a chunk that one reducer takes in without an intermediate level.
FAN_IN = 64


def chunks(array: np.ndarray) -> Iterator[pa.RecordBatch]:
    """A flat array as ``(chunk, values)`` batches, one chunk per batch."""
    flat = np.ascontiguousarray(array, dtype=np.float64).ravel()
    for chunk, start in enumerate(range(0, len(flat), CHUNK)):
        yield pa.RecordBatch.from_arrays(
            [pa.array([chunk], pa.int32()), lists(flat[None, start : start + CHUNK])], ["chunk", "values"]
        )


def _sum_level(partials: DataFrame, keys: list[str]) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, chunk = None, None
        for batch in batches:
            for position, values in enumerate(batch.column("values")):
                part = values.values.to_numpy(zero_copy_only=False)
                if total is None:
                    total, chunk = part.astype(np.float64), batch.column("chunk")[position].as_py()
                else:
                    total += part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), lists(total[None, :])], ["chunk", "values"])

    return partials.groupBy(*keys).applyInArrow(add, CHUNK_SCHEMA)


def sum_chunks(partials: DataFrame, size: int) -> np.ndarray:
    """Sum the chunk partials of all tasks and bring the array to the driver.

    ``size`` is fixed by the model (features squared, parameters), not by the row count.
    Small arrays are summed number by number in the JVM.
    """
    out = np.zeros(size)
    if size <= SMALL:
        numbers = partials.select(
            F.posexplode("values").alias("at", "value"),
        )
        table = numbers.groupBy("at").agg(F.sum("value").alias("value")).toArrow()
        out[table.column("at").to_numpy()] = table.column("value").to_numpy()
        return out
    # Two levels, so the scan keeps its tasks and no reducer reads one chunk from all of them.
    salted = partials.withColumn("salt", (F.spark_partition_id() / FAN_IN).cast("int"))
    table = _sum_level(_sum_level(salted, ["chunk", "salt"]), ["chunk"]).toArrow()
    for chunk, values in zip(table.column("chunk").to_pylist(), table.column("values")):
        part = values.values.to_numpy(zero_copy_only=False)
        out[chunk * CHUNK : chunk * CHUNK + len(part)] = part
    return out


# Rows a task should have before moving some elsewhere pays.
SPREAD_ROWS = 50_000


def is_held(df: DataFrame) -> bool:
    """Whether the caller has cached this table already."""
    level = df.storageLevel
    return level.useMemory or level.useDisk


def cached(df: DataFrame) -> DataFrame:
    """The input on memory and disk for repeated passes; the caller unpersists it.

    A table that sits in a few crowded partitions (few files, one row group) is spread over
    the cores on its way into the cache. One of many partitions stays where it is: no shuffle.
    """
    parallel = df.sparkSession.sparkContext.defaultParallelism
    row = (  # reads no column
        df.select(F.spark_partition_id().alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("n"))
        .agg(F.count(F.lit(1)).alias("busy"), F.max("n").alias("most")).first()
    )
    crowded = row["busy"] * 2 <= parallel and (row["most"] or 0) > SPREAD_ROWS
    spread = df.repartition(parallel) if crowded else df
    return spread.persist(StorageLevel.MEMORY_AND_DISK)
