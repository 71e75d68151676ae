"""What the text operators share: tables, scratch space, Arrow maps, digests."""

from __future__ import annotations

import tempfile
import uuid
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrove.llm import units


def tokenizer_file(name: str) -> str:
    """Place of a public tokenizer file, the default of every ``path`` parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path under ``spark.checkpoint.dir``, which the executors share.

    Only a session on one machine without that setting (a test) gets a folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = tempfile.mkdtemp(prefix="llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows of ``df`` written once as Parquet in the shared folder; cuts the lineage."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def discard(*tables: DataFrame | None) -> None:
    """Delete tables that :func:`stored` wrote and nothing that is still to run reads."""
    for df in tables:
        path = getattr(df, "scratch_path", None)
        if path:
            context = df.sparkSession.sparkContext
            place = context._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(context._jsc.hadoopConfiguration()).delete(place, True)


#: Rows whose texts are Python strings at one time.
SLICE = 2_000


def slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(0, batch.num_rows, SLICE):
            yield batch.slice(i, SLICE)


def map_arrow(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str, keep: bool = False
) -> DataFrame:
    """``fn`` over every Arrow batch, ``SLICE`` rows at a time; None gives no rows. ``keep`` as in :func:`tidy`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            out = fn(batch)
            if out is not None:
                yield out

    return df.mapInArrow(tidy(run, keep), schema)


def tidy(
    run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: bool = False
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``run`` for a worker that is left small when its task ends.

    Spark deals tasks to its idle workers in turn, and a stage with several maps in a row has
    several workers a core, so what each kept until its next task would add up. ``keep`` leaves
    the worker its memo of units, which the next task then need not work out again.
    """

    def tidied(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            if not keep:
                units.drop()
            units.give_back()

    return tidied


def texts_of(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a batch, an empty one for null."""
    return [x or "" for x in batch.column(column).to_pylist()]


def plain_texts(df: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``doc_id, text`` only, whatever other columns there are; null text counts as empty."""
    return df.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text")
    )


def summed_blocks(rows: DataFrame, combine: Callable[[list[np.ndarray]], np.ndarray], kind: str) -> dict[int, np.ndarray]:
    """Blocks ``block, part, data`` of all tasks combined in two rounds, by number.

    ``data`` is zlib-compressed. Only for arrays of fixed size: they come to the driver.
    """

    def total(group: pd.DataFrame) -> pd.DataFrame:
        out = combine([np.frombuffer(zlib.decompress(x), kind) for x in group["data"]])
        return group[["block", "part"]].head(1).assign(data=[zlib.compress(out.astype(kind).tobytes(), 1)])

    schema = "block int, part int, data binary"
    rows = rows.groupBy("block", "part").applyInPandas(total, schema).groupBy("block").applyInPandas(total, schema)
    return {r.block: np.frombuffer(zlib.decompress(r.data), kind) for r in rows.collect()}


def block_rows(values: np.ndarray, size: int) -> pa.RecordBatch:
    """An array of a task as rows for :func:`summed_blocks`."""
    blocks = [zlib.compress(values[i : i + size].tobytes(), 1) for i in range(0, len(values), size)]
    part = TaskContext.get().partitionId() % 64
    return pa.RecordBatch.from_arrays(
        [pa.array(range(len(blocks)), pa.int32()), pa.array([part] * len(blocks), pa.int32()), pa.array(blocks, pa.binary())],
        ["block", "part", "data"],
    )


class IdFilter:
    """A filter of fixed size over the ids of a table, to go ahead of a join with it.

    It never turns away an id of the table; where the table is so large that the filter is
    full it lets everything through, and the join alone decides.
    """

    BITS = 1 << 26

    def __init__(self, ids: DataFrame, column: str):
        spot = self._spot

        def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            bits = np.zeros(IdFilter.BITS, bool)
            for batch in batches:
                bits[spot(batch.column(0).to_numpy())] = True
            yield block_rows(np.packbits(bits), 1 << 19)

        rows = ids.select(F.col(column).cast("long")).dropna().mapInArrow(tidy(mark), "block int, part int, data binary")
        blocks = summed_blocks(rows, np.bitwise_or.reduce, "u1")
        bits = np.concatenate([blocks[i] for i in sorted(blocks)]) if blocks else np.zeros(self.BITS // 8, np.uint8)
        self.shared = ids.sparkSession.sparkContext.broadcast(bits)

    @staticmethod
    def _spot(values: np.ndarray) -> np.ndarray:
        x = values.astype(np.int64).view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(32))) % np.uint64(IdFilter.BITS)).astype(np.int64)

    def may_hold(self, values: np.ndarray) -> np.ndarray:
        at = self._spot(values)
        return (self.shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)


def parted(df: DataFrame, ids: IdFilter, column: str) -> tuple[DataFrame, DataFrame]:
    """Rows that may have an id of the filter, and those that surely have not (a null id has not).

    A join of the first with the filter's table, and the second as it is, make the join of the
    whole without dealing out the rows that it leaves alone.
    """

    @F.pandas_udf("boolean")
    def may(values: pd.Series) -> pd.Series:
        return pd.Series(ids.may_hold(values.to_numpy(np.int64)))

    near = df[column].isNotNull() & may(F.coalesce(df[column].cast("long"), F.lit(0)))
    return df.where(near), df.where(~near)


def keep_repeated(
    key: list[str], rest: list[str], first: dict[str, str] | None = None
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of rows sorted by ``key`` and ``rest``, those whose key has two different rests; equal rows once.

    ``first`` adds columns (new name to column) with what the first row of the key has. Rows
    stream through: one row is held at a time, so a key may have any number of them.
    """
    first = first or {}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, written, lead = None, False, None
        for batch in batches:
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            changed = [np.append(True, x[1:] != x[:-1]) for x in (table.column(c).to_numpy() for c in key + rest)]
            fresh = np.logical_or.reduce(changed)
            new_key = np.logical_or.reduce(changed[: len(key)])[fresh]
            table = table.filter(pa.array(fresh))
            many = ~new_key | np.append(~new_key[1:], False)
            out = many.copy()
            if written:
                out[0] = False
            full = table
            start = np.flatnonzero(new_key)[np.cumsum(new_key) - 1]
            for name, column in first.items():
                values = table.column(column).to_numpy()[start]
                if lead is not None:
                    values = np.where(start == 0, lead[name], values)
                full = full.append_column(name, pa.array(values))
            lead = {name: full.column(name)[-1].as_py() for name in first}
            if out.any():
                yield from full.filter(pa.array(out)).combine_chunks().to_batches()
            written = bool(many[-1]) or (written and len(many) == 1)
            held = table.slice(table.num_rows - 1).combine_chunks().to_batches()[0]

    return run
