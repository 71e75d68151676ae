"""Raw float32 matrices as a Spark data source.

The format is headerless: little-endian float32 in row order, row width known from outside.
A matrix is one file, or a folder of parts whose concatenation in name order is the matrix.
Rows get ``row_id`` = position, computed from the byte offset, so a scan splits anywhere and
needs no numbering pass.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.types import StructType

from vectrove.functions.vectors import matrix
from vectrove.operators.centroids import held
from vectrove.operators.shape import check_mask
from vectrove.sources.storage import locate

FORMAT = "raw_matrix"
FLOAT = np.dtype("<f4")
PARTITION_BYTES = 128 << 20
BATCH_BYTES = 8 << 20
# Bytes between the wanted spans of two rows from which on they are skipped and not read.
SKIP_BYTES = 64 << 10
_SUFFIX = ".f32"


@dataclass
class Span(InputPartition):
    """Consecutive rows of one file, and the pieces of the label files that belong to them."""

    path: str
    offset: int
    rows: int
    first_row: int
    labels: tuple[tuple[str, int, int], ...] = ()  # (file, byte offset, floats)


def _files(path: str) -> list[tuple[str, int]]:
    files, inner = locate(path)
    info = files.get_file_info(inner)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if info.type == fs.FileType.File:
        return [(inner, info.size)]
    found = [
        (entry.path, entry.size)
        for entry in files.get_file_info(fs.FileSelector(inner))
        if entry.type == fs.FileType.File and not entry.base_name.startswith(("_", "."))
    ]
    return sorted(found)


def plan_spans(path: str, dim: int, n_rows: int | None, partition_bytes: int = PARTITION_BYTES) -> list[Span]:
    """Row ranges to scan. A size that does not fit the shape is an error; a prefix is fewer spans."""
    if dim < 1:
        raise ValueError("row width must be positive")
    row_bytes = dim * FLOAT.itemsize
    files = _files(path)
    held = sum(size for _, size in files)
    if n_rows is not None and n_rows * row_bytes > held:
        raise ValueError(f"{n_rows} rows of {dim} floats need {n_rows * row_bytes} bytes, {path} has {held}")
    wanted = n_rows if n_rows is not None else held // row_bytes
    per_span = max(1, partition_bytes // row_bytes)
    spans: list[Span] = []
    first = 0
    for position, (name, size) in enumerate(files):
        if first >= wanted:
            break
        whole, rest = divmod(size, row_bytes)
        # A prefix may end before a ragged tail; nothing else may be ragged.
        if rest and (n_rows is None or position < len(files) - 1):
            raise ValueError(f"size {size} of {name} is not a multiple of the row width ({row_bytes} bytes)")
        take = min(whole, wanted - first)
        for start in range(0, take, per_span):
            spans.append(Span(name, start * row_bytes, min(per_span, take - start), first + start))
        first += take
    return spans


def plan_labelled(
    path: str, labels: str, dim: int, n_rows: int | None = None, partition_bytes: int = PARTITION_BYTES
) -> list[Span]:
    """Row ranges of a matrix, each with its range of the label vector; lengths must match."""
    spans = plan_spans(path, dim, n_rows, partition_bytes)
    pieces = plan_spans(labels, 1, n_rows, partition_bytes=1 << 62)
    x_rows, y_rows = sum(s.rows for s in spans), sum(p.rows for p in pieces)
    if x_rows != y_rows:
        raise ValueError(f"{path} has {x_rows} rows, {labels} has {y_rows}")
    at = 0
    for span in spans:
        last, found = span.first_row + span.rows, []
        while pieces[at].first_row + pieces[at].rows <= span.first_row:
            at += 1
        for piece in pieces[at:]:
            if piece.first_row >= last:
                break
            start = max(span.first_row, piece.first_row)
            stop = min(last, piece.first_row + piece.rows)
            found.append((piece.path, (start - piece.first_row) * FLOAT.itemsize, stop - start))
        span.labels = tuple(found)
    return spans


class RawMatrixReader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.dim = int(options["dim"])
        self.n_rows = int(options["n_rows"]) if options.get("n_rows") else None
        self.partition_bytes = int(options.get("partition_bytes", PARTITION_BYTES))
        self.labels = options.get("labels")
        wanted = options.get("features")
        self.features = np.array([int(i) for i in wanted.split(",")]) if wanted else None
        self.skip_bytes = int(options.get("skip_bytes", SKIP_BYTES))
        self.low, self.high = 0, None  # rows wanted, the last one included

    def pushFilters(self, filters: list) -> Iterator:
        """Bounds on ``row_id`` become byte ranges; Spark still applies every filter."""
        for wanted in filters:
            if getattr(wanted, "attribute", None) == ("row_id",) and isinstance(getattr(wanted, "value", None), int):
                name, value = type(wanted).__name__, wanted.value
                if name in ("EqualTo", "GreaterThan", "GreaterThanOrEqual"):
                    self.low = max(self.low, value + (name == "GreaterThan"))
                if name in ("EqualTo", "LessThan", "LessThanOrEqual"):
                    value -= name == "LessThan"
                    self.high = value if self.high is None else min(self.high, value)
            yield wanted

    def partitions(self) -> list[Span]:
        if self.labels:
            spans = plan_labelled(self.path, self.labels, self.dim, self.n_rows, self.partition_bytes)
        else:
            spans = plan_spans(self.path, self.dim, self.n_rows, self.partition_bytes)
        return [part for span in spans if (part := self._within(span)) is not None]

    def _within(self, span: Span) -> Span | None:
        """The wanted rows of a span; one that has its labels with it stays whole."""
        first = max(span.first_row, self.low)
        last = span.first_row + span.rows - 1
        last = last if self.high is None else min(last, self.high)
        if first > last:
            return None
        if self.labels:
            return span
        skipped = (first - span.first_row) * self.dim * FLOAT.itemsize
        return Span(span.path, span.offset + skipped, last - first + 1, first)

    def _label_values(self, span: Span) -> np.ndarray:
        files, _ = locate(self.labels)
        parts = []
        for path, offset, count in span.labels:
            with files.open_input_file(path) as source:
                parts.append(np.frombuffer(source.read_at(count * FLOAT.itemsize, offset), dtype=FLOAT))
        return np.concatenate(parts).astype(np.int32)

    def _values(self, source, offset: int, rows: int) -> np.ndarray:
        """The wanted features of ``rows`` rows from a byte offset on, flat.

        Only bytes from the first to the last wanted feature of a row matter: what lies between
        two rows' spans is skipped where it is long, and read along where a seek would cost more.
        """
        row_bytes = self.dim * FLOAT.itemsize
        first, last = (0, self.dim) if self.features is None else (int(self.features.min()), int(self.features.max()) + 1)
        at, width = offset + first * FLOAT.itemsize, (last - first) * FLOAT.itemsize
        if row_bytes - width >= self.skip_bytes:
            data, size = b"".join(source.read_at(width, at + i * row_bytes) for i in range(rows)), rows * width
            step = last - first
        else:
            size, step = (rows - 1) * row_bytes + width, self.dim
            data = source.read_at(size, at)
        if len(data) != size:
            raise OSError("a raw matrix became shorter while it was read")
        values = np.frombuffer(data, dtype=FLOAT)
        if self.features is None:
            return values
        starts = np.arange(rows, dtype=np.int64) * step
        return values[(starts[:, None] + (self.features - first)).ravel()]

    def read(self, partition: Span) -> Iterator[pa.RecordBatch]:
        if partition is None:  # an empty matrix has no span
            return
        files, _ = locate(self.path)
        row_bytes = self.dim * FLOAT.itemsize
        per_batch = max(1, BATCH_BYTES // row_bytes)
        labels = self._label_values(partition) if self.labels else None
        with files.open_input_file(partition.path) as source:
            for done in range(0, partition.rows, per_batch):
                rows = min(per_batch, partition.rows - done)
                values = self._values(source, partition.offset + done * row_bytes, rows)
                offsets = np.arange(rows + 1, dtype=np.int32) * (len(values) // rows)
                first = partition.first_row + done
                columns = [
                    pa.array(np.arange(first, first + rows, dtype=np.int64)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(values)),
                ]
                names = ["row_id", "features"]
                if labels is not None:
                    columns.append(pa.array(labels[done : done + rows]))
                    names.append("label")
                yield pa.RecordBatch.from_arrays(columns, names)


@dataclass
class Part(WriterCommitMessage):
    temporary: str
    final: str
    first: int | None
    last: int | None


class RawMatrixWriter(DataSourceArrowWriter):
    """One part file per task, renamed into place when the whole job has succeeded."""

    def __init__(self, path: str, overwrite: bool):
        self.path = path
        self.overwrite = overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Part:
        from pyspark import TaskContext

        files, inner = locate(self.path)
        files.create_dir(inner, recursive=True)
        part = TaskContext.get().partitionId()
        temporary = f"{inner}/_attempt-{uuid.uuid4().hex}"
        first = last = None
        with files.open_output_stream(temporary) as sink:
            for batch in iterator:
                if not len(batch):
                    continue
                ids = batch.column(batch.schema.get_field_index("row_id")).to_numpy()
                if (np.diff(ids) < 0).any() or (last is not None and ids[0] < last):
                    raise ValueError("rows of a raw matrix must arrive in row_id order")
                first, last = (int(ids[0]) if first is None else first), int(ids[-1])
                values = matrix(batch.column(batch.schema.get_field_index("features")))
                sink.write(np.ascontiguousarray(values, dtype=FLOAT).tobytes())
        return Part(temporary, f"{inner}/part-{part:010d}{_SUFFIX}", first, last)

    def commit(self, messages: list[Part | None]) -> None:
        files, inner = locate(self.path)
        parts = sorted((m for m in messages if m is not None), key=lambda m: m.final)
        filled = [m for m in parts if m.first is not None]
        if any(a.last > b.first for a, b in zip(filled, filled[1:])):
            self.abort(messages)
            raise ValueError("partitions of a raw matrix must follow row_id order")
        old = _files(self.path)
        if old and not self.overwrite:
            self.abort(messages)
            raise FileExistsError(f"{self.path} already holds parts")
        for name, _size in old:
            if name.endswith(_SUFFIX):
                files.delete_file(name)
        for part in parts:
            files.move(part.temporary, part.final)
        # What failed or repeated attempts of tasks have left.
        for entry in files.get_file_info(fs.FileSelector(inner)):
            if entry.base_name.startswith("_attempt-"):
                files.delete_file(entry.path)

    def abort(self, messages: list[Part | None]) -> None:
        files, _ = locate(self.path)
        for message in messages:
            if message is not None:
                files.delete_file(message.temporary)


class RawMatrixSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "row_id bigint, features array<float>" + (", label int" if self.options.get("labels") else "")

    def reader(self, schema: StructType) -> RawMatrixReader:
        return RawMatrixReader(self.options)

    def writer(self, schema: StructType, overwrite: bool) -> RawMatrixWriter:
        return RawMatrixWriter(self.options["path"], overwrite)


def _mask_option(features: Sequence[int], dim: int) -> str:
    places = check_mask(features)
    if max(places) >= dim:
        raise ValueError(f"a mask reaches past a row of {dim} features")
    return ",".join(map(str, places))


def read_matrix(
    spark: SparkSession,
    path: str,
    dim: int,
    n_rows: int | None = None,
    partition_bytes: int = PARTITION_BYTES,
    features: Sequence[int] | None = None,
) -> DataFrame:
    """``row_id, features``: all rows, or the first ``n_rows``; a file of the wrong size is an error.

    ``features`` is a mask: only its positions are handed on, in its order, as by
    :func:`vectrove.operators.shape.mask_features` on the whole rows.
    """
    plan_spans(path, dim, n_rows)
    spark.dataSource.register(RawMatrixSource)
    reader = spark.read.format(FORMAT).option("dim", dim).option("partition_bytes", partition_bytes)
    if n_rows is not None:
        reader = reader.option("n_rows", n_rows)
    if features is not None:
        reader = reader.option("features", _mask_option(features, dim))
    return reader.load(path)


def read_labelled(
    spark: SparkSession,
    path: str,
    labels: str,
    dim: int,
    n_rows: int | None = None,
    partition_bytes: int = PARTITION_BYTES,
    features: Sequence[int] | None = None,
) -> DataFrame:
    """``row_id, features, label`` of a matrix and its label vector, aligned while scanning.

    A task reads the labels of its own row range, so aligning costs no join and no shuffle.
    Different lengths are an error. ``features`` as for :func:`read_matrix`.
    """
    plan_labelled(path, labels, dim, n_rows)
    spark.dataSource.register(RawMatrixSource)
    reader = spark.read.format(FORMAT).option("dim", dim).option("partition_bytes", partition_bytes)
    if n_rows is not None:
        reader = reader.option("n_rows", n_rows)
    if features is not None:
        reader = reader.option("features", _mask_option(features, dim))
    return reader.option("labels", labels).load(path)


def read_labels(spark: SparkSession, path: str, n_rows: int | None = None) -> DataFrame:
    """``row_id, label``: a label vector (one float per row)."""
    return read_matrix(spark, path, 1, n_rows).select("row_id", F.get("features", F.lit(0)).cast("int").alias("label"))


def zip_labels(x: DataFrame, y: DataFrame, row_id: str = "row_id", check: bool = True) -> DataFrame:
    """Align two tables by ``row_id``. With ``check``, unequal row sets are an error.

    For raw files :func:`read_labelled` does the same without a shuffle.
    """
    if check:
        rows = (
            x.select(F.col(row_id), F.lit(1).alias("x"))
            .join(y.select(F.col(row_id), F.lit(1).alias("y")), row_id, "full_outer")
            .agg(F.count(F.when(F.col("x").isNull() | F.col("y").isNull(), 1)).alias("loose"))
        )
        loose = rows.first()["loose"]
        if loose:
            raise ValueError(f"{loose} rows have features or a label but not both")
    return x.join(y, row_id)


def write_matrix(
    df: DataFrame, path: str, features: str = "features", row_id: str = "row_id", ordered: bool = False
) -> None:
    """Write vectors as float32 in ``row_id`` order, one part per range of rows.

    ``ordered`` says that the partitions already follow ``row_id`` (a raw matrix with only
    row-wise operators on top) and saves the shuffle; the order is verified either way.
    """
    df.sparkSession.dataSource.register(RawMatrixSource)
    rows = df.select(F.col(row_id).alias("row_id"), F.col(features).cast("array<float>").alias("features"))
    if not ordered:
        rows = rows.repartitionByRange("row_id").sortWithinPartitions("row_id")
    rows.write.format(FORMAT).mode("overwrite").save(path)


def write_assignments(
    assigned: DataFrame, path: str, cluster: str = "cluster", row_id: str = "row_id", parquet: bool = False
) -> DataFrame:
    """Write one float per row (its cluster) in row order; returns ``cluster, n``.

    ``parquet`` writes a table ``row_id, cluster`` instead. The assignment is evaluated once:
    id and cluster are held for the ordering, the write and the count.
    """
    narrow = assigned.select(row_id, cluster).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if parquet:
            narrow.write.mode("overwrite").parquet(path)
        else:
            write_matrix(narrow.select(row_id, F.array(F.col(cluster).cast("float")).alias("features")), path, row_id=row_id)
        return held(narrow.groupBy(cluster).agg(F.count(F.lit(1)).alias("n")))  # a row a cluster
    finally:
        narrow.unpersist()
