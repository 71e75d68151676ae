"""Token ids as length-delimited binary records with an offset index for shuffled reads.

A data file is a row of frames, little-endian:

    8 bytes  length of the payload
    4 bytes  masked crc32 of those 8 bytes
    payload  8 bytes doc_id, then the ids, 2 or 4 bytes each
    4 bytes  masked crc32 of the payload

The mask is that of the well-known record format (rotate right by 15, add a constant), so a
checksum of data that holds checksums stays meaningful; the checksum itself is zlib's crc32.
Beside each data file lies an index file of 32 bytes a record: doc_id, offset and length of
the frame, ids before it in the file. A manifest (a Parquet table) names the files of tasks
that ended well; files of attempts that were lost are not in it.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vectrove.llm.common import plain_texts, slices, texts_of, tidy, tokenizer_file
from vectrove.llm.tokens import BYTE_LEVEL, token_ids
from vectrove.sources.storage import locate

_MASK = 0xA282EAD8  # fixed by the format
_INDEX = np.dtype([("doc_id", "<i8"), ("offset", "<i8"), ("length", "<i8"), ("before", "<i8")])
_READ = 8 << 20
#: The id under which records of rows without one are kept.
NAMELESS = -(1 << 63)


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + _MASK) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return b"".join([head, struct.pack("<I", masked(head)), payload, struct.pack("<I", masked(payload))])


def payload_of(data: memoryview) -> memoryview:
    """The payload of one frame, both checksums verified."""
    (length,) = struct.unpack_from("<Q", data)
    if struct.unpack_from("<I", data, 8)[0] != masked(data[:8]) or len(data) != length + 16:
        raise ValueError("damaged record: its length does not match")
    payload = data[12 : 12 + length]
    if struct.unpack_from("<I", data, 12 + length)[0] != masked(payload):
        raise ValueError("damaged record: its payload does not match")
    return payload


def write_token_records(
    docs: DataFrame, root: str, path: str | None = None, end_id: int | None = 2, id_bytes: int = 2
) -> DataFrame:
    """Encode all documents and write their ids under ``root`` in ascending doc_id order.

    ``root`` must be storage that all executors see. ``id_bytes`` is 2 for vocabularies up to
    65,536 ids, else 4. Returns the manifest: ``part, file, n_records, n_ids, before`` with
    ``before`` the ids of all files ahead. The table is dealt by ranges of doc_id, so a
    file's ids follow those of the file before it; one range is one file, written as it
    streams. A null text is empty and gives a record with the end id only. Records without a
    doc_id come first, under the id ``NAMELESS``, and are read back as null. Rows that repeat
    an id are in the order of their text's hash and text, which also parts one frequent id
    between files; repeated rows give repeated records.
    """
    path = path or tokenizer_file(BYTE_LEVEL)
    kind = {2: "<u2", 4: "<u4"}[id_bytes]
    tail = b"" if end_id is None else np.array([end_id], "<u4").tobytes()
    ready = plain_texts(docs).withColumn("doc_id", F.coalesce("doc_id", F.lit(NAMELESS))).withColumn("t", F.xxhash64("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        name = f"part-{part:06d}-{uuid.uuid4().hex}"
        files, place = locate(f"{root}/{name}")
        files.create_dir(place.rpartition("/")[0], recursive=True)
        out = index = None
        offset = n_ids = n_records = 0
        for batch in slices(batches):
            if out is None:
                out, index = files.open_output_stream(place + ".bin"), files.open_output_stream(place + ".idx")
            rows, parts = [], []
            ids_column = batch.column("doc_id").to_pylist()
            for doc_id, ids in zip(ids_column, token_ids(texts_of(batch), path), strict=True):
                ids = np.frombuffer(ids + tail, "<u4")
                narrow = ids.astype(kind)
                if id_bytes == 2 and len(ids) and int(ids.max()) > 0xFFFF:
                    raise ValueError("the vocabulary needs id_bytes=4")
                data = frame(struct.pack("<q", doc_id) + narrow.tobytes())
                rows.append((doc_id, offset, len(data), n_ids))
                parts.append(data)
                offset, n_ids, n_records = offset + len(data), n_ids + len(ids), n_records + 1
            out.write(b"".join(parts))
            index.write(np.array(rows, _INDEX).tobytes())
        if out is not None:
            out.close()
            index.close()
            yield pa.RecordBatch.from_pydict(
                {"part": [part], "file": [name], "n_records": [n_records], "n_ids": [n_ids]}, schema=written
            )

    written = pa.schema([("part", pa.int64()), ("file", pa.string()), ("n_records", pa.int64()), ("n_ids", pa.int64())])
    ordered = ready.repartitionByRange("doc_id", "t").sortWithinPartitions("doc_id", "t", "text")
    parts = ordered.mapInArrow(tidy(run, keep=True), "part long, file string, n_records long, n_ids long")
    parts.write.parquet(f"{root}/manifest")
    return manifest(docs.sparkSession, root)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """The files of a finished write, with the ids ahead of each. One row a file."""
    files = spark.read.schema("part long, file string, n_records long, n_ids long").parquet(f"{root}/manifest")
    ahead = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("before", F.coalesce(F.sum("n_ids").over(ahead), F.lit(0)))


def record_index(spark: SparkSession, root: str) -> DataFrame:
    """``doc_id, file, offset, length, start``: where each record lies, and all ids before it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, before in zip(batch.column("file").to_pylist(), batch.column("before").to_pylist(), strict=True):
                files, place = locate(f"{root}/{file}.idx")
                with files.open_input_stream(place) as stream:
                    while data := stream.read(_READ // 32 * 32):
                        rows = np.frombuffer(data, _INDEX)
                        yield pa.RecordBatch.from_arrays(
                            [
                                pa.array(rows["doc_id"]),
                                pa.array([file] * len(rows), pa.string()),
                                pa.array(rows["offset"]),
                                pa.array(rows["length"]),
                                pa.array(rows["before"] + before),
                            ],
                            ["doc_id", "file", "offset", "length", "start"],
                        )

    names = manifest(spark, root).select("file", "before")
    # One file a task or so; the table has a row a file.
    spread = names.repartition(max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))), "file")
    return spread.mapInArrow(run, "doc_id long, file string, offset long, length long, start long")


def read_token_records(index: DataFrame, root: str, id_bytes: int = 2, with_ids: bool = True) -> DataFrame:
    """The records that the rows of an index name, in the order of those rows.

    Shuffle, filter or sample the index first: only the frames it names are read, and frames
    that follow each other are read at once. The id ``NAMELESS`` is given back as null. Adds ``n_tokens``, ``ids_crc32`` (of the ids as
    little-endian unsigned 32-bit integers) and, unless ``with_ids`` is False, ``ids``.
    Damaged frames raise an error.
    """
    kind = {2: "<u2", 4: "<u4"}[id_bytes]
    schema = "doc_id long, file string, offset long, length long, start long, n_tokens long, ids_crc32 long"

    def frames(names: list, offsets: list, lengths: list) -> Iterator[memoryview]:
        at, opened, stream = 0, None, None
        while at < len(names):
            last = at
            end = offsets[at] + lengths[at]
            while (
                last + 1 < len(names)
                and names[last + 1] == names[at]
                and offsets[last + 1] == end
                and end + lengths[last + 1] - offsets[at] <= _READ
            ):
                last += 1
                end += lengths[last]
            if opened != names[at]:
                if stream is not None:
                    stream.close()
                files, place = locate(f"{root}/{names[at]}.bin")
                opened, stream = names[at], files.open_input_file(place)
            data = memoryview(stream.read_at(end - offsets[at], offsets[at]))
            for i in range(at, last + 1):
                begin = offsets[i] - offsets[at]
                yield data[begin : begin + lengths[i]]
            at = last + 1
        if stream is not None:
            stream.close()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places = [batch.column(c).to_pylist() for c in ("file", "offset", "length")]
            counts, sums, lists = [], [], []
            for doc_id, data in zip(batch.column("doc_id").to_pylist(), frames(*places), strict=True):
                payload = payload_of(data)
                if struct.unpack_from("<q", payload)[0] != doc_id:
                    raise ValueError("damaged index: another document lies there")
                ids = np.frombuffer(payload, kind, offset=8).astype("<u4")
                counts.append(len(ids))
                sums.append(zlib.crc32(ids.tobytes()))
                if with_ids:
                    lists.append(ids.astype(np.int32))
            columns = [batch.column(c) for c in ("doc_id", "file", "offset", "length", "start")]
            columns[0] = pc.replace_with_mask(columns[0], pc.equal(columns[0], NAMELESS), pa.scalar(None, pa.int64()))
            columns += [pa.array(counts, pa.int64()), pa.array(sums, pa.int64())]
            names = schema.replace(" long", "").replace(" string", "").split(", ")
            if with_ids:
                columns.append(pa.array(lists, pa.list_(pa.int32())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)

    wanted = index.select("doc_id", "file", "offset", "length", "start")
    return wanted.mapInArrow(tidy(run), schema + (", ids array<int>" if with_ids else ""))
