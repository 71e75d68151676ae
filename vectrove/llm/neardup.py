"""Near-duplicate vectors by cross-polytope hashing after fast Hadamard rotations.

A rotation flips signs at random and applies a Hadamard transform, three times over; the
nearest axis of the rotated vector (with its sign) is its hash. Two rotations make a
bucket, several tables make recall, and each vector also looks into the buckets of its
next-best axes. Pairs that meet are verified by cosine in blocks: an oversize bucket is
cut into blocks that meet two by two, so no task holds it whole and no pair is skipped.
What leaves a task is a count per vector and a tree of links, never the pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.llm.common import map_arrow, stored
from vectrove.llm.graph import components
from vectrove.llm.vectors import block, usable

#: Tables, rotations of a bucket, probes beside the own bucket, rows of a block.
TABLES, ROTATIONS, PROBES, ROWS = 8, 2, 2, 512
_PAIRS = 40_000


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, width = x.shape
    step = 1
    while step < width:
        y = x.reshape(n, width // (2 * step), 2, step)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(n, width)
        step *= 2
    return x / np.sqrt(width)


def rotated(x: np.ndarray, seed: int) -> np.ndarray:
    width = 1 << max(1, (x.shape[1] - 1).bit_length())
    y = np.zeros((len(x), width))
    y[:, : x.shape[1]] = x
    rng = np.random.default_rng(seed)
    for _ in range(3):
        y = hadamard(y * rng.choice([-1.0, 1.0], width))
    return y


def codes(x: np.ndarray) -> np.ndarray:
    """``rows x TABLES x (1 + PROBES)``: own bucket first, then the likeliest next ones."""
    out = np.zeros((len(x), TABLES, 1 + PROBES), np.int64)
    pick = np.arange(len(x))
    for table in range(TABLES):
        first, second, loss = [], [], []
        for r in range(ROTATIONS):
            y = rotated(x, 1000 * table + r)
            size = np.abs(y)
            best = size.argmax(1)
            top = size[pick, best].copy()
            size[pick, best] = -1
            next_ = size.argmax(1)
            loss.append(top - size[pick, next_])
            first.append(2 * best + (y[pick, best] > 0))
            second.append(2 * next_ + (y[pick, next_] > 0))
        width = 2 * y.shape[1]
        order = np.argsort(np.stack(loss, 1), axis=1, kind="stable")
        for probe in range(1 + PROBES):
            code = np.zeros(len(x), np.int64)
            for r in range(ROTATIONS):
                swap = (order[:, probe - 1] == r) if 0 < probe <= ROTATIONS else np.zeros(len(x), bool)
                code = code * width + np.where(swap, second[r], first[r])
            out[:, table, probe] = code
    return out


def _pairs_of(sizes: np.ndarray, starts: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of rows within each group, some thousands at a time."""
    total = int(sizes.sum())
    row = np.repeat(starts, sizes) + np.arange(total) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    left = np.repeat(starts + sizes, sizes) - row - 1  # partners after each row
    reach = np.cumsum(left)
    at = 0
    while at < total:
        done = reach[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(reach, done + _PAIRS, side="right")))
        n = left[at:end]
        first = np.repeat(row[at:end], n)
        yield first, first + 1 + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        at = end


def _roots(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest reachable number for each of ``n`` by the links ``a, b``."""
    root = np.arange(n)
    while len(a):
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            break
    return root


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, id_column: str = "vec_id", column: str = "embedding", label: str = "label"
) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every id.

    Rows are compared when their labels are equal and not null; vectors that are null, zero
    or hold null or non-finite components link with nothing, and are components of their
    own. Exact copies are linked without being compared. Of rows that repeat an id one
    counts (the smallest label and vector); rows without an id are left out, other columns
    ignored. Vectors of different lengths never link.
    """
    rows = (
        vectors.where(F.col(id_column).isNotNull())
        .select(
            F.col(id_column).cast("long").alias("vec_id"),
            F.struct(F.col(label).alias("label"), F.col(column).cast("array<double>").alias("v")).alias("s"),
        )
        .groupBy("vec_id")
        .agg(F.min("s").alias("s"))
        .select("vec_id", "s.label", "s.v")
        .withColumn("v", F.when(F.col("label").isNotNull() & usable(F.col("v")), F.col("v")))
    )
    rows = stored(rows, "vectors")
    taking = rows.where(F.col("v").isNotNull())
    texts = taking.groupBy("label", "v").agg(F.min("vec_id").alias("rep"), F.count("vec_id").alias("copies"))
    reps = stored(texts, "distinct")

    def hashed(batch: pa.RecordBatch) -> pa.RecordBatch:
        lists, n = batch.column("v"), batch.num_rows
        lengths = np.asarray(lists.value_lengths())
        own = np.zeros((n, TABLES, 1 + PROBES), np.int64)
        data = [b""] * n
        for width in np.unique(lengths).tolist():
            at = np.flatnonzero(lengths == width)
            x = block(lists.take(pa.array(at)))
            x = x / np.abs(x).max(1, keepdims=True)
            x = x / np.sqrt((x**2).sum(1, keepdims=True))
            own[at] = codes(x)
            for i, v in zip(at.tolist(), x, strict=True):
                data[i] = v.tobytes()
        marks = [c.astype("<i4").tobytes() for c in own]
        spots = TABLES * (1 + PROBES)
        take = np.repeat(np.arange(n), spots)
        return pa.RecordBatch.from_arrays(
            [
                batch.column("label").take(pa.array(take)),
                pa.array(np.repeat(lengths, spots).astype(np.int32)),
                pa.array(np.tile(np.repeat(np.arange(TABLES, dtype=np.int32), 1 + PROBES), n)),
                pa.array(own.reshape(-1)),
                pa.array(np.tile(np.arange(1 + PROBES) == 0, n * TABLES)),
                batch.column("rep").take(pa.array(take)),
                batch.column("copies").take(pa.array(take)),
                pa.array(marks, pa.binary()).take(pa.array(take)),
                pa.array(data, pa.binary()).take(pa.array(take)),
            ],
            ["label", "width", "tab", "code", "own", "id", "copies", "marks", "data"],
        )

    kind = dict(rows.dtypes)["label"]
    spots = map_arrow(
        reps, hashed, f"label {kind}, width int, tab int, code long, own boolean, id long, copies long, marks binary, data binary"
    ).withColumn("bucket", F.xxhash64("label", "width", "tab", "code"))
    sizes = spots.groupBy("bucket").agg(F.count("id").alias("n"), F.max("own").alias("owned")).where("n > 1 and owned")
    cut = spots.join(sizes.select("bucket", F.ceil(F.col("n") / ROWS).alias("blocks")), "bucket")
    cut = cut.withColumn("block", F.pmod(F.xxhash64("id"), "blocks"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    cells = cut.select(
        F.xxhash64("bucket", F.least("block", "other"), F.greatest("block", "other")).alias("cell"),
        "bucket",
        (F.col("block") <= F.col("other")).alias("low"),
        (F.col("block") >= F.col("other")).alias("high"),
        "tab", "own", "id", "copies", "marks", "data",
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            held = table if held is None else pa.concat_tables([held, table])
            cell = held.column("cell").to_numpy()
            last = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            if last:
                yield from _verified(held.slice(0, last), threshold)
                held = held.slice(last).combine_chunks()
        if held is not None and held.num_rows:
            yield from _verified(held, threshold)

    found = stored(
        cells.repartition("cell").sortWithinPartitions("cell").mapInArrow(verify, "id long, root long, links long"), "links"
    )
    groups = components(found.where("root is not null").select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = found.where("root is null").groupBy("id").agg(F.sum("links").alias("links"))
    per_rep = (
        reps.select("label", "v", "rep", "copies")
        .join(links.withColumnRenamed("id", "rep"), "rep", "left")
        .join(groups.select(F.col("node").alias("rep"), "component"), "rep", "left")
    )
    full = taking.join(
        per_rep.select(
            "label", "v",
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"),
        ),
        ["label", "v"],
    ).select("vec_id", "n_links", "component_id")
    alone = rows.where(F.col("v").isNull()).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return full.union(alone).withColumn("kept", F.col("vec_id") == F.col("component_id"))


def _verified(table: pa.Table, threshold: float) -> Iterator[pa.RecordBatch]:
    """Links counted per vector, and links to the root of what is connected here.

    A pair is counted where it meets first: in the first of its tables, and there in the
    bucket of the smaller row's own code if both look into two common ones.
    """
    cell, bucket = table.column("cell").to_numpy(), table.column("bucket").to_numpy()
    low, high, own = (table.column(c).to_numpy(zero_copy_only=False) for c in ("low", "high", "own"))
    tab, ids, copies = (table.column(c).to_numpy() for c in ("tab", "id", "copies"))
    marks = table.column("marks").to_pylist()
    data = table.column("data").to_pylist()
    mark = np.frombuffer(b"".join(marks), "<i4").reshape(len(marks), TABLES, -1)
    starts = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (bucket[1:] != bucket[:-1])))
    sizes = np.diff(np.append(starts, len(cell)))
    names, number = np.unique(ids, return_inverse=True)
    links = np.zeros(len(names), np.int64)
    weight = np.zeros(len(names), np.int64)
    weight[number] = copies
    ends: list[tuple[np.ndarray, np.ndarray]] = []
    for a, b in _pairs_of(sizes[sizes > 1], starts[sizes > 1]):
        meet = (own[a] | own[b]) & (ids[a] != ids[b]) & (low[a] & high[b] | low[b] & high[a])
        a, b = a[meet], b[meet]
        if not len(a):
            continue
        swap = ids[a] > ids[b]
        a, b = np.where(swap, b, a), np.where(swap, a, b)
        common = (mark[a][:, :, :1] == mark[b]).any(2)  # b looks into a's bucket
        back = (mark[b][:, :, :1] == mark[a]).any(2)
        first = (common | back).argmax(1) == tab[a]
        # In one table, a pair may meet in a's own bucket and in b's: a's counts.
        there = np.where(common[np.arange(len(a)), tab[a]], own[a], own[b])
        a, b = a[first & there], b[first & there]
        if not len(a):
            continue
        x = np.array([np.frombuffer(data[i], float) for i in a.tolist()])
        y = np.array([np.frombuffer(data[i], float) for i in b.tolist()])
        near = np.einsum("ij,ij->i", x, y) >= threshold
        a, b = number[a[near]], number[b[near]]
        np.add.at(links, a, weight[b])
        np.add.at(links, b, weight[a])
        ends.append((a, b))
    if not ends:
        return
    a, b = (np.concatenate(x) for x in zip(*ends, strict=True))
    some, root = np.flatnonzero(links), _roots(a, b, len(names))
    moved = np.flatnonzero(root != np.arange(len(names)))
    none = pa.nulls(len(some), pa.int64())
    yield pa.RecordBatch.from_arrays([pa.array(names[some]), none, pa.array(links[some])], ["id", "root", "links"])
    yield pa.RecordBatch.from_arrays(
        [pa.array(names[moved]), pa.array(names[root[moved]]), pa.nulls(len(moved), pa.int64())], ["id", "root", "links"]
    )
