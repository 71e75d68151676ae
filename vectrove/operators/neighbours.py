"""Nearest-neighbour joins: cluster assignment, distances to a point set, exact kNN.

Three exact strategies, chosen from counted sizes:

* the point side fits a broadcast: the other side is scanned once, nothing is shuffled. Narrow
  rows in numbers that make too many pairs go by cells all the same;
* only the query side fits: the train side is scanned once, each task keeps the best *k* per
  query, and the partial lists are merged by query;
* neither fits: train rows are dealt to cells around pivots, and a query searches only the
  cells that its k-th distance so far can meet (:mod:`vectrove.operators.cells`).

A fourth one, ``grid``, cuts both sides into tiles by hash and searches every pair of tiles, block
by block; it prunes nothing and is there for vectors without any clusters. No strategy forms all pairs: a task only ever emits *k* rows per query it has seen.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vectrove.functions import kernels
from vectrove.functions.vectors import lists, matrix
from vectrove.operators.cells import nearest_by_cells
from vectrove.operators.centroids import BROADCAST_NUMBERS, as_matrix, point_numbers

# Numbers per grid block (64 MiB as float64).
BLOCK_NUMBERS = 8_000_000
# Numbers of a grid tile, if its blocks are smaller: a row is sent once for each tile it meets.
TILE_NUMBERS = 8_000_000
# Pairs up to which a side is scanned whole for every query; rows of more numbers always are,
# as distances to pivots rule out little of wide vectors.
SCAN_PAIRS, NARROW = 5_000_000_000, 16
# Rows of a cell unless stated, and cells at most (or so) before they grow.
CELL_ROWS, CELLS = 2048, 4096

_NEIGHBOUR = "struct<distance: double, neighbour: bigint, label: int>"


# -- assignment ---------------------------------------------------------------------------


def nearest_point(points: np.ndarray, rooted: bool, spark):
    """Arrow UDF ``features -> struct<cluster, error>`` over a broadcast point set."""
    shared = spark.sparkContext.broadcast(np.asarray(points, dtype=np.float64))

    @F.arrow_udf("struct<cluster: int, error: double>")
    def assign(vectors: pa.Array) -> pa.Array:
        means = shared.value
        best, error = kernels.nearest(matrix(vectors, means.shape[1]), means, rooted)
        return pa.StructArray.from_arrays([pa.array(best, pa.int32()), pa.array(error)], ["cluster", "error"])

    return assign


def assign_clusters(
    df: DataFrame,
    centroids,
    metric: str = "euclidean",
    features: str = "features",
    row_id: str = "row_id",
) -> DataFrame:
    """Add ``cluster`` (closest centroid, ties to the lowest) and ``error`` (that distance).

    ``metric`` is ``euclidean`` or ``squared``. ``centroids`` is an array or a DataFrame
    ``cluster, centroid``. Works on streaming input: no state, no shuffle. A centroid table
    beyond the broadcast bound is taken in blocks: each is one more map over the row, which
    keeps the best it has seen, so rows stay where they are and need no id at any size.
    """
    if metric not in ("euclidean", "squared"):
        raise ValueError("metric is 'euclidean' or 'squared'")
    rooted = metric == "euclidean"
    blocks = 1
    if isinstance(centroids, DataFrame):
        blocks = max(1, math.ceil(point_numbers(centroids, "centroid") / BROADCAST_NUMBERS))
    if blocks == 1:
        best = nearest_point(as_matrix(centroids), rooted, df.sparkSession)(F.col(features))
    else:
        best = _nearest_of_blocks(centroids, blocks, rooted, features)
    return df.withColumn("_nearest", best).select(
        *[F.col(c) for c in df.columns], "_nearest.cluster", "_nearest.error"
    )


def _nearest_of_blocks(centroids: DataFrame, blocks: int, rooted: bool, features: str) -> Column:
    """The nearest of a centroid table that is broadcast block by block; ties to the lowest cluster."""
    spark, found = centroids.sparkSession, []
    for block in range(blocks):
        rows = centroids.filter(F.pmod("cluster", F.lit(blocks)) == block)
        names = sorted(row[0] for row in rows.select("cluster").collect())
        if names:
            local = nearest_point(as_matrix(rows, bounded=True), rooted, spark)(F.col(features))
            name = F.get(F.array(*[F.lit(n) for n in names]), local["cluster"]) if len(names) <= 1000 else _named(spark, names)(local["cluster"])
            found.append(F.struct(local["error"].alias("error"), name.cast("int").alias("cluster")))
    best = F.least(*found) if len(found) > 1 else found[0]
    return F.struct(best["cluster"].alias("cluster"), best["error"].alias("error"))


def _named(spark, names: list[int]):
    """Arrow UDF ``place -> cluster`` over the clusters of a block."""
    shared = spark.sparkContext.broadcast(np.asarray(names, dtype=np.int32))

    @F.arrow_udf("int")
    def name(places: pa.Array) -> pa.Array:
        return pa.array(shared.value[places.to_numpy()], pa.int32())

    return name


def point_distances(
    df: DataFrame, points: np.ndarray, metric: str = "euclidean", features: str = "features", name: str = "distances"
) -> DataFrame:
    """Add an array column: the distance of each row to every point of a small set."""
    shared = df.sparkSession.sparkContext.broadcast(np.asarray(points, dtype=np.float64))
    rooted = metric == "euclidean"

    @F.arrow_udf("array<double>")
    def measure(vectors: pa.Array) -> pa.Array:
        targets = shared.value
        return lists(kernels.distances(matrix(vectors, targets.shape[1]), targets, rooted))

    return df.withColumn(name, measure(F.col(features)))


# -- k nearest neighbours -----------------------------------------------------------------


def _width(df: DataFrame) -> int:
    row = df.select(F.size("features")).first()
    return int(row[0]) if row else 0


def _extent(df: DataFrame) -> tuple[int, int]:
    """Rows and partitions of a side; no vector is read for it."""
    row = df.select(F.spark_partition_id().alias("p")).agg(F.count("p").alias("n"), F.max("p").alias("last")).first()
    return row["n"], (row["last"] if row["last"] is not None else -1) + 1


def _side(df: DataFrame, row_id: str, features: str, label: str | None) -> DataFrame:
    tag = F.col(label).cast("int") if label else F.lit(None).cast("int")
    return df.select(F.col(row_id).cast("long").alias("row_id"), F.col(features).alias("features"), tag.alias("label"))


def _labels(column) -> np.ndarray:
    return pc.fill_null(column.cast(pa.int64()), int(kernels.NO_LABEL)).to_numpy()


def _collect_side(df: DataFrame):
    """A side of checked size as (ids, vectors, labels) arrays for a broadcast."""
    table = df.toArrow().combine_chunks()
    return table.column("row_id").to_numpy(), matrix(table.column("features")), _labels(table.column("label"))


def _packed(query_ids: np.ndarray, best: kernels.ClosestK) -> pa.RecordBatch:
    """One record per query; the list is empty where no distance is finite."""
    lengths, distance, ids, labels = best.found()
    offsets = np.r_[0, np.cumsum(lengths)].astype(np.int32)
    entries = pa.StructArray.from_arrays(
        [
            pa.array(distance),
            pa.array(ids, pa.int64()),
            pa.array(labels, pa.int64(), mask=labels == kernels.NO_LABEL).cast(pa.int32()),
        ],
        ["distance", "neighbour", "label"],
    )
    return pa.RecordBatch.from_arrays(
        [pa.array(query_ids, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets), entries)],
        ["row_id", "neighbours"],
    )


_PACKED = f"row_id bigint, neighbours array<{_NEIGHBOUR}>"


def _scan_queries(train: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Train side broadcast: the final list of each query comes out of one map."""
    shared = queries.sparkSession.sparkContext.broadcast(_collect_side(train))

    def search(batches):
        ids, vectors, labels = shared.value
        for batch in batches:
            x = matrix(batch.column("features"))
            if len(x):
                best = kernels.ClosestK(x, k)
                if len(ids):
                    best.add(vectors, ids, labels)
                yield _packed(batch.column("row_id").to_numpy(), best)

    return queries.select("row_id", "features").mapInArrow(search, _PACKED)


def _scan_train(train: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Query side broadcast: each task of the train scan keeps the best ``k`` per query."""
    shared = train.sparkSession.sparkContext.broadcast(_collect_side(queries)[:2])

    def search(batches):
        query_ids, targets = shared.value
        best = kernels.ClosestK(targets, k)
        for batch in batches:
            x = matrix(batch.column("features"))
            if len(x) and len(query_ids):
                best.add(x, batch.column("row_id").to_numpy(), _labels(batch.column("label")))
        yield _packed(query_ids, best)

    return _merge(train.mapInArrow(search, _PACKED), k)


def _grid(train: DataFrame, queries: DataFrame, k: int, block_numbers: int) -> DataFrame:
    """Neither side broadcast: one cogroup per (train tile, query tile), searched block by block.

    Every row is sent as often as the other side has tiles, so these are of a fixed large size
    and no more than the cores ask for, whatever the blocks.
    """
    width = max(1, _width(train))
    rows_per_block = max(1, block_numbers // width)
    train_blocks, query_blocks = _tiles(train.count(), queries.count(), max(rows_per_block, TILE_NUMBERS // width), queries)

    def every(n: int):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    def block(n: int):
        return F.pmod(F.xxhash64("row_id"), F.lit(n)).cast("int")

    if "label" not in train.columns:
        train = train.withColumn("label", F.lit(None).cast("int"))
    left = train.select("row_id", "features", "label", block(train_blocks).alias("tb"), every(query_blocks).alias("qb"))
    right = queries.select("row_id", "features", block(query_blocks).alias("qb"), every(train_blocks).alias("tb"))

    def cell(train_block: pa.Table, query_block: pa.Table) -> pa.Table:
        best = kernels.ClosestK(matrix(query_block.column("features")), k)
        if len(train_block) and len(query_block):
            for at in range(0, len(train_block), rows_per_block):
                part = train_block.slice(at, rows_per_block)
                best.add(matrix(part.column("features")), part.column("row_id").to_numpy(), _labels(part.column("label")))
        return pa.Table.from_batches([_packed(query_block.column("row_id").to_numpy(), best)])

    cells = left.groupBy("tb", "qb").cogroup(right.groupBy("tb", "qb")).applyInArrow(cell, _PACKED)
    return _merge(cells, k)


def _tiles(train_rows: int, query_rows: int, rows: int, df: DataFrame) -> tuple[int, int]:
    """Tiles of either side of at most about ``rows`` rows; more of the train side, if cores would be idle."""
    train_tiles, query_tiles = max(1, math.ceil(train_rows / rows)), max(1, math.ceil(query_rows / rows))
    parallel = df.sparkSession.sparkContext.defaultParallelism
    return max(train_tiles, min(train_rows, math.ceil(parallel / query_tiles))), query_tiles


def _merge(partial: DataFrame, k: int) -> DataFrame:
    """Best ``k`` of the partial lists of each query; one shuffle by query serves both steps."""
    best = Window.partitionBy("row_id").orderBy(F.asc_nulls_last("entry.distance"), "entry.neighbour")
    return (
        partial.select("row_id", F.explode_outer("neighbours").alias("entry"))
        .withColumn("place", F.row_number().over(best))
        .filter(F.col("place") <= k)
        .groupBy("row_id")
        .agg(F.array_sort(F.collect_list("entry")).alias("neighbours"))
    )


def knn_lists(
    train: DataFrame,
    queries: DataFrame,
    k: int = 5,
    row_id: str = "row_id",
    features: str = "features",
    label: str | None = "label",
    strategy: str = "auto",
    block_numbers: int | None = None,
) -> DataFrame:
    """``row_id, neighbours``: the exact ``k`` nearest train rows of each query, best first.

    Distance ties go to the lower train ``row_id``; a query without a finite distance has an
    empty list. ``strategy`` forces one of ``scan_queries`` (train broadcast), ``scan_train``
    (queries broadcast), ``cells`` or ``grid``; a side that is too large for a broadcast is an error.
    """
    if k < 1:
        raise ValueError("k must be positive")
    t = _side(train, row_id, features, label)
    q = _side(queries, row_id, features, None)
    if strategy in ("auto", "scan_queries", "scan_train"):
        width = max(1, _width(t))
        train_rows, tasks = _extent(t)
        query_rows = _extent(q)[0] if strategy != "scan_queries" else 0
        if strategy == "auto":
            # Partial lists must not outweigh the train side they summarise.
            fits = query_rows * width <= BROADCAST_NUMBERS and query_rows * k * tasks <= train_rows
            strategy = "scan_queries" if train_rows * width <= BROADCAST_NUMBERS else "scan_train" if fits else "cells"
            if width <= NARROW and train_rows * query_rows > SCAN_PAIRS:
                strategy = "cells"
        sent = train_rows if strategy == "scan_queries" else query_rows
        if strategy.startswith("scan") and sent * width > BROADCAST_NUMBERS:
            raise ValueError(f"{sent} rows of width {width} are too many to broadcast for {strategy}")
    if strategy == "scan_queries":
        return _scan_queries(t, q, k)
    if strategy == "scan_train":
        return _scan_train(t, q, k)
    if strategy == "cells":
        train_rows, most = t.count(), max(1, (block_numbers or BLOCK_NUMBERS) // max(1, _width(t)))
        if block_numbers is None:
            most = min(most, max(CELL_ROWS, train_rows // CELLS))
        found = nearest_by_cells(t, q, k, most, _packed, _PACKED, rows=train_rows)
        if found is None:  # no train row can be a neighbour
            return q.select("row_id", F.array().cast(f"array<{_NEIGHBOUR}>").alias("neighbours"))
        return _merge(found, k)
    if strategy == "grid":
        return _grid(t, q, k, block_numbers or BLOCK_NUMBERS)
    raise ValueError(f"unknown strategy {strategy!r}")


def knn_neighbours(train: DataFrame, queries: DataFrame, k: int = 5, **options) -> DataFrame:
    """``row_id, rank, neighbour, distance``: :func:`knn_lists`, one row per neighbour."""
    lists_ = knn_lists(train, queries, k, **options)
    return lists_.select("row_id", F.posexplode("neighbours").alias("pos", "entry")).select(
        "row_id", (F.col("pos") + 1).alias("rank"), "entry.neighbour", "entry.distance"
    )


def knn_classify(train: DataFrame, queries: DataFrame, k: int = 5, **options) -> DataFrame:
    """``row_id, predicted``: uniform vote of the ``k`` nearest; a tied vote takes the smallest label, none gives NULL."""
    labels = F.transform("neighbours", lambda n: n["label"])
    votes = F.transform(
        F.array_distinct(labels),
        lambda value: F.struct(
            F.size(F.filter(labels, lambda other: other == value)).alias("n"), (-value).alias("preference")
        ),
    )
    winner = -F.array_max(votes)["preference"]
    return knn_lists(train, queries, k, **options).select("row_id", winner.alias("predicted"))
