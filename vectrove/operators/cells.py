"""Exact k nearest neighbours by cells around pivots, when neither side fits a broadcast.

Pivots are drawn from the train side and every train row is dealt to its nearest one. A cell
keeps how many rows it has and the range of their distances to its pivot; a crowded cell is cut
into rings of distance and, where a ring is still crowded (copies), by a hash of the row id,
so no cell exceeds its bound. Cells follow each other in space, and a number of them make a
region. A query goes first to the region of the cell that promises the nearest rows. The
distance of the k-th row it found there, with the triangle inequality, rules out every cell
whose range it cannot meet; it goes on to the regions that have others, once to each, and
searches only those cells there. So where nothing can be ruled out, a row is sent as often as
there are regions, however many the cells.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from vectrove.functions import kernels
from vectrove.functions.vectors import matrix, row_slices
from vectrove.sources.storage import scratch

#: Pivots at most; a pivot's distances to a row cost as much as one train row does.
PIVOTS = 1024
#: Distances are taken as this much wider, relatively, than they were computed.
SLACK = 1e-9
_FAR = -1
#: Tables of a number for each row and cell that are alive at a time; they share the scratch.
_TABLES = 8
#: Numbers of a region's vectors, and of the queries that search it as one group (32 MiB as float64).
REGION_NUMBERS = 4_000_000
#: Regions for each core, if they still have so many numbers.
REGIONS, LEAST_NUMBERS = 2, 131_072
#: Rows of the cells of a region that are searched together, if a cell has fewer: a product of few rows is mostly overhead.
RUN_ROWS = 512
#: Partitions for each group of a search, as a hash may put some into one.
_SPREAD = 3


@dataclass
class Cells:
    """``rows`` is the stored train side with its ``cell``; the arrays describe the cells in order.

    Cell ``c`` lies around ``pivots[pivot[c]]``, its ``count[c]`` rows between ``low[c]`` and
    ``high[c]`` from it. Rows too far for a finite distance are in cells of infinite reach.
    ``held[c]`` is about the number of its rows, for what is no bound.
    """

    rows: DataFrame
    pivots: np.ndarray
    pivot: np.ndarray
    count: np.ndarray
    low: np.ndarray
    high: np.ndarray
    held: np.ndarray

    def part(self, at: slice) -> Cells:
        """Some cells by themselves, without their rows."""
        used, pivot = np.unique(self.pivot[at], return_inverse=True)
        return Cells(None, self.pivots[used], pivot, self.count[at], self.low[at], self.high[at], self.held[at])

    def between(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Least and largest distance that rows of each cell can have to each query."""
        with np.errstate(invalid="ignore", over="ignore"):
            away = kernels.distances(x, self.pivots, True)[:, self.pivot]
            least = np.maximum(np.maximum(away * (1 - SLACK) - self.high, self.low - away * (1 + SLACK)), 0)
            return np.where(np.isinf(self.high), np.where(np.isnan(away), np.nan, 0.0), least), away * (1 + SLACK) + self.high

    def bound(self, most: np.ndarray, k: int) -> np.ndarray:
        """A distance within which each query has ``k`` rows for sure; infinite where the table has fewer."""
        filled = np.flatnonzero(self.count)
        most = np.where(np.isnan(most[:, filled]), np.inf, most[:, filled])
        # Each cell has a row, so the k nearest of them are enough.
        order = np.argpartition(most, k - 1, axis=1)[:, :k] if k < len(filled) else np.tile(np.arange(len(filled)), (len(most), 1))
        order = np.take_along_axis(order, np.argsort(np.take_along_axis(most, order, 1), axis=1), 1)
        if not len(filled):
            return np.full(len(most), np.inf)
        reached = np.cumsum(self.count[filled][order], axis=1) >= k
        place = np.where(reached.any(1), reached.argmax(1), -1)
        found = np.take_along_axis(most, order, 1)[np.arange(len(most)), place]
        return np.where(reached.any(1), found, np.inf)


def draw_pivots(train: DataFrame, n: int) -> np.ndarray:
    """About ``n`` different finite rows, by a hash of their id: one bounded task result."""
    finite = F.forall("features", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v.cast("double")) < float("inf")))
    drawn = train.where(finite).orderBy(F.xxhash64("row_id", F.lit("pivot")), "row_id").limit(n).select("features").toArrow()
    if not drawn.num_rows:
        return np.zeros((0, 0))
    found = np.unique(matrix(drawn.combine_chunks().column("features")), axis=0)
    return found[_along(found, np.arange(len(found)))]


def _along(points: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Positions in an order that has near points close: halves across the axis of widest spread, again and again."""
    if len(at) <= 2:
        return at
    with np.errstate(invalid="ignore", over="ignore"):
        axis = points[at].astype(np.float64).var(axis=0).argmax()
    sides = np.array_split(at[np.argsort(points[at, axis], kind="stable")], 2)
    return np.concatenate([_along(points, side) for side in sides])


def deal_cells(train: DataFrame, pivots: np.ndarray, most: int) -> Cells:
    """Deal ``row_id, features, label`` to cells of at most ``most`` rows or so: a cut by hash is even on average."""
    spark = train.sparkSession
    shared = spark.sparkContext.broadcast(pivots)

    @F.arrow_udf("struct<pivot: int, away: double>")
    def nearest(vectors: pa.Array) -> pa.Array:
        x = matrix(vectors, shared.value.shape[1])
        best, error = np.zeros(len(x), np.int32), np.zeros(len(x))
        with np.errstate(invalid="ignore", over="ignore"):
            for at in row_slices(len(x), _TABLES * len(shared.value)):
                best[at], error[at] = kernels.nearest(x[at], shared.value, True)
        return pa.StructArray.from_arrays([pa.array(best, pa.int32()), pa.array(error)], ["pivot", "away"])

    dealt = train.withColumn("_at", nearest("features")).select("row_id", "features", "label", "_at.pivot", "_at.away")
    path = scratch(spark, "cells")
    # What has a null or NaN component is nobody's neighbour; a distance beyond all numbers has cells of its own.
    sound = F.forall("features", lambda v: v.isNotNull() & ~F.isnan(v))
    limit = float(np.finfo(np.float32).max)
    far = ~(F.col("away") < limit)
    dealt.where(sound).withColumn("pivot", F.when(far, _FAR).otherwise(F.col("pivot"))).write.parquet(path)
    rows = spark.read.schema(dealt.schema).parquet(path)

    ranges = rows.groupBy("pivot").agg(F.count("row_id").alias("n"), F.min("away").alias("low"), F.max("away").alias("high")).toArrow().to_pylist()
    if not ranges:
        return Cells(rows.withColumn("cell", F.lit(0)), pivots, *(np.zeros(0, t) for t in (np.int64, np.int64, float, float, float)))
    rings = spark.createDataFrame([(r["pivot"], *_rings(r, most)) for r in ranges], "pivot int, start double, wide double, rings int")
    cut = F.least(F.floor((F.col("away") - F.col("start")) / F.col("wide")).cast("int"), F.col("rings") - 1)
    ring = F.when(F.col("rings") > 1, F.greatest(cut, F.lit(0))).otherwise(F.lit(0))
    ringed = rows.join(F.broadcast(rings), "pivot").withColumn("ring", ring)  # a row for each pivot
    found = ringed.groupBy("pivot", "ring").agg(F.count("row_id").alias("n"), F.min("away").alias("low"), F.max("away").alias("high"))
    parts = sorted(found.toArrow().to_pylist(), key=lambda r: (r["pivot"], r["ring"]))
    table, first = [], 0
    for r in parts:
        pieces = -(-r["n"] // most)
        table.append((r["pivot"], r["ring"], first, pieces))
        first += pieces
    starts = spark.createDataFrame(table, "pivot int, ring int, first int, pieces int")  # a row for each ring: rows / most of them
    placed = ringed.join(F.broadcast(starts), ["pivot", "ring"])
    cell = F.col("first") + F.pmod(F.xxhash64("row_id"), F.col("pieces")).cast("int")
    every = [(r, p) for r, (_, _, _, pieces) in zip(parts, table, strict=True) for p in range(pieces)]
    far_cells = np.array([r["pivot"] == _FAR for r, _ in every], bool)
    return Cells(
        placed.select("row_id", "features", "label", cell.alias("cell")),
        pivots,
        np.array([max(r["pivot"], 0) for r, _ in every], np.int64),
        # A hash may leave a piece empty, so a cut ring counts once, in its first piece; rows out of reach count for nothing.
        np.array([0 if r["pivot"] == _FAR or p else r["n"] for r, p in every], np.int64),
        np.where(far_cells, 0.0, [r["low"] * (1 - SLACK) if r["pivot"] != _FAR else 0.0 for r, _ in every]),
        np.where(far_cells, np.inf, [r["high"] * (1 + SLACK) if r["pivot"] != _FAR else 0.0 for r, _ in every]),
        np.array([r["n"] / pieces for r, (_, _, _, pieces) in zip(parts, table, strict=True) for _ in range(pieces)]),
    )


def _rings(found: dict, most: int) -> tuple[float, float, int]:
    low, high = found["low"], found["high"]
    n = -(-found["n"] // most)
    if found["pivot"] == _FAR or n <= 1 or not high > low:
        return 0.0, 1.0, 1
    return float(low), float((high - low) / n), int(n)


def deal_regions(cells: Cells, rows: int) -> np.ndarray:
    """The region of each cell: cells that follow each other, of about ``rows`` rows together."""
    before = np.cumsum(cells.held) - cells.held
    return np.unique(before // rows, return_inverse=True)[1].astype(np.int32)


def _region_rows(cells: Cells, width: int, most: int, cores: int) -> int:
    """Rows of a region: as many as are bounded, or fewer if cores would be idle."""
    rows, least = max(1, REGION_NUMBERS // width), max(most, LEAST_NUMBERS // width)
    return min(rows, max(least, math.ceil(cells.held.sum() / (REGIONS * cores))))


def _searched(cells: Cells, region: np.ndarray, visits: DataFrame, k: int, lot: int, packed, schema: str, first: bool) -> DataFrame:
    """Partial lists of ``visits(row_id, features, cell, reach, region)``: groups of one region's rows and at most about ``lot`` queries.

    Of a region, a query searches the cells that can meet its ``reach`` or, with more and more rows
    found, its k-th distance: on its first visit, with a list for every query, from ``cell`` on.
    """
    spark = visits.sparkSession
    load = {r["region"]: -(-r["n"] // lot) for r in visits.groupBy("region").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row for each region
    lots = F.broadcast(spark.createDataFrame([*load.items()], "region int, lots int"))
    table = [(c, int(r), load[r]) for c, r in enumerate(region) if r in load]
    searched = F.broadcast(spark.createDataFrame(table, "cell int, region int, lots int"))  # a row for each cell
    left = cells.rows.join(searched, "cell").withColumn("lot", F.explode(F.sequence(F.lit(0), F.col("lots") - 1)))
    right = visits.join(lots, "region").withColumn("lot", F.pmod(F.xxhash64("row_id"), F.col("lots")).cast("int"))
    shared = spark.sparkContext.broadcast((_light(cells), region))

    def search(key, train: pa.Table, queries: pa.Table) -> pa.Table:
        ids, x = queries.column("row_id").to_numpy(), matrix(queries.column("features"))
        best = kernels.ClosestK(x, k, queries.column("reach").to_numpy() * (1 + SLACK))
        if len(train) and len(ids):
            here, regions = shared.value
            own = slice(*np.searchsorted(regions, [key[0].as_py(), key[0].as_py() + 1]))
            _search_region(best, x, here.part(own), _by_cell(train, own), queries.column("cell").to_numpy() - own.start if first else None)
        found = pa.Table.from_batches([packed(ids, best)])
        return found if first else found.filter(pc.greater(pc.list_value_length(found.column("neighbours")), 0))

    left, right = left.select("row_id", "features", "label", "cell", "region", "lot"), right.select("row_id", "features", "cell", "reach", "region", "lot")
    tasks = _SPREAD * max(1, sum(load.values()))
    left, right = (side.repartition(tasks, "region", "lot").groupBy("region", "lot") for side in (left, right))
    return left.cogroup(right).applyInArrow(search, schema)


def _by_cell(train: pa.Table, own: slice) -> tuple:
    """Vectors, ids and labels of a region in the order of its cells, and where each of these begins."""
    cell = train.column("cell").to_numpy()
    order = np.argsort(cell, kind="stable")
    label = train.column("label").cast(pa.int64()).fill_null(int(kernels.NO_LABEL)).to_numpy()
    starts = np.searchsorted(cell[order], np.arange(own.start, own.stop + 1))
    return matrix(train.column("features"))[order], train.column("row_id").to_numpy()[order], label[order], starts


def _search_region(best: kernels.ClosestK, x: np.ndarray, cells: Cells, rows: tuple, home: np.ndarray | None) -> None:
    """Search the cells of a region, small ones in runs; ``home`` is the cell to begin with."""
    *sides, starts = rows
    firsts, run = np.unique(starts[:-1] // RUN_ROWS, return_index=True, return_inverse=True)[1:]
    ends = np.append(starts[firsts[1:]], starts[-1])
    blocks = [[side[a:b] for side in sides] for a, b in zip(starts[firsts], ends, strict=True)]
    if home is not None:
        own = run[home]
        for r in np.unique(own):
            best.add(*blocks[r], np.flatnonzero(own == r))
    for at in row_slices(len(x), _TABLES * len(cells.count)):
        near = np.fmin.reduceat(cells.between(x[at])[0], firsts, axis=1).T.copy()
        if home is not None:
            near[own[at], np.arange(at.stop - at.start)] = np.nan  # searched
        for r, block in enumerate(blocks):
            if len(block[0]) and len(only := np.flatnonzero(near[r] <= best.reach(at) * (1 + SLACK))):
                best.add(*block, at.start + only)


def first_visits(cells: Cells, queries: DataFrame, k: int) -> DataFrame:
    """``row_id, features, cell, reach``: the cell each query searches first, and a distance within which it has ``k`` rows."""
    shared = queries.sparkSession.sparkContext.broadcast(_light(cells))

    @F.arrow_udf("struct<cell: int, reach: double>")
    def visit(vectors: pa.Array) -> pa.Array:
        here = shared.value
        x = matrix(vectors, here.pivots.shape[1])
        home, reach = np.zeros(len(x), np.int32), np.zeros(len(x))
        for at in row_slices(len(x), _TABLES * max(1, len(here.count))):
            least, most = here.between(x[at])
            rank = np.where(np.isnan(most) | (here.count == 0), np.inf, least + 1e-6 * np.where(np.isfinite(most), most, 0.0))
            home[at], reach[at] = rank.argmin(1), here.bound(most, k)
        return pa.StructArray.from_arrays([pa.array(home), pa.array(reach)], ["cell", "reach"])

    return queries.withColumn("_to", visit("features")).select("row_id", "features", "_to.cell", "_to.reach")


def further_visits(cells: Cells, queries: DataFrame, region: np.ndarray | None = None) -> DataFrame:
    """``row_id, features, cell, reach`` for every other cell that may hold a row within ``reach`` of a query.

    With ``region`` (of each cell, ascending) there is a row with a ``region`` for every other one that
    has such a cell. Lists leave a task some rows at a time, as a list may hold every cell.
    """
    name, region = ("cell", np.arange(len(cells.count))) if region is None else ("region", region)
    shared = queries.sparkSession.sparkContext.broadcast((_light(cells), region))
    queries = queries.select("row_id", "features", "cell", "reach")

    def visit(batches):
        here, of = shared.value
        starts = np.flatnonzero(np.diff(of, prepend=-1))
        for batch in batches:
            x, near = matrix(batch.column("features"), here.pivots.shape[1]), batch.column("reach").to_numpy(zero_copy_only=False)
            first = of[batch.column("cell").to_numpy()]
            for at in row_slices(len(x), _TABLES * max(1, len(here.count))):
                least, _ = here.between(x[at])
                meets = np.logical_or.reduceat(least <= near[at][:, None] * (1 + SLACK), starts, axis=1)
                meets[np.arange(len(meets)), first[at]] = False
                offsets = np.concatenate([[0], np.cumsum(meets.sum(1))]).astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.nonzero(meets)[1], pa.int32()))
                part = batch.slice(at.start, at.stop - at.start)
                yield pa.RecordBatch.from_arrays([part.column("row_id"), part.column("features"), found, part.column("reach")], ["row_id", "features", "to", "reach"])

    schema = queries.select("row_id", "features").schema.add("to", ArrayType(IntegerType())).add("reach", "double")
    return queries.mapInArrow(visit, schema).select("row_id", "features", "reach", F.explode("to").alias(name))


def _light(cells: Cells) -> Cells:
    return Cells(None, cells.pivots, cells.pivot, cells.count, cells.low, cells.high, cells.held)


def nearest_by_cells(train: DataFrame, queries: DataFrame, k: int, most: int, packed, schema: str, n_pivots: int | None = None, rows: int | None = None):
    """Partial lists of all queries by both visits, or None where no train row has a finite vector."""
    rows = train.count() if rows is None else rows
    wanted = n_pivots or int(min(PIVOTS, max(8, 4 * -(-rows // most))))
    pivots = draw_pivots(train, wanted)
    if not len(pivots):
        return None
    spark, width = train.sparkSession, max(1, pivots.shape[1])
    cells = deal_cells(train, pivots, most)
    if not len(cells.count):
        return None
    region = deal_regions(cells, _region_rows(cells, width, most, spark.sparkContext.defaultParallelism))
    lot = max(1, REGION_NUMBERS // max(width, 3 * k))  # a list has three numbers for each neighbour
    path = scratch(spark, "cells")
    homes = first_visits(cells, queries, k)
    homes.write.parquet(path)
    homes = spark.read.schema(homes.schema).parquet(path)
    regions = F.broadcast(spark.createDataFrame([(c, int(r)) for c, r in enumerate(region)], "cell int, region int"))  # a row for each cell
    path = scratch(spark, "cells")
    _searched(cells, region, homes.join(regions, "cell"), k, lot, packed, schema, True).write.parquet(path)
    first = spark.read.schema(schema).parquet(path)
    kth = first.select(F.col("row_id").alias("_id"), F.get("neighbours", F.lit(k - 1))["distance"].alias("_kth"))
    # Ids may repeat among queries: the wider of their bounds holds for each.
    kth = kth.groupBy("_id").agg(F.max(F.coalesce("_kth", F.lit(float("inf")))).alias("_kth"))
    bounded = homes.join(kth, homes["row_id"] == kth["_id"], "left")
    reach = F.when(F.isnan("reach"), F.lit(None).cast("double")).otherwise(F.least("reach", "_kth"))
    bounded = bounded.select("row_id", "features", "cell", F.coalesce(reach, F.lit(-1.0)).alias("reach"))
    if not region[-1]:
        return first
    further = further_visits(cells, bounded, region).withColumn("cell", F.lit(None).cast("int"))
    return first.unionByName(_searched(cells, region, further, k, lot, packed, schema, False))
