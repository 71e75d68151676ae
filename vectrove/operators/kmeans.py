"""K-means by full passes over the table.

A pass is one job: tasks assign their rows against broadcast means and fold them into one
partial per (cluster, feature); Spark sums the partials by (cluster, feature), spread over
the reducers, and ``k * d`` numbers come back to the driver. Rows are never shuffled, a
cluster that holds most rows costs no more than a small one, and no lineage builds up:
every pass starts from the input again.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.functions import kernels
from vectrove.functions.vectors import matrix
from vectrove.operators.centroids import as_matrix, centroid_frame, local_frame
from vectrove.operators.neighbours import assign_clusters
from vectrove.operators.reduce import cached, is_held
from vectrove.operators.seeding import seed_many, seed_matrix, seed_two
from vectrove.operators.stats import feature_partials

HISTORY_SCHEMA = "iteration int, mean_error double, delta double, seconds double"
_PARTIAL = "cluster int, feature int, n long, error double, total double"


@dataclass
class KMeansResult:
    """What a run leaves: lazy assignments, small tables, and the last means."""

    assignments: DataFrame  # input columns + cluster, error (against the means before the last update)
    centroids: DataFrame  # cluster, centroid (after the last update)
    sizes: DataFrame  # cluster, n
    history: DataFrame  # iteration, mean_error, delta, seconds
    iterations: int


def _initial(df, k, init, seed, row_id, features, ids=None, sample_rows=None, candidate_rows=None) -> np.ndarray:
    if init is None:
        options = {"seed": seed, "row_id": row_id, "features": features, "ids": ids}
        options |= {"sample_rows": sample_rows, "candidate_rows": candidate_rows}
        return seed_matrix(seed_two(df, **options) if k == 2 else seed_many(df, k, **options))
    if isinstance(init, DataFrame):
        vector = "centroid" if "centroid" in init.columns else "features"
        init = as_matrix(init, "cluster", vector)
    means = as_matrix(init)
    if k is not None and len(means) != k:
        raise ValueError(f"{len(means)} initial centroids for k={k}")
    return means


def _sizes_frame(spark, sizes) -> DataFrame:
    return local_frame(spark, [(i, int(n)) for i, n in enumerate(sizes)], "cluster int, n bigint")


def partial_sums(vectors: DataFrame, groups: int, width: int, fold: Callable) -> DataFrame:
    """Run ``fold(x, sums)`` over the batches of a task; emit one partial per group and feature."""

    def run(batches):
        sums = kernels.ClusterSums(groups, width)
        for batch in batches:
            x = matrix(batch.column(0), width)
            if len(x):
                fold(x, sums)
        for group in np.flatnonzero(sums.sizes):
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(width, group, dtype=np.int32)),
                    pa.array(np.arange(width, dtype=np.int32)),
                    pa.array(np.full(width, sums.sizes[group])),
                    pa.array(np.full(width, sums.errors[group])),
                    pa.array(sums.totals[group]),
                ],
                ["cluster", "feature", "n", "error", "total"],
            )

    return vectors.mapInArrow(run, _PARTIAL)


def _gather(partials: DataFrame, k: int, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sizes, error sums and column sums per cluster: ``k * d`` rows reach the driver."""
    table = (
        partials.groupBy("cluster", "feature")
        .agg(F.sum("n").alias("n"), F.sum("error").alias("error"), F.sum("total").alias("total"))
        .toArrow()
    )
    cluster = table.column("cluster").to_numpy()
    feature = table.column("feature").to_numpy()
    sizes = np.zeros(k, dtype=np.int64)
    errors, totals = np.zeros(k), np.zeros((k, width))
    sizes[cluster] = table.column("n").to_numpy()
    errors[cluster] = table.column("error").to_numpy()
    totals[cluster, feature] = table.column("total").to_numpy()
    return sizes, errors, totals


def lloyd_pass(vectors: DataFrame, means: np.ndarray, metric: str = "euclidean"):
    """One assign-and-sum job over a one-column vector table."""
    shared = vectors.sparkSession.sparkContext.broadcast(means)
    rooted = metric == "euclidean"

    def fold(x, sums):
        kernels.assign_and_sum(x, shared.value, rooted, sums)

    try:
        return _gather(partial_sums(vectors, *means.shape, fold), *means.shape)
    finally:
        shared.unpersist()


def update_centroids(assigned: DataFrame, features: str = "features", cluster: str = "cluster") -> DataFrame:
    """``cluster, feature, mean, n``: means and cardinalities of an assigned table."""
    partials = feature_partials(assigned.where(F.col(cluster).isNotNull()), cluster, features)
    return partials.groupBy(F.col("grp").cast("int").alias("cluster"), "feature").agg(
        (F.sum("total") / F.sum("n")).alias("mean"), F.sum("n").alias("n")
    )


def cluster_sizes(assigned: DataFrame, cluster: str = "cluster") -> DataFrame:
    """``cluster, n``: rows per cluster, for any number of clusters."""
    return assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"))


def kmeans(
    df: DataFrame,
    k: int,
    max_iter: int = 20,
    min_delta: float = 0.1,
    init=None,
    metric: str = "euclidean",
    seed: int | str = 0,
    cache: bool = True,
    features: str = "features",
    row_id: str = "row_id",
    ids: DataFrame | None = None,
    sample_rows: int | None = None,
    candidate_rows: int | None = None,
) -> KMeansResult:
    """Cluster until the mean error moves by at most ``min_delta`` or ``max_iter`` passes ran.

    At least one pass runs. Seeds come from ``init`` (array, or DataFrame ``cluster,
    centroid|features``), else from :func:`seed_two` / :func:`seed_many` (``ids``, ``sample_rows``, ``candidate_rows`` as there). An empty cluster
    loses its mean and is never chosen again. The input's vectors are cached on memory and
    disk for the passes unless ``df`` is cached already; ``cache=False`` rescans them, for inputs beyond the executors' disks.
    """
    spark = df.sparkSession
    vectors = df.select(features)
    cache = cache and not (is_held(df) or is_held(vectors))
    # Seeds are drawn from the cached rows: the input is scanned once.
    rows = df.select(*dict.fromkeys([features] if init is not None else [row_id, features]))
    source = cached(rows) if cache else rows
    history, previous = [], None
    try:
        means = _initial(df if is_held(df) else source, k, init, seed, row_id, features, ids, sample_rows, candidate_rows)
        if cache:
            vectors = source.select(features)
        for iteration in range(max(1, max_iter)):
            started = time.monotonic()
            used = means
            sizes, errors, totals = lloyd_pass(vectors, used, metric)
            rows = int(sizes.sum())
            if rows == 0:
                raise ValueError("k-means over an empty table")
            with np.errstate(invalid="ignore", divide="ignore"):
                means = totals / sizes[:, None]
            mean_error = float(errors.sum() / rows)
            delta = None if previous is None else abs(previous - mean_error)
            previous = mean_error
            history.append((iteration, mean_error, delta, time.monotonic() - started))
            if delta is not None and delta <= min_delta:
                break
    finally:
        if cache:
            source.unpersist()
    return KMeansResult(
        assignments=assign_clusters(df, used, metric, features, row_id),
        centroids=centroid_frame(spark, means),
        sizes=_sizes_frame(spark, sizes),
        history=local_frame(spark, history, HISTORY_SCHEMA),
        iterations=len(history),
    )


def _replay(x: np.ndarray, past: list[np.ndarray], freeze: float):
    """State of rows after the recorded passes: cluster, error, pass that froze the row (-1: none).

    A row's state depends only on the means of past passes, so tasks hold none and a lost
    executor loses none.
    """
    cluster = np.zeros(len(x), dtype=np.int32)
    error = np.zeros(len(x))
    frozen_at = np.full(len(x), -1)
    open_rows = np.arange(len(x))
    for step, means in enumerate(past):
        if not len(open_rows):
            break
        cluster[open_rows], error[open_rows] = kernels.nearest(x[open_rows], means, rooted=False)
        freezing = error[open_rows] < freeze
        frozen_at[open_rows[freezing]] = step
        open_rows = open_rows[~freezing]
    return cluster, error, frozen_at


def kmeans_freezing(
    df: DataFrame,
    init,
    max_iter: int = 20,
    freeze: float = 5_000_000.0,
    min_delta: float = 50_000.0,
    cache: bool = True,
    features: str = "features",
) -> KMeansResult:
    """K-means whose rows settle: once a row's squared error is below ``freeze`` it stays put.

    Settled rows (and the seed, once more) make up the means; their last error keeps counting
    towards the mean error. ``sizes`` counts all rows by their last cluster.
    """
    spark = df.sparkSession
    seeds = _initial(df, None, init, None, None, features)
    k, width = seeds.shape
    vectors = df.select(features)
    cache = cache and not (is_held(df) or is_held(vectors))
    if cache:
        vectors = cached(vectors)
    settled_n, settled_sum = np.ones(k), seeds.copy()
    past, history, previous = [seeds], [], None
    try:
        for iteration in range(max(1, max_iter)):
            started = time.monotonic()
            shared = spark.sparkContext.broadcast(past)

            def fold(x, sums, shared=shared, last=len(past) - 1):
                cluster, error, frozen_at = _replay(x, shared.value, freeze)
                # Even groups: rows that froze in this pass. Odd groups: the others, whose
                # vectors do not enter the means but whose errors count.
                sums.add(cluster * 2 + (frozen_at != last), error, x)

            sizes, errors, totals = _gather(partial_sums(vectors, 2 * k, width, fold), 2 * k, width)
            shared.unpersist()
            rows = int(sizes.sum())
            if rows == 0:
                raise ValueError("k-means over an empty table")
            settled_n = settled_n + sizes[0::2]
            settled_sum = settled_sum + totals[0::2]
            used = list(past)
            past.append(settled_sum / settled_n[:, None])
            mean_error = float(errors.sum() / rows)
            delta = None if previous is None else abs(previous - mean_error)
            previous = mean_error
            history.append((iteration, mean_error, delta, time.monotonic() - started))
            if delta is not None and delta <= min_delta:
                break
    finally:
        if cache:
            vectors.unpersist()

    replayed = spark.sparkContext.broadcast(used)

    @F.arrow_udf("struct<cluster: int, error: double, frozen: boolean>")
    def state(column: pa.Array) -> pa.Array:
        cluster, error, frozen_at = _replay(matrix(column, width), replayed.value, freeze)
        return pa.StructArray.from_arrays(
            [pa.array(cluster, pa.int32()), pa.array(error), pa.array(frozen_at >= 0)], ["cluster", "error", "frozen"]
        )

    assignments = df.withColumn("_state", state(F.col(features))).select(
        *[F.col(c) for c in df.columns], "_state.cluster", "_state.error", "_state.frozen"
    )
    by_cluster = sizes[0::2] + sizes[1::2]
    return KMeansResult(
        assignments=assignments,
        centroids=centroid_frame(spark, past[-1]),
        sizes=_sizes_frame(spark, by_cluster),
        history=local_frame(spark, history, HISTORY_SCHEMA),
        iterations=len(history),
    )
