"""Data-driven k-means seeds, chosen among a few candidates judged on a sample.

Sample and candidates are parameter-sized (defaults 1000 and 48 rows) whatever the table
holds; drawing them costs id-only scans (operators/sample.py) and one filtered scan. ``ids``
may hold the row ids where they are cheaper to scan than in the table.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.functions import kernels
from vectrove.operators.centroids import as_matrix, held
from vectrove.operators.distance import (
    mean_distance_to_sample,
    number_candidates,
    pairwise_distances,
    similar_pairs,
)
from vectrove.operators.neighbours import nearest_point, point_distances
from vectrove.operators.sample import draw_key, sample_exact, sample_up_to

SAMPLE_ROWS = 1000
CANDIDATE_ROWS = 48


@dataclass
class Draw:
    """A cached sample, and its numbered candidates as a local relation."""

    sample: DataFrame
    candidates: DataFrame

    def release(self) -> None:
        self.sample.unpersist()


def draw(
    df: DataFrame,
    sample_rows: int | None = None,
    candidate_rows: int | None = None,
    seed: int | str = 0,
    row_id: str = "row_id",
    features: str = "features",
    ids: DataFrame | None = None,
) -> Draw:
    """Sample the table, then the candidates out of the sample.

    Numbers that are given are exact: a table with fewer rows is an error. By default the
    sample has ``SAMPLE_ROWS`` rows and gives ``CANDIDATE_ROWS``, or what there is.
    """
    exact = sample_rows is not None
    sample_rows = sample_rows or max(SAMPLE_ROWS, candidate_rows or 0)
    candidate_rows = candidate_rows or min(CANDIDATE_ROWS, sample_rows)
    if candidate_rows > sample_rows:
        raise ValueError(f"cannot draw {candidate_rows} candidates out of {sample_rows} rows")
    table = df.select(F.col(row_id).alias("row_id"), F.col(features).alias("features"))
    sample = (sample_exact if exact else sample_up_to)(table, sample_rows, seed, ids=ids).persist()
    # The sample has a parameter's number of rows: a plain top-n draws from it in one job.
    drawn = sample.orderBy(draw_key(f"{seed}:candidates"), "row_id").limit(candidate_rows)
    return Draw(sample, held(number_candidates(held(drawn))))


def pair_potentials(candidates: DataFrame, sample: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """``i, j, potential`` of every similar pair: ``|d(i, j) - (mean_i + mean_j) / 2|``."""
    pairs = similar_pairs(held(mean_distance_to_sample(candidates, sample)), tolerance)
    apart = pairwise_distances(candidates)
    middle = (F.col("mean_i") + F.col("mean_j")) / 2
    return pairs.join(apart, ["i", "j"]).select("i", "j", F.abs(F.col("distance") - middle).alias("potential"))


def best_pair(candidates: DataFrame, sample: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """The similar pair of least potential, first in (i, j) order among equals."""
    return pair_potentials(candidates, sample, tolerance).orderBy("potential", "i", "j").limit(1)


def _distances_to(sample: DataFrame, points: np.ndarray) -> np.ndarray:
    """``sample rows x points``; both sides have a parameter's number of rows."""
    columns = point_distances(sample, points).select("distances").toArrow().column("distances")
    return np.array(columns.combine_chunks().flatten()).reshape(-1, len(points))


def _rows(candidates: DataFrame, chosen: list[int]) -> DataFrame:
    """``cluster, row_id, features`` of chosen candidate numbers, in choice order."""
    place = F.array_position(F.array(*[F.lit(c) for c in chosen]), F.col("cand")) - 1
    return candidates.filter(F.col("cand").isin(chosen)).select(place.cast("int").alias("cluster"), "row_id", "features")


def seed_two(
    df: DataFrame,
    sample_rows: int | None = None,
    candidate_rows: int | None = None,
    tolerance: float = 0.05,
    seed: int | str = 0,
    row_id: str = "row_id",
    features: str = "features",
    ids: DataFrame | None = None,
) -> DataFrame:
    """Two seeds ``cluster, row_id, features``; raises when no pair is similar."""
    drawn = draw(df, sample_rows, candidate_rows, seed, row_id, features, ids)
    try:
        # Candidates times sample is a parameter's number of distances: one job brings them.
        points = as_matrix(drawn.candidates, "cand", "features", bounded=True)
        to_sample = _distances_to(drawn.sample, points)
        mean = to_sample.mean(axis=0)
        apart = kernels.distances(points, points, True)
        i, j = np.nonzero(mean[:, None] * mean > 0)
        i, j = i[i != j], j[i != j]
        alike = np.abs(mean[i] / mean[j] - 1.0) < tolerance
        i, j = i[alike], j[alike]
        if not len(i):
            raise ValueError("no two candidates have similar mean distances")
        potential = np.abs(apart[i, j] - (mean[i] + mean[j]) / 2)
        best = np.lexsort((j, i, potential))[0]
        return held(_rows(drawn.candidates, [int(i[best]), int(j[best])]))
    finally:
        drawn.release()


def seed_potential(sample: DataFrame, points, metric: str = "euclidean", features: str = "features") -> DataFrame:
    """``potential``: sum over the sample of the distance to the closest of the points."""
    closest = nearest_point(as_matrix(points), metric == "euclidean", sample.sparkSession)
    return sample.select(closest(F.col(features))["error"].alias("error")).agg(F.sum("error").alias("potential"))


def seed_many(
    df: DataFrame,
    k: int,
    sample_rows: int | None = None,
    candidate_rows: int | None = None,
    seed: int | str = 0,
    row_id: str = "row_id",
    features: str = "features",
    ids: DataFrame | None = None,
) -> DataFrame:
    """``k`` seeds: a drawn row, then per step the candidate of (lower) median potential.

    A candidate's potential counts every seed chosen so far; no row is chosen twice.
    Distances of the sample to all candidates are measured once, in one job. By default
    there are ``CANDIDATE_ROWS`` candidates, or two for each seed if those are more.
    """
    if k < 1:
        raise ValueError("k must be positive")
    if candidate_rows is None:
        candidate_rows = max(CANDIDATE_ROWS, 2 * (k - 1))
    if candidate_rows < k - 1:
        raise ValueError(f"{candidate_rows} candidates cannot give {k} seeds")
    table = df.select(F.col(row_id).alias("row_id"), F.col(features).alias("features"))
    drawn = draw(table, sample_rows, candidate_rows, seed, ids=ids)
    try:
        first = sample_exact(table, 1, f"{seed}:first", ids=ids).first()
        points = as_matrix(drawn.candidates, "cand", "features", bounded=True)
        measured = _distances_to(drawn.sample, np.vstack([np.asarray([first["features"]], dtype=np.float64), points]))
        closest, distances = measured[:, 0], measured[:, 1:]
        open_candidates = {
            row["cand"] for row in drawn.candidates.select("cand", "row_id").collect() if row["row_id"] != first["row_id"]
        }
        chosen: list[int] = []
        for _ in range(k - 1):
            if not open_candidates:
                raise ValueError(f"{len(points)} candidates cannot give {k} seeds")
            potentials = np.minimum(closest[:, None], distances).sum(axis=0)
            ranked = sorted((potentials[c], c) for c in open_candidates)
            median = ranked[(len(ranked) - 1) // 2][1]
            chosen.append(median)
            open_candidates.discard(median)
            closest = np.minimum(closest, distances[:, median])
        spark = df.sparkSession
        opening = spark.createDataFrame(
            [(0, first["row_id"], first["features"])],
            _seed_schema(table),
        )
        if not chosen:
            return opening
        rest = _rows(drawn.candidates, chosen).withColumn("cluster", F.col("cluster") + 1)
        return held(opening.unionByName(rest))
    finally:
        drawn.release()


def _seed_schema(table: DataFrame) -> str:
    return ", ".join(
        ["cluster int"] + [f"{name} {table.schema[name].dataType.simpleString()}" for name in ("row_id", "features")]
    )


def seed_matrix(seeds: DataFrame) -> np.ndarray:
    """Seed rows as a ``k x d`` array."""
    return as_matrix(seeds, "cluster", "features", bounded=True)
