"""Distances within small samples: candidate matrices, mean distances, similar pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectrove.functions.vectors import euclidean, squared_euclidean
from vectrove.operators.centroids import as_matrix
from vectrove.operators.neighbours import point_distances


def row_distances(df: DataFrame, a: str, b: str) -> DataFrame:
    """Add ``distance`` and ``squared`` between two vector columns of one row."""
    return df.withColumn("distance", euclidean(a, b)).withColumn("squared", squared_euclidean(a, b))


def number_candidates(candidates: DataFrame, key: str = "row_id", features: str = "features") -> DataFrame:
    """``cand, row_id, features``: candidates numbered from 0 in ``row_id`` order.

    A candidate set is a parameter-sized table (tens to hundreds of rows), so numbering it
    needs no partitioning.
    """
    place = F.row_number().over(Window.orderBy(key)) - 1
    return candidates.select(place.alias("cand"), F.col(key).alias("row_id"), F.col(features).alias("features"))


def pairwise_distances(candidates: DataFrame) -> DataFrame:
    """``i, j, distance`` for every ordered pair of numbered candidates."""
    points = as_matrix(candidates, "cand", "features")
    measured = point_distances(candidates, points)
    return measured.select(F.col("cand").alias("i"), F.posexplode("distances").alias("j", "distance"))


def mean_distance_to_sample(candidates: DataFrame, sample: DataFrame) -> DataFrame:
    """``cand, mean_distance``: mean distance to all sample rows (a candidate's own 0 counts)."""
    measured = point_distances(sample.select("features"), as_matrix(candidates, "cand", "features"))
    return (
        measured.select(F.posexplode("distances").alias("cand", "distance"))
        .groupBy("cand")
        .agg(F.avg("distance").alias("mean_distance"))
    )


def similar_pairs(means: DataFrame, tolerance: float = 0.05) -> DataFrame:
    """``i, j, mean_i, mean_j``: ordered pairs of candidates with similar mean distance.

    A band join on the mean distance; both sides are candidate-sized and bucketed on the
    logarithm of the mean, so only neighbouring buckets meet.
    """
    if not 0.0 < tolerance < 1.0:
        raise ValueError("tolerance must lie in (0, 1)")
    positive = means.filter(F.col("mean_distance") > 0)
    # |a/b - 1| < t bounds |ln a - ln b| by -ln(1 - t): at most one band apart.
    band = -F.log(F.lit(1.0 - tolerance))
    i = positive.select(
        F.col("cand").alias("i"),
        F.col("mean_distance").alias("mean_i"),
        F.floor(F.log("mean_distance") / band).alias("band"),
    )
    at = F.floor(F.log("mean_distance") / band)
    j = positive.select(
        F.col("cand").alias("j"),
        F.col("mean_distance").alias("mean_j"),
        F.explode(F.array(at - 1, at, at + 1)).alias("band"),
    )
    similar = (F.col("i") != F.col("j")) & (F.abs(F.col("mean_i") / F.col("mean_j") - 1.0) < tolerance)
    return i.join(j, "band").filter(similar).select("i", "j", "mean_i", "mean_j")
