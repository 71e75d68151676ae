"""Principal components: distributed covariance, eigenvectors of one ``d x d`` matrix."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrove.functions.vectors import lists, matrix, row_slices
from vectrove.operators.centroids import local_frame
from vectrove.operators.reduce import CHUNK_SCHEMA, chunks, sum_chunks
from vectrove.operators.sample import sample_exact
from vectrove.operators.stats import feature_partials

# Covariance is formed and decomposed as one matrix; this bounds it to 800 MB.
MAX_WIDTH = 10_000
MODEL_SCHEMA = "component int, loadings array<double>, variance double, ratio double"


@dataclass
class PCAModel:
    """Mean vector, ``k x d`` components (largest loading positive), variances."""

    mean: np.ndarray
    components: np.ndarray
    variance: np.ndarray
    ratio: np.ndarray

    @property
    def k(self) -> int:
        return len(self.components)


def _mean(vectors: DataFrame) -> tuple[int, np.ndarray]:
    table = (
        feature_partials(vectors, features=vectors.columns[0])
        .groupBy("feature")
        .agg(F.sum("n").alias("n"), (F.sum("total") / F.sum("n")).alias("mean"))
        .orderBy("feature")
        .collect()
    )
    return (table[0]["n"] if table else 0), np.array([row["mean"] for row in table])


def _scatter(vectors: DataFrame, mean: np.ndarray) -> np.ndarray:
    """Sum of outer products of centred rows: one partial matrix per task, summed in chunks."""
    width = len(mean)
    shared = vectors.sparkSession.sparkContext.broadcast(mean)

    def run(batches):
        total = None
        for batch in batches:
            x = matrix(batch.column(0), width)
            if total is None and len(x):
                total = np.zeros((width, width))
            for rows in row_slices(len(x), width):
                centred = x[rows] - shared.value
                total += centred.T @ centred
        if total is not None:
            yield from chunks(total)

    try:
        return sum_chunks(vectors.mapInArrow(run, CHUNK_SCHEMA), width * width).reshape(width, width)
    finally:
        shared.unpersist()


def fit_pca(
    df: DataFrame,
    k: int = 20,
    sample: int | None = None,
    seed: int | str = 0,
    features: str = "features",
    row_id: str = "row_id",
    ids: DataFrame | None = None,
) -> PCAModel:
    """Fit on all rows, or on an exact sample of ``sample`` rows (an error if there are fewer).

    ``ids`` as in :func:`vectrove.operators.sample.sample_exact`.
    """
    fitted = df
    if sample is not None:
        fitted = sample_exact(df, sample, seed, row_id, ids)
    vectors = fitted.select(features)
    if sample is not None:
        vectors = vectors.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n, mean = _mean(vectors)
        if n < 2:
            raise ValueError("PCA needs at least two rows")
        if not 1 <= k <= min(len(mean), n):
            raise ValueError(f"cannot take {k} components of {n} rows of width {len(mean)}")
        if len(mean) > MAX_WIDTH:
            raise ValueError(f"PCA of more than {MAX_WIDTH} features")
        covariance = _scatter(vectors, mean) / (n - 1)
    finally:
        if sample is not None:
            vectors.unpersist()
    values, vectors_ = np.linalg.eigh((covariance + covariance.T) / 2)
    order = np.argsort(values)[::-1][:k]
    components = vectors_[:, order].T
    largest = np.argmax(np.abs(components), axis=1)
    components = components * np.sign(components[np.arange(k), largest])[:, None]
    variance = np.maximum(values[order], 0.0)
    whole = float(np.trace(covariance))
    return PCAModel(mean, components, variance, variance / whole if whole else np.zeros(k))


def transform_pca(df: DataFrame, model: PCAModel, features: str = "features") -> DataFrame:
    """Replace features by ``(x - mean) . components^T``: a map, for streams too."""
    shared = df.sparkSession.sparkContext.broadcast((model.mean, model.components))

    @F.arrow_udf("array<double>")
    def project(vectors: pa.Array) -> pa.Array:
        mean, components = shared.value
        x = matrix(vectors, len(mean))
        out = np.empty((len(x), len(components)))
        for rows in row_slices(len(x), len(mean)):
            out[rows] = (x[rows] - mean) @ components.T
        return lists(out)

    return df.withColumn(features, project(F.col(features)))


def project_2d(df: DataFrame, model: PCAModel, label: str = "label", row_id: str = "row_id") -> DataFrame:
    """``row_id, pc1, pc2, label``: the points of a scatter plot."""
    scores = transform_pca(df, model)
    return scores.select(
        row_id, F.get("features", F.lit(0)).alias("pc1"), F.get("features", F.lit(1)).alias("pc2"), label
    )


def pca_frame(spark: SparkSession, model: PCAModel) -> DataFrame:
    """Model table: component -1 holds the mean, 0.. the loadings."""
    rows = [(-1, model.mean.tolist(), None, None)]
    rows += [
        (i, model.components[i].tolist(), float(model.variance[i]), float(model.ratio[i])) for i in range(model.k)
    ]
    return local_frame(spark, rows, MODEL_SCHEMA)


def save_pca(spark: SparkSession, model: PCAModel, path: str) -> None:
    """Write the model table as Parquet."""
    pca_frame(spark, model).coalesce(1).write.mode("overwrite").parquet(path)


def load_pca(spark: SparkSession, path: str) -> PCAModel:
    """Read a model table back."""
    rows = spark.read.parquet(path).orderBy("component").collect()
    if not rows or rows[0]["component"] != -1:
        raise ValueError(f"no PCA model at {path}")
    parts = rows[1:]
    return PCAModel(
        np.array(rows[0]["loadings"]),
        np.array([r["loadings"] for r in parts]),
        np.array([r["variance"] for r in parts]),
        np.array([r["ratio"] for r in parts]),
    )
