"""Vector tables in Parquet, and the training/validation pair."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrove.sources.raw import write_matrix


def read_vectors(
    spark: SparkSession, path: str, row_id: str, features: str, label: str | None = None, features_type: str = "double"
) -> DataFrame:
    """``row_id, features[, label]`` from a Parquet table; only these columns are read."""
    columns = [F.col(row_id).cast("long").alias("row_id"), F.col(features).cast(f"array<{features_type}>").alias("features")]
    if label:
        columns.append(F.col(label).cast("int").alias("label"))
    return spark.read.parquet(path).select(*columns)


def write_dataset(training: DataFrame, validation: DataFrame, path: str, raw: bool = False) -> None:
    """Write both sets of a split below ``path``.

    Parquet tables ``training`` and ``validation``, or with ``raw`` the four matrices
    ``Xtraining, Ytraining, Xvalidation, Yvalidation``, rows in ``row_id`` order.
    """
    for name, df in (("training", training), ("validation", validation)):
        if raw:
            write_matrix(df, f"{path}/X{name}")
            write_matrix(df.withColumn("features", F.array(F.col("label").cast("float"))), f"{path}/Y{name}")
        else:
            df.select("row_id", "features", "label").write.mode("overwrite").parquet(f"{path}/{name}")


def read_dataset(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(training, validation) as written by :func:`write_dataset` in Parquet."""
    return spark.read.parquet(f"{path}/training"), spark.read.parquet(f"{path}/validation")


def write_masked(df: DataFrame, mask, path: str, raw: bool = False, ordered: bool = False) -> None:
    """Write the table with its features projected to a mask."""
    from vectrove.operators.shape import mask_features

    narrow = mask_features(df, mask)
    if raw:
        write_matrix(narrow, path, ordered=ordered)
    else:
        narrow.write.mode("overwrite").parquet(path)
