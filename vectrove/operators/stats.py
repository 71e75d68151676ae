"""Per-feature statistics over wide vectors.

Each task folds its rows into one partial per (group, feature) -- count, sum, squared
deviations around the task's own mean, extrema -- and only those partials are shuffled, by
(group, feature). Shuffle volume is tasks x groups x width whatever the row count, a hot
group is already folded before it moves, and rows are never exploded.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectrove.functions.vectors import matrix, row_slices

_PARTIAL = "feature int, n long, total double, m2 double, low double, high double"
# Accumulators one task keeps before it emits its partials and starts again, so that many
# groups cannot exhaust a worker.
_HELD_ELEMENTS = 8_000_000


class _Fold:
    """Running count, mean, squared deviations and extrema of one group (Chan's update)."""

    __slots__ = ("n", "mean", "m2", "low", "high")

    def __init__(self, width: int):
        self.n = 0
        self.mean = np.zeros(width)
        self.m2 = np.zeros(width)
        self.low = np.full(width, np.inf)
        self.high = np.full(width, -np.inf)

    def add(self, x: np.ndarray) -> None:
        n = len(x)
        mean = x.mean(axis=0)
        centred = x - mean
        shift = mean - self.mean
        merged = self.n + n
        self.m2 += np.einsum("ij,ij->j", centred, centred) + shift * shift * (self.n * n / merged)
        self.mean += shift * (n / merged)
        self.n = merged
        np.minimum(self.low, x.min(axis=0), out=self.low)
        np.maximum(self.high, x.max(axis=0), out=self.high)


def feature_partials(df: DataFrame, by: str | None = None, features: str = "features") -> DataFrame:
    """One row per task, group and feature; merge with ordinary aggregates."""
    keyed = by is not None
    source = df.select(*([F.col(by).cast("long").alias("grp")] if keyed else []), F.col(features).alias("v"))

    def emit(folds):
        for group, fold in folds.items():
            width = len(fold.mean)
            columns = [
                pa.array(np.arange(width, dtype=np.int32)),
                pa.array(np.full(width, fold.n, dtype=np.int64)),
                pa.array(fold.mean * fold.n),
                pa.array(fold.m2),
                pa.array(fold.low),
                pa.array(fold.high),
            ]
            names = ["feature", "n", "total", "m2", "low", "high"]
            if keyed:
                columns.insert(0, pa.array([group] * width, pa.int64()))
                names.insert(0, "grp")
            yield pa.RecordBatch.from_arrays(columns, names)

    def fold_rows(batches):
        folds: dict = {}
        for batch in batches:
            x = matrix(batch.column("v"))
            if not len(x):
                continue
            groups = batch.column("grp") if keyed else None
            for rows in row_slices(len(x), 8 * x.shape[1]):
                block = x[rows].astype(np.float64, copy=False)
                if not keyed:
                    parts = [(None, block)]
                else:
                    keys = groups.slice(rows.start, rows.stop - rows.start)
                    codes = keys.dictionary_encode(null_encoding="encode")
                    index = codes.indices.to_numpy()
                    order = np.argsort(index, kind="stable")
                    cuts = np.flatnonzero(np.diff(index[order])) + 1
                    names = codes.dictionary.to_pylist()
                    parts = [(names[index[p[0]]], block[p]) for p in np.split(order, cuts)]
                for group, part in parts:
                    fold = folds.get(group)
                    if fold is None:
                        fold = folds[group] = _Fold(part.shape[1])
                    elif len(fold.mean) != part.shape[1]:
                        raise ValueError("vectors of different widths")
                    fold.add(part)
                if len(folds) * x.shape[1] > _HELD_ELEMENTS:
                    yield from emit(folds)
                    folds = {}
        yield from emit(folds)

    return source.mapInArrow(fold_rows, ("grp long, " if keyed else "") + _PARTIAL)


def feature_summary(df: DataFrame, by: str | None = None, features: str = "features") -> DataFrame:
    """``[by,] feature, n, mean, sd, min, max`` with the population deviation, in one scan.

    Deviations are merged around the overall mean, which a window over the (small) partials
    provides, so no large squares cancel; one shuffle serves the window and the aggregate.
    """
    keys = (["grp"] if by else []) + ["feature"]
    over = Window.partitionBy(*keys)
    centre = F.sum("total").over(over) / F.sum("n").over(over)
    merged = (
        feature_partials(df, by, features)
        .withColumn("centre", centre)
        .withColumn("shift", F.col("total") / F.col("n") - F.col("centre"))
        .groupBy(*keys)
        .agg(
            F.sum("n").alias("n"),
            F.first("centre").alias("mean"),
            F.sum(F.col("m2") + F.col("n") * F.col("shift") * F.col("shift")).alias("m2"),
            F.min("low").alias("min"),
            F.max("high").alias("max"),
        )
    )
    return merged.select(
        *([F.col("grp").cast(df.schema[by].dataType).alias(by)] if by else []),
        "feature",
        "n",
        "mean",
        F.sqrt(F.col("m2") / F.col("n")).alias("sd"),
        "min",
        "max",
    )


def class_mean_vectors(df: DataFrame, label: str = "label", features: str = "features") -> DataFrame:
    """``label, feature, mean``: mean of each feature per class."""
    return (
        feature_partials(df, label, features)
        .groupBy("grp", "feature")
        .agg((F.sum("total") / F.sum("n")).alias("mean"))
        .select(F.col("grp").cast(df.schema[label].dataType).alias(label), "feature", "mean")
    )


def feature_min_max(df: DataFrame, clamp_zero: bool = True, features: str = "features") -> DataFrame:
    """``feature, min, max`` over all rows. Extrema start at 0 unless ``clamp_zero=False``."""
    low, high = F.min("low"), F.max("high")
    if clamp_zero:
        low, high = F.least(low, F.lit(0.0)), F.greatest(high, F.lit(0.0))
    return feature_partials(df, None, features).groupBy("feature").agg(low.alias("min"), high.alias("max"))


def class_contrast_report(
    df: DataFrame,
    classes: Sequence[int] = (0, 1),
    label: str = "label",
    features: str = "features",
    decimals: int = 6,
) -> DataFrame:
    """Per feature: mean in both classes, their absolute difference, clamped min and max.

    One scan and one shuffle: the per-class partials also carry the overall extrema.
    """
    first, second = classes

    def class_mean(value: int):
        inside = F.col("grp") == value
        return F.sum(F.when(inside, F.col("total"))) / F.sum(F.when(inside, F.col("n")))

    merged = (
        feature_partials(df, label, features)
        .groupBy("feature")
        .agg(
            class_mean(first).alias("mean_0"),
            class_mean(second).alias("mean_1"),
            F.least(F.min("low"), F.lit(0.0)).alias("min"),
            F.greatest(F.max("high"), F.lit(0.0)).alias("max"),
        )
    )
    difference = F.abs(F.col("mean_0") - F.col("mean_1"))
    return merged.select(
        "feature",
        F.round("mean_0", decimals).alias("mean_0"),
        F.round("mean_1", decimals).alias("mean_1"),
        F.round(difference, decimals).alias("difference"),
        F.round("min", decimals).alias("min"),
        F.round("max", decimals).alias("max"),
    )


def _max_abs():
    return F.greatest(F.abs(F.col("min")), F.abs(F.col("max")))


def feature_max_abs(df: DataFrame, features: str = "features") -> DataFrame:
    """``feature, max_abs``."""
    extrema = feature_min_max(df, clamp_zero=False, features=features)
    return extrema.select("feature", _max_abs().alias("max_abs"))


def feature_mean_sd(df: DataFrame, as_written: bool = False, features: str = "features") -> DataFrame:
    """``feature, max_abs, mean, sd`` of ``x / max|x|``; a feature that is 0 throughout has 0, 0.

    Scaling is linear, so one scan of the raw features is enough. ``as_written`` gives the
    spread of ``mean - x / max|x| / n`` around 0, kept for study.
    """
    scale = F.when(F.col("max_abs") == 0.0, F.lit(1.0)).otherwise(F.col("max_abs"))
    scaled = (
        feature_summary(df, None, features)
        .withColumn("max_abs", _max_abs())
        .withColumn("mean", F.col("mean") / scale)
        .withColumn("sd", F.col("sd") / scale)
    )
    if as_written:
        n, mean, sd = F.col("n"), F.col("mean"), F.col("sd")
        square = mean * mean * (F.lit(1.0) - F.lit(2.0) / n) + (sd * sd + mean * mean) / (n * n)
        scaled = scaled.withColumn("sd", F.sqrt(square))
    return scaled.select("feature", "max_abs", "mean", "sd")


def top_features_by_sd(df: DataFrame, m: int, features: str = "features") -> DataFrame:
    """Mask table ``rank, feature, scale, sd``: the ``m`` features of largest scaled deviation."""
    top = feature_mean_sd(df, features=features).orderBy(F.desc("sd"), "feature").limit(m)
    # m rows: ranking them needs no partitioning.
    rank = F.row_number().over(Window.orderBy(F.desc("sd"), "feature"))
    return top.select(rank.alias("rank"), "feature", F.col("max_abs").alias("scale"), "sd")


def low_mean_features(df: DataFrame, sample: DataFrame, m: int = 128, features: str = "features") -> DataFrame:
    """``feature, mean``: the ``m`` features of lowest mean after min-max scaling by ``sample``.

    The mean of a scaled feature is the scaled mean, so rows are not rewritten.
    """
    limits = feature_summary(sample, None, features).select("feature", F.col("min").alias("lo"), F.col("max").alias("hi"))
    span = F.when(F.col("hi") == F.col("lo"), F.lit(1.0)).otherwise(F.col("hi") - F.col("lo"))
    means = feature_partials(df, None, features).groupBy("feature").agg((F.sum("total") / F.sum("n")).alias("raw"))
    return (
        means.join(limits, "feature")
        .select("feature", ((F.col("raw") - F.col("lo")) / span).alias("mean"))
        .orderBy("mean", "feature")
        .limit(m)
    )


def feature_values(table: DataFrame, value: str, order: str = "feature") -> list[float]:
    """One column of a per-feature table as a list in feature order (width-sized, for shaping)."""
    return [row[0] for row in table.orderBy(order).select(value).collect()]
