"""Row filters and feature shaping: mask, max-abs scaling, rank weights, min-max scaling.

Everything here is a JVM expression over one row: no shuffle, no state, and the row filters
are plain predicates that reach the Parquet scan. Feature positions are 0-based.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vectrove.functions.vectors import as_doubles, double_literal

UNLABELLED = -1


def drop_unlabelled(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows that carry a label (``label <> -1``)."""
    return df.filter(F.col(label) != UNLABELLED)


def labelled_only(df: DataFrame, label: str = "label") -> DataFrame:
    """Rows usable for scoring (``label >= 0``)."""
    return df.filter(F.col(label) >= 0)


def select_class(df: DataFrame, value: int, label: str = "label") -> DataFrame:
    """Rows of one class."""
    return df.filter(F.col(label) == value)


def check_mask(features: Sequence[int]) -> list[int]:
    """A mask is an ordered list of distinct, non-negative feature positions."""
    mask = [int(i) for i in features]
    if not mask:
        raise ValueError("empty feature mask")
    if len(set(mask)) != len(mask):
        raise ValueError("feature mask has duplicate positions")
    if min(mask) < 0:
        raise ValueError("feature positions start at 0")
    return mask


# Up to so many features, a row's array is built element by element in generated code.
UNROLLED = 256


def _shaped(
    features: Column, mask: Sequence[int] | None, scale: Sequence[float] | None, weights: Sequence[float] | None
) -> Column:
    """Mask, then scale, then weight; a vector of another width than they say is an error."""
    size = max(mask) + 1 if mask is not None else len(scale if scale is not None else weights)
    places = list(mask) if mask is not None else list(range(size))
    scale, weights = (None if v is None else [float(x) for x in v] for v in (scale, weights))
    for values in (scale, weights):
        if values is not None and len(values) != len(places):
            raise ValueError(f"{len(values)} numbers for {len(places)} features")
    right = F.size(features) >= size if mask is not None else F.size(features) == size
    if len(places) <= UNROLLED:
        elements = []
        for at, place in enumerate(places):
            x = F.get(features, F.lit(place))
            if scale is not None:
                x = x.cast("double") / F.lit(scale[at]) if scale[at] != 0.0 else F.lit(0.0)
            if weights is not None:
                x = x.cast("double") * F.lit(weights[at])
            elements.append(x)
        shaped = F.array(*elements)
    else:
        shaped = features if mask is None else F.transform(F.array(*[F.lit(i) for i in places]), lambda i: F.get(features, i))
        if scale is not None:
            shaped = F.zip_with(shaped.cast("array<double>"), double_literal(scale), _ratio)
        if weights is not None:
            shaped = F.zip_with(shaped.cast("array<double>"), double_literal(weights), lambda x, w: x * w)
    said = "has another width than its scale or weights" if mask is None else "is shorter than its mask: it reaches past the end"
    wrong = F.raise_error(F.lit(f"a feature vector {said}"))
    return F.when(features.isNull() | right, F.when(features.isNotNull(), shaped)).otherwise(wrong)


def _ratio(value: Column, scale: Column) -> Column:
    return F.when(scale == 0.0, F.lit(0.0)).otherwise(value / scale)


def mask_features(df: DataFrame, mask: Sequence[int], features: str = "features") -> DataFrame:
    """Project features to the mask; output order is mask order."""
    return df.withColumn(features, _shaped(F.col(features), check_mask(mask), None, None))


def scale_max_abs(df: DataFrame, scale: Sequence[float], features: str = "features") -> DataFrame:
    """Divide each feature by its maximum absolute value; x/0 is 0."""
    return df.withColumn(features, _shaped(F.col(features), None, scale, None))


def weight_features(df: DataFrame, weights: Sequence[float], features: str = "features") -> DataFrame:
    """Multiply each feature by its weight."""
    return df.withColumn(features, _shaped(F.col(features), None, None, weights))


def shape_features(
    df: DataFrame,
    mask: Sequence[int],
    scale: Sequence[float] | None = None,
    weights: Sequence[float] | None = None,
    features: str = "features",
) -> DataFrame:
    """Mask, scale and weight in one projection.

    Plain Euclidean distance on the result equals the masked, scaled, weighted distance on
    the input, so shape once and cluster the narrow table.
    """
    return df.withColumn(features, _shaped(F.col(features), check_mask(mask), scale, weights).cast("array<double>"))


def rank_weights(mask: DataFrame, rank: str = "rank") -> DataFrame:
    """Add ``weight = log10(m / rank)`` to a mask table with ranks ``1..m``."""
    size = mask.agg(F.count(F.lit(1)).alias("mask_size"))
    # One row on the right: the size of the mask table.
    return mask.join(F.broadcast(size)).select(
        *[F.col(c) for c in mask.columns],
        F.log10(F.col("mask_size") / F.col(rank)).alias("weight"),
    )


def scale_min_max(
    df: DataFrame,
    minimum: Sequence[float],
    maximum: Sequence[float],
    features: str = "features",
) -> DataFrame:
    """``(x - min) / (max - min)`` with limits fitted elsewhere; a constant feature only shifts.

    Rows outside the fitted limits leave [0, 1], as they must: the limits come from a sample.
    """
    limits = [(float(lo), float(hi - lo) if hi != lo else 1.0) for lo, hi in zip(minimum, maximum, strict=True)]
    x = F.col(features)
    if len(limits) <= UNROLLED:
        scaled = F.array(*[(F.get(x, F.lit(i)).cast("double") - F.lit(lo)) / F.lit(span) for i, (lo, span) in enumerate(limits)])
    else:
        shifted = F.zip_with(as_doubles(features), double_literal([lo for lo, _ in limits]), lambda x, lo: x - lo)
        scaled = F.zip_with(shifted, double_literal([span for _, span in limits]), lambda x, span: x / span)
    wrong = F.raise_error(F.lit("a feature vector has another width than the limits"))
    right = F.size(x) == len(limits)
    return df.withColumn(features, F.when(x.isNull() | right, F.when(x.isNotNull(), scaled)).otherwise(wrong))
