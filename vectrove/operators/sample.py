"""Exact, deterministic sampling and splitting by hash order.

A row's place in the draw is ``(md5(seed:row_id), row_id)``. A draw of *n* rows is the *n*
smallest places. The cut-off place is found from a histogram of hash prefixes (a map-side
combined count) plus a sort of ids inside one bucket, so feature vectors are never shuffled:
the sample and its complement are plain filters on the input.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Ids sorted to place the cut inside one hash bucket; larger buckets are refined first.
BUCKET_ROWS = 100_000
_DIGITS = 3


def draw_key(seed: int | str, row_id: str = "row_id") -> Column:
    """Hash that orders the draw."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(row_id).cast("string")).cast("binary"))


@dataclass(frozen=True)
class Cut:
    """Last place inside the draw; ``None`` draws nothing."""

    key: str | None
    row_id: int | None

    def inside(self, key: Column, row_id: Column) -> Column:
        if self.key is None:
            return F.lit(False)
        return (key < self.key) | ((key == self.key) & (row_id <= F.lit(self.row_id)))


def find_cut(df: DataFrame, seed: int | str, size, row_id: str = "row_id") -> Cut:
    """Place of the last drawn row. ``size`` is a count, or a function of the row count."""
    places = df.select(draw_key(seed, row_id).alias("key"), F.col(row_id).alias("id"))
    prefix, remaining = "", None
    while True:
        digits = len(prefix) + _DIGITS
        bucket = F.substring("key", 1, digits)
        inside = places.filter(F.col("key").startswith(prefix)) if prefix else places
        counts = sorted(
            (row["bucket"], row["n"])
            for row in inside.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n")).collect()
        )
        if remaining is None:
            total = sum(n for _, n in counts)
            remaining = size(total) if callable(size) else int(size)
            if remaining < 0:
                raise ValueError("sample size is negative")
            if remaining > total:
                raise ValueError(f"cannot draw {remaining} distinct rows out of {total}")
            if remaining == 0:
                return Cut(None, None)
        for name, n in counts:
            if remaining <= n:
                prefix, held = name, n
                break
            remaining -= n
        if held <= BUCKET_ROWS or len(prefix) >= 32:
            break
    bucket = places.filter(F.col("key").startswith(prefix))
    last = bucket.orderBy("key", "id").limit(remaining).agg(F.max(F.struct("key", "id")).alias("place")).first()["place"]
    cut = Cut(last["key"], last["id"])
    if held > remaining:
        drawn = bucket.filter(cut.inside(F.col("key"), F.col("id"))).count()
        if drawn != remaining:
            raise ValueError(f"row id {cut.row_id} repeats: the draw would hold {drawn - remaining} rows too many")
    return cut


def sample_exact(
    df: DataFrame, n: int, seed: int | str, row_id: str = "row_id", ids: DataFrame | None = None
) -> DataFrame:
    """Exactly ``n`` distinct rows, uniform over seeds; raises when the table is smaller.

    Rows of one id share their place; a draw that would have to part them is an error.

    ``ids`` may hold the same row ids where they are cheaper to scan: Parquet reads the id
    column alone, but a raw matrix is read whole, and its label vector is not.
    """
    cut = find_cut(df if ids is None else ids, seed, n, row_id)
    return df.filter(cut.inside(draw_key(seed, row_id), F.col(row_id)))


def sample_up_to(
    df: DataFrame, n: int, seed: int | str, row_id: str = "row_id", ids: DataFrame | None = None
) -> DataFrame:
    """:func:`sample_exact`, or every row of a table that has fewer than ``n``."""
    cut = find_cut(df if ids is None else ids, seed, lambda total: min(n, total), row_id)
    return df.filter(cut.inside(draw_key(seed, row_id), F.col(row_id)))


def sample_candidates(sample: DataFrame, m: int, seed: int | str, row_id: str = "row_id") -> DataFrame:
    """``m`` distinct rows out of a sample, drawn with a seed of their own."""
    return sample_exact(sample, m, f"{seed}:candidates", row_id)


def sample_block(df: DataFrame, n: int, start: int, row_id: str = "row_id") -> DataFrame:
    """``n`` consecutive rows from position ``start``: a range filter the scan can use."""
    return df.filter(F.col(row_id).between(start, start + n - 1))


def random_block(df: DataFrame, n: int, seed: int | str, row_id: str = "row_id") -> DataFrame:
    """A block of ``n`` consecutive rows whose start is drawn in ``[first, last - n + 1]``."""
    low, high = df.agg(F.min(row_id), F.max(row_id)).first()
    if low is None or high - low + 1 < n:
        raise ValueError(f"table has fewer than {n} consecutive row ids")
    from random import Random

    start = Random(str(seed)).randint(low, high - n + 1)
    return sample_block(df, n, start, row_id)


def train_validation_split(
    df: DataFrame,
    proportion: float = 0.1,
    seed: int | str = 0,
    row_id: str = "row_id",
    ids: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(training, validation): validation holds exactly ``int(N * proportion)`` rows.

    Both sides are filters over ``df``; together they hold every row once. ``ids`` as in
    :func:`sample_exact`.
    """
    if not 0.0 <= proportion <= 1.0:
        raise ValueError("proportion must lie in [0, 1]")
    cut = find_cut(df if ids is None else ids, seed, lambda total: int(total * proportion), row_id)
    drawn = cut.inside(draw_key(seed, row_id), F.col(row_id))
    return df.filter(~drawn), df.filter(drawn)


def with_set(df: DataFrame, proportion: float = 0.1, seed: int | str = 0, row_id: str = "row_id") -> DataFrame:
    """Both sides of the split in one scan, told apart by a column ``set``."""
    cut = find_cut(df, seed, lambda total: int(total * proportion), row_id)
    drawn = cut.inside(draw_key(seed, row_id), F.col(row_id))
    return df.withColumn("set", F.when(drawn, F.lit("validation")).otherwise(F.lit("training")))
