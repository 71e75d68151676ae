"""Scores of clusterings and classifiers.

The data is read once, into counts of (truth, prediction) or (cluster, label) pairs with
map-side combining; every score is arithmetic on those few rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.operators.centroids import local_frame, lookup

TERNARY = (-1, 0, 1)


def _pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.groupBy(F.col(a).cast("int").alias("a"), F.col(b).cast("int").alias("b")).agg(
        F.count(F.lit(1)).alias("n")
    )


def majority_label(
    assigned: DataFrame,
    k: int | None = None,
    labels: Sequence[int] | None = None,
    cluster: str = "cluster",
    label: str = "label",
) -> DataFrame:
    """``cluster, majority``: most frequent label (unlabelled counts), ties to the smallest.

    Every label counts unless ``labels`` names those that do. With ``k`` given, clusters
    ``0..k-1`` all appear; one without rows gets the first of ``labels``, -1 by default.
    """
    counted = assigned.filter(F.col(label).isNotNull() if labels is None else F.col(label).isin(list(labels)))
    counts = _pairs(counted, cluster, label)
    best = counts.groupBy("a").agg(F.max(F.struct("n", (-F.col("b")).alias("preference"))).alias("best"))
    voted = best.select(F.col("a").alias("cluster"), (-F.col("best.preference")).alias("majority"))
    if k is None:
        return voted
    ids = assigned.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    known = voted.filter(F.col("cluster").between(0, k - 1))  # at most k rows
    return ids.join(F.broadcast(known), "cluster", "left").select(
        "cluster", F.coalesce("majority", F.lit(min(labels or TERNARY))).alias("majority")
    )


def relabel(assigned: DataFrame, majority: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Add ``predicted``: the majority label of the row's cluster (cluster itself if unmapped).

    The lookup has one row per cluster and is broadcast, so rows stay where they are however
    uneven the clusters.
    """
    names = lookup(majority.select(F.col("cluster").alias(cluster), F.col("majority").alias("predicted")))
    return assigned.join(names, cluster, "left").withColumn(
        "predicted", F.coalesce("predicted", F.col(cluster).cast("int"))
    )


def accuracy(df: DataFrame, truth: str = "label", predicted: str = "predicted") -> DataFrame:
    """``accuracy``: share of rows whose prediction equals the label."""
    return df.agg(F.avg((F.col(truth) == F.col(predicted)).cast("double")).alias("accuracy"))


def class_scores(
    df: DataFrame, labels: Sequence[int] | None = None, truth: str = "label", predicted: str = "predicted"
) -> DataFrame:
    """``class, precision, recall, f1, support``; 0 where a denominator is 0.

    Classes are ``labels``, or every value seen in truth or prediction.
    """
    pairs = _pairs(df, truth, predicted)
    # Each pair count is seen from both of its classes; a hit counts on either side once.
    per_class = (
        pairs.select(
            "n", F.explode(F.array(F.struct(F.col("a").alias("class"), F.lit(True).alias("as_truth")),
                                   F.struct(F.col("b").alias("class"), F.lit(False).alias("as_truth")))).alias("side"),
            (F.col("a") == F.col("b")).alias("hit"),
        )
        .groupBy(F.col("side.class").alias("class"))
        .agg(
            F.sum(F.when(F.col("side.as_truth"), F.col("n")).otherwise(0)).alias("support"),
            F.sum(F.when(~F.col("side.as_truth"), F.col("n")).otherwise(0)).alias("claimed"),
            F.sum(F.when(F.col("side.as_truth") & F.col("hit"), F.col("n")).otherwise(0)).alias("hits"),
        )
    )
    if labels is not None:
        wanted = local_frame(df.sparkSession, [(int(v),) for v in labels], "class int")
        known = per_class.filter(F.col("class").isin(list(labels)))  # at most one row per label
        per_class = wanted.join(F.broadcast(known), "class", "left").na.fill(0)

    def share(part: str, whole: str):
        return F.when(F.col(whole) > 0, F.col(part) / F.col(whole)).otherwise(0.0)

    precision, recall = share("hits", "claimed"), share("hits", "support")
    f1 = F.when(
        F.col("claimed") + F.col("support") > 0, 2 * F.col("hits") / (F.col("claimed") + F.col("support"))
    ).otherwise(0.0)
    return per_class.select(
        "class", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"), "support"
    )


def macro_scores(
    df: DataFrame, labels: Sequence[int] | None = None, truth: str = "label", predicted: str = "predicted"
) -> DataFrame:
    """``precision_macro, recall_macro, f1_macro``: unweighted means over the classes."""
    return class_scores(df, labels, truth, predicted).agg(
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
    )


def precision_macro(df: DataFrame, labels=None, truth: str = "label", predicted: str = "predicted") -> DataFrame:
    """``precision_macro``."""
    return macro_scores(df, labels, truth, predicted).select("precision_macro")


def recall_macro(df: DataFrame, labels=None, truth: str = "label", predicted: str = "predicted") -> DataFrame:
    """``recall_macro``."""
    return macro_scores(df, labels, truth, predicted).select("recall_macro")


def f1_macro(df: DataFrame, labels=None, truth: str = "label", predicted: str = "predicted") -> DataFrame:
    """``f1_macro``: mean of the per-class F scores."""
    return macro_scores(df, labels, truth, predicted).select("f1_macro")


def confusion_matrix(
    df: DataFrame, labels: Sequence[int], truth: str = "label", predicted: str = "predicted"
) -> DataFrame:
    """``truth, p_<label>...``: rows are truth, columns prediction, every label present."""
    labels = [int(v) for v in labels]
    counts = _pairs(df.filter(F.col(truth).isin(labels)), truth, predicted)
    wide = counts.groupBy("a").agg(
        *[F.sum(F.when(F.col("b") == v, F.col("n")).otherwise(0)).alias(_column(v)) for v in labels]
    )
    rows = local_frame(df.sparkSession, [(v,) for v in labels], "truth int")
    return rows.join(F.broadcast(wide), F.col("truth") == F.col("a"), "left").drop("a").na.fill(0)


def _column(label: int) -> str:
    return f"p_{label}" if label >= 0 else f"p_neg{-label}"


def contingency(assigned: DataFrame, k: int | None = None, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """``cluster, n0, n1``: labelled rows per cluster and class; with ``k``, empty clusters too.

    There are two classes: a label above 1 is an error.
    """
    known = F.when(F.col(label) > 1, F.raise_error(F.lit("labels above 1 have no class here"))).otherwise(F.col(label))
    counts = (
        assigned.filter(F.col(label) >= 0)
        .select(F.col(cluster).cast("int").alias("cluster"), known.alias("known"))
        .groupBy("cluster")
        .agg(F.count(F.when(F.col("known") == 0, 1)).alias("n0"), F.count(F.when(F.col("known") == 1, 1)).alias("n1"))
    )
    if k is None:
        return counts
    ids = assigned.sparkSession.range(k).select(F.col("id").cast("int").alias("cluster"))
    known = counts.filter(F.col("cluster").between(0, k - 1))  # at most k rows
    return ids.join(F.broadcast(known), "cluster", "left").na.fill(0)


def balance_score(table: DataFrame, k: int) -> DataFrame:
    """``balance``: smallest over largest labelled cluster of ``k``; all empty -> NULL.

    A cluster that the contingency table leaves out is empty.
    """
    rows = F.col("n0") + F.col("n1")
    least = F.when(F.count(F.lit(1)) < k, F.lit(0)).otherwise(F.min(rows))
    return table.agg((least / F.when(F.max(rows) > 0, F.max(rows))).alias("balance"))


def purity_score(table: DataFrame) -> DataFrame:
    """``cluster, purity``: ``1 - min/max`` of both class counts; an empty cluster -> NULL."""
    most = F.greatest("n0", "n1")
    return table.select("cluster", (1.0 - F.least("n0", "n1") / F.when(most > 0, most)).alias("purity"))


def trial_scores(assigned: DataFrame, k: int = 2, cluster: str = "cluster", label: str = "label") -> DataFrame:
    """One row: ``balance`` and ``purity_0 .. purity_<k-1>`` of an assigned table, from one count."""
    counts = contingency(assigned, k, cluster, label)
    purities = purity_score(counts).agg(
        *[F.max(F.when(F.col("cluster") == c, F.col("purity"))).alias(f"purity_{c}") for c in range(k)]
    )
    # Two tables of one row, of k counts.
    return balance_score(counts, k).join(F.broadcast(purities))


def mean_scores(trials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Means of the numeric columns of trial rows, per ``by``."""
    values = [f.name for f in trials.schema if f.name not in by and f.name != "trial"]
    return trials.groupBy(*by).agg(*[F.avg(v).alias(v) for v in values])
