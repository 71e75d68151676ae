"""End-to-end jobs: data preparation, scored k-means trials, PCA + kNN classification."""

from __future__ import annotations

import time
from collections.abc import Sequence
from math import log10

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.operators import evaluate
from vectrove.operators.centroids import local_frame
from vectrove.operators.kmeans import KMeansResult, kmeans
from vectrove.operators.neighbours import knn_classify
from vectrove.operators.pca import fit_pca, transform_pca
from vectrove.operators.sample import train_validation_split
from vectrove.operators.shape import drop_unlabelled, shape_features
from vectrove.operators.stats import top_features_by_sd
from vectrove.sources.tables import write_dataset


def prepare_dataset(df: DataFrame, path: str, proportion: float = 0.1, seed: int | str = 0, raw: bool = False) -> None:
    """Drop unlabelled rows, split exactly, write both sets."""
    training, validation = train_validation_split(drop_unlabelled(df), proportion, seed)
    write_dataset(training, validation, path, raw)


def deviation_mask(df: DataFrame, m: int) -> list:
    """The mask table of :func:`top_features_by_sd` as rows in rank order (``m`` of them)."""
    return sorted(top_features_by_sd(df, m).collect(), key=lambda row: row["rank"])


def shaped_by_deviation(df: DataFrame, m: int, weights: bool = True, mask: list | None = None) -> DataFrame:
    """The table masked to its ``m`` most deviating features, scaled by max-abs, weighted by rank."""
    chosen = (deviation_mask(df, m) if mask is None else mask)[:m]
    return shape_features(
        df,
        [row["feature"] for row in chosen],
        [row["scale"] for row in chosen],
        [log10(len(chosen) / row["rank"]) for row in chosen] if weights else None,
    )


def kmeans_trials(
    df: DataFrame, trials: int = 1, k: int = 2, inits: Sequence | None = None, seed: int | str = 0, **options
) -> DataFrame:
    """One row per trial: ``trial, balance, purity_0.., seconds``.

    Each trial draws its own seeds (``inits`` fixes them). Scores use labelled rows only.
    """
    rows = []
    for trial in range(trials):
        started = time.monotonic()
        init = None if inits is None else inits[trial]
        result: KMeansResult = kmeans(df, k, init=init, seed=f"{seed}:{trial}", **options)
        score = evaluate.trial_scores(result.assignments, k).first()
        rows.append((trial, score["balance"], *[score[f"purity_{c}"] for c in range(k)], time.monotonic() - started))
    columns = ["trial int", "balance double", *[f"purity_{c} double" for c in range(k)], "seconds double"]
    return local_frame(df.sparkSession, rows, ", ".join(columns))


def repeat_trials(df: DataFrame, trials: int = 1, k: int = 2, **options) -> DataFrame:
    """Mean of every score over the trials."""
    return evaluate.mean_scores(kmeans_trials(df, trials, k, **options))


def mask_size_report(
    df: DataFrame, sizes: Sequence[int] = (64, 48, 32), trials: int = 1, k: int = 2, inits=None, **options
) -> DataFrame:
    """Per mask size: ``mask_size, balance, purity`` (mean over the clusters), ``seconds``.

    ``inits(shaped, size)`` may fix the seeds of a mask size.
    """
    report = None
    # The mask of a smaller size is the head of the largest one: one statistics scan for all.
    mask = deviation_mask(df, max(sizes))
    for size in sizes:
        shaped = shaped_by_deviation(df, size, mask=mask)
        fixed = None if inits is None else [inits(shaped, size)] * trials
        scores = repeat_trials(shaped, trials, k, inits=fixed, **options)
        purities = [F.col(f"purity_{c}") for c in range(k)]
        row = scores.select(
            F.lit(size).alias("mask_size"), "balance", (sum(purities[1:], purities[0]) / k).alias("purity"), "seconds"
        )
        report = row if report is None else report.unionByName(row)
    return report


def pca_knn(
    training: DataFrame,
    validation: DataFrame,
    components: int = 20,
    sample: int | None = None,
    k: int = 5,
    seed: int | str = 0,
) -> DataFrame:
    """``row_id, label, predicted`` for the validation rows: reduce, then vote of the nearest."""
    model = fit_pca(training, components, sample, seed)
    votes = knn_classify(transform_pca(training, model), transform_pca(validation, model), k)
    return validation.select("row_id", "label").join(votes, "row_id", "left")


def classifier_scores(predictions: DataFrame, labels: Sequence[int] = (0, 1)) -> DataFrame:
    """``precision_macro, recall_macro, f1_macro`` over fixed labels."""
    return evaluate.macro_scores(predictions, labels)
