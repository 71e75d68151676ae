"""Training logs: progress lines to typed rows, long and wide metric tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from vectrove.operators.centroids import lookup

# What marks a progress line, and the layout of its metrics.
PROGRESS = "===="
LEFTOVER = "==="
NAMES = ("loss", "accuracy", "val_loss", "val_accuracy")
PATTERN = r"^.*loss: ([^ ]*) - accuracy: ([^ ]*) - val_loss: ([^ ]*) - val_accuracy: ([^ ]*)(.*)$"
# Starts what the pattern produced, so that an unmatched line cannot pass for it.
MARK = "\u0001"
PLOTTED = {"loss": "loss", "accuracy": "accuracy", "eval_accuracy": "val_accuracy"}


def parse_training_log(lines: DataFrame, line: str = "line", keep: tuple[str, ...] = ("ordinal",)) -> DataFrame:
    """``keep..., loss, accuracy, val_loss, val_accuracy`` of the progress lines with all four.

    A progress line whose metrics are missing or not numbers is dropped.
    """
    text = F.col(line)
    cut = F.split(F.regexp_replace(text, PATTERN, f"{MARK} $1 $2 $3 $4 $5"), " ", 6)
    # The generator keeps Catalyst from repeating the regular expression for every use below.
    parts = lines.filter(text.contains(PROGRESS)).select(
        *[F.col(c) for c in keep], F.explode(F.array(cut)).alias("parts")
    )
    # A bar left over behind the metrics marks a line where extraction failed.
    matched = parts.filter((F.get("parts", F.lit(0)) == MARK) & ~F.get("parts", F.lit(5)).contains(LEFTOVER))
    values = [F.get("parts", F.lit(i + 1)).try_cast("double").alias(name) for i, name in enumerate(NAMES)]
    return matched.select(*[F.col(c) for c in keep], *values).na.drop(subset=list(NAMES))


def read_training_log(spark: SparkSession, path: str) -> DataFrame:
    """``epoch, loss, accuracy, val_loss, val_accuracy``; ``epoch`` counts extracted lines from 0.

    Lines are numbered without sorting them or moving them to one task: a line's number is
    its place inside its file split plus the lines of the splits before it, and only the
    per-split counts (one row per file split) are put in order.
    """
    lines = spark.read.text(path).select(
        F.col("value").alias("line"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
    )
    parsed = parse_training_log(lines, keep=("file", "start")).withColumn("at", F.monotonically_increasing_id())
    splits = parsed.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("first"))
    before = Window.orderBy("file", "start").rowsBetween(Window.unboundedPreceding, -1)
    offsets = splits.select("file", "start", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return parsed.join(lookup(offsets), ["file", "start"]).select(
        (F.col("offset") + F.col("at") - F.col("first")).alias("epoch"), *NAMES
    )


def log_metrics_long(metrics: DataFrame, epoch: str = "epoch") -> DataFrame:
    """``epoch, metric, value`` for loss, accuracy and eval_accuracy (val_loss is not plotted)."""
    pairs = ", ".join(f"'{name}', {source}" for name, source in PLOTTED.items())
    return metrics.selectExpr(f"{epoch} AS epoch", f"stack({len(PLOTTED)}, {pairs}) AS (metric, value)")


def pivot_metrics(long: DataFrame) -> DataFrame:
    """One row per epoch, one column per metric."""
    columns = [
        F.first(F.when(F.col("metric") == name, F.col("value")), ignorenulls=True).alias(name) for name in sorted(PLOTTED)
    ]
    return long.groupBy("epoch").agg(*columns)
