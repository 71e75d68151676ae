"""Headline queries on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session():
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("vectrove-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def wide_lineitem(spark, sf):
    """One 64-wide vector per lineitem row: the embedding its part key points at.

    ``row_id`` is unique per row; the right side is the embeddings table.
    """
    from pyspark.sql import functions as F

    embeddings = spark.read.parquet(f"{sf}/embeddings.parquet")
    n = embeddings.count()
    items = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.monotonically_increasing_id().alias("row_id"),
        F.pmod("l_partkey", F.lit(n)).alias("vec_id"),
        F.col("l_quantity").cast("float").alias("shift"),
        F.expr("CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 ELSE -1 END").alias("label"),
    )
    joined = items.join(embeddings.select("vec_id", "embedding"), "vec_id")
    return joined.select(
        "row_id", F.transform("embedding", lambda x: x + F.col("shift") / 500).cast("array<float>").alias("features"), "label"
    )


def headline(spark, sf):
    """``name -> callable`` running one query to the end."""
    from catalogue import QUERIES
    from pyspark.sql import functions as F

    from vectrove.operators import evaluate, stats
    from vectrove.operators import kmeans as km
    from vectrove.operators.neighbours import assign_clusters, knn_classify
    from vectrove.operators.sample import train_validation_split
    from vectrove.operators.seeding import seed_two
    from vectrove.operators.shape import mask_features
    from vectrove.plans import jobs
    from vectrove.sources.raw import write_assignments
    from vectrove.sources.storage import scratch

    wide = wide_lineitem(spark, sf).repartition(int(CPUS)).persist()
    wide.count()

    def finish(df):
        df.write.format("noop").mode("overwrite").save()

    def kmeans_run(width):
        """Seeding, passes with the default stop rule, assignments written, scores."""
        rows = wide if width == 64 else mask_features(wide, range(width))
        result = km.kmeans(rows, 2, seed=1)
        write_assignments(result.assignments, scratch(spark, "bench"))
        finish(evaluate.trial_scores(result.assignments, 2))
        print(f"kmeans_{width}d: {result.iterations} passes", file=sys.stderr)

    def kmeans_64d_pass():
        km.lloyd_pass(wide.select("features"), centroids)

    def knn_64d():
        training, validation = train_validation_split(wide, 0.001, 3)
        finish(knn_classify(training, validation, 5))

    centroids = km.as_matrix(seed_two(wide, seed=1), "cluster", "features")
    runs = {
        "kmeans_64d": lambda: kmeans_run(64),
        "kmeans_48d": lambda: kmeans_run(48),
        "kmeans_32d": lambda: kmeans_run(32),
        "kmeans_64d_pass": kmeans_64d_pass,
        "assign_64d": lambda: finish(assign_clusters(wide, centroids)),
        "split_64d": lambda: [finish(s.select("row_id", "label")) for s in train_validation_split(wide, 0.1, 5)],
        "feature_sd_64d": lambda: finish(stats.feature_mean_sd(wide)),
        "class_contrast_64d": lambda: finish(stats.class_contrast_report(wide)),
        "shape_32_of_64d": lambda: finish(jobs.shaped_by_deviation(wide, 32)),
        "knn_64d": knn_64d,
    }
    for name in (
        "kmeans_3pass",
        "kmeans_lineitem",
        "class_contrast_lineitem",
        "feature_sd_lineitem",
        "scale_max_abs",
        "sample_exact",
        "split_members",
        "assign_orders",
        "seed_two",
        "seed_many",
        "kmeans_freezing",
        "pca_scores",
        "pca_lineitem",
        "knn_exact",
        "pca_knn_scores",
        "confusion",
        "mask_size_report",
        "network_history",
        "network_scores",
        "raw_roundtrip",
        "log_read",
        "log_pivot",
    ):
        runs[name] = lambda name=name: finish(QUERIES[name](spark, sf))
    return runs


def main() -> None:
    from vectrove import attach

    spark = attach(session())
    only = sys.argv[1:]
    times = {}
    for name, run in headline(spark, SF_DIR).items():
        if only and name not in only:
            continue
        best = None
        for _ in range(2):  # the first run warms up code generation and workers
            started = time.monotonic()
            run()
            took = time.monotonic() - started
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(SF_DIR).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
