"""Raw matrices, data sets, logs."""

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue import sqlkit as kit
from catalogue.clustering import drawn_seeds
from catalogue.registry import query, r, rounded
from catalogue.shaping import MASK, MASK_SQL, long
from vectrove.operators.centroids import as_matrix
from vectrove.operators.neighbours import assign_clusters
from vectrove.plans import jobs
from vectrove.sources import logs, raw, tables
from vectrove.sources.storage import scratch

# Small spans, so that a test table is read by several tasks.
SPAN_BYTES = 16 << 10


def _written(spark, sf, name, df=None):
    path = scratch(spark, name)
    raw.write_matrix(fx.vectors(spark, sf) if df is None else df, path)
    return path


@query("raw_roundtrip", f"WITH {fx.vectors_sql()} SELECT row_id, feature, {r('x')} AS value FROM l")
def raw_roundtrip(spark, sf):
    return long(raw.read_matrix(spark, _written(spark, sf, "matrix"), 64, partition_bytes=SPAN_BYTES), "row_id")


@query(
    "raw_prefix",
    f"WITH {fx.vectors_sql()} SELECT row_id, {r('sum(x)', 4)} AS total FROM l "
    "WHERE row_id < (SELECT count(*) // 3 FROM v) GROUP BY row_id",
)
def raw_prefix(spark, sf):
    """The first third of the rows: reading a prefix is the operator."""
    rows = fx.vectors(spark, sf).count() // 3
    prefix = raw.read_matrix(spark, _written(spark, sf, "matrix"), 64, rows, SPAN_BYTES)
    total = F.aggregate("features", F.lit(0.0), lambda a, b: a + b)
    return prefix.select("row_id", rounded(total, 4).alias("total"))


@query("zip_labels", f"WITH {fx.vectors_sql()} SELECT row_id, label, {r('features[1]')} AS first FROM v")
def zip_labels(spark, sf):
    rows = fx.vectors(spark, sf)
    x = raw.read_matrix(spark, _written(spark, sf, "x", rows), 64)
    y = raw.read_labels(
        spark, _written(spark, sf, "y", rows.withColumn("features", F.array(F.col("label").cast("float"))))
    )
    return raw.zip_labels(x, y).select("row_id", "label", rounded(F.col("features")[0]).alias("first"))


@query("read_labelled", f"WITH {fx.vectors_sql()} SELECT row_id, label, {r('features[1]')} AS first FROM v")
def read_labelled(spark, sf):
    """Features and labels aligned by position during the scan."""
    rows = fx.vectors(spark, sf)
    y = _written(spark, sf, "y", rows.withColumn("features", F.array(F.col("label").cast("float"))))
    found = raw.read_labelled(spark, _written(spark, sf, "x", rows), y, 64, partition_bytes=SPAN_BYTES)
    return found.select("row_id", "label", rounded(F.col("features")[0]).alias("first"))


@query(
    "write_counts",
    f"WITH {fx.vectors_sql()}, {kit.seeds('v', 4, 'write')}, {kit.assigned('v', 'c0', 'a')} "
    "SELECT cluster, count(*) AS n FROM a GROUP BY cluster",
)
def write_counts(spark, sf):
    rows = fx.vectors(spark, sf)
    assigned = assign_clusters(rows, as_matrix(drawn_seeds(rows, 4, "write"), "cluster", "features", bounded=True))
    return raw.write_assignments(assigned, scratch(spark, "assignments"))


@query(
    "written_assignments",
    f"WITH {fx.vectors_sql()}, {kit.seeds('v', 4, 'write')}, {kit.assigned('v', 'c0', 'a')} SELECT row_id, cluster FROM a",
)
def written_assignments(spark, sf):
    """What lies in the file after the write, read back by position."""
    rows = fx.vectors(spark, sf)
    assigned = assign_clusters(rows, as_matrix(drawn_seeds(rows, 4, "write"), "cluster", "features", bounded=True))
    path = scratch(spark, "assignments")
    raw.write_assignments(assigned, path)
    return raw.read_labels(spark, path).withColumnRenamed("label", "cluster")


_SPLIT_SQL = f"WITH {fx.vectors_sql()}, k AS (SELECT * FROM v WHERE label <> -1), s AS ({kit.split('k', 0.1, 'data')})"


@query(
    "write_dataset",
    f"{_SPLIT_SQL} SELECT CASE WHEN held THEN 'validation' ELSE 'training' END AS name, row_id, label, "
    f"{r('features[1]')} AS first FROM s",
)
def write_dataset(spark, sf):
    path = scratch(spark, "dataset")
    jobs.prepare_dataset(fx.vectors(spark, sf), path, 0.1, "data")
    training, validation = tables.read_dataset(spark, path)
    both = training.withColumn("name", F.lit("training")).unionByName(
        validation.withColumn("name", F.lit("validation"))
    )
    return both.select("name", "row_id", "label", rounded(F.col("features")[0]).alias("first"))


@query(
    "write_raw_dataset",
    f"{_SPLIT_SQL}, o AS (SELECT held, row_number() OVER (PARTITION BY held ORDER BY row_id) - 1 AS row_id, label, features FROM s) "
    "SELECT CASE WHEN held THEN 'validation' ELSE 'training' END AS name, row_id, label, "
    f"{r('features[64]')} AS last FROM o",
)
def write_raw_dataset(spark, sf):
    path = scratch(spark, "dataset")
    jobs.prepare_dataset(fx.vectors(spark, sf), path, 0.1, "data", raw=True)
    parts = [
        raw.read_labelled(spark, f"{path}/X{name}", f"{path}/Y{name}", 64).select(
            F.lit(name).alias("name"), "row_id", "label", rounded(F.col("features")[63]).alias("last")
        )
        for name in ("training", "validation")
    ]
    return parts[0].unionByName(parts[1])


@query(
    "write_masked",
    f"WITH {fx.vectors_sql()}, m AS (SELECT generate_subscripts({MASK_SQL}, 1) - 1 AS place, "
    f"unnest({MASK_SQL}) AS feature) SELECT row_id, m.place AS feature, {r('x')} AS value "
    "FROM l JOIN m ON l.feature = m.feature",
)
def write_masked(spark, sf):
    path = scratch(spark, "masked")
    source = raw.read_matrix(spark, _written(spark, sf, "wide"), 64, partition_bytes=SPAN_BYTES)
    tables.write_masked(source, MASK, path, raw=True, ordered=True)
    return long(raw.read_matrix(spark, path, len(MASK)), "row_id")


@query(
    "masked_scan",
    f"WITH {fx.vectors_sql()}, m AS (SELECT generate_subscripts({MASK_SQL}, 1) - 1 AS place, "
    f"unnest({MASK_SQL}) AS feature) SELECT row_id, l.label, m.place AS feature, {r('x')} AS value "
    "FROM l JOIN m ON l.feature = m.feature",
)
def masked_scan(spark, sf):
    """The mask is applied by the scan, so rows reach Spark with the wanted features alone."""
    rows = fx.vectors(spark, sf)
    y = _written(spark, sf, "y", rows.withColumn("features", F.array(F.col("label").cast("float"))))
    found = raw.read_labelled(spark, _written(spark, sf, "wide", rows), y, 64, partition_bytes=SPAN_BYTES, features=MASK)
    return long(found, "row_id", "label")


# -- logs ---------------------------------------------------------------------------------


@query("log_parse", f"WITH {fx.LOG_SQL} SELECT ordinal, loss, accuracy, val_loss, val_accuracy FROM logs")
def log_parse(spark, sf):
    return logs.parse_training_log(fx.log_lines(spark, sf))


@query(
    "log_read",
    f"WITH {fx.LOG_SQL} SELECT row_number() OVER (ORDER BY ordinal) - 1 AS epoch, loss, accuracy, val_loss, val_accuracy FROM logs",
)
def log_read(spark, sf):
    path = scratch(spark, "log")
    fx.log_lines(spark, sf).repartitionByRange(4, "ordinal").sortWithinPartitions("ordinal").select("line").write.text(path)
    return logs.read_training_log(spark, path)


@query(
    "log_long",
    f"WITH {fx.LOG_SQL} SELECT ordinal AS epoch, 'loss' AS metric, loss AS value FROM logs "
    "UNION ALL SELECT ordinal, 'accuracy', accuracy FROM logs UNION ALL SELECT ordinal, 'eval_accuracy', val_accuracy FROM logs",
)
def log_long(spark, sf):
    return logs.log_metrics_long(logs.parse_training_log(fx.log_lines(spark, sf)), "ordinal")


@query("log_pivot", f"WITH {fx.LOG_SQL} SELECT ordinal AS epoch, accuracy, val_accuracy AS eval_accuracy, loss FROM logs")
def log_pivot(spark, sf):
    long_rows = logs.log_metrics_long(logs.parse_training_log(fx.log_lines(spark, sf)), "ordinal")
    return logs.pivot_metrics(long_rows)
