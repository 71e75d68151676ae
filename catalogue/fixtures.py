"""The given tables seen as vector tables, label tables and log lines; in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vectrove.sources.tables import read_vectors

# -- vectors: embeddings ------------------------------------------------------------------

_LABELS = {"ternary": "label % 3 - 1", "binary": "label % 2", "ten": "label"}


def vectors(spark: SparkSession, sf: str, labels: str = "ternary") -> DataFrame:
    """``row_id, features, label`` from the embeddings (label -1/0/1, 0/1 or 0..9)."""
    rows = read_vectors(spark, f"{sf}/embeddings.parquet", "vec_id", "embedding", "label", "float")
    return rows.withColumn("label", F.expr(_LABELS[labels]).cast("int"))


def vectors_sql(labels: str = "ternary") -> str:
    return (
        "v AS (SELECT vec_id AS row_id, CAST(embedding AS DOUBLE[]) AS features, "
        f"CAST({_LABELS[labels]} AS INTEGER) AS label FROM embeddings), "
        "l AS (SELECT row_id, label, generate_subscripts(features, 1) - 1 AS feature, unnest(features) AS x FROM v)"
    )


# -- narrow vectors without a key: lineitem -----------------------------------------------


def lineitem(spark: SparkSession, sf: str) -> DataFrame:
    """``features, label``: quantity, price, discount, tax by return flag."""
    return spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("features"),
        F.expr("CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 ELSE -1 END").alias("label"),
    )


LINEITEM_SQL = (
    "v AS MATERIALIZED (SELECT row_number() OVER () AS row_id, "
    "[l_quantity, l_extendedprice, l_discount, l_tax] AS features, "
    "CASE l_returnflag WHEN 'R' THEN 1 WHEN 'A' THEN 0 ELSE -1 END AS label FROM lineitem), "
    "l AS (SELECT row_id, label, generate_subscripts(features, 1) - 1 AS feature, unnest(features) AS x FROM v)"
)

# -- keyed narrow vectors: orders ---------------------------------------------------------


def orders(spark: SparkSession, sf: str) -> DataFrame:
    """``row_id, features, label``: total price and order day by status."""
    return spark.read.parquet(f"{sf}/orders.parquet").select(
        F.col("o_orderkey").alias("row_id"),
        F.array(
            F.col("o_totalprice").cast("double"), F.unix_date(F.col("o_orderdate").cast("date")).cast("double")
        ).alias("features"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE -1 END").alias("label"),
    )


ORDERS_SQL = (
    "v AS (SELECT o_orderkey AS row_id, [CAST(o_totalprice AS DOUBLE), "
    "CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE)] AS features, "
    "CASE o_orderstatus WHEN 'F' THEN 1 WHEN 'O' THEN 0 ELSE -1 END AS label FROM orders), "
    "l AS (SELECT row_id, label, generate_subscripts(features, 1) - 1 AS feature, unnest(features) AS x FROM v)"
)

# -- part-labelled rows: documents and labels ---------------------------------------------


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """``row_id, label, toxic, n_chars``: quality label, -1 where a document has none."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "n_chars")
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    return docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").alias("row_id"),
        F.coalesce("quality", F.lit(-1)).alias("label"),
        F.coalesce("toxic", F.lit(-1)).alias("toxic"),
        "n_chars",
    )


DOCUMENTS_SQL = (
    "d AS (SELECT doc_id AS row_id, coalesce(quality, -1) AS label, coalesce(toxic, -1) AS toxic, n_chars "
    "FROM documents LEFT JOIN labels USING (doc_id))"
)

# -- log lines: events --------------------------------------------------------------------

# The same expression text runs in Spark SQL and DuckDB. Every 5th line lacks the bar, every
# 7th its metrics, every 11th ends in a second bar.
_K = "CAST(regexp_extract(props, '([0-9]+)', 1) AS INTEGER)"


def _figure(expression: str) -> str:
    return f"'0.' || lpad(CAST({expression} AS VARCHAR(3)), 2, '0')"


_LINE = (
    "CASE WHEN event_id % 5 = 0 THEN '450/450 [done]' ELSE '450/450 [=====================]' END || "
    "CASE WHEN event_id % 7 = 0 THEN ' - ETA: 0s' ELSE ' - 1s 2ms/step - loss: ' || "
    f"{_figure(_K)} || ' - accuracy: ' || {_figure(f'99 - {_K}')} || "
    f"' - val_loss: ' || {_figure(f'({_K} * 7) % 100')} || ' - val_accuracy: ' || {_figure(f'({_K} * 3) % 100')} END || "
    "CASE WHEN event_id % 11 = 0 THEN ' [====]' ELSE '' END"
)


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """``ordinal, line``."""
    events = spark.read.parquet(f"{sf}/events.parquet")
    return events.select(F.col("event_id").alias("ordinal"), F.expr(_LINE).alias("line"))


LOG_SQL = (
    f"lines AS (SELECT event_id AS ordinal, {_LINE} AS line FROM events), "
    "logs AS (SELECT ordinal, "
    "CAST(regexp_extract(line, ' loss: ([0-9.]+)', 1) AS DOUBLE) AS loss, "
    "CAST(regexp_extract(line, ' accuracy: ([0-9.]+)', 1) AS DOUBLE) AS accuracy, "
    "CAST(regexp_extract(line, 'val_loss: ([0-9.]+)', 1) AS DOUBLE) AS val_loss, "
    "CAST(regexp_extract(line, 'val_accuracy: ([0-9.]+)', 1) AS DOUBLE) AS val_accuracy "
    "FROM lines WHERE contains(line, '====') AND contains(line, 'val_accuracy: ') "
    "AND NOT contains(regexp_replace(line, '^.*val_accuracy: [0-9.]+', ''), '==='))"
)
