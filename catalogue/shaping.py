"""Filters, feature shaping, sampling and splitting."""

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue import sqlkit as kit
from catalogue.registry import query, r, rounded
from vectrove.operators import sample, shape
from vectrove.operators.stats import feature_max_abs, feature_summary, feature_values

MASK = [63, 0, 17, 5, 40, 2, 31, 8]
MASK_SQL = str(MASK)


def long(df, *keys):
    """Vectors as comparable rows."""
    return df.select(*keys, F.posexplode("features").alias("feature", "x")).select(
        *keys, "feature", rounded("x").alias("value")
    )


@query("drop_unlabelled", f"WITH {fx.DOCUMENTS_SQL} SELECT row_id, label, toxic FROM d WHERE label <> -1")
def drop_unlabelled(spark, sf):
    return shape.drop_unlabelled(fx.documents(spark, sf)).select("row_id", "label", "toxic")


@query(
    "labelled_only",
    f"WITH {fx.LINEITEM_SQL} SELECT label, count(*) AS n, {r('sum(features[1])')} AS quantity "
    "FROM v WHERE label >= 0 GROUP BY label",
)
def labelled_only(spark, sf):
    rows = shape.labelled_only(fx.lineitem(spark, sf))
    return rows.groupBy("label").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum(F.col("features")[0])).alias("quantity")
    )


@query("select_class", f"WITH {fx.DOCUMENTS_SQL} SELECT row_id, toxic, n_chars FROM d WHERE label = 1")
def select_class(spark, sf):
    return shape.select_class(fx.documents(spark, sf), 1).select("row_id", "toxic", "n_chars")


@query(
    "mask_features",
    f"WITH {fx.vectors_sql()}, m AS (SELECT generate_subscripts({MASK_SQL}, 1) - 1 AS place, "
    f"unnest({MASK_SQL}) AS feature) SELECT row_id, m.place AS feature, {r('x')} AS value "
    "FROM l JOIN m ON l.feature = m.feature",
)
def mask_features(spark, sf):
    return long(shape.mask_features(fx.vectors(spark, sf), MASK), "row_id")


_MAX_ABS_SQL = "s AS (SELECT feature, max(abs(x)) AS scale FROM l GROUP BY feature)"


@query(
    "scale_max_abs",
    f"WITH {fx.ORDERS_SQL}, {_MAX_ABS_SQL} SELECT row_id, feature, {r('x / scale')} AS value FROM l JOIN s USING (feature)",
)
def scale_max_abs(spark, sf):
    rows = fx.orders(spark, sf)
    scale = feature_values(feature_max_abs(rows), "max_abs")
    return long(shape.scale_max_abs(rows, scale), "row_id")


@query(
    "weight_features",
    f"WITH {fx.vectors_sql()} SELECT row_id, feature, {r('x * log10(64.0 / (feature + 1))')} AS value FROM l",
)
def weight_features(spark, sf):
    from math import log10

    return long(shape.weight_features(fx.vectors(spark, sf), [log10(64.0 / (i + 1)) for i in range(64)]), "row_id")


@query(
    "shape_features",
    f"WITH {fx.vectors_sql()}, {_MAX_ABS_SQL}, m AS (SELECT generate_subscripts({MASK_SQL}, 1) - 1 AS place, "
    f"unnest({MASK_SQL}) AS feature) SELECT row_id, place AS feature, "
    f"{r('x / scale * log10(8.0 / (place + 1))')} AS value FROM l JOIN m USING (feature) JOIN s USING (feature)",
)
def shape_features(spark, sf):
    from math import log10

    rows = fx.vectors(spark, sf)
    scale = feature_values(feature_max_abs(rows), "max_abs")
    weights = [log10(len(MASK) / (i + 1)) for i in range(len(MASK))]
    return long(shape.shape_features(rows, MASK, [scale[i] for i in MASK], weights), "row_id")


@query(
    "rank_weights",
    f"WITH {fx.vectors_sql()}, t AS (SELECT feature, stddev_pop(x) / max(abs(x)) AS sd FROM l GROUP BY feature), "
    "m AS (SELECT feature, row_number() OVER (ORDER BY sd DESC, feature) AS rank FROM t) "
    f"SELECT rank, feature, {r('log10(16.0 / rank)')} AS weight FROM m WHERE rank <= 16",
)
def rank_weights(spark, sf):
    from vectrove.operators.stats import top_features_by_sd

    mask = top_features_by_sd(fx.vectors(spark, sf), 16)
    return shape.rank_weights(mask).select("rank", "feature", rounded("weight").alias("weight"))


@query(
    "scale_min_max",
    f"WITH {fx.ORDERS_SQL}, f AS ({kit.drawn('v', '1000', 'minmax')}), "
    "u AS (SELECT generate_subscripts(features, 1) - 1 AS feature, unnest(features) AS x FROM f), "
    "s AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM u GROUP BY feature) "
    f"SELECT row_id, feature, {r('(x - lo) / CASE WHEN hi = lo THEN 1 ELSE hi - lo END')} AS value "
    "FROM l JOIN s USING (feature)",
)
def scale_min_max(spark, sf):
    rows = fx.orders(spark, sf)
    limits = feature_summary(sample.sample_exact(rows, 1000, "minmax")).orderBy("feature").collect()
    return long(shape.scale_min_max(rows, [x["min"] for x in limits], [x["max"] for x in limits]), "row_id")


# -- sampling -----------------------------------------------------------------------------


@query(
    "sample_exact",
    f"WITH {fx.ORDERS_SQL}, s AS ({kit.drawn('v', '1000', '7')}) SELECT row_id, {r('features[1]')} AS price, label FROM s",
)
def sample_exact(spark, sf):
    rows = sample.sample_exact(fx.orders(spark, sf), 1000, 7)
    return rows.select("row_id", rounded(F.col("features")[0]).alias("price"), "label")


@query(
    "sample_candidates",
    f"WITH {fx.ORDERS_SQL}, s AS ({kit.drawn('v', '1000', '7')}), c AS ({kit.drawn('s', '48', '7:candidates')}) "
    "SELECT row_id, label FROM c",
)
def sample_candidates(spark, sf):
    drawn = sample.sample_exact(fx.orders(spark, sf), 1000, 7)
    return sample.sample_candidates(drawn, 48, 7).select("row_id", "label")


@query(
    "sample_block",
    f"WITH {fx.ORDERS_SQL}, e AS (SELECT (min(row_id) + max(row_id)) // 2 AS start FROM v) "
    f"SELECT row_id, {r('features[1]')} AS price FROM v, e WHERE row_id BETWEEN start AND start + 499",
)
def sample_block(spark, sf):
    rows = fx.orders(spark, sf)
    start = rows.agg(F.expr("(min(row_id) + max(row_id)) div 2")).first()[0]
    return sample.sample_block(rows, 500, start).select("row_id", rounded(F.col("features")[0]).alias("price"))


@query(
    "split_sizes",
    f"WITH {fx.DOCUMENTS_SQL}, k AS (SELECT * FROM d WHERE label <> -1), s AS ({kit.split('k', 0.1, 'split')}) "
    "SELECT CASE WHEN held THEN 'validation' ELSE 'training' END AS name, count(*) AS n, sum(n_chars) AS chars "
    "FROM s GROUP BY held",
)
def split_sizes(spark, sf):
    labelled = shape.drop_unlabelled(fx.documents(spark, sf))
    sets = sample.train_validation_split(labelled, 0.1, "split")
    parts = [
        rows.agg(F.count(F.lit(1)).alias("n"), F.sum("n_chars").cast("long").alias("chars")).select(
            F.lit(name).alias("name"), "n", "chars"
        )
        for name, rows in zip(("training", "validation"), sets)
    ]
    return parts[0].unionByName(parts[1])


@query(
    "split_members",
    f"WITH {fx.ORDERS_SQL}, k AS (SELECT * FROM v WHERE label <> -1), s AS ({kit.split('k', 0.1, 'split')}) "
    "SELECT row_id, label, CASE WHEN held THEN 'validation' ELSE 'training' END AS name FROM s",
)
def split_members(spark, sf):
    labelled = shape.drop_unlabelled(fx.orders(spark, sf))
    return sample.with_set(labelled, 0.1, "split").select("row_id", "label", F.col("set").alias("name"))
