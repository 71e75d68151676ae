"""Per-feature statistics, wide (embeddings) and long (lineitem)."""

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue import sqlkit as kit
from catalogue.registry import query, r, rounded
from vectrove.operators import stats
from vectrove.operators.sample import sample_exact

# lineitem prices reach 1e5: four decimals are 13 significant digits of a sum over the table.
_SOURCES = {
    "": (fx.vectors, fx.vectors_sql(), 6),
    "_lineitem": (fx.lineitem, fx.LINEITEM_SQL, 4),
}


def _register(name, body, operator):
    for suffix, (source, cte, decimals) in _SOURCES.items():
        sql = f"WITH {cte} {body(decimals)}".replace(") , ", "), ")
        query(name + suffix, sql)(lambda spark, sf, source=source, d=decimals: operator(source(spark, sf), d))


_register(
    "class_means",
    lambda d: f"SELECT label, feature, {r('avg(x)', d)} AS mean FROM l GROUP BY label, feature",
    lambda df, d: stats.class_mean_vectors(df).select("label", "feature", rounded("mean", d).alias("mean")),
)
_register(
    "feature_min_max",
    lambda d: f"SELECT feature, {r('least(min(x), 0)', d)} AS low, {r('greatest(max(x), 0)', d)} AS high "
    "FROM l GROUP BY feature",
    lambda df, d: stats.feature_min_max(df).select(
        "feature", rounded("min", d).alias("low"), rounded("max", d).alias("high")
    ),
)
_register(
    "feature_extrema",
    lambda d: f"SELECT feature, {r('min(x)', d)} AS low, {r('max(x)', d)} AS high FROM l GROUP BY feature",
    lambda df, d: stats.feature_min_max(df, clamp_zero=False).select(
        "feature", rounded("min", d).alias("low"), rounded("max", d).alias("high")
    ),
)
_register(
    "class_contrast",
    lambda d: "SELECT feature, "
    + ", ".join(
        f"{r(e, d)} AS {n}"
        for n, e in {
            "mean_0": "avg(x) FILTER (WHERE label = 0)",
            "mean_1": "avg(x) FILTER (WHERE label = 1)",
            "difference": "abs(avg(x) FILTER (WHERE label = 0) - avg(x) FILTER (WHERE label = 1))",
            "low": "least(min(x), 0)",
            "high": "greatest(max(x), 0)",
        }.items()
    )
    + " FROM l GROUP BY feature",
    lambda df, d: stats.class_contrast_report(df, decimals=d).select(
        "feature",
        *[(F.col(c) + 0.0).alias(c) for c in ("mean_0", "mean_1", "difference")],
        (F.col("min") + 0.0).alias("low"),
        (F.col("max") + 0.0).alias("high"),
    ),
)
_register(
    "feature_max_abs",
    lambda d: f"SELECT feature, {r('max(abs(x))', d)} AS max_abs FROM l GROUP BY feature",
    lambda df, d: stats.feature_max_abs(df).select("feature", rounded("max_abs", d).alias("max_abs")),
)
_register(
    "feature_sd",
    lambda d: f"SELECT feature, {r('avg(x) / max(abs(x))')} AS mean, {r('stddev_pop(x) / max(abs(x))')} AS sd "
    "FROM l GROUP BY feature",
    lambda df, d: stats.feature_mean_sd(df).select(
        "feature", rounded("mean").alias("mean"), rounded("sd").alias("sd")
    ),
)
_register(
    "feature_sd_as_written",
    lambda d: ", t AS (SELECT feature, avg(x) / max(abs(x)) AS mean, max(abs(x)) AS scale, count(*) AS n FROM l "
    f"GROUP BY feature) SELECT feature, {r('sqrt(sum(pow(mean - x / scale / n, 2)) / any_value(n))')} AS sd "
    "FROM l JOIN t USING (feature) GROUP BY feature",
    lambda df, d: stats.feature_mean_sd(df, as_written=True).select("feature", rounded("sd").alias("sd")),
)
_register(
    "top_sd_features",
    lambda d: ", t AS (SELECT feature, stddev_pop(x) / max(abs(x)) AS sd FROM l GROUP BY feature), "
    "m AS (SELECT *, row_number() OVER (ORDER BY sd DESC, feature) AS rank FROM t) "
    f"SELECT rank, feature, {r('sd')} AS sd FROM m WHERE rank <= 32",
    lambda df, d: stats.top_features_by_sd(df, 32).select("rank", "feature", rounded("sd").alias("sd")),
)


@query(
    "low_mean_features",
    f"WITH {fx.ORDERS_SQL}, f AS ({kit.drawn('v', '1000', 'minmax')}), "
    "u AS (SELECT generate_subscripts(features, 1) - 1 AS feature, unnest(features) AS x FROM f), "
    "s AS (SELECT feature, min(x) AS lo, max(x) AS hi FROM u GROUP BY feature), "
    "t AS (SELECT feature, avg((x - lo) / (hi - lo)) AS mean FROM l JOIN s USING (feature) GROUP BY feature) "
    f"SELECT feature, {r('mean')} AS mean FROM t ORDER BY t.mean, feature LIMIT 32",
)
def low_mean_features(spark, sf):
    rows = fx.orders(spark, sf)
    low = stats.low_mean_features(rows, sample_exact(rows, 1000, "minmax"), 32)
    return low.select("feature", rounded("mean").alias("mean"))
