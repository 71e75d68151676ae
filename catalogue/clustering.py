"""Distances, seeding, k-means."""

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue import sqlkit as kit
from catalogue.registry import query, r, rounded
from vectrove.operators import distance, evaluate, seeding
from vectrove.operators import kmeans as km
from vectrove.operators.centroids import as_matrix
from vectrove.operators.neighbours import assign_clusters
from vectrove.operators.sample import sample_exact
from vectrove.operators.shape import scale_max_abs
from vectrove.operators.stats import feature_max_abs, feature_values

SAMPLE, CANDIDATES, SEED, TOLERANCE = 1000, 48, 11, 0.05


def drawn_seeds(df, k, seed):
    """``k`` drawn rows numbered in row order (k rows: one task is enough)."""
    rows = sample_exact(df, k, seed)
    return rows.select((F.row_number().over(Window.orderBy("row_id")) - 1).alias("cluster"), "features")


# -- distances ----------------------------------------------------------------------------

_NEIGHBOURS_SQL = (
    f"WITH {fx.vectors_sql()} SELECT a.row_id, {{}} FROM v a JOIN v b ON b.row_id = a.row_id + 1"
)


def _consecutive(spark, sf):
    rows = fx.vectors(spark, sf).select("row_id", "features")
    following = rows.select((F.col("row_id") - 1).alias("row_id"), F.col("features").alias("other"))
    return distance.row_distances(rows.join(following, "row_id"), "features", "other")


@query("distances", _NEIGHBOURS_SQL.format(f"{r('list_distance(a.features, b.features)')} AS distance"))
def distances(spark, sf):
    return _consecutive(spark, sf).select("row_id", rounded("distance").alias("distance"))


@query("sq_distances", _NEIGHBOURS_SQL.format(f"{r('pow(list_distance(a.features, b.features), 2)')} AS squared"))
def sq_distances(spark, sf):
    return _consecutive(spark, sf).select("row_id", rounded("squared").alias("squared"))


@query(
    "assign",
    f"WITH {fx.vectors_sql()}, {kit.seeds('v', 8, 'assign')}, {kit.assigned('v', 'c0', 'a')} "
    f"SELECT row_id, cluster, {r('error')} AS error FROM a",
)
def assign(spark, sf):
    rows = fx.vectors(spark, sf)
    found = assign_clusters(rows, as_matrix(drawn_seeds(rows, 8, "assign"), "cluster", "features", bounded=True))
    return found.select("row_id", "cluster", rounded("error").alias("error"))


@query(
    "assign_orders",
    f"WITH {fx.ORDERS_SQL}, {kit.seeds('v', 4, 'assign')}, {kit.assigned('v', 'c0', 'a')} "
    f"SELECT row_id, cluster, {r('error * error', 2)} AS error FROM a",
)
def assign_orders(spark, sf):
    rows = fx.orders(spark, sf)
    centroids = drawn_seeds(rows, 4, "assign").withColumnRenamed("features", "centroid")
    found = assign_clusters(rows, centroids, metric="squared")
    return found.select("row_id", "cluster", rounded("error", 2).alias("error"))


# -- seeding ------------------------------------------------------------------------------

#: Of the orders, since the smallest tables have fewer vectors than the sample.
_DRAW_SQL = (
    f"{fx.ORDERS_SQL}, s AS MATERIALIZED ({kit.drawn('v', str(SAMPLE), str(SEED))}), "
    f"k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY row_id) - 1 AS cand, row_id, features "
    f"FROM ({kit.drawn('s', str(CANDIDATES), f'{SEED}:candidates')})), "
    "md AS MATERIALIZED (SELECT cand, avg(list_distance(k.features, s.features)) AS mean_distance FROM k, s GROUP BY cand), "
    "pd AS (SELECT i.cand AS i, j.cand AS j, list_distance(i.features, j.features) AS distance FROM k i, k j), "
    "sp AS (SELECT i.cand AS i, j.cand AS j, i.mean_distance AS mean_i, j.mean_distance AS mean_j FROM md i, md j "
    f"WHERE i.cand <> j.cand AND abs(i.mean_distance / j.mean_distance - 1) < {TOLERANCE}), "
    "pp AS (SELECT i, j, abs(distance - (mean_i + mean_j) / 2) AS potential FROM sp JOIN pd USING (i, j))"
)


def _draw(spark, sf):
    return seeding.draw(fx.orders(spark, sf), SAMPLE, CANDIDATES, SEED)


@query("pairwise", f"WITH {_DRAW_SQL} SELECT i, j, {r('distance', 3)} AS distance FROM pd")
def pairwise(spark, sf):
    found = distance.pairwise_distances(_draw(spark, sf).candidates)
    return found.select("i", "j", rounded("distance", 3).alias("distance"))


@query("mean_distance", f"WITH {_DRAW_SQL} SELECT cand, {r('mean_distance', 3)} AS mean_distance FROM md")
def mean_distance(spark, sf):
    drawn = _draw(spark, sf)
    found = distance.mean_distance_to_sample(drawn.candidates, drawn.sample)
    return found.select("cand", rounded("mean_distance", 3).alias("mean_distance"))


@query("similar_pairs", f"WITH {_DRAW_SQL} SELECT i, j, {r('mean_i', 3)} AS mean_i, {r('mean_j', 3)} AS mean_j FROM sp")
def similar_pairs(spark, sf):
    drawn = _draw(spark, sf)
    found = distance.similar_pairs(distance.mean_distance_to_sample(drawn.candidates, drawn.sample), TOLERANCE)
    return found.select("i", "j", rounded("mean_i", 3).alias("mean_i"), rounded("mean_j", 3).alias("mean_j"))


@query("pair_potentials", f"WITH {_DRAW_SQL} SELECT i, j, {r('potential', 3)} AS potential FROM pp")
def pair_potentials(spark, sf):
    drawn = _draw(spark, sf)
    found = seeding.pair_potentials(drawn.candidates, drawn.sample, TOLERANCE)
    return found.select("i", "j", rounded("potential", 3).alias("potential"))


@query(
    "seed_two",
    f"WITH {_DRAW_SQL}, b AS (SELECT i, j FROM pp ORDER BY potential, i, j LIMIT 1) "
    "SELECT CASE WHEN k.cand = b.i THEN 0 ELSE 1 END AS cluster, k.row_id FROM k, b WHERE k.cand IN (b.i, b.j)",
)
def seed_two(spark, sf):
    return seeding.seed_two(fx.orders(spark, sf), SAMPLE, CANDIDATES, TOLERANCE, SEED).select("cluster", "row_id")


@query(
    "seed_potential",
    f"WITH {_DRAW_SQL}, c AS (SELECT cand AS cluster, features AS centroid FROM k), {kit.assigned('s', 'c', 'a')} "
    f"SELECT {r('sum(error)', 3)} AS potential FROM a",
)
def seed_potential(spark, sf):
    drawn = _draw(spark, sf)
    found = seeding.seed_potential(drawn.sample, as_matrix(drawn.candidates, "cand", "features"))
    return found.select(rounded("potential", 3).alias("potential"))


def _median_step(name: str, closest: str, taken: str) -> str:
    """``name(cand)``: candidate of lower median potential given ``closest(row_id, d)``."""
    return (
        f"{name}p AS MATERIALIZED (SELECT k.cand, sum(least(o.d, list_distance(k.features, s.features))) AS potential "
        f"FROM s JOIN {closest} o USING (row_id), k WHERE k.row_id NOT IN ({taken}) GROUP BY k.cand), "
        f"{name}r AS (SELECT cand, row_number() OVER (ORDER BY potential, cand) AS place, count(*) OVER () AS m FROM {name}p), "
        f"{name} AS MATERIALIZED (SELECT cand, row_id, features FROM k WHERE cand = "
        f"(SELECT cand FROM {name}r WHERE place = (m - 1) // 2 + 1))"
    )


@query(
    "seed_many",
    f"WITH {_DRAW_SQL}, f AS MATERIALIZED ({kit.drawn('v', '1', f'{SEED}:first')}), "
    "o1 AS MATERIALIZED (SELECT s.row_id, list_distance(s.features, f.features) AS d FROM s, f), "
    f"{_median_step('m1', 'o1', 'SELECT row_id FROM f')}, "
    "o2 AS MATERIALIZED (SELECT s.row_id, least(o1.d, list_distance(s.features, m1.features)) AS d "
    "FROM s JOIN o1 USING (row_id), m1), "
    f"{_median_step('m2', 'o2', 'SELECT row_id FROM f UNION ALL SELECT row_id FROM m1')} "
    "SELECT 0 AS cluster, row_id FROM f UNION ALL SELECT 1, row_id FROM m1 UNION ALL SELECT 2, row_id FROM m2",
)
def seed_many(spark, sf):
    return seeding.seed_many(fx.orders(spark, sf), 3, SAMPLE, CANDIDATES, SEED).select("cluster", "row_id")


# -- k-means ------------------------------------------------------------------------------

K, PASSES = 3, 3
_KMEANS_SQL = f"{fx.vectors_sql()}, {kit.seeds('v', K, 'kmeans')}, {kit.lloyd('v', 'l', PASSES)}"


def run_kmeans(df, k=K, passes=PASSES, seed="kmeans", min_delta=-1.0):
    return km.kmeans(df, k, max_iter=passes, min_delta=min_delta, init=drawn_seeds(df, k, seed))


@query(
    "kmeans_3pass",
    f"WITH {_KMEANS_SQL}, {kit.contingency(f'a{PASSES}', 'v', 't', K)} "
    f"SELECT cluster, n0, n1, {r(kit.PURITY)} AS purity, {r(f'(SELECT {kit.BALANCE} FROM t)')} AS balance FROM t",
)
def kmeans_3pass(spark, sf):
    """Assign, recompute, three times; contingency, purity and balance of the last assignment."""
    result = run_kmeans(fx.vectors(spark, sf))
    table = evaluate.contingency(result.assignments, K)
    rows = F.col("n0") + F.col("n1")
    every = Window.partitionBy()  # k rows
    balance = F.min(rows).over(every) / F.max(rows).over(every)
    purity = 1.0 - F.least("n0", "n1") / F.when(F.greatest("n0", "n1") > 0, F.greatest("n0", "n1"))
    return table.select("cluster", "n0", "n1", rounded(purity).alias("purity"), rounded(balance).alias("balance"))


@query("kmeans_assignments", f"WITH {_KMEANS_SQL} SELECT row_id, cluster, {r('error')} AS error FROM a{PASSES}")
def kmeans_assignments(spark, sf):
    found = run_kmeans(fx.vectors(spark, sf)).assignments
    return found.select("row_id", "cluster", rounded("error").alias("error"))


def _long_centroids(frame, decimals=6):
    return frame.select("cluster", F.posexplode("centroid").alias("feature", "x")).select(
        "cluster", "feature", rounded("x", decimals).alias("mean")
    )


@query(
    "centroids",
    f"WITH {_KMEANS_SQL} SELECT cluster, generate_subscripts(centroid, 1) - 1 AS feature, "
    f"round(unnest(centroid), 6) + 0.0 AS mean FROM c{PASSES}",
)
def centroids(spark, sf):
    return _long_centroids(run_kmeans(fx.vectors(spark, sf)).centroids)


_SCALED_SQL = (
    f"{fx.LINEITEM_SQL.replace('v AS MATERIALIZED', 'v0 AS MATERIALIZED').replace('FROM v)', 'FROM v0)').replace('l AS (', 'l0 AS (')}, "
    "s AS (SELECT feature, max(abs(x)) AS scale FROM l0 GROUP BY feature), "
    "l AS MATERIALIZED (SELECT row_id, label, feature, x / scale AS x FROM l0 JOIN s USING (feature)), "
    "v AS MATERIALIZED (SELECT row_id, any_value(label) AS label, list(x ORDER BY feature) AS features FROM l GROUP BY row_id), "
    "c0 AS (SELECT unnest([0, 1, 2]) AS cluster, unnest([[0.2, 0.2, 0.2, 0.2], [0.5, 0.5, 0.5, 0.5], "
    "[0.8, 0.8, 0.8, 0.8]])::DOUBLE[] AS centroid)"
)


def scaled_lineitem(spark, sf):
    rows = fx.lineitem(spark, sf)
    return scale_max_abs(rows, feature_values(feature_max_abs(rows), "max_abs"))


FIXED = np.array([[0.2] * 4, [0.5] * 4, [0.8] * 4])


@query(
    "kmeans_lineitem",
    f"WITH {_SCALED_SQL}, {kit.lloyd('v', 'l', 4)} SELECT cluster, generate_subscripts(centroid, 1) - 1 AS feature, "
    "round(unnest(centroid), 6) + 0.0 AS mean FROM c4",
)
def kmeans_lineitem(spark, sf):
    result = km.kmeans(scaled_lineitem(spark, sf), 3, max_iter=4, min_delta=-1.0, init=FIXED)
    return _long_centroids(result.centroids)


@query(
    "cluster_sizes",
    f"WITH {_SCALED_SQL}, {kit.lloyd('v', 'l', 2)} SELECT cluster, count(*) AS n FROM a2 GROUP BY cluster",
)
def cluster_sizes(spark, sf):
    result = km.kmeans(scaled_lineitem(spark, sf), 3, max_iter=2, min_delta=-1.0, init=FIXED)
    return km.cluster_sizes(result.assignments)


@query(
    "update_centroids",
    f"WITH {fx.vectors_sql('ten')} SELECT label AS cluster, feature, {r('avg(x)')} AS mean, count(*) AS n "
    "FROM l GROUP BY label, feature",
)
def update_centroids(spark, sf):
    rows = fx.vectors(spark, sf, "ten").withColumnRenamed("label", "cluster")
    return km.update_centroids(rows).select("cluster", "feature", rounded("mean").alias("mean"), "n")


_HISTORY = " UNION ALL ".join(f"SELECT {t - 1} AS iteration, avg(error) AS mean_error FROM a{t}" for t in range(1, PASSES + 1))


@query(
    "iteration_history",
    f"WITH {_KMEANS_SQL}, h AS ({_HISTORY}) SELECT iteration, {r('mean_error')} AS mean_error, "
    f"{r('abs(mean_error - lag(mean_error) OVER (ORDER BY iteration))')} AS delta FROM h",
)
def iteration_history(spark, sf):
    found = run_kmeans(fx.vectors(spark, sf)).history
    return found.select("iteration", rounded("mean_error").alias("mean_error"), rounded("delta").alias("delta"))


MAX_PASSES, SETTLED = 20, 0.1
_SETTLING = " UNION ALL ".join(
    f"SELECT {t - 1} AS iteration, avg(error) AS mean_error FROM a{t}" for t in range(1, MAX_PASSES + 1)
)


@query(
    "kmeans_converged",
    f"WITH {_DRAW_SQL}, b AS (SELECT i, j FROM pp ORDER BY potential, i, j LIMIT 1), "
    "c0 AS MATERIALIZED (SELECT CASE WHEN k.cand = b.i THEN 0 ELSE 1 END AS cluster, k.features AS centroid "
    f"FROM k, b WHERE k.cand IN (b.i, b.j)), {kit.lloyd('v', 'l', MAX_PASSES)}, h AS ({_SETTLING}), "
    "g AS (SELECT *, abs(mean_error - lag(mean_error) OVER (ORDER BY iteration)) AS delta FROM h) "
    f"SELECT iteration, {r('mean_error', 3)} AS mean_error, {r('delta', 3)} AS delta FROM g WHERE iteration <= "
    f"coalesce((SELECT min(iteration) FROM g WHERE delta <= {SETTLED}), {MAX_PASSES})",
)
def kmeans_converged(spark, sf):
    """Data-driven seeds, passes until the mean error settles."""
    rows = fx.orders(spark, sf)
    init = seeding.seed_two(rows, SAMPLE, CANDIDATES, TOLERANCE, SEED)
    result = km.kmeans(rows, 2, max_iter=MAX_PASSES, init=init, min_delta=SETTLED)
    return result.history.select("iteration", rounded("mean_error", 3).alias("mean_error"), rounded("delta", 3).alias("delta"))


MANY, MANY_SEED = 60, 5


def _many_sql() -> str:
    """``c0`` from a drawn first row and one median step per further seed, at the stated 1000 sample rows."""
    parts = [
        f"{fx.ORDERS_SQL}, s AS MATERIALIZED ({kit.drawn('v', '1000', str(MANY_SEED))})",
        "k AS MATERIALIZED (SELECT row_number() OVER (ORDER BY row_id) - 1 AS cand, row_id, features "
        f"FROM ({kit.drawn('s', str(2 * (MANY - 1)), f'{MANY_SEED}:candidates')}))",
        f"m0 AS MATERIALIZED ({kit.drawn('v', '1', f'{MANY_SEED}:first')})",
        "o0 AS MATERIALIZED (SELECT s.row_id, list_distance(s.features, m0.features) AS d FROM s, m0)",
    ]
    for step in range(1, MANY):
        taken = " UNION ALL ".join(f"SELECT row_id FROM m{i}" for i in range(step))
        parts.append(_median_step(f"m{step}", f"o{step - 1}", taken))
        parts.append(
            f"o{step} AS MATERIALIZED (SELECT s.row_id, least(o.d, list_distance(s.features, m{step}.features)) AS d "
            f"FROM s JOIN o{step - 1} o USING (row_id), m{step})"
        )
    seeds = " UNION ALL ".join(f"SELECT {i} AS cluster, features AS centroid FROM m{i}" for i in range(MANY))
    return ", ".join([*parts, f"c0 AS MATERIALIZED ({seeds})", kit.assigned("v", "c0", "a")])


@query("kmeans_many", f"WITH {_many_sql()} SELECT cluster, count(*) AS n, {r('sum(error)', 2)} AS error FROM a GROUP BY cluster")
def kmeans_many(spark, sf):
    """Sixty clusters from seeds of the run's own: more than the usual candidates can give."""
    result = km.kmeans(fx.orders(spark, sf), MANY, max_iter=1, seed=MANY_SEED)
    found = result.assignments.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("error").alias("error"))
    return found.select("cluster", "n", rounded("error", 2).alias("error"))


# -- freezing variant ---------------------------------------------------------------------

#: The stated threshold, stop rule and bound on passes, in squared distances of the orders.
FREEZE, STILL, FREEZING_PASSES = 5_000_000, 50_000, 20


def _freezing_sql() -> str:
    """Passes unrolled to the bound: rows below the threshold settle; means are (seed + settled) / (1 + settled).

    ``s`` has the rows that each pass measured, ``e`` the mean error after it, ``last`` the pass
    that the stop rule ends with, and ``f<pass>`` its means.
    """
    parts = [
        f"{fx.ORDERS_SQL}, {kit.seeds('v', 2, 'freezing')}",
        "z AS MATERIALIZED (SELECT cluster, generate_subscripts(centroid, 1) - 1 AS feature, unnest(centroid) AS x FROM c0)",
    ]
    points, centroids = "v", "c0"
    for step in range(1, FREEZING_PASSES + 1):
        settled = " UNION ALL ".join(f"SELECT row_id, cluster FROM a{t} WHERE error * error < {FREEZE}" for t in range(1, step + 1))
        parts += [
            kit.assigned(points, centroids, f"a{step}"),
            f"f{step} AS MATERIALIZED (SELECT c.cluster, list(c.x / 1.0 ORDER BY c.feature) AS centroid FROM ("
            "SELECT z.cluster, z.feature, (z.x + coalesce(sum(u.x), 0)) / (1 + count(u.x)) AS x FROM z "
            f"LEFT JOIN (SELECT g.cluster, l.feature, l.x FROM ({settled}) g JOIN l USING (row_id)) u "
            "ON u.cluster = z.cluster AND u.feature = z.feature GROUP BY z.cluster, z.feature, z.x) c GROUP BY c.cluster)",
            f"open{step} AS MATERIALIZED (SELECT v.* FROM v JOIN a{step} USING (row_id) WHERE a{step}.error * a{step}.error >= {FREEZE})",
        ]
        points, centroids = f"open{step}", f"f{step}"
    every = " UNION ALL ".join(f"SELECT {t} AS step, row_id, cluster, error * error AS error FROM a{t}" for t in range(1, FREEZING_PASSES + 1))
    means = " UNION ALL ".join(f"SELECT {t} AS step, * FROM f{t}" for t in range(1, FREEZING_PASSES + 1))
    return ", ".join(
        [
            *parts,
            f"s AS MATERIALIZED ({every})",
            f"y AS (SELECT t AS step, sum(error) FILTER (WHERE s.step = t OR error < {FREEZE}) / (SELECT count(*) FROM v) AS mean_error "
            f"FROM s, range(1, {FREEZING_PASSES + 1}) p(t) WHERE s.step <= t GROUP BY t)",
            "e AS (SELECT *, abs(mean_error - lag(mean_error) OVER (ORDER BY step)) AS delta FROM y)",
            f"last AS (SELECT coalesce((SELECT min(step) FROM e WHERE delta <= {STILL}), {FREEZING_PASSES}) AS step)",
            f"f AS ({means})",
        ]
    )


def _run_freezing(spark, sf):
    rows = fx.orders(spark, sf)
    return km.kmeans_freezing(rows, drawn_seeds(rows, 2, "freezing"), FREEZING_PASSES, FREEZE, STILL)


@query(
    "kmeans_freezing",
    f"WITH {_freezing_sql()} SELECT row_id, arg_max(cluster, step) AS cluster, {r('arg_max(error, step) / 1e6', 2)} AS error, "
    f"arg_max(error, step) < {FREEZE} AS frozen FROM s WHERE step <= (SELECT step FROM last) GROUP BY row_id",
)
def kmeans_freezing(spark, sf):
    found = _run_freezing(spark, sf).assignments
    return found.select("row_id", "cluster", rounded(F.col("error") / 1e6, 2).alias("error"), "frozen")


@query(
    "freezing_centroids",
    f"WITH {_freezing_sql()} SELECT cluster, generate_subscripts(centroid, 1) - 1 AS feature, "
    "round(unnest(centroid), 3) + 0.0 AS mean FROM f WHERE step = (SELECT step FROM last)",
)
def freezing_centroids(spark, sf):
    return _long_centroids(_run_freezing(spark, sf).centroids, 3)


@query(
    "freezing_history",
    f"WITH {_freezing_sql()} SELECT step - 1 AS iteration, {r('mean_error / 1e6', 3)} AS mean_error, {r('delta / 1e6', 3)} AS delta "
    "FROM e WHERE step <= (SELECT step FROM last)",
)
def freezing_history(spark, sf):
    history = _run_freezing(spark, sf).history
    return history.select("iteration", *[rounded(F.col(c) / 1e6, 3).alias(c) for c in ("mean_error", "delta")])
