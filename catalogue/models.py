"""PCA, nearest neighbours, network."""

import numpy as np
from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue import sqlkit as kit
from catalogue.registry import query, r, rounded
from vectrove.operators import network as net
from vectrove.operators import pca, pca_merge
from vectrove.operators.barrier import fit_network_barrier
from vectrove.operators.neighbours import knn_classify, knn_neighbours
from vectrove.operators.sample import train_validation_split
from vectrove.plans import jobs
from vectrove.sources.storage import scratch

# -- PCA ----------------------------------------------------------------------------------


@query("pca_variance", f"WITH {fx.vectors_sql()}, t AS (SELECT var_samp(x) AS s FROM l GROUP BY feature) "
       f"SELECT {r('sum(s)')} AS total_variance FROM t")  # fmt: skip
def pca_variance(spark, sf):
    """The variances of all components add up to the variances of all features."""
    model = pca.fit_pca(fx.vectors(spark, sf), k=64, sample=None)
    return pca.pca_frame(spark, model).agg(rounded(F.sum("variance")).alias("total_variance"))


@query("pca_merged", f"WITH {fx.vectors_sql()}, t AS (SELECT var_samp(x) AS s FROM l GROUP BY feature) "
       f"SELECT {r('sum(s)')} AS total_variance FROM t")  # fmt: skip
def pca_merged(spark, sf):
    """Decompositions of the tasks' rows, merged: all components together have the total variance."""
    model, _bound = pca_merge.fit_pca_merged(fx.vectors(spark, sf), k=64, rank=64)
    return pca.pca_frame(spark, model).agg(rounded(F.sum("variance")).alias("total_variance"))


@query(
    "pca_scores",
    f"WITH {fx.vectors_sql()}, m AS (SELECT feature, avg(x) AS mean FROM l GROUP BY feature) "
    f"SELECT row_id, {r('sum(pow(x - mean, 2))')} AS norm FROM l JOIN m USING (feature) GROUP BY row_id",
)
def pca_scores(spark, sf):
    """All components keep every row's distance to the mean."""
    rows = fx.vectors(spark, sf)
    scores = pca.transform_pca(rows, pca.fit_pca(rows, k=64, sample=None))
    norm = F.aggregate(F.transform("features", lambda x: x * x), F.lit(0.0), lambda a, b: a + b)
    return scores.select("row_id", rounded(norm).alias("norm"))


@query("pca_lineitem", f"WITH {fx.LINEITEM_SQL}, t AS (SELECT var_samp(x) AS s FROM l GROUP BY feature) "
       f"SELECT {r('sum(s) / 1e6', 4)} AS total_variance FROM t")  # fmt: skip
def pca_lineitem(spark, sf):
    model = pca.fit_pca(fx.lineitem(spark, sf), k=4, sample=None)
    return pca.pca_frame(spark, model).agg(rounded(F.sum("variance") / 1e6, 4).alias("total_variance"))


@query(
    "pca_project_2d",
    f"WITH {fx.vectors_sql()}, {kit.principal('l', 2)} SELECT row_id, {r('sc1.x')} AS pc1, {r('sc2.x')} AS pc2, label "
    "FROM sc1 JOIN sc2 USING (row_id) JOIN v USING (row_id)",
)
def pca_project_2d(spark, sf):
    rows = fx.vectors(spark, sf)
    found = pca.project_2d(rows, pca.fit_pca(rows, k=2, sample=None))
    return found.select("row_id", rounded("pc1").alias("pc1"), rounded("pc2").alias("pc2"), "label")


@query(
    "pca_saved",
    f"WITH {fx.vectors_sql()}, {kit.principal('l', 2)}, w AS (SELECT sum(x) AS trace FROM q1_0 WHERE i = j) "
    f"SELECT 0 AS component, {r('value')} AS variance, {r('value / trace')} AS ratio FROM lam1, w UNION ALL "
    f"SELECT 1, {r('value')}, {r('value / trace')} FROM lam2, w",
)
def pca_saved(spark, sf):
    """Variances of a model after writing and reading its table."""
    rows = fx.vectors(spark, sf)
    path = scratch(spark, "pca")
    pca.save_pca(spark, pca.fit_pca(rows, k=2, sample=None), path)
    frame = pca.pca_frame(spark, pca.load_pca(spark, path)).filter("component >= 0")
    return frame.select("component", rounded("variance").alias("variance"), rounded("ratio").alias("ratio"))


@query(
    "pca_sampled",
    f"WITH {fx.ORDERS_SQL}, s AS MATERIALIZED ({kit.drawn('v', '1000', '4')}), "
    "l1 AS (SELECT row_id, generate_subscripts(features, 1) - 1 AS feature, unnest(features) AS x FROM s), "
    f"{kit.principal('l1', 1)}, p AS (SELECT l.row_id, sum((l.x - mean) * e1.x) AS x FROM l JOIN mu USING (feature) "
    f"JOIN e1 USING (feature) GROUP BY l.row_id) SELECT row_id, {r('x', 3)} AS pc1 FROM p",
)
def pca_sampled(spark, sf):
    """Fitted on an exact sample, applied to every row."""
    rows = fx.orders(spark, sf)
    scores = pca.transform_pca(rows, pca.fit_pca(rows, k=1, sample=1000, seed=4))
    return scores.select("row_id", rounded(F.col("features")[0], 3).alias("pc1"))


# -- nearest neighbours -------------------------------------------------------------------

_KNN_SQL = (
    f"{fx.vectors_sql('binary')}, s AS MATERIALIZED ({kit.split('v', 0.1, 'knn')}), "
    "n AS MATERIALIZED (SELECT q.row_id, t.row_id AS neighbour, t.label, list_distance(q.features, t.features) AS distance, "
    "row_number() OVER (PARTITION BY q.row_id ORDER BY list_distance(q.features, t.features), t.row_id) AS rank "
    "FROM (SELECT * FROM s WHERE held) q, (SELECT * FROM s WHERE NOT held) t QUALIFY rank <= 5), "
    "b AS (SELECT row_id, label, count(*) AS n FROM n GROUP BY ALL), "
    "w AS (SELECT row_id, label AS predicted, row_number() OVER (PARTITION BY row_id ORDER BY n DESC, label) AS place FROM b)"
)


def _sets(spark, sf):
    return train_validation_split(fx.vectors(spark, sf, "binary"), 0.1, "knn")


@query("knn_neighbours", f"WITH {_KNN_SQL} SELECT row_id, rank, neighbour, {r('distance')} AS distance FROM n")
def knn_lists(spark, sf):
    found = knn_neighbours(*_sets(spark, sf), k=5)
    return found.select("row_id", "rank", "neighbour", rounded("distance").alias("distance"))


@query("knn_exact", f"WITH {_KNN_SQL} SELECT row_id, predicted FROM w WHERE place = 1")
def knn_exact(spark, sf):
    return knn_classify(*_sets(spark, sf), k=5)


@query("knn_cells", f"WITH {_KNN_SQL} SELECT row_id, predicted FROM w WHERE place = 1")
def knn_cells(spark, sf):
    """Cells of 100 rows or so around pivots."""
    return knn_classify(*_sets(spark, sf), k=5, strategy="cells", block_numbers=64 * 100)


@query("knn_grid", f"WITH {_KNN_SQL} SELECT row_id, predicted FROM w WHERE place = 1")
def knn_grid(spark, sf):
    """The block join taken when neither side fits a broadcast."""
    return knn_classify(*_sets(spark, sf), k=5, strategy="grid", block_numbers=64 * 100)


_ORDERS_KNN_SQL = (
    f"{fx.ORDERS_SQL}, s AS MATERIALIZED ({kit.split('v', 0.02, 'orders')}), "
    "n AS MATERIALIZED (SELECT q.row_id, t.row_id AS neighbour, list_distance(q.features, t.features) AS distance, "
    "row_number() OVER (PARTITION BY q.row_id ORDER BY list_distance(q.features, t.features), t.row_id) AS rank "
    "FROM (SELECT * FROM s WHERE held) q, (SELECT * FROM s WHERE NOT held) t QUALIFY rank <= 3)"
)


@query("knn_orders", f"WITH {_ORDERS_KNN_SQL} SELECT row_id, rank, neighbour, {r('distance', 4)} AS distance FROM n")
def knn_orders(spark, sf):
    training, validation = train_validation_split(fx.orders(spark, sf), 0.02, "orders")
    found = knn_neighbours(training, validation, k=3)
    return found.select("row_id", "rank", "neighbour", rounded("distance", 4).alias("distance"))


@query("pca_knn_scores")
def pca_knn_scores(spark, sf):
    training, validation = _sets(spark, sf)
    found = jobs.classifier_scores(jobs.pca_knn(training, validation, components=20, seed=3))
    return found.select(*[rounded(c).alias(c) for c in ("precision_macro", "recall_macro", "f1_macro")])


_KNN_2D_SQL = (
    f"{fx.vectors_sql('binary')}, s AS MATERIALIZED ({kit.split('v', 0.1, 'knn')}), "
    "l1 AS (SELECT l.* FROM l JOIN s USING (row_id) WHERE NOT held), "
    f"{kit.principal('l1', 2)}, "
    "z AS MATERIALIZED (SELECT l.row_id, [sum((l.x - mean) * e1.x), sum((l.x - mean) * e2.x)] AS features FROM l "
    "JOIN mu USING (feature) JOIN e1 USING (feature) JOIN e2 USING (feature) GROUP BY l.row_id), "
    "n AS (SELECT q.row_id, t.row_id AS neighbour, s.label, row_number() OVER (PARTITION BY q.row_id ORDER BY "
    "list_distance(q.features, t.features), t.row_id) AS rank FROM z q JOIN s sq ON sq.row_id = q.row_id AND sq.held, "
    "z t JOIN s ON s.row_id = t.row_id AND NOT s.held QUALIFY rank <= 5), "
    "b AS (SELECT row_id, label, count(*) AS n FROM n GROUP BY ALL), "
    "w AS (SELECT row_id, label AS predicted, row_number() OVER (PARTITION BY row_id ORDER BY n DESC, label) AS place FROM b), "
    "p AS (SELECT v.label, w.predicted FROM w JOIN v USING (row_id) WHERE place = 1), "
    "pc AS (SELECT class, "
    "coalesce((SELECT avg(CAST(label = class AS INTEGER)) FROM p WHERE predicted = class), 0) AS prec, "
    "coalesce((SELECT avg(CAST(predicted = class AS INTEGER)) FROM p WHERE label = class), 0) AS rec "
    "FROM (SELECT unnest([0, 1]) AS class)), "
    "pf AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END AS f FROM pc)"
)


@query(
    "pca_knn_2d",
    f"WITH {_KNN_2D_SQL} SELECT {r('avg(prec)')} AS precision_macro, {r('avg(rec)')} AS recall_macro, {r('avg(f)')} AS f1_macro FROM pf",
)
def pca_knn_2d(spark, sf):
    training, validation = _sets(spark, sf)
    found = jobs.classifier_scores(jobs.pca_knn(training, validation, components=2, sample=None))
    return found.select(*[rounded(c).alias(c) for c in ("precision_macro", "recall_macro", "f1_macro")])


# -- network ------------------------------------------------------------------------------

HIDDEN_UNITS = 8


def _kernel(i, j, unit):
    return ((i * 7 + j * 3) % 11 - 5) * unit


def _ruled_network() -> net.Network:
    """64 -> 8 relu -> 1 sigmoid with weights by rule, so that SQL can state them."""
    i, j = np.arange(64)[:, None], np.arange(HIDDEN_UNITS)[None, :]
    hidden = {"kernel": _kernel(i, j, 0.1), "bias": _kernel(np.arange(HIDDEN_UNITS), 1, 0.02)}
    out = {"kernel": _kernel(np.arange(HIDDEN_UNITS)[:, None], 2, 0.2), "bias": np.array([0.05])}
    return net.Network([net.Layer("dense", "relu", hidden), net.Layer("dense", "sigmoid", out)])


_SCORED_SQL = (
    f"{fx.vectors_sql('binary')}, h AS (SELECT l.row_id, j, "
    "greatest(sum(x * (((feature * 7 + j * 3) % 11 - 5) * 0.1)) + ((j * 7 + 3) % 11 - 5) * 0.02, 0) AS a "
    f"FROM l, (SELECT unnest(range({HIDDEN_UNITS})) AS j) GROUP BY l.row_id, j), "
    "p AS (SELECT row_id, label, CAST(1 / (1 + exp(-(sum(a * (((j * 7 + 6) % 11 - 5) * 0.2)) + 0.05))) AS DOUBLE) AS probability "
    "FROM h JOIN v USING (row_id) GROUP BY row_id, label)"
)


@query("network_scores", f"WITH {_SCORED_SQL} SELECT row_id, {r('probability')} AS probability FROM p")
def network_scores(spark, sf):
    scored = net.score_network(fx.vectors(spark, sf, "binary"), _ruled_network())
    return scored.select("row_id", rounded("probability").alias("probability"))


@query(
    "log_loss",
    f"WITH {_SCORED_SQL} SELECT {r('avg(-(label * ln(probability) + (1 - label) * ln(1 - probability)))')} AS log_loss FROM p",
)
def log_loss(spark, sf):
    scored = net.score_network(fx.vectors(spark, sf, "binary"), _ruled_network())
    return net.binary_log_loss(scored).select(rounded("log_loss").alias("log_loss"))


@query(
    "binary_accuracy",
    f"WITH {_SCORED_SQL} SELECT {r('avg(CAST((probability > 0.5) = (label = 1) AS INTEGER))')} AS accuracy FROM p",
)
def binary_accuracy(spark, sf):
    scored = net.score_network(fx.vectors(spark, sf, "binary"), _ruled_network())
    return net.binary_accuracy(scored).select(rounded("accuracy").alias("accuracy"))


EPOCHS, RATE = 3, 0.01


def _training_sql() -> str:
    """One sigmoid unit, full-table steps of Adagrad; ``w<t>(feature, w, s)``, feature -1 is the bias."""
    parts = [
        f"{fx.vectors_sql('binary')}",
        "u AS MATERIALIZED (SELECT row_id, label, feature, x FROM l UNION ALL SELECT row_id, label, -1, 1.0 FROM v)",
        "w0 AS (SELECT DISTINCT feature, CASE WHEN feature < 0 THEN 0.05 "
        "ELSE ((feature * 7 + 3) % 11 - 5) * 0.1 END AS w, 0.0 AS s FROM u)",
    ]
    for t in range(EPOCHS):
        parts += [
            f"p{t} AS MATERIALIZED (SELECT row_id, any_value(label) AS label, CAST(1 / (1 + exp(-sum(x * w))) AS DOUBLE) AS p "
            f"FROM u JOIN w{t} USING (feature) GROUP BY row_id)",
            f"g{t} AS (SELECT feature, avg((p - p{t}.label) * x) AS g FROM u JOIN p{t} USING (row_id) GROUP BY feature)",
            f"w{t + 1} AS MATERIALIZED (SELECT feature, w - {RATE} * g / (sqrt(s + g * g) + 1e-7) AS w, s + g * g AS s "
            f"FROM w{t} JOIN g{t} USING (feature))",
        ]
    return ", ".join(parts)


def _train_unit(spark, sf, fit=net.fit_network):
    start = net.Layer(
        "dense", "sigmoid", {"kernel": _kernel(np.arange(64)[:, None], 1, 0.1), "bias": np.array([0.05])}
    )
    rows = fx.vectors(spark, sf, "binary")
    # One step per epoch: the whole table is the mini-batch.
    return fit(
        rows, network=net.Network([start]), epochs=EPOCHS, learning_rate=RATE, batch_size=rows.count()
    )


@query("network_training", f"WITH {_training_sql()} SELECT feature, {r('w')} AS weight FROM w{EPOCHS} WHERE feature >= 0")
def network_training(spark, sf):
    frame = net.network_frame(spark, _train_unit(spark, sf).network).filter("parameter = 'kernel'")
    return frame.select(F.posexplode("values").alias("feature", "w")).select("feature", rounded("w").alias("weight"))


@query("network_barrier", f"WITH {_training_sql()} SELECT feature, {r('w')} AS weight FROM w{EPOCHS} WHERE feature >= 0")
def network_barrier(spark, sf):
    """The same steps, one barrier stage an epoch."""
    frame = net.network_frame(spark, _train_unit(spark, sf, fit_network_barrier).network).filter("parameter = 'kernel'")
    return frame.select(F.posexplode("values").alias("feature", "w")).select("feature", rounded("w").alias("weight"))


_LOSSES_SQL = " UNION ALL ".join(
    f"SELECT {t} AS epoch, avg(-(label * ln(p) + (1 - label) * ln(1 - p))) AS loss, "
    f"avg(CAST((p > 0.5) = (label = 1) AS INTEGER)) AS accuracy FROM p{t}"
    for t in range(EPOCHS)
)


@query(
    "network_losses",
    f"WITH {_training_sql()}, x AS ({_LOSSES_SQL}) SELECT epoch, {r('loss')} AS loss, {r('accuracy')} AS accuracy FROM x",
)
def network_losses(spark, sf):
    history = _train_unit(spark, sf).history
    return history.select("epoch", rounded("loss").alias("loss"), rounded("accuracy").alias("accuracy"))


def _small_training(spark, sf):
    training, validation = _sets(spark, sf)
    network = net.build_network(64, first=32, hidden=(32, 16), seed=5)
    return net.fit_network(training, validation, network, epochs=2, learning_rate=0.01)


@query("network_history")
def network_history(spark, sf):
    """Batch normalisation, several layers, mini-batches, metrics on held-out rows."""
    history = _small_training(spark, sf).history
    return history.select("epoch", *[rounded(c).alias(c) for c in ("loss", "accuracy", "val_loss", "val_accuracy")])


@query("network_saved", f"WITH {_SCORED_SQL} SELECT row_id, {r('probability')} AS probability FROM p")
def network_saved(spark, sf):
    path = scratch(spark, "network")
    net.save_network(spark, _ruled_network(), path)
    scored = net.score_network(fx.vectors(spark, sf, "binary"), net.load_network(spark, path))
    return scored.select("row_id", rounded("probability").alias("probability"))
