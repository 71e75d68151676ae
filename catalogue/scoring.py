"""Scores of clusterings and classifications."""

from pyspark.sql import functions as F

from catalogue import fixtures as fx
from catalogue import sqlkit as kit
from catalogue.clustering import drawn_seeds
from catalogue.registry import query, r, rounded
from vectrove.operators import evaluate
from vectrove.operators.centroids import as_matrix
from vectrove.operators.neighbours import assign_clusters
from vectrove.plans import jobs

# Clusters of the embeddings, some of them without rows, with ternary labels.
K = 5
_ASSIGNED_SQL = (
    f"{fx.vectors_sql()}, {kit.seeds('v', K, 'score')}, {kit.assigned('v', 'c0', 'a')}, "
    "n AS (SELECT a.cluster, v.label, count(*) AS n FROM a JOIN v USING (row_id) GROUP BY a.cluster, v.label), "
    "w AS (SELECT cluster, label, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS place FROM n), "
    "m AS (SELECT k.cluster, coalesce(w.label, -1) AS majority FROM (SELECT unnest(range(6)) AS cluster) k "
    "LEFT JOIN w ON w.cluster = k.cluster AND w.place = 1), "
    "p AS (SELECT a.row_id, a.cluster, v.label, m.majority AS predicted FROM a JOIN v USING (row_id) JOIN m USING (cluster))"
)
_SCORES_SQL = (
    "classes AS (SELECT label AS class FROM p UNION SELECT predicted FROM p), "
    "pc AS (SELECT class, "
    "coalesce((SELECT avg(CAST(label = class AS INTEGER)) FROM p WHERE predicted = class), 0) AS prec, "
    "coalesce((SELECT avg(CAST(predicted = class AS INTEGER)) FROM p WHERE label = class), 0) AS rec FROM classes), "
    "pf AS (SELECT *, CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0 END AS f FROM pc)"
)


def _assigned(spark, sf):
    rows = fx.vectors(spark, sf)
    return assign_clusters(rows, as_matrix(drawn_seeds(rows, K, "score"), "cluster", "features", bounded=True))


def _predicted(spark, sf):
    rows = _assigned(spark, sf)
    return evaluate.relabel(rows, evaluate.majority_label(rows, K + 1))


@query("majority_label", f"WITH {_ASSIGNED_SQL} SELECT cluster, majority FROM m")
def majority_label(spark, sf):
    return evaluate.majority_label(_assigned(spark, sf), K + 1)


@query("relabel", f"WITH {_ASSIGNED_SQL} SELECT row_id, cluster, label, predicted FROM p")
def relabel(spark, sf):
    return _predicted(spark, sf).select("row_id", "cluster", "label", "predicted")


@query("accuracy", f"WITH {_ASSIGNED_SQL} SELECT {r('avg(CAST(label = predicted AS INTEGER))')} AS accuracy FROM p")
def accuracy(spark, sf):
    return evaluate.accuracy(_predicted(spark, sf)).select(rounded("accuracy").alias("accuracy"))


def _macro(name, column, sql):
    @query(name, f"WITH {_ASSIGNED_SQL}, {_SCORES_SQL} SELECT {r(f'avg({column})')} AS {name} FROM pf")
    def run(spark, sf):
        return getattr(evaluate, name)(_predicted(spark, sf)).select(rounded(name).alias(name))


_macro("precision_macro", "prec", None)
_macro("recall_macro", "rec", None)
_macro("f1_macro", "f", None)


@query(
    "class_scores",
    f"WITH {_ASSIGNED_SQL}, {_SCORES_SQL} SELECT class, {r('prec')} AS precision, {r('rec')} AS recall, {r('f')} AS f1, "
    "(SELECT count(*) FROM p WHERE label = class) AS support FROM pf",
)
def class_scores(spark, sf):
    found = evaluate.class_scores(_predicted(spark, sf))
    return found.select("class", *[rounded(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query(
    "confusion",
    f"WITH {_ASSIGNED_SQL} SELECT t.truth, count(*) FILTER (WHERE predicted = -1) AS p_neg1, "
    "count(*) FILTER (WHERE predicted = 0) AS p_0, count(*) FILTER (WHERE predicted = 1) AS p_1 "
    "FROM (SELECT unnest([-1, 0, 1]) AS truth) t LEFT JOIN p ON p.label = t.truth GROUP BY t.truth",
)
def confusion(spark, sf):
    return evaluate.confusion_matrix(_predicted(spark, sf), (-1, 0, 1))


_TABLE_SQL = f"{_ASSIGNED_SQL}, {kit.contingency('a', 'v', 't', K + 1)}"


@query("contingency", f"WITH {_TABLE_SQL} SELECT cluster, n0, n1 FROM t")
def contingency(spark, sf):
    return evaluate.contingency(_assigned(spark, sf), K + 1)


@query("balance", f"WITH {_TABLE_SQL} SELECT {r(kit.BALANCE)} AS balance FROM t")
def balance(spark, sf):
    table = evaluate.contingency(_assigned(spark, sf))
    return evaluate.balance_score(table, K + 1).select(rounded("balance").alias("balance"))


@query("purity", f"WITH {_TABLE_SQL} SELECT cluster, {r(kit.PURITY)} AS purity FROM t")
def purity(spark, sf):
    found = evaluate.purity_score(evaluate.contingency(_assigned(spark, sf), K + 1))
    return found.select("cluster", rounded("purity").alias("purity"))


@query(
    "document_labels",
    f"WITH {fx.DOCUMENTS_SQL}, n AS (SELECT n_chars % 7 AS cluster, label, count(*) AS n FROM d GROUP BY ALL), "
    "w AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS place FROM n) "
    "SELECT cluster, label AS majority FROM w WHERE place = 1",
)
def document_labels(spark, sf):
    """Majority of part-labelled rows, where unlabelled ones may win."""
    rows = fx.documents(spark, sf).withColumn("cluster", (F.col("n_chars") % 7).cast("int"))
    return evaluate.majority_label(rows)


@query(
    "majority_ten",
    f"WITH {fx.vectors_sql('ten')}, n AS (SELECT CAST(row_id % 7 AS INTEGER) AS cluster, label, count(*) AS n FROM v GROUP BY ALL), "
    "w AS (SELECT *, row_number() OVER (PARTITION BY cluster ORDER BY n DESC, label) AS place FROM n) "
    "SELECT cluster, label AS majority FROM w WHERE place = 1",
)
def majority_ten(spark, sf):
    """Majority among ten labels: none is left out."""
    rows = fx.vectors(spark, sf, "ten").withColumn("cluster", (F.col("row_id") % 7).cast("int"))
    return evaluate.majority_label(rows)


# -- trials -------------------------------------------------------------------------------

TRIALS = 3
TRIAL_PASSES = 2


def _trial_sql(t: int) -> str:
    return (
        f"{kit.seeds('v', 2, f'trial{t}', f's{t}')}, {kit.lloyd('v', 'l', TRIAL_PASSES, f's{t}', f'_{t}')}, "
        f"{kit.contingency(f'a{TRIAL_PASSES}_{t}', 'v', f't{t}', 2)}"
    )


def _score_row(table: str, extra: str) -> str:
    return (
        f"SELECT {extra}, {kit.BALANCE} AS balance, max({kit.PURITY}) FILTER (WHERE cluster = 0) AS purity_0, "
        f"max({kit.PURITY}) FILTER (WHERE cluster = 1) AS purity_1 FROM {table}"
    )


_TRIALS_SQL = (
    f"{fx.vectors_sql()}, {', '.join(_trial_sql(t) for t in range(TRIALS))}, "
    f"x AS ({' UNION ALL '.join(_score_row(f't{t}', f'{t} AS trial') for t in range(TRIALS))})"
)


def _trials(spark, sf):
    rows = fx.vectors(spark, sf)
    inits = [drawn_seeds(rows, 2, f"trial{t}") for t in range(TRIALS)]
    return rows, dict(trials=TRIALS, k=2, inits=inits, max_iter=TRIAL_PASSES, min_delta=-1.0)


@query(
    "trials",
    f"WITH {_TRIALS_SQL} SELECT trial, {r('balance')} AS balance, {r('purity_0')} AS purity_0, "
    f"{r('purity_1')} AS purity_1 FROM x",
)
def trials(spark, sf):
    rows, options = _trials(spark, sf)
    found = jobs.kmeans_trials(rows, **options)
    return found.select("trial", *[rounded(c).alias(c) for c in ("balance", "purity_0", "purity_1")])


@query(
    "repeat_trials",
    f"WITH {_TRIALS_SQL} SELECT {r('avg(balance)')} AS balance, {r('avg(purity_0)')} AS purity_0, "
    f"{r('avg(purity_1)')} AS purity_1 FROM x",
)
def repeat_trials(spark, sf):
    rows, options = _trials(spark, sf)
    found = jobs.repeat_trials(rows, **options)
    return found.select(*[rounded(c).alias(c) for c in ("balance", "purity_0", "purity_1")])


MASKS = (64, 48, 32)


def _mask_sql(m: int) -> str:
    """Shaped table, seeds, two passes and scores for one mask size."""
    return (
        f"l{m} AS MATERIALIZED (SELECT row_id, label, rank - 1 AS feature, x / scale * log10({m}.0 / rank) AS x "
        f"FROM l JOIN mask USING (feature) WHERE rank <= {m}), "
        f"v{m} AS MATERIALIZED (SELECT row_id, any_value(label) AS label, list(x ORDER BY feature) AS features "
        f"FROM l{m} GROUP BY row_id), "
        f"{kit.seeds(f'v{m}', 2, 'mask', f's{m}')}, {kit.lloyd(f'v{m}', f'l{m}', TRIAL_PASSES, f's{m}', f'_{m}')}, "
        f"{kit.contingency(f'a{TRIAL_PASSES}_{m}', f'v{m}', f't{m}', 2)}"
    )


@query(
    "mask_size_report",
    f"WITH {fx.vectors_sql()}, g AS (SELECT feature, max(abs(x)) AS scale, stddev_pop(x) / max(abs(x)) AS sd "
    "FROM l GROUP BY feature), "
    "mask AS MATERIALIZED (SELECT feature, scale, row_number() OVER (ORDER BY sd DESC, feature) AS rank FROM g), "
    f"{', '.join(_mask_sql(m) for m in MASKS)}, "
    f"x AS ({' UNION ALL '.join(_score_row(f't{m}', f'{m} AS mask_size') for m in MASKS)}) "
    f"SELECT mask_size, {r('balance')} AS balance, {r('(purity_0 + purity_1) / 2')} AS purity FROM x",
)
def mask_size_report(spark, sf):
    found = jobs.mask_size_report(
        fx.vectors(spark, sf),
        MASKS,
        inits=lambda shaped, size: drawn_seeds(shaped, 2, "mask"),
        max_iter=TRIAL_PASSES,
        min_delta=-1.0,
    )
    return found.select("mask_size", rounded("balance").alias("balance"), rounded("purity").alias("purity"))
