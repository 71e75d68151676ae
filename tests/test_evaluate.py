import numpy as np
import pytest

from vectrove.operators import evaluate as ev
from vectrove.plans import jobs


def pairs(spark, rows, names="cluster, label"):
    a, b = names.split(", ")
    return spark.createDataFrame(rows, f"{a} int, {b} int")


def test_majority(spark):
    rows = [(0, 0), (0, 0), (0, 1), (0, 1), (1, -1), (1, -1), (1, 1), (5, 1), (5, 9), (5, 9)]
    df = pairs(spark, rows)
    assert {tuple(r) for r in ev.majority_label(df, 4).collect()} == {(0, 0), (1, -1), (2, -1), (3, -1)}
    assert {tuple(r) for r in ev.majority_label(df).collect()} == {(0, 0), (1, -1), (5, 9)}
    assert {tuple(r) for r in ev.majority_label(df, labels=(-1, 0, 1)).collect()} == {(0, 0), (1, -1), (5, 1)}


def test_relabel_keeps_every_row_and_unmapped_clusters(spark):
    df = pairs(spark, [(0, 1), (0, 0), (7, 1)])
    named = ev.relabel(df, pairs(spark, [(0, 1)], "cluster, majority"))
    assert sorted((r["cluster"], r["predicted"]) for r in named.collect()) == [(0, 1), (0, 1), (7, 7)]
    assert "BroadcastHashJoin" in named._jdf.queryExecution().executedPlan().toString()


def test_relabel_beyond_the_lookup_bound(spark, monkeypatch):
    from vectrove.operators import centroids

    monkeypatch.setattr(centroids, "LOOKUP_ROWS", 1)
    df = pairs(spark, [(0, 1), (1, 0), (1, 1)])
    named = ev.relabel(df, pairs(spark, [(0, 5), (1, 6)], "cluster, majority"))
    assert sorted(r["predicted"] for r in named.collect()) == [5, 6, 6]


def test_macro_scores(spark):
    df = pairs(spark, [(0, 0), (0, 0), (1, 0), (1, 1)], "label, predicted")
    row = ev.macro_scores(df).first()
    assert row["precision_macro"] == pytest.approx((2 / 3 + 1) / 2)
    assert row["recall_macro"] == pytest.approx((1 + 0.5) / 2)
    assert row["f1_macro"] == pytest.approx((0.8 + 2 / 3) / 2)
    assert ev.accuracy(df).first()[0] == 0.75
    assert ev.precision_macro(df).columns == ["precision_macro"]


def test_scores_equal_definition_over_seen_or_given_labels(spark):
    rng = np.random.default_rng(0)
    y, p = rng.integers(-1, 3, 200), rng.integers(0, 4, 200)
    df = pairs(spark, [(int(a), int(b)) for a, b in zip(y, p)], "label, predicted")
    for labels in (None, (0, 1), (0, 9)):
        classes = sorted(set(y) | set(p)) if labels is None else labels
        wanted = []
        for c in classes:
            hit, claimed, support = ((y == c) & (p == c)).sum(), (p == c).sum(), (y == c).sum()
            precision, recall = hit / claimed if claimed else 0, hit / support if support else 0
            wanted.append((precision, recall, 2 * precision * recall / (precision + recall) if hit else 0))
        row = ev.macro_scores(df, labels).first()
        np.testing.assert_allclose(list(row), np.mean(wanted, axis=0))


def test_confusion(spark):
    df = pairs(spark, [(0, 0), (0, 1), (1, 1), (-1, 1), (3, 0)], "label, predicted")
    rows = {r["truth"]: (r["p_neg1"], r["p_0"], r["p_1"]) for r in ev.confusion_matrix(df, (-1, 0, 1)).collect()}
    assert rows == {-1: (0, 0, 1), 0: (0, 1, 1), 1: (0, 0, 1)}


def test_contingency_balance_purity(spark):
    df = pairs(spark, [(0, 0)] * 3 + [(0, 1)] + [(1, 1)] * 2 + [(1, -1)] * 9)
    table = ev.contingency(df, 3)
    assert {tuple(r) for r in table.collect()} == {(0, 3, 1), (1, 0, 2), (2, 0, 0)}
    assert ev.balance_score(ev.contingency(df), 2).first()[0] == 0.5
    assert ev.balance_score(table, 3).first()[0] == 0.0
    assert {r["cluster"]: r["purity"] for r in ev.purity_score(table).collect()} == {0: pytest.approx(2 / 3), 1: 1.0, 2: None}
    scores = ev.trial_scores(df, 2).first()
    assert (scores["balance"], scores["purity_0"], scores["purity_1"]) == (0.5, pytest.approx(2 / 3), 1.0)
    assert ev.balance_score(ev.contingency(df.filter("label < 0"), 2), 2).first()[0] is None


def test_purity_equals_distance_to_the_ideal_rows(spark):
    """1 - smallest distance of the normalised row to (0, 1) or (1, 0), on all small counts."""
    rows = [(i * 20 + j, i, j) for i in range(20) for j in range(20) if i + j]
    table = spark.createDataFrame(rows, "cluster int, n0 long, n1 long")
    got = {r["cluster"]: r["purity"] for r in ev.purity_score(table).collect()}
    for c, i, j in rows:
        v = np.array([i, j]) / max(i, j)
        wanted = 1 - min(np.linalg.norm(v - [0, 1]), np.linalg.norm(v - [1, 0]))
        assert got[c] == pytest.approx(wanted, abs=1e-12)


def blobs(vectors):
    rng = np.random.default_rng(0)
    y = np.arange(120) % 2
    return vectors(rng.normal(size=(120, 4)) + 9 * y[:, None] * [1, 1, 0, 0], y)


def test_trials_draw_their_own_seeds(vectors):
    df = blobs(vectors)
    inits = [np.array([[0.0] * 4, [9.0, 9, 0, 0]]), np.array([[9.0, 9, 0, 0], [0.0] * 4])]
    rows = jobs.kmeans_trials(df, 2, inits=inits, max_iter=3).orderBy("trial").collect()
    assert [(r["trial"], r["balance"], r["purity_0"], r["purity_1"]) for r in rows] == [(0, 1, 1, 1), (1, 1, 1, 1)]
    mean = jobs.repeat_trials(df, 2, inits=inits, max_iter=3).first()
    assert (mean["balance"], mean["purity_0"]) == (1.0, 1.0) and mean["seconds"] > 0


def test_mask_size_report(vectors):
    df = blobs(vectors)
    report = jobs.mask_size_report(df, (4, 2), inits=lambda shaped, m: shaped.filter("row_id < 2").select(
        shaped.row_id.cast("int").alias("cluster"), "features"), max_iter=3)
    rows = {r["mask_size"]: (r["balance"], r["purity"]) for r in report.collect()}
    assert rows == {4: (1.0, 1.0), 2: (1.0, 1.0)}


def test_all_labels_count_and_a_third_class_is_an_error(spark):
    df = spark.createDataFrame([(0, 7), (0, 7), (0, 1)], "cluster int, label int")
    assert [tuple(r) for r in ev.majority_label(df).collect()] == [(0, 7)]
    assert [tuple(r) for r in ev.majority_label(df, labels=(0, 1)).collect()] == [(0, 1)]
    with pytest.raises(Exception, match="labels above 1"):
        ev.contingency(df, 1).collect()
