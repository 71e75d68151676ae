import numpy as np
import pytest

from vectrove.operators import stats


def table(df, key="feature"):
    return {r[key]: r.asDict() for r in df.collect()}


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(500, 6)) * [1, 10, 0.1, 1, 1, 0] + [0, 5, -3, 1e6, 0, 0]
    return x, rng.integers(-1, 2, size=500)


@pytest.fixture
def df(vectors, data):
    return vectors(data[0], data[1], partitions=7)


def test_summary(df, data):
    x, _ = data
    got = table(stats.feature_summary(df))
    for j in range(6):
        assert got[j]["n"] == 500
        assert got[j]["mean"] == pytest.approx(x[:, j].mean(), rel=1e-12, abs=1e-12)
        assert got[j]["sd"] == pytest.approx(x[:, j].std(), rel=1e-9, abs=1e-12)
        assert (got[j]["min"], got[j]["max"]) == (x[:, j].min(), x[:, j].max())


def test_summary_by_group(df, data):
    x, y = data
    for r in stats.feature_summary(df, "label").collect():
        column = x[y == r["label"], r["feature"]]
        assert (r["n"], r["mean"]) == (len(column), pytest.approx(column.mean(), rel=1e-12, abs=1e-12))
        assert r["sd"] == pytest.approx(column.std(), rel=1e-9, abs=1e-12)


def test_small_spread_on_a_large_offset(vectors):
    x = 1e9 + np.random.default_rng(0).normal(size=(300, 1))
    got = table(stats.feature_summary(vectors(x, partitions=5)))[0]
    assert got["sd"] == pytest.approx(x.std(), rel=1e-6)


def test_many_groups_are_flushed(df, data, monkeypatch):
    monkeypatch.setattr(stats, "_HELD_ELEMENTS", 6)
    x, y = data
    got = {(r["label"], r["feature"]): r["mean"] for r in stats.class_mean_vectors(df).collect()}
    assert got[(1, 1)] == pytest.approx(x[y == 1, 1].mean(), rel=1e-12)
    assert len(got) == 18


def test_clamp(vectors):
    df = vectors([[2, -1], [5, -3]])
    assert {f: (r["min"], r["max"]) for f, r in table(stats.feature_min_max(df)).items()} == {0: (0, 5), 1: (-3, 0)}
    assert {f: (r["min"], r["max"]) for f, r in table(stats.feature_min_max(df, False)).items()} == {0: (2, 5), 1: (-3, -1)}


def test_contrast(df, data):
    x, y = data
    got = table(stats.class_contrast_report(df))
    for j in range(6):
        m0, m1 = x[y == 0, j].mean(), x[y == 1, j].mean()
        assert got[j]["mean_0"] == pytest.approx(m0, abs=1e-6)
        assert got[j]["difference"] == pytest.approx(abs(m0 - m1), abs=2e-6)
        assert got[j]["max"] == pytest.approx(max(0, x[:, j].max()), abs=1e-6)


def test_contrast_without_a_class(vectors):
    got = table(stats.class_contrast_report(vectors([[1], [2]], labels=[0, -1])))[0]
    assert (got["mean_0"], got["mean_1"], got["difference"], got["max"]) == (1.0, None, None, 2.0)


def test_scaled_deviation(df, data):
    x, _ = data
    got = table(stats.feature_mean_sd(df))
    written = table(stats.feature_mean_sd(df, as_written=True))
    for j in range(5):
        scaled = x[:, j] / np.abs(x[:, j]).max()
        assert got[j]["sd"] == pytest.approx(scaled.std(), rel=1e-6, abs=1e-12)
        as_written = np.sqrt(((scaled.mean() - scaled / 500) ** 2).sum() / 500)
        assert written[j]["sd"] == pytest.approx(as_written, rel=1e-9)
    assert (got[5]["max_abs"], got[5]["mean"], got[5]["sd"]) == (0.0, 0.0, 0.0)


def test_top_and_low(df, data):
    x, _ = data
    scale = np.where(np.abs(x).max(0) == 0, 1, np.abs(x).max(0))
    order = np.argsort(-(x / scale).std(0), kind="stable")[:3]
    top = stats.top_features_by_sd(df, 3).orderBy("rank").collect()
    assert [r["feature"] for r in top] == order.tolist()
    assert [r["rank"] for r in top] == [1, 2, 3]
    span = np.where(x.max(0) == x.min(0), 1, x.max(0) - x.min(0))
    means = ((x - x.min(0)) / span).mean(0)
    low = stats.low_mean_features(df, df, 2).collect()
    assert {r["feature"] for r in low} == set(np.argsort(means, kind="stable")[:2].tolist())


def test_float_and_double_input_agree(df):
    narrow = df.withColumn("features", df["features"].cast("array<float>"))
    a, b = table(stats.feature_summary(df)), table(stats.feature_summary(narrow))
    assert all(a[j]["mean"] == pytest.approx(b[j]["mean"], rel=1e-6, abs=1e-6) for j in a)


def test_one_shuffle(df):
    text = stats.feature_summary(df, "label")._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(grp") == 1


def test_empty_table(vectors):
    assert stats.feature_summary(vectors([[1]]).filter("row_id < 0")).count() == 0
