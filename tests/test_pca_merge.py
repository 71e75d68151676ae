import numpy as np
import pytest

from vectrove.operators.pca import fit_pca
from vectrove.operators.pca_merge import fit_pca_merged


def table(spark, x, parts):
    rows = [(i, row.tolist()) for i, row in enumerate(x)]
    return spark.createDataFrame(rows, "row_id long, features array<double>").repartition(parts)


@pytest.fixture(scope="module")
def x():
    draw = np.random.default_rng(3)
    return draw.normal(size=(600, 6)) * [9, 7, 5, 4, 3, 2] @ draw.normal(size=(6, 30)) + 0.1 * draw.normal(size=(600, 30)) + 5


def test_full_rank_is_exact(spark, x):
    df = table(spark, x, 20)  # two levels of merging
    exact, (model, bound) = fit_pca(df, 5), fit_pca_merged(df, 5, rank=30)
    assert bound < 1e-20
    np.testing.assert_allclose(model.mean, exact.mean, rtol=1e-12)
    np.testing.assert_allclose(model.variance, exact.variance, rtol=1e-10)
    np.testing.assert_allclose(model.ratio, exact.ratio, rtol=1e-10)
    np.testing.assert_allclose(model.components, exact.components, atol=1e-8)


def test_low_rank_keeps_to_its_bound(spark, x):
    df = table(spark, x, 5)
    exact, (model, bound) = fit_pca(df, 5), fit_pca_merged(df, 5, rank=10)
    assert 0 < bound < 0.05 * exact.variance[4]
    assert np.abs(model.variance - exact.variance).max() <= bound
    assert (np.abs((model.components * exact.components).sum(axis=1)) > 0.9999).all()


def test_wider_than_a_covariance_allows(spark):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(40, 3)) * [50, 30, 10] @ draw.normal(size=(3, 12_000)) + draw.normal(size=(40, 12_000))
    model, bound = fit_pca_merged(table(spark, x, 3), 3, rank=40)
    s = np.linalg.svd(x - x.mean(axis=0), compute_uv=False)
    np.testing.assert_allclose(model.variance, s[:3] ** 2 / 39, atol=bound + 1e-6, rtol=1e-9)
    assert model.components.shape == (3, 12_000)


def test_empty_and_equal_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0])] * 4, "row_id long, features array<double>")
    with pytest.raises(ValueError, match="two rows"):
        fit_pca_merged(df.where("row_id > 0"), 1)
    model, bound = fit_pca_merged(df, 1)
    assert bound == 0 and model.variance.tolist() == [0.0] and model.ratio.tolist() == [0.0]
