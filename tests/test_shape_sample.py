import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrove.operators import sample, shape


def features(df):
    return {r["row_id"]: list(r["features"]) for r in df.collect()}


def ids(df):
    return sorted(r["row_id"] for r in df.collect())


# -- filters and shaping ------------------------------------------------------------------


def test_filters(vectors):
    df = vectors([[0], [1], [2], [3]], labels=[-1, 0, 1, 1])
    assert ids(shape.drop_unlabelled(df)) == [1, 2, 3]
    assert ids(shape.labelled_only(df)) == [1, 2, 3]
    assert ids(shape.select_class(df, 1)) == [2, 3]


def test_filter_is_pushed_to_the_scan(spark, sf):
    df = shape.drop_unlabelled(spark.read.parquet(f"{sf}/embeddings.parquet"))
    assert "PushedFilters: [IsNotNull(label), Not(EqualTo(label,-1))]" in df._jdf.queryExecution().executedPlan().toString()


def test_mask_order_and_errors(vectors):
    df = vectors([[10, 20, 30]])
    assert features(shape.mask_features(df, (2, 0))) == {0: [30.0, 10.0]}
    for wrong in ((1, 1), (), (-1, 0)):
        with pytest.raises(ValueError):
            shape.mask_features(df, wrong)
    with pytest.raises(Exception, match="past the end"):
        shape.mask_features(df, (0, 3)).collect()


def test_scaling_by_zero_gives_zero(vectors):
    df = vectors([[0, 4], [0, -8]])
    assert features(shape.scale_max_abs(df, [0.0, 8.0])) == {0: [0.0, 0.5], 1: [0.0, -1.0]}


def test_weights(vectors, spark):
    assert features(shape.weight_features(vectors([[2, 3]]), [0.5, 2.0])) == {0: [1.0, 6.0]}
    mask = spark.createDataFrame([(1, 9), (2, 4), (3, 7)], "rank int, feature int")
    weights = {r["rank"]: r["weight"] for r in shape.rank_weights(mask).collect()}
    assert weights == {i: pytest.approx(math.log10(3 / i), abs=1e-15) for i in (1, 2, 3)}


def test_fused_shaping_equals_steps(vectors):
    x = np.random.default_rng(0).normal(size=(20, 5))
    df, mask, scale, weights = vectors(x), [4, 1, 2], [2.0, 0.0, 0.5], [1.0, 3.0, 0.25]
    steps = shape.weight_features(shape.scale_max_abs(shape.mask_features(df, mask), scale), weights)
    assert features(shape.shape_features(df, mask, scale, weights)) == features(steps)


def test_shaping_is_one_projection(vectors):
    df = shape.shape_features(vectors([[1, 2]]), [1], [2.0], [3.0])
    text = df._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Project") == 1


def test_min_max_of_constant_feature(vectors):
    df = vectors([[1, 5], [3, 6]])
    assert features(shape.scale_min_max(df, [1.0, 5.0], [3.0, 5.0])) == {0: [0.0, 0.0], 1: [1.0, 1.0]}


# -- sampling -----------------------------------------------------------------------------


@pytest.fixture(scope="module")
def thousand(spark):
    return spark.range(1000).select(F.col("id").alias("row_id"), (F.col("id") % 3 - 1).cast("int").alias("label"))


@pytest.mark.parametrize("n", [0, 1, 48, 999, 1000])
def test_sample_is_exact_and_in_hash_order(thousand, n):
    drawn = ids(sample.sample_exact(thousand, n, 7))
    assert len(set(drawn)) == len(drawn) == n
    ranked = thousand.withColumn("key", sample.draw_key(7)).orderBy("key", "row_id").limit(n)
    assert drawn == ids(ranked)


def test_sample_depends_on_seed_only(thousand):
    a = ids(sample.sample_exact(thousand, 50, 1))
    assert a == ids(sample.sample_exact(thousand.repartition(5), 50, 1))
    assert a != ids(sample.sample_exact(thousand, 50, 2))


def test_sample_too_large(thousand):
    with pytest.raises(ValueError, match="1001"):
        sample.sample_exact(thousand, 1001, 0)


def test_cut_inside_a_refined_bucket(thousand, monkeypatch):
    plain = ids(sample.sample_exact(thousand, 321, 3))
    monkeypatch.setattr(sample, "BUCKET_ROWS", 1)
    monkeypatch.setattr(sample, "_DIGITS", 1)
    assert ids(sample.sample_exact(thousand, 321, 3)) == plain


def test_sample_is_a_filter(thousand):
    text = sample.sample_exact(thousand, 10, 0)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in text and "Sort" not in text


def test_candidates_come_from_the_sample(thousand):
    drawn = sample.sample_exact(thousand, 100, 7)
    picked = ids(sample.sample_candidates(drawn, 10, 7))
    assert len(picked) == 10 and set(picked) <= set(ids(drawn))


def test_blocks(thousand):
    assert ids(sample.sample_block(thousand, 4, 10)) == [10, 11, 12, 13]
    block = ids(sample.random_block(thousand, 1000, seed=1))
    assert block == list(range(1000))
    drawn = ids(sample.random_block(thousand, 10, seed=2))
    assert drawn == list(range(drawn[0], drawn[0] + 10))
    with pytest.raises(ValueError):
        sample.random_block(thousand, 1001, seed=1)


def test_split_of_25(spark):
    df = spark.range(25).withColumnRenamed("id", "row_id")
    training, validation = sample.train_validation_split(df, 0.1, 5)
    a, b = ids(training), ids(validation)
    assert (len(a), len(b)) == (23, 2)
    assert sorted(a + b) == list(range(25))
    marked = {r["row_id"] for r in sample.with_set(df, 0.1, 5).filter("set = 'validation'").collect()}
    assert marked == set(b)


@pytest.mark.parametrize("p", [0.0, 1.0])
def test_split_extremes(thousand, p):
    training, validation = sample.train_validation_split(thousand, p, 0)
    assert (training.count(), validation.count()) == (int(1000 * (1 - p)), int(1000 * p))
    with pytest.raises(ValueError):
        sample.train_validation_split(thousand, 1.5)


def test_ids_from_elsewhere(thousand):
    ids_only = thousand.select("row_id")
    assert ids(sample.sample_exact(thousand, 33, 4, ids=ids_only)) == ids(sample.sample_exact(thousand, 33, 4))
    assert ids(sample.train_validation_split(thousand, 0.2, 4, ids=ids_only)[1]) == ids(
        sample.train_validation_split(thousand, 0.2, 4)[1]
    )
    assert ids(sample.sample_up_to(thousand, 5000, 1)) == list(range(1000))
    assert ids(sample.sample_up_to(thousand, 12, 1)) == ids(sample.sample_exact(thousand, 12, 1))


def test_draws_count_rows_not_ids(spark):
    df = spark.range(1000).selectExpr("id % 10 AS row_id", "array(cast(id as double)) AS features")
    with pytest.raises(ValueError, match="repeats"):
        sample.sample_exact(df, 15, 1)
    with pytest.raises(ValueError, match="repeats"):
        sample.train_validation_split(df, 0.015, 1)
    assert sample.sample_exact(df, 200, 1).count() == 200  # two whole ids


@pytest.mark.parametrize("width", [3, 300])
def test_shaping_of_any_width_and_of_a_wrong_one(vectors, width):
    x = np.random.default_rng(3).normal(size=(5, width))
    scale, weights = np.linspace(0, 2, width), np.linspace(-1, 1, width)
    got = shape.weight_features(shape.scale_max_abs(vectors(x), scale.tolist()), weights.tolist()).orderBy("row_id").collect()
    with np.errstate(divide="ignore", invalid="ignore"):
        want = np.where(scale == 0, 0, x / scale) * weights
    np.testing.assert_allclose([r["features"] for r in got], want, rtol=1e-15)
    with pytest.raises(Exception, match="another width"):
        shape.scale_max_abs(vectors(x), scale[:-1].tolist()).collect()
