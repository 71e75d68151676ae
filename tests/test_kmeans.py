import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrove.functions import kernels
from vectrove.operators import kmeans as km
from vectrove.operators.centroids import centroid_frame
from vectrove.operators import neighbours
from vectrove.operators.neighbours import assign_clusters


def by_id(df, *columns):
    return {r["row_id"]: tuple(r[c] for c in columns) for r in df.collect()}


def centroids_of(result):
    return [r["centroid"] for r in result.centroids.orderBy("cluster").collect()]


def random_rows(n, d, seed=0):
    return np.random.default_rng(seed).normal(size=(n, d))


def brute_lloyd(x, means, passes):
    for _ in range(passes):
        d = np.sqrt(((x[:, None, :] - means[None]) ** 2).sum(2))
        cluster = np.nanargmin(d, axis=1)
        error = d[np.arange(len(x)), cluster]
        with np.errstate(invalid="ignore"):
            new = np.array([x[cluster == j].mean(0) if (cluster == j).any() else np.full(x.shape[1], np.nan) for j in range(len(means))])
        used, means = means, new
    return cluster, error, means, used


def test_tie_goes_to_lowest(vectors):
    df = assign_clusters(vectors([[0]]), np.array([[-1.0], [1.0]]))
    assert by_id(df, "cluster", "error") == {0: (0, 1.0)}


def test_metric_and_all_columns_kept(vectors):
    df = assign_clusters(vectors([[3]], labels=[7]), np.array([[1.0]]), metric="squared")
    assert df.columns == ["row_id", "features", "label", "cluster", "error"]
    assert by_id(df, "label", "error") == {0: (7, 4.0)}
    with pytest.raises(ValueError):
        assign_clusters(df, np.array([[1.0]]), metric="manhattan")


def test_empty_cluster_gets_no_mean_and_is_never_chosen(vectors):
    result = km.kmeans(vectors([[0], [1]]), 2, max_iter=3, min_delta=-1.0, init=np.array([[0.0], [100.0]]))
    assert centroids_of(result) == [[0.5], None]
    assert [tuple(r) for r in result.sizes.orderBy("cluster").collect()] == [(0, 2), (1, 0)]
    assert {c for (c,) in by_id(result.assignments, "cluster").values()} == {0}


def test_nan_rows_are_lost_to_cluster_zero(vectors):
    df = assign_clusters(vectors([[float("nan")], [5]]), np.array([[0.0], [5.0]]))
    assert by_id(df, "cluster", "error") == {0: (0, kernels.UNREACHABLE), 1: (1, 0.0)}


def test_stale_assignment(vectors):
    result = km.kmeans(vectors([[0], [2], [3]]), 2, max_iter=1, init=np.array([[0.0], [2.0]]))
    assert by_id(result.assignments, "cluster") == {0: (0,), 1: (1,), 2: (1,)}
    assert centroids_of(result) == [[0.0], [2.5]]


def test_stops_on_small_delta_but_runs_once(vectors):
    df = vectors([[0], [1], [10], [11]])
    result = km.kmeans(df, 2, max_iter=20, min_delta=0.1, init=np.array([[0.0], [10.0]]))
    history = [tuple(r)[:3] for r in result.history.orderBy("iteration").collect()]
    assert history == [(0, 0.5, None), (1, 0.5, 0.0)]
    assert km.kmeans(df, 2, max_iter=0, init=np.array([[0.0], [10.0]])).iterations == 1


def test_k_of_one_and_wrong_init(vectors):
    df = vectors([[0], [4]])
    assert centroids_of(km.kmeans(df, 1, max_iter=1, init=np.array([[1.0]]))) == [[2.0]]
    with pytest.raises(ValueError):
        km.kmeans(df, 3, init=np.array([[1.0]]))


@pytest.mark.parametrize("k", [2, 3, 9])
def test_matches_brute_force(vectors, k):
    x = random_rows(400, 7, seed=k)
    seeds = x[:k].copy()
    cluster, error, means, used = brute_lloyd(x, seeds, 4)
    result = km.kmeans(vectors(x, partitions=5), k, max_iter=4, min_delta=-1.0, init=seeds)
    got = by_id(result.assignments, "cluster", "error")
    assert [got[i][0] for i in range(len(x))] == cluster.tolist()
    np.testing.assert_allclose([got[i][1] for i in range(len(x))], error, rtol=1e-12)
    np.testing.assert_allclose(centroids_of(result), means, rtol=1e-12)
    assert sum(r["n"] for r in result.sizes.collect()) == len(x)


def test_partitioning_does_not_matter(vectors):
    x = random_rows(300, 5, seed=3)
    runs = [km.kmeans(vectors(x, partitions=p), 3, max_iter=5, min_delta=-1.0, init=x[:3]) for p in (1, 7)]
    np.testing.assert_allclose(centroids_of(runs[0]), centroids_of(runs[1]), rtol=1e-10)


def test_crowded_input_is_spread_once(spark, monkeypatch):
    from vectrove.operators import reduce as red

    monkeypatch.setattr(red, "SPREAD_ROWS", 10)
    crowded = spark.range(400).coalesce(1).selectExpr("array(cast(id as double)) AS features")
    kept = red.cached(crowded)
    sizes = [r["count"] for r in kept.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == spark.sparkContext.defaultParallelism and sum(sizes) == 400
    assert not crowded.is_cached
    kept.unpersist()
    wide = red.cached(spark.range(0, 400, 1, 8).selectExpr("array(cast(id as double)) AS features"))
    assert "Exchange" not in plan(wide)
    wide.unpersist()


def test_hot_cluster(vectors):
    """Two thirds of all rows are copies of one vector."""
    x = np.vstack([np.tile([1.0, 2.0], (400, 1)), random_rows(200, 2, seed=5) + 8])
    cluster, _, means, _ = brute_lloyd(x, x[[0, 450]].copy(), 3)
    result = km.kmeans(vectors(x, partitions=6), 2, max_iter=3, min_delta=-1.0, init=x[[0, 450]])
    np.testing.assert_allclose(centroids_of(result), means)
    assert [r["n"] for r in result.sizes.orderBy("cluster").collect()] == np.bincount(cluster).tolist()


def test_assignment_past_the_broadcast_bound_is_the_same(spark, vectors, monkeypatch):
    """With and without unique row ids; ties and rows without a distance included."""
    x, c = random_rows(300, 4, seed=8), random_rows(17, 4, seed=9)
    x[7], x[8] = np.nan, c[3]
    means = np.vstack([c, c[3:5], np.full((1, 4), np.nan)])
    frame = centroid_frame(spark, means)
    repeated = vectors(x).withColumn("row_id", F.col("row_id") % 5).withColumn("n", F.col("features")[0])
    bare = repeated.select("features", "n")

    def found(df):
        return sorted((repr(r["n"]), r["cluster"], round(r["error"], 9)) for r in assign_clusters(df, frame).collect())

    wanted = found(repeated)
    for bound in (20, 30, 79):
        monkeypatch.setattr(neighbours, "BROADCAST_NUMBERS", bound)
        monkeypatch.setattr(neighbours, "as_matrix", lambda p, **_: as_matrix_unbounded(p))
        assert found(repeated) == wanted
        assert found(bare) == wanted
        assert "Exchange" not in plan(assign_clusters(vectors(x).drop("label"), frame)).replace("REPARTITION_BY_NUM", "").split("ArrowEvalPython")[0]


def as_matrix_unbounded(points):
    from vectrove.operators.centroids import as_matrix

    return as_matrix(points, bounded=True)


def test_kernel_finds_exact_ties_among_many_points():
    points = np.repeat(np.arange(6.0)[:, None], 3, axis=1)
    x = np.array([[0.5] * 3, [2.5] * 3, [4.0] * 3, [1e9] * 3])
    best, error = kernels.nearest(x, points)
    assert best.tolist() == [0, 2, 4, 5]
    np.testing.assert_allclose(error[:3] ** 2, [0.75, 0.75, 0.0])


def test_kernel_far_from_origin():
    """Large offsets drown small distances in a product form; the result must not."""
    points = 1e8 + np.arange(8.0)[:, None] * 0.25
    x = points + 0.01
    best, error = kernels.nearest(x, points)
    assert best.tolist() == list(range(8))
    np.testing.assert_allclose(error, x[:, 0] - points[:, 0], rtol=1e-12)


def test_update_centroids_and_sizes(vectors):
    df = vectors([[1, 2], [3, 4], [10, 20]], labels=[0, 0, 5]).withColumnRenamed("label", "cluster")
    rows = {(r["cluster"], r["feature"]): (r["mean"], r["n"]) for r in km.update_centroids(df).collect()}
    assert rows == {(0, 0): (2.0, 2), (0, 1): (3.0, 2), (5, 0): (10.0, 1), (5, 1): (20.0, 1)}
    assert {tuple(r) for r in km.cluster_sizes(df).collect()} == {(0, 2), (5, 1)}


def test_ragged_and_null_vectors_are_errors(spark):
    for rows in ([(0, [1.0]), (1, [1.0, 2.0])], [(0, [1.0]), (1, None)]):
        df = spark.createDataFrame(rows, "row_id bigint, features array<double>").coalesce(1)
        with pytest.raises(Exception, match="width|NULL"):
            assign_clusters(df, np.array([[0.0]])).collect()


# -- freezing -----------------------------------------------------------------------------


def test_freezing_case(vectors):
    df = vectors([[0], [2], [10]])
    result = km.kmeans_freezing(df, np.array([[0.0], [10.0]]), max_iter=1, freeze=5.0, min_delta=0.0)
    assert centroids_of(result) == [[2 / 3], [10.0]]
    assert by_id(result.assignments, "cluster", "error", "frozen") == {
        0: (0, 0.0, True),
        1: (0, 4.0, True),
        2: (1, 0.0, True),
    }


def replay(x, seeds, passes, freeze):
    """Plain per-row bookkeeping of the same rule."""
    n, k = len(x), len(seeds)
    total, count, means = seeds.copy(), np.ones(k), seeds.copy()
    cluster, error, live = np.zeros(n, int), np.ones(n), np.ones(n, bool)
    mean_errors = []
    for _ in range(passes):
        for i in np.flatnonzero(live):
            d = ((means - x[i]) ** 2).sum(1)
            cluster[i], error[i] = d.argmin(), d.min()
            if error[i] < freeze:
                live[i] = False
                count[cluster[i]] += 1
                total[cluster[i]] = total[cluster[i]] + x[i]
        means = total / count[:, None]
        mean_errors.append(error.mean())
    return cluster, error, ~live, means, mean_errors


@pytest.mark.parametrize("freeze", [0.5, 3.0, 1e9])
def test_freezing_equals_replay(vectors, freeze):
    x = random_rows(120, 3, seed=4)
    seeds = x[[0, 1, 2]].copy()
    cluster, error, frozen, means, errors = replay(x, seeds, 5, freeze)
    result = km.kmeans_freezing(vectors(x, partitions=4), seeds, max_iter=5, freeze=freeze, min_delta=-1.0)
    got = by_id(result.assignments, "cluster", "error", "frozen")
    assert [got[i][0] for i in range(len(x))] == cluster.tolist()
    assert [got[i][2] for i in range(len(x))] == frozen.tolist()
    np.testing.assert_allclose([got[i][1] for i in range(len(x))], error, rtol=1e-9)
    np.testing.assert_allclose(centroids_of(result), means, rtol=1e-9)
    np.testing.assert_allclose([r["mean_error"] for r in result.history.orderBy("iteration").collect()], errors)


def test_many_seeds_and_small_tables(vectors):
    x = random_rows(300, 2, seed=6)
    result = km.kmeans(vectors(x, partitions=3), 60, max_iter=2, seed=2)
    assert result.sizes.count() == 60 and result.iterations == 2
    assert km.kmeans(vectors(x[:40]), 3, max_iter=2, sample_rows=30, candidate_rows=10).sizes.count() == 3
    with pytest.raises(ValueError, match="cannot give"):
        km.kmeans(vectors(x), 60, candidate_rows=10)


# -- plans --------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_assignment_is_one_map_over_needed_columns(spark, sf):
    from catalogue import fixtures as fx

    text = plan(assign_clusters(fx.vectors(spark, sf), np.zeros((2, 64))).select("row_id", "cluster", "error"))
    assert text.count("ArrowEvalPython") == 1
    assert "Exchange" not in text
    assert "ReadSchema: struct<vec_id:bigint,embedding:array<float>>" in text


def test_filter_reaches_the_scan_below_an_assignment(spark, sf):
    from catalogue import fixtures as fx

    assigned = assign_clusters(fx.vectors(spark, sf), np.zeros((2, 64))).filter(F.col("row_id") > 100)
    assert "GreaterThan(vec_id,100)" in plan(assigned)


def test_pass_shuffles_partials_only(spark, vectors):
    df = vectors([[0, 0], [1, 1]])

    def fold(x, sums):
        kernels.assign_and_sum(x, np.zeros((2, 2)), True, sums)

    text = plan(km.partial_sums(df.select("features"), 2, 2, fold).groupBy("cluster", "feature").sum("total"))
    assert text.index("HashAggregate") < text.index("MapInArrow")
