import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrove.functions import kernels
from vectrove.operators import cells, distance, neighbours, seeding
from vectrove.operators.neighbours import knn_classify, knn_lists, knn_neighbours


def brute(train, queries, k):
    d = np.sqrt(((queries[:, None, :] - train[None]) ** 2).sum(2))
    order = np.lexsort((np.broadcast_to(np.arange(len(train)), d.shape), d), axis=1)[:, :k]
    return order, np.take_along_axis(d, order, axis=1)


def lists_of(df):
    return {r["row_id"]: [(n["neighbour"], n["distance"]) for n in r["neighbours"]] for r in df.collect()}


STRATEGIES = ["scan_queries", "scan_train", "grid", "cells", "auto"]


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_equals_brute_force(vectors, strategy):
    rng = np.random.default_rng(6)
    t, q = rng.normal(size=(400, 5)), rng.normal(size=(60, 5))
    order, d = brute(t, q, 4)
    got = lists_of(knn_lists(vectors(t, partitions=5), vectors(q, partitions=3), 4, strategy=strategy, block_numbers=250))
    assert [[n for n, _ in got[i]] for i in range(60)] == order.tolist()
    np.testing.assert_allclose([[x for _, x in got[i]] for i in range(60)], d, rtol=1e-12)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_copies_tie_by_row_id(vectors, strategy):
    """Half of the train rows are copies of one vector: the lowest ids win."""
    t = np.vstack([np.zeros((100, 2)), np.random.default_rng(1).normal(size=(100, 2)) + 50])
    got = lists_of(knn_lists(vectors(t, partitions=4), vectors([[0, 0]], partitions=1), 5, strategy=strategy, block_numbers=60))
    assert got == {0: [(i, 0.0) for i in range(5)]}


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_fewer_rows_than_k(vectors, strategy):
    got = lists_of(knn_lists(vectors([[1], [2]]), vectors([[0]]), 5, strategy=strategy))
    assert got == {0: [(0, 1.0), (1, 2.0)]}


def test_far_from_origin_is_exact(vectors):
    t = 1e7 + np.arange(50.0)[:, None] * [1e-3, 1e-3]
    order, _ = brute(t, t, 3)
    got = lists_of(knn_lists(vectors(t), vectors(t), 3))
    assert [[n for n, _ in got[i]] for i in range(50)] == order.tolist()


def test_kernel_in_pieces(monkeypatch):
    rng = np.random.default_rng(3)
    t, q = rng.integers(0, 4, size=(500, 3)).astype(float), rng.integers(0, 4, size=(37, 3)).astype(float)
    monkeypatch.setattr(kernels.ClosestK, "_TRAIN", 33)
    monkeypatch.setattr(kernels.ClosestK, "_QUERIES", 8)
    best = kernels.ClosestK(q, 6)
    for part in np.array_split(np.random.default_rng(0).permutation(500), 4):
        best.add(t[part], part, part * 10)
    order, d = brute(t, q, 6)
    assert np.array_equal(best.ids, order)
    assert np.array_equal(best.labels, order * 10)
    np.testing.assert_allclose(np.sqrt(best.square), d)


def test_nan_train_rows_are_never_neighbours(vectors):
    got = lists_of(knn_lists(vectors([[float("nan")], [3], [1]]), vectors([[0]]), 2))
    assert got == {0: [(2, 1.0), (1, 3.0)]}


def test_vote(vectors):
    train = vectors([[0], [1], [2], [3], [10]], labels=[1, 0, 1, 0, 7])
    votes = {r["row_id"]: r["predicted"] for r in knn_classify(train, vectors([[0], [9]]), 4).collect()}
    assert votes == {0: 0, 1: 0}  # 2:2 goes to the smallest label; 7 has one vote, 0 has two
    one = {r["row_id"]: r["predicted"] for r in knn_classify(train, vectors([[9]]), 1).collect()}
    assert one == {0: 7}


def test_long_form(vectors):
    rows = [tuple(r) for r in knn_neighbours(vectors([[1], [5]]), vectors([[0]]), 2).orderBy("rank").collect()]
    assert rows == [(0, 1, 0, 1.0), (0, 2, 1, 5.0)]
    with pytest.raises(ValueError):
        knn_lists(vectors([[1]]), vectors([[1]]), 0)


def test_small_train_side_needs_no_shuffle(vectors):
    text = knn_classify(vectors([[1]], labels=[0]), vectors([[1]]), 1)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in text


# -- distances and seeding ----------------------------------------------------------------


def numbered(spark, means):
    return spark.createDataFrame(list(enumerate(means)), "cand int, mean_distance double")


def test_similar_pairs_case(spark):
    pairs = distance.similar_pairs(numbered(spark, [1.0, 1.04, 2.0]))
    assert {(r["i"], r["j"]) for r in pairs.collect()} == {(0, 1), (1, 0)}


@pytest.mark.parametrize("tolerance", [0.01, 0.05, 0.6])
def test_similar_pairs_equal_all_pairs_check(spark, tolerance):
    m = np.exp(np.random.default_rng(0).normal(size=40))
    m[5] = 0.0
    got = sorted((r["i"], r["j"]) for r in distance.similar_pairs(numbered(spark, m.tolist()), tolerance).collect())
    wanted = sorted(
        (i, j) for i in range(40) for j in range(40) if i != j and m[i] > 0 and m[j] > 0 and abs(m[i] / m[j] - 1) < tolerance
    )
    assert got == wanted
    with pytest.raises(ValueError):
        distance.similar_pairs(numbered(spark, [1.0]), 1.0)


def test_row_distances(spark):
    df = spark.createDataFrame([([0.0, 0.0], [3.0, 4.0])], "a array<double>, b array<double>")
    row = distance.row_distances(df, "a", "b").first()
    assert (row["distance"], row["squared"]) == (5.0, 25.0)


def test_no_similar_pair_raises(vectors):
    df = vectors([[0], [1], [100]])
    with pytest.raises(ValueError, match="similar"):
        seeding.seed_two(df, 3, 3, tolerance=1e-6)


def test_seed_many_has_no_duplicates(vectors):
    x = np.random.default_rng(2).normal(size=(60, 3))
    seeds = seeding.seed_many(vectors(x), 8, 40, 12, seed=1).orderBy("cluster").collect()
    assert [r["cluster"] for r in seeds] == list(range(8))
    assert len({r["row_id"] for r in seeds}) == 8
    assert all(np.array_equal(r["features"], x[r["row_id"]]) for r in seeds)
    with pytest.raises(ValueError):
        seeding.seed_many(vectors(x), 20, 40, 12, seed=1)


def test_seed_potential(vectors):
    row = seeding.seed_potential(vectors([[0], [3], [10]]), np.array([[0.0], [9.0]])).first()
    assert row["potential"] == 0 + 3 + 1


def test_forced_strategies_check_sizes(vectors, monkeypatch):
    monkeypatch.setattr(neighbours, "BROADCAST_NUMBERS", 10)
    many, few = vectors(np.zeros((20, 2))), vectors([[0, 0]])
    for strategy, train, queries in (("scan_queries", many, few), ("scan_train", few, many)):
        with pytest.raises(ValueError, match="too many to broadcast"):
            knn_lists(train, queries, 1, strategy=strategy)


@pytest.mark.parametrize("strategy", ["scan_queries", "scan_train", "grid"])
def test_no_query_is_lost(vectors, strategy):
    nan = float("nan")
    got = {r["row_id"]: r["neighbours"] for r in knn_lists(vectors([[1], [2]]), vectors([[0], [nan]]), 1, strategy=strategy).collect()}
    assert len(got[0]) == 1 and got[1] == []
    votes = knn_classify(vectors([[1], [2]], [3, 4]), vectors([[0], [nan]]), 1, strategy=strategy).collect()
    assert {r["row_id"]: r["predicted"] for r in votes} == {0: 3, 1: None}


def test_distance_operators_check_sizes(vectors, monkeypatch):
    from vectrove.operators import centroids

    monkeypatch.setattr(centroids, "BROADCAST_NUMBERS", 3)
    rows = distance.number_candidates(vectors([[0, 1], [2, 3]]))
    for found in (lambda: distance.pairwise_distances(rows), lambda: distance.mean_distance_to_sample(rows, rows)):
        with pytest.raises(ValueError, match="too many"):
            found()


def test_cells_skip_most_of_a_clustered_table(vectors):
    """Queries search a few cells each; no cell exceeds its bound, though one pivot has a third of all rows."""
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(40, 6)) * 100
    t = np.vstack([np.repeat(centres, 50, axis=0) + rng.normal(size=(2000, 6)), np.tile(centres[:1], (1000, 1))])
    q = centres[rng.integers(0, 40, 200)] + rng.normal(size=(200, 6))
    train, queries = vectors(t, partitions=6).select("row_id", "features", F.lit(None).cast("int").alias("label")), vectors(q, partitions=3)
    dealt = cells.deal_cells(train, cells.draw_pivots(train, 48), 60)
    sizes = {r["cell"]: r["count"] for r in dealt.rows.groupBy("cell").count().collect()}
    assert sum(sizes.values()) == 3000 and max(sizes.values()) <= 120 and len(sizes) >= 50
    for r in dealt.rows.collect():
        away = np.linalg.norm(np.array(r["features"]) - dealt.pivots[dealt.pivot[r["cell"]]])
        assert dealt.low[r["cell"]] <= away <= dealt.high[r["cell"]]
    homes = cells.first_visits(dealt, queries, 3)
    order, d = brute(t, q, 3)
    reach = {r["row_id"]: r["reach"] for r in homes.collect()}
    assert all(reach[i] >= d[i][-1] for i in range(200))
    kth = homes.sparkSession.createDataFrame([(i, float(d[i][-1])) for i in range(200)], "row_id long, reach double")
    further = cells.further_visits(dealt, homes.drop("reach").join(kth, "row_id")).count()
    assert further < 0.15 * 200 * len(dealt.count)
    got = lists_of(knn_lists(vectors(t, partitions=6), queries, 3, strategy="cells", block_numbers=360))
    assert [[n for n, _ in got[i]] for i in range(200)] == order.tolist()


def test_cells_of_odd_vectors(vectors):
    nan, inf, huge = float("nan"), float("inf"), 1e200
    t = [[0, 0], [nan, 1], [inf, 1], [huge, 0], [huge, 1], [3, 4], [0, 0]]
    q = [[0, 1], [nan, 0], [huge, 0], [inf, 0], [3, 3]]
    want = lists_of(knn_lists(vectors(t), vectors(q), 3, strategy="scan_queries"))
    assert lists_of(knn_lists(vectors(t), vectors(q), 3, strategy="cells", block_numbers=4)) == want
    none = lists_of(knn_lists(vectors([[nan, 1]]), vectors(q), 3, strategy="cells"))
    assert none == {i: [] for i in range(5)}


def test_narrow_rows_in_many_pairs_go_by_cells(vectors, monkeypatch):
    rng = np.random.default_rng(8)
    t, q = rng.normal(size=(900, 2)), rng.normal(size=(40, 2))
    order, d = brute(t, q, 3)
    used, by_cells = [], neighbours.nearest_by_cells
    monkeypatch.setattr(neighbours, "nearest_by_cells", lambda *a, **kw: (used.append(a[3]), by_cells(*a, **kw))[1])
    monkeypatch.setattr(neighbours, "SCAN_PAIRS", 900 * 40 - 1)
    monkeypatch.setattr(neighbours, "CELL_ROWS", 50)
    got = lists_of(knn_lists(vectors(t, partitions=4), vectors(q), 3))
    assert used == [50] and [[n for n, _ in got[i]] for i in range(40)] == order.tolist()
    monkeypatch.setattr(neighbours, "NARROW", 1)
    assert lists_of(knn_lists(vectors(t, partitions=4), vectors(q), 3)) == got and used == [50]


def test_visits_leave_a_task_in_bounded_batches(vectors, monkeypatch):
    """However many cells a query meets, and however many queries a batch has."""
    import pyarrow as pa

    from vectrove.functions import vectors as views

    rng = np.random.default_rng(9)
    train, queries = vectors(rng.normal(size=(600, 8))).withColumn("label", F.lit(None).cast("int")), vectors(rng.normal(size=(300, 8)))
    dealt = cells.deal_cells(train, cells.draw_pivots(train, 32), 10)
    run = []
    real = type(queries).mapInArrow
    monkeypatch.setattr(type(queries), "mapInArrow", lambda self, fn, *rest, **kw: (run.append(fn), real(self, fn, *rest, **kw))[1])
    homes = cells.first_visits(dealt, queries, 3)
    found = cells.further_visits(dealt, homes)
    table = homes.toArrow().combine_chunks()
    monkeypatch.setattr(views, "SCRATCH_ELEMENTS", 100 * len(dealt.count))
    parts = list(run[-1](iter(table.to_batches())))
    assert max(p.num_rows for p in parts) <= 13 and sum(p.num_rows for p in parts) == 300
    pairs = {(i, c) for p in parts for i, cs in zip(p.column(0).to_pylist(), p.column(2).to_pylist()) for c in cs}
    assert pairs == {(r["row_id"], r["cell"]) for r in found.collect()} and len(pairs) > 3000
    assert isinstance(parts[0], pa.RecordBatch)


def test_grid_sends_rows_a_bounded_number_of_times(vectors, monkeypatch):
    some = vectors([[0]])
    rows = [neighbours._tiles(9 * n, n, neighbours.TILE_NUMBERS // 64, some) for n in (1_000, 10_000, 60_000)]
    for n, (train_tiles, query_tiles) in zip((1_000, 10_000, 60_000), rows):
        assert query_tiles == 1 and 9 * n + n * train_tiles <= 20 * n
    rng = np.random.default_rng(10)
    t, q = rng.normal(size=(300, 4)), rng.normal(size=(90, 4))
    order, _ = brute(t, q, 4)
    monkeypatch.setattr(neighbours, "TILE_NUMBERS", 120)  # tiles of 30 rows, searched in blocks of 10
    got = lists_of(knn_lists(vectors(t, partitions=4), vectors(q, partitions=3), 4, strategy="grid", block_numbers=40))
    assert [[n for n, _ in got[i]] for i in range(90)] == order.tolist()


def test_cells_send_a_row_once_for_a_region(vectors, monkeypatch):
    """Where no cell can be ruled out, what is sent grows with the regions and not with the cells."""
    from pyspark.sql.pandas.group_ops import PandasCogroupedOps

    rng = np.random.default_rng(11)
    t, q = rng.normal(size=(1200, 12)), rng.normal(size=(200, 12))
    order, _ = brute(t, q, 4)
    sent, real = [], PandasCogroupedOps.applyInArrow
    monkeypatch.setattr(PandasCogroupedOps, "applyInArrow", lambda self, *a: (sent.append((self._gd1._df.count(), self._gd2._df.count())), real(self, *a))[1])
    got = lists_of(knn_lists(vectors(t, partitions=4), vectors(q, partitions=3), 4, strategy="cells", block_numbers=120))
    assert [[n for n, _ in got[i]] for i in range(200)] == order.tolist()
    assert sum(n for n, _ in sent) <= 4 * 1200 and sum(n for _, n in sent) <= 4 * 200


@pytest.mark.parametrize("region_rows", [7, 60, 250])
def test_regions_and_lots_of_any_size(vectors, monkeypatch, region_rows):
    """Copies that fill many regions, regions of fewer rows than k, and several lots for each."""
    rng = np.random.default_rng(12)
    t = np.vstack([rng.normal(size=(300, 4)), np.ones((150, 4)), rng.normal(size=(100, 4)) + 40])
    q = np.vstack([rng.normal(size=(60, 4)), np.ones((30, 4)), rng.normal(size=(20, 4)) + 40])
    order, d = brute(t, q, 9)
    monkeypatch.setattr(cells, "REGION_NUMBERS", 4 * region_rows)
    monkeypatch.setattr(cells, "LEAST_NUMBERS", 1)
    monkeypatch.setattr(cells, "RUN_ROWS", 12)
    got = lists_of(knn_lists(vectors(t, partitions=4), vectors(q, partitions=3), 9, strategy="cells", block_numbers=20))
    assert [[n for n, _ in got[i]] for i in range(110)] == order.tolist()
    np.testing.assert_allclose([[x for _, x in got[i]] for i in range(110)], d, rtol=1e-12)


def test_regions_are_bounded_and_hold_every_cell(vectors):
    rng = np.random.default_rng(13)
    train = vectors(np.vstack([rng.normal(size=(500, 3)), np.zeros((300, 3))])).withColumn("label", F.lit(None).cast("int"))
    dealt = cells.deal_cells(train, cells.draw_pivots(train, 20), 10)
    region = cells.deal_regions(dealt, 100)
    assert dealt.held.sum() == 800 and len(region) == len(dealt.count)
    assert set(np.diff(region)) <= {0, 1} and region[0] == 0 and 7 <= region[-1] <= 9
    assert np.bincount(region, weights=dealt.held).max() <= 110


def test_kernel_within_a_distance_and_for_some_queries():
    rng = np.random.default_rng(14)
    t, q = rng.normal(size=(300, 3)), rng.normal(size=(20, 3))
    order, d = brute(t, q, 5)
    best = kernels.ClosestK(q, 5, d[:, 2])
    best.add(t, np.arange(300), np.zeros(300, int), np.arange(10))
    assert not np.isfinite(best.square[10:]).any()
    np.testing.assert_allclose(best.reach()[:10], d[:10, 2])
    best.add(t, np.arange(300), np.zeros(300, int), np.arange(10, 20))
    lengths, distance, _, _ = best.found()
    assert np.array_equal(best.ids[:, :3], order[:, :3])
    assert all(3 <= n <= 5 for n in lengths) and len(distance) == lengths.sum()


def test_regions_of_odd_vectors_and_none_to_go_on_to(vectors, monkeypatch):
    nan, inf, huge = float("nan"), float("inf"), 1e200
    t = [[0, 0], [nan, 1], [inf, 1], [huge, 0], [huge, 1], [3, 4], [0, 0], [5, 5]]
    q = [[0, 1], [nan, 0], [huge, 0], [inf, 0], [3, 3]]
    want = lists_of(knn_lists(vectors(t), vectors(q), 3, strategy="scan_queries"))
    monkeypatch.setattr(cells, "REGION_NUMBERS", 4)
    monkeypatch.setattr(cells, "LEAST_NUMBERS", 1)
    assert lists_of(knn_lists(vectors(t), vectors(q), 3, strategy="cells", block_numbers=2)) == want
    apart = np.arange(40.0)[:, None] % 20 * [0.01, 0.02] + np.repeat([0, 1000], 20)[:, None]
    order, _ = brute(apart, apart, 3)
    monkeypatch.setattr(cells, "REGION_NUMBERS", 40)
    gone, real = [], cells.further_visits
    monkeypatch.setattr(cells, "further_visits", lambda *a: (gone.append(real(*a)), gone[0])[1])
    got = lists_of(knn_lists(vectors(apart), vectors(apart), 3, strategy="cells", block_numbers=40))
    assert [[n for n, _ in got[i]] for i in range(40)] == order.tolist() and gone[0].count() == 0
