import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from vectrove.operators import barrier
from vectrove.operators import network as net
from vectrove.operators import pca
from vectrove.operators import reduce as red
from vectrove.plans import jobs

# -- PCA ----------------------------------------------------------------------------------


def data(n=300, d=6, seed=0):
    rng = np.random.default_rng(seed)
    return rng.normal(size=(n, d)) @ rng.normal(size=(d, d)) + rng.normal(size=d) * 100


def reference(x, k):
    values, vectors = np.linalg.eigh(np.cov(x.T))
    order = np.argsort(values)[::-1][:k]
    c = vectors[:, order].T
    sign = np.sign(c[np.arange(k), np.abs(c).argmax(1)])
    return values[order], c * sign[:, None]


def test_components_and_variance(vectors):
    x = data()
    model = pca.fit_pca(vectors(x, partitions=5), k=3, sample=None)
    values, components = reference(x, 3)
    np.testing.assert_allclose(model.variance, values, rtol=1e-9)
    np.testing.assert_allclose(model.components, components, atol=1e-8)
    np.testing.assert_allclose(model.mean, x.mean(0))
    np.testing.assert_allclose(model.ratio, values / np.trace(np.cov(x.T)))


def test_large_matrix_goes_through_chunks(vectors, monkeypatch):
    monkeypatch.setattr(red, "SMALL", 4)
    monkeypatch.setattr(red, "CHUNK", 10)
    monkeypatch.setattr(red, "FAN_IN", 2)
    x = data(80, 6, 1)
    model = pca.fit_pca(vectors(x, partitions=5), k=2, sample=None)
    np.testing.assert_allclose(model.components, reference(x, 2)[1], atol=1e-8)


def test_scores_are_centred_and_uncorrelated(vectors):
    x = data()
    df = vectors(x)
    model = pca.fit_pca(df, k=3, sample=None)
    z = np.array([r["features"] for r in pca.transform_pca(df, model).orderBy("row_id").collect()])
    np.testing.assert_allclose(z, (x - x.mean(0)) @ model.components.T, atol=1e-8)
    np.testing.assert_allclose(z.mean(0), 0, atol=1e-8)
    np.testing.assert_allclose(np.cov(z.T), np.diag(model.variance), atol=1e-7)


def test_fit_on_a_sample(vectors):
    from vectrove.operators.sample import sample_exact

    x = data()
    df = vectors(x)
    ids = [r["row_id"] for r in sample_exact(df, 50, 9).collect()]
    model = pca.fit_pca(df, k=2, sample=50, seed=9)
    np.testing.assert_allclose(model.mean, x[ids].mean(0))
    np.testing.assert_allclose(pca.fit_pca(df, k=2).mean, x.mean(0))
    with pytest.raises(ValueError, match="cannot draw"):
        pca.fit_pca(df, k=2, sample=10_000)


def test_save_and_load(spark, vectors, tmp_path):
    df = vectors(data())
    model = pca.fit_pca(df, k=2, sample=None)
    pca.save_pca(spark, model, str(tmp_path / "m"))
    back = pca.load_pca(spark, str(tmp_path / "m"))
    for name in ("mean", "components", "variance", "ratio"):
        assert np.array_equal(getattr(model, name), getattr(back, name))
    assert pca.project_2d(df, back).columns == ["row_id", "pc1", "pc2", "label"]


def test_bad_requests(vectors):
    for k in (0, 7):
        with pytest.raises(ValueError):
            pca.fit_pca(vectors(data()), k=k, sample=None)
    with pytest.raises(ValueError):
        pca.fit_pca(vectors([[1, 2]]), k=1)


def test_pca_knn_separates_two_blobs(vectors):
    rng = np.random.default_rng(0)
    y = np.arange(200) % 2
    x = rng.normal(size=(200, 8)) + 6 * y[:, None]
    df = vectors(x, y)
    train, held = df.filter("row_id >= 40"), df.filter("row_id < 40")
    scores = jobs.classifier_scores(jobs.pca_knn(train, held, components=3)).first()
    assert (scores["precision_macro"], scores["recall_macro"], scores["f1_macro"]) == (1.0, 1.0, 1.0)


# -- network ------------------------------------------------------------------------------


def batch(spark, x, y, partitions=3):
    rows = [([float(v) for v in a], float(b)) for a, b in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, label double").repartition(partitions)


def batch_loss(network, x, y):
    """Mean log loss with batch statistics, written out."""
    a = x
    for layer in network.layers:
        p = layer.parameters
        if layer.kind == "batch_norm":
            a = p["gamma"] * (a - a.mean(0)) / np.sqrt(a.var(0) + net.BN_EPSILON) + p["beta"]
            continue
        a = a @ p["kernel"] + p["bias"]
        a = np.maximum(a, 0) if layer.activation == "relu" else 1 / (1 + np.exp(-a))
    p = a[:, 0]
    return float(-(y * np.log(p) + (1 - y) * np.log(1 - p)).mean())


@pytest.mark.parametrize("batch_norm", [True, False])
def test_gradient_equals_finite_differences(spark, batch_norm):
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(30, 4)), rng.integers(0, 2, size=30).astype(float)
    network = net.build_network(4, first=5, hidden=(6, 3), batch_norm=batch_norm, seed=1)
    for layer in network.layers:
        for name, p in layer.parameters.items():
            if name in ("bias", "beta", "gamma"):
                layer.parameters[name] = p + rng.normal(size=p.shape) * 0.3
    gradients, moments, loss, _, n = net.batch_gradient(network, batch(spark, x, y))
    assert n == 30
    assert loss == pytest.approx(batch_loss(network, x, y), rel=1e-9)
    assert (moments is not None) == batch_norm
    for layer, gradient in zip(network.layers, gradients):
        for name, g in gradient.items():
            p = layer.parameters[name]
            for at in list(np.ndindex(p.shape))[:12]:
                old, step = p[at], 1e-6
                p[at] = old + step
                up = batch_loss(network, x, y)
                p[at] = old - step
                down = batch_loss(network, x, y)
                p[at] = old
                assert g[at] == pytest.approx((up - down) / (2 * step), abs=1e-6)


def test_gradient_does_not_depend_on_partitions_or_slices(spark, monkeypatch):
    rng = np.random.default_rng(3)
    x, y = rng.normal(size=(50, 4)), rng.integers(0, 2, size=50).astype(float)
    network = net.build_network(4, first=5, hidden=(3,), seed=2)
    one = net.batch_gradient(network, batch(spark, x, y, 1))[0]
    monkeypatch.setattr(red, "SMALL", 1)
    monkeypatch.setattr(red, "CHUNK", 7)
    many = net.batch_gradient(network, batch(spark, x, y, 6))[0]
    for a, b in zip(one, many):
        for name in a:
            np.testing.assert_allclose(a[name], b[name], atol=1e-12)


def test_reference_shape():
    network = net.build_network(2351)
    dense = [l.parameters["kernel"].shape for l in network.layers if l.kind == "dense"]
    assert dense == [(2351, 1024), (1024, 1024), (1024, 512), (512, 256), (256, 128), (128, 64), (64, 1)]
    assert network.layers[1].kind == "batch_norm"
    bound = np.sqrt(6 / (2351 + 1024))
    kernel = network.layers[0].parameters["kernel"]
    assert kernel.min() >= -bound and kernel.max() <= bound and kernel.std() == pytest.approx(bound / np.sqrt(3), rel=0.01)


def test_training_learns(vectors):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(240, 4))
    y = (x[:, 0] * x[:, 1] > 0).astype(int)
    df = vectors(x, y, partitions=3)
    train, held = df.filter("row_id >= 60"), df.filter("row_id < 60")
    network = net.build_network(4, first=16, hidden=(8,), seed=0)
    result = net.fit_network(train, held, network, epochs=12, batch_size=90, learning_rate=0.05)
    history = result.history.orderBy("epoch").collect()
    assert [r["epoch"] for r in history] == list(range(12))
    assert history[-1]["loss"] < history[0]["loss"]
    row = net.evaluate_network(held, result.network).first()
    assert row["loss"] == pytest.approx(history[-1]["val_loss"])
    assert row["accuracy"] == pytest.approx(history[-1]["val_accuracy"])


def test_moving_statistics_follow_batches(vectors):
    x = np.random.default_rng(1).normal(size=(40, 3))
    network = net.build_network(3, first=4, hidden=(), seed=0)
    first = np.maximum(x @ network.layers[0].parameters["kernel"], 0)
    result = net.fit_network(vectors(x, np.arange(40) % 2), None, network, epochs=1, batch_size=40)
    bn = result.network.layers[1].parameters
    np.testing.assert_allclose(bn["mean"], 0.01 * first.mean(0), atol=1e-12)
    np.testing.assert_allclose(bn["variance"], 0.99 + 0.01 * first.var(0), atol=1e-12)


def _barrier_case(vectors):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(301, 5))
    df = vectors(x, (x[:, 0] * x[:, 1] > 0).astype(int), partitions=5)
    network = net.build_network(5, first=16, hidden=(8, 4), seed=0)
    return df.filter("row_id >= 60"), df.filter("row_id < 60"), network


def test_barrier_training_gives_the_same_weights(spark, vectors):
    train, held, network = _barrier_case(vectors)
    options = dict(network=network, epochs=2, batch_size=130, learning_rate=0.05, seed=2)
    one, two = net.fit_network(train, held, **options), barrier.fit_network_barrier(train, held, tasks=4, **options)
    for a, b in zip(one.network.layers, two.network.layers):
        for name in a.parameters:
            np.testing.assert_allclose(a.parameters[name], b.parameters[name], rtol=1e-9, atol=1e-9)
    for a, b in zip(one.history.orderBy("epoch").collect(), two.history.orderBy("epoch").collect()):
        np.testing.assert_allclose(a[:5], b[:5], rtol=1e-9)
    np.testing.assert_array_equal(network.layers[0].parameters["bias"], 0)  # the given network is not changed


def test_a_step_is_one_job_of_one_task(spark, vectors, monkeypatch):
    """Steps of one partition don't pass over the others; a step of very many rows gives the same weights."""
    train, held, network = _barrier_case(vectors)
    options = dict(network=network, epochs=2, batch_size=16, learning_rate=0.05, seed=2)
    context = spark.sparkContext
    tasks = []
    run = type(context).runJob
    monkeypatch.setattr(type(context), "runJob", lambda self, rdd, f, partitions=None, *rest: (tasks.append(len(partitions)), run(self, rdd, f, partitions, *rest))[1])
    one = net.fit_network(train, None, **options)
    assert tasks == [1] * 2 * math.ceil(241 / 16)
    monkeypatch.setattr(net, "HELD_NUMBERS", 20)
    two, three = net.fit_network(train, None, **options), barrier.fit_network_barrier(train, None, tasks=4, **options)
    assert len(tasks) > 4 * 2 * math.ceil(241 / 16) - 20
    for other in (two, three):
        for a, b in zip(one.network.layers, other.network.layers):
            for name in a.parameters:
                np.testing.assert_allclose(a.parameters[name], b.parameters[name], rtol=1e-9, atol=1e-9)


def test_barrier_training_goes_on_after_the_last_stored_epoch(vectors, tmp_path, monkeypatch):
    train, _, network = _barrier_case(vectors)
    options = dict(network=network, batch_size=300, learning_rate=0.05, tasks=3)
    stages, epoch = [], barrier._epoch
    monkeypatch.setattr(barrier, "_epoch", lambda *rest: (stages.append(1), epoch(*rest))[1])
    for epochs, ran in ((1, 1), (3, 2), (3, 0)):  # a stage for each epoch that was not stored
        stages.clear()
        stored = barrier.fit_network_barrier(train, epochs=epochs, checkpoints=str(tmp_path / "epochs"), **options)
        assert len(stages) == ran
    again = barrier.fit_network_barrier(train, epochs=3, **options)
    assert [r["epoch"] for r in stored.history.orderBy("epoch").collect()] == [0, 1, 2]
    for a, b in zip(stored.network.layers, again.network.layers):
        for name in a.parameters:
            np.testing.assert_allclose(a.parameters[name], b.parameters[name], rtol=1e-9, atol=1e-12)


def test_barrier_training_refuses_what_it_cannot_hold(spark, vectors, monkeypatch):
    train, _, network = _barrier_case(vectors)
    with pytest.raises(ValueError, match="slots"):
        barrier.fit_network_barrier(train, network=network, epochs=1, tasks=10_000)
    monkeypatch.setattr(barrier, "EXCHANGE", 10)
    with pytest.raises(ValueError, match="exchange"):
        barrier.fit_network_barrier(train, network=network, epochs=1)
    with pytest.raises(ValueError, match="empty"):
        barrier.fit_network_barrier(train.limit(0), network=network, epochs=1)


def test_scores_save_load(spark, vectors, tmp_path):
    x = np.random.default_rng(1).normal(size=(20, 3))
    network = net.build_network(3, first=4, hidden=(2,), seed=0)
    net.save_network(spark, network, str(tmp_path / "n"))
    back = net.load_network(spark, str(tmp_path / "n"))
    got = [r["probability"] for r in net.score_network(vectors(x), back).orderBy("row_id").collect()]
    np.testing.assert_allclose(got, net.forward(network, x))
    assert back.normalised and back.size() == network.size()


def test_log_loss_and_accuracy(spark):
    df = spark.createDataFrame([(1, 0.5)], "label int, probability double")
    assert net.binary_log_loss(df).first()[0] == pytest.approx(0.693147, abs=1e-6)
    hard = spark.createDataFrame([(1, 0.0), (0, 0.2)], "label int, probability double")
    assert net.binary_log_loss(hard).first()[0] == pytest.approx((-np.log(1e-7) - np.log(0.8)) / 2)
    assert net.binary_accuracy(hard).first()[0] == 0.5


def test_too_large_network():
    with pytest.raises(ValueError, match="too many"):
        net.build_network(10, first=9000, hidden=(9000,))


# -- streams ------------------------------------------------------------------------------


def test_row_wise_operators_run_on_a_stream(spark, vectors, tmp_path):
    from vectrove import streaming

    x = np.random.default_rng(0).normal(size=(60, 4))
    df = vectors(x, np.arange(60) % 3 - 1)
    df.write.parquet(str(tmp_path / "in"))
    means = x[:2, :2]
    network = net.build_network(2, first=3, hidden=(), seed=0)

    def steps(source):
        rows = streaming.shape_features(streaming.drop_unlabelled(source), [0, 1])
        return streaming.score_network(streaming.assign_clusters(rows, means), network).select(
            "row_id", "cluster", F.round("probability", 9).alias("probability")
        )

    stream = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    query = (
        steps(stream).writeStream.format("parquet").option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "checkpoint")).trigger(availableNow=True).start()
    )
    query.awaitTermination(120)
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "out")).collect())) == sorted(map(tuple, steps(df).collect()))
