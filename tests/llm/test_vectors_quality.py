"""The quality classifier, nearest neighbours and the pipeline."""

import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from vectrove.llm import nearest, quality, units
from vectrove.llm.common import table


@pytest.fixture(scope="module")
def scored(spark, sf):
    docs = table(spark, sf, "documents")
    model = quality.fit_quality(docs, table(spark, sf, "labels"))
    return model, quality.score_quality(docs, model).toPandas()


def test_held_out_accuracy(scored, sf):
    labels = duckdb.sql(f"SELECT doc_id, quality FROM '{sf}/labels.parquet'").df()
    both = scored[1].merge(labels, on="doc_id")
    both = both[both.held_out]
    assert len(both) > 50
    assert (both.predicted == both.quality).mean() > 0.95
    assert (both[both.quality == 1].predicted == 1).mean() > 0.97
    assert both[both.quality == 1].score.mean() > both[both.quality == 0].score.mean() + 0.5


def test_scoring_a_column_leaves_its_worker_small(monkeypatch):
    calls = []
    monkeypatch.setattr(units, "drop", lambda: calls.append("drop"))
    monkeypatch.setattr(units, "give_back", lambda: calls.append("give_back"))
    run = quality.column_scores(lambda texts: np.array([len(t) for t in texts], float))
    batches = run(iter([pd.Series(["ab", None]), pd.Series([], dtype=object), pd.Series(["abc"])]))
    assert next(batches).tolist() == [2, 0] and calls == []
    assert [x.tolist() for x in batches] == [[], [3]]
    assert calls == ["drop", "give_back"]


def test_a_repeated_id_is_learnt_from_once(spark, make, monkeypatch):
    ids = [i for i in range(40) if zlib.crc32(b"%d" % i) % 5]
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    sizes, fit = [], quality.fit_network
    monkeypatch.setattr(quality, "fit_network", lambda x, *rest: (sizes.append(len(x)), fit(x, *rest))[1])
    quality.fit_quality(make([(i, f"text {i}") for i in range(40)] + [(ids[0], f"other {i}") for i in range(300)]), labels)
    assert sizes == [len(ids)]


def test_scores_of_odd_texts(scored, docs, no_docs, rows):
    got = quality.score_quality(docs, scored[0]).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[0] == by[1]  # null and empty
    assert quality.score_quality(no_docs, scored[0]).collect() == []
    kept = quality.score_quality(docs, scored[0], keep_columns=True)
    assert kept.columns == [*docs.columns, "_score", "_predicted"]


def test_context_sums_do_not_depend_on_partitions(docs):
    one, many = (quality.context_sums(docs.repartition(n)) for n in (1, 7))
    assert np.array_equal(one, many) and one[:, -1].sum() == docs.selectExpr("sum(size(filter(split(text, '\\\\s+'), x -> x <> '')))").first()[0]


def test_fit_without_labels(docs, no_docs, spark):
    labels = spark.createDataFrame([(4, None, 1), (None, 1, 0), (5, 7, 0)], "doc_id long, quality int, x int")
    for some in (docs, no_docs):
        model = quality.fit_quality(some, labels)
        assert quality.score_quality(some, model).count() == some.count()


def vectors(spark, n=700):
    draw = np.random.default_rng(8)
    centers = draw.normal(size=(9, 24))
    rows = [(i, (centers[i % 9] + 0.4 * draw.normal(size=24)).tolist()) for i in range(n)]
    rows += [(n + i, rows[0][1]) for i in range(60)]  # ties
    rows += [(5000, None), (5020, [0.0] * 24), (5040, [float("inf")] * 24), (5060, [1.0]), (None, rows[0][1]), rows[0]]
    return rows, spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("shard", F.lit("x"))


def exact(rows, k):
    good = {d: v for d, v in rows if d is not None and v is not None and len(v) == 24 and np.isfinite(v).all() and any(v)}
    ids, x = np.array(list(good)), np.array(list(good.values()))
    score = np.einsum("ij,kj->ik", x, x)
    out = []
    for i in np.flatnonzero(ids % 20 == 0):
        order = [j for j in np.lexsort((ids, -score[i])) if j != i][:k]
        out += [(int(ids[i]), place + 1, int(ids[j]), float(score[i, j])) for place, j in enumerate(order)]
    return out


def test_factor_one_is_exact(spark, monkeypatch):
    rows, df = vectors(spark)
    for shard in (4096, 100):
        index = nearest.build_index(df, shard=shard)
        got = sorted(map(tuple, nearest.search_index(index, df.where("vec_id % 20 = 0"), 20, factor=1.0).collect()))
        assert got == sorted(exact(rows, 20))


def test_recall_of_the_default(spark):
    rows, df = vectors(spark, 4000)
    names = ["query_id", "rank", "vec_id", "score"]
    got = pd.DataFrame([tuple(r) for r in nearest.search_index(nearest.build_index(df), df.where("vec_id % 20 = 0")).collect()], columns=names)
    assert nearest.recall(got, pd.DataFrame(exact(rows, 20), columns=names)) >= 0.9


def test_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [2.0, 1.0])], "vec_id long, embedding array<double>")
    assert [tuple(r) for r in nearest.search_index(nearest.build_index(df), df).orderBy("query_id").collect()] == [(0, 1, 1, 4.0), (1, 1, 0, 4.0)]
    assert nearest.search_index(nearest.build_index(df.limit(0)), df).collect() == []
    assert nearest.search_index(nearest.build_index(df), df.limit(0)).collect() == []


def test_pipeline_stages(spark, sf):
    import corpus_pipeline as pipeline

    from vectrove.llm.common import stored

    docs = table(spark, sf, "documents").limit(300).withColumn("e", F.lit(1))
    columns, ids = docs.columns, {r.doc_id for r in docs.collect()}
    for name, stage in pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), name)
        now = {r.doc_id for r in docs.collect()}
        assert docs.columns == columns and now <= ids and docs.count() == len(now)
        assert docs.where("n_chars <> length(text)").count() == 0
        ids = now
    packed = pipeline.STAGES[-1][1](spark, docs, sf)
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == ids


def test_pipeline_of_odd_and_of_no_rows(spark, docs, no_docs, sf):
    import corpus_pipeline as pipeline

    from vectrove.llm.common import stored

    for name, stage in pipeline.STAGES:
        out = stored(stage(spark, docs, sf), name)
        assert stage(spark, no_docs, sf).count() == 0
        if name != "packing":
            assert out.columns == docs.columns


def test_a_block_of_queries_visits_a_leaf_twice_at_most(monkeypatch):
    draw = np.random.default_rng(4)
    x = draw.normal(size=(2000, 16))
    x /= np.sqrt((x**2).sum(1, keepdims=True))
    ids = np.arange(2000)
    tree = nearest.VantageTree(ids, x, 1.0 + 1e-12)
    leaves = sum(node[2] is None for node in tree.nodes)
    calls, one_by_one = [], nearest.inner
    monkeypatch.setattr(nearest, "inner", lambda a, b: calls.append(len(a)) or one_by_one(a, b))
    scores, found = tree.search(ids[:300], x[:300], 20, 1.0)
    assert len(calls) <= 2 * leaves
    every = np.einsum("ij,kj->ik", x[:300], x)
    every[ids[:300], ids[:300]] = -np.inf
    want = np.lexsort((np.broadcast_to(ids, every.shape), -every), axis=1)[:, :20]
    assert (found == want).all() and (scores == np.take_along_axis(every, want, 1)).all()
