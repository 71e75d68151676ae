"""Line dedup, Jaccard join, suffix dedup and near-duplicate vectors against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from llm_helpers import as_set, partition
from pyspark.sql import functions as F

from vectrove.llm import common, graph, jaccard, lines, neardup, suffixes


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5), (None, 4), (2, 1)] + [(100, i) for i in range(101, 200)]
    edges += [(i, i + 1) for i in range(1000, 1040)]
    got = dict(map(tuple, graph.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    want = dict.fromkeys((1, 2, 3, 7, 8, 9), 1) | dict.fromkeys((20, 21), 20) | dict.fromkeys(range(100, 200), 100)
    assert got == want | dict.fromkeys(range(1000, 1041), 1000)
    assert graph.components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rounds_of_few_edges_have_few_tasks(spark, monkeypatch):
    files = []

    def stored(df, name):
        out = common.stored(df, name)
        files.append(len(out.inputFiles()))
        return out

    monkeypatch.setattr(graph, "stored", stored)
    held = {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        path = spark.createDataFrame([(i, i + 1) for i in range(60)], "a long, b long")
        assert set(graph.components(path).collect()) == {(i, 0) for i in range(61)}
        assert len(files) > 1 and max(files[1:]) <= graph.TASKS
        files.clear()
        stars = spark.createDataFrame([(7 * (i // 20), 1000 + i) for i in range(200)], "a long, b long")
        want = {(1000 + i, 7 * (i // 20)) for i in range(200)} | {(7 * i, 7 * i) for i in range(10)}
        assert set(graph.components(stars).collect()) == want
        assert len(files) == 1  # what is stars already needs no round
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def shingles(text):
    w = words(text)
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def similar(rows):
    sets = [shingles(t) for _, t in rows]
    links = [
        (i, j)
        for i in range(len(rows))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])
    ]
    root = partition(len(rows), links)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[root[i]] = min(ids.get(root[i], d), d)
    return sorted([(d, len(sets[i]), ids.get(root[i])) for i, (d, _) in enumerate(rows)], key=repr)


def test_similar_documents(docs, no_docs, rows):
    want = similar(rows)
    assert as_set(jaccard.similar_documents(docs)) == want
    assert as_set(jaccard.similar_documents(docs, rounds=1)) == want
    assert len({w[2] for w in want}) < len(rows) - 10
    assert jaccard.similar_documents(no_docs).collect() == []


def test_all_shingles_frequent_gives_the_same_links(docs, rows, monkeypatch):
    """With every shingle in the frequent classes, combinations alone find all links."""
    monkeypatch.setattr(np, "log2", lambda x: np.full(np.shape(x), 3.0))
    assert as_set(jaccard.similar_documents(docs)) == similar(rows)


def test_a_pair_in_many_lists_is_a_row_in_few(spark):
    draw = random.Random(3)
    for carried, most in ((4, 2.0), (30, 1.0)):
        rows = []
        for pair in range(40):
            both = draw.sample(range(1000), 20)
            one, two = (sorted(both + draw.sample(range(1000, 2000), 5)) for _ in "ab")
            rows += [(pair, sig, one[:carried], two[:carried]) for sig in sorted(set(one) & set(two))]
        table = spark.createDataFrame(rows, "pair int, sig long, own array<long>, own2 array<long>")
        got = table.where(jaccard.once("sig", "own", "own2")).groupBy("pair").agg(F.min("sig").alias("least"), F.count("sig").alias("k")).collect()
        least = {}
        for pair, sig, *_ in rows:
            least[pair] = min(sig, least.get(pair, sig))
        assert {r.pair: r.least for r in got} == least  # no pair is lost
        assert sum(r.k for r in got) <= most * len(got)
        assert len(rows) >= 20 * len(got)


def test_pairs_in_many_lists_link_whatever_rows_carry(docs, rows, monkeypatch):
    for carried in (1, 3):
        monkeypatch.setattr(jaccard, "CARRIED", carried)
        assert as_set(jaccard.similar_documents(docs, rounds=1)) == similar(rows)


def test_the_partner_tried_first_is_the_nearest():
    sets = [np.sort(np.random.default_rng(1).integers(0, 1 << 63, 200).astype(np.uint64))]
    sets += [np.unique(np.append(sets[0][k:], np.random.default_rng(k).integers(0, 1 << 63, k).astype(np.uint64))) for k in (2, 12)]
    maps = [jaccard._bitmap(s) for s in sets]
    batch = pa.RecordBatch.from_pydict({"a": [1, 2], "b": [0, 0], "both": [400, 400], "x": maps[1:], "y": [maps[0]] * 2})
    (out,) = jaccard._may_link(75)(iter([batch]))
    near, far = out.column("far").to_pylist()
    assert out.column("a").to_pylist() == [1, 2] and 0 < near < far < 0.15


def test_links_through_a_row_without_an_id_hold(make):
    words = [f"w{i}" for i in range(400)]
    one, two, three = (" ".join(words[:i] + ["x%d" % k for k in range(16)] + words[i + 16 :]) for i in (0, 200, 380))
    middle = " ".join(words)
    rows = [(1, one), (None, middle), (3, three)]
    want = similar(rows)
    assert {w[2] for w in want} == {1}
    assert as_set(jaccard.similar_documents(make(rows))) == want
    rows = [(2, two), (None, one), (7, middle), (None, "y " + three)]
    assert as_set(jaccard.similar_documents(make(rows))) == similar(rows)


def test_words_that_agree_in_powers_are_told_apart(make):
    def morse(a, b):
        return "".join(a if bin(i).count("1") % 2 == 0 else b for i in range(1024))

    rows = [(1, morse("a", "b")), (2, morse("b", "a"))]
    assert as_set(jaccard.similar_documents(make(rows))) == [(1, 1, 1), (2, 1, 2)]


def test_one_of_each(docs, rows):
    kept = Counter(r.doc_id for r in jaccard.one_of_each(docs).collect())
    assert kept == Counter({d for d, _, c in similar(rows) if d == c} | {None})


def test_keep_repeated_streams(spark):
    draw = np.random.default_rng(1)
    rows = [(int(a), int(b)) for a, b in zip(draw.integers(0, 30, 500) ** 2 % 23, draw.integers(0, 4, 500), strict=True)]
    df = spark.createDataFrame(rows, "k long, v long").repartition("k").sortWithinPartitions("k", "v")
    several = {k for k, _ in rows if len({b for a, b in rows if a == k}) > 1}
    least = {k: min(b for a, b in rows if a == k) for k in several}
    for size in ("1", "7", "10000"):
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", size)
        got = as_set(df.mapInArrow(common.keep_repeated(["k"], ["v"], {"f": "v"}), "k long, v long, f long"))
        assert got == sorted({(a, b, least[a]) for a, b in rows if a in several}, key=repr)
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def without_repeats(rows, length):
    data = [(d, (t or "").encode()) for d, t in rows]
    seen = Counter(t[i : i + length] for _, t in data for i in range(len(t) - length + 1))
    out = []
    for d, t in data:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(x for x, y in zip(t, gone, strict=True) if not y)
        spans = sum(1 for i in range(len(gone)) if gone[i] and (not i or not gone[i - 1]))
        out.append((d, len(t), len(t) - len(kept), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_remove_repeats(docs, no_docs, rows, monkeypatch):
    want = without_repeats(rows, 200)
    assert as_set(suffixes.remove_repeats(docs)) == want and sum(w[2] for w in want) > 1000
    monkeypatch.setattr(suffixes, "SHARD", 10)  # many shards
    assert as_set(suffixes.remove_repeats(docs)) == want
    cut = suffixes.remove_repeats(docs, keep_columns=True)
    assert cut.columns == [*docs.columns, "_removed"]
    got = Counter((r.doc_id, r._removed) for r in cut.collect())
    assert got == Counter((w[0], w[2]) for w in want)
    assert suffixes.remove_repeats(no_docs).collect() == []


def test_common_grams_are_not_sorted_in_one_task(make, rows, monkeypatch):
    draw = random.Random(2)
    passage, *own = ("".join(draw.choices("abcdef ", k=k)) for k in [350, *[120] * 240])
    many = [(1000 + i, own[2 * i] + passage + own[2 * i + 1]) for i in range(120)]
    many += [(2000, "ab" * 700), (2001, "c" + "ab" * 300), (2002, passage[:210] + passage[10:230])]
    places, hashed = [], suffixes._hashed_spans
    monkeypatch.setattr(suffixes, "_hashed_spans", lambda sent, n: (places.append(sent.select(F.sum(F.size("places"))).first()[0]), hashed(sent, n))[1])
    monkeypatch.setattr(suffixes, "GROUP", 20)
    assert as_set(suffixes.remove_repeats(make(rows + many))) == without_repeats(rows + many, 200)
    assert places and places[0] >= 240  # of each passage two at least


def test_loser_tree_orders_and_knows_shared_lengths():
    draw = np.random.default_rng(2)
    entries = [bytes(draw.integers(97, 99, draw.integers(1, 30)).astype(np.uint8)) for _ in range(400)]
    for ways in (1, 2, 5, 8):
        runs = [suffixes.coded_run([(e, b"", [(0, i)]) for i, e in enumerate(entries[k::ways])]) for k in range(ways)]
        merged = list(suffixes.merged_runs([suffixes.decoded_run(r) for r in runs]))
        order = [m[1][0] for m in merged]
        assert order == sorted(order) and set(order) == set(entries)
        for (_, before), (known, entry) in zip(merged, merged[1:], strict=False):
            assert known == suffixes.shared_length(before[0], entry[0], 0)


def plain(line):
    return line.strip().lower()


def test_repeated_lines(docs, no_docs, rows):
    texts = {}
    for d, t in rows:
        if d is not None and t is not None:
            texts.setdefault((d, t), [(i, plain(x)) for i, x in enumerate(t.split("\n")) if plain(x)])
    names = {p: i for i, p in enumerate(sorted({p for v in texts.values() for _, p in v}))}
    sets = [{p[i : i + 8] for i in range(max(1, len(p) - 7))} for p in names]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
    root = partition(len(sets), links)
    got = {r.doc_id: r for r in lines.repeated_lines(docs).collect()}
    kept, removed, want = Counter(), 0, 0
    for (d, _), found in texts.items():
        if found:
            assert got[d].n_lines == len(found)
            gone = set(got[d].removed)
            assert gone <= {i for i, _ in found}
            removed += len(gone)
            kept.update(root[names[p]] for i, p in found if i not in gone)
    want = sum(len(v) for v in texts.values()) - len(set(root))
    assert set(kept) == set(root)  # one line of each component, at least, stays
    assert removed <= want and removed >= 0.99 * want  # nothing else goes, and few are missed
    out = {r.doc_id: r.text for r in lines.dedup_lines(docs).collect()}
    assert out[0] is None and out[1] == "" and out[7] == "   \n\t " and out[None].startswith("alone")
    assert out[4] == rows[4][1] and out[5] == ""
    assert lines.dedup_lines(docs).columns == docs.columns and lines.dedup_lines(docs).count() == len(rows)
    assert lines.repeated_lines(no_docs).collect() == [] and lines.dedup_lines(no_docs).collect() == []


def test_line_recall_at_the_threshold(spark):
    draw, rows = random.Random(1), []
    for i in range(2000):  # 6n shingles in common and n of its own each: 0.75
        n = draw.randint(2, 50)
        same, one, two = ("".join(draw.choices("abcdefghijklmnopqrstuvwxyz", k=k)) for k in (6 * n + 7, n, n))
        rows += [(2 * i, same + "1" + one[1:]), (2 * i + 1, same + "2" + two[1:])]
    found = lines.line_bands(spark.createDataFrame(rows, "h long, plain string").repartition(4)).collect()
    bands = {r.h: set(r.bands) for r in found}
    assert sum(not bands[2 * i].isdisjoint(bands[2 * i + 1]) for i in range(2000)) >= 0.985 * 2000


def test_line_dedup_stays_in_the_jvm(docs):
    plan = lines.dedup_lines(docs)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_near_duplicate_vectors(spark, monkeypatch):
    draw = np.random.default_rng(5)
    centers = draw.normal(size=(12, 48))
    rows = []
    for i in range(900):
        center = centers[min(11, int(draw.integers(0, 30)))]
        spread = 0.05 if i % 3 else 0.9
        rows.append((i, (center + spread * draw.normal(size=48)).tolist(), i % 2 if i % 50 else None))
    rows += [(1000 + i, rows[3][1], 1) for i in range(40)]
    rows += [(2000, None, 0), (2001, [0.0] * 48, 0), (2002, [float("nan")] * 48, 0), (2003, [1.0], 0), (2004, [None, 1.0], 0), (None, rows[0][1], 0)]
    df = spark.createDataFrame([*rows, rows[5]], "vec_id long, embedding array<double>, label int").withColumn("id", F.lit(1))
    found = [r for r in rows if r[0] is not None]
    x = np.array([r[1] if r[1] and len(r[1]) == 48 and np.isfinite(r[1]).all() else [0.0] * 48 for r in found], float)
    length = np.linalg.norm(x, axis=1)
    unit = x / np.where(length > 0, length, 1)[:, None]
    near = unit @ unit.T >= 0.93
    label = [r[2] for r in found]
    links = [(i, j) for i, j in zip(*np.nonzero(np.tril(near, -1)), strict=True) if label[i] == label[j] and label[i] is not None]
    root = partition(len(found), links)
    count = Counter(k for link in links for k in link)
    least = {}
    for i, r in enumerate(found):
        least[root[i]] = min(least.get(root[i], r[0]), r[0])
    want = sorted([(r[0], count[i], least[root[i]], r[0] == least[root[i]]) for i, r in enumerate(found)], key=repr)
    got = as_set(neardup.near_duplicates(df))
    assert got == want and len(links) > 5000
    monkeypatch.setattr(neardup, "ROWS", 16)  # large buckets are cut into many blocks
    assert as_set(neardup.near_duplicates(df)) == want
    assert neardup.near_duplicates(df.limit(0)).collect() == []


def test_cross_polytope_recall_at_the_threshold():
    draw = np.random.default_rng(6)
    x = draw.normal(size=(3000, 64))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y = draw.normal(size=(3000, 64))
    y -= (y * x).sum(1, keepdims=True) * x
    y /= np.linalg.norm(y, axis=1, keepdims=True)
    y = 0.93 * x + (1 - 0.93**2) ** 0.5 * y
    a, b = neardup.codes(x), neardup.codes(y)
    met = (a[:, :, :1] == b).any(2) | (b[:, :, :1] == a).any(2)
    assert met.any(1).mean() > 0.95
