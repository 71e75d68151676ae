"""Vector codes and whitening against brute force."""

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from vectrove.llm import codes, qd, whitening
from vectrove.llm.common import table

EXTRA = "cast(null as string) as codes", "1L as error", "'x' as x", "2 as component", "3L as n", "0 as part"


@pytest.fixture(scope="module")
def odd(spark):
    """Vectors with nulls, copies, ties, other lengths, non-finite components and clashing columns."""
    draw = np.random.default_rng(5)
    rows = [(int(i), [float(x) for x in draw.normal(0, 0.1, 32).astype(np.float32)], int(i % 3)) for i in range(400)]
    rows += [(1000 + i, rows[7][1], None) for i in range(150)]  # a group of copies
    rows += [(2000, [0.0] * 32, 1), (2001, None, 1), (2002, [None] + [0.5] * 31, 2), (2003, [float("nan")] * 32, 2), (2004, [float("inf")] * 32, 0)]
    rows += [(2005, [0.25] * 5, 0), (2006, [], 0), (None, rows[9][1], None), (3, rows[11][1], 4), (5, rows[5][1], 2)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").selectExpr("*", *EXTRA).repartition(6)


def part(rows, length=32):
    return [r for r in rows if r.embedding and len(r.embedding) == length and all(c is not None and np.isfinite(c) for c in r.embedding)]


def grid(rows):
    return np.array([[int(np.floor(256 * c)) for c in r.embedding] for r in rows], np.int64)


@given(st.integers(0, 10_000), st.integers(1, 70), st.integers(1, 5), st.sampled_from([2, 20, 10**7]))
@settings(max_examples=60, deadline=None)
def test_access_tree_finds_the_first_nearest_entry(seed, entries, width, spread):
    draw = np.random.default_rng(seed)
    book, rows = draw.integers(-spread, spread, (entries, width)), draw.integers(-spread, spread, (200, width))
    index, squares = codes.AccessTree(book).nearest(rows)
    apart = ((rows[:, None] - book) ** 2).sum(2)
    assert np.array_equal(index, apart.argmin(1)) and np.array_equal(squares, apart.min(1))


def test_access_tree_leaves_out_most_entries_where_they_lie_in_groups():
    draw = np.random.default_rng(1)
    centres = draw.integers(-10**6, 10**6, (8, 4))
    book = np.concatenate([c + draw.integers(-500, 500, (8, 4)) for c in centres])
    rows = np.concatenate([c + draw.integers(-500, 500, (300, 4)) for c in centres])
    tree = codes.AccessTree(book)
    index, _ = tree.nearest(rows)
    assert np.array_equal(index, ((rows[:, None] - book) ** 2).sum(2).argmin(1))
    assert tree.measured < 0.35 * len(rows) * len(book)


def plain_codes(rows, parts=16, entries=64, rounds=2):
    x = codes.in_parts(grid(rows), parts)
    first = {}
    for r, v in zip(rows, x):
        if r.vec_id is not None and (r.vec_id not in first or r.embedding < first[r.vec_id][0]):
            first[r.vec_id] = (r.embedding, v)
    books = [[first[i][1][p].tolist() for i in sorted(first)[:entries]] for p in range(parts)]

    def near(p, v):
        return min((sum((int(a) - b) ** 2 for a, b in zip(v, e)), i) for i, e in enumerate(books[p]))

    for _ in range(rounds):
        new = [list(b) for b in books]
        for p in range(parts):
            members = {}
            for v in x[:, p]:
                members.setdefault(near(p, v)[1], []).append(v)
            for e, vs in members.items():
                new[p][e] = [int(sum(int(v[k]) for v in vs)) // len(vs) for k in range(len(vs[0]))]
        books = new
    out = []
    for r, v in zip(rows, x):
        best = [near(p, v[p]) for p in range(parts)]
        out.append((r.vec_id, "".join(f"{i:02x}" for _, i in best), sum(d for d, _ in best), r.label))
    total = {}
    for *_, error, label in out:
        total[label] = total.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(i, c, e, total[label], digest) for i, c, e, label in out]


def test_codes_equal_brute_force(odd):
    want = plain_codes(part(odd.collect()))
    assert sorted(map(tuple, codes.coded_vectors(odd).collect()), key=str) == sorted(want, key=str)
    assert sorted(map(tuple, codes.coded_vectors(odd.repartition(1)).collect()), key=str) == sorted(want, key=str)


def test_labels_beyond_the_broadcast_bound_are_joined(odd, monkeypatch):
    want = sorted(map(tuple, codes.coded_vectors(odd).collect()), key=str)
    monkeypatch.setattr(codes, "LABELS", 1)
    assert sorted(map(tuple, codes.coded_vectors(odd).collect()), key=str) == want


def test_codes_of_few_and_odd_vectors(spark, odd):
    assert codes.coded_vectors(odd.limit(0)).collect() == []
    nameless = odd.where("vec_id is null or embedding is null")
    assert codes.coded_vectors(nameless).collect() == []  # nothing can start a codebook
    few = spark.createDataFrame([(1, [1e30] * 5, 0), (2, [-1e30] * 5, 0), (2, [-1e30] * 5, 0)], "vec_id long, embedding array<double>, label int")
    rows = codes.coded_vectors(few).collect()  # five components in sixteen parts, held within the bound
    assert [r.error for r in rows] == [0] * 3 and {r.code for r in rows} == {"00" * 16, "01" * 5 + "00" * 11}


def test_decoded_vectors_are_the_entries(odd):
    books = codes.fit_codebooks(odd)
    for r in codes.decode(codes.encode(odd, books).limit(20), books).collect():
        assert np.array_equal(np.array(r.embedding) * 256, np.concatenate([books.entries[p][c] for p, c in enumerate(r.codes)]))


def plain_whitening(rows, k=4):
    x = grid(rows)
    distinct = np.unique(x, axis=0)
    n, sums = len(distinct), distinct.sum(0)
    values, vectors = np.linalg.eigh(np.cov(distinct.T.astype(float), bias=True))
    return n, sums, values[::-1], vectors[:, ::-1]


def test_whitening_equals_brute_force(odd):
    rows = part(odd.collect())
    n, sums, values, vectors = plain_whitening(rows)
    model = whitening.fit_whitening(odd)
    assert (model.count, model.sums) == (n, sums.tolist())
    assert np.allclose(model.values, values[:4], rtol=1e-12) and np.allclose(model.explained, values[:4] / values.sum(), rtol=1e-10)
    assert np.allclose(np.abs(model.directions.T @ vectors[:, :4]), np.eye(4), atol=1e-9)
    got = whitening.whiten(odd, model).collect()
    assert len(got) == 4 * len(rows) and all(r.identity_error < 1e-10 for r in got)
    want = {(r.vec_id, str(r.embedding)): x for r, x in zip(rows, grid(rows))}
    by_id = {}
    for (i, _), x in want.items():
        by_id.setdefault(i, []).append(x)
    for r in got:
        options = [(int(((n * x - sums) ** 2).sum()), float((x - sums / n) @ model.directions[:, r.component - 1] / np.sqrt(model.values[r.component - 1]))) for x in by_id[r.vec_id]]
        assert any(r.deviation == d and abs(r.whitened - w) < 1e-8 for d, w in options)


def test_triangles_fold_over_levels(odd, monkeypatch):
    one = whitening.fit_whitening(odd.repartition(1))
    monkeypatch.setattr(whitening, "FAN_IN", 2)
    monkeypatch.setattr(whitening, "ROWS", 7)
    many = whitening.fit_whitening(odd.repartition(13))
    assert np.allclose(one.values, many.values, rtol=1e-12) and np.allclose(one.directions, many.directions, atol=1e-9)


def test_whitening_without_spread(spark, odd):
    assert whitening.fit_whitening(odd.limit(0)) is None and whitening.whiten(odd.limit(0), None).collect() == []
    same = spark.createDataFrame([(i, [0.5, 0.25]) for i in range(9)] + [(None, [0.5, 0.25])], "vec_id long, embedding array<float>")
    rows = whitening.whiten(same, whitening.fit_whitening(same)).collect()
    assert len(rows) == 20 and all((r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (1, 0, None, 0.0, None) for r in rows)
    line = spark.createDataFrame([(i, [float(i), -float(i), 3.0]) for i in range(9)], "vec_id long, embedding array<float>")
    rows = whitening.whiten(line, whitening.fit_whitening(line)).collect()
    assert len(rows) == 27 and all((r.whitened is None) == (r.component > 1) for r in rows)
    assert all(abs(r.explained - (r.component == 1)) < 1e-12 and r.identity_error < 1e-12 for r in rows)
    huge = spark.createDataFrame([(1, [1e300]), (2, [-1e300]), (3, [0.0])], "vec_id long, embedding array<double>")
    assert {r.vec_id: r.deviation for r in whitening.whiten(huge, whitening.fit_whitening(huge)).collect()} == {1: None, 2: None, 3: 0}


@given(st.integers(0, 10_000), st.integers(1, 30), st.sampled_from(["plain", "clusters", "graded", "rank", "integers"]))
@settings(max_examples=80, deadline=None)
def test_bidiagonal_solver(seed, n, kind):
    draw = np.random.default_rng(seed)
    m = draw.normal(size=(n, n))
    if kind == "clusters":
        m = np.diag(draw.choice([1.0, 3.0, 3.0 + 1e-9], n)) @ np.linalg.qr(m)[0]
    elif kind == "graded":
        m = m * 10.0 ** draw.integers(-6, 6, n)
    elif kind == "rank":
        m[:, n // 2 :] = 0
    elif kind == "integers":
        m = np.round(m)
    squares, vectors = qd.right_vectors(m, n)
    want = np.linalg.svd(m, compute_uv=False) ** 2
    assert np.abs(squares - want).max() <= 1e-13 * n * max(want[0], 1e-300)
    sound = squares > 1e-9 * squares[0]  # what lies within rounding of zero has no direction of its own
    v = vectors[:, sound]
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max(initial=0) < 1e-5
    assert np.abs(m.T @ (m @ v) - v * squares[sound]).max(initial=0) <= 1e-11 * n * max(want[0], 1e-300)


def test_small_singular_values_keep_their_digits():
    a, b = 10.0 ** -np.arange(12.0), 0.5 * 10.0 ** -np.arange(11.0)
    product = qd.squared_values(a, b).prod()
    assert abs(product / np.prod(a**2) - 1) < 1e-11  # the determinant, whose factors span 22 powers of ten


def test_registered_whitening(spark, sf):
    from vectrove.llm.queries import op12_whitening

    rows = op12_whitening(spark, sf).collect()
    assert len(rows) == 4 * table(spark, sf, "embeddings").count()
    assert max(r.identity_error for r in rows) < 1e-10
