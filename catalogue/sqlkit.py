"""SQL building blocks that recur in the oracles."""

from __future__ import annotations


def drawn(source: str, n: str, seed: str) -> str:
    """The ``n`` first rows of a table in hash order."""
    return f"SELECT * FROM {source} ORDER BY md5('{seed}:' || CAST(row_id AS VARCHAR)), row_id LIMIT {n}"


def split(source: str, proportion: float, seed: str) -> str:
    """All rows with ``place`` in hash order and the table size ``total``."""
    return (
        f"SELECT *, row_number() OVER (ORDER BY md5('{seed}:' || CAST(row_id AS VARCHAR)), row_id) "
        f"<= CAST(floor(count(*) OVER () * {proportion}) AS BIGINT) AS held FROM {source}"
    )


def seeds(source: str, k: int, seed: str, name: str = "c0") -> str:
    """``c0(cluster, centroid)``: drawn rows numbered in row order."""
    return (
        f"{name} AS MATERIALIZED (SELECT row_number() OVER (ORDER BY row_id) - 1 AS cluster, features AS centroid "
        f"FROM ({drawn(source, str(k), seed)}))"
    )


def assigned(points: str, centroids: str, name: str) -> str:
    """``name(row_id, cluster, error)``: nearest centroid, ties to the lowest."""
    return (
        f"{name} AS MATERIALIZED (SELECT row_id, cluster, dist AS error FROM (SELECT p.row_id, c.cluster, "
        "list_distance(p.features, c.centroid) AS dist, row_number() OVER (PARTITION BY p.row_id "
        "ORDER BY list_distance(p.features, c.centroid), c.cluster) AS place "
        f"FROM {points} p, {centroids} c WHERE c.centroid IS NOT NULL) WHERE place = 1)"
    )


def means(assignment: str, long: str, seeds_: str, name: str) -> str:
    """``name(cluster, centroid)``: means of an assignment, NULL for an empty cluster."""
    return (
        f"{name} AS MATERIALIZED (SELECT k.cluster, m.centroid FROM {seeds_} k LEFT JOIN (SELECT cluster, "
        "list(mean ORDER BY feature) AS centroid FROM (SELECT a.cluster, u.feature, avg(u.x) AS mean "
        f"FROM {assignment} a JOIN {long} u USING (row_id) GROUP BY a.cluster, u.feature) GROUP BY cluster) m "
        "USING (cluster))"
    )


def lloyd(points: str, long: str, passes: int, first: str = "c0", tag: str = "") -> str:
    """CTEs ``a1{tag}, c1{tag} .. a<passes>{tag}, c<passes>{tag}``."""
    parts, centroids = [], first
    for step in range(1, passes + 1):
        parts.append(assigned(points, centroids, f"a{step}{tag}"))
        parts.append(means(f"a{step}{tag}", long, first, f"c{step}{tag}"))
        centroids = f"c{step}{tag}"
    return ", ".join(parts)


def contingency(assignment: str, labels: str, name: str, k: int) -> str:
    """``name(cluster, n0, n1)`` over labelled rows, for clusters 0..k-1."""
    return (
        f"{name} AS (SELECT k.cluster, count(*) FILTER (WHERE y.label = 0) AS n0, "
        f"count(*) FILTER (WHERE y.label = 1) AS n1 FROM (SELECT unnest(range({k})) AS cluster) k "
        f"LEFT JOIN {assignment} a USING (cluster) LEFT JOIN {labels} y ON y.row_id = a.row_id GROUP BY k.cluster)"
    )


BALANCE = "min(n0 + n1) / nullif(CAST(max(n0 + n1) AS DOUBLE), 0)"
PURITY = "1 - least(n0, n1) / nullif(CAST(greatest(n0, n1) AS DOUBLE), 0)"


def principal(long: str, k: int, squarings: int = 14) -> str:
    """``e1 .. e<k>(feature, x)`` and ``lam1 .. (value)``: leading eigenvectors of the covariance.

    Repeated squaring of the covariance (scaled by its trace) leaves the leading vector; the
    next one comes from the matrix with that component taken out. The largest loading is
    made positive.
    """
    parts = [
        f"mu AS MATERIALIZED (SELECT feature, avg(x) AS mean FROM {long} GROUP BY feature)",
        f"ctr AS MATERIALIZED (SELECT row_id, feature, x - mean AS x FROM {long} JOIN mu USING (feature))",
        "q1_0 AS MATERIALIZED (SELECT a.feature AS i, b.feature AS j, sum(a.x * b.x) / (count(*) - 1) AS x "
        "FROM ctr a JOIN ctr b USING (row_id) GROUP BY a.feature, b.feature)",
    ]
    for c in range(1, k + 1):
        for step in range(1, squarings + 1):
            old = f"q{c}_{step - 1}"
            parts.append(
                f"q{c}_{step} AS MATERIALIZED (SELECT a.i, b.j, sum(a.x * b.x) / any_value(t.trace) / any_value(t.trace) AS x "
                f"FROM {old} a JOIN {old} b ON a.j = b.i, (SELECT sum(x) AS trace FROM {old} WHERE i = j) t GROUP BY a.i, b.j)"
            )
        last = f"q{c}_{squarings}"
        parts += [
            # The column of the largest diagonal entry is the best-conditioned copy of the vector.
            f"d{c} AS (SELECT i AS feature, x FROM {last} WHERE j = (SELECT j FROM {last} WHERE i = j ORDER BY x DESC, i LIMIT 1))",
            f"e{c} AS MATERIALIZED (SELECT feature, x / sqrt((SELECT sum(x * x) FROM d{c})) * "
            f"(SELECT sign(x) FROM d{c} ORDER BY abs(x) DESC, feature LIMIT 1) AS x FROM d{c})",
            f"lam{c} AS MATERIALIZED (SELECT sum(q.x * a.x * b.x) AS value FROM q{c}_0 q JOIN e{c} a ON a.feature = q.i "
            f"JOIN e{c} b ON b.feature = q.j)",
            f"q{c + 1}_0 AS MATERIALIZED (SELECT q.i, q.j, q.x - (SELECT value FROM lam{c}) * a.x * b.x AS x "
            f"FROM q{c}_0 q JOIN e{c} a ON a.feature = q.i JOIN e{c} b ON b.feature = q.j)",
        ]
    for c in range(1, k + 1):
        parts.append(
            f"sc{c} AS MATERIALIZED (SELECT row_id, sum(ctr.x * e{c}.x) AS x FROM ctr JOIN e{c} USING (feature) GROUP BY row_id)"
        )
    return ", ".join(parts)
