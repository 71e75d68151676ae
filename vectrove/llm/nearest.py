"""Approximate nearest neighbours by vantage-point trees, one tree a shard.

Largest inner products become smallest distances once every indexed vector gets one more
component that brings all to one length. In a tree each inner node splits its rows by their
distance to a vantage point; a query leaves out the far side when the triangle inequality
rules it out, taken as if its nearest so far were ``factor`` times as near. With factor
one, the search is exact. Batches of queries go down a tree together: each query to the leaf
on its own side, for a first bound, then all of them once over the nodes that are left open.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from vectrove.llm.common import stored
from vectrove.llm.vectors import block, inner, usable, usual_length

#: Rows of a shard, rows of a leaf, queries of a block.
SHARD, LEAF, QUERIES = 4096, 64, 512


class VantageTree:
    """Rows in tree order, and nodes ``(first, end, vantage row, radius, inside, outside)``."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray, longest: float):
        order = np.argsort(ids, kind="stable")
        self.ids, self.rows = ids[order], rows[order]
        rest = np.maximum(longest**2 - (self.rows**2).sum(1), 0)
        space = np.concatenate([self.rows, np.sqrt(rest)[:, None]], 1)
        self.nodes: list[tuple] = []
        rng = np.random.default_rng(len(ids))
        place = np.arange(len(ids))
        self.root = self._grow(place, space, 0, len(ids), rng)
        self.ids, self.rows, self.space = self.ids[place], self.rows[place], space[place]

    def _grow(self, place, space, first, end, rng) -> int:
        here, at = place[first:end], len(self.nodes)
        self.nodes.append((first, end, None, 0.0, -1, -1))
        if end - first > LEAF:
            vantage = space[here[rng.integers(len(here))]]
            far = np.sqrt(((space[here] - vantage) ** 2).sum(1))
            order = np.argsort(far, kind="stable")
            radius = float(far[order[len(order) // 2]])
            cut = int(np.searchsorted(far[order], radius, side="left"))
            if 0 < cut:  # rows that are all as far stay one leaf
                place[first:end] = here[order]
                inside = self._grow(place, space, first, first + cut, rng)
                outside = self._grow(place, space, first + cut, end, rng)
                self.nodes[at] = (first, end, vantage, radius, inside, outside)
        return at

    def search(self, own: np.ndarray, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Scores and ids of the ``k`` best of each query, best first; -inf fills up."""
        n, d = len(queries), queries.shape[1]
        scores, ids = np.full((n, k), -np.inf), np.full((n, k), np.iinfo(np.int64).max)
        length = (queries**2).sum(1)
        lifted = np.concatenate([queries, np.zeros((n, 1))], 1)
        longest = (self.space[0] ** 2).sum() if len(self.space) else 0.0
        # Twice what either way of summing may be off, for every row of this length.
        slack = 4 * d * np.finfo(float).eps * np.sqrt(length * longest) + 4 * d * np.finfo(float).tiny

        def reach(at: np.ndarray) -> np.ndarray:
            """Distance of the last of the best so far, in the lifted space."""
            return np.sqrt(np.maximum(length[at] + longest - 2 * scores[at, -1], 0))

        home = np.full(n, -1)

        def side(node: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Distances from a node's vantage point, and whether they are inside."""
            away = np.sqrt(np.maximum(((lifted[at] - self.nodes[node][2]) ** 2).sum(1), 0))
            return away, away < self.nodes[node][3]

        def settle(node: int, at: np.ndarray) -> None:
            """Each query down to the leaf on its own side, which gives it a first reach."""
            if not len(at):
                return
            if self.nodes[node][2] is None:
                measure(node, at)
                home[at] = node
                return
            near_in = side(node, at)[1]
            settle(self.nodes[node][4], at[near_in])
            settle(self.nodes[node][5], at[~near_in])

        def visit(node: int, at: np.ndarray) -> None:
            """Every node at most once, for all queries that have not ruled it out when it is reached."""
            if not len(at):
                return
            vantage, radius, inside, outside = self.nodes[node][2:]
            if vantage is None:
                measure(node, at[home[at] != node])
                return
            away, near_in = side(node, at)
            for child, mine in ((inside, near_in), (outside, ~near_in)):
                # A little slack keeps rounding from ruling out an equal distance.
                open_ = np.abs(away - radius) <= factor * reach(at) * (1 + 1e-9) + 1e-9
                visit(child, at[mine | open_])

        def measure(node: int, at: np.ndarray) -> None:
            if not len(at):
                return
            first, end = self.nodes[node][:2]
            # A matrix product rules out rows by more than its rounding error; the others are measured.
            rough = queries[at] @ self.rows[first:end].T
            row, column = np.nonzero(~(rough < (scores[at, -1] - slack[at])[:, None]))
            keep = self.ids[first + column] != own[at[row]]
            row, column = row[keep], first + column[keep]
            if not len(row):
                return
            counts = np.bincount(row, minlength=len(at))
            some = np.flatnonzero(counts)
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            line = (np.cumsum(counts > 0) - 1)[row]
            at, width = at[some], k + int(counts.max())
            every, who = np.full((len(at), width), -np.inf), np.full((len(at), width), np.iinfo(np.int64).max)
            every[:, :k], who[:, :k] = scores[at], ids[at]
            every[line, k + place] = inner(queries[at[line]], self.rows[column])
            who[line, k + place] = self.ids[column]
            best = np.lexsort((who, -every), axis=1)[:, :k]
            scores[at], ids[at] = np.take_along_axis(every, best, 1), np.take_along_axis(who, best, 1)

        if n and len(self.ids) and d:
            settle(self.root, np.arange(n))
            visit(self.root, np.arange(n))
        return scores, ids


def build_index(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding", shard: int = SHARD) -> DataFrame:
    """``shard, tree``: every usable row in one tree of about ``shard`` rows.

    Null, zero and non-finite vectors and vectors of an unusual length take no part, nor do
    rows without an id; of rows that share an id one counts, that of the smallest vector.
    Other columns are ignored. The number of shards follows from the number of rows.
    """
    rows = (
        vectors.where(usable(F.col(column)) & F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
        .groupBy("id")
        .agg(F.min("v").alias("v"))
    )
    rows = stored(rows, "vectors")
    width = usual_length(rows, "v")
    rows = rows.where(F.size("v") == width)
    norm = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    count, longest = rows.agg(F.count("id"), F.sqrt(F.max(norm))).first()
    shards = max(1, -(-count // shard))

    def grow(group: pa.Table) -> pa.Table:
        tree = VantageTree(group.column("id").to_numpy(), block(group.column("v").combine_chunks()), longest * (1 + 1e-12))
        return pa.table({"shard": group.column("shard")[:1], "tree": pa.array([pickle.dumps(tree)], pa.binary())})

    placed = rows.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)))
    return stored(placed.groupBy("shard").applyInArrow(grow, "shard long, tree binary"), "trees")


def search_index(
    index: DataFrame, queries: DataFrame, k: int = 20, factor: float = 0.6, id_column: str = "vec_id", column: str = "embedding"
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` best rows found for each query.

    A row is never its own neighbour. Ties go to the smaller id; with fewer rows than ``k``
    all are returned. ``factor`` from 0 to 1 trades recall for work; 1 is exact. Queries are
    sent to every shard in blocks, and each tree answers a block at once; unusable queries
    have no rows.
    """
    usable_queries = (
        queries.where(usable(F.col(column)) & F.col(id_column).isNotNull())
        .select(F.col(id_column).cast("long").alias("id"), F.col(column).cast("array<double>").alias("v"))
        .groupBy("id")
        .agg(F.min("v").alias("v"))
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, QUERIES):
                part = batch.slice(i, QUERIES)
                lists = part.column("v").to_pylist()
                data = pickle.dumps((part.column("id").to_numpy(), lists))
                yield pa.RecordBatch.from_arrays([pa.array([data], pa.binary())], ["block"])

    shards = index.agg(F.coalesce(F.max("shard"), F.lit(-1))).first()[0] + 1
    if not shards:
        return queries.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks = stored(usable_queries.mapInArrow(pack, "block binary"), "queries")
    sent = blocks.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, tree = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                number = batch.column("shard")[i].as_py()
                if number != last:
                    last, tree = number, pickle.loads(batch.column("tree")[i].as_py())
                own, lists = pickle.loads(batch.column("block")[i].as_py())
                fit = [j for j, v in enumerate(lists) if len(v) == tree.rows.shape[1]]
                own, rows = own[fit], np.array([lists[j] for j in fit], float).reshape(len(fit), -1)
                scores, ids = tree.search(own, rows, k, factor)
                there = scores > -np.inf
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(own, there.sum(1))), pa.array(ids[there]), pa.array(scores[there])],
                    ["query_id", "vec_id", "score"],
                )

    pairs = sent.join(index, "shard").select("shard", "tree", "block")
    found = pairs.mapInArrow(answer, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def recall(found: pd.DataFrame, exact: pd.DataFrame) -> float:
    """Share of the exact neighbours that were found."""
    both = found.merge(exact, on=["query_id", "vec_id"])
    return len(both) / max(1, len(exact))
