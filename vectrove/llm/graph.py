"""Distributed union-find: connected components of an edge table, in DataFrame operations.

Alternating star operations: every node sends its larger neighbours to the smallest node it
knows, then its smaller ones, until the edges are stars around the smallest node of each
component. A round is grouped minima (combined before the shuffle) and a join that Spark
may split where one node has most edges; its result is stored, so no lineage builds up and
a lost executor costs one round at most. A round of few edges has few tasks, as each leaves
files behind in every shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vectrove.llm.common import discard, stored

#: A round has a task for so many edges, and so many tasks at least (fewer where Spark makes fewer).
EDGES, TASKS = 50_000, 8


def components(edges: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``edges(a, b)``: the smallest node it can reach.

    Edges are undirected and may repeat; loops and edges with a null end are left out. An
    empty table gives no rows.
    """
    return _stars(_settled(edges))


def stored_components(edges: DataFrame, node: str, component: str) -> DataFrame:
    """:func:`components`, written as a table of its own with these column names."""
    settled = _settled(edges)
    found = _stars(settled).select(F.col("node").alias(node), F.col("component").alias(component))
    out = stored(found, "components")
    discard(settled)
    return out


def _settled(edges: DataFrame) -> DataFrame:
    clean = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    now = stored(clean.distinct(), "edges")
    tasks = None
    while True:
        # Stars: every larger end has one edge, and is no smaller end.
        ends = now.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
        ends = ends.union(now.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
        nodes = _few(ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")), tasks)
        count, still = nodes.agg(F.sum("up"), F.max((F.col("up") > 1) | (F.col("up") > 0) & (F.col("down") > 0))).first()
        if not still:
            break
        tasks = max(TASKS, -(-count // EDGES))
        both = now.select("u", "v").union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _few(_few(large, tasks).distinct(), tasks)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        both = _few(small.union(least.select("u", F.col("m").alias("v"))), tasks).distinct()
        old, now = now, stored(_few(both, tasks), "edges")
        discard(old)
    return now


def _few(rows: DataFrame, tasks: int | None) -> DataFrame:
    """``rows`` in ``tasks`` tasks at most."""
    return rows if tasks is None else rows.coalesce(tasks)


def _stars(now: DataFrame) -> DataFrame:
    own = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(own)
