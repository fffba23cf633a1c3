"""Connected components of a graph of any size.

Edges are dealt out evenly, some hundred thousand to a task, and every task replaces its edges by stars around the
smallest nodes of its own components. Where several tasks were needed, alternating large-star and small-star steps join
their stars. A step is a pre-aggregated minimum and a join of written tables, so a node with very many neighbours is split
by the adaptive skew join; no neighbour list is ever collected. Steps end when the edges form one star per component.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from fleetspark.session import stored

EDGES_PER_TASK = 200_000


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            p, q = root(a), root(b)
            parent[max(p, q)] = min(p, q)
    found = [(x, root(x)) for x in list(parent)]
    found = [(x, r) for x, r in found if x != r]
    yield pa.RecordBatch.from_arrays(
        [pa.array([x for x, _ in found], pa.int64()), pa.array([r for _, r in found], pa.int64())], ["u", "v"])


def _linked(edges: DataFrame, smallest: DataFrame) -> DataFrame:
    """Edges (u, v) with the smallest node next to u; both sides are tables, so a hot u can be split."""
    return edges.join(stored(smallest, "smallest"), "u")


def _large_star(edges: DataFrame) -> DataFrame:
    upward = edges.select(F.col("v").alias("u"), F.col("u").alias("v"))  # v > u
    smallest = edges.unionByName(upward).groupBy("u").agg(F.least("u", F.min("v")).alias("m"))
    return _linked(upward, smallest).where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = _linked(edges, smallest).select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
    return moved.unionByName(smallest.select("u", F.col("m").alias("v"))).distinct()


def _starry(edges: DataFrame) -> bool:
    """Whether every node has one neighbour, or is one of those."""
    if not edges.groupBy("u").count().where("count > 1").isEmpty():
        return False
    return edges.join(edges.select(F.col("v").alias("w")).distinct(), F.expr("u = w"), "left_semi").isEmpty()


def components(edges: DataFrame, a: str, b: str, per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(node, component) for every node of an edge; component is the smallest node. Loops and nulls are ignored."""
    given = stored(edges.where(F.col(a) != F.col(b)).select(F.col(a).alias("u"), F.col(b).alias("v")), "edges")
    tasks = 1 + given.count() // per_task
    current = stored(given.repartition(tasks).mapInArrow(_stars, "u long, v long"), "stars")
    while tasks > 1 and not _starry(current):
        current = stored(_small_star(stored(_large_star(current), "edges")), "stars")
    centres = current.select("v").distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        centres.select(F.col("v").alias("node"), F.col("v").alias("component")))
