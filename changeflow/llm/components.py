"""Connected components of a large graph.

Every round turns the graph into one with fewer and shorter paths (alternating large-star
and small-star, Kiveris et al. 2014), so rounds grow with the logarithm of the longest
path. Before the first round each task contracts its own edges with union-find. A round is
written to the shared folder: a lost executor costs its own tasks only. No vertex
gathers its neighbours: each round is a minimum per vertex, combined before the shuffle,
and a join whose hot keys Spark can split.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from changeflow.session import materialize


def union_find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (a, b) of a task to at most one edge per vertex: to the smallest it reaches here."""
    for batch in batches:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for a, b in zip(batch["a"].to_pylist(), batch["b"].to_pylist()):
            a, b = root(a), root(b)
            parent[max(a, b)] = min(a, b)
        found = [(x, r) for x in list(parent) if (r := root(x)) != x]
        yield pa.RecordBatch.from_pydict({"a": pa.array([x for x, _ in found], pa.int64()),
                                          "b": pa.array([r for _, r in found], pa.int64())})


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy("a").agg(F.least("a", F.min("b")).alias("m"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b")
    return moved.union(least.select("a", F.col("m").alias("b"))).distinct()


def connected(edges: DataFrame) -> DataFrame:
    """(node, label) of every vertex of the long pairs (a, b); the label is the smallest
    vertex that it reaches. Loops and repeated edges do no harm; no edges, no rows."""
    pairs = edges.select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    now = materialize(pairs.where("a <> b").mapInArrow(union_find, "a long, b long"), "edges")
    before = None
    while True:
        now = materialize(_small_star(_large_star(now)), "edges")
        state = now.agg(F.count("a"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("label"))
    return stars.union(now.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct())
