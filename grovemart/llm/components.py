"""Connected components of a table of edges, by star contraction.

First every `PART` edges are contracted for themselves, to one edge per node, which leaves little
to do; a table of fewer edges is done by that. Then large stars and small stars in turn: every node's larger, then its smaller neighbours are linked
to its least neighbour, until nothing changes; O(log² n) rounds, each a join and a few
sums, each ending in a written table. A node with very many neighbours is one row of the minimum, and
its edges are split between tasks by the join.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovemart.llm.common import written

#: Edges that a task contracts by itself.
PART = 250_000


def _contracted(edges: DataFrame, parts: int) -> DataFrame:
    """An edge (u, v) from every node of a part's edges, but the least, to the least one it reaches there."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        for batch in batches:
            for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                a, b = root(a), root(b)
                parent[max(a, b)] = min(a, b)
        u = [x for x in parent if root(x) != x]
        columns = [pa.array(u, pa.int64()), pa.array([root(x) for x in u], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["u", "v"])

    return edges.coalesce(parts).mapInArrow(contract, "u long, v long")


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Edges (u, v) relinked to each u's least neighbour (itself included)."""
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    if not large:
        both = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    joined = both.join(least, "u")
    moved = joined.where("v > u" if large else "true").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        moved = moved.union(least.select("u", F.col("m").alias("v")))
    moved = moved.where("u <> v")
    return moved if large else moved.distinct()


def components(edges: DataFrame) -> DataFrame:
    """`node` and `component`, its least reachable node, for all nodes of edges (u, v)."""
    given = written(edges.select("u", "v").where("u <> v"), "edges")
    parts = max(1, -(-given.count() // PART))
    now = written(_contracted(given, parts), "contracted")
    seen = None
    while parts > 1:
        now = written(_star(_star(now, large=True), large=False), "stars")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(state) == seen:
            break
        seen = tuple(state)
    members = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    return members.union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
