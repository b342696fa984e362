"""Exact top-k inner-product search with ball trees.

Vectors become integers, so scores are exact. Candidates are split into shards of bounded size by
nearest of a few pivots, which keeps neighbours together; each shard is a ball tree, searched
best first by the largest inner product its nodes can hold, and cut off by the k-th score that
the query already has.

Queries are asked in two rounds. First each goes to the shard whose ball promises most,
which gives it a k-th score; then, with that score, to those of the other shards whose bound
reaches it. Queries travel only to shards that may change their answer. What tasks get from the
driver is pivots, at most `PIVOTS` a length, and one ball per shard of `SHARD` vectors.

Defined cases: vectors that are null, empty or hold null or non-finite components take no part;
only vectors of equal length are compared; equal scores go to the smaller id; repeated ids are
candidates of their own, but never of that id's query, which is asked once, by the least vector; rows beyond k are dropped by
definition of the search; an empty table gives an empty one.
"""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovemart.llm.common import written

#: Vectors of a shard at most on average, cells at most, vectors of a leaf.
SHARD, PIVOTS, LEAF = 4096, 256, 64
#: Integers above this are multiplied as Python numbers.
LARGE = 1 << 24


def usable(vector: Column) -> Column:
    """Not null, not empty, all components there and finite."""
    infinite = F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    return vector.isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True))


def integers(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, x as double."""
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long"))


class BallTree:
    """Vectors in balls of balls; leaves hold up to LEAF vectors."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        order = np.argsort(ids, kind="stable")
        self.ids, self.vectors = ids[order], vectors[order]
        if self.vectors.size and np.abs(self.vectors).max() > LARGE:
            self.vectors = self.vectors.astype(object)
        self.nodes: list[tuple[np.ndarray, float, np.ndarray | None, int, int]] = []
        self._grow(np.arange(len(ids)))

    def _grow(self, rows: np.ndarray) -> int:
        points = self.vectors[rows].astype(float)
        centre = points.mean(axis=0)
        away = np.sqrt(((points - centre) ** 2).sum(axis=1))
        number = len(self.nodes)
        radius = float(away.max())
        if len(rows) <= LEAF or radius == 0:
            self.nodes.append((centre, radius, rows, -1, -1))
            return number
        self.nodes.append((centre, radius, None, -1, -1))
        first = points[away.argmax()]
        second = points[((points - first) ** 2).sum(axis=1).argmax()]
        along = points @ (second - first)
        half = np.argsort(along, kind="stable")
        low = self._grow(np.sort(rows[half[: len(rows) // 2]]))
        high = self._grow(np.sort(rows[half[len(rows) // 2 :]]))
        self.nodes[number] = (centre, radius, None, low, high)
        return number

    def search(self, query_id: int, query: np.ndarray, k: int, floor: int | None) -> list[tuple[int, int]]:
        """The k best (score, id), at least `floor`; nodes in order of what they can reach at most."""
        found: list[tuple[int, int]] = []  # heap of (score, -id): the worst on top
        norm = float(np.sqrt((query.astype(float) ** 2).sum()))
        floating = query.astype(float)

        def bound(node: int) -> float:
            centre, radius = self.nodes[node][:2]
            reach = float(floating @ centre) + norm * radius
            return reach + 1e-6 * (1.0 + abs(reach) + norm * radius)

        waiting = [(-bound(0), 0)]
        while waiting:
            most, node = heapq.heappop(waiting)
            least = found[0][0] if len(found) == k else floor
            if least is not None and -most < least:
                break
            _, _, rows, low, high = self.nodes[node]
            if rows is None:
                for child in (low, high):
                    heapq.heappush(waiting, (-bound(child), child))
                continue
            scores = self.vectors[rows] @ query
            for i in np.flatnonzero(scores >= least) if least is not None else range(len(rows)):
                one = (int(scores[i]), -int(self.ids[rows[i]]))
                if -one[1] == query_id:
                    continue
                if len(found) < k:
                    heapq.heappush(found, one)
                elif one > found[0]:
                    heapq.heapreplace(found, one)
        return [(score, -negative) for score, negative in found]


def _pivots(rows: DataFrame, count: int) -> DataFrame:
    """Some vectors as centres of cells, the same in every run: at most PIVOTS rows per length."""
    first = Window.partitionBy("dim").orderBy(F.xxhash64("id"), "id")
    few = rows.where(F.pmod(F.xxhash64("id", F.lit(7)), F.lit(max(1, count // (8 * PIVOTS)))) == 0)
    return few.withColumn("cell", F.row_number().over(first)).where(F.col("cell") <= PIVOTS).select("dim", "cell", "vector")


def _cells(rows: DataFrame, pivots: dict[int, np.ndarray], shards: int) -> DataFrame:
    """Adds `shard`: the nearest pivot's cell, cut into parts of bounded size."""
    schema = "id long, dim int, vector array<bigint>, cell int"

    def assign(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = batch.column("dim").to_numpy()
            cell = np.zeros(len(dims), np.int32)
            flat = batch.column("vector").flatten().to_numpy().astype(float)
            starts = np.concatenate(([0], np.cumsum(dims)[:-1]))
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                points = flat[starts[at][:, None] + np.arange(dim)]
                centres = pivots[int(dim)]
                cell[at] = (points @ centres.T - 0.5 * (centres**2).sum(axis=1)).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell)], names=["id", "dim", "vector", "cell"])

    celled = written(rows.mapInArrow(assign, schema), "cells")
    sizes = celled.groupBy("dim", "cell").count()
    parts = sizes.select("dim", "cell", F.ceil(F.col("count") / SHARD).alias("parts"))
    part = F.pmod(F.xxhash64("id"), F.col("parts"))
    shard = F.xxhash64("dim", "cell", part)
    return celled.join(parts, ["dim", "cell"]).select("id", "dim", "vector", shard.alias("shard"))


def top_k(vectors: DataFrame, queries: Column, k: int, scale: int = 1024) -> DataFrame:
    """query_id, rank, id, score: the k best candidates of every row for which `queries` holds.

    `vectors` has `id` and `vector`; candidates are all other rows.
    """
    spark = vectors.sparkSession
    rows = written(
        vectors.where(usable(F.col("vector")))
        .select(F.col("id").cast("long"), F.size("vector").alias("dim"), integers(F.col("vector"), scale).alias("vector")),
        "vectors",
    )
    count = rows.count()
    pivots: dict[int, list] = {}
    for dim, _, vector in _pivots(rows, count).orderBy("dim", "cell").collect():
        pivots.setdefault(dim, []).append(vector)
    cells = max(1, min(PIVOTS, -(-count // SHARD)))
    centres = {dim: np.array(v[:cells], float) for dim, v in pivots.items()}
    for (dim,) in rows.select("dim").distinct().collect():
        centres.setdefault(dim, np.zeros((1, dim)))
    sharded = written(_cells(rows, centres, cells), "shards")
    asked = written(
        sharded.where(queries).groupBy("id", "dim").agg(F.min("vector").alias("query")).withColumnRenamed("id", "query_id"),
        "queries",
    )
    balls = _balls(sharded)
    none = F.lit(None).cast("long").alias("floor")
    first = written(_searched(sharded, _routed(asked.select("*", none), balls, True), k), "first")
    # The k-th score so far, for those that have k.
    kth = first.groupBy("query_id").agg(F.count("*").alias("have"), F.min("score").alias("least"))
    floors = kth.select("query_id", F.when(F.col("have") >= k, F.col("least")).alias("floor"))
    second = _searched(sharded, _routed(asked.join(floors, "query_id", "left"), balls, False), k)
    ranked = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (
        first.union(second)
        .withColumn("rank", F.row_number().over(ranked).cast("int"))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "id", "score")
    )


def _balls(sharded: DataFrame) -> dict[int, list[tuple[int, np.ndarray, float]]]:
    """By length: every shard with its centre and radius."""

    def ball(key: tuple, rows: pa.Table) -> pa.Table:
        points = np.array(rows["vector"].to_pylist(), float)
        centre = points.mean(axis=0)
        radius = float(np.sqrt(((points - centre) ** 2).sum(axis=1).max()))
        return pa.table({
            "shard": rows["shard"].slice(0, 1),
            "centre": pa.array([centre.tolist()], pa.list_(pa.float64())),
            "radius": pa.array([radius]),
        })

    found: dict[int, list] = {}
    schema = "shard long, centre array<double>, radius double"
    for shard, centre, radius in sharded.groupBy("shard").applyInArrow(ball, schema).collect():
        found.setdefault(len(centre), []).append((shard, np.array(centre), radius))
    return found


def _routed(asked: DataFrame, balls: dict, first: bool) -> DataFrame:
    """Queries with the shards they go to: the one of the largest bound, or all others that reach the floor."""
    schema = "query_id long, query array<bigint>, floor long, shard long"

    def route(batches):
        for batch in batches:
            rows = [batch.column(c).to_pylist() for c in ("query_id", "dim", "query", "floor")]
            for query_id, dim, query, floor in zip(*rows, strict=True):
                point = np.array(query, float)
                norm = float(np.sqrt((point**2).sum()))
                here = balls[dim]
                reach = np.array([c @ point + norm * r for _, c, r in here])
                reach += 1e-6 * (1.0 + np.abs(reach) + norm)
                best = int(reach.argmax())
                to = [best] if first else [i for i in range(len(here)) if i != best and (floor is None or reach[i] >= floor)]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([query_id] * len(to), pa.int64()),
                        pa.array([query] * len(to), pa.list_(pa.int64())),
                        pa.array([floor] * len(to), pa.int64()),
                        pa.array([here[i][0] for i in to], pa.int64()),
                    ],
                    names=["query_id", "query", "floor", "shard"],
                )

    return asked.mapInArrow(route, schema)


def _searched(sharded: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """The best k of a shard for each query sent to it, not below the score it has."""

    def search(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple[int, int, int]] = []
        if left.num_rows and right.num_rows:
            vectors = np.array(left["vector"].to_pylist(), np.int64)
            tree = BallTree(left["id"].to_numpy(), vectors)
            for query_id, query, floor in zip(*(right[c].to_pylist() for c in ("query_id", "query", "floor")), strict=True):
                point = np.array(query, np.int64)
                if np.abs(point).max() > LARGE or tree.vectors.dtype == object:
                    point = point.astype(object)
                out += [(query_id, other, score) for score, other in tree.search(query_id, point, k, floor)]
        columns = list(zip(*out, strict=True)) or [(), (), ()]
        return pa.table({n: pa.array(c, pa.int64()) for n, c in zip(("query_id", "id", "score"), columns, strict=True)})

    return sharded.groupBy("shard").cogroup(asked.groupBy("shard")).applyInArrow(search, "query_id long, id long, score long")
