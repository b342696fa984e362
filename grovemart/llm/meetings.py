"""Rows of a group meeting in tasks of bounded size.

A group of bounded size meets in one task; a larger one is cut into blocks that meet two by
two, so that every pair of rows meets and no task gets an unbounded group.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def meetings(rows: DataFrame, group: list[str], limit: int, weight: Column | None = None) -> DataFrame:
    """Adds `meeting` and `side` to the rows (with `id`) of groups of more than one.

    Blocks of a group weigh about `limit` (rows, or the sum of `weight`). `side` is -1 in the
    first block of a pair, 1 in the second, and 0 where a block meets itself.
    """
    size = F.count("*") if weight is None else F.sum(weight)
    sizes = rows.groupBy(*group).agg(F.count("*").alias("_rows"), size.alias("_size")).where("_rows > 1")
    blocks = F.ceil(F.col("_size") / limit).cast("int").alias("_blocks")
    pair = F.struct(F.least("_own", "_other").alias("a"), F.greatest("_own", "_other").alias("b"))
    return (
        rows.join(sizes.select(*group, blocks), group)
        .withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_blocks")).cast("int"))
        .withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
        .withColumn("meeting", F.xxhash64(*group, pair))
        .withColumn("side", F.signum(F.col("_own") - F.col("_other")).cast("int"))
        .drop("_blocks", "_own", "_other")
    )


def dealt(met: DataFrame, tasks: int) -> DataFrame:
    """Adds `task`: meetings dealt to a number of tasks."""
    return met.withColumn("task", F.pmod("meeting", F.lit(max(24, tasks))))


def by_meeting(rows: pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Row numbers of both sides of every meeting; the same ones twice within a block."""
    meeting, side = rows["meeting"].to_numpy(), rows["side"].to_numpy()
    order = np.lexsort((rows["id"].to_numpy(), meeting))
    if not len(order):
        return
    cuts = np.flatnonzero(np.diff(meeting[order]) != 0) + 1
    for at in np.split(order, cuts):
        left, right = at[side[at] <= 0], at[side[at] >= 0]
        if len(at) > 1 and len(left) and len(right):
            yield left, right


def _grouped(near: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of rows and of columns: the number of the first row they are joined to through near pairs, or -1."""
    back = np.ascontiguousarray(near.T)
    of_row, of_column = np.full(len(near), -1), np.full(len(back), -1)
    for start in starts.tolist():
        if of_row[start] >= 0:
            continue
        rows = np.array([start])
        while len(rows):
            of_row[rows] = start
            columns = np.flatnonzero(near[rows].any(axis=0) & (of_column < 0))
            of_column[columns] = start
            rows = np.flatnonzero(back[columns].any(axis=0) & (of_row < 0))
    return of_row, of_column


def code_edges(rows: pa.Table, most: float) -> pa.Table:
    """Edges (u, v) that join, in every meeting, all rows whose `code`s differ in `most` bits at most.

    Near is not transitive: every near pair counts, and each row gets an edge to the least id of those
    it is joined to.
    """
    joined = rows["code"].to_pylist()
    width = -(-max(map(len, joined), default=1) // 8) * 8
    words = np.frombuffer(b"".join(c.ljust(width, b"\0") for c in joined), np.uint64).reshape(len(joined), -1)
    ids = rows["id"].to_numpy()
    u, v = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for left, right in by_meeting(rows):
        differ = np.zeros((len(left), len(right)), np.uint16)
        for w in range(words.shape[1]):
            differ += np.bitwise_count(words[left, w][:, None] ^ words[right, w][None, :])
        near = differ <= most
        # Within a block every row is near itself.
        within = len(left) == len(right) and bool((left == right).all())
        starts = np.flatnonzero(near.sum(axis=1) > within)
        if not len(starts):
            continue
        group = np.concatenate(_grouped(near, starts))
        some = np.flatnonzero(group >= 0)
        who, group = ids[np.concatenate([left, right])[some]], group[some]
        least = np.full(len(left), np.iinfo(np.int64).max)
        np.minimum.at(least, group, who)
        u.append(who)
        v.append(least[group])
    u, v = np.concatenate(u), np.concatenate(v)
    pairs = np.unique(np.column_stack([u, v])[u != v], axis=0)
    return pa.table({"u": pa.array(pairs[:, 0], pa.int64()), "v": pa.array(pairs[:, 1], pa.int64())})
