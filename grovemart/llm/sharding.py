"""Uniform shuffle into shards of exact size by a communication matrix.

Rows lie in virtual partitions. How many rows of each partition go to each shard is drawn
first, as the hypergeometric matrix that a uniform permutation of all rows would give;
its row sums are the partition sizes, its column sums the wanted shard sizes. Then every
partition is permuted for itself, its rows are dealt by the counts, and every shard is permuted
again. All permutations are hashes of the row's key columns: a task that runs again gives the
same rows.

The rows are only touched by DataFrame functions. The matrix has 4096 times the number
of shards cells, whatever the number of rows, and is drawn on the driver from the 4096
partition sizes.

Defined cases: rows equal in all key columns are interchangeable; nulls are hashed like
values; an empty table gives an empty one; shards differ by at most one row; columns named
like the result are replaced.
"""

from __future__ import annotations

import math
import random

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovemart.llm.common import before, put_back, set_aside

#: Virtual partitions, and slices of a shard for the second permutation: powers of two.
PARTITIONS = 4096
SLICE_BITS = 10


def hypergeometric(rng: random.Random, draws: int, good: int, bad: int) -> int:
    """Good ones among `draws` from `good` + `bad` without replacement: inversion from the mode outward."""
    low, high = max(0, draws - bad), min(draws, good)
    if low == high:
        return low
    mode = min(max((draws + 1) * (good + 1) // (good + bad + 2), low), high)

    def choices(n: int, k: int) -> float:
        return math.lgamma(n + 1) - math.lgamma(k + 1) - math.lgamma(n - k + 1)

    top = math.exp(choices(good, mode) + choices(bad, draws - mode) - choices(good + bad, draws))
    left = rng.random() - top
    down, up, p_down, p_up = mode, mode, top, top
    while left > 0 and (down > low or up < high):
        if up < high:
            p_up *= (good - up) * (draws - up) / ((up + 1) * (bad - draws + up + 1))
            up += 1
            left -= p_up
            if left <= 0:
                return up
        if down > low:
            p_down *= down * (bad - draws + down) / ((good - down + 1) * (draws - down + 1))
            down -= 1
            left -= p_down
            if left <= 0:
                return down
    return mode


def communication_matrix(sizes: list[int], shards: list[int], seed: int) -> list[list[int]]:
    """Counts by partition and shard: row sums `sizes`, column sums `shards`, drawn exactly."""
    rng, room, matrix = random.Random(seed), list(shards), []
    for size in sizes:
        counts, left, open_rows = [], size, sum(room)
        for j, free in enumerate(room):
            open_rows -= free
            taken = hypergeometric(rng, left, free, open_rows)
            counts.append(taken)
            left -= taken
            room[j] -= taken
        matrix.append(counts)
    return matrix


def shard(df: DataFrame, shards: int, keys: list[str], seed: int = 0) -> DataFrame:
    """`df` with `shard` (0 ...) and `slot` (0 ... in the shard, gapless), uniformly shuffled.

    `keys` are the columns that identify a row; nothing else decides on its place.
    """
    spark = df.sparkSession
    rows, names = set_aside(df)
    place = [F.col(names[key]) for key in keys]

    def hashed(step: int):
        return F.xxhash64(F.lit(f"{seed}|{step}"), *place)

    parted = rows.withColumn("_part", F.pmod(hashed(0), F.lit(PARTITIONS)).cast("int"))
    sizes = {row[0]: row[1] for row in parted.groupBy("_part").count().collect()}
    total = sum(sizes.values())
    capacity = [total // shards + (j < total % shards) for j in range(shards)]
    present = sorted(sizes)
    matrix = communication_matrix([sizes[p] for p in present], capacity, seed)
    cuts = []
    for part, counts in zip(present, matrix, strict=True):
        sums = [0]
        for count in counts:
            sums.append(sums[-1] + count)
        cuts.append((part, sums[1:]))
    dealt = spark.createDataFrame(cuts, "_part int, _cuts array<bigint>")

    local = Window.partitionBy("_part").orderBy(hashed(1), *place)
    exchanged = (
        parted.withColumn("_rank", F.row_number().over(local) - 1)
        .join(dealt, "_part")
        .withColumn("shard", F.size(F.filter("_cuts", lambda cut: cut <= F.col("_rank"))).cast("int"))
        .drop("_part", "_rank", "_cuts")
        .withColumn("_second", hashed(2))
        .withColumn("_slice", F.shiftrightunsigned("_second", 64 - SLICE_BITS).cast("int"))
    )
    slices = exchanged.groupBy("shard", "_slice").agg(F.count("*").alias("_rows"))
    offsets = slices.withColumn("_offset", before(["shard"], ["_slice"], "_rows")).drop("_rows")
    again = Window.partitionBy("shard", "_slice").orderBy("_second", *place)
    return (
        exchanged.withColumn("_rank", F.row_number().over(again) - 1)
        .join(offsets, ["shard", "_slice"])
        .withColumn("slot", F.col("_offset") + F.col("_rank"))
        .select(*put_back(names, ["shard", "slot"]), "shard", "slot")
    )
