"""Near-duplicate vectors by randomised-rotation binary codes.

A unit vector o is rotated at random and kept as its signs x, with the correction <x, o>. For any
other unit vector q, <x, q> and the correction bound <o, q> from above, as the angles of o and of q
to x differ by no more than that between o and q; only pairs whose bound reaches the
threshold are computed from the vectors themselves, in double precision. The bound is certain.

1. Equal vectors of a label become one, with a count.
2. Signs of several rotations are cut into bands; vectors of a label that agree in a band
   meet, as codes only. Code pairs whose differing bits allow the threshold join candidate
   groups. The bits of a band grow with the logarithm of the largest label, the bands so that a pair
   at the threshold meets in none of them with a chance below `MISS`; it differs in too many
   bits with a chance below `MISS`.
3. Groups, disjoint by now, are compared by the bounds and, where needed, exactly. Crowded bands and
   large groups are cut into blocks that meet two by two; of links only counts and
   one edge a vector leave a block.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components, and those
without a label, have no links; only equal lengths are compared; repeated ids are vectors of
their own; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovemart.llm.common import written
from grovemart.llm.components import components
from grovemart.llm.meetings import by_meeting, code_edges, dealt, meetings
from grovemart.llm.search import usable

#: Chance to miss a pair at the threshold, of the bands and of the bits each: in 10^9 such pairs none is missed.
MISS = 1e-12
#: Bits of a band at least, and members of a bucket on average above that.
BAND_BITS, BUCKET = 8, 64
#: Vectors of a block, and codes or vectors that a task takes together.
BLOCK, TASK = 2048, 32_768


def rotations(dim: int, count: int, seed: int) -> np.ndarray:
    """Random orthogonal matrices, side by side: (dim, count * dim)."""
    rng = np.random.default_rng([seed, dim])
    return np.hstack([np.linalg.qr(rng.standard_normal((dim, dim)))[0] for _ in range(count)])


def _scaled(vectors: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Vectors times powers of two, which round nothing, so that large or small components neither overflow nor vanish."""
    rows = np.array(vectors.to_pylist(), float)
    return np.ldexp(rows, -np.frexp(np.abs(rows).max(axis=1, keepdims=True))[1])


def _units(rows: np.ndarray) -> np.ndarray:
    return rows / np.sqrt((rows**2).sum(axis=1, keepdims=True))


def _signs(units: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    return units @ rotation >= 0


def bands(threshold: float, largest: int) -> tuple[int, int]:
    """Bits of a band and number of bands for the largest label."""
    agree = 1 - math.acos(threshold) / math.pi
    bits = max(BAND_BITS, math.ceil(math.log2(max(1, largest / BUCKET))))
    return bits, math.ceil(math.log(MISS) / math.log(1 - agree**bits))


def most_differing(bits: int, threshold: float) -> int:
    """Least number of differing bits that a pair at the threshold exceeds with a chance below MISS."""
    differ = math.acos(threshold) / math.pi
    most, above = bits, 0.0
    while most:
        ways = math.lgamma(bits + 1) - math.lgamma(most + 1) - math.lgamma(bits - most + 1)
        chance = math.exp(ways + most * math.log(differ) + (bits - most) * math.log(1 - differ))
        if above + chance >= MISS:
            break
        above += chance
        most -= 1
    return most


def _links(members: DataFrame, threshold: float, seed: int) -> DataFrame:
    """Per block pair: id, links (counting equal vectors) and the least linked id."""

    def compare(rows: pa.Table) -> pa.Table:
        ids, copies = rows["id"].to_numpy(), rows["copies"].to_numpy()
        out_id, out_links, out_least = [], [], []
        for left, right in by_meeting(rows):
            within = len(left) == len(right) and (left == right).all()
            q, o = _scaled(rows["vector"].take(pa.array(left))), _scaled(rows["vector"].take(pa.array(right)))
            dim = q.shape[1]
            rotation = rotations(dim, 1, seed)
            turned = _units(o) @ rotation
            code = np.where(turned >= 0, 1.0, -1.0) / math.sqrt(dim)
            # No code is further from q than o is and the threshold allows; 1e-7 for rounding, near 0 degrees most of all.
            angle = np.arccos(np.minimum(np.sum(code * turned, axis=1), 1)) + math.acos(threshold) + 1e-7
            least_product = np.cos(np.minimum(angle, math.pi)) - 1e-9
            a, b = np.nonzero((_units(q) @ rotation) @ code.T >= least_product)
            if within:
                a, b = a[a < b], b[a < b]
            linked = np.zeros(len(a), bool)
            for first in range(0, len(a), 1 << 16):
                part = slice(first, first + (1 << 16))
                x, y = q[a[part]], o[b[part]]
                squares = np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y)
                linked[part] = np.einsum("ij,ij->i", x, y) / np.sqrt(squares) >= threshold
            a, b = left[a[linked]], right[b[linked]]
            both, other = np.concatenate([a, b]), np.concatenate([b, a])
            if not len(both):
                continue
            who, at = np.unique(both, return_inverse=True)
            links, least = np.zeros(len(who), np.int64), np.full(len(who), np.iinfo(np.int64).max)
            np.add.at(links, at, copies[other])
            np.minimum.at(least, at, ids[other])
            out_id.append(ids[who])
            out_links.append(links)
            out_least.append(least)
        empty = np.zeros(0, np.int64)
        columns = {"id": out_id, "links": out_links, "least": out_least}
        return pa.table({n: pa.array(np.concatenate([empty, *c]), pa.int64()) for n, c in columns.items()})

    met = meetings(members, ["component"], BLOCK)
    # Tasks are as many as the rows sent ask for; a member of a large component is sent to each of its blocks.
    return dealt(met, met.count() // TASK).groupBy("task").applyInArrow(compare, "id long, links long, least long")


def near_duplicates(vectors: DataFrame, threshold: float, seed: int = 0) -> DataFrame:
    """id, n_links, component (least id reachable by links) and kept (id = component) of every row.

    `vectors` has id, label and vector.
    """
    number = F.transform("vector", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x.cast("double")))
    some = F.exists("vector", lambda x: x != 0)
    usable_rows = usable(F.col("vector")) & F.coalesce(some, F.lit(False)) & F.col("label").isNotNull()
    rows = vectors.select(F.col("id").cast("long"), "label", F.when(usable_rows, number).alias("vector"))
    valid = rows.where("vector is not null and id is not null")
    kinds = written(
        valid.groupBy("label", "vector").agg(F.min("id").alias("first"), F.count("*").alias("copies"))
        .withColumn("dim", F.size("vector")).withColumn("id", F.monotonically_increasing_id()),
        "kinds",
    )
    largest = kinds.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 1
    bits, n_bands = bands(threshold, largest)

    def encode(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            dims = batch.column("dim").to_numpy()
            codes = [b""] * len(dims)
            keys: list[list[int]] = [[]] * len(dims)
            weight = 1 << np.arange(bits, dtype=np.int64)
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                turn = rotations(int(dim), -(-bits * n_bands // int(dim)), seed + 1)
                signs = _signs(_units(_scaled(batch.column("vector").take(pa.array(at)))), turn)[:, : bits * n_bands]
                packed = np.packbits(signs, axis=1)
                # A band's bits lie far apart: those of one rotation depend on each other.
                numbers = np.einsum("ijk,j->ik", signs.reshape(len(at), bits, n_bands), weight)
                for i, row in enumerate(at):
                    codes[row], keys[row] = packed[i].tobytes(), numbers[i].tolist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("label_hash"), batch.column("dim"), pa.array(codes, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "label", "dim", "code", "keys"],
            )

    to_code = kinds.select("id", F.xxhash64("label").alias("label_hash"), "dim", "vector")
    coded = written(to_code.mapInArrow(encode, "id long, label long, dim int, code binary, keys array<bigint>"), "codes")
    banded = coded.select("id", "label", "dim", "code", F.posexplode("keys").alias("band", "key"))
    most = most_differing(bits * n_bands, threshold)
    met = written(meetings(banded, ["label", "dim", "band", "key"], BLOCK).select("id", "code", "meeting", "side"), "meetings")
    tasks = dealt(met, met.count() // TASK).groupBy("task")
    groups = components(tasks.applyInArrow(lambda rows: code_edges(rows, most), "u long, v long"))
    members = written(
        kinds.join(groups, F.col("id") == F.col("node")).select("component", "id", "vector", "copies"), "members"
    )
    links = written(_links(members, threshold, seed), "links")
    counted = links.groupBy("id").agg(F.sum("links").alias("links"))
    # Components of kinds by their numbers, then by the least id of a vector in them.
    joined = components(links.select(F.col("id").alias("u"), F.col("least").alias("v")))
    named = kinds.select("id", "first").join(joined, F.col("id") == F.col("node")).groupBy("component").agg(F.min("first").alias("name"))
    of_kind = (
        kinds.join(counted, "id", "left")
        .join(joined.withColumnRenamed("node", "id"), "id", "left")
        .join(named, "component", "left")
        .select("label", "vector", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("name", "first").alias("component"))
    )
    linked = valid.join(of_kind, ["label", "vector"]).select("id", "n_links", "component")
    alone = rows.where("vector is null or id is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.union(alone).withColumn("kept", F.col("id") == F.col("component"))
