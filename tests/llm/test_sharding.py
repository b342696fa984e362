"""Shards: exact sizes, gapless slots, a fair matrix."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from grovemart.llm import sharding
from tests.llm import data


@pytest.mark.parametrize("shards", [1, 4, 40])
def test_sizes_and_slots(spark, shards):
    docs = data.documents(spark)
    rows = sharding.shard(docs, shards, ["doc_id", "text"])
    assert [c for c in rows.columns if c not in ("shard", "slot")] == [c for c in docs.columns if c not in ("shard", "slot")]
    slots = Counter()
    seen = set()
    for r in rows.collect():
        slots[r["shard"]] += 1
        seen.add((r["shard"], r["slot"]))
    sizes = [slots[s] for s in range(shards)]
    assert sum(sizes) == len(data.ODD) and max(sizes) - min(sizes) <= 1
    assert seen == {(s, i) for s in range(shards) for i in range(slots[s])}


def test_rows_are_kept_and_reruns_agree(spark):
    docs = data.documents(spark).select("doc_id", "text")
    first = sharding.shard(docs, 3, ["doc_id", "text"])
    assert data.sorted_rows(first.select("doc_id", "text")) == sorted(((d, t) for d, t, _ in data.ODD), key=repr)
    again = sharding.shard(docs.repartition(5), 3, ["doc_id", "text"])
    assert data.sorted_rows(first) == data.sorted_rows(again)
    assert sharding.shard(docs.limit(0), 3, ["doc_id"]).count() == 0


def test_many_equal_rows(spark):
    same = spark.range(5000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("x").alias("text"))
    counts = [r["count"] for r in sharding.shard(same, 40, ["doc_id", "text"]).groupBy("shard").count().collect()]
    assert counts == [125] * 40


def test_matrix_sums():
    sizes, shards = [0, 7, 100, 1, 50], [40, 40, 39, 39]
    matrix = sharding.communication_matrix(sizes, shards, seed=3)
    assert [sum(row) for row in matrix] == sizes
    assert [sum(column) for column in zip(*matrix, strict=True)] == shards


def test_hypergeometric_distribution():
    from math import comb

    rng, n = random.Random(1), 20_000
    seen = Counter(sharding.hypergeometric(rng, 6, 5, 9) for _ in range(n))
    for k in range(6):
        p = comb(5, k) * comb(9, 6 - k) / comb(14, 6)
        assert abs(seen[k] / n - p) < 5 * (p * (1 - p) / n) ** 0.5 + 1e-4


def test_uniform_over_shards_and_slots(spark):
    """Rows that lie side by side do not stay together: neighbours share a shard as often as by chance."""
    placed = sharding.shard(spark.range(4000).withColumnRenamed("id", "doc_id"), 10, ["doc_id"])
    shard = {r["doc_id"]: (r["shard"], r["slot"]) for r in placed.collect()}
    together = sum(shard[i][0] == shard[i + 1][0] for i in range(3999)) / 3999
    assert abs(together - 0.1) < 0.025
    early = [shard[i][1] < 200 for i in range(2000)]
    assert abs(sum(early) / 2000 - 0.5) < 0.05
