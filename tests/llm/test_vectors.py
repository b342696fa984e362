"""Near vectors and top-k search against full products."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from grovemart.llm import components as module
from grovemart.llm import nearvectors, search
from grovemart.llm.components import components
from grovemart.llm.meetings import code_edges
from tests.llm.data import Groups, sorted_rows

NAN, INF = float("nan"), float("inf")
SCHEMA = "id long, label int, vector array<float>, cell string, dim string, shard string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, label, v, "x", "y", "z") for i, label, v in rows], SCHEMA)


def odd_rows(seed=0, dim=8, count=160):
    rng = np.random.default_rng(seed)
    base = rng.standard_normal((count // 4, dim))
    rows = []
    for i in range(count):
        v = base[i % len(base)] + rng.standard_normal(dim) * (0.05, 0.2, 0.4)[i % 3]
        rows.append((i * 10, int(i % 3) if i % 11 else None, [float(np.float32(x)) for x in v * rng.uniform(0.1, 9)]))
    rows += [
        (2001, 1, None), (2002, 1, []), (2003, 1, [0.0] * dim), (2004, 1, [NAN] + [1.0] * (dim - 1)),
        (2005, 1, [INF] + [1.0] * (dim - 1)), (2006, 1, [None] + [1.0] * (dim - 1)), (2007, 1, [1.0, 2.0]),
        (2008, 1, [2.0, 4.0]), (2009, 2, rows[0][2]), (2010, rows[1][1], rows[1][2]), (2011, rows[1][1], rows[1][2]),
        (2011, rows[1][1], rows[1][2]), (2012, 0, [-0.0, 1e-30] + [0.0] * (dim - 2)), (2013, 0, [0.0, 1e30] + [0.0] * (dim - 2)),
    ]
    return rows


def fine(v):
    return bool(v) and all(x is not None and np.isfinite(x) for x in v)


def brute_near(rows, threshold):
    groups, links = Groups(), [0] * len(rows)
    unit = [np.array(v, float) / np.linalg.norm(v) if fine(v) and any(v) else None for _, _, v in rows]
    for a in range(len(rows)):
        groups.root(rows[a][0])
        for b in range(a):
            if rows[a][1] is None or rows[a][1] != rows[b][1] or unit[a] is None or unit[b] is None:
                continue
            if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= threshold:
                links[a] += 1
                links[b] += 1
                groups.link(rows[a][0], rows[b][0])
    return sorted(((i, n, groups.root(i), groups.root(i) == i) for (i, _, _), n in zip(rows, links, strict=True)), key=repr)


@pytest.mark.parametrize("block", [2048, 8])
def test_near_vectors(spark, monkeypatch, block):
    monkeypatch.setattr(nearvectors, "BLOCK", block)
    rows = odd_rows()
    want = brute_near(rows, 0.93)
    assert sum(n for _, n, _, _ in want) > 50
    assert sorted_rows(nearvectors.near_duplicates(vectors(spark, rows), 0.93)) == want


def test_no_vectors(spark):
    assert nearvectors.near_duplicates(vectors(spark, []), 0.93).count() == 0
    one = nearvectors.near_duplicates(vectors(spark, [(1, 1, None), (2, None, [1.0])]), 0.93)
    assert sorted_rows(one) == [(1, 0, 1, True), (2, 0, 2, True)]


@pytest.mark.parametrize("scale", [1.0, 3.0, 2.0**100, 2.0**-100])
def test_pairs_at_the_threshold_are_linked(spark, scale):
    # The squares add up to 100²: the cosine to the axis of the 93 is 93 / 100 and nothing less.
    whole = [[5, 0, 19, 2, 0, 93, 31], [35, 1, 5, 93, 10], [93, 1, 31, 0, 18, 7, 4], [5, 6, 1, 3, 93, 32, 16]]
    rows = []
    for at, v in enumerate(whole):
        assert sum(x * x for x in v) == 10_000
        rows += [(10 * at, at, [float(x == 93) for x in v]), (10 * at + 1, at, [scale * x for x in v])]
    found = nearvectors.near_duplicates(vectors(spark, rows), 0.93)
    assert [r["n_links"] for r in found.collect()] == [1] * len(rows)


def test_no_pair_is_missed_by_chance():
    agree = 1 - np.arccos(0.93) / np.pi
    for largest in (1, 1000, 10**6, 10**9):
        bits, count = nearvectors.bands(0.93, largest)
        assert (1 - agree**bits) ** count <= 1e-12
        # Chernoff: 2^-kl(most / n, chance that a bit differs) bounds the chance of more bits than that.
        n, differ = bits * count, 1 - agree
        share = (nearvectors.most_differing(n, 0.93) + 1) / n
        kl = share * np.log(share / differ) + (1 - share) * np.log((1 - share) / agree)
        assert np.exp(-n * kl) <= 1e-9


def test_recall_on_the_table(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = [(r["vec_id"], r["label"], r["embedding"]) for r in table.collect()]
    found = {r["id"]: r["n_links"] for r in nearvectors.near_duplicates(
        table.select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vector")), 0.93).collect()}
    by_label = {}
    for i, label, v in rows:
        if label is not None and fine(v) and any(v):
            by_label.setdefault(label, []).append((i, v))
    links = same = 0
    for members in by_label.values():
        x = np.array([v for _, v in members], float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        counts = ((x @ x.T) >= 0.93).sum(axis=1) - 1
        links += int(counts.sum())
        same += sum(min(found[i], int(n)) for (i, _), n in zip(members, counts, strict=True))
        assert all(found[i] <= n for (i, _), n in zip(members, counts, strict=True))
    assert same >= 0.99 * links


def brute_top(rows, k, scale=1024):
    whole = [(i, [int(np.floor(float(scale) * float(np.float32(x)))) for x in v]) for i, _, v in rows if fine(v)]
    asked = {}
    for i, v in whole:
        if i % 100 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(v) == len(w))
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shard", [4096, 12])
def test_top_k(spark, monkeypatch, shard):
    monkeypatch.setattr(search, "SHARD", shard)
    monkeypatch.setattr(search, "LEAF", 4)
    rows = [r for r in odd_rows(seed=4) if r[0] != 2013]
    rows += [(2100, 1, rows[5][2]), (2200, 1, [0.0] * 8), (2300, 1, [1.0, 2.0])]
    assert sorted_rows(search.top_k(vectors(spark, rows), F.col("id") % 100 == 0, 10)) == brute_top(rows, 10)


def test_top_k_of_little(spark):
    empty = vectors(spark, [])
    assert search.top_k(empty, F.col("id") % 100 == 0, 10).count() == 0
    two = vectors(spark, [(100, 1, [1.0]), (7, 1, [2.0])])
    assert sorted_rows(search.top_k(two, F.col("id") % 100 == 0, 10)) == [(100, 1, 7, 2 * 1024 * 1024)]


def test_large_integers():
    tree = search.BallTree(np.array([1, 2]), np.array([[1 << 30, 1], [-(1 << 30), 5]]))
    assert tree.search(9, np.array([1 << 30, 1], object), 1, None) == [((1 << 60) + 1, 1)]


@pytest.mark.parametrize("part", [250_000, 60])
def test_components(spark, monkeypatch, part):
    monkeypatch.setattr(module, "PART", part)
    rng = np.random.default_rng(3)
    edges = [(i, i + 1) for i in range(300, 400)] + [tuple(map(int, e)) for e in rng.integers(0, 200, (120, 2))] + [(999, i) for i in range(500, 560)]
    groups = Groups()
    for a, b in edges:
        if a != b:
            groups.link(a, b)
    want = sorted((i, groups.root(i)) for i in groups.parent)
    table = spark.createDataFrame(edges, "u long, v long").repartition(6)
    assert sorted_rows(components(table)) == sorted(want, key=repr)
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def joined_codes(codes, sides, most):
    names = {"id": range(len(codes)), "meeting": [7] * len(codes), "side": sides}
    table = pa.table({**{n: pa.array(list(c), pa.int64()) for n, c in names.items()}, "code": pa.array(codes, pa.binary())})
    edges, groups = code_edges(table, most).to_pydict(), Groups()
    assert len(edges["u"]) < len(codes)
    for a, b in zip(edges["u"], edges["v"], strict=True):
        groups.link(a, b)
    return [groups.root(i) for i in range(len(codes))]


@pytest.mark.parametrize("sides", [[0, 0, 0], [-1, -1, 1], [1, 1, -1]])
def test_three_codes_in_a_chain(sides):
    # 0 and 1 are near 2, not each other.
    assert joined_codes([b"\x0f", b"\xf0", b"\x00"], sides, 4) == [0, 0, 0]


@pytest.mark.parametrize("across", [False, True])
def test_code_edges_join_all_near_pairs(across):
    rng = np.random.default_rng(6)
    for _ in range(50):
        codes = [x.tobytes() for x in rng.integers(0, 256, (40, 2), dtype=np.uint8)]
        sides = [(-1, 1)[i % 2] if across else 0 for i in range(40)]
        groups = Groups()
        for a in range(40):
            groups.root(a)
            for b in range(a):
                differ = (int.from_bytes(codes[a]) ^ int.from_bytes(codes[b])).bit_count()
                if differ <= 3 and (sides[a] != sides[b] or not across):
                    groups.link(a, b)
        assert joined_codes(codes, sides, 3) == [groups.root(i) for i in range(40)]
