"""N-gram Jaccard join by signature trees.

A document is the set of its word shingles. Equal sets are one class. Which classes may be
alike is found by min-hash bands and one well-mixed bit of every min-hash: classes that agree in a
band and whose bits allow the threshold are in one candidate group. A pair at the threshold is
missed with a chance below `MISS` by the bands and below `MISS` by the bits, so below twice `MISS`
in all (and less the more alike it is), for min-hashes taken as independent; nothing is capped.

Candidate groups, disjoint and small but for groups of many copies, are joined exactly:
a signature tree over the sets, its nodes holding the OR of their token bitmaps and the range
of sizes, is traversed against itself; a pair of nodes is left where the common bits, with
the tokens that share bits, cannot hold the overlap that the sizes ask for. Pairs left over are
counted on the sets, unless they are linked already by others: what is asked for is the
components. Groups above `GROUP` shingles are cut into blocks that meet two by two.

Defined cases: null or empty text and text of white space only have no shingles and no links;
fewer words than a shingle make one; a row without doc_id links with nothing; rows of one
doc_id are told apart by their texts; an empty table gives an empty one; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovemart.llm.common import written
from grovemart.llm.components import components
from grovemart.llm.meetings import by_meeting, code_edges, dealt, meetings
from grovemart.llm.overlap import SPACE, Rolling, byte_values, mixed, word_values

#: Min-hashes of a band; chance to miss a pair at the threshold, of the bands and of the bits each.
ROWS, MISS = 3, 1e-9
#: Codes of a block, shingles of a block, codes and shingles that a task takes, text bytes hashed at a time.
CODES, GROUP, TASK_CODES, TASK_GROUP, SLICE = 2048, 1 << 20, 65_536, 1 << 22, 1 << 20
#: Bits of a token bitmap, members of a leaf, children of a node.
BITS, LEAF, FAN = 2048, 16, 8

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def shingle_sets(texts: list[bytes], size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each, and where each text begins (and the end)."""
    edges = np.concatenate(([0], np.cumsum([len(t) for t in texts]))).astype(np.int64)
    raw = LOWER[np.frombuffer(b"".join(texts), np.uint8)]
    word = ~SPACE[raw]
    first, last = word.copy(), word.copy()
    first[1:] &= ~word[:-1]
    last[:-1] &= ~word[1:]
    inner = edges[(edges > 0) & (edges < len(raw))]
    first[inner], last[inner - 1] = word[inner], word[inner - 1]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    docs = np.searchsorted(starts, edges)
    words = Rolling(word_values(raw.tobytes(), byte_values()[raw], starts, ends))
    counts = np.diff(docs)
    # A text of fewer words has one shingle of them all.
    shingles = np.where(counts >= size, counts - size + 1, (counts > 0).astype(np.int64))
    owner = np.repeat(np.arange(len(texts)), shingles)
    at = np.arange(len(owner)) - np.repeat(np.cumsum(shingles) - shingles, shingles) + docs[owner]
    hashes = words.of(at, np.minimum(at + size, docs[owner + 1]))
    order = np.lexsort((hashes, owner))
    owner, hashes = owner[order], hashes[order]
    new = np.ones(len(hashes), bool)
    new[1:] = (owner[1:] != owner[:-1]) | (hashes[1:] != hashes[:-1])
    return hashes[new], np.searchsorted(owner[new], np.arange(len(texts) + 1))


def digests(hashes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two order-free 64-bit digests of every set; 0 for an empty one."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes), dtype=np.uint64)))
    other = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(hashes ^ np.uint64(0x5BD1E995)), dtype=np.uint64)))
    one, two = sums[starts[1:]] - sums[starts[:-1]], other[starts[1:]] - other[starts[:-1]]
    return mixed(one).view(np.int64), mixed(two).view(np.int64)


def band_count(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold**ROWS))


def most_differing(bits: int, threshold: float) -> int:
    """Least number of differing bits that a pair at the threshold exceeds with a chance below MISS."""
    differ = (1 - threshold) / 2
    chance = [math.comb(bits, n) * differ**n * (1 - differ) ** (bits - n) for n in range(bits + 1)]
    most, above = bits, 0.0
    while most and above + chance[most] < MISS:
        above += chance[most]
        most -= 1
    return most


def min_hashes(hashes: np.ndarray, starts: np.ndarray, count: int, seed: int) -> np.ndarray:
    """(set, function): the least value of each hash function over each set, which must not be empty."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(0, 1 << 32, count, dtype=np.uint32) | np.uint32(1)
    shift = rng.integers(0, 1 << 32, count, dtype=np.uint32)
    tokens = (hashes >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts) - 1, count), np.uint32)
    for i in range(count):
        out[:, i] = np.minimum.reduceat(tokens * factor[i] + shift[i], starts[:-1])
    return out


def min_hash_bits(least: np.ndarray) -> np.ndarray:
    """A bit of every min-hash, packed by set.

    Mixed with the number of its function: the lowest bit of t * factor + shift is the token's own.
    """
    number = np.arange(1, least.shape[1] + 1, dtype=np.uint64) << np.uint64(32)
    return np.packbits((mixed(least | number) & np.uint64(1)).astype(bool), axis=1)


def sliced(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about SLICE bytes."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text)
        if size >= SLICE or i + 1 == len(texts):
            yield first, i + 1
            first, size = i + 1, 0


def _sketches(docs: DataFrame, size: int, bands: int, seed: int) -> DataFrame:
    """doc_id, hash of the text, n_shingles, two digests, band keys and min-hash bits of every document."""
    names = ["doc_id", "text_key", "n_shingles", "one", "two", "keys", "code"]

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.encode() if t else b"" for t in batch.column(1).to_pylist()]
            for low, high in sliced(texts):
                hashes, starts = shingle_sets(texts[low:high], size)
                count = np.diff(starts)
                one, two = digests(hashes, starts)
                some = np.flatnonzero(count)
                keys: list = [None] * len(count)
                codes: list = [None] * len(count)
                if len(some):
                    least = min_hashes(hashes, np.append(starts[:-1][some], len(hashes)), bands * ROWS, seed)
                    packed = min_hash_bits(least)
                    banded = least.reshape(len(some), bands, ROWS).astype(np.uint64)
                    key = np.arange(1, bands + 1, dtype=np.uint64)[None, :]
                    for r in range(ROWS):
                        key = mixed(key * np.uint64(0x100000001B3) + banded[:, :, r])
                    key = key.view(np.int64)
                    for i, row in enumerate(some):
                        keys[row], codes[row] = key[i], packed[i].tobytes()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low), batch.column(2).slice(low, high - low),
                        pa.array(count, pa.int64()), pa.array(one), pa.array(two),
                        pa.array(keys, pa.list_(pa.int64())), pa.array(codes, pa.binary()),
                    ],
                    names=names,
                )

    schema = "doc_id long, text_key long, n_shingles long, one long, two long, keys array<bigint>, code binary"
    return docs.select(F.col("doc_id").cast("long"), "text", F.xxhash64("text").alias("text_key")).mapInArrow(sketch, schema)


class SignatureTree:
    """Sets in leaves by size; every node with its OR bitmap, size range and least number of shared bits."""

    def __init__(self, sets: list[np.ndarray], members: np.ndarray) -> None:
        sizes = np.array([len(sets[i]) for i in members])
        self.members = members[np.argsort(sizes, kind="stable")]
        self.sizes = np.array([len(sets[i]) for i in self.members])
        self.maps = np.zeros((len(members), BITS // 8), np.uint8)
        for row, i in enumerate(self.members):
            bits = np.zeros(BITS, bool)
            bits[sets[i] % np.uint64(BITS)] = True
            self.maps[row] = np.packbits(bits)
        self.maps = self.maps.view(np.uint64)
        self.spare = self.sizes - np.bitwise_count(self.maps).sum(axis=1)
        # Nodes level by level: (first, last) of members, or of the level below.
        self.levels = [self._level(np.arange(0, len(members), LEAF), self.maps, self.sizes, self.sizes, self.spare)]
        while len(self.levels[-1][0]) > 1:
            starts, maps, low, high, spare = self.levels[-1]
            self.levels.append(self._level(np.arange(0, len(starts), FAN), maps, low, high, spare))

    @staticmethod
    def _level(starts, maps, low, high, spare):
        return (
            starts, np.bitwise_or.reduceat(maps, starts, axis=0), np.minimum.reduceat(low, starts),
            np.maximum.reduceat(high, starts), np.maximum.reduceat(spare, starts),
        )


def may_link(maps_a, low_a, high_a, spare_a, maps_b, low_b, high_b, spare_b, threshold: int) -> np.ndarray:
    """Which pairs of nodes (or sets) may hold a pair of sets at `threshold` percent."""
    common = np.bitwise_count(maps_a[:, None, :] & maps_b[None, :, :]).sum(axis=2, dtype=np.int64)
    most = np.minimum(common + np.minimum(spare_a[:, None], spare_b[None, :]), np.minimum(high_a[:, None], high_b[None, :]))
    sizes = low_a[:, None] + low_b[None, :]
    alike = (100 * high_a[:, None] >= threshold * low_b[None, :]) & (100 * high_b[None, :] >= threshold * low_a[:, None])
    # overlap / (sizes - overlap) >= threshold / 100
    return alike & ((100 + threshold) * most >= threshold * sizes)


def linked_pairs(a: SignatureTree, b: SignatureTree, threshold: int) -> Iterator[tuple[int, int]]:
    """Pairs of members that the bitmaps cannot part: both trees from the top down."""
    same = a is b
    level_a, level_b = len(a.levels) - 1, len(b.levels) - 1
    waiting = [(level_a, 0, level_b, 0)]

    def children(tree: SignatureTree, level: int, node: int) -> np.ndarray:
        starts = tree.levels[level][0]
        below = len(tree.members) if level == 0 else len(tree.levels[level - 1][0])
        return np.arange(starts[node], starts[node + 1] if node + 1 < len(starts) else below)

    def parts(tree: SignatureTree, level: int, rows: np.ndarray):
        if level < 0:
            return tree.maps[rows], tree.sizes[rows], tree.sizes[rows], tree.spare[rows]
        _, maps, low, high, spare = tree.levels[level]
        return maps[rows], low[rows], high[rows], spare[rows]

    while waiting:
        la, i, lb, j = waiting.pop()
        # The higher of two nodes is opened; both where they are leaves.
        open_a, open_b = la >= lb, lb >= la
        rows_a = children(a, la, i) if open_a else np.array([i])
        rows_b = children(b, lb, j) if open_b else np.array([j])
        la, lb = la - open_a, lb - open_b
        x, y = np.nonzero(may_link(*parts(a, la, rows_a), *parts(b, lb, rows_b), threshold))
        for p, q in zip(rows_a[x].tolist(), rows_b[y].tolist(), strict=True):
            if same and la == lb and p > q:
                continue
            if la < 0 and lb < 0:
                if not (same and p == q):
                    yield int(a.members[p]), int(b.members[q])
            else:
                waiting.append((la, p, lb, q))


def overlap_at_least(a: np.ndarray, b: np.ndarray, threshold: int) -> bool:
    common = len(a) + len(b) - len(np.union1d(a, b))
    return 100 * common >= threshold * (len(a) + len(b) - common)


def _joined(members: DataFrame, size: int, threshold: int, tasks: int) -> DataFrame:
    """Edges (u, v) that join what is linked in each meeting."""

    def join(rows: pa.Table) -> pa.Table:
        texts = [t.encode() if t else b"" for t in rows["text"].to_pylist()]
        sets: list[np.ndarray] = []
        wanted = zip(rows["one"].to_pylist(), rows["two"].to_pylist(), strict=True)
        for low, high in sliced(texts):
            hashes, starts = shingle_sets(texts[low:high], size)
            one, two = digests(hashes, starts)
            for found, (a, b), first, last in zip(
                zip(one.tolist(), two.tolist(), strict=True), wanted, starts[:-1], starts[1:], strict=False
            ):
                # Another text of a repeated doc_id is not the class that is asked for.
                sets.append(hashes[first:last] if found == (a, b) else hashes[:0])
        ids = rows["id"].to_numpy()
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while parent.setdefault(x, x) != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        u, v = [], []
        full = np.array([len(s) > 0 for s in sets], bool)
        for left, right in by_meeting(rows):
            within = len(left) == len(right) and bool((left == right).all())
            left, right = left[full[left]], right[full[right]]
            if not len(left) or not len(right):
                continue
            tree = SignatureTree(sets, left)
            other = tree if within else SignatureTree(sets, right)
            parent.clear()
            for p, q in linked_pairs(tree, other, threshold):
                a, b = root(int(ids[p])), root(int(ids[q]))
                if a != b and overlap_at_least(sets[p], sets[q], threshold):
                    parent[max(a, b)] = min(a, b)
                    u.append(max(a, b))
                    v.append(min(a, b))
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return dealt(members, tasks).groupBy("task").applyInArrow(join, "u long, v long")


def _classed(docs: DataFrame, size: int, threshold: int, seed: int) -> tuple[DataFrame, DataFrame]:
    """Documents with the number of their component and its component_id, and those that link with nothing."""
    bands = band_count(threshold / 100)
    sketched = written(_sketches(docs, size, bands, seed), "sketches")
    kinds = written(
        sketched.where("n_shingles > 0 and doc_id is not null")
        .groupBy("n_shingles", "one", "two")
        .agg(F.min_by(F.struct("keys", "code"), "doc_id").alias("sketch"), F.min(F.struct("doc_id", "text_key")).alias("row"))
        .select("n_shingles", "one", "two", F.col("row.doc_id").alias("first"), "row.text_key", "sketch.*")
        .withColumn("id", F.monotonically_increasing_id()),
        "kinds",
    )
    most = most_differing(bands * ROWS, threshold / 100)
    met = meetings(kinds.select("id", F.explode("keys").alias("key")), ["key"], CODES)
    coded = written(met.join(kinds.select("id", "code"), "id").select("id", "code", "meeting", "side"), "meetings")
    edges = dealt(coded, coded.count() // TASK_CODES).groupBy("task").applyInArrow(
        lambda rows: code_edges(rows, most), "u long, v long"
    )
    candidates = components(edges)
    grouped = written(
        kinds.join(candidates, F.col("id") == F.col("node")).select("id", "component", "first", "text_key", "one", "two", "n_shingles"),
        "candidates",
    )
    # Groups are cut before the texts join, so that only numbers are grouped. Tasks are as many as what is sent asks for.
    placed = written(meetings(grouped, ["component"], GROUP, F.col("n_shingles")).drop("component"), "placed")
    weight = placed.agg(F.sum("n_shingles")).first()[0] or 0
    # One text a candidate, whatever rows share its doc_id. Candidates grow with the documents, so they are never broadcast.
    row = ["first", "text_key"]
    texts = docs.select(F.col("doc_id").cast("long").alias("first"), F.xxhash64("text").alias("text_key"), "text")
    asked = texts.join(grouped.select(*row).hint("merge"), row, "left_semi").dropDuplicates(row)
    with_text = placed.hint("merge").join(asked, row)
    links = written(_joined(with_text.select("id", "one", "two", "text", "meeting", "side"), size, threshold, weight // TASK_GROUP), "links")
    joined = components(links)
    named = kinds.join(joined, F.col("id") == F.col("node"), "left").select(
        "n_shingles", "one", "two", "first", F.coalesce("component", "id").alias("component")
    )
    names = named.groupBy("component").agg(F.min("first").alias("component_id"))
    of_kind = named.join(names, "component").select("n_shingles", "one", "two", "component", "component_id")
    classed = sketched.where("n_shingles > 0 and doc_id is not null").join(of_kind, ["n_shingles", "one", "two"])
    return classed, sketched.where("n_shingles = 0 or doc_id is null")


def jaccard_components(docs: DataFrame, size: int = 5, threshold: int = 75, seed: int = 0) -> DataFrame:
    """doc_id, n_shingles, component_id (least doc_id reachable by links) of every document."""
    classed, rest = _classed(docs, size, threshold, seed)
    return classed.select("doc_id", "n_shingles", "component_id").union(
        rest.select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    )


def first_rows(docs: DataFrame, size: int = 5, threshold: int = 75, seed: int = 0) -> DataFrame:
    """doc_id and text_key (xxhash64 of the text) of one document a component, that of the least doc_id,
    and of all that link with nothing; none of rows without doc_id."""
    classed, rest = _classed(docs, size, threshold, seed)
    first = classed.groupBy("component").agg(F.min(F.struct("doc_id", "text_key")).alias("row")).select("row.*")
    return first.union(rest.where("doc_id is not null").select("doc_id", "text_key").distinct())
