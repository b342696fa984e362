"""Finding text that also occurs in another document: seeds, routing, answers.

Shared by the two substring operators, which differ in the unit (bytes or words) and in the
index that settles the open cases.

Every stretch of `length` units has a seed: its smallest `seed`-unit hash. Stretches of a
document with the same seed occurrence form a run. Equal stretches have equal seeds,
so it is enough to bring runs together by seed:

1. documents are written as blocks (a compressed table, bucketed by block) that later steps
   read without shuffling any text again;
2. of every run, two hashes go to the bucket of its seed: seed and whole content. Runs of
   equal content are settled there (all but those of the smallest doc_id go), as are seeds
   of one document only. Within a block the same is done before anything is sent, so a
   passage in a third of all documents is sent once per block;
3. the content of runs that share a seed but not all their text goes to a shard of such
   runs, where an index over texts, not hashes, tells which stretches are repeated. A seed with
   more than `CROWD` contents sends no text: its stretches are settled one by one by two hashes,
   seed and stretch, first within a block and then in the shard of the stretch, so that a passage of any
   number of documents is a row per block;
4. answers go back to the blocks, which are cut.

Defined cases: null text is empty; a document without doc_id is kept whole and is no
reference; equal doc_ids are no smaller than each other; columns of any name are carried.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, LongType

from grovemart.llm.common import once, written
from grovemart.session import run_dir

#: Text bytes of a block, and of the corpus per bucket of seeds and per shard of open runs.
BLOCK = 1 << 20
BUCKET = 4 << 20
SHARDS_OF_BUCKET = 4
#: Buckets of blocks at most: Spark refuses more than 100,000. A task takes its bucket block by block, so larger
#: buckets need no more memory; 100 TB in 65,536 of them are 1.5 GB each, a third of that as stored.
BUCKETS = 1 << 16
#: Different contents of one seed beyond which its stretches are settled one by one.
CROWD = 512
#: A stretch of a crowded seed as it is sent.
SINGLE = np.dtype([("seed", "u8"), ("content", "u8"), ("doc_id", "i8"), ("run", "u4"), ("stretch", "u4")])

BASE = 0x9E3779B97F4A7C15
#: Bytes of a word up to which a sum of powers is its hash.
SHORT_WORD = 48
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True


@dataclass(frozen=True)
class Unit:
    """What is compared: `bytes` or `words`; stretches of `length`, seeds of `seed` units."""

    kind: str
    length: int
    seed: int


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_values() -> np.ndarray:
    return once("byte_values", lambda: mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(BASE)))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE**i and its inverse, modulo 2**64, for i up to n."""
    out = []
    for base in (BASE, pow(BASE, -1, 1 << 64)):
        row = np.full(n + 1, base, np.uint64)
        row[0] = 1
        out.append(np.multiply.accumulate(row))
    return out[0], out[1]


class Rolling:
    """Hashes of any slices of a sequence of 64-bit values."""

    def __init__(self, values: np.ndarray) -> None:
        # One pair of rows a process, the longest asked for: shorter ones are its beginnings.
        kept = once("powers", dict)
        if len(kept.get("rows", ((),))[0]) <= len(values):
            kept["rows"] = _powers(max(BLOCK + (BLOCK >> 3), len(values)))
        power, self.inverse = kept["rows"]
        self.sums = np.zeros(len(values) + 1, np.uint64)
        np.cumsum(values * power[: len(values)], out=self.sums[1:])

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start] + (end - start).astype(np.uint64))


def word_values(data: bytes, values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word. Sums of powers modulo 2**64 are equal for texts of a certain doubled pattern
    from some thousand bytes on, so words above `SHORT_WORD` bytes are hashed as a whole."""
    out = Rolling(values).of(starts, ends)
    long = np.flatnonzero(ends - starts > SHORT_WORD)
    for i, start, end in zip(long.tolist(), starts[long].tolist(), ends[long].tolist(), strict=True):
        out[i] = int.from_bytes(hashlib.blake2b(data[start:end], digest_size=8).digest(), "little")
    return out


def first_minimum(values: np.ndarray, width: int) -> np.ndarray:
    """Place of the first smallest of each `width` neighbours."""
    best, place, have = values, np.arange(len(values), dtype=np.int32), 1
    while have < width:
        step = min(have, width - have)
        later = best[step:] < best[:-step]
        place = np.where(later, place[step:], place[:-step])
        best = np.where(later, best[step:], best[:-step])
        have += step
    return place


class Block:
    """Documents of a block as units, and their runs."""

    def __init__(self, rows: pa.Table, unit: Unit) -> None:
        texts = rows["text"].combine_chunks()
        texts = texts.chunk(0) if isinstance(texts, pa.ChunkedArray) else texts
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        sizes = pc.binary_length(texts).to_numpy().astype(np.int64)
        self.data = b"".join(texts.to_pylist())
        self.edges = np.concatenate(([0], np.cumsum(sizes)))
        self.ids, self.unit = rows["doc_id"].to_pylist(), unit
        raw = np.frombuffer(self.data, np.uint8)
        values = byte_values()[raw]
        if unit.kind == "bytes":
            self.starts = self.ends = None
            self.docs, self.rolling = self.edges, Rolling(values)
        else:
            word = ~SPACE[raw]
            first, last = word.copy(), word.copy()
            first[1:] &= ~word[:-1]
            last[:-1] &= ~word[1:]
            inner = self.edges[(self.edges > 0) & (self.edges < len(raw))]
            first[inner] = word[inner]
            last[inner - 1] = word[inner - 1]
            self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
            self.docs = np.searchsorted(self.starts, self.edges)
            self.rolling = Rolling(word_values(self.data, values, self.starts, self.ends))
        self.counts = np.diff(self.docs)
        self.owner = np.repeat(np.arange(len(self.counts), dtype=np.int32), self.counts)
        self._runs()

    def _runs(self) -> None:
        n, length, k = len(self.owner), self.unit.length, self.unit.seed
        empty = np.zeros(0, np.int64)
        self.first = self.count = self.place = self.doc = empty
        self.seed = self.content = np.zeros(0, np.uint64)
        self.doc_id = empty
        if n < length:
            return
        at = np.arange(n - k + 1)
        grams = self.rolling.of(at, at + k)
        place = first_minimum(grams, length - k + 1)
        known = np.array([i is not None for i in self.ids], bool)[self.owner[: n - length + 1]]
        inside = np.flatnonzero((self.owner[: n - length + 1] == self.owner[length - 1 :]) & known)
        if not len(inside):
            return
        seeds = place[inside].astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], (seeds[1:] != seeds[:-1]) | (np.diff(inside) != 1))))
        self.first = inside[new]
        self.count = np.diff(np.concatenate((new, [len(inside)])))
        self.place = seeds[new] - self.first
        self.doc = self.owner[self.first]
        ids = np.array([0 if i is None else i for i in self.ids], np.int64)
        self.doc_id = ids[self.doc]
        self.seed = grams[seeds[new]]
        whole = self.rolling.of(self.first, self.first + self.count + length - 1)
        self.content = mixed(whole + self.place.astype(np.uint64))

    def settled(self) -> tuple[np.ndarray, np.ndarray]:
        """Runs to be removed for one of equal content in this block, and runs to be sent."""
        order, least, _ = by_content(self.seed, self.content, self.doc_id)
        later = self.doc_id[order] > least
        return order[later], np.sort(order[~later])

    def singles(self, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Stretches of `runs` to be removed for an equal one in this block, and those to be sent."""
        count = self.count[runs]
        out = np.empty(count.sum(), SINGLE)
        run = np.repeat(runs, count)
        stretch = np.arange(len(run)) - np.repeat(np.cumsum(count) - count, count)
        start = self.first[run] + stretch
        out["seed"], out["doc_id"], out["run"], out["stretch"] = self.seed[run], self.doc_id[run], run, stretch
        out["content"] = self.rolling.of(start, start + self.unit.length)
        order, least, _ = by_content(out["seed"], out["content"], out["doc_id"])
        later = out["doc_id"][order] > least
        return out[order[later]], out[order[~later]]

    def slices(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte ranges of unit ranges [first, last)."""
        if self.starts is None:
            return first, last
        return self.starts[first], self.ends[last - 1]

    def contents(self, runs: np.ndarray) -> list[bytes]:
        low, high = self.slices(self.first[runs], self.first[runs] + self.count[runs] + self.unit.length - 1)
        return [self.data[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]

    def covered(self, runs: np.ndarray, of: np.ndarray, stretch: np.ndarray) -> np.ndarray:
        """Units covered by all stretches of `runs` and by single stretches of the runs `of`."""
        change = np.zeros(len(self.owner) + 1, np.int64)
        length = self.unit.length
        np.add.at(change, self.first[runs], 1)
        np.add.at(change, self.first[runs] + self.count[runs] + length - 1, -1)
        np.add.at(change, self.first[of] + stretch, 1)
        np.add.at(change, self.first[of] + stretch + length, -1)
        return np.cumsum(change[:-1]) > 0


def by_content(seed: np.ndarray, content: np.ndarray, doc_id: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order by seed, content and doc_id; there, the least doc_id of the content, and where contents begin."""
    order = np.lexsort((doc_id, content, seed))
    s, c = seed[order], content[order]
    new = np.ones(len(order), bool)
    new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
    starts = np.flatnonzero(new)
    least = np.repeat(doc_id[order][starts], np.diff(np.concatenate((starts, [len(order)]))))
    return order, least, new


def stretches_of_equals(values: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of equal neighbours."""
    if not len(values):
        return []
    edges = [0, *(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)]
    return list(zip(edges[:-1], edges[1:], strict=True))


def _blocks(docs: DataFrame, unit: Unit, buckets: int) -> DataFrame:
    """The documents as rows of (block, documents of about BLOCK bytes, compressed)."""
    schema = "block long, body binary"

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        size = 0

        def body() -> pa.RecordBatch:
            sink = pa.BufferOutputStream()
            options = pa.ipc.IpcWriteOptions(compression="zstd")
            with pa.ipc.new_stream(sink, held[0].schema, options=options) as out:
                out.write_table(pa.Table.from_batches(held).combine_chunks())
            one = [pa.array([number], pa.int64()), pa.array([sink.getvalue().to_pybytes()], pa.binary())]
            return pa.RecordBatch.from_arrays(one, names=["block", "body"])

        for batch in batches:
            sizes = pc.binary_length(batch.column("text").cast(pa.binary())).fill_null(0)
            sums = np.cumsum(sizes.to_numpy())
            first = 0
            while first < batch.num_rows:
                done = sums[first - 1] if first else 0
                last = max(first + 1, int(np.searchsorted(sums, done + BLOCK - size)))
                held.append(batch.slice(first, last - first))
                size += int(sums[last - 1] - done) if last <= len(sums) else 0
                first = last
                if size >= BLOCK:
                    yield body()
                    number, held, size = number + 1, [], 0
        if held:
            yield body()

    name = f"blocks_{uuid.uuid4().hex}"
    rows = docs.withColumn("doc_id", F.col("doc_id").cast("long")).mapInArrow(blocks, schema)
    writer = rows.write.bucketBy(buckets, "block").format("parquet").option("compression", "uncompressed")
    writer.option("path", run_dir(docs.sparkSession, "blocks")).saveAsTable(name)
    table = docs.sparkSession.table(name)
    # What was read knows its files and buckets; nobody else needs the name.
    docs.sparkSession.sql(f"drop table {name}")
    return table


def opened(body: bytes) -> pa.Table:
    return pa.ipc.open_stream(body).read_all()


def _numbers(rows: pa.Table, name: str, kind: str | np.dtype) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in rows[name].to_pylist() if x), kind)


def _sent(blocks: DataFrame, unit: Unit, buckets: int) -> DataFrame:
    """Per block and bucket: seeds, contents, doc_ids and numbers of the runs."""
    names = ["bucket", "block", "seeds", "contents", "ids", "runs"]

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, body in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block = Block(opened(body.as_py()), unit)
                _, runs = block.settled()
                if not len(runs):
                    continue
                bucket = (block.seed[runs] % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(bucket, kind="stable")
                runs, bucket = runs[order], bucket[order]
                starts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
                parts = [
                    (int(bucket[i]), number, *(x.tobytes() for x in (block.seed[r], block.content[r], block.doc_id[r], r.astype(np.uint32))))
                    for i, r in zip(starts, np.split(runs, starts[1:]), strict=True)
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*parts, strict=True)], names=names)

    return blocks.mapInArrow(send, "bucket long, block long, seeds binary, contents binary, ids binary, runs binary")


def _settle(sent: DataFrame) -> DataFrame:
    """Per bucket and block: the runs to be removed, and those still open (crowded ones apart)."""

    def settle(rows: pa.Table) -> pa.Table:
        seed, content = _numbers(rows, "seeds", "u8"), _numbers(rows, "contents", "u8")
        doc_id, run = _numbers(rows, "ids", "i8"), _numbers(rows, "runs", "u4")
        sizes = [len(x) // 4 for x in rows["runs"].to_pylist()]
        block = np.repeat(rows["block"].to_numpy(), sizes)
        order, least, new = by_content(seed, content, doc_id)
        seed, doc_id, run, block = seed[order], doc_id[order], run[order], block[order]
        heads = np.concatenate(([True], seed[1:] != seed[:-1]))
        group = np.cumsum(heads) - 1
        starts = np.flatnonzero(heads)
        contents = np.add.reduceat(new.astype(np.int64), starts)
        differ = np.maximum.reduceat(least, starts) != np.minimum.reduceat(least, starts)
        removed = doc_id > least
        is_open = ~removed & (contents > 1)[group] & differ[group]
        crowded = (contents > CROWD)[group]
        kind = np.where(removed, 0, np.where(is_open, 1 + crowded, 3))
        keep = np.flatnonzero(kind < 3)
        keep = keep[np.lexsort((kind[keep], block[keep]))]
        b, what, run = block[keep], kind[keep], run[keep].astype(np.uint32)
        out = {"block": [], "removed": [], "open": [], "crowded": []}
        for low, high in stretches_of_equals(b):
            out["block"].append(int(b[low]))
            for value, name in enumerate(("removed", "open", "crowded")):
                out[name].append(run[low:high][what[low:high] == value].tobytes())
        return pa.table({"block": pa.array(out["block"], pa.int64()), **{n: pa.array(out[n], pa.binary()) for n in ("removed", "open", "crowded")}})

    return sent.groupBy("bucket").applyInArrow(settle, "block long, removed binary, open binary, crowded binary")


def _open_runs(blocks: DataFrame, settled: DataFrame, unit: Unit, shards: int) -> DataFrame:
    """The texts of open runs, dealt by seed, and the stretches of crowded seeds, dealt by content.

    Stretches are packed, a row per block and shard with `run` -1.
    """
    schema = "shard long, key long, doc_id long, block long, run long, place long, body binary"
    names = [part.split()[0] for part in schema.split(", ")]

    def ask(left: pa.Table, right: pa.Table) -> pa.Table:
        columns = dict.fromkeys(names[:-1], np.zeros(0, np.int64))
        body: list[bytes] = []
        runs, crowd = (_numbers(right, n, "u4").astype(np.int64) for n in ("open", "crowded"))
        if left.num_rows and len(runs) + len(crowd):
            block = Block(opened(left["body"][0].as_py()), unit)
            _, singles = block.singles(crowd)
            shard = (singles["content"] % np.uint64(shards)).astype(np.int64)
            order = np.argsort(shard, kind="stable")
            spans = stretches_of_equals(shard[order])
            none = np.zeros(len(spans), np.int64)
            key = block.seed[runs]
            columns = {
                "shard": np.concatenate([(key % np.uint64(shards)).astype(np.int64), shard[order[[a for a, _ in spans]]]]),
                "key": np.concatenate([key.view(np.int64), none]),
                "doc_id": np.concatenate([block.doc_id[runs], none]),
                "block": np.full(len(runs) + len(spans), left["block"][0].as_py()),
                "run": np.concatenate([runs, none - 1]),
                "place": np.concatenate([block.place[runs], none]),
            }
            body = block.contents(runs) + [singles[order[a:b]].tobytes() for a, b in spans]
        return pa.table({**{n: pa.array(c, pa.int64()) for n, c in columns.items()}, "body": pa.array(body, pa.binary())})

    return blocks.groupBy("block").cogroup(settled.groupBy("block")).applyInArrow(ask, schema)


#: Stretches found repeated in texts of smaller doc_ids: (row, stretch) pairs.
Index = Callable[[pa.Table, Unit], tuple[np.ndarray, np.ndarray]]


def _answers(asked: DataFrame, unit: Unit, index: Index) -> DataFrame:
    """Per shard and block: the single stretches to be removed."""

    def answer(rows: pa.Table) -> pa.Table:
        packed = rows.filter(pc.less(rows["run"], 0))
        rows = rows.filter(pc.greater_equal(rows["run"], 0))
        rows = rows.sort_by([("key", "ascending"), ("doc_id", "ascending")]).combine_chunks()
        row, stretch = index(rows, unit)
        singles = _numbers(packed, "body", SINGLE)
        sizes = [len(x) // SINGLE.itemsize for x in packed["body"].to_pylist()]
        order, least, _ = by_content(singles["seed"], singles["content"], singles["doc_id"])
        later = order[singles["doc_id"][order] > least]
        block = np.concatenate([rows["block"].to_numpy()[row], np.repeat(packed["block"].to_numpy(), sizes)[later]])
        run = np.concatenate([rows["run"].to_numpy()[row], singles["run"][later]])
        stretch = np.concatenate([stretch, singles["stretch"][later]])
        order = np.argsort(block, kind="stable")
        block, run, stretch = block[order], run[order].astype(np.uint32), stretch[order].astype(np.uint32)
        spans = stretches_of_equals(block)
        return pa.table({
            "block": pa.array([int(block[a]) for a, _ in spans], pa.int64()),
            "of": pa.array([run[a:b].tobytes() for a, b in spans], pa.binary()),
            "stretch": pa.array([stretch[a:b].tobytes() for a, b in spans], pa.binary()),
        })

    return asked.groupBy("shard").applyInArrow(answer, "block long, of binary, stretch binary")


def cut(docs: DataFrame, unit: Unit, index: Index) -> DataFrame:
    """`docs` (doc_id, text, ...) with `kept`, `n_units`, `n_removed`, `n_spans`.

    A unit is removed if a stretch that covers it also starts in a document with a smaller
    doc_id. `kept` holds the remaining bytes, words joined by one space.
    """
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(64, total // BUCKET)
    blocks = _blocks(docs, unit, min(BUCKETS, max(12, total // (16 * BLOCK))))
    settled = written(_settle(_sent(blocks, unit, parts)), "settled")
    # An index holds a shard's open runs in memory, some hundred bytes a unit: shards are smaller than buckets.
    asked = _open_runs(blocks, settled.select("block", "open", "crowded"), unit, parts * SHARDS_OF_BUCKET)
    answers = written(_answers(asked, unit, index), "answers")
    none = F.lit(None).cast("binary")
    events = settled.select("block", "removed", "crowded", none.alias("of"), none.alias("stretch")).union(
        answers.select("block", none, none, "of", "stretch")
    )
    own = ["kept", "n_units", "n_removed", "n_spans"]
    schema = docs.drop(*own).withColumn("doc_id", F.col("doc_id").cast("long")).schema
    for name, kind in zip(own, (BinaryType(), LongType(), LongType(), LongType()), strict=True):
        schema = schema.add(name, kind)

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        rows = opened(left["body"][0].as_py())
        block = Block(rows, unit)
        local, _ = block.settled()
        runs = np.concatenate((local, _numbers(right, "removed", "u4").astype(np.int64)))
        alike, _ = block.singles(_numbers(right, "crowded", "u4").astype(np.int64))
        of = np.concatenate((alike["run"], _numbers(right, "of", "u4"))).astype(np.int64)
        stretch = np.concatenate((alike["stretch"], _numbers(right, "stretch", "u4"))).astype(np.int64)
        gone = block.covered(runs, of, stretch)
        kept, removed, spans = [], [], []
        for low, high in zip(block.docs[:-1].tolist(), block.docs[1:].tolist(), strict=True):
            own_gone = gone[low:high]
            edges = np.flatnonzero(np.diff(np.concatenate(([1], own_gone, [1])).astype(np.int8)))
            removed.append(int(own_gone.sum()))
            spans.append(int(own_gone[:1].sum() + (own_gone[1:] & ~own_gone[:-1]).sum()))
            a, b = block.slices(low + edges[::2], low + edges[1::2])
            texts = [block.data[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)]
            kept.append(b"".join(texts) if unit.kind == "bytes" else b" ".join(b" ".join(t.split()) for t in texts))
        rows = rows.drop_columns([c for c in rows.column_names if c in own])
        for name, values, kind in (
            ("kept", kept, pa.binary()),
            ("n_units", block.counts, pa.int64()),
            ("n_removed", removed, pa.int64()),
            ("n_spans", spans, pa.int64()),
        ):
            rows = rows.append_column(name, pa.array(values, kind))
        return rows

    return blocks.groupBy("block").cogroup(events.groupBy("block")).applyInArrow(finish, schema)
