"""Aligning the tokens of two tokenizers by divide and conquer at shared cuts.

Both tokenizers cover the same bytes, so a byte offset where tokens of both end is a cut. A
document is one interval at first. In every interval a common end near the middle is looked
for: the ends of A around the middle are bisected among the ends of B, one at first, then ever wider stretches, and the
common one nearest to the middle is taken. It splits the interval, and both halves are treated alike; an
interval without a common end inside is a leaf, a group. All intervals of a level, of many
documents, are taken at once, so a level is a few array operations and there is no recursion to
run out of.

A link is a token of A and one of B whose bytes overlap. In a group each end but the last belongs
to one side only, so every distinct end closes exactly one link.

How many documents hold a pair of linked ids is counted by Spark over the distinct pairs of each
document. Looking the counts up again does not send common pairs anywhere, whose rows would pile
up on one key: those in many documents, `COMMON` at most, go to every task as arrays of at most 17 bytes a pair;
the others, each in few documents, are joined.

Texts are tokenised in slices that end before a blank between two letters, where tokens of both end
whatever surrounds it, of about `SLICE` code points; a stretch without such a blank is one
slice. Only the distinct pairs are kept for a whole document, so a task needs some 200 bytes a
code point of its longest slice, not of its longest text.

Defined cases: null and empty texts, and texts whose tokens do not spell blank + text, have zeros and no hash;
null and repeated doc_ids are rows like others (each row is a document); an empty table gives
an empty one; extra columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovemart.llm.common import once, written

#: Code points of a slice, and of the slices that are aligned together: few enough for their arrays to stay in the cache.
SLICE = 1 << 18
TOGETHER = 1 << 17
#: Pairs whose counts go to every task.
COMMON = 1 << 18

COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
ROW = "row long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string"
PAIRS = "a array<int>, b array<int>, times array<int>"

_BLANK = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


class Vocabularies:
    """Both tokenizers, with the bytes of every id and its text in a list of groups."""

    def __init__(self, ranks: tuple[str, str, str], model: str) -> None:
        import base64

        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        ranks_path, tokenizer_path, pattern = ranks
        with open(ranks_path, "rb") as lines:
            known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        self.fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=known, special_tokens={})
        self.exact = Tokenizer.from_file(tokenizer_path)
        self.exact.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=model)
        self.size_a = self.exact.get_vocab_size()
        spelled = {rank: token for token, rank in known.items()}
        self.bytes_a = np.empty(self.size_a, object)
        self.bytes_a[:] = [spelled.get(i, b"") for i in range(self.size_a)]
        self.bytes_b = [self._piece(i) for i in range(self.b.get_piece_size())]
        self.length_a = np.array(list(map(len, self.bytes_a)))
        self.length_b = np.array(list(map(len, self.bytes_b)))
        # Of every id: its text before a comma, then before the mark that ends its side of a group.
        words = [f"{i}{mark}" for i in range(self.size_a) for mark in ",|"]
        words += [f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in ",;"]
        self.words = np.array(words, object)

    def _piece(self, i: int) -> bytes:
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def ids_a(self, text: str) -> np.ndarray:
        try:
            return np.array(self.fast.encode_ordinary(text), np.int64)
        except BaseException as error:  # the library's own panic is no Exception
            if isinstance(error, KeyboardInterrupt | SystemExit):
                raise
            return np.array(self.exact.encode(text, add_special_tokens=False).ids, np.int64)

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of blank + text by A and of text by B, which adds the blank; None if either spells other bytes."""
        a, b = self.ids_a(" " + text), self.b.encode(text, num_threads=1)
        whole = b" " + text.encode()
        if b"".join(self.bytes_a[a].tolist()) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return None
        return a, np.array(b, np.int64)


def slices(text: str, size: int = SLICE) -> Iterator[str]:
    """The text without the blanks at its cuts, each between two letters, the first behind `size` code points."""
    start = 0
    while start < len(text):
        found = _BLANK.search(text, start + size)
        end = found.start() if found else len(text)
        yield text[start:end]
        start = end + 1


def _nearest(a: np.ndarray, b: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Of every interval, the place in a[low:high] of the value nearest to the middle that b has, too; or -1."""
    found, middle = np.full(len(low), -1), (low + high) // 2
    open_, reach = np.flatnonzero(low < high), 0
    while len(open_):
        first = np.maximum(low[open_], middle[open_] - reach)
        number = np.minimum(high[open_], middle[open_] + reach + 1) - first
        heads = np.cumsum(number) - number
        probe = np.arange(heads[-1] + number[-1]) + np.repeat(first - heads, number)
        at = np.searchsorted(b, a[probe])
        common = b[np.minimum(at, len(b) - 1)] == a[probe]
        away = np.abs(probe - np.repeat(middle[open_], number))
        order = np.where(common, 2 * away + (probe > np.repeat(middle[open_], number)), np.iinfo(np.int64).max)
        best = np.minimum.reduceat(order, heads)
        hit = best < np.iinfo(np.int64).max
        side = np.where(best[hit] & 1, 1, -1)
        found[open_[hit]] = middle[open_[hit]] + side * (best[hit] >> 1)
        # Looked at from end to end: a leaf.
        open_ = open_[~hit & ((first > low[open_]) | (first + number < high[open_]))]
        reach = 4 * reach + 1
    return found


def cuts(a: np.ndarray, b: np.ndarray, docs: np.ndarray) -> np.ndarray:
    """Places in `a` of all ends it shares with `b`. Both ascend; `docs` are the places of the documents' last
    ends, which are shared."""
    out = [docs]
    low = np.concatenate(([0], docs[:-1] + 1)) if len(docs) else docs
    high = docs
    while len(low):
        at = _nearest(a, b, low, high)
        split = at >= 0
        out.append(at[split])
        low, high = np.concatenate((low[split], at[split] + 1)), np.concatenate((at[split], high[split]))
        inner = low < high
        low, high = low[inner], high[inner]
    return np.sort(np.concatenate(out))


@dataclass
class Document:
    """What is known of a document's slices so far."""

    counts: np.ndarray = field(default_factory=lambda: np.zeros(4, np.int64))
    groups: object = field(default_factory=hashlib.sha256)
    pairs: list = field(default_factory=list)

    def row(self) -> tuple:
        if not self.counts[0]:
            return (*self.counts.tolist(), "", np.zeros(0, np.int64), np.zeros(0, np.int64))
        keys = np.concatenate([k for k, _ in self.pairs])
        times = np.concatenate([t for _, t in self.pairs])
        keys, where = np.unique(keys, return_inverse=True)
        return (*self.counts.tolist(), self.groups.hexdigest(), keys, np.bincount(where, times).astype(np.int64))


def take_in(vocabularies: Vocabularies, encoded: list[tuple[Document, np.ndarray, np.ndarray]]) -> None:
    """Align slices, one after another in one row of bytes, and add what they hold to their documents."""
    v = vocabularies
    ids_a, ids_b = np.concatenate([a for _, a, _ in encoded]), np.concatenate([b for _, _, b in encoded])
    ends_a, ends_b = np.cumsum(v.length_a[ids_a]), np.cumsum(v.length_b[ids_b])
    docs_a = np.cumsum([len(a) for _, a, _ in encoded])
    docs_b = np.cumsum([len(b) for _, _, b in encoded])
    cut_a = cuts(ends_a, ends_b, docs_a - 1)
    cut_b = np.searchsorted(ends_b, ends_a[cut_a])
    ends_group_a, ends_group_b = np.zeros(len(ids_a), bool), np.zeros(len(ids_b), bool)
    ends_group_a[cut_a], ends_group_b[cut_b] = True, True

    # Texts of the tokens, A before B in every group.
    group_a, group_b = np.cumsum(ends_group_a) - ends_group_a, np.cumsum(ends_group_b) - ends_group_b
    words = np.empty(len(ids_a) + len(ids_b), object)
    words[np.arange(len(ids_a)) + np.concatenate(([0], cut_b + 1))[group_a]] = v.words[2 * ids_a + ends_group_a]
    words[np.arange(len(ids_b)) + (cut_a + 1)[group_b]] = v.words[2 * (v.size_a + ids_b) + ends_group_b]

    # Every end once; the tokens that hold the byte before it are linked.
    order = np.argsort(np.concatenate((ends_a, ends_b[~ends_group_b])), kind="stable")
    of_a = order < len(ends_a)
    of_b = ~of_a
    of_b[of_a] = ends_group_a
    link_a, link_b = np.cumsum(of_a) - of_a, np.cumsum(of_b) - of_b
    which = np.searchsorted(docs_a, link_a, side="right")
    keys = ids_a[link_a] * len(v.length_b) + ids_b[link_b]
    packed, times = np.unique(which * (v.size_a * len(v.length_b)) + keys, return_counts=True)
    slice_of, keys = np.divmod(packed, v.size_a * len(v.length_b))
    number = len(encoded)
    links, groups = np.bincount(which, minlength=number), np.diff(np.searchsorted(cut_a, docs_a), prepend=0)
    pairs = np.searchsorted(slice_of, np.arange(number + 1))
    at = 0
    for i, (document, a, b) in enumerate(encoded):
        text = "".join(words[at : at + len(a) + len(b)].tolist())
        at += len(a) + len(b)
        document.groups.update((";" if document.counts[0] else "").encode() + text[:-1].encode())
        document.counts += (len(a), len(b), groups[i], links[i])
        document.pairs.append((keys[pairs[i] : pairs[i + 1]], times[pairs[i] : pairs[i + 1]]))


def aligned(docs: DataFrame, ranks: tuple[str, str, str], model: str, slice_size: int = SLICE) -> DataFrame:
    """Every document with its counts, the hash of its groups, and its distinct linked pairs of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabularies = once(("aligned", ranks, model), partial(Vocabularies, ranks, model))
        row = TaskContext.get().partitionId() << 33
        held: list[tuple[int | None, Document]] = []
        waiting: list[tuple[Document, np.ndarray, np.ndarray]] = []

        def settled() -> pa.RecordBatch:
            nonlocal row, held, waiting
            if waiting:
                take_in(vocabularies, waiting)
            rows = [d.row() for _, d in held]
            names = ["row", "doc_id", *COUNTS, "groups_sha256", "a", "b", "times"]
            columns = [pa.array(range(row, row + len(held)), pa.int64()), pa.array([i for i, _ in held], pa.int64())]
            columns += [pa.array([r[k] for r in rows], pa.int64()) for k in range(4)]
            columns.append(pa.array([r[4] for r in rows], pa.string()))
            keys = np.concatenate([r[5] for r in rows])
            times = np.concatenate([r[6] for r in rows])
            ends = pa.array(np.cumsum([0, *(len(r[5]) for r in rows)]), pa.int32())
            for values in (*np.divmod(keys, len(vocabularies.length_b)), times):
                columns.append(pa.ListArray.from_arrays(ends, pa.array(values.astype(np.int32))))
            row, held, waiting = row + len(held), [], []
            return pa.RecordBatch.from_arrays(columns, names=names)

        size = 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                document, whole = Document(), True
                mine: list[tuple[Document, np.ndarray, np.ndarray]] = []
                for part in slices(text.as_py() or "", slice_size):
                    encoded = vocabularies.encoded(part)
                    if encoded is None:
                        document, whole, mine = Document(), False, []
                        break
                    mine.append((document, *encoded))
                    size += len(part)
                    if size > TOGETHER:
                        take_in(vocabularies, [*waiting, *mine])
                        waiting, mine, size = [], [], 0
                held.append((doc_id, document))
                if whole:
                    waiting += mine
                if len(held) >= 1024 or sum(len(k) for k, _ in document.pairs) > SLICE:
                    yield settled()
                    size = 0
        if held:
            yield settled()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, f"{ROW}, {PAIRS}")


def _common(ranked: DataFrame, most: int) -> int:
    """The least power of two such that at most `most` pairs are in so many documents; 1 if all may."""
    sizes = ranked.groupBy(F.floor(F.log2("count")).cast("int").alias("size")).agg(F.count(F.lit(1)).alias("n")).collect()
    total, least = 0, 62
    for r in sorted(sizes, reverse=True):
        total += r["n"]
        if total > most:
            return 1 << least
        least = r["size"]
    return 1


def align(
    docs: DataFrame,
    ranks: tuple[str, str, str],
    model: str,
    common: int = COMMON,
    slice_size: int = SLICE,
) -> DataFrame:
    """Every document with the sizes of its alignment and how common its links are.

    `ranks` is (ranks file, tokenizer file, split pattern) of A, `model` the file of B. Returns doc_id, n_a, n_b,
    n_groups, n_links, n_best, count_sum, groups_sha256.
    """
    spark = docs.sparkSession
    rows = written(aligned(docs, ranks, model, slice_size), "aligned")
    pair = rows.select(F.explode(F.arrays_zip("a", "b")).alias("pair")).select("pair.a", "pair.b")
    counts = written(pair.groupBy("a", "b").agg(F.count(F.lit(1)).alias("count")), "pairs")
    best = counts.groupBy("a").agg(F.max("count").alias("most"))
    ranked = counts.join(best, "a").select("a", "b", "count", (F.col("count") == F.col("most")).alias("best"))
    least = _common(counts, common)
    known = ranked.where(F.col("count") >= least).toArrow()
    key = known["a"].to_numpy().astype(np.int64) << 32 | known["b"].to_numpy()
    order = np.argsort(key)
    # At most `common` pairs of 17 bytes.
    arrays = (key[order], known["count"].to_numpy()[order], known["best"].to_numpy()[order])
    shared = spark.sparkContext.broadcast(arrays)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, count, is_best = shared.value
        for batch in batches:
            lists = [batch[name] for name in ("a", "b", "times")]
            a, b, times = (part.flatten().to_numpy().astype(np.int64) for part in lists)
            owner = np.repeat(np.arange(len(batch)), pc.list_value_length(lists[0]).to_numpy())
            wanted = a << 32 | b
            at = np.minimum(np.searchsorted(keys, wanted), max(len(keys) - 1, 0))
            found = keys[at] == wanted if len(keys) else np.zeros(len(wanted), bool)
            at = at[found]
            n_best, count_sum = np.zeros(len(batch), np.int64), np.zeros(len(batch), np.int64)
            np.add.at(n_best, owner[found], times[found] * is_best[at])
            np.add.at(count_sum, owner[found], times[found] * count[at])
            ends = pa.array(np.searchsorted(owner[~found], np.arange(len(batch) + 1)), pa.int32())
            rest = [pa.ListArray.from_arrays(ends, pa.array(x[~found].astype(np.int32))) for x in (a, b, times)]
            names = [n for n in batch.schema.names if n not in ("a", "b", "times")]
            columns = [*(batch[n] for n in names), pa.array(n_best), pa.array(count_sum), *rest]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "n_best", "count_sum", "a", "b", "times"])

    out = ["doc_id", *COUNTS, "n_best", "count_sum", "groups_sha256"]
    found = rows.mapInArrow(look_up, f"{ROW}, n_best long, count_sum long, {PAIRS}")
    if least == 1:
        return found.select(*out)
    found = written(found, "looked_up")
    rare = found.select("row", F.explode(F.arrays_zip("a", "b", "times")).alias("pair")).select("row", "pair.*")
    met = rare.join(ranked.where(F.col("count") < least), ["a", "b"]).groupBy("row").agg(
        F.sum(F.col("times") * F.col("best").cast("int")).alias("more_best"),
        F.sum(F.col("times") * F.col("count")).alias("more_count"),
    )
    both = found.drop("a", "b", "times").join(met, "row", "left")
    more = {"n_best": "more_best", "count_sum": "more_count"}
    return both.withColumns({n: F.col(n) + F.coalesce(F.col(m), F.lit(0)) for n, m in more.items()}).select(*out)
