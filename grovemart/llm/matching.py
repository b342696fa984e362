"""Best-fit packing: large documents matched in pairs, small ones into the gaps that fit best.

Documents are tokenised once where they lie. A document longer than a sequence is cut into whole
sequences behind a shorter first piece; nothing else is cut. Pieces above a third of a sequence are large: at most two
share one. From the longest down, each is matched with the longest one left that still fits
(greedy matching, which leaves the fewest sequences for large pieces alone). Then small pieces,
longest first, go to the smallest gap that holds them, and open a sequence only where none does.

All pieces of one length are alike, so this is done on counts: the plan for the whole corpus
comes from one number per length (at most `window` numbers, whatever the data) and says which
ranks of a length go to which sequences. A plan has some 30,000 segments at most: matching makes two
classes of equal gaps a length, a small length splits two more at most, and a class that takes
pieces of length n keeps a gap below n, so it takes again only some ten times. Nothing is lost at the edges of groups, for there are none.

A piece's rank within its length is its place among the rows of its task, written with it, plus
the counts of the tasks before: only rows of a few numbers are shuffled, and equal rows have different
ranks.

Defined cases: null text is empty text (one piece with the end id only); a null doc_id is carried;
repeated rows are packed each; an empty table gives an empty one; very long texts are cut like
others; extra columns are not read. Ties between equal lengths go by rank.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovemart.llm.common import written
from grovemart.llm.packing import token_ids

PIECE_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32"]
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"

#: Ranks of a length that lie in neighbouring sequences: length, first rank, first sequence, pieces in each, offset.
Segment = tuple[int, int, int, int, int]


def pieces(docs: DataFrame, vocabulary: tuple[str, str, str], window: int, end_id: int) -> DataFrame:
    """Documents cut into pieces, each with its task (`part`) and its place among the task's pieces of that length (`nth`)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), [0] * (window + 1)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*token_ids(text.as_py() or "", vocabulary), end_id], "<u4")
                first = len(ids) % window or window
                for piece, start in enumerate([0, *range(first, len(ids), window)]):
                    held = ids[start : start + window] if piece else ids[:first]
                    rows.append((doc_id, piece, start, len(held), zlib.crc32(held.tobytes()), part, seen[len(held)]))
                    seen[len(held)] += 1
            kinds = [pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()]
            columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
            arrays = [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*PIECE_NAMES, "part", "nth"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE_SCHEMA + ", part int, nth long")


class Sequences:
    """Sequences being filled, in classes of equal gaps, and the segments handed out."""

    def __init__(self, window: int) -> None:
        self.window, self.opened = window, 0
        self.handed: dict[int, int] = defaultdict(int)
        self.gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.segments: list[Segment] = []

    def open(self, number: int) -> int:
        self.opened += number
        return self.opened - number

    def put(self, length: int, first: int, number: int, each: int, gap: int) -> int:
        """`each` pieces of a length into each of `number` sequences from `first` on; returns the gap left."""
        self.segments.append((length, self.handed[length], first, each, self.window - gap))
        self.handed[length] += number * each
        return gap - each * length

    def keep(self, first: int, number: int, gap: int) -> None:
        if number and gap:
            self.gaps[gap].append((first, number))

    def match(self, left: dict[int, int]) -> None:
        """Large pieces: the longest with the longest that fits beside it, or alone."""
        lengths = sorted(left)
        while lengths:
            a = lengths[-1]
            at = bisect_right(lengths, self.window - a) - 1
            if at >= 0 and lengths[at] == a and left[a] == 1:
                at -= 1
            b = lengths[at] if at >= 0 else None
            number = left[a] if b is None else left[a] // 2 if a == b else min(left[a], left[b])
            first = self.open(number)
            if a == b:
                gap = self.put(a, first, number, 2, self.window)
            else:
                gap = self.put(a, first, number, 1, self.window)
                if b is not None:
                    gap = self.put(b, first, number, 1, gap)
            self.keep(first, number, gap)
            for length in {a, b} - {None}:
                left[length] -= number * (2 if a == b else 1)
                if not left[length]:
                    lengths.remove(length)

    def fit(self, length: int, count: int) -> None:
        """Pieces of one length, each into the smallest gap that holds it."""
        for gap in range(length, self.window + 1):
            waiting, each = self.gaps.get(gap, []), gap // length
            while waiting and count:
                first, number = waiting.pop()
                full = min(number, count // each)
                if full:
                    self.keep(first, full, self.put(length, first, full, each, gap))
                    count -= full * each
                if full < number and count:
                    self.keep(first + full, 1, self.put(length, first + full, 1, count, gap))
                    full, count = full + 1, 0
                self.keep(first + full, number - full, gap)
        if count:
            number = -(-count // (self.window // length))
            self.keep(self.open(number), number, self.window)
            self.fit(length, count)


def plan(counts: dict[int, int], window: int) -> tuple[list[Segment], int]:
    """Segments for so many pieces of each length, and the number of sequences."""
    sequences = Sequences(window)
    sequences.match({n: c for n, c in counts.items() if 3 * n > window and c})
    for length in sorted((n for n, c in counts.items() if 3 * n <= window and c), reverse=True):
        sequences.fit(length, counts[length])
    return sorted(sequences.segments), sequences.opened


def pack(docs: DataFrame, vocabulary: tuple[str, str, str], window: int = 1024, end_id: int = 2) -> DataFrame:
    """Every piece of every document with its place: sequence_id and offset.

    `vocabulary` is (ranks file, tokenizer file, split pattern). Returns doc_id, piece, start, length,
    ids_crc32, sequence_id, offset.
    """
    cut = written(pieces(docs, vocabulary, window, end_id), "whole_pieces")
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    # A row for each task and length, at most: counted again from the pieces for the join, as a table of its own
    # would be a file a task for a few numbers.
    numbers = (
        cut.groupBy("part", "length")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    counts = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    segments = np.array(plan(counts, window)[0], np.int64).reshape(-1, 5)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Segments lie by length and first rank: the last one not beyond a piece holds it.
        edges = np.searchsorted(segments[:, 0], np.arange(window + 2))
        for batch in batches:
            length, rank = batch["length"].to_numpy(), batch["nth"].to_numpy() + batch["before"].to_numpy()
            low, high = edges[length], edges[length + 1]
            while len(low) and (high - low).max() > 1:
                middle = (low + high) // 2
                beyond = segments[np.minimum(middle, len(segments) - 1), 1] > rank
                narrow = high - low > 1
                high = np.where(narrow & beyond, middle, high)
                low = np.where(narrow & ~beyond, middle, low)
            _, first_rank, first, each, offset = segments[low].T
            at, nth = np.divmod(rank - first_rank, each)
            columns = [*(batch[name] for name in PIECE_NAMES), pa.array(first + at), pa.array(offset + nth * length)]
            yield pa.RecordBatch.from_arrays(columns, names=[*PIECE_NAMES, "sequence_id", "offset"])

    # The numbers grow with the tasks, so they are never broadcast.
    ranked = cut.join(numbers.hint("merge"), ["part", "length"])
    return ranked.select(*PIECE_NAMES, "nth", "before").mapInArrow(place, PIECE_SCHEMA + ", sequence_id long, offset long")
