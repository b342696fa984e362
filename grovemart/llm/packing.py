"""Packing token sequences by minimum bin slack.

Documents are tokenised once where they lie; whole windows are cut off, and what remains of
each document is packed, never cut. A group of pieces packs its windows for itself: the
longest piece left opens a window, and a bitset of reachable sums picks the multiset of
remaining lengths that fills it closest to capacity. The same multiset is used
as often as the counts allow, so the work is per distinct pattern and not per window.

Only rows of a few numbers are shuffled, never ids or texts. Groups are of bounded size
and chosen by a hash of the piece, so no key can make one large.

Defined cases: null text is empty text (one piece with the end id only); repeated rows are
packed each; an empty table gives an empty one; extra columns are not read.
"""

from __future__ import annotations

import base64
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from grovemart.llm.common import once, written

#: Pieces that are packed together; a group leaves a few windows with padding.
GROUP_PIECES = 16_384

PIECE_SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def _encoders(ranks_path: str, tokenizer_path: str, pattern: str):
    """The vocabulary twice: the fast library, and the one whose ids are asked for."""
    import tiktoken
    from tokenizers import Tokenizer

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    fast = tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    exact = Tokenizer.from_file(tokenizer_path)
    special = [t.content for t in exact.get_added_tokens_decoder().values()]
    return fast, exact, special


def token_ids(text: str, vocabulary: tuple[str, str, str]) -> list[int]:
    """Ids of a text as `tokenizers` gives them without special tokens added.

    The same vocabulary in the faster library gives the same ids; a text that holds the
    name of a special token, or that the faster one refuses, takes the slower way.
    """
    fast, exact, special = once(("encoders", vocabulary), lambda: _encoders(*vocabulary))
    if not any(name in text for name in special):
        try:
            return fast.encode_ordinary(text)
        except BaseException as error:  # the library's own panic is no Exception
            if isinstance(error, KeyboardInterrupt | SystemExit):
                raise
    return exact.encode(text, add_special_tokens=False).ids


def pieces(docs: DataFrame, vocabulary: tuple[str, str, str], window: int, end_id: int) -> DataFrame:
    """Documents cut into whole windows and a rest: doc_id, start, length, ids_crc32, doc_tokens."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.array([*token_ids(text.as_py() or "", vocabulary), end_id], "<u4")
                for start in range(0, len(ids), window):
                    part = ids[start : start + window]
                    rows.append((doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids)))
            columns = list(zip(*rows, strict=True)) or [()] * 5
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECE_SCHEMA)


def fill(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Lengths and how many of each, within `counts`, whose sum is the largest up to `capacity`."""
    reachable, steps = 1, []
    within = (1 << (capacity + 1)) - 1
    for length in sorted(counts, reverse=True):
        if length > capacity:
            continue
        steps.append((length, reachable))
        left, block = min(counts[length], capacity // length), 1
        while left > 0:
            used = min(block, left)
            reachable |= (reachable << (length * used)) & within
            left -= used
            block *= 2
        if reachable >> capacity:
            break
    total, chosen = reachable.bit_length() - 1, {}
    for length, earlier in reversed(steps):
        used = 0
        while not earlier >> total & 1:
            total -= length
            used += 1
        if used:
            chosen[length] = used
    return chosen


def windows(lengths: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each of the pieces."""
    order = np.argsort(lengths, kind="stable")
    values, starts, numbers = np.unique(lengths[order], return_index=True, return_counts=True)
    waiting = {int(v): int(n) for v, n in zip(values, numbers, strict=True)}
    next_of = {int(v): int(s) for v, s in zip(values, starts, strict=True)}
    at, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    opened = 0
    while waiting:
        longest = max(waiting)
        others = {v: n - (v == longest) for v, n in waiting.items() if n > (v == longest)}
        pattern = fill(others, window - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(waiting[v] // n for v, n in pattern.items())
        place = 0
        for value, n in sorted(pattern.items(), reverse=True):
            for _ in range(n):
                taken = order[next_of[value] : next_of[value] + times]
                at[taken] = opened + np.arange(times)
                offset[taken] = place
                next_of[value] += times
                place += value
            waiting[value] -= n * times
            if not waiting[value]:
                del waiting[value]
        opened += times
    return at, offset


def pack(
    docs: DataFrame,
    vocabulary: tuple[str, str, str],
    window: int = 2048,
    end_id: int = 1,
    group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """Every piece of every document with its place: sequence_id and offset.

    `vocabulary` is (ranks file, tokenizer file, split pattern). Returns doc_id, start, length,
    ids_crc32, doc_tokens, sequence_id, offset.
    """
    cut = written(pieces(docs, vocabulary, window, end_id), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    keyed = cut.withColumn("_group", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(groups)))

    def place(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([(name, "ascending") for name in ("doc_id", "start", "ids_crc32")])
        at, offset = windows(rows["length"].to_numpy(), window)
        first = key[0].as_py() << 32
        out = rows.drop_columns("_group").append_column("sequence_id", pa.array(first + at))
        return out.append_column("offset", pa.array(offset))

    return keyed.groupBy("_group").applyInArrow(place, PIECE_SCHEMA + ", sequence_id long, offset long")
