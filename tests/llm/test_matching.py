"""Best-fit packing: every id in one piece, gapless sequences, few of them."""

import zlib
from collections import defaultdict
from pathlib import Path

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from grovemart.llm import matching
from grovemart.llm.queries import SHORT_END_ID, SHORT_WINDOW, vocabulary
from grovemart.session import runs_folder
from tests.llm import data


def one_by_one(counts, window):
    """Number of sequences when every piece is put by itself."""
    items = sorted((n for n, c in counts.items() for _ in range(c)), reverse=True)
    large, gaps = [n for n in items if 3 * n > window], []
    while large:
        a = large.pop(0)
        fits = [i for i, b in enumerate(large) if a + b <= window]
        gaps.append(window - a - (large.pop(fits[0]) if fits else 0))
    for n in items:
        if 3 * n <= window:
            fits = sorted((g, i) for i, g in enumerate(gaps) if g >= n)
            if fits:
                gaps[fits[0][1]] -= n
            else:
                gaps.append(window - n)
    return sorted(gaps)


def laid_out(segments, counts):
    """(sequence, offset, length) of every piece of a plan."""
    for k, (length, rank, first, each, offset) in enumerate(segments):
        following = segments[k + 1] if k + 1 < len(segments) and segments[k + 1][0] == length else None
        end = following[1] if following else counts[length]
        for r in range(rank, end):
            at, nth = divmod(r - rank, each)
            yield first + at, offset + nth * length, length


@given(st.dictionaries(st.integers(1, 40), st.integers(1, 9), max_size=12), st.just(40))
@settings(max_examples=300, deadline=None)
def test_plan_is_that_of_single_pieces(counts, window):
    segments, opened = matching.plan(dict(counts), window)
    cells, placed = defaultdict(set), defaultdict(int)
    for at, offset, length in laid_out(segments, counts):
        held = set(range(offset, offset + length))
        assert not held & cells[at] and max(held) < window
        cells[at] |= held
        placed[length] += 1
    assert dict(placed) == counts and len(cells) == opened
    assert all(held == set(range(len(held))) for held in cells.values())
    assert sorted(window - len(held) for held in cells.values()) == one_by_one(counts, window)


def test_large_pieces_are_matched_best():
    """As few sequences as any matching allows, here by trying all."""
    import random

    def most_pairs(items, window):
        if len(items) < 2:
            return 0
        a, rest = items[0], items[1:]
        best = most_pairs(rest, window)
        for i, b in enumerate(rest):
            if a + b <= window:
                best = max(best, 1 + most_pairs(rest[:i] + rest[i + 1 :], window))
        return best

    draw = random.Random(5)
    for _ in range(60):
        items = [draw.randint(15, 40) for _ in range(8)]
        counts = {n: items.count(n) for n in items}
        assert matching.plan(counts, 42)[1] == len(items) - most_pairs(items, 42)


def test_plan_does_not_grow_with_the_counts():
    small = {n: 3 + n * 7919 % 97 for n in range(1, 1025)}
    few, many = matching.plan(small, 1024)[0], matching.plan({n: c * 1_000_003 for n, c in small.items()}, 1024)[0]
    assert len(many) < 30_000 and len(few) < 30_000


def check(rows, texts, tokenizer):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append(r)
    for doc_id, text in texts:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, SHORT_END_ID], "<u4")
        at = 0
        for k, r in enumerate(sorted(pieces[doc_id], key=lambda r: r["piece"])):
            part = ids[at : at + r["length"]]
            assert (r["piece"], r["start"], r["ids_crc32"]) == (k, at, zlib.crc32(part.tobytes()))
            assert r["length"] == SHORT_WINDOW or k == 0
            at += r["length"]
        assert at == len(ids) and len(pieces[doc_id]) == -(-len(ids) // SHORT_WINDOW)
    for held in sequences.values():
        at = 0
        for r in sorted(held, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= SHORT_WINDOW
    return len(sequences)


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(vocabulary()[1])


def packed(docs):
    return matching.pack(docs, vocabulary(), SHORT_WINDOW, SHORT_END_ID)


def test_odd_rows(spark, tokenizer):
    rows = [(i, t, s) for i, (_, t, s) in enumerate(data.ODD)]
    out = packed(data.documents(spark, rows).repartition(5))
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    check(out.collect(), [(d, t) for d, t, _ in rows], tokenizer)


def test_repeated_rows_null_ids_and_no_rows(spark):
    docs = data.documents(spark)
    rows = packed(docs).collect()
    twice = [r for r in rows if r["doc_id"] == 18]
    assert len(twice) == 2 and len({(r["sequence_id"], r["offset"]) for r in twice}) == 2
    assert len([r for r in rows if r["doc_id"] is None]) == 2
    assert packed(docs.limit(0)).count() == 0


def test_equal_rows_are_no_group(spark):
    """Ten thousand equal rows are as few sequences as they can be, whatever tasks they come from."""
    docs = spark.range(10_000).selectExpr("1L as doc_id", "'one two three' as text").repartition(7)
    rows = packed(docs).groupBy("sequence_id").count().collect()
    each = SHORT_WINDOW // 4
    assert sorted(r["count"] for r in rows)[1:] == [each] * (10_000 // each)


def test_only_pieces_are_written(spark):
    """A file for each task that cuts, and none for the numbers: on a local disk each file starts three processes."""

    def files():
        return set(Path(runs_folder(spark)).glob("**/part-*.parquet"))

    docs, there = data.documents(spark).repartition(3), files()
    assert packed(docs).count() > len(data.ODD)
    assert {p.parent.name.rpartition("-")[0] for p in files() - there} == {"whole_pieces"}
    assert len(files() - there) <= 3


def test_few_sequences(spark, tokenizer):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = packed(docs.repartition(6)).collect()
    used = check(rows, [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()], tokenizer)
    counts = defaultdict(int)
    for r in rows:
        counts[r["length"]] += 1
    assert used == len(one_by_one(counts, SHORT_WINDOW))
    assert used <= 1.01 * sum(r["length"] for r in rows) / SHORT_WINDOW
