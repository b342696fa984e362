"""Alignment of tokens against a plain version by bytes."""

import hashlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from grovemart.llm import alignment
from grovemart.llm.queries import piece_model, vocabulary
from tests.llm import data


class Plain:
    """Tokens with their bytes, and everything the operator returns, found byte by byte."""

    def __init__(self):
        self.a = Tokenizer.from_file(vocabulary()[1])
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_model())
        # The byte-level alphabet: printable bytes stand for themselves, others for code points from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [i for i in range(256) if i not in plain]
        self.byte = {chr(i): i for i in plain} | {chr(256 + k): i for k, i in enumerate(others)}

    def spell_a(self, i):
        return bytes(self.byte[c] for c in self.a.id_to_token(i))

    def spell_b(self, i):
        piece = self.b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(self, text):
        if not text:
            return [], []
        a, b = self.a.encode(" " + text, add_special_tokens=False).ids, self.b.encode(text)
        whole = (" " + text).encode()
        fits = b"".join(map(self.spell_a, a)) == whole == b"".join(map(self.spell_b, b))
        return (a, b) if fits else ([], [])

    def one(self, text):
        a, b = self.tokens(text)
        if not a:
            return 0, 0, 0, Counter(), ""
        at_a = [i for i in range(len(a)) for _ in self.spell_a(a[i])]
        at_b = [i for i in range(len(b)) for _ in self.spell_b(b[i])]
        links = Counter((a[i], b[j]) for i, j in set(zip(at_a, at_b, strict=True)))
        groups, ga, gb = [], [], []
        for k in range(len(at_a)):
            end_a = k + 1 == len(at_a) or at_a[k + 1] != at_a[k]
            end_b = k + 1 == len(at_b) or at_b[k + 1] != at_b[k]
            ga += [a[at_a[k]]] * end_a
            gb += [b[at_b[k]]] * end_b
            if end_a and end_b:
                groups.append(",".join(map(str, ga)) + "|" + ",".join(map(str, gb)))
                ga, gb = [], []
        return len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()

    def all(self, rows):
        found = [(d, *self.one(t)) for d, t in rows]
        count = Counter(pair for *_, links, _ in found for pair in links)
        most = defaultdict(int)
        for (a, _), n in count.items():
            most[a] = max(most[a], n)
        out = []
        for d, n_a, n_b, n_groups, links, sha in found:
            best = sum(n for pair, n in links.items() if count[pair] == most[pair[0]])
            out.append((d, n_a, n_b, n_groups, links.total(), best, sum(n * count[p] for p, n in links.items()), sha))
        return sorted(out, key=repr)


@pytest.fixture(scope="module")
def plain():
    return Plain()


ODD_TEXTS = [
    "a<|endoftext|>b </s><s> <unk> <0x41>", "  two  blanks ", "tabs\t\tand\r\nlines\n\n", "x▁y", "▁", "\x00\x00 zero",
    "日本語のテキスト 한국어 русский текст", "é ﬁ 　\xa0 ", "🧑‍🚀🧑🏽‍🚀" * 3, " ", "I'll we've it's", "12345 678,90",
    "naïve café ÀÉÎ", "a b c d e f g", "ab" * 400,
]


def aligned(spark, rows, **how):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, n_a string").repartition(3)
    out = alignment.align(docs, vocabulary(), piece_model(), **how)
    assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return data.sorted_rows(out)


@pytest.fixture(scope="module")
def odd():
    return [(d, t) for d, t, _ in data.ODD] + [(100 + k, t) for k, t in enumerate(ODD_TEXTS)]


@pytest.mark.parametrize("how", [{}, {"common": 0}, {"common": 40}, {"slice_size": 1}, {"slice_size": 200, "common": 500}])
def test_odd_rows(spark, plain, odd, how):
    assert aligned(spark, odd, **how) == plain.all(odd)


def test_no_rows(spark):
    assert aligned(spark, []) == [] and aligned(spark, [(1, None)]) == [(1, 0, 0, 0, 0, 0, 0, "")]


def test_all_documents(spark, plain):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    expected = plain.all(rows)
    assert aligned(spark, rows) == expected == aligned(spark, rows, common=300, slice_size=1000)


def test_a_bad_slice_takes_its_whole_document(spark, plain):
    rows = [(1, "plain words " * 50 + "▁ " + "plain words " * 50), (2, "plain words " * 50)]
    out = aligned(spark, rows, slice_size=20)
    assert out == plain.all(rows) and out[0] == (1, 0, 0, 0, 0, 0, 0, "")


ends = st.lists(st.integers(1, 120), min_size=1, max_size=60, unique=True).map(sorted)


@given(ends, ends, st.lists(st.integers(121, 125), min_size=1, max_size=1))
@settings(max_examples=300, deadline=None)
def test_cuts_are_all_shared_ends(a, b, last):
    a, b = np.array([*a, *last]), np.array([*b, *last])
    assert a[alignment.cuts(a, b, np.array([len(a) - 1]))].tolist() == sorted(set(a) & set(b))


def test_cuts_of_many_documents_and_of_a_long_one_without_any():
    a = np.concatenate([np.arange(2, 400_002, 2), np.arange(400_003, 400_403, 2)])
    b = np.concatenate([np.arange(1, 400_001, 2)[1:], [400_000], np.arange(400_003, 400_403, 2)])
    docs = np.array([199_999, 200_199])
    assert np.array_equal(a[alignment.cuts(a, b, docs)], np.intersect1d(a, b))


@given(st.text(alphabet=st.sampled_from("ab Z\n.é'1"), max_size=80), st.integers(1, 20))
@settings(max_examples=200, deadline=None)
def test_slices_are_tokenised_like_the_whole(text, size):
    p = test_slices_are_tokenised_like_the_whole.__dict__.setdefault("plain", Plain())
    parts = list(alignment.slices(text, size))
    assert " ".join(parts) == text or not text
    if text:
        assert sum((p.a.encode(" " + t, add_special_tokens=False).ids for t in parts), []) == p.a.encode(" " + text, add_special_tokens=False).ids
        assert sum((p.b.encode(t) for t in parts), []) == p.b.encode(text)
