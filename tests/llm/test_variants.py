"""Spelling variants against a comparison of all words."""

import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from grovemart.llm import variants
from tests.llm import data


def brute_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 5:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 3}


def apart(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(rows):
    words, form, out = brute_words(rows), {}, []
    near = {w: [v for v in words if apart(w, v)] for w in words}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * n else None
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), words.get(form[w])))
    return sorted(out, key=repr)


def grouped(spark, rows, letters=variants.RANGE_LETTERS):
    docs = spark.createDataFrame([(d, t, "x") for d, t in rows], "doc_id long, text string, word string")
    return data.sorted_rows(variants.group(docs, letters))


FAMILY = (
    ["colour"] * 40 + ["color"] * 9 + ["colours"] * 4 + ["colr"] * 3 + ["coloor"] * 3 + ["dolour"] * 3 + ["Colour"] * 2
    + ["aaaaaa"] * 7 + ["aaaaa"] * 20 + ["aaaaaaa"] * 3 + ["aaaab"] * 3 + ["baaaa"] * 3 + ["abaaa"] * 9 + ["abaab"] * 4
    + ["señora"] * 12 + ["senora"] * 3 + ["sèñora"] * 3 + ["SEÑORA"] * 6 + ["naÿve"] * 3 + ["naÿvé"] * 6
    + ["lonely"] * 3 + ["words"] * 2 + ["tiesa"] * 8 + ["tiesb"] * 8 + ["tiesc"] * 3 + ["over×cut"] * 3
)


def test_family(spark):
    rows = [(1, " ".join(FAMILY)), (2, None), (3, ""), (None, "senora lonely"), (4, "1 2 3"), (4, "colour"), (4, "colour")]
    assert grouped(spark, rows) == brute(rows)
    by_word = {r[0]: r for r in grouped(spark, rows)}
    assert by_word["tiesc"][1] == "tiesa" and by_word["lonely"][1:3] == (None, "lonely")
    # Through a word of middle size to the largest.
    assert by_word["aaaaaaa"][1:3] == ("aaaaaa", "aaaaa")


def test_no_rows(spark):
    assert grouped(spark, []) == [] == grouped(spark, [(1, "a b c")])


def test_very_long_words_and_many_rows_of_one_document(spark):
    long = "solid" * 3000
    rows = [(k, f"{long} {long[:-1]} x{long}") for k in range(3)] + [(7, long)] * 4 + [(8, "glued " * 5000)]
    assert grouped(spark, rows) == brute(rows)


@pytest.mark.parametrize("letters", [1500, 20_000])
def test_ranges_of_words(spark, letters):
    """Nodes have one number each, however the sorted words are cut into ranges."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    assert grouped(spark, rows, letters) == brute(rows)


def test_numbers_are_trie_nodes(spark):
    words = ["abcde", "abcdf", "abx", "b", "ba", "bab", "c", "Ãb", "Ãbc"]
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    for letters in (1, 7, 100):
        nodes = {}
        rows = variants.numbered(df, letters).orderBy("id").collect()
        assert [r["word"] for r in rows] == sorted(words) and [r["id"] for r in rows] == list(range(len(words)))
        for r in rows:
            for k, number in enumerate(r["nodes"]):
                assert nodes.setdefault(r["word"][:k], number) == number
        assert sorted(nodes.values()) == list(range(len(nodes)))


def test_long_way_to_the_root(spark):
    forms = spark.createDataFrame([(k, k + 1) for k in range(60)] + [(100, 7)], "id long, form long")
    assert {tuple(r) for r in variants.roots(forms).collect()} == {(k, 60) for k in [*range(60), 100]}


def test_groups_of_pairs_stay_small(spark):
    """A pair of nodes has a word per letter at most, however many words there are."""
    letters = "abcdefghijklmnopqrstuvwxyz"
    words = [a + b + c + "tail" for a in letters[:12] for b in letters[:12] for c in letters[:12]]
    df = spark.createDataFrame([(w, 3) for w in words], "word string, n long")
    ahead = variants.numbered(df)
    behind = variants.numbered(ahead.select(F.reverse("word").alias("word"), F.col("id").alias("n")))
    both = ahead.withColumnRenamed("nodes", "ahead").join(behind.select(F.col("n").alias("id"), F.col("nodes").alias("behind")), "id")
    assert variants.cuts(both).groupBy("p", "s").count().agg(F.max("count")).first()[0] <= 13
