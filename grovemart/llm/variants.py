"""Spelling variants: words one code point apart, found by pairs of trie nodes.

The dictionary's words make a trie, their reversals another, and the nodes of both are numbered. A word
cut at a place is then two integers: the node of what lies before and the node of what lies
behind. Leaving out one code point gives a pair around the gap; a place between two
code points, where one may be inserted, gives a pair without a gap. So two words are one

- replacement apart if and only if they share a pair around a gap of the same place: equal
  numbers are equal texts, and the words differ in that code point only;
- insertion or deletion apart if and only if the pair around a gap of the longer one is a pair
  without a gap of the shorter one.

That is a grouping by two integers, exact and without comparing texts. A pair has one word per
code point of the alphabet at most, and one without a gap: no group grows with the data. In a run of equal
code points only the first is left out for a deletion, so every neighbour is met once.

Nodes are numbered where the sorted words lie: a word makes a node for every code point beyond what
it shares with the word before it. A range of words begins by making nodes that the range
before may have made, too; the first and last word of every range tell which, and their numbers are
replaced. Two words a range go through the driver; a range has about `RANGE_LETTERS` letters.

Defined cases: null and empty texts have no words; a null doc_id counts as empty text in the checksum;
repeated rows count twice; ties of the largest count go to the word that is first by code points; an empty
table gives an empty one; very long words are words like others; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from grovemart.llm.common import written

#: A run of letters.
RUN = "[A-Za-zÀ-ÿ]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Letters of the words that a task numbers.
RANGE_LETTERS = 8 << 20
#: Node numbers that a task hands on at once.
HAND_ON = 1 << 20

NODES = "part int, place long, word string, n long, nodes array<long>, made long"


def lowered(run: Column) -> Column:
    """A-Z in lower case, other letters as they are."""
    plain = F.octet_length(run) == F.char_length(run)
    return F.when(plain, F.lower(run)).otherwise(F.translate(run, UPPER, LOWER))


def misprinted(run: Column, doc_id: Column, modulus: int) -> Column:
    """The run, less one code point where `modulus` divides the checksum of document and run."""
    check = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run).cast("binary"))
    at = F.pmod(check, F.char_length(run)).cast("int")
    less = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.char_length(run)))
    return F.when(check % modulus == 0, less).otherwise(run)


def dictionary(docs: DataFrame, least_letters: int = 5, least_count: int = 3, modulus: int = 97) -> DataFrame:
    """`word` and `n`, how often it occurs; counted in every task before anything is sent."""
    runs = docs.select("doc_id", F.explode(F.regexp_extract_all("text", F.lit(RUN), F.lit(0))).alias("run"))
    runs = runs.where(F.char_length("run") >= least_letters)
    words = runs.select("doc_id", lowered(F.col("run")).alias("run"))
    words = words.select(misprinted(F.col("run"), F.col("doc_id"), modulus).alias("word"))
    long = words.where(F.char_length("word") >= least_letters)
    return long.groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


def shared(a: str, b: str) -> int:
    """Number of code points that two words begin with alike."""
    if b.startswith(a):
        return len(a)
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def _numbered(words: DataFrame, ranges: int) -> DataFrame:
    """Every word with its place in a sorted range and the range's own numbers of the nodes on its way."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, place, made, before = TaskContext.get().partitionId(), 0, 0, ""
        way = np.zeros(1, np.int64)
        rows: list[tuple] = []
        held = 0

        def handed() -> pa.RecordBatch:
            places, texts, counts, ways, totals = zip(*rows, strict=True)
            ends = np.cumsum([0, *map(len, ways)])
            nodes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(ways)))
            columns = [pa.array([part] * len(rows), pa.int32()), pa.array(places, pa.int64()), pa.array(texts, pa.string())]
            columns += [pa.array(counts, pa.int64()), nodes, pa.array(totals, pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["part", "place", "word", "n", "nodes", "made"])

        for batch in batches:
            for word, n in zip(batch["word"].to_pylist(), batch["n"].to_pylist(), strict=True):
                same = shared(before, word)
                new = len(word) - same
                way = np.concatenate((way[: same + 1], np.arange(made + 1, made + new + 1)))
                made += new
                rows.append((place, word, n, way, made))
                place, before, held = place + 1, word, held + len(way)
                if held > HAND_ON:
                    yield handed()
                    rows, held = [], 0
        if rows:
            yield handed()

    sorted_words = words.repartitionByRange(ranges, "word").sortWithinPartitions("word")
    return sorted_words.select("word", "n").mapInArrow(walk, NODES)


def numbered(words: DataFrame, range_letters: int = RANGE_LETTERS) -> DataFrame:
    """`word`, `n`, its rank among all words, and the numbers of its trie nodes from the root (0) on."""
    letters = words.agg(F.sum(F.char_length("word"))).first()[0] or 0
    local = written(_numbered(words, 1 + letters // range_letters), "nodes")
    last = F.max_by(F.struct("word", "nodes", "made", "place"), "place").alias("last")
    ranges = local.groupBy("part").agg(F.min_by("word", "place").alias("first"), last).orderBy("part").collect()
    rows, rank, base, before, way = [], 0, 0, "", np.zeros(1, np.int64)
    for r in ranges:
        same = shared(before, r["first"])
        carried = way[: same + 1]
        rows.append((r["part"], rank, base, carried.tolist()))
        nodes = np.array(r["last"]["nodes"], np.int64)
        # The first word's nodes have the numbers from 1 on: those it shares are known already.
        way = np.where(nodes <= same, carried[np.minimum(nodes, same)], base + nodes - same)
        before, rank, base = r["last"]["word"], rank + r["last"]["place"] + 1, base + r["last"]["made"] - same
    known = words.sparkSession.createDataFrame(rows, "part int, rank long, base long, carried array<long>")
    joined = local.join(known, "part")
    same = F.size("carried") - 1
    number = F.transform(
        "nodes", lambda x: F.when(x <= same, F.get("carried", x.cast("int"))).otherwise(F.col("base") + x - same)
    )
    return joined.select("word", "n", (F.col("rank") + F.col("place")).alias("id"), number.alias("nodes"))


def cuts(words: DataFrame) -> DataFrame:
    """Every word (`id`, `n`, `word`, `ahead`, `behind`) at every place: the pair (p, s) of nodes and whether a
    code point is left out between them (`gap`), the first of its run (`first`)."""
    places = words.select("id", "n", "word", "ahead", "behind", F.posexplode("ahead").alias("at", "p"))
    length = F.size("ahead") - 1
    own, left = F.substring(F.col("word"), F.col("at") + 1, F.lit(1)), F.substring(F.col("word"), F.col("at"), F.lit(1))
    gaps = places.where(F.col("at") < length).select(
        "p", F.get("behind", length - 1 - F.col("at")).alias("s"), "id", "n",
        F.lit(True).alias("gap"), ((F.col("at") == 0) | (own != left)).alias("first"),
    )
    whole = places.select(
        "p", F.get("behind", length - F.col("at")).alias("s"), "id", "n", F.lit(False).alias("gap"), F.lit(False).alias("first")
    )
    return gaps.union(whole)


def neighbours(cut: DataFrame) -> DataFrame:
    """Of every word with near words: their number, and the one of largest `n` (the least id of those)."""
    row = F.struct("n", (-F.col("id")).alias("minus"), "gap", "first")
    groups = cut.groupBy("p", "s").agg(F.collect_list(row).alias("rows")).where(F.size("rows") > 1)
    one = groups.select("rows", F.explode("rows").alias("one"))

    def near(other: Column) -> Column:
        me = F.col("one")
        replaced = me["gap"] & other["gap"] & (other["minus"] != me["minus"])
        return replaced | (me["first"] & ~other["gap"]) | (~me["gap"] & other["first"])

    others = one.select((-F.col("one")["minus"]).alias("id"), F.filter("rows", near).alias("others"))
    best = F.array_max(F.transform("others", lambda x: F.struct(x["n"].alias("n"), x["minus"].alias("minus"))))
    met = others.where(F.size("others") > 0).select("id", F.size("others").alias("k"), best.alias("best"))
    return met.groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """`id` and `root` of rows (id, form): where the forms lead. A form's count is at least twice its
    word's, so there is no ring, and a way of 63 steps at most, halved in every round."""
    now = written(forms.select("id", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("id").alias("root"), F.col("root").alias("next"))
        stepped = now.join(ahead, "root", "left").select("id", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        stepped = written(stepped, "roots")
        if stepped.where("moved").isEmpty():
            return stepped.select("id", "root")
        now = stepped.select("id", "root")


def group(docs: DataFrame, range_letters: int = RANGE_LETTERS) -> DataFrame:
    """Every word of the documents (doc_id, text) with its form and root.

    Returns word, form, root, n, n_near, form_n: the form is the near word of largest n if that is twice
    the word's own at least.
    """
    counted = written(dictionary(docs), "dictionary")
    forward = written(numbered(counted, range_letters), "ahead")
    backward = numbered(forward.select(F.reverse("word").alias("word"), F.col("id").alias("n")), range_letters)
    words = written(
        forward.withColumnRenamed("nodes", "ahead").join(
            backward.select(F.col("n").alias("id"), F.col("nodes").alias("behind")), "id"
        ),
        "words",
    )
    near = words.select("id", "word", "n").join(neighbours(cuts(words)), "id", "left")
    is_form = F.col("best")["n"] >= 2 * F.col("n")
    near = near.select(
        "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, -F.col("best")["minus"]).alias("form"), F.when(is_form, F.col("best")["n"]).alias("form_n"),
    )
    near = written(near, "near")
    with_form = near.where("form is not null")
    led = roots(with_form).withColumnRenamed("id", "_id")
    names = near.select("id", "word")
    form_names = names.select(F.col("id").alias("form"), F.col("word").alias("form_word"))
    root_names = names.select(F.col("id").alias("root"), F.col("word").alias("root_word"))
    named = with_form.join(led, F.col("id") == F.col("_id")).join(form_names, "form").join(root_names, "root")
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    grouped = named.select("word", F.col("form_word").alias("form"), F.col("root_word").alias("root"), "n", "n_near", "form_n")
    alone = near.where("form is null").withColumn("form", F.lit(None).cast("string")).withColumn("root", F.col("word"))
    return grouped.select(*columns).union(alone.select(*columns))
