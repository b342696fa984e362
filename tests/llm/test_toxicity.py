"""Toxicity: held-out documents of the tables, disguised insults, odd rows."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from grovemart.llm import toxicity
from tests.llm import data

INSULTS = ["blorptard", "snivelgut", "mudbrain"]


def made_up(count, seed):
    """Documents of invented words; every third one holds insults."""
    rng = random.Random(seed)
    parts = ["an", "ti", "ro", "sel", "mo", "the", "ing", "ver", "ka", "lu", "out", "es", "ha"]

    def word():
        return "".join(rng.choice(parts) for _ in range(rng.randint(1, 4)))

    rows = []
    for i in range(count):
        words = [word() for _ in range(rng.randint(20, 120))]
        if i % 3 == 0:
            for _ in range(rng.randint(1, 3)):
                words[rng.randrange(len(words))] = rng.choice(INSULTS)
        text = " ".join(w + rng.choice(["", "", "", ".", ","]) for w in words)
        rows.append((i, text, int(i % 3 == 0)))
    return rows


@pytest.fixture(scope="module")
def model():
    sentences = [(i, s.encode(), bool(t)) for i, text, t in made_up(600, 1) for s in text.split(".") if len(s) > 1]
    return toxicity.fit(sentences)


def chance(model, text):
    return float(model.probability([text.encode()])[0])


def test_held_out_documents(model):
    rows = made_up(300, 2)
    right = sum((chance(model, text) >= 0.5) == bool(t) for _, text, t in rows)
    assert right >= 0.98 * len(rows)


@pytest.mark.parametrize("word", INSULTS)
def test_disguises(model, word):
    for disguise in (word.upper(), " ".join(word), ".".join(word), word[:4] + "-" + word[4:], word.replace("o", "0"), word + "!!"):
        assert chance(model, f"out and {disguise} over") >= 0.5, disguise


def test_inserted_letters(model):
    altered = [word[:i] + "q" + word[i:] for word in INSULTS for i in range(1, len(word))]
    assert np.mean([chance(model, f"an over {word} out") >= 0.5 for word in altered]) >= 0.7


def test_sums_against_plain_counting(model):
    """Every word's score by its own subsequences, one by one."""
    texts = [b"The s-t mudbrain a b c", b"", b"word"]
    words = toxicity.Words(texts)
    scores = words.scores(model.table)
    for row, (start, end) in enumerate(zip(words.start, words.end, strict=True)):
        symbols = words.symbols[start:end].tolist()
        total = norm = 0.0
        for (a, b, c), weight in toxicity.SHAPES:
            for i in range(len(symbols) - c):
                number = 0
                for place in (0, a, b, c):
                    number = number * toxicity.SYMBOLS + symbols[i + place]
                total += weight * model.table[number]
                norm += weight**2
        assert scores[row] == pytest.approx(total / max(norm, 1e-9) ** 0.5, abs=1e-4)
    assert len(words.start) == 5  # the letters a b c are one word


def test_odd_rows(spark):
    rows = [(d, t, "s") for d, t, _ in made_up(200, 3)] + [(None, "x", "s"), (1000, None, "s"), (1001, "", "s"), (1002, data.LONG, "s")]
    docs = data.documents(spark, rows)
    labels = spark.createDataFrame(
        [(d, 0, t, "z") for d, _, t in made_up(200, 3)] + [(None, 1, 1, "z"), (5, 1, None, "z"), (9999, 1, 1, "z")],
        "doc_id long, quality int, toxic int, text string",
    )
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model)
    assert scored.columns == [*[c for c in docs.columns if c != "score"], "score", "predicted"]
    found = scored.collect()
    assert len(found) == len(rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in found)
    empty = [r["score"] for r in found if not r["text"]]
    assert len(set(empty)) == 1 and empty[0] < 0.5
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_without_labels(spark):
    docs = data.documents(spark)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = toxicity.score(docs, toxicity.train(docs, none)).collect()
    assert all(r["predicted"] == 0 for r in rows)


def test_held_out_rows_are_never_learned(spark):
    docs = data.documents(spark, [(i, f"text {i}. more {i}", "s") for i in range(200)])
    labels = spark.range(200).select(F.col("id").alias("doc_id"), F.lit(0).alias("quality"), (F.col("id") % 2).cast("int").alias("toxic"))
    learned = {d for d, _, _ in toxicity.labelled_sentences(docs, labels)}
    assert learned == {i for i in range(200) if zlib.crc32(str(i).encode()) % 5}


def test_accuracy_on_the_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    scored = toxicity.score(docs, toxicity.train(docs, labels))
    langs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "lang")
    held = scored.join(labels, "doc_id").join(langs, "doc_id").where(toxicity.held_out(F.col("doc_id")))
    rows = held.select("toxic", "score", "predicted", "lang").collect()
    assert np.mean([r["predicted"] for r in rows if r["toxic"]]) >= 0.9
    assert np.mean([r["predicted"] for r in rows if not r["toxic"]]) <= 0.025
    for lang in ("en", "fr", "de", "es"):
        assert np.mean([r["predicted"] for r in rows if r["toxic"] and r["lang"] == lang]) >= 0.9


def test_long_texts_push_no_others_out(spark, monkeypatch):
    """Every document gives as many sentences as the bound allows, one after another; long ones are cut, not shortened."""
    monkeypatch.setattr(toxicity, "TOXIC_SENTENCES", 60)
    monkeypatch.setattr(toxicity, "CLEAN_SENTENCES", 30)
    rows = [(i, f"one {i}. two {i}. three {i}", "s") for i in range(40)] + [(100, "long one. " * 5000, "s"), (102, "y" * 2500, "s")]
    docs = data.documents(spark, rows)
    labels = spark.createDataFrame([(i, 0, 1 - i % 2) for i, *_ in rows], "doc_id long, quality int, toxic int")
    drawn = toxicity.labelled_sentences(docs, labels)
    per_doc = {}
    for doc, _, toxic in drawn:
        per_doc.setdefault(toxic, {}).setdefault(doc, 0)
        per_doc[toxic][doc] += 1
    assert sum(per_doc[True].values()) <= 60 and sum(per_doc[False].values()) == 30
    assert set(per_doc[True]) | set(per_doc[False]) == {i for i, *_ in rows if zlib.crc32(str(i).encode()) % 5}
    assert max(per_doc[False].values()) <= 1 + min(per_doc[False].values())
    if 102 in per_doc[True]:
        assert {len(s) for d, s, _ in drawn if d == 102} <= {1000, 500}


def test_marks_behind_a_word_are_no_letters():
    def symbols(text):
        return toxicity.encode([text])[0].tolist()

    assert symbols(b"SCUM!! you") == symbols(b"scum you") == symbols(b"scum!?! you")
    assert symbols(b"sk!ll") == symbols(b"skill") and symbols(b"!") == symbols(b" ")


@pytest.mark.parametrize("seed", range(3))
def test_features_give_the_full_kernel(seed):
    """With every word a landmark the machine's table holds the whole kernel: landmarks lose nothing then."""
    rng = np.random.default_rng(seed)
    texts = [bytes(rng.integers(97, 104, rng.integers(5, 9)).astype(np.uint8)) for _ in range(12)]
    words = toxicity.Words([b" ".join(texts)])
    rows = np.arange(len(words.start))
    whole = toxicity.kernel(words, rows, toxicity.landmark_table(words, rows))
    values, vectors = np.linalg.eigh(whole)
    solid = values > 1e-6 * values.max()
    x = whole @ (vectors[:, solid] / np.sqrt(values[solid]))
    assert np.allclose(x @ x.T, whole, atol=1e-3)
