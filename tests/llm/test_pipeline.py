"""Each stage on odd rows and, end to end, against brute-force versions on the small table."""

import re

import pytest

import corpus_pipeline
from grovemart.llm.common import written
from tests.llm import data
from tests.llm.test_ngrams import brute

SF_DIR = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


def test_stages():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard", "substring_dedup", "mixing", "packing"]


@pytest.mark.parametrize("name", list(STAGES)[:-1])
def test_columns_stay(spark, name):
    docs = data.documents(spark)
    out = STAGES[name](spark, docs, SF_DIR)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    assert out.count() > 0
    assert STAGES[name](spark, docs.limit(0), SF_DIR).count() == 0


def rows_of(df):
    return [(r["doc_id"], r["text"], r["source"]) for r in df.collect()]


def test_chain(spark):
    """Every stage on what the one before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    kept = written(STAGES["toxicity"](spark, docs, SF_DIR), "t")
    left = {r["doc_id"] for r in kept.collect()}
    clean = [d for d, t in labels.items() if t == 0]
    assert sum(d in left for d in clean) >= 0.97 * len(clean)

    alone = written(STAGES["ngram_jaccard"](spark, kept, SF_DIR), "a")
    want = {d for d, _, c in brute(rows_of(kept)) if d == c}
    assert {r["doc_id"] for r in alone.collect()} == want

    cut = written(STAGES["substring_dedup"](spark, alone, SF_DIR), "c")
    expected = {d: (n, gone, sha) for d, n, gone, _, sha in data.brute_words(rows_of(alone))}
    texts = {d: t for d, t, _ in rows_of(alone)}
    assert cut.count() == alone.count()
    for r in cut.collect():
        words = data.WORD.findall(r["text"])
        n, gone, sha = expected[r["doc_id"]]
        assert len(words) == n - gone and data.sha(" ".join(words).encode()) == sha
        assert gone or r["text"] == texts[r["doc_id"]]
        assert r["n_chars"] == len(r["text"])

    mixed = written(STAGES["mixing"](spark, cut, SF_DIR), "m")
    before = sum(len(data.WORD.findall(t)) for _, t, _ in rows_of(cut))
    after = sum(len(data.WORD.findall(t)) for _, t, _ in rows_of(mixed))
    assert abs(before - after) <= len({s for _, _, s in rows_of(cut)})

    packed = STAGES["packing"](spark, mixed, SF_DIR).collect()
    assert sum(r["start"] == 0 for r in packed) == mixed.count()
    assert re.fullmatch(r"doc_id,start,length,ids_crc32,doc_tokens,sequence_id,offset", ",".join(packed[0].__fields__))


def test_run(spark):
    assert corpus_pipeline.run(spark, SF_DIR).count() > 0


def test_other_texts_of_a_doc_id_stay(spark):
    kept = rows_of(STAGES["ngram_jaccard"](spark, data.documents(spark), SF_DIR))
    assert [d for d, t, _ in kept if t == data.BODY[6]] == [-5]
    assert [d for d, t, _ in kept if t == data.BODY[7]] == [20]
    assert [d for d, t, _ in kept if t == data.BODY[5]] == [18]
    rows = [(1, "", "a"), (1, data.BODY[0], "a"), (2, data.BODY[1], "a"), (2, data.BODY[2], "a"), (2, data.BODY[2], "a")]
    kept = rows_of(STAGES["ngram_jaccard"](spark, data.documents(spark, rows), SF_DIR))
    assert sorted(kept) == sorted(set(rows))
