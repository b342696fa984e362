"""From raw documents to packed training sequences."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from grovemart.llm import automata, mixing, ngrams, packing, toxicity
from grovemart.llm.common import put_back, set_aside, table, written
from grovemart.llm.queries import END_ID, WINDOW, vocabulary

#: Learned scores and indexes over texts: no SQL gives these rows.
ORACLE_SQL = None


def _set_aside(docs: DataFrame) -> tuple[DataFrame, Callable[[DataFrame, Column], DataFrame]]:
    """The documents under doc_id, text, source and neutral names, so that no column can clash with an
    operator's own, and a function that gives rows their columns back with another text."""
    rows, names = set_aside(docs)
    for name in ("doc_id", "text", "source"):
        rows, names[name] = rows.withColumnRenamed(names[name], name), name

    def restored(out: DataFrame, text: Column) -> DataFrame:
        changed = out.withColumn("text", text)
        if "n_chars" in names:
            kind = docs.schema["n_chars"].dataType
            changed = changed.withColumn(names["n_chars"], F.length("text").cast(kind))
        return changed.select(*put_back(names, []))

    return rows, restored


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity model does not reject."""
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    rows, names = set_aside(docs)
    rows, names["text"] = rows.withColumnRenamed(names["text"], "text"), "text"
    return toxicity.score(rows, model).where("predicted = 0").select(*put_back(names, []))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of alike documents the one with the least doc_id.

    Rows of one doc_id and text are one document, other texts of a doc_id are documents of their
    own; rows without doc_id stay.
    """
    stays = ngrams.first_rows(docs).toDF("_id", "_key")
    rows, names = set_aside(docs)
    doc_id, key = F.col(names["doc_id"]), F.xxhash64(names["text"])
    one = F.row_number().over(Window.partitionBy("_id", "_key").orderBy(names["text"]))
    # The documents that stay grow with the input: never broadcast.
    same = (doc_id == F.col("_id")) & (key == F.col("_key"))
    kept = rows.join(stays.hint("merge"), same).withColumn("_row", one).where("_row = 1")
    columns = put_back(names, [])
    return kept.select(*columns).union(rows.where(doc_id.isNull()).select(*columns))


def drop_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less the passages that smaller doc_ids hold; untouched texts stay as they are."""
    rows, restored = _set_aside(docs)
    text = F.when(F.col("n_removed") > 0, F.decode("kept", "UTF-8")).otherwise(F.col("text"))
    return restored(automata.dedup(rows), text)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, each as often as its source's target asks for."""
    rows, restored = _set_aside(docs)
    return restored(mixing.mixed(rows), F.col("text"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in the sequences."""
    return packing.pack(docs, vocabulary(), WINDOW, END_ID)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard", drop_near_copies),
    ("substring_dedup", drop_repeated_passages),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages one after another over the documents; each reads what the last has written."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
