"""The operators on the whole test tables, with the parameters of production."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grovemart.llm import (
    alignment,
    automata,
    matching,
    mixing,
    nearvectors,
    ngrams,
    packing,
    search,
    sharding,
    suffixes,
    toxicity,
    urls,
    variants,
)
from grovemart.llm.common import n_bytes, table

WINDOW = 2048
END_ID = 1
SHARDS = 40
TOP = 10
COSINE = 0.93
SHORT_WINDOW = 1024
SHORT_END_ID = 2


def vocabulary() -> tuple[str, str, str]:
    """Ranks, tokenizer and split pattern of the public byte-level vocabulary."""
    import public_tokenizers

    return (
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.PATTERN,
    )


def piece_model() -> str:
    """The public vocabulary of pieces."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select("doc_id", *mixing.PLAN_COLUMNS)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixes.dedup(docs).select(
        "doc_id", F.col("n_units").alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), vocabulary(), WINDOW, END_ID)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        (n_bytes(text) + 16).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
    )
    return sharding.shard(docs, SHARDS, ["doc_id", "size", "text_crc32"]).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op6_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), "label", F.col("embedding").alias("vector"))
    found = nearvectors.near_duplicates(vectors, COSINE)
    return found.select(F.col("id").alias("vec_id"), "n_links", F.col("component").alias("component_id"), "kept")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(table(spark, sf_dir, "pages"))


def op8_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"))
    return search.top_k(vectors, F.col("id") % 100 == 0, TOP).select("query_id", "rank", F.col("id").alias("vec_id"), "score")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return automata.dedup(docs).select(
        "doc_id", F.col("n_units").alias("n_words"), "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngrams.jaccard_components(table(spark, sf_dir, "documents"))


def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return matching.pack(table(spark, sf_dir, "documents"), vocabulary(), SHORT_WINDOW, SHORT_END_ID)


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.group(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary(), piece_model())


QUERIES = {
    "op1_mixing": op1_mixing,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_packing": op3_packing,
    "op4_toxicity": op4_toxicity,
    "op5_sharding": op5_sharding,
    "op6_near_vectors": op6_near_vectors,
    "op7_url_filter": op7_url_filter,
    "op8_top_k": op8_top_k,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_ngram_jaccard": op10_ngram_jaccard,
    "op11_best_fit_packing": op11_best_fit_packing,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_token_alignment": op13_token_alignment,
}
