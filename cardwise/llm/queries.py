"""Registered queries of the training-data operators and their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwise.llm import collocations, conversation_repair, exact_dedup, language_id, near_dedup, packing, sentencepiece_codec, sharding, suffix_dedup, token_counts, topk, toxicity, url_filter

SHARDS = 40
EVERY_QUERY = 20
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_dedup(table(spark, sf_dir, "documents"), percent=near_dedup.PERCENT).drop("stays", "text_hash")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_filter(table(spark, sf_dir, "pages"))


def op5_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY_QUERY == 0)


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text, and the SHA-256 of the text that they decode to."""
    model = sentencepiece_codec.read_model(PIECES)
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), model, decoded_digest=True)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    automaton = token_counts.build_automaton(*token_counts.pieces_of_model(PIECES))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), automaton)


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_plan(table(spark, sf_dir, "documents"), SHARDS)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.conversation_repair(table(spark, sf_dir, "conversations"), damage=True)


QUERIES = (
    op1_exact_dedup,
    op2_minhash_near_dedup,
    op3_toxicity,
    op4_url_filter,
    op5_exact_topk,
    op6_sentencepiece,
    op7_token_counts,
    op8_best_fit_packing,
    op9_language_id,
    op10_sharding,
    op11_collocations,
    op12_suffix_dedup,
    op13_conversation_repair,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": exact_dedup.ORACLE,
        "op2_minhash_near_dedup": near_dedup.ORACLE,
        "op4_url_filter": url_filter.oracle(),
        "op5_exact_topk": topk.oracle(EVERY_QUERY),
        "op10_sharding": sharding.oracle(SHARDS),
        "op11_collocations": collocations.oracle(),
        "op12_suffix_dedup": suffix_dedup.oracle(),
        "op13_conversation_repair": conversation_repair.oracle(),
    }
