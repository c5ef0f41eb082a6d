"""Corpus pipeline: language ID, toxicity, exact dedup, MinHash near-dedup, best-fit packing.

Every stage works on all rows that its predecessor kept and returns the columns of documents,
but for the last, which returns the packed pieces. ``run`` writes each stage's result under the
shared checkpoint folder and reads it back for the next, so a lost executor costs a stage at
most. An empty table passes through all stages; rows with null text have no letters and go in
the first.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwise.llm import exact_dedup, language_id, near_dedup, packing, toxicity
from cardwise.llm.helpers import fold, normalised_text, text_or_empty, written

#: Columns added for a while; no table of ours has such names.
FOUND, KEY = "__corpus_found", "__corpus_key"
#: Near copies share so many percent of their shingles or more.
NEAR_PERCENT = 80
ORACLE_SQL = None  # two stages are trained models


def keep_rows(docs: DataFrame, key: Column, kept: DataFrame, kept_key: Column) -> DataFrame:
    """One row of ``docs`` for each key that is in ``kept``. Rows that repeat a key are dropped
    before the shuffle, then once more after it."""
    columns = docs.columns
    rows = docs.withColumn(KEY, key).dropDuplicates([KEY])
    return rows.join(kept.select(kept_key.alias(KEY)), KEY, "left_semi").select(*columns)


def row_key(id_col: str, digest: Column) -> Column:
    return F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("none")), digest.cast("string"))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without a language (``und``)."""
    predict = language_id.predictor(docs, fold(F.col("doc_id"), 4) != 2, "doc_id", "text", "lang")
    found = docs.withColumn(FOUND, predict(F.col("text")))
    return found.where(F.col(FOUND)["lang_pred"] != language_id.UNKNOWN).select(*docs.columns)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents with a score of a half or more."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    score = toxicity.scorer(docs, labels, fold(F.col("doc_id"), 5) != 0, "doc_id", "text", "toxic")
    return docs.withColumn(FOUND, score(F.col("text"))).where(F.col(FOUND) < 0.5).select(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest id of equal texts."""
    kept = exact_dedup.exact_dedup(docs).where("kept")
    digest = F.sha2(normalised_text(F.col("text")), 256)
    return keep_rows(docs, row_key("doc_id", digest), kept, row_key("doc_id", F.col("text_sha256")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies."""
    kept = near_dedup.near_dedup(docs, percent=NEAR_PERCENT).where("stays")
    return keep_rows(docs, row_key("doc_id", F.xxhash64(text_or_empty(F.col("text")))), kept, row_key("doc_id", F.col("text_hash")))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs whole documents into sequences."""
    return packing.pack(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("minhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
