"""Exact dedup: tree-merge of sorted digest runs (DataFrame operators only).

Each scan partition is one *run*: its digests, pre-aggregated and sorted by the partial
aggregate. Runs are then exchanged in binomial rounds: in round r, the ``fan_in`` runs whose
numbers agree above digit r meet, and a multiway merge keeps, for every digest, the smallest
identifier and the number of rows. After ``ceil(log_fan_in(runs))`` rounds one run is left.
A merge is *verified*: two entries are one only if SHA-256, a second 64-bit hash and the
length of the text all agree, at every level.

Every exchange is keyed by (run at this level, digest), so the work of a round is spread over
all tasks; the last run is never gathered into one task. Of a group that holds a third of all
rows, a run sends one entry. Results return the same way: first to the distinct (run, digest)
pairs, at most one per run and digest, then from these to the rows, so that no key of the
last join has more rows than one scan partition.

Defined results: null text counts as empty; the smallest non-null id of a group stays; if
several rows repeat that id, or if all ids of a group are null, exactly one of them stays (the
first in scan order). An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwise.llm.helpers import normalised_text, written

FAN_IN = 8
KEY = ("digest", "check", "length")


def digest_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, pos, run, digest, check, length) per row, written once: the text is read once."""
    text = docs.select(F.col(id_col).alias("doc_id"), normalised_text(F.col(text_col)).alias("text"))
    return written(
        text.select(
            "doc_id",
            F.monotonically_increasing_id().alias("pos"),
            F.spark_partition_id().alias("run"),
            F.unhex(F.sha2("text", 256)).alias("digest"),
            F.xxhash64("text").alias("check"),
            F.length("text").alias("length"),
        ),
        "digests",
    )


def merge_tree(rows: DataFrame, fan_in: int = FAN_IN) -> DataFrame:
    """(digest, check, length, best, size): the root run of the merge tree.

    ``best`` is the struct (id is null, id, pos) of the row that stays."""
    runs = rows.agg(F.max("run")).first()[0]
    level = rows.select(
        "run", *KEY, F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "pos").alias("best"), F.lit(1).cast("long").alias("size")
    )
    while True:
        level = (
            level.withColumn("run", (F.col("run") / fan_in).cast("int"))
            .groupBy("run", *KEY)
            .agg(F.min("best").alias("best"), F.sum("size").alias("size"))
        )
        runs = (runs or 0) // fan_in
        if not runs:
            return level.drop("run")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fan_in: int = FAN_IN) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = digest_rows(docs, id_col, text_col)
    root = merge_tree(rows, fan_in)
    pairs = rows.select("run", *KEY).distinct()
    answers = pairs.join(root, list(KEY))
    return rows.join(answers, ["run", *KEY]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("size").alias("group_size"),
        (F.col("pos") == F.col("best.pos")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


ORACLE = r"""
WITH d AS (
  SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, h AS text_sha256
FROM d WINDOW g AS (PARTITION BY h)
"""
