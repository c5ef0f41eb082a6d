"""Small helpers shared by the operators: text rules, fold rules, written scratch tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwise.session import scratch_path

WHITESPACE = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def text_or_empty(text: Column) -> Column:
    return F.coalesce(text.cast("string"), F.lit(""))


def normalised_text(text: Column) -> Column:
    """Null as empty, every run of ASCII whitespace as one space."""
    return F.regexp_replace(text_or_empty(text), WHITESPACE, " ")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def fold(id_col: Column, folds: int) -> Column:
    """``crc32(id as text) mod folds``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % folds


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint folder and read back.

    Cuts lineage with files that outlive any executor. The reread table keeps the names and
    types of ``df``."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
