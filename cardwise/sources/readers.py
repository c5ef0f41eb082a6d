"""Batch sources: dataset adapters that normalise to the canonical transaction schema.

Every reader declares its schema (no inference) and returns a lazy DataFrame; event order
is never materialised by a global sort, it is a property of the per-card windows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cardwise.functions.columns import (
    blank_to_na,
    card_key,
    ieee_event_ms,
    pseudo_geo,
    region_key,
    text_event_ms,
)
from cardwise.schema import TXN_COLUMNS, TXN_SCHEMA

# fixed values: source CSV headers the adapters read
IEEE_COLUMNS = (
    "TransactionID",
    "TransactionDT",
    "TransactionAmt",
    "ProductCD",
    "card1",
    "card2",
    "card3",
    "card5",
    "addr1",
    "addr2",
    "P_emaildomain",
    "isFraud",
)
IEEE_CARD_PARTS = ("card1", "card2", "card3", "card5", "addr1", "addr2")
SPARKOV_COLUMNS = (
    "trans_date_trans_time",
    "cc_num",
    "merchant",
    "category",
    "amt",
    "trans_num",
    "merch_lat",
    "merch_long",
    "is_fraud",
)


def _string_schema(names) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


def _csv(spark: SparkSession, path: str, names) -> DataFrame:
    # Column subset by header name; extra columns in the file are ignored.
    return (
        spark.read.option("header", "true")
        .option("enforceSchema", "false")
        .schema(_string_schema(names))
        .csv(path)
    )


def read_ieee(spark: SparkSession, path: str) -> DataFrame:
    """IEEE-CIS ``train_transaction.csv`` to canonical rows."""
    raw = _csv(spark, path, IEEE_COLUMNS)
    lat, lon = pseudo_geo(region_key("addr1", "addr2"))
    return raw.select(
        F.col("TransactionID").alias("txn_id"),
        card_key(IEEE_CARD_PARTS).alias("card_id"),
        ieee_event_ms("TransactionDT").alias("ts_ms"),
        F.col("TransactionAmt").cast("double").alias("amount"),
        blank_to_na("ProductCD").alias("mcc"),
        blank_to_na("P_emaildomain").alias("merchant_id"),
        lat.alias("lat"),
        lon.alias("lon"),
        F.col("isFraud").cast("int").alias("label"),
    )


def read_sparkov(spark: SparkSession, path: str) -> DataFrame:
    """Sparkov simulator CSV to canonical rows (naive time read as UTC)."""
    raw = _csv(spark, path, SPARKOV_COLUMNS)
    return raw.select(
        F.col("trans_num").alias("txn_id"),
        F.col("cc_num").alias("card_id"),
        text_event_ms("trans_date_trans_time").alias("ts_ms"),
        F.col("amt").cast("double").alias("amount"),
        F.coalesce("category", F.lit("")).alias("mcc"),
        F.coalesce("merchant", F.lit("")).alias("merchant_id"),
        F.col("merch_lat").cast("double").alias("lat"),
        F.col("merch_long").cast("double").alias("lon"),
        F.col("is_fraud").cast("int").alias("label"),
    )


def read_normalized(spark: SparkSession, path: str) -> DataFrame:
    """S3: CSV already in the canonical layout (header required); bad rows come from
    ``read_quarantine``."""
    return coerce_transactions(_csv(spark, path, TXN_COLUMNS))[0]


def read_quarantine(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a canonical CSV that ``read_normalized`` leaves out, as text, with the reason."""
    return coerce_transactions(_csv(spark, path, TXN_COLUMNS))[1]


READERS = {"ieee": read_ieee, "sparkov": read_sparkov, "normalized": read_normalized}


def read_transactions(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """Dispatch on the dataset kind; unknown kinds are an error."""
    if kind not in READERS:
        raise ValueError(f"unknown dataset {kind!r}; expected one of {sorted(READERS)}")
    return READERS[kind](spark, path)


def coerce_transactions(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """P5: cast text fields to the canonical types.

    Returns ``(good, quarantine)``. A row is quarantined when an id or a numeric field is
    missing, unparsable or not finite; a missing merchant becomes ``""``, a missing MCC
    ``"NA"``, a missing or blank label NULL. ``quarantine`` keeps the raw text plus a reason.
    """
    typed = df.select(
        F.col("txn_id").cast("string").alias("txn_id"),
        F.col("card_id").cast("string").alias("card_id"),
        F.expr("try_cast(trim(CAST(ts_ms AS STRING)) AS BIGINT)").alias("ts_ms"),
        F.expr("try_cast(trim(CAST(amount AS STRING)) AS DOUBLE)").alias("amount"),
        F.coalesce(F.col("mcc").cast("string"), F.lit("NA")).alias("mcc"),
        F.coalesce(F.col("merchant_id").cast("string"), F.lit("")).alias("merchant_id"),
        F.expr("try_cast(trim(CAST(lat AS STRING)) AS DOUBLE)").alias("lat"),
        F.expr("try_cast(trim(CAST(lon AS STRING)) AS DOUBLE)").alias("lon"),
        F.expr("try_cast(nullif(trim(CAST(label AS STRING)), '') AS INT)").alias("label"),
        F.struct(*[F.col(c).cast("string").alias(c) for c in df.columns]).alias("_raw"),
    )

    def finite(c):
        return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))

    reason = (
        F.when(F.col("txn_id").isNull(), "txn_id")
        .when(F.col("card_id").isNull(), "card_id")
        .when(F.col("ts_ms").isNull(), "ts_ms")
        .when(~finite("amount"), "amount")
        .when(~finite("lat"), "lat")
        .when(~finite("lon"), "lon")
    )
    tagged = typed.withColumn("_reason", reason)
    good = tagged.filter(F.col("_reason").isNull()).select(*TXN_COLUMNS)
    quarantine = tagged.filter(F.col("_reason").isNotNull()).select(
        F.col("_reason").alias("reason"), "_raw.*"
    )
    return good, quarantine


def read_features(spark: SparkSession, path: str, labelled: bool = True) -> DataFrame:
    """Feature table scan; unlabelled rows dropped (the filter reaches the scan)."""
    df = spark.read.parquet(path)
    return df.filter(F.col("label").isNotNull()) if labelled else df


def empty_transactions(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], TXN_SCHEMA)
