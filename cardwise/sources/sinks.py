"""Batch sinks (K1, K4, K5)."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwise.schema import FEATURE_TABLE_COLUMNS, TXN_COLUMNS


def write_features(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K1: feature table in column-contract order, partitioned by event day (UTC).

    Day partitions let later reads prune by time (temporal splits, monitoring windows).
    """
    out = df.select(*FEATURE_TABLE_COLUMNS).withColumn(
        "event_day", F.to_date(F.timestamp_millis(F.col("ts_ms")))
    )
    out.write.mode(mode).partitionBy("event_day").parquet(path)


def write_normalized(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """K5: canonical transactions as CSV with a header, in schema order."""
    df.select(*TXN_COLUMNS).write.mode(mode).option("header", "true").csv(path)


def write_report(spark: SparkSession, report: dict, path: str) -> None:
    """K4: one JSON document (test report, threshold, cost model, curve, importance, order), as a
    one-row table of nested structs, which ``spark.read.json`` gives back.

    The report is a small dict of scalars and short lists (<= a few hundred numbers).
    """
    doc = json.dumps(report, sort_keys=True)
    row = spark.createDataFrame([(doc,)], "value string").select(F.from_json("value", F.schema_of_json(F.lit(doc))).alias("r"))
    row.select("r.*").coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(path)
