"""Raw transactions into a table of good rows and one of quarantined rows.

Each micro-batch writes both tables and then a commit record, all under its ``batch_id``:

    quarantine/batch=<id>/          rows that cannot be typed, as text, with the reason
    good/event_day=<d>/batch=<id>/  typed rows, one for each txn_id
    commits/batch=<id>/             counts; what has no record does not count as written

A batch that was killed anywhere in between is replayed with the same rows and the same id, and
overwrites its own folders, so every row is in exactly one table; a batch with a record is left
as it is. Readers go by the records.

Redelivery is absorbed without a state store. A transaction's event day never changes, so a row is
new unless its id is in a committed batch of the same day; a micro-batch reads the ids of the days
that occur in it, however old they are, and a late first delivery is kept. What is kept grows on
disk by day, where it can be dropped by day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwise.schema import RAW_STRING_SCHEMA, TXN_COLUMNS, TXN_SCHEMA
from cardwise.sources.readers import coerce_transactions
from cardwise.streaming.jobs import start_stream

COMMIT = "batch long, good long, quarantined long, repeated long"
GOOD = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in TXN_SCHEMA.fields) + ", event_day date, batch long"
BAD = "reason string, " + ", ".join(f"{f.name} string" for f in RAW_STRING_SCHEMA.fields) + ", batch long"


def read_or_empty(spark: SparkSession, paths: Sequence[str], schema: str, base: str | None = None) -> DataFrame:
    """The Parquet folders among ``paths`` that exist, as one table."""
    out = spark.createDataFrame([], schema)
    for path in paths:
        reader = spark.read.schema(schema)
        try:
            out = out.unionByName((reader.option("basePath", base) if base else reader).parquet(path))
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
    return out


def commits(spark: SparkSession, base: str) -> DataFrame:
    return read_or_empty(spark, [f"{base}/commits"], COMMIT)


def landed(spark: SparkSession, base: str, days: Sequence | None = None) -> DataFrame:
    """The good rows of committed batches; of some event days, if given."""
    paths = [f"{base}/good"] if days is None else [f"{base}/good/event_day={d}" for d in days]
    return read_or_empty(spark, paths, GOOD, f"{base}/good").join(commits(spark, base).select("batch"), "batch", "left_semi")


def quarantined(spark: SparkSession, base: str) -> DataFrame:
    return read_or_empty(spark, [f"{base}/quarantine"], BAD, f"{base}/quarantine").join(commits(spark, base).select("batch"), "batch", "left_semi")


def commit(spark: SparkSession, base: str, counts: tuple) -> None:
    record = spark.createDataFrame([counts], COMMIT).coalesce(1)
    record.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{base}/commits")


def land_batch(batch: DataFrame, batch_id: int, base: str) -> None:
    """One micro-batch of raw rows into both tables."""
    spark = batch.sparkSession
    if commits(spark, base).where(F.col("batch") == batch_id).limit(1).count():
        return
    batch = batch.persist()  # both halves and the counts read it
    try:
        good, bad = coerce_transactions(batch)
        bad = bad.withColumn("batch", F.lit(batch_id).cast("long"))
        bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{base}/quarantine")
        day = F.to_date(F.timestamp_millis(F.col("ts_ms")))
        once = F.row_number().over(W.partitionBy("txn_id").orderBy(*TXN_COLUMNS[1:]))
        rows = good.withColumn("n", once).where("n = 1").select(*TXN_COLUMNS, day.alias("event_day"))
        days = [r[0] for r in rows.select("event_day").distinct().collect()]  # days in one micro-batch
        known = landed(spark, base, days).select("txn_id")
        new = rows.join(known, "txn_id", "left_anti").withColumn("batch", F.lit(batch_id).cast("long"))
        new = new.select(*TXN_COLUMNS, "event_day", "batch")
        new.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("event_day", "batch").parquet(f"{base}/good")
        written = read_or_empty(spark, [f"{base}/good/event_day={d}/batch={batch_id}" for d in days], GOOD, f"{base}/good").count()
        n_good = good.count()
        commit(spark, base, (batch_id, written, batch.count() - n_good, n_good - written))
    finally:
        batch.unpersist()


def land_stream(raw: DataFrame, base: str, checkpoint: str, trigger: dict | None = None):
    """Starts the stream that lands ``raw`` (all fields as text) under ``base``."""
    writer = raw.writeStream.foreachBatch(lambda batch, batch_id: land_batch(batch, batch_id, base)).option("checkpointLocation", checkpoint)
    return start_stream(writer.trigger(**trigger) if trigger else writer, raw.sparkSession)


def landed_stream(spark: SparkSession, base: str, max_files: int | None = None) -> DataFrame:
    """The good rows as a stream of their own, a file after the other as batches land.

    A file shows when its batch's write is renamed into place, just before the record. Only if the
    job is killed within that rename does the replay bring rows a second time; the decisions table
    absorbs those."""
    spark.createDataFrame([], GOOD).write.mode("append").partitionBy("event_day", "batch").parquet(f"{base}/good")  # the folder
    reader = spark.readStream.schema(GOOD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(f"{base}/good").select(*TXN_COLUMNS)
