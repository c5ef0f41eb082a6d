"""Streaming sources, the feature stream, scoring stream and sinks."""

from __future__ import annotations

import re

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwise.operators.formulas import features_from_facts
from cardwise.schema import FEATURE_ORDER, RAW_STRING_SCHEMA, TXN_COLUMNS, TXN_SCHEMA
from cardwise.session import configure
from cardwise.sources.readers import coerce_transactions
from cardwise.streaming.card_state import LEDGER_SCHEMA, TRAIL_ROWS
from cardwise.streaming.processor import FACTS_SCHEMA, CardFeatureProcessor, EventTimeCardProcessor, EventTimeSlotProcessor, SlotProcessor
from cardwise.streaming.runs import PACKED_FACTS_SCHEMA, PACKED_SCHEMA, PackedCardProcessor, pack_rows, unpack_facts

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB,
    # commit a changelog per micro-batch instead of uploading a full snapshot each time
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


def _stateful_conf(spark: SparkSession) -> None:
    configure(spark)
    # The state store coordinator lives in the streaming query manager; touching it makes
    # the stateful operator usable on batch DataFrames too.
    _ = spark.streams.active
    for key, value in STATE_CONF.items():
        if spark.conf.get(key, "") != value:
            spark.conf.set(key, value)


def stream_transactions_files(spark: SparkSession, path: str, fmt: str = "json", max_files: int = 1) -> DataFrame:
    """File stream of text-typed transactions, ``max_files`` files per micro-batch."""
    reader = spark.readStream.schema(RAW_STRING_SCHEMA).option("maxFilesPerTrigger", max_files)
    return reader.format(fmt).load(path)


def stream_transactions_kafka(spark: SparkSession, bootstrap: str, topic: str) -> DataFrame:
    """Kafka topic of JSON transactions (needs the Kafka connector on the classpath)."""
    raw = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .option("failOnDataLoss", "false")
        .load()
    )
    return raw.select(F.from_json(F.col("value").cast("string"), RAW_STRING_SCHEMA).alias("t")).select("t.*")


def typed_stream(raw: DataFrame) -> DataFrame:
    """P5 on a stream: typed rows (bad rows come from ``quarantine_stream``)."""
    return coerce_transactions(raw)[0]


def quarantine_stream(raw: DataFrame) -> DataFrame:
    """The rows that ``typed_stream`` leaves out, as text, with the reason; write them to a sink
    of their own (``drain_to_parquet``, for one)."""
    return coerce_transactions(raw)[1]


def dedupe_stream(df: DataFrame, delay: str | None = None) -> DataFrame:
    """A redelivered transaction (same txn_id) is processed once.

    By default every id is remembered (one key without payload each, in the state store) and no
    row is lost, however late. With ``delay``, ids are forgotten after that much event time and
    state stays bounded, but Spark then also discards rows older than the watermark; use it only
    where such rows may go.
    """
    if delay is None:
        return df.dropDuplicates(["txn_id"])
    ts = F.timestamp_millis(F.col("ts_ms"))
    return df.withColumn("_event_ts", ts).withWatermark("_event_ts", delay).dropDuplicatesWithinWatermark(["txn_id"]).drop("_event_ts")


#: Cards of a slot, and the slots that even few cards get, so that tasks are even.
SLOT_CARDS, MIN_SLOTS = 128, 512


def slots_for(txn: DataFrame) -> int:
    """Slots for the cards of ``txn``; the number is part of a checkpoint and cannot change later."""
    return max(MIN_SLOTS, txn.agg(F.approx_count_distinct("card_id")).first()[0] // SLOT_CARDS)


def by_state_key(rows: DataFrame, slots: int | None):
    """``rows`` grouped by the key of their state: the card, or the card's slot."""
    if slots is None:
        return rows.groupBy("card_id")
    return rows.withColumn("slot", F.pmod(F.xxhash64("card_id"), F.lit(slots)).cast("int")).groupBy("slot")


def stream_features(
    df: DataFrame,
    idle_ms: int | None = None,
    lru: bool = True,
    reset_after_ms: int | None = None,
    caps: tuple[int, int] | None = None,
    delay: str = "0 seconds",
    trail_rows: int = TRAIL_ROWS,
    slots: int | None = None,
    packed: bool = False,
) -> DataFrame:
    """27 features per transaction from keyed per-card state (stream or batch input).

    ``reset_after_ms``: event-time history reset after an idle gap (W4, same rule as the batch
    path). ``idle_ms`` (T3): the same reset, and timers clear the state of cards that have been
    idle for so long of event time, by a watermark ``delay`` behind the newest event; rows behind
    the watermark are then dropped by Spark. ``trail_rows`` (T2): rows of a card's last 24 h that
    its state value holds before older ones move into map state by minute. ``slots``: cards share
    that many state keys (many cards a micro-batch); by default each card has its own, which suits
    micro-batches with few of the cards. ``packed``: a card's rows of a micro-batch are taken
    together, as arrays (few cards with many rows each); not with ``idle_ms`` or ``slots``.
    """
    _stateful_conf(df.sparkSession)
    if packed:
        if idle_ms is not None or slots is not None:
            raise ValueError("packed rows have no event time of their own and no slot")
        return features_from_facts(packed_facts(df, PackedCardProcessor(None, lru, reset_after_ms, caps, trail_rows)))
    rows = df.select(*TXN_COLUMNS)
    if idle_ms is not None:
        rows = rows.withColumn("event_ts", F.timestamp_millis(F.col("ts_ms"))).withWatermark("event_ts", delay)
    processor = CardFeatureProcessor if slots is None else SlotProcessor
    facts = by_state_key(rows, slots).transformWithState(
        statefulProcessor=processor(idle_ms=idle_ms, lru=lru, reset_after_ms=reset_after_ms, caps=caps, trail_rows=trail_rows),
        outputStructType=FACTS_SCHEMA,
        outputMode="Append",
        timeMode="None" if idle_ms is None else "EventTime",
    )
    return features_from_facts(facts)


def packed_facts(df: DataFrame, processor: PackedCardProcessor) -> DataFrame:
    """Facts of rows that are packed by card for the state operator; as the cards may be few, the
    features of its packed facts are made in as many tasks as there are cores."""
    rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in TXN_SCHEMA])
    facts = rows.mapInArrow(pack_rows, PACKED_SCHEMA).groupBy("card_id").transformWithState(
        statefulProcessor=processor, outputStructType=PACKED_FACTS_SCHEMA, outputMode="Append", timeMode="None"
    )
    return facts.repartition(df.sparkSession.sparkContext.defaultParallelism).mapInArrow(unpack_facts, FACTS_SCHEMA)


def stream_features_event_time(
    df: DataFrame, delay: str, lru: bool = True, reset_after_ms: int | None = None, slots: int | None = None
) -> DataFrame:
    """T5: features released in event order once the watermark (max event time - ``delay``)
    passes a row; equal to a sorted replay for any arrival order within ``delay``.

    Rows behind the watermark on arrival are late and dropped by Spark. A finite input
    needs a final row beyond its last event time + delay to flush the last window.
    """
    _stateful_conf(df.sparkSession)
    rows = df.select(*TXN_COLUMNS).withColumn("event_ts", F.timestamp_millis(F.col("ts_ms"))).withWatermark("event_ts", delay)
    processor = EventTimeCardProcessor if slots is None else EventTimeSlotProcessor
    facts = by_state_key(rows, slots).transformWithState(
        statefulProcessor=processor(lru=lru, reset_after_ms=reset_after_ms),
        outputStructType=FACTS_SCHEMA,
        outputMode="Append",
        timeMode="EventTime",
    )
    return features_from_facts(facts)


def to_payload(features: DataFrame) -> DataFrame:
    """(card_id, payload) with the payload as compact JSON of ids, label and features."""
    feats = F.struct(*[F.col(n) for n in sorted(FEATURE_ORDER)]).alias("features")
    body = F.struct(F.col("card_id"), feats, F.col("label"), F.col("ts_ms"), F.col("txn_id"))
    return features.select("card_id", F.to_json(body, {"ignoreNullFields": "false"}).alias("payload"))


def read_feature_payloads(df: DataFrame) -> DataFrame:
    """Parse payload JSON back to typed feature columns."""
    schema = (
        "card_id string, features struct<" + ", ".join(f"{n}: double" for n in sorted(FEATURE_ORDER)) + ">, "
        "label int, ts_ms long, txn_id string"
    )
    p = df.select(F.from_json("payload", schema).alias("p"))
    return p.select("p.txn_id", "p.card_id", "p.ts_ms", *[F.col(f"p.features.{n}").alias(n) for n in FEATURE_ORDER], "p.label")


def features_to_kafka(features: DataFrame, bootstrap: str, topic: str, checkpoint: str, trigger: str = "1 second"):
    """K2: keyed by card, JSON value, append, checkpointed."""
    out = to_payload(features).selectExpr("CAST(card_id AS STRING) AS key", "payload AS value")
    writer = (
        out.writeStream.format("kafka")
        .option("kafka.bootstrap.servers", bootstrap)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(processingTime=trigger)
    )
    return start_stream(writer, features.sparkSession)


def upsert_decisions(batch: DataFrame, batch_id: int, target: str, day_col: str = "event_ts") -> None:
    """K3: first writer wins on txn_id; a redelivered micro-batch adds nothing.

    The table is partitioned by event day. One row per txn_id is kept within the batch
    (earliest scored_at); ids already present are removed with an anti join that reads only
    the event days occurring in the batch (partition pruning), so the cost follows the
    batch, not the table. A transaction's event day never changes, so its earlier decision
    is always in one of those days.
    """
    from pyspark.sql import Window as W

    spark = batch.sparkSession
    day = F.to_date(F.col(day_col)) if day_col in batch.columns else F.lit(None).cast("date")
    w = W.partitionBy("txn_id").orderBy("scored_at")
    fresh = (
        batch.withColumn("event_day", day)
        .withColumn("_rn", F.row_number().over(w))
        .filter("_rn = 1")
        .drop("_rn")
    )
    # Two actions follow; the batch must not run the stateful plan behind it for each of them.
    fresh = fresh.persist()
    try:
        new = fresh
        try:
            table = spark.read.parquet(target)
        except AnalysisException as e:  # the first batch: no folder yet, or one without files
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
        else:
            days = [r[0] for r in fresh.select("event_day").distinct().collect()]  # days in one micro-batch
            new = fresh.join(table.filter(F.col("event_day").isin(days)).select("txn_id"), "txn_id", "left_anti")
        new.write.mode("append").partitionBy("event_day").parquet(target)
    finally:
        fresh.unpersist()


def model_scorer(model):
    """Scoring function for :func:`stream_decisions` from a fitted model (L3)."""
    from cardwise.operators.model import score

    return lambda df: score(df, model)


def stream_decisions(features: DataFrame, scorer, threshold: float, version: str, target: str, checkpoint: str, trigger=None):
    """Score each micro-batch and upsert its decisions (at-least-once in, once in the table).

    ``scorer`` maps a feature batch to the same rows with a ``score`` column (see
    :func:`model_scorer`); ``scored_at`` is fixed once per micro-batch.
    """
    from cardwise.operators.monitor import decisions

    def run(batch: DataFrame, batch_id: int) -> None:
        upsert_decisions(decisions(scorer(batch), threshold, version), batch_id, target)

    w = features.writeStream.foreachBatch(run).option("checkpointLocation", checkpoint)
    if trigger is not None:
        w = w.trigger(**trigger)
    return start_stream(w, features.sparkSession)


def stream_decision_counts(decisions: DataFrame, target: str, checkpoint: str, delay: str = "1 hour", width: str = "1 minute", trigger=None):
    """M7, M8 on a stream: decisions per window and decision, kept up to date under ``target``.

    Each micro-batch writes the windows that changed, with their new counts, under its id; a replayed
    one overwrites them. Windows leave the state ``delay`` behind the newest decision.
    """
    from cardwise.operators.monitor import decision_counts

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("batch", F.lit(batch_id).cast("long"))
        out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(target)

    counts = decision_counts(decisions.withWatermark("scored_at", delay), width)
    w = counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint)
    return start_stream(w.trigger(**trigger) if trigger else w, decisions.sparkSession)


def streamed_counts(spark: SparkSession, target: str) -> DataFrame:
    """The newest count of each window and decision; the input of ``rate_of_counts`` and
    ``alert_rate_of_counts``."""
    newest = F.max_by("n", "batch").alias("n")
    return spark.read.parquet(target).groupBy("bucket_start", "decision").agg(newest)


def state_snapshot(spark: SparkSession, checkpoint: str, batch_id: int | None = None) -> DataFrame:
    """Per-card state of a running or stopped feature stream, read from its checkpoint (one row
    per card) without touching the query: the latest, or as of the end of a micro-batch."""
    by_slot = _by_slot(spark, checkpoint)
    reader = spark.read.format("statestore").option("stateVarName", "slot" if by_slot else "card")
    state = (reader if batch_id is None else reader.option("batchId", batch_id)).load(checkpoint)
    if not by_slot:
        return state
    cards = state.select("partition_id", F.inline(F.arrays_zip("value.cards", "value.ledgers"))).toDF("partition_id", "card_id", "ledger")
    return cards.select(F.struct("card_id").alias("key"), F.from_json("ledger", LEDGER_SCHEMA).alias("value"), "partition_id")


def _by_slot(spark: SparkSession, checkpoint: str) -> bool:
    """Whether the checkpoint's cards share state keys."""
    operators = spark.read.format("state-metadata").load(checkpoint).select("operatorProperties").distinct().collect()
    return any(re.search(r'"stateName":"slot"', r[0] or "") for r in operators)


def state_changes(spark: SparkSession, checkpoint: str, first_batch: int = 0, last_batch: int | None = None) -> DataFrame:
    """The updates and deletions of cards' state in a range of micro-batches (``batch_id``,
    ``change_type``, key and value); where cards share state keys, of whole slots."""
    variable = "slot" if _by_slot(spark, checkpoint) else "card"
    reader = spark.read.format("statestore").option("stateVarName", variable).option("readChangeFeed", "true").option("changeStartBatchId", first_batch)
    return (reader if last_batch is None else reader.option("changeEndBatchId", last_batch)).load(checkpoint)


def start_stream(writer, spark: SparkSession, state_partitions: int | None = None):
    """Start a stream whose stateful operators get ``state_partitions`` partitions (default:
    the cluster's total cores, so a micro-batch is one wave of tasks).

    The count is fixed in the checkpoint at the first start; the session setting is
    restored right after the query has captured it.
    """
    n = state_partitions or spark.sparkContext.defaultParallelism
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n))
    try:
        return writer.start()
    finally:
        spark.conf.set(key, before)


def drain_to_parquet(stream: DataFrame, base: str) -> DataFrame:
    """Run a stream over everything available now into ``base/out`` (checkpoint in
    ``base/ckpt``) and return the written table."""
    spark = stream.sparkSession
    writer = (
        stream.writeStream.format("parquet")
        .option("path", f"{base}/out")
        .option("checkpointLocation", f"{base}/ckpt")
        .trigger(availableNow=True)
    )
    start_stream(writer, spark).awaitTermination()
    return spark.read.parquet(f"{base}/out")
