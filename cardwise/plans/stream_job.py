"""Raw transactions -> landed and quarantined rows -> keyed feature state -> decisions.

    python -m cardwise.plans.stream_job --path IN --base OUT --threshold 0.9 --model DIR --version v1

``--base`` gets ``transactions`` (good rows, quarantine, commit records), ``decisions`` (one row per
transaction) and the checkpoints of both streams. Without ``--model`` the features are written as
Parquet (``features``), or to a Kafka topic.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from cardwise.session import build_session
from cardwise.streaming.jobs import (
    features_to_kafka,
    model_scorer,
    start_stream,
    stream_decisions,
    stream_features,
    stream_transactions_files,
    stream_transactions_kafka,
)
from cardwise.streaming.landing import land_stream, landed_stream


def landed_features(spark: SparkSession, raw: DataFrame, base: str, trigger: dict, idle_ms: int | None = None, slots: int | None = None):
    """(landing stream, stream of features of the landed rows). A finite run of the landing stream
    ends here, so that the second finds all files."""
    landing = land_stream(raw, f"{base}/transactions", f"{base}/checkpoints/landing", trigger)
    if trigger.get("availableNow"):
        landing.awaitTermination()
    return landing, stream_features(landed_stream(spark, f"{base}/transactions"), idle_ms=idle_ms, slots=slots)


def score_transactions(
    spark: SparkSession, raw: DataFrame, base: str, scorer, threshold: float, version: str, trigger: dict, idle_ms: int | None = None,
    slots: int | None = None,
):
    """T8 end to end: both streams, started; ``scorer`` maps a feature batch to one with ``score``."""
    landing, features = landed_features(spark, raw, base, trigger, idle_ms, slots)
    return landing, stream_decisions(features, scorer, threshold, version, f"{base}/decisions", f"{base}/checkpoints/decisions", trigger)


def main(argv: list[str] | None = None) -> int:  # pragma: no cover - long-running service
    p = argparse.ArgumentParser(prog="cardwise-stream")
    source = p.add_mutually_exclusive_group(required=True)
    source.add_argument("--path", help="input folder of JSON files")
    source.add_argument("--bootstrap", help="Kafka servers; needs --raw-topic")
    p.add_argument("--raw-topic")
    p.add_argument("--feature-topic", help="write features there instead of to files")
    p.add_argument("--base", required=True)
    p.add_argument("--model", help="folder of a fitted model; decisions are made if given")
    p.add_argument("--threshold", type=float)
    p.add_argument("--version")
    p.add_argument("--idle-hours", type=float, default=0.0, help="event time after which an idle card is forgotten; 0 = off")
    a = p.parse_args(argv)
    spark = build_session(app_name="cardwise-stream")
    raw = stream_transactions_files(spark, a.path) if a.path else stream_transactions_kafka(spark, a.bootstrap, a.raw_topic)
    trigger, idle_ms = {"processingTime": "1 second"}, int(a.idle_hours * 3_600_000) or None
    if a.model:
        from pyspark.ml.classification import GBTClassificationModel

        scorer = model_scorer(GBTClassificationModel.load(a.model))
        score_transactions(spark, raw, a.base, scorer, a.threshold, a.version, trigger, idle_ms)
    else:
        _, features = landed_features(spark, raw, a.base, trigger, idle_ms)
        checkpoint = f"{a.base}/checkpoints/features"
        if a.feature_topic:
            features_to_kafka(features, a.bootstrap, a.feature_topic, checkpoint)
        else:
            writer = features.writeStream.format("parquet").option("path", f"{a.base}/features").option("checkpointLocation", checkpoint)
            start_stream(writer.trigger(**trigger), spark)
    spark.streams.awaitAnyTermination()
    return 0


if __name__ == "__main__":  # pragma: no cover
    raise SystemExit(main())
