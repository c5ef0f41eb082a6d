"""Offline dataset — read a source, compute the features, write the feature table."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from cardwise.operators.features import compute_features
from cardwise.operators.split import dataset_summary
from cardwise.session import build_session, release_persisted
from cardwise.sources.readers import read_transactions
from cardwise.sources.sinks import write_features


def build_dataset(spark: SparkSession, kind: str, path: str, out: str) -> DataFrame:
    """Features for every transaction of a dataset, written partitioned by event day.

    Returns the feature table read back from ``out`` (a lineage cut: later stages restart
    from the written table, not from the source scan).
    """
    feats = compute_features(read_transactions(spark, kind, path))
    write_features(feats, out)
    release_persisted()  # the written table replaces the cached bucket layout
    return spark.read.parquet(out)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="cardwise-build-dataset")
    p.add_argument("--dataset", default="ieee", choices=["ieee", "sparkov", "normalized"])
    p.add_argument("--path", required=True)
    p.add_argument("--out", required=True)
    a = p.parse_args(argv)
    spark = build_session(app_name="cardwise-build-dataset")
    table = build_dataset(spark, a.dataset, a.path, a.out)
    dataset_summary(table).show(truncate=False)
    return 0


if __name__ == "__main__":  # pragma: no cover
    raise SystemExit(main())
