"""Temporal split (A5), its check (A6) and dataset / replay summaries (A1-A4)."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwise.operators.ordered import global_lag, global_rank, order_statistics


def split_cutoffs(df: DataFrame, train_frac: float = 0.7, valid_frac: float = 0.15) -> tuple[object, object, int]:
    """Event-time cut points of the temporal split.

    With rows in (ts_ms, txn_id) order, train is the first ``int(n * train_frac)`` rows
    pushed forward until the time changes, i.e. every row with ``ts_ms`` <= the k-th smallest
    time; the same for train+valid. Returns ``(train_max_ts, valid_max_ts, n)`` where a None
    cut means "no rows".
    """
    n = df.count()
    k_train = int(n * train_frac)
    k_valid = int(n * (train_frac + valid_frac))
    stats = order_statistics(df, "ts_ms", [k for k in (k_train, k_valid) if 0 < k <= n], tiebreak=("txn_id",))
    cut_t = stats.get(k_train) if k_train > 0 else None
    cut_v = stats.get(k_valid) if k_valid > 0 else None
    if k_train >= n:
        cut_t = math.inf
    if k_valid >= n:
        cut_v = math.inf
    return cut_t, cut_v, n


def temporal_split(
    df: DataFrame, train_frac: float = 0.7, valid_frac: float = 0.15
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A5: (train, valid, test) by event time; equal times never straddle a cut."""
    cut_t, cut_v, _ = split_cutoffs(df, train_frac, valid_frac)
    return split_by_cutoffs(df, cut_t, cut_v)


def _le(cut):
    if cut is None:
        return F.lit(False)
    if cut == math.inf:
        return F.lit(True)
    return F.col("ts_ms") <= F.lit(cut)


def split_by_cutoffs(df: DataFrame, cut_t, cut_v) -> tuple[DataFrame, DataFrame, DataFrame]:
    in_t, in_v = _le(cut_t), _le(cut_v)
    return df.filter(in_t), df.filter(~in_t & in_v), df.filter(~in_v)


def split_label(df: DataFrame, train_frac: float = 0.7, valid_frac: float = 0.15) -> DataFrame:
    """``df`` with a ``split`` column (train / valid / test)."""
    cut_t, cut_v, _ = split_cutoffs(df, train_frac, valid_frac)
    in_t, in_v = _le(cut_t), _le(cut_v)
    return df.withColumn("split", F.when(in_t, "train").when(in_v, "valid").otherwise("test"))


def split_check(labelled: DataFrame) -> DataFrame:
    """Per-split size and time range, plus whether the order and sizes hold.

    One row: ``n_train, n_valid, n_test, n, ordered`` where ordered means
    train.max < valid.min and valid.max < test.min (empty splits ignored).
    """
    s = labelled.groupBy().agg(
        F.count_if(F.col("split") == "train").alias("n_train"),
        F.count_if(F.col("split") == "valid").alias("n_valid"),
        F.count_if(F.col("split") == "test").alias("n_test"),
        F.count(F.lit(1)).alias("n"),
        F.max(F.when(F.col("split") == "train", F.col("ts_ms"))).alias("train_max"),
        F.min(F.when(F.col("split") == "valid", F.col("ts_ms"))).alias("valid_min"),
        F.max(F.when(F.col("split") == "valid", F.col("ts_ms"))).alias("valid_max"),
        F.min(F.when(F.col("split") == "test", F.col("ts_ms"))).alias("test_min"),
    )
    ok1 = F.coalesce(F.col("train_max") < F.coalesce(F.col("valid_min"), F.col("test_min")), F.lit(True))
    ok2 = F.coalesce(F.col("valid_max") < F.col("test_min"), F.lit(True))
    return s.select(
        "n_train",
        "n_valid",
        "n_test",
        "n",
        (ok1 & ok2 & (F.col("n_train") + F.col("n_valid") + F.col("n_test") == F.col("n"))).alias("ordered"),
    )


def dataset_summary(df: DataFrame) -> DataFrame:
    """A1: rows, distinct cards, label rate."""
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("card_id").alias("cards"),
        F.avg("label").alias("fraud_rate"),
    )


def replay_summary(df: DataFrame, speedup: float = 100.0) -> DataFrame:
    """A2: rows, label rate, event-time span (hours) and replay time at ``speedup`` (minutes)."""
    span_s = (F.max("ts_ms") - F.min("ts_ms")) / 1000.0
    return df.agg(
        F.count(F.lit(1)).alias("rows"),
        (F.count_if(F.col("label") == 1) / F.count(F.lit(1))).alias("fraud_rate"),
        (span_s / 3600.0).alias("span_hours"),
        (span_s / F.lit(max(speedup, 1e-9)) / 60.0).alias("projected_minutes"),
    )


def replay_schedule(df: DataFrame, speedup: float = 100.0, max_sleep: float = 5.0) -> DataFrame:
    """A3: publish offset (s) of each row when replayed in event order.

    A row waits ``min(gap / speedup, max_sleep)`` after the previous row when the gap is
    positive; the offset is the running total (partition-parallel prefix sum).
    """
    order = ["ts_ms", "txn_id"]
    lagged = global_lag(df.select("txn_id", "ts_ms"), order, "ts_ms", "_prev_ts")
    gap = (F.col("ts_ms") - F.col("_prev_ts")) / 1000.0 / F.lit(speedup)
    sleep = F.when(F.col("_prev_ts").isNull() | (gap <= 0), 0.0).otherwise(F.least(gap, F.lit(max_sleep)))
    ranked = global_rank(lagged.withColumn("sleep_s", sleep), order, sums=("sleep_s",))
    return ranked.select("txn_id", "ts_ms", F.col("_rank").alias("seq"), "sleep_s", F.col("cum_sleep_s").alias("offset_s"))


def first_n(df: DataFrame, n: int) -> DataFrame:
    """A4: the first ``n`` rows in event order (a top-k, not a global sort)."""
    return df.orderBy("ts_ms", "txn_id").limit(n)
