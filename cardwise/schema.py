"""Typed schemas and the fixed constants every operator shares.

The canonical transaction has nine columns; features add 27 DOUBLE columns in a
fixed order. That order is the one column-order contract of the whole library:
feature tables are written in it and model vectors are assembled from it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# fixed values: column names of a transaction
TXN_SCHEMA = T.StructType(
    [
        T.StructField("txn_id", T.StringType(), False),
        T.StructField("card_id", T.StringType(), False),
        T.StructField("ts_ms", T.LongType(), False),
        T.StructField("amount", T.DoubleType(), False),
        T.StructField("mcc", T.StringType(), False),
        T.StructField("merchant_id", T.StringType(), False),
        T.StructField("lat", T.DoubleType(), False),
        T.StructField("lon", T.DoubleType(), False),
        T.StructField("label", T.IntegerType(), True),
    ]
)
TXN_COLUMNS = tuple(f.name for f in TXN_SCHEMA.fields)

# Wire form of a streamed transaction: every field arrives as text.
RAW_STRING_SCHEMA = T.StructType([T.StructField(f.name, T.StringType(), True) for f in TXN_SCHEMA.fields])

# --- fixed values (must equal the original pipeline's feature contract) ----------------------
# Feature names in model-input order.
FEATURE_ORDER: tuple[str, ...] = (
    "amount",
    "log_amount",
    "hour_of_day",
    "day_of_week",
    "is_first_txn_for_card",
    "velocity_1m",
    "velocity_1h",
    "velocity_24h",
    "amount_sum_1h",
    "amount_sum_24h",
    "amount_zscore",
    "amount_ratio_to_mean",
    "prior_amount_mean",
    "prior_amount_std",
    "prior_txn_count",
    "mcc_is_new",
    "mcc_days_since_last_seen",
    "card_distinct_mcc_count",
    "merchant_is_new",
    "seconds_since_last_txn",
    "distance_km_from_last",
    "implied_kmh",
    "impossible_travel_flag",
    "hour_prior_count",
    "hour_probability",
    "hour_deviation",
    "out_of_order_flag",
)
# Window lengths (ms), amount-history length, memory caps, physical constants.
WINDOW_1M_MS = 60_000
WINDOW_1H_MS = 3_600_000
WINDOW_24H_MS = 86_400_000
AMOUNT_WINDOW = 50
MAX_MCC = 64
MAX_MERCHANTS = 128
IMPOSSIBLE_KMH = 1000.0
MIN_TRAVEL_SECONDS = 1.0
HOUR_SMOOTHING = 1.0
NEVER_SEEN = -1.0
EARTH_RADIUS_KM = 6371.0088
STATE_VERSION = 1
# Epoch of the IEEE-CIS TransactionDT offset: 2017-12-01T00:00:00Z in ms.
IEEE_EPOCH_MS = 1_512_086_400_000
# Decision labels and the default review budgets of the evaluation report.
APPROVE = "APPROVE"
REVIEW = "REVIEW"
DEFAULT_BUDGETS = (0.001, 0.005, 0.01, 0.05)
COST_CURVE_POINTS = 200
# --------------------------------------------------------------------------------------------

FEATURE_TABLE_COLUMNS = ("txn_id", "card_id", "ts_ms", *FEATURE_ORDER, "label")

# fixed values: column names of a decision
DECISION_SCHEMA = T.StructType(
    [
        T.StructField("txn_id", T.StringType(), False),
        T.StructField("card_id", T.StringType(), False),
        T.StructField("event_ts", T.TimestampType(), False),
        T.StructField("score", T.DoubleType(), False),
        T.StructField("threshold", T.DoubleType(), False),
        T.StructField("decision", T.StringType(), False),
        T.StructField("label", T.ShortType(), True),
        T.StructField("model_version", T.StringType(), False),
        T.StructField("scored_at", T.TimestampType(), False),
        T.StructField("latency_ms", T.DoubleType(), False),
    ]
)


@dataclass(frozen=True)
class CostModel:
    """Cost of a false positive, share of a missed fraud's amount lost, fixed cost per miss."""

    # fixed values: default costs
    false_positive_cost: float = 150.0
    chargeback_loss_fraction: float = 1.0
    chargeback_fixed_cost: float = 500.0
