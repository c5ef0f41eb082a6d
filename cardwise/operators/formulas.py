"""The 27 features as column expressions over facts about a card's earlier rows.

Both paths end here: windows (:mod:`cardwise.operators.features`) and keyed state
(:mod:`cardwise.streaming.processor`) only differ in how they find the facts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwise.functions.columns import (
    day_of_week,
    haversine_km,
    hour_of_day,
    implied_kmh,
    impossible_travel,
    log_amount,
)
from cardwise.schema import FEATURE_ORDER, HOUR_SMOOTHING, NEVER_SEEN


def flag(condition: Column) -> Column:
    return F.when(condition, 1.0).otherwise(0.0)


def amount_features(amount: Column, n: Column, mean: Column, spread: Column) -> dict[str, Column]:
    """Anomaly of an amount against the last ``n`` (``spread``: sum of squared deviations)."""
    enough = n >= 2
    std = F.sqrt(F.try_divide(spread, (n - 1).cast("double")))
    scale = F.when(std > 1e-9, std).otherwise(F.greatest(F.lit(1.0), F.abs(mean)))
    return {
        "amount_zscore": F.when(enough, (amount - mean) / scale).otherwise(0.0),
        "amount_ratio_to_mean": F.when(enough & (F.abs(mean) > 1e-9), amount / mean).otherwise(0.0),
        "prior_amount_mean": F.when(enough, mean).otherwise(0.0),
        "prior_amount_std": F.when(enough, std).otherwise(0.0),
    }


def travel_features(ts: Column, lat: Column, lon: Column, last: tuple[Column, Column, Column]) -> dict[str, Column]:
    last_ts, last_lat, last_lon = last
    placed = last_ts.isNotNull() & last_lat.isNotNull() & last_lon.isNotNull()
    elapsed = (ts - last_ts) / 1000.0
    km = haversine_km(last_lat, last_lon, lat, lon)
    kmh = implied_kmh(km, elapsed)
    return {
        "seconds_since_last_txn": F.when(placed, elapsed).otherwise(NEVER_SEEN),
        "distance_km_from_last": F.when(placed, km).otherwise(NEVER_SEEN),
        "implied_kmh": F.when(placed, kmh).otherwise(0.0),
        "impossible_travel_flag": F.when(placed, impossible_travel(kmh)).otherwise(0.0),
        "out_of_order_flag": flag(ts < last_ts),
    }


def hour_features(hour_prior: Column, prior_n: Column) -> dict[str, Column]:
    share = (hour_prior.cast("double") + HOUR_SMOOTHING) / (prior_n.cast("double") + HOUR_SMOOTHING * 24.0)
    return {
        "hour_prior_count": hour_prior,
        "hour_probability": share,
        "hour_deviation": -F.log(share) - F.log(F.lit(24.0)),
    }


def features_from_facts(d: DataFrame) -> DataFrame:
    """Ids, the 27 features in order and the label, from a row's own columns and its facts."""
    c = F.col
    prior_n, amount, seen = c("prior_n"), c("amount"), c("mcc_prev_ts")
    named = {
        "amount": amount,
        "log_amount": log_amount(amount),
        "hour_of_day": hour_of_day("ts_ms"),
        "day_of_week": day_of_week("ts_ms"),
        "is_first_txn_for_card": flag(prior_n == 0),
        "prior_txn_count": prior_n,
        "velocity_1m": c("vel_p1m"),
        "velocity_1h": c("vel_p1h"),
        "velocity_24h": c("vel_p24h"),
        "amount_sum_1h": c("sum_p1h"),
        "amount_sum_24h": c("sum_p24h"),
        "mcc_is_new": flag(seen.isNull()),
        "mcc_days_since_last_seen": F.when(seen.isNull(), NEVER_SEEN).otherwise((c("ts_ms") - seen) / 86_400_000.0),
        "card_distinct_mcc_count": c("mcc_known"),
        "merchant_is_new": flag(~c("merchant_known")),
        **amount_features(amount, c("amt_n"), c("amt_mean"), c("amt_spread")),
        **travel_features(c("ts_ms"), c("lat"), c("lon"), (c("last_ts"), c("last_lat"), c("last_lon"))),
        **hour_features(c("hour_prior"), prior_n),
    }
    columns = [named[name].cast("double").alias(name) for name in FEATURE_ORDER]
    return d.select("txn_id", "card_id", "ts_ms", *columns, "label")
