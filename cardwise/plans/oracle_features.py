"""Reference SQL (DuckDB dialect) for the 27 features, written directly from the rules.

It is the independent cross-check of :func:`cardwise.operators.features.compute_features`:
plain per-card windows, no bucketing, no probes.
"""

from __future__ import annotations

from cardwise.functions.columns import report_sql
from cardwise.schema import FEATURE_ORDER

_ORDER = "ORDER BY ts_ms, txn_id"


def _range(w_ms: int, agg: str) -> str:
    return f"{agg} OVER (PARTITION BY card_id ORDER BY ts_ms RANGE BETWEEN {w_ms - 1} PRECEDING AND 1 PRECEDING)"


def _hav(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    a = (
        f"(pow(sin((radians({lat2}) - radians({lat1})) / 2.0), 2) + "
        f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin(radians({lon2} - {lon1}) / 2.0), 2))"
    )
    return f"(2.0 * 6371.0088 * asin(sqrt(CASE WHEN {a} > 1.0 THEN 1.0 ELSE {a} END)))"


def _columns() -> str:
    """The 27 features over a relation ``c`` of facts."""
    dist = _hav("p_lat", "p_lon", "lat", "lon")
    elapsed = "((ts_ms - p_ts) / 1000.0)"
    kmh = f"({dist} / ((CASE WHEN {elapsed} < 1.0 THEN 1.0 ELSE {elapsed} END) / 3600.0))"
    scale = "(CASE WHEN astd > 1e-9 THEN astd ELSE greatest(1.0, abs(amean)) END)"
    prob = "((hour_prior + 1.0) / (prior_n + 24.0))"
    feats = {
        "amount": "amount",
        "log_amount": "ln(1.0 + greatest(0.0, amount))",
        "hour_of_day": "hour",
        "day_of_week": "((floor(ts_ms / 86400000.0) + 3) % 7 + 7) % 7",
        "is_first_txn_for_card": "CASE WHEN prior_n = 0 THEN 1 ELSE 0 END",
        "velocity_1m": "r1m + tie_n",
        "velocity_1h": "r1h + tie_n",
        "velocity_24h": "r24h + tie_n",
        "amount_sum_1h": "s1h + tie_s",
        "amount_sum_24h": "s24h + tie_s",
        "amount_zscore": f"CASE WHEN an >= 2 THEN (amount - amean) / {scale} ELSE 0 END",
        "amount_ratio_to_mean": "CASE WHEN an >= 2 AND abs(amean) > 1e-9 THEN amount / amean ELSE 0 END",
        "prior_amount_mean": "CASE WHEN an >= 2 THEN amean ELSE 0 END",
        "prior_amount_std": "CASE WHEN an >= 2 THEN astd ELSE 0 END",
        "prior_txn_count": "prior_n",
        "mcc_is_new": "CASE WHEN mcc_prev IS NULL THEN 1 ELSE 0 END",
        "mcc_days_since_last_seen": "CASE WHEN mcc_prev IS NULL THEN -1.0 ELSE (ts_ms - mcc_prev) / 86400000.0 END",
        "card_distinct_mcc_count": "least(64, mcc_distinct)",
        "merchant_is_new": "CASE WHEN merchant_id = '' OR rn_mer = 1 THEN 1 ELSE 0 END",
        "seconds_since_last_txn": f"CASE WHEN p_ts IS NULL THEN -1.0 ELSE {elapsed} END",
        "distance_km_from_last": f"CASE WHEN p_ts IS NULL THEN -1.0 ELSE {dist} END",
        "implied_kmh": f"CASE WHEN p_ts IS NULL THEN 0.0 ELSE {kmh} END",
        "impossible_travel_flag": f"CASE WHEN p_ts IS NULL THEN 0 WHEN {kmh} > 1000.0 THEN 1 ELSE 0 END",
        "hour_prior_count": "hour_prior",
        "hour_probability": prob,
        "hour_deviation": f"(-ln({prob}) - ln(24.0))",
        "out_of_order_flag": "late",
    }
    return ",\n  ".join(f"{report_sql(feats[n])} AS {n}" for n in FEATURE_ORDER)


def features_sql(src: str) -> str:
    """Feature table SQL over a source query yielding the canonical columns."""
    return f"""
WITH t AS ({src}),
b AS (
  SELECT *,
    CAST(floor(((ts_ms % 86400000) + 86400000) % 86400000 / 3600000) AS INTEGER) AS hour,
    count(*) OVER (PARTITION BY card_id {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior_n,
    {_range(60000, "count(*)")} AS r1m,
    {_range(3600000, "count(*)")} AS r1h,
    {_range(86400000, "count(*)")} AS r24h,
    coalesce({_range(3600000, "sum(amount)")}, 0) AS s1h,
    coalesce({_range(86400000, "sum(amount)")}, 0) AS s24h,
    row_number() OVER (PARTITION BY card_id, ts_ms ORDER BY txn_id) - 1 AS tie_n,
    coalesce(sum(amount) OVER (PARTITION BY card_id, ts_ms ORDER BY txn_id
                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS tie_s,
    count(amount) OVER (PARTITION BY card_id {_ORDER} ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING) AS an,
    avg(amount) OVER (PARTITION BY card_id {_ORDER} ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING) AS amean,
    stddev_samp(amount) OVER (PARTITION BY card_id {_ORDER} ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING) AS astd,
    lag(ts_ms) OVER (PARTITION BY card_id, mcc {_ORDER}) AS mcc_prev,
    row_number() OVER (PARTITION BY card_id, merchant_id {_ORDER}) AS rn_mer,
    lag(ts_ms) OVER (PARTITION BY card_id {_ORDER}) AS p_ts,
    lag(lat) OVER (PARTITION BY card_id {_ORDER}) AS p_lat,
    lag(lon) OVER (PARTITION BY card_id {_ORDER}) AS p_lon
  FROM t
),
c AS (
  SELECT *,
    row_number() OVER (PARTITION BY card_id, hour {_ORDER}) - 1 AS hour_prior,
    coalesce(sum(CASE WHEN mcc_prev IS NULL THEN 1 ELSE 0 END)
             OVER (PARTITION BY card_id {_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      AS mcc_distinct
  FROM b
)
SELECT txn_id, card_id, ts_ms,
  {_columns()},
  label
FROM (SELECT *, 0.0 AS late FROM c) c
"""


def arrival_features_sql(src: str, arrival: str) -> str:
    """The same table in arrival order: facts by joins of a row with those that arrived before."""
    before = "OVER (PARTITION BY card_id ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    fifty = "OVER (PARTITION BY card_id ORDER BY r ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)"
    inside = lambda w: f"j.ts_ms > n.ts_ms - {w} AND j.ts_ms > n.p_ts - 86400000"
    return f"""
WITH t AS (SELECT *, row_number() OVER (PARTITION BY card_id ORDER BY {arrival}, ts_ms, txn_id) AS r FROM ({src}) x),
n AS (
  SELECT *, max(ts_ms) {before} AS p_ts, max(CAST(ts_ms AS HUGEINT) * 4294967296 + r) {before} % 4294967296 AS p_r,
    CAST(floor(((ts_ms % 86400000) + 86400000) % 86400000 / 3600000) AS INTEGER) AS hour,
    r - 1 AS prior_n, list(amount) {fifty} AS win,
    max(ts_ms) OVER (PARTITION BY card_id, mcc ORDER BY r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS mcc_prev,
    row_number() OVER (PARTITION BY card_id, merchant_id ORDER BY r) AS rn_mer FROM t),
m AS (
  SELECT *, row_number() OVER (PARTITION BY card_id, hour ORDER BY r) - 1 AS hour_prior, coalesce(len(win), 0) AS an, list_sum(win) / len(win) AS amean,
    CASE WHEN len(win) > 1 THEN sqrt(list_sum(list_transform(win, lambda x: pow(x - list_sum(win) / len(win), 2))) / (len(win) - 1)) END AS astd,
    coalesce(sum(CASE WHEN mcc_prev IS NULL THEN 1 ELSE 0 END) {before}, 0) AS mcc_distinct FROM n),
w AS (
  SELECT n.card_id, n.r, count(*) FILTER ({inside(60000)}) AS r1m, count(*) FILTER ({inside(3600000)}) AS r1h, count(*) FILTER ({inside(86400000)}) AS r24h,
    sum(CAST(j.amount AS DECIMAL(38,10))) FILTER ({inside(3600000)}) AS s1h, sum(CAST(j.amount AS DECIMAL(38,10))) FILTER ({inside(86400000)}) AS s24h
  FROM n JOIN t j ON j.card_id = n.card_id AND j.r < n.r GROUP BY n.card_id, n.r),
c AS (
  SELECT m.*, 0 AS tie_n, 0.0 AS tie_s, coalesce(r1m, 0) AS r1m, coalesce(r1h, 0) AS r1h, coalesce(r24h, 0) AS r24h,
    CAST(coalesce(s1h, 0) AS DOUBLE) AS s1h, CAST(coalesce(s24h, 0) AS DOUBLE) AS s24h, p.lat AS p_lat, p.lon AS p_lon,
    CASE WHEN m.ts_ms < m.p_ts THEN 1.0 ELSE 0.0 END AS late
  FROM m LEFT JOIN w ON w.card_id = m.card_id AND w.r = m.r LEFT JOIN t p ON p.card_id = m.card_id AND p.r = m.p_r)
SELECT txn_id, card_id, ts_ms,
  {_columns()},
  label
FROM c
"""
