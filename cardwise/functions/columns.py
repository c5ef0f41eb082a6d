"""Scalar column expressions (all JVM-side built-ins, no Python per row)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from cardwise.schema import (
    APPROVE,
    EARTH_RADIUS_KM,
    IEEE_EPOCH_MS,
    IMPOSSIBLE_KMH,
    MIN_TRAVEL_SECONDS,
    REVIEW,
    WINDOW_24H_MS,
)

_TWO_POW_64 = 18446744073709551616.0


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_na(c: Column | str) -> Column:
    """Missing or empty text becomes ``"NA"``."""
    c = _c(c)
    return F.coalesce(F.nullif(c.cast("string"), F.lit("")), F.lit("NA"))


def card_key(cols: Sequence[Column | str]) -> Column:
    """Dash-joined card/address tuple, each part ``NA`` when blank."""
    return F.concat_ws("-", *[blank_to_na(c) for c in cols])


def region_key(addr1: Column | str, addr2: Column | str) -> Column:
    """``addr1:addr2`` with ``NA`` for blanks."""
    return F.concat_ws(":", blank_to_na(addr1), blank_to_na(addr2))


def stable_unit_float(part: str, seed: Column | str) -> Column:
    """First 8 bytes of sha256("part|seed") read big-endian, divided by 2**64."""
    digest = F.sha2(F.concat(F.lit(part + "|"), _c(seed)), 256)
    return F.conv(F.substring(digest, 1, 16), 16, 10).cast("double") / F.lit(_TWO_POW_64)


def pseudo_geo(seed: Column | str) -> tuple[Column, Column]:
    """Deterministic (lat, lon) for a region key, rounded to 5 decimals."""
    lat = F.round(F.lit(-55.0) + stable_unit_float("lat", seed) * F.lit(125.0), 5)
    lon = F.round(F.lit(-170.0) + stable_unit_float("lon", seed) * F.lit(340.0), 5)
    return lat, lon


def ieee_event_ms(transaction_dt: Column | str) -> Column:
    """Epoch ms of IEEE-CIS ``TransactionDT`` seconds after 2017-12-01 UTC (truncated)."""
    secs = _c(transaction_dt).cast("double")
    return ((F.lit(IEEE_EPOCH_MS / 1000.0) + secs) * F.lit(1000.0)).cast("long")


def text_event_ms(text: Column | str) -> Column:
    """Epoch ms of a zone-less ISO timestamp read as UTC."""
    return F.unix_millis(F.to_timestamp(_c(text)))


def log_amount(amount: Column | str) -> Column:
    """``log1p(max(0, amount))``."""
    return F.log1p(F.greatest(F.lit(0.0), _c(amount)))


def hour_of_day(ts_ms: Column | str) -> Column:
    """UTC hour, computed from epoch ms so it does not depend on the session zone."""
    return F.floor(F.pmod(_c(ts_ms), F.lit(WINDOW_24H_MS)) / F.lit(3_600_000)).cast("int")


def day_of_week(ts_ms: Column | str) -> Column:
    """Monday = 0 ... Sunday = 6 (1970-01-01 was a Thursday, index 3)."""
    day = F.floor(_c(ts_ms) / F.lit(WINDOW_24H_MS))
    return F.pmod(day + F.lit(3), F.lit(7)).cast("int")


def haversine_km(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance, ``a`` clamped at 1. Null in, null out."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dlam = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dphi / 2.0), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlam / 2.0), 2)
    a = F.when(a > 1.0, F.lit(1.0)).otherwise(a)  # not least(): least() skips nulls
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(a))


def implied_kmh(distance_km: Column | str, elapsed_s: Column | str) -> Column:
    """Distance over max(elapsed, 1 s) in hours."""
    el = _c(elapsed_s)
    secs = F.when(el < MIN_TRAVEL_SECONDS, F.lit(MIN_TRAVEL_SECONDS)).otherwise(el)
    return _c(distance_km) / (secs / 3600.0)


def impossible_travel(kmh: Column | str) -> Column:
    """1.0 when the implied speed exceeds 1000 km/h."""
    return F.when(_c(kmh) > IMPOSSIBLE_KMH, 1.0).otherwise(0.0)


def decide(score: Column | str, threshold: Column | str | float) -> Column:
    """P10: REVIEW iff score >= threshold."""
    thr = F.lit(threshold) if isinstance(threshold, float | int) else _c(threshold)
    return F.when(_c(score) >= thr, F.lit(REVIEW)).otherwise(F.lit(APPROVE))


def e2e_latency_ms(scored_at: Column | str, event_ts: Column | str) -> Column:
    """Decision time minus event time in ms (may be negative)."""
    return (F.unix_micros(_c(scored_at)) - F.unix_micros(_c(event_ts))) / 1000.0


def latency_seconds_clamped(now: Column | str, event_ts: Column | str) -> Column:
    """``max(0, now - event)`` in seconds, for histograms only."""
    return F.greatest(F.lit(0.0), e2e_latency_ms(now, event_ts) / 1000.0)


def run_filter(txn_id: Column | str, prefix: str) -> Column:
    """Rows of one replay run (``txn_id`` starts with ``prefix-``); pushes down."""
    return _c(txn_id).startswith(prefix + "-")


def report_double(c: Column | str, digits: int = 6) -> Column:
    """Comparison form of a DOUBLE: ``round(x + 1e-9, digits)`` with -0 folded to 0.

    Adding 1e-9 moves exact decimal ties (sums of cents divided by powers of two) off the
    rounding boundary so two engines whose results differ by an ulp still agree.
    """
    # -0.0 + 0.0 is 0.0: with a comparison instead, each value would be rounded twice
    return F.round(_c(c).cast("double") + F.lit(1e-9), digits) + F.lit(0.0)


def report_sql(expr: str, digits: int = 6) -> str:
    """SQL text of :func:`report_double` for oracle queries."""
    r = f"round(CAST({expr} AS DOUBLE) + 1e-9, {digits})"
    return f"(CASE WHEN {r} = 0 THEN 0.0 ELSE {r} END)"
