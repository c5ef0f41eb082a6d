"""Hand fixtures per feature, one card; every check runs on both the window path (W1) and
the keyed state used by the stream (so the two are pinned to the same rules)."""

import math

import pytest
from pyspark.sql import functions as F

from cardwise.operators.features import compute_features
from cardwise.operators.formulas import features_from_facts
from cardwise.streaming.card_state import CardLedger
from cardwise.streaming.jobs import stream_features
from cardwise.schema import FEATURE_ORDER
from cardwise.streaming.processor import FACTS_SCHEMA
from tests.conftest import T0

BLR = (12.97, 77.59)
DEL = (28.61, 77.21)


def _feats(make_txn, spec):
    rows = compute_features(make_txn(spec)).orderBy("ts_ms", "txn_id").collect()
    return [r.asDict() for r in rows]


def _both(make_txn, spec):
    a = _feats(make_txn, spec)
    b = [r.asDict() for r in stream_features(make_txn(spec)).orderBy("ts_ms", "txn_id").collect()]
    assert len(a) == len(b) == len(spec)
    for x, y in zip(a, b):
        for k in FEATURE_ORDER:
            assert math.isclose(x[k], y[k], rel_tol=1e-12, abs_tol=1e-12), (k, x[k], y[k])
    return a


def _row(i, off_ms, amount=10.0, mcc="A", merchant="m1", geo=BLR):
    return (f"t{i:03d}", "c1", T0 + off_ms, amount, mcc, merchant, geo[0], geo[1])


def test_velocity_windows(make_txn):
    offs = [0, 30_000, 90_000, 7_200_000, 9_000_000, 10_800_000]
    f = _both(make_txn, [_row(i, o) for i, o in enumerate(offs)])
    assert (f[-1]["velocity_1m"], f[-1]["velocity_1h"], f[-1]["velocity_24h"]) == (0.0, 1.0, 5.0)
    assert f[2]["velocity_1h"] == 2.0


@pytest.mark.parametrize("gap,expected", [(60_000, 0.0), (59_999, 1.0)])
def test_window_boundary(make_txn, gap, expected):
    f = _both(make_txn, [_row(0, 0), _row(1, gap)])
    assert f[1]["velocity_1m"] == expected


def test_24h_exit(make_txn):
    f = _both(make_txn, [_row(0, 0), _row(1, 25 * 3_600_000)])
    assert f[1]["velocity_24h"] == 0.0 and f[1]["prior_txn_count"] == 1.0


def test_same_ms_ties_use_txn_id(make_txn):
    f = _both(make_txn, [_row(1, 5), _row(0, 5), _row(2, 5)])
    assert [r["txn_id"] for r in f] == ["t000", "t001", "t002"]
    assert [r["velocity_1m"] for r in f] == [0.0, 1.0, 2.0]
    assert [r["prior_txn_count"] for r in f] == [0.0, 1.0, 2.0]


def test_flat_history_zscore(make_txn):
    spec = [_row(i, i * 60_000, 100.0) for i in range(4)] + [_row(4, 4 * 60_000, 400.0)]
    f = _both(make_txn, spec)
    last = f[-1]
    assert last["prior_amount_mean"] == 100.0 and last["prior_amount_std"] == 0.0
    assert last["amount_zscore"] == 3.0 and last["amount_ratio_to_mean"] == 4.0


def test_amount_window_is_last_50_across_days(make_txn):
    # 60 rows spread over 6 days: the 50-row history crosses bucket boundaries
    spec = [_row(i, i * 3 * 3_600_000, float(i)) for i in range(60)]
    f = _both(make_txn, spec)
    assert f[-1]["prior_amount_mean"] == pytest.approx(sum(range(9, 59)) / 50)


def test_mcc_novelty(make_txn):
    day = 86_400_000
    f = _both(make_txn, [_row(0, 0, mcc="A"), _row(1, day, mcc="B"), _row(2, 2 * day, mcc="A")])
    assert [r["mcc_is_new"] for r in f] == [1.0, 1.0, 0.0]
    assert [r["mcc_days_since_last_seen"] for r in f] == [-1.0, -1.0, 2.0]
    assert [r["card_distinct_mcc_count"] for r in f] == [0.0, 1.0, 2.0]


def test_merchant_novelty_and_empty_merchant(make_txn):
    day = 86_400_000
    spec = [_row(0, 0, merchant="x"), _row(1, 3 * day, merchant="x"), _row(2, 4 * day, merchant=""), _row(3, 5 * day, merchant="")]
    f = _both(make_txn, spec)
    assert [r["merchant_is_new"] for r in f] == [1.0, 0.0, 1.0, 1.0]


@pytest.mark.parametrize("gap,flag", [(60_000, 1.0), (6 * 3_600_000, 0.0), (0, 1.0)])
def test_travel(make_txn, gap, flag):
    f = _both(make_txn, [_row(0, 0, geo=BLR), _row(1, gap, geo=DEL)])
    assert f[0]["seconds_since_last_txn"] == -1.0 and f[0]["distance_km_from_last"] == -1.0
    assert f[1]["impossible_travel_flag"] == flag
    assert math.isfinite(f[1]["implied_kmh"])


def test_hour_deviation(make_txn):
    day = 86_400_000
    spec = [_row(i, i * day) for i in range(10)] + [_row(10, 10 * day + 7 * 3_600_000)]
    f = _both(make_txn, spec)
    assert f[9]["hour_prior_count"] == 9.0 and f[9]["hour_deviation"] < 0
    assert f[10]["hour_prior_count"] == 0.0 and f[10]["hour_deviation"] > 0


def _wire(ts, mcc="A", merchant="m", lat=0.0, lon=0.0):
    return {"ts_ms": ts, "amount": 1.0, "mcc": mcc, "merchant_id": merchant, "lat": lat, "lon": lon}


def test_late_row_in_arrival_mode_does_not_rewind(spark):
    ledger = CardLedger()
    ledger.take(_wire(T0 + 600_000))
    told = ledger.take(_wire(T0, lat=5.0, lon=5.0))
    row = spark.createDataFrame([("t", "c", T0, 1.0, 5.0, 5.0, None, *told)], FACTS_SCHEMA)
    f = features_from_facts(row).first()
    assert f["out_of_order_flag"] == 1.0 and f["velocity_1m"] == 1.0
    assert ledger.place == (T0 + 600_000, 0.0, 0.0)
    assert ledger.trail.times == [T0, T0 + 600_000] and ledger.trail.since(T0) == (1, 1.0)


def test_state_version_cold_start():
    ledger = CardLedger()
    ledger.take(_wire(T0))
    kept = ledger.stored()
    assert CardLedger(stored=kept).rows == 1 and CardLedger(stored=kept).stored() == kept
    assert CardLedger(stored=(999, *kept[1:])).rows == 0


def test_lru_caps_evict_least_recent():
    ledger = CardLedger()
    for i in range(70):
        ledger.take(_wire(T0 + i, mcc=f"m{i:02d}", merchant=""))
    assert len(ledger.mccs) == 64 and ledger.mccs.when("m00") is None and ledger.mccs.when("m69") is not None


def test_repeated_delivery_is_two_rows(make_txn):
    f = _both(make_txn, [_row(0, 0), _row(1, 1_000), _row(1, 1_000), _row(2, 2_000)])
    assert [r["velocity_1m"] for r in f] == [0.0, 1.0, 2.0, 3.0]
    assert [r["amount_sum_1h"] for r in f] == [0.0, 10.0, 20.0, 30.0]


def test_null_place_is_kept(make_txn):
    def unplaced(spec):
        return make_txn(spec).withColumn("lat", F.when(F.col("txn_id") != "t000", F.col("lat")))

    f = _both(unplaced, [_row(0, 0), _row(1, 1_000), _row(2, 2_000)])
    assert [r["seconds_since_last_txn"] for r in f] == [-1.0, -1.0, 1.0]


def test_bucket_width_does_not_change_values(make_txn):
    spec = [_row(i, i * 5 * 3_600_000 + (i % 3), float(i % 7), mcc="AB"[i % 2]) for i in range(80)]
    a = compute_features(make_txn(spec)).orderBy("txn_id").collect()
    b = compute_features(make_txn(spec), bucket_ms=3 * 86_400_000).orderBy("txn_id").collect()
    assert [r.asDict() for r in a] == [r.asDict() for r in b]


def test_fine_buckets_and_hot_cards_do_not_change_values(make_txn):
    spec = [_row(i, i * 37 * 60_000 + (i % 3), float(i % 11), mcc="ABC"[i % 3], merchant=f"m{i % 5}") for i in range(150)]
    spec += [(f"u{i:03d}", "c2", T0 + i * 3 * 3_600_000, 5.0, "A", "z", 1.0, 1.0) for i in range(40)]
    base = compute_features(make_txn(spec), hot_rows=None).orderBy("txn_id").collect()
    fine = compute_features(make_txn(spec), bucket_ms=3_600_000, hot_rows=None).orderBy("txn_id").collect()
    hot = compute_features(make_txn(spec), hot_rows=100, hot_bucket_ms=2 * 3_600_000).orderBy("txn_id").collect()
    assert [r.asDict() for r in base] == [r.asDict() for r in fine] == [r.asDict() for r in hot]


def test_lru_overflow_guard(make_txn):
    from cardwise.operators.features import lru_overflow_cards

    spec = [_row(i, i * 1000, mcc=f"M{i:03d}") for i in range(70)] + [
        (f"u{i:03d}", "c2", T0 + i, 1.0, "A", "m", 0.0, 0.0) for i in range(5)
    ]
    rows = lru_overflow_cards(make_txn(spec)).collect()
    assert [(r["card_id"], r["distinct_mcc"]) for r in rows] == [("c1", 70)]


def test_cards_in_one_bucket_and_by_day_have_the_same_features(spark):
    """Cards below ``dense_rows`` are one bucket, one of them on both sides of time 0; nothing changes."""
    from cardwise.operators.checks import feature_parity
    from cardwise.operators.features import WHOLE_MS, card_widths
    from cardwise.sources.views import events_txn
    from tests.conftest import SF_SMALL

    t = events_txn(spark, SF_SMALL)
    first = t.agg(F.min("card_id")).first()[0]
    middle = t.where(F.col("card_id") == first).agg(F.percentile_approx("ts_ms", 0.5)).first()[0]
    t = t.withColumn("ts_ms", F.when(F.col("card_id") == first, F.col("ts_ms") - middle).otherwise(F.col("ts_ms")))
    n = sorted(r[0] for r in t.groupBy("card_id").count().select("count").collect())
    dense = n[len(n) // 2]
    width, widths = card_widths(t, None, dense, None, 3_600_000)
    assert width == WHOLE_MS and 0 < widths.count() < len(n)
    t = t.withColumn("amount", F.when(F.col("txn_id").cast("long") % 97 != 0, F.col("amount")))
    want = compute_features(t, bucket_ms=86_400_000, hot_rows=None, caps=(2, 3))
    got = compute_features(t, dense_rows=dense, caps=(2, 3))
    assert got.count() == t.count() and feature_parity(want, got).count() == 0


def test_payload_filter_stays_above_the_written_features(spark):
    from cardwise.plans import catalog
    from tests.conftest import SF_SMALL

    plan = catalog.queries()["features_payload_round_trip"](spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "Window" not in plan and "aggregate(" not in plan
