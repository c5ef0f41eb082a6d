"""Cards that share state keys (slots): same features, few state rows, expiry, snapshots."""

import random

from pyspark.sql import functions as F

from cardwise.operators.checks import feature_parity
from cardwise.operators.features import compute_features
from cardwise.sources.views import events_txn
from cardwise.streaming.jobs import state_snapshot, stream_features, stream_features_event_time, stream_transactions_files, typed_stream
from cardwise.streaming.replay import set_arrival_order, write_flush_row, write_replay_files
from tests.conftest import SF_SMALL, T0

HOUR, DAY = 3_600_000, 86_400_000


def drain(features, base):
    w = features.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return features.sparkSession.read.parquet(f"{base}/out"), q


def replayed(spark, folder):
    return typed_stream(stream_transactions_files(spark, folder, max_files=1))


def test_slots_hold_all_cards_and_tell_the_same(spark, tmp_path):
    t = events_txn(spark, SF_SMALL)
    write_replay_files(t, f"{tmp_path}/in", 4)
    got, q = drain(stream_features(replayed(spark, f"{tmp_path}/in"), slots=3), f"{tmp_path}/run")
    assert got.count() == t.count()
    assert feature_parity(compute_features(t), got, tol=1e-9).count() == 0
    assert q.lastProgress["stateOperators"][0]["numRowsTotal"] <= 3 < t.select("card_id").distinct().count()
    want = {(r[0], r[1], r[2]) for r in t.groupBy("card_id").agg(F.count("*"), F.max("ts_ms")).collect()}
    seen = state_snapshot(spark, f"{tmp_path}/run/ckpt").select("key.card_id", "value.txn_count", "value.last_ts").collect()
    assert {tuple(r) for r in seen} == want and len(seen) == len(want)


def crowded(make_txn, cards, n, seed, step=60_000):
    rng = random.Random(seed)
    ts, rows = T0, []
    for i in range(n):
        ts += rng.choice([0, 0, 1, 900, step])
        rows.append((f"t{i:06d}", f"c{rng.randrange(cards)}", ts, round(rng.uniform(0, 500), 2), rng.choice("abc"), rng.choice(["", "m", "n"]), rng.uniform(-5, 5), 1.5))
    return make_txn(rows), ts


def test_busy_cards_of_a_slot_spill_and_expire(spark, tmp_path, make_txn):
    t, last = crowded(make_txn, 5, 1500, 3, step=HOUR // 2)
    later, _ = crowded(make_txn, 2, 40, 4)
    gap = last - T0 + 3 * DAY
    later = later.withColumn("ts_ms", F.col("ts_ms") + gap).withColumn("txn_id", F.concat(F.lit("u"), "txn_id"))
    both = t.unionByName(later)
    write_replay_files(both, f"{tmp_path}/in", 5)
    features = stream_features(replayed(spark, f"{tmp_path}/in"), idle_ms=2 * DAY, trail_rows=10, slots=2)
    got, q = drain(features, f"{tmp_path}/run")
    assert got.count() == both.count()
    assert feature_parity(compute_features(both, reset_after_ms=2 * DAY), got, tol=1e-9).count() == 0
    kept = state_snapshot(spark, f"{tmp_path}/run/ckpt").select("key.card_id", "value.txn_count").collect()
    assert {tuple(r) for r in kept} == {tuple(r) for r in later.groupBy("card_id").agg(F.count("*")).collect()}
    for name in ("minutes", "parts"):  # nothing of the forgotten cards is left
        held = spark.read.format("statestore").option("stateVarName", name).load(f"{tmp_path}/run/ckpt")
        assert {r[0] for r in held.select("user_map_key.card_id").distinct().collect()} <= {"c0", "c1"}


def test_event_time_slots_wait_for_the_watermark(spark, tmp_path, make_txn):
    t, last = crowded(make_txn, 40, 1200, 5)
    names = write_replay_files(t, f"{tmp_path}/in", 6)
    set_arrival_order(spark, names, [1, 0, 3, 2, 5, 4])
    write_flush_row(spark, f"{tmp_path}/in", last + 30 * DAY, 10)
    stream = replayed(spark, f"{tmp_path}/in")
    got, _ = drain(stream_features_event_time(stream, "90 minutes", slots=4), f"{tmp_path}/run")
    assert got.count() == t.count()
    assert feature_parity(compute_features(t), got, tol=1e-9).count() == 0


def test_windows_of_a_busy_card_are_counted_once_a_minute():
    from cardwise.streaming.card_state import CardLedger, Minutes, Recency

    class Counted(Minutes):
        edges_made = 0

        def edge(self, minute):
            Counted.edges_made += 1
            return super().edge(minute)

    rng, ts = random.Random(9), T0
    plain, busy = CardLedger(trail_rows=10**9), CardLedger(trail_rows=64)
    busy.minutes = Counted(busy.minutes.store)
    for _ in range(6000):
        ts += rng.randrange(0, 2600)
        row = {"ts_ms": ts, "amount": round(rng.uniform(0, 500), 2), "mcc": "a", "merchant_id": str(rng.randrange(300)), "lat": 1.0, "lon": 2.0}
        assert busy.take(row) == plain.take(row)
    assert busy.spilled and 0 < Counted.edges_made < 6000  # three windows a row ask for 18,000

    kept, used = Recency(5), {}
    for _ in range(4000):
        key, at = str(rng.randrange(12)), rng.randrange(900)
        kept.use(key, at)
        used[key] = max(at, used.get(key, at))
        if len(used) > 5:
            del used[min(used, key=lambda k: (used[k], k))]
        assert kept.latest == used
    assert len(kept.order) <= 8 * 6 + 1
