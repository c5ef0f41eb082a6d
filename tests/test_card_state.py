"""Keyed state: spilled minutes, bounded writes, idle timers, layouts, warm start."""

import random

import pytest
from pyspark.sql import functions as F

from cardwise.operators.checks import feature_parity
from cardwise.operators.features import compute_features
from cardwise.sources.views import events_txn
from cardwise.streaming.card_state import SPILLED_VERSION, CardLedger, Held, Minutes
from tests.conftest import SF_SMALL, T0

MINUTE, HOUR, DAY = 60_000, 3_600_000, 86_400_000


def row(ts, amount):
    return {"ts_ms": ts, "amount": amount, "mcc": "a", "merchant_id": "m", "lat": 1.0, "lon": 2.0}


class Kept:
    """A state store in memory that counts what a batch writes."""

    def __init__(self):
        self.minutes, self.parts, self.spill, self.card = {}, {}, None, None

    def open(self, trail_rows):
        self.held = Held(self.minutes.get, lambda m, p: self.parts[m, p])
        minutes = Minutes(self.held, *self.spill) if self.card and self.card[0] == SPILLED_VERSION else Minutes(self.held)
        return CardLedger(stored=self.card, minutes=minutes, trail_rows=trail_rows)

    def close(self, ledger):
        for key in self.held.dropped_parts:
            self.parts.pop(key, None)
        numbers = 0
        for key in self.held.changed_parts:
            self.parts[key] = self.held.parts[key]
            numbers += len(self.parts[key][0])
        for m in self.held.changed_minutes:
            if self.held.minutes[m] is None:
                self.minutes.pop(m, None)
            else:
                self.minutes[m] = self.held.minutes[m]
        self.spill = (ledger.minutes.before, [(h, *v) for h, v in ledger.minutes.hours.items()])
        self.card = ledger.stored()
        return numbers + len(self.card[7]) + 3 * len(self.spill[1])


@pytest.mark.parametrize("late", [0, 5])
def test_spilled_minutes_tell_the_same_facts(late):
    rng = random.Random(7)
    ts = T0
    rows = []
    for _ in range(6000):
        ts += rng.choice([0, 1, 900, 7_000, 40_000, 40_000])
        back = rng.randrange(0, 30 * HOUR) if late and rng.randrange(late) == 0 else 0
        rows.append(row(ts - back, round(rng.uniform(-5, 500), 2)))
    plain, kept = CardLedger(trail_rows=10**9), Kept()
    sizes = []
    for at in range(0, len(rows), 50):
        ledger = kept.open(trail_rows=40)
        for r in rows[at : at + 50]:
            assert ledger.take(r) == plain.take(r)
        sizes.append(kept.close(ledger))
    assert plain.trail.times and ledger.spilled and len(ledger.trail.times) <= 40
    assert max(ts for ts, _ in kept.parts) and len(kept.minutes) <= 25 * 60
    # a batch of 50 rows writes the parts it adds to, not the day
    assert max(sizes) <= 40 + 75 + 50 + 2 * 50 * 8 and len(plain.trail.times) > 1000


def test_one_minute_with_all_rows():
    plain, kept = CardLedger(trail_rows=10**9), Kept()
    for at in range(0, 3000, 100):
        ledger = kept.open(trail_rows=40)
        for i in range(at, at + 100):
            assert ledger.take(row(T0 + i % 7, 1.5)) == plain.take(row(T0 + i % 7, 1.5))
        written = kept.close(ledger)
        assert written <= 256 + 100 + 40 + 80
    assert ledger.take(row(T0 + 2 * DAY, 1.0)) == plain.take(row(T0 + 2 * DAY, 1.0))
    kept.close(ledger)
    assert not kept.minutes and not kept.parts  # whole hours are gone


def start(spark, folder, features, base):
    q = features.writeStream.format("parquet").option("path", f"{base}/out").option("checkpointLocation", f"{base}/ckpt")
    q.trigger(availableNow=True).start().awaitTermination()
    return spark.read.parquet(f"{base}/out")


def test_first_layout_goes_on_in_the_second(spark, tmp_path):
    """A checkpoint written without any map state is continued by the processor that spills."""
    from cardwise.operators.formulas import features_from_facts
    from cardwise.schema import TXN_COLUMNS
    from cardwise.streaming.jobs import stream_features, stream_transactions_files, typed_stream
    from cardwise.streaming.processor import FACTS_SCHEMA, CardProcessor
    from cardwise.streaming.card_state import LEDGER_SCHEMA
    from cardwise.streaming.replay import write_replay_files

    class First(CardProcessor):
        def init(self, handle):
            self.card = handle.getValueState("card", LEDGER_SCHEMA)

        def handleInputRows(self, key, rows, timerValues):
            from cardwise.streaming.processor import Facts

            stored = self.card.get()
            ledger = CardLedger(self.caps, None if stored is None else tuple(stored), trail_rows=10**9)
            for r in sorted(rows, key=lambda r: (r["ts_ms"], r["txn_id"])):
                yield Facts(r["txn_id"], key[0], r["ts_ms"], r["amount"], r["lat"], r["lon"], r["label"], *ledger.take(r))
            self.card.update(ledger.stored())

    t = events_txn(spark, SF_SMALL).withColumn("card_id", F.lit("one"))
    folder, base = str(tmp_path / "in"), str(tmp_path / "run")
    names = write_replay_files(t, f"{tmp_path}/all", 6)
    import shutil
    from pathlib import Path

    Path(folder).mkdir()
    local = [Path(n.removeprefix("file:")) for n in names]
    for n in local[:3]:
        shutil.copy2(n, folder)
    stream = lambda: typed_stream(stream_transactions_files(spark, folder, max_files=1)).select(*TXN_COLUMNS)
    stream_features(events_txn(spark, SF_SMALL).limit(0))  # state store settings
    facts = stream().groupBy("card_id").transformWithState(statefulProcessor=First(), outputStructType=FACTS_SCHEMA, outputMode="Append", timeMode="None")
    start(spark, folder, features_from_facts(facts), base)
    for n in local[3:]:
        shutil.copy2(n, folder)
    got = start(spark, folder, stream_features(stream(), trail_rows=20), base)
    assert got.count() == t.count()
    assert feature_parity(compute_features(t), got, tol=1e-9).count() == 0


def test_unknown_layout_is_a_cold_start():
    ledger = CardLedger()
    ledger.take(row(T0, 5.0))
    assert CardLedger(stored=ledger.stored()).rows == 1
    assert CardLedger(stored=(99, *ledger.stored()[1:])).rows == 0


def test_state_as_of_a_batch_and_its_changes(spark, tmp_path):
    from cardwise.streaming.jobs import state_changes, state_snapshot, stream_features, stream_transactions_files, typed_stream
    from cardwise.streaming.replay import write_replay_files

    names = write_replay_files(events_txn(spark, SF_SMALL), f"{tmp_path}/in", 3)
    features = stream_features(typed_stream(stream_transactions_files(spark, f"{tmp_path}/in", max_files=1)))
    start(spark, f"{tmp_path}/in", features, f"{tmp_path}/run")
    ckpt = f"{tmp_path}/run/ckpt"
    seen = None
    for batch, name in enumerate(names):
        part = spark.read.schema("card_id string, ts_ms string").json(name)
        seen = part if seen is None else seen.unionByName(part)
        want = {r[0]: (r[1], r[2]) for r in seen.groupBy("card_id").agg(F.count("*"), F.max(F.col("ts_ms").cast("long"))).collect()}
        got = {r[0]: (r[1], r[2]) for r in state_snapshot(spark, ckpt, batch).select("key.card_id", "value.txn_count", "value.last_ts").collect()}
        assert got == want
        changed = {r[0] for r in state_changes(spark, ckpt, batch, batch).where("change_type = 'update'").select("key.card_id").collect()}
        assert changed == {r[0] for r in part.select("card_id").distinct().collect()}
