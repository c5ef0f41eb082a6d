"""Runs of rows as arrays and packed rows: the same facts, state and features as rows singly."""

import random
import shutil
from math import isclose
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from cardwise.operators.checks import feature_parity
from cardwise.operators.features import compute_features
from cardwise.sources.views import events_txn
from cardwise.streaming.card_state import FACT_FIELDS, SCALE, CardLedger, Held
from cardwise.streaming.jobs import state_snapshot, stream_features, stream_transactions_files, typed_stream
from cardwise.streaming.replay import write_replay_files
from cardwise.streaming.runs import all_facts, of_units
from tests.conftest import SF_SMALL, T0
from tests.test_card_state import DAY, HOUR, Kept, start

COLUMNS = {"txn_id": pa.string(), "ts_ms": pa.int64(), "amount": pa.float64(), "mcc": pa.string(), "merchant_id": pa.string(),
           "lat": pa.float64(), "lon": pa.float64(), "label": pa.int32()}


def stream_of(seed, n, steps, late=0, amounts=lambda rng: round(rng.uniform(-5, 500), 2), keys=(4, 9)):
    rng, ts, rows = random.Random(seed), T0, []
    for i in range(n):
        ts += rng.choice(steps)
        back = rng.randrange(0, 30 * HOUR) if late and rng.randrange(late) == 0 else 0
        mcc, merchant = f"c{rng.randrange(keys[0])}", rng.choice(["", f"m{rng.randrange(keys[1])}", f"m{rng.randrange(keys[1])}"])
        place = rng.choice([(1.5, 2.5), (rng.uniform(-9, 9), 7.0), (None, None)])
        rows.append((f"t{i:07d}", ts - back, amounts(rng), mcc, merchant, *place, rng.choice([0, 1, None])))
    return rows


def close_to(got, want):
    """All facts alike; the spread's squares may differ in the last bit."""
    spread = list(FACT_FIELDS).index("amt_spread")
    assert got[:spread] == want[:spread] and got[spread + 1 :] == want[spread + 1 :]
    assert got[spread] == want[spread] or isclose(got[spread], want[spread], rel_tol=1e-12)


BUSY, CROWDED = [0, 1, 900, 7_000, 40_000, 40_000], [0, 0, 1, 2, 50]


@pytest.mark.parametrize(
    ("steps", "batch", "late", "reset", "caps", "amounts"),
    [
        (BUSY, 700, 0, None, (64, 128), None),
        (BUSY, 90, 0, None, (64, 128), None),
        (BUSY, 700, 40, None, (64, 128), None),
        (CROWDED, 500, 0, None, (64, 128), None),
        ([*BUSY * 40, 2 * DAY], 700, 0, DAY, (64, 128), None),
        (BUSY, 700, 60, None, (3, 5), None),
        (BUSY, 700, 0, None, (None, None), None),
        (BUSY, 700, 0, None, (64, 128), lambda rng: rng.choice([1e9 / 3, -7e10 / 3, 0.1, 4e11])),
        (BUSY, 700, 0, None, (64, 128), lambda rng: rng.choice([1e18, 1e13, -1e18, 0.1, 5.0, 5.0])),
        (BUSY, 700, 0, None, (64, 128), lambda rng: 0.1),
    ],
)
def test_runs_tell_the_same_facts_as_rows_singly(monkeypatch, steps, batch, late, reset, caps, amounts):
    monkeypatch.setattr("cardwise.streaming.runs.RUN_ROWS", 500)
    monkeypatch.setattr("cardwise.streaming.runs.FACT_ROWS", 64)
    rows = stream_of(3, 6000, steps, late, **({"amounts": amounts} if amounts else {}))
    plain, kept = CardLedger(caps, trail_rows=10**9), Kept()
    for at in range(0, len(rows), batch):
        own = sorted(rows[at : at + batch], key=lambda r: (r[1], r[0]))
        table = pa.table({name: pa.array(values, kind) for (name, kind), values in zip(COLUMNS.items(), zip(*own))})
        ledger = kept.open(trail_rows=40)
        ledger.caps = caps
        ledger.mccs.cap, ledger.merchants.cap = caps
        told = [r for part in all_facts(ledger, table, reset) for r in part.to_pylist()]
        assert [r["txn_id"] for r in told] == [r[0] for r in own]
        for r, o in zip(told, own):
            want = plain.take(dict(zip(COLUMNS, o)), reset)
            close_to(tuple(r[f] for f in FACT_FIELDS), want)
        kept.close(ledger)
        assert len(ledger.trail.times) <= 40
        assert (ledger.rows, ledger.place, ledger.hours, ledger.amounts) == (plain.rows, plain.place, plain.hours, plain.amounts)
        assert (ledger.mccs.latest, ledger.merchants.latest) == (plain.mccs.latest, plain.merchants.latest)
    assert ledger.spilled


def test_a_run_leaves_the_minutes_that_rows_singly_leave():
    rows = stream_of(5, 4000, BUSY)
    table = pa.table({name: pa.array(values, kind) for (name, kind), values in zip(COLUMNS.items(), zip(*rows))})
    kept, single = Kept(), Kept()
    ledger, by_row = kept.open(40), single.open(40)
    assert sum(part.num_rows for part in all_facts(ledger, table)) == len(rows)
    for r in rows:
        by_row.take(dict(zip(COLUMNS, r)))
    kept.close(ledger)
    single.close(by_row)
    for minute in single.minutes:  # the run's trail holds the newest minute alone
        assert kept.minutes[minute] == single.minutes[minute]
        for part in range(kept.minutes[minute][2]):
            assert [list(x) for x in kept.parts[minute, part]] == [list(x) for x in single.parts[minute, part]]
    assert single.spill[0] <= kept.spill[0]


def test_sums_of_units_are_the_nearest_amounts():
    import numpy as np

    rng = random.Random(1)
    totals = [rng.randrange(-(2**bits), 2**bits) for bits in (10, 50, 53, 54, 60, 62, 70, 90) for _ in range(3000)]
    totals += [k * 10**10 // 2**j for j in range(20) for k in (2**21 + 1, 2**25 - 1, 2**30 + 3)]
    got = of_units(np.array([t >> 32 for t in totals]), np.array([t & 2**32 - 1 for t in totals]))
    assert got.tolist() == [t / SCALE for t in totals]


def test_full_parts_of_a_minute_go_on_in_new_ones():
    from cardwise.streaming.card_state import Minutes

    one, all_at_once = Minutes(Held()), Minutes(Held())
    times = [T0 + i * 100 for i in range(1500)]
    for m, put in ((one, lambda t, a: [one.add(*x) for x in zip(t, a)]), (all_at_once, all_at_once.add_run)):
        for first, end in ((0, 5), (5, 300), (300, 1500)):
            put(times[first:end], [0.1 * i for i in range(first, end)])
    assert all_at_once.hours == one.hours and all_at_once.store.minutes == one.store.minutes
    assert {k: [list(x) for x in v] for k, v in all_at_once.store.parts.items()} == {k: [list(x) for x in v] for k, v in one.store.parts.items()}


def test_packed_rows_have_the_same_features_and_go_on_from_rows_singly(spark, tmp_path):
    t = events_txn(spark, SF_SMALL).withColumn("card_id", F.pmod(F.col("card_id").cast("long"), F.lit(3)).cast("string"))
    names = write_replay_files(t, f"{tmp_path}/all", 4)
    folder, base = Path(f"{tmp_path}/in"), f"{tmp_path}/run"
    folder.mkdir()
    local = [Path(n.removeprefix("file:")) for n in names]
    for part, packed in ((local[:2], False), (local[2:], True)):
        for n in part:
            shutil.copy2(n, folder)
        stream = typed_stream(stream_transactions_files(spark, str(folder), max_files=1))
        got = start(spark, str(folder), stream_features(stream, trail_rows=20, packed=packed), base)
    assert got.count() == t.count()
    assert feature_parity(compute_features(t), got, tol=1e-9).count() == 0
    want = {tuple(r) for r in t.groupBy("card_id").agg(F.count("*"), F.max("ts_ms")).collect()}
    assert {tuple(r) for r in state_snapshot(spark, f"{base}/ckpt").select("key.card_id", "value.txn_count", "value.last_ts").collect()} == want


def test_packed_rows_of_a_table(spark):
    t = events_txn(spark, SF_SMALL)
    reset = 5 * DAY
    assert feature_parity(compute_features(t, reset_after_ms=reset), stream_features(t, reset_after_ms=reset, packed=True), tol=1e-9).count() == 0
    with pytest.raises(ValueError):
        stream_features(t, packed=True, idle_ms=DAY)


def test_whole_numbers_are_reported_as_before(spark):
    from cardwise.plans.catalog import report_features, report_stored_features
    from cardwise.schema import FEATURE_ORDER

    rng = random.Random(2)
    odd = [0.0, -0.0, -1.0, 0.5, 1e-9, -1e-9, 5e-7, 2.5e-6, 1e9, -1e9, 2.0**53 + 2, 1e17, 1e300, float("nan"), float("inf"), -float("inf"), None, 123456.7890125]
    odd += [float(rng.randrange(10**k)) for k in range(1, 17)] + [rng.uniform(-(10.0**k), 10.0**k) for k in range(1, 17)]
    rows = [(str(i), "c", i, *[odd[(i + k) % len(odd)] for k in range(len(FEATURE_ORDER))], 1) for i in range(len(odd))]
    schema = "txn_id string, card_id string, ts_ms long, " + ", ".join(f"{n} double" for n in FEATURE_ORDER) + ", label int"
    df = spark.createDataFrame(rows, schema)
    as_text = lambda d: sorted(map(str, d.collect()))
    assert as_text(report_stored_features(df)) == as_text(report_features(df))


def test_rows_of_a_busy_card_are_not_taken_singly(monkeypatch):
    """The state operator's work on a busy card follows its micro-batches and minutes, not its rows."""
    rows = stream_of(11, 20_000, BUSY)
    table = pa.table({name: pa.array(values, kind) for (name, kind), values in zip(COLUMNS.items(), zip(*rows))})
    taken, take = [], CardLedger.take
    monkeypatch.setattr(CardLedger, "take", lambda self, *a: taken.append(1) or take(self, *a))
    ledger = CardLedger(trail_rows=64)
    for at in range(0, len(rows), 5000):
        assert sum(part.num_rows for part in all_facts(ledger, table.slice(at, 5000))) == 5000
    assert len(taken) == 50
