"""T4 in batch: features in arrival order against the keyed state, with late rows."""

import pytest
from pyspark.sql import functions as F

from cardwise.operators.arrival import arrival_features
from cardwise.operators.checks import feature_parity
from cardwise.operators.formulas import features_from_facts
from cardwise.operators.ordered import segmented_prefix
from cardwise.schema import MAX_MCC, MAX_MERCHANTS
from cardwise.sources.views import events_txn
from cardwise.streaming.card_state import CardLedger
from cardwise.streaming.processor import FACTS_SCHEMA
from tests.conftest import SF_SMALL


def by_state(spark, rows, caps):
    """Features of rows, each taken by its card's state in arrival order."""
    ledgers, facts = {}, []
    for r in sorted(rows, key=lambda r: (r["arrival"], r["ts_ms"], r["txn_id"])):
        told = ledgers.setdefault(r["card_id"], CardLedger(caps)).take(r)
        facts.append((r["txn_id"], r["card_id"], r["ts_ms"], r["amount"], r["lat"], r["lon"], r["label"], *told))
    return features_from_facts(spark.createDataFrame(facts, FACTS_SCHEMA))


def late(df, every=5, places=97):
    n = F.col("txn_id").cast("long")
    return df.withColumn("arrival", n + F.when(n % every == 0, places).otherwise(0))


@pytest.mark.parametrize("leaf_bits,caps", [(6, (MAX_MCC, MAX_MERCHANTS)), (0, (MAX_MCC, MAX_MERCHANTS)), (3, (3, 4))])
def test_batch_in_arrival_order_equals_state(spark, leaf_bits, caps):
    t = late(events_txn(spark, SF_SMALL))
    # a third of the rows is one card's
    t = t.withColumn("card_id", F.when(F.col("txn_id").cast("long") % 3 == 0, "hot").otherwise(F.col("card_id"))).cache()
    got = arrival_features(t, "arrival", caps, bucket_bits=6, leaf_bits=leaf_bits)
    assert got.count() == t.count()
    assert got.where("out_of_order_flag = 1").count() > 20
    assert feature_parity(got, by_state(spark, t.collect(), caps), tol=1e-9).count() == 0
    t.unpersist()


def test_batch_in_arrival_order_equals_stream(spark, tmp_path):
    from cardwise.streaming.jobs import stream_features, stream_transactions_files, typed_stream
    from cardwise.streaming.replay import set_arrival_order, write_replay_files

    names = write_replay_files(events_txn(spark, SF_SMALL), str(tmp_path / "in"), 6)
    order = [2, 0, 5, 1, 4, 3]
    set_arrival_order(spark, names, order)
    delivered = None
    for place, i in enumerate(order):
        part = typed_stream_rows(spark, names[i]).withColumn("arrival", F.lit(place))
        delivered = part if delivered is None else delivered.unionByName(part)
    stream = typed_stream(stream_transactions_files(spark, str(tmp_path / "in"), max_files=1))
    from cardwise.streaming.jobs import drain_to_parquet

    streamed = drain_to_parquet(stream_features(stream), str(tmp_path / "run"))
    assert streamed.where("out_of_order_flag = 1").count() > 0
    assert feature_parity(arrival_features(delivered, "arrival", leaf_bits=2), streamed, tol=1e-9).count() == 0


def typed_stream_rows(spark, name):
    from cardwise.schema import RAW_STRING_SCHEMA
    from cardwise.sources.readers import coerce_transactions

    return coerce_transactions(spark.read.schema(RAW_STRING_SCHEMA).json(name))[0]


def test_arrival_features_of_nothing(spark):
    t = late(events_txn(spark, SF_SMALL)).where("false")
    assert arrival_features(t, "arrival").count() == 0


def test_too_small_buckets_are_refused(spark):
    with pytest.raises(ValueError, match="amount history"):
        arrival_features(late(events_txn(spark, SF_SMALL)), "arrival", bucket_bits=5)


@pytest.mark.parametrize("parts", [1, 7])
def test_segmented_prefix_over_partitions(spark, parts):
    rows = [("a" if i % 10 else f"b{i}", i, i * 2) for i in range(500)]
    got = segmented_prefix(spark.createDataFrame(rows, "seg string, i long, v long"), ["seg"], ["i"], ["v"], parts).collect()
    run = {}
    for seg, i, v in sorted(rows, key=lambda r: r[1]):
        run[seg] = run.get(seg, 0) + v
        assert next(r["cum_v"] for r in got if r["i"] == i) == run[seg]


def test_capped_keys_of_one_card_over_many_buckets(spark):
    """One card holds all rows; hour buckets, so the prefix scan has several levels."""
    from cardwise.operators.features import compute_features

    t = events_txn(spark, SF_SMALL).withColumn("card_id", F.lit("one")).withColumn("arrival", F.col("ts_ms"))
    got = compute_features(t, caps=(3, 4), hot_rows=5)
    assert feature_parity(got, by_state(spark, t.collect(), (3, 4)), tol=1e-9).count() == 0


@pytest.mark.parametrize("leaf_bits,caps", [(3, (MAX_MCC, MAX_MERCHANTS)), (9, (3, 4))])
def test_hot_cards_spread_by_bucket_equal_state(spark, leaf_bits, caps):
    t = late(events_txn(spark, SF_SMALL))
    # a third of the rows is one card's, which is spread over tasks; the others are whole
    t = t.withColumn("card_id", F.when(F.col("txn_id").cast("long") % 3 == 0, "hot").otherwise(F.col("card_id"))).cache()
    got = arrival_features(t, "arrival", caps, bucket_bits=6, leaf_bits=leaf_bits, hot_rows=200)
    assert got.count() == t.count()
    assert got.where("card_id = 'hot' AND out_of_order_flag = 1").count() > 20
    assert feature_parity(got, by_state(spark, t.collect(), caps), tol=1e-9).count() == 0
    t.unpersist()


def plan_nodes(plan):
    if plan.nodeName() == "AdaptiveSparkPlan":
        return plan_nodes(plan.executedPlan())
    return [plan.nodeName()] + [n for i in range(plan.children().size()) for n in plan_nodes(plan.children().apply(i))]


def test_cards_move_once(spark):
    """F8: once the rows are numbered, no fact of a card that is not hot needs another exchange."""
    got = arrival_features(late(events_txn(spark, SF_SMALL)), "arrival", bucket_bits=6, leaf_bits=3)
    nodes = plan_nodes(got._jdf.queryExecution().executedPlan())
    assert "InMemoryTableScan" in nodes and "Window" in nodes
    assert "Exchange" not in nodes


def test_deliveries_alike_and_rows_without_card(spark, make_txn):
    """Rows alike in all columns are rows of their own; rows that name no card have no features."""
    spec = [(f"t{i // 2}", "c", 1_700_000_000_000 + i // 2 * 1000, 5.0, "m", "s", 1.0, 2.0) for i in range(140)]
    t = make_txn(spec).withColumn("arrival", F.lit(0))
    t = t.unionByName(t.limit(3).withColumn("card_id", F.lit(None).cast("string")))
    for hot_rows in (10, 1000):
        got = arrival_features(t, "arrival", bucket_bits=6, leaf_bits=2, hot_rows=hot_rows).collect()
        assert sorted(r["prior_txn_count"] for r in got) == [float(i) for i in range(140)]
        assert all(r["velocity_24h"] == r["prior_txn_count"] and r["amount_sum_24h"] == 5 * r["prior_txn_count"] for r in got)


def test_report_double_folds_negative_zero(spark):
    from cardwise.functions.columns import report_double

    values = [-0.0, -1e-9, -1e-8, -4e-7, 0.0, 1.25, -2.0000005, float("nan"), float("-inf"), None]
    rows = spark.createDataFrame([(v,) for v in values], "v double").select("v", report_double("v").alias("r")).collect()
    got = {str(r["v"]): str(r["r"]) for r in rows}
    assert [got[str(v)] for v in values] == ["0.0", "0.0", "0.0", "0.0", "0.0", "1.25", "-2.0", "nan", "-inf", "None"]
