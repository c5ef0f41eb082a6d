"""Best iteration by average precision; ranking metrics at scale; sessions without settings."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from cardwise.operators import metrics, monitor
from cardwise.operators.boosting import precision_by_iteration, prefix_scores, train_best
from cardwise.operators.features import compute_features
from cardwise.operators.model import score, train
from cardwise.session import write_once
from cardwise.sources.views import decisions_table, events_txn
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def split(spark):
    f = compute_features(events_txn(spark, SF_SMALL))
    f = write_once(f.withColumn("label", F.when(F.col("amount") > 150, 1).otherwise(F.col("label"))), "features")
    part = F.col("txn_id").cast("long") % 3
    return f.where(part != 0), f.where(part == 0)


def test_prefix_scores_and_precision_equal_single_fits(spark, split):
    tr, va = split
    options = {"max_depth": 3, "early_stop": False}
    grown = train(tr, va, max_iter=6, **options)
    curve = {r["iteration"]: r["average_precision"] for r in precision_by_iteration(va, grown).collect()}
    assert sorted(curve) == [1, 2, 3, 4, 5, 6]
    for trees in (1, 4, 6):
        single = score(va, train(tr, va, max_iter=trees, **options))
        prefix = prefix_scores(va, grown).where(F.col("iteration") == trees).select("txn_id", F.col("score").alias("prefix"))
        both = single.join(prefix, "txn_id")
        assert both.count() == va.count() and both.where("abs(score - prefix) > 1e-9").count() == 0
        assert curve[trees] == pytest.approx(metrics.pr_auc(single).first()[0], abs=1e-12)


def test_best_iteration_is_kept(split):
    tr, va = split
    model, best, curve = train_best(tr, va, max_iter=5, max_depth=2)
    assert len(curve) == 5 and curve[best - 1] == max(curve) and model.getNumTrees == best
    assert metrics.pr_auc(score(va, model)).first()[0] == pytest.approx(max(curve), abs=1e-12)


def test_roc_auc_of_very_many_rows(spark):
    many = 10**10
    rows = [(0.1, many, 3 * many), (0.5, 2 * many, 2 * many), (0.9, 3 * many, many)]
    got = metrics.roc_auc_of_counts(spark.createDataFrame(rows, "score double, pos long, neg long")).first()[0]
    small = metrics.roc_auc_of_counts(spark.createDataFrame([(s, p // many, n // many) for s, p, n in rows], "score double, pos long, neg long")).first()[0]
    assert got == pytest.approx(small) and 0.5 < got < 1


def test_budget_metrics_rank_ties_at_the_edge(spark):
    rows = [(float(i // 40), i, f"{i:04d}", int(i % 7 == 0), 1.5 * i) for i in range(400)]
    df = spark.createDataFrame(rows, "score double, ts_ms long, txn_id string, label int, amount double")
    ordered = sorted(rows, key=lambda r: (-r[0], r[1], r[2]))
    for r in metrics.metrics_at_budget(df, (0.001, 0.13, 1.0)).collect():
        top = ordered[: int(r["reviewed_n"])]
        assert r["precision"] == pytest.approx(sum(x[3] for x in top) / len(top))
        assert r["recall_value"] == pytest.approx(sum(x[4] for x in top if x[3]) / sum(x[4] for x in rows if x[3]))


def test_crowded_and_quiet_buckets_have_the_same_percentiles(spark):
    d = decisions_table(spark, SF_SMALL)
    key = lambda df: sorted((r["bucket_start"], *(round(r[c], 9) for c in ("p50", "p95", "p99"))) for r in df.collect())
    for bucket in ("10 seconds", "1 day"):
        assert key(monitor.latency_percentiles(d, bucket)) == key(monitor.latency_percentiles(d, bucket, large=2))


def test_history_reset_keeps_odd_card_ids(spark, make_txn):
    rows = [("1", "a\u0001b", 0, 1.0, "m", "x", 0.0, 0.0), ("2", "a\u0001b", 10**9, 1.0, "m", "x", 0.0, 0.0), ("3", "a", 5, 1.0, "m", "x", 0.0, 0.0)]
    got = {r["txn_id"]: (r["card_id"], r["is_first_txn_for_card"]) for r in compute_features(make_txn(rows), reset_after_ms=1000).collect()}
    assert got == {"1": ("a\u0001b", 1.0), "2": ("a\u0001b", 1.0), "3": ("a", 1.0)}


def test_local_session_without_a_checkpoint_setting(tmp_path):
    code = "from cardwise.session import build_session, scratch_path; s = build_session('local[1]'); p = scratch_path(s, 'x'); s.range(3).write.parquet(p); print('rows', s.read.parquet(p).count(), scratch_path(s, 'y').rsplit('/', 1)[0] == p.rsplit('/', 1)[0])"
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYTHONPATH": os.getcwd()}
    run = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=180)
    assert "rows 3 True" in run.stdout, run.stderr[-2000:]
