"""Landing tables under commit records, and the whole scoring job."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from cardwise.operators.features import compute_features
from cardwise.plans.catalog import _hurt_rows
from cardwise.sources.views import events_txn
from cardwise.streaming import landing
from cardwise.streaming.jobs import stream_transactions_files
from cardwise.streaming.replay import _order_mtimes, redeliver
from tests.conftest import SF_SMALL

NOW = {"availableNow": True}


def replay(spark, folder, n=4):
    t = events_txn(spark, SF_SMALL)
    _hurt_rows(t).repartitionByRange(n, "txn_id").write.json(folder)
    names = _order_mtimes(spark, folder)
    redeliver(spark, names[0], "part-z.json", 10_000)
    good = t.where("label = 0 AND merchant_id NOT LIKE '%7'")
    return t, good


@pytest.mark.parametrize("where", ["quarantine", "good", "commit"])
def test_a_killed_batch_is_replayed_into_one_sink(spark, tmp_path, monkeypatch, where):
    t, good = replay(spark, f"{tmp_path}/in")
    raw = stream_transactions_files(spark, f"{tmp_path}/in", max_files=2)
    base, calls = f"{tmp_path}/out", []

    def dies(f, at):
        def run(*args, **kwargs):
            calls.append(1)
            if len(calls) == at:
                raise RuntimeError("killed")
            return f(*args, **kwargs)

        return run

    with monkeypatch.context() as m:
        if where == "commit":  # after both tables, of the second batch
            m.setattr(landing, "commit", dies(landing.commit, 2))
        elif where == "good":  # after quarantine, of the first
            m.setattr(landing, "landed", dies(landing.landed, 1))
        else:  # before anything
            m.setattr(landing, "coerce_transactions", dies(landing.coerce_transactions, 2))
        with pytest.raises(StreamingQueryException):
            landing.land_stream(raw, base, f"{tmp_path}/ckpt", NOW).awaitTermination()
    if where == "good":
        assert landing.quarantined(spark, base).count() == 0  # written, but without a record
    landing.land_stream(raw, base, f"{tmp_path}/ckpt", NOW).awaitTermination()
    rows = landing.landed(spark, base)
    assert rows.count() == good.count()
    assert rows.select("txn_id").exceptAll(good.select("txn_id")).count() == 0
    bad = landing.quarantined(spark, base).select("txn_id").distinct()
    assert bad.count() == t.count() - good.count() and bad.join(rows, "txn_id").count() == 0
    totals = landing.commits(spark, base).agg(F.sum("good"), F.sum("repeated")).first()
    assert totals[0] == good.count() and totals[1] > 0


def test_scoring_job_equals_batch(spark, tmp_path):
    from cardwise.operators.model import score, train
    from cardwise.plans.stream_job import score_transactions
    from cardwise.streaming.jobs import model_scorer

    _, good = replay(spark, f"{tmp_path}/in")
    features = compute_features(events_txn(spark, SF_SMALL)).cache()
    model = train(features, features.limit(50), max_iter=3, max_depth=3)
    raw = stream_transactions_files(spark, f"{tmp_path}/in", max_files=1)
    _, query = score_transactions(spark, raw, f"{tmp_path}/out", model_scorer(model), 0.5, "v1", NOW)
    query.awaitTermination()
    got = spark.read.parquet(f"{tmp_path}/out/decisions")
    want = score(compute_features(good), model)
    both = got.join(want.select("txn_id", F.col("score").alias("batch")), "txn_id")
    assert got.count() == want.count() == both.count()
    assert both.where("abs(score - batch) > 1e-9").count() == 0
    assert got.where("decision = 'REVIEW'").count() == want.where("score >= 0.5").count()
    features.unpersist()


def test_reading_before_anything_landed(spark, tmp_path):
    assert landing.landed(spark, f"{tmp_path}/none").count() == 0
    assert landing.quarantined(spark, f"{tmp_path}/none").count() == 0
