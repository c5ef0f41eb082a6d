"""Global order on data larger than a range sample, and rows that earlier versions lost."""

from pyspark.sql import functions as F

from cardwise.operators.metrics import roc_auc
from cardwise.operators.ordered import global_lag, global_rank
from cardwise.sources.readers import read_normalized, read_quarantine, read_sparkov
from cardwise.streaming.jobs import dedupe_stream

ROWS = 3_000_000


def test_ranks_are_gapless_beyond_the_range_sample(spark):
    df = spark.range(ROWS).select("id", F.xxhash64("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("unused"))
    out = global_rank(df, ["k", "id"], n_parts=8).select("_rank")
    top, distinct, n = out.agg(F.max("_rank"), F.countDistinct("_rank"), F.count("*")).first()
    assert (top, distinct, n) == (ROWS, ROWS, ROWS)


def test_lag_crosses_partitions(spark):
    df = spark.range(ROWS).select("id", F.pmod(F.col("id") * 7919, F.lit(ROWS)).alias("k"), F.lit("x").alias("unused"))
    out = global_lag(df, ["k"], "k", "prev", n_parts=8)
    assert out.where(F.coalesce(F.col("k") - F.col("prev"), F.lit(1)) != 1).count() == 0


def test_roc_auc_equals_the_rank_sum(spark):
    df = spark.range(1_000_000).select(
        F.col("id").cast("string").alias("txn_id"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 1000).alias("score"),
        (F.pmod(F.xxhash64(F.lit(5), "id"), F.lit(30)) == 0).cast("int").alias("label"),
        F.lit(1.0).alias("amount"),
    )
    by = df.groupBy("score").agg(F.sum("label").alias("p"), F.sum(1 - F.col("label")).alias("n")).orderBy("score").collect()
    below = wins = 0.0
    for row in by:
        wins += row["p"] * (below + row["n"] / 2)
        below += row["n"]
    expected = wins / (below * sum(r["p"] for r in by))
    got = roc_auc(df).first()[0]
    assert abs(got - expected) < 1e-9


def test_dedupe_keeps_late_rows(spark, tmp_path):
    schema = "txn_id string, ts_ms long"
    for i, rows in enumerate([[("a", 10_000_000_000), ("b", 10_000_000_000)], [("late", 1_000), ("a", 10_000_000_000)]]):
        spark.createDataFrame(rows, schema).coalesce(1).write.json(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(f"{tmp_path}/in/*")
    query = dedupe_stream(stream).writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out")
    query.awaitTermination(120)
    assert sorted(r["txn_id"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == ["a", "b", "late"]


def test_blank_text_and_quarantine(spark, tmp_path):
    csv = tmp_path / "s.csv"
    csv.write_text("trans_date_trans_time,cc_num,merchant,category,amt,trans_num,merch_lat,merch_long,is_fraud\n2020-01-01 00:00:00,1,,,2.5,t1,1.0,2.0,0\n")
    row = read_sparkov(spark, str(csv)).first()
    assert (row["mcc"], row["merchant_id"], row["amount"]) == ("", "", 2.5)
    csv = tmp_path / "n.csv"
    csv.write_text("txn_id,card_id,ts_ms,amount,mcc,merchant_id,lat,lon,label\na,c,1,2.0,m,x,0,0,0\nb,c,oops,2.0,m,x,0,0,0\n")
    assert [r["txn_id"] for r in read_normalized(spark, str(csv)).collect()] == ["a"]
    assert [(r["reason"], r["txn_id"]) for r in read_quarantine(spark, str(csv)).collect()] == [("ts_ms", "b")]
