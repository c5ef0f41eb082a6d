"""Decisions (L4) and the monitoring queries over the decisions table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwise.functions.columns import decide, e2e_latency_ms
from cardwise.operators.ordered import segmented_prefix
from cardwise.schema import APPROVE, REVIEW

# fixed values: latency histogram bucket upper bounds (seconds)
INFERENCE_BOUNDS = (0.0005, 0.001, 0.002, 0.005, 0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0)
E2E_BOUNDS = (0.01, 0.025, 0.05, 0.1, 0.15, 0.2, 0.3, 0.5, 1.0, 2.0, 5.0)
SLO_MS = 200.0


def decisions(
    scored: DataFrame,
    threshold: float,
    model_version: str,
    scored_at: Column | None = None,
    latency_ms: Column | None = None,
) -> DataFrame:
    """L4: one decision row per scored transaction.

    ``scored_at`` defaults to the batch's current time (fixed once per query);
    ``latency_ms`` defaults to 0 when the caller did not time inference.
    """
    event_ts = F.timestamp_millis(F.col("ts_ms"))
    return scored.select(
        "txn_id",
        "card_id",
        event_ts.alias("event_ts"),
        F.col("score").cast("double").alias("score"),
        F.lit(float(threshold)).alias("threshold"),
        decide("score", float(threshold)).alias("decision"),
        F.col("label").cast("smallint").alias("label"),
        F.lit(model_version).alias("model_version"),
        (scored_at if scored_at is not None else F.current_timestamp()).alias("scored_at"),
        (latency_ms if latency_ms is not None else F.lit(0.0)).cast("double").alias("latency_ms"),
    )


def decision_latency(d: DataFrame) -> DataFrame:
    """M1: scored_at, decision, end-to-end and inference latency (ms)."""
    return d.select(
        "scored_at",
        "decision",
        e2e_latency_ms("scored_at", "event_ts").alias("e2e_latency_ms"),
        F.col("latency_ms").alias("inference_latency_ms"),
    )


def decision_quality(d: DataFrame) -> DataFrame:
    """M2: confusion counts over labelled decisions."""
    lab = d.filter(F.col("label").isNotNull())
    rev, app = F.col("decision") == REVIEW, F.col("decision") == APPROVE
    return lab.agg(
        F.count_if(rev & (F.col("label") == 1)).alias("true_positives"),
        F.count_if(rev & (F.col("label") == 0)).alias("false_positives"),
        F.count_if(app & (F.col("label") == 1)).alias("false_negatives"),
        F.count_if(app & (F.col("label") == 0)).alias("true_negatives"),
    )


def precision_recall_pct(d: DataFrame) -> DataFrame:
    """M3: precision and recall in percent, 2 decimals, NULL when the denominator is 0."""
    q = decision_quality(d)
    tp = F.col("true_positives").cast("decimal(20,0)")
    prec = F.round(F.try_divide(tp * 100, (F.col("true_positives") + F.col("false_positives")).cast("decimal(20,0)")), 2)
    rec = F.round(F.try_divide(tp * 100, (F.col("true_positives") + F.col("false_negatives")).cast("decimal(20,0)")), 2)
    return q.select(prec.cast("double").alias("precision_pct"), rec.cast("double").alias("recall_pct"))


def decision_count(d: DataFrame) -> DataFrame:
    """M4: number of decisions."""
    return d.agg(F.count(F.lit(1)).alias("decisions"))


def recent_decisions(d: DataFrame, n: int = 50) -> DataFrame:
    """M5: latest decisions by scored_at (top-k)."""
    return d.orderBy(F.col("scored_at").desc(), F.col("txn_id")).limit(n)


def card_history(d: DataFrame, card_id: str, n: int = 50) -> DataFrame:
    """M5: one card's decisions, newest event first (filter reaches the scan)."""
    return d.filter(F.col("card_id") == card_id).orderBy(F.col("event_ts").desc(), F.col("txn_id")).limit(n)


def review_queue(d: DataFrame, n: int = 100) -> DataFrame:
    """M5: latest REVIEW decisions."""
    return d.filter(F.col("decision") == REVIEW).orderBy(F.col("scored_at").desc(), F.col("txn_id")).limit(n)


PERCENTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}


def latency_percentiles(d: DataFrame, bucket: str = "10 seconds", start=None, end=None, large: int = 1_000_000) -> DataFrame:
    """M6: exact continuous p50/p95/p99 of e2e latency per time bucket of scored_at.

    A bucket of at most ``large`` rows is one ``percentile`` aggregate, whose map of values fits a
    task. Larger ones are ranked: distinct latencies with their counts, one range-partitioned sort of
    all buckets with running counts, so that a bucket with all rows is spread over all tasks.
    """
    lat = decision_latency(d)
    if start is not None:
        lat = lat.filter(F.col("scored_at") >= F.lit(start))
    if end is not None:
        lat = lat.filter(F.col("scored_at") < F.lit(end))
    lat = lat.select(F.window("scored_at", bucket)["start"].alias("bucket_start"), F.col("e2e_latency_ms").alias("v"))
    crowded = lat.groupBy("bucket_start").agg(F.count("v").alias("n")).where(F.col("n") > large)
    if not crowded.limit(1).count():
        return _percentiles_by_map(lat)
    few = lat.join(crowded, "bucket_start", "left_anti")
    return _percentiles_by_map(few).unionByName(grouped_percentiles(lat.join(crowded.select("bucket_start"), "bucket_start", "left_semi")))


def _percentiles_by_map(lat: DataFrame) -> DataFrame:
    return lat.groupBy("bucket_start").agg(*[F.percentile("v", q).alias(name) for name, q in PERCENTILES.items()])


def grouped_percentiles(lat: DataFrame) -> DataFrame:
    """Exact percentiles of ``v`` per ``bucket_start`` without a task that holds a bucket: the values
    at the two ranks around ``q * (n - 1)``, interpolated."""
    counts = lat.where(F.col("v").isNotNull()).groupBy("bucket_start", "v").agg(F.count("*").alias("n"))
    ranked = segmented_prefix(counts, ["bucket_start"], ["v"], ["n"])
    totals = lat.groupBy("bucket_start").agg(F.count("v").alias("total"))
    wanted = []
    for name, q in PERCENTILES.items():
        at = F.lit(q) * (F.col("total") - 1)
        wanted += [F.struct(F.lit(f"{name}_{side}").alias("name"), rank.cast("long").alias("rank")) for side, rank in (("lo", F.floor(at)), ("hi", F.ceil(at)))]
    hits = ranked.join(totals, "bucket_start").select("bucket_start", "total", "v", F.filter(F.array(*wanted), lambda w: (w["rank"] < F.col("cum_n")) & (w["rank"] >= F.col("cum_n") - F.col("n"))).alias("w"))
    hits = hits.where(F.size("w") > 0).select("bucket_start", "total", "v", F.inline("w"))
    at = lambda name: F.max(F.when(F.col("name") == name, F.col("v")))
    found = hits.groupBy("bucket_start", "total").agg(*[at(f"{name}_{side}").alias(f"{name}_{side}") for name in PERCENTILES for side in ("lo", "hi")])
    out = []
    for name, q in PERCENTILES.items():
        rank, lo, hi = F.lit(q) * (F.col("total") - 1), F.col(f"{name}_lo"), F.col(f"{name}_hi")
        between = (F.ceil(rank) - rank) * lo + (rank - F.floor(rank)) * hi
        out.append(F.when(lo == hi, lo).otherwise(between).alias(name))
    return found.select("bucket_start", *out)


def decision_counts(d: DataFrame, width: str = "1 minute") -> DataFrame:
    """(bucket_start, decision, n) per window of scored_at; on a stream with a watermark, too."""
    g = d.groupBy(F.window("scored_at", width).alias("w"), "decision").agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.col("w.start").alias("bucket_start"), "decision", "n")


def decision_rate(d: DataFrame, width: str = "1 minute", seconds: float = 60.0) -> DataFrame:
    """M7: decisions per second by decision, per window of scored_at."""
    return rate_of_counts(decision_counts(d, width), seconds)


def rate_of_counts(counts: DataFrame, seconds: float = 60.0) -> DataFrame:
    return counts.select("bucket_start", "decision", (F.col("n") / seconds).alias("per_sec"))


def alert_rate(d: DataFrame, width: str = "5 minutes", slide: str = "1 minute", floor: float = 0.0001) -> DataFrame:
    """M8: share of REVIEW over a sliding window; the rate denominator is floored. Rows are counted
    by ``slide`` first; ``width`` must be a multiple of it."""
    return alert_rate_of_counts(decision_counts(d, slide), width, slide, floor)


def alert_rate_of_counts(counts: DataFrame, width: str = "5 minutes", slide: str = "1 minute", floor: float = 0.0001) -> DataFrame:
    """M8 from counts by ``slide`` and decision: each count goes to the windows that hold it."""
    secs, step = _seconds(width), _seconds(slide)
    if secs % step:
        raise ValueError("the window is a multiple of its slide")
    starts = F.sequence(F.lit(0), F.lit(int(secs // step) - 1))
    each = counts.select("bucket_start", "decision", "n", F.explode(starts).alias("back"))
    each = each.select(F.timestamp_micros(F.unix_micros("bucket_start") - F.col("back") * int(step * 1_000_000)).alias("bucket_start"), "decision", "n")
    g = each.groupBy("bucket_start").agg(F.sum(F.when(F.col("decision") == REVIEW, F.col("n")).otherwise(0)).alias("review"), F.sum("n").alias("total"))
    rate = (F.col("review") / secs) / F.greatest(F.col("total") / secs, F.lit(floor))
    return g.select("bucket_start", rate.alias("alert_rate"))


def _seconds(text: str) -> float:
    num, unit = text.split()
    return float(num) * {"second": 1, "seconds": 1, "minute": 60, "minutes": 60, "hour": 3600, "hours": 3600}[unit]


def run_review_rate(d: DataFrame) -> DataFrame:
    """M8: REVIEW share over a whole run."""
    return d.agg(F.round(F.avg(F.when(F.col("decision") == REVIEW, 1.0).otherwise(0.0)), 4).alias("review_rate"))


def latency_histogram(values: DataFrame, col: str, bounds: Sequence[float]) -> DataFrame:
    """M9: cumulative histogram (le, count) over fixed upper bounds plus +Inf; input in seconds.

    Rows are bucketed by one pass; the cumulative sum runs over <= len(bounds)+1 rows.
    """
    b = F.lit(len(bounds))
    for i in reversed(range(len(bounds))):
        b = F.when(F.col(col) <= F.lit(bounds[i]), F.lit(i)).otherwise(b)
    per = values.groupBy(b.alias("i")).agg(F.count(F.lit(1)).alias("n"))
    spark = values.sparkSession
    les = spark.createDataFrame([(i, float(x)) for i, x in enumerate([*bounds, float("inf")])], "i int, le double")
    full = les.join(F.broadcast(per), "i", "left").fillna(0, ["n"])
    return full.select(
        "i", "le", F.sum("n").over(W.orderBy("i").rowsBetween(W.unboundedPreceding, 0)).alias("cumulative")
    )


def histogram_quantile(hist: DataFrame, qs: Sequence[float]) -> DataFrame:
    """Quantile from a cumulative histogram, linear inside the bucket.

    Rank q*total falls in the first bucket whose cumulative count reaches it; the value is
    interpolated between the bucket's bounds (lower bound 0 for the first bucket); a rank in
    the +Inf bucket returns the largest finite bound. ``hist`` has <= a few dozen rows.
    """
    rows = sorted(hist.select("le", "cumulative").collect(), key=lambda r: r[0])
    total = rows[-1][1] if rows else 0
    out = []
    for q in qs:
        if total == 0:
            out.append((float(q), None))
            continue
        rank = q * total
        prev_le, prev_c = 0.0, 0
        val = None
        for le, c in rows:
            if c >= rank:
                if le == float("inf"):
                    val = prev_le
                elif c == prev_c:
                    val = le
                else:
                    val = prev_le + (le - prev_le) * (rank - prev_c) / (c - prev_c)
                break
            prev_le, prev_c = le, c
        out.append((float(q), val))
    return hist.sparkSession.createDataFrame(out, "q double, value double")


def slo_share(d: DataFrame, slo_ms: float = SLO_MS) -> DataFrame:
    """Share of decisions within the end-to-end SLO."""
    lat = decision_latency(d)
    return lat.agg(F.avg(F.when(F.col("e2e_latency_ms") <= slo_ms, 1.0).otherwise(0.0)).alias("within_slo"))


def decisions_by_label(d: DataFrame) -> DataFrame:
    """Decision counter per decision label."""
    return d.groupBy("decision").agg(F.count(F.lit(1)).alias("n"))
