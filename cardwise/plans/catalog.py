"""Registered queries: each is a Spark plan over the driver tables plus, where the rule is
SQL-expressible, an independent DuckDB statement computing the same rows.

Every query reads whole tables. Floating outputs are reported through
:func:`cardwise.functions.columns.report_double` (and its SQL twin) so both engines are
compared on the same rounding.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwise.functions.columns import report_double, report_sql
from cardwise.operators.arrival import arrival_features
from cardwise.operators.features import compute_features
from cardwise.plans.oracle_features import arrival_features_sql, features_sql
from cardwise.schema import FEATURE_ORDER
from cardwise.session import configure
from cardwise.sources.views import VIEW_SQL, VIEWS

QueryFn = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, QueryFn] = {}
_SQL: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            configure(spark)
            return fn(spark, sf_dir)

        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _SQL[name] = sql
        return run

    return deco


def queries() -> dict[str, QueryFn]:
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_SQL)


def report_features(df: DataFrame) -> DataFrame:
    return df.select(
        "txn_id", "card_id", "ts_ms", *[report_double(n).alias(n) for n in FEATURE_ORDER], "label"
    )


def report_stored_features(df: DataFrame) -> DataFrame:
    """``report_features`` of a stored table. Most features are whole numbers, which are their own
    comparison form; only the others are rounded."""
    named = {n: F.when(F.rint(n) == F.col(n), F.col(n) + F.lit(0.0)).otherwise(report_double(n)).alias(n) for n in FEATURE_ORDER}
    return df.select("txn_id", "card_id", "ts_ms", *named.values(), "label")


# ------------------------------------------------------------------------- sources / views

for _view in ("txn", "txn_orders"):

    def _make(view: str):
        def q(spark: SparkSession, sf_dir: str) -> DataFrame:
            """Canonical transaction view over the driver tables (P1-P4 style projection)."""
            return VIEWS[view](spark, sf_dir)

        return q

    register(f"view_{_view}", VIEW_SQL[_view]())(_make(_view))


# ------------------------------------------------------------------------------ features

for _view in ("txn", "txn_coarse", "txn_orders"):

    def _make_f(view: str):
        def q(spark: SparkSession, sf_dir: str) -> DataFrame:
            """The 27 point-in-time features over a transaction view."""
            return report_features(compute_features(VIEWS[view](spark, sf_dir)))

        return q

    register(f"features_{_view}", features_sql(VIEW_SQL[_view]()))(_make_f(_view))


# ---------------------------------------------------------------- summaries, split, replay

from cardwise.functions.columns import card_key, pseudo_geo, region_key, report_sql  # noqa: E402
from cardwise.operators import checks, metrics, monitor, split  # noqa: E402
from cardwise.operators.features import lru_overflow_cards, out_of_order_flags  # noqa: E402
from cardwise.sources.readers import coerce_transactions  # noqa: E402
from cardwise.streaming.jobs import drain_to_parquet, start_stream  # noqa: E402
from cardwise.sources.views import (  # noqa: E402
    DECISION_THRESHOLD,
    GEO_SQL,
    SCORED_SQL,
    decisions_sql,
    decisions_table,
    events_txn,
    orders_txn,
    scored_events,
    table,
)

R, RS = report_double, report_sql
TXN_SQL = VIEW_SQL["txn"]()
ORD_SQL = VIEW_SQL["txn_orders"]()
DEC_SQL = decisions_sql()
TRAIN_FRAC, VALID_FRAC = 0.7, 0.15
SPEEDUP, MAX_SLEEP = 100.0, 5.0


@register(
    "dataset_summary",
    f"SELECT count(*) AS rows, count(DISTINCT card_id) AS cards, {RS('avg(label)')} AS fraud_rate FROM ({TXN_SQL}) t",
)
def q_dataset_summary(spark, d):
    """A1: rows, distinct cards and label rate of the transaction view."""
    s = split.dataset_summary(events_txn(spark, d))
    return s.select("rows", "cards", R("fraud_rate").alias("fraud_rate"))


@register(
    "replay_summary",
    f"""SELECT count(*) AS rows, {RS('sum(CASE WHEN label = 1 THEN 1 ELSE 0 END) * 1.0 / count(*)')} AS fraud_rate,
       {RS('(max(ts_ms) - min(ts_ms)) / 1000.0 / 3600.0')} AS span_hours,
       {RS(f'(max(ts_ms) - min(ts_ms)) / 1000.0 / {SPEEDUP} / 60.0')} AS projected_minutes
FROM ({TXN_SQL}) t""",
)
def q_replay_summary(spark, d):
    """A2: replay size, label rate, event-time span and projected replay time."""
    s = split.replay_summary(events_txn(spark, d), SPEEDUP)
    return s.select("rows", *[R(c).alias(c) for c in ("fraud_rate", "span_hours", "projected_minutes")])


@register(
    "replay_schedule",
    f"""WITH t AS ({TXN_SQL}),
g AS (SELECT txn_id, ts_ms, row_number() OVER (ORDER BY ts_ms, txn_id) AS seq,
             (ts_ms - lag(ts_ms) OVER (ORDER BY ts_ms, txn_id)) / 1000.0 / {SPEEDUP} AS gap FROM t),
s AS (SELECT *, CASE WHEN gap IS NULL OR gap <= 0 THEN 0.0 ELSE least(gap, {MAX_SLEEP}) END AS sleep_s FROM g)
SELECT txn_id, ts_ms, seq, {RS('sleep_s')} AS sleep_s,
       {RS('sum(sleep_s) OVER (ORDER BY ts_ms, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)')} AS offset_s
FROM s""",
)
def q_replay_schedule(spark, d):
    """A3: per-row publish offset of an event-ordered replay (partition-parallel prefix sum)."""
    s = split.replay_schedule(events_txn(spark, d), SPEEDUP, MAX_SLEEP)
    return s.select("txn_id", "ts_ms", "seq", R("sleep_s").alias("sleep_s"), R("offset_s").alias("offset_s"))


@register(
    "first_n",
    f"SELECT txn_id, card_id, ts_ms, amount FROM ({TXN_SQL}) t ORDER BY ts_ms, txn_id LIMIT 100",
)
def q_first_n(spark, d):
    """A4: first 100 transactions in event order (top-k)."""
    return split.first_n(events_txn(spark, d), 100).select("txn_id", "card_id", "ts_ms", "amount")


def _split_sql(src: str) -> str:
    f1, f2 = repr(TRAIN_FRAC), repr(TRAIN_FRAC + VALID_FRAC)
    return f"""WITH t AS ({src}),
o AS (SELECT ts_ms, row_number() OVER (ORDER BY ts_ms, txn_id) AS rn, count(*) OVER () AS n FROM t),
c AS (SELECT max(CASE WHEN rn = CAST(floor(n * CAST({f1} AS DOUBLE)) AS BIGINT) THEN ts_ms END) AS cut_t,
             max(CASE WHEN rn = CAST(floor(n * CAST({f2} AS DOUBLE)) AS BIGINT) THEN ts_ms END) AS cut_v FROM o)
SELECT t.*, CASE WHEN t.ts_ms <= c.cut_t THEN 'train' WHEN t.ts_ms <= c.cut_v THEN 'valid' ELSE 'test' END AS split
FROM t, c"""


@register("temporal_split_assign", f"SELECT txn_id, split FROM ({_split_sql(ORD_SQL)}) s")
def q_split_assign(spark, d):
    """A5: train/valid/test by event time over the day-granular orders view (ties never straddle)."""
    return split.split_label(orders_txn(spark, d), TRAIN_FRAC, VALID_FRAC).select("txn_id", "split")


@register(
    "temporal_split_check",
    f"""WITH s AS ({_split_sql(ORD_SQL)})
SELECT count(*) FILTER (WHERE split = 'train') AS n_train, count(*) FILTER (WHERE split = 'valid') AS n_valid,
       count(*) FILTER (WHERE split = 'test') AS n_test, count(*) AS n,
       (coalesce(max(ts_ms) FILTER (WHERE split = 'train') <
                 coalesce(min(ts_ms) FILTER (WHERE split = 'valid'), min(ts_ms) FILTER (WHERE split = 'test')), TRUE)
        AND coalesce(max(ts_ms) FILTER (WHERE split = 'valid') < min(ts_ms) FILTER (WHERE split = 'test'), TRUE)) AS ordered
FROM s""",
)
def q_split_check(spark, d):
    """Split sizes and the train < valid < test time order."""
    return split.split_check(split.split_label(orders_txn(spark, d), TRAIN_FRAC, VALID_FRAC))


# --------------------------------------------------------------------------- evaluation

def _cost_sql(flag: str) -> str:
    return f"""SELECT {RS(f'''count(*) FILTER (WHERE ({flag}) AND label = 0) * 150.0
        + coalesce(sum(CAST(amount AS DECIMAL(38,10))) FILTER (WHERE NOT ({flag}) AND label = 1), 0) * 1.0
        + count(*) FILTER (WHERE NOT ({flag}) AND label = 1) * 500.0''')} AS expected_cost FROM ({SCORED_SQL}) s"""


@register("expected_cost_at_threshold", _cost_sql(f"score >= {DECISION_THRESHOLD}"))
def q_expected_cost(spark, d):
    """Expected cost when flagging score >= threshold."""
    return metrics.expected_cost(scored_events(spark, d), DECISION_THRESHOLD).select(R("expected_cost").alias("expected_cost"))


@register("expected_cost_approve_all", _cost_sql("FALSE"))
def q_expected_cost_all(spark, d):
    """Expected cost of approving everything."""
    return metrics.expected_cost(scored_events(spark, d), None).select(R("expected_cost").alias("expected_cost"))


_CURVE_SQL = f"""WITH s AS ({SCORED_SQL}),
mm AS (SELECT min(score) AS lo, max(score) AS hi FROM s),
g AS (SELECT i, CASE WHEN i = 199 THEN hi ELSE i * ((hi - lo) / 199.0) + lo END AS threshold
      FROM mm, range(200) r(i)),
c AS (SELECT g.i, g.threshold,
        count(*) FILTER (WHERE s.score >= g.threshold AND s.label = 0) AS fp,
        coalesce(sum(CAST(s.amount AS DECIMAL(38,10))) FILTER (WHERE s.score < g.threshold AND s.label = 1), 0) AS fn_value,
        count(*) FILTER (WHERE s.score < g.threshold AND s.label = 1) AS fn
      FROM g, s GROUP BY g.i, g.threshold)
SELECT i, threshold, fp * 150.0 + CAST(fn_value AS DOUBLE) * 1.0 + fn * 500.0 AS expected_cost FROM c"""


@register(
    "cost_curve",
    f"SELECT CAST(i AS INTEGER) AS i, {RS('threshold')} AS threshold, {RS('expected_cost')} AS expected_cost FROM ({_CURVE_SQL}) x",
)
def q_cost_curve(spark, d):
    """Expected cost at 200 thresholds over [min, max] score."""
    c = metrics.cost_curve(scored_events(spark, d))
    return c.select("i", R("threshold").alias("threshold"), R("expected_cost").alias("expected_cost"))


@register(
    "optimal_threshold",
    f"""SELECT {RS('threshold')} AS threshold, {RS('expected_cost')} AS expected_cost
FROM ({_CURVE_SQL}) x ORDER BY expected_cost, i LIMIT 1""",
)
def q_optimal_threshold(spark, d):
    """A10: lowest threshold with the minimum expected cost."""
    o = metrics.optimal_threshold(scored_events(spark, d))
    return o.select(R("threshold").alias("threshold"), R("expected_cost").alias("expected_cost"))


_RANKED_SQL = f"""SELECT *, row_number() OVER (ORDER BY score DESC, ts_ms, txn_id) AS rk,
  sum(label) OVER (ORDER BY score DESC, ts_ms, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp
FROM ({SCORED_SQL}) s"""


@register(
    "pr_auc",
    f"SELECT {RS('coalesce(sum(CASE WHEN label = 1 THEN tp * 1.0 / rk END) / nullif(sum(label), 0), 0.0)')} AS pr_auc FROM ({_RANKED_SQL}) r",
)
def q_pr_auc(spark, d):
    """Step-wise average precision."""
    return metrics.pr_auc(scored_events(spark, d)).select(R("pr_auc").alias("pr_auc"))


@register(
    "roc_auc",
    f"""WITH g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
               FROM ({SCORED_SQL}) s GROUP BY score),
r AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg FROM g)
SELECT {RS('CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN 0.5 ELSE sum(pos * (2 * (cneg - neg) + neg)) / (2.0 * sum(pos) * sum(neg)) END')} AS roc_auc
FROM r""",
)
def q_roc_auc(spark, d):
    """ROC-AUC with tie-averaged ranks."""
    return metrics.roc_auc(scored_events(spark, d)).select(R("roc_auc").alias("roc_auc"))


def _budget_sql() -> str:
    parts = []
    for b in metrics.DEFAULT_BUDGETS:
        parts.append(
            f"""SELECT CAST({b!r} AS DOUBLE) AS review_rate, greatest(1, CAST(round_even(n * CAST({b!r} AS DOUBLE), 0) AS BIGINT)) AS k FROM (SELECT count(*) AS n FROM ({SCORED_SQL}) s0)"""
        )
    ks = " UNION ALL ".join(parts)
    return f"""WITH r AS ({_RANKED_SQL}), k AS ({ks}),
tot AS (SELECT count(*) FILTER (WHERE label = 1) AS p, coalesce(sum(CAST(amount AS DECIMAL(38,10))) FILTER (WHERE label = 1), 0) AS pv FROM r),
c AS (SELECT k.review_rate, k.k, count(*) FILTER (WHERE r.label = 1) AS caught,
             coalesce(sum(CAST(r.amount AS DECIMAL(38,10))) FILTER (WHERE r.label = 1), 0) AS cv
      FROM k JOIN r ON r.rk <= k.k GROUP BY k.review_rate, k.k)
SELECT {RS('review_rate')} AS review_rate, {RS('k')} AS reviewed_n, {RS('caught * 1.0 / k')} AS precision,
       {RS('CASE WHEN p > 0 THEN caught * 1.0 / p ELSE 0 END')} AS recall_count,
       {RS('CASE WHEN pv <> 0 THEN CAST(cv AS DOUBLE) / CAST(pv AS DOUBLE) ELSE 0 END')} AS recall_value
FROM c, tot"""


@register("metrics_at_budget", _budget_sql())
def q_metrics_at_budget(spark, d):
    """Precision and recall (count, value) at review budgets 0.1 %, 0.5 %, 1 %, 5 %."""
    m = metrics.metrics_at_budget(scored_events(spark, d))
    return m.select(*[R(c).alias(c) for c in ("review_rate", "reviewed_n", "precision", "recall_count", "recall_value")])


@register(
    "confusion_at_threshold",
    f"""WITH c AS (SELECT count(*) FILTER (WHERE score >= {DECISION_THRESHOLD} AND label = 1) AS tp,
                      count(*) FILTER (WHERE score >= {DECISION_THRESHOLD} AND label = 0) AS fp,
                      count(*) FILTER (WHERE score < {DECISION_THRESHOLD} AND label = 1) AS fn,
                      avg(CASE WHEN score >= {DECISION_THRESHOLD} THEN 1.0 ELSE 0.0 END) AS alert_rate
               FROM ({SCORED_SQL}) s)
SELECT tp, fp, fn, {RS('CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END')} AS precision,
       {RS('CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END')} AS recall, {RS('alert_rate')} AS alert_rate FROM c""",
)
def q_confusion(spark, d):
    """Confusion counts, precision, recall and alert rate at the decision threshold."""
    c = metrics.confusion_at_threshold(scored_events(spark, d), DECISION_THRESHOLD)
    return c.select("tp", "fp", "fn", R("precision").alias("precision"), R("recall").alias("recall"), R("alert_rate").alias("alert_rate"))


@register(
    "amount_percentiles",
    f"""WITH v AS (SELECT amount, row_number() OVER (ORDER BY amount) - 1 AS i, count(*) OVER () AS n FROM ({TXN_SQL}) t),
q AS (SELECT * FROM (VALUES (0.5), (0.95), (0.99)) x(q))
SELECT {RS('q.q')} AS q, {RS('v.amount')} AS value FROM q, v
WHERE v.i = least(v.n - 1, CAST(round_even(q.q * (v.n - 1), 0) AS BIGINT))""",
)
def q_amount_percentiles(spark, d):
    """Nearest-rank percentiles of transaction amounts (exact, distributed ranking)."""
    p = metrics.nearest_rank_percentiles(events_txn(spark, d), "amount", (0.5, 0.95, 0.99))
    return p.select(R("q").alias("q"), R("value").alias("value"))


# ---------------------------------------------------------------- decisions and monitoring

def _ms(col: str):
    return F.unix_millis(F.col(col))


@register(
    "decisions",
    f"""SELECT txn_id, card_id, CAST(epoch_ms(event_ts) AS BIGINT) AS event_ts_ms, {RS('score')} AS score,
       {RS('threshold')} AS threshold, decision, label, model_version,
       CAST(epoch_ms(scored_at) AS BIGINT) AS scored_at_ms, {RS('latency_ms')} AS latency_ms
FROM ({DEC_SQL}) d""",
)
def q_decisions(spark, d):
    """L4: decision rows (score, threshold, decision, version, scored time, latency)."""
    t = decisions_table(spark, d)
    return t.select(
        "txn_id", "card_id", _ms("event_ts").alias("event_ts_ms"), R("score").alias("score"),
        R("threshold").alias("threshold"), "decision", "label", "model_version",
        _ms("scored_at").alias("scored_at_ms"), R("latency_ms").alias("latency_ms"),
    )


_LAT_SQL = f"""SELECT scored_at, decision,
  (epoch_us(scored_at) - epoch_us(event_ts)) / 1000.0 AS e2e_latency_ms, latency_ms AS inference_latency_ms
FROM ({DEC_SQL}) d"""


@register(
    "decision_latency",
    f"""SELECT CAST(epoch_ms(scored_at) AS BIGINT) AS scored_at_ms, decision, {RS('e2e_latency_ms')} AS e2e_latency_ms,
       {RS('inference_latency_ms')} AS inference_latency_ms FROM ({_LAT_SQL}) l""",
)
def q_decision_latency(spark, d):
    """M1: end-to-end and inference latency per decision."""
    lat = monitor.decision_latency(decisions_table(spark, d))
    return lat.select(
        _ms("scored_at").alias("scored_at_ms"), "decision", R("e2e_latency_ms").alias("e2e_latency_ms"),
        R("inference_latency_ms").alias("inference_latency_ms"),
    )


@register(
    "decision_quality",
    f"""SELECT count(*) FILTER (WHERE decision = 'REVIEW' AND label = 1) AS true_positives,
       count(*) FILTER (WHERE decision = 'REVIEW' AND label = 0) AS false_positives,
       count(*) FILTER (WHERE decision = 'APPROVE' AND label = 1) AS false_negatives,
       count(*) FILTER (WHERE decision = 'APPROVE' AND label = 0) AS true_negatives
FROM ({DEC_SQL}) d WHERE label IS NOT NULL""",
)
def q_decision_quality(spark, d):
    """M2: confusion counts over labelled decisions."""
    return monitor.decision_quality(decisions_table(spark, d))


@register(
    "precision_recall_pct",
    f"""WITH q AS (SELECT count(*) FILTER (WHERE decision = 'REVIEW' AND label = 1) AS tp,
                      count(*) FILTER (WHERE decision = 'REVIEW' AND label = 0) AS fp,
                      count(*) FILTER (WHERE decision = 'APPROVE' AND label = 1) AS fn
               FROM ({DEC_SQL}) d WHERE label IS NOT NULL)
SELECT CAST(round(CAST(tp AS DECIMAL(20,0)) * 100 / nullif(tp + fp, 0), 2) AS DOUBLE) AS precision_pct,
       CAST(round(CAST(tp AS DECIMAL(20,0)) * 100 / nullif(tp + fn, 0), 2) AS DOUBLE) AS recall_pct FROM q""",
)
def q_precision_recall_pct(spark, d):
    """M3: precision and recall in percent (NULL when undefined)."""
    return monitor.precision_recall_pct(decisions_table(spark, d))


@register("decision_count", f"SELECT count(*) AS decisions FROM ({DEC_SQL}) d")
def q_decision_count(spark, d):
    """M4: number of decisions."""
    return monitor.decision_count(decisions_table(spark, d))


@register(
    "recent_decisions",
    f"""SELECT txn_id, card_id, decision, CAST(epoch_ms(scored_at) AS BIGINT) AS scored_at_ms
FROM ({DEC_SQL}) d ORDER BY scored_at DESC, txn_id LIMIT 50""",
)
def q_recent(spark, d):
    """M5: the 50 most recent decisions."""
    r = monitor.recent_decisions(decisions_table(spark, d), 50)
    return r.select("txn_id", "card_id", "decision", _ms("scored_at").alias("scored_at_ms"))


@register(
    "review_queue",
    f"""SELECT txn_id, card_id, {RS('score')} AS score, CAST(epoch_ms(scored_at) AS BIGINT) AS scored_at_ms
FROM ({DEC_SQL}) d WHERE decision = 'REVIEW' ORDER BY scored_at DESC, txn_id LIMIT 100""",
)
def q_review_queue(spark, d):
    """M5: the 100 most recent REVIEW decisions."""
    r = monitor.review_queue(decisions_table(spark, d), 100)
    return r.select("txn_id", "card_id", R("score").alias("score"), _ms("scored_at").alias("scored_at_ms"))


@register(
    "latency_percentiles_10s",
    f"""SELECT CAST(epoch_ms(scored_at) // 10000 * 10000 AS BIGINT) AS bucket_start_ms,
       {RS('quantile_cont(e2e_latency_ms, 0.5)')} AS p50, {RS('quantile_cont(e2e_latency_ms, 0.95)')} AS p95,
       {RS('quantile_cont(e2e_latency_ms, 0.99)')} AS p99
FROM ({_LAT_SQL}) l GROUP BY 1""",
)
def q_latency_pct(spark, d):
    """M6: exact p50/p95/p99 end-to-end latency per 10 s bucket."""
    p = monitor.latency_percentiles(decisions_table(spark, d), "10 seconds")
    return p.select(_ms("bucket_start").alias("bucket_start_ms"), *[R(c).alias(c) for c in ("p50", "p95", "p99")])


@register(
    "latency_percentiles_crowded",
    f"""SELECT CAST(0 AS BIGINT) AS bucket_start_ms,
       {RS('quantile_cont(e2e_latency_ms, 0.5)')} AS p50, {RS('quantile_cont(e2e_latency_ms, 0.95)')} AS p95,
       {RS('quantile_cont(e2e_latency_ms, 0.99)')} AS p99
FROM ({_LAT_SQL}) l""",
)
def q_latency_pct_crowded(spark, d):
    """M6 with all rows in one time bucket, which no task holds."""
    p = monitor.latency_percentiles(decisions_table(spark, d), "36500 days", large=1000)
    return p.select(_ms("bucket_start").alias("bucket_start_ms"), *[R(c).alias(c) for c in ("p50", "p95", "p99")])


@register(
    "decision_rate_1m",
    f"""SELECT CAST(epoch_ms(scored_at) // 60000 * 60000 AS BIGINT) AS bucket_start_ms, decision,
       {RS('count(*) / 60.0')} AS per_sec FROM ({DEC_SQL}) d GROUP BY 1, 2""",
)
def q_decision_rate(spark, d):
    """M7: decisions per second by decision, per minute."""
    r = monitor.decision_rate(decisions_table(spark, d))
    return r.select(_ms("bucket_start").alias("bucket_start_ms"), "decision", R("per_sec").alias("per_sec"))


@register(
    "alert_rate_5m",
    f"""WITH x AS (SELECT (epoch_ms(scored_at) // 60000 - k) * 60000 AS bucket_start_ms, decision
               FROM ({DEC_SQL}) d, range(5) r(k))
SELECT CAST(bucket_start_ms AS BIGINT) AS bucket_start_ms,
       {RS("(count(*) FILTER (WHERE decision = 'REVIEW') / 300.0) / greatest(count(*) / 300.0, 0.0001)")} AS alert_rate
FROM x GROUP BY 1""",
)
def q_alert_rate(spark, d):
    """M8: REVIEW share over 5-minute windows sliding by 1 minute."""
    a = monitor.alert_rate(decisions_table(spark, d))
    return a.select(_ms("bucket_start").alias("bucket_start_ms"), R("alert_rate").alias("alert_rate"))


@register(
    "panels_stream",
    f"""WITH d AS ({DEC_SQL}), x AS (SELECT (epoch_ms(scored_at) // 60000 - k) * 60000 AS bucket_start_ms, decision FROM d, range(5) r(k))
SELECT CAST(epoch_ms(scored_at) // 60000 * 60000 AS BIGINT) AS bucket_start_ms, decision AS panel, {RS('count(*) / 60.0')} AS value FROM d GROUP BY 1, 2
UNION ALL SELECT CAST(bucket_start_ms AS BIGINT), 'alert_rate',
  {RS("(count(*) FILTER (WHERE decision = 'REVIEW') / 300.0) / greatest(count(*) / 300.0, 0.0001)")} FROM x GROUP BY 1""",
)
def q_panels_stream(spark, d):
    """M7 + M8 on a stream: decisions replayed in files, neighbours swapped so that half come late,
    counted per minute by a watermarked aggregation."""
    from cardwise.session import scratch_path
    from cardwise.streaming.jobs import stream_decision_counts, streamed_counts
    from cardwise.streaming.replay import _order_mtimes, set_arrival_order

    base = scratch_path(spark, "panels")
    rows = decisions_table(spark, d)
    rows.repartitionByRange(6, "scored_at").write.parquet(f"{base}/in")
    names = _order_mtimes(spark, f"{base}/in")
    set_arrival_order(spark, names, [i ^ 1 for i in range(len(names))])
    stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    stream_decision_counts(stream, f"{base}/counts", f"{base}/ckpt", "60 days", trigger={"availableNow": True}).awaitTermination()
    counts = streamed_counts(spark, f"{base}/counts")
    rate = monitor.rate_of_counts(counts).select("bucket_start", F.col("decision").alias("panel"), F.col("per_sec").alias("value"))
    alert = monitor.alert_rate_of_counts(counts).select("bucket_start", F.lit("alert_rate").alias("panel"), F.col("alert_rate").alias("value"))
    return rate.unionByName(alert).select(_ms("bucket_start").alias("bucket_start_ms"), "panel", R("value").alias("value"))


@register(
    "run_review_rate",
    "SELECT " + RS("round(avg(CASE WHEN decision = 'REVIEW' THEN 1.0 ELSE 0.0 END), 4)") + f" AS review_rate FROM ({DEC_SQL}) d",
)
def q_run_review_rate(spark, d):
    """M8: REVIEW share over the whole run."""
    return monitor.run_review_rate(decisions_table(spark, d)).select(R("review_rate").alias("review_rate"))


def _hist_sql(expr: str, bounds) -> str:
    cases = " ".join(f"WHEN {expr} <= {b!r} THEN {i}" for i, b in enumerate(bounds))
    les = ", ".join(f"({i}, {float(b)!r})" for i, b in enumerate(bounds))
    return f"""WITH b AS (SELECT CASE {cases} ELSE {len(bounds)} END AS i FROM ({_LAT_SQL}) l),
per AS (SELECT i, count(*) AS n FROM b GROUP BY i),
les AS (SELECT * FROM (VALUES {les}, ({len(bounds)}, 'inf'::DOUBLE)) x(i, le))
SELECT CAST(les.i AS INTEGER) AS i, les.le AS le,
       CAST(sum(coalesce(per.n, 0)) OVER (ORDER BY les.i ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS cumulative
FROM les LEFT JOIN per ON les.i = per.i"""


@register("e2e_latency_histogram", _hist_sql("greatest(0.0, e2e_latency_ms / 1000.0)", monitor.E2E_BOUNDS))
def q_e2e_hist(spark, d):
    """M9: cumulative end-to-end latency histogram (seconds, fixed bounds, clamped at 0)."""
    from cardwise.functions.columns import latency_seconds_clamped

    lat = decisions_table(spark, d).select(latency_seconds_clamped("scored_at", "event_ts").alias("s"))
    return monitor.latency_histogram(lat, "s", monitor.E2E_BOUNDS).select("i", "le", F.col("cumulative").cast("long").alias("cumulative"))


@register("inference_latency_histogram", _hist_sql("inference_latency_ms / 1000.0", monitor.INFERENCE_BOUNDS))
def q_inf_hist(spark, d):
    """M9: cumulative inference latency histogram."""
    lat = monitor.decision_latency(decisions_table(spark, d)).select((F.col("inference_latency_ms") / 1000.0).alias("s"))
    return monitor.latency_histogram(lat, "s", monitor.INFERENCE_BOUNDS).select(
        "i", "le", F.col("cumulative").cast("long").alias("cumulative")
    )


_HQ_SQL = f"""WITH h AS ({_hist_sql("greatest(0.0, e2e_latency_ms / 1000.0)", monitor.E2E_BOUNDS)}),
t AS (SELECT max(cumulative) AS total FROM h),
qs AS (SELECT * FROM (VALUES (0.5), (0.95), (0.99)) x(q)),
hp AS (SELECT i, le, cumulative, lag(le, 1, 0.0) OVER (ORDER BY i) AS prev_le,
              lag(cumulative, 1, 0) OVER (ORDER BY i) AS prev_c FROM h),
pick AS (SELECT qs.q, hp.*, t.total, row_number() OVER (PARTITION BY qs.q ORDER BY hp.i) AS rn
         FROM qs, t, hp WHERE hp.cumulative >= qs.q * t.total)
SELECT {RS('q')} AS q,
       {RS("CASE WHEN le = 'inf'::DOUBLE THEN prev_le WHEN cumulative = prev_c THEN le "
           "ELSE prev_le + (le - prev_le) * (q * total - prev_c) / (cumulative - prev_c) END")} AS value
FROM pick WHERE rn = 1"""


@register("e2e_histogram_quantiles", _HQ_SQL)
def q_hist_quantiles(spark, d):
    """Histogram-interpolated p50/p95/p99 of end-to-end latency (clamped at 0)."""
    from cardwise.functions.columns import latency_seconds_clamped

    lat = decisions_table(spark, d).select(latency_seconds_clamped("scored_at", "event_ts").alias("s"))
    h = monitor.latency_histogram(lat, "s", monitor.E2E_BOUNDS)
    return monitor.histogram_quantile(h, (0.5, 0.95, 0.99)).select(R("q").alias("q"), R("value").alias("value"))


@register(
    "slo_share",
    f"SELECT {RS('avg(CASE WHEN e2e_latency_ms <= 200.0 THEN 1.0 ELSE 0.0 END)')} AS within_slo FROM ({_LAT_SQL}) l",
)
def q_slo(spark, d):
    """Share of decisions within 200 ms end to end."""
    return monitor.slo_share(decisions_table(spark, d)).select(R("within_slo").alias("within_slo"))


@register("decisions_by_label", f"SELECT decision, count(*) AS n FROM ({DEC_SQL}) d GROUP BY decision")
def q_by_label(spark, d):
    """Decision counts per label."""
    return monitor.decisions_by_label(decisions_table(spark, d))


@register(
    "bench_summary",
    f"""WITH v AS (SELECT e2e_latency_ms AS v, row_number() OVER (ORDER BY e2e_latency_ms) - 1 AS i, count(*) OVER () AS n FROM ({_LAT_SQL}) l),
p AS (SELECT max(v) FILTER (WHERE i = least(n - 1, CAST(round_even(0.5 * (n - 1), 0) AS BIGINT))) AS p50,
             max(v) FILTER (WHERE i = least(n - 1, CAST(round_even(0.95 * (n - 1), 0) AS BIGINT))) AS p95,
             max(v) FILTER (WHERE i = least(n - 1, CAST(round_even(0.99 * (n - 1), 0) AS BIGINT))) AS p99,
             max(v) AS mx, avg(v) AS mean, count(*) AS n FROM v)
SELECT n AS decisions_observed, CAST(1.0 AS DOUBLE) AS completeness, {RS('p50')} AS p50, {RS('p95')} AS p95, {RS('p99')} AS p99,
       {RS('mx')} AS max, {RS('mean')} AS mean FROM p""",
)
def q_bench_summary(spark, d):
    """Completeness and nearest-rank latency percentiles of a decisions run."""
    lat = monitor.decision_latency(decisions_table(spark, d))
    b = metrics.bench_summary(lat)
    return b.select("decisions_observed", "completeness", *[R(c).alias(c) for c in ("p50", "p95", "p99", "max", "mean")])


# ----------------------------------------------------------------------------- checks

@register(
    "check_score_ranges",
    f"""SELECT count(*) FILTER (WHERE score IS NULL OR NOT (score BETWEEN 0.0 AND 1.0)) AS bad_scores,
       count(*) FILTER (WHERE decision IS NULL OR decision NOT IN ('APPROVE', 'REVIEW')) AS bad_decisions FROM ({DEC_SQL}) d""",
)
def q_check_ranges(spark, d):
    """Scores within [0, 1] and decisions within the domain."""
    return checks.score_and_decision_ranges(decisions_table(spark, d))


@register("check_duplicate_decisions", f"SELECT txn_id, count(*) AS n FROM ({DEC_SQL}) d GROUP BY txn_id HAVING count(*) > 1")
def q_check_dups(spark, d):
    """No decision id twice."""
    return checks.duplicate_ids(decisions_table(spark, d))


_FEAT_SQL = features_sql(TXN_SQL)


@register(
    "check_cold_starts",
    f"SELECT count(*) FILTER (WHERE is_first_txn_for_card = 1) AS cold_starts, count(DISTINCT card_id) AS cards FROM ({_FEAT_SQL}) f",
)
def q_check_cold(spark, d):
    """Exactly one cold start per card."""
    return checks.cold_starts(compute_features(events_txn(spark, d)))


@register(
    "check_busiest_card",
    f"""SELECT card_id, count(*) AS n, {RS('max_by(prior_txn_count, ts_ms)')} AS last_prior_count
FROM ({_FEAT_SQL}) f GROUP BY card_id ORDER BY n DESC, card_id LIMIT 1""",
)
def q_check_busiest(spark, d):
    """C4: the busiest card's last row has prior count n - 1."""
    b = checks.busiest_card(compute_features(events_txn(spark, d)))
    return b.select("card_id", "n", R("last_prior_count").alias("last_prior_count"))


@register(
    "check_feature_nulls",
    "SELECT " + ", ".join(f"count(*) FILTER (WHERE {n} IS NULL) AS {n}" for n in FEATURE_ORDER) + f" FROM ({_FEAT_SQL}) f",
)
def q_check_nulls(spark, d):
    """No NULL in any of the 27 features."""
    return checks.feature_nulls(compute_features(events_txn(spark, d)))


@register(
    "reconcile_feature_ids",
    f"""SELECT txn_id, 'missing' AS kind FROM (SELECT txn_id FROM ({TXN_SQL}) t EXCEPT SELECT txn_id FROM ({_FEAT_SQL}) f) a
UNION ALL SELECT txn_id, 'unexpected' AS kind FROM (SELECT txn_id FROM ({_FEAT_SQL}) f EXCEPT SELECT txn_id FROM ({TXN_SQL}) t) b""",
)
def q_reconcile(spark, d):
    """Every transaction has exactly one feature row (missing / unexpected ids)."""
    t = events_txn(spark, d)
    return checks.reconcile_ids(t, compute_features(t))


@register(
    "feature_parity_bucket_width",
    "SELECT CAST(NULL AS VARCHAR) AS txn_id, CAST(NULL AS VARCHAR) AS feature, CAST(NULL AS DOUBLE) AS a, "
    "CAST(NULL AS DOUBLE) AS b WHERE FALSE",
)
def q_parity(spark, d):
    """Features with 1-day and 1-hour buckets are identical (the layout never changes values)."""
    t = events_txn(spark, d)
    a = compute_features(t, bucket_ms=86_400_000)
    b = compute_features(t, bucket_ms=3_600_000, hot_rows=None)
    return checks.feature_parity(a, b)


@register(
    "leak_probe",
    f"""WITH f AS ({_FEAT_SQL}), m AS (SELECT card_id, avg(amount) AS card_mean_all FROM f GROUP BY card_id)
SELECT f.txn_id, f.card_id, {RS('f.prior_amount_mean')} AS prior_amount_mean, {RS('m.card_mean_all')} AS card_mean_all
FROM f JOIN m USING (card_id) WHERE abs(m.card_mean_all - f.prior_amount_mean) > 1e-6""",
)
def q_leak(spark, d):
    """The point-in-time mean differs from the whole-history mean (negative control)."""
    f = compute_features(events_txn(spark, d))
    full = f.groupBy("card_id").agg(F.avg("amount").alias("card_mean_all"))
    j = f.join(full, "card_id").filter(F.abs(F.col("card_mean_all") - F.col("prior_amount_mean")) > 1e-6)
    return j.select("txn_id", "card_id", R("prior_amount_mean").alias("prior_amount_mean"), R("card_mean_all").alias("card_mean_all"))


SMALL_CAPS = (3, 20)


@register(
    "features_small_caps",
    f"""WITH t AS ({TXN_SQL}), pairs AS (
  SELECT r.txn_id, count(DISTINCT o.mcc) AS n FROM t r LEFT JOIN t o
    ON o.card_id = r.card_id AND (o.ts_ms, o.txn_id) < (r.ts_ms, r.txn_id) GROUP BY r.txn_id),
um AS (SELECT r.txn_id, r.card_id, r.ts_ms, r.mcc AS k, max(u.ts_ms) AS seen FROM t r
       JOIN t u ON u.card_id = r.card_id AND u.mcc = r.mcc AND (u.ts_ms, u.txn_id) < (r.ts_ms, r.txn_id) GROUP BY ALL),
mm AS (SELECT um.txn_id, any_value(um.seen) AS seen FROM um LEFT JOIN t o ON o.card_id = um.card_id AND o.mcc <> um.k
         AND (o.ts_ms, o.txn_id) < (um.ts_ms, um.txn_id) AND (o.ts_ms, o.mcc) > (um.seen, um.k)
       GROUP BY um.txn_id HAVING count(DISTINCT o.mcc) < {SMALL_CAPS[0]}),
us AS (SELECT r.txn_id, r.card_id, r.ts_ms, r.merchant_id AS k, max(u.ts_ms) AS seen FROM t r
       JOIN t u ON u.card_id = r.card_id AND u.merchant_id = r.merchant_id AND r.merchant_id <> ''
        AND (u.ts_ms, u.txn_id) < (r.ts_ms, r.txn_id) GROUP BY ALL),
ms AS (SELECT us.txn_id FROM us LEFT JOIN t o ON o.card_id = us.card_id AND o.merchant_id NOT IN ('', us.k)
         AND (o.ts_ms, o.txn_id) < (us.ts_ms, us.txn_id) AND (o.ts_ms, o.merchant_id) > (us.seen, us.k)
       GROUP BY us.txn_id HAVING count(DISTINCT o.merchant_id) < {SMALL_CAPS[1]})
SELECT t.txn_id, CASE WHEN mm.txn_id IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS mcc_is_new,
  {report_sql("CASE WHEN mm.txn_id IS NULL THEN -1.0 ELSE (t.ts_ms - mm.seen) / 86400000.0 END")} AS mcc_days_since_last_seen,
  least({SMALL_CAPS[0]}, pairs.n)::DOUBLE AS card_distinct_mcc_count,
  CASE WHEN ms.txn_id IS NULL THEN 1.0 ELSE 0.0 END::DOUBLE AS merchant_is_new
FROM t JOIN pairs USING (txn_id) LEFT JOIN mm USING (txn_id) LEFT JOIN ms USING (txn_id)""",
)
def q_small_caps(spark, d):
    """Novelty under caps of 3 MCCs and 20 merchants, which most cards pass."""
    f = compute_features(events_txn(spark, d), caps=SMALL_CAPS)
    return f.select(
        "txn_id",
        "mcc_is_new",
        report_double("mcc_days_since_last_seen").alias("mcc_days_since_last_seen"),
        "card_distinct_mcc_count",
        "merchant_is_new",
    )


# The deliveries are numbered, so every window of the statement orders a pair alike.
_TWICE_SQL = f"SELECT t.* REPLACE (t.txn_id || chr(1) || n AS txn_id) FROM ({TXN_SQL}) t, (VALUES ('1'), ('2')) d(n)"


@register(
    "features_redelivered",
    f"SELECT * REPLACE (split_part(txn_id, chr(1), 1) AS txn_id) FROM ({features_sql(_TWICE_SQL)}) f",
)
def q_redelivered(spark, d):
    """Every transaction delivered twice; the second delivery sees the first."""
    t = events_txn(spark, d)
    return report_features(compute_features(t.unionByName(t)))


@register(
    "lru_overflow_cards",
    f"""SELECT card_id, count(DISTINCT mcc) AS distinct_mcc,
       count(DISTINCT CASE WHEN merchant_id <> '' THEN merchant_id END) AS distinct_merchants
FROM ({TXN_SQL}) t GROUP BY card_id
HAVING count(DISTINCT mcc) > 64 OR count(DISTINCT CASE WHEN merchant_id <> '' THEN merchant_id END) > 128""",
)
def q_lru(spark, d):
    """W3 guard: cards where the 64 / 128 LRU caps could change novelty features."""
    return lru_overflow_cards(events_txn(spark, d))


@register(
    "out_of_order_arrival",
    f"""WITH t AS ({ORD_SQL})
SELECT txn_id, card_id, ts_ms,
       CASE WHEN ts_ms < max(ts_ms) OVER (PARTITION BY card_id ORDER BY CAST(txn_id AS BIGINT)
                                           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN CAST(1.0 AS DOUBLE) ELSE CAST(0.0 AS DOUBLE) END AS out_of_order_flag
FROM t""",
)
def q_out_of_order(spark, d):
    """F27 in arrival order: orders arrive by order key, not by date."""
    t = orders_txn(spark, d).withColumn("arrival", F.col("txn_id").cast("long"))
    return out_of_order_flags(t, "arrival", bucket_ms=1 << 10)


#: Events arrive by event id, but every seventh one 300 places late.
_LATE_SQL = "CAST(txn_id AS BIGINT) + CASE WHEN CAST(txn_id AS BIGINT) % 7 = 0 THEN 300 ELSE 0 END"


@register("features_orders_arrival", arrival_features_sql(ORD_SQL, "CAST(txn_id AS BIGINT)"))
def q_orders_arrival(spark, d):
    """T4 in batch: all 27 features with orders arriving by order key, most of them out of order."""
    t = orders_txn(spark, d).withColumn("arrival", F.col("txn_id").cast("long"))
    return report_features(arrival_features(t, "arrival"))


@register("features_txn_arrival", arrival_features_sql(TXN_SQL, _LATE_SQL))
def q_txn_arrival(spark, d):
    """T4 in batch with small buckets and leaves: events of which every seventh comes late."""
    t = events_txn(spark, d).withColumn("arrival", F.expr(_LATE_SQL))
    return report_features(arrival_features(t, "arrival", bucket_bits=6, leaf_bits=3))


@register(
    "customer_card_keys",
    f"""SELECT c_custkey,
  concat_ws('-', coalesce(nullif(CAST(c_nationkey AS VARCHAR), ''), 'NA'), coalesce(nullif(c_mktsegment, ''), 'NA'),
            coalesce(nullif(CAST(c_custkey AS VARCHAR), ''), 'NA')) AS card_id,
  coalesce(nullif(CAST(c_nationkey AS VARCHAR), ''), 'NA') || ':' || coalesce(nullif(c_mktsegment, ''), 'NA') AS region,
  round(-55.0 + (CAST(CAST(('0x' || substr(sha256('lat|' || coalesce(nullif(CAST(c_nationkey AS VARCHAR), ''), 'NA') || ':' || coalesce(nullif(c_mktsegment, ''), 'NA')), 1, 16)) AS UBIGINT) AS DOUBLE) / 18446744073709551616.0) * 125.0, 5) AS lat
FROM customer""",
)
def q_customer_keys(spark, d):
    """Card key, region key and pseudo-location over the customer table."""
    c = table(spark, d, "customer")
    region = region_key("c_nationkey", "c_mktsegment")
    lat, _ = pseudo_geo(region)
    return c.select(
        "c_custkey",
        card_key(["c_nationkey", "c_mktsegment", "c_custkey"]).alias("card_id"),
        region.alias("region"),
        lat.alias("lat"),
    )


@register(
    "coerce_events",
    f"""SELECT CASE WHEN merchant_id LIKE '%7' OR label = 1 THEN 'quarantine' ELSE 'good' END AS part, count(*) AS n
FROM ({TXN_SQL}) t GROUP BY part""",
)
def q_coerce(spark, d):
    """P5: text-typed rows coerced to the canonical schema; bad rows quarantined with a reason.

    Amounts of positives are made unreadable and times of merchants ending in 7 are blanked."""
    t = events_txn(spark, d)
    raw = t.select(*[F.col(c).cast("string").alias(c) for c in t.columns])
    raw = raw.withColumn("amount", F.when(F.col("label") == "1", "n/a").otherwise(F.col("amount")))
    raw = raw.withColumn("ts_ms", F.when(F.col("merchant_id").endswith("7"), "").otherwise(F.col("ts_ms")))
    good, bad = coerce_transactions(raw)
    g = good.agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("part"), "n")
    b = bad.agg(F.count(F.lit(1)).alias("n")).select(F.lit("quarantine").alias("part"), "n")
    return g.unionByName(b)


# ---------------------------------------------------------------------------- streaming

# ------------------------------------------------- checks with something to find

@register(
    "check_duplicates_planted",
    f"""WITH d AS ({DEC_SQL}), p AS (SELECT txn_id FROM d UNION ALL SELECT txn_id FROM d WHERE decision = 'REVIEW')
SELECT txn_id, count(*) AS n FROM p GROUP BY txn_id HAVING count(*) > 1""",
)
def q_check_dups_planted(spark, d):
    """C2 over a table in which every decision to review stands twice."""
    rows = decisions_table(spark, d)
    return checks.duplicate_ids(rows.unionByName(rows.where("decision = 'REVIEW'")))


@register(
    "reconcile_planted",
    f"""WITH t AS ({TXN_SQL})
SELECT txn_id, 'missing' AS kind FROM t WHERE label = 1
UNION ALL SELECT DISTINCT 'x-' || card_id, 'unexpected' FROM t""",
)
def q_reconcile_planted(spark, d):
    """A feature table without the positives and with an unknown row for each card."""
    t = events_txn(spark, d)
    features = compute_features(t).where("label = 0").select("txn_id")
    unknown = t.select(F.concat(F.lit("x-"), "card_id").alias("txn_id")).distinct()
    return checks.reconcile_ids(t, features.unionByName(unknown))


_COUNTED = ("prior_txn_count", "velocity_24h", "mcc_is_new", "card_distinct_mcc_count", "hour_prior_count", "out_of_order_flag")


@register(
    "feature_parity_late_rows",
    f"""SELECT * FROM (SELECT x.txn_id, unnest([{", ".join(f"'{n}'" for n in _COUNTED)}]) AS feature,
  unnest([{", ".join(f"CAST(x.{n} AS DOUBLE)" for n in _COUNTED)}]) AS a, unnest([{", ".join(f"CAST(y.{n} AS DOUBLE)" for n in _COUNTED)}]) AS b
  FROM ({features_sql(TXN_SQL)}) x JOIN ({arrival_features_sql(TXN_SQL, _LATE_SQL)}) y ON x.txn_id = y.txn_id) p WHERE a <> b""",
)
def q_parity_late(spark, d):
    """What late delivery changes in the counting features."""
    t = events_txn(spark, d)
    return checks.feature_parity(compute_features(t), arrival_features(t.withColumn("arrival", F.expr(_LATE_SQL)), "arrival"), _COUNTED)


@register(
    "lru_overflow_small_caps",
    f"""SELECT card_id, count(DISTINCT mcc) AS distinct_mcc,
       count(DISTINCT CASE WHEN merchant_id <> '' THEN merchant_id END) AS distinct_merchants
FROM ({TXN_SQL}) t GROUP BY card_id
HAVING count(DISTINCT mcc) > {SMALL_CAPS[0]} OR count(DISTINCT CASE WHEN merchant_id <> '' THEN merchant_id END) > {SMALL_CAPS[1]}""",
)
def q_lru_small(spark, d):
    """W3 guard under caps that most cards pass."""
    return lru_overflow_cards(events_txn(spark, d), *SMALL_CAPS)


@register("features_stream_txn", features_sql(TXN_SQL))
def q_features_stream(spark, d):
    """T1 + S6: features from keyed state in a real micro-batch stream.

    The transaction view is replayed as 16 event-ordered files, one per micro-batch,
    through the RocksDB-backed stateful processor into a parquet sink (availableNow).
    """
    from cardwise.session import scratch_path
    from cardwise.streaming.jobs import slots_for, stream_features, stream_transactions_files, typed_stream
    from cardwise.streaming.replay import write_replay_files

    base = scratch_path(spark, "replay")
    t = events_txn(spark, d)
    write_replay_files(t, f"{base}/in", 16)
    stream = typed_stream(stream_transactions_files(spark, f"{base}/in", max_files=1))
    return report_features(drain_to_parquet(stream_features(stream, slots=slots_for(t)), base))


BUSY_CARDS, BUSY_TRAIL = 3, 64
_BUSY_SQL = f"SELECT * REPLACE (CAST(CAST(card_id AS BIGINT) % {BUSY_CARDS} AS VARCHAR) AS card_id) FROM ({TXN_SQL}) b"


@register("features_stream_busy", features_sql(_BUSY_SQL))
def q_features_stream_busy(spark, d):
    """Three cards hold all rows, and a state value 64 of them; the rest of the last 24 h lives
    in map state by minute. A card's rows of a micro-batch go through the state operator packed."""
    from cardwise.session import scratch_path
    from cardwise.streaming.jobs import stream_features, stream_transactions_files, typed_stream
    from cardwise.streaming.replay import write_replay_files

    base = scratch_path(spark, "busy")
    t = events_txn(spark, d).withColumn("card_id", F.pmod(F.col("card_id").cast("long"), F.lit(BUSY_CARDS)).cast("string"))
    write_replay_files(t, f"{base}/in", 8)
    stream = typed_stream(stream_transactions_files(spark, f"{base}/in", max_files=1))
    return report_stored_features(drain_to_parquet(stream_features(stream, trail_rows=BUSY_TRAIL, packed=True), base))


@register("features_stream_warm", features_sql(TXN_SQL))
def q_features_stream_warm(spark, d):
    """The first half of event time in batch, the second streamed from the state that the first
    left; busy minutes spill on loading."""
    from cardwise.session import scratch_path
    from cardwise.streaming.jobs import stream_transactions_files, typed_stream
    from cardwise.streaming.replay import write_replay_files
    from cardwise.streaming.warm import stream_features_from

    base = scratch_path(spark, "warm")
    t = events_txn(spark, d)
    lo, hi = t.agg(F.min("ts_ms"), F.max("ts_ms")).first()
    history, rest = (t.where(side) for side in (F.col("ts_ms") < (lo + hi) // 2, F.col("ts_ms") >= (lo + hi) // 2))
    write_replay_files(rest, f"{base}/in", 6)
    stream = typed_stream(stream_transactions_files(spark, f"{base}/in", max_files=1))
    streamed = drain_to_parquet(stream_features_from(stream, history, trail_rows=64), base)
    return report_features(compute_features(history).unionByName(streamed))


def _hurt_rows(t: DataFrame) -> DataFrame:
    """The view as text; amounts of positives are unreadable, times of merchants ending in 7 blank."""
    raw = t.select(*[F.col(c).cast("string").alias(c) for c in t.columns])
    raw = raw.withColumn("amount", F.when(F.col("label") == "1", "n/a").otherwise(F.col("amount")))
    return raw.withColumn("ts_ms", F.when(F.col("merchant_id").endswith("7"), "").otherwise(F.col("ts_ms")))


def _write_hurt_replay(spark, d, folder: str, n_files: int = 6) -> list[str]:
    """Replay files in event order with unreadable rows, the first delivered last and two twice."""
    from cardwise.streaming.replay import _order_mtimes, redeliver, set_arrival_order

    t = events_txn(spark, d)
    _hurt_rows(t).repartitionByRange(n_files, "txn_id").write.mode("overwrite").json(folder)
    names = _order_mtimes(spark, folder)
    set_arrival_order(spark, names, [*range(1, n_files), 0])
    redeliver(spark, names[1], "part-z-again-a.json", 10_000)
    redeliver(spark, names[0], "part-z-again-b.json", 20_000)
    return names


@register(
    "transactions_landed",
    f"""SELECT CASE WHEN merchant_id LIKE '%7' OR label = 1 THEN 'quarantine' ELSE 'good' END AS part, txn_id,
  CASE WHEN merchant_id LIKE '%7' THEN 'ts_ms' WHEN label = 1 THEN 'amount' END AS reason,
  CASE WHEN merchant_id LIKE '%7' OR label = 1 THEN NULL ELSE ts_ms END AS ts_ms FROM ({TXN_SQL}) t""",
)
def q_landed(spark, d):
    """P5 + T6: one stream lands good and quarantined rows under commit records; files that come
    twice add no good row, and the first file, which comes last, is kept."""
    from cardwise.session import scratch_path
    from cardwise.streaming.jobs import stream_transactions_files
    from cardwise.streaming.landing import land_stream, landed, quarantined

    base = scratch_path(spark, "landing")
    _write_hurt_replay(spark, d, f"{base}/in")
    raw = stream_transactions_files(spark, f"{base}/in", max_files=2)
    land_stream(raw, f"{base}/table", f"{base}/ckpt", {"availableNow": True}).awaitTermination()
    good = landed(spark, f"{base}/table").select(F.lit("good").alias("part"), "txn_id", F.lit(None).cast("string").alias("reason"), "ts_ms")
    bad = quarantined(spark, f"{base}/table").select("txn_id", "reason").distinct()
    return good.unionByName(bad.select(F.lit("quarantine").alias("part"), "txn_id", "reason", F.lit(None).cast("long").alias("ts_ms")))


@register("decisions_stream_model")
def q_decisions_model(spark, d):
    """T8 end to end: replayed raw rows, some unreadable and some delivered twice, are landed, their
    features streamed, scored with boosted trees fitted on the batch features, and decided once.
    Non-SQL (model fitting), so no oracle statement."""
    from cardwise.operators.model import train
    from cardwise.plans.stream_job import score_transactions
    from cardwise.session import scratch_path, write_once
    from cardwise.streaming.jobs import model_scorer, slots_for, stream_transactions_files

    base = scratch_path(spark, "scoring")
    _write_hurt_replay(spark, d, f"{base}/in")
    features = write_once(compute_features(events_txn(spark, d)), "features")
    newer = F.col("txn_id").cast("long") % 4 == 0
    model = train(features.where(~newer), features.where(newer), max_iter=5, max_depth=3)
    raw = stream_transactions_files(spark, f"{base}/in", max_files=2)
    _, query = score_transactions(spark, raw, base, model_scorer(model), 0.5, "v1", {"availableNow": True}, slots=slots_for(events_txn(spark, d)))
    query.awaitTermination()
    return spark.read.parquet(f"{base}/decisions").select("txn_id", "card_id", R("score").alias("score"), "decision", "label")


# ------------------------------------------------------------------------------- model

@register("train_evaluate_report")
def q_train_evaluate(spark, d):
    """Temporal split, boosted trees, validation threshold, test report.

    Long form (metric, value): the test report, the chosen threshold and the 27 feature
    importances. Non-SQL (model fitting), so no oracle statement.
    """
    from cardwise.plans.train_evaluate import fit_and_evaluate
    from cardwise.session import write_once

    _, rep = fit_and_evaluate(spark, write_once(compute_features(events_txn(spark, d)), "features"), max_iter=40)
    rows = [(f"test_{k}", v) for k, v in rep["test"].items()]
    rows.append(("chosen_threshold", rep["chosen_threshold"]))
    rows.append(("validation_cost_at_chosen_threshold", rep["validation_cost_at_chosen_threshold"]))
    rows += [(k, rep[k]) for k in ("best_iteration", "validation_average_precision")]
    rows += [(f"importance_{k}", v) for k, v in rep["feature_importance"].items()]
    return spark.createDataFrame([(k, None if v is None else float(v)) for k, v in rows], "metric string, value double")


RESET_MS = 200 * 86_400_000


def _reset_src_sql(src: str, reset_ms: int) -> str:
    return f"""WITH o AS ({src}),
p AS (SELECT *, lag(ts_ms) OVER (PARTITION BY card_id ORDER BY ts_ms, txn_id) AS prev FROM o),
e AS (SELECT *, sum(CASE WHEN ts_ms - prev > {reset_ms} THEN 1 ELSE 0 END)
                  OVER (PARTITION BY card_id ORDER BY ts_ms, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS epoch
      FROM p)
SELECT txn_id, card_id || chr(1) || CAST(epoch AS VARCHAR) AS card_id, ts_ms, amount, mcc, merchant_id, lat, lon, label FROM e"""


@register(
    "features_reset_orders",
    f"SELECT * REPLACE (split_part(card_id, chr(1), 1) AS card_id) FROM ({features_sql(_reset_src_sql(ORD_SQL, RESET_MS))}) f",
)
def q_features_reset(spark, d):
    """Features with history forgotten after a 200-day idle gap (orders view)."""
    return report_features(compute_features(orders_txn(spark, d), reset_after_ms=RESET_MS))


def _idle_stream(spark, d, base: str) -> DataFrame:
    from cardwise.streaming.jobs import slots_for, stream_features, stream_transactions_files, typed_stream
    from cardwise.streaming.replay import write_replay_files

    t = orders_txn(spark, d)
    write_replay_files(t, f"{base}/in", 8)
    return stream_features(typed_stream(stream_transactions_files(spark, f"{base}/in", max_files=1)), idle_ms=RESET_MS, slots=slots_for(t))


@register(
    "features_stream_idle",
    f"SELECT * REPLACE (split_part(card_id, chr(1), 1) AS card_id) FROM ({features_sql(_reset_src_sql(ORD_SQL, RESET_MS))}) f",
)
def q_features_stream_idle(spark, d):
    """The stream forgets cards that have been idle for 200 days, as the batch path does."""
    from cardwise.session import scratch_path

    base = scratch_path(spark, "idle")
    return report_features(drain_to_parquet(_idle_stream(spark, d, base), base))


@register(
    "stream_idle_cards",
    f"""WITH e AS ({_reset_src_sql(ORD_SQL, RESET_MS)}),
last AS (SELECT split_part(card_id, chr(1), 1) AS card_id, CAST(split_part(card_id, chr(1), 2) AS BIGINT) AS epoch, ts_ms FROM e),
kept AS (SELECT card_id, epoch, count(*) AS txn_count, max(ts_ms) AS last_ts FROM last GROUP BY card_id, epoch
         QUALIFY epoch = max(epoch) OVER (PARTITION BY card_id))
SELECT card_id, txn_count, last_ts FROM kept WHERE last_ts + {RESET_MS} + 1 > (SELECT max(ts_ms) FROM last)""",
)
def q_stream_idle_cards(spark, d):
    """What the state store holds once the stream has ended; timers have cleared idle cards."""
    from cardwise.session import scratch_path
    from cardwise.streaming.jobs import state_snapshot

    base = scratch_path(spark, "idle-state")
    writer = _idle_stream(spark, d, base).writeStream.format("noop").option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True)
    start_stream(writer, spark).awaitTermination()
    return state_snapshot(spark, f"{base}/ckpt").select(
        F.col("key.card_id").alias("card_id"), F.col("value.txn_count").alias("txn_count"), F.col("value.last_ts").alias("last_ts")
    )


@register(
    "stream_state_snapshot",
    f"SELECT card_id, count(*) AS txn_count, CAST(max(ts_ms) AS BIGINT) AS last_ts FROM ({TXN_SQL}) t GROUP BY card_id",
)
def q_state_snapshot(spark, d):
    """Per-card state read from a finished stream's checkpoint (count and clock)."""
    from cardwise.session import scratch_path
    from cardwise.streaming.jobs import state_snapshot, stream_features, stream_transactions_files, typed_stream
    from cardwise.streaming.replay import write_replay_files

    base = scratch_path(spark, "snapshot")
    write_replay_files(events_txn(spark, d), f"{base}/in", 4)
    stream = typed_stream(stream_transactions_files(spark, f"{base}/in", max_files=1))
    q = (
        stream_features(stream)
        .writeStream.format("noop")
        .option("checkpointLocation", f"{base}/ckpt")
        .trigger(availableNow=True)
    )
    q = start_stream(q, spark)
    q.awaitTermination()
    snap = state_snapshot(spark, f"{base}/ckpt")
    return snap.select(
        F.col("key.card_id").alias("card_id"),
        F.col("value.txn_count").alias("txn_count"),
        F.col("value.last_ts").alias("last_ts"),
    )


def _replay_with_redelivery(spark, d, base: str, n_files: int = 8):
    from cardwise.streaming.replay import redeliver, write_replay_files

    names = write_replay_files(events_txn(spark, d), f"{base}/in", n_files)
    redeliver(spark, names[n_files // 2], "part-redelivered-a.json")
    redeliver(spark, names[-1], "part-redelivered-b.json")


@register("features_stream_redelivery", features_sql(TXN_SQL))
def q_features_redelivery(spark, d):
    """T6 + T1: two replay files are delivered twice; deduplication keeps every
    transaction's features exactly as in a clean replay."""
    from cardwise.session import scratch_path
    from cardwise.streaming.jobs import dedupe_stream, slots_for, stream_features, stream_transactions_files, typed_stream

    base = scratch_path(spark, "redelivery")
    _replay_with_redelivery(spark, d, base)
    stream = dedupe_stream(typed_stream(stream_transactions_files(spark, f"{base}/in", max_files=1)))
    return report_features(drain_to_parquet(stream_features(stream, slots=slots_for(events_txn(spark, d))), base))


def _hash_scorer(df):
    from cardwise.sources.views import SCORE_MOD, SCORE_MULT

    return df.withColumn("score", (F.col("txn_id").cast("long") * SCORE_MULT) % SCORE_MOD / F.lit(1000.0))


@register(
    "decisions_stream_upsert",
    f"SELECT txn_id, card_id, {RS('score')} AS score, decision, label FROM ({DEC_SQL}) d",
)
def q_decisions_stream(spark, d):
    """T8 + K3: features stream -> per-batch scoring -> first-writer-wins decisions table.

    The whole stream is run twice (a full redelivery with a fresh checkpoint); the table
    still holds one decision per transaction.
    """
    from cardwise.session import scratch_path
    from cardwise.streaming.jobs import stream_decisions, stream_features, stream_transactions_files, typed_stream
    from cardwise.streaming.replay import write_replay_files

    base = scratch_path(spark, "decisions")
    write_replay_files(events_txn(spark, d), f"{base}/in", 4)
    for attempt in ("a", "b"):
        feats = stream_features(typed_stream(stream_transactions_files(spark, f"{base}/in", max_files=1)))
        q = stream_decisions(
            feats, _hash_scorer, DECISION_THRESHOLD, "v1", f"{base}/decisions", f"{base}/ckpt-{attempt}",
            trigger={"availableNow": True},
        )
        q.awaitTermination()
    t = spark.read.parquet(f"{base}/decisions")
    return t.select("txn_id", "card_id", R("score").alias("score"), "decision", "label")


@register("features_stream_event_time", features_sql(TXN_SQL))
def q_features_event_time(spark, d):
    """T5: out-of-order arrival (neighbouring replay files swapped) through the event-time
    processor with a 10-day watermark delay; a final sentinel row flushes the last window."""
    from cardwise.session import scratch_path
    from cardwise.streaming.jobs import slots_for, stream_features_event_time, stream_transactions_files, typed_stream
    from cardwise.streaming.replay import set_arrival_order, write_flush_row, write_replay_files

    base = scratch_path(spark, "event-time")
    t = events_txn(spark, d)
    names = write_replay_files(t, f"{base}/in", 16)
    order = [i ^ 1 for i in range(len(names))]  # 1, 0, 3, 2, ...
    set_arrival_order(spark, names, order)
    last = t.agg(F.max("ts_ms")).first()[0]
    write_flush_row(spark, f"{base}/in", last + 30 * 86_400_000, len(names) + 1)
    stream = typed_stream(stream_transactions_files(spark, f"{base}/in", max_files=1))
    return report_features(drain_to_parquet(stream_features_event_time(stream, "10 days", slots=slots_for(t)), base))


@register("features_txn_hot", features_sql(TXN_SQL))
def q_features_hot(spark, d):
    """W1 with the hot-card path forced: every card with >= 50 rows gets 2-hour buckets and
    routed window probes (no 24 h context copies); values must not change."""
    return report_features(compute_features(events_txn(spark, d), hot_rows=50, hot_bucket_ms=2 * 3_600_000))


def _full_report_sql(thr: float) -> str:
    flag = f"score >= {thr}"
    miss_amt = f"coalesce(sum(CAST(amount AS DECIMAL(38,10))) FILTER (WHERE NOT ({{f}}) AND label = 1), 0)"
    cost = (
        "(count(*) FILTER (WHERE ({f}) AND label = 0) * 150.0 + CAST(" + miss_amt + " AS DOUBLE) * 1.0"
        " + count(*) FILTER (WHERE NOT ({f}) AND label = 1) * 500.0)"
    )
    budget_rows = []
    for b in metrics.DEFAULT_BUDGETS:
        for m, expr in (
            ("reviewed_n", "k"),
            ("precision", "caught * 1.0 / k"),
            ("recall_count", "CASE WHEN p > 0 THEN caught * 1.0 / p ELSE 0 END"),
            ("recall_value", "CASE WHEN pv <> 0 THEN CAST(cv AS DOUBLE) / CAST(pv AS DOUBLE) ELSE 0 END"),
        ):
            budget_rows.append(
                f"SELECT 'budget_{b!r}_{m}' AS metric, CAST({expr} AS DOUBLE) AS value FROM bud WHERE review_rate = {b!r}"
            )
    ks = " UNION ALL ".join(
        f"SELECT CAST({b!r} AS DOUBLE) AS review_rate, greatest(1, CAST(round_even(n * CAST({b!r} AS DOUBLE), 0) AS BIGINT)) AS k FROM base"
        for b in metrics.DEFAULT_BUDGETS
    )
    return f"""WITH s AS ({SCORED_SQL}),
r AS (SELECT *, row_number() OVER (ORDER BY score DESC, ts_ms, txn_id) AS rk,
             sum(label) OVER (ORDER BY score DESC, ts_ms, txn_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS tp FROM s),
base AS (SELECT count(*) AS n, avg(label) AS fraud_rate FROM s),
g AS (SELECT score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg FROM s GROUP BY score),
gr AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cneg FROM g),
conf AS (SELECT count(*) FILTER (WHERE {flag} AND label = 1) AS tp, count(*) FILTER (WHERE {flag} AND label = 0) AS fp,
                count(*) FILTER (WHERE NOT ({flag}) AND label = 1) AS fn,
                avg(CASE WHEN {flag} THEN 1.0 ELSE 0.0 END) AS alert FROM s),
costs AS (SELECT {cost.format(f=flag)} AS at_thr, {cost.format(f="FALSE")} AS all_cost FROM s),
k AS ({ks}),
tot AS (SELECT count(*) FILTER (WHERE label = 1) AS p,
               coalesce(sum(CAST(amount AS DECIMAL(38,10))) FILTER (WHERE label = 1), 0) AS pv FROM s),
bud AS (SELECT k.review_rate, k.k, count(*) FILTER (WHERE r.label = 1) AS caught,
               coalesce(sum(CAST(r.amount AS DECIMAL(38,10))) FILTER (WHERE r.label = 1), 0) AS cv, tot.p, tot.pv
        FROM k JOIN r ON r.rk <= k.k, tot GROUP BY k.review_rate, k.k, tot.p, tot.pv),
rows AS (
  SELECT 'n' AS metric, CAST(n AS DOUBLE) AS value FROM base
  UNION ALL SELECT 'fraud_rate', CAST(fraud_rate AS DOUBLE) FROM base
  UNION ALL SELECT 'pr_auc', coalesce(sum(CASE WHEN label = 1 THEN tp * 1.0 / rk END) / nullif(sum(label), 0), 0.0) FROM r
  UNION ALL SELECT 'roc_auc', CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN 0.5
                                   ELSE sum(pos * (2 * (cneg - neg) + neg)) / (2.0 * sum(pos) * sum(neg)) END FROM gr
  UNION ALL SELECT 'threshold', CAST({thr} AS DOUBLE)
  UNION ALL SELECT 'precision_at_threshold', CASE WHEN tp + fp > 0 THEN tp * 1.0 / (tp + fp) ELSE 0 END FROM conf
  UNION ALL SELECT 'recall_at_threshold', CASE WHEN tp + fn > 0 THEN tp * 1.0 / (tp + fn) ELSE 0 END FROM conf
  UNION ALL SELECT 'alert_rate_at_threshold', CAST(alert AS DOUBLE) FROM conf
  UNION ALL SELECT 'expected_cost_at_threshold', at_thr FROM costs
  UNION ALL SELECT 'expected_cost_approve_all', all_cost FROM costs
  UNION ALL SELECT 'cost_saved_vs_approve_all', all_cost - at_thr FROM costs
  UNION ALL {" UNION ALL ".join(budget_rows)}
)
SELECT metric, {RS('value')} AS value FROM rows"""


@register("full_report", _full_report_sql(DECISION_THRESHOLD))
def q_full_report(spark, d):
    """The whole evaluation report (long form) at the decision threshold."""
    rep = metrics.full_report(scored_events(spark, d), DECISION_THRESHOLD)
    return rep.select("metric", R("value").alias("value"))


@register("features_table_round_trip", features_sql(TXN_SQL))
def q_features_round_trip(spark, d):
    """K1 + S8: features written as the day-partitioned table (shared scratch folder) and
    read back (unlabelled rows dropped at the scan)."""
    from cardwise.session import scratch_path
    from cardwise.sources.readers import read_features
    from cardwise.sources.sinks import write_features

    path = scratch_path(spark, "features")
    write_features(compute_features(events_txn(spark, d)), path)
    return report_features(read_features(spark, path))


@register("normalized_csv_round_trip", VIEW_SQL["txn"]())
def q_csv_round_trip(spark, d):
    """K5 + S3: the transaction view written as normalised CSV and read back typed."""
    from cardwise.session import scratch_path
    from cardwise.sources.readers import read_transactions
    from cardwise.sources.sinks import write_normalized

    path = scratch_path(spark, "normalized")
    write_normalized(events_txn(spark, d), path)
    return read_transactions(spark, "normalized", path)


_IEEE_EPOCH_S = 1_512_086_400


def _ieee_sql() -> str:
    region = "(CAST(((TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 25) + 25) % 25 AS VARCHAR) || ':NA')"

    def u(part):
        return (
            f"(CAST(CAST(('0x' || substr(sha256('{part}|' || {region}), 1, 16)) AS UBIGINT) AS DOUBLE)"
            " / 18446744073709551616.0)"
        )

    dt = f"((epoch_us(ts) // 1000 - {_IEEE_EPOCH_S * 1000}) / 1000.0)"
    return f"""SELECT CAST(event_id AS VARCHAR) AS txn_id,
       CAST(user_id AS VARCHAR) || '-NA-NA-NA-' || CAST(((TRY_CAST(json_extract_string(props, '$.k') AS BIGINT) % 25) + 25) % 25 AS VARCHAR) || '-NA' AS card_id,
       CAST(trunc((CAST({_IEEE_EPOCH_S} AS DOUBLE) + {dt}) * 1000.0) AS BIGINT) AS ts_ms,
       value AS amount,
       coalesce(nullif(event_type, ''), 'NA') AS mcc,
       'm' || json_extract_string(props, '$.k') || '.com' AS merchant_id,
       round(-55.0 + {u('lat')} * 125.0, 5) AS lat,
       round(-170.0 + {u('lon')} * 340.0, 5) AS lon,
       CAST(CASE WHEN (event_id * 104729) % 200 < 7 THEN 1 ELSE 0 END AS INTEGER) AS label
FROM events"""


@register("ieee_reader", _ieee_sql())
def q_ieee_reader(spark, d):
    """S1 (+P1-P4): ``events`` written in the IEEE-CIS CSV layout (card2/3/5 and addr2 blank,
    addr1 = merchant nation, time as seconds after 2017-12-01) and read back by the adapter."""
    from cardwise.session import scratch_path
    from cardwise.sources.readers import IEEE_COLUMNS, read_ieee
    from cardwise.sources.views import _label

    ev = table(spark, d, "events")
    k = F.get_json_object("props", "$.k")
    ts_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    out = ev.select(
        F.col("event_id").cast("string").alias("TransactionID"),
        ((ts_ms - F.lit(_IEEE_EPOCH_S * 1000)) / F.lit(1000.0)).alias("TransactionDT"),
        F.col("value").alias("TransactionAmt"),
        F.col("event_type").alias("ProductCD"),
        F.col("user_id").cast("string").alias("card1"),
        F.lit(None).cast("string").alias("card2"),
        F.lit(None).cast("string").alias("card3"),
        F.lit(None).cast("string").alias("card5"),
        F.pmod(k.cast("long"), F.lit(25)).cast("string").alias("addr1"),
        F.lit(None).cast("string").alias("addr2"),
        F.concat(F.lit("m"), k, F.lit(".com")).alias("P_emaildomain"),
        _label("event_id").alias("isFraud"),
    ).select(*IEEE_COLUMNS)
    path = scratch_path(spark, "ieee")
    out.write.option("header", "true").csv(path)
    return read_ieee(spark, path)


@register(
    "sparkov_reader",
    f"""SELECT CAST(e.event_id AS VARCHAR) AS txn_id, CAST(e.user_id AS VARCHAR) AS card_id,
       CAST(epoch_us(date_trunc('second', e.ts)) // 1000 AS BIGINT) AS ts_ms,
       e.value AS amount, e.event_type AS mcc, 'm' || json_extract_string(e.props, '$.k') AS merchant_id,
       g.lat AS lat, g.lon AS lon,
       CAST(CASE WHEN (e.event_id * 104729) % 200 < 7 THEN 1 ELSE 0 END AS INTEGER) AS label
FROM events e
LEFT JOIN ({GEO_SQL}) g ON g.geo_key = ((TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) % 25) + 25) % 25""",
)
def q_sparkov_reader(spark, d):
    """``events`` written in the Sparkov CSV layout (zone-less text time to the second,
    merchant coordinates) and read back by the adapter (text time read as UTC)."""
    from cardwise.session import scratch_path
    from cardwise.sources.readers import SPARKOV_COLUMNS, read_sparkov
    from cardwise.sources.views import _label

    t = events_txn(spark, d)
    ev = table(spark, d, "events").select(F.col("event_id"), F.col("ts"), F.col("event_type"))
    j = t.join(ev, t.txn_id == F.lpad(F.col("event_id").cast("string"), 12, "0"))
    out = j.select(
        F.date_format(F.col("ts"), "yyyy-MM-dd HH:mm:ss").alias("trans_date_trans_time"),
        F.col("card_id").alias("cc_num"),
        F.concat(F.lit("m"), F.col("merchant_id")).alias("merchant"),
        F.col("event_type").alias("category"),
        F.col("amount").alias("amt"),
        F.col("event_id").cast("string").alias("trans_num"),
        F.col("lat").alias("merch_lat"),
        F.col("lon").alias("merch_long"),
        _label("event_id").alias("is_fraud"),
    ).select(*SPARKOV_COLUMNS)
    path = scratch_path(spark, "sparkov")
    out.write.option("header", "true").csv(path)
    return read_sparkov(spark, path)


def _violations_sql(src: str, arrival: str) -> str:
    return f"""WITH t AS ({src}),
l AS (SELECT ts_ms, txn_id, lag(ts_ms) OVER (ORDER BY {arrival}) AS pts, lag(txn_id) OVER (ORDER BY {arrival}) AS ptx FROM t)
SELECT count(*) AS rows,
       count(*) FILTER (WHERE pts IS NOT NULL AND (ts_ms < pts OR (ts_ms = pts AND txn_id < ptx))) AS violations
FROM l"""


@register("arrival_order_events", _violations_sql(TXN_SQL, "CAST(txn_id AS BIGINT)"))
def q_order_events(spark, d):
    """(ts_ms, txn_id) never goes backwards when events arrive by event id."""
    from cardwise.operators.features import ordering_violations

    return ordering_violations(events_txn(spark, d).withColumn("arrival", F.col("txn_id").cast("long")), "arrival")


@register("arrival_order_orders", _violations_sql(ORD_SQL, "CAST(txn_id AS BIGINT)"))
def q_order_orders(spark, d):
    """Orders arriving by order key are out of event order (the guard counts them)."""
    from cardwise.operators.features import ordering_violations

    return ordering_violations(orders_txn(spark, d).withColumn("arrival", F.col("txn_id").cast("long")), "arrival")


@register("features_payload_round_trip", features_sql(TXN_SQL))
def q_payload_round_trip(spark, d):
    """P12 + S7 (+C5): features encoded as the keyed JSON payload and parsed back; the key
    must equal the payload's card (rows failing that are dropped and would show as missing)."""
    from cardwise.session import write_once
    from cardwise.streaming.jobs import read_feature_payloads, to_payload

    # written once: Spark pushes the filter on the payload below the features, which it would then
    # compute anew, nested in each other, for every part of the condition
    p = to_payload(write_once(compute_features(events_txn(spark, d)), "features"))
    p = p.filter(F.col("card_id") == F.get_json_object("payload", "$.card_id"))
    return report_features(read_feature_payloads(p))
