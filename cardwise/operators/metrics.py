"""Evaluation metrics for a scored table (columns ``score``, ``label``, ``amount`` and the
event order ``ts_ms``, ``txn_id``). Only scalars or tiny tables reach the driver.

Ranking metrics use the order (score desc, ts_ms, txn_id): the stable order of a score
sort over rows already in event order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwise.operators.ordered import global_rank, order_statistic
from cardwise.schema import COST_CURVE_POINTS, DEFAULT_BUDGETS, CostModel

_DEC = "decimal(38,10)"


def rank_order():
    return [F.col("score").desc(), F.col("ts_ms"), F.col("txn_id")]


def _pos():
    return F.col("label") == 1


def _neg():
    return F.col("label") == 0


def expected_cost(df: DataFrame, threshold: float | None, cost: CostModel = CostModel()) -> DataFrame:
    """A7 (A8 when ``threshold`` is None = +inf): one row ``expected_cost``."""
    flagged = F.lit(False) if threshold is None else (F.col("score") >= F.lit(threshold))
    missed = ~flagged & _pos()
    agg = df.agg(
        F.count_if(flagged & _neg()).alias("fp"),
        F.coalesce(F.sum(F.when(missed, F.col("amount").cast(_DEC))), F.lit(0).cast(_DEC)).alias("fn_value"),
        F.count_if(missed).alias("fn"),
    )
    total = (
        F.col("fp") * F.lit(cost.false_positive_cost)
        + F.col("fn_value").cast("double") * F.lit(cost.chargeback_loss_fraction)
        + F.col("fn") * F.lit(cost.chargeback_fixed_cost)
    )
    return agg.select(total.alias("expected_cost"))


def linspace(lo: float, hi: float, n: int) -> list[float]:
    """Same arithmetic as an evenly spaced grid ``lo + i * step`` with the end pinned to hi."""
    if n == 1:
        return [lo]
    step = (hi - lo) / (n - 1)
    grid = [i * step + lo if step != 0 else lo for i in range(n)]
    grid[-1] = hi
    return grid


def _grid_index(score, grid: list[float]):
    """Number of grid points <= score, exact: arithmetic guess corrected by two comparisons."""
    n = len(grid)
    lo, hi = grid[0], grid[-1]
    arr = F.array(*[F.lit(float(g)) for g in grid])
    if hi == lo:
        return F.when(score >= F.lit(lo), F.lit(n)).otherwise(F.lit(0))
    step = (hi - lo) / (n - 1)
    guess = F.floor((score - F.lit(lo)) / F.lit(step)).cast("int") + 1
    guess = F.least(F.greatest(guess, F.lit(0)), F.lit(n))
    # guess-1 points assumed <= score: fix by checking the boundary points
    down = F.when((guess >= 1) & (F.element_at(arr, F.greatest(guess, F.lit(1))) > score), guess - 1).otherwise(guess)
    up = F.when((down < n) & (F.element_at(arr, F.least(down + 1, F.lit(n))) <= score), down + 1).otherwise(down)
    return up


def cost_curve(df: DataFrame, cost: CostModel = CostModel(), n_points: int = COST_CURVE_POINTS) -> DataFrame:
    """Expected cost at ``n_points`` thresholds evenly spaced over [min, max] score.

    Each row falls in a bucket (number of grid points <= its score); a threshold t_i
    flags buckets > i. Per-bucket totals (<= n_points + 1 rows) and suffix sums give
    every point; no row is compared with every threshold.
    """
    spark: SparkSession = df.sparkSession
    mm = df.agg(F.min("score"), F.max("score")).first()
    if mm is None or mm[0] is None:
        return spark.createDataFrame([], "i int, threshold double, expected_cost double")
    grid = linspace(float(mm[0]), float(mm[1]), n_points)
    b = _grid_index(F.col("score"), grid)
    per = df.groupBy(b.alias("b")).agg(
        F.count_if(_neg()).alias("neg"),
        F.count_if(_pos()).alias("pos"),
        F.coalesce(F.sum(F.when(_pos(), F.col("amount").cast(_DEC))), F.lit(0).cast(_DEC)).alias("pos_amt"),
    )
    pts = spark.createDataFrame([(i, g) for i, g in enumerate(grid)], "i int, threshold double")
    # Tiny tables (<= n_points + 1 rows each); the window over them is bounded by n_points.
    j = pts.join(F.broadcast(per), F.col("b") > F.col("i"), "left")  # flagged buckets
    flagged = j.groupBy("i", "threshold").agg(
        F.coalesce(F.sum("neg"), F.lit(0)).alias("fp"),
        F.coalesce(F.sum("pos"), F.lit(0)).alias("tp"),
        F.coalesce(F.sum("pos_amt"), F.lit(0).cast(_DEC)).alias("tp_amt"),
    )
    totals = per.agg(F.sum("pos").alias("P"), F.sum("pos_amt").alias("P_amt"))
    out = flagged.crossJoin(F.broadcast(totals))  # totals: exactly one row
    cost_col = (
        F.col("fp") * F.lit(cost.false_positive_cost)
        + (F.coalesce(F.col("P_amt"), F.lit(0).cast(_DEC)) - F.col("tp_amt")).cast("double")
        * F.lit(cost.chargeback_loss_fraction)
        + (F.coalesce(F.col("P"), F.lit(0)) - F.col("tp")) * F.lit(cost.chargeback_fixed_cost)
    )
    return out.select("i", "threshold", cost_col.alias("expected_cost"))


def optimal_threshold(df: DataFrame, cost: CostModel = CostModel(), n_points: int = COST_CURVE_POINTS) -> DataFrame:
    """A10: lowest threshold reaching the minimum expected cost (one row)."""
    curve = cost_curve(df, cost, n_points)
    return curve.orderBy("expected_cost", "i").limit(1).select("threshold", "expected_cost")


def pr_auc(df: DataFrame) -> DataFrame:
    """Step-wise average precision = (1/P) * sum over positives of tp_i / i."""
    ranked = global_rank(df.select("score", "ts_ms", "txn_id", F.col("label").cast("long").alias("y")), rank_order(), sums=("y",))
    return ranked.agg(
        F.coalesce(
            F.try_divide(F.sum(F.when(F.col("y") == 1, F.col("cum_y") / F.col("_rank"))), F.sum("y").cast("double")),
            F.lit(0.0),
        ).alias("pr_auc")
    )


def roc_auc(df: DataFrame) -> DataFrame:
    """Rank statistic with tie-averaged ranks; 0.5 when one class is absent."""
    return roc_auc_of_counts(df.groupBy("score").agg(F.count_if(_pos()).alias("pos"), F.count_if(_neg()).alias("neg")))


def roc_auc_of_counts(g: DataFrame) -> DataFrame:
    """A12 from (score, pos, neg), a row a score. The rank sum reaches twice the product of the
    class sizes, so it is summed in decimals."""
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    ranked = global_rank(g, [F.col("score")], sums=("neg",))
    num = F.sum((wide("pos") * (2 * wide("cum_neg") - wide("neg"))).cast("decimal(38,0)"))
    agg = ranked.agg(num.alias("num2"), F.sum("pos").alias("P"), F.sum("neg").alias("N"))
    auc = F.when((F.col("P") == 0) | (F.col("N") == 0) | F.col("P").isNull(), F.lit(0.5)).otherwise(
        F.col("num2").cast("double") / (2.0 * F.col("P").cast("double") * F.col("N").cast("double"))
    )
    return agg.select(auc.alias("roc_auc"))


def metrics_at_budget(df: DataFrame, budgets: Sequence[float] = DEFAULT_BUDGETS) -> DataFrame:
    """Precision / recall (count and value) when the top ``budget`` share is reviewed.

    k = max(1, round-half-even(n * budget)); top-k by (score desc, ts_ms, txn_id). Only rows that
    score at least as high as the last one of the largest budget are ranked; where that is comes
    from an order statistic.
    """
    pos_amt = F.when(_pos(), F.col("amount").cast(_DEC))
    tot = df.agg(F.count("*").alias("n"), F.count_if(_pos()).alias("P"), F.coalesce(F.sum(pos_amt), F.lit(0).cast(_DEC)).alias("P_value"))
    total, n_pos, pos_value = tot.first()
    if total == 0:
        return df.sparkSession.createDataFrame(
            [], "review_rate double, reviewed_n double, precision double, recall_count double, recall_value double"
        )
    rows = [(float(b), max(1, _round_half_even(total * b))) for b in budgets]
    lowest = order_statistic(df.select((-F.col("score")).alias("down")), "down", min(total, max(k for _, k in rows)))
    top = df.select("score", "ts_ms", "txn_id", "label", "amount").where(-F.col("score") <= F.lit(lowest))
    ranked = global_rank(top, rank_order())
    kdf = df.sparkSession.createDataFrame(rows, "review_rate double, k long")
    # kdf has one row per budget: each ranked row meets at most len(budgets) of them.
    j = ranked.join(F.broadcast(kdf), F.col("_rank") <= F.col("k"))
    per = j.groupBy("review_rate", "k").agg(
        F.count_if(_pos()).alias("caught"), F.coalesce(F.sum(pos_amt), F.lit(0).cast(_DEC)).alias("caught_value")
    )
    return per.select(
        "review_rate",
        F.col("k").cast("double").alias("reviewed_n"),
        (F.col("caught") / F.col("k")).alias("precision"),
        (F.col("caught") / F.lit(n_pos) if n_pos else F.lit(0.0)).alias("recall_count"),
        (F.col("caught_value").cast("double") / F.lit(float(pos_value)) if pos_value else F.lit(0.0)).alias("recall_value"),
    )


def _round_half_even(x: float) -> int:
    return int(round(x))


def confusion_at_threshold(df: DataFrame, threshold: float) -> DataFrame:
    """Tp, fp, fn, precision, recall (0 when empty) and alert rate at a threshold."""
    flagged = F.col("score") >= F.lit(threshold)
    agg = df.agg(
        F.count_if(flagged & _pos()).alias("tp"),
        F.count_if(flagged & _neg()).alias("fp"),
        F.count_if(~flagged & _pos()).alias("fn"),
        F.avg(F.when(flagged, 1.0).otherwise(0.0)).alias("alert_rate"),
    )
    return agg.select(
        "tp",
        "fp",
        "fn",
        F.when(F.col("tp") + F.col("fp") > 0, F.col("tp") / (F.col("tp") + F.col("fp"))).otherwise(0.0).alias("precision"),
        F.when(F.col("tp") + F.col("fn") > 0, F.col("tp") / (F.col("tp") + F.col("fn"))).otherwise(0.0).alias("recall"),
        "alert_rate",
    )


def full_report(
    df: DataFrame, threshold: float, cost: CostModel = CostModel(), budgets: Sequence[float] = DEFAULT_BUDGETS
) -> DataFrame:
    """The evaluation report in long form: (metric, value) rows."""
    spark = df.sparkSession
    base = df.agg(F.count(F.lit(1)).alias("n"), F.avg("label").alias("fraud_rate")).first()
    at_thr = expected_cost(df, threshold, cost).first()[0]
    approve_all = expected_cost(df, None, cost).first()[0]
    conf = confusion_at_threshold(df, threshold).first()
    rows = [
        ("n", float(base["n"])),
        ("fraud_rate", float(base["fraud_rate"]) if base["fraud_rate"] is not None else None),
        ("pr_auc", float(pr_auc(df).first()[0])),
        ("roc_auc", float(roc_auc(df).first()[0])),
        ("threshold", float(threshold)),
        ("precision_at_threshold", float(conf["precision"])),
        ("recall_at_threshold", float(conf["recall"])),
        ("alert_rate_at_threshold", float(conf["alert_rate"]) if conf["alert_rate"] is not None else None),
        ("expected_cost_at_threshold", float(at_thr)),
        ("expected_cost_approve_all", float(approve_all)),
        ("cost_saved_vs_approve_all", float(approve_all - at_thr)),
    ]
    for r in metrics_at_budget(df, budgets).collect():  # one row per budget
        for m in ("reviewed_n", "precision", "recall_count", "recall_value"):
            rows.append((f"budget_{r['review_rate']}_{m}", float(r[m])))
    return spark.createDataFrame(rows, "metric string, value double")


def nearest_rank_percentiles(df: DataFrame, col: str, qs: Sequence[float], rule: str = "round") -> DataFrame:
    """Value at sorted index ``min(n-1, round-half-even(q*(n-1)))`` (``rule='round'``)
    or ``int(n*q)`` (``rule='floor'``); NaN when empty. Exact (bracketed order statistics).
    """
    from cardwise.operators.ordered import order_statistics

    spark = df.sparkSession
    vals = df.select(F.col(col).alias("_v")).filter(F.col("_v").isNotNull())
    n = vals.count()
    if n == 0:
        return spark.createDataFrame([(float(q), float("nan")) for q in qs], "q double, value double")
    idx = {}
    for q in qs:
        i = min(n - 1, int(round(q * (n - 1)))) if rule == "round" else min(n - 1, int(n * q))
        idx[float(q)] = i + 1
    by_rank = order_statistics(vals, "_v", list(set(idx.values())))
    return spark.createDataFrame([(q, float(by_rank[k])) for q, k in idx.items()], "q double, value double")


def bench_summary(decisions: DataFrame, published: int | None = None) -> DataFrame:
    """Observed count, completeness vs published, latency p50/p95/p99 (nearest rank), max, mean."""
    lat = decisions.select(F.col("e2e_latency_ms").alias("v"))
    pct = {r["q"]: r["value"] for r in nearest_rank_percentiles(lat, "v", (0.5, 0.95, 0.99)).collect()}
    agg = lat.agg(F.count(F.lit(1)).alias("n"), F.max("v").alias("mx"), F.avg("v").alias("mean")).first()
    n = int(agg["n"])
    pub = published if published is not None else n
    spark = decisions.sparkSession
    row = [
        (
            n,
            float(round(n / pub, 4)) if pub else 0.0,
            pct[0.5],
            pct[0.95],
            pct[0.99],
            float(agg["mx"]) if agg["mx"] is not None else None,
            float(agg["mean"]) if agg["mean"] is not None else None,
        )
    ]
    return spark.createDataFrame(
        row, "decisions_observed long, completeness double, p50 double, p95 double, p99 double, max double, mean double"
    )


def cumulative(df: DataFrame, order_col: str, value_col: str, out_col: str) -> DataFrame:
    """Running sum over a small table (<= a few hundred rows)."""
    return df.withColumn(out_col, F.sum(value_col).over(W.orderBy(order_col).rowsBetween(W.unboundedPreceding, 0)))
