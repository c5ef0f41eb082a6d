"""Evaluation metrics against tiny hand-computed arrays (ties, single class)."""

import math

import pytest

from cardwise.operators import metrics
from cardwise.schema import CostModel


def _scored(spark, rows):
    data = [(f"t{i:03d}", i, float(s), int(y), float(a)) for i, (s, y, a) in enumerate(rows)]
    return spark.createDataFrame(data, "txn_id string, ts_ms long, score double, label int, amount double")


def _ap(rows):
    order = sorted(range(len(rows)), key=lambda i: (-rows[i][0], i))
    p = sum(r[1] for r in rows)
    if p == 0:
        return 0.0
    tp, acc = 0, 0.0
    for k, i in enumerate(order, 1):
        if rows[i][1]:
            tp += 1
            acc += tp / k
    return acc / p


def _auc(rows):
    pos = [r[0] for r in rows if r[1] == 1]
    neg = [r[0] for r in rows if r[1] == 0]
    if not pos or not neg:
        return 0.5
    s = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p in pos for n in neg)
    return s / (len(pos) * len(neg))


CASES = [
    [(0.9, 1, 10), (0.8, 0, 5), (0.8, 1, 7), (0.1, 0, 3), (0.5, 1, 1), (0.5, 0, 2), (0.5, 0, 9)],
    [(0.3, 0, 1), (0.3, 0, 2), (0.3, 1, 3), (0.3, 1, 4)],
    [(0.2, 0, 1), (0.4, 0, 2)],
]


@pytest.mark.parametrize("rows", CASES)
def test_pr_and_roc(spark, rows):
    df = _scored(spark, rows)
    assert metrics.pr_auc(df).first()[0] == pytest.approx(_ap(rows))
    assert metrics.roc_auc(df).first()[0] == pytest.approx(_auc(rows))


def test_cost_curve_and_threshold(spark):
    rows = CASES[0]
    df = _scored(spark, rows)
    cost = CostModel()
    curve = metrics.cost_curve(df, cost, n_points=7).orderBy("i").collect()
    grid = metrics.linspace(0.1, 0.9, 7)
    for r, t in zip(curve, grid):
        fp = sum(1 for s, y, a in rows if s >= t and y == 0)
        miss = [(s, y, a) for s, y, a in rows if s < t and y == 1]
        want = fp * 150 + sum(a for _, _, a in miss) + 500 * len(miss)
        assert r["threshold"] == t and r["expected_cost"] == pytest.approx(want)
    best = metrics.optimal_threshold(df, cost, n_points=7).first()
    costs = [r["expected_cost"] for r in curve]
    assert best["threshold"] == grid[costs.index(min(costs))]


def test_budget_rounding_half_even(spark):
    rows = [(1 - i / 100, int(i % 3 == 0), 1.0) for i in range(50)]
    m = {r["review_rate"]: r for r in metrics.metrics_at_budget(_scored(spark, rows), (0.05, 0.01)).collect()}
    assert m[0.05]["reviewed_n"] == 2.0  # round(2.5) == 2
    assert m[0.01]["reviewed_n"] == 1.0  # max(1, round(0.5) == 0)


def test_percentiles_nearest_rank(spark):
    df = spark.createDataFrame([(float(x),) for x in [5, 1, 4, 2, 3]], "v double")
    got = {r["q"]: r["value"] for r in metrics.nearest_rank_percentiles(df, "v", (0.5, 0.95, 0.0)).collect()}
    assert got == {0.5: 3.0, 0.95: 5.0, 0.0: 1.0}
    empty = spark.createDataFrame([], "v double")
    assert math.isnan(metrics.nearest_rank_percentiles(empty, "v", (0.5,)).first()["value"])
