"""Global order without a single-partition window.

O1 ``global_rank`` / prefix sums: range-partition on the (unique) order key, number and
accumulate rows inside each partition, and add per-partition offsets computed from a
table with one row per partition. O2 ``order_statistic`` builds on it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwise.session import partitions, write_once


def _sort_cols(order: Sequence[Column | str]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in order]


def ranged(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """``df`` range-partitioned by ``order``, with its partition number ``_pid``, written once.

    Two branches over ``repartitionByRange`` may sample different bounds (column pruning makes
    them different plans), so a partition number only means something once it is stored."""
    return write_once(df.repartitionByRange(n, *order).withColumn("_pid", F.spark_partition_id()), "ranged")


def global_rank(
    df: DataFrame,
    order: Sequence[Column | str],
    sums: Sequence[str] = (),
    rank_col: str = "_rank",
    n_parts: int | None = None,
) -> DataFrame:
    """Add ``rank_col`` (1-based position in ``order``) and inclusive running sums.

    ``order`` must be a total order (append a unique id to break ties). Running sums are
    named ``cum_<col>``. Work per partition is bounded by the range partitioner, not by the
    data's value distribution, because the key is unique.
    """
    n = n_parts or partitions(df.sparkSession)
    cols = _sort_cols(order)
    parts = ranged(df, cols, n)
    w = W.partitionBy("_pid").orderBy(*cols)
    run = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    local = parts.select(
        "*",
        F.row_number().over(w).alias("_lrank"),
        *[F.sum(c).over(run).alias(f"_lcum_{c}") for c in sums],
    )
    totals = parts.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), *[F.sum(c).alias(f"_t_{c}") for c in sums])
    # One row per partition: offsets are a running sum over at most n rows.
    before = W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select(
        "_pid",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"),
        *[F.sum(f"_t_{c}").over(before).alias(f"_o_{c}") for c in sums],
    )
    out = local.join(F.broadcast(offsets), "_pid")  # offsets: one row per partition
    out = out.withColumn(rank_col, F.col("_off") + F.col("_lrank"))
    for c in sums:
        out = out.withColumn(f"cum_{c}", F.coalesce(F.col(f"_o_{c}"), F.lit(0)) + F.col(f"_lcum_{c}"))
    drop = ["_pid", "_lrank", "_off"] + [f"_lcum_{c}" for c in sums] + [f"_o_{c}" for c in sums]
    return out.drop(*drop)


def global_lag(df: DataFrame, order: Sequence[Column | str], col: str, out_col: str, n_parts: int | None = None) -> DataFrame:
    """Previous row's ``col`` in ``order`` (NULL for the first row), partition-parallel.

    The first row of each range partition takes the last value of the nearest earlier
    non-empty partition from a one-row-per-partition table.
    """
    n = n_parts or partitions(df.sparkSession)
    cols = _sort_cols(order)
    key = F.struct(*cols)
    parts = ranged(df, cols, n)
    w = W.partitionBy("_pid").orderBy(*cols)
    local = parts.withColumn("_llag", F.lag(col).over(w)).withColumn("_first", F.row_number().over(w) == 1)
    lasts = parts.groupBy("_pid").agg(F.max_by(F.col(col), key).alias("_last"))
    prev = lasts.select(
        "_pid", F.last("_last").over(W.orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)).alias("_plast")
    )
    out = local.join(F.broadcast(prev), "_pid", "left")
    out = out.withColumn(out_col, F.when(F.col("_first"), F.col("_plast")).otherwise(F.col("_llag")))
    return out.drop("_pid", "_llag", "_first", "_plast")


def segmented_prefix(
    df: DataFrame, segment: Sequence[str], order: Sequence[Column | str], sums: Sequence[str], n_parts: int | None = None
) -> DataFrame:
    """Add ``cum_<c>``: inclusive running sums of ``sums`` within each ``segment``, in ``order``.

    ``(segment, order)`` must be a total order. Rows are range-partitioned on it, so a segment
    with any share of all rows is spread over partitions: sums run inside (partition, segment),
    and only the first and the last segment of a partition, which may go on elsewhere, take an
    offset from a table of two rows a partition.
    """
    n = n_parts or partitions(df.sparkSession)
    cols = _sort_cols(order)
    parts = ranged(df, [*(F.col(c) for c in segment), *cols], n)
    run = W.partitionBy("_pid", *segment).orderBy(*cols).rowsBetween(W.unboundedPreceding, W.currentRow)
    local = parts.select("*", *[F.sum(c).over(run).alias(f"_lcum_{c}") for c in sums])
    key = F.struct(*segment)
    edges = parts.groupBy("_pid").agg(F.array_distinct(F.array(F.min(key), F.max(key))).alias("_e")).select("_pid", F.inline("_e"))
    # two rows a partition at most, here and in what follows
    totals = parts.join(F.broadcast(edges), ["_pid", *segment]).groupBy("_pid", *segment).agg(*[F.sum(c).alias(f"_t_{c}") for c in sums])
    before = W.partitionBy(*segment).orderBy("_pid").rowsBetween(W.unboundedPreceding, -1)
    offsets = totals.select("_pid", *segment, *[F.sum(f"_t_{c}").over(before).alias(f"_o_{c}") for c in sums])
    out = local.join(F.broadcast(offsets), ["_pid", *segment], "left")
    for c in sums:
        kind = df.schema[c].dataType
        out = out.withColumn(f"cum_{c}", F.coalesce(F.col(f"_o_{c}"), F.lit(0).cast(kind)) + F.coalesce(F.col(f"_lcum_{c}"), F.lit(0).cast(kind)))
    return out.drop("_pid", *[f"_lcum_{c}" for c in sums], *[f"_o_{c}" for c in sums])


def order_statistic(df: DataFrame, col: str, k: int, tiebreak: Sequence[str] = ()) -> object | None:
    """O2: the ``k``-th smallest value of ``col`` (1-based); None if k is out of range."""
    return order_statistics(df, col, [k], tiebreak).get(k)


def order_statistics(
    df: DataFrame, col: str, ks: Sequence[int], tiebreak: Sequence[str] = (), accuracy: int = 10_000
) -> dict[int, object]:
    """Exact k-th smallest values of ``col`` without sorting every row.

    1. one aggregation: ``percentile_approx`` brackets [lo, hi] around each wanted rank
       (rank error <= n / accuracy on each side, widened 4x);
    2. one aggregation: exact counts of rows below each ``lo`` and of rows in the bracket;
    3. only rows inside a bracket (about 8n / accuracy, plus ties) are ranked, with the
       partition-parallel :func:`global_rank`.
    A bracket whose counts do not contain k (sketch error) falls back to ranking all rows.
    """
    wanted = sorted({k for k in ks if k >= 1})
    if not wanted:
        return {}
    vals = df.select(col, *tiebreak).filter(F.col(col).isNotNull())
    n = vals.count()
    wanted = [k for k in wanted if k <= n]
    if not wanted:
        return {}
    delta = 4.0 / accuracy
    probs = []
    for k in wanted:
        p = k / n
        probs += [max(0.0, p - delta), min(1.0, p + delta)]
    q = vals.agg(F.percentile_approx(col, probs, accuracy).alias("q")).first()["q"]
    brackets = {k: (q[2 * i], q[2 * i + 1]) for i, k in enumerate(wanted)}
    counts = vals.agg(
        *[F.count_if(F.col(col) < F.lit(lo)).alias(f"below_{k}") for k, (lo, _) in brackets.items()],
        *[F.count_if(F.col(col).between(F.lit(lo), F.lit(hi))).alias(f"in_{k}") for k, (lo, hi) in brackets.items()],
    ).first()
    out: dict[int, object] = {}
    fallback = []
    for k, (lo, hi) in brackets.items():
        below, inside = counts[f"below_{k}"], counts[f"in_{k}"]
        if not (below < k <= below + inside):
            fallback.append(k)
            continue
        cand = vals.filter(F.col(col).between(F.lit(lo), F.lit(hi)))
        ranked = global_rank(cand, [col, *tiebreak])
        row = ranked.filter(F.col("_rank") == k - below).select(col).first()
        out[k] = row[0]
    if fallback:
        ranked = global_rank(vals, [col, *tiebreak])
        rows = ranked.filter(F.col("_rank").isin(fallback)).select("_rank", col).collect()  # <= len(ks) rows
        out.update({int(r[0]): r[1] for r in rows})
    return out
