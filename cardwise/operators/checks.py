"""Data-quality checks (C1-C6) and table comparisons (J1-J3), all as distributed queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwise.schema import APPROVE, FEATURE_ORDER, REVIEW


def score_and_decision_ranges(d: DataFrame) -> DataFrame:
    """Counts of scores outside [0, 1] and of decisions outside the domain."""
    return d.agg(
        F.count_if(~F.col("score").between(0.0, 1.0) | F.col("score").isNull()).alias("bad_scores"),
        F.count_if(~F.col("decision").isin(APPROVE, REVIEW) | F.col("decision").isNull()).alias("bad_decisions"),
    )


def duplicate_ids(d: DataFrame, key: str = "txn_id") -> DataFrame:
    """Ids present more than once (partial aggregation; no per-id collection)."""
    return d.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > 1)


def cold_starts(features: DataFrame) -> DataFrame:
    """First-transaction flags vs distinct cards (equal when every card starts once)."""
    return features.agg(
        F.count_if(F.col("is_first_txn_for_card") == 1.0).alias("cold_starts"),
        F.count_distinct("card_id").alias("cards"),
    )


def busiest_card(features: DataFrame) -> DataFrame:
    """C4: the busiest card's row count and its last row's prior count (expected n - 1).

    Two partial aggregates: per-card (count, last row's prior count), then the top card.
    """
    per = features.groupBy("card_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by("prior_txn_count", F.struct("ts_ms", "txn_id")).alias("last_prior_count"),
    )
    return per.orderBy(F.col("n").desc(), F.col("card_id")).limit(1)


def payload_keys_match(out: DataFrame) -> DataFrame:
    """Rows whose output key differs from the card in the payload."""
    parsed = out.select("card_id", F.get_json_object("payload", "$.card_id").alias("_pc"))
    return parsed.filter(~F.col("card_id").eqNullSafe(F.col("_pc")))


def feature_nulls(features: DataFrame, names: Sequence[str] = FEATURE_ORDER) -> DataFrame:
    """NULL count per feature column (one pass)."""
    return features.agg(*[F.count_if(F.col(n).isNull()).alias(n) for n in names])


def reconcile_ids(expected: DataFrame, actual: DataFrame, key: str = "txn_id") -> DataFrame:
    """Ids missing from ``actual`` and ids unexpected in it."""
    e, a = expected.select(key).distinct(), actual.select(key).distinct()
    missing = e.join(a, key, "left_anti").withColumn("kind", F.lit("missing"))
    extra = a.join(e, key, "left_anti").withColumn("kind", F.lit("unexpected"))
    return missing.unionByName(extra)


def feature_parity(
    a: DataFrame, b: DataFrame, names: Sequence[str] = FEATURE_ORDER, tol: float = 0.0, key: str = "txn_id"
) -> DataFrame:
    """Per-row, per-feature differences of two feature tables (long form).

    Rows present on one side only are reported with feature ``<presence>``. A pair differs
    when ``|x - y| > tol`` or exactly one side is NULL.
    """
    sel_a = a.select(key, *[F.col(n).alias(f"a__{n}") for n in names], F.lit(True).alias("_in_a"))
    sel_b = b.select(key, *[F.col(n).alias(f"b__{n}") for n in names], F.lit(True).alias("_in_b"))
    j = sel_a.join(sel_b, key, "full_outer")
    presence = j.filter(F.col("_in_a").isNull() | F.col("_in_b").isNull()).select(
        key, F.lit("<presence>").alias("feature"), F.lit(None).cast("double").alias("a"), F.lit(None).cast("double").alias("b")
    )
    both = j.filter(F.col("_in_a") & F.col("_in_b"))
    longs = both.select(
        key,
        F.explode(
            F.array(*[F.struct(F.lit(n).alias("feature"), F.col(f"a__{n}").alias("a"), F.col(f"b__{n}").alias("b")) for n in names])
        ).alias("p"),
    ).select(key, "p.feature", "p.a", "p.b")
    differs = (F.col("a").isNull() != F.col("b").isNull()) | (F.abs(F.col("a") - F.col("b")) > tol)
    return presence.unionByName(longs.filter(differs))


def leak_probe(features: DataFrame) -> DataFrame:
    """J3 negative control: rows where the whole-history card mean differs from the
    point-in-time prior mean (a leaky feature would make them equal).

    The whole-history mean is a partial aggregate joined back on card_id, not a window over
    each card's full partition.
    """
    full = features.groupBy("card_id").agg(F.avg("amount").alias("card_mean_all"))
    j = features.join(full, "card_id")
    return j.filter(F.abs(F.col("card_mean_all") - F.col("prior_amount_mean")) > 1e-9).select(
        "txn_id", "card_id", "prior_amount_mean", "card_mean_all"
    )
