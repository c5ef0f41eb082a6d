"""The 27 point-in-time features per card, computed with windows (no Python per row).

Every feature of a row reads only rows of the same card that come *before* it in
``(ts_ms, txn_id)`` order.

Layout for scale
----------------
A card's history is cut into event-time buckets and the work is keyed by ``(card_id,
bucket)``. Cards with fewer than ``dense_rows`` rows have one bucket for all their history, so
that there is nothing to carry from bucket to bucket; the others have a bucket a day
(``bucket_ms`` sets one width for all), so even a card holding a third of all rows is
spread over as many tasks as it has active days. One hash exchange on
``(card_id, bucket)`` serves every row-level window and join below.

What a bucket needs from earlier buckets arrives through a small *carry* table, one row per
non-empty ``(card_id, bucket)``, computed from per-bucket summaries (partial aggregates)
with windows over buckets (a card has at most one carry row per active day):

* rows and hour-of-day histogram before the bucket (prefix sums over buckets),
* the last row before the bucket (travel features),
* MCCs seen before, with their last time (only the MCCs occurring in the bucket),
* the last <= 50 amounts before the bucket (amount statistics).

Rows of the previous 24 h are copied into the bucket as context rows (``ctx = 1``), so the
sliding 1 m / 1 h / 24 h windows can be evaluated inside the bucket. Those windows are not
Spark sliding frames (which re-aggregate the whole frame per row, O(rows x window)); they
are differences of one running count/sum, read at the row itself and at three *probe* rows
placed at ``ts - w``. Running frames are incremental, so the cost stays O(n log n) for
any density.

Merchant novelty uses one partial aggregate (first bucket of each (card, merchant)), joined
on ``(card_id, bucket, merchant_id)`` without moving the large side.

Memory caps of the per-card state (64 MCCs, 128 merchants, LRU) only matter for cards that
exceed them. Those are found exactly (:func:`lru_overflow_cards`); only their key memory is
followed row by row, bucket by bucket in parallel (:func:`_capped_keys`), and all other facts
come from the windows as for any card. ``card_distinct_mcc_count`` is ``min(64, distinct)``
under any eviction order.

A row's identity inside its bucket is its row number ``_rid`` there, so a transaction that was
delivered twice is two rows, the second of which sees the first, as in the keyed state.

Hot cards (at least ``hot_rows`` rows) get finer buckets and routed window probes instead of
24 h context copies (:func:`_velocity_routed`).
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwise.functions.columns import hour_of_day
from cardwise.operators.joins import bounded_broadcast
from cardwise.operators.formulas import features_from_facts
from cardwise.session import partitions, persist_partitioned, write_once
from cardwise.schema import (
    AMOUNT_WINDOW,
    MAX_MCC,
    MAX_MERCHANTS,
    TXN_COLUMNS,
    WINDOW_1H_MS,
    WINDOW_1M_MS,
    WINDOW_24H_MS,
)

PROBES = (("p1m", WINDOW_1M_MS), ("p1h", WINDOW_1H_MS), ("p24h", WINDOW_24H_MS))
_SUM_TYPE = "decimal(38,10)"  # exact running sums: no cancellation in the differences
#: Rows from which a card's history is cut into days; the width (about 35,000 years) of the bucket
#: of cards with fewer.
DENSE_ROWS, WHOLE_MS = 20_000, 1 << 50


def _order():
    return [F.col("ts_ms"), F.col("txn_id")]


def _with_widths(t: DataFrame, bucket_ms: int, widths: DataFrame | None) -> DataFrame:
    """``t`` with each card's bucket width ``_bw`` and whether it is hot (``_hot``)."""
    if widths is None:
        return t.withColumns({"_bw": F.lit(bucket_ms).cast("long"), "_hot": F.lit(False)})
    t = t.join(widths, "card_id", "left")
    return t.withColumns({"_bw": F.coalesce("_bw", F.lit(bucket_ms)).cast("long"), "_hot": F.coalesce("_hot", F.lit(False))})


def _bucketed(txn: DataFrame, bucket_ms: int, widths: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(data rows, 24 h context rows), both hash-partitioned on (card_id, bucket).

    A card's bucket width is ``bucket_ms`` unless ``widths`` (card_id, _bw, _hot) names another.
    Context rows (for cards that are not hot) are copies of a row into each later bucket whose previous 24 h cover
    it (one bucket when the width is >= 24 h), reduced to the columns the sliding windows
    read. Both sides share the partitioning, so their union needs no further exchange.
    """
    n = partitions(txn.sparkSession)
    t = _with_widths(txn.select(*TXN_COLUMNS), bucket_ms, widths)
    bucket = F.floor(F.col("ts_ms") / F.col("_bw")).cast("long")
    data = t.select(
        *TXN_COLUMNS, "_bw", "_hot", bucket.alias("bucket"), F.lit(0).alias("ctx"), hour_of_day("ts_ms").alias("hour")
    )
    # Persisted: every branch below reads this one exchange (a cached relation also stops
    # branch filters from being pushed under the exchange and splitting it).
    # Ties of (ts_ms, txn_id) fall back to the other columns, so a recomputed block numbers alike.
    rid = W.partitionBy("card_id", "bucket").orderBy(*_order(), "amount", "mcc", "merchant_id", "lat", "lon", "label")
    data = persist_partitioned(data.repartition(n, "card_id", "bucket").withColumn("_rid", F.row_number().over(rid)))
    # Hot cards get no context copies (their windows use routed probes, see _velocity_routed).
    own = data.filter(~F.col("_hot")).select("card_id", "bucket", "_rid", "ts_ms", "amount", "lat", "lon", "_bw")
    copies = own.withColumn("_to", F.col("bucket") + 1) if bucket_ms >= WINDOW_24H_MS else _later_buckets(own)
    in_halo = F.col("ts_ms") >= F.col("_to") * F.col("_bw") - F.lit(WINDOW_24H_MS)
    halo = copies.filter(in_halo).select(
        "card_id", F.col("_to").alias("bucket"), "_rid", "ts_ms", "amount", "lat", "lon",
        F.lit(1).alias("ctx"),
    )
    return data, halo.repartition(n, "card_id", "bucket")


def _later_buckets(own: DataFrame) -> DataFrame:
    """Each row once for every later bucket of its card within 24 h that has rows (``_to``).

    With buckets shorter than a day most of those hours are empty for most cards, so the buckets are
    looked up by (card, block of as many buckets as 24 h have) and only copies that are read move."""
    n = partitions(own.sparkSession)
    reach = F.ceil(F.lit(WINDOW_24H_MS) / F.col("_bw")).cast("long")
    own = own.withColumns({"_reach": reach, "_block": F.floor(F.col("bucket") / reach).cast("long")})
    block = F.explode(F.array(F.col("_block") - 1, F.col("_block")))
    used = own.select("card_id", "bucket", "_block").distinct().select("card_id", "bucket", block.alias("_block"))
    used = used.groupBy("card_id", "_block").agg(F.collect_list("bucket").alias("_used"))  # 48 h of buckets
    rows = own.repartition(n, "card_id", "_block").join(used, ["card_id", "_block"])
    return rows.withColumn("_to", F.explode("_used")).filter((F.col("_to") > F.col("bucket")) & (F.col("_to") <= F.col("bucket") + F.col("_reach")))


def card_widths(
    txn: DataFrame, bucket_ms: int | None, dense_rows: int, hot_rows: int | None, hot_bucket_ms: int, max_listed: int = 100_000,
) -> tuple[int, DataFrame | None]:
    """(bucket width of most cards, (card_id, _bw, _hot) of the others or None).

    Without ``bucket_ms``, cards with fewer than ``dense_rows`` rows have one bucket and the others a
    bucket a day; cards with at least ``hot_rows`` rows are *hot* and get ``hot_bucket_ms``. Cards
    with null amounts have days as well: those of earlier days count in the amount history (and
    leave its mean null), those of the row's own day do not.
    Per-card counts are a partial aggregate; the list is broadcast only when it has at
    most ``max_listed`` rows (otherwise a shuffle join, which AQE splits when skewed).
    """
    limits = [x for x in (dense_rows if bucket_ms is None else None, hot_rows) if x is not None]
    width = bucket_ms or WHOLE_MS
    if not limits:
        return width, None
    hot = F.lit(False) if hot_rows is None else F.col("_n") >= hot_rows
    own = F.when(hot, F.lit(hot_bucket_ms)).otherwise(F.lit(bucket_ms or WINDOW_24H_MS)).cast("long")
    counted = txn.groupBy("card_id").agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col("amount").isNull()).alias("_unknown"))
    counted = counted.filter((F.col("_n") >= min(limits)) | ((F.col("_unknown") > 0) & F.lit(bucket_ms is None)))
    listed = write_once(counted.select("card_id", own.alias("_bw"), hot.alias("_hot")), "card-widths")
    if listed.limit(1).count() == 0:
        return width, None
    return width, bounded_broadcast(listed, max_listed)


def _carry(data: DataFrame) -> DataFrame:
    """One row per non-empty (card_id, bucket): what the bucket inherits from earlier ones.

    Per-bucket parts come from the (card_id, bucket) layout without an exchange; one
    exchange by card then serves both the per-MCC look-back and the prefix windows over a
    card's buckets (a card has one row per active bucket here, not one per transaction).
    """
    n = partitions(data.sparkSession)
    summary = data.groupBy("card_id", "bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.max_by(F.struct("ts_ms", "lat", "lon"), "_rid").alias("last"),
        *[F.count_if(F.col("hour") == h).alias(f"h{h}") for h in range(24)],
    )
    # Last <= 50 amounts of each bucket (top-k per group, pushed below the sort).
    tail_w = W.partitionBy("card_id", "bucket").orderBy(F.col("_rid").desc())
    tails = (
        data.select("card_id", "bucket", "_rid", "amount", F.row_number().over(tail_w).alias("_rn"))
        .filter(F.col("_rn") <= AMOUNT_WINDOW)
        .groupBy("card_id", "bucket")
        .agg(F.sort_array(F.collect_list(F.struct("_rid", "amount"))).alias("_tail"))
        .select("card_id", "bucket", F.transform("_tail", lambda x: x["amount"]).alias("tail"))
    )
    # Latest time of each MCC in the bucket (<= distinct MCCs of the bucket).
    mccs = (
        data.groupBy("card_id", "bucket", "mcc")
        .agg(F.max("ts_ms").alias("mx"))
        .groupBy("card_id", "bucket")
        .agg(F.collect_list(F.struct("mcc", "mx")).alias("mccs"))
    )
    per_bucket = summary.join(tails, ["card_id", "bucket"]).join(mccs, ["card_id", "bucket"]).repartition(n, "card_id")

    # Previous occurrence of each MCC across buckets: window by (card, mcc) on the card layout.
    m = per_bucket.select("card_id", "bucket", F.explode("mccs").alias("_m")).select(
        "card_id", "bucket", F.col("_m.mcc").alias("mcc"), F.col("_m.mx").alias("mx")
    )
    m = m.withColumn("prev_mx", F.lag("mx").over(W.partitionBy("card_id", "mcc").orderBy("bucket")))
    m = m.groupBy("card_id", "bucket").agg(
        F.map_from_entries(
            F.collect_list(F.when(F.col("prev_mx").isNotNull(), F.struct("mcc", "prev_mx")))
        ).alias("mcc_prev"),
        F.count_if(F.col("prev_mx").isNull()).alias("new_mcc"),
    )

    cw = W.partitionBy("card_id").orderBy("bucket")
    before = cw.rowsBetween(W.unboundedPreceding, -1)
    joined = per_bucket.drop("mccs").join(m, ["card_id", "bucket"])
    pt = F.flatten(F.collect_list("tail").over(cw.rowsBetween(-AMOUNT_WINDOW, -1)))
    carry = joined.select(
        "card_id",
        "bucket",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n_before"),
        F.lag("last").over(cw).alias("last_before"),
        F.array(*[F.coalesce(F.sum(f"h{h}").over(before), F.lit(0)) for h in range(24)]).alias(
            "hour_before"
        ),
        pt.alias("_pt"),
        F.coalesce(F.sum("new_mcc").over(before), F.lit(0)).alias("mcc_distinct_before"),
        "mcc_prev",
    )
    return carry.select(
        "*", F.slice("_pt", F.greatest(F.size("_pt") - (AMOUNT_WINDOW - 1), F.lit(1)), AMOUNT_WINDOW).alias("prev_tail")
    ).drop("_pt")


#: The columns of :func:`_carry`; all null for a card with one bucket.
CARRIED = {
    "n_before": "long",
    "last_before": "struct<ts_ms: long, lat: double, lon: double>",
    "hour_before": "array<long>",
    "mcc_distinct_before": "long",
    "mcc_prev": "map<string, long>",
    "prev_tail": "array<double>",
}


def _split_cards(data: DataFrame) -> DataFrame:
    """(card_id): the cards with more than one bucket."""
    buckets = data.groupBy("card_id", "bucket").agg(F.lit(1)).groupBy("card_id").agg(F.count(F.lit(1)).alias("_b"))
    return write_once(buckets.filter(F.col("_b") > 1).select("card_id"), "split-cards")


def _velocity(data: DataFrame, halo: DataFrame) -> DataFrame:
    """Prior count/sum in the last 1 m / 1 h / 24 h and the previous row, per data row.

    Each data row is exploded with three probe rows at ``ts - w`` placed after every row at
    that time; a single running count/sum over (card_id, bucket) answers all windows.
    """
    is_data = F.col("ctx") == 0
    self_ = F.struct(F.col("ts_ms").alias("k"), F.lit(0).alias("kind"), F.lit("self").alias("tag"))
    probes = [
        F.struct((F.col("ts_ms") - F.lit(w)).alias("k"), F.lit(1).alias("kind"), F.lit(tag).alias("tag"))
        for tag, w in PROBES
    ]
    marks = F.when(is_data, F.array(self_, *probes)).otherwise(F.array(self_))
    cols = ["card_id", "bucket", "_rid", "ts_ms", "amount", "lat", "lon", "ctx"]
    p = data.select(*cols).unionByName(halo.select(*cols)).select(*cols, F.explode(marks).alias("m"))
    is_row = F.col("m.kind") == 0
    run_w = W.partitionBy("card_id", "bucket").orderBy(F.col("m.k"), F.col("m.kind"), F.col("_rid"))
    upto = run_w.rowsBetween(W.unboundedPreceding, W.currentRow)
    p = p.select(
        "card_id",
        "bucket",
        "_rid",
        "ctx",
        "amount",
        F.col("m.tag").alias("tag"),
        F.sum(F.when(is_row, 1).otherwise(0)).over(upto).alias("cnt"),
        F.sum(F.when(is_row, F.col("amount").cast(_SUM_TYPE))).over(upto).alias("amt"),
        F.last(F.when(is_row, F.struct("ts_ms", "lat", "lon")), ignorenulls=True)
        .over(run_w.rowsBetween(W.unboundedPreceding, -1))
        .alias("prev"),
    ).filter(F.col("ctx") == 0)

    def at(tag: str, c: str) -> Column:
        return F.max(F.when(F.col("tag") == tag, F.col(c)))

    v = p.groupBy("card_id", "bucket", "_rid").agg(
        at("self", "cnt").alias("cnt_self"),
        at("self", "amt").alias("amt_self"),
        F.max(F.when(F.col("tag") == "self", F.col("amount").cast(_SUM_TYPE))).alias("amt_own"),
        F.max_by("prev", F.when(F.col("tag") == "self", F.lit(1)).otherwise(F.lit(0))).alias("prev_row"),
        *[at(tag, "cnt").alias(f"cnt_{tag}") for tag, _ in PROBES],
        *[F.coalesce(at(tag, "amt"), F.lit(0).cast(_SUM_TYPE)).alias(f"amt_{tag}") for tag, _ in PROBES],
    )
    prior_cnt = F.col("cnt_self") - 1
    prior_amt = F.col("amt_self") - F.col("amt_own")
    return v.select(
        "card_id",
        "bucket",
        "_rid",
        "prev_row",
        *[(prior_cnt - F.col(f"cnt_{tag}")).alias(f"vel_{tag}") for tag, _ in PROBES],
        *[(prior_amt - F.col(f"amt_{tag}")).cast("double").alias(f"sum_{tag}") for tag, _ in PROBES],
    )


def _velocity_routed(hot: DataFrame) -> DataFrame:
    """Velocity for hot cards without context copies: each row's three probes (``ts - w``)
    are sent to the (card, bucket) their time falls in and answered there.

    At a probe, the number / amount of the card's rows with ``ts <= ts - w`` is the dense
    per-bucket prefix before that bucket plus a running count / sum inside it. The dense
    prefix table has one row per bucket between a card's first and last bucket (its time
    span divided by the bucket width, not its row count). Answers come back in one narrow
    exchange keyed like the rows, so no task holds more than one bucket of a hot card.
    """
    n = partitions(hot.sparkSession)
    dec = F.col("amount").cast(_SUM_TYPE)
    wd = W.partitionBy("card_id", "bucket").orderBy("_rid")
    rows = hot.select(
        "card_id",
        "bucket",
        "_rid",
        "ts_ms",
        "_bw",
        (F.col("_rid") - 1).alias("_j"),
        F.coalesce(F.sum(dec).over(wd.rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast(_SUM_TYPE)).alias("_s_in"),
        F.lag(F.struct("ts_ms", "lat", "lon")).over(wd).alias("prev_row"),
    )
    per = hot.groupBy("card_id", "bucket").agg(F.count(F.lit(1)).alias("_nb"), F.sum(dec).alias("_sb"))
    span = per.groupBy("card_id").agg(F.min("bucket").alias("_lo"), F.max("bucket").alias("_hi"))
    dense = span.select("card_id", F.explode(F.sequence("_lo", "_hi")).alias("bucket")).join(
        per, ["card_id", "bucket"], "left"
    )
    before = W.partitionBy("card_id").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    dense = dense.select(
        "card_id",
        "bucket",
        F.coalesce(F.sum(F.coalesce("_nb", F.lit(0))).over(before), F.lit(0)).alias("_n_before"),
        F.coalesce(F.sum(F.coalesce("_sb", F.lit(0).cast(_SUM_TYPE))).over(before), F.lit(0).cast(_SUM_TYPE)).alias(
            "_s_before"
        ),
    ).repartition(n, "card_id", "bucket")

    probes = rows.select(
        "card_id",
        F.col("bucket").alias("_origin"),
        "_rid",
        "_bw",
        F.explode(
            F.array(*[F.struct(F.lit(tag).alias("tag"), (F.col("ts_ms") - F.lit(w)).alias("u")) for tag, w in PROBES])
        ).alias("_p"),
    ).select(
        "card_id",
        F.floor(F.col("_p.u") / F.col("_bw")).cast("long").alias("bucket"),
        F.col("_p.u").alias("k"),
        F.lit(1).alias("kind"),
        F.lit(None).cast(_SUM_TYPE).alias("a"),
        "_origin",
        "_rid",
        F.col("_p.tag").alias("tag"),
    ).repartition(n, "card_id", "bucket")
    marks = hot.select(
        "card_id",
        "bucket",
        F.col("ts_ms").alias("k"),
        F.lit(0).alias("kind"),
        dec.alias("a"),
        F.lit(None).cast("long").alias("_origin"),
        F.lit(None).cast("int").alias("_rid"),
        F.lit(None).cast("string").alias("tag"),
    )
    run = W.partitionBy("card_id", "bucket").orderBy("k", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
    mix = marks.unionByName(probes).select(
        "*",
        F.sum(F.when(F.col("kind") == 0, 1).otherwise(0)).over(run).alias("_c"),
        F.coalesce(F.sum("a").over(run), F.lit(0).cast(_SUM_TYPE)).alias("_s"),
    )
    answered = mix.filter(F.col("kind") == 1).join(dense, ["card_id", "bucket"], "left").select(
        "card_id",
        F.col("_origin").alias("bucket"),
        "_rid",
        "tag",
        (F.coalesce(F.col("_n_before"), F.lit(0)) + F.col("_c")).alias("_L"),
        (F.coalesce(F.col("_s_before"), F.lit(0).cast(_SUM_TYPE)) + F.col("_s")).alias("_SL"),
    ).repartition(n, "card_id", "bucket")
    back = answered.groupBy("card_id", "bucket", "_rid").agg(
        *[F.max(F.when(F.col("tag") == tag, F.col("_L"))).alias(f"L_{tag}") for tag, _ in PROBES],
        *[F.max(F.when(F.col("tag") == tag, F.col("_SL"))).alias(f"SL_{tag}") for tag, _ in PROBES],
    )
    v = rows.join(dense, ["card_id", "bucket"]).join(back, ["card_id", "bucket", "_rid"])
    prior_cnt = F.col("_n_before") + F.col("_j")
    prior_amt = F.col("_s_before") + F.col("_s_in")
    return v.select(
        "card_id",
        "bucket",
        "_rid",
        "prev_row",
        *[(prior_cnt - F.col(f"L_{tag}")).alias(f"vel_{tag}") for tag, _ in PROBES],
        *[(prior_amt - F.col(f"SL_{tag}")).cast("double").alias(f"sum_{tag}") for tag, _ in PROBES],
    )


def compute_features(
    txn: DataFrame,
    bucket_ms: int | None = None,
    reset_after_ms: int | None = None,
    hot_rows: int | None = 2_000_000,
    hot_bucket_ms: int = WINDOW_1H_MS,
    lru_exact: bool = True,
    caps: tuple[int, int] = (MAX_MCC, MAX_MERCHANTS),
    dense_rows: int = DENSE_ROWS,
) -> DataFrame:
    """All 27 features in :data:`FEATURE_ORDER`, plus ids and label.

    ``txn`` needs the canonical columns. A card's history is one bucket below ``dense_rows`` rows
    and split by day from there on; ``bucket_ms`` splits that of every card by one width instead.
    Larger buckets carry less and copy fewer context rows.
    ``reset_after_ms`` (W4, opt-in) forgets a card's history after an idle gap longer than
    that (event time): the rows after the gap start a new history epoch.
    Cards with at least ``hot_rows`` rows get ``hot_bucket_ms`` buckets and routed window
    probes instead of 24 h context copies, so a card with a large share of all rows is split
    into hour-sized tasks (``hot_rows=None`` skips the check).
    ``lru_exact`` (W3): cards whose distinct MCCs / merchants exceed ``caps`` (where LRU
    eviction can change the novelty features) get ``mcc_prev_ts`` and ``merchant_known`` from
    :func:`_capped_keys`; every other fact, and every other card, is exact on the window path.
    Rows with a NULL coordinate are kept. Repeated ``txn_id`` are rows of their own.
    """
    if (bucket_ms is not None and bucket_ms <= 0) or hot_bucket_ms <= 0:
        raise ValueError("bucket widths must be positive")
    if reset_after_ms is not None:
        return _with_history_reset(txn, bucket_ms, reset_after_ms, hot_rows, hot_bucket_ms, lru_exact, caps, dense_rows)
    width, widths = card_widths(txn, bucket_ms, dense_rows, hot_rows, hot_bucket_ms)
    n = partitions(txn.sparkSession)
    data, halo = _bucketed(txn, width, widths)
    # Only cards with several buckets carry anything from one to the next.
    split = _split_cards(data) if bucket_ms is None else None
    whole = split is not None and split.limit(1).count() == 0
    carried = data if split is None else data.join(bounded_broadcast(split, 1_000_000), "card_id", "left_semi")
    # Small sides are laid out like the large one, so no join moves the data rows.
    carry = None if whole else _carry(carried).repartition(n, "card_id", "bucket")
    merchant_first = None if whole else (
        carried.filter(F.col("merchant_id") != "")
        .groupBy("card_id", "merchant_id")
        .agg(F.min("bucket").alias("bucket"))
        .withColumn("merchant_first_bucket", F.lit(True))
        .repartition(n, "card_id", "bucket")
    )

    wd = W.partitionBy("card_id", "bucket").orderBy("_rid")
    wmcc = W.partitionBy("card_id", "bucket", "mcc").orderBy("_rid")
    wmer = W.partitionBy("card_id", "bucket", "merchant_id").orderBy("_rid")
    whr = W.partitionBy("card_id", "bucket", "hour").orderBy("_rid")

    # Sorts are of narrow rows: of the carry's arrays and map only the row's own entries go on,
    # and the carried amounts only where the bucket's own do not fill the window.
    d = data.withColumn("mcc_prev_in", F.lag("ts_ms").over(wmcc)).withColumn("rn_hour", F.row_number().over(whr))
    d = d.withColumn("rn_mer", F.row_number().over(wmer))
    if whole:
        d = d.withColumns({**{name: F.lit(None).cast(kind) for name, kind in CARRIED.items()}, "merchant_first_bucket": F.lit(None).cast("boolean")})
    else:
        d = d.join(merchant_first, ["card_id", "bucket", "merchant_id"], "left").join(carry, ["card_id", "bucket"], "left")
    d = d.withColumns({
        **{name: F.coalesce(name, F.lit(0).cast("long")) for name in ("n_before", "mcc_distinct_before")},
        # a bucket that nothing is carried into has the first use of each of its merchants
        "merchant_first_bucket": F.coalesce("merchant_first_bucket", F.when(F.col("n_before").isNull(), F.lit(True))),
        "j": F.col("_rid") - 1,
        "mcc_prev_ts": F.coalesce(F.col("mcc_prev_in"), F.try_element_at("mcc_prev", F.col("mcc"))),
        "hour_before": F.coalesce(F.element_at("hour_before", F.col("hour") + 1), F.lit(0).cast("long")),
        "prev_tail": F.when(F.col("_rid") <= AMOUNT_WINDOW, F.coalesce("prev_tail", F.array().cast("array<double>"))),
    }).drop("mcc_prev", "mcc_prev_in")
    d = d.withColumn("amt_prior", F.collect_list("amount").over(wd.rowsBetween(-AMOUNT_WINDOW, -1)))
    d = d.withColumn(
        "mcc_new_in",
        F.coalesce(
            F.sum(F.when(F.col("mcc_prev_ts").isNull(), 1).otherwise(0)).over(
                wd.rowsBetween(W.unboundedPreceding, -1)
            ),
            F.lit(0),
        ),
    )
    if widths is None:
        vel = _velocity(data, halo)
    else:
        cold = data.filter(~F.col("_hot"))
        vel = _velocity(cold, halo).unionByName(_velocity_routed(data.filter(F.col("_hot"))))
    d = d.join(vel, ["card_id", "bucket", "_rid"])
    facts = _facts(d, caps[0])
    over = _overflow_cards(data, caps) if lru_exact else None
    if over is not None and over.limit(1).count():
        own = data.join(bounded_broadcast(over, 1_000_000), "card_id", "left_semi")
        keys = _capped_keys(own, caps).repartition(n, "card_id", "bucket")
        facts = facts.join(keys, ["card_id", "bucket", "_rid"], "left")
        for name in ("mcc_prev_ts", "merchant_known"):
            facts = facts.withColumn(name, F.when(F.col("_capped"), F.col(f"_{name}")).otherwise(F.col(name)))
    return features_from_facts(facts)


def _overflow_cards(data: DataFrame, caps: tuple[int, int]) -> DataFrame | None:
    """The cards of :func:`lru_overflow_cards`. The distinct keys of a card's buckets, which are
    counted where the rows are, add up to its distinct keys or more, so only cards for which that
    sum passes a cap are counted across buckets. None if there is no such card."""
    bounds = []
    for key, cap in (("mcc", caps[0]), ("merchant_id", caps[1])):
        keys = data.filter(F.col("merchant_id") != "") if key == "merchant_id" else data
        here = keys.groupBy("card_id", "bucket", key).agg(F.lit(1)).groupBy("card_id", "bucket").agg(F.count(F.lit(1)).alias("_k"))
        bounds.append(here.groupBy("card_id").agg(F.sum("_k").alias("_k")).filter(F.col("_k") > cap).select("card_id"))
    likely = write_once(bounds[0].unionByName(bounds[1]).distinct(), "likely-overflow")
    if likely.limit(1).count() == 0:
        return None
    rows = data.select("card_id", "mcc", "merchant_id").join(bounded_broadcast(likely, 1_000_000), "card_id", "left_semi")
    return write_once(lru_overflow_cards(rows, *caps).select("card_id"), "overflow")


def _key_memories(caps: tuple[int, int]):
    from cardwise.streaming.card_state import Recency

    return {"mcc": Recency(caps[0]), "merchant": Recency(caps[1])}


#: Buckets that one step of the prefix scan walks, and the bucket of what it starts with.
SCAN_FAN, CARRIED_IN = 64, -(1 << 62)


def _scan_keys(caps: tuple[int, int]):
    """Over (card_id, block, bucket, kind, key, ts_ms) sorted by the first three: the keys that the
    card remembers before each bucket. At most the caps are remembered between rows."""

    def run(batches):
        at = bucket = memory = None
        for pdf in batches:
            out = []
            for c, block, b, kind, key, ts in pdf.itertuples(index=False, name=None):
                if (c, block) != at:
                    at, bucket, memory = (c, block), CARRIED_IN, _key_memories(caps)
                if b != bucket:
                    out += [(c, b, k, name, used) for k, m in memory.items() for name, used in m.latest.items()]
                bucket = b
                memory[kind].use(key, ts)
            yield pd.DataFrame(out, columns=["card_id", "bucket", "kind", "key", "ts_ms"])

    return run


def _seed_keys(latest: DataFrame, caps: tuple[int, int], fan: int = SCAN_FAN) -> DataFrame:
    """(card_id, bucket, kind, key, ts_ms): what every bucket of ``latest`` starts with, as a prefix
    scan in a tree.

    "The ``cap`` keys with the highest (latest time, key)" merges associatively, so blocks of ``fan``
    buckets are summarised by such lists, blocks of blocks likewise, and each block is then walked
    from what its predecessors left. A task holds one memory and walks ``fan`` buckets of a card at
    a time, however many buckets a card has."""
    n = partitions(latest.sparkSession)
    span = latest.agg(F.min("bucket"), F.max("bucket")).first()
    first = span[0] or 0  # blocks count from there, so that the tree ends on both sides of time 0
    block = F.floor((F.col("bucket") - first) / fan).cast("long")
    rows = latest.select("card_id", block.alias("block"), "bucket", "kind", "key", "ts_ms")
    if span[0] is not None and span[1] - span[0] >= fan:
        merged = rows.groupBy("card_id", "block", "kind", "key").agg(F.max("ts_ms").alias("ts_ms"))
        top = W.partitionBy("card_id", "block", "kind").orderBy(F.col("ts_ms").desc(), F.col("key").desc())
        cap = F.when(F.col("kind") == "mcc", caps[0]).otherwise(caps[1])
        merged = merged.withColumn("_n", F.row_number().over(top)).where((F.col("_n") <= max(caps)) & (F.col("_n") <= cap))
        before = _seed_keys(merged.select("card_id", F.col("block").alias("bucket"), "kind", "key", "ts_ms"), caps, fan)
        carried = before.select("card_id", F.col("bucket").alias("block"), F.lit(CARRIED_IN).alias("bucket"), "kind", "key", "ts_ms")
        rows = rows.unionByName(carried)
    walked = rows.repartition(n, "card_id", "block").sortWithinPartitions("card_id", "block", "bucket")
    return walked.mapInPandas(_scan_keys(caps), "card_id string, bucket long, kind string, key string, ts_ms long")


def _follow_keys(caps: tuple[int, int]):
    """Over one bucket's seeds, then its rows in order: what each row's card remembers."""

    def run(batches):
        at = None
        for pdf in batches:
            out = []
            for c, b, rid, kind, ts, mcc, merchant in pdf.itertuples(index=False, name=None):
                if (c, b) != at:
                    at, memory = (c, b), _key_memories(caps)
                if isinstance(kind, str):  # a seed; its key travels in the mcc column
                    memory[kind].use(mcc, ts)
                    continue
                out.append((c, b, rid, memory["mcc"].when(mcc), memory["merchant"].when(merchant) is not None, True))
                memory["mcc"].use(mcc, ts)
                if merchant:
                    memory["merchant"].use(merchant, ts)
            done = pd.DataFrame(out, columns=["card_id", "bucket", "_rid", "_mcc_prev_ts", "_merchant_known", "_capped"])
            yield done.astype({"_mcc_prev_ts": "Int64"})

    return run


def _capped_keys(rows: DataFrame, caps: tuple[int, int]) -> DataFrame:
    """(card_id, bucket, _rid, _mcc_prev_ts, _merchant_known, _capped) under the caps.

    In event order the memory is always the ``cap`` distinct keys with the highest (latest time,
    key). So a first pass over each card's distinct keys per bucket (partial aggregates, not
    rows) finds what every bucket starts with, and a second follows the rows of all buckets in
    parallel. Both read sorted partitions as a stream and hold one memory of ``caps`` keys: the
    sort may spill, and no group is collected.
    """
    n = partitions(rows.sparkSession)
    used = F.array(
        F.struct(F.lit("mcc").alias("kind"), F.col("mcc").alias("key")),
        F.struct(F.lit("merchant").alias("kind"), F.col("merchant_id").alias("key")),
    )
    latest = (
        rows.select("card_id", "bucket", "ts_ms", F.inline(used))
        .filter((F.col("kind") == "mcc") | (F.col("key") != ""))
        .groupBy("card_id", "bucket", "kind", "key")
        .agg(F.max("ts_ms").alias("ts_ms"))
    )
    # a card with one bucket carries nothing into it
    seeds = _seed_keys(write_once(latest.join(_split_cards(rows), "card_id", "left_semi"), "latest-keys"), caps)
    columns = ("card_id", "bucket", "_rid", "kind", "ts_ms", "mcc", "merchant_id")
    seeded = seeds.select("card_id", "bucket", F.lit(0).alias("_rid"), "kind", "ts_ms", F.col("key").alias("mcc"), F.lit("").alias("merchant_id"))
    return (
        rows.withColumn("kind", F.lit(None).cast("string"))
        .select(*columns)
        .unionByName(seeded)
        .repartition(n, "card_id", "bucket")
        .sortWithinPartitions("card_id", "bucket", "_rid")
        .mapInPandas(
            _follow_keys(caps),
            "card_id string, bucket long, _rid int, _mcc_prev_ts long, _merchant_known boolean, _capped boolean",
        )
    )


_EPOCH_SEP = "\u0001"


def history_epochs(
    txn: DataFrame, reset_after_ms: int, bucket_ms: int = WINDOW_24H_MS, widths: DataFrame | None = None,
    keep: tuple[str, ...] = ("txn_id", "card_id", "ts_ms"),
) -> DataFrame:
    """The ``keep`` columns and ``epoch``: the number of idle gaps > ``reset_after_ms`` before a
    row in its card's (ts_ms, txn_id) order.

    Two-level like the features: previous row and gap counts inside (card, bucket), plus
    per-bucket carries (last time, gap count) from windows over a card's buckets.
    """
    n = partitions(txn.sparkSession)
    t = _with_widths(txn.select(*keep), bucket_ms, widths)
    t = t.select(*keep, F.floor(F.col("ts_ms") / F.col("_bw")).cast("long").alias("bucket")).repartition(n, "card_id", "bucket")
    cw = W.partitionBy("card_id").orderBy("bucket")
    last = t.groupBy("card_id", "bucket").agg(F.max_by("ts_ms", F.struct("ts_ms", "txn_id")).alias("_last"))
    last = last.select("card_id", "bucket", F.lag("_last").over(cw).alias("_last_before")).repartition(
        n, "card_id", "bucket"
    )
    wd = W.partitionBy("card_id", "bucket").orderBy(*_order())
    g = t.join(last, ["card_id", "bucket"]).withColumn(
        "_prev", F.coalesce(F.lag("ts_ms").over(wd), F.col("_last_before"))
    )
    g = g.withColumn("_gap", F.when(F.col("ts_ms") - F.col("_prev") > F.lit(reset_after_ms), 1).otherwise(0))
    per = g.groupBy("card_id", "bucket").agg(F.sum("_gap").alias("_g"))
    per = per.select(
        "card_id",
        "bucket",
        F.coalesce(F.sum("_g").over(cw.rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("_g_before"),
    ).repartition(n, "card_id", "bucket")
    out = g.join(per, ["card_id", "bucket"]).withColumn(
        "epoch", F.col("_g_before") + F.sum("_gap").over(wd.rowsBetween(W.unboundedPreceding, W.currentRow))
    )
    return out.select(*keep, "epoch")


def _with_history_reset(
    txn: DataFrame, bucket_ms: int | None, reset_after_ms: int, hot_rows, hot_bucket_ms, lru_exact=True, caps=(MAX_MCC, MAX_MERCHANTS),
    dense_rows: int = DENSE_ROWS,
) -> DataFrame:
    width, widths = card_widths(txn, bucket_ms, dense_rows, hot_rows, hot_bucket_ms)
    # the epoch comes first, so whatever characters a card id has, the rest of the key is the card
    keyed = history_epochs(txn, reset_after_ms, width, widths, TXN_COLUMNS).withColumn(
        "card_id", F.concat_ws(_EPOCH_SEP, F.col("epoch").cast("string"), F.col("card_id"))
    )
    feats = compute_features(
        keyed.drop("epoch"), bucket_ms, hot_rows=hot_rows, hot_bucket_ms=hot_bucket_ms, lru_exact=lru_exact, caps=caps, dense_rows=dense_rows
    )
    return feats.withColumn("card_id", F.expr(f"substring(card_id, instr(card_id, '{_EPOCH_SEP}') + 1)"))


def _facts(d: DataFrame, mcc_cap: int) -> DataFrame:
    """The facts of :mod:`cardwise.operators.formulas` from the carry and the bucket's windows."""
    # Last <= 50 amounts before the row: carried tail of earlier buckets + this bucket's.
    joined = F.when(F.col("j") < AMOUNT_WINDOW, F.concat("prev_tail", "amt_prior")).otherwise(F.col("amt_prior"))
    win = F.slice(joined, F.greatest(F.size(joined) - (AMOUNT_WINDOW - 1), F.lit(1)), AMOUNT_WINDOW)
    d = d.withColumn("_win", win).withColumn("amt_n", F.size("_win"))
    d = d.withColumn(
        "amt_mean", F.try_divide(F.aggregate("_win", F.lit(0.0), lambda acc, x: acc + x), F.col("amt_n").cast("double"))
    )

    def off(x: Column) -> Column:
        return x - F.col("amt_mean")

    prev, before = F.col("prev_row"), F.col("last_before")
    last = F.when(prev.isNotNull(), prev).otherwise(before)
    first_use = (F.col("rn_mer") == 1) & F.col("merchant_first_bucket").isNotNull()
    return d.select(
        "card_id", "bucket", "_rid", "txn_id", "ts_ms", "amount", "lat", "lon", "label",
        (F.col("n_before") + F.col("j")).alias("prior_n"),
        *[f"vel_{tag}" for tag, _ in PROBES],
        *[f"sum_{tag}" for tag, _ in PROBES],
        "amt_n",
        "amt_mean",
        F.aggregate("_win", F.lit(0.0), lambda acc, x: acc + off(x) * off(x)).alias("amt_spread"),
        "mcc_prev_ts",
        F.least(F.lit(mcc_cap), F.col("mcc_distinct_before") + F.col("mcc_new_in")).alias("mcc_known"),
        ((F.col("merchant_id") != "") & ~first_use).alias("merchant_known"),
        *[last[name].alias(f"last_{name.removesuffix('_ms')}") for name in ("ts_ms", "lat", "lon")],
        (F.col("hour_before") + F.col("rn_hour") - 1).alias("hour_prior"),
    )


def out_of_order_flags(df: DataFrame, arrival_col: str, bucket_ms: int = WINDOW_24H_MS) -> DataFrame:
    """F27 in arrival order: 1 when a row is older than the newest earlier-arrived row of its card.

    Two-level running max keyed by (card_id, arrival bucket of ``bucket_ms`` width over the
    arrival column's value), so a hot card is still split across tasks.
    """
    b = F.floor(F.col(arrival_col) / F.lit(bucket_ms)).cast("long")
    t = df.select("txn_id", "card_id", "ts_ms", F.col(arrival_col).alias("_arr"), b.alias("_ab"))
    per_bucket = t.groupBy("card_id", "_ab").agg(F.max("ts_ms").alias("_bmax"))
    carry = per_bucket.select(
        "card_id",
        "_ab",
        F.max("_bmax").over(W.partitionBy("card_id").orderBy("_ab").rowsBetween(W.unboundedPreceding, -1)).alias(
            "_cmax"
        ),
    )
    w = W.partitionBy("card_id", "_ab").orderBy("_arr", "txn_id").rowsBetween(W.unboundedPreceding, -1)
    newest = F.greatest(F.max("ts_ms").over(w), F.col("_cmax"))
    out = t.join(carry, ["card_id", "_ab"]).select(
        "txn_id", "card_id", "ts_ms", F.when(F.col("ts_ms") < newest, 1.0).otherwise(0.0).alias("out_of_order_flag")
    )
    return out


def lru_overflow_cards(txn: DataFrame, mcc_cap: int = MAX_MCC, merchant_cap: int = MAX_MERCHANTS) -> DataFrame:
    """W3 guard: cards whose distinct MCCs exceed ``mcc_cap`` or merchants ``merchant_cap``.

    Only for these cards can LRU eviction change ``mcc_is_new`` / ``merchant_is_new``.
    Exact: distinct (card, key) pairs first (partial aggregation keyed by card and key, so a
    hot card is spread over its keys), then one count per card; no per-card collection.
    """
    mcc = txn.select("card_id", "mcc").distinct().groupBy("card_id").agg(F.count(F.lit(1)).alias("distinct_mcc"))
    mer = (
        txn.filter(F.col("merchant_id") != "")
        .select("card_id", "merchant_id")
        .distinct()
        .groupBy("card_id")
        .agg(F.count(F.lit(1)).alias("distinct_merchants"))
    )
    both = mcc.join(mer, "card_id", "full_outer").fillna(0, ["distinct_mcc", "distinct_merchants"])
    return both.filter((F.col("distinct_mcc") > mcc_cap) | (F.col("distinct_merchants") > merchant_cap))


def assert_ordered(df: DataFrame, arrival_col: str, ts_only: bool = False) -> None:
    """Raise if, in arrival order, a row's event time (or (ts, txn_id)) goes backwards.

    Range-partitioned on the arrival column: each partition checks its own order, and
    partition boundaries are checked from per-partition (first, last) summaries.
    """
    from cardwise.operators.ordered import ranged
    from cardwise.session import partitions

    rows = df.select(F.col(arrival_col).alias("_a"), "ts_ms", "txn_id")
    parts = ranged(rows, [F.col("_a")], partitions(df.sparkSession))
    key = F.col("ts_ms") if ts_only else F.struct("ts_ms", "txn_id")
    w = W.partitionBy("_pid").orderBy("_a")
    inside = parts.select((key < F.lag(key).over(w)).alias("_bad")).filter("_bad").limit(1).count()
    if inside:
        raise ValueError("input is not ordered by event time in arrival order")
    edges = parts.groupBy("_pid").agg(
        F.min_by(key, F.col("_a")).alias("_first"), F.max_by(key, F.col("_a")).alias("_last"), F.min("_a").alias("_lo")
    )
    # Partition edges: <= number of partitions rows, tiny.
    ew = W.orderBy("_lo")
    bad = edges.select((F.col("_first") < F.lag("_last").over(ew)).alias("_bad")).filter("_bad").count()
    if bad:
        raise ValueError("input is not ordered by event time in arrival order")


def ordering_violations(df: DataFrame, arrival_col: str, ts_only: bool = False) -> DataFrame:
    """W2 as a query: rows whose event time (or (ts_ms, txn_id)) is smaller than the previous
    row's in arrival order, counted with the partition-parallel global lag (one row out)."""
    from cardwise.operators.ordered import global_lag

    key = F.struct("ts_ms") if ts_only else F.struct("ts_ms", "txn_id")
    lagged = global_lag(df.select(arrival_col, "ts_ms", "txn_id").withColumn("_k", key), [arrival_col], "_k", "_prev")
    return lagged.agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("_k") < F.col("_prev")).alias("violations"),
    )
