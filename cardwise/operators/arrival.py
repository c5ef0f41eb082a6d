"""T4 in batch: the 27 features in arrival order, late rows included.

A row sees the rows of its card that arrived before it, whatever their event times, as a card's
keyed state does in a stream. Most facts are prefixes in arrival order. The sliding windows are
not: they count rows that arrived before *and* lie in a range of event time, which is counting in
two dimensions.

Layout
------
Rows are numbered per card in arrival order (``rank``) and lie in buckets of ``2 ** bucket_bits``
ranks. What a bucket inherits comes from tables with one row per bucket (or per bucket and key),
joined narrowly: the newest row, the hour's count, the key's latest time.

Cards with fewer than ``hot_rows`` rows move once, to the task that their ``card_id`` is hashed to,
and are kept there sorted by bucket and rank: every window, join and sum below finds its rows in
place. The others are numbered by a segmented prefix sum and laid out by ``(card_id, bucket)``, so
that a card with any share of the rows is spread over tasks.

Windows
-------
The ranks before a row fall into at most one *leaf* of ``2 ** leaf_bits`` ranks, which the row
shares, and full runs of doubling sizes, one for each further bit that is set in its rank: a
merge tree over arrival. In the leaf, the earlier rows are looked at one by one. In a run, points
and the rows' window bounds are sorted together by event time, latest first, and a running count
and sum at a bound is what lies inside the window. A card's runs are summed where its rows are; the
runs of hot cards are one range-partitioned sort with segmented sums
(:func:`cardwise.operators.ordered.segmented_prefix`), so no run, however long, is one task. Cards
with no more rows than a leaf need none of it; a card of n rows has about
``(log2(n) - leaf_bits) / 2`` copies of a row as a point and three times that as bounds.

The state drops times that lie 24 h or more behind the newest row seen, so a bound is never
older than that either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwise.functions.columns import hour_of_day
from cardwise.operators.features import PROBES, _capped_keys, lru_overflow_cards
from cardwise.operators.formulas import features_from_facts
from cardwise.operators.joins import bounded_broadcast
from cardwise.operators.ordered import segmented_prefix
from cardwise.schema import AMOUNT_WINDOW, MAX_MCC, MAX_MERCHANTS, TXN_COLUMNS, WINDOW_24H_MS
from cardwise.session import partitions, persist_partitioned, write_once

MONEY = "decimal(38,10)"  # exact sums, as in the event-time windows
ROW = ("card_id", "bucket", "rank")
#: Rows of one arrival number come in (ts_ms, txn_id) order, as in a micro-batch; rows that are
#: alike in all of these are alike in every column.
ARRIVED = ("_arrival", "ts_ms", "txn_id", "amount", "mcc", "merchant_id", "lat", "lon", "label")
#: Rows from which a card is spread over tasks.
HOT_ROWS = 100_000


def hot_cards(arrived: DataFrame, hot_rows: int) -> DataFrame | None:
    """(card_id) of the cards with ``hot_rows`` rows or more, None if there are none."""
    counted = arrived.groupBy("card_id").agg(F.count(F.lit(1)).alias("_n"))
    hot = write_once(counted.where(F.col("_n") >= hot_rows).select("card_id"), "hot-cards")
    return bounded_broadcast(hot, 1_000_000) if hot.limit(1).count() else None


def numbered(arrived: DataFrame, bucket_bits: int, whole: bool) -> DataFrame:
    """The canonical columns with ``rank`` (from 0, per card, in arrival order), ``bucket`` and
    ``hour``: kept, sorted by bucket and rank, with a card's rows in one task (``whole``) or
    spread by bucket."""
    n = partitions(arrived.sparkSession)
    if whole:
        rank = F.row_number().over(W.partitionBy("card_id").orderBy(*ARRIVED)).cast("long") - 1
        ranked = arrived.repartition(n, "card_id").withColumn("rank", rank)
    else:
        rows = arrived.withColumns({"one": F.lit(1).cast("long"), "_place": F.monotonically_increasing_id()})
        ranked = segmented_prefix(write_once(rows, "arrived"), ["card_id"], [*ARRIVED, "_place"], ["one"])
        ranked = ranked.withColumn("rank", F.col("cum_one") - 1)
    out = ranked.select(*TXN_COLUMNS, "rank", F.shiftright("rank", bucket_bits).alias("bucket"), hour_of_day("ts_ms").alias("hour"))
    if not whole:
        out = write_once(out, "numbered").repartition(n, "card_id", "bucket")
    return persist_partitioned(out.sortWithinPartitions(*ROW))


def newest_and_amounts(rows: DataFrame, bucket_bits: int, whole: bool) -> DataFrame:
    """``rows`` with ``newest``, the row with the latest event time that arrived before (of equal
    ones the one that arrived last), and ``win``, the last 50 amounts that arrived.

    Where buckets of a card may lie apart, ``newest`` is carried from bucket to bucket and a bucket
    gets the last 50 rows of the one before as context."""
    place = F.struct("ts_ms", "rank", "lat", "lon")
    if whole:
        card = W.partitionBy("card_id").orderBy("bucket", "rank")
        before, last = card.rowsBetween(W.unboundedPreceding, -1), card.rowsBetween(-AMOUNT_WINDOW, -1)
        return rows.select("*", F.max(place).over(before).alias("newest"), F.collect_list("amount").over(last).alias("win"))
    size = 1 << bucket_bits
    cards = W.partitionBy("card_id").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    carried = rows.groupBy("card_id", "bucket").agg(F.max(place).alias("top")).select("card_id", "bucket", F.max("top").over(cards).alias("carried"))
    own = rows.withColumn("context", F.lit(False))
    late = rows.where(F.col("rank") % size >= size - AMOUNT_WINDOW).select("card_id", (F.col("bucket") + 1).alias("bucket"), "rank", "amount", F.lit(True).alias("context"))
    both = own.unionByName(late, allowMissingColumns=True)
    inside = W.partitionBy("card_id", "bucket").orderBy("rank")
    here = F.max(F.when(~F.col("context"), place)).over(inside.rowsBetween(W.unboundedPreceding, -1))
    d = both.select("*", here.alias("here"), F.collect_list("amount").over(inside.rowsBetween(-AMOUNT_WINDOW, -1)).alias("win"))
    d = d.where("NOT context").join(carried, ["card_id", "bucket"])
    return d.withColumn("newest", F.greatest("here", "carried")).drop("context", "here", "carried")


def key_facts(rows: DataFrame, whole: bool) -> DataFrame:
    """(card_id, bucket, rank, mcc_prev_ts, mcc_known, merchant_known, hour_prior) of the rows that
    have an MCC and an hour. Where a card's rows lie together (``whole``), its merchants and hours,
    of which a bucket has nearly as many as rows, are counted without a table of them."""
    inside = lambda *keys: W.partitionBy("card_id", "bucket", *keys).orderBy("rank").rowsBetween(W.unboundedPreceding, -1)
    earlier = lambda *keys: W.partitionBy("card_id", *keys).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    nth_here = lambda key: F.row_number().over(W.partitionBy("card_id", "bucket", key).orderBy("rank"))

    mccs = rows.groupBy("card_id", "bucket", "mcc").agg(F.max("ts_ms").alias("mx"))
    mccs = mccs.select("card_id", "bucket", "mcc", F.max("mx").over(earlier("mcc")).alias("mcc_carried"))
    first_here = mccs.groupBy("card_id", "bucket").agg(F.count_if(F.col("mcc_carried").isNull()).alias("fresh"))
    distinct = first_here.select("card_id", "bucket", F.coalesce(F.sum("fresh").over(earlier()), F.lit(0)).alias("mccs_before"))

    d = rows.select(*ROW, "ts_ms", "mcc", "merchant_id", "hour")
    told = F.col("mcc").isNotNull() & F.col("hour").isNotNull()
    # each window sorts the rows as the join after it wants them
    if whole:
        card = lambda key: W.partitionBy("card_id", key).orderBy("bucket", "rank")
        since = F.min("bucket").over(card("merchant_id"))
        again = F.count_if(told).over(card("merchant_id").rowsBetween(W.unboundedPreceding, -1)) > 0
        d = d.withColumn("merchant_known", (F.col("merchant_id") != "") & (again | (since < F.col("bucket")))).where(told)
        d = d.withColumn("hour_prior", (F.row_number().over(card("hour")) - 1).cast("long"))
    else:
        merchants = rows.where("merchant_id <> ''").groupBy("card_id", "merchant_id").agg(F.min("bucket").alias("bucket"))
        merchants = merchants.withColumn("merchant_starts", F.lit(True))
        hours = rows.groupBy("card_id", "bucket", "hour").agg(F.count("*").alias("n"))
        # an hour may be missing in a bucket, so its count so far is taken from the hours that occur there
        hours = hours.select("card_id", "bucket", "hour", F.coalesce(F.sum("n").over(earlier("hour")), F.lit(0)).alias("hour_before"))
        d = d.where(told).withColumn("again", nth_here("merchant_id") > 1).join(merchants, ["card_id", "bucket", "merchant_id"], "left")
        d = d.withColumn("merchant_known", (F.col("merchant_id") != "") & (F.col("again") | F.col("merchant_starts").isNull()))
        d = d.withColumn("hour_here", nth_here("hour")).join(hours, ["card_id", "bucket", "hour"])
        d = d.withColumn("hour_prior", F.col("hour_before") + F.col("hour_here") - 1)
    d = d.withColumn("mcc_here", F.max("ts_ms").over(inside("mcc"))).join(mccs, ["card_id", "bucket", "mcc"])
    d = d.join(distinct, ["card_id", "bucket"])
    d = d.select(*ROW, F.greatest("mcc_here", "mcc_carried").alias("mcc_prev_ts"), "mccs_before", "merchant_known", "hour_prior")
    mcc_known = F.col("mccs_before") + F.coalesce(F.count_if(F.col("mcc_prev_ts").isNull()).over(inside()), F.lit(0))
    return d.withColumn("mcc_known", mcc_known).drop("mccs_before")


def with_amount_facts(d: DataFrame) -> DataFrame:
    """``d`` with amt_n, amt_mean, amt_spread of ``win``."""
    n = F.size("win")
    d = d.withColumns({"amt_n": n.cast("long"), "amt_mean": F.try_divide(F.aggregate("win", F.lit(0.0), lambda a, x: a + x), n.cast("double"))})
    off = lambda x: x - F.col("amt_mean")
    return d.withColumn("amt_spread", F.aggregate("win", F.lit(0.0), lambda a, x: a + off(x) * off(x))).drop("win")


def window_bounds(ts: Column, newest: Column) -> dict[str, Column]:
    """Event times that rows in a window lie after."""
    return {tag: F.greatest(ts - F.lit(w), newest - F.lit(WINDOW_24H_MS)) for tag, w in PROBES}


def with_leaf_facts(d: DataFrame, leaf_bits: int) -> DataFrame:
    """``d`` with n_* and s_*: the rows of its leaf that arrived before and lie in each window."""
    size = 1 << leaf_bits
    before = W.partitionBy("card_id", "bucket").orderBy("rank").rowsBetween(-max(size - 1, 1), -1)
    d = d.withColumn("seen", F.collect_list(F.struct("ts_ms", "amount")).over(before))
    d = d.withColumns({f"after_{tag}": after for tag, after in window_bounds(F.col("ts_ms"), F.col("newest.ts_ms")).items()})
    here = (F.col("rank") % size).cast("int")  # a leaf lies in one bucket
    d = d.withColumn("seen", F.slice("seen", F.size("seen") - here + 1, here))
    d = d.withColumns({tag: F.expr(f"filter(seen, s -> s.ts_ms > after_{tag})") for tag, _ in PROBES})
    total = lambda xs: F.aggregate(xs, F.lit(0).cast(MONEY), lambda a, x: (a + x["amount"].cast(MONEY)).cast(MONEY))
    d = d.withColumns({f"n_{tag}": F.size(tag).cast("long") for tag, _ in PROBES} | {f"s_{tag}": total(F.col(tag)) for tag, _ in PROBES})
    return d.drop("seen", *[tag for tag, _ in PROBES], *[f"after_{tag}" for tag, _ in PROBES])


def run_facts(rows: DataFrame, leaf_bits: int, whole: bool) -> DataFrame:
    """(card_id, bucket, rank, fn_*, fs_*): the rows in the runs before a row's leaf that lie in each
    window, for rows with such runs. ``rows`` have their ``newest``."""
    # Runs of 2 ** level ranks: point r is in run r >> level, and a run is asked only if its number is even.
    levels = rows.groupBy("card_id").agg(F.max("rank").alias("top")).where(F.col("top") >= 1 << leaf_bits)
    tall = levels.select("card_id", "top", F.expr("length(bin(top)) - 1").alias("high"))
    bounds = window_bounds(F.col("ts_ms"), F.col("newest.ts_ms"))
    bounded = rows.select(*ROW, "ts_ms", F.col("amount").cast(MONEY).alias("amount"), *[b.alias(f"after_{tag}") for tag, b in bounds.items()])
    deep = bounded.join(tall, "card_id").withColumn("level", F.explode(F.sequence(F.lit(leaf_bits), "high")))
    deep = deep.withColumn("run", F.expr("shiftright(rank, level)"))
    mark = lambda at, kind, tag: F.struct((-F.col(at)).alias("back"), F.lit(kind).cast("long").alias("kind"), F.lit(tag).alias("tag"))
    # latest first, and a bound (kind 0) before the points (kind 1) at its own time, which are outside
    asks = F.array(*[mark(f"after_{tag}", 0, i) for i, (tag, _) in enumerate(PROBES)])
    asked_later = F.expr("shiftleft(run + 1, level) <= top")  # the last run has none after it
    marks = F.when(F.col("run") % 2 == 1, asks).when(asked_later, F.array(mark("ts_ms", 1, -1)))
    marks = deep.select(*ROW, "level", (F.col("run") - F.col("run") % 2).alias("run"), "amount", F.inline(marks))
    marks = marks.withColumn("amount", F.when(F.col("kind") == 1, F.col("amount")))
    runs = ["card_id", "level", "run"]
    if whole:
        upto = W.partitionBy(*runs).orderBy("back", "kind").rowsBetween(W.unboundedPreceding, W.currentRow)
        counted = marks.select("*", F.sum("kind").over(upto).alias("cum_kind"), F.sum("amount").over(upto).alias("cum_amount"))
    else:
        counted = segmented_prefix(marks, runs, ["back", "kind", "rank", "tag"], ["kind", "amount"])
    at = lambda i, name: F.sum(F.when(F.col("tag") == i, F.col(name)))
    return counted.where("kind = 0").groupBy(*ROW).agg(
        *[F.coalesce(at(i, "cum_kind"), F.lit(0)).alias(f"fn_{tag}") for i, (tag, _) in enumerate(PROBES)],
        *[F.coalesce(at(i, "cum_amount"), F.lit(0)).cast(MONEY).alias(f"fs_{tag}") for i, (tag, _) in enumerate(PROBES)],
    )


def facts(arrived: DataFrame, caps: tuple[int, int], bucket_bits: int, leaf_bits: int, whole: bool) -> DataFrame:
    """The facts of :mod:`cardwise.operators.formulas` about cards that are each in one task
    (``whole``) or spread by bucket."""
    rows = numbered(arrived, bucket_bits, whole)
    placed = newest_and_amounts(rows, bucket_bits, whole)
    d = with_leaf_facts(with_amount_facts(placed), leaf_bits)
    d = d.join(key_facts(rows, whole), list(ROW)).join(run_facts(placed.drop("win"), leaf_bits, whole), list(ROW), "left")
    d = d.withColumns(
        {
            **{f"vel_{tag}": F.col(f"n_{tag}") + F.coalesce(f"fn_{tag}", F.lit(0)) for tag, _ in PROBES},
            **{f"sum_{tag}": (F.col(f"s_{tag}") + F.coalesce(f"fs_{tag}", F.lit(0).cast(MONEY))).cast("double") for tag, _ in PROBES},
            **{f"last_{c.removesuffix('_ms')}": F.col(f"newest.{c}") for c in ("ts_ms", "lat", "lon")},
            "prior_n": F.col("rank"),
            "mcc_known": F.least(F.lit(caps[0]), "mcc_known"),
        }
    )
    over = write_once(lru_overflow_cards(rows, *caps).select("card_id"), "overflow")
    if over.limit(1).count():
        place = (F.col("rank") - F.shiftleft("bucket", bucket_bits) + 1).cast("int")  # from 1; what is carried in has 0
        own = rows.join(bounded_broadcast(over, 1_000_000), "card_id", "left_semi").withColumn("_rid", place)
        d = d.withColumn("_rid", place).join(_capped_keys(own, caps), ["card_id", "bucket", "_rid"], "left")
        for name in ("mcc_prev_ts", "merchant_known"):
            d = d.withColumn(name, F.when(F.col("_capped"), F.col(f"_{name}")).otherwise(F.col(name)))
    return d


def arrival_features(
    txn: DataFrame,
    arrival_col: str,
    caps: tuple[int, int] = (MAX_MCC, MAX_MERCHANTS),
    bucket_bits: int = 12,
    leaf_bits: int = 6,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """All 27 features in arrival order, plus ids and label; equal to the keyed state of a stream
    that delivers the rows in that order. ``2 ** bucket_bits`` must be 50 (the amount history) or
    more, and a leaf is a bucket at most; neither these nor ``hot_rows``, from which on a card is
    spread over tasks, change a value."""
    if 1 << bucket_bits < AMOUNT_WINDOW or leaf_bits < 0:
        raise ValueError("a bucket holds the amount history at least")
    leaf_bits = min(leaf_bits, bucket_bits)
    arrived = txn.select(*TXN_COLUMNS, F.col(arrival_col).alias("_arrival")).where("card_id IS NOT NULL")
    hot = hot_cards(arrived, hot_rows)
    if hot is None:
        return features_from_facts(facts(arrived, caps, bucket_bits, leaf_bits, whole=True))
    told = [facts(arrived.join(hot, "card_id", how), caps, bucket_bits, leaf_bits, how == "left_anti") for how in ("left_anti", "left_semi")]
    return features_from_facts(told[0]).unionByName(features_from_facts(told[1]))
