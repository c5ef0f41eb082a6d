"""Keyed state that starts from a batch history (``initialState`` of ``transformWithState``).

A card's history becomes one ``card`` row (counters, last place, histogram, last amounts, keys) and
a ``minute`` row for every minute of its last 24 h, so that no row holds more than a minute of a
busy card. Every part is a partial aggregate or a window over tables with a row per (card, day),
(card, key) or (card, minute). The processor loads the rows in whatever order they come.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from cardwise.functions.columns import hour_of_day
from cardwise.operators.formulas import features_from_facts
from cardwise.schema import AMOUNT_WINDOW, MAX_MCC, MAX_MERCHANTS, TXN_COLUMNS, WINDOW_1M_MS, WINDOW_24H_MS
from cardwise.streaming.card_state import CardLedger
from cardwise.streaming.processor import FACTS_SCHEMA, CardFeatureProcessor


def last_amounts(txn: DataFrame) -> DataFrame:
    """(card_id, amount_window): the last 50 amounts, oldest first; the days' last ones first, so
    a card's window has at most 50 rows a day."""
    newest_first = [F.col("ts_ms").desc(), F.col("txn_id").desc()]
    day = F.floor(F.col("ts_ms") / WINDOW_24H_MS).alias("day")
    rows = txn.select("card_id", day, "ts_ms", "txn_id", "amount")
    for keys in (("card_id", "day"), ("card_id",)):
        rows = rows.withColumn("n", F.row_number().over(W.partitionBy(*keys).orderBy(*newest_first))).where(F.col("n") <= AMOUNT_WINDOW)
    kept = rows.groupBy("card_id").agg(F.sort_array(F.collect_list(F.struct("ts_ms", "txn_id", "amount"))).alias("rows"))
    return kept.select("card_id", F.transform("rows", lambda r: r["amount"]).alias("amount_window"))


def last_keys(txn: DataFrame, key: str, cap: int) -> DataFrame:
    """(card_id, <key>_keys, <key>_ts): the ``cap`` keys used last; equal times rank by key."""
    used = txn.where(F.col(key) != "") if key == "merchant_id" else txn
    latest = used.groupBy("card_id", F.col(key).alias("key")).agg(F.max("ts_ms").alias("ts"))
    rank = F.row_number().over(W.partitionBy("card_id").orderBy(F.col("ts").desc(), F.col("key").desc()))
    kept = latest.withColumn("n", rank).where(F.col("n") <= cap).groupBy("card_id").agg(F.collect_list(F.struct("key", "ts")).alias("kept"))
    return kept.select("card_id", F.col("kept.key").alias(f"{key}_keys"), F.col("kept.ts").alias(f"{key}_ts"))


def card_history(txn: DataFrame, caps: tuple[int, int] = (MAX_MCC, MAX_MERCHANTS)) -> DataFrame:
    """The initial state of every card of ``txn``: ``card`` and ``minute`` rows."""
    newest = F.max(F.struct("ts_ms", "txn_id", "lat", "lon")).alias("newest")
    cards = txn.withColumn("hour", hour_of_day("ts_ms")).groupBy("card_id").agg(
        F.count("*").alias("txn_count"), newest, F.array(*[F.count_if(F.col("hour") == h) for h in range(24)]).alias("hour_hist")
    )
    for more in (last_amounts(txn), last_keys(txn, "mcc", caps[0]), last_keys(txn, "merchant_id", caps[1])):
        cards = cards.join(more, "card_id", "left")
    none = F.array().cast("array<long>")
    card = cards.select(
        "card_id", "txn_count", F.col("newest.ts_ms").alias("last_ts"), F.col("newest.lat").alias("last_lat"), F.col("newest.lon").alias("last_lon"),
        "hour_hist", "amount_window", "mcc_keys", "mcc_ts",
        F.coalesce("merchant_id_keys", F.array().cast("array<string>")).alias("merchant_keys"), F.coalesce("merchant_id_ts", none).alias("merchant_ts"),
        none.alias("times"), F.array().cast("array<double>").alias("amounts"),
    )
    recent = txn.join(card.select("card_id", "last_ts"), "card_id").where(F.col("ts_ms") > F.col("last_ts") - WINDOW_24H_MS)
    minute = F.floor(F.col("ts_ms") / WINDOW_1M_MS).alias("minute")
    trail = recent.groupBy("card_id", "last_ts", minute).agg(F.sort_array(F.collect_list(F.struct("ts_ms", "amount"))).alias("rows"))
    missing = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in card.schema.fields}
    trail = trail.select(*[{**missing, "card_id": F.col("card_id"), "last_ts": F.col("last_ts"), "times": F.col("rows.ts_ms"), "amounts": F.col("rows.amount")}[c].alias(c) for c in card.columns])
    return card.unionByName(trail)


class WarmCardProcessor(CardFeatureProcessor):
    """Facts on arrival, going on from rows of :func:`card_history`."""

    def handleInitialState(self, key, initialState, timerValues) -> None:
        ledger: CardLedger = self.ledger()
        row = initialState
        if row["txn_count"] is not None:
            ledger.rows, ledger.hours = row["txn_count"], list(row["hour_hist"])
            ledger.amounts.extend(row["amount_window"])
            for memory, keys, times in ((ledger.mccs, "mcc_keys", "mcc_ts"), (ledger.merchants, "merchant_keys", "merchant_ts")):
                memory.latest = dict(zip(row[keys], row[times]))
            ledger.place = (row["last_ts"], row["last_lat"], row["last_lon"])
            if self.idle_ms is not None:
                self.handle.registerTimer(row["last_ts"] + self.idle_ms + 1)
        for ts, amount in zip(row["times"], row["amounts"]):
            ledger.remember(ts, amount, row["last_ts"] - WINDOW_24H_MS)
        self.save(ledger)


def stream_features_from(df: DataFrame, history: DataFrame, **options) -> DataFrame:
    """T1 over ``df`` with every card's state started from the transactions in ``history``, which
    come before those of the stream. ``options`` are those of the processor."""
    from cardwise.streaming.jobs import _stateful_conf

    _stateful_conf(df.sparkSession)
    caps = options.get("caps") or (MAX_MCC, MAX_MERCHANTS)
    facts = (
        df.select(*TXN_COLUMNS)
        .groupBy("card_id")
        .transformWithState(
            statefulProcessor=WarmCardProcessor(**options),
            outputStructType=FACTS_SCHEMA,
            outputMode="Append",
            timeMode="None",
            initialState=card_history(history.select(*TXN_COLUMNS), caps).groupBy("card_id"),
        )
    )
    return features_from_facts(facts)
