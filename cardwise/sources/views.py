"""Transaction views over the driver's tables, in Spark and as equivalent SQL text.

The driver ships no transaction table, so three views map its tables onto the canonical
schema:

* ``txn``        ``events`` one-to-one (card = user, MCC = event type, merchant = props.k).
* ``txn_coarse`` the same rows with event time floored to 10 minutes, so one card has
  many rows at the same millisecond (exercises the (ts_ms, txn_id) tie order).
* ``txn_orders`` ``orders`` (card = customer, day-granular times: many ties).

The merchant's nation (``k mod 25``) is the region whose pseudo-location gives lat/lon,
so a change of merchant region moves the card. Labels and scores are deterministic
functions of the row id (about 3.5 % positive; scores on a 1/1000 grid force ties).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwise.functions.columns import pseudo_geo
from cardwise.operators.joins import bounded_broadcast

COARSE_MS = 600_000
# fixed values: row-id hash constants for the synthetic label and score
LABEL_MULT, LABEL_MOD, LABEL_CUT = 104729, 200, 7
SCORE_MULT, SCORE_MOD = 7919, 1000
NATIONS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def region_geo(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(nation key, lat, lon) for every nation: the hash runs once per nation, not per row."""
    nation = table(spark, sf_dir, "nation")
    lat, lon = pseudo_geo(F.col("n_name"))
    return nation.select(F.col("n_nationkey").cast("long").alias("geo_key"), lat.alias("lat"), lon.alias("lon"))


def _label(id_col: str):
    return F.when((F.col(id_col) * LABEL_MULT) % LABEL_MOD < LABEL_CUT, 1).otherwise(0).cast("int")


def _with_geo(spark: SparkSession, sf_dir: str, df: DataFrame, key: F.Column) -> DataFrame:
    geo = bounded_broadcast(region_geo(spark, sf_dir), max_rows=10_000)
    return df.withColumn("geo_key", key).join(geo, "geo_key", "left").drop("geo_key")


def events_txn(
    spark: SparkSession, sf_dir: str, coarse: bool = False, with_score: bool = False
) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    ts_ms = F.unix_millis(F.col("ts").cast("timestamp"))
    if coarse:
        ts_ms = ts_ms - F.pmod(ts_ms, F.lit(COARSE_MS))
    merchant = F.coalesce(F.get_json_object("props", "$.k"), F.lit(""))
    base = ev.select(
        F.lpad(F.col("event_id").cast("string"), 12, "0").alias("txn_id"),
        F.col("user_id").cast("string").alias("card_id"),
        ts_ms.alias("ts_ms"),
        F.col("value").alias("amount"),
        F.coalesce(F.col("event_type"), F.lit("NA")).alias("mcc"),
        merchant.alias("merchant_id"),
        _label("event_id").alias("label"),
        ((F.col("event_id") * SCORE_MULT) % SCORE_MOD / F.lit(1000.0)).alias("score"),
    )
    out = _with_geo(spark, sf_dir, base, F.pmod(F.col("merchant_id").cast("long"), F.lit(NATIONS)))
    cols = ["txn_id", "card_id", "ts_ms", "amount", "mcc", "merchant_id", "lat", "lon", "label"]
    return out.select(*cols, *(["score"] if with_score else []))


def orders_txn(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    base = o.select(
        F.lpad(F.col("o_orderkey").cast("string"), 12, "0").alias("txn_id"),
        F.col("o_custkey").cast("string").alias("card_id"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
        F.col("o_totalprice").alias("amount"),
        F.coalesce(F.col("o_orderpriority"), F.lit("NA")).alias("mcc"),
        F.coalesce(F.col("o_orderstatus"), F.lit("")).alias("merchant_id"),
        _label("o_orderkey").alias("label"),
        F.col("o_custkey").alias("_k"),
    )
    out = _with_geo(spark, sf_dir, base, F.pmod(F.col("_k"), F.lit(NATIONS)))
    return out.select("txn_id", "card_id", "ts_ms", "amount", "mcc", "merchant_id", "lat", "lon", "label")


VIEWS = {
    "txn": lambda spark, d: events_txn(spark, d),
    "txn_coarse": lambda spark, d: events_txn(spark, d, coarse=True),
    "txn_orders": orders_txn,
}


def scored_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Evaluation input: txn rows with a deterministic score on a 1/1000 grid (ties)."""
    return events_txn(spark, sf_dir, with_score=True)


# ----------------------------------------------------------------------------- SQL text

def _geo_sql(part: str) -> str:
    return (
        f"(CAST(CAST(('0x' || substr(sha256('{part}|' || n_name), 1, 16)) AS UBIGINT) AS DOUBLE)"
        " / 18446744073709551616.0)"
    )


GEO_SQL = (
    "SELECT CAST(n_nationkey AS BIGINT) AS geo_key, "
    f"round(-55.0 + {_geo_sql('lat')} * 125.0, 5) AS lat, "
    f"round(-170.0 + {_geo_sql('lon')} * 340.0, 5) AS lon FROM nation"
)


def events_txn_sql(coarse: bool = False, with_score: bool = False) -> str:
    ts = "(epoch_us(ts) // 1000)"
    score = f",\n       ((e.event_id * {SCORE_MULT}) % {SCORE_MOD}) / 1000.0 AS score" if with_score else ""
    if coarse:
        ts = f"({ts} - (({ts} % {COARSE_MS}) + {COARSE_MS}) % {COARSE_MS})"
    return f"""
SELECT lpad(CAST(e.event_id AS VARCHAR), 12, '0') AS txn_id,
       CAST(e.user_id AS VARCHAR) AS card_id,
       CAST({ts} AS BIGINT) AS ts_ms,
       e.value AS amount,
       coalesce(e.event_type, 'NA') AS mcc,
       coalesce(json_extract_string(e.props, '$.k'), '') AS merchant_id,
       g.lat AS lat, g.lon AS lon,
       CAST(CASE WHEN (e.event_id * {LABEL_MULT}) % {LABEL_MOD} < {LABEL_CUT} THEN 1 ELSE 0 END AS INTEGER) AS label{score}
FROM events e
LEFT JOIN ({GEO_SQL}) g
  ON g.geo_key = ((TRY_CAST(json_extract_string(e.props, '$.k') AS BIGINT) % {NATIONS}) + {NATIONS}) % {NATIONS}
"""


def orders_txn_sql() -> str:
    return f"""
SELECT lpad(CAST(o.o_orderkey AS VARCHAR), 12, '0') AS txn_id,
       CAST(o.o_custkey AS VARCHAR) AS card_id,
       CAST(epoch_us(o.o_orderdate) // 1000 AS BIGINT) AS ts_ms,
       o.o_totalprice AS amount,
       coalesce(o.o_orderpriority, 'NA') AS mcc,
       coalesce(o.o_orderstatus, '') AS merchant_id,
       g.lat AS lat, g.lon AS lon,
       CAST(CASE WHEN (o.o_orderkey * {LABEL_MULT}) % {LABEL_MOD} < {LABEL_CUT} THEN 1 ELSE 0 END AS INTEGER) AS label
FROM orders o
LEFT JOIN ({GEO_SQL}) g ON g.geo_key = ((o.o_custkey % {NATIONS}) + {NATIONS}) % {NATIONS}
"""


VIEW_SQL = {
    "txn": lambda: events_txn_sql(),
    "txn_coarse": lambda: events_txn_sql(coarse=True),
    "txn_orders": orders_txn_sql,
}

SCORED_SQL = events_txn_sql(with_score=True)


# ------------------------------------------------------------------- decisions fixture view
# fixed values: decision threshold, model version and the id-hash delays of the
# deterministic decisions table (scoring delay 5..454 ms, inference 0.0..9.9 ms)
DECISION_THRESHOLD = 0.95
MODEL_VERSION = "v1"
DELAY_MULT, DELAY_MOD, DELAY_BASE = 37, 450, 5
INFER_MULT, INFER_MOD = 13, 100


def decisions_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions over every ``events`` row: synthetic score, scored a fixed id-derived delay
    after the event (so monitoring queries are reproducible)."""
    from cardwise.operators.monitor import decisions

    scored = events_txn(spark, sf_dir, with_score=True)
    rid = F.col("txn_id").cast("long")
    delay = (rid * DELAY_MULT) % DELAY_MOD + DELAY_BASE
    scored_at = F.timestamp_millis(F.col("ts_ms") + delay)
    infer = ((rid * INFER_MULT) % INFER_MOD) / F.lit(10.0)
    return decisions(scored, DECISION_THRESHOLD, MODEL_VERSION, scored_at=scored_at, latency_ms=infer)


def decisions_sql() -> str:
    return f"""
SELECT txn_id, card_id,
       make_timestamp(ts_ms * 1000) AS event_ts,
       score, {DECISION_THRESHOLD} AS threshold,
       CASE WHEN score >= {DECISION_THRESHOLD} THEN 'REVIEW' ELSE 'APPROVE' END AS decision,
       CAST(label AS SMALLINT) AS label, '{MODEL_VERSION}' AS model_version,
       make_timestamp((ts_ms + (CAST(txn_id AS BIGINT) * {DELAY_MULT}) % {DELAY_MOD} + {DELAY_BASE}) * 1000) AS scored_at,
       ((CAST(txn_id AS BIGINT) * {INFER_MULT}) % {INFER_MOD}) / 10.0 AS latency_ms
FROM ({SCORED_SQL}) s
"""
