"""Sharding by jump consistent hashing (DataFrame functions only).

A key walks through shard counts: standing in bucket ``b``, it next moves when the count
reaches ``floor((b + 1) / u) + 1``, with ``u`` in (0, 1] drawn from the key and ``b`` alone.
Its shard among ``n`` is the last bucket below ``n``. No table of the ring is kept, and one
more shard only takes rows into itself (each row with probability ``1 / (n + 1)``). The walk
is a fold over at most ``n`` steps (each step moves on by one at least; about ``ln n`` draws
are made). Draws are the first 13 hex digits of an MD5, so SQL engines agree on them.

Slots number a shard's rows without gaps in the order (block, doc_id, size, crc). A block is a
hash range of the keys that holds about ``rows_per_block`` rows, so a slot needs only the sort
of one block and the offset of that block; no task sees a whole shard. Rows that agree in id,
size and checksum are counted before they are shuffled and expanded after numbering, so a row
that is repeated without end does not fill a task.

Defined results: null text has size 16 and checksum 0; a row without id takes the MD5 of its
text as its key; repeated rows get slots of their own; an empty table gives no rows. Other
columns are ignored by ``shard_plan`` and kept by ``write_shards``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from cardwise.llm.helpers import text_or_empty, written

SCALE = 2.0**52
ROWS_PER_BLOCK = 20_000


def shard_key(id_col: Column, text_col: Column) -> Column:
    return F.coalesce(id_col.cast("string"), F.concat(F.lit("text:"), F.md5(text_or_empty(text_col).cast("binary"))))


def jump(key: Column, shards: int) -> Column:
    """Struct (b, j): the key's shard among ``shards``, and the bucket it would jump to next."""

    def after(b: Column) -> Column:
        draw = F.conv(F.substring(F.md5(F.concat_ws(":", key, b.cast("string")).cast("binary")), 1, 13), 16, 10).cast("long")
        return F.floor((b + 1) * F.lit(SCALE) / (draw + 1)).cast("long")

    def step(at: Column, _: Column) -> Column:
        return F.when(at["j"] < shards, F.struct(at["j"].alias("b"), after(at["j"]).alias("j"))).otherwise(at)

    zero = F.lit(0).cast("long")
    return F.aggregate(F.sequence(F.lit(1), F.lit(shards)), F.struct(zero.alias("b"), after(zero).alias("j")), step)


def shard_of(key: Column, shards: int) -> Column:
    return jump(key, shards)["b"].cast("int")


def shard_plan(docs: DataFrame, shards: int, id_col: str = "doc_id", text_col: str = "text", rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, law, shard, slot, grown_shard."""
    text, key = text_or_empty(F.col(text_col)), shard_key(F.col(id_col), F.col(text_col))
    placed = written(
        docs.select(
            F.col(id_col).alias("doc_id"),
            (F.octet_length(text) + 16).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("long").alias("hash"),
            jump(key, shards).alias("at"),
        ),
        "shards",
    )
    blocks = max(1, -(-placed.count() // (shards * rows_per_block)))
    placed = placed.select(
        "doc_id", "size", "text_crc32", F.col("at.b").cast("int").alias("shard"),
        F.when(F.col("at.j") == shards, shards).otherwise(F.col("at.b")).cast("int").alias("grown_shard"),
        (F.col("hash") % blocks).alias("block"),
    )
    upto = Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("shard", "block").count().select("shard", "block", F.coalesce(F.sum("count").over(upto), F.lit(0)).alias("start"))
    within = Window.partitionBy("shard", "block").orderBy(F.col("doc_id").asc_nulls_last(), "size", "text_crc32", "grown_shard")
    first = F.coalesce(F.sum("count").over(within.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    distinct = placed.groupBy("shard", "block", "doc_id", "size", "text_crc32", "grown_shard").count().withColumn("first", first)
    at = F.col("start") + F.col("first")
    return distinct.join(starts, ["shard", "block"]).select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard",
        F.explode(F.sequence(at, at + F.col("count") - 1)).alias("slot"), "grown_shard",
    )


def write_shards(docs: DataFrame, shards: int, path: str, id_col: str = "doc_id", text_col: str = "text", shard_col: str = "shard") -> None:
    """Whole rows into one folder per shard. The shard is an expression of the key: no shuffle."""
    if shard_col in docs.columns:
        raise ValueError(f"column {shard_col} exists; name another with shard_col")
    docs.withColumn(shard_col, shard_of(shard_key(F.col(id_col), F.col(text_col)), shards)).write.partitionBy(shard_col).parquet(path)


def oracle(shards: int, rows_per_block: int = ROWS_PER_BLOCK) -> str:
    draw = "floor(({b} + 1) * 4503599627370496.0::DOUBLE / (('0x' || substr(md5(k || ':' || {b}), 1, 13))::BIGINT + 1))::BIGINT"
    return f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 16 AS size, coalesce(text, '') AS t,
         coalesce(doc_id::VARCHAR, 'text:' || md5(coalesce(text, ''))) AS k FROM documents),
bits AS (
  SELECT i, list_reduce([i::BIGINT, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda a, s: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v FROM range(256) r(i)),
crc_table AS (SELECT list(v ORDER BY i) AS c FROM bits),
hexed AS (SELECT DISTINCT t, hex(encode(t)) AS h FROM docs),
crcs AS (
  SELECT t, xor(list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(len(h) // 2), lambda p: ('0x' || substr(h, 2 * p + 1, 2))::BIGINT)),
    lambda a, x: xor(c[xor(a, x) % 256 + 1], a // 256)), 4294967295) AS crc FROM hexed, crc_table),
walk(k, b, j) AS (
  SELECT k, 0::BIGINT, {draw.format(b="0")} FROM (SELECT DISTINCT k FROM docs)
  UNION ALL SELECT k, j, {draw.format(b="j")} FROM walk WHERE j < {shards}),
ends AS (SELECT k, max(b) AS b, max(j) AS j FROM walk GROUP BY k),
counted AS (SELECT greatest(1, ceil(count(*) / {float(shards * rows_per_block)}))::BIGINT AS blocks FROM docs)
SELECT doc_id, size::BIGINT AS size, crc::BIGINT AS text_crc32, 'key' AS law, b::INTEGER AS shard,
       row_number() OVER (PARTITION BY b ORDER BY ('0x' || substr(md5(k), 1, 8))::BIGINT % blocks, doc_id, size, crc) - 1 AS slot,
       CASE WHEN j = {shards} THEN {shards} ELSE b END::INTEGER AS grown_shard
FROM docs JOIN ends USING (k) JOIN crcs USING (t), counted
"""
