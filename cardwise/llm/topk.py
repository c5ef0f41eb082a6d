"""Exact top-k by inner product: no-random-access aggregation over blocks of sorted lists.

Candidates are dealt into blocks of about ``ROWS`` rows and queries into blocks of about
``ASKED``; every pair of blocks is one group with a key of its own, so the work spreads evenly
and each task holds two bounded blocks. In a block every component is a list sorted by value,
read in step from its end: from the top for a positive query component, from the bottom for a
negative one. Reading goes on in steps (``DEPTHS``, the share of a list read). After a step a
candidate's score lies between two bounds: what has been read, plus for each list not yet met
the list's far end (lower) or the value just read (upper). A candidate whose upper bound is
under its query's k-th largest lower bound cannot qualify and leaves that query for good. A
query stops reading when no more than ``LEFT`` times k candidates are left to it, and their
scores are resolved; one that never gets there has read its lists to the end.

``TOGETHER`` queries read side by side, so that a step's bounds are two matrix products over
the candidates that any query still reading holds; which candidates are left, and when to stop,
is each query's own. With the depth's value ``f``, an entry counts as ``max(x, f)`` (upper) or
as ``x`` where ``x >= f`` and the list's end elsewhere (lower).

Numbers are exact: single or double precision is used only where every partial sum fits its
mantissa, else 64-bit integers, else (partial sums of 2^63 or more) Python's integers.
Components are ``floor(64 * x)``. A component of 2^63 or more after scaling, or a score among
a block's best that a 64-bit column cannot hold, ends the query with an error.

Defined results: vectors that are null or hold a null or non-finite component, and rows
without id, take no part; shorter vectors count as filled with zeros; a query does not meet
rows of its own id; repeated candidate rows are ranked each; of a repeated query id the
smallest vector asks; ties go to the smaller id; empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

K, SCALE = 20, 64
ROWS, ASKED, TOGETHER = 8192, 4096, 64
DEPTHS = (0.25, 0.5, 0.75, 0.875, 0.9375, 1.0)
LEFT = 4
SCHEMA = "query_id long, vec_id long, score long"


def quantised(vector: Column) -> Column:
    """``floor(SCALE * x)`` of every component; null for a vector that takes no part."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    scaled = F.transform(vector, lambda x: x.cast("double") * SCALE)
    too_large = F.raise_error(F.lit("a vector's component is too large for 64 bits"))
    fits = F.forall(scaled, lambda y: F.abs(y) < 2.0**63)
    return F.when(whole, F.when(fits, F.transform(scaled, lambda y: F.floor(y).cast("long"))).otherwise(too_large))


def matrix(vectors: pd.Series, dims: int) -> np.ndarray:
    out = np.zeros((len(vectors), dims), np.int64)
    for i, v in enumerate(vectors):
        out[i, : len(v)] = v
    return out


def number_kind(queries: np.ndarray, block: np.ndarray) -> tuple[type, int]:
    """The cheapest type that holds every partial sum exactly, and a bound of all scores."""
    bound = int(np.abs(queries).max(initial=0)) * int(np.abs(block).max(initial=0)) * max(block.shape[1], 1)
    return np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else np.int64 if bound < 1 << 63 else object, bound


def read_lists(ask: np.ndarray, block: np.ndarray, lists: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[int, float, np.ndarray]]:
    """(query, share of the lists read, rows of ``block`` that may still qualify) as queries stop
    reading, each query once. ``lists``: the block with every column sorted."""
    n = len(block)
    kind, bound = number_kind(ask, block)
    plus, minus = np.maximum(ask, 0).astype(kind), np.minimum(ask, 0).astype(kind)
    reading, rows, left = np.arange(len(ask)), np.arange(n), ~own
    depth = 0.0
    for ahead in DEPTHS:
        few = left.sum(1) <= LEFT * k
        for q in np.flatnonzero(few):
            yield reading[q], depth, rows[left[q]]
        reading, left = reading[~few], left[~few]
        if not len(reading):
            return
        some = left.any(0)
        rows, left = rows[some], left[:, some]
        depth, t = ahead, max(1, int(n * ahead))
        part, high, low = block[rows], lists[n - t], lists[t - 1]
        up, down = plus[reading], minus[reading]
        upper = up @ np.maximum(part, high).T.astype(kind) + down @ np.minimum(part, low).T.astype(kind)
        lower = up @ np.where(part >= high, part, lists[0]).T.astype(kind) + down @ np.where(part <= low, part, lists[-1]).T.astype(kind)
        lower[~left] = -bound - 1
        reached = np.partition(lower, len(rows) - k, axis=1)[:, len(rows) - k]
        left &= (upper >= reached[:, None]).astype(bool)
    for q, mine in zip(reading, left, strict=True):
        yield q, depth, rows[mine]


def top_k(queries: np.ndarray, block: np.ndarray, own: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows of ``block``, scores) of each query's k best; rows stand in the order of ties.
    ``own``: (queries x rows) mask of rows that a query does not meet."""
    kind, _ = number_kind(queries, block)
    lists = np.sort(block, axis=0)
    for at in range(0, len(queries), TOGETHER):
        ask = queries[at : at + TOGETHER]
        found = {q: rows for q, _, rows in read_lists(ask, block, lists, own[at : at + TOGETHER], k)}
        for q in range(len(ask)):
            rows = found[q]
            score = block[rows].astype(kind) @ ask[q].astype(kind)
            order = np.argsort(-score, kind="stable")[:k]
            yield rows[order], score[order].astype(np.int64)


def exact_top_k(vectors: DataFrame, is_query: Column, k: int = K, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """Rows query_id, rank, vec_id, score. ``is_query`` is a condition on the input's columns."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), quantised(F.col(vector_col)).alias("vector"), is_query.alias("asks"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
    asking = rows.where("asks").groupBy("vec_id").agg(F.min("vector").alias("vector"))
    n, n_asking = rows.agg(F.count("*"), F.sum(F.col("asks").cast("int"))).first()
    blocks, asks = max(1, -(-n // ROWS)), max(1, -(-(n_asking or 0) // ASKED))
    every = lambda count: F.explode(F.sequence(F.lit(0), F.lit(count - 1)))
    dealt = lambda count, *by: F.pmod(F.xxhash64(*by), F.lit(count)).cast("int")
    candidates = rows.select("vec_id", "vector", dealt(blocks, "vec_id", F.monotonically_increasing_id()).alias("block")).select("*", every(asks).alias("asked"))
    asking = asking.select("vec_id", "vector", dealt(asks, "vec_id").alias("asked")).select("*", every(blocks).alias("block"))

    def search(found: pd.DataFrame, asking: pd.DataFrame) -> pd.DataFrame:
        found = found.sort_values("vec_id", kind="stable")
        dims = max([0, *map(len, found["vector"]), *map(len, asking["vector"])])
        ids, asked = found["vec_id"].to_numpy(np.int64), asking["vec_id"].to_numpy(np.int64)
        if not len(ids) or not len(asked):
            return pd.DataFrame({c: np.zeros(0, np.int64) for c in ("query_id", "vec_id", "score")})
        best = list(top_k(matrix(asking["vector"], dims), matrix(found["vector"], dims), asked[:, None] == ids, k))
        return pd.DataFrame({
            "query_id": np.repeat(asked, [len(r) for r, _ in best]),
            "vec_id": ids[np.concatenate([r for r, _ in best])],
            "score": np.concatenate([s for _, s in best]),
        })

    best = candidates.groupBy("asked", "block").cogroup(asking.groupBy("asked", "block")).applyInPandas(search, SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def oracle(every: int, k: int = K) -> str:
    return f"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % {every} = 0),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM r WHERE rank <= {k}
"""
