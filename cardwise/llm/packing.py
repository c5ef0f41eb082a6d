"""Variable-capacity best-fit packing of documents into training sequences.

A document's length is its number of words (or any length column). What is longer than the
largest permitted sequence is cut into pieces of that length and a rest; every token of every
document is in exactly one piece. Pieces are dealt by a hash into groups of about
``group_pieces`` (the number of groups grows with the data, so no task grows), and each group
is packed longest first:

* a piece goes into the open bin with the least room that still holds it;
* if none does, a new bin is opened in the size of least cost per token it can expect to hold:
  ``cost(c) / min(c, length of all pieces not yet placed)`` over the sizes that hold the piece;
* at the end each bin shrinks to the smallest permitted size that holds its contents.

``cost(c)`` is ``c`` plus a fixed share per sequence plus a part that grows with the square,
as attention does; sizes and costs are arguments.

Defined results: a document without words (null or empty text) has one row with length 0 and
no bin; repeated rows and null ids are packed like others, a row each; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Mapping, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwise.llm.helpers import WORD, text_or_empty, written

SIZES = (512, 1024, 2048, 4096, 8192)
GROUP_PIECES = 20_000
SCHEMA = "doc_id long, piece int, start long, length long, bin long, capacity int, offset int"


def cost_of(size: int, fixed: float = 64, square: float = 1 / 32768) -> float:
    return size + fixed + square * size * size


def word_count(text: Column) -> Column:
    return F.regexp_count(text_or_empty(text), F.lit(WORD)).cast("long")


def best_fit(lengths: Sequence[int], costs: Mapping[int, float]) -> tuple[list[int], list[int], list[int]]:
    """(bin of each piece, offset of each piece, size of each bin); pieces longest first."""
    sizes = sorted(costs)
    left = sum(lengths)
    room: list[tuple[int, int]] = []  # (room, bin), sorted
    opened: list[int] = []
    used: list[int] = []
    bins, offsets = [], []
    for n in lengths:
        i = bisect_left(room, (n, -1))
        if i < len(room):
            free, at = room.pop(i)
        else:
            free = min((c for c in sizes if c >= n), key=lambda c: (costs[c] / min(c, left), c))
            at = len(opened)
            opened.append(free)
            used.append(0)
        bins.append(at)
        offsets.append(used[at])
        used[at] += n
        left -= n
        if free > n:
            insort(room, (free - n, at))
    return bins, offsets, [sizes[bisect_left(sizes, u)] for u in used]


def pack(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str | None = None,
    sizes: Sequence[int] = SIZES, costs: Mapping[int, float] | None = None, group_pieces: int = GROUP_PIECES,
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, bin, capacity, offset (``SCHEMA``)."""
    costs = dict(costs or {c: cost_of(c) for c in sizes})
    largest = max(costs)
    length = word_count(F.col(text_col)) if length_col is None else F.coalesce(F.greatest(F.col(length_col).cast("long"), F.lit(0)), F.lit(0))
    rows = written(docs.select(F.col(id_col).cast("long").alias("doc_id"), length.alias("words"), F.monotonically_increasing_id().alias("row")), "lengths")
    pieces = F.greatest(F.lit(1), F.ceil(F.col("words") / largest)).cast("int")
    total = rows.agg(F.sum(pieces)).first()[0] or 0
    groups = max(1, -(-total // group_pieces))
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), pieces - 1)).alias("piece"))
    start = F.col("piece").cast("long") * largest
    rows = rows.select(
        "doc_id", "row", "piece", start.alias("start"), F.least(F.lit(largest), F.col("words") - start).cast("long").alias("length"),
        F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).alias("group"),
    )

    def pack_group(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row", "piece"], ascending=[False, True, True])
        some = pdf["length"] > 0
        bins, offsets, capacity = best_fit(pdf.loc[some, "length"].tolist(), costs)
        out = pdf[["doc_id", "piece", "start", "length"]].assign(bin=None, capacity=None, offset=None)
        out["doc_id"] = out["doc_id"].astype("Int64")
        first = int(key[0]) << 32
        out.loc[some, "bin"] = [first + b for b in bins]
        out.loc[some, "capacity"] = [capacity[b] for b in bins]
        out.loc[some, "offset"] = offsets
        return out.astype({"bin": "Int64", "capacity": "Int32", "offset": "Int32"})

    return rows.groupBy("group").applyInPandas(pack_group, SCHEMA)
