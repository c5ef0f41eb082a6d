"""Join helpers: broadcast only behind a size check, otherwise a shuffle join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_broadcast(df: DataFrame, max_rows: int) -> DataFrame:
    """Mark ``df`` for broadcast only if it has at most ``max_rows`` rows.

    The check counts at most ``max_rows + 1`` rows (a bounded job); a larger side is returned
    unmarked so the planner falls back to a shuffle join.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df
