"""Connected components of a link table by smallest labels and pointer jumping.

Each round a node takes the smallest label among its neighbours' and its own, then the label
that its label has (a jump), so long chains shrink by halves. Rounds end when nothing changes.
Labels are written once a round under the shared checkpoint folder; nothing but the number of
changes reaches the driver. Hubs are pre-aggregated before the shuffle of the minimum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwise.llm.helpers import written


def components(links: DataFrame) -> DataFrame:
    """(node, label) of every node in ``links`` (columns a, b); label is the smallest node of
    its component."""
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("a")).alias("label"))
    labels = written(labels, "labels")
    while True:
        of_b = labels.select(F.col("node").alias("b"), F.col("label").alias("seen"))
        lowest = both.join(of_b, "b").groupBy(F.col("a").alias("node")).agg(F.min("seen").alias("seen"))
        nearer = labels.join(lowest, "node").select("node", "label", F.least("label", "seen").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("label").alias("then"))
        after = written(nearer.join(jump, "now").select("node", F.least("now", "then").alias("now"), "label"), "labels")
        changed = after.where(F.col("now") != F.col("label")).limit(1).count()
        labels = after.select("node", F.col("now").alias("label"))
        if not changed:
            return labels
