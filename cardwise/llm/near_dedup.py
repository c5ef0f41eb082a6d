"""MinHash near-dedup: fast similarity sketches, banding, exact verification.

Texts whose shingle sets are equal form a *class*; a class is compared once. Two classes are
candidates if one of ``BANDS`` bands of their sketches agrees (``minhash``): a pair at a
threshold of 0.85 is missed with a probability of (1 - 0.85^5)^32, about 7e-9, one at 0.8 with
about 3e-6. Candidates are confirmed on the full shingle sets, against ``percent`` of their
union. Groups are handled without emitting their pairs:

* *Bounds first.* A shingle that no other candidate class has cannot be in an intersection.
  With n shingles, s of them shared, two classes can only be linked if
  ``(100 + percent) * min(s, s') >= percent * (n + n')``. Classes that cannot reach this with
  anybody leave, and the rest is counted again. The filter is exact.
* *Star.* In each bucket all members are verified against the smallest one, which joins a
  group of true near copies with as many pairs as it has members.
* *Rest.* Only members of one bucket that are not yet in the same component meet each other,
  under the bound and a second exact one (no intersection is larger than the sum, over hash
  remainders, of the smaller of the two counts of shingles), in the first band that they
  share; so no link between components is lost, and few pairs but links are made.

Components are found on the confirmed links by distributed label passing. Results reach the
rows through the distinct (scan partition, class) pairs, so a text with a third of all rows
does not fill a task. Shingles are compared as 64-bit hashes.

Defined results: null and empty texts, and texts without words, have no shingles, are linked
with nothing and stay; rows that repeat an id and text share their component; among null ids
the component is the smallest non-null id reached, or null (such a row counts as ``kept``); an
empty table gives no rows; other columns are ignored. ``kept`` compares ids alone; ``stays`` is
true for exactly one row of every component, the smallest by (id is null, id, scan order).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwise.llm import minhash
from cardwise.llm.components import components
from cardwise.llm.helpers import LOWER, UPPER, WORD, text_or_empty, written

#: Linked if so many percent of the union are in the intersection: op2's own threshold.
PERCENT = 85
BROADCAST_ROWS = 1_000_000
#: Entries of a class's profile: how many of its shingles have each hash remainder.
PROFILE = 256
CLASS = ("high", "low", "n")


def pass_bound(n_a: Column, s_a: Column, n_b: Column, s_b: Column, percent: int) -> Column:
    return F.least(s_a, s_b) * (100 + percent) >= percent * (n_a + n_b)


def meet_bound(n_a: Column, profile_a: Column, n_b: Column, profile_b: Column, percent: int) -> Column:
    """Whether two sets can be linked going by their profiles: no more than the smaller count of
    each remainder can be in the intersection."""
    most = F.aggregate(F.zip_with(profile_a, profile_b, lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)
    return most * (100 + percent) >= percent * (n_a + n_b)


def sketch_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, pos, run, text_hash, n, high, low, bands) per row, written: one pass over texts."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for at in range(0, len(texts), 1000):
                sets = minhash.shingle_sets(texts[at : at + 1000])
                digests = np.array([minhash.set_digest(s) for s in sets], np.uint64).view(np.int64)
                keys = minhash.band_keys(minhash.sketches(sets)).view(np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * minhash.BANDS, pa.int32()), pa.array(keys.ravel()))
                own = batch.slice(at, len(sets))
                yield pa.RecordBatch.from_arrays(
                    [own.column(c) for c in ("doc_id", "pos", "run", "text_hash")]
                    + [pa.array([len(s) for s in sets], pa.int64()), pa.array(digests[:, 0]), pa.array(digests[:, 1]), bands],
                    ["doc_id", "pos", "run", "text_hash", "n", "high", "low", "bands"],
                )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.monotonically_increasing_id().alias("pos"), F.spark_partition_id().alias("run"),
        F.xxhash64(text_or_empty(F.col(text_col))).alias("text_hash"), text_or_empty(F.col(text_col)).alias("text"),
    )
    schema = "doc_id long, pos long, run int, text_hash long, n long, high long, low long, bands array<long>"
    return written(rows.mapInArrow(sketch, schema), "sketches")


def sets_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(node, shingles, profile) of the classes in ``wanted`` (node, doc_id, text_hash), read from the
    texts again; the ids are broadcast only while they are few."""
    if wanted.count() <= BROADCAST_ROWS:
        wanted = F.broadcast(wanted)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    texts = texts.withColumn("text_hash", F.xxhash64("text")).withColumn("key", F.coalesce("doc_id", F.lit(-1)))
    keyed = wanted.select("node", F.col("text_hash"), F.coalesce("doc_id", F.lit(-1)).alias("key"))
    found = texts.join(keyed, ["key", "text_hash"]).select("node", "text")

    def shingle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), 1000):
                part = pdf.iloc[at : at + 1000]
                sets = minhash.shingle_sets(part["text"].tolist())
                profiles = [np.bincount((s % np.uint64(PROFILE)).astype(np.int64), minlength=PROFILE) for s in sets]
                yield pd.DataFrame({"node": part["node"], "shingles": [s.view(np.int64) for s in sets], "profile": profiles})

    sets = found.mapInPandas(shingle, "node long, shingles array<long>, profile array<int>")
    return written(sets.groupBy("node").agg(F.first("shingles").alias("shingles"), F.first("profile").alias("profile")), "sets")


def shared_counts(sets: DataFrame) -> DataFrame:
    """(node, n, s): s of the n shingles are in another set of the table too."""
    owners = sets.select("node", F.explode("shingles").alias("shingle")).groupBy("shingle").agg(F.min("node").alias("node"), F.max("node").alias("other"))
    alone = owners.where(F.col("node") == F.col("other")).groupBy("node").agg(F.count("*").alias("alone"))
    return sets.select("node", F.size("shingles").cast("long").alias("n")).join(alone, "node", "left").select("node", "n", (F.col("n") - F.coalesce("alone", F.lit(0))).alias("s"))


def with_possible_partner(members: DataFrame, percent: int) -> DataFrame:
    """Nodes that pass the bound with some other member of a bucket (key, node, n, s): of the
    others, the most favourable n and s are taken, so none is lost."""
    best = members.groupBy("key").agg(
        F.count("*").alias("size"), F.min("n").alias("least_n"), F.max("s").alias("most_s")
    )
    fits = members.join(best, "key").where((F.col("size") > 1) & pass_bound(F.col("n"), F.col("s"), F.col("least_n"), F.col("most_s"), percent))
    return fits.select("node").distinct()


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are linked, verified on the full sets."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("of_a"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("of_b"))
    both = pairs.join(left, "a").join(right, "b")
    inside = F.size(F.array_intersect("of_a", "of_b"))
    return both.where(inside * (100 + percent) >= percent * (F.size("of_a") + F.size("of_b"))).select("a", "b")


def linked_classes(docs: DataFrame, classes: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """(node, label): component of every class that is linked with another."""
    bands = classes.where("n > 0").select("node", F.posexplode("bands").alias("band", "key"))
    several = bands.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where(F.col("first") != F.col("last"))
    members = written(bands.join(several.select("key"), "key"), "members")
    candidates = members.select("node").distinct().join(classes, "node").select("node", F.col("best.doc_id").alias("doc_id"), F.col("best.text_hash").alias("text_hash"))
    sets = sets_of(docs, candidates, id_col, text_col)

    counts = written(shared_counts(sets).where(F.col("s") * 100 >= F.col("n") * percent), "counts")
    sets = written(sets.join(counts.select("node"), "node"), "sets")
    counts = written(shared_counts(sets).where(F.col("s") * 100 >= F.col("n") * percent), "counts")
    members = written(members.join(counts, "node"), "members")
    members = written(members.join(with_possible_partner(members, percent), "node"), "members")

    stars = members.join(members.groupBy("key").agg(F.min(F.struct("node", "n", "s")).alias("star")), "key").where(
        (F.col("node") != F.col("star.node")) & pass_bound(F.col("n"), F.col("s"), F.col("star.n"), F.col("star.s"), percent)
    )
    pairs = stars.select(F.col("star.node").alias("a"), F.col("node").alias("b")).distinct()
    star_links = written(confirmed(pairs, sets, percent), "links")
    labels = components(star_links)

    placed = members.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    mixed = placed.groupBy("key").agg(F.min("label").alias("low"), F.max("label").alias("high")).where(F.col("low") != F.col("high"))
    rest = written(placed.join(mixed.select("key"), "key").join(classes.select("node", "bands"), "node").join(sets.select("node", "profile"), "node"), "rest")
    side = lambda name: rest.select("key", "band", *(F.col(c).alias(f"{name}_{c}") for c in ("node", "n", "s", "label", "bands", "profile")))
    before = lambda name: F.slice(F.col(f"{name}_bands"), F.lit(1), F.col("band"))
    meet = side("a").join(side("b").drop("band"), "key").where(
        (F.col("a_node") < F.col("b_node")) & (F.col("a_label") != F.col("b_label"))
        & pass_bound(F.col("a_n"), F.col("a_s"), F.col("b_n"), F.col("b_s"), percent)
        & ~F.exists(F.zip_with(before("a"), before("b"), lambda x, y: x == y), lambda same: same)
        & meet_bound(F.col("a_n"), F.col("a_profile"), F.col("b_n"), F.col("b_profile"), percent)
    )
    rest_links = written(confirmed(meet.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), sets, percent), "links")
    return components(star_links.unionByName(rest_links))


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id, kept, stays, text_hash."""
    rows = sketch_rows(docs, id_col, text_col)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "pos", "text_hash")).alias("best")
    classes = written(rows.groupBy(*CLASS).agg(F.min("pos").alias("node"), best, F.first("bands").alias("bands")), "classes")
    labels = linked_classes(docs, classes, id_col, text_col, percent)
    smallest = labels.join(classes, "node").groupBy("label").agg(F.min(F.struct("best.no_id", "best.doc_id", "best.pos")).alias("least"))
    placed = labels.join(smallest, "label").select("node", "least")
    first = F.coalesce("least", F.struct("best.no_id", "best.doc_id", "best.pos"))
    answers = classes.join(placed, "node", "left").select(*CLASS, first["doc_id"].alias("component_id"), first["pos"].alias("first_pos"))
    pairs = rows.select("run", *CLASS).where("n > 0").distinct().join(answers, list(CLASS))
    component = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return rows.join(pairs, ["run", *CLASS], "left").select(
        "doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"),
        ((F.col("n") == 0) | (F.col("pos") == F.col("first_pos"))).alias("stays"), "text_hash",
    )


ORACLE = rf"""
WITH RECURSIVE texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM texts),
sizes AS (SELECT doc_id, count(s) AS n FROM texts LEFT JOIN shingles USING (doc_id) GROUP BY doc_id),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= {PERCENT} * (p.n + q.n - c)),
reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM texts UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT doc_id, n AS n_shingles, min(other) AS component_id, doc_id = min(other) AS kept
FROM reach JOIN sizes USING (doc_id) GROUP BY doc_id, n
"""
