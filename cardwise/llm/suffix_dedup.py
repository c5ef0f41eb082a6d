"""Removal of repeated passages by sorted suffixes.

Strings are ``SPAN`` bytes from each byte of a text on (suffixes, cut to that length); one that is
somewhere else too, the same text included, is *repeated*, and the bytes it covers go.

1. Families (``cardwise.llm.suffixes``) of all texts. What shares no anchor gram with anything is
   not repeated, and a family whose very bytes are a family elsewhere is repeated as a whole. That
   leaves families that meet another one in part: the ends of passages and the surroundings of edits.
2. Their suffixes' leading tokens are the anchor's gram; distinct families go to buckets by sampled
   splitters of the gram, and of the bytes too where a gram has more than ``GIANT`` families, so
   that one with a third of all families is split over buckets. A bucket sorts the strings of
   each gram by multikey quicksort; neighbours that are equal to the end are repeated.
3. Comparison across boundaries: of the first and the last gram of a bucket, if they are split,
   each distinct string is sent once, by a 128-bit fingerprint, to meet its like in the others.
4. Repeated strings, as ranges of a text, go to the texts, where the covered bytes are cut out.

Texts are known by 120 bits of their SHA-256, so copies need no numbers and share their ranges. A
task holds a megabyte of text, later a bucket's families; nothing reaches the driver.

Defined results: null text counts as empty; texts shorter than ``SPAN`` bytes stay as they are; of
repeated passages every occurrence goes; repeated rows and null ids get a row each; an empty table
gives no rows; other columns are ignored. What is left may not be valid UTF-8, hence the digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwise.llm.helpers import text_or_empty, written
from cardwise.llm.suffixes import GRAM, LIMIT, SPAN, chunks, families, fingerprints, multikey_quicksort
from cardwise.session import partitions

TEXT_KEY = ("doc_a", "doc_b")
FAMILY = "doc_a long, doc_b long, at int, width int, lead int, anchor long, digest long"
JUDGED = "doc_a long, doc_b long, at int, until int, anchor long, place int, print_a long, print_b long"
WINDOWS, GIANT = 1 << 19, 1 << 14


def with_key(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, doc_a, doc_b."""
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(F.col(text_col)).alias("text"))
    digest = F.sha2("text", 256)
    part = lambda at: F.conv(F.substring(digest, at, 15), 16, 10).cast("long")
    return rows.select("doc_id", "text", part(1).alias("doc_a"), part(16).alias("doc_b"))


def all_families(rows: DataFrame, limit: int = LIMIT) -> DataFrame:
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            keys = pdf[list(TEXT_KEY)].to_numpy()
            for index, base, parts in chunks(pdf["text"], limit):
                part, start, count, lead, anchor, digest = families(parts)
                key = keys[np.array(index)[part]]
                yield pd.DataFrame(
                    {"doc_a": key[:, 0], "doc_b": key[:, 1], "at": np.array(base)[part] + start, "width": count, "lead": lead, "anchor": anchor, "digest": digest}
                )

    return rows.select(*TEXT_KEY, "text").where(F.octet_length("text") >= SPAN).mapInPandas(find, FAMILY)


def judge(pdf: pd.DataFrame, border: set[bytes]) -> pd.DataFrame:
    """Ranges of repeated strings among the families of some grams, and the distinct strings of
    the grams in ``border``."""
    data = np.frombuffer(b"".join(pdf["bytes"]) + bytes(8), np.uint8)
    size = pdf["bytes"].map(len).to_numpy()
    width, lead, many = pdf["width"].to_numpy(), pdf["lead"].to_numpy(), pdf["n"].to_numpy() > 1
    row = np.repeat(np.arange(len(pdf)), width)
    step = np.arange(len(row)) - np.repeat(np.cumsum(width) - width, width)
    place = (np.cumsum(size) - size)[row] + step
    before = lead[row] - step  # the anchor's place after the string's own
    gram = pd.factorize(pdf["token"])[0][row]
    label = multikey_quicksort(data, place, gram * (2 * SPAN) + before + SPAN)
    repeated = (np.bincount(label, minlength=len(label))[label] > 1) | many[row]
    own = repeated & ~many[row]
    first = np.flatnonzero(own & np.concatenate([[True], ~own[:-1] | (row[1:] != row[:-1])]))
    last = np.flatnonzero(own & np.concatenate([~own[1:] | (row[1:] != row[:-1]), [True]]))
    out = pdf.iloc[row[first]][[*TEXT_KEY, "at"]].reset_index(drop=True)
    out["until"] = out["at"] + step[last] + 1
    out["at"] += step[first]
    split = (pdf["token"].isin(border) & (pdf["spread"].map(len) > 0)).to_numpy()
    at_border = split[row] & (label == np.arange(len(label)))
    some = np.flatnonzero(at_border)
    sent = pdf.iloc[row[some]][[*TEXT_KEY, "at", "anchor"]].reset_index(drop=True)
    sent["at"] += step[some]
    sent["place"] = before[some]
    sent["print_a"], sent["print_b"] = fingerprints(data, place[some])
    sent["until"] = np.where(repeated[some], -1, sent["at"] + 1)  # -1: known to be repeated
    both = pd.concat([out, sent], ignore_index=True)
    return both.reindex(columns=["doc_a", "doc_b", "at", "until", "anchor", "place", "print_a", "print_b"]).astype(
        {"doc_a": "int64", "doc_b": "int64", "at": "int32", "until": "int32", "anchor": "Int64", "place": "Int32", "print_a": "Int64", "print_b": "Int64"}
    )


def judged_buckets(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """``judge`` over the sorted families of a bucket, some grams at a time; the last gram waits
    for the end."""
    held: pd.DataFrame | None = None
    opening = None
    for pdf in batches:
        if not len(pdf):
            continue
        opening = opening or pdf["token"].iloc[0]
        held = pdf if held is None else pd.concat([held, pdf], ignore_index=True)
        if held["width"].sum() < WINDOWS:
            continue
        going_on = (held["token"] == held["token"].iloc[-1]).to_numpy()
        if not going_on.all():
            yield judge(held[~going_on].reset_index(drop=True), {opening})
            held = held[going_on].reset_index(drop=True)
    if held is not None:
        yield judge(held, {opening, held["token"].iloc[-1]})


def repeated_ranges(rows: DataFrame, parts: int) -> DataFrame:
    """(doc_a, doc_b, at, until): the strings from byte ``at`` to before ``until`` are repeated."""
    found = written(all_families(rows), "families")
    stats = found.groupBy("anchor").agg(F.count("*").alias("n"), F.min("digest").alias("least"), F.max("digest").alias("most"))
    met = written(stats.where("n > 1").select("anchor", (F.col("least") == F.col("most")).alias("alike")), "met")
    hits = written(found.join(met, "anchor"), "hits")
    span = lambda df: df.select(*TEXT_KEY, "at", (F.col("at") + F.col("width")).alias("until"))

    place = F.struct(*TEXT_KEY, "at", "width", "lead")
    classes = hits.where("NOT alike").groupBy("anchor", "digest").agg(F.count("*").alias("n"), F.min(place).alias("one"))
    classes = written(classes.select("anchor", "digest", "n", "one.*"), "classes")
    several = hits.where("NOT alike").join(classes.where("n > 1").select("anchor", "digest"), ["anchor", "digest"])

    giants = classes.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > GIANT).select("anchor", F.lit(True).alias("giant"))
    texts = rows.select(*TEXT_KEY, "text").dropDuplicates(list(TEXT_KEY))
    data = F.col("text").cast("binary")
    held = classes.join(written(giants, "giants"), "anchor", "left").join(texts, list(TEXT_KEY)).select(
        *TEXT_KEY, "at", "width", "lead", "anchor", "n", "giant",
        F.substring(data, F.col("at") + 1, F.col("width") + (SPAN - 1)).alias("bytes"),
    )
    held = held.withColumn("token", F.substring("bytes", F.col("lead") + 1, F.lit(GRAM)))
    held = held.withColumn("spread", F.when(F.col("giant"), F.col("bytes")).otherwise(F.lit(b""))).drop("giant")
    buckets = written(held, "held").repartitionByRange(parts, "token", "spread").sortWithinPartitions("token", "spread")
    judged = written(buckets.mapInPandas(judged_buckets, JUDGED), "judged")
    sent = judged.where("print_a IS NOT NULL").groupBy("anchor", "place", "print_a", "print_b")
    # at most a row a bucket in each group
    across = sent.agg(F.count("*").alias("n"), F.collect_list(F.struct(*TEXT_KEY, "at", "until")).alias("strings")).where("n > 1")
    across = across.select(F.explode(F.filter("strings", lambda s: s["until"] > 0)).alias("s")).select("s.*")
    local = judged.where("print_a IS NULL").select(*TEXT_KEY, "at", "until")
    return span(hits.where("alike")).unionByName(span(several)).unionByName(local).unionByName(across).distinct()


def cut(text: bytes, ranges: np.ndarray) -> tuple[int, int, str]:
    """(bytes removed, runs removed, SHA-256 of the rest)."""
    ranges = np.sort(ranges)
    start, end = ranges >> 32, (ranges & 0xFFFFFFFF) + SPAN - 1
    end = np.maximum.accumulate(end)
    fresh = np.concatenate([[True], start[1:] > end[:-1]])
    first = np.flatnonzero(fresh)
    start, end = start[first], end[np.append(first[1:] - 1, len(end) - 1)]
    digest, at = hashlib.sha256(), 0
    for a, b in zip(start.tolist(), end.tolist(), strict=True):
        digest.update(text[at:a])
        at = b
    digest.update(text[at:])
    return int((end - start).sum()), len(start), digest.hexdigest()


def cut_rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for text, ranges in zip(pdf["text"], pdf["ranges"], strict=True):
            data = text.encode("utf-8", "surrogatepass")
            out.append((len(data), *((0, 0, hashlib.sha256(data).hexdigest()) if ranges is None else cut(data, np.asarray(ranges, np.int64)))))
        frame = pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "kept_sha256"])
        yield pd.concat([pdf[["doc_id"]].reset_index(drop=True), frame], axis=1)


def suffix_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    rows = with_key(docs, id_col, text_col)
    ranges = repeated_ranges(rows, parts or partitions(docs.sparkSession))
    packed: Column = F.shiftleft(F.col("at").cast("long"), 32) + F.col("until")
    per_text = ranges.groupBy(*TEXT_KEY).agg(F.collect_list(packed).alias("ranges"))  # no more than the text has bytes
    kind = rows.schema["doc_id"].dataType.simpleString()
    cut_up = rows.join(per_text, list(TEXT_KEY), "left").select(F.col("doc_id").cast("string").alias("doc_id"), "text", "ranges")
    out = cut_up.mapInPandas(cut_rows, "doc_id string, n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))


def oracle(span: int = SPAN) -> str:
    return f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS row, encode(coalesce(text, '')) AS b FROM documents),
places AS (SELECT row, b, unnest(range(1, octet_length(b) - {span - 2})) AS i FROM docs WHERE octet_length(b) >= {span}),
keyed AS (SELECT row, i, md5_number(b[i:i + {span - 1}]) AS k FROM places),
again AS (SELECT row, i FROM keyed QUALIFY count(*) OVER (PARTITION BY k) > 1),
steps AS (SELECT row, i, CASE WHEN i - lag(i) OVER (PARTITION BY row ORDER BY i) <= {span} THEN 0 ELSE 1 END AS fresh FROM again),
numbered AS (SELECT row, i, sum(fresh) OVER (PARTITION BY row ORDER BY i) AS s FROM steps),
spans AS (SELECT row, s, min(i) AS a, max(i) + {span} AS z FROM numbered GROUP BY row, s),
gaps AS (SELECT row, coalesce(lag(z) OVER (PARTITION BY row ORDER BY a), 1) AS a, a AS z FROM spans
  UNION ALL SELECT row, max(z), NULL FROM spans GROUP BY row),
kept AS (SELECT row, string_agg(hex(b[a:coalesce(z, octet_length(b) + 1) - 1]), '' ORDER BY a) AS h FROM gaps JOIN docs USING (row) GROUP BY row),
removed AS (SELECT row, sum(z - a)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY row)
SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       CASE WHEN h IS NULL THEN sha256(b) ELSE sha256(from_hex(h)) END AS kept_sha256
FROM docs LEFT JOIN removed USING (row) LEFT JOIN kept USING (row)
"""
