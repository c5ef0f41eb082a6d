"""Phrase collocations: mergeable Misra-Gries summaries, then an exact second pass.

1. Summaries, order by order (single words, then phrases of 2, 3, ... words). A task counts the
   hashed n-grams of its own texts and sends them, packed, to hash partitions. Each partition
   feeds a Misra-Gries summary whose capacity exceeds its mass (the occurrences it gets) divided
   by the threshold, so what the summary has subtracted (``lost``) stays below the threshold and
   every n-gram that occurs so often survives: of each it keeps a count that is too low by at most
   that. Summaries take sorted arrays of counts and merge by adding, then subtracting the
   (capacity + 1)-th largest count from all. Masses are known only after the shuffle, so the
   capacity is set from the order before and ``lost`` is looked at afterwards (``survivors``).
2. What survives marks a bit map of bounded size (``MAP_BITS``); n-grams of the next order are
   sent only if their first and last n-gram of this order are marked, as those of every frequent
   one are. A full map would let more through, never less.
3. Second pass: the n-grams of all orders that are marked are counted exactly, as text, and those
   below the threshold go. Parts of a frequent phrase are frequent, so their counts are there.
4. Phrases are scored, dropped inside longer ones, and ranked by joins on (language, phrase).

Arithmetic on counts is decimal. A language with a third of all rows, or a very frequent phrase,
costs a task one row a task before it, and the ranking keeps the best of every (language, salt)
first. Memory of a task: ``HELD`` n-grams while counting, the capacities of its partitions later.

Defined results: null text counts as empty, null language as ``und``; an empty table gives no
rows; repeated rows count as often as they are there; other columns are ignored.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cardwise.llm.grams import Chunk, chunks, held
from cardwise.llm.helpers import LOWER, UPPER, text_or_empty, written
from cardwise.session import partitions

THRESHOLD, LONGEST, TOP, COVER = 30, 4, 2000, 80
SCALE = 2_000_000
MAP_BITS, LEAST_BITS, BITS_EACH = 1 << 27, 1 << 16, 64
BLOCK = 16  # a block of the bit map has so many bits as a power of two
HELD, BLOCK_GRAMS, LEAST_CAPACITY = 1 << 20, 1 << 12, 1 << 16
#: Phrases in a frame that the second pass sends, and bytes of text that it counts at a time.
FRAME, CHUNK = 1 << 15, 400_000
#: The summaries know an n-gram by so many leading bits of its hash; where two meet, both may
#: survive that should not, which the second pass sets right.
GRAM_BITS = 48
SALTS, SCANS = 64, 4


def summed(hashes: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct hashes with their summed counts."""
    if not len(hashes):
        return hashes, counts
    order = np.argsort(hashes)
    hashes, counts = hashes[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    return hashes[first], np.add.reduceat(counts, first)


class Summary:
    """A Misra-Gries summary: ``count <= true count <= count + lost``, ``lost`` being at most
    mass / (capacity + 1)."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def add(self, hashes: np.ndarray, counts: np.ndarray) -> None:
        self.hashes, self.counts = summed(np.concatenate([self.hashes, hashes]), np.concatenate([self.counts, counts]))
        if len(self.counts) > self.capacity:
            less = int(np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1])
            self.lost += less
            left = self.counts > less
            self.hashes, self.counts = self.hashes[left], self.counts[left] - less

    def merge(self, other: Summary) -> None:
        self.lost += other.lost
        self.add(other.hashes, other.counts)

    def frequent(self, threshold: int) -> np.ndarray:
        return self.hashes[self.counts + self.lost >= threshold]


def packed(hashes: np.ndarray, counts: np.ndarray, parts: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(part, grams of six bytes, their counts) in blocks; without counts, all are 1."""
    grams = hashes >> np.uint64(64 - GRAM_BITS)
    dealt = (grams % np.uint64(parts)).astype(np.int64)
    order = np.lexsort((counts > 1, dealt))
    grams, counts, dealt = grams[order], counts[order], dealt[order]
    kind = 2 * dealt + (counts > 1)
    edges = np.flatnonzero(np.concatenate([[True], kind[1:] != kind[:-1], [True]])) if len(kind) else []
    for a, b in pairwise(edges):
        for at in range(a, b, BLOCK_GRAMS):
            some = slice(at, min(at + BLOCK_GRAMS, b))
            low, high = grams[some].astype(np.uint32), (grams[some] >> np.uint64(32)).astype(np.uint16)
            yield int(dealt[at]), low.tobytes() + high.tobytes(), counts[some].tobytes() if counts[at] > 1 else b""


def unpacked(grams: bytes, counts: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = len(grams) // 6
    low, high = np.frombuffer(grams, np.uint32, n), np.frombuffer(grams, np.uint16, n, 4 * n)
    return high.astype(np.uint64) << np.uint64(32) | low, np.frombuffer(counts, np.int64) if counts else np.ones(n, np.int64)


def local_counts(rows: DataFrame, order: int, longest: int, maps: list[Broadcast], parts: int) -> DataFrame:
    """(part, grams, counts): occurrences of the order's n-grams, summed within a task, packed."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = [m.value for m in maps]
        buffer: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def frame(hashes: np.ndarray, counts: np.ndarray) -> pd.DataFrame:
            return pd.DataFrame(packed(hashes, counts, parts), columns=["part", "grams", "counts"])

        for chunk, _ in chunks(((x, t) for pdf in batches for x, t in zip(pdf["lang"], pdf["text"], strict=True)), longest):
            *_, (gram, mask) = chunk.grams(order, wanted)
            found = np.sort(gram[mask])
            first = np.flatnonzero(np.concatenate([[True], found[1:] != found[:-1]])) if len(found) else np.zeros(0, np.int64)
            buffer.append((found[first], np.diff(np.append(first, len(found)))))
            size += len(first)
            if size > 2 * HELD:
                buffer = [summed(*(np.concatenate(x) for x in zip(*buffer, strict=True)))]
                size = len(buffer[0][0])
                if size > HELD:
                    yield frame(*buffer[0])
                    buffer, size = [], 0
        if buffer:
            yield frame(*summed(*(np.concatenate(x) for x in zip(*buffer, strict=True))))

    return rows.mapInPandas(count, "part int, grams binary, counts binary")


def summaries(counts: DataFrame, threshold: int, capacity: int, parts: int) -> DataFrame:
    """(gram, lost, mass) of what survives in each hash partition; a row without a gram tells
    what a partition has lost and its mass."""

    def summarise(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[int, tuple[Summary, list[int]]] = {}
        for pdf in batches:
            for part, group in pdf.groupby("part"):
                summary, mass = found.setdefault(part, (Summary(capacity), [0]))
                grams, n = (np.concatenate(x) for x in zip(*map(unpacked, group["grams"], group["counts"]), strict=True))
                mass[0] += int(n.sum())
                summary.add(grams, n)
        for summary, mass in found.values():
            frame = pd.DataFrame({"gram": summary.frequent(threshold).view(np.int64), "lost": None, "mass": None})
            yield pd.concat([frame, pd.DataFrame({"gram": [None], "lost": [summary.lost], "mass": mass})]).astype("Int64")

    return counts.repartition(parts, "part").mapInPandas(summarise, "gram long, lost long, mass long")


def survivors(counts: DataFrame, order: int, threshold: int, mass: int, parts: int) -> tuple[DataFrame, int]:
    """((gram): every n-gram with ``threshold`` occurrences or more, and few others; their mass).
    The capacity is twice what an even share of ``mass`` asks for. A partition for which that was
    too little is known by having lost ``threshold`` or more; the order is then summarised anew
    with more capacity, so none is ever missed."""
    capacity = max(LEAST_CAPACITY, 2 * mass // (parts * threshold) + 1)
    while True:
        kept = written(summaries(counts, threshold, capacity, parts), f"survivors-{order}")
        lost, mass = kept.agg(F.max("lost"), F.sum("mass")).first()
        if (lost or 0) < threshold:
            return kept.where("gram IS NOT NULL").select("gram"), mass or 0
        capacity *= 4


def bit_map(grams: DataFrame) -> np.ndarray:
    """The n-grams' bits, by their leading bits; ``MAP_BITS`` at most, whatever the input."""
    size = min(MAP_BITS, max(LEAST_BITS, 1 << (BITS_EACH * grams.count()).bit_length()))
    shift = GRAM_BITS - size.bit_length() + 1

    def mark(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        bits = np.zeros(1 << BLOCK, np.uint8)
        bits[pdf["slot"].to_numpy() & ((1 << BLOCK) - 1)] = 1
        return pd.DataFrame({"block": [key[0]], "bits": [np.packbits(bits, bitorder="little").tobytes()]})

    slot = F.shiftrightunsigned("gram", shift)
    slots = grams.select(slot.alias("slot")).distinct().withColumn("block", F.shiftright("slot", BLOCK))
    bits = np.zeros(size >> 3, np.uint8)
    for block, found in slots.groupBy("block").applyInPandas(mark, "block long, bits binary").collect():  # MAP_BITS at most
        at = block << (BLOCK - 3)
        bits[at : at + len(found)] = np.frombuffer(found, np.uint8)
    return bits


class Tally:
    """Exact counts of phrases that are known by their hashes."""

    def __init__(self):
        self.hashes, self.rows, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.phrases: list[bytes] = []
        self.langs: list[str] = []  # each a reference to one of a few names

    def add(self, chunk: Chunk, names: list[str], order: int, gram: np.ndarray, at: np.ndarray) -> None:
        hashes, first, counts = np.unique(gram[at], return_index=True, return_counts=True)
        place = np.searchsorted(self.hashes, hashes)
        known = np.zeros(len(hashes), bool)
        inside = place < len(self.hashes)
        known[inside] = self.hashes[place[inside]] == hashes[inside]
        self.counts[self.rows[place[known]]] += counts[known]
        new = np.flatnonzero(~known)
        rows = len(self.phrases) + np.arange(len(new))
        part = chunk.words[3]
        self.phrases += [chunk.phrase(i, order) for i in at[first[new]].tolist()]
        self.langs += [sys.intern(names[k]) for k in chunk.lang[part[at[first[new]]]].tolist()]
        self.hashes, self.rows = np.insert(self.hashes, place[new], hashes[new]), np.insert(self.rows, place[new], rows)
        self.counts = np.append(self.counts, counts[new])


def exact_counts(rows: DataFrame, longest: int, maps: list[Broadcast]) -> DataFrame:
    """(lang, words, phrase, n) of the marked n-grams, summed within a task; a row with a null
    phrase has the number of the language's words."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = [m.value for m in maps]
        tallies = {order: Tally() for order in range(1, longest + 1)}
        totals: dict[str, int] = {}

        def frames(order: int) -> Iterator[pd.DataFrame]:
            tally = tallies[order]
            tallies[order] = Tally()
            for at in range(0, len(tally.phrases), FRAME):  # decoded and sent in parts
                some = slice(at, at + FRAME)
                yield pd.DataFrame({"lang": tally.langs[some], "words": order, "phrase": [p.decode("utf-8", "replace") for p in tally.phrases[some]], "n": tally.counts[some]})

        for chunk, names in chunks(((x, t) for pdf in batches for x, t in zip(pdf["lang"], pdf["text"], strict=True)), longest, CHUNK):
            part, own = chunk.words[3:]
            for name, n in zip(names, np.bincount(chunk.lang[part[own]], minlength=len(names)).tolist(), strict=True):
                totals[name] = totals.get(name, 0) + n
            for order, (gram, mask) in enumerate(chunk.grams(longest, wanted), 1):
                at = np.flatnonzero(mask)
                tallies[order].add(chunk, names, order, gram, at[held(gram[at], wanted[order - 1])])
                if len(tallies[order].phrases) > HELD // 2:
                    yield from frames(order)
        for order in tallies:
            yield from frames(order)
        if totals:
            yield pd.DataFrame({"lang": list(totals), "words": 0, "phrase": [None] * len(totals), "n": list(totals.values())})

    return rows.mapInPandas(count, "lang string, words int, phrase string, n long")


def frequent_phrases(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, text_col: str = "text", lang_col: str = "lang", parts: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """((lang, words, phrase, f) of all phrases with ``threshold`` occurrences, (lang, n))."""
    spark = docs.sparkSession
    parts = parts or partitions(spark)
    rows = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), text_or_empty(F.col(text_col)).alias("text"))
    maps: list[Broadcast] = []
    mass = (rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0) // 2 + 1  # a word takes two bytes
    for order in range(1, longest + 1):
        kept, mass = survivors(local_counts(rows, order, longest, maps, parts), order, threshold, mass, parts)
        maps.append(spark.sparkContext.broadcast(bit_map(kept)))
    # a task counts several scan partitions, which saves a row for every phrase that they share
    tasks = max(spark.sparkContext.defaultParallelism, rows.rdd.getNumPartitions() // SCANS)
    counted = exact_counts(rows.coalesce(tasks), longest, maps).groupBy("lang", "words", "phrase").agg(F.sum("n").alias("f"))
    counted = written(counted.where(F.col("phrase").isNull() | (F.col("f") >= threshold)), "phrases")
    return counted.where(F.col("phrase").isNotNull()), counted.where(F.col("phrase").isNull()).select("lang", F.col("f").alias("n"))


def scored(phrases: DataFrame) -> DataFrame:
    """(lang, words, phrase, a, l, r, score): the lowest-scoring cut of each phrase of two words
    or more."""
    word = F.split("phrase", " ")
    cuts = phrases.where("words > 1").select("lang", "words", "phrase", F.col("f").alias("a"), word.alias("w"), F.explode(F.expr("sequence(1, words - 1)")).alias("k"))
    cuts = cuts.select(
        "lang", "words", "phrase", "a", "k",
        F.concat_ws(" ", F.expr("slice(w, 1, k)")).alias("first"), F.concat_ws(" ", F.expr("slice(w, k + 1, words - k)")).alias("rest"),
    )
    part = lambda key, n: phrases.select("lang", F.col("phrase").alias(key), F.col("f").alias(n))
    cuts = cuts.join(part("first", "l"), ["lang", "first"]).join(part("rest", "r"), ["lang", "rest"])
    score = F.expr(f"(cast(a AS decimal(20, 0)) * {SCALE}) div (cast(l AS decimal(20, 0)) + cast(r AS decimal(20, 0)))")
    best = cuts.groupBy("lang", "words", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return best.select("lang", "words", "phrase", "a", "cut.l", "cut.r", "cut.score")


def covered(phrases: DataFrame, cover: int) -> DataFrame:
    """(lang, phrase, most): phrases that lie inside longer ones, with the longer ones' largest
    count."""
    inside = phrases.where("words > 2").select("lang", "words", "f", F.split("phrase", " ").alias("w"), F.explode(F.expr("sequence(2, words - 1)")).alias("k"))
    inside = inside.select("lang", "f", "w", "k", F.explode(F.expr("sequence(1, words - k + 1)")).alias("at"))
    return inside.groupBy("lang", F.concat_ws(" ", F.expr("slice(w, at, k)")).alias("phrase")).agg(F.max("f").alias("most"))


def collocations(
    docs: DataFrame, threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, cover: int = COVER, text_col: str = "text", lang_col: str = "lang",
) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` phrases of each language."""
    phrases, totals = frequent_phrases(docs, threshold, longest, text_col, lang_col)
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    kept = scored(phrases).join(covered(phrases, cover), ["lang", "phrase"], "left")
    kept = kept.where(F.col("most").isNull() | (wide("most") * 100 < wide("a") * cover))
    order = (F.desc("score"), F.desc("a"), F.asc("phrase"))
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    # at most SALTS * top rows of a language are left
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= top)
    return kept.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def oracle(threshold: int = THRESHOLD, longest: int = LONGEST, top: int = TOP, cover: int = COVER) -> str:
    return rf"""
WITH pieces AS (
  SELECT lang, row_number() OVER () AS piece, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
    SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')) AS p
    FROM documents)),
totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM pieces GROUP BY lang),
places AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM pieces WHERE len(w) > 0),
grams AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase FROM places, range(1, {longest + 1}) t(k) WHERE i + k - 1 <= len(w)),
freq AS (SELECT lang, k AS words, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= {threshold}),
cut AS (
  SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w, unnest(range(1, words)) AS k FROM freq WHERE words > 1),
cuts AS (
  SELECT cut.lang, cut.words, cut.phrase, a, k, x.f AS l, y.f AS r,
         (a::HUGEINT * {SCALE}) // (x.f::HUGEINT + y.f::HUGEINT) AS score
  FROM cut JOIN freq x ON x.lang = cut.lang AND x.phrase = array_to_string(w[1:k], ' ')
           JOIN freq y ON y.lang = cut.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
spans AS (SELECT lang, f, string_split(phrase, ' ') AS w, words, unnest(range(2, words)) AS k FROM freq WHERE words > 2),
inside AS (SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, max(f) AS most FROM spans, range(1, {longest + 1}) t(i) WHERE i + k - 1 <= words GROUP BY ALL),
kept AS (
  SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE most IS NULL OR 100::HUGEINT * most < {cover}::HUGEINT * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN totals USING (lang) WHERE rank <= {top}
"""
