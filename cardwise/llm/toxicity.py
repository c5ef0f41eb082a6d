"""Toxicity scores by non-negative positive-unlabelled learning.

Learned from confirmed toxic texts (P) and unlabelled texts (U: any text of the training
folds); that a text is labelled clean is used for nothing. The class prior ``pi``, the toxic share
of U, is an argument or estimated from P and U (``estimated_prior``). A linear classifier on the
hashed set of a text's words and of their first letters (``STEMS`` bytes; inflected words share
them, and whether several distinct words of a text do counts besides) minimises the
class-prior-corrected risk with the logistic loss l:

    pi * mean_P l(z) + max(0, mean_U l(-z) - pi * mean_P l(-z))

Only buckets that tell P from U take part: those whose shares in the two differ by ``TELLING``
standard errors. Where the corrected part is negative, the step goes against it, as the method prescribes, so
it cannot be driven below zero by overfitting. Weights are pulled to zero by soft thresholding.
``MEMBERS`` classifiers are trained in tasks of their own, on disjoint parts of U, and their
weights averaged.

Rows that repeat an id and its text count once, in every number and draw, so they neither flood
nor starve the rest.

Bounds: about ``FIT_POSITIVE`` toxic and ``FIT_UNLABELLED`` unlabelled texts are fitted on (a
hash of the id decides which), and weights have ``BUCKETS`` entries, which bounds what a
training task and the driver hold and what is broadcast. Every whole text is scored.

Defined results: null and empty texts have no words and get the classifier's base score;
without toxic training texts every score is ``pi`` if given, else 0;
null ids take no labels; repeated rows get a row each; an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cardwise.llm.helpers import fold
from cardwise.llm.words import distinct, unique, word_batches

BUCKETS = 1 << 20
MEMBERS = 4
FIT_POSITIVE, FIT_UNLABELLED = 8_000, 32_000
STEPS, RATE, SPARSE, TELLING = 200, 0.1, 1e-5, 5.0
#: Standard errors by which shares may be off in the first bound of the class prior, and in the
#: estimate by scores; the shares of P that its thresholds may leave above them.
MARGIN, SCORE_MARGIN, ABOVE = 3.0, 2.0, (0.3, 0.98)
ROUNDS = 2
#: Texts of an Arrow batch whose words a task holds at a time.
EXTRACT_ROWS = 1_000
STEMS = (4, 5)
#: Flips a bucket to the one that says that several distinct words of a text fell into it.
SEVERAL = 0x5A5A5
#: ASCII bytes that are no letters part words; upper case counts as lower case.
TABLE = bytes(c if c >= 128 or chr(c).isalpha() else 32 for c in range(256)).lower()


def clean(text: bytes) -> bytes:
    return text.translate(TABLE)


def hashed(words: list[bytes]) -> np.ndarray:
    """A row of buckets for each word: the word and its stems."""
    kinds = [words, *([w[:n] for w in words] for n in STEMS)]
    return np.stack([np.fromiter((zlib.crc32(w, i) for w in kind), np.int64, len(words)) % BUCKETS for i, kind in enumerate(kinds)], 1)


def features(texts: list[str | None], wanted: np.ndarray | None = None) -> list[np.ndarray]:
    """The sorted set of buckets of each text; of ``wanted`` (a mask) alone, if given. A bucket
    that several distinct words of a text share brings a further one (``SEVERAL``)."""
    telling = None if wanted is None else wanted | wanted[np.arange(BUCKETS) ^ SEVERAL]
    parts = [np.zeros((0, 2 + len(STEMS)), np.int64)]
    for index, words in word_batches(texts, clean=clean):
        codes, vocabulary = distinct(words)
        table = hashed(vocabulary)
        if telling is not None:
            some = telling[table].any(1)[codes]
            index, codes = index[some], codes[some]
        pairs = unique(index * len(vocabulary) + codes)
        parts.append(np.column_stack([pairs // len(vocabulary), table[pairs % len(vocabulary)]]))
    rows = np.concatenate(parts)
    if len(parts) > 2:  # a text cut into parts may bring a word more than once
        rows = rows[np.unique(rows[:, 0] * BUCKETS + rows[:, 1], return_index=True)[1]]
    pairs = np.sort((rows[:, :1] * BUCKETS + rows[:, 1:]).ravel())
    again = unique(pairs[1:][pairs[1:] == pairs[:-1]])
    pairs = unique(np.concatenate([pairs, again ^ SEVERAL]))
    if wanted is not None:
        pairs = pairs[wanted[pairs % BUCKETS]]
    ends = np.searchsorted(pairs, np.arange(1, len(texts)) * BUCKETS)
    return np.split(pairs % BUCKETS, ends) if len(texts) else []


def logits(sets: list[np.ndarray], weights: np.ndarray, bias: float) -> np.ndarray:
    sizes = np.array([len(s) for s in sets], np.int64)
    rows = np.repeat(np.arange(len(sets)), sizes)
    return bias + np.bincount(rows, weights[np.concatenate([*sets, np.zeros(0, np.int64)]).astype(np.int64)], len(sets))


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many of the texts have each bucket."""
    out = np.zeros(BUCKETS, np.int64)
    for some in sets:
        out[some] += 1
    return out


def prior_bound(positive: list[np.ndarray], unlabelled: list[np.ndarray]) -> float:
    """An estimate of the toxic share of U. A bucket that a share p of P and a share u of U have
    bounds it by u / p, and one that no clean text has by just that; the smallest such bound,
    with ``MARGIN`` standard errors to its disadvantage, is taken (1 if there is none)."""
    p, u = counts(positive) / len(positive), counts(unlabelled) / len(unlabelled)
    p = p - MARGIN * np.sqrt(p * (1 - p) / len(positive)) - 1 / len(positive)
    u = u + MARGIN * np.sqrt(u * (1 - u) / len(unlabelled)) + 1 / len(unlabelled)
    return float(min(1.0, (u[p > 0] / p[p > 0]).min(initial=1.0)))


def risk_and_slope(z: np.ndarray, is_p: np.ndarray, prior: float) -> tuple[float, float, np.ndarray]:
    """(risk of P as toxic, corrected risk of U as clean, slope of each logit): the slope of the
    sum of both, or against the second alone where that is negative."""
    n_p, n_u = int(is_p.sum()), int((~is_p).sum())
    p = sigmoid(z)
    positive = prior * np.logaddexp(0, -z[is_p]).mean()
    corrected = np.logaddexp(0, z[~is_p]).mean() - prior * np.logaddexp(0, z[is_p]).mean()
    if corrected >= 0:
        return positive, corrected, np.where(is_p, prior / n_p * ((p - 1) - p), p / n_u)
    return positive, corrected, -np.where(is_p, -prior / n_p * p, p / n_u)


def fit(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, np.ndarray, float]:
    """(buckets, weights, bias) of one classifier."""
    sets = [*positive, *unlabelled]
    n_p, n_u = len(positive), len(unlabelled)
    in_p, in_u = counts(positive), counts(unlabelled)
    share = (in_p + in_u) / (n_p + n_u)
    error = np.sqrt(share * (1 - share) * (1 / n_p + 1 / n_u)) + 1 / (n_p + n_u)
    telling = np.abs(in_p / n_p - in_u / n_u) > TELLING * error
    seen = np.flatnonzero(telling)
    kept = [some[telling[some]] for some in sets]  # the few buckets that count, before any array over all
    rows = np.repeat(np.arange(len(sets)), [len(some) for some in kept])
    column = np.searchsorted(seen, np.concatenate([*kept, np.zeros(0, np.int32)]))
    is_p = np.arange(len(sets)) < n_p
    w, bias = np.zeros(len(seen)), float(np.log(prior / (1 - prior)))
    first, second = np.zeros(len(seen) + 1), np.zeros(len(seen) + 1)
    for step in range(1, STEPS + 1):
        z = bias + np.bincount(rows, w[column], len(sets))
        slope = risk_and_slope(z, is_p, prior)[2]
        grad = np.append(np.bincount(column, slope[rows], len(seen)), slope.sum())
        first += 0.1 * (grad - first)
        second += 0.001 * (grad * grad - second)
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        scale = RATE / (np.sqrt(second[:-1] / (1 - 0.999**step)) + 1e-8)
        w -= move[:-1]
        w = np.sign(w) * np.maximum(np.abs(w) - SPARSE * scale, 0)
        bias -= float(move[-1])
    some = np.flatnonzero(w)
    return seen[some], w[some], bias


def unseen_logits(positive: list[np.ndarray], unlabelled: list[np.ndarray], prior: float) -> tuple[np.ndarray, np.ndarray]:
    """Logits of P and of U, each half by a classifier that was fitted on the other half."""
    z_p, z_u = np.zeros(len(positive)), np.zeros(len(unlabelled))
    for half in (0, 1):
        buckets, some, bias = fit(positive[half::2], unlabelled[half::2], prior)
        weights = np.zeros(BUCKETS)
        weights[buckets] = some
        z_p[1 - half :: 2] = logits(positive[1 - half :: 2], weights, bias)
        z_u[1 - half :: 2] = logits(unlabelled[1 - half :: 2], weights, bias)
    return z_p, z_u


def estimated_prior(positive: list[np.ndarray], unlabelled: list[np.ndarray], least: float) -> float:
    """An estimate of the toxic share of U. If a share p of P and a share u of U score above a
    threshold, the toxic share is at most u / p, and about that where no clean text scores so
    high; the threshold with the lowest such bound (u taken ``SCORE_MARGIN`` standard errors
    higher) is used. Scores are of texts that their classifier has not seen, first of classifiers
    fitted with the bound by single buckets, then with the estimate itself. ``least`` of U is known
    to be toxic, and is all that is known where the scores do not tell P from U (a bound of 1)."""
    clip = lambda x: float(min(0.999, max(least, x)))
    prior = clip(prior_bound(positive, unlabelled))
    if min(len(positive), len(unlabelled)) < 4:
        return prior
    for _ in range(ROUNDS):
        z_p, z_u = (np.sort(z) for z in unseen_logits(positive, unlabelled, prior))
        at = z_p[::-1][int(len(z_p) * ABOVE[0]) : max(int(len(z_p) * ABOVE[0]) + 1, int(len(z_p) * ABOVE[1]))]
        p, u = (1 - np.searchsorted(z, at, "left") / len(z) for z in (z_p, z_u))
        bounds = (u + SCORE_MARGIN * np.sqrt(u * (1 - u) / len(z_u))) / p
        best = bounds.argmin()
        if bounds[best] >= 1:
            return clip(least)
        prior = clip(u[best] / p[best])
    return prior


def member_keys(spark: SparkSession) -> list[int]:
    """A number for each member, such that each falls in a partition of its own."""
    at = F.pmod(F.hash(F.col("id").cast("int")), F.lit(MEMBERS)).alias("at")
    return [r["key"] for r in spark.range(64 * MEMBERS).groupBy(at).agg(F.min("id").cast("int").alias("key")).collect()]


def learn(
    docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, toxic_col: str, prior: float | None = None,
) -> tuple[np.ndarray, float]:
    """(weights, bias) averaged over the members."""
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("same"), train.alias("train")).where("train").drop("train")
    marks = labels.select(F.col(id_col).cast("long").alias("doc_id"), F.col(toxic_col).cast("int").alias("toxic")).where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    marks = marks.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).where("toxic = 1")
    ids = rows.select("doc_id", "same").distinct().join(marks, "doc_id", "left")
    n, n_toxic = ids.agg(F.count("*"), F.sum("toxic")).first()
    if not n_toxic:
        return np.zeros(BUCKETS, np.float32), float(np.log(prior / (1 - prior))) if prior else -40.0
    least = n_toxic / n  # of the rows of U so many are confirmed
    drawn = lambda wanted, of: F.pmod(F.xxhash64(F.lit(3), "doc_id", "same"), F.lit(1_000_000)) < int(min(1.0, wanted / of) * 1_000_000)
    keys = F.array(*[F.lit(k) for k in member_keys(docs.sparkSession)])
    part = F.element_at(keys, (F.pmod(F.xxhash64(F.lit(4), "doc_id", "same"), F.lit(MEMBERS)) + 1).cast("int"))
    toxic = ids.where("toxic = 1").where(drawn(FIT_POSITIVE, n_toxic)).select("doc_id", "same")
    once = lambda df: df.dropDuplicates(["doc_id", "same"])
    # about FIT_POSITIVE pairs, by the draw: broadcast, so that no text is shuffled to find them
    positive = once(rows.join(F.broadcast(toxic), ["doc_id", "same"])).select("text", keys.alias("members"), F.lit(True).alias("confirmed"))
    unlabelled = once(rows.where(drawn(FIT_UNLABELLED, n))).select("text", F.array(part).alias("members"), F.lit(False).alias("confirmed"))

    def extract(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for at in range(0, len(pdf), EXTRACT_ROWS):  # a few texts at a time, their buckets as bytes
                some = pdf.iloc[at : at + EXTRACT_ROWS]
                words = [s.astype(np.int32).tobytes() for s in features(some["text"].tolist())]
                yield pd.DataFrame({"members": some["members"].tolist(), "confirmed": some["confirmed"].tolist(), "words": words})

    def train_member(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.assign(key=[zlib.crc32(np.frombuffer(s, np.int32).astype(np.int64).tobytes()) for s in pdf["words"]]).sort_values(["confirmed", "key"], kind="stable")
        sets = [np.frombuffer(s, np.int32) for s in pdf["words"]]
        n_u = int((~pdf["confirmed"]).sum())
        whole = 0 < n_u < len(sets)
        share = prior or (estimated_prior(sets[n_u:], sets[:n_u], least) if whole else min(0.999, least))
        if not whole:
            return pd.DataFrame({"bucket": [-1], "weight": [float(np.log(share / (1 - share)))]})
        buckets, weights, bias = fit(sets[n_u:], sets[:n_u], share)
        return pd.DataFrame({"bucket": np.append(buckets, -1), "weight": np.append(weights, bias)})

    sets = positive.unionByName(unlabelled).mapInPandas(extract, "members array<int>, confirmed boolean, words binary")
    sets = sets.select(F.explode("members").alias("member"), "confirmed", "words").repartition(MEMBERS, "member")
    weights, bias = np.zeros(BUCKETS, np.float32), 0.0
    trained = sets.groupBy("member").applyInPandas(train_member, "bucket int, weight double")
    for bucket, weight in trained.groupBy("bucket").agg(F.sum("weight")).collect():  # BUCKETS rows at most
        if bucket < 0:
            bias = weight / MEMBERS
        else:
            weights[bucket] = weight / MEMBERS
    return weights, bias


def scorer(
    docs: DataFrame, labels: DataFrame, train: Column, id_col: str, text_col: str, toxic_col: str, prior: float | None = None,
) -> Callable[[Column], Column]:
    """Learns the classifier; a function from a text column to the score."""
    shared = docs.sparkSession.sparkContext.broadcast(learn(docs, labels, train, id_col, text_col, toxic_col, prior))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        weights, bias = shared.value
        wanted = weights != 0
        some = (texts.iloc[at : at + EXTRACT_ROWS].tolist() for at in range(0, len(texts), EXTRACT_ROWS))
        return pd.Series(np.concatenate([np.zeros(0), *(sigmoid(logits(features(t, wanted), weights, bias)) for t in some)]))

    return score


def toxicity(
    docs: DataFrame, labels: DataFrame, folds: int = 5, held_out_fold: int = 0, id_col: str = "doc_id", text_col: str = "text", toxic_col: str = "toxic",
    prior: float | None = None,
) -> DataFrame:
    """One row per input row: doc_id, held_out, score, predicted. Labels of the held-out fold
    are not used."""
    held_out = fold(F.col(id_col), folds) == held_out_fold
    score = scorer(docs, labels, ~held_out, id_col, text_col, toxic_col, prior)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), score(F.col(text_col).cast("string")).alias("score"))
    return rows.select("*", (F.col("score") >= 0.5).cast("int").alias("predicted"))
