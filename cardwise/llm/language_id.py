"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 (drawn from the letter and a seed). A trigram's
vector binds its letters by multiplication, each rotated by its place; the vector of a text
bundles (adds) the vectors of its trigrams; a language's prototype bundles the texts of that
language, each scaled to length ``UNIT``. A text goes to the prototype with the largest cosine
(ties: the first name), and that cosine, not below 0, is the score.

Texts are lower-cased; letters stay, anything else is one space between words. Long texts are
worked on in parts, so memory does not grow with them. Prototypes are summed in whole numbers
by Spark (order does not matter) and have a size of languages x ``DIMS``, which bounds what
the driver gets and what is broadcast.

Defined results: a null text or one without a letter is ``und`` with score 0, as is every text
if there is nothing to learn from; null ids and repeated rows get a row each; rows with null
language are predicted but not learned from; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardwise.llm.helpers import fold
from cardwise.llm.words import unique

DIMS, SEED, UNIT = 512, 20, 1000
PART = 1 << 20
TABLE_ROWS = 60_000
FIT_ROWS = 30_000
UNKNOWN = "und"
#: Code points that are letters.
LETTERS = np.array([chr(c).isalpha() for c in range(0x110000)])
SPACE = 32


def letter_vectors(codes: np.ndarray) -> np.ndarray:
    """Rows of +1 and -1 for code points."""
    return np.stack([np.random.Generator(np.random.PCG64([SEED, int(c)])).integers(0, 2, DIMS, np.int8) * 2 - 1 for c in codes]).astype(np.int8)


def parts_of(text: str) -> Iterator[np.ndarray]:
    """Code points of the text's letters, with one space around every word, part by part;
    parts overlap by two characters, as trigrams do."""
    tail = np.array([SPACE], np.uint32)
    for at in range(0, len(text), PART):
        codes = np.frombuffer(text[at : at + PART].lower().encode("utf-32-le", "surrogatepass"), np.uint32)
        codes = np.where(LETTERS[codes], codes, np.uint32(SPACE))
        codes = np.concatenate([tail, codes] if at + PART < len(text) else [tail, codes, [np.uint32(SPACE)]])
        codes = codes[np.concatenate([[True], (codes[1:] != SPACE) | (codes[:-1] != SPACE)])].astype(np.uint32)
        yield codes
        tail = codes[-2:]


def bind(ids: np.ndarray, n: int, vectors: np.ndarray) -> np.ndarray:
    """Vectors of trigrams, given as numbers to the base ``n`` of letter rows."""
    first, second, third = np.roll(vectors, 2, 1), np.roll(vectors, 1, 1), vectors
    return (first[ids // (n * n)] * second[ids // n % n] * third[ids % n]).astype(np.float32)


def text_vectors(texts: list[str | None]) -> np.ndarray:
    """The bundled vector of each text; zeros for a text without letters."""
    out = np.zeros((len(texts), DIMS))
    held: list[tuple[int, np.ndarray]] = []
    size = 0

    def bundle() -> None:
        codes = np.concatenate([c for _, c in held])
        seen = unique(codes)
        n = len(seen)
        vectors, place = letter_vectors(seen), np.searchsorted(seen, codes)
        ids = [((p[:-2] * n + p[1:-1]) * n + p[2:]) for p in np.split(place, np.cumsum([len(c) for _, c in held])[:-1])]
        if n**3 <= 1 << 23:
            present = np.zeros(n**3, bool)
            for x in ids:
                present[x] = True
            table = np.flatnonzero(present)
            row = np.zeros(n**3, np.int64)
            row[table] = np.arange(len(table))
        else:
            table = row = None
        bound = bind(table, n, vectors) if table is not None and len(table) <= TABLE_ROWS else None
        for (i, _), x in zip(held, ids, strict=True):
            if bound is not None:
                counts = np.bincount(row[x])
                some = np.flatnonzero(counts)
                out[i] += counts[some].astype(np.float32) @ bound[some]
                continue
            some, counts = np.unique(x, return_counts=True)
            for at in range(0, len(some), TABLE_ROWS):
                out[i] += counts[at : at + TABLE_ROWS].astype(np.float32) @ bind(some[at : at + TABLE_ROWS], n, vectors)

    for i, text in enumerate(texts):
        for codes in parts_of(text or ""):
            if len(codes) > 2:
                held.append((i, codes))
                size += len(codes)
            if size >= 2 * PART:
                bundle()
                held, size = [], 0
    if held:
        bundle()
    return out


def learn(docs: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str, fit_rows: int) -> dict[str, np.ndarray]:
    """Prototype of each language, from about ``fit_rows`` labelled rows (a hash of the id
    decides which; all of them, if there are no more)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"), train.alias("train"))
    rows = rows.where(F.col("train") & F.col("lang").isNotNull())
    total = rows.count()
    if total > fit_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1_000_000)) < int(1_000_000 * fit_rows / total))

    def bundle(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for pdf in batches:
            vectors = text_vectors(pdf["text"].tolist())
            norms = np.linalg.norm(vectors, axis=1, keepdims=True)
            unit = np.rint(UNIT * vectors / np.where(norms > 0, norms, 1)).astype(np.int64)
            for lang, at in pdf.groupby("lang").indices.items():
                sums[lang] = sums.get(lang, 0) + unit[at].sum(0)
        if sums:
            yield pd.DataFrame({"lang": list(sums), "vector": [v.tolist() for v in sums.values()]})

    sums = rows.select("text", "lang").mapInPandas(bundle, "lang string, vector array<long>").select("lang", F.posexplode("vector").alias("dim", "x"))
    found: dict[str, np.ndarray] = {}
    for lang, dim, x in sums.groupBy("lang", "dim").agg(F.sum("x")).collect():  # languages x DIMS rows
        found.setdefault(lang, np.zeros(DIMS))[dim] = x
    return {lang: v / np.linalg.norm(v) for lang, v in sorted(found.items()) if v.any()}


def predictor(docs: DataFrame, train: Column, id_col: str, text_col: str, lang_col: str, fit_rows: int = FIT_ROWS) -> Callable[[Column], Column]:
    """Learns prototypes; a function from a text column to the struct (lang_pred, score)."""
    prototypes = learn(docs, train, id_col, text_col, lang_col, fit_rows)
    names = np.array([*prototypes, UNKNOWN], object)
    shared = docs.sparkSession.sparkContext.broadcast((names, np.stack([*prototypes.values(), np.zeros(DIMS)])))

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: pd.Series) -> pd.DataFrame:
        names, matrix = shared.value
        vectors = text_vectors(texts.tolist())
        norms = np.linalg.norm(vectors, axis=1)
        cosines = vectors @ matrix.T / np.where(norms > 0, norms, 1)[:, None]
        cosines[:, -1] = -2 if len(names) > 1 else 0
        best = np.where(norms > 0, cosines.argmax(1), len(names) - 1)
        score = np.where(best < len(names) - 1, np.clip(cosines.max(1), 0, 1), 0.0)
        return pd.DataFrame({"lang_pred": names[best], "score": score})

    return predict


def language_id(
    docs: DataFrame, folds: int = 4, held_out_fold: int = 2, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
    fit_rows: int = FIT_ROWS,
) -> DataFrame:
    """One row per input row: doc_id, held_out, lang_pred, score. Rows of the held-out fold are
    never learned from."""
    held_out = fold(F.col(id_col), folds) == held_out_fold
    predict = predictor(docs, ~held_out, id_col, text_col, lang_col, fit_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out.alias("held_out"), predict(F.col(text_col).cast("string")).alias("found"))
    return rows.select("doc_id", "held_out", "found.lang_pred", "found.score")
