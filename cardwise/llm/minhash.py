"""Shingle sets, fast similarity sketches and band keys of batches of texts (NumPy).

A sketch has ``COORDS`` coordinates. In round i every element is hashed anew, into a bin and a
value; a bin that is empty before the round keeps the smallest value of the round. In the first
``COORDS`` rounds the bin is drawn by the hash, in the next ``COORDS`` rounds all elements go
to bin ``i - COORDS``, so every coordinate is filled after at most two times ``COORDS`` rounds
(after one or two for sets much larger than the sketch). Each coordinate of two sets agrees
with a probability of their Jaccard similarity, with Chernoff-like concentration over the
coordinates, which plain one-permutation hashing lacks for small sets.
"""

from __future__ import annotations

import numpy as np
import xxhash

from cardwise.llm.helpers import LOWER, UPPER
from cardwise.llm.words import distinct, unique, word_batches

SHINGLE = 5
BANDS, BAND_ROWS = 32, 5
COORDS = BANDS * BAND_ROWS
EMPTY = np.uint64(2**64 - 1)
TABLE = bytes.maketrans(UPPER.encode(), LOWER.encode())
#: Odd multipliers of the words of a shingle, by place.
PLACES = np.array([pow(0x9E3779B97F4A7C15, k + 1, 2**64) for k in range(SHINGLE)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: each bit of the result depends on all bits of ``x``."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def lowered(text: bytes) -> bytes:
    return text.translate(TABLE)


def shingle_sets(texts: list[str | None]) -> list[np.ndarray]:
    """The sorted set of 64-bit shingle hashes of each text; with fewer words than a shingle
    has, the whole sequence is the one element; without words, the set is empty."""
    hashes: list[list[np.ndarray]] = [[] for _ in texts]
    for index, words in word_batches(texts, clean=lowered):
        codes, vocabulary = distinct(words)
        of_word = mix(np.fromiter(map(xxhash.xxh3_64_intdigest, vocabulary), np.uint64, len(vocabulary)))
        at = np.concatenate([[0], np.flatnonzero(np.diff(index)) + 1, [len(index)]])
        for a, b in zip(at[:-1], at[1:], strict=True):
            hashes[index[a]].append(of_word[codes[a:b]])
    return [shingles(np.concatenate(h) if len(h) > 1 else h[0]) if h else np.zeros(0, np.uint64) for h in hashes]


def shingles(words: np.ndarray) -> np.ndarray:
    n = len(words)
    size = min(n, SHINGLE)
    total = np.full(n - size + 1, size, np.uint64)
    for k in range(size):
        total += words[k : n - size + 1 + k] * PLACES[k]
    return unique(mix(total))


def sketches(sets: list[np.ndarray]) -> np.ndarray:
    """A row of ``COORDS`` values for each non-empty set; rows of empty sets stay ``EMPTY``."""
    out = np.full((len(sets), COORDS), EMPTY)
    flat = out.reshape(-1)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    items = np.concatenate([*sets, np.zeros(0, np.uint64)])
    for i in range(2 * COORDS):
        if not len(items):
            break
        value = mix(items + np.uint64((i + 1) * int(PLACES[0]) % 2**64))
        place = (value % np.uint64(COORDS)).astype(np.int64) if i < COORDS else i - COORDS
        cell = rows * COORDS + place
        value = mix(value)
        if i:
            free = flat[cell] == EMPTY
            cell, value = cell[free], value[free]
        np.minimum.at(flat, cell, np.minimum(value, EMPTY - np.uint64(1)))
        lacking = (out == EMPTY).any(1)
        if i < 2 or i % 8 == 0:
            going = lacking[rows]
            rows, items = rows[going], items[going]
    return out


def band_keys(sketch: np.ndarray) -> np.ndarray:
    """(sets x BANDS) keys: equal where all rows of the band agree."""
    parts = sketch.reshape(len(sketch), BANDS, BAND_ROWS)
    key = np.broadcast_to(mix(np.arange(1, BANDS + 1, dtype=np.uint64)), (len(sketch), BANDS)).copy()
    for k in range(BAND_ROWS):
        key = mix(key + parts[:, :, k] * PLACES[k])
    return key


def set_digest(shingle_set: np.ndarray) -> tuple[int, int]:
    """128 bits that depend on the set alone."""
    return tuple(int(x) for x in (mix(shingle_set + PLACES[1]).sum(dtype=np.uint64), mix(shingle_set ^ PLACES[2]).sum(dtype=np.uint64)))
