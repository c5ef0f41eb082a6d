"""Words of batches of texts, for tasks that work on Arrow batches.

A word is a maximal run of bytes other than space and 0x09-0x0D. Batches are cut by bytes, and
a long text is cut at white space, so that a task's memory is bounded by ``limit``, not by the
number of rows in a batch or the length of a text.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pandas as pd

LIMIT = 4_000_000
WHITE = b" \t\n\x0b\x0c\r"


def pieces(text: bytes, limit: int = LIMIT) -> Iterator[bytes]:
    """``text`` in parts of about ``limit`` bytes, cut at white space."""
    at = 0
    while len(text) - at > limit:
        end = at + limit
        while end < len(text) and text[end] not in WHITE:
            end += 1
        yield text[at:end]
        at = end
    yield text[at:] if at else text


def word_batches(texts: Iterable[str | None], limit: int = LIMIT, clean: Callable[[bytes], bytes] | None = None) -> Iterator[tuple[np.ndarray, list[bytes]]]:
    """(index of the text of each word, words) for runs of texts of about ``limit`` bytes."""
    index: list[int] = []
    counts: list[int] = []
    words: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        if not text:
            continue
        for part in pieces(text.encode("utf-8", "surrogatepass"), limit):
            found = (clean(part) if clean else part).split()
            index.append(i)
            counts.append(len(found))
            words += found
            size += len(part)
            if size >= limit:
                yield np.repeat(np.array(index, np.int64), counts), words
                index, counts, words, size = [], [], [], 0
    if words:
        yield np.repeat(np.array(index, np.int64), counts), words


def unique(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values, by a sort (NumPy's own hashes, which is slower on many numbers)."""
    values = np.sort(values)
    return values[np.concatenate([[True], values[1:] != values[:-1]])] if len(values) else values


def distinct(words: list[bytes]) -> tuple[np.ndarray, list[bytes]]:
    """(code of each word, distinct words)."""
    column = np.empty(len(words), object)
    column[:] = words
    codes, found = pd.factorize(column)
    return codes.astype(np.int64), list(found)
