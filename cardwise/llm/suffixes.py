"""Anchored suffixes of texts, and a multikey quicksort of them, in NumPy.

Every string of ``SPAN`` bytes has an anchor: the place of its least hashed gram of ``GRAM`` bytes
(the leftmost, if several are equal). Equal strings have their anchors at the same place, so a
string can only be repeated where its anchor's gram is, and neighbouring strings mostly share one
anchor. A *family* is a run of neighbouring strings with the same anchor in a text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np

from cardwise.llm.grams import ODD, mixed

SPAN, GRAM = 200, 48
LIMIT = 1_000_000
PLACE = 24  # bits for a place in a chunk
WORD = 8
WORDS = SPAN // WORD


def gram_hashes(data: np.ndarray) -> np.ndarray:
    """The mixed polynomial hash of the ``GRAM`` bytes from each place on."""
    power, whole, length, out = 1, mixed(data.astype(np.uint64) * ODD + ODD), 0, None
    factor = int(ODD)
    while True:  # ``whole`` hashes ``power`` bytes, ``out`` the first ``length``
        if GRAM & power:
            n = len(data) - length - power + 1
            if n <= 0:
                return np.zeros(0, np.uint64)
            out = whole[:n] if out is None else out[:n] * np.uint64(factor) + whole[length : length + n]
            length += power
        if length == GRAM:
            return mixed(out)
        whole = whole[: max(0, len(whole) - power)] * np.uint64(factor) + whole[power:]
        factor = factor * factor % (1 << 64)
        power *= 2


def window_least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbouring entries."""
    step = 1
    while 2 * step <= width:
        x = np.minimum(x[: len(x) - step], x[step:])
        step *= 2
    rest = width - step
    return np.minimum(x[: len(x) - rest], x[rest:]) if rest else x


def families(parts: list[bytes]) -> tuple[np.ndarray, ...]:
    """(part, first string's place in it, number of strings, anchor's place after the first
    string's, anchor gram's hash, digest of the family's bytes) of the families in ``parts``, each
    of ``SPAN`` bytes or more."""
    text = b"".join(parts)
    size = np.array([len(p) for p in parts])
    begin = np.cumsum(size) - size
    hashes = gram_hashes(np.frombuffer(text, np.uint8))
    low = np.uint64((1 << PLACE) - 1)
    anchor = window_least((hashes & ~low) | np.arange(len(hashes), dtype=np.uint64), SPAN - GRAM + 1) & low
    anchor = anchor.astype(np.int64)
    part = np.repeat(np.arange(len(parts)), size)[: len(anchor)]
    place = np.arange(len(anchor))
    inside = place + SPAN <= (begin + size)[part]
    place, part, anchor = place[inside], part[inside], anchor[inside]
    first = np.flatnonzero(np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])]))
    count = np.diff(np.append(first, len(place)))
    start, where = place[first], anchor[first]
    lead = where - start
    digest = [
        hashlib.blake2b(text[a : a + n + SPAN - 1], digest_size=8, salt=d.to_bytes(2, "little")).digest()
        for a, n, d in zip(start.tolist(), count.tolist(), lead.tolist(), strict=True)
    ]
    return part[first], start - begin[part[first]], count, lead, hashes[where].view(np.int64), np.frombuffer(b"".join(digest), np.int64)


def chunks(texts: Iterable[str | None], limit: int = LIMIT) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """(number of the text, its part's first byte, part) of parts that make up about ``limit``
    bytes. Parts of a long text overlap by ``SPAN - 1`` bytes."""
    index: list[int] = []
    base: list[int] = []
    parts: list[bytes] = []
    size = 0
    for i, text in enumerate(texts):
        data = (text or "").encode("utf-8", "surrogatepass")
        for at in range(0, len(data) - SPAN + 1, limit):
            parts.append(data[at : at + limit + SPAN - 1])
            index.append(i)
            base.append(at)
            size += len(parts[-1])
            if size >= limit:
                yield index, base, parts
                index, base, parts, size = [], [], [], 0
    if parts:
        yield index, base, parts


def words_at(data: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The ``WORD`` bytes from each place on, as numbers that sort like them."""
    return np.lib.stride_tricks.sliding_window_view(data, WORD)[place].view(">u8").ravel().astype(np.uint64)


def multikey_quicksort(data: np.ndarray, place: np.ndarray, group: np.ndarray) -> np.ndarray:
    """A number for each string (``SPAN`` bytes from ``place`` on), the same for equal strings of
    a group and for no others.

    Multikey quicksort by words of eight bytes, all its open parts at a time: a part is split by a
    median of three into lower, equal and higher words; the equal part goes on with the next word.
    Parts of one string are done, as are those that are equal to the end."""
    label = np.arange(len(place))
    order = np.argsort(group, kind="stable")
    part = np.cumsum(np.concatenate([[0], np.diff(group[order]) != 0])) if len(order) else order
    depth = np.zeros(int(part[-1]) + 1 if len(part) else 0, np.int64)
    while len(order):
        size = np.bincount(part, minlength=len(depth))
        done = depth == WORDS
        ended = done[part]
        if ended.any():
            begin = np.cumsum(size) - size
            label[order[ended]] = order[begin[part[ended]]]
        left = ((size > 1) & ~done)[part]
        order, part = order[left], part[left]
        if not len(order):
            break
        first = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]]))
        depth = depth[part[first]]
        size = np.diff(np.append(first, len(part)))
        part = np.repeat(np.arange(len(first)), size)
        word = words_at(data, place[order] + WORD * depth[part])
        three = np.sort(np.stack([word[first], word[first + size // 2], word[first + size - 1]]), axis=0)
        pivot = three[1][part]
        side = (word >= pivot).astype(np.int64) + (word > pivot)
        key = 3 * part + side
        begin = np.concatenate([[0], np.cumsum(np.bincount(key, minlength=3 * len(first)))])
        to = np.empty(len(order), np.int64)
        for which in range(3):
            mine = side == which
            upto = np.cumsum(mine)
            rank = upto - 1 - (upto[first] - mine[first])[part]
            to[mine] = begin[key[mine]] + rank[mine]
        moved, keys = np.empty_like(order), np.empty_like(key)
        moved[to], keys[to] = order, key
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        order, part = moved, np.repeat(np.arange(len(first)), np.diff(np.append(first, len(keys))))
        depth = depth[keys[first] // 3] + (keys[first] % 3 == 1)
    return label


def fingerprints(data: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each string."""
    one, two = np.full(len(place), ODD), np.full(len(place), ~ODD)
    for i in range(WORDS):
        word = words_at(data, place + WORD * i)
        one, two = mixed(one ^ word), mixed(two + word * ODD)
    return one.view(np.int64), two.view(np.int64)
