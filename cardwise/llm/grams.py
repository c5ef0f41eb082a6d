"""Hashed n-grams of batches of texts, for tasks that work on Arrow batches.

Texts are bytes; a piece ends at one of ``. , ; : ! ?`` or 0x0A-0x0D, and words are runs of other
bytes than space and tab within a piece. A word's hash is a sum over its bytes of mixed (byte,
place) numbers, an n-gram's folds its words' hashes one after the other; both start from the hash
of the language, so that equal phrases of two languages differ. All of it is NumPy over a few
megabytes at a time; a long text is cut at breaks, with the words that its last n-grams need.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np

LIMIT = 1_500_000
BREAKS = rb" \t.,;:!?\n\x0b\x0c\r"
BREAK = re.compile(rb"[" + BREAKS + rb"]")
LOWERED = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: 0 in a word, 1 between words, 2 between pieces.
KIND = np.array([2 if c in b".,;:!?\n\x0b\x0c\r" else 1 if c in b" \t" else 0 for c in range(256)], np.uint8)
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def seed_of(lang: str) -> int:
    return int.from_bytes(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def parts_of(text: bytes, ahead: int, limit: int = LIMIT) -> Iterator[tuple[bytes, int]]:
    """(part, bytes that are its own); the rest of a part are up to ``ahead`` words of the next."""
    following = re.compile(rb"(?:[" + BREAKS + rb"]*[^" + BREAKS + rb"]+){0,%d}" % ahead)
    at = 0
    while len(text) - at > limit and (cut := BREAK.search(text, at + limit)):
        yield text[at : following.match(text, cut.start()).end()], cut.start() - at
        at = cut.start()
    yield text[at:], len(text) - at


@dataclass
class Chunk:
    """Some megabytes of parts of texts. ``lang`` has the number of each part's language."""

    text: bytes
    offset: np.ndarray
    own: np.ndarray
    lang: np.ndarray
    seeds: np.ndarray

    @cached_property
    def words(self) -> tuple[np.ndarray, ...]:
        """(start, end, piece, part, own) of each word."""
        kind = KIND[np.frombuffer(self.text, np.uint8)]
        inside = np.concatenate([[0], (kind == 0).view(np.int8), [0]])
        edge = np.flatnonzero(np.diff(inside))
        start, end = edge[::2], edge[1::2]
        part = np.searchsorted(self.offset, start, "right") - 1
        return start, end, np.cumsum(kind == 2)[start] if len(start) else start, part, start - self.offset[part] < self.own[part]

    @cached_property
    def hashes(self) -> np.ndarray:
        start, end, _, part, _ = self.words
        if not len(start):
            return np.zeros(0, np.uint64)
        size = end - start
        first = np.concatenate([[0], np.cumsum(size)[:-1]])
        place = np.arange(int(size.sum())) - np.repeat(first, size)
        byte = np.frombuffer(self.text, np.uint8)[place + np.repeat(start, size)]
        sums = np.add.reduceat(mixed((place.astype(np.uint64) << np.uint64(8) | byte) * ODD + ODD), first)
        return mixed(sums + self.seeds[self.lang[part]])

    def grams(self, longest: int, wanted: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(hash, mask) of the n-grams of 1, 2, ... ``longest`` words that begin at each word. The
        mask is true for those within a piece whose own shorter n-grams, first and last, are all
        in the bit maps ``wanted`` of the orders before."""
        start, _, piece, _, own = self.words
        h = self.hashes
        gram, mask = h, np.ones(len(start), bool)
        for n in range(1, longest + 1):
            if n > 1:
                inside = held(gram, wanted[n - 2]) & mask
                gram = mixed(gram[: len(gram) - 1] * ODD + h[n - 1 :])
                mask = inside[:-1] & inside[1:] & (piece[: len(gram)] == piece[n - 1 :])
            yield gram, mask & own[: len(gram)]

    def phrase(self, at: int, n: int) -> bytes:
        start, end = self.words[:2]
        return b" ".join(self.text[a:b] for a, b in zip(start[at : at + n].tolist(), end[at : at + n].tolist(), strict=True))


def chunks(rows: Iterable[tuple[str, str | None]], ahead: int, limit: int = LIMIT) -> Iterator[tuple[Chunk, list[str]]]:
    """(chunk, its languages by number) for runs of (language, text) of about ``limit`` bytes."""
    parts: list[bytes] = []
    own: list[int] = []
    lang: list[int] = []
    names: dict[str, int] = {}
    size = 0

    def made() -> tuple[Chunk, list[str]]:
        offset = np.cumsum([0, *(len(p) + 1 for p in parts)])[:-1]
        seeds = np.array([seed_of(x) for x in names], np.uint64)
        return Chunk(b"\n".join(parts).translate(LOWERED), offset, np.array(own), np.array(lang), seeds), list(names)

    for name, text in rows:
        if not text:
            continue
        for part, mine in parts_of(text.encode("utf-8", "surrogatepass"), ahead, limit):
            parts.append(part)
            own.append(mine)
            lang.append(names.setdefault(name, len(names)))
            size += len(part)
            if size >= limit:
                yield made()
                parts, own, lang, names, size = [], [], [], {}, 0
    if parts:
        yield made()


def held(hashes: np.ndarray, bits: np.ndarray) -> np.ndarray:
    """Which hashes have their bit in a bit map (bytes; a power of two)."""
    slot = hashes >> np.uint64(64 - (len(bits) * 8).bit_length() + 1)
    return (bits[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
