"""SentencePiece encoding and decoding by suffix-array matching.

A text is a mark and its characters, spaces written as marks. It falls into *units* that no
piece crosses: a run of marks with what follows up to the next mark, or a line end. For the
units of a batch that are not yet remembered:

1. they are joined, with a separator no piece has, and indexed by a suffix array (prefix
   doubling up to the length of the longest piece);
2. every piece is binary-searched in the array, all pieces together, character by character,
   which leaves the range of its occurrences;
3. ranges become edges (start, piece), sorted by their position in the unit;
4. edges are relaxed in that order, all units together.

Relaxing follows the model. *Unigram*: the predecessor with the best sum of scores. *BPE*: a
prefix's encoding is the encoding of a shorter prefix and one more piece, and a piece may
follow another just if the two alone are encoded as these two pieces (no merge crosses a
boundary that survives), so exactly one edge into each position holds; pairs are judged once
by merging and remembered. The ids equal the library's. Characters without a piece become
their byte pieces, or the unknown piece.

Decoding joins pieces (byte pieces as bytes, ill-formed ones as U+FFFD), turns marks into
spaces and takes the first space away.

Defined results: null and empty texts have no ids and decode to the empty text; null ids of
documents and repeated rows get a row each; an empty table gives no rows; other columns are
ignored. A mark in the text decodes as a space, as in the library. Batches are cut by
characters and long texts at unit ends; remembered units are bounded by ``REMEMBERED``.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwise.llm.words import unique

MARK = "▁"
LIMIT = 3_000_000
REMEMBERED = 800_000
FEW = 64
SEPARATOR = 0x110000
UNITS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")


@dataclass
class Model:
    """Pieces with scores; ``bpe`` tells how they compete. ``bytes_at`` is the id of byte 0 (or
    -1), ``silent`` the ids that are never matched (control, unknown and byte pieces)."""

    pieces: list[str]
    scores: list[float]
    bpe: bool
    unknown: int
    bytes_at: int
    silent: frozenset[int] = field(default_factory=frozenset)

    @cached_property
    def ids(self) -> dict[str, int]:
        return {p: i for i, p in enumerate(self.pieces) if i not in self.silent}

    @cached_property
    def spelled(self) -> list[bytes]:
        """What each id decodes to."""
        out = [b"" if i in self.silent else p.replace(MARK, " ").encode() for i, p in enumerate(self.pieces)]
        for b in range(256 if self.bytes_at >= 0 else 0):
            out[self.bytes_at + b] = bytes([b])
        out[self.unknown] = " ⁇ ".encode()
        return out

    def merges(self, ids: list[int]) -> list[int]:
        """BPE of a few symbols: the best-scored neighbours merge, the leftmost at a tie."""
        text = [self.pieces[i] if i >= 0 else None for i in ids]
        while True:
            best, at = None, -1
            for i in range(len(text) - 1):
                if text[i] is not None and text[i + 1] is not None:
                    merged = self.ids.get(text[i] + text[i + 1])
                    if merged is not None and (best is None or self.scores[merged] > self.scores[best]):
                        best, at = merged, i
            if best is None:
                return [-1 if t is None else self.ids[t] for t in text]
            text[at : at + 2] = [self.pieces[best]]


def read_model(path: str) -> Model:
    import sentencepiece

    p = sentencepiece.SentencePieceProcessor(model_file=path)
    n = p.get_piece_size()
    silent = frozenset(i for i in range(n) if p.is_control(i) or p.is_unknown(i) or p.is_byte(i) or p.is_unused(i))
    scores = [p.get_score(i) for i in range(n)]
    first = next((i for i in range(n) if p.is_byte(i)), -1)
    pieces = [p.id_to_piece(i) for i in range(n)]
    if any(MARK in x.lstrip(MARK) or "\n" in x for i, x in enumerate(pieces) if i not in silent):
        raise ValueError("a piece crosses units")
    return Model(pieces, scores, all(s == int(s) for s in scores), p.unk_id(), first, silent)


def suffix_array(codes: np.ndarray, depth: int) -> np.ndarray:
    """Positions in the order of their first ``depth`` codes, by prefix doubling."""
    _, rank = np.unique(codes, return_inverse=True)
    order = np.argsort(rank)
    width = 1
    while width < depth:
        after = np.zeros(len(codes), np.int64)
        after[:-width] = rank[width:] + 1
        key = rank * (len(codes) + 1) + after
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(len(codes), np.int64)
        rank[order] = np.cumsum(np.concatenate([[0], ordered[1:] != ordered[:-1]]))
        width *= 2
    return order


class Encoder:
    """Encodes units; remembers them and the pairs of pieces that may stand side by side."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.matched = [i for i in range(len(model.pieces)) if i not in model.silent and model.pieces[i]]
        texts = [model.pieces[i] for i in self.matched]
        self.lengths = np.array([len(t) for t in texts], np.int64)
        self.longest = int(self.lengths.max(initial=1))
        self.chars = np.full((len(texts), self.longest), -1, np.int64)
        for row, t in zip(self.chars, texts, strict=True):
            row[: len(t)] = [ord(c) for c in t]
        self.matched = np.array(self.matched, np.int64)
        size = len(model.pieces)
        self.length_of = np.ones(size + 1, np.int64)  # the last entry: a character without a piece
        self.length_of[self.matched] = self.lengths
        self.list_of_lengths = self.length_of.tolist()
        self.score_of = np.append(np.array(model.scores, float), min(model.scores, default=0.0) - 10)
        self.pairs = np.zeros(0, np.int64)
        self.allowed = np.zeros(0, bool)
        self.verdicts: dict[int, bool] = {}  # as ``allowed``, for single edges
        self.forget()

    def forget(self) -> None:
        self.slots: dict[str, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.pool = np.zeros(0, np.int32)

    def occurrences(self, codes: np.ndarray, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Range of each piece in the suffix array."""
        low, high = np.zeros(len(self.lengths), np.int64), np.full(len(self.lengths), len(codes))
        at_end = np.append(codes, -1)
        for depth in range(self.longest):
            live = np.flatnonzero((self.lengths > depth) & (low < high))
            want = self.chars[live, depth]
            for bound, more in ((low, 0), (high, 1)):
                a, b = low[live].copy(), high[live].copy()
                while (open_ := a < b).any():
                    middle = (a + b) // 2
                    code = at_end[np.minimum(order[np.minimum(middle, len(codes) - 1)] + depth, len(codes))]
                    right = open_ & (code < want + more)
                    a, b = np.where(right, middle + 1, a), np.where(open_ & ~right, middle, b)
                if more:
                    bound[live] = a
                else:
                    first = a
            low[live] = first
        return low, high

    def may_follow(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether BPE keeps the two pieces apart (and each whole); ``left`` -1: at a unit's start."""
        size = len(self.model.pieces) + 1
        key = (left + 1) * (size + 1) + right
        found = np.searchsorted(self.pairs, key)
        known = self.pairs[np.minimum(found, len(self.pairs) - 1)] == key if len(self.pairs) else np.zeros(len(key), bool)
        if not known.all():
            fresh = unique(key[~known])
            verdicts = np.fromiter((self.judge(int(k) // (size + 1) - 1, int(k) % (size + 1)) for k in fresh), bool, len(fresh))
            order = np.argsort(keys := np.concatenate([self.pairs, fresh]))
            self.pairs, self.allowed = keys[order], np.concatenate([self.allowed, verdicts])[order]
            found = np.searchsorted(self.pairs, key)
        return self.allowed[found]

    def judge(self, left: int, right: int) -> bool:
        strange = len(self.model.pieces)
        spelled: list[int] = []
        expected: list[int] = []
        for piece in (left, right):
            if piece == strange:
                spelled.append(-1)
                expected.append(-1)
            elif piece >= 0:
                spelled += [self.model.ids.get(c, -1) for c in self.model.pieces[piece]]
                expected.append(piece)
        return self.model.merges(spelled) == expected

    def relax_singly(self, begin: np.ndarray, piece: np.ndarray, offset: np.ndarray, best: np.ndarray, last: np.ndarray) -> np.ndarray:
        """``last`` after the given edges, in order of position, one at a time."""
        if not len(begin):
            return last
        edges = zip(begin.tolist(), piece.tolist(), (begin + self.length_of[piece]).tolist(), strict=True)
        out = last.tolist()
        if self.model.bpe:
            size, first = len(self.model.pieces) + 1, (offset == 0).tolist()
            for s, t, e in edges:
                left = out[s]
                if left < 0 and not first[s]:
                    continue
                key = (left + 1) * (size + 1) + t
                good = self.verdicts.get(key)
                if good is None:
                    good = self.verdicts[key] = self.judge(left, t)
                if good:
                    out[e] = t
        else:
            scores, totals = self.score_of.tolist(), best.tolist()
            for s, t, e in edges:
                total = totals[s] + scores[t]
                if total > totals[e]:
                    totals[e], out[e] = total, t
        return np.array(out, np.int64)

    def trace(self, last: np.ndarray, start: int, end: int) -> tuple[np.ndarray, np.ndarray]:
        """(places, pieces) of one unit, from its end back."""
        pieces, lengths = last[start : end + 1].tolist(), self.list_of_lengths
        at, ats, ids = end - start, [], []
        while at > 0:
            t = pieces[at]
            at -= lengths[t]
            ats.append(start + at)
            ids.append(t)
        return np.array(ats, np.int64), np.array(ids, np.int64)

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in a row, number of ids of each unit)."""
        strange = len(self.model.pieces)
        size = np.array([len(u) for u in units], np.int64)
        start = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
        codes = np.full(int((size + 1).sum()), SEPARATOR, np.int64)
        inside = np.ones(len(codes), bool)
        inside[start + size] = False
        codes[inside] = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        order = suffix_array(codes, self.longest)
        low, high = self.occurrences(codes, order)
        count = np.maximum(high - low, 0)
        place = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(low, count)
        begin, piece = order[place], np.repeat(self.matched, count)
        bare = inside.copy()
        bare[begin[self.length_of[piece] == 1]] = False
        begin, piece = np.concatenate([begin, np.flatnonzero(bare)]), np.concatenate([piece, np.full(int(bare.sum()), strange)])
        offset = np.arange(len(codes)) - np.repeat(start, size + 1)
        by_offset = np.argsort(offset[begin])
        begin, piece = begin[by_offset], piece[by_offset]
        last = np.full(len(codes), -1, np.int64)  # the piece that ends here
        best = np.full(len(codes), -np.inf)
        best[start] = 0.0
        many = int(np.sort(size)[-FEW - 1]) if len(size) > FEW else 0  # from here on, few units are alive
        cuts = np.searchsorted(offset[begin], np.arange(many + 1))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            s, t = begin[a:b], piece[a:b]
            e = s + self.length_of[t]
            if self.model.bpe:
                reached = (last[s] >= 0) | (offset[s] == 0)
                s, t, e = s[reached], t[reached], e[reached]
                good = self.may_follow(last[s], t)
                last[e[good]] = t[good]
            else:
                total = best[s] + self.score_of[t]
                good = total > best[e]
                best[e[good]], last[e[good]] = total[good], t[good]
        last = self.relax_singly(begin[cuts[-1] :], piece[cuts[-1] :], offset, best, last)
        steps = []
        unit, at = np.arange(len(units)), start + size
        unit, at = unit[size > 0], at[size > 0]
        while len(unit) > FEW:
            t = last[at]
            at = at - self.length_of[t]
            steps.append((unit, at, t))
            going = at > start[unit]
            unit, at = unit[going], at[going]
        for one, end in zip(unit.tolist(), at.tolist(), strict=True):
            ats, ids = self.trace(last, int(start[one]), end)
            steps.append((np.full(len(ats), one), ats, ids))
        if not steps:
            return np.zeros(0, np.int64), np.zeros(len(units), np.int64)
        unit, at, t = (np.concatenate(x) for x in zip(*steps, strict=True))
        forward = np.argsort(at)
        unit, at, t = unit[forward], at[forward], t[forward]
        odd = np.flatnonzero(t == strange)
        if len(odd) and self.model.bytes_at >= 0:
            spelled = [chr(c).encode("utf-8", "surrogatepass") for c in codes[at[odd]]]
            width = np.ones(len(t), np.int64)
            width[odd] = [len(b) for b in spelled]
            first = (np.cumsum(width) - width)[odd]
            unit, t = np.repeat(unit, width), np.repeat(t, width)
            for i, b in zip(first, spelled, strict=True):
                t[i : i + len(b)] = [self.model.bytes_at + x for x in b]
        else:
            t[odd] = self.model.unknown
        return t, np.bincount(unit, minlength=len(units))

    def slots_of(self, units: list[str]) -> np.ndarray:
        if len(self.slots) > REMEMBERED:
            self.forget()
        slot = self.slots.get
        found = np.array([slot(u, -1) for u in units], np.int64)
        missing = np.flatnonzero(found < 0).tolist()
        if missing:
            fresh = list(dict.fromkeys(units[i] for i in missing))
            ids, counts = self.encode_units(fresh)
            known = len(self.slots)
            self.slots.update(zip(fresh, range(known, known + len(fresh)), strict=True))
            self.pool = np.concatenate([self.pool, ids.astype(np.int32)])
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts)])
            found[missing] = [self.slots[units[i]] for i in missing]
        return found

    def gather(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all units in a row, number of ids of each)."""
        slots = self.slots_of(units)
        first, count = self.starts[slots], self.starts[slots + 1] - self.starts[slots]
        return self.pool[np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)], count

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text; a long one is taken in parts that end with a unit."""
        text = MARK + text.replace(" ", MARK) if text else ""
        out, at = [np.zeros(0, np.int32)], 0
        while at < len(text):
            end = at + LIMIT
            while end < len(text) and not (text[end] == MARK != text[end - 1]):
                end += 1
            out.append(self.gather(UNITS.findall(text[at:end]))[0])
            at = end
        return np.concatenate(out)

    def encode_run(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, number of ids of each text)."""
        if len(texts) == 1:
            ids = self.encode(texts[0])
            return ids, np.array([len(ids)], np.int64)
        units: list[str] = []
        ends = [0]
        for text in texts:
            if text:
                units += UNITS.findall(MARK + text.replace(" ", MARK))
            ends.append(len(units))
        ids, count = self.gather(units)
        upto = np.concatenate([[0], np.cumsum(count)])[ends]
        return ids, np.diff(upto)


_ENCODERS: dict[bytes, Encoder] = {}


def encoder_of(key: bytes, model: Model) -> Encoder:
    """The encoder that this Python worker keeps for the model, over tasks."""
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(model)
    return _ENCODERS[key]


def decode(ids: np.ndarray, spelled: list[bytes]) -> str:
    return b"".join(map(spelled.__getitem__, ids.tolist())).decode("utf-8", "replace").removeprefix(" ")


def runs(texts: list[str]) -> Iterator[list[str]]:
    run: list[str] = []
    size = 0
    for text in texts:
        run.append(text)
        size += len(text)
        if size >= LIMIT:
            yield run
            run, size = [], 0
    if run:
        yield run


def encode_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", decoded_digest: bool = False) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids. The model is broadcast. With
    ``decoded_digest``, the ids are decoded again in the same task, and ``decoded_sha256`` is the
    SHA-256 of that text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    key = hashlib.sha256(repr((model.pieces, model.scores, model.bpe, model.unknown, sorted(model.silent))).encode("utf-8", "surrogatepass")).digest()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(key, shared.value)
        for batch in batches:
            texts, at = [t or "" for t in batch.column("text").to_pylist()], 0
            for run in runs(texts):
                ids, sizes = encoder.encode_run(run)
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(ids))
                columns = {"doc_id": batch.column("doc_id").slice(at, len(run)), "n_tokens": pa.array(sizes), "ids": lists}
                if decoded_digest:
                    texts = (decode(x, encoder.model.spelled) for x in np.split(ids, np.cumsum(sizes)[:-1]))
                    columns["decoded_sha256"] = pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in texts])
                yield pa.RecordBatch.from_arrays(list(columns.values()), list(columns))
                at += len(run)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(encode, "doc_id long, n_tokens long, ids array<int>" + ", decoded_sha256 string" * decoded_digest)


def decode_documents(encoded: DataFrame, model: Model, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """One row per input row: doc_id, text."""
    shared = encoded.sparkSession.sparkContext.broadcast(model.spelled)

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("ids")
            texts = [decode(lists[i].values.to_numpy(zero_copy_only=False), shared.value) if lists[i].is_valid else "" for i in range(len(lists))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).alias("ids"))
    return rows.mapInArrow(spell, "doc_id long, text string")
