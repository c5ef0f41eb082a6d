"""Word-piece token counts by a linear longest-match automaton.

The vocabulary becomes one trie with two roots: pieces that start a word, and pieces that
continue one. Each node has a failure link (the node for what is left of the matched string
after the pieces that greedy matching would emit) and the number of pieces popped on the way,
both computed once, breadth first. A word then costs one step per character and no piece is
ever built: follow the edge, else add the node's popped count and fail. A word that cannot be
matched to its end counts as one unknown piece, as word-piece tokenisers do.

Distinct words of a batch run through the automaton together, one character position a step,
while more than ``FEW`` are alive; the rest of longer words is walked a word at a time.

Defined results: null and empty texts have no words and no tokens; repeated rows and null ids
get a row each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cardwise.llm.words import distinct, word_batches

SCHEMA = "doc_id long, n_words long, n_tokens long"
CODE_BITS = 21  # a Unicode code point
FEW = 64


@dataclass(frozen=True)
class Automaton:
    """Nodes 0 (word start) and 1 (continuation); edges sorted by ``node << CODE_BITS | char``."""

    edges: np.ndarray
    targets: np.ndarray
    fail: np.ndarray
    popped: np.ndarray

    @cached_property
    def by_edge(self) -> dict[int, int]:
        return dict(zip(self.edges.tolist(), self.targets.tolist(), strict=True))

    @cached_property
    def failing(self) -> list[tuple[int, int]]:
        """(failure link, popped pieces) of each node."""
        return list(zip(self.fail.tolist(), self.popped.tolist(), strict=True))


def walk(auto: Automaton, chars: list[int], state: int, count: int) -> tuple[int, int]:
    """(state, count) after one word's further characters; state -1 where it cannot be matched."""
    edge, failing = auto.by_edge.get, auto.failing
    for char in chars:
        to = edge(state << CODE_BITS | char)
        while to is None:
            state, more = failing[state]
            count += more
            if state < 0:
                return -1, count
            to = edge(state << CODE_BITS | char)
        state = to
    return state, count


def pieces_of_model(path: str) -> tuple[list[str], list[str]]:
    """(word-initial, continuing) pieces of a SentencePiece model file: those with and without
    the leading word mark; control, unknown and byte pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    initial, inner = [], []
    for i in range(model.get_piece_size()):
        if model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i):
            continue
        piece = model.id_to_piece(i)
        if "▁" in piece[1:] or piece == "▁":
            continue
        (initial if piece[0] == "▁" else inner).append(piece.removeprefix("▁"))
    return initial, inner


def build_automaton(initial: Iterable[str], inner: Iterable[str]) -> Automaton:
    goto: list[dict[str, int]] = [{}, {}]
    final = [False, False]
    for root, words in ((0, initial), (1, inner)):
        for word in words:
            at = root
            for char in word:
                if char not in goto[at]:
                    goto[at][char] = len(goto)
                    goto.append({})
                    final.append(False)
                at = goto[at][char]
            final[at] |= at != root
    fail, popped = [-1] * len(goto), [0] * len(goto)
    queue = deque([0, 1])
    while queue:
        parent = queue.popleft()
        for char, node in goto[parent].items():
            queue.append(node)
            if final[node]:
                fail[node], popped[node] = 1, 1
                continue
            at, n = fail[parent], popped[parent]
            while at >= 0 and char not in goto[at]:
                n += popped[at]
                at = fail[at]
            if at >= 0:
                fail[node], popped[node] = goto[at][char], n
    pairs = sorted((node << CODE_BITS | ord(char), to) for node, out in enumerate(goto) for char, to in out.items())
    keys, targets = (np.array(x, np.int64) for x in (zip(*pairs, strict=True) if pairs else ((), ())))
    return Automaton(keys, targets, np.array(fail, np.int64), np.array(popped, np.int64))


def lengths(words: list[bytes], auto: Automaton) -> np.ndarray:
    """Greedy word-piece length of each word; 1 for a word that cannot be matched."""
    texts = [w.decode("utf-8", "surrogatepass") for w in words]
    size = np.array([len(t) for t in texts], np.int64)
    order = np.argsort(-size, kind="stable")
    size = size[order]
    chars = np.frombuffer("".join([texts[i] for i in order]).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    start = np.concatenate([[0], np.cumsum(size)])[:-1]
    state, count = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
    dead = np.zeros(len(words), bool)
    alive = len(words)
    for at in range(int(size[0]) if len(size) else 0):
        alive = int(np.searchsorted(-size[:alive], -at, "left"))  # words longer than ``at``
        if alive <= FEW:
            for word in np.flatnonzero(~dead[:alive]):
                rest = chars[start[word] + at : start[word] + size[word]].tolist()
                state[word], count[word] = walk(auto, rest, int(state[word]), int(count[word]))
                dead[word] = state[word] < 0
            break
        todo = np.flatnonzero(~dead[:alive])
        char = chars[start[todo] + at]
        while len(todo):
            key = state[todo] << CODE_BITS | char
            edge = np.minimum(np.searchsorted(auto.edges, key), len(auto.edges) - 1) if len(auto.edges) else None
            hit = auto.edges[edge] == key if edge is not None else np.zeros(len(todo), bool)
            if edge is not None:
                state[todo[hit]] = auto.targets[edge[hit]]
            todo, char = todo[~hit], char[~hit]
            count[todo] += auto.popped[state[todo]]
            state[todo] = auto.fail[state[todo]]
            lost = state[todo] < 0
            dead[todo[lost]] = True
            todo, char = todo[~lost], char[~lost]
    todo = np.flatnonzero(~dead & (state != 1))
    while len(todo):
        count[todo] += auto.popped[state[todo]]
        state[todo] = auto.fail[state[todo]]
        dead[todo[state[todo] < 0]] = True
        todo = todo[state[todo] > 1]
    out = np.empty(len(words), np.int64)
    out[order] = np.where(dead, 1, count)
    return out


def token_counts(docs: DataFrame, auto: Automaton, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_tokens. The automaton's size is that of the
    vocabulary; it is broadcast."""
    shared = docs.sparkSession.sparkContext.broadcast(auto)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n_words, n_tokens = np.zeros(len(pdf), np.int64), np.zeros(len(pdf), np.int64)
            for index, words in word_batches(pdf["text"]):
                codes, found = distinct(words)
                n_words += np.bincount(index, minlength=len(pdf))
                n_tokens += np.bincount(index, weights=lengths(found, shared.value)[codes], minlength=len(pdf)).astype(np.int64)
            yield pd.DataFrame({"doc_id": pdf["doc_id"].astype("Int64"), "n_words": n_words, "n_tokens": n_tokens})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInPandas(count, SCHEMA)
