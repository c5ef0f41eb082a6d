"""The repair lattice of a conversation and its cheapest path by an auction.

Node (i, s): i rows are dealt with, and the roles so far end in state s. Edits are arcs: keep (K),
rerole (R) and delete (D) deal with a row, insert (I) does not. A state lets each edit lead to one
node alone, so a path is known by its edits' letters.

The auction (Bertsekas) keeps a price for every node, at most the cost of any arc plus the price of
its head, and a path from the origin. At the path's last node it either raises the price to the
cheapest arc plus its head's price and takes the node off the path, or extends the path by that
arc. When the path is at the destination, prices are dual optimal: an arc is on a cheapest path
only if it is tight (price of its tail = cost + price of its head), and of the tight arcs that lead
on to the destination the trace takes the one with the smallest letter.

Rows are taken in blocks, last block first: the exact prices at a block's left are the costs of
leaving the block before it, which bounds how far prices and paths of an auction can grow.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

KEEP, REROLE, DELETE, INSERT, CUT_SHORT = 0, 3, 4, 3, 3
#: States by what the roles so far end in; nothing, system, user, assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
#: The state after a user or assistant turn, whichever may follow.
FOLLOWS = (USER, USER, ASSISTANT, USER)
ROLE = {USER: "user", ASSISTANT: "assistant"}
#: Cost, and inserted turns, that end a conversation in each state.
CLOSING = (0, 2 * INSERT, INSERT, 0)
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
NEVER = 1 << 40
BLOCK = 32

#: (cost, rows, state, letter), by letter.
Arc = tuple[int, int, int, str]


def arcs_of(initial: str, fault: int) -> tuple[tuple[Arc, ...], ...]:
    """The arcs that leave each state before a row with this role initial and fault."""
    out = []
    for state in STATES:
        arcs: list[Arc] = [(DELETE, 1, state, "D"), (INSERT, 0, FOLLOWS[state], "I")]
        if fault not in (BLANK, DUPLICATE):
            more = CUT_SHORT if fault == TRUNCATED else 0
            after = {"s": SYSTEM, "u": USER, "a": ASSISTANT}.get(initial)
            if after is not None and (after == FOLLOWS[state] if after != SYSTEM else state == START):
                arcs.append((KEEP + more, 1, after, "K"))
            arcs.append((REROLE + more, 1, FOLLOWS[state], "R"))
        out.append(tuple(arcs))
    return tuple(out)


ARCS = {(i, f): arcs_of(i, f) for i in ("s", "u", "a", "") for f in (FINE, BLANK, DUPLICATE, TRUNCATED)}


def row_arcs(initial: str, fault: int) -> tuple[tuple[Arc, ...], ...]:
    return ARCS[initial if initial in ("s", "u", "a") else "", fault]


@dataclass
class Solved:
    """A block with its prices (row by row, four states each)."""

    rows: list[tuple[tuple[Arc, ...], ...]]
    prices: list[int]
    leads: bytearray  # whether a node leads to the destination by tight arcs

    def trace(self, state: int) -> Iterator[tuple[str, list[int], int]]:
        """(letters, states after each, cost) of the edits up to and with each row's own."""
        for i in range(len(self.rows)):
            letters, states, cost, taken = "", [], 0, 0
            while not taken:
                for paid, taken, after, letter in self.rows[i][state]:
                    head = 4 * (i + taken) + after
                    if self.prices[4 * i + state] == paid + self.prices[head] and self.leads[head]:
                        break
                letters, cost, state = letters + letter, cost + paid, after
                states.append(after)
            yield letters, states, cost


def auction(rows: list[tuple[tuple[Arc, ...], ...]], leave: tuple[int, ...], origins: tuple[int, ...]) -> Solved:
    """Prices that are exact at the ``origins`` (states before the first row), when leaving the
    block in a state costs ``leave``. An origin must have a way out."""
    n = len(rows)
    end = 4 * n
    prices = [0] * end + list(leave)
    arcs = [[(cost, 4 * (i + taken) + after) for cost, taken, after, _ in rows[i][state]] for i in range(n) for state in STATES]
    for origin in origins:
        path = [origin]
        while path[-1] < end:
            node = path[-1]
            best, head = NEVER * 2, -1
            for cost, to in arcs[node]:
                if cost + prices[to] < best:
                    best, head = cost + prices[to], to
            if prices[node] < best:
                prices[node] = best
                if len(path) > 1:
                    path.pop()
            else:
                path.append(head)
    leads = bytearray(end) + bytearray(p < NEVER for p in leave)
    for i in range(n - 1, -1, -1):
        for _ in range(3):  # inserts lead from state to state of one row
            for node in range(4 * i, 4 * i + 4):
                leads[node] = leads[node] or any(leads[to] and prices[node] == cost + prices[to] for cost, to in arcs[node])
    return Solved(rows, prices, leads)


def solve(rows: list[tuple[tuple[Arc, ...], ...]], leave: tuple[int, ...], block: int = BLOCK) -> list[Solved]:
    """The blocks of ``rows``, solved from every state."""
    out = []
    for at in reversed(range(0, len(rows), block)):
        solved = auction(rows[at : at + block], leave, tuple(s for s in STATES if can_leave(rows[at : at + block], leave, s)))
        leave = tuple(solved.prices[s] if solved.leads[s] else NEVER for s in STATES)
        out.append(solved)
    return out[::-1]


def can_leave(rows: list[tuple[tuple[Arc, ...], ...]], leave: tuple[int, ...], state: int) -> bool:
    """Whether a block can be left, at a finite price, from ``state``: only the roles' start and
    a system turn cannot come again."""
    if leave[USER] < NEVER or leave[ASSISTANT] < NEVER:
        return True
    reach = {state}
    for row in rows:
        reach |= {after for s in reach for _, taken, after, _ in row[s] if not taken}
        reach = {after for s in reach for _, taken, after, _ in row[s] if taken}
    return any(leave[s] < NEVER for s in reach)


def crossing(rows: list[tuple[tuple[Arc, ...], ...]], block: int = BLOCK) -> list[int]:
    """Costs from each state before ``rows`` to each state after them (16; ``NEVER`` for none)."""
    out = [NEVER] * 16
    for after in STATES:
        leave = tuple(0 if s == after else NEVER for s in STATES)
        first = solve(rows, leave, block)[0]
        for s in STATES:
            if first.leads[s] and first.prices[s] < NEVER:
                out[4 * s + after] = first.prices[s]
    return out
