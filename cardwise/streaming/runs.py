"""T2 for cards with many rows a micro-batch: a run of rows in event order as arrays.

:meth:`CardLedger.take` asks history once a row. For a run that begins no earlier than the card's
newest row, the same facts are differences of running sums over the trail and the run, and what
lies further back is asked once a minute that a window's edge falls into. The ledger is left as
after the rows singly, but for how many rows its trail has moved on.

Rows reach the state operator packed: a stateless step before it makes one value of a card's rows
in some Arrow batches (``pack_rows``), a stateless step behind it makes rows of packed facts
(``unpack_facts``), so Spark's row-wise transfer to and from the operator has a few rows a card.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from pyspark.sql import Row

from cardwise.schema import AMOUNT_WINDOW, WINDOW_1H_MS, WINDOW_1M_MS, WINDOW_24H_MS
from cardwise.streaming.card_state import FACT_FIELDS, SCALE, CardLedger, Recency, Trail
from cardwise.streaming.processor import FACTS_SCHEMA, OWN, PENDING, CardProcessor

#: Rows of an Arrow table that is packed by card, of a run, and of a packed value of facts.
PACK_ROWS, RUN_ROWS, FACT_ROWS = 1 << 17, 1 << 21, 1 << 16
#: Rows at a time where a pass per window place follows, so that the arrays stay in the CPU's cache.
BLOCK = 1 << 13
#: Amounts' units are summed in two halves, each within 64 bits.
HALF = 32
#: Amounts from which on rows are taken singly: the upper halves of 2^22 smaller ones sum up in 62 bits.
MOST = 2.0**72 / SCALE
PLACE = ("ts_ms", "lat", "lon")
PACKED_SCHEMA = "card_id string, rows binary"
PACKED_FACTS_SCHEMA = "card_id string, facts binary"
KINDS = {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}
FACT_KINDS = {name: KINDS[kind] for name, kind in FACT_FIELDS.items()}
FACTS = tuple(field.split()[0] for field in FACTS_SCHEMA.split(", "))


# ---------------------------------------------------------------------------------- packing

def packed(table: pa.Table, max_rows: int | None = None) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="lz4")) as out:
        out.write_table(table, max_chunksize=max_rows)
    return sink.getvalue().to_pybytes()


def unpacked(values: list[bytes]) -> pa.Table:
    return pa.concat_tables([pa.ipc.open_stream(v).read_all() for v in values])


def pack_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of PACKED_SCHEMA: those of each card in some ten batches, as they come."""
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= PACK_ROWS:
            yield packed_by_card(pa.Table.from_batches(held))
            held, n = [], 0
    if n:
        yield packed_by_card(pa.Table.from_batches(held))


def packed_by_card(rows: pa.Table) -> pa.RecordBatch:
    cards = rows["card_id"].combine_chunks().dictionary_encode(null_encoding="encode")
    codes = cards.indices.to_numpy()
    order = np.argsort(codes, kind="stable")
    ends = np.cumsum(np.bincount(codes, minlength=len(cards.dictionary)))
    rows = rows.select(PENDING).take(order)
    values = [packed(rows.slice(first, end - first)) for first, end in zip([0, *ends], ends)]
    return pa.RecordBatch.from_arrays([cards.dictionary, pa.array(values, pa.binary())], ["card_id", "rows"])


def unpack_facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of FACTS_SCHEMA."""
    for batch in batches:
        for card_id, value in zip(batch.column(0), batch.column(1)):
            for facts in pa.ipc.open_stream(value.as_buffer()):
                columns = dict(zip(facts.schema.names, facts.columns))
                columns["card_id"] = pa.repeat(pa.scalar(card_id.as_py(), pa.string()), facts.num_rows)
                yield pa.RecordBatch.from_arrays([columns[name] for name in FACTS], list(FACTS))


class PackedCardProcessor(CardProcessor):
    """Facts on arrival, of rows that come and go packed."""

    def handleInputRows(self, key, rows, timerValues):
        together = unpacked([r["rows"] for r in rows]).sort_by([("ts_ms", "ascending"), ("txn_id", "ascending")])
        ledger, out = self.ledger(), Row("card_id", "facts")
        for facts in all_facts(ledger, together, self.reset_after_ms):
            yield out(key[0], packed(facts, BLOCK))
        self.save(ledger)


# ------------------------------------------------------------------------------------ facts

def all_facts(ledger: CardLedger, rows: pa.Table, reset_after_ms: int | None = None) -> Iterator[pa.Table]:
    """Own columns and facts of a card's rows in (ts_ms, txn_id) order. Late rows, those after a
    gap that resets, and those before the card has its last 50 amounts are taken singly."""
    rows = rows.combine_chunks()
    ts = numbers(rows["ts_ms"])
    gaps = np.flatnonzero(np.diff(ts) > reset_after_ms) + 1 if reset_after_ms is not None else np.array([], int)
    at = 0
    while at < len(ts):
        end = at + fit_for_a_run(ledger, rows, ts, gaps, at, reset_after_ms)
        run = Run.of(ledger, rows.slice(at, end - at)) if end > at else None
        end = max(end, at + until_a_run(ledger, ts, at))
        for first in range(at, end, FACT_ROWS):
            some = rows.slice(first, min(FACT_ROWS, end - first))
            if run:
                facts = run.facts(some, first - at)
            else:
                told = [ledger.take(r, reset_after_ms) for r in some.to_pylist()]
                facts = {name: pa.array(values, kind) for (name, kind), values in zip(FACT_KINDS.items(), zip(*told))}
            yield pa.table({name: some[name] for name in OWN if name != "card_id"} | facts)
        if run:
            run.remember()
        at = end


def numbers(column: pa.ChunkedArray) -> np.ndarray:
    """Values of a column without nulls; one with nulls is an error."""
    return column.combine_chunks().to_numpy()


def fit_for_a_run(ledger: CardLedger, rows: pa.Table, ts: np.ndarray, gaps: np.ndarray, at: int, reset_after_ms: int | None) -> int:
    """How many of the rows from ``at`` can be taken together; 0: the next is to be taken singly."""
    newest = ledger.place[0]
    if newest is None or ts[at] < newest or len(ledger.amounts) < AMOUNT_WINDOW:
        return 0
    if reset_after_ms is not None and ts[at] - newest > reset_after_ms:
        return 0
    gap = np.searchsorted(gaps, at, "right")
    end = min(at + RUN_ROWS, len(ts), *gaps[gap : gap + 1].tolist())
    # halves of larger units might not fit; neither might amounts that are not finite
    trail, amounts = np.array(ledger.trail.amounts, float), numbers(rows["amount"].slice(at, end - at))
    odd = np.flatnonzero(~(np.abs(amounts) < MOST))
    if not np.all(np.abs(trail) < MOST):
        return 0
    return int(odd[0]) if len(odd) else end - at


def until_a_run(ledger: CardLedger, ts: np.ndarray, at: int) -> int:
    """How many rows from ``at`` to take singly before a run is tried again."""
    newest = ledger.place[0]
    late = 0 if newest is None else int(np.searchsorted(ts[at:], newest))
    return min(max(late, AMOUNT_WINDOW - len(ledger.amounts), 1), AMOUNT_WINDOW, len(ts) - at)


def halves(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers (as floats) as upper and lower halves; the lower ones are not negative."""
    upper = np.floor(units / 2.0**HALF)
    return upper.astype(np.int64), (units - upper * 2.0**HALF).astype(np.int64)


class Run:
    """Rows of a card that come no earlier than all before them: ``facts`` of some after the other,
    then ``remember``."""

    def __init__(self, ledger: CardLedger, ts: np.ndarray, amount: np.ndarray):
        self.ledger, self.n = ledger, len(ts)
        self.times = np.concatenate([np.array(ledger.trail.times, np.int64), ts])
        self.amounts = np.concatenate([np.array(ledger.trail.amounts, float), amount])
        self.totals = [np.concatenate([[0], np.cumsum(half)]) for half in halves(np.rint(self.amounts * float(SCALE)))]
        vel_1m, _ = self.since(ts - WINDOW_1M_MS, amounts=False)
        self.windows = vel_1m, *self.since(ts - WINDOW_1H_MS), *self.since(ts - WINDOW_24H_MS)

    @classmethod
    def of(cls, ledger: CardLedger, rows: pa.Table) -> Run | None:
        """Nothing where sums of units are too long."""
        try:
            return cls(ledger, numbers(rows["ts_ms"]), numbers(rows["amount"]))
        except OverflowError:
            return None

    def facts(self, rows: pa.Table, at: int) -> dict[str, pa.Array]:
        """Facts of the next rows, from place ``at`` of the run; they count in what is told of later ones."""
        ledger, ts, amount = self.ledger, numbers(rows["ts_ms"]), numbers(rows["amount"])
        n = len(ts)
        mean, spread = moments(np.concatenate([np.fromiter(ledger.amounts, float), amount]), n)
        mcc_ts, mcc_known = used_before(ledger.mccs, rows["mcc"], ts)
        merchant_ts, _ = used_before(ledger.merchants, rows["merchant_id"], ts, blank=True)
        hours = ts // WINDOW_1H_MS % 24
        place = []
        for old, name, kind in zip(ledger.place, PLACE, (pa.int64(), pa.float64(), pa.float64())):
            place.append(pa.concat_arrays([pa.array([old], kind), rows[name].combine_chunks().slice(0, n - 1)]))
        facts = (
            np.arange(ledger.rows, ledger.rows + n), *(window[at : at + n] for window in self.windows), np.full(n, AMOUNT_WINDOW), mean, spread,
            mcc_ts, mcc_known, merchant_ts.is_valid(), *place, np.asarray(ledger.hours)[hours] + rank_within(hours),
        )
        ledger.rows += n
        ledger.hours = (np.asarray(ledger.hours) + np.bincount(hours, minlength=24)).tolist()
        ledger.amounts.extend(amount[-AMOUNT_WINDOW:].tolist())
        ledger.place = tuple(rows[name][n - 1].as_py() for name in PLACE)
        return {name: pa.array(values, kind) if isinstance(values, np.ndarray) else values for (name, kind), values in zip(FACT_KINDS.items(), facts)}

    def since(self, edges: np.ndarray, amounts: bool = True) -> tuple[np.ndarray, np.ndarray | None]:
        """For every row of the run: (rows, amount) before it that are later than its edge."""
        here = np.arange(len(self.times) - self.n, len(self.times))
        at = np.searchsorted(self.times, edges, "right")
        count = here - at
        upper, lower = (total[here] - total[at] for total in self.totals)
        minutes = self.ledger.minutes
        if minutes.before is not None:
            older = edges[: np.searchsorted(edges, minutes.before * WINDOW_1M_MS)]
            asked = older // WINDOW_1M_MS
            starts = np.flatnonzero(np.diff(asked, prepend=asked[:1] - 1))
            for first, end in zip(starts.tolist(), [*starts[1:].tolist(), len(older)]):
                n, total, times, totals = minutes.edge(int(asked[first]))
                late = np.searchsorted(np.array(times, np.int64), older[first:end], "right")
                count[first:end] += n + len(times) - late
                if amounts:
                    left = [total + totals[-1] - t for t in totals]
                    if max(map(abs, left)) >> 92:
                        raise OverflowError
                    upper[first:end] += np.array([units >> HALF for units in left])[late]
                    lower[first:end] += np.array([units & (1 << HALF) - 1 for units in left])[late]
        return count, of_units(upper, lower) if amounts else None

    def remember(self) -> None:
        """The run enters the trail; the rows that it has no room for go on to minutes."""
        trail_rows, minutes = self.ledger.trail_rows, self.ledger.minutes
        keep_after = int(self.times[-1]) - WINDOW_24H_MS
        first = int(np.searchsorted(self.times, keep_after, "right"))
        if minutes.before is not None:
            first = max(first, int(np.searchsorted(self.times, minutes.before * WINDOW_1M_MS)))
        if len(self.times) - first > trail_rows:
            newest = int(self.times[-1]) // WINDOW_1M_MS
            crowded = len(self.times) - np.searchsorted(self.times, newest * WINDOW_1M_MS) > trail_rows
            minutes.before = newest + int(crowded)
        if minutes.before is not None:
            first = max(first, int(np.searchsorted(self.times, minutes.before * WINDOW_1M_MS)))
            moved = slice(int(np.searchsorted(self.times, (keep_after + 1) // WINDOW_1H_MS * WINDOW_1H_MS)), first)
            minutes.add_run(self.times[moved].tolist(), self.amounts[moved].tolist())
            minutes.evict(keep_after)
        self.ledger.trail = Trail(self.times[first:].tolist(), self.amounts[first:].tolist())


def of_units(upper: np.ndarray, lower: np.ndarray) -> np.ndarray:
    """Sums of units as amounts: the double nearest to each quotient, as from whole numbers."""
    upper, lower = upper + (lower >> HALF), lower & (1 << HALF) - 1
    small = np.abs(upper) < 1 << 62 - HALF
    units = np.where(small, upper, 0) * (1 << HALF) + lower
    whole, rest = np.divmod(units, SCALE)
    part = rest / SCALE
    out = np.where(np.abs(units) < 1 << 53, units / SCALE, whole + part)
    # beyond 53 bits the sum of both is rounded a second time, which tells where it falls near a tie
    cut, step = np.abs(part - (out - whole)), np.spacing(np.abs(out))
    near = (np.abs(cut - step / 2) < 1e-15) | (np.abs(cut - step / 4) < 1e-15)
    for i in np.flatnonzero((np.abs(units) >= 1 << 53) & near | ~small):
        out[i] = ((int(upper[i]) << HALF) + int(lower[i])) / SCALE
    return out


def moments(amounts: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and sum of squared deviations of the 50 amounts before each of the last ``n``."""
    mean, spread = np.empty(n), np.empty(n)
    for first in range(0, n, BLOCK):
        size = min(BLOCK, n - first)
        window = [amounts[first + k : first + k + size] for k in range(AMOUNT_WINDOW)]
        own = summed(window) / AMOUNT_WINDOW
        mean[first : first + size] = own
        spread[first : first + size] = summed((a - own) ** 2 for a in window)
    return mean, spread


def summed(arrays) -> np.ndarray:
    """The arrays' sum with what rounding loses added up beside it, like ``sum`` of floats."""
    total, lost = 0.0, 0.0
    for x in arrays:
        new = total + x
        lost += np.where(np.abs(total) >= np.abs(x), (total - new) + x, (x - new) + total)
        total = new
    return total + lost


def rank_within(codes: np.ndarray) -> np.ndarray:
    """How many earlier places have the same (small) code."""
    order = np.argsort(codes.astype(np.int16), kind="stable")
    counts = np.bincount(codes)
    rank = np.empty(len(codes), np.int64)
    rank[order] = np.arange(len(codes)) - np.repeat(np.cumsum(counts) - counts, counts)
    return rank


def used_before(memory: Recency, keys: pa.ChunkedArray, ts: np.ndarray, blank: bool = False) -> tuple[pa.Array, np.ndarray]:
    """For every row when its key was last used (null: not known) and how many keys were known; the
    keys are then used. ``blank``: an empty key is none."""
    keys = keys.combine_chunks().dictionary_encode(null_encoding="encode")
    names, codes = keys.dictionary.to_pylist(), keys.indices.to_numpy()
    used = [name for name in names if name or not blank]
    if memory.cap is not None and len(memory.latest.keys() | set(used)) > memory.cap:
        when, known = [], []
        for code, at in zip(codes.tolist(), ts.tolist()):
            name = names[code]
            when.append(memory.when(name))
            known.append(len(memory))
            if name or not blank:
                memory.use(name, at)
        return pa.array(when, pa.int64()), np.array(known)
    order = np.argsort(codes, kind="stable")
    firsts = np.flatnonzero(np.diff(codes[order], prepend=-1))
    when = np.empty(len(ts), np.int64)
    when[order[1:]] = ts[order[:-1]]
    missing, new = np.zeros(len(ts), bool), np.zeros(len(ts), np.int64)
    lasts = ts[order[np.append(firsts[1:], len(ts)) - 1]].tolist()
    for name, first, last, own in zip(names, order[firsts].tolist(), lasts, np.split(order, firsts[1:])):
        seen = memory.when(name)
        missing[first], when[first] = seen is None, seen or 0
        if blank and not name:
            missing[own] = True
            continue
        new[first] = seen is None
        memory.latest[name] = last
    memory.order = None  # made anew when the cap is passed
    known = len(memory) - int(new.sum()) + np.cumsum(new) - new
    return pa.array(when, pa.int64(), mask=missing), known
