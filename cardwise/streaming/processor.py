"""Keyed state per card in Structured Streaming (``transformWithState``, row API).

State per card (RocksDB state store): a typed ValueState ``card`` holding version, counters, last
position, hour histogram, last <= 50 amounts, the trail of the last 24 h (at most ``TRAIL_ROWS``
rows) and the MCC (<= 64) / merchant (<= 128) last-seen times as parallel arrays. One value keeps
the state traffic of a quiet card to a read and a write per card per micro-batch.

T2: a busy card's older rows live in map state by minute, with sums by minute (``minutes``) and by
hour (``spill``) and the rows in parts (``parts``). Whole hours are evicted; only a window's edge
reads rows. A micro-batch writes the minutes that it adds to, whatever the day holds. The value's
version tells whether a card has spilled, so a checkpoint of the first layout goes on as it is.

T3: with ``idle_ms``, each batch moves an event-time timer to the card's last row + ``idle_ms``;
when it expires all state of the card is cleared. A row after a longer gap starts a new history
whether or not the timer has fired yet, so the result does not depend on the watermark.

Slots: with ``slots``, cards share a state key, the hash of the card modulo ``slots``. A micro-batch
then calls the state store a few times per slot instead of several times per card, and the rows of
a slot come and go as one Arrow batch. The slot's value holds every card's ledger as JSON text; only
cards with new rows are parsed. Map state by minute is keyed by card and minute, and one timer
per slot stands at its first card to expire. A slot's value is read and written whole, so ``slots``
should grow with the number of cards (:func:`cardwise.streaming.jobs.slots_for`).

The processors only report facts that need history; :func:`cardwise.operators.formulas.features_from_facts`
makes the features of them. Rows of one card within a micro-batch are processed in
(ts_ms, txn_id) order; one output row per input row.
"""

from __future__ import annotations

import json
from collections import defaultdict
from collections.abc import Iterator
from decimal import Decimal

from pyspark.sql import Row
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from cardwise.schema import MAX_MCC, MAX_MERCHANTS
from cardwise.streaming.card_state import (
    FACT_FIELDS,
    LEDGER_FIELDS,
    LEDGER_SCHEMA,
    MINUTE_KEY,
    MINUTE_SCHEMA,
    PART_KEY,
    PART_SCHEMA,
    SLOT_SCHEMA,
    SPILL_SCHEMA,
    SPILLED_VERSION,
    TRAIL_ROWS,
    CardLedger,
    Held,
    Minutes,
)

OWN = ("txn_id", "card_id", "ts_ms", "amount", "lat", "lon", "label")
FACTS_SCHEMA = (
    "txn_id string, card_id string, ts_ms long, amount double, lat double, lon double, label int, "
    + ", ".join(f"{name} {kind}" for name, kind in FACT_FIELDS.items())
)
Facts = Row(*OWN, *FACT_FIELDS)


class StoredMinutes(Held):
    """Minutes and parts in map state: read when asked for, written back once a batch."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.by_minute = handle.getMapState("minutes", MINUTE_KEY, MINUTE_SCHEMA)
        self.by_part = handle.getMapState("parts", PART_KEY, PART_SCHEMA)
        self.listed: dict[int, tuple] | None = None
        super().__init__(self.stored_minute, self.stored_part)

    def stored_minute(self, minute: int):
        if self.listed is None:  # one pass over a day's minutes instead of a question for each
            self.listed = {key[0]: (n, int(units), parts) for key, (n, units, parts) in self.by_minute.iterator()}
        return self.listed.get(minute)

    def stored_part(self, minute: int, part: int):
        times, amounts = self.by_part.getValue((minute, part))
        return list(times), list(amounts)

    def save(self) -> None:
        for key in self.dropped_parts:
            self.by_part.removeKey(key)
        for key in self.changed_parts:
            self.by_part.updateValue(key, self.parts[key])
        for minute in self.changed_minutes:
            value = self.minutes[minute]
            if value is None:
                self.by_minute.removeKey((minute,))
            else:
                self.by_minute.updateValue((minute,), (value[0], Decimal(value[1]), value[2]))

    def forget(self) -> None:
        """Nothing of this batch's card is left for the next."""
        self.__dict__.update(listed=None, minutes={}, parts={}, changed_minutes=set(), changed_parts=set(), dropped_parts=[])

    def clear(self) -> None:
        self.by_minute.clear()
        self.by_part.clear()


class CardProcessor(StatefulProcessor):
    """What both modes share: the ledger in the state store and the facts of a run of rows."""

    def __init__(
        self, idle_ms: int | None = None, lru: bool = True, reset_after_ms: int | None = None, caps: tuple[int, int] | None = None,
        trail_rows: int = TRAIL_ROWS,
    ):
        self.idle_ms, self.trail_rows = idle_ms, trail_rows
        self.reset_after_ms = reset_after_ms if idle_ms is None else min(idle_ms, reset_after_ms or idle_ms)
        self.caps = (caps or (MAX_MCC, MAX_MERCHANTS)) if lru else (None, None)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.card = handle.getValueState("card", LEDGER_SCHEMA)
        self.spill = handle.getValueState("spill", SPILL_SCHEMA)
        self.store = StoredMinutes(handle)

    def ledger(self) -> CardLedger:
        stored = self.card.get()  # None when the card has no state yet
        self.store.forget()
        minutes = Minutes(self.store)
        if stored is not None and stored[0] == SPILLED_VERSION:
            before, *sums = self.spill.get()
            minutes = Minutes(self.store, before, [(h, n, int(u)) for h, n, u in zip(*sums)])
        self.had_spill = minutes.before is not None
        return CardLedger(self.caps, None if stored is None else tuple(stored), minutes, self.trail_rows)

    def save(self, ledger: CardLedger) -> None:
        self.card.update(ledger.stored())
        self.store.save()
        if ledger.spilled:
            hours = ledger.minutes.hours
            sums = [n for n, _ in hours.values()], [Decimal(units) for _, units in hours.values()]
            self.spill.update((ledger.minutes.before, list(hours), *sums))
        elif self.had_spill:
            self.spill.clear()

    def facts(self, card_id: str, rows: list[Row]) -> Iterator[Row]:
        ledger = self.ledger()
        before = ledger.place[0]
        for r in sorted(rows, key=lambda r: (r["ts_ms"], r["txn_id"])):
            told = ledger.take(r, self.reset_after_ms)
            yield Facts(r["txn_id"], card_id, r["ts_ms"], r["amount"], r["lat"], r["lon"], r["label"], *told)
        self.save(ledger)
        if self.idle_ms is not None and ledger.place[0] != before:
            if before is not None:
                self.handle.deleteTimer(before + self.idle_ms + 1)
            self.handle.registerTimer(ledger.place[0] + self.idle_ms + 1)

    def forget(self) -> None:
        """Clears all state of the card at hand."""
        self.card.clear()
        self.spill.clear()
        self.store.clear()

    def close(self) -> None:
        pass


class CardFeatureProcessor(CardProcessor):
    """Facts on arrival; ``idle_ms`` clears the state of idle cards (default off)."""

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from self.facts(key[0], list(rows))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self.forget()
        return iter(())


PENDING_SCHEMA = (
    "txn_id string, ts_ms long, amount double, mcc string, merchant_id string, lat double, lon double, label int"
)
PENDING = ("txn_id", "ts_ms", "amount", "mcc", "merchant_id", "lat", "lon", "label")


class EventTimeCardProcessor(CardProcessor):
    """T5: event-time mode. Rows of a card wait in list state until the watermark passes
    them and are then processed in (ts_ms, txn_id) order, so any arrival order within the
    watermark delay yields the same features as a sorted replay.

    The pending buffer holds at most the rows of the last ``delay`` of event time per card.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.pending = handle.getListState("pending", PENDING_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [tuple(r[c] for c in PENDING) for r in rows]
        if new:
            self.pending.appendList(new)
            self.handle.registerTimer(max(t[1] for t in new))
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        ready, later = [], []
        for waiting in self.pending.get():
            row = Row(*PENDING)(*waiting)
            (ready if row["ts_ms"] < watermark else later).append(row)
        if not ready:
            return
        yield from self.facts(key[0], ready)
        self.pending.clear()
        if later:
            self.pending.put([tuple(r) for r in later])
            self.handle.registerTimer(max(r["ts_ms"] for r in later))


class SlotMinutes:
    """Minutes and parts of all cards of a slot in map state, keyed by card."""

    def __init__(self, handle: StatefulProcessorHandle):
        self.by_minute = handle.getMapState("minutes", f"card_id string, {MINUTE_KEY}", MINUTE_SCHEMA)
        self.by_part = handle.getMapState("parts", f"card_id string, {PART_KEY}", PART_SCHEMA)
        self.listed: dict[str, dict[int, tuple]] | None = None

    def of(self, card_id: str, spilled: bool) -> Held:
        """The card's minutes; a card that has not spilled has none to read."""
        if not spilled:
            return Held()
        if self.listed is None:  # one pass for all cards of the slot
            self.listed = defaultdict(dict)
            for (card, minute), (n, units, parts) in self.by_minute.iterator():
                self.listed[card][minute] = (n, int(units), parts)

        def part(minute: int, part: int):
            times, amounts = self.by_part.getValue((card_id, minute, part))
            return list(times), list(amounts)

        return Held(self.listed[card_id].get, part)

    def save(self, card_id: str, held: Held) -> None:
        for key in held.dropped_parts:
            self.by_part.removeKey((card_id, *key))
        for key in held.changed_parts:
            self.by_part.updateValue((card_id, *key), held.parts[key])
        for minute in held.changed_minutes:
            value = held.minutes[minute]
            if value is None:
                self.by_minute.removeKey((card_id, minute))
            else:
                self.by_minute.updateValue((card_id, minute), (value[0], Decimal(value[1]), value[2]))

    def forget(self, card_id: str) -> None:
        """Clears the card's minutes and parts."""
        self.of(card_id, True)
        for minute, (_, _, parts) in self.listed.pop(card_id, {}).items():
            for part in range(parts):
                self.by_part.removeKey((card_id, minute, part))
            self.by_minute.removeKey((card_id, minute))


class SlotProcessor(CardProcessor):
    """Facts on arrival, of all cards of a slot at once."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.slot = handle.getValueState("slot", SLOT_SCHEMA)
        self.store = SlotMinutes(handle)

    def read(self) -> dict[str, tuple[int, str]]:
        """(time of the newest row, ledger as JSON) of every card of the slot."""
        self.store.listed = None  # nothing of the last slot is left
        stored = self.slot.get()
        return {} if stored is None else {card: told for card, *told in zip(*stored)}

    def write(self, known: dict[str, tuple[int, str]], before: int | None) -> None:
        """``before`` is the oldest card's time when the slot was read."""
        if known:
            self.slot.update((list(known), [ts for ts, _ in known.values()], [text for _, text in known.values()]))
        else:
            self.slot.clear()
        if self.idle_ms is not None:
            after = oldest(known)
            if after != before:
                if before is not None:
                    self.handle.deleteTimer(before + self.idle_ms + 1)
                if after is not None:
                    self.handle.registerTimer(after + self.idle_ms + 1)

    def slot_facts(self, rows: Iterator) -> Iterator[Row]:
        by_card = defaultdict(list)
        for r in rows:
            by_card[r["card_id"]].append(r)
        known = self.read()
        before = oldest(known)
        for card_id, own in by_card.items():
            stored = json.loads(known[card_id][1]) if card_id in known else None
            spilled = stored is not None and stored["v"] == SPILLED_VERSION
            held = self.store.of(card_id, spilled)
            minutes = Minutes(held, *stored["spill"]) if spilled else Minutes(held)
            ledger = CardLedger(self.caps, stored and tuple(stored[f] for f in LEDGER_FIELDS), minutes, self.trail_rows)
            for r in sorted(own, key=lambda r: (r["ts_ms"], r["txn_id"])):
                told = ledger.take(r, self.reset_after_ms)
                yield Facts(r["txn_id"], card_id, r["ts_ms"], r["amount"], r["lat"], r["lon"], r["label"], *told)
            value = dict(zip(LEDGER_FIELDS, ledger.stored()))
            if ledger.spilled:
                value["spill"] = [ledger.minutes.before, [(h, *sums) for h, sums in ledger.minutes.hours.items()]]
            self.store.save(card_id, held)
            known[card_id] = (ledger.place[0], json.dumps(value, separators=(",", ":")))
        self.write(known, before)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        yield from self.slot_facts(rows)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        known = self.read()
        upto = timerValues.getCurrentWatermarkInMs() - self.idle_ms - 1
        for card_id in [card for card, (ts, _) in known.items() if ts <= upto]:
            _, text = known.pop(card_id)
            if json.loads(text)["v"] == SPILLED_VERSION:
                self.store.forget(card_id)
        # the timer that has expired is deleted by Spark
        self.write(known, None)
        return iter(())


def oldest(known: dict[str, tuple[int, str]]) -> int | None:
    return min((ts for ts, _ in known.values()), default=None)


class EventTimeSlotProcessor(SlotProcessor):
    """T5 by slots: rows wait as JSON, a list element for each micro-batch of a slot with its first
    and last time; elements that the watermark has not reached are passed on unread."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        super().init(handle)
        self.pending = handle.getListState("pending", WAITING_SCHEMA)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        new = [[r[c] for c in WAITING] for r in rows]
        if new:
            self.pending.appendList([waiting(new)])
            self.handle.registerTimer(max(r[TS_AT] for r in new) + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        watermark = timerValues.getCurrentWatermarkInMs()
        ready, later = [], []
        for first, last, text in self.pending.get():
            if first >= watermark:
                later.append((first, last, text))
                continue
            rows = json.loads(text)
            ready += [dict(zip(WAITING, r)) for r in rows if r[TS_AT] < watermark]
            if last >= watermark:
                later.append(waiting([r for r in rows if r[TS_AT] >= watermark]))
        if not ready:
            return
        yield from self.slot_facts(ready)
        if later:
            self.pending.put(later)
            self.handle.registerTimer(max(last for _, last, _ in later) + 1)
        else:
            self.pending.clear()


WAITING = ("card_id", *PENDING)
TS_AT = WAITING.index("ts_ms")
WAITING_SCHEMA = "first long, last long, rows string"


def waiting(rows: list[list]) -> tuple[int, int, str]:
    times = [r[TS_AT] for r in rows]
    return min(times), max(times), json.dumps(rows, separators=(",", ":"))
