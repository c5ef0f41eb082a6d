"""Collocations, suffix dedup and conversation repair against brute force, with nulls, repeats,
ties, long texts, empty tables and clashing columns."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from cardwise.llm import collocations as co
from cardwise.llm import conversation_repair as cr
from cardwise.llm import grams, lattice, suffix_dedup, suffixes

DOCS = "doc_id long, text string, lang string, phrase string, at int, digest string"


def docs_frame(spark, rows):
    return spark.createDataFrame([(i, t, lang, "x", 1, "y") for i, t, lang in rows], DOCS)


# -- collocations ---------------------------------------------------------------------------


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute_collocations(rows, threshold, longest, top, cover):
    n, f = Counter(), defaultdict(Counter)
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        n[lang] += 0
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        frequent = {p: a for p, a in counts.items() if a >= threshold}
        hidden = defaultdict(int)
        for p, a in frequent.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    hidden[p[i : i + k]] = max(hidden[p[i : i + k]], a)
        found = []
        for p, a in frequent.items():
            if len(p) > 1 and 100 * hidden[p] < cover * a:
                score, _, left, right = min((2_000_000 * a // (counts[p[:k]] + counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
                found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def talk(seed, rows=300):
    rng = random.Random(seed)
    word = lambda: rng.choice(["New", "york", "CITY", "of", "the", "à", "x" * 40, "w%d" % rng.randrange(60)])
    texts = [" ".join(word() + rng.choice(["", "", "", ".", ",", "\t", "\n"]) for _ in range(rng.randrange(30))) for _ in range(rows)]
    out = [(i, t, rng.choice(["en", "fr", None])) for i, t in enumerate(texts)]
    return [*out, (1, None, "en"), (1, "", "en"), (None, "new york city of the " * 3000, "en"), (5, "the of", "de"), *[(9, "hot phrase here", "fr")] * 200]


@pytest.mark.parametrize("limit", [300, 2_000_000])
def test_collocations_equal_brute_force(spark, monkeypatch, limit):
    monkeypatch.setattr(grams.chunks, "__defaults__", (limit,))
    rows = talk(limit)
    got = co.collocations(docs_frame(spark, rows).repartition(5), threshold=6, top=25)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(rows, 6, 4, 25, 80)


def test_collocations_of_nothing(spark):
    assert co.collocations(docs_frame(spark, [])).count() == 0
    assert co.collocations(docs_frame(spark, [(1, None, None), (2, "", "en")])).count() == 0


def test_long_texts_are_cut_without_loss():
    text = ("alpha beta, gamma  delta " * 40 + "z" * 700 + " end of it").encode()
    for limit in (10, 50, 333):
        counts = [Counter(), Counter()]
        for which, cap in enumerate((limit, 1 << 20)):
            for chunk, _ in grams.chunks([("en", text.decode())], 4, cap):
                for gram, mask in chunk.grams(4, [np.full(8192, 255, np.uint8)] * 4):
                    counts[which].update(gram[mask].tolist())
        assert counts[0] == counts[1]


def test_misra_gries_keeps_what_is_frequent():
    rng = np.random.default_rng(3)
    values = np.concatenate([rng.integers(0, 5000, 20_000), np.repeat(np.arange(6000, 6040), 60)]).astype(np.uint64)
    rng.shuffle(values)
    true = Counter(values.tolist())
    threshold = 50
    parts = [co.Summary(len(values) // threshold + 1) for _ in range(3)]
    for i, some in enumerate(np.array_split(values, 60)):
        keys, counts = np.unique(some, return_counts=True)
        parts[i % 3].add(keys, counts)
    whole = parts[0]
    for other in parts[1:]:
        whole.merge(other)
    assert 0 < whole.lost < threshold and len(whole.hashes) <= whole.capacity
    kept = dict(zip(whole.hashes.tolist(), whole.counts.tolist(), strict=True))
    assert all(kept.get(v, 0) <= n <= kept.get(v, 0) + whole.lost for v, n in true.items())
    assert {v for v, n in true.items() if n >= threshold} <= set(whole.frequent(threshold).tolist())


# -- suffix dedup ---------------------------------------------------------------------------


def brute_cut(rows):
    texts = [(i, (t or "").encode()) for i, t, _ in rows]
    seen = Counter(b[p : p + 200] for _, b in texts for p in range(len(b) - 199))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for p in range(len(b) - 199):
            if seen[b[p : p + 200]] > 1:
                gone[p : p + 200] = b"\1" * 200
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(rb"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def passages(seed):
    rng = random.Random(seed)
    noise = lambda n: "".join(rng.choice("abcdefgh é") for _ in range(n))
    shared = [noise(n) for n in (199, 200, 201, 350, 900)]
    rows = []
    for i in range(60):
        rows.append((i, noise(rng.randrange(300)).join(rng.choices(shared, k=rng.randrange(4)) + [noise(150)]), "en"))
    edited = list(shared[4])
    edited[450] = "#"
    rows += [(100, "".join(edited), "en"), (101, "ab" * 700, "en"), (102, "z" * 1300, "en"), (103, noise(5000), "en")]
    rows += [(104, shared[3] + shared[3], None), (105, None, "en"), (106, "", "en"), (None, noise(220), "en")]
    rows += [(7, "copy " * 3 + noise(0) + shared[1], "en")] * 3
    return rows + [(200 + i, noise(120) + shared[2] + noise(120), "en") for i in range(40)]


@pytest.mark.parametrize("limit,giant", [(400, 0), (1_000_000, 8), (1_000_000, 1 << 14)])
def test_suffix_dedup_equals_brute_force(spark, monkeypatch, limit, giant):
    monkeypatch.setattr(suffixes.chunks, "__defaults__", (limit,))
    monkeypatch.setattr(suffix_dedup.all_families, "__defaults__", (limit,))
    monkeypatch.setattr(suffix_dedup, "WINDOWS", 2000)
    monkeypatch.setattr(suffix_dedup, "GIANT", giant)
    rows = passages(limit)
    got = suffix_dedup.suffix_dedup(docs_frame(spark, rows).repartition(4), parts=7)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_cut(rows)


def test_suffix_dedup_of_nothing(spark):
    assert suffix_dedup.suffix_dedup(docs_frame(spark, [])).count() == 0


def test_multikey_quicksort_finds_equal_strings():
    rng = np.random.default_rng(4)
    data = np.concatenate([np.tile(rng.integers(0, 3, 400), 5), rng.integers(0, 2, 3000), np.zeros(900)]).astype(np.uint8)
    place = rng.integers(0, len(data) - 208, 4000)
    group = rng.integers(0, 3, 4000)
    label = suffixes.multikey_quicksort(data, place, group)
    first = {}
    for i, (p, g) in enumerate(zip(place.tolist(), group.tolist(), strict=True)):
        key = (g, data[p : p + 200].tobytes())
        assert label[first.setdefault(key, i)] == label[i]
    assert len(set(label.tolist())) == len(first)


# -- conversation repair --------------------------------------------------------------------

CONV = "conv_id long, turn long, role string, text string, part string, pos int, conv string"


def damage(rows):
    out = []
    for c, t, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(c, t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def paths(rows):
    """(cost, audit, lines) of every state, row by row, by plain dynamic programming."""
    follows = {"": "u", "s": "u", "u": "a", "a": "u"}
    name = {"u": "user:", "a": "assistant:"}

    def inserted(best):
        for _ in range(3):
            for s, (cost, audit, lines) in list(best.items()):
                to = follows[s]
                best[to] = min(best.get(to, (9**9,)), (cost + 3, audit + "I", [*lines, name[to]]))
        return best

    best = {"": (0, "", [])}
    for role, text, fault in rows:
        after = {}
        for s, (cost, audit, lines) in inserted(best).items():
            ways = [(s, cost + 4, "D", lines)]
            if fault not in ("blank", "duplicate"):
                more = 3 if fault else 0
                ways.append((follows[s], cost + 3 + more, "R", [*lines, name[follows[s]] + text]))
                if role[:1] == follows[s] or (role[:1] == "s" and s == ""):
                    ways.append((role[:1], cost + more, "K", [*lines, f"{role}:{text}"]))
            for to, c, letter, more_lines in ways:
                after[to] = min(after.get(to, (9**9,)), (c, audit + letter, more_lines))
        best = after
    best = inserted(best)
    return min(best[s] for s in ("", "a") if s in best)


def brute_repair(rows, with_damage=True):
    hurt = damage(rows) if with_damage else [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    by = defaultdict(list)
    for r in hurt:
        by[r[0]].append(r)
    out = []
    for c in {r[0] for r in rows}:
        turns = sorted(by[c], key=lambda r: (r[1] is not None, r[1] or 0, r[2], hashlib.sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()))
        seen, marked, faults = set(), [], Counter()
        for _, _, role, text in turns:
            body = re.sub(r"[\x20\x09-\x0D]+$", "", text)
            fault = "blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else ""
            seen.add((role, text))
            faults[fault] += 1
            marked.append((role, text, fault))
        known = [r[1] for r in turns if r[1] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        cost, audit, lines = paths(marked)
        out.append((c, gaps, faults["blank"], faults["duplicate"], faults["truncated"], illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def chats(seed, convs=40, hot=900):
    rng = random.Random(seed)
    rows = []
    for c in [*range(convs), None]:
        for t in range(hot if c == 3 else rng.randrange(1, 14)):
            role = rng.choice(["system", None, "", "tool", "User"]) if rng.random() < 0.1 else ("user", "assistant")[t % 2]
            text = rng.choice(["Hello there. ", "cut off", "Yes!\n", "", " \t", None, "é?", "so %d." % rng.randrange(500)])
            rows.append((c, None if rng.random() < 0.05 else t + 2 * (t > 5), role, text))
    rows += [(5, 2, "user", "again."), (5, 2, "user", "again."), (5, 2, "assistant", "tie."), (77, 1, "user", "a" * 100_000), (78, None, None, None)]
    rng.shuffle(rows)
    return rows


def conv_frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "y") for r in rows], CONV)


@pytest.mark.parametrize("with_damage", [True, False])
def test_conversation_repair_equals_brute_force(spark, monkeypatch, with_damage):
    monkeypatch.setattr(cr, "CHUNK", 64)
    rows = chats(11)
    got = cr.conversation_repair(conv_frame(spark, rows).repartition(3), damage=with_damage, parts=9)
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_repair(rows, with_damage)


def test_conversation_repair_of_nothing(spark):
    assert cr.conversation_repair(conv_frame(spark, [])).count() == 0


@pytest.mark.parametrize("block", [3, 32])
def test_auction_equals_dynamic_programming(block):
    rng = random.Random(block)
    for _ in range(150):
        rows = [(rng.choice(["s", "u", "a", "u", "a", " "]), "t", rng.choice(["", "", "", "blank", "duplicate", "truncated"])) for _ in range(rng.randrange(40))]
        codes = {"": lattice.FINE, "blank": lattice.BLANK, "duplicate": lattice.DUPLICATE, "truncated": lattice.TRUNCATED}
        state, audit, cost = lattice.START, "", 0
        for solved in lattice.solve([lattice.row_arcs(i, codes[f]) for i, _, f in rows], lattice.CLOSING, block):
            for letters, states, paid in solved.trace(state):
                audit, cost, state = audit + letters, cost + paid, states[-1]
        audit, cost = audit + "I" * (lattice.CLOSING[state] // lattice.INSERT), cost + lattice.CLOSING[state]
        assert (cost, audit) == paths(rows)[:2]
