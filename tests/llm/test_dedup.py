"""Exact and near dedup against brute force, with nulls, repeats, ties and clashing columns."""

import hashlib
import random
import re

import numpy as np
import pytest

from cardwise.llm import minhash
from cardwise.llm.components import components
from cardwise.llm.exact_dedup import exact_dedup
from cardwise.llm.near_dedup import near_dedup

SCHEMA = "doc_id long, text string, digest int, run int, kept string, node int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 1, 2, "x", 3) for i, t in rows], SCHEMA)


def exact_rows():
    rng = random.Random(1)
    rows = [(i, rng.choice(["same  text", "same\ttext", "other", "", None, "long " * 20_000])) for i in range(200)]
    return [*rows, (7, "same text"), (7, "same text"), (None, "only"), (None, "only"), (None, "same text")]


@pytest.mark.parametrize("fan_in", [2, 8])
def test_exact_dedup_equals_groups(spark, fan_in):
    rows = exact_rows()
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    got = exact_dedup(frame(spark, rows).repartition(7), fan_in=fan_in).collect()
    assert len(got) == len(rows)
    by_digest = {hashlib.sha256(t.encode()).hexdigest(): ids for t, ids in groups.items()}
    for r in got:
        ids = by_digest[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == min((i for i in ids if i is not None), default=None)
        assert not r["kept"] or r["doc_id"] == r["keep_id"]
    assert sum(r["kept"] for r in got) == len(groups)


def test_empty_tables(spark):
    assert exact_dedup(frame(spark, [])).count() == 0
    assert near_dedup(frame(spark, [])).count() == 0


def shingle_set(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_rows():
    rng = random.Random(2)
    word = lambda: "w%d" % rng.randrange(5000)
    passage = [word() for _ in range(60)]
    rows = []
    for base in range(12):
        text = [word() for _ in range(rng.choice([20, 80, 300]))] + (passage if base % 2 else [])
        for _ in range(12):
            copy = list(text)
            for _ in range(rng.randrange(4)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(" ".join(copy))
            text = copy if base % 3 == 0 else text  # chains: the ends are not linked directly
    rows += ["a b c", "A  b\nc", "a b", "", None, " \t", "Ünï cödé of five words"] + [rows[5].upper()] * 3
    rng.shuffle(rows)
    return [*enumerate(rows), (0, rows[0]), (None, rows[1]), (None, ""), (None, "no id at all here now")]


def test_near_dedup_equals_brute_force(spark):
    rows = near_rows()
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    least = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    expected = sorted((str(i), len(sets[a]), str(least.get(find(a)))) for a, (i, _) in enumerate(rows))
    got = near_dedup(frame(spark, rows)).collect()
    assert sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got) == expected
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_near_dedup_takes_a_threshold(spark):
    words = ["u%d" % i for i in range(204)]
    rows = [(1, " ".join(words)), (2, " ".join([*words[:184], *("v%d" % i for i in range(20))]))]  # 180 of 220 shingles
    sets = [shingle_set(t) for _, t in rows]
    assert 0.80 <= len(sets[0] & sets[1]) / len(sets[0] | sets[1]) < 0.85
    for percent, kept in ((85, {1, 2}), (80, {1})):
        assert {r["doc_id"] for r in near_dedup(frame(spark, rows), percent=percent).collect() if r["kept"]} == kept


def test_sketches_fill_and_estimate():
    rng = np.random.default_rng(0)
    base = rng.integers(0, 2**63, 2000).astype(np.uint64)
    for n in (1, 2, 40, 2000):
        sketch = minhash.sketches([base[:n], base[: max(1, n * 9 // 10)]])
        assert not (sketch == minhash.EMPTY).any()
        assert abs((sketch[0] == sketch[1]).mean() - max(1, n * 9 // 10) / n) < 0.15
    assert (minhash.sketches([base[:0]]) == minhash.EMPTY).all()


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 50)]
    random.Random(3).shuffle(links)
    got = {r["node"]: r["label"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: 0 if n < 1000 else 1000 for link in links for n in link}
