"""Packing, exact search, URL filter, sharding and the pipeline on small tables."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cardwise.llm import packing, sharding, topk, url_filter


def test_best_fit_equals_a_plain_search():
    rng = np.random.default_rng(5)
    costs = {c: packing.cost_of(c) for c in (16, 32, 64)}
    lengths = sorted(rng.integers(1, 65, 400).tolist(), reverse=True)
    bins, offsets, sizes = packing.best_fit(lengths, costs)
    room, used, expected, left = {}, {}, [], sum(lengths)
    for n in lengths:
        fits = [(r, b) for b, r in room.items() if r >= n]
        if fits:
            _, b = min(fits)
        else:
            b = len(used)
            room[b] = min((c for c in costs if c >= n), key=lambda c: (costs[c] / min(c, left), c))
            used[b] = 0
        expected.append(b)
        room[b] -= n
        used[b] += n
        left -= n
    assert bins == expected
    assert sizes == [min(c for c in costs if c >= used[b]) for b in range(len(used))]


def test_pack_covers_every_word_once(spark):
    rows = [(1, "a b c"), (2, None), (3, ""), (None, "x y"), (4, "w " * 1000), (4, "w " * 1000), (5, "tie tie tie")]
    got = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), sizes=(8, 64)).toPandas()
    assert got.length.sum() == 3 + 2 + 2000 + 3
    assert got[got.length == 0].bin.isna().all() and len(got[got.length == 0]) == 2
    full = got[got.length > 0]
    for _, part in full.groupby("bin"):
        spans = sorted(zip(part.offset, part.length, strict=True))
        assert all(a + n == b for (a, n), (b, _) in zip(spans, spans[1:], strict=False))
        assert part.length.sum() <= part.capacity.iloc[0]
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(6)
    rows = [(i, rng.normal(size=8).round(1).tolist()) for i in range(300)]  # rounding makes ties
    rows += [(400, None), (420, [1.0, None]), (440, [float("nan")] * 8), (460, [float("inf")] * 8), (None, [1.0] * 8), (7, rows[7][1]), (480, [])]
    got = topk.exact_top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), F.col("vec_id") % 20 == 0, k=5).collect()
    whole = [(i, [int(np.floor(np.float64(np.float32(x)) * 64)) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, qv in whole:
        if q % 20 == 0:
            scored = sorted((-sum(a * b for a, b in zip(qv, v, strict=False)), i) for i, v in whole if i != q)[:5]
            want += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    assert sorted(tuple(r) for r in got) == sorted(want)
    assert topk.exact_top_k(spark.createDataFrame([], "vec_id long, embedding array<float>"), F.lit(True)).count() == 0


def test_top_k_with_large_numbers():
    rng = np.random.default_rng(7)
    for scale in (5, 10**5, 2**28):
        block, ask = rng.integers(-scale, scale, (200, 6)), rng.integers(-scale, scale, (9, 6))
        for (rows, scores), q in zip(topk.top_k(ask, block, np.zeros((9, 200), bool), 7), ask, strict=True):
            exact = block.astype(object) @ q.astype(object)
            order = sorted(range(200), key=lambda i: (-exact[i], i))[:7]
            assert rows.tolist() == order and scores.tolist() == [exact[i] for i in order]


def test_top_k_with_components_past_a_clamp(spark):
    rows = [(0, [1.0, -0.5]), (1, [5e6, 0.0]), (2, [6e6, 0.0]), (3, [7e6, 1e6]), (4, [2.0**40, -3.0])]
    schema = "vec_id long, embedding array<double>"
    got = topk.exact_top_k(spark.createDataFrame(rows, schema), F.col("vec_id") == 0, k=4).collect()
    whole = {i: [int(np.floor(x * 64)) for x in v] for i, v in rows}
    want = sorted((-sum(a * b for a, b in zip(whole[0], v, strict=True)), i) for i, v in whole.items() if i)
    assert [(r["rank"], r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"])] == [(n, i, -s) for n, (s, i) in enumerate(want, 1)]
    for huge in (1e300, 2.0**50):  # a component, or a score alone, that 64 bits cannot hold
        with pytest.raises(Exception, match="too large"):
            topk.exact_top_k(spark.createDataFrame([(0, [huge]), (1, [huge])], schema), F.col("vec_id") == 0).collect()


def test_top_k_past_64_bits():
    rng = np.random.default_rng(8)
    block, ask = -rng.integers(1 << 35, 1 << 40, (200, 6)), rng.integers(1 << 35, 1 << 40, (3, 6))
    block[::20] = rng.integers(-5, 6, (10, 6))  # the best scores fit 64 bits, the others do not
    for (rows, scores), q in zip(topk.top_k(ask, block, np.zeros((3, 200), bool), 7), ask, strict=True):
        exact = block.astype(object) @ q.astype(object)
        order = sorted(range(200), key=lambda i: (-exact[i], i))[:7]
        assert rows.tolist() == order and scores.tolist() == [exact[i] for i in order]


def test_top_k_reading_stops_when_no_outsider_can_qualify():
    rng = np.random.default_rng(9)
    block, ask = rng.integers(-9, 10, (4000, 8)), rng.integers(-9, 10, (70, 8))
    block[:, 3] *= rng.integers(1, 400, 4000)  # one list decides most scores, so little of the lists is read
    own = np.zeros((70, 4000), bool)
    own[5, :3990] = True  # a query that meets ten rows
    scores = ask @ block.T
    scores[own] = -(10**12)
    seen, depths = [], []
    for q, depth, rows in topk.read_lists(ask, block, np.sort(block, axis=0), own, 6):
        best = np.lexsort((np.arange(4000), -scores[q]))[:6]
        assert set(best) <= set(rows.tolist()) and not own[q, rows].any()
        seen.append(q)
        depths.append(depth)
        if depth < 1:
            assert len(rows) <= topk.LEFT * 6
        else:  # read to the end: the bounds meet, only the best and their ties are left
            assert scores[q, rows].min() >= scores[q, best].min()
    assert sorted(seen) == list(range(70)) and depths[seen.index(5)] == 0
    assert np.mean(np.array(depths) <= 0.75) > 0.5


def test_url_rules_and_edges(spark):
    urls = ["http://A.Example.com/en/1?x", "https://www.example.com/en/2#t", "http://x.net/es/3", "http://x.net", "http://com/a", "notaurl", None, "http://", "ftp://b.org/a/b/7/", "http://x.net/fr/é?q://z", "http://evilcom/a"]
    got = {r["page_id"]: r for r in url_filter.url_filter(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")).collect()}
    assert [got[i]["rule"] for i in range(len(urls))] == ["example.com/en/", "www.example.com/en/", "net/es/", None, "com/", None, None, None, None, "net/fr/", None]
    assert (got[0]["host"], got[0]["path"]) == ("a.example.com", "/en/1")
    assert (got[5]["host"], got[6]["path"], got[9]["path"]) == ("", "", "/fr/é")
    assert {r["verdict"] for r in got.values()} <= {"allow", "block"}
    assert url_filter.url_filter(spark.createDataFrame([], "page_id long, url string")).count() == 0


def test_url_templates_reject_by_purity(spark):
    rules = [("block", "a.com/bad/"), ("allow", "b.com/")]
    urls = [f"http://a.com/bad/{i}" for i in range(300)] + [f"http://a.com/new/{i}" for i in range(20)] + [f"http://b.com/x/{i}" for i in range(300)] + ["http://c.org/x/1"]
    urls += [f"http://a.com/{i}/b" for i in range(20)] + [f"http://d.com/v{i}/y" for i in range(20)]
    rules += [("block", f"d.com/v{i}/") for i in range(19)]
    seen = set()
    for times in (1, 10, 50):  # repeated rows change no verdict
        rows = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
        rows = rows.join(spark.range(times).withColumnRenamed("id", "copy"))
        got = url_filter.url_filter(rows, rules=rules).drop("path").distinct().collect()
        assert {r["verdict"] for r in got if r["template"] == "new/*"} == {"allow"}  # blocked siblings are no evidence
        assert {r["verdict"] for r in got if r["host"] == "c.org"} == {"allow"}
        last = [r for r in got if r["host"] == "d.com" and r["rule"] is None]
        assert {(r["template"], r["verdict"]) for r in last} == {("*/y", "block")}  # labelled paths share its template
        seen.add(tuple(sorted((r["page_id"], r["template"], r["verdict"]) for r in got)))
    assert len(seen) == 1


@pytest.mark.parametrize("depth", [6_000, 50_000])
def test_very_long_urls(spark, depth):
    rows = [(1, "http://a.com/" + "x/y1/" * (depth // 2)), (2, "http://net/es/" + "z/" * depth), (3, "http://a.com/x")]
    got = {r["page_id"]: r for r in url_filter.url_filter(spark.createDataFrame(rows * 2, "page_id long, url string")).collect()}
    assert got[1]["template"].count("/") == depth - 1 and got[2]["verdict"] == "block" and got[3]["template"] == "*"


def jump(key, shards):
    import hashlib

    b, j = 0, 0
    while j < shards:
        b = j
        j = int((b + 1) * 2.0**52 / (int(hashlib.md5(f"{key}:{b}".encode()).hexdigest()[:13], 16) + 1))
    return b


@pytest.mark.parametrize("per_block", [20_000, 3])
def test_sharding_law_and_slots(spark, per_block):
    rows = [(i, f"t{i}") for i in range(500)] + [(7, "t7")] * 30 + [(None, "x"), (None, None), (501, None)]
    got = sharding.shard_plan(spark.createDataFrame(rows, "doc_id long, text string"), 6, rows_per_block=per_block).collect()
    assert len(got) == len(rows)
    slots = {}
    for r in got:
        slots.setdefault(r["shard"], []).append(r["slot"])
        if r["doc_id"] is not None:
            assert r["shard"] == jump(r["doc_id"], 6) and r["grown_shard"] == jump(r["doc_id"], 7)
        assert r["grown_shard"] in (r["shard"], 6)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert Counter(r["doc_id"] for r in got)[7] == 31
    assert sharding.shard_plan(spark.createDataFrame([], "doc_id long, text string"), 6).count() == 0


def test_pipeline_stages_on_planted_rows(spark, tmp_path):
    base = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{base}/documents.parquet")
    long_text = docs.where("length(text) > 2000 and lang = 'en'").orderBy("doc_id").first()["text"]
    fresh = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(400))
    extra = [(900_001, fresh, "en", "s", 1), (900_002, fresh.replace(" ", "  "), "en", "s", 1), (900_003, fresh + " tail", "en", "s", 1), (900_004, None, "en", "s", 1), (900_005, "123 456", "en", "s", 1)]
    rows = docs.union(spark.createDataFrame(extra, docs.schema))
    for name, stage in corpus_pipeline.STAGES:
        kept = stage(spark, rows, base)
        if name != "best_fit_packing":
            assert kept.columns == docs.columns
        path = str(tmp_path / name)
        kept.write.parquet(path)
        rows = spark.read.parquet(path)
        ids = {r[0] for r in rows.select("doc_id").collect()}
        assert not ids & {900_004, 900_005}
        assert (900_002 in ids) == (name in ("language_id", "toxicity"))
        assert (900_003 in ids) == (name in ("language_id", "toxicity", "exact_dedup"))
        assert 900_001 in ids and len(long_text) > 0


def test_pipeline_drops_near_copies_from_80_percent(spark):
    words = ["u%d" % i for i in range(204)]
    texts = [words, [*words[:184], *("v%d" % i for i in range(20))], ["w%d" % i for i in range(50)]]  # 180 of 220 shingles
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string")
    assert {r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()} == {0, 2}


def test_pipeline_keeps_one_near_copy_without_id(spark):
    copies = [" ".join(["u%d" % i for i in range(100)] + [end] * 2) for end in ("x", "y", "z")]
    rows = [*((None, t) for t in copies), (None, "alone " * 9), (None, "one two three"), (5, "a b c d e f g"), (5, "a b c d e f g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = [r["text"] for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert len(set(kept) & set(copies)) == 1 and len(kept) == 4 and len(set(kept)) == 4


def test_pipeline_takes_empty_tables(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
    assert docs.count() == 0
