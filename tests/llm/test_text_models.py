"""Language ID and toxicity (held-out accuracy, edge rows), tokenisers (library oracles)."""

import os
import time

import numpy as np
import pytest

from cardwise.llm import language_id, sentencepiece_codec, token_counts, toxicity
from cardwise.llm.queries import PIECES

DATA = "/root/testdata/sf0.01"
ODD = [None, "", " \t\n", "?!? 123", "ab " * 200_000, "x" * 3000, "ſ ﬁ 日本語 \U0001f600 é", "Hello  world\n a\tb", "a" * 50 + " " * 40 + "b", "//---===", "tail  "]


def edge(spark, extra="lang string"):
    rows = [(i, t, None) for i, t in enumerate(ODD)] + [(None, "null id", "en"), (3, "repeat", "en"), (3, "repeat", "en")]
    return spark.createDataFrame(rows, f"doc_id long, text string, {extra}")


needs_pieces = pytest.mark.skipif(not os.path.exists(PIECES), reason="vocabulary file is not here")


def test_language_id_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = language_id.language_id(docs).toPandas().merge(docs.select("doc_id", "lang").toPandas(), on="doc_id")
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_id_edges(spark):
    got = language_id.language_id(edge(spark)).toPandas()
    assert len(got) == len(ODD) + 3
    assert set(got[got.doc_id.isin([0, 1, 2])].lang_pred) == {"und"}
    assert language_id.language_id(edge(spark).limit(0)).count() == 0
    assert set(language_id.language_id(edge(spark).drop("lang").selectExpr("*", "cast(null as string) lang")).toPandas().lang_pred) == {"und"}


@pytest.mark.parametrize("clean_labels", [None, 0, 1, 10, 1000])
def test_toxicity_held_out(spark, clean_labels):
    """However many texts are labelled clean, and with a toxic id there 20,000 times."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    given = labels
    if clean_labels is not None:
        given = labels.where("toxic = 1").union(labels.where("toxic = 0").orderBy("doc_id").limit(clean_labels))
        one = labels.where("toxic = 1 AND crc32(cast(cast(doc_id AS string) AS binary)) % 5 <> 0").orderBy("doc_id").limit(1)
        docs = docs.unionByName(docs.join(one.select("doc_id"), "doc_id").join(spark.range(20_000).select()).select(*docs.columns))
    got = toxicity.toxicity(docs, given).distinct().toPandas().merge(labels.toPandas(), on="doc_id")
    held = got[got.held_out]
    toxic, clean = held[held.toxic == 1], held[held.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.9
    assert (clean.predicted == 1).mean() < 0.02
    assert held.score.between(0, 1).all()


def test_toxicity_slopes_are_those_of_the_risk():
    rng = np.random.default_rng(2)
    for shift in (0.0, -6.0):  # with a corrected part above and below zero
        z, is_p = rng.normal(size=40) + shift, np.arange(40) < 9
        z[is_p] += 8 if shift else 0
        positive, corrected, slope = toxicity.risk_and_slope(z, is_p, 0.3)
        p, u = z[is_p], z[~is_p]
        loss = lambda x: np.log1p(np.exp(-x))
        assert positive == pytest.approx(0.3 * loss(p).mean()) and corrected == pytest.approx(loss(-u).mean() - 0.3 * loss(-p).mean())
        assert (corrected < 0) == (shift < 0)
        for i in range(40):
            up, down = z.copy(), z.copy()
            up[i] += 1e-5
            down[i] -= 1e-5
            value = lambda x: (lambda r: r[0] + r[1] if shift == 0 else -r[1])(toxicity.risk_and_slope(x, is_p, 0.3))
            assert slope[i] == pytest.approx((value(up) - value(down)) / 2e-5, abs=1e-8)


def test_toxicity_edges(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (None, 1)], "doc_id long, toxic int")
    got = toxicity.toxicity(edge(spark), labels).toPandas()
    assert len(got) == len(ODD) + 3 and got.score.between(0, 1).all()
    assert set(toxicity.toxicity(edge(spark), labels.limit(0)).toPandas().predicted) == {0}
    assert toxicity.toxicity(edge(spark).limit(0), labels).count() == 0


@pytest.mark.parametrize("prior", [None, 0.25])
def test_toxicity_learns_from_confirmed_toxic_rows_alone(spark, prior):
    rng = np.random.default_rng(9)
    words = lambda kind, n: [f"{kind}{i}" for i in rng.integers(0, n, 12)]
    toxic = [i % 4 == 0 for i in range(800)]
    texts = [" ".join([*(f"q{chr(97 + int(j) % 26)}x" for j in rng.integers(0, 26, 12)), *(["vile", "awful"] if bad else ["calm"]), *words("n", 50)]) for bad in toxic]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, 1) for i in range(0, 800, 8)], "doc_id long, toxic int")  # half of the toxic ones
    got = toxicity.toxicity(docs, labels, prior=prior).toPandas().sort_values("doc_id")
    assert got.held_out.any() and (got.predicted == np.array(toxic)).mean() > 0.95


@needs_pieces
def test_token_counts_equal_the_library(spark):
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    initial, inner = token_counts.pieces_of_model(PIECES)
    vocabulary = {}
    for piece in ["[UNK]", *initial, *("##" + p for p in inner)]:
        vocabulary.setdefault(piece, len(vocabulary))
    library = Tokenizer(models.WordPiece(vocabulary, unk_token="[UNK]", max_input_chars_per_word=10**6))
    library.pre_tokenizer = pre_tokenizers.Split(Regex(r"[\x20\x09-\x0D]+"), "removed")
    docs = edge(spark).select("doc_id", "text").union(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 1000", "text"))
    got = {(r["doc_id"], r["n_tokens"]) for r in token_counts.token_counts(docs, token_counts.build_automaton(initial, inner)).collect()}
    assert got == {(r["doc_id"], len(library.encode(r["text"] or "", add_special_tokens=False).ids)) for r in docs.collect()}


def test_automaton_on_a_small_vocabulary():
    auto = token_counts.build_automaton(["a", "abcde"], ["b", "cd", "c", "d", "ef", "bcdx"])
    assert token_counts.lengths([b"abcde", b"abcdx", b"abcd", b"abz", b"z", b"aef"], auto).tolist() == [1, 2, 3, 1, 1, 2]


def greedy_length(word: str, initial: set[str], inner: set[str]) -> int:
    longest, at, n, pieces = max(map(len, initial | inner)), 0, 0, initial
    while at < len(word):
        fits = [k for k in range(1, min(longest, len(word) - at) + 1) if word[at : at + k] in pieces]
        if not fits:
            return 1
        at, n, pieces = at + fits[-1], n + 1, inner
    return n


def test_long_words_are_walked_singly():
    rng = np.random.default_rng(12)
    initial, inner = {"a", "abcde", "ab"}, {"a", "b", "cd", "c", "d", "ef", "bcdx", "abc"}
    words = ["".join(rng.choice(list("abcdef" if i % 5 else "abcd"), n)) for i, n in enumerate(rng.integers(1, 60, 500))]
    words += ["a" + "".join(rng.choice(list("abcd"), n)) for n in (3000, 70, 500)] + ["a" * 400 + "z"]
    auto = token_counts.build_automaton(initial, inner)
    want = [greedy_length(w, initial, inner) for w in words]
    assert token_counts.lengths([w.encode() for w in words], auto).tolist() == want
    assert [int(token_counts.lengths([w.encode()], auto)[0]) for w in words] == want


@needs_pieces
def test_a_million_unbroken_characters():
    import sentencepiece

    rng = np.random.default_rng(13)
    text = "".join(rng.choice(list("etaoinshrdlu"), 1_000_000))
    initial, inner = map(set, token_counts.pieces_of_model(PIECES))
    auto = token_counts.build_automaton(initial, inner)
    began = time.process_time()
    got = int(token_counts.lengths([text.encode()], auto)[0])
    assert time.process_time() - began < 10 and got == greedy_length(text, initial, inner)
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    encoder = sentencepiece_codec.Encoder(sentencepiece_codec.read_model(PIECES))
    began = time.process_time()
    ids = encoder.encode(text)
    assert time.process_time() - began < 30 and ids.tolist() == library.encode(text)


@needs_pieces
def test_encoding_equals_the_library_and_decodes(spark):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    model = sentencepiece_codec.read_model(PIECES)
    docs = edge(spark).union(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id + 1000", "text", "lang"))
    encoded = sentencepiece_codec.encode_documents(docs, model)
    want = sorted((str(r["doc_id"]), library.encode(r["text"] or "")) for r in docs.collect())
    assert sorted((str(r["doc_id"]), r["ids"]) for r in encoded.collect()) == want
    texts = sorted((str(r["doc_id"]), r["text"]) for r in sentencepiece_codec.decode_documents(encoded, model).collect())
    assert texts == sorted((str(r["doc_id"]), r["text"] or "") for r in docs.collect())
    assert sentencepiece_codec.encode_documents(docs.limit(0), model).count() == 0


def test_unigram_takes_the_best_path():
    pieces = ["<unk>", "▁", "a", "b", "ab", "▁a", "ba", "▁ab", "aba"]
    scores = [0.0, -2.5, -3.1, -3.2, -4.0, -4.4, -4.2, -6.1, -5.3]
    model = sentencepiece_codec.Model(pieces, scores, False, 0, -1, frozenset({0}))
    encoder = sentencepiece_codec.Encoder(model)

    def best(text):
        if not text:
            return 0.0
        return max((scores[i] + best(text[len(p) :]) for i, p in enumerate(pieces) if i and text.startswith(p)), default=-np.inf)

    for text in ("abab", "ba ab", "aababba", "b"):
        ids = encoder.encode(text)
        assert sum(scores[i] for i in ids) == pytest.approx(best("▁" + text.replace(" ", "▁")))
        assert sentencepiece_codec.decode(ids, model.spelled) == text


def test_text_vectors_equal_brute_force():
    vector = {}

    def of(char):
        return vector.setdefault(char, language_id.letter_vectors(np.array([ord(char)]))[0].astype(int))

    for text in ("Abc, abc!  Äß", "a", "ab ab ab", "日本語 ok", "x" * 500, "q1w2e3"):
        letters = "".join(c if c.isalpha() else " " for c in text.lower())
        plain = " " + " ".join(letters.split()) + " "
        want = sum(np.roll(of(a), 2) * np.roll(of(b), 1) * of(c) for a, b, c in zip(plain, plain[1:], plain[2:], strict=False))
        assert np.array_equal(language_id.text_vectors([None, text, ""])[1], want)
