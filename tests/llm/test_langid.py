"""Language models over segmentations against spelled-out sums, and held-out accuracy."""

import math

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from folioweave.llm import langid

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = ["the", "ünïcode", "straße", "ab", "zq漢𒀀字", "é", "internationalisation"]


def cuts(text, vocabulary, own):
    """All segmentations of a text as lists of pieces; characters that are no piece go by bytes."""
    if not text:
        yield []
    for n in range(1, len(text) + 1):
        if text[:n] in vocabulary:
            found = [vocabulary[text[:n]]]
        elif n == 1:
            found = [own.byte[b] for b in text[0].encode()]
        else:
            continue
        for rest in cuts(text[n:], vocabulary, own):
            yield found + rest


@pytest.fixture(scope="module")
def own():
    return langid.lattice(PIECES)


@pytest.fixture(scope="module")
def vocabulary(own):
    from sentencepiece import SentencePieceProcessor

    m = SentencePieceProcessor(model_file=PIECES)
    return {m.id_to_piece(i): i for i in range(own.size) if not (m.is_byte(i) or m.is_control(i) or m.is_unknown(i))}


def test_forward_sums_all_segmentations(own, vocabulary):
    table = np.log(np.random.default_rng(1).dirichlet(np.ones(own.size), size=3))
    spans = own.spans(WORDS)
    got = spans.forward(spans.weights(table))[spans.last]
    for w, row in zip(WORDS, got):
        ways = list(cuts("▁" + w[:12], vocabulary, own))
        if len(w) > 12:
            continue
        want = [math.log(sum(math.exp(sum(table[k, i] for i in way)) for way in ways)) for k in range(3)]
        assert np.allclose(row, want, rtol=1e-9)


def test_expected_uses_are_shares_of_all_segmentations(spark, own, vocabulary):
    words = [("xx", "the", 3), ("xx", "漢字", 2), ("yy", "the", 1)]
    table = np.log(np.random.default_rng(2).dirichlet(np.ones(own.size), size=2))
    got = langid.expected(spark.createDataFrame(words, "lang string, word string, n long").repartition(2), PIECES, ["xx", "yy"], table)
    want = np.zeros((2, own.size))
    for lang, w, n in words:
        k = ["xx", "yy"].index(lang)
        ways = list(cuts("▁" + w, vocabulary, own))
        p = np.array([math.exp(sum(table[k, i] for i in way)) for way in ways])
        for way, share in zip(ways, p / p.sum()):
            for i in way:
                want[k, i] += n * share
    assert np.abs(got / langid.UNIT - want).max() < 1e-3


def test_very_long_words_do_not_vanish(own):
    table = np.log(np.full((1, own.size), 1 / own.size))
    spans = own.spans(["x" * 20_000, "a"])
    got = spans.forward(spans.weights(table))[spans.last]
    assert np.isfinite(got).all() and got[0, 0] < -1000


def rows():
    return [(1, "der hund und die katze spielen im garten", "de", "a"), (2, "the dog and the cat play in the garden", "en", "b"),
            (3, "der garten ist groß und schön", "de", None), (4, "the garden is large and fine", "en", "c"),
            (5, "der hund", None, "d"), (6, "the dog, the cat", None, "e"), (7, None, "de", "f"), (8, "", None, "g"),
            (9, "12 34 !? \n\t", "en", "h"), (10, "the " * 50_000, None, "i"), (None, "und der hund", None, "j"),
            (2, "the dog and the cat play in the garden", "en", "b")]


def test_defined_cases(spark):
    docs = spark.createDataFrame(rows(), "doc_id long, text string, lang string, score string").repartition(3)
    model = langid.fit(docs, PIECES)
    assert model.langs == ["de", "en"] and np.allclose(np.exp(model.table).sum(axis=1), 1)
    again = langid.fit(docs.repartition(5), PIECES)
    assert np.array_equal(model.table, again.table)
    got = {r.doc_id: r for r in docs.withColumn("p", langid.predict(spark, F.col("text"), model)).collect()}
    assert {k: r.p.lang for k, r in got.items()} == {
        1: "de", 2: "en", 3: "de", 4: "en", 5: "de", 6: "en", 7: "und", 8: "und", 9: "und", 10: "en", None: "de"}
    assert got[1].score == "a" and got[7].p.score == 0 and all(0 <= r.p.score <= 1 for r in got.values())


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    model = langid.fit(docs, PIECES)
    assert [tuple(r.p) for r in docs.select(langid.predict(spark, F.col("text"), model).alias("p")).collect()] == [("und", 0.0)]
    empty = docs.where("false")
    assert langid.fit(empty, PIECES).langs == []
    with pytest.raises(ValueError):
        langid.fit(docs.withColumn("lang", F.explode(F.array(F.lit("a"), F.lit("b")))), PIECES, max_langs=1)


def test_held_out_accuracy(spark, sf):
    from folioweave.llm.registry import QUERIES
    import folioweave.llm.queries  # noqa: F401

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = QUERIES["op12_language_id"](spark, sf).join(docs, "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert n > 10 and right >= 0.95 * n
