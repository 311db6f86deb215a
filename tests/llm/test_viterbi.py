"""Counts against the library's unigram model."""

import random

import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from folioweave.llm import viterbi
from folioweave.llm.queries import PIECES
from pyspark.sql import functions as F


def library(pieces, byte_fallback, unk=0):
    tok = Tokenizer(models.Unigram(pieces, unk, byte_fallback))
    tok.pre_tokenizer = pre_tokenizers.Metaspace(replacement=viterbi.MARK, prepend_scheme="always", split=True)
    return tok


TEXTS = ["", "a", " leading", "two  blanks ", "tab\tand\nline", "日本語 😀😀 x", "▁marked ▁▁ word", "<s> <unk> <0x41>", "ÀÉ ß",
         "word " * 5000, "x" * 20_000, " ", "  "]


def test_counts_equal_the_library_on_the_public_vocabulary():
    pieces = viterbi.vocabulary(PIECES)
    tok, own = library(pieces, True), viterbi.PieceCounter(pieces)
    for t in TEXTS:
        assert own.text(t) == len(tok.encode(t, add_special_tokens=False).ids), repr(t[:40])


@pytest.mark.parametrize("byte_fallback", [True, False])
def test_ties_and_unknown_characters(byte_fallback):
    rnd = random.Random(7)
    for _ in range(60):
        letters = "abc"
        pieces = {"<unk>": 0.0, viterbi.MARK: -2.0} | {
            "".join(rnd.choice(letters + viterbi.MARK) for _ in range(rnd.randint(1, 4))): -float(rnd.randint(1, 4)) for _ in range(14)}
        pieces = list(pieces.items())
        tok, own = library(pieces, byte_fallback), viterbi.PieceCounter(pieces, byte_fallback)
        for _ in range(40):
            t = "".join(rnd.choice("abcdé ") for _ in range(rnd.randint(1, 25)))
            assert own.text(t) == len(tok.encode(t, add_special_tokens=False).ids), (pieces, t)


def test_column_with_nulls_repeats_and_empty_tables(spark):
    docs = spark.createDataFrame([(1, None, 5), (2, "one two", 5), (2, "one two", 5)], "doc_id long, text string, n_tokens int")
    got = [r.n for r in docs.select(viterbi.token_count(F.col("text"), PIECES).alias("n")).collect()]
    assert got[0] == 0 and got[1] == got[2] > 0
    assert docs.where("false").select(viterbi.token_count(F.col("text"), PIECES)).count() == 0
