"""Packing: every id in exactly one piece, all limits held, little padding; token ids against the library."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from tokenizers import Tokenizer

from folioweave.llm import packing
from folioweave.llm.packing import Limits, place
from folioweave.llm.queries import WORD_BPE
from folioweave.llm.wordids import word_ids

TEXTS = ["", None, "One two, three.", "don't STOP 'til 10²½", "naïve œuvre ÀÉ×÷ß µ", "tabs\tand\x0bfeeds\x0c here", "a b",
         "é combining\nplain line", "日本語 text İstanbul", "<|endoftext|> inside <|startoftext|>", "\x1c\x1d odd", "x" * 5000,
         "word " * 30_000, "…“quoted” — dash", "''s ''re 'veve", "😀 smile\r\nnext", "­ soft​zero"]


def test_ids_equal_the_library():
    tok, own = Tokenizer.from_file(WORD_BPE), word_ids(WORD_BPE)
    assert own.by_word
    for t in TEXTS:
        want = tok.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(own.encode(t or ""), own.kind).tolist() == want


def test_ids_of_random_texts():
    rnd, tok, own = random.Random(2), Tokenizer.from_file(WORD_BPE), word_ids(WORD_BPE)
    letters = "ab Zé'ßÖ1²\n\t.,-<|>œŸΣς́ ÿ"
    for _ in range(300):
        t = "".join(rnd.choice(letters) for _ in range(rnd.randint(0, 60)))
        assert np.frombuffer(own.encode(t), own.kind).tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


@pytest.mark.parametrize("cut", [True, False])
@pytest.mark.parametrize("seed", range(6))
def test_placement_keeps_all_limits(seed, cut):
    rnd = np.random.default_rng(seed)
    limits = Limits(tokens=100, segments=int(rnd.integers(2, 9)), loss=int(rnd.integers(20, 101)))
    n = 200
    end = rnd.integers(1, 260 if cut else 90, n)
    loss_from = rnd.integers(0, end + 1)
    if not cut:
        loss_from = np.maximum(loss_from, end - limits.loss)
    got = place(np.zeros(n, np.int64), end, loss_from, limits, cut)
    pieces, bins = defaultdict(list), defaultdict(list)
    for i, s, e, b, o in got:
        assert s < e
        pieces[i].append((s, e))
        bins[b].append((o, e - s, e - max(s, int(loss_from[i])) if e > loss_from[i] else 0))
    for i in range(n):
        at = 0
        for s, e in sorted(pieces[i]):
            assert s == at
            at = e
        assert at == end[i] and (cut or len(pieces[i]) == 1)
    for rows in bins.values():
        at = 0
        for o, size, _ in sorted(rows):
            assert o == at
            at += size
        assert at <= limits.tokens and len(rows) <= limits.segments and sum(r[2] for r in rows) <= limits.loss
    assert sorted(bins) == list(range(len(bins)))


def test_oversize_example_stays_whole_without_cuts():
    got = place(np.array([0, 0]), np.array([500, 10]), np.array([0, 0]), Limits(100, 4, 100), cut=False)
    assert sorted((i, s, e) for i, s, e, _, _ in got) == [(0, 0, 500), (1, 0, 10)]
    assert len({b for *_, b, _ in got}) == 2


def test_documents_round_trip(spark):
    tok = Tokenizer.from_file(WORD_BPE)
    rows = [(i, t, "s", 0) for i, t in enumerate(TEXTS)] + [(2, TEXTS[2], "s", 0), (2, TEXTS[2], "s", 0), (None, "null id", None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, grp string, start int")
    packed = packing.digest(packing.pack_documents(docs, WORD_BPE, group_rows=8), packing.id_bytes(WORD_BPE)).collect()
    want = {i: tok.encode(t or "", add_special_tokens=False).ids + [1] for i, t, _, _ in rows}
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in packed:
        ids = want[r.doc_id][r.start:r.start + r.length]
        assert r.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and r.doc_tokens == len(want[r.doc_id])
        pieces[r.doc_id].append((r.start, r.length))
        bins[r.sequence_id].append((r.offset, r.length))
    assert sum(n for p in pieces.values() for _, n in p) == sum(len(want[i]) for i, *_ in rows)
    assert sorted(pieces[2]) == [(0, len(want[2]))] * 3
    for b in bins.values():
        at = 0
        for o, n in sorted(b):
            assert o == at
            at += n
        assert at <= 2048


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack_documents(docs, WORD_BPE).count() == 0


def test_little_padding(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = packing.digest(packing.pack_documents(docs, WORD_BPE), packing.id_bytes(WORD_BPE)).collect()
    tokens, bins = sum(r.length for r in rows), len({r.sequence_id for r in rows})
    assert bins * 2048 - tokens < 2048 + 0.01 * tokens


def test_workers_take_few_texts_at_a_time(spark):
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    was, docs = spark.conf.get(key), spark.createDataFrame([(i, f"text {i}") for i in range(20)], "doc_id long, text string")
    try:
        spark.conf.set(key, "10000")
        whole = sorted(packing.tokenize(docs, WORD_BPE).drop("copy").collect())
        assert int(spark.conf.get(key)) == packing.BATCH_ROWS
        spark.conf.set(key, "3")
        assert sorted(packing.tokenize(docs, WORD_BPE).drop("copy").collect()) == whole
        assert spark.conf.get(key) == "3"
    finally:
        spark.conf.set(key, was)
