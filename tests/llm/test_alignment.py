"""Token alignment against all pairs of tokens of whole texts."""

from collections import Counter
from hashlib import sha256

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from folioweave.llm import alignment
from folioweave.llm.wordids import _byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "The quick brown fox. The quick brown fox", "The quick brown fox. The quick brown fox", "Überraschung, naïve façade",
    "", None, " ", "a", " a", "a ", "  two  blanks ", "line\n\nline \n x", "▁", "a ▁b", "日本語 テキスト  x", "a\x1c b", "a \x85 b",
    "<|endoftext|> <s></s><unk>", "é́ ́a", "nul\x00 byte", "x" * 3000, "don't we'll 've it's", "١٢٣ ½ ²", "　 a  b",
    "🙂🙂 🙂", "<0x0A> \n", "ab " * 2000, "aaaa aaaaa aaa aa a",
]


def plain(texts):
    a_tok, b_tok = Tokenizer.from_file(A), SentencePieceProcessor(model_file=B)
    a_tok.encode_special_tokens = True
    byte = {c: b for b, c in _byte_letters().items()}

    def spans(parts):
        at, out = 0, []
        for i, v in parts:
            out.append((i, at, at + len(v)))
            at += len(v)
        return out, b"".join(v for _, v in parts)

    rows, count = [], Counter()
    for t in texts:
        whole = b" " + (t or "").encode()
        a, joined_a = spans([(i, bytes(byte[c] for c in a_tok.id_to_token(i)))
                             for i in a_tok.encode(" " + (t or ""), add_special_tokens=False).ids])
        b, joined_b = spans([(i, bytes([int(b_tok.id_to_piece(i)[3:5], 16)]) if b_tok.is_byte(i)
                              else b_tok.id_to_piece(i).replace("▁", " ").encode()) for i in b_tok.encode(t or "")])
        if not t or joined_a != whole or joined_b != whole:
            rows.append(None)
            continue
        links = [(i, j) for i, s, e in a for j, u, v in b if s < v and u < e]
        count.update(links)
        cuts = sorted({e for _, _, e in a} & {v for _, _, v in b})
        groups, low = [], 0
        for c in cuts:
            groups.append(",".join(str(i) for i, s, e in a if low <= s and e <= c) + "|"
                          + ",".join(str(j) for j, u, v in b if low <= u and v <= c))
            low = c
        rows.append((len(a), len(b), len(groups), len(links), links, sha256(";".join(groups).encode()).hexdigest()))
    most = Counter()
    for (_, j), n in count.items():
        most[j] = max(most[j], n)
    return [(0, 0, 0, 0, 0, 0, "") if r is None else
            (*r[:4], sum(count[x] == most[x[1]] for x in r[4]), sum(count[x] for x in r[4]), r[5]) for r in rows]


@pytest.mark.parametrize("max_pairs", [alignment.MAX_PAIRS, 0])
def test_equals_all_pairs_of_tokens(spark, max_pairs):
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(TEXTS)], "doc_id long, text string, row int, pair string")
    got = alignment.align(docs.repartition(3), A, B, max_pairs=max_pairs).orderBy("doc_id")
    assert [tuple(r[1:4]) + (r.n_links, r.n_best, r.count_sum, r.groups_sha256) for r in got.collect()] == plain(TEXTS)


@pytest.mark.parametrize("max_pairs", [alignment.MAX_PAIRS, 0])
def test_null_and_repeated_ids(spark, max_pairs):
    docs = spark.createDataFrame([(None, "one text"), ("7", "one text"), ("7", "another text"), (None, None)], "doc_id string, text string")
    got = alignment.align(docs, A, B, max_pairs=max_pairs).collect()
    assert sorted((r.doc_id or "", r.n_a > 0) for r in got) == [("", False), ("", True), ("7", True), ("7", True)]


def test_empty_table(spark):
    assert alignment.align(spark.createDataFrame([], "doc_id long, text string"), A, B).collect() == []


def test_identity_has_the_same_bytes():
    own = alignment.aligner(A, B)
    at = [i for i, j in enumerate(own.identity) if j >= 0]
    assert len(at) > 5000 and all(own.a.bytes[i] == own.b.bytes[own.identity[i]] for i in at)


def test_pieces_and_small_caches_change_nothing(monkeypatch):
    own = alignment.Aligner(A, B)
    want = [own.pieces([t])[0] if t else None for t in TEXTS]
    assert own.by_word and own.texts(TEXTS) == want
    monkeypatch.setattr(alignment, "KEPT_PIECES", 2)
    monkeypatch.setattr(alignment, "PASS_CHARS", 10)
    assert [x for t in TEXTS for x in own.texts([t])] == want
