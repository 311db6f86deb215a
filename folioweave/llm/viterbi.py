"""Token counts by a count-only Viterbi pass over a unigram vocabulary.

An Aho-Corasick automaton lists, at every place of a word, the vocabulary pieces that end there. Dynamic programming carries
the best score and the number of pieces of the best path, and never builds the path. The rules are those of the `tokenizers`
library's unigram model: scores add up as doubles from the left; a place keeps its path unless another is strictly better,
and longer pieces come first; a character that no single-character piece covers costs the lowest score minus ten; such
characters in a row count as one unknown piece, or with byte fallback as their UTF-8 bytes.

Texts are cut into words the way the library's word marker does (a marker before every word, blanks become markers), and a
worker keeps the counts of words it has seen. Defined cases: a null or empty text has no tokens; other white space is part
of a word; repeated rows are counted alike; other columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from folioweave.llm.common import ship

MARK = "▁"
UNKNOWN_PENALTY = 10.0
KEPT_WORDS = 500_000


class PieceCounter:
    def __init__(self, pieces: list[tuple[str, float]], byte_fallback: bool = True) -> None:
        import ahocorasick

        self.find = ahocorasick.Automaton()
        for piece, score in pieces:
            if piece and piece not in self.find:
                self.find.add_word(piece, (len(piece), score))
        self.find.make_automaton()
        names = {p for p, _ in pieces}
        self.bytes = byte_fallback and all(f"<0x{b:02X}>" in names for b in range(256))
        self.unknown = min(s for _, s in pieces) - UNKNOWN_PENALTY
        self.kept: dict[str, int] = {}

    def word(self, word: str) -> int:
        """Pieces on the best path of one word."""
        n = len(word)
        ends: list[list[tuple[int, float]]] = [[] for _ in range(n)]
        for end, match in self.find.iter(word):
            ends[end].append(match)
        score, count, unknown = [0.0] * (n + 1), [0] * (n + 1), [False] * (n + 1)
        for at in range(n):
            best, back, miss = None, 0, True
            for length, own in ends[at]:
                s = own + score[at + 1 - length]
                if length == 1:
                    miss = False
                if best is None or s > best:
                    best, back = s, length
            lost = False
            if miss:
                s = self.unknown + score[at]
                if best is None or s > best:
                    best, back, lost = s, 1, True
            score[at + 1], unknown[at + 1] = best, lost
            before = count[at + 1 - back]
            if not lost:
                count[at + 1] = before + 1
            elif self.bytes:
                count[at + 1] = before + len(word[at].encode())
            else:
                count[at + 1] = before + (not unknown[at])
        return count[n]

    def text(self, text: str | None) -> int:
        if not text:
            return 0
        marked = text.replace(" ", MARK)
        if marked[0] == MARK:
            marked = marked[1:]
        kept, total = self.kept, 0
        if len(kept) > KEPT_WORDS:
            kept.clear()
        for w in marked.split(MARK):
            n = kept.get(w)
            if n is None:
                n = self.word(MARK + w)
                if len(w) <= 64:
                    kept[w] = n
            total += n
        return total


def vocabulary(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a `sentencepiece` file."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), float(model.get_score(i))) for i in range(model.get_piece_size())]


@lru_cache(maxsize=2)
def counter(path: str, byte_fallback: bool = True) -> PieceCounter:
    return PieceCounter(vocabulary(path), byte_fallback)


def token_count(text: Column, path: str, byte_fallback: bool = True) -> Column:
    """Tokens of each whole text by the unigram model over the vocabulary at ``path``."""

    ship()

    @F.pandas_udf(LongType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            own = counter(path, byte_fallback)
            yield pd.Series([own.text(t) for t in texts], dtype="int64")

    return run(text)
