"""Language of a text by unigram models over a fixed vocabulary, summed over all segmentations.

Each language gives every piece of a public vocabulary a probability. A word's probability in a language is the sum over all
ways to cut it into pieces, which a forward pass adds up; a text's is the product over its words. The language with the highest
posterior is predicted, and that posterior is the score.

Learning counts words by language in Spark, then takes expectation steps over the counted words: forward and backward passes
share a word's count out over the pieces of all its segmentations, first with equal piece probabilities, then with those of the
language. The shares are whole numbers of 1/65536, so sums do not depend on their order and reruns agree. A language's
probabilities lean on those of all languages with the weight of ``prior`` pieces. What the driver and the workers hold is one
number for each piece and language.

A word is a run of letters (and marks after the first) in lower case; other characters tell nothing. A character that is no
piece itself is spelled in byte pieces.

Defined cases: a null text, and one without a letter, is ``und`` with score 0, as is every text if nothing could be learned;
ties go to the smallest name; rows with a null language teach nothing; repeated rows count and are scored alike; words and
texts of any length are taken whole; other columns of the input pass through ``predict`` and do not count in ``fit``.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioweave.llm.common import settle, ship
from folioweave.llm.toxicity import held_out

MARK = "▁"
UNKNOWN = "und"
UNIT = 1 << 16
#: Bounds of what a task holds: distinct blank-separated strings while counting, bytes of scored ones, words of one pass.
MAX_STRINGS = 300_000
MAX_STRING_BYTES = 48 << 20
SCORE_BYTES = 24 << 20
PASS_CHARS = 100_000
#: Words of up to so many characters are summed as products, others as logarithms.
PLAIN_LETTERS, LIFT = 40, 4.0
#: Texts and characters of texts that are scored together.
PART, PART_CHARS = 256, 2 << 20


@lru_cache(maxsize=1)
def _letters():
    import regex

    return regex.compile(r"\p{L}[\p{L}\p{M}]*").findall


class Lattice:
    """All segmentations of words into the pieces of a `sentencepiece` file."""

    def __init__(self, path: str) -> None:
        import ahocorasick
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.size = model.get_piece_size()
        self.find = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.single, self.byte = set(), [-1] * 256
        for i in range(self.size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte[int(piece[3:5], 16)] = i
            elif not (model.is_control(i) or model.is_unknown(i)):
                self.find.add_word(piece, len(piece) * self.size + i)
                if len(piece) == 1:
                    self.single.add(piece)
        self.find.make_automaton()

    def spans(self, words: list[str]) -> Spans:
        """Every piece found in the words, each with a marker before it."""
        joined = "\n".join([MARK + w for w in words]) + "\n"
        size = np.array([len(w) + 2 for w in words], np.int64)
        found = np.fromiter(chain.from_iterable(self.find.iter(joined)), np.int64).reshape(-1, 2)
        end, length, piece = found[:, 0] + 1, found[:, 1] // self.size, found[:, 1] % self.size
        spelled: list[list[int]] = []
        odd = set(joined) - self.single - {"\n"}
        if odd:
            number = {c: self.size + k for k, c in enumerate(sorted(odd))}
            spelled = [[self.byte[b] for b in c.encode()] for c in sorted(odd)]
            at = [(i + 1, number[c]) for i, c in enumerate(joined) if c in odd]
            extra = np.array(at, np.int64).reshape(-1, 2)
            end, piece = np.concatenate([end, extra[:, 0]]), np.concatenate([piece, extra[:, 1]])
            length = np.concatenate([length, np.ones(len(extra), np.int64)])
        first = np.cumsum(size) - size
        word = np.repeat(np.arange(len(words)), size)[end - 1]
        return Spans(first, first + size - 1, end - length, end, piece, word, end - first[word], spelled)


@dataclass
class Spans:
    """Pieces in words: places count from the start of all words, which stand one after another."""

    first: np.ndarray
    last: np.ndarray
    start: np.ndarray
    end: np.ndarray
    piece: np.ndarray
    word: np.ndarray
    depth: np.ndarray
    spelled: list[list[int]]

    def weights(self, table: np.ndarray) -> np.ndarray:
        """Log weight of each piece in each language; what is spelled in bytes has their product. ``table``: language, piece."""
        if not self.spelled:
            return table[:, self.piece].T
        more = np.stack([table[:, b].sum(axis=1) for b in self.spelled], axis=1)
        return np.concatenate([table, more], axis=1)[:, self.piece].T

    def forward(self, weight: np.ndarray) -> np.ndarray:
        """Log of the summed products up to every place."""
        return self._sweep(weight, self.first, self.start, self.end, self.depth)

    def backward(self, weight: np.ndarray) -> np.ndarray:
        """Log of the summed products from every place on."""
        return self._sweep(weight, self.last, self.end, self.start, self.last[self.word] - self.start)

    def _sweep(self, weight: np.ndarray, origin: np.ndarray, near: np.ndarray, far: np.ndarray, depth: np.ndarray) -> np.ndarray:
        order = np.argsort(depth * (int(self.last[-1]) + 1) + far)
        near, far, depth, weight = near[order], far[order], depth[order], weight[order]
        groups = np.flatnonzero(np.diff(far, prepend=-1))
        turns = np.searchsorted(depth, np.arange(1, int(depth[-1]) + 2))
        cut = np.searchsorted(groups, turns)
        steps = [(a, b, groups[x:y]) for a, b, x, y in zip(turns[:-1], turns[1:], cut[:-1], cut[1:]) if a < b]
        if len(turns) <= PLAIN_LETTERS:
            # products themselves, lifted by a constant for each character so that they stay in range
            out = np.zeros((int(self.last[-1]) + 1, weight.shape[1]))
            out[origin] = 1.0
            lift = np.exp(weight + LIFT * np.abs(far - near)[:, None])
            for a, b, at in steps:
                out[far[at]] = np.add.reduceat(out[near[a:b]] * lift[a:b], at - a, axis=0)
            if out.min() > 0 and np.isfinite(out).all():
                place = np.arange(len(out))
                return np.log(out) - LIFT * np.abs(place - np.repeat(origin, self.last - self.first + 1))[:, None]
        out = np.full((int(self.last[-1]) + 1, weight.shape[1]), -np.inf)
        out[origin] = 0.0
        for a, b, at in steps:
            out[far[at]] = np.logaddexp.reduceat(out[near[a:b]] + weight[a:b], at - a, axis=0)
        return out


@lru_cache(maxsize=2)
def lattice(path: str) -> Lattice:
    return Lattice(path)


@dataclass
class Model:
    """``table``: log probability by language and piece; ``prior``: log share of the languages, in the order of ``langs``."""

    path: str
    langs: list[str]
    table: np.ndarray
    prior: np.ndarray


def word_counts(docs: DataFrame, lang: str = "lang", text: str = "text") -> DataFrame:
    """``lang, word, n`` over whole texts. Tasks add up before they hand on."""
    ship()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Counter] = {}
        held = 0

        def spill() -> Iterator[pa.RecordBatch]:
            letters = _letters()
            for name, strings in seen.items():
                words: Counter = Counter()
                for s, n in strings.items():
                    for w in letters(s.lower()):
                        words[w] += n
                rows = sorted(words.items())
                for at in range(0, len(rows), 20_000):
                    part = rows[at:at + 20_000]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([name] * len(part)), pa.array([w for w, _ in part]), pa.array([n for _, n in part], pa.int64())],
                        ["lang", "word", "n"])
            seen.clear()

        for batch in batches:
            for name, body in zip(batch.column("lang"), batch.column("text")):
                whole = body.as_py() or ""
                own = seen.setdefault(name.as_py(), Counter())
                own.update(whole.split())
                held += len(whole)
                if held > MAX_STRING_BYTES or len(own) > MAX_STRINGS:
                    if sum(map(len, seen.values())) > MAX_STRINGS or sum(len(s) for c in seen.values() for s in c) > MAX_STRING_BYTES:
                        yield from spill()
                    held = 0
        yield from spill()

    counted = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text")).mapInArrow(run, "lang string, word string, n long")
    return counted.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def expected(counts: DataFrame, path: str, langs: list[str], table: np.ndarray | None) -> np.ndarray:
    """Expected uses of every piece in every language, in units: language, piece. Equal weights without a ``table``."""
    ship()
    place = {name: i for i, name in enumerate(langs)}
    given = counts.sparkSession.sparkContext.broadcast(table)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = lattice(path)
        weight = given.value if given.value is not None else np.full((len(langs), own.size), -np.log(own.size))
        uses = np.zeros((len(langs), own.size), np.int64)
        for batch in batches:
            words, n = batch.column("word").to_pylist(), batch.column("n").to_numpy()
            of = np.array([place[x] for x in batch.column("lang").to_pylist()], np.int64)
            for some in passes(words):
                spans = own.spans([words[i] for i in some.tolist()])
                mine = of[some][spans.word]
                w = spans.weights(weight)[np.arange(len(mine)), mine][:, None]
                fore, back = spans.forward(w), spans.backward(w)
                share = np.exp(fore[spans.start] + w + back[spans.end] - fore[spans.last][spans.word])[:, 0]
                units = np.rint(share * UNIT).astype(np.int64) * n[some][spans.word]
                plain = spans.piece < own.size
                np.add.at(uses, (mine[plain], spans.piece[plain]), units[plain])
                for i in np.flatnonzero(~plain).tolist():
                    np.add.at(uses, (mine[i], spans.spelled[spans.piece[i] - own.size]), units[i])
        lang, piece = np.nonzero(uses)
        yield pa.RecordBatch.from_arrays(
            [pa.array(x, pa.int64()) for x in (lang, piece, uses[lang, piece])], ["lang", "piece", "units"])

    rows = (counts.mapInArrow(run, "lang long, piece long, units long").groupBy("lang", "piece")
            .agg(F.sum("units").alias("units")).toArrow())
    out = np.zeros((len(langs), lattice(path).size), np.int64)
    out[rows.column("lang").to_numpy(), rows.column("piece").to_numpy()] = rows.column("units").to_numpy()
    return out


def passes(words: list[str]) -> Iterator[np.ndarray]:
    """Words, by their places, whose characters together are bounded; long words are kept apart from short ones."""
    size = np.array([len(w) + 2 for w in words], np.int64)
    for part in (np.flatnonzero(size <= PLAIN_LETTERS), np.flatnonzero(size > PLAIN_LETTERS)):
        if len(part):
            yield from np.split(part, np.flatnonzero(np.diff(np.cumsum(size[part]) // PASS_CHARS)) + 1)


def fit(docs: DataFrame, path: str, lang: str = "lang", text: str = "text", *, rounds: int = 2, prior: float = 100.0,
        max_langs: int = 1000) -> Model:
    """Learn from all rows of ``docs`` that have a language. More than ``max_langs`` of them are refused: such a column does
    not hold languages."""
    known = docs.where(F.col(lang).isNotNull())
    found = known.groupBy(F.col(lang).alias("lang")).agg(F.count("*").alias("n")).orderBy("lang").limit(max_langs + 1).collect()
    if len(found) > max_langs:
        raise ValueError(f"more than {max_langs} languages")
    langs, size = [r["lang"] for r in found], lattice(path).size
    if not langs:
        return Model(path, [], np.zeros((0, size)), np.zeros(0))
    counts = settle(word_counts(known, lang, text), "language-words")
    table = None
    for _ in range(rounds):
        uses = expected(counts, path, langs, table) / UNIT
        every = (uses.sum(axis=0) + 1) / (uses.sum() + size)
        table = np.log((uses + prior * every) / (uses.sum(axis=1, keepdims=True) + prior))
    docs_of = np.array([r["n"] for r in found], float)
    return Model(path, langs, table, np.log(docs_of / docs_of.sum()))


class Rows(dict):
    """Row numbers of strings; those not met before are listed."""

    def __init__(self) -> None:
        self.new: list[str] = []

    def __missing__(self, string: str) -> int:
        self[string] = at = len(self)
        self.new.append(string)
        return at

    def of(self, strings: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, strings), np.int64, len(strings))


class Scorer:
    """Log probabilities of texts, with what is known about words and blank-separated strings."""

    def __init__(self, model: Model) -> None:
        self.model, self.lattice = model, lattice(model.path)
        self.most = max(1000, SCORE_BYTES // (8 * len(model.langs)))
        self._forget()

    def _forget(self) -> None:
        self.words, self.strings = Rows(), Rows()
        self.word_value = np.zeros((0, len(self.model.langs)))
        self.value, self.lettered = self.word_value, np.zeros(0, bool)

    def word_values(self, words: list[str]) -> np.ndarray:
        """Log probability of every word in every language."""
        out = np.zeros((len(words), len(self.model.langs)))
        for some in passes(words):
            spans = self.lattice.spans([words[i] for i in some.tolist()])
            out[some] = spans.forward(spans.weights(self.model.table))[spans.last]
        return out

    def learn(self, strings: list[str]) -> None:
        """Sums over the words of strings that were not met before."""
        letters = _letters()
        parts = [letters(s.lower()) for s in strings]
        size = np.array([len(p) for p in parts], np.int64)
        at = self.words.of([w for p in parts for w in p])
        if self.words.new:
            self.word_value = np.concatenate([self.word_value, self.word_values(self.words.new)])
            self.words.new = []
        new = np.zeros((len(strings), len(self.model.langs)))
        np.add.at(new, np.repeat(np.arange(len(strings)), size), self.word_value[at])
        self.value, self.lettered = np.concatenate([self.value, new]), np.concatenate([self.lettered, size > 0])

    def texts(self, texts: list[str | None]) -> Iterator[tuple[str, float]]:
        if max(len(self.strings), len(self.words)) > self.most:
            self._forget()
        rows = [self.strings.of((t or "").split()) for t in texts]
        if self.strings.new:
            self.learn(self.strings.new)
            self.strings.new = []
        for at in rows:
            if not self.lettered[at].any():
                yield UNKNOWN, 0.0
                continue
            z = self.model.prior + self.value[at].sum(axis=0)
            best = int(np.argmax(z))
            yield self.model.langs[best], float(1 / np.exp(z - z[best]).sum())


def predict(spark: SparkSession, text: Column, model: Model) -> Column:
    """Struct of the predicted language ``lang`` and its posterior ``score``, for whole texts."""
    if not model.langs:
        return F.struct(F.lit(UNKNOWN).alias("lang"), F.lit(0.0).alias("score"))
    ship()
    given = spark.sparkContext.broadcast(model)

    @F.pandas_udf("lang string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Scorer(given.value)
        for texts in batches:
            got, part, chars = [], [], 0
            for t in texts.tolist():
                part.append(t)
                chars += len(t or "")
                if len(part) >= PART or chars >= PART_CHARS:
                    got += own.texts(part)
                    part, chars = [], 0
            yield pd.DataFrame([*got, *own.texts(part)], columns=["lang", "score"])

    return run(text)
