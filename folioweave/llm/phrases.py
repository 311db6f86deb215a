"""Phrase collocations: a trie of hash containers counts in every task, sorted runs are merged by prefix.

Every word with another after it in its piece is one entry: the two and, if there is one, the third. A task numbers the words
it meets, counts them in an array, and keeps the entries in a trie: first word, then a hash container of the rest, which bursts into one container for each second
word when it grows. When the trie is full, its largest subtrees are handed on whole, as runs sorted by their words, so that
memory is bounded and what is met often is added up early. Spark deals the runs by language and the first two words and sorts
each part, which merges the runs; one pass over a part adds up equal entries. The count of two words is the sum of the entries
that begin with them, so they are not counted apart. A third of all entries under one first word are dealt by their second
words.

Only counts from ``min_count`` on go further: no part of a candidate can be rarer than the candidate, so nothing is lost.

Defined cases: a null or empty text has no words; a null language is ``und``; repeated rows count each; a word may be of any
length; an empty table gives an empty result; other columns of the input do not count, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioweave.llm.common import settle, ship

#: Bits of a word number; three of them make one key. Number 0 stands for no word.
BITS = 21
MASK = (1 << BITS) - 1
NO_LANGUAGE = "und"
#: Bounds of what a task holds: entries of the trie, entries of a container, words and their bytes, words taken in at once.
MAX_ENTRIES = 700_000
BURST = 4096
MAX_WORDS = 500_000
MAX_WORD_BYTES = 48 << 20
CHUNK_BYTES = 2 << 20
#: Bytes of words in one batch of rows that a task hands on.
ROW_BYTES = 8 << 20
#: Ends of pieces become a byte that no text has; tabs become blanks; A to Z become small letters.
BREAK = b"\xff"
PLAIN = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\n\x0b\x0c\r\t", b"abcdefghijklmnopqrstuvwxyz" + BREAK * 10 + b" ")
COUNTS = "lang string, prefix string, last string, n long"
SCHEMA = pa.schema([("lang", pa.string()), ("prefix", pa.string()), ("last", pa.string()), ("n", pa.int64())])


class Words(dict):
    """Numbers of words, from 1 on in the order in which they are met."""

    def __init__(self) -> None:
        self.seen: list[bytes] = [b""]
        self.bytes = 0
        self[BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = at = len(self.seen)
        self.seen.append(word)
        self.bytes += len(word)
        return at


class PhraseTrie:
    """Counts of entries (first, second, third word) of one language."""

    def __init__(self, burst: int = BURST) -> None:
        self.tops: dict[int, dict] = {}
        self.open: set[int] = set()  # first words whose container has burst
        self.size: dict[int, int] = {}
        self.entries = 0
        self.burst = burst

    @staticmethod
    def _add(box: dict, keys: list[int], counts: list[int]) -> None:
        get = box.get
        for k, c in zip(keys, counts):
            box[k] = get(k, 0) + c

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        """Add sorted distinct keys."""
        first = keys >> (2 * BITS)
        cut = np.flatnonzero(np.diff(first)) + 1
        starts = np.concatenate([[0], cut]).tolist()
        ends = np.concatenate([cut, [len(keys)]]).tolist()
        rest, n = (keys & ((1 << 2 * BITS) - 1)).tolist(), counts.tolist()
        for word, a, b in zip(first[starts].tolist(), starts, ends):
            box = self.tops.get(word)
            if box is None:
                self.tops[word] = dict(zip(rest[a:b], n[a:b]))
                grown = b - a
            elif word in self.open:
                grown = 0
                for k, c in zip(rest[a:b], n[a:b]):
                    below = box.setdefault(k >> BITS, {})
                    before = len(below)
                    below[k & MASK] = below.get(k & MASK, 0) + c
                    grown += len(below) - before
            else:
                before = len(box)
                self._add(box, rest[a:b], n[a:b])
                grown = len(box) - before
                if len(box) > self.burst:
                    self._burst(word, box)
            self.size[word] = self.size.get(word, 0) + grown
            self.entries += grown

    def _burst(self, word: int, box: dict) -> None:
        node: dict[int, dict] = {}
        for k, c in box.items():
            node.setdefault(k >> BITS, {})[k & MASK] = c
        self.tops[word] = node
        self.open.add(word)

    def take(self, leave: int) -> tuple[np.ndarray, np.ndarray]:
        """Remove the largest subtrees until ``leave`` entries are left; their keys and counts."""
        rest, counts, bases, sizes = [], [], [], []
        for word in sorted(self.size, key=self.size.__getitem__, reverse=True):
            if self.entries <= leave:
                break
            box = self.tops.pop(word)
            top = word << (2 * BITS)
            for base, own in [(top + (k << BITS), below) for k, below in box.items()] if word in self.open else [(top, box)]:
                rest += own
                counts += own.values()
                bases.append(base)
                sizes.append(len(own))
            self.open.discard(word)
            self.entries -= self.size.pop(word)
        return (np.repeat(np.array(bases, np.int64), np.array(sizes, np.int64)) + np.array(rest, np.int64),
                np.array(counts, np.int64))


def entries(ids: np.ndarray) -> np.ndarray:
    """One key for each word that another follows before the next break (number 0): the two, and the word after them."""
    padded = np.concatenate([ids, [0, 0]])
    one, two, three = padded[:-2], padded[1:-1], padded[2:]
    third = np.where(two == 0, 0, three)
    return ((one << (2 * BITS)) + (two << BITS) + third)[(one > 0) & (two > 0)]


def run_rows(lang: str, keys: np.ndarray, counts: np.ndarray, words: list[bytes]) -> Iterator[pa.RecordBatch]:
    """A sorted run of entries as rows."""
    ids, place = np.unique(np.concatenate([[0], keys >> (2 * BITS), (keys >> BITS) & MASK, keys & MASK]), return_inverse=True)
    own = [words[i] for i in ids.tolist()]
    order = sorted(range(len(own)), key=own.__getitem__)
    rank = np.empty(len(own), np.int64)
    rank[order] = np.arange(len(own))
    one, two, three = rank[place[1:]].reshape(3, -1)
    at = np.argsort((one << (2 * BITS)) + (two << BITS) + three, kind="stable")
    one, two, three, counts = one[at], two[at], three[at], counts[at]
    text = pa.array([own[i] for i in order], pa.binary()).cast(pa.string())
    length = np.array([len(own[i]) for i in order], np.int64)

    def spell(r: np.ndarray) -> pa.Array:
        return text.take(pa.array(r, mask=r == 0))

    for c in cuts(length[one] + length[two] + length[three]):
        prefix = pc.binary_join_element_wise(spell(one[c]), spell(two[c]), " ")
        yield _batch(lang, prefix, spell(three[c]), counts[c])


def cuts(size: np.ndarray) -> Iterator[slice]:
    """Ranges of rows of so many bytes, to be handed on together."""
    edge = np.flatnonzero(np.diff(np.cumsum(size + 64) // ROW_BYTES)) + 1
    for a, b in zip([0, *edge.tolist()], [*edge.tolist(), len(size)]):
        yield slice(a, b)


def word_rows(lang: str, counts: np.ndarray, words: list[bytes]) -> Iterator[pa.RecordBatch]:
    """The counts of single words as rows, sorted."""
    at = sorted(np.flatnonzero(counts).tolist(), key=words.__getitem__)
    own = [words[i] for i in at]
    for c in cuts(np.array([len(w) for w in own], np.int64)):
        text = pa.array(own[c], pa.binary()).cast(pa.string())
        yield _batch(lang, text, pa.nulls(len(text), pa.string()), counts[at[c]])


def _batch(lang: str, prefix: pa.Array, last: pa.Array, n) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([lang] * len(prefix), pa.string()), prefix, last, pa.array(n, pa.int64())], ["lang", "prefix", "last", "n"])


def _count(max_entries: int, burst: int):
    def chunks(batch: pa.RecordBatch) -> Iterator[tuple[str, bytes]]:
        by_lang: dict[str, list[bytes]] = {}
        held = 0
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            by_lang.setdefault(lang, []).append(text.encode())
            held += len(by_lang[lang][-1])
            if held > CHUNK_BYTES:
                yield from ((k, BREAK.join(v)) for k, v in by_lang.items())
                by_lang, held = {}, 0
        yield from ((k, BREAK.join(v)) for k, v in by_lang.items())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, tuple[Words, PhraseTrie]] = {}
        single: dict[str, np.ndarray] = {}

        def held() -> int:
            return sum(t.entries for _, t in seen.values())

        def spill(leave: int) -> Iterator[pa.RecordBatch]:
            whole = max(1, held())
            for lang, (words, trie) in seen.items():
                keys, counts = trie.take(leave * trie.entries // whole)
                if len(keys):
                    yield from run_rows(lang, keys, counts, words.seen)

        def finish() -> Iterator[pa.RecordBatch]:
            yield from spill(0)
            for lang, counts in single.items():
                yield from word_rows(lang, counts, seen[lang][0].seen)
                yield _batch(lang, pa.array([""], pa.string()), pa.nulls(1, pa.string()), [int(counts.sum())])
            seen.clear()
            single.clear()

        for batch in batches:
            for lang, body in chunks(batch):
                words, trie = seen.setdefault(lang, (Words(), PhraseTrie(burst)))
                tokens = body.translate(PLAIN).replace(BREAK, b" " + BREAK + b" ").split()
                ids = np.fromiter(map(words.__getitem__, tokens), np.int64, len(tokens))
                uses = np.bincount(ids, minlength=len(words.seen))
                uses[0] = 0
                if lang in single:
                    uses[:len(single[lang])] += single[lang]
                single[lang] = uses
                keys, n = np.unique(entries(ids), return_counts=True)
                if len(keys):
                    trie.add(keys, n)
                if held() > max_entries:
                    yield from spill(max_entries // 2)
                if sum(len(w) for w, _ in seen.values()) > MAX_WORDS or sum(w.bytes for w, _ in seen.values()) > MAX_WORD_BYTES:
                    yield from finish()
        yield from finish()

    return run


def _changes(col: pa.Array) -> np.ndarray:
    """Where a value differs from the one before; null equals null."""
    a, b = col.slice(1), col.slice(0, len(col) - 1)
    same = pc.fill_null(pc.equal(a, b), False).to_numpy(zero_copy_only=False)
    nulls = pc.and_(pc.is_null(a), pc.is_null(b)).to_numpy(zero_copy_only=False)
    return np.concatenate([[True], ~(same | nulls)])


def _merge(min_count: int):
    """Sums of equal entries and of equal prefixes, in one pass over sorted rows.

    What is still open at the end of a batch goes before the next one as two rows: the last entry's sum, and what else its
    prefix has.
    """
    names = ["lang", "prefix", "last", "n"]

    def sums(t: pa.Table, end: bool) -> tuple[list[pa.RecordBatch], pa.Table | None]:
        lang, prefix, last = (t.column(c).combine_chunks() for c in names[:3])
        n, rest = t.column("n").to_numpy(), None
        fresh_prefix = _changes(prefix) | _changes(lang)
        two = np.flatnonzero(fresh_prefix)
        three = np.flatnonzero(fresh_prefix | _changes(last))
        sum2, sum3 = np.add.reduceat(n, two), np.add.reduceat(n, three)
        if not end:
            f3 = int(sum3[-1])
            rest = pa.table([pa.array([c[-1].as_py()] * 2, pa.string()) for c in (lang, prefix)]
                            + [pa.array([None, last[-1].as_py()], pa.string()), pa.array([int(sum2[-1]) - f3, f3], pa.int64())], names)
            two, sum2, three, sum3 = two[:-1], sum2[:-1], three[:-1], sum3[:-1]
        whole = pc.equal(prefix, "").to_numpy(zero_copy_only=False)
        third = pc.is_valid(last).to_numpy(zero_copy_only=False)
        out = []
        for at, f, shown in ((two, sum2, (sum2 >= min_count) | whole[two]), (three, sum3, third[three] & (sum3 >= min_count))):
            at, f = pa.array(at[shown]), pa.array(f[shown])
            more = last.take(at) if out else pa.nulls(len(at), pa.string())
            out.append(pa.RecordBatch.from_arrays([lang.take(at), prefix.take(at), more, f], names))
        return out, rest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None
        for batch in batches:
            if batch.num_rows:
                now = pa.Table.from_batches([batch]).select(names)
                now = pa.Table.from_arrays([c.cast(f) for c, f in zip(now.columns, SCHEMA.types)], schema=SCHEMA)
                got, rest = sums(now if rest is None else pa.concat_tables([rest, now]), False)
                yield from got
        if rest is not None:
            yield from sums(rest, True)[0]

    return run


def phrase_counts(docs: DataFrame, text: str = "text", lang: str = "lang", *, min_count: int = 10,
                  max_entries: int = MAX_ENTRIES, burst: int = BURST) -> DataFrame:
    """``lang, prefix, last, n`` for every phrase of one to three words with ``n >= min_count`` occurrences.

    ``prefix`` is the first word or two, ``last`` the third (null without one). The row of a language with an empty prefix
    has the number of all its words.
    """
    ship()
    rows = docs.select(F.coalesce(F.col(lang), F.lit(NO_LANGUAGE)).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    runs = rows.mapInArrow(_count(max_entries, burst), COUNTS)
    dealt = runs.repartition("lang", "prefix").sortWithinPartitions("prefix", "lang", "last")
    return dealt.mapInArrow(_merge(min_count), COUNTS)


def whole_score(a: str, l: str, r: str) -> str:
    """SQL for floor(1000000 * a * a / (l * r)) in whole numbers of up to 38 digits."""
    big = "CAST({} AS DECIMAL(15, 0))".format
    return f"CAST((CAST(1000000 AS DECIMAL(7, 0)) * ({big(a)} * {big(a)})) DIV ({big(l)} * {big(r)}) AS BIGINT)"


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", *, min_count: int = 10, inside_pct: int = 50,
                 top: int = 2000, max_entries: int = MAX_ENTRIES, burst: int = BURST) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the ``top`` phrases of two and three words of each language.

    A phrase's score is that of its lowest-scoring cut, the earliest of equals. A phrase goes if a longer one of
    ``min_count`` occurrences around it has ``inside_pct`` % of its occurrences or more.
    """
    counted = settle(phrase_counts(docs, text, lang, min_count=min_count, max_entries=max_entries, burst=burst), "phrase-counts")
    known = counted.where("prefix <> ''").select("lang", F.concat_ws(" ", "prefix", "last").alias("phrase"), "n")
    word = F.split("phrase", " ")
    size = F.size(word)
    phrases = known.where(size >= 2).withColumn("word", word)
    w = [F.get("word", F.lit(i)) for i in range(3)]
    three = F.size("word") == 3
    tail = F.concat_ws(" ", w[1], w[2])
    parts = F.array_compact(F.array(
        F.struct(F.lit(1).alias("k"), w[0].alias("head"), tail.alias("rest")),
        F.when(three, F.struct(F.lit(2).alias("k"), F.concat_ws(" ", w[0], w[1]).alias("head"), w[2].alias("rest")))))
    cut = phrases.select("lang", "phrase", F.col("n").alias("a"), F.inline(parts))
    left = known.select(F.col("lang").alias("lang_l"), F.col("phrase").alias("head"), F.col("n").alias("l"))
    right = known.select(F.col("lang").alias("lang_r"), F.col("phrase").alias("rest"), F.col("n").alias("r"))
    scored = (cut.join(left, (F.col("lang") == F.col("lang_l")) & (cut["head"] == left["head"])).drop(left["head"])
              .join(right, (F.col("lang") == F.col("lang_r")) & (cut["rest"] == right["rest"])).drop(right["rest"])
              .withColumn("score", F.expr(whole_score("a", "l", "r"))))
    best = (scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("b"))
            .select("lang", "phrase", "a", "b.score", "b.l", "b.r"))
    around = (phrases.where(three).select(
        "lang", "n", F.explode(F.array(F.concat_ws(" ", w[0], w[1]), tail)).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("n").alias("longer")))
    kept = best.join(around, ["lang", "phrase"], "left").where(
        F.coalesce(100 * F.col("longer") < inside_pct * F.col("a"), F.lit(True)))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    first = kept.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = counted.where("prefix = ''").select("lang", F.col("n").alias("total"))
    return first.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("total").alias("n"), "score")
