"""Alignment of two tokenizers: tokens of the same texts side by side, grouped where both end, pairs counted over all texts.

A (a byte-level BPE of the `tokenizers` library) and B (a `sentencepiece` model) cut the same bytes. Places where a token of
both ends cut the tokens into groups; two tokens are linked if their bytes overlap. An array from every A id to the B id of
the same bytes is the fast path: a group of one A token and that B token needs no pair, it is one more count in a vector as
long as A's vocabulary. Only the links of other groups are counted as pairs, pre-aggregated in tasks and shuffled by pair.

Neither tokenizer joins across a single blank between two other characters, which both see as the start of a word. Texts are
cut there, and a task keeps what it found out about short pieces. Where a tokenizer's file does not promise that, or a piece
is long, the whole goes through the library.

Pair counts are looked up in sorted arrays that every worker is given, if there are at most ``max_pairs``; if there are more,
the links of each text are joined with the counts. Both give the same rows.

Defined cases: a text that is null or empty, or that either tokenizer does not give back byte by byte, has no tokens: zeros and
an empty digest; repeated rows count each and stay; the id may be of any type, null and repeated; an empty table gives an empty
result; other columns of the input are not carried, whatever their names.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioweave.llm.common import settle, ship
from folioweave.llm.wordids import _byte_letters

#: Pairs that workers are given as arrays, 17 bytes each.
MAX_PAIRS = 4_000_000
#: A pair is one number: A's id times this, plus B's id.
SIDE = 1 << 32
KEPT_PIECES = 180_000
LONGEST_KEPT = 200
#: Characters of pieces that are aligned at once; texts and characters of texts whose pieces are looked up together.
PASS_CHARS = 50_000
TEXTS, TEXT_CHARS = 256, 2 << 20
#: Rows and bytes of one batch that a task hands on.
ROWS, ROW_BYTES = 2048, 16 << 20
BORDER = re.compile(r"(?<=\S) (?=\S)")
ODD_BLANKS = re.compile(r"\s\s|^\s|\s$")
#: The cut of texts into words that byte-level files without a pattern of their own use (a fixed value).
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class ByteTokens:
    """A: ids and token bytes of a byte-level file."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        byte = {c: b for b, c in _byte_letters().items()}
        self.size = self.whole.get_vocab_size(with_added_tokens=True)
        self.bytes: list[bytes] = [b""] * self.size
        for token, i in self.whole.get_vocab(with_added_tokens=True).items():
            self.bytes[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
        pre = spec.get("pre_tokenizer") or {}
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"].get("merges", [])]
        vocab = spec["model"].get("vocab", {})
        by_rank = [vocab.get("".join(m)) for m in merges] == list(range(256, 256 + len(merges)))
        self.by_word = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
                        and spec.get("normalizer") is None)
        self.fast = None
        if self.by_word and by_rank:
            import tiktoken

            ranks = {self.bytes[i]: i for i in range(256 + len(merges))}
            self.fast = tiktoken.Encoding("a", pat_str=WORD_PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary

    def ids(self, text: str, short: bool = False) -> list[int]:
        """``short``: no blank-separated part is long."""
        if self.fast is not None and (short or len(text) <= LONGEST_KEPT):
            return self.fast(text)
        return self.whole.encode(text, add_special_tokens=False).ids


class PieceTokens:
    """B: ids and piece bytes of a `sentencepiece` model. It puts a blank before the text itself."""

    def __init__(self, path: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=path)
        self.size = self.model.get_piece_size()
        names = [self.model.id_to_piece(i) for i in range(self.size)]
        self.bytes = [bytes([int(p[3:5], 16)]) if self.model.is_byte(i) else p.replace("▁", " ").encode()
                      for i, p in enumerate(names)]
        plain = [p for i, p in enumerate(names) if not (self.model.is_control(i) or self.model.is_unknown(i))]
        probe = "a  b \n ①ﬁ "
        self.by_word = (not any(re.search("[^▁]▁", p) for p in plain)
                        and b"".join(self.bytes[i] for i in self.model.encode(probe)) == b" " + probe.encode())

    def ids(self, text: str) -> list[int]:
        return self.model.encode(text)


#: What a piece is known by: ``n_a, n_b, groups, links, spelled groups, regular A ids, other links``.
Piece = tuple[int, int, int, int, str, bytes, bytes]


class Aligner:
    """What two tokenizers make of texts, piece by piece."""

    def __init__(self, a_path: str, b_path: str) -> None:
        self.a, self.b = ByteTokens(a_path), PieceTokens(b_path)
        same = {v: i for i, v in reversed(list(enumerate(self.b.bytes))) if v and not self.b.model.is_byte(i)}
        same |= {v: i for i, v in enumerate(self.b.bytes) if v not in same and self.b.model.is_byte(i)}
        #: For every A id the B id of the same bytes, or -1.
        self.identity = np.array([same.get(v, -1) if v else -1 for v in self.a.bytes], np.int64)
        self.size_a, self.size_b = (np.array([len(v) for v in t.bytes], np.int64) for t in (self.a, self.b))
        self.spell = {(t, end): np.array([f"{i}{end}" for i in range(size)], object)
                      for t, size in (("a", self.a.size), ("b", self.b.size)) for end in ",|;"}
        self.by_word = self.a.by_word and self.b.by_word
        self.kept: dict[str, Piece | None] = {}
        self.older: dict[str, Piece | None] = {}

    def pieces(self, bodies: list[str]) -> list[Piece | None]:
        """Each body with a blank before it, aligned in one go; None where a tokenizer does not give it back.

        Several bodies must neither begin nor end with white space, nor be empty.
        """
        text = " ".join(bodies)
        whole = b" " + text.encode()
        a, b = self.a.ids(" " + text, len(bodies) > 1), self.b.ids(text)
        if b"".join(map(self.a.bytes.__getitem__, a)) != whole or b"".join(map(self.b.bytes.__getitem__, b)) != whole:
            half = len(bodies) // 2
            return [*self.pieces(bodies[:half]), *self.pieces(bodies[half:])] if half else [None]
        a, b = np.array(a, np.int64), np.array(b, np.int64)
        end_a, end_b = np.cumsum(self.size_a[a]), np.cumsum(self.size_b[b])
        border = np.cumsum([len(x.encode()) + 1 for x in bodies])
        cut = np.intersect1d(end_a, end_b, assume_unique=True)
        link = np.union1d(end_a, end_b)  # a link ends wherever a token of either ends
        link_a, link_b = a[np.searchsorted(end_a, link)], b[np.searchsorted(end_b, link)]
        group = np.searchsorted(cut, link)
        regular = (np.bincount(group) == 1)[group] & (self.identity[link_a] == link_b)
        other = (link_a * SIDE + link_b)[~regular].astype("<i8").tobytes()
        plain = link_a[regular].astype("<i4").tobytes()
        group_a, group_b = np.searchsorted(cut, end_a), np.searchsorted(cut, end_b)
        said = np.empty(len(a) + len(b), object)
        said[np.arange(len(a)) + np.searchsorted(group_b, group_a)] = np.where(
            end_a == cut[group_a], self.spell["a", "|"][a], self.spell["a", ","][a])
        said[np.arange(len(b)) + np.searchsorted(group_a, group_b, "right")] = np.where(
            end_b == cut[group_b], self.spell["b", ";"][b], self.spell["b", ","][b])
        said = said.tolist()
        upto = [np.searchsorted(x, border, "right") for x in (end_a, end_b, cut, link)]
        plain_upto = np.concatenate([[0], np.cumsum(regular)])[upto[3]]
        rows = np.stack([*upto, plain_upto], axis=1)
        sizes = np.diff(rows, axis=0, prepend=0).tolist()
        out, na, nr, no = [], 0, 0, 0
        for x, y, g, n, r in sizes:
            o = n - r
            out.append((x, y, g, n, "".join(said[na:na + x + y])[:-1], plain[4 * nr:4 * (nr + r)], other[8 * no:8 * (no + o)]))
            na, nr, no = na + x + y, nr + r, no + o
        return out

    def learn(self, strings: set[str]) -> None:
        """Find out about pieces that were not met before, many at once."""
        part, size = [], 0
        for s in sorted(strings):
            if not s or len(s) > LONGEST_KEPT or s[0].isspace() or s[-1].isspace():
                self.kept[s] = self.pieces([s])[0]
                continue
            part.append(s)
            size += len(s)
            if size > PASS_CHARS:
                self.kept.update(zip(part, self.pieces(part), strict=True))
                part, size = [], 0
        if part:
            self.kept.update(zip(part, self.pieces(part), strict=True))

    def texts(self, texts: list[str | None]) -> list[Piece | None]:
        """Whole texts; None for those without tokens."""
        split = [self._split(t) for t in texts]
        if len(self.kept) > KEPT_PIECES:
            self.older, self.kept = self.kept, {}
        kept, older = self.kept, self.older
        new = {s for p in split for s in p if s not in kept}
        kept.update({s: older[s] for s in new if s in older})
        self.learn({s for s in new if s not in older})
        out: list[Piece | None] = []
        for p in split:
            got = list(map(kept.__getitem__, p))
            if not got or None in got:
                out.append(None)
                continue
            a, b, groups, links, spelled, regular, other = zip(*got)
            out.append((sum(a), sum(b), sum(groups), sum(links), ";".join(spelled), b"".join(regular), b"".join(other)))
        for s in [s for s in new if len(s) > LONGEST_KEPT]:
            del kept[s]
        return out

    def _split(self, text: str | None) -> list[str]:
        if not text:
            return []
        if not self.by_word or "▁" in text:
            return [text]
        return BORDER.split(text) if ODD_BLANKS.search(text) else text.split(" ")


@lru_cache(maxsize=2)
def aligner(a_path: str, b_path: str) -> Aligner:
    return Aligner(a_path, b_path)


COUNTS = ["n_a", "n_b", "n_groups", "n_links"]


def aligned(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: ``row, id``, the counts, ``groups`` as spelled or its digest, and the links in short form.

    ``regular`` holds A ids (32 bits each) whose link is to the B id of the same bytes, ``other`` all other links (64 bits).
    """
    ship()
    kind = docs.select(F.col(id).alias("id")).schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        for batch in batches:
            key, texts = batch.column("id"), batch.column("text")
            rows, size, begin = [], 0, 0

            def found() -> Iterator[Piece | None]:
                part, chars = [], 0
                for t in texts:
                    part.append(t.as_py())
                    chars += len(part[-1] or "")
                    if len(part) >= TEXTS or chars >= TEXT_CHARS:
                        yield from own.texts(part)
                        part, chars = [], 0
                yield from own.texts(part)

            def done(end: int) -> pa.RecordBatch:
                cols = list(zip(*rows))
                return pa.RecordBatch.from_arrays(
                    [key.slice(begin, end - begin), *[pa.array(c, pa.int64()) for c in cols[:4]], pa.array(cols[4], pa.string()),
                     *[pa.array(c, pa.binary()) for c in cols[5:]]],
                    ["id", *COUNTS, "groups_sha256", "regular", "other"])

            for at, got in enumerate(found()):
                if got is None:
                    rows.append((0, 0, 0, 0, "", b"", b""))
                else:
                    rows.append((*got[:4], sha256(got[4].encode()).hexdigest(), *got[5:]))
                    size += len(got[5]) + len(got[6])
                if len(rows) >= ROWS or size >= ROW_BYTES:
                    yield done(at + 1)
                    rows, size, begin = [], 0, at + 1
            if rows:
                yield done(batch.num_rows)

    longs = ", ".join(f"{c} long" for c in COUNTS)
    return (docs.select(F.col(id).alias("id"), F.col(text).alias("text"))
            .mapInArrow(run, f"id {kind}, {longs}, groups_sha256 string, regular binary, other binary")
            .withColumn("row", F.monotonically_increasing_id()))


def pair_counts(rows: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """``pair, n, best`` for all linked ids of ``aligned`` rows; ``best`` if no pair of the same B id has a higher count."""
    ship()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(a_path, b_path)
        vector = np.zeros(len(own.identity), np.int64)
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                flat = np.frombuffer(b"".join(part.column("regular").to_pylist()), "<i4")
                vector += np.bincount(flat, minlength=len(vector))
                pairs, n = np.unique(np.frombuffer(b"".join(part.column("other").to_pylist()), "<i8"), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], ["pair", "n"])
        a = np.flatnonzero(vector)
        yield pa.RecordBatch.from_arrays(
            [pa.array(a * SIDE + own.identity[a], pa.int64()), pa.array(vector[a], pa.int64())], ["pair", "n"])

    pairs = rows.select("regular", "other").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    pairs = settle(pairs.withColumn("b", F.expr(f"pair % {SIDE}")), "pair-counts")
    most = pairs.groupBy("b").agg(F.max("n").alias("most"))
    return pairs.join(most, "b").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def _by_arrays(rows: DataFrame, pairs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Look the pairs up in sorted arrays."""
    spark = rows.sparkSession
    got = pairs.toArrow()
    pair = got.column("pair").to_numpy()
    order = np.argsort(pair)
    table = spark.sparkContext.broadcast((
        pair[order], got.column("n").to_numpy()[order], got.column("best").to_numpy(zero_copy_only=False)[order]))
    kept = [c for c in rows.columns if c not in ("regular", "other", "row")]
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, n, best = table.value
        identity = aligner(a_path, b_path).identity
        a = key // SIDE
        plain = identity[a] == key % SIDE
        count, top = np.zeros(len(identity), np.int64), np.zeros(len(identity), np.int64)
        count[a[plain]], top[a[plain]] = n[plain], best[plain]

        def both(regular: bytes, other: bytes) -> tuple[int, int]:
            r, o = np.frombuffer(regular, "<i4"), np.searchsorted(key, np.frombuffer(other, "<i8"))
            return int(top[r].sum() + best[o].sum()), int(count[r].sum() + n[o].sum())

        for batch in batches:
            got = [both(r, o) for r, o in zip(batch.column("regular").to_pylist(), batch.column("other").to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in kept], *[pa.array([g[k] for g in got], pa.int64()) for k in (0, 1)]],
                [*kept, "n_best", "count_sum"])

    schema = ", ".join([f"{c} {t}" if c != "id" else f"id {kind}" for c, t in rows.select(*kept).dtypes])
    return rows.drop("row").mapInArrow(run, f"{schema}, n_best long, count_sum long")


def _by_join(rows: DataFrame, pairs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Join each text's links, added up by pair, with the counts."""
    ship()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        identity = aligner(a_path, b_path).identity
        for batch in batches:
            for row, regular, other in zip(*[batch.column(c).to_pylist() for c in ("row", "regular", "other")]):
                r = np.frombuffer(regular, "<i4").astype(np.int64)
                pair, n = np.unique(np.concatenate([r * SIDE + identity[r], np.frombuffer(other, "<i8")]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(pair), row), pa.int64()), pa.array(pair, pa.int64()), pa.array(n, pa.int64())],
                    ["row", "pair", "times"])

    links = rows.select("row", "regular", "other").mapInArrow(run, "row long, pair long, times long")
    sums = links.join(pairs, "pair").groupBy("row").agg(
        F.sum(F.col("best").cast("long") * F.col("times")).alias("n_best"), F.sum(F.col("n") * F.col("times")).alias("count_sum"))
    zero = F.lit(0).cast("long")
    kept = [c for c in rows.columns if c not in ("regular", "other", "row")]
    return rows.select("row", *kept).join(sums, "row", "left").select(
        *kept, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"))


def align(docs: DataFrame, a_path: str, b_path: str, id: str = "doc_id", text: str = "text", *,
          max_pairs: int = MAX_PAIRS) -> DataFrame:
    """``id``, the counts of tokens, groups and links, the digest of the groups, ``n_best`` and ``count_sum`` of every text."""
    rows = settle(aligned(docs, a_path, b_path, id, text), "aligned-texts", compression="zstd")
    pairs = pair_counts(rows, a_path, b_path)
    few = pairs.count() <= max_pairs
    return (_by_arrays if few else _by_join)(rows, pairs, a_path, b_path).withColumnRenamed("id", id)
