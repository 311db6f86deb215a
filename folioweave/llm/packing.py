"""Vector bin packing of examples into training sequences, by the dot-product heuristic.

An example takes tokens, one segment and loss-bearing tokens; a sequence has a limit for each. The open sequence takes the
example whose demands have the largest dot product with what is left of the limits, among those that fit; if none fits, the
example with the largest product is cut and its head fills the sequence (``cut=False``: the sequence is closed instead).
Examples are dealt into groups of bounded size by a hash of id and place; each group is packed by one task, on arrays.
Examples above a limit are cut into heads first; each full head is a sequence of its own.

Defined cases: a null or empty text is the end id alone; repeated rows are packed each; with ``cut=False`` an example above
a limit gets a sequence of its own; an empty table gives an empty result; other columns of the input are not carried.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioweave.llm.common import ship, small_batches
from folioweave.llm.wordids import word_ids


#: Texts that a worker takes at a time.
BATCH_ROWS = 1000


@dataclass(frozen=True)
class Limits:
    tokens: int = 2048
    segments: int = 256
    loss: int = 2048


def _head(limit_tokens: int, limit_loss: int, start: int, end: int, loss_from: int) -> int:
    """Longest head of [start, end) within both limits; tokens from ``loss_from`` on bear loss."""
    return min(end - start, limit_tokens, max(0, loss_from - start) + limit_loss)


def place(start: np.ndarray, end: np.ndarray, loss_from: np.ndarray, limits: Limits, cut: bool = True):
    """Pieces (item, start, end, sequence, offset) for items [start, end), in placing order."""
    out: list[tuple[int, int, int, int, int]] = []
    seq = 0
    item, first, last, mark = [], [], [], []
    for i, (s, e, p) in enumerate(zip(start.tolist(), end.tolist(), loss_from.tolist(), strict=True)):
        while s < e:
            h = _head(limits.tokens, limits.loss, s, e, p)
            if h == limits.tokens and (cut or h == e - s):
                out.append((i, s, s + h, seq, 0))
                seq += 1
            elif cut and 0 < h < e - s:
                item.append(i), first.append(s), last.append(s + h), mark.append(p)
            else:
                break
            s += h
        if not cut and (e - s > limits.tokens or e - max(s, p) > limits.loss):
            out.append((i, s, e, seq, 0))
            seq += 1
        elif s < e:
            item.append(i), first.append(s), last.append(e), mark.append(p)
    item, first, last, mark = (np.array(x, np.int64) for x in (item, first, last, mark))
    size = np.array([limits.tokens, limits.segments, limits.loss], float)
    tokens = last - first
    loss = np.maximum(0, last - np.maximum(first, mark))
    share = np.array([tokens.sum(), len(item), loss.sum()]) / size
    weight = share / max(share.sum(), 1e-12) / size / size
    left, offset = [limits.tokens, limits.segments, limits.loss], 0
    open_ = False
    while len(item):
        if not open_:
            left, offset, open_ = [limits.tokens, limits.segments, limits.loss], 0, True
        w = weight * left
        score = tokens * w[0] + w[1] + loss * w[2]
        fits = (tokens <= left[0]) & (loss <= left[2]) & (left[1] > 0)
        if fits.any():
            i = int(np.argmax(np.where(fits, score, -1.0)))
            h = int(tokens[i])
        else:
            i = int(np.argmax(score))
            h = _head(left[0], left[2], int(first[i]), int(last[i]), int(mark[i])) if cut and left[1] > 0 else 0
        if h <= 0:
            seq, open_ = seq + 1, False
            continue
        s = int(first[i])
        out.append((int(item[i]), s, s + h, seq, offset))
        left = [left[0] - h, left[1] - 1, left[2] - max(0, s + h - max(s, int(mark[i])))]
        offset += h
        if h == tokens[i]:
            keep = np.arange(len(item)) != i
            item, first, last, mark, tokens, loss = (x[keep] for x in (item, first, last, mark, tokens, loss))
        else:
            first[i], tokens[i] = s + h, tokens[i] - h
            loss[i] = max(0, int(last[i]) - max(s + h, int(mark[i])))
        if left[0] == 0 or left[1] == 0:
            seq, open_ = seq + 1, False
    return out


def tokenize(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", end_id: int = 1,
             piece_tokens: int = 2048) -> DataFrame:
    """Rows ``id, has_id, start, ids, doc_tokens, copy``: each text's ids and ``end_id``, cut every ``piece_tokens`` ids.

    ``ids`` holds little-endian numbers, ``id_bytes(path)`` wide. ``copy`` counts equal ids met before in the task, so that
    repeated rows can be told and dealt apart. A null id (a number or a string) travels as zero with ``has_id`` false.
    """
    ship()
    small_batches(docs.sparkSession, BATCH_ROWS)
    kind = next(t for n, t in docs.dtypes if n == id)
    names = ["id", "has_id", "start", "ids", "doc_tokens", "copy"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids = word_ids(path)
        wide, seen = np.dtype(ids.kind).itemsize, Counter()
        end = np.array([end_id], ids.kind).tobytes()
        for batch in batches:
            rows = []
            for key, has, body in zip(batch["id"].tolist(), batch["has_id"].tolist(), batch["text"], strict=True):
                b = ids.encode(body or "") + end
                n, copy = len(b) // wide, seen[key, has]
                seen[key, has] += 1
                rows += [(key, has, s, b[s * wide:(s + piece_tokens) * wide], n, copy) for s in range(0, n, piece_tokens)]
                if len(rows) >= 4096:
                    yield pd.DataFrame(rows, columns=names)
                    rows = []
            yield pd.DataFrame(rows, columns=names)

    return (docs.select(F.coalesce(F.col(id), F.lit(0).cast(kind)).alias("id"), F.col(id).isNotNull().alias("has_id"),
                        F.col(text).alias("text"))
            .mapInPandas(run, f"id {kind}, has_id boolean, start long, ids binary, doc_tokens long, copy long"))


def id_bytes(path: str) -> int:
    return np.dtype(word_ids(path).kind).itemsize


def pack(pieces: DataFrame, rows: int, limits: Limits, id_width: int, *, cut: bool = True, group_rows: int = 2048,
         loss_from: str | None = None) -> DataFrame:
    """Pack rows of ``tokenize``: ``id, copy, doc_tokens, start, ids, sequence_id, offset``, one per placed piece.

    ``rows`` is the number of examples, from which the number of groups follows; ``loss_from`` names a column with the
    place in the document where loss begins (all tokens bear loss without it). Sequence ids are unique, not gapless.
    """
    groups = max(1, math.ceil(rows / group_rows))
    begins = F.col(loss_from).cast("long") if loss_from else F.lit(0).cast("long")
    kind = next(t for n, t in pieces.dtypes if n == "id")
    dealt = pieces.select(
        "id", "has_id", "start", "ids", "doc_tokens", "copy", begins.alias("loss_from"),
        F.pmod(F.xxhash64("id", "start", "copy"), F.lit(groups)).alias("grp"))
    carried = ["id", "has_id", "doc_tokens", "copy"]

    def run(part: pd.DataFrame) -> pd.DataFrame:
        # a worker that cut texts before needs its words no more
        word_ids.cache_clear()
        part = part.sort_values(["has_id", "id", "copy", "start", "ids"], kind="stable").reset_index(drop=True)
        body, begin = part["ids"].tolist(), part["start"].to_numpy()
        end = begin + np.array([len(b) // id_width for b in body], np.int64)
        got = place(begin, end, part["loss_from"].fillna(0).to_numpy().astype(np.int64), limits, cut)
        at = np.array(got, np.int64).reshape(-1, 5)
        out = part[carried].iloc[at[:, 0]].reset_index(drop=True)
        out["start"] = at[:, 1]
        out["ids"] = [body[i][(s - begin[i]) * id_width:(e - begin[i]) * id_width] for i, s, e in at[:, :3].tolist()]
        out["sequence_id"] = (int(part["grp"].iloc[0]) << 32) + at[:, 3]
        out["offset"] = at[:, 4]
        return out

    packed = dealt.groupBy("grp").applyInPandas(
        run, f"id {kind}, has_id boolean, doc_tokens long, copy long, start long, ids binary, sequence_id long, offset long")
    return packed.select(F.when(F.col("has_id"), F.col("id")).alias("id"), "copy", "doc_tokens", "start", "ids",
                         "sequence_id", "offset")


def pack_documents(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text",
                   limits: Limits = Limits(), end_id: int = 1, group_rows: int = 2048) -> DataFrame:
    """Documents to packed pieces; see ``pack``.

    A document counts as one example and one more for every ``2 * limits.tokens`` bytes of its text, so that a group's size
    is bounded where documents are long, too.
    """
    pieces = tokenize(docs, path, id, text, end_id, limits.tokens)
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length(text).cast("long"))).first()
    return pack(pieces, rows + (size or 0) // (2 * limits.tokens), limits, id_bytes(path), group_rows=group_rows)


def digest(packed: DataFrame, id_width: int, id: str = "doc_id") -> DataFrame:
    """Packed pieces with the length and checksum of their ids (as 32-bit numbers) in place of the ids."""
    import zlib

    @F.pandas_udf("long")
    def crc(ids: pd.Series) -> pd.Series:
        return pd.Series([zlib.crc32(np.frombuffer(b, f"<u{id_width}").astype("<u4").tobytes()) for b in ids], dtype="int64")

    return packed.select(
        F.col("id").alias(id), "start", F.expr(f"octet_length(ids) div {id_width}").alias("length"),
        crc("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "copy")
