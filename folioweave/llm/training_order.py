"""Training-order materialisation: a keyed permutation gives every sequence its slot, and shards hold slots in order.

Texts become token ids; all ids in a row, document after document, are the token stream, and sequence i is the stream's
i-th run of ``tokens`` ids (the last is padded). A Feistel network over the sequence number, walked along its cycle until it
falls inside the range, is a permutation of all sequences that needs no table. Slots are dealt to shards in ranges of
``shard_records``; each shard is one file of records of one length, so slot s starts at byte ``(s % shard_records) * stride``
of shard ``s // shard_records``, and reading can start again anywhere.

Documents keep the order in which Spark scans them; every task writes its ids with their place in the task's own stream, and
the tasks' totals place the tasks. Files go through Spark's text sink, one record a line, so any store that Spark writes to
will do; a record is the ids as little-endian numbers, and a line feed.

Defined cases: a null or empty text is the end id alone; a null id is carried as null; repeated rows are repeated; an empty
table has no shards; other columns of the input do not count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioweave.llm.common import settle, ship, small_frame
from folioweave.llm.sharding import M64
from folioweave.session import scratch_path

ROUNDS = 6
#: Rows that a task hands on at once, so that it holds few texts or records besides those it is given.
CHUNK_ROWS = 1024


def _round(x: np.ndarray, key: int) -> np.ndarray:
    x = (x + np.uint64(key)) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def round_keys(seed: int) -> list[int]:
    from hashlib import sha256

    d = sha256(seed.to_bytes(16, "little", signed=True)).digest() + sha256(f"{seed}".encode()).digest()
    return [int.from_bytes(d[8 * i:8 * i + 8], "little") for i in range(ROUNDS)]


def permute(i: np.ndarray, n: int, seed: int) -> np.ndarray:
    """Slot of each sequence number below ``n``: a keyed bijection of range(n)."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = round_keys(seed)
    out = i.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> shift, out[todo] & mask
            for k in keys:
                left, right = right, left ^ (_round(right, k & M64) & mask)
            out[todo] = (left << shift) | right
            todo = todo[out[todo] >= np.uint64(n)]
    return out.astype(np.int64)


@dataclass(frozen=True)
class Layout:
    """Where the records of one materialisation are."""

    path: str
    sequences: int
    stream_tokens: int
    tokens: int
    id_width: int
    shard_records: int

    @property
    def stride(self) -> int:
        return self.tokens * self.id_width + 1

    @property
    def shards(self) -> int:
        return math.ceil(self.sequences / self.shard_records)

    def place(self, slot: int) -> tuple[int, int]:
        """Shard and byte offset of a slot."""
        return slot // self.shard_records, slot % self.shard_records * self.stride


def stream(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", end_id: int = 1) -> DataFrame:
    """Rows ``task, start, n, id, ids``: ids of each text and the end id, placed in the task's own stream."""
    from folioweave.llm.wordids import word_ids

    ship()
    kind = next(t for n, t in docs.dtypes if n == id)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, at, task = word_ids(path), 0, TaskContext.get().partitionId()
        end = np.array([end_id], own.kind).tobytes()
        wide = len(end)
        for batch in batches:
            for k in range(0, len(batch), CHUNK_ROWS):
                part = batch.iloc[k:k + CHUNK_ROWS]
                ids = [own.encode(t or "") + end for t in part["text"]]
                n = np.array([len(b) // wide for b in ids], np.int64)
                yield pd.DataFrame({"task": task, "start": at + np.cumsum(n) - n, "n": n, "has_id": part["has_id"].to_numpy(),
                                    "id": part["id"].to_numpy(), "ids": ids})
                at += int(n.sum())

    got = docs.select(F.coalesce(F.col(id), F.lit(0).cast(kind)).alias("id"), F.col(id).isNotNull().alias("has_id"),
                      F.col(text).alias("text")).mapInPandas(
        run, f"task int, start long, n long, has_id boolean, id {kind}, ids binary")
    return got.select("task", "start", "n", F.when(F.col("has_id"), F.col("id")).alias("id"), "ids")


def materialise(docs: DataFrame, path: str, out: str, id: str = "doc_id", text: str = "text", *, seed: int = 0,
                tokens: int = 1024, end_id: int = 1, shard_records: int = 4096) -> tuple[Layout, DataFrame]:
    """Write the shards below ``out``; returns their layout and the stream places ``id, first, n`` of the documents.

    The driver receives one total per task. The ids are written once, shuffled once and written as records.
    """
    from folioweave.llm.packing import id_bytes

    width = id_bytes(path)
    stored = settle(stream(docs, path, id, text, end_id), "token-stream", compression="zstd")
    sums = {r["task"]: r["n"] for r in stored.groupBy("task").agg(F.sum("n").alias("n")).collect()}
    bases, total = [], 0
    for t in sorted(sums):
        bases.append({"task": t, "base": total})
        total += sums[t]
    placed = stored.join(small_frame(docs.sparkSession, bases, "task: int, base: long"), "task").select(
        "id", "n", "ids", (F.col("base") + F.col("start")).alias("first"))
    layout = Layout(out, math.ceil(total / tokens), total, tokens, width, shard_records)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Pieces of the documents by sequence, their ids compressed for the shuffle."""
        import zstandard

        small = zstandard.ZstdCompressor(level=3).compress
        def done(rows: list) -> pd.DataFrame:
            got = pd.DataFrame(rows, columns=["seq", "at", "ids"])
            got["slot"] = permute(got["seq"].to_numpy(np.int64), max(layout.sequences, 1), seed)
            return got[["slot", "at", "ids"]]

        for batch in batches:
            rows = []
            for at, ids in zip(batch["first"].tolist(), batch["ids"], strict=True):
                if len(rows) >= CHUNK_ROWS:
                    yield done(rows)
                    rows = []
                n = len(ids) // width
                for seq in range(at // tokens, (at + n - 1) // tokens + 1):
                    a, b = max(at, seq * tokens), min(at + n, (seq + 1) * tokens)
                    rows.append((seq, a - seq * tokens, small(ids[(a - at) * width:(b - at) * width])))
            yield done(rows)

    def records(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Whole records from pieces in order."""
        import zstandard

        whole = zstandard.ZstdDecompressor().decompress
        slot, held = -1, []

        def done() -> tuple[int, bytes]:
            return slot // shard_records, b"".join(held).ljust(tokens * width, b"\0")

        for batch in batches:
            rows = []
            for s, ids in zip(batch["slot"], batch["ids"], strict=True):
                if s != slot:
                    if held:
                        rows.append(done())
                    if len(rows) >= CHUNK_ROWS:
                        yield pd.DataFrame(rows, columns=["shard", "value"])
                        rows = []
                    slot, held = s, []
                held.append(whole(ids))
            yield pd.DataFrame(rows, columns=["shard", "value"])
        if held:
            yield pd.DataFrame([done()], columns=["shard", "value"])

    pieces = placed.select("first", "ids").mapInPandas(cut, "slot long, at int, ids binary")
    dealt = (pieces.withColumn("shard", F.expr(f"slot div {shard_records}")).repartition("shard")
             .sortWithinPartitions("shard", "slot", "at"))
    (dealt.select("slot", "ids").mapInPandas(records, "shard long, value binary")
     .select("shard", F.expr("CAST(value AS STRING)").alias("value"))
     .write.partitionBy("shard").option("compression", "none").text(out))
    return layout, placed.select("id", "first", "n")


def read_records(spark: SparkSession, layout: Layout) -> DataFrame:
    """``shard, slot, byte_offset, ids_crc32`` of every record in the files, read back by stride."""
    import zlib

    if not layout.sequences:
        return spark.range(0).select(F.col("id").alias("shard"), F.col("id").alias("slot"),
                                     F.col("id").alias("byte_offset"), F.col("id").alias("ids_crc32"))
    stride, per = layout.stride, layout.shard_records

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, body in zip(batch["path"], batch["content"], strict=True):
                shard = int(path.rpartition("shard=")[2].partition("/")[0])
                at = np.arange(0, len(body), stride)
                crc = [zlib.crc32(np.frombuffer(body[a:a + stride - 1], f"<u{layout.id_width}").astype("<u4").tobytes())
                       for a in at]
                yield pd.DataFrame({"shard": shard, "slot": shard * per + at // stride, "byte_offset": at,
                                    "ids_crc32": crc})

    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option(
        "pathGlobFilter", "part-*").load(layout.path).select("path", "content")
    return files.mapInPandas(read, "shard long, slot long, byte_offset long, ids_crc32 long")


def new_folder(spark: SparkSession) -> str:
    return scratch_path(spark, "training-order")
