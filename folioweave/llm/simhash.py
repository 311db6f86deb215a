"""SimHash near-duplicates: fingerprints of word shingles, exact comparison in tiles, linked groups.

Which fingerprints can differ in few bits: if a fingerprint is cut into ``radius + 2`` blocks, two that differ in at most
``radius`` bits agree in at least two blocks. Each choice of two blocks makes a key, and only fingerprints of one key are
compared. Inside a key the rows are ordered by population count and cut into tiles; a pair of tiles is compared by numpy
exclusive-or and bit counts, unless all their population counts differ by more than the radius. Nothing is left out: keys
and tiles only spare comparisons that cannot succeed. A key too large for one task is cut by population count and hash into
tiles that meet in pairs, each pair a group of its own. A task answers with the edges of a forest, never with all pairs.

Defined cases: null and blank texts have fingerprint zero and are linked like others; equal fingerprints are one node, so
copies cost nothing; a null id takes part but never names a group (the group's id is null if it has no other); repeated
rows stay; an empty table gives an empty result; other columns of the input pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from folioweave.llm.common import fresh, settle, ship

CHUNK = 1 << 14
TILE = 256


def _fingerprint(text: str | None, shingle: int, seed: int) -> int:
    import xxhash

    word = (text or "").encode().lower().split()
    if not word:
        return 0
    joined = b" ".join(word)
    size = np.fromiter(map(len, word), np.int64, len(word))
    end = np.cumsum(size + 1) - 1
    start = end - size
    k = min(shingle, len(word))
    digest = xxhash.xxh64_intdigest
    pairs = zip(start[: len(word) - k + 1].tolist(), end[k - 1:].tolist(), strict=True)
    h = np.fromiter((digest(joined[a:b], seed) for a, b in pairs), np.uint64, len(word) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), CHUNK):
        part = h[at:at + CHUNK]
        ones += np.unpackbits(part.view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])


def fingerprint(text: Column, shingle: int = 3, seed: int = 42) -> Column:
    """64 bits as a long: bit b is set if over half the shingles' XXH64 values have it set."""

    ship()

    @F.pandas_udf(LongType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([_fingerprint(t, shingle, seed) for t in texts], dtype="int64")

    return run(text)


def block_masks(radius: int, agree: int = 2) -> list[int]:
    """Masks of every choice of ``agree`` among ``radius + agree`` blocks of the 64 bits."""
    n = radius + agree
    cuts = [64 * i // n for i in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    masks = [sum(c) for c in combinations(blocks, agree)]
    return [m - (1 << 64) if m >= 1 << 63 else m for m in masks]


class Forest:
    """Union of index pairs, in whole arrays."""

    def __init__(self, n: int) -> None:
        self.up = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.up[a], self.up[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.up, np.maximum(ra, rb), np.minimum(ra, rb))
            while True:
                flat = self.up[self.up]
                if np.array_equal(flat, self.up):
                    break
                self.up = flat


def compare_tiles(left: np.ndarray, right: np.ndarray | None, radius: int, tile: int = TILE) -> np.ndarray:
    """Roots of the linked rows of ``left`` followed by ``right`` (of ``left`` alone if that is None)."""
    both = left if right is None else np.concatenate([left, right])
    forest, ones = Forest(len(both)), np.bitwise_count(both).astype(np.int64)
    rows = np.argsort(ones[: len(left)], kind="stable")
    cols = rows if right is None else len(left) + np.argsort(ones[len(left):], kind="stable")
    tiles = [cols[i:i + tile] for i in range(0, len(cols), tile)]
    low, high = [ones[t[0]] for t in tiles], [ones[t[-1]] for t in tiles]
    for i in range(0, len(rows), tile):
        a = rows[i:i + tile]
        for j in range(i // tile if right is None else 0, len(tiles)):
            if low[j] > ones[a[-1]] + radius:
                break
            if high[j] < ones[a[0]] - radius:
                continue
            x, y = np.nonzero(np.bitwise_count(both[a][:, None] ^ both[tiles[j]][None, :]) <= radius)
            forest.join(a[x], tiles[j][y])
    return forest.up


def _small_groups(group: np.ndarray, value: np.ndarray, radius: int, longest: int) -> np.ndarray:
    """Roots for many small groups at once: every row against the row d places on, for each d."""
    forest = Forest(len(value))
    for d in range(1, longest):
        hit = (group[d:] == group[:-d]) & (np.bitwise_count(value[d:] ^ value[:-d]) <= radius)
        at = np.flatnonzero(hit)
        forest.join(at, at + d)
    return forest.up


def _linker(radius: int, small: int = 32):
    keys = ["band", "key", "ta", "tb"]

    def edges(value: np.ndarray, root: np.ndarray) -> pd.DataFrame:
        far = value != value[root]
        return pd.DataFrame({"u": value[far].view(np.int64), "v": value[root][far].view(np.int64)})

    def solve(part: pd.DataFrame) -> Iterator[pd.DataFrame]:
        new = (part[keys] != part[keys].shift()).any(axis=1).to_numpy()
        group = np.cumsum(new) - 1
        size = np.bincount(group)
        value, side = part["fp"].to_numpy().view(np.uint64), part["side"].to_numpy()
        few = size[group] <= small
        few &= (part["ta"] == part["tb"]).to_numpy()
        if few.any():
            yield edges(value[few], _small_groups(group[few], value[few], radius, small))
        for g in np.unique(group[~few]):
            own = group == g
            v, s = value[own], side[own]
            if part["ta"].to_numpy()[own][0] == part["tb"].to_numpy()[own][0]:
                yield edges(v, compare_tiles(v, None, radius))
            else:
                ordered = np.concatenate([v[s == 0], v[s == 1]])
                yield edges(ordered, compare_tiles(v[s == 0], v[s == 1], radius))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest = None
        for batch in batches:
            if len(batch):
                part = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
                last = (part[keys] == part[keys].iloc[-1]).all(axis=1).to_numpy()
                rest = part[last].reset_index(drop=True)
                if not last.all():
                    yield from solve(part[~last].reset_index(drop=True))
        if rest is not None:
            yield from solve(rest)

    return run


def fingerprint_links(prints: DataFrame, radius: int = 3, tile_rows: int = 4096) -> DataFrame:
    """Edges ``u, v`` that connect all of ``prints.fp`` (distinct longs) that are linked within ``radius`` bits."""
    bands = prints.select("fp", F.inline(F.array(*[
        F.struct(F.lit(b).cast("int").alias("band"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
        for b, m in enumerate(block_masks(radius))])))
    shared = bands.groupBy("band", "key").agg(F.count("*").alias("n")).where("n > 1")
    rows = settle(bands.join(shared, ["band", "key"]), "fingerprint-bands")
    whole = rows.where(F.col("n") <= tile_rows).select(
        "band", "key", F.lit(0).cast("long").alias("ta"), F.lit(0).cast("long").alias("tb"),
        F.lit(0).alias("side"), "fp")
    large = rows.where(F.col("n") > tile_rows).withColumn("ones", F.bit_count("fp"))
    cut = (large.groupBy("band", "key", "ones").agg(F.ceil(F.count("*") / tile_rows).alias("parts"))
           .groupBy("band", "key").agg(F.map_from_entries(F.collect_list(F.struct("ones", "parts"))).alias("cut")))
    part = F.pmod(F.xxhash64("fp"), F.col("cut")[F.col("ones")])
    own = F.col("ones") * (1 << 32) + part + 1
    near = F.filter(F.map_entries("cut"), lambda e: F.abs(e["key"] - F.col("ones")) <= radius)
    others = F.flatten(F.transform(near, lambda e: F.transform(
        F.sequence(F.lit(0).cast("long"), e["value"] - 1), lambda p: e["key"] * (1 << 32) + p + 1)))
    pairs = (large.join(cut, ["band", "key"]).withColumn("tile", own)
             .select("band", "key", "fp", "tile", F.explode(others).alias("other"))
             .select("band", "key", F.least("tile", "other").alias("ta"), F.greatest("tile", "other").alias("tb"),
                     (F.col("tile") > F.col("other")).cast("int").alias("side"), "fp"))
    dealt = (whole.unionByName(pairs).repartition("band", "key", "ta", "tb")
             .sortWithinPartitions("band", "key", "ta", "tb", "fp"))
    return dealt.mapInPandas(_linker(radius), "u long, v long")


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node that is not its group's smallest, by alternating large-star and small-star steps.

    Minima are aggregated before they are joined back, so that a node with very many edges does not meet in one task.
    """
    def mark(e: DataFrame):
        return e.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % (1 << 40))).first()

    now = settle(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                 .where("u <> v").distinct(), "edges")
    seen = mark(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        turn = small.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        now = settle(turn.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "edges")
        if (got := mark(now)) == seen:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        seen = got


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", *, shingle: int = 3, radius: int = 3,
                    tile_rows: int = 4096, key: str | None = None) -> DataFrame:
    """``docs`` without the text, with ``fp`` (long) and ``component_id``, the smallest id that links reach.

    ``key`` names one more column, a long that tells the groups apart also where ids are null or repeated.
    """
    rest = docs.drop("fp", "component_id", *([key] if key else []))
    keep = [c for c in rest.columns if c != text]
    rows = settle(rest.select(*keep, fingerprint(F.col(text), shingle).alias("fp")), "fingerprints")
    low, root, comp, node = fresh(rows, "low", "root", "component", "node")
    prints = rows.groupBy("fp").agg(F.min(id).alias(low))
    linked = components(fingerprint_links(prints.select("fp"), radius, tile_rows)).select(
        F.col("node").alias(node), F.col("root").alias(root))
    rooted = prints.join(linked, F.col("fp") == F.col(node), "left").select(
        F.col("fp").alias(node), F.coalesce(root, "fp").alias(root), low)
    named = rooted.groupBy(root).agg(F.min(low).alias(comp))
    by_print = rooted.select(node, root).join(named, root).select(node, root, comp)
    return (rows.join(by_print, F.col("fp") == F.col(node))
            .select(*keep, "fp", F.col(comp).alias("component_id"), *([F.col(root).alias(key)] if key else [])))
