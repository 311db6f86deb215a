"""SimHash groups against all pairs, bit by bit."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from folioweave.llm import simhash


def plain_print(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_groups(prints, radius):
    root = list(range(len(prints)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(prints))]


def texts():
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randint(1, 6)))
    base = [" ".join(word() for _ in range(rnd.randint(1, 400))) for _ in range(60)]
    near = [t.replace(" a", " b", 1) + "." for t in base[:30]]
    near += [" ".join([w if rnd.random() > 0.01 else word() for w in t.split()]) for t in base for _ in range(2)]
    return [*base, *near, base[0], base[0], "", None, " \n\t ", "A", "a", "Ä ß é", "x " * 40_000, base[1].upper()]


def test_groups_match_all_pairs(spark):
    rows = texts()
    docs = spark.createDataFrame([(i, t, "f", 1) for i, t in enumerate(rows)], "doc_id long, text string, low string, node int")
    got = {r.doc_id: r for r in simhash.near_duplicates(docs).collect()}
    prints = [plain_print(t) for t in rows]
    assert [got[i].fp & (2**64 - 1) for i in range(len(rows))] == prints
    assert [got[i].component_id for i in range(len(rows))] == plain_groups(prints, 3)
    assert got[0].low == "f" and got[0].node == 1


@pytest.mark.parametrize("tile_rows", [4, 4096])
def test_large_keys_are_cut_without_losing_links(spark, tile_rows):
    rnd = random.Random(9)
    centre = rnd.getrandbits(64)
    prints = {centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.randint(0, 6))) for _ in range(150)}
    prints = sorted(prints | {rnd.getrandbits(64) for _ in range(50)})
    signed = [int(np.uint64(p).view(np.int64)) for p in prints]
    links = simhash.fingerprint_links(spark.createDataFrame([(s,) for s in signed], "fp long"), 3, tile_rows)
    root = {r.node: r.root for r in simhash.components(links).collect()}
    groups = {}
    for s, g in zip(signed, plain_groups(prints, 3), strict=True):
        groups.setdefault(g, set()).add(root.get(s, s))
    assert all(len(v) == 1 for v in groups.values())
    assert len({min(v) for v in groups.values()}) == len(groups)


def test_tiles_agree_with_all_pairs():
    rnd = np.random.default_rng(3)
    centre = rnd.integers(0, 2**63, 20, dtype=np.uint64)
    value = np.unique(centre[rnd.integers(0, 20, 900)] ^ (np.uint64(1) << rnd.integers(0, 63, 900, dtype=np.uint64)))
    got = simhash.compare_tiles(value, None, 1, tile=16)
    want = plain_groups([int(v) for v in value], 1)
    pairs = lambda x: {frozenset(np.flatnonzero(np.array(x) == r).tolist()) for r in set(x)}
    assert pairs(got.tolist()) == pairs(want)


def test_long_chain_is_one_component(spark):
    edges = spark.range(300).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_null_ids_and_empty_table(spark):
    kind = "doc_id long, text string"
    got = simhash.near_duplicates(spark.createDataFrame([(None, "a b c"), (None, "a b c"), (4, "x y z"), (7, "x y z")], kind))
    assert sorted((r.doc_id is None, r.component_id) for r in got.collect() if r.doc_id) == [(False, 4), (False, 4)]
    assert [r.component_id for r in got.collect() if r.doc_id is None] == [None, None]
    assert simhash.near_duplicates(spark.createDataFrame([], kind)).count() == 0


def test_masks_leave_two_blocks_alike():
    masks = [m & (2**64 - 1) for m in simhash.block_masks(3)]
    rnd = random.Random(1)
    for _ in range(300):
        diff = sum(1 << b for b in rnd.sample(range(64), 3))
        assert any(diff & m == 0 for m in masks)
