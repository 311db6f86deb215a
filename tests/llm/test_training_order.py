"""Training order: a permutation, every id once, records where the layout says."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioweave.llm import training_order as to
from folioweave.llm.queries import WORD_BPE
from folioweave.llm.wordids import word_ids


@pytest.mark.parametrize("n", [1, 2, 3, 5, 64, 1000, 4097])
def test_permutation(n):
    slots = to.permute(np.arange(n), n, 7)
    assert sorted(slots.tolist()) == list(range(n))
    if n >= 1000:
        assert not np.array_equal(slots, to.permute(np.arange(n), n, 8))
        assert abs(np.corrcoef(np.arange(n), slots)[0, 1]) < 0.1


def test_permutation_of_a_large_range_is_computed_per_row():
    n = 10**12 + 39
    got = to.permute(np.arange(n - 1000, n), n, 1)
    assert len(set(got.tolist())) == 1000 and got.min() >= 0 and got.max() < n


def test_records_hold_the_stream(spark, tmp_path):
    own = word_ids(WORD_BPE)
    texts = ["some words here", None, "", "long " * 700, "ends", "ends", "tail of it all"] * 3
    docs = spark.createDataFrame([(i if i else None, t, "n", 1) for i, t in enumerate(texts)],
                                 "doc_id long, text string, ids string, start int").repartition(3, "text")
    layout, places = to.materialise(docs, WORD_BPE, str(tmp_path / "out"), tokens=64, shard_records=5, seed=3)
    ids = {i: np.append(np.frombuffer(own.encode(t or ""), own.kind), 1) for i, t in enumerate(texts)}
    total = sum(map(len, ids.values()))
    assert layout.stream_tokens == total and layout.sequences == -(-total // 64)
    stream = np.zeros(layout.sequences * 64, np.int64)
    cover = Counter()
    for r in places.collect():
        assert r.n == len(ids[r.id or 0])
        stream[r.first:r.first + r.n] = ids[r.id or 0]
        cover.update(range(r.first, r.first + r.n))
    assert set(cover) == set(range(total)) and set(cover.values()) == {1}
    got = {r.slot: r for r in to.read_records(spark, layout).collect()}
    assert sorted(got) == list(range(layout.sequences))
    slots = to.permute(np.arange(layout.sequences), layout.sequences, 3)
    for seq, slot in enumerate(slots.tolist()):
        r = got[slot]
        assert (r.shard, r.byte_offset) == layout.place(slot)
        assert r.ids_crc32 == zlib.crc32(stream[seq * 64:(seq + 1) * 64].astype("<u4").tobytes())
    files = list((tmp_path / "out").rglob("part-*"))
    assert len(files) == layout.shards and all(f.stat().st_size % layout.stride == 0 for f in files)


def test_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([], "doc_id long, text string")
    layout, places = to.materialise(docs, WORD_BPE, str(tmp_path / "out"))
    assert layout.shards == 0 and places.count() == 0 and to.read_records(spark, layout).count() == 0


def test_stream_keeps_rows_and_null_ids(spark):
    docs = spark.createDataFrame([(None, "a", 1), (2, "b", 1), (2, "b", 1)], "doc_id long, text string, task int")
    got = to.stream(docs, WORD_BPE).collect()
    assert len(got) == 3 and sum(r.id is None for r in got) == 1
    assert docs.where(F.lit(False)).count() == 0
