"""The pipeline, stage by stage, against plain recounts of each stage's decision on its own input."""

import os
from collections import defaultdict

import corpus_pipeline as pipeline
from folioweave.llm import packing, simhash, toxicity
from folioweave.llm.queries import WORD_BPE
from folioweave.llm.wordids import word_ids


def test_stages_in_order(spark, sf, tmp_path):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    seen = [docs]
    for i, (_, stage) in enumerate(pipeline.STAGES):
        out = str(tmp_path / str(i))
        stage(spark, seen[-1], sf).write.parquet(out)
        seen.append(spark.read.parquet(out))
    raw, ruled, mild, single, mixed, packed = seen
    for s in seen[1:-1]:
        assert s.dtypes == raw.select(*pipeline.COLUMNS).dtypes
    assert 0.5 * raw.count() < ruled.count() < raw.count()
    model = toxicity.fit(ruled, spark.read.parquet(f"{sf}/labels.parquet"))
    assert {r.doc_id for r in mild.collect()} == {r.doc_id for r in ruled.collect() if model.score(r.text) < 0.5}
    groups = simhash.near_duplicates(mild.select("doc_id", "text")).collect()
    assert sorted(r.doc_id for r in single.collect()) == sorted({r.component_id for r in groups})
    copies = defaultdict(int)
    for r in mixed.collect():
        copies[r.doc_id] += 1
    assert set(copies) <= {r.doc_id for r in single.collect()} and max(copies.values()) <= 2
    own = word_ids(WORD_BPE)
    width = packing.id_bytes(WORD_BPE)
    want = sum(len(own.encode(r.text or "")) // width + 1 for r in mixed.collect())
    assert sum(r.length for r in packed.collect()) == want


def test_stages_take_empty_and_odd_rows(spark, sf, tmp_path):
    rows = [(None, None, None, None, None), (1, "", "en", "s", 0), (2, "a b " * 30_000, "en", None, 120_000),
            (3, "ten words that say nothing at all about any one thing", "en", "s", 50),
            (3, "ten words that say nothing at all about any one thing", "en", "s", 50)]
    kind = "doc_id long, text string, lang string, source string, n_chars long"
    for k, data in enumerate(([], rows)):
        docs = spark.createDataFrame(data, kind)
        for i, (_, stage) in enumerate(pipeline.STAGES):
            out = str(tmp_path / f"{k}-{i}")
            stage(spark, docs, sf).write.parquet(out)
            docs = spark.read.parquet(out)
        assert (docs.count() > 0) == bool(data)


def test_one_row_of_each_group_stays(spark, sf):
    def text(seed):
        return " ".join(f"w{seed}x{i * i % 97}" for i in range(60))

    rows = [(1, text("a"), "en"), (5, text("a"), "en"), (5, text("b"), "en"), (5, text("c"), "en"), (5, text("c"), "de"),
            (7, text("b"), "en"), (None, text("c"), "en"), (None, text("d"), "en"), (None, text("d"), "en"),
            (None, text("e"), "en"), (None, None, "en"), (None, "", "en")]
    docs = spark.createDataFrame([(i, t, lang, "s", 1) for i, t, lang in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long").repartition(4)
    got = pipeline.one_of_each(spark, docs, sf)
    assert got.columns == pipeline.COLUMNS
    want = [(1, text("a"), "en"), (5, text("b"), "en"), (5, text("c"), "de"), (None, text("d"), "en"), (None, text("e"), "en"),
            (None, None, "en")]
    assert sorted((tuple(r)[:3] for r in got.collect()), key=repr) == sorted(want, key=repr)


def test_modules_stay_inside_their_package():
    top = os.path.dirname(os.path.abspath(pipeline.__file__))
    for folder, _, names in os.walk(os.path.join(top, "folioweave")):
        if os.path.basename(folder) != "llm":
            for n in names:
                if n.endswith(".py"):
                    with open(os.path.join(folder, n)) as f:
                        assert "folioweave.llm" not in f.read()
