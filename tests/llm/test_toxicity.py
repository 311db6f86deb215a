"""Toxicity: held-out accuracy, unmoved scores under swaps, defined edge cases."""

import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from folioweave.llm import toxicity
from folioweave.llm.queries import toxicity_query


def sentences(n=900, seed=4):
    rnd = random.Random(seed)
    plain = ["table", "river", "house", "green", "quiet", "paper", "window", "morning", "letter", "garden"]
    bad = ["idiot", "scum", "worthless"]
    rows = []
    for i in range(n):
        words = [rnd.choice(plain) for _ in range(12)]
        toxic = i % 3 == 0
        if toxic:
            words.insert(rnd.randint(0, 12), rnd.choice(bad))
        if rnd.random() < (0.6 if toxic else 0.05):
            words.insert(rnd.randint(0, 12), "muslims")
        rows.append((i, " ".join(words), int(toxic)))
    return rows


def test_neutral_mentions_do_not_raise_the_score(spark):
    rows = sentences()
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    right = [(model.score(t) >= 0.5) == bool(y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean(right) > 0.97
    for term in ("muslims", "christians", "jews"):
        assert abs(model.score(f"the {term} in the garden") - model.score("the people in the garden")) < 0.1
    weights = {m: model.weight[i] for m, i in model.wanted.items()}
    assert abs(sum(weights[m] for m in toxicity.marks("muslims"))) < 0.5 < weights["scum"]


def test_penalty_pulls_swapped_scores_together():
    rnd = np.random.default_rng(0)
    y = rnd.integers(0, 2, 400).astype(float)
    x = np.column_stack([y * (rnd.random(400) < 0.8), rnd.random(400) < 0.2 + 0.5 * y]).astype(float)
    gaps = np.array([[0.0, -1.0]] * 100)
    loose, _ = toxicity.train(x, y, gaps, fair=0.0)
    tight, _ = toxicity.train(x, y, gaps, fair=10.0)
    assert abs(tight[1]) < 0.1 * abs(loose[1]) and tight[0] > 1


def test_swaps_go_round_the_group():
    assert {"the women and a woman", "the people and a people"} <= set(toxicity.swaps("the men and a man"))
    assert list(toxicity.swaps("no such terms")) == [] and list(toxicity.swaps(None)) == []


def test_edge_cases(spark):
    rows = [(1, None), (2, ""), (None, "idiot"), (3, "idiot " * 50_000), (3, "idiot " * 50_000)]
    docs = spark.createDataFrame([(i, t, 1.0, 2) for i, t in rows], "doc_id long, text string, score double, y int")
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, none)
    assert model.score("anything") < 0.01
    odd = spark.createDataFrame([(1, None), (None, 1), (99, 1), (2, 0), (2, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, odd)
    got = docs.select(toxicity.score(F.col("text"), model).alias("s")).collect()
    assert len(got) == 5 and all(0 <= r.s <= 1 for r in got)
    assert docs.where("false").select(toxicity.score(F.col("text"), model)).count() == 0


def test_query_on_given_tables(spark, sf):
    got = {r.doc_id: r for r in toxicity_query(spark, sf.replace("sf0.001", "sf0.1")).collect()}
    labels = spark.read.parquet(f"{sf.replace('sf0.001', 'sf0.1')}/labels.parquet").collect()
    held = [(x.toxic, got[x.doc_id].predicted) for x in labels if got[x.doc_id].held_out]
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in got.items())
    hit = sum(a and b for a, b in held)
    assert hit / sum(a for a, _ in held) > 0.85 and hit / sum(b for _, b in held) > 0.95


def test_repeated_ids_do_not_widen_the_sample(spark, monkeypatch):
    rows = sentences(300)
    hot = next(i for i, r in enumerate(rows) if zlib.crc32(str(r[0]).encode()) % 5)
    docs = [(i, t) for i, t, _ in rows] + [(hot, f"the women and {n} more words") for n in range(400)]
    seen = []

    def train(x, y, gaps, own=toxicity.train):
        seen.append((len(x), len(gaps)))
        return own(x, y, gaps)

    monkeypatch.setattr(toxicity, "train", train)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    a, b = toxicity.fit(frame, labels), toxicity.fit(frame.repartition(5), labels)
    assert seen[0] == seen[1] and seen[0][0] == sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _, _ in rows)
    assert a.wanted == b.wanted and np.allclose(a.weight, b.weight, atol=1e-4)
