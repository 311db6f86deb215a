"""Mixing: targets, the entropy-balanced rates, rounding near the targets."""

import random
from collections import defaultdict

import numpy as np
import pytest

from folioweave.llm import mixing
from folioweave.llm.queries import mix_query


def corpus(n=3000, seed=1):
    rnd = random.Random(seed)
    names = ["hot", "B", "a", "é", None, "z"]
    rows = [(i, rnd.choices(names, [10, 1, 2, 1, 2, 3])[0], int(rnd.lognormvariate(4, 1.2)), "t", 0.5) for i in range(n)]
    return rows + [(n, "hot", 0, "t", 0.5), (n + 1, "z", 0, "t", 0.5), (5, *rows[5][1:]), (None, "a", 40, "t", 0.5)]


def test_targets_share_by_weight_and_stop_at_the_cap():
    got = mixing.fill_targets({0: 100, 1: 1000, 2: 10}, {0: 3, 1: 1, 2: 2}, 1.5, 2.0)
    assert got[2] == 20 and got[0] == 200 and got[1] == pytest.approx(1.5 * 1110 - 220)
    assert mixing.fill_targets({}, {}, 1.5, 2.0) == {}
    assert mixing.fill_targets({0: 0, 1: 4}, {0: 3, 1: 1}, 1.5, 2.0) == {0: 0.0, 1: 6.0}


def test_rates_solve_the_balance_and_copies_meet_targets(spark):
    rows = corpus()
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long, target string, base double").repartition(5)
    got = mixing.mix(docs, "size").collect()
    again = mixing.mix(docs.repartition(3), "size").collect()
    pick = lambda rs: sorted((repr(r.doc_id), r.size, r.copies) for r in rs)
    assert pick(got) == pick(again) and len(got) == len(rows)
    words, taken, target, rated = defaultdict(int), defaultdict(int), {}, defaultdict(float)
    for r in got:
        words[r.source] += r.size
        taken[r.source] += r.size * r.copies
        rated[r.source] += r.size * r.rate
        target[r.source] = r.target
        assert r.source_size >= r.size and 0 <= r.copies <= 2 and r.base == 0.5
    order = sorted(words, key=lambda s: (s is None, s or ""))
    want = mixing.fill_targets({i: words[s] for i, s in enumerate(order)}, {i: (3, 1, 2)[i % 3] for i in range(len(order))}, 1.5, 2.0)
    for i, s in enumerate(order):
        assert target[s] == pytest.approx(want[i])
        assert rated[s] == pytest.approx(want[i], rel=1e-6)
        assert taken[s] == pytest.approx(want[i], rel=0.01)
    open_ = [r for r in got if r.source == "hot" and 0 < r.size and r.rate < 2]
    tilt = np.array([np.log(r.rate) / r.size for r in open_])
    assert np.ptp(tilt) < 1e-9 and abs(tilt[0]) > 1e-9


def test_sources_without_words_and_empty_tables(spark):
    kind = "doc_id long, source string, size long"
    got = mixing.mix(spark.createDataFrame([(1, "a", 0), (2, None, 5), (2, None, 5)], kind), "size").collect()
    assert sorted((r.doc_id, r.copies) for r in got)[0] == (1, 1)
    assert mixing.mix(spark.createDataFrame([], kind), "size").count() == 0


def test_query_runs_no_python(spark, sf):
    shape = mix_query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in shape and "Arrow" not in shape
