"""Exact top-k against all products."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from folioweave.llm import knn


def brute(vectors, queries, k):
    want = []
    for q in queries:
        scores = sorted((-int(sum(a * b for a, b in zip(vectors[q], v))), i) for i, v in vectors.items() if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(want)


@pytest.mark.parametrize("pivots, block_rows, scale", [(4, 16, 50), (16, 10_000, 50), (1, 7, 1), (8, 64, 10**8)])
def test_equals_brute_force(spark, pivots, block_rows, scale):
    rnd = np.random.default_rng(pivots)
    centre = rnd.normal(0, 1, (5, 6))
    x = (scale * (centre[rnd.integers(0, 5, 300)] + rnd.normal(0, 0.2, (300, 6)))).astype(int)
    x[100:140] = x[100]
    vectors = {int(i) * 3: v.tolist() for i, v in enumerate(x)}
    rows = [(i, v, "c", 1) for i, v in vectors.items()]
    rows += [(None, [1] * 6, "c", 1), (7000, None, "c", 1)]
    frame = spark.createDataFrame(rows, "vec_id long, ints array<long>, cell string, grp int").repartition(4)
    got = knn.top_k(frame, F.col("vec_id") % 2 == 0, 5, pivots=pivots, block_rows=block_rows).collect()
    assert sorted(map(tuple, got)) == brute(vectors, [i for i in vectors if i % 2 == 0], 5)


def test_far_cells_are_not_visited():
    pivots = np.array([[1000, 0], [-1000, 0], [0, 1000]])
    bounds = knn.Bounds(pivots, np.array([10.0, 10.0, 10.0]), [[1.0, 2.0, 3.0]] * 3, 2)
    assert bounds.needed(np.array([[900, 0]])).tolist() == [[True, False, False]]


def test_odd_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [0.5, -0.25]), (1, [nan, 1.0]), (2, [inf, 1.0]), (3, [None, 1.0]), (4, None), (5, [-0.001, 0.0]), (6, [1.0])]
    frame = spark.createDataFrame(rows, "vec_id long, e array<float>").select("vec_id", knn.whole_vector(F.col("e")).alias("ints"))
    assert {r.vec_id: r.ints for r in frame.collect()} == {0: [128, -64], 1: None, 2: None, 3: None, 4: None, 5: [-1, 0], 6: [256]}
    got = knn.top_k(frame, F.col("vec_id") == 0).collect()
    assert [tuple(r) for r in sorted(got)] == [(0, 1, 6, 32768), (0, 2, 5, -128)]


def test_repeated_rows_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, [1, 2]), (1, [1, 2]), (2, [3, 4]), (2, [3, 4])], "vec_id long, ints array<long>")
    assert [tuple(r) for r in knn.top_k(frame, F.col("vec_id") == 1).collect()] == [(1, 1, 2, 11)]
    assert knn.top_k(frame.where("false"), F.col("vec_id") == 1).count() == 0
    assert knn.top_k(frame, F.col("vec_id") == 99).count() == 0


@pytest.mark.parametrize("pivots, block_rows", [(1, 10_000), (4, 2), (32, 16)])
def test_copies_do_not_take_the_place_of_answers(spark, pivots, block_rows):
    vectors = {0: [10, 1], 99: [100, 7], **{i: [i, -i] for i in range(1, 11)}}
    rows = list(vectors.items()) + [(99, [100, 7])] * 6 + [(0, [10, 1])] * 6
    frame = spark.createDataFrame(rows, "vec_id long, ints array<long>").repartition(3)
    got = knn.top_k(frame, F.col("vec_id") == 0, 5, pivots=pivots, block_rows=block_rows).collect()
    assert sorted(map(tuple, got)) == brute(vectors, [0], 5)


@pytest.mark.parametrize("pivots", [1, 3, 8])
def test_vectors_under_one_id_are_rows(spark, pivots):
    rnd = np.random.default_rng(7)
    rows = [(0, [1000 + i, i]) for i in range(8)] + [(int(i), v.tolist()) for i, v in enumerate(rnd.integers(-50, 50, (40, 2)), 1)]
    rows += [(7, [900, 900]), (7, [900, 901]), (8, [900, 900])]
    frame = spark.createDataFrame(rows + rows[::2], "vec_id long, ints array<long>").repartition(3)
    got = knn.top_k(frame, F.col("vec_id") == 0, 5, pivots=pivots, block_rows=16).collect()
    scores = sorted((-sum(a * b for a, b in zip(q, v)), i) for j, q in rows if j == 0 for i, v in rows if i)
    assert sorted(map(tuple, got)) == [(0, r + 1, i, -s) for r, (s, i) in enumerate(scores[:5])]
