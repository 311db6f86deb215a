"""Curation, joins, rows, order, quality."""

import random

import pytest
from pyspark.sql import functions as F

from folioweave.functions import text as X
from folioweave.operators import curate, joins, order, plan, quality, rows

C = F.col


def tuples(df, *order_cols):
    return [tuple(r) for r in (df.orderBy(*order_cols) if order_cols else df).collect()]


# ---------------------------------------------------------------- rules and moves

RULES = [
    curate.rule({"a": "1"}, {"b": "x", "c": "first"}),
    curate.rule({"a": ["1", "2"]}, {"c": "second"}),
    curate.rule({"b": "x"}, {"a": "9"}),
    curate.rule({"a": "9", "c": ("starts", "sec")}, {"b": "y"}),
    curate.rule({"b": ("ends", "y")}, {"c": "it's \\ done"}),
    curate.rule({"c": ("contains", "it")}, {"a": ""}),
    curate.rule({"c": ("regex", "it.s")}, {"b": "z"}),
]


def plain_rules(record):
    checks = {"eq": lambda v, w: v == w, "in": lambda v, w: v in w, "starts": lambda v, w: v.startswith(w), "ends": lambda v, w: v.endswith(w),
              "contains": lambda v, w: w in v, "regex": lambda v, w: __import__("re").match(w, v) is not None}
    for r in RULES:
        if all(record[t.col] is not None and checks[t.op](record[t.col], t.value) for t in r.tests):
            record = {**record, **r.set}
    return record


def test_folded_rules_equal_one_by_one(spark):
    rng = random.Random(5)
    data = [(i, *[rng.choice(["1", "2", "x", "sec", None, ""]) for _ in range(3)]) for i in range(300)]
    df = spark.createDataFrame(data, "i INT, a STRING, b STRING, c STRING")
    got = tuples(curate.apply_rules(df, RULES), "i")
    want = []
    for i, a, b, c in data:
        r = plain_rules({"a": a, "b": b, "c": c})
        want.append((i, r["a"], r["b"], r["c"]))
    assert got == want
    assert len(curate.layers(RULES)) < len(RULES)


def test_column_values_see_their_own_layer(spark):
    df = spark.createDataFrame([("x, ",), (", y",), ("z,",)], "s STRING")
    todo = [curate.rule({"s": ("ends", ", ")}, {"s": X.rstrip_set(C("s"), ", ")}),
            curate.rule({"s": ("ends", ",")}, {"s": X.rstrip_set(C("s"), ",")}),
            curate.rule({"s": ("starts", ", ")}, {"s": X.py_slice(C("s"), 2)})]
    assert sorted(r[0] for r in curate.apply_rules(df, todo).collect()) == ["x", "y", "z"]


def test_moves_leave_no_searched_text(spark):
    moves = [curate.Move("day", "t", "Day"), curate.Move("red", "a", "Rot"), curate.Move("in caves", "p", "Caves"), curate.Move("o", "t", "O")]
    data = [("red day", "in caves"), ("", "red"), (None, "day in caves day"), ("zzz", "foo")]
    df = spark.createDataFrame([(a, b, "", "") for a, b in data], "a STRING, b STRING, t STRING, p STRING")
    got = curate.move_conditions(df, moves, ["a", "b"]).collect()
    for before, r in zip(data, got):
        a, b, t, p = *before, "", ""
        for m in moves:
            hit = (a is not None and m.search in a) or (b is not None and m.search in b)
            if hit:
                a, t, p = (m.value if m.target == "a" else a), (m.value if m.target == "t" else t), (m.value if m.target == "p" else p)
            a = None if a is None else a.replace(m.search, "")
            b = None if b is None else b.replace(m.search, "")
        assert (r.a, r.b, r.t, r.p) == (a, b, t, p)


# ---------------------------------------------------------------- filters and dedup


def test_dedup_any_input_order(spark):
    rng = random.Random(2)
    data = [(rng.choice([0] * 50 + list(range(20))), rng.randrange(3), i) for i in range(500)]
    want = sorted(min(((r, i) for k2, r, i in data if k2 == k), default=None) + (k,) for k in {k for k, _, _ in data})
    for seed in (1, 2):
        rng.seed(seed)
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k INT, r INT, i INT").repartition(5)
        got = sorted((r, i, k) for k, r, i in tuples(curate.dedup_first(df, ["k"], ["r", "i"])))
        assert got == want


def test_dedup_keeps_one_row_per_key_before_the_shuffle(spark):
    df = curate.dedup_first(spark.range(100).withColumn("k", C("id") % 3), ["k"], ["id"])
    shape = df._jdf.queryExecution().executedPlan().toString()
    partial = shape.index("Partial")
    assert "WindowGroupLimit" in shape and partial > shape.index("Exchange hashpartitioning")


def test_null_handling_of_filters(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k STRING")
    assert sorted(str(r[0]) for r in curate.exclude(df, "k", ["a"]).collect()) == ["None", "b"]
    assert sorted(str(r[0]) for r in curate.exclude(df, "k", df.filter("k = 'a'")).collect()) == ["None", "b"]
    assert sorted(str(r[0]) for r in curate.drop_where(df, C("k") == "a").collect()) == ["None", "b"]


def test_key_between_is_textual(spark):
    df = spark.createDataFrame([("0151",), ("0151a",), ("0001",), ("00001",), ("0150b",)], "k STRING")
    assert sorted(r[0] for r in df.filter(curate.key_between(C("k"), "0001", "0151")).collect()) == ["0001", "0150b", "0151"]


def test_prune_null_columns(spark):
    df = spark.createDataFrame([(1, None, None, "x")], "a INT, b STRING, c DOUBLE, d STRING")
    assert curate.prune_null_columns(df).columns == ["a", "d"]
    assert curate.prune_null_columns(df, keep=["c"]).columns == ["a", "c", "d"]


def test_write_pruned_tells_empty_columns_in_the_run_that_writes(spark, tmp_path):
    df = spark.createDataFrame([(1, None, None, "x", None), (None, None, None, "", None)], "a INT, b STRING, c DOUBLE, `d.e` STRING, f STRING")
    df = df.withColumn("void", F.lit(None))
    sc = spark.sparkContext
    sc.setJobGroup("pruned", "write_pruned")
    got = curate.write_pruned(df, str(tmp_path / "one"), keep=["c"])
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert got.columns == ["a", "c", "d.e"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == [(1, None, "x"), (None, None, "")]
    assert len(sc.statusTracker().getJobIdsForGroup("pruned")) == 1
    none = curate.write_pruned(df.filter("a > 5"), str(tmp_path / "two"), keep=["a"])
    assert none.columns == ["a"] and none.count() == 0
    assert curate.write_pruned(df.select("a"), str(tmp_path / "three"), keep=["a"]).count() == 2


def test_rank_of(spark):
    df = spark.createDataFrame([("b",), ("zz",), (None,), ("a",)], "v STRING")
    assert [r[0] for r in df.select(curate.rank_of(C("v"), ["a", "b"])).collect()] == [1, None, None, 0]


# ---------------------------------------------------------------- joins


def random_frames(spark, seed, hot):
    rng = random.Random(seed)
    frames = []
    for f in range(4):
        data = [(rng.choice([7] * hot + [None, 1, 2, 3, 4, 5]), rng.choice("xy"), f * 100 + i) for i in range(12)]
        frames.append(spark.createDataFrame(data, f"k INT, m STRING, v{f} INT"))
    return frames


@pytest.mark.parametrize("seed, heavy", [(1, []), (2, [(7, "x"), (7, "y")]), (3, [(None, "x"), (99, "x"), (1, "y")])])
def test_outer_merge_chain_like_pandas(spark, seed, heavy):
    import pandas as pd

    frames = random_frames(spark, seed, hot=2)
    want = None
    for f in frames:
        p = pd.DataFrame([r.asDict() for r in f.collect()]).astype("object")
        want = p if want is None else want.merge(p, on=["k", "m"], how="outer")
    cols = ["k", "m", "v0", "v1", "v2", "v3"]

    def key(rows_):
        return sorted((tuple(-1 if v is None or v != v else v for v in r) for r in rows_), key=str)

    got = joins.outer_merge_all(frames, ["k", "m"], heavy=heavy, slices=3).select(cols)
    assert key(tuples(got)) == key(want[cols].itertuples(index=False, name=None))


def test_outer_merge_reads_every_frame_once(spark, sf):
    frames = [spark.read.parquet(f"{sf}/{t}.parquet").select(C(k).alias("k"), C(v)) for t, k, v in (
        ("orders", "o_custkey", "o_orderkey"), ("customer", "c_custkey", "c_name"), ("supplier", "s_suppkey", "s_name"))]
    shape = joins.outer_merge_all(frames, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert shape.count("FileScan") == 3 and "Nested" not in shape and "Cartesian" not in shape


def test_heavy_key_of_copies(spark):
    # a third of the rows are copies of one row
    hot = C("id") % 3 == 0
    big = spark.range(0, 5000, 1, 20).select(F.when(hot, 7).otherwise(C("id")).alias("k"), F.when(hot, 1).otherwise(C("id")).alias("v"))
    small = spark.range(10).select(C("id").alias("k"), (C("id") * 10).alias("w"))
    got = joins.outer_merge(big, small, ["k"], heavy=[(7,)])
    want = big.join(small, "k", "full_outer")
    assert got.select("k", "v", "w").exceptAll(want.select("k", "v", "w")).isEmpty() and got.count() == want.count()


def hot_frames(spark):
    hot = C("id") % 3 == 0
    big = spark.range(0, 9000, 1, 6).select(
        F.when(hot, F.lit("h")).when(C("id") % 5 == 0, F.lit(None)).otherwise(C("id").cast("string")).alias("k"),
        F.lit(1).alias("m"), C("id").alias("v"))
    small = spark.range(40).select(F.when(C("id") < 2, F.lit("h")).otherwise(C("id").cast("string")).alias("k"),
                                   F.lit(1).alias("m"), C("id").alias("w"))
    return big, small


def test_heavy_keys_are_found(spark):
    big, small = hot_frames(spark)
    assert set(joins.heavy_keys([big, small], ["k", "m"], rows=500)) == {("h", 1), (None, 1)}
    assert joins.heavy_keys([big, small], ["k", "m"], rows=5000) == []
    assert joins.heavy_keys([big.withColumn("k", C("v") / 2)], ["k"], rows=1) == []
    assert joins.heavy_keys([big.limit(0), small.limit(0)], ["k", "m"], rows=1) == []


def test_found_keys_are_spread_and_change_nothing(spark):
    big, small = hot_frames(spark)
    found = joins.outer_merge_all([big, small], ["k", "m"], rows=500, slices=8)
    plain = joins.outer_merge_all([big, small], ["k", "m"], heavy=())
    assert tuples(found.select("k", "v", "w").orderBy("k", "v", "w")) == tuples(plain.select("k", "v", "w").orderBy("k", "v", "w"))
    # as with large frames: no broadcast, and no partitions put together
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "16", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    was = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)

        def most(df):
            return df.filter("k = 'h'").groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0]

        whole, spread = (most(joins.outer_merge_all([big, small], ["k", "m"], **kw).cache())
                         for kw in ({"heavy": ()}, {"rows": 500, "slices": 8}))
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)
    assert whole == 6000 and spread <= 3000


def test_rule_with_a_column_value_reads_earlier_writes(spark):
    df = spark.createDataFrame([("x", "old", "z")], "t STRING, a STRING, b STRING")
    todo = [curate.rule({"t": "x"}, {"a": "new"}), curate.rule({"t": "x"}, {"b": C("a")})]
    assert tuples(curate.apply_rules(df, todo)) == [("x", "new", "new")]
    assert len(curate.layers(todo)) == 2
    assert len(curate.layers([todo[0], curate.rule({"t": "x"}, {"b": C("t")}, ["t"])])) == 1


def test_positions_follow_the_sort(spark):
    df = spark.range(0, 5000, 1, 9).select((C("id") * 7919 % 5000).alias("k"))
    got = order.with_position(order.sort_by(df, ["k"], []))
    assert got.filter("k <> position").isEmpty() and got.count() == 5000
    assert order.with_position(order.sort_by(df.filter("k < 0"), ["k"], [])).count() == 0


def test_written_split_runs_the_plan_once(spark):
    df = spark.createDataFrame([(1, "x"), (2, None)], "i INT, s STRING")
    good, bad = quality.write_split(quality.validate(df, {"no s": C("s").isNull()}), "test")
    assert tuples(good) == [(1, "x")] and [(r.i, r.errors) for r in bad.collect()] == [(2, ["no s"])]


def test_value_below(spark):
    df = spark.createDataFrame([(1, 1, "L"), (1, 2, "v"), (1, 3, "L"), (2, 1, "v"), (2, 2, "L"), (2, 3, "w")], "g INT, r INT, t STRING")
    got = tuples(joins.value_below(df, ["g"], "r", C("t") == "L", "t"), "g", "r")
    assert got == [(1, 1, "v"), (1, 3, None), (2, 2, "w")]


# ---------------------------------------------------------------- rows, order, quality


def test_clone_and_append(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "i INT, s STRING")
    cloned = rows.clone_rows(df, C("s") == "b", [{"i": 20}, {"s": F.concat(C("s"), F.lit("!"))}], copy_no="n")
    assert sorted(tuples(cloned), key=str) == sorted([(1, "a", 0), (2, "b", 0), (20, "b", 1), (2, "b!", 2), (3, None, 0)], key=str)
    added = rows.append_rows(df, [{"i": 9}, {"s": "it's \\ here"}])
    assert sorted(tuples(added), key=str) == sorted([(1, "a"), (2, "b"), (3, None), (9, None), (None, "it's \\ here")], key=str)


def test_union_of_unequal_columns(spark):
    a, b = spark.createDataFrame([(1, "x")], "i INT, s STRING"), spark.createDataFrame([(2, 2.5)], "i INT, d DOUBLE")
    assert sorted(tuples(rows.union_all([a, b]).select("i", "s", "d"))) == [(1, "x", None), (2, None, 2.5)]


def test_mixed_order(spark):
    values = ["12", "—", None, "3", "Start", "100"]
    df = spark.createDataFrame([(v,) for v in values], "raw STRING").withColumn("num", C("raw").try_cast("int"))
    got = [r[0] for r in df.orderBy(*order.mixed_order(C("num"), C("raw"))).collect()]
    assert got == ["3", "12", "100", "Start", "—", None]


def test_sort_by_rank_keeps_nulls_last(spark):
    df = spark.createDataFrame([("b", 1, 1), (None, 0, 2), ("a", 2, 3), ("a", 1, 4)], "k STRING, rank INT, i INT")
    assert [r[1] for r in order.sort_by_rank(df, ["k"], ["rank"], ["i"]).collect()] == [4, 3, 1, 2]


def test_quarantine_covers_all_rows(spark):
    df = spark.createDataFrame([(1, "x"), (2, None), (None, None)], "i INT, s STRING")
    checked = quality.validate(df, {"no i": C("i").isNull(), "no s": C("s").isNull(), "unknown": C("s") == "q"})
    good, bad = quality.split_quarantine(checked)
    assert good.count() == 1 and bad.count() == 2
    assert tuples(quality.error_counts(checked), "reason") == [("no i", 1), ("no s", 2)]


def test_pin_stops_filters(spark):
    df = plan.pin(spark.range(10), {"x": F.expr("substr(cast(id AS string), 1, 1)")}, ["id"]).filter("x = '3'")
    shape = df._jdf.queryExecution().optimizedPlan().toString()
    assert shape.count("substr") == 1 and [r.id for r in df.collect()] == [3]
