"""Outer merges on keys, and lookups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _same(on: Sequence[str], left: str, right: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(f"{left}.{k}").eqNullSafe(F.col(f"{right}.{k}")) for k in on])


#: A key is heavy above so many rows of a frame, and above this share of the frame.
HEAVY_ROWS, HEAVY_SHARE = 100_000, 0.01
#: Keys that a frame's sketch follows; its counts are at most 3.5 / TRACKED of the frame's rows too low.
TRACKED = 1 << 14


def heavy_keys(frames: Sequence[DataFrame], on: Sequence[str], rows: int = HEAVY_ROWS, share: float = HEAVY_SHARE) -> list[tuple]:
    """Keys that hold at least ``rows`` rows and ``share`` of all rows in one of the frames.

    One job sketches the frequent key hashes of all frames; where there are any, a second job counts the keys behind them
    exactly. The driver gets at most ``1 / share`` keys for each frame. Keys with fractions are not looked for.
    """
    kinds = dict(frames[0].select(*on).dtypes)
    if any(kind in ("float", "double") for kind in kinds.values()):
        return []
    most = min(100, int(1 / share))

    def numbered(pick) -> DataFrame:
        return reduce(DataFrame.unionByName, [pick(f).withColumn("_frame", F.lit(i)) for i, f in enumerate(frames)])

    hashes = numbered(lambda f: f.select(F.xxhash64(*on).alias("_key")))
    found = hashes.groupBy("_frame").agg(
        F.count("*").alias("n"), F.expr(f"approx_top_k(_key, {most}, {TRACKED})").alias("top")).collect()
    # the sketch may count too little, by its error at most
    least = {r["_frame"]: max(rows, share * r["n"]) for r in found}
    maybe = {t["item"] for r in found for t in r["top"] if t["count"] + 3.5 / TRACKED * r["n"] >= least[r["_frame"]]}
    if not maybe:
        return []
    few = numbered(lambda f: f.select(*on).filter(F.xxhash64(*on).isin(*maybe)))
    counted = few.groupBy("_frame", *on).agg(F.count("*").alias("_n")).collect()
    return list(dict.fromkeys(tuple(r[k] for k in on) for r in counted if r["_n"] >= least[r["_frame"]]))


def outer_merge_all(frames: Sequence[DataFrame], on: Sequence[str], heavy: Sequence[tuple] | None = None,
                    slices: int = 64, rows: int = HEAVY_ROWS) -> DataFrame:
    """Full outer merge of several frames on shared keys; repeated keys multiply and NULL keys match each other.

    Every frame is read once by a chain of full outer joins. A full outer join puts all rows of a key into one task, so
    very frequent keys are merged apart: the frame with most rows of a key deals them to ``slices`` tasks and the others'
    rows are repeated for each. Which keys are that frequent is looked up before (:func:`heavy_keys`, which reads the key
    columns alone) unless the caller names them in ``heavy``, as tuples in the order of ``on``; ``()`` stands for none.
    """
    on = list(on)
    if heavy is None:
        heavy = heavy_keys(frames, on, rows)
    if heavy:
        named = [reduce(lambda x, y: x & y, [F.col(k).eqNullSafe(F.lit(v)) for k, v in zip(on, key, strict=True)]) for key in heavy]
        is_heavy = reduce(lambda x, y: x | y, named)
        plain = outer_merge_all([f.filter(~is_heavy) for f in frames], on, ())
        return plain.unionByName(_merge_heavy([f.filter(is_heavy) for f in frames], on, slices))

    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        joined = a.alias("a").join(b.alias("b"), _same(on, "a", "b"), "full_outer")
        keys = [F.coalesce(f"a.{k}", f"b.{k}").alias(k) for k in on]
        return joined.select(*keys, *[f"a.{c}" for c in a.columns if c not in on], *[f"b.{c}" for c in b.columns if c not in on])

    return reduce(merge, frames)


def _merge_heavy(frames: Sequence[DataFrame], on: list[str], slices: int) -> DataFrame:
    """Merge of a few named keys. Their counts (one row per key and frame) are worked out once, on the driver."""
    counts = [{tuple(r[k] for k in on): r["n"] for r in f.groupBy(*on).agg(F.count("*").alias("n")).collect()} for f in frames]
    keys = list(dict.fromkeys(k for c in counts for k in c))
    most = {k: max(range(len(frames)), key=lambda i: counts[i].get(k, 0)) for k in keys}

    def whole(i: int) -> DataFrame:
        f = frames[i]
        # the input partition tells identical rows apart; it is the same when a task is run again
        own = F.pmod(F.xxhash64(*f.columns, F.spark_partition_id()), F.lit(slices)).cast("int")
        cut = reduce(lambda x, y: x | y, [
            reduce(lambda x, y: x & y, [F.col(c).eqNullSafe(F.lit(v)) for c, v in zip(on, k, strict=True)])
            for k in keys if most[k] == i] or [F.lit(False)])
        every = F.array(*[F.lit(s) for s in range(slices)])
        dealt = f.withColumn("_slice", F.explode(F.when(cut, F.array(own)).otherwise(every)))
        lacking = [k for k in keys if k not in counts[i]]
        if not lacking:
            return dealt
        kinds = ", ".join(f"{c} {t}" for c, t in f.dtypes if c in on)
        rows = f.sparkSession.createDataFrame(lacking, kinds).select(*on, F.explode(every).alias("_slice"))
        return dealt.unionByName(rows, allowMissingColumns=True)

    def merge(a: DataFrame, b: DataFrame) -> DataFrame:
        joined = a.alias("a").join(b.alias("b"), _same([*on, "_slice"], "a", "b"))
        return joined.select(*[f"a.{c}" for c in a.columns], *[f"b.{c}" for c in b.columns if c not in (*on, "_slice")])

    return reduce(merge, [whole(i) for i in range(len(frames))]).drop("_slice")


def outer_merge(a: DataFrame, b: DataFrame, on: Sequence[str], heavy: Sequence[tuple] | None = None) -> DataFrame:
    return outer_merge_all([a, b], on, heavy)


def lookup_column(df: DataFrame, dim: DataFrame, on: str, value: str, alias: str | None = None) -> DataFrame:
    """Left join to a dimension with unique keys; a missing key gives NULL."""
    side = dim.select(F.col(on), F.col(value).alias(alias or value))
    return df.join(side, on, "left")


def value_below(df: DataFrame, keys: Sequence[str], row: str, is_label: Column, value: str,
                offset: int = 1, out: str = "value") -> DataFrame:
    """For each label row, the value ``offset`` rows further on in the same group.

    An equi-join on group and row number: the pair is unique, so a large group is spread
    over all tasks, which a window over the group would not do. No such row gives NULL.
    """
    below = df.select(*keys, (F.col(row) - offset).alias(row), F.col(value).alias(out))
    return df.filter(is_label).select(*keys, row).join(below, [*keys, row], "left")
