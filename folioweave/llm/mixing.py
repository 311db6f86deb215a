"""Mixing sources to target word counts by entropy balancing.

Each document gets a rate: the closest to one, in relative entropy, with which its source's words meet the target, no rate
above ``most``. The answer is an exponential tilt, ``min(most, exp(lambda * size / scale))``, with one lambda per source; the
dual is convex, and each Newton step sums its gradient and curvature in Spark over the histogram of document sizes. Steps
that leave the known bracket are halved into it. Rates become copies by systematic rounding: running sums of the rates,
ordered by size inside hash buckets, are cut at whole numbers plus an offset, so a source's error stays near the size of one
document; of ``OFFSETS`` offsets each source gets the one that comes nearest to its target.

Everything is DataFrame expressions; the driver holds one row per source. Defined cases: null texts have no words; null
sources come last; a source without words takes nothing and keeps its documents once; repeated rows are rounded each; an
empty table gives an empty result; other columns pass through and those named like results are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioweave.llm.common import fresh, settle, small_frame

BUCKET_ROWS = 4_096
#: Rates are rounded to this many parts of a copy, so that their sums are exact whole numbers.
UNIT = 1_000_000
OFFSETS = 32


def fill_targets(sizes: dict, weights: dict, share: float, most: float) -> dict:
    """Targets that share ``share`` times all sizes by weight, none above ``most`` times its source's size."""
    target, free = {}, set(sizes)
    left = share * sum(sizes.values())
    while free:
        total = sum(weights[s] for s in free)
        want = {s: left * weights[s] / total for s in free}
        over = [s for s in free if want[s] > most * sizes[s]]
        if not over:
            return target | want
        for s in over:
            target[s] = most * float(sizes[s])
            left -= target[s]
            free.discard(s)
    return target


def solve_tilts(histogram: DataFrame, targets: dict, scale: dict, most: float, tolerance: float = 1e-7,
                steps: int = 60) -> dict:
    """Lambda per source number ``s`` so that the sum of n * size * min(most, exp(lambda * size / scale)) is its target.

    ``histogram`` has ``s, size, n``. Safeguarded Newton: the sum grows with lambda.
    """
    spark = histogram.sparkSession
    tilt = {s: min(math.log(most), max(-20.0, math.log(t / scale[s][1]))) if t > 0 else -50.0
            for s, t in targets.items()}
    low, high = dict.fromkeys(targets, -math.inf), dict.fromkeys(targets, math.inf)
    open_ = {s for s, t in targets.items() if t > 0}
    for _ in range(steps):
        if not open_:
            break
        now = small_frame(spark, [{"s": s, "lambda": tilt[s], "scale": scale[s][0]} for s in open_],
                    "s: int, lambda: double, scale: double")
        bend = F.col("size") / F.col("scale")
        raw = F.exp(F.least(F.col("lambda") * bend, F.lit(50.0)))
        got = (histogram.join(now, "s").groupBy("s").agg(
            F.sum(F.col("n") * F.col("size") * F.least(raw, F.lit(most))).alias("f"),
            F.sum(F.when(raw < most, F.col("n") * F.col("size") * raw * bend).otherwise(0.0)).alias("d")).collect())
        for r in got:
            s, gap = r["s"], r["f"] - targets[r["s"]]
            if abs(gap) <= tolerance * targets[s]:
                open_.discard(s)
                continue
            if gap > 0:
                high[s] = tilt[s]
            else:
                low[s] = tilt[s]
            step = tilt[s] - gap / r["d"] if r["d"] > 0 else math.inf
            if not low[s] < step < high[s]:
                if math.isinf(high[s]):
                    step = 2 * abs(tilt[s]) + 1
                elif math.isinf(low[s]):
                    step = -2 * abs(tilt[s]) - 1
                else:
                    step = (low[s] + high[s]) / 2
            if math.isfinite(low[s]) and math.isfinite(high[s]) and high[s] - low[s] < 1e-13 * max(1, abs(high[s])):
                open_.discard(s)
                continue
            tilt[s] = step
    return {s: float(f"{t:.12g}") for s, t in tilt.items()}


def mix(docs: DataFrame, size: str, source: str = "source", id: str = "doc_id", *, cycle: tuple = (3, 1, 2),
        share: float = 1.5, most: float = 2.0) -> DataFrame:
    """``docs`` with ``source_size``, ``target``, ``rate`` and ``copies``. ``size`` names a column of whole numbers.

    Sources in order of code points, null last, weigh ``cycle`` in turn. ``copies`` (0 to ``ceil(most)``) are the rates
    rounded; equal input gives equal copies. ``docs`` is read more than once and should be a table.
    """
    rows = docs.drop("source_size", "target", "rate", "copies")
    spark = docs.sparkSession
    plain = rows.select(F.col(source).alias("source"), F.col(size).cast("long").alias("size"))
    bins = settle(plain.groupBy("source", "size").agg(F.count("*").alias("n")), "size-histogram")
    facts = bins.groupBy("source").agg(
        F.sum("n").alias("n"), F.sum(F.col("n") * F.col("size")).alias("words"),
        F.sum(F.col("n") * F.col("size") * F.col("size").cast("double")).alias("squares")).collect()
    facts.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    words = {i: r["words"] or 0 for i, r in enumerate(facts)}
    weights = {i: cycle[i % len(cycle)] for i in words}
    target = fill_targets(words, weights, share, most)
    numbers = small_frame(spark, [
        {"source": r["source"], "s": i, "source_size": words[i], "target": target[i], "docs": r["n"],
         "full": target[i] >= most * words[i]} for i, r in enumerate(facts)],
        "source: string, s: int, source_size: long, target: double, docs: long, full: boolean")
    open_ = {i: t for i, t in target.items() if words[i] and t < most * words[i]}
    scale = {i: (facts[i]["squares"] / words[i], words[i]) for i in open_}
    histogram = bins.alias("b").join(numbers.alias("k"), F.col("b.source").eqNullSafe(F.col("k.source"))).select(
        "s", "size", "n")
    tilt = solve_tilts(histogram, open_, scale, most)
    solved = small_frame(spark, [{"s": s, "lambda": t, "scale": scale[s][0]} for s, t in tilt.items()],
                   "s: int, lambda: double, scale: double")
    plan = numbers.join(solved, "s", "left")
    k_src, n_s, n_docs, full, lam, scl, bucket, run, base, unit, total, offset = fresh(
        rows, "key_source", "key_s", "key_docs", "key_full", "lambda", "scale", "bucket", "run", "base", "unit", "total", "offset")
    plan = plan.select(F.col("source").alias(k_src), F.col("s").alias(n_s), F.col("docs").alias(n_docs),
                       F.col("full").alias(full), F.col("lambda").alias(lam), F.col("scale").alias(scl),
                       "source_size", "target")
    tilted = F.when(F.col(lam).isNull(), F.when(F.col("source_size") == 0, 1.0).when(F.col(full), most).otherwise(0.0))
    tilted = tilted.otherwise(F.least(F.lit(most), F.exp(F.least(F.col(lam) * F.col(size) / F.col(scl), F.lit(50.0)))))
    rated = (rows.join(plan, F.col(source).eqNullSafe(F.col(k_src)))
             .withColumn("rate", tilted)
             .withColumn(bucket, F.pmod(F.xxhash64(id, size), F.ceil(F.col(n_docs) / BUCKET_ROWS))))
    rated = rated.withColumn(unit, F.round(F.col("rate") * UNIT).cast("long"))
    order = Window.partitionBy(n_s, bucket).orderBy(size, F.xxhash64(id), id)
    summed = rated.withColumn(run, F.sum(unit).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    before = (rated.groupBy(n_s, bucket).agg(F.sum(unit).alias(total))
              .withColumn(base, F.sum(total).over(Window.partitionBy(n_s).orderBy(bucket)) - F.col(total))
              .select(F.col(n_s).alias(f"{n_s}_b"), F.col(bucket).alias(f"{bucket}_b"), base))
    joined = summed.join(before, (F.col(n_s) == F.col(f"{n_s}_b")) & (F.col(bucket) == F.col(f"{bucket}_b")))

    def cut(offset: str) -> Column:
        return F.expr(f"({base} + {run} + {offset}) div {UNIT} - ({base} + {run} - {unit} + {offset}) div {UNIT}")

    steps = [UNIT * m // OFFSETS for m in range(OFFSETS)]
    tried = joined.groupBy(n_s).agg(*[F.sum(F.col(size) * cut(f"{o}L")).alias(f"t{o}") for o in steps]).collect()
    best = {r[0]: min(steps, key=lambda o: (abs((r[f"t{o}"] or 0) - target[r[0]]), o)) for r in tried}  # noqa: B023
    nearest = small_frame(spark, [{"s": s, "o": o} for s, o in best.items()], "s: int, o: long").select(
        F.col("s").alias(f"{n_s}_o"), F.col("o").alias(offset))
    return joined.join(nearest, F.col(n_s) == F.col(f"{n_s}_o")).select(
        *rows.columns, "source_size", "target", "rate", cut(offset).alias("copies"))
