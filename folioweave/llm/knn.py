"""Exact top-k search: a Voronoi join of queries and data for the largest inner products.

Rows belong to the cell of their nearest pivot. Each data cell has a summary: rows, radius and its ``k + 1`` smallest
distances to the pivot. For a query q and a row x at distance d from pivot p, ``q.p - |q| d <= q.x <= q.p + |q| d``; the lower
ends over all summaries give a score that the k-th answer reaches at least, and a cell whose upper end stays below it cannot
hold an answer. Data cells and query groups are cut into blocks by hash; a pair of blocks meets in one task only if some
query of the group needs the cell, and there only the queries that need it. Each task returns k rows per query, and a window
merges them.

Defined cases: vectors that are null, or hold null or non-finite components, take no part, nor do rows without an id;
shorter vectors read as padded with zeros; rows of equal id and vector are copies and count once, before anything is chosen,
while different vectors under one id are rows of their own; equal ids never answer each other; equal scores go to the
smaller id; with fewer than k candidates all are returned. Scores are exact while ``|q| |x|`` stays below 2**53, and
beyond that while the components fit a long and the products do.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioweave.llm.common import settle, ship


def whole_vector(vector: Column, scale: int = 256) -> Column:
    """floor(scale * x) of each component; null if a component is null or not finite."""
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.when(fine, F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double"))))


def _matrix(vectors: pd.Series, width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for i, v in enumerate(vectors):
        out[i, :len(v)] = v
    return out


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products: through floats where they are exact there, else in whole numbers."""
    large = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    return (a.astype(float) @ b.astype(float).T).astype(np.int64) if large < 2.0**53 else a @ b.T


def best(queries: np.ndarray, query_id: np.ndarray, data: np.ndarray, data_id: np.ndarray, k: int) -> pd.DataFrame:
    """The k best rows of ``data`` for each query, ties to the smaller id."""
    order = np.argsort(data_id, kind="stable")
    data, data_id = data[order], data_id[order]
    found = []
    for at in range(0, len(queries), 256):
        got = _scores(queries[at:at + 256], data)
        for i, row in enumerate(got):
            q = query_id[at + i]
            other = np.flatnonzero(data_id != q)
            s = row[other]
            if len(s) > k:
                least = np.partition(s, len(s) - k)[len(s) - k]
                above, ties = np.flatnonzero(s > least), np.flatnonzero(s == least)
                keep = np.concatenate([above, ties[:k - len(above)]])
                other, s = other[keep], s[keep]
            found.append(pd.DataFrame({"query_id": q, "vec_id": data_id[other], "score": s}))
    if not found:
        return pd.DataFrame({"query_id": [], "vec_id": [], "score": []}, dtype="int64")
    return pd.concat(found, ignore_index=True)


class Bounds:
    """Which cells a query can have answers in, from the cells' summaries."""

    def __init__(self, pivots: np.ndarray, radius: np.ndarray, near: list[list[float]], k: int,
                 near_id: list[list[int]] | None = None) -> None:
        self.pivots, self.radius, self.k = pivots.astype(float), radius, k
        self.id = None if near_id is None else np.array([i for d in near_id for i in d], np.int64)
        self.cell = np.array([j for j, d in enumerate(near) for _ in d], np.int64)
        self.dist = np.array([x for d in near for x in d], float)

    def needed(self, queries: np.ndarray, query_id: np.ndarray | None = None) -> np.ndarray:
        """Boolean matrix, query by cell. The (k + 1)-th lower end counts, as the own row may be in a summary; rows of the
        query's id that are known as such do not count at all."""
        q = queries.astype(float)
        length, dot = np.sqrt((q * q).sum(axis=1)), q @ self.pivots.T
        upper = dot + length[:, None] * self.radius[None, :]
        if len(self.dist) <= self.k:
            return np.broadcast_to(self.radius >= 0, upper.shape)
        lower = dot[:, self.cell] - length[:, None] * self.dist[None, :]
        if self.id is not None and query_id is not None:
            lower[self.id[None, :] == query_id[:, None]] = -np.inf
        least = np.partition(lower, lower.shape[1] - self.k - 1, axis=1)[:, lower.shape[1] - self.k - 1]
        slack = 1e-9 * (np.abs(upper) + np.abs(np.where(np.isfinite(least), least, 0))[:, None]) + 1e-6
        return (upper + slack >= least[:, None]) & (self.radius >= 0)


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, id: str = "vec_id", vector: str = "ints", *,
          pivots: int = 64, block_rows: int = 16_384) -> DataFrame:
    """``query_id, rank, vec_id, score``: for every row with ``is_query`` the k best other rows.

    ``vector`` holds arrays of longs. ``pivots`` rows (by hash of the id) are the cells' centres; they and one summary per
    cell are all the driver receives. ``block_rows`` bounds the rows of either side that meet in a task.
    """
    ship()
    kept = settle(vectors.where(F.col(id).isNotNull() & F.col(vector).isNotNull()).select(
        F.col(id).cast("long").alias("id"), F.col(vector).alias("v"), is_query.alias("query"))
        .groupBy("id", "v").agg(F.max("query").alias("query")), "vectors")
    width = kept.agg(F.max(F.size("v"))).first()[0] or 0
    chosen = kept.select("id", "v").orderBy(F.xxhash64("id"), "id").limit(pivots).collect()
    if not chosen:
        return kept.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                           F.col("id").alias("score"))
    centre = np.unique(_matrix(pd.Series([r["v"] for r in chosen]), width), axis=0)

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        c = centre.astype(float)
        for batch in batches:
            if not len(batch):
                continue
            x = _matrix(batch["v"], width).astype(float)
            d = np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :], 0)
            cell = d.argmin(axis=1)
            far = np.sqrt(((x - c[cell]) ** 2).sum(axis=1))
            yield batch.assign(cell=cell.astype(np.int32), far=far)

    cells = settle(kept.mapInPandas(assign, "id long, v array<long>, query boolean, cell int, far double"), "cells")
    radius, near, near_id = np.full(len(centre), -1.0), [[] for _ in centre], [[] for _ in centre]
    counts, asked = [0] * len(centre), [0] * len(centre)
    for r in cells.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n"),
                                       F.count(F.when(F.col("query"), 1)).alias("q")).collect():
        radius[r["cell"]], counts[r["cell"]], asked[r["cell"]] = r["far"], r["n"], r["q"]
    first = Window.partitionBy("cell").orderBy("far", "id")
    for r in cells.withColumn("r", F.row_number().over(first)).where(F.col("r") <= k + 1).select("cell", "far", "id").collect():
        near[r["cell"]].append(r["far"])
        near_id[r["cell"]].append(r["id"])
    bounds = Bounds(centre, radius, near, k, near_id)
    blocks = [math.ceil(n / block_rows) for n in counts]
    groups = max(1, math.ceil(sum(asked) / block_rows))

    def spread(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Each query to all blocks of the cells it needs."""
        for batch in batches:
            if not len(batch):
                continue
            need = bounds.needed(_matrix(batch["v"], width), batch["id"].to_numpy())
            for j in range(need.shape[1]):
                rows = batch[need[:, j]]
                for b in range(blocks[j] if len(rows) else 0):
                    yield rows[["id", "v", "grp"]].assign(cell=np.int32(j), block=np.int32(b))

    # queries of near cells share a group, so that a group needs few cells
    turn = np.cumsum([0, *asked[:-1]]) * groups // max(sum(asked), 1)
    in_group = F.element_at(F.lit([int(t) for t in turn]), F.col("cell") + 1)
    width_of = F.element_at(F.lit([max(1, math.ceil(a / block_rows)) for a in asked]), F.col("cell") + 1)
    queries = cells.where("query").withColumn(
        "grp", (in_group * 4096 + F.pmod(F.xxhash64("id"), width_of)).cast("int"))
    sent = settle(queries.select("id", "v", "grp").mapInPandas(
        spread, "id long, v array<long>, grp int, cell int, block int"), "queries-sent")
    wanted = sent.select(*[F.col(c).alias(c) for c in ("cell", "block", "grp")]).distinct()
    split = F.element_at(F.lit([max(1, b) for b in blocks]), F.col("cell") + 1)
    data = (cells.withColumn("block", F.pmod(F.xxhash64("id"), split).cast("int"))
            .join(wanted, ["cell", "block"]).select("id", "v", "cell", "block", "grp"))

    def solve(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        return best(_matrix(left["v"], width), left["id"].to_numpy(), _matrix(right["v"], width),
                    right["id"].to_numpy(), k)

    keys = ["cell", "block", "grp"]
    local = sent.groupBy(*keys).cogroup(data.groupBy(*keys)).applyInPandas(solve, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
