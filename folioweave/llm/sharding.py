"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

The ring has ``cells`` equal cells; a key's cell is the top of its hash, and every shard stands at ``nodes`` cells chosen by
hash. A cell belongs to the first shard clockwise that is not full. Spark sums the bytes of each cell; the walk around the
ring runs over those at most ``cells`` sums, largest cell first, so that the bound can be tight and still hold; the result, a
row per cell, is joined back. A row's slot is its shard's rows in earlier cells plus its place in its cell.

A cell that holds a large part of a shard (a key that many rows have) is cut by a hash of key, size and ties into parts with
places of their own on the ring, so that one key fills several shards and is numbered by several tasks.

Everything on the rows is DataFrame expressions. Defined cases: a null text has no bytes; a null key has the hash of null;
rows with equal keys share a cell, or the parts of one, ordered by size and ties; rows that also agree in size and ties
share a part; a part that fits nowhere (fewer rows than it takes to be even) goes to the emptiest shard; an empty table gives
an empty result; other columns pass through, those named ``shard`` or ``slot`` are replaced.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioweave.llm.common import fresh, small_frame

M64 = (1 << 64) - 1
#: A cell of more than this part of a shard's mean load is cut.
PARTS = 128


def _mix(x: int) -> int:
    """A 64-bit mixer for the places of virtual nodes."""
    x = (x + 0x9E3779B97F4A7C15) & M64
    x = ((x ^ (x >> 30)) * 0xBF58476D1CE4E5B9) & M64
    x = ((x ^ (x >> 27)) * 0x94D049BB133111EB) & M64
    return x ^ (x >> 31)


def ring(shards: int, nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes in ring order. A shard's nodes do not depend on the number of shards."""
    return sorted((_mix((s << 20) + v) % cells, s) for s in range(shards) for v in range(nodes))


def preference(points: list[tuple[int, int]], cells: int, depth: int) -> list[list[int]]:
    """For every cell the first ``depth`` distinct shards clockwise from it."""
    arcs = []
    for i in range(len(points)):
        order: dict[int, None] = {}
        for k in range(len(points)):
            order[points[(i + k) % len(points)][1]] = None
            if len(order) == depth:
                break
        arcs.append(list(order))
    out, at = [], 0
    for c in range(cells):
        while at < len(points) and points[at][0] < c:
            at += 1
        out.append(arcs[at % len(points)])
    return out


def bounded_loads(load: dict[int, int], shards: int, nodes: int, cells: int, slack: float) -> dict[int, int]:
    """Shard of each cell: the first clockwise whose load stays within ``(1 + slack)`` times the mean.

    Part ``p`` of cell ``c`` is numbered ``c + cells * p``; parts from 1 on stand on the ring where a hash says.
    """
    prefer = preference(ring(shards, nodes, cells), cells, shards)
    most = (1 + slack) * sum(load.values()) / shards
    held, out = [0] * shards, {}
    for c in sorted(load, key=lambda c: (-load[c], c)):
        order = prefer[c if c < cells else _mix(c) % cells]
        s = next((s for s in order if held[s] + load[c] <= most), None)
        if s is None:
            s = min(order, key=lambda s: held[s])
        held[s] += load[c]
        out[c] = s
    return out


def ring_cell(key: Column, cells: int) -> Column:
    """Cell of a key on a ring of a power of two cells."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - (cells.bit_length() - 1)).cast("int")


def shard(rows: DataFrame, key: str, size: str, shards: int, *, nodes: int = 64, cells: int = 1 << 16,
          slack: float = 0.001, ties: tuple[str, ...] = ()) -> DataFrame:
    """``rows`` with ``shard`` and ``slot`` (gapless from 0 in each shard); bytes per shard within ``(1 + slack)`` of the mean.

    ``rows`` is read twice, once for its key and size only; once more for key, size and ``ties`` if a cell is cut. ``cells``
    and ``shards * PARTS`` bound what the driver receives and what is joined back, whatever the number of rows; ``ties``
    order rows of equal key and tell them apart where a cell is cut.
    """
    if cells & (cells - 1) or cells < shards:
        raise ValueError("cells must be a power of two, and not fewer than shards")
    plain = rows.drop("shard", "slot")
    cell, c2, base, to, hot_cell, parts = fresh(plain, "cell", "cell_of", "base", "to", "hot_cell", "parts")
    placed = plain.withColumn(cell, ring_cell(F.col(key), cells).cast("long"))

    def sums_of(df: DataFrame) -> list:
        return df.groupBy(cell).agg(F.sum(size).alias("bytes"), F.count("*").alias("n")).collect()

    sums = sums_of(placed)
    part = max(1, sum(r["bytes"] or 0 for r in sums) // (shards * PARTS))
    hot = [{hot_cell: r[0], parts: math.ceil(r["bytes"] / part)} for r in sums if r["n"] > 1 and (r["bytes"] or 0) > part]
    if hot:
        cut = placed.join(small_frame(rows.sparkSession, hot, f"{hot_cell}: long, {parts}: int"),
                          F.col(cell) == F.col(hot_cell), "left")
        number = F.pmod(F.xxhash64(F.lit(1), key, size, *ties), F.col(parts))
        again = cut.withColumn(cell, F.col(cell) + F.coalesce(number, F.lit(0)) * cells)
        placed = again.drop(hot_cell, parts)
        whole = {h[hot_cell] for h in hot}
        sums = [r for r in sums if r[0] not in whole] + sums_of(again.where(F.col(hot_cell).isNotNull()))
    where = bounded_loads({r[0]: r["bytes"] or 0 for r in sums}, shards, nodes, cells, slack)
    start, table = [0] * shards, []
    for r in sorted(sums, key=lambda r: r[0]):
        s = where[r[0]]
        table.append([r[0], s, start[s]])
        start[s] += r["n"]
    plan = rows.sparkSession.range(1).select(F.explode(
        F.from_json(F.lit(json.dumps(table)), "array<array<long>>")).alias("r")).select(
        F.get("r", F.lit(0)).alias(c2), F.get("r", F.lit(1)).cast("int").alias(to),
        F.get("r", F.lit(2)).alias(base))
    order = Window.partitionBy(cell).orderBy(F.xxhash64(key), key, size, *ties)
    numbered = placed.withColumn("slot", F.row_number().over(order).cast("long") - 1)
    return numbered.join(plan, F.col(cell) == F.col(c2)).select(
        *plain.columns, F.col(to).alias("shard"), (F.col("slot") + F.col(base)).alias("slot"))
