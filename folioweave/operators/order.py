"""Sorts. Each takes a unique tie-break, which also lets Spark split a heavy sort value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.session import scratch_path


def sort_by(df: DataFrame, keys: Sequence[str], tie: Sequence[str]) -> DataFrame:
    """Ascending, NULLs last, ties broken by unique columns."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in [*keys, *tie]])


def sort_by_rank(df: DataFrame, keys: Sequence[str], ranks: Sequence[str], tie: Sequence[str],
                 drop: bool = True) -> DataFrame:
    """Sort by ranks that were taken before later edits, then drop them."""
    out = sort_by(df, [*keys, *ranks], tie)
    return out.drop(*ranks) if drop else out


def sort_by_base_key(df: DataFrame, base_key: str, form_index: str, tie: Sequence[str]) -> DataFrame:
    return sort_by(df, [base_key, form_index], tie)


def with_position(ordered: DataFrame, name: str = "position") -> DataFrame:
    """A sorted frame with each row's place, from 0.

    Rows are numbered inside their range partition and moved on by the rows of the partitions before, of which the driver
    gets one count each; no row meets rows of another partition. The sorted frame is written to the shared folder, so both
    readings agree, and the counts read one column. Rows come back in any order; their places say where they belong.
    """
    path = scratch_path(ordered.sparkSession, "sorted")
    marked = ordered.withColumn("_at", F.monotonically_increasing_id())
    marked.write.parquet(path)
    kept = ordered.sparkSession.read.schema(marked.schema).parquet(path)
    part = F.shiftrightunsigned("_at", 33)
    counts = kept.groupBy(part.alias("part")).agg(F.count("*").alias("n")).collect()
    before, pairs = 0, []
    for part_no, n in sorted((r["part"], r["n"]) for r in counts):
        pairs += [F.lit(part_no), F.lit(before)]
        before += n
    first = F.try_element_at(F.create_map(*pairs), part) if pairs else F.lit(0).cast("bigint")
    inside = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return kept.select(*ordered.columns, (first + inside).cast("bigint").alias(name))


def mixed_class(num: Column, raw: Column) -> Column:
    """0 for numbers, 1 for text, 2 for NULL."""
    return F.when(raw.isNull(), F.lit(2)).when(num.isNull(), F.lit(1)).otherwise(F.lit(0))


def mixed_order(num: Column, raw: Column) -> list[Column]:
    """Sort columns for a number-or-text value: numbers, then text, then NULL."""
    return [mixed_class(num, raw).asc(), num.asc_nulls_last(), raw.asc_nulls_last()]
