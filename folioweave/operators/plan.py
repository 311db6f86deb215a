"""Small helpers that steer the optimizer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def pin(df: DataFrame, columns: dict[str, Column], keep: list[str]) -> DataFrame:
    """``keep`` plus computed columns, each computed once per row.

    A filter on a computed column is normally pushed below the projection that makes it and
    repeats its expression there, often several times over a chain of projections. Here the
    columns come out of a one-row generator, which filters do not pass.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def group_in_order(df: DataFrame) -> DataFrame:
    """Let Spark group rows that already lie sorted by their group as they stand, in one pass.

    This sets an option of the session. Without it the grouping takes rows up in a hash table of lists, gives that up after
    a few groups and sorts all rows once more.
    """
    df.sparkSession.conf.set("spark.sql.execution.replaceHashWithSortAgg", "true")
    return df


#: Stored bytes of compact pages that one task takes; cut up they take many times that.
PAGE_BYTES = 32 << 20


def page_partitions(pages: DataFrame) -> int:
    """Tasks for a page job: the session's number, or more where the size of the pages asks for it.

    The size is added up in a pass over the pages. The optimizer's guess will not do: it takes a made text for 20 bytes, and
    a join for the product of its sides.
    """
    size = pages.agg(F.sum(F.octet_length("html").cast("long"))).first()[0] or 0
    return max(shuffle_partitions(pages), -(-size // PAGE_BYTES))


def spread(df: DataFrame) -> DataFrame:
    """Rows dealt evenly over the session's number of tasks.

    A small file lies in few splits, often one; where every row takes long or grows to a page, few tasks would do all of it.
    """
    return df.repartition(shuffle_partitions(df))
