"""Writers: fail-if-exists tables, partitioned tables, delimited files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioweave.operators import order, plan

def write_table(df: DataFrame, name: str, mode: str = "errorifexists", fmt: str = "parquet",
                path: str | None = None, partition_by: Sequence[str] = ()) -> None:
    """Save as a catalog table, failing if it exists."""
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "errorifexists", **props: str) -> None:
    """Save to a database table through JDBC, failing if it exists."""
    df.write.jdbc(url, table, mode=mode, properties=props)


def write_by_gen(df: DataFrame, path: str, gen: str = "gen", mode: str = "errorifexists",
                 rows_per_file: int = 2_000_000) -> None:
    """One dataset with a folder per generation.

    Rows are spread by generation, row hash and input partition: a generation, or a group of
    copies, with most of the rows still uses many tasks. A file ends after ``rows_per_file`` rows.
    """
    slot = F.pmod(F.xxhash64(*df.columns, F.spark_partition_id()), F.lit(plan.shuffle_partitions(df)))
    spread = df.withColumn("_slot", slot).repartition(F.col(gen), F.col("_slot")).drop("_slot")
    (
        spread.write.mode(mode).option("maxRecordsPerFile", rows_per_file)
        .partitionBy(gen).parquet(path)
    )


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def export_sorted(df: DataFrame, path: str, keys: Sequence[str], tie: Sequence[str],
                  rows_per_file: int = 1_000_000) -> None:
    """Sorted delimited files with a header each, numbered in order.

    Rows are range-partitioned, so every task sorts and writes its own part; reading the files by name gives the order.
    """
    ordered = order.sort_by(df, keys, tie)
    ordered.write.mode("errorifexists").option("header", True).option("maxRecordsPerFile", rows_per_file).csv(path)
