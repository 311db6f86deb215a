"""Row checks and the split into good and quarantined rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.session import scratch_path


def validate(df: DataFrame, checks: Mapping[str, Column], errors: str = "errors") -> DataFrame:
    """Add an array with the reason of every check whose 'bad' condition holds."""
    found = [F.when(F.coalesce(bad, F.lit(False)), F.lit(reason)) for reason, bad in checks.items()]
    return df.withColumn(errors, F.array_compact(F.array(*found)))


def split_quarantine(df: DataFrame, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """(rows without errors, rows with errors).

    Both are filters over the same plan; :func:`write_split` runs a costly plan once.
    """
    return (
        df.filter(F.size(errors) == 0).drop(errors),
        df.filter(F.size(errors) > 0),
    )


def write_split(df: DataFrame, name: str, errors: str = "errors") -> tuple[DataFrame, DataFrame]:
    """(rows without errors, rows with errors), from one run of the plan.

    The checked rows are written once to the shared folder, in a folder for each of the two kinds, and read from there.
    """
    path = scratch_path(df.sparkSession, name)
    df.withColumn("_bad", F.size(errors) > 0).write.partitionBy("_bad").parquet(path)
    stored = df.sparkSession.read.schema(df.schema.add("_bad", "boolean")).parquet(path)
    return stored.filter(~F.col("_bad")).drop("_bad", errors), stored.filter(F.col("_bad")).drop("_bad")


def error_counts(df: DataFrame, errors: str = "errors") -> DataFrame:
    return df.select(F.explode(errors).alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))
