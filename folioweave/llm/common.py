"""Helpers shared by the training-data operators."""

from __future__ import annotations

import json
import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioweave.session import scratch_path

#: Everything but blank, tab, line feed, vertical tab, form feed and carriage return belongs to a word.
BLANKS = r"[\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), BLANKS, -1), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def fresh(taken: DataFrame | list[str], *names: str) -> list[str]:
    """Column names close to ``names`` that no column of ``taken`` has."""
    used = {c.lower() for c in (taken if isinstance(taken, list) else taken.columns)}
    out = []
    for name in names:
        while name.lower() in used:
            name = f"_{name}"
        used.add(name.lower())
        out.append(name)
    return out


def settle(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: its plan is not run again, also not for a lost executor."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", compression).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_frame(spark: SparkSession, rows: list[dict], schema: str) -> DataFrame:
    """A small frame from driver values, of a size that Spark knows."""
    return spark.range(1).select(F.inline(F.from_json(F.lit(json.dumps(rows)), f"array<struct<{schema}>>")))


def text_key(text: Column) -> Column:
    """96 bits that stand for a text (null reads as empty)."""
    whole = F.coalesce(text, F.lit(""))
    return F.struct(F.xxhash64(whole).alias("a"), F.hash(whole).alias("b"))


def ship() -> None:
    """Let Python workers on the driver's machine import this package from where the driver has it."""
    spark, home = SparkSession.getActiveSession(), os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    if spark is not None:
        env = spark.sparkContext.environment
        path = env.get("PYTHONPATH", "")
        if home not in path.split(os.pathsep):
            env["PYTHONPATH"] = os.pathsep.join(filter(None, [path, home]))


def small_batches(spark: SparkSession, rows: int) -> None:
    """Let Python workers take at most ``rows`` rows at a time; a smaller number that is set already stays.

    This sets an option of the session. Spark's own number, 10,000, holds that many whole texts in a worker in three forms.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, str(rows))
