"""Registry of named queries over the driver tables, each with its SQL twin where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from folioweave.operators import order, plan

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


def finished(ordered: DataFrame) -> DataFrame:
    """A sorted table written to the shared folder and read back, with every row's place."""
    return order.with_position(ordered)


def spread_table(spark: SparkSession, sf: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table whose rows take long each, dealt over all tasks."""
    return plan.spread(table(spark, sf, name).select(*columns))


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")
