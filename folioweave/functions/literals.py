"""Literals as SQL text. One parsed expression is far cheaper to build than a Column per value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def sql_name(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def sql_value(v: object) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, int | float):
        return repr(v)
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_list(values: Sequence[object]) -> str:
    return ", ".join(sql_value(v) for v in values)


def array_of(values: Sequence[object]) -> Column:
    """Constant array."""
    return F.expr(f"array({sql_list(values)})")


def array_of_structs(names: Sequence[str], values: Sequence[Sequence[object]]) -> Column:
    """Constant array of structs with the given field names."""
    def one(row: Sequence[object]) -> str:
        return "named_struct(" + ", ".join(f"{sql_value(n)}, {sql_value(v)}" for n, v in zip(names, row)) + ")"
    return F.expr("array(" + ", ".join(one(r) for r in values) + ")")
