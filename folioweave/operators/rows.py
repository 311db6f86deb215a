"""Rows made from rows: explode, clone, append, unite."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions.literals import sql_value


def explode_forms(df: DataFrame, forms: str, index: str = "form_index", form: str = "form") -> DataFrame:
    """One row per item of an array column, keeping the item's index."""
    rest = [c for c in df.columns if c != forms]
    return df.select(*rest, F.posexplode(F.col(forms)).alias(index, form))


def derive_forms(special: Column, alternates: Column, has_variants: Column,
                 fixed: Mapping[str, Sequence[str]] | None = None, name: Column | None = None) -> Column:
    """List of forms of a page.

    Special forms follow the base form; otherwise a page with variants lists its alternates,
    unless its name has a fixed list; a page without variants has the one form ''.
    """
    base = F.array(F.lit(""))
    plain = F.when(F.size(alternates) > 0, alternates).otherwise(base)
    if fixed and name is not None:
        for key, forms in fixed.items():
            plain = F.when(name == key, F.array(*[F.lit(f) for f in forms])).otherwise(plain)
    return (
        F.when(F.size(special) > 0, F.concat(base, F.array_distinct(special)))
        .when(has_variants, plain)
        .otherwise(base)
    )


def append_rows(df: DataFrame, rows: Sequence[Mapping[str, object]]) -> DataFrame:
    """Append literal rows; columns a row does not name stay NULL."""
    if not rows:
        return df
    def record(row: Mapping[str, object]) -> str:
        fields = [
            f"{sql_value(f.name)}, CAST({sql_value(row.get(f.name))} AS {f.dataType.simpleString()})" for f in df.schema
        ]
        return f"named_struct({', '.join(fields)})"

    literal = df.sparkSession.range(0, 1, 1, 1).selectExpr(f"inline(array({', '.join(record(r) for r in rows)}))")
    return df.unionByName(literal)


def clone_rows(df: DataFrame, cond: Column, changes: Sequence[Mapping[str, Column | str]],
               copy_no: str | None = None) -> DataFrame:
    """Matching rows once more per change, in one scan: no join, no second read.

    ``copy_no`` optionally adds 0 for the original and 1.. for its copies.
    """

    touched = list(dict.fromkeys(c for ch in changes for c in ch))
    types = {f.name: f.dataType for f in df.schema}

    def variant(i: int, change: Mapping[str, Column | str]) -> Column:
        cols = [F.lit(i).alias("_copy")]
        for name in touched:
            v = change.get(name)
            c = F.col(name) if v is None else (v if isinstance(v, Column) else F.lit(v))
            cols.append(c.cast(types[name]).alias(name))
        return F.struct(*cols)

    original = variant(0, {})
    copies = [variant(i + 1, ch) for i, ch in enumerate(changes)]
    # only the changed columns are multiplied, and only for matching rows
    many = F.when(F.coalesce(cond, F.lit(False)), F.array(original, *copies)).otherwise(F.array(original))
    out = df.withColumn("_v", F.explode(many))
    fresh = {c: F.col("_v")[c] for c in touched}
    if copy_no:
        fresh[copy_no] = F.col("_v")["_copy"]
    return out.withColumns(fresh).drop("_v")


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by name, columns a frame lacks become NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
