"""Table curation: routing, ordered rules, condition moving, dedup, filters, null pruning."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from folioweave.functions import text as tx
from folioweave.functions.literals import array_of, sql_list, sql_name, sql_value

Value = str | int | float | None | Column


def _lit(v: Value) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def _sure(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


# ---------------------------------------------------------------- conditional update


@dataclass(frozen=True)
class Test:
    """One comparison of a rule: ``col op value``."""

    col: str
    op: str
    value: object

    def sql(self) -> str:
        c = sql_name(self.col)
        if self.op == "in":
            return f"{c} IN ({sql_list(self.value)})"
        v = sql_value(f"\\A(?:{self.value})" if self.op == "regex" else self.value)
        return {
            "eq": f"{c} = {v}",
            "starts": f"startswith({c}, {v})",
            "ends": f"endswith({c}, {v})",
            "contains": f"contains({c}, {v})",
            "regex": f"rlike({c}, {v})",
            "gt": f"{c} > {v}",
            "lt": f"{c} < {v}",
        }[self.op]


@dataclass(frozen=True)
class Rule:
    """Where all tests hold, set the given columns. Values may be literals or Columns.

    ``uses`` names the columns that Column values read; without it a rule with such a value may read any column.
    """

    tests: tuple[Test, ...]
    set: Mapping[str, Value] = field(default_factory=dict)
    uses: tuple[str, ...] | None = None

    def reads_any(self) -> bool:
        return self.uses is None and any(isinstance(v, Column) for v in self.set.values())

    def reads(self) -> set[str]:
        return {t.col for t in self.tests} | {*(self.uses or ())}

    def sql(self) -> str:
        """Condition as SQL; NULL counts as false where it is used, in CASE."""
        return " AND ".join(t.sql() for t in self.tests)


def rule(match: Mapping[str, object], set: Mapping[str, Value], uses: Sequence[str] | None = None) -> Rule:
    """Shorthand: ``{"col": value}`` means equality, ``{"col": ("ends", "x")}`` names the test.

    A list as value means membership. ``uses``: see :class:`Rule`.
    """
    tests = []
    for col, want in match.items():
        if isinstance(want, tuple):
            tests.append(Test(col, want[0], want[1]))
        elif isinstance(want, list):
            tests.append(Test(col, "in", want))
        else:
            tests.append(Test(col, "eq", want))
    return Rule(tuple(tests), dict(set), None if uses is None else tuple(uses))


def assign_where(df: DataFrame, cond: Column, values: Mapping[str, Value]) -> DataFrame:
    """Set columns where a condition holds, in one projection."""
    return df.withColumns({c: F.when(cond, _lit(v)).otherwise(F.col(c)) for c, v in values.items()})


def layers(rules: Iterable[Rule]) -> list[list[Rule]]:
    """Cut an ordered rule list where a rule reads what an earlier one of its layer wrote."""
    out: list[list[Rule]] = []
    written: set[str] = set()
    for r in rules:
        if not out or r.reads() & written or r.reads_any() and written:
            out.append([])
            written = set()
        out[-1].append(r)
        written |= set(r.set)
    return out


def apply_rules(df: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """Ordered rules, later ones seeing earlier results, as one projection per layer.

    Within a layer no rule reads a written column, so each column becomes a single CASE
    whose branches run from the last rule to the first.
    """
    for layer in layers(rules):
        types = {f.name: f.dataType.simpleString() for f in df.schema}
        changed = {}
        for c in dict.fromkeys(c for r in layer for c in r.set):
            mine = [r for r in reversed(layer) if c in r.set]
            if any(isinstance(r.set[c], Column) for r in mine):
                expr = F.when(F.expr(mine[0].sql()), _lit(mine[0].set[c]))
                for r in mine[1:]:
                    expr = expr.when(F.expr(r.sql()), _lit(r.set[c]))
                changed[c] = expr.otherwise(F.col(c)).cast(types[c])
            else:
                branches = " ".join(f"WHEN {r.sql()} THEN {sql_value(r.set[c])}" for r in mine)
                changed[c] = F.expr(f"CAST(CASE {branches} ELSE {sql_name(c)} END AS {types[c]})")
        df = df.withColumns(changed)
    return df


@dataclass(frozen=True)
class Move:
    """Text to look for, the column it belongs to, and what to write there."""

    search: str
    target: str
    value: str


def move_conditions(df: DataFrame, moves: Sequence[Move], sources: Sequence[str]) -> DataFrame:
    """Where a source contains the text, write ``value`` to the target; then delete the text.

    Moves run in order. Those that write to other columns fold into one projection; a move
    whose target is itself a source ends the projection, so expressions stay small.
    """
    batch: list[Move] = []
    for m in moves:
        batch.append(m)
        if m.target in sources or len(batch) == 6:
            df = _move_batch(df, batch, sources)
            batch = []
    return _move_batch(df, batch, sources) if batch else df


def _move_batch(df: DataFrame, batch: Sequence[Move], sources: Sequence[str]) -> DataFrame:
    env = {c: sql_name(c) for c in {*sources, *[m.target for m in batch]}}
    for m in batch:
        found = " OR ".join(f"contains({env[s]}, {sql_value(m.search)})" for s in sources)
        env[m.target] = f"CASE WHEN {found} THEN {sql_value(m.value)} ELSE {env[m.target]} END"
        for s in sources:
            env[s] = f"replace({env[s]}, {sql_value(m.search)}, '')"
    return df.withColumns({c: F.expr(e) for c, e in env.items()})


def move_by_affix(df: DataFrame, source: str, target: str, prefix: str = "", suffix: str = "",
                  keep_affix: bool = False, also: Mapping[str, Value] | None = None,
                  test: Column | None = None) -> DataFrame:
    """Move a whole text whose start (or end) matches into another column, clear the source."""
    c = F.col(source)
    hit = test if test is not None else (c.startswith(prefix) if prefix else c.endswith(suffix))
    moved = c if keep_affix else tx.between_affixes(c, prefix, suffix)
    return assign_where(df, hit, {target: moved, **(also or {}), source: F.lit("")})


def annotate(df: DataFrame, key: str, keys: Sequence[str], values: Mapping[str, Value]) -> DataFrame:
    """Constant values for the rows of a short list of keys."""
    return assign_where(df, F.col(key).isin(*keys), values)


def route(text: Column, by: Column, branches: Mapping[str, tuple[Sequence[str], Column]],
          default: str | None = None) -> dict[str, Column]:
    """Send one text to one of several columns by a routing value; the others get ''.

    ``branches`` maps a target column to (routing values, cleaned text); ``default`` names
    the target of all other routing values.
    """
    named = [v for target, (vals, _) in branches.items() for v in vals if target != default]
    out = {}
    for target, (vals, cleaned) in branches.items():
        ok = ~by.isin(*named) if target == default else by.isin(*vals)
        out[target] = F.when(_sure(ok), cleaned).otherwise(F.lit(""))
    return out


def blank_to_null(df: DataFrame) -> DataFrame:
    """'' to NULL in every string column."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.expr(f"nullif({sql_name(c)}, '')") for c in texts})


# ---------------------------------------------------------------- filters


def key_between(c: Column, lo: str, hi: str) -> Column:
    """Inclusive text range, compared character by character."""
    return c.between(lo, hi)


def not_matching(c: Column, pattern: str) -> Column:
    """Keep rows whose text does not match from its first character; NULLs drop."""
    return ~tx.matches_at_start(c, pattern)


def exclude(df: DataFrame, key: str, keys: Sequence[str] | DataFrame) -> DataFrame:
    """Drop listed keys, keep NULL keys.

    A Python list becomes a set test in the scan's stage. A DataFrame becomes an anti join,
    for which Spark picks the strategy from the size it knows.
    """
    if isinstance(keys, DataFrame):
        only = keys.select(F.col(keys.columns[0]).alias(key)).distinct()
        return df.join(only, key, "left_anti")
    k = sql_name(key)
    return df.filter(F.expr(f"{k} IS NULL OR {k} NOT IN ({sql_list(keys)})"))


def drop_where(df: DataFrame, cond: Column) -> DataFrame:
    """Remove rows where the condition is true; unknown keeps the row."""
    return df.filter(~_sure(cond))


def prune_null_columns(df: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Drop columns that hold no value at all. One aggregate, one row back to the driver.

    The aggregate runs the frame's plan; where that is costly, pass a checkpointed or written frame.
    """
    open_cols = [c for c in df.columns if c not in keep]
    if not open_cols:
        return df
    counts = df.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in open_cols]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c in keep or counts[c]])


def write_pruned(df: DataFrame, path: str, keep: Sequence[str] = ()) -> DataFrame:
    """Write a frame and read it back without the columns that hold no value at all.

    The run that writes sees which columns hold one, so there is neither a second run nor a read for it. A task that runs
    twice sees the same values, so lost executors do no harm to the result.
    """
    void = [f.name for f in df.schema if isinstance(f.dataType, T.NullType)]
    df = df.drop(*[c for c in void if c not in keep]).withColumns({c: F.col(f"`{c}`").cast("string") for c in void if c in keep})
    open_cols = [c for c in df.columns if c not in keep]
    if not open_cols:
        df.write.parquet(path)
        return df.sparkSession.read.schema(df.schema).parquet(path)
    seen = Observation()
    # by place, as names of metrics need not fit names of columns
    flags = [F.max(F.col(f"`{c}`").isNotNull()).alias(f"c{i}") for i, c in enumerate(open_cols)]
    df.observe(seen, *flags).write.parquet(path)
    found = seen.get
    held = {c for i, c in enumerate(open_cols) if found.get(f"c{i}")}
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    return stored.select(*[F.col(f"`{c}`") for c in df.columns if c in keep or c in held])


# ---------------------------------------------------------------- ranks and dedup


def rank_of(c: Column, values: Sequence[str]) -> Column:
    """Position of a value in an ordered enumeration (0-based), NULL when unknown."""
    return F.nullif(F.array_position(array_of(values), c), F.lit(0)).cast("int") - 1


def dedup_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """First row per key in the given order. Put a unique column last in ``order``.

    ``row_number() = 1`` lets Spark keep one row per key in every map task before the
    shuffle (WindowGroupLimit), so a key with a large share of all rows does no harm.
    """
    cols = [o if isinstance(o, Column) else F.col(o).asc_nulls_last() for o in order]
    w = Window.partitionBy(*keys).orderBy(*cols)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
