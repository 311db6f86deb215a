"""Learnset tables, generations 1 and 2: captioned sections of a page, merged on the move.

The sections of one page are lists in one row, so the outer merge of a page is a chain of
generators over that row: no join and no shuffle beyond the one that places the pages.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioweave.functions import numbers as N
from folioweave.functions import text as X
from folioweave.functions.literals import sql_value
from folioweave.operators import fields, order, plan, quality

C = F.col
D = fields.Doc()

# Fixed values per generation: column, caption, exact caption, test on the value's cell (t), constant.
ODD = "t.row_no % 2 = 1"
SECTIONS = {
    1: [
        ("level", "Generation I Level Up", True, ODD, None),
        ("tm_hm", "TM & HM Attacks", True, ODD, None),
    ],
    2: [
        ("level", "Generation II Level Up", True, ODD, None),
        ("tm_hm", "TM & HM Attacks", True, f"{ODD} AND t.col_no % 2 = 1", None),
        ("egg_moves", "Egg Moves", False, None, "Egg"),
        ("crystal_move_tutor", "Crystal Move Tutor Attacks", False, None, "4000 Coins"),
        ("g1_tm_hm", "Gen I Only Moves", False,
         "array_contains(wide, t.cell)", None),
    ],
}
# Where the page's key stands.
KEY_PLACE = {1: ("fooinfo", 3), 2: (None, 11)}


def _section(caption: str, exact: bool, test: str | None) -> str:
    """SQL text: struct of the section's moves and values."""
    match = f"n.text = {sql_value(caption)}" if exact else f"contains(n.text, {sql_value(caption)})"
    # every table with the caption counts, in page order
    tables = f"array_distinct(transform(filter(named, n -> n.row_no = 1 AND {match}), n -> n.tbl))"
    moves = "transform(filter(texts, t -> array_contains(s, t.tbl) AND t.row_no > 2 AND t.prev = 'a'), t -> t.text)"
    values = (f"transform(filter(texts, t -> array_contains(s, t.tbl) AND t.row_no > 2 AND t.cls = 'fooinfo' AND t.direct AND {test} "
              "AND trim(t.text) <> ''), t -> t.text)" if test else "CAST(array() AS array<string>)")
    both = D.let(tables, f"named_struct('moves', {moves}, 'vals', {values})", "s")
    return D.let("transform(filter(cells, c -> c.colspan = '2'), c -> c.pos)", both, "wide") if "wide" in values else both


def sections(pages: DataFrame, gen: int) -> DataFrame:
    """One row per page: key, one list of (move, value) per section, and ``errors``."""
    spec = SECTIONS[gen]
    docs = fields.with_labels(fields.documents(pages), [s[1] for s in spec])
    cls, n = KEY_PLACE[gen]
    raw = {"key": F.expr(D.nth(D.class_texts(cls), n))}
    raw.update({f"raw_{col}": F.expr(_section(cap, exact, test)) for col, cap, exact, test, _ in spec})
    df = plan.pin(docs, raw, keep=["page_id"])
    out, checks = [], {}
    for col, _, _, _, const in spec:
        moves, vals = C(f"raw_{col}")["moves"], C(f"raw_{col}")["vals"]
        if const is None:
            # a page without the section has no lists at all
            pairs = F.zip_with(moves, vals, lambda m, v: F.struct(m.alias("move"), v.alias("value")))
            checks[f"{col}: moves and values differ in number"] = F.size(moves) != F.size(vals)
        else:
            pairs = F.zip_with(moves, F.array_repeat(F.lit(const), F.size(moves)),
                               lambda m, v: F.struct(m.alias("move"), v.alias("value")))
        out.append(pairs.alias(col))
    key = X.zfill(F.replace(X.clean_ws(C("key")), F.lit("#"), F.lit("")), 4)
    df = quality.validate(df, {"dex_no: missing": C("key").isNull(), **checks})
    return df.select("page_id", key.alias("dex_no"), *out, "errors")


def merge_sections(df: DataFrame, cols: list[str]) -> DataFrame:
    """Outer merge of a row's lists on the move; repeated moves multiply."""
    names = F.array_distinct(F.concat(*[F.transform(c, lambda p: p["move"]) for c in cols]))
    out = df.withColumn("move", F.explode(names))
    for c in cols:
        mine = F.expr(f"transform(filter({c}, p -> p.move = move), p -> p.value)")
        out = out.withColumn(c, F.explode_outer(mine))
    return out


def learnsets(pages: DataFrame, gen: int, ordered: bool = True) -> tuple[DataFrame, DataFrame]:
    """(learnset table, quarantined pages with reasons)."""
    cols = [s[0] for s in SECTIONS[gen]]
    good, bad = quality.write_split(sections(pages, gen), f"learnsets-g{gen}")
    df = merge_sections(good, cols)
    df = df.withColumn("level_raw", C("level")).withColumn("level", N.to_numeric(C("level")))
    df = df.select("dex_no", "move", "level", "level_raw", *cols[1:], F.lit(gen).alias("gen"), "page_id")
    if ordered:
        num, raw = N.int_or_raw(C("level_raw"))
        df = df.orderBy("dex_no", *order.mixed_order(num, raw), C("tm_hm").asc_nulls_last(), "move", "page_id")
    return df.drop("page_id"), bad.select("page_id", "errors")
