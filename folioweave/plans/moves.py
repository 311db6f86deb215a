"""Move tables: one row per move page, for all generations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions import numbers as N
from folioweave.functions import text as X
from folioweave.operators import fields, order, plan, quality
from folioweave.plans import move_values as V

D = fields.Doc()
NO_VALUE = "N/A"


def _raw(kind: str, sel: tuple, gen: int) -> str:
    """SQL text of a field's raw value."""
    if kind == "text":
        return D.nth(D.class_texts(sel[0]), sel[1])
    if kind == "cell":
        cell = D.nth(D.cells(sel[0]), sel[1] - 1)
        return D.nth(D.all_texts(cell), 0) if sel[0] == "cen" else D.own_text(cell)
    if kind == "after_br":
        return D.nth(D.texts_after(D.nth(D.cells(sel[0]), sel[1] - 1), "br"), 0)
    if kind in ("aligned", "aligned_icon"):
        # k-th centred cell of its own row, first such cell of the page
        k = sel[0]
        hits = (f"filter(m, (c, i) -> get(m, i - {k - 1}).row = c.row AND coalesce(get(m, i - {k}).row <> c.row, true))")
        first = f"get(array_sort(transform({hits}, c -> named_struct('pos', c.pos, 'stop', c.stop))), 0)"
        cell = D.let("centred", first, "m")
        return D.nth(D.own_texts(cell), 0) if kind == "aligned" else D.nth(D.values_in(cell, starts=sel[1]), 0)
    if kind == "icon":
        return D.nth(D.values_in(D.nth(D.cells(sel[0]), sel[1] - 1), starts=sel[2]), 0)
    if kind == "flag":
        return D.own_text(D.nth(D.cells(sel[0]), sel[1] - 1))
    if kind == "below":
        label, mode, cls, k = sel
        return D.value(label, k, mode, cls=cls)
    if kind == "beside_icon":
        return D.nth(D.values_in(D.beside_cell(sel[0], sel[1], cls=sel[2]), starts=sel[3]), 0)
    if kind == "optional_icon":
        return D.nth(D.values_in(D.value_cell(sel[0], 1, sel[1], cls=sel[2]), starts=sel[3]), 0)
    if kind == "count":
        return D.icons(D.nth(D.cells(sel[0]), sel[1] - 1))
    if kind == "count_below":
        return D.icons(D.value_cell(sel[0], sel[3], sel[1], cls=sel[2]))
    raise ValueError(kind)


def _clean(name: str, kind: str, sel: tuple, gen: int) -> Column:
    raw = F.col(f"raw_{name}")
    if kind.endswith("icon"):
        return X.code_from_path(raw, sel[-2], sel[-1])
    if kind == "flag":
        return F.when(raw == V.IN_DEPTH, F.lit("Yes")).otherwise(F.lit("No"))
    if kind.startswith("count"):
        return raw
    text = X.clean_ws(raw)
    if name == "effect_rate":
        return X.replace_all(text, V.RATE_CUTS[gen])
    if name == "tm_no" and gen <= 3:
        return X.replace_all(text, [("None", "")])
    return X.replace_all(text, V.NUMBER_CUTS.get((gen, name), []))


def move_fields(gen: int) -> list[tuple[str, str, tuple, str]]:
    return [f[2:] for f in V.FIELDS if f[0] <= gen <= f[1]]


def extract_moves(pages: DataFrame, gen: int) -> DataFrame:
    """All fields of every page, with an ``errors`` array: missing cells and bad numbers.

    One exchange (pages by id). The raw values are pinned, so the split by errors does not
    repeat the lookups.
    """
    specs = move_fields(gen)
    labels = [s[2][0] for s in specs if "below" in s[1] or s[1] in ("beside_icon", "optional_icon")]
    docs = fields.with_labels(fields.documents(pages), labels)
    if any(s[1].startswith("aligned") for s in specs):
        # sorted by row, so that a cell's number among its row's centred cells is a look back
        place = "named_struct('row', c.row, 'pos', c.pos, 'stop', c.stop)"
        docs = docs.withColumn("centred", F.expr(f"array_sort(transform(filter(cells, c -> c.align = 'center'), c -> {place}))"))
    raw = plan.pin(docs, {f"raw_{n}": F.expr(_raw(k, sel, gen)) for n, k, sel, _ in specs}, keep=["page_id"])
    clean = raw.select("page_id", *[_clean(n, k, sel, gen).alias(n) for n, k, sel, _ in specs])

    out, checks = [], {}
    for name, _, _, kind in specs:
        c = F.col(f"`{name}`")
        if kind in ("int", "float"):
            parsed = N.to_int(c) if kind == "int" else N.to_double(c)
            out.append(parsed.alias(name))
            checks[f"{name}: not a number"] = N.bad_number(c, parsed)
        elif kind == "rate":
            number, text = N.int_or_raw(c)
            out += [number.alias(name), text.alias(f"{name}_raw")]
        elif kind == "pair":
            out += [c.alias(name), F.coalesce(c.cast("string"), F.lit(NO_VALUE)).alias(f"{name}_raw")]
        elif kind == "optional":
            out.append(F.coalesce(c, F.lit(NO_VALUE)).alias(name))
        else:
            out.append(c.alias(name))
        if kind not in ("pair", "optional"):
            checks[f"{name}: missing"] = c.isNull()
    checked = quality.validate(clean, checks)
    return checked.select("page_id", *out, "errors")


def moves(pages: DataFrame, gen: int, ordered: bool = True) -> tuple[DataFrame, DataFrame]:
    """(move table, quarantined pages with reasons)."""
    good, bad = quality.write_split(extract_moves(pages, gen), f"moves-g{gen}")
    good = good.withColumn("gen", F.lit(gen))
    if ordered:
        good = order.sort_by(good, ["move_name"], ["page_id"])
    return good, bad.select("page_id", "errors")
