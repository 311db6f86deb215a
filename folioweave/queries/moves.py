"""Move tables of all generations, from pages that Spark renders out of ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions.literals import sql_value
from folioweave.plans import move_values as V
from folioweave.plans import moves
from folioweave.queries.registry import finished, query, spread_table

C = F.col


def q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


# Value of field number i on the page of one part row, as text both engines can read.
def field_text(i: int, kind: str) -> str:
    """SQL text in the common subset of Spark and DuckDB."""
    if kind == "int" or kind == "float":
        return f"CAST((p_partkey * {i + 3} + p_size) % 200 AS {{str}})"
    if kind == "rate":
        return "CASE WHEN p_size % 3 = 0 THEN '—' ELSE CAST(p_size AS {str}) END"
    return f"concat(p_name, ' ', CAST((p_partkey + {i}) % 7 AS {{str}}))"


def icon_word(i: int) -> str:
    return f"CASE (p_partkey + {i}) % 3 WHEN 0 THEN 'fire' WHEN 1 THEN 'water' ELSE 'grass' END"


def icon_number(i: int) -> str:
    return f"CAST((p_partkey + {i}) % 4 AS INT)"


BROKEN = "p_partkey % 40 = 7"  # pages whose power points are no number
NOTED = "p_size % 7 = 2"  # pages with a note, and with a rate that is written without a blank


class Page:
    """A page as a list of SQL text pieces that are joined with concat."""

    def __init__(self):
        self.parts: list[str] = []

    def lit(self, s: str) -> None:
        self.parts.append(sql_value(s))

    def sql(self, s: str) -> None:
        self.parts.append(s)

    def cell(self, cls: str, sql: str | None, extra: str = "") -> None:
        self.lit(f'<td class="{cls}"{extra}>\r\n\t\t')
        if sql:
            self.sql(sql)
        self.lit("</td>")

    def icons(self, cls: str, number: str, blank: str = "\r\n") -> None:
        self.lit(f'<td class="{cls}">{blank}')
        self.sql(f"repeat('<img src=\"/heart.png\">', {number})")
        self.lit("</td>")

    def icon(self, cls: str, i: int, path: str, ending: str, extra: str = "") -> None:
        self.lit(f'<td class="{cls}"{extra}><a href="/t"><img src="{path}')
        self.sql(icon_word(i))
        self.lit(f'{ending}"></a></td>')


def page_sql(gen: int) -> str:
    """Spark SQL text of a page that has every field where its selector looks for it."""
    specs = moves.move_fields(gen)
    p = Page()
    p.lit("<!DOCTYPE html><html><body><table class='head'><tr>")
    def text_of(i, name, kind):
        body = field_text(i, kind).format(str="STRING")
        if name == "power_points":
            noted = f"concat({body}, CASE WHEN {NOTED} THEN ' (SMUSUM)' ELSE '' END)" if gen == 7 else body
            return f"CASE WHEN {BROKEN} THEN 'n/a' ELSE {noted} END"
        if name == "battle_effect":
            return f"concat({body}, CASE WHEN {NOTED} THEN ' (SMUSUM)' ELSE '' END)"
        if name == "effect_rate" and gen >= 3:
            return f"CASE WHEN {NOTED} THEN '30%' ELSE concat({body}, ' %') END"
        if name == "effect_rate":
            return f"CASE WHEN {NOTED} THEN ' 3 0 %' ELSE {body} END"
        return body
    slots = {}
    for i, (name, kind, sel, typ) in enumerate(specs):
        if kind in ("text", "cell", "icon", "count", "after_br", "flag"):
            k = sel[1] + (1 if kind == "text" else 0)
            slots.setdefault(sel[0], {})[k] = (i, name, kind, sel, typ)
    # centred cells first, for the generation that uses them
    for i, (name, kind, sel, typ) in enumerate(specs):
        if kind == "aligned":
            p.cell("x", text_of(i, name, typ), ' align="center"')
        elif kind == "aligned_icon":
            p.icon("x", i, sel[1], sel[2], ' align="center"')
    p.lit("</tr><tr>")
    for cls, by_place in slots.items():
        last = max(by_place)
        for k in range(1, last + 1):
            slot = by_place.get(k)
            if slot is None:
                p.cell(cls, "'filler'")
                continue
            i, name, kind, sel, typ = slot
            if kind == "icon":
                # text slots count texts, so an icon cell of the first generations holds one too
                p.lit(f'<td class="{cls}">\r\n<img src="{sel[2]}')
                p.sql(icon_word(i))
                p.lit(f'{sel[3]}"></td>')
            elif kind == "count":
                p.icons(cls, icon_number(i))
            elif kind == "after_br":
                p.lit(f'<td class="{cls}">Rate:<br>')
                p.sql(text_of(i, name, typ))
                p.lit("</td>")
            elif kind == "flag":
                p.lit(f'<td class="{cls}">')
                p.sql(f"CASE WHEN p_size % 2 = 0 THEN {sql_value(V.IN_DEPTH)} ELSE 'Other' END")
                p.lit("</td>")
            else:
                p.cell(cls, text_of(i, name, typ))
    p.lit("</tr></table>")
    for i, (name, kind, sel, typ) in enumerate(specs):
        if kind not in ("below", "count_below", "beside_icon", "optional_icon"):
            continue
        label, mode, cls = sel[0], sel[1], sel[2]
        k = sel[3] if kind in ("below", "count_below") else 1
        optional = typ in ("pair", "optional")
        shown = f"<b>{label}</b>" if mode == "bold" else (f"{label} ?" if mode == "contains" else label)
        piece = Page()
        if kind == "beside_icon":
            piece.lit(f"<table><tr><td>{shown}</td>")
            piece.icon(cls, i, sel[3], sel[4])
            piece.lit("</tr></table>")
        else:
            if mode == "contains":
                shown = f"{label}<br>{name}"
            piece.lit(f"<table><tr><td>{'</td><td>'.join(['-'] * (k - 1) + [shown])}</td></tr><tr>")
            for _ in range(k - 1):
                piece.cell(cls, "'filler'")
            if kind == "below":
                piece.cell(cls, text_of(i, name, typ))
            elif kind == "optional_icon":
                piece.icon(cls, i, sel[3], sel[4])
            else:
                piece.icons(cls, icon_number(i))
            piece.lit("</tr></table>")
        body = f"concat({', '.join(piece.parts)})"
        p.sql(f"CASE WHEN p_size % 5 = 1 THEN '' ELSE {body} END" if optional else body)
    p.lit("</body></html>")
    return f"concat({', '.join(p.parts)})"


def move_sql(gen: int) -> str:
    cols = []
    seen = {}
    for i, (name, kind, sel, typ) in enumerate(moves.move_fields(gen)):
        # two fields may look at the same place; the page shows the first one's value there
        spot = (kind, sel)
        i = seen.setdefault(spot, i)
        text = field_text(i, typ).format(str="VARCHAR")
        if name == "battle_effect":
            text = f"({text} || CASE WHEN {NOTED} THEN ' (SMUSUM)' ELSE '' END)"
        if name == "effect_rate":
            text = f"CASE WHEN {NOTED} THEN {q('30%' if gen >= 3 else '30')} ELSE {text} END"
        gap = "p_size % 5 = 1"
        if kind.endswith("icon"):
            word = icon_word(i)
            val = f"(upper(left({word}, 1)) || substr({word}, 2))"
            cols.append(f"{f'CASE WHEN {gap} THEN {q(moves.NO_VALUE)} ELSE {val} END' if typ == 'optional' else val} AS {name}")
        elif kind == "flag":
            cols.append(f"CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END AS {name}")
        elif typ == "pair":
            cols.append(f"CASE WHEN {gap} THEN NULL ELSE {icon_number(i)} END AS {name}")
            cols.append(f"CASE WHEN {gap} THEN 'N/A' ELSE {icon_number(i)}::VARCHAR END AS {name}_raw")
        elif kind.startswith("count"):
            cols.append(f"{icon_number(i)} AS {name}")
        elif typ == "rate":
            cols.append(f"TRY_CAST({text} AS INTEGER) AS {name}, {text} AS {name}_raw")
        elif typ in ("int", "float"):
            cols.append(f"TRY_CAST({text} AS {'INTEGER' if typ == 'int' else 'DOUBLE'}) AS {name}")
        elif typ == "optional":
            cols.append(f"CASE WHEN {gap} THEN 'N/A' ELSE {text} END AS {name}")
        else:
            cols.append(f'{text} AS "{name}"')
    rows = f"SELECT p_partkey AS page_id, {', '.join(cols)}, {gen}::INTEGER AS gen FROM part WHERE NOT ({BROKEN})"
    return f"SELECT *, row_number() OVER (ORDER BY move_name NULLS LAST, page_id) - 1 AS position FROM ({rows})"


def move_pages(spark, sf, gen):
    return spread_table(spark, sf, "part", "p_partkey", "p_name", "p_size").select(
        C("p_partkey").alias("page_id"), F.lit("https://dex.example.org/attack/").alias("url"), F.expr(page_sql(gen)).alias("html"))


def register(gen: int) -> None:
    @query(f"moves_g{gen}", move_sql(gen))
    def run(spark, sf):
        return finished(moves.moves(move_pages(spark, sf, gen), gen)[0])


for _gen in range(1, 10):
    register(_gen)


@query("moves_quarantine", f"""
    SELECT p_partkey AS page_id, 'power_points: not a number' AS reasons FROM part WHERE {BROKEN}""")
def quarantine(spark, sf):
    bad = moves.moves(move_pages(spark, sf, 8), 8)[1]
    return bad.select("page_id", F.array_join("errors", "; ").alias("reasons"))
