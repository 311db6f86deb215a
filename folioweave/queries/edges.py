"""Evolution tables of all generations, from pages that Spark renders out of ``part``.

The SQL twins start from the same part rows without any HTML and apply the rule tables one
rule at a time, so both the extraction and the folding of rules are checked.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import text as X
from folioweave.functions.literals import array_of, array_of_structs
from folioweave.plans import edge_values as V
from folioweave.plans import edges
from folioweave.queries.registry import finished, query, table

C = F.col

# Key pairs with forms: from, its form, to, its form. Every second part row uses one of them.
PAIRS = [
    ("0082", "", "0462", ""), ("0133", "", "0470", ""), ("0133", "", "0471", ""), ("0299", "", "0476", ""),
    ("0349", "", "0350", ""), ("0412", "Plant Cloak", "0413", "Plant Cloak"), ("0554", "Galarian Darumaka", "0555", "Standard Mode"),
    ("0554", "", "0555", "Standard Mode"), ("0710", "Average Size", "0711", "Average Size"), ("0744", "", "0745", "Midday Form"),
    ("0744", "Own Tempo", "0745", "Dusk Form"), ("0744", "", "0745", "Midnight Form"), ("0206", "", "0982", "Two-Segment Form"),
    ("0206", "", "0982", "Three-Segment Form"), ("0924", "", "0925", "Family of Four"), ("0924", "", "0925", "Family of Three"),
    ("0891", "", "0892", "Rapid Strike Style"), ("0891", "", "0892", "Single Strike Style"), ("0848", "", "0849", "Amped Form"),
    ("0854", "", "0855", ""), ("0155", "", "0156", ""), ("0588", "", "0589", ""), ("0616", "", "0617", ""), ("0686", "", "0687", ""),
    ("0133", "", "0700", ""), ("0790", "", "0791", ""), ("0790", "", "0792", ""), ("0803", "", "0804", ""), ("0808", "", "0809", ""),
    ("0866", "", "0867", ""), ("0868", "", "0869", ""), ("0234", "", "0899", ""), ("0217", "", "0901", ""),
    ("0550", "White-Striped Form", "0902", "Female"), ("0550", "White-Striped Form", "0902", "Male"),
    ("0215", "Hisuian Form", "0903", ""), ("0211", "Hisuian Form", "0904", ""), ("0963", "", "0964", "Zero Form"),
    ("0999", "Roaming Form", "1000", ""), ("1012", "", "1013", ""), ("0290", "", "0292", ""), ("0458", "", "0226", ""),
    ("0674", "", "0675", ""), ("0025", "", "0026", ""), ("0025", "", "0026", "Alolan Raichu"), ("0102", "", "0103", ""),
    ("0104", "", "0105", "Alolan Marowak"), ("0737", "", "0738", ""), ("0739", "", "0740", ""), ("0495", "", "0496", ""),
    ("0019", "Alolan Rattata", "0020", "Alolan Raticate"), ("0052", "Paldean x", "0980", ""), ("0156", "", "0157", "Hisuian Form"),
]
TEXTS = [
    "Thunder Stone", "Daytime, outside Alola", "Nighttime", "Kings Rock", "level up in a Magnetic Field area",
    "level up near an Icy Rock", "or level up near a Mossy Rock", "in buildings", "in caves", "in grass, Female", "Male",
    "during rain", "after Rollout learned", "hold Oval Stone, Daytime", "Attack > Defense", "Attack < Defense", "in Galar",
    "outside Galar", "in Legends: Arceus", "", "Dawn Stone+, Female", "use Ice Stone in Gen 8", "x, or Level 17 in Legends: Arceus",
    "Cracked Pot", "Unremarkable Teacup", ", Daytime", "some plain condition, ", "in Alola, Nighttime", "trailing,",
]
PER_PAGE = 25


LOST_KEY, LOST_METHOD = "p_partkey % 40 = 7", "page_id % 7 = 3"


def method_pages(spark, sf, broken=False):
    """Pages of at most 25 table rows each, rendered from part; ``broken`` ones lack a key, or are of an unknown method."""
    k = C("p_partkey")
    pair = F.element_at(
        array_of_structs(["f", "ff", "t", "tf"], PAIRS),
        (F.floor(k / 2) % len(PAIRS) + 1).cast("int"))
    listed = k % 2 == 0
    def number(part, shift):
        return F.when(listed, part).otherwise(X.zfill(((k + shift) % 1000).cast("string"), 4))
    text = F.element_at(array_of(TEXTS), (F.floor(k / 3) % len(TEXTS) + 1).cast("int"))
    shown = X.replace_all(text, [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")])
    def cell(num, form):
        small = F.when(listed & (form != ""), F.concat(F.lit('<small class="text-muted">'), form, F.lit("</small>"))).otherwise("")
        return F.concat(F.lit('<td class="cell-name"><a title="View Pokedex for #'), num, F.lit(' x" href="/x">x</a><br>'), small, F.lit("</td>"))
    second = cell(number(pair["t"], 1), pair["tf"])
    if broken:
        second = F.when(F.expr(LOST_KEY), F.lit('<td class="cell-name">?</td>')).otherwise(second)
    level = F.when(C("p_size") % 3 == 0, C("p_size").cast("string")).otherwise("")
    row = F.concat(
        F.lit("<tr>"), cell(number(pair["f"], 0), pair["ff"]), F.lit('<td class="cell-num">'), level, F.lit("</td>"),
        second, F.lit('<td class="cell-med-text"> <i>'), shown, F.lit("</i> </td></tr>"))
    page = F.floor(k / PER_PAGE)
    listed_rows = table(spark, sf, "part").select(page.alias("page_id"), k.alias("k"), row.alias("row"))
    # bounded group: p_partkey is unique, so a page has at most PER_PAGE rows
    packed = listed_rows.groupBy("page_id").agg(F.array_sort(F.collect_list(F.struct("k", "row"))).alias("r"))
    body = F.array_join(F.transform("r", lambda x: x["row"]), "\n")
    method = F.element_at(array_of(V.METHODS), (C("page_id") % len(V.METHODS) + 1).cast("int"))
    if broken:
        method = F.when(F.expr(LOST_METHOD), F.lit("fusion")).otherwise(method)
    return packed.select(
        "page_id", F.concat(F.lit("https://dex.example.org/evolution/"), method).alias("url"),
        F.concat(F.lit("<html><body><table><thead><tr><th>From</th><th>L</th><th>To</th></tr></thead><tbody>\n"), body,
                 F.lit("</tbody></table></body></html>")).alias("html"))


# ---------------------------------------------------------------- SQL twins


def q(v) -> str:
    return "'" + str(v).replace("'", "''") + "'"


def sql_list(vals) -> str:
    return "[" + ", ".join(q(v) for v in vals) + "]"


def sql_replace(expr: str, pairs) -> str:
    for a, b in pairs:
        expr = f"replace({expr}, {q(a)}, {q(b)})"
    return expr


def sql_test(col: str, want) -> str:
    if isinstance(want, list):
        return f"{col} IN ({', '.join(q(v) for v in want)})"
    if isinstance(want, tuple):
        return {"starts": f"starts_with({col}, {q(want[1])})", "ends": f"suffix({col}, {q(want[1])})"}[want[0]]
    return f"{col} = {q(want)}"


class Steps:
    """Chain of CTEs, each one edit of the whole table."""

    def __init__(self):
        self.ctes: list[str] = []

    def add(self, body: str) -> None:
        self.ctes.append(f"s{len(self.ctes)} AS ({body.replace('PREV', f's{len(self.ctes) - 1}')})")

    def edit(self, cond: str, values: dict[str, str]) -> None:
        sets = ", ".join(f"CASE WHEN {cond} THEN {v} ELSE {c} END AS {c}" for c, v in values.items())
        self.add(f"SELECT * REPLACE ({sets}) FROM PREV")

    def rules(self, entries) -> None:
        for match, values in entries:
            cond = " AND ".join(sql_test(c, w) for c, w in match.items())
            self.edit(cond, {c: q(v) for c, v in values.items()})


def sql_suffix(key: str, form: str) -> str:
    branches = " ".join(f"WHEN starts_with({form}, {q(r)}) THEN {key} || {q(s)}" for r, s in X.REGION_SUFFIXES.items())
    return f"CASE WHEN {form} IS NULL THEN {key} {branches} ELSE {key} || lower(left({form}, 2)) END"


def sql_label(form: str, gen: int) -> str:
    if gen < 7:
        return form
    branches = " ".join(f"WHEN starts_with({form}, {q(r)}) THEN {q(r + ' Form')}" for r in X.REGION_SUFFIXES)
    return f"CASE {branches} ELSE {form} END"


def edge_sql(gen: int) -> str:
    s = Steps()
    pairs = ", ".join("[" + ", ".join(q(x) for x in p) + "]" for p in PAIRS)
    s.add(f"""SELECT p_partkey AS k, p_partkey // {PER_PAGE} AS page_id, p_size, p_partkey % 2 = 0 AS listed,
        [{pairs}][p_partkey // 2 % {len(PAIRS)} + 1] AS pr, {sql_list(TEXTS)}[p_partkey // 3 % {len(TEXTS)} + 1] AS txt FROM part""")
    s.add("""SELECT k, page_id, p_size, txt, CASE WHEN listed THEN pr[1] ELSE lpad((k % 1000)::VARCHAR, 4, '0') END AS f,
        CASE WHEN listed THEN pr[3] ELSE lpad(((k + 1) % 1000)::VARCHAR, 4, '0') END AS t,
        CASE WHEN listed THEN NULLIF(pr[2], '') END AS ff, CASE WHEN listed THEN NULLIF(pr[4], '') END AS tf FROM PREV""")
    method = f"{sql_list(V.METHODS)}[page_id % 5 + 1]"
    if gen == 1:
        # the first generation does not trim; the cell holds blanks around its text
        texts = f"{sql_replace(q(' ') + ' || txt || ' + q(' '), V.FIRST_GEN_CUTS)} AS item_used, '' AS item_held, '' AS other_condition"
    else:
        texts = (f"CASE WHEN {method} = 'stone' THEN {sql_replace('trim(txt)', V.STONE_CUTS[gen])} ELSE '' END AS item_used, "
                 f"CASE WHEN {method} = 'trade' THEN {sql_replace('trim(txt)', V.TRADE_CUTS)} ELSE '' END AS item_held, "
                 f"CASE WHEN {method} NOT IN ('stone', 'trade') THEN {sql_replace('trim(txt)', V.OTHER_CUTS[gen])} ELSE '' END AS other_condition")
    rest = [c for c in edges.WIDE if c not in ("evolves_from", "evolves_from_form", "evolves_to", "evolves_to_form",
                                               "method", "level", "item_used", "item_held", "other_condition")]
    s.add(f"""SELECT {sql_suffix('f', 'ff')} AS evolves_from, {sql_label('ff', gen)} AS evolves_from_form,
        {sql_suffix('t', 'tf')} AS evolves_to, {sql_label('tf', gen)} AS evolves_to_form, {method} AS method,
        CASE WHEN p_size % 3 = 0 THEN p_size::VARCHAR ELSE '' END AS level, {texts},
        {', '.join(f"'' AS {c}" for c in rest)}, 0 AS stage, page_id, k FROM PREV""")
    s.rules(V.of_gen(V.FIRST_RULES, gen))
    for i, row in enumerate(V.ADDED.get(gen, [])):
        vals = ", ".join(f"{q(row.get(c, ''))} AS {c}" for c in edges.WIDE)
        s.add(f"SELECT * FROM PREV UNION ALL BY NAME SELECT {vals}, 1 AS stage, 0 AS page_id, {i} AS k")
    for form in V.DROPPED_FORMS.get(gen, []):
        s.add(f"SELECT * FROM PREV WHERE evolves_to_form IS DISTINCT FROM {q(form)}")
    if gen >= 6:
        copies = " UNION ALL ".join(
            f"SELECT * REPLACE ({q(a)} AS evolves_from, {q(b)} AS evolves_to, 2 AS stage) FROM PREV WHERE evolves_from = {q(V.COPIED_FROM)}"
            for a, b in V.COPIES)
        s.add(f"SELECT * FROM PREV UNION ALL {copies}")
    s.rules(V.of_gen(V.SECOND_RULES, gen))
    rank = f"list_position({sql_list(V.METHODS)}, method)"
    if gen in V.FIRST_RANK:
        rank = f"CASE WHEN {sql_test('evolves_to', V.FIRST_RANK[gen])} THEN 1 ELSE {rank} END"
    games = f"list_position({sql_list(V.GAMES[gen])}, versions)" if gen in V.GAMES else "0"
    keys = ["evolves_from", "evolves_to", *V.EXTRA_KEYS.get(gen, [])] + (["stage = 1"] if gen == 9 else [])
    s.add(f"""SELECT *, {rank} AS method_rank, {games} AS games_rank FROM PREV QUALIFY row_number() OVER (PARTITION BY {', '.join(keys)}
        ORDER BY {rank}, {games}, stage, page_id, k) = 1""")
    if gen >= 2:
        s.rules(V.of_gen(V.BEFORE_MOVES, gen))
        for text, target, value in V.of_gen(V.MOVES, gen):
            found = f"(contains(item_used, {q(text)}) OR contains(other_condition, {q(text)}))"
            s.edit(found, {target: q(value)})
            s.add(f"SELECT * REPLACE (replace(item_used, {q(text)}, '') AS item_used, replace(other_condition, {q(text)}, '') AS other_condition) FROM PREV")
        s.rules(V.of_gen(V.AFTER_MOVES, gen))
        if gen >= 4:
            s.edit("suffix(item_used, ', ')", {"item_used": "rtrim(item_used, ', ')"})
            s.edit("suffix(item_used, ',')", {"item_used": "rtrim(item_used, ',')"})
            s.edit("starts_with(other_condition, ', ')", {"other_condition": "substr(other_condition, 3)"})
            s.edit("suffix(other_condition, ', ')", {"other_condition": "rtrim(other_condition, ', ')"})
            s.edit("suffix(other_condition, 'learned')", {
                "move_learned": "substr(other_condition, 7, greatest(0, length(other_condition) - 14))", "method": "'level'", "other_condition": "''"})
            s.edit("starts_with(other_condition, 'hold ')", {"item_held": "substr(other_condition, 6)", "method": "'level'", "other_condition": "''"})
        s.edit("starts_with(other_condition, 'Attack')", {"stat": "other_condition", "other_condition": "''"})
    s.rules(V.of_gen(V.LAST_RULES, gen))
    texts_out = [c for c in V.COLUMNS[gen] if c != "level"]
    outs = {c: f"NULLIF({c}, '')" for c in texts_out}
    if gen >= 3:
        outs["other_condition"] = "upper(left(NULLIF(other_condition, ''), 1)) || substr(other_condition, 2)"
    where = []
    if V.KEY_LIMIT[gen]:
        for key in ("evolves_from", "evolves_to"):
            where += [f"{key} BETWEEN '0001' AND {q(V.KEY_LIMIT[gen])}", f"NOT regexp_matches({key}, {q('^' + V.NOT_IN_GEN[gen])})"]
    if gen in V.DROPPED_ROWS:
        where.append("NOT (" + " AND ".join(f"{c} = {q(v)}" for c, v in V.DROPPED_ROWS[gen].items()) + ")")
    if gen in V.EXCLUDED:
        where.append(f"NOT ({sql_test('evolves_to', V.EXCLUDED[gen])})")
    cond = f"WHERE {' AND '.join(where)}" if where else ""
    final = f"s{len(s.ctes) - 1}"
    cols = ", ".join(f"{v} AS {c}" for c, v in outs.items())
    place = "row_number() OVER (ORDER BY evolves_from, evolves_to, method_rank, games_rank, stage, page_id, k) - 1 AS position"
    rows = f"SELECT {cols}, TRY_CAST(level AS DOUBLE) AS level, {place} FROM {final} {cond}"
    # columns without any value are dropped by the job; here they are counted
    used = " + ".join(f"(count({c}) > 0)::BIGINT" for c in V.COLUMNS[gen]) if gen >= 2 else f"{len(V.COLUMNS[gen])} + 0 * count(*)"
    return f"WITH {', '.join(s.ctes)}, t AS ({rows}) SELECT t.*, u.columns_kept FROM t, (SELECT {used} AS columns_kept FROM t) u"


def register(gen: int) -> None:
    @query(f"evo_g{gen}", edge_sql(gen))
    def run(spark, sf):
        kept = finished(edges.evolutions(method_pages(spark, sf), gen)[0])
        gone = [F.lit(None).cast("string").alias(c) for c in V.COLUMNS[gen] if c not in kept.columns]
        n = len([c for c in V.COLUMNS[gen] if c in kept.columns])
        return kept.select("*", *gone, F.lit(n).cast("bigint").alias("columns_kept"))


for _gen in range(1, 10):
    register(_gen)



@query("evo_quarantine", f"""
    WITH k AS (SELECT p_partkey // {PER_PAGE} AS page_id, {LOST_KEY} AS no_key, (p_partkey // {PER_PAGE}) % 7 = 3 AS no_method FROM part)
    SELECT page_id, CASE WHEN no_key AND no_method THEN 'evolves_to: missing; method: unknown'
      WHEN no_key THEN 'evolves_to: missing' ELSE 'method: unknown' END AS reasons, count(*) AS n
    FROM k WHERE no_key OR no_method GROUP BY ALL""")
def quarantine(spark, sf):
    bad = edges.evolutions(method_pages(spark, sf, broken=True), 8)[1]
    return bad.groupBy("page_id", F.array_join("errors", "; ").alias("reasons")).agg(F.count("*").alias("n"))
