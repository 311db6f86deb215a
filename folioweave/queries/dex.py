"""Dex tables, from pages that Spark renders out of ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions.literals import sql_value
from folioweave.operators import plan
from folioweave.plans import dex
from folioweave.plans import dex_values as V
from folioweave.queries.registry import finished, query, spread_table, table

C = F.col

KEY = "lpad(CAST(p_partkey % 10000 AS {str}), 4, '0')"
TYPE1 = "CASE p_partkey % 3 WHEN 0 THEN 'fire' WHEN 1 THEN 'water' ELSE 'grass' END"
TYPE2 = "CASE p_size % 2 WHEN 0 THEN 'rock' ELSE 'ice' END"
FIRST, SECOND = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"


def variant(gen: int) -> str:
    """0 one form; 1 two forms with own types; 2 two forms, shared types; 3 special form, or three forms."""
    return "p_partkey % 4"


def stat(form: int, k: int) -> str:
    return f"CAST((p_partkey * {k + 1} + {form * 17} + p_size) % 150 AS INT)"


def concat(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def lit(s: str) -> str:
    return sql_value(s)


def row(*cells: str) -> str:
    return concat(lit("<tr>"), *cells, lit("</tr>"))


def td(body: str, attrs: str = "") -> str:
    return concat(lit(f"<td{attrs}>"), body, lit("</td>"))


def labels(*names: str, bold: bool = False) -> str:
    return lit("<tr>" + "".join(f"<td class=\"fooevo\">{f'<b>{n}</b>' if bold else n}</td>" for n in names) + "</tr>")


def box(*rows: str, attrs: str = ' class="dextable"') -> str:
    return concat(lit(f"<table{attrs}>"), *rows, lit("</table>\n"))


def icon(path: str, word: str) -> str:
    return concat(lit(f'<img src="{path}'), word, lit('.gif">'))


def page_sql(gen: int) -> str:
    path, v = V.TYPE_PATH[gen], variant(gen)
    head = "h2" if gen >= 7 else "b"
    one_type, two_type = icon(path, TYPE1), concat(icon(path, TYPE1), icon(path, TYPE2))

    def type_row(form: str, icons: str) -> str:
        return row(td(lit(form), ' width="50%"'), td(icons))
    types = (f"CASE WHEN {v} = 1 THEN " + box(type_row("Plant Form", one_type), type_row("Sandy Form", two_type), attrs="")
             + f" ELSE {two_type} END")
    shares = "CASE p_size % 3 WHEN 1 THEN '87.5' ELSE '0' END", "CASE p_size % 3 WHEN 1 THEN '12.5' ELSE '100' END"
    known = box(row(td(lit("Male:")), td(concat(shares[0], lit("%")))), row(td(lit("Female:")), td(concat(shares[1], lit("%")))), attrs="")
    gender = f"CASE WHEN p_size % 3 = 0 THEN {lit('is ' + V.NO_RATIO[gen])} ELSE {known} END"
    height = concat("CAST(p_size % 12 AS STRING)", lit("'0"), "CAST(p_partkey % 10 AS STRING)", lit('"'))
    weight = concat("format_number(p_retailprice, 1)", lit("lbs"))
    main = box(
        labels("Name", "Other", "No.", "Gender Ratio", "Type"),
        row(td("p_name", ' class="fooinfo"'), td(lit("o")), td(lit("n")), td(gender, ' class="fooinfo"'), td(types, ' class="cen"')),
        labels("Classification", "Height", "Weight", "Capture Rate", "Base Egg Steps"),
        row(td(concat("p_brand", lit(V.CLASS_END)), ' class="fooinfo"'), td(height, ' class="fooinfo"'), td(weight, ' class="fooinfo"'),
            td("CAST(p_size * 3 AS STRING)"), td("CASE WHEN p_size % 7 = 0 THEN '&nbsp;' ELSE format_number(p_size * 256, 0) END" if gen >= 6
                                                 else "format_number(p_size * 256, 0)")),
    )
    national = box(row(td(lit("<b>National</b>")), td(concat(lit("#"), KEY.format(str="STRING")))))
    parts = [lit("<html><body>"), national, main]
    if gen == 4:
        parts.append(box(labels("a", "b", "c", "Colour"), row(td(lit("-")), td(lit("-")), td(lit("-")), td("p_type"))))
        parts.append(box(labels("Ability", bold=True), row(td(concat(lit("<a><b>"), FIRST, lit("</b></a> &amp; <b>"), SECOND, lit("</b>"))))))
    else:
        parts.append(box(row(td(concat(lit("<b>Abilities</b>: <a><b>"), FIRST, lit("</b></a> - <b>"), SECOND, lit("</b> "))))))
    ev_two = lit("<b>Plant Form</b><br>2 HP<br><b>Sandy Form</b><br>1 Speed<br>")
    ev_one = concat("CAST(1 + p_size % 3 AS STRING)", lit(" Attack<br>2 Sp. Defense<br>"))
    evs = f"CASE WHEN {v} = 1 THEN {ev_two} " + (f"WHEN p_size % 10 = 0 THEN '' " if gen >= 6 else "") + f"ELSE {ev_one} END"
    extra = V.EXTRA[gen][1] if gen in V.EXTRA else "x"
    extra_text = "CASE WHEN p_size % 2 = 0 THEN 'this one can Dynamax' ELSE 'it could not Dynamax' END" if gen == 8 else "p_type"
    parts.append(box(labels("Experience Growth", "Base Happiness", "Effort Values Earned", extra),
                     row(td(lit("1,000,000 Points<br>Fast")), td(lit("70")), td(evs, ' class="fooinfo"'), td(extra_text))))
    parts.append(box(labels("Egg Groups"), row(td(lit("-"), ' class="fooinfo"'), td(
        f"CASE WHEN p_size % 5 = 0 THEN {lit('It ' + V.CANNOT_BREED)} WHEN p_size % 5 = 1 THEN '<a>Monster</a>' ELSE '<a>Monster</a><br><a>Grass</a>' END",
        ' class="fooinfo"'))))
    def names(*fs: str) -> str:
        if gen == 9:
            return lit("<tr><td><table><tr>" + "".join(f"<td><b>{f}</b></td>" for f in fs) + "</tr><tr><td>x</td></tr></table></td></tr>")
        return lit("<tr>" + "".join(f"<td><b>{f}</b></td>" for f in fs) + "</tr>")
    two = names("Plant Form", "Sandy Form")
    three = names("Plant Form", "Sandy Form", "Trash Form")
    listed = f"CASE WHEN {v} = 0 THEN '' " + (f"WHEN {v} = 3 THEN '' " if gen >= 6 else f"WHEN {v} = 3 THEN {three} ") + f"ELSE {two} END"
    parts.append(box(labels("Alternate Forms"), listed))
    def stats(form: int) -> str:
        nums = [td(f"CAST({stat(form, k)} AS STRING)", ' class="fooinfo"') for k in range(6)]
        return box(lit(f'<tr><td class="fooevo"><{head}>Stats</{head}></td></tr>'), row(td(lit("Base Stats"), ' class="fooinfo"'), *nums))
    parts.append(stats(0))
    if gen >= 6:
        tag = "b" if gen <= 7 else "h2"
        mega = concat(
            box(lit(f'<tr><td class="fooevo" colspan="6"><{tag}>Mega Evolution</{tag}></td></tr>')),
            box(labels("Name", "Other", "No.", "Gender Ratio", "Type"),
                row(td(lit("m")), td(lit("m")), td(lit("m")), td(lit("-")), td(icon(path, TYPE2), ' class="cen"')),
                labels("Classification", "Height", "Weight", "Capture Rate", "Base Egg Steps"),
                row(td(lit("m")), td(concat(lit("7'0"), "CAST(p_partkey % 10 AS STRING)", lit('"'))), td(lit("1,234.5lbs")), td(lit("1")), td(lit("1")))),
            box(row(td(lit("<b>Abilities</b>: <b>Tough</b>")))))
        parts.append(f"CASE WHEN {v} = 3 THEN {mega} ELSE '' END")
    parts.append(f"CASE WHEN {v} = 0 THEN '' ELSE {stats(1)} END")
    parts.append(lit("</body></html>"))
    return concat(*parts)


def dex_sql(gen: int) -> str:
    v = variant(gen)
    last = "['', 'Mega Evolution']" if gen >= 6 else "['Plant Form', 'Sandy Form', 'Trash Form']"
    special = f"({v} = 3 AND i = 1)" if gen >= 6 else "false"
    def cap(w: str) -> str:
        return f"(upper(left({w}, 1)) || substr({w}, 2))"
    # which stat table a form reads
    table_no = f"CASE WHEN {v} = 0 THEN 0 WHEN {v} = 3 AND {'false' if gen >= 6 else 'true'} THEN least(i, 1) ELSE i END"
    one_type = f"({v} = 1 AND i = 0)"
    cols = {
        "page_id": "p_partkey",
        "dex_no": KEY.format(str="VARCHAR") + f" || CASE WHEN {special} THEN 'meg' ELSE lower(left(form, 2)) END",
        "name": "p_name", "form": "form", "class": "p_brand",
        "height_ft": f"round(CASE WHEN {special} THEN 7 ELSE p_size % 12 END + (p_partkey % 10) / 12.0::DOUBLE, 2)",
        "weight_lb": f"CASE WHEN {special} THEN 1234.5 ELSE round(p_retailprice, 1) END::DOUBLE",
        "male_female_rate": "CASE p_size % 3 WHEN 0 THEN 'N/A' WHEN 1 THEN '7:1' ELSE 'Always female' END",
        "type_one": f"CASE WHEN {special} THEN {cap(TYPE2)} ELSE {cap(TYPE1)} END",
        "type_two": f"CASE WHEN {special} OR {one_type} THEN '' ELSE {cap(TYPE2)} END",
    }
    if gen == 4:
        cols.update({"color": "p_type", "ability_one": FIRST, "ability_two": SECOND})
    else:
        pair = f"{FIRST} || '|' || {SECOND}"
        # generations 8 and 9 repeat the base abilities three times, so the second form still reads those
        cols["abilities"] = f"CASE WHEN {special} THEN 'Tough' ELSE {pair} END" if gen < 8 else pair
    for k, c in enumerate(V.BASE_STATS):
        cols[c] = f"CASE WHEN ({table_no}) = 0 THEN {stat(0, k)} ELSE {stat(1, k)} END"
    blank = "p_size % 7 = 0" if gen >= 6 else "false"
    none = f"(p_size % 10 = 0 AND {v} <> 1)" if gen >= 6 else "false"
    cols.update({
        "cptr_rt": "p_size * 3", "exp_growth": "'Fast'",
        "base_egg_steps": f"CASE WHEN {blank} THEN NULL ELSE p_size * 256 END",
        "base_egg_steps_raw": f"CASE WHEN {blank} THEN 'N/A' ELSE (p_size * 256)::VARCHAR END",
        "egg_group_one": f"CASE WHEN p_size % 5 = 0 THEN '{V.NO_EGGS}' ELSE 'Monster' END",
        "egg_group_two": "CASE WHEN p_size % 5 IN (0, 1) THEN '' ELSE 'Grass' END",
    })
    if gen in V.EXTRA:
        cols[V.EXTRA[gen][0]] = "CASE WHEN p_size % 2 = 0 THEN 'Yes' ELSE 'No' END" if gen == 8 else "p_type"
    cols["evs_raw"] = (f"CASE WHEN {none} THEN '{V.NOT_LISTED}' WHEN {v} = 1 AND i = 0 THEN '2 HP' WHEN {v} = 1 THEN '1 Speed' "
                       "ELSE (1 + p_size % 3)::VARCHAR || ' Attack, 2 Sp. Defense' END")
    values = {"hp_evs": ("2", "0", "0"), "atk_evs": ("0", "0", "1 + p_size % 3"), "def_evs": ("0", "0", "0"),
              "sp_atk_evs": ("0", "0", "0"), "sp_def_evs": ("0", "0", "2"), "speed_evs": ("0", "1", "0")}
    for c, (a, b, d) in values.items():
        cols[c] = f"CASE WHEN {none} THEN NULL WHEN {v} = 1 AND i = 0 THEN {a} WHEN {v} = 1 THEN {b} ELSE {d} END::INTEGER"
    cols["gen"] = f"{gen}::INTEGER"
    picked = ", ".join(f"{e} AS {c}" for c, e in cols.items())
    gone = ", ".join(f"'{k}'" for k in V.DROPPED_KEYS.get(gen, []))
    where = f"WHERE {cols['dex_no']} NOT IN ({gone})" if gone else ""
    return f"""WITH f AS (SELECT part.*, u.form, (u.pos - 1)::INTEGER AS i FROM part,
        unnest(CASE {v} WHEN 0 THEN [''] WHEN 3 THEN {last} ELSE ['Plant Form', 'Sandy Form'] END) WITH ORDINALITY AS u(form, pos))
        SELECT {picked}, row_number() OVER (ORDER BY {KEY.format(str="VARCHAR")}, i, p_partkey) - 1 AS position FROM f {where}"""


PART = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


def dex_pages(spark, sf, gen):
    return spread_table(spark, sf, "part", *PART).select(
        C("p_partkey").alias("page_id"), F.lit("https://dex.example.org/dex/").alias("url"), F.expr(page_sql(gen)).alias("html"))


def register(gen: int) -> None:
    @query(f"dex_g{gen}", dex_sql(gen))
    def run(spark, sf):
        good = finished(dex.dex(dex_pages(spark, sf, gen), gen)[0])
        return good if gen == 4 else good.withColumn("abilities", F.array_join("abilities", "|"))


for _gen in range(4, 10):
    register(_gen)


# ---------------------------------------------------------------- generations 1 to 3


def cells(texts: list[str], cls: str | None) -> list[str]:
    return [td(t, f' class="{cls}"' if cls else "") for t in texts]


def key4(engine: str) -> str:
    return KEY.format(str=engine)


def page_g1() -> str:
    height = concat("CAST(p_size % 12 AS STRING)", lit("'0"), "CAST(p_partkey % 10 AS STRING)", lit('"'))
    info = [lit("x"), lit("x"), "p_name", concat(lit("#"), "CAST(p_partkey AS STRING)"), concat("p_brand", lit(V.CLASS_END)), height,
            lit("x"), concat("CAST(p_size AS STRING)", lit(".5lbs")), lit("x"), "CAST(p_size * 3 AS STRING)", lit("x"),
            f"CASE WHEN p_size % 2 = 0 THEN {lit(V.SLOW_RATE[0])} ELSE 'Fast' END", lit("x")]
    tail = [f"CAST({stat(0, k)} AS STRING)" for k in range(5)] + [lit("y")] * 13
    icons = f"CASE WHEN p_size % 2 = 0 THEN {icon(V.TYPE_PATH[1], TYPE1)} ELSE {concat(icon(V.TYPE_PATH[1], TYPE1), icon(V.TYPE_PATH[1], TYPE2))} END"
    sprite = concat(lit('<img src="/pokedex/icon/'), KEY.format(str="STRING"), lit('.png">'))
    return concat(lit("<html>"), box(row(td(sprite)), attrs=' class="dextab"'), box(row(td(icons, ' class="cen"'))),
                  box(row(*cells(info, "fooinfo")), row(*cells(tail, "fooinfo"))), lit("</html>"))


def stats_sql(names: list[str]) -> str:
    return ", ".join(f"{stat(0, k)} AS {n}" for k, n in enumerate(names))


def cap(w: str) -> str:
    return f"(upper(left({w}, 1)) || substr({w}, 2))"


FEET = "round(p_size % 12 + (p_partkey % 10) / 12.0::DOUBLE, 2)"
RATIO = "CASE p_size % 3 WHEN 0 THEN 'N/A' WHEN 1 THEN '7:1' ELSE 'Always female' END"
WHOLE_KEY = "lpad(p_partkey::VARCHAR, greatest(4, length(p_partkey::VARCHAR))::INTEGER, '0')"


def small_pages(spark, sf, sql):
    return spread_table(spark, sf, "part", *PART).select(C("p_partkey").alias("page_id"), F.lit("https://dex.example.org/").alias("url"), F.expr(sql).alias("html"))


BY_KEY = f"row_number() OVER (ORDER BY {WHOLE_KEY}, p_partkey) - 1 AS position"


@query("dex_g1", f"""
    SELECT {BY_KEY}, p_partkey AS page_id, {WHOLE_KEY} AS dex_no, p_name AS name, {key4('VARCHAR')} AS sprite, {cap(TYPE1)} AS type_one,
      CASE WHEN p_size % 2 = 0 THEN '' ELSE {cap(TYPE2)} END AS type_two, p_brand AS class, {FEET} AS height_ft, p_size + 0.5::DOUBLE AS weight_lb,
      p_size * 3 AS cptr_rt, CASE WHEN p_size % 2 = 0 THEN 'Slow' ELSE 'Fast' END AS exp_rt,
      {stats_sql(['hp', 'atk', 'def', 'special', 'speed'])}, 1::INTEGER AS gen FROM part""")
def dex_g1(spark, sf):
    return finished(dex.dex(small_pages(spark, sf, page_g1()), 1)[0])


def page_g2() -> str:
    height = concat("CAST(p_size % 12 AS STRING)", lit("'0"), "CAST(p_partkey % 10 AS STRING)", lit('"'))
    shares = "CASE p_size % 3 WHEN 1 THEN '87.5' ELSE '0' END", "CASE p_size % 3 WHEN 1 THEN '12.5' ELSE '100' END"
    known = box(row(td(lit("Male:")), td(concat(shares[0], lit("%")))), row(td(lit("Female:")), td(concat(shares[1], lit("%")))), attrs="")
    gender = f"CASE WHEN p_size % 3 = 0 THEN 'Genderless' ELSE {known} END"
    icons = concat(icon(V.TYPE_PATH[2], TYPE1), icon(V.TYPE_PATH[2], TYPE2))
    plain = [lit("x")] * 11 + [concat(lit("#"), "CAST(p_partkey AS STRING)")]
    info = ["p_name", lit("x"), lit("x"), lit("x"), gender, concat("p_brand", lit(V.CLASS_END)), lit("x"), lit("x"),
            "CAST(p_size * 3 AS STRING)", "format_number(p_size * 256, 0)", lit("1,000,000 Points<br>Fast")]
    tail = [f"CAST({stat(0, k)} AS STRING)" for k in range(6)] + [lit("y")] * 15
    sizes = box(lit("<tr><td>Name</td><td>Height</td><td>Weight</td></tr>"),
                row(td(lit("n")), td(height), td(concat("CAST(p_size AS STRING)", lit(".5lbs")))))
    eggs = box(row(td("CASE p_size % 3 WHEN 0 THEN 'none' WHEN 1 THEN '<a>Monster</a>' ELSE '<a>Monster</a> <a>Grass</a>' END")), attrs=' class="dexitem"')
    return concat(lit("<html>"), box(row(td(lit('<img src="/pokedex-gs/icon/ab-12.png">'), ' class="p"')), attrs=' class="dextab"'),
                  box(row(*cells(plain, None))), box(row(td(icons, ' class="cen"'))), box(row(*cells(info, "fooinfo"))), sizes, eggs,
                  box(row(*cells(tail, "fooinfo"))), lit("</html>"))


@query("dex_g2", f"""
    SELECT {BY_KEY}, p_partkey AS page_id, {WHOLE_KEY} AS dex_no, p_name AS name, 'Ab-12' AS sprite, {cap(TYPE1)} AS type_one, {cap(TYPE2)} AS type_two,
      p_brand AS class, {FEET} AS height_ft, p_size + 0.5::DOUBLE AS weight_lb, p_size * 3 AS cptr_rt, 'Fast' AS exp_rt,
      {stats_sql(['hp', 'atk', 'def', 'sp_atk', 'sp_def', 'speed'])}, {RATIO} AS male_female_rate, p_size * 256 AS base_egg_steps,
      CASE WHEN p_size % 3 = 0 THEN '{V.NO_EGGS}' ELSE 'Monster' END AS egg_group_one, CASE WHEN p_size % 3 = 2 THEN 'Grass' ELSE '' END AS egg_group_two,
      2::INTEGER AS gen FROM part""")
def dex_g2(spark, sf):
    return finished(dex.dex(small_pages(spark, sf, page_g2()), 2)[0])


def page_g3() -> str:
    height = concat("CAST(p_size % 12 AS STRING)", lit("'0"), "CAST(p_partkey % 10 AS STRING)", lit('"'))
    info = [lit("x"), lit("x"), lit("x"), "CAST(p_partkey AS STRING)", lit("x"), "p_name"]
    path = V.TYPE_PATH[3]
    icons = concat(icon(path, TYPE1), f"CASE WHEN p_size % 2 = 0 THEN {lit(f'<img src={chr(34)}{path}na.gif{chr(34)}>')} ELSE {icon(path, TYPE2)} END")
    gender = box(lit("<tr><td><b>Gender Ratio</b></td></tr>"), row(
        td("CASE p_size % 3 WHEN 0 THEN 'Genderless' WHEN 1 THEN 'Male: 87.5 %' ELSE 'Male: 0 %' END"),
        td("CASE p_size % 3 WHEN 1 THEN 'Female: 12.5 %' ELSE 'Female: 100 %' END")))
    size = box(lit("<tr><td>a</td><td>b</td><td>c</td><td>Height</td><td>Weight</td></tr>"), row(
        td(concat("p_brand", lit(V.CLASS_END))), td(lit("-")), td(lit("-")), td(height), td(concat("CAST(p_size AS STRING)", lit(".5 lbs")))))
    cat = box(lit("<tr><td>Dex Category</td></tr>"), row(td(lit("-")), td(lit('<img title="GROUND" src="/c.gif">')), td("lower(p_type)")))
    egg = box(lit("<tr><td>Egg Steps to Hatch</td></tr>"), row(
        td(concat("format_number(p_size * 256, 0)", lit(" Steps"))), td(lit("HP 1, Special Attack 2, Speed 3")), td("CAST(p_size * 3 AS STRING)")))
    groups = box(lit('<tr><td class="fooevo">Egg Groups</td><td>p</td><td>q</td></tr>'), row(
        td("CASE p_size % 3 WHEN 0 THEN 'Cannot Breed' ELSE 'Monster' END"), "CASE p_size % 3 WHEN 2 THEN '<td>Grass</td>' ELSE '' END"))
    ability = box(row(td(concat(lit("<b>Ability: "), FIRST, f"CASE WHEN p_size % 2 = 0 THEN {concat(lit(' &amp; '), SECOND)} ELSE '' END", lit("</b>")), ' colspan="4"')))
    def block(form: int, name: str) -> str:
        return box(lit(f'<tr><td class="fooinfo" colspan="7"><b>Stats</b>{name}</td></tr>'),
                   row(*cells([f"CAST({stat(form, k)} AS STRING)" for k in range(6)], "cen")))
    second = f"CASE WHEN p_partkey % 4 = 0 THEN {concat(block(0, ' (Attack Forme)'), block(1, ' (Defence Forme)'))} ELSE {block(0, '')} END"
    return concat(lit("<html>"), box(row(*cells(info, "fooinfo"))), box(row(td(icons))), gender, size, cat, egg, groups, ability, second, lit("</html>"))


@query("dex_g3", f"""
    WITH f AS (SELECT part.*, u.form, (u.pos - 1)::INTEGER AS i FROM part,
      unnest(CASE WHEN p_partkey % 4 = 0 THEN ['Attack forme', 'Defense forme'] ELSE [''] END) WITH ORDINALITY AS u(form, pos))
    SELECT row_number() OVER (ORDER BY {WHOLE_KEY} || lower(left(form, 2)), p_partkey) - 1 AS position,
      p_partkey AS page_id, {WHOLE_KEY} || lower(left(form, 2)) AS dex_no, p_name AS name, form, p_brand AS class, 'Ground' AS dex_cat,
      upper(left(p_type, 1)) || lower(substr(p_type, 2)) AS color, {FEET} AS height_ft, p_size + 0.5::DOUBLE AS weight_lb, {RATIO} AS male_female_rate,
      {cap(TYPE1)} AS type_one, CASE WHEN p_size % 2 = 0 THEN '' ELSE {cap(TYPE2)} END AS type_two, {FIRST} AS ability_one,
      CASE WHEN p_size % 2 = 0 THEN {SECOND} ELSE '' END AS ability_two,
      {', '.join(f"CASE WHEN i = 0 THEN {stat(0, k)} ELSE {stat(1, k)} END AS {c}" for k, c in enumerate(V.BASE_STATS))},
      p_size * 3 AS cptr_rt, p_size * 256 AS base_egg_steps, CASE WHEN p_size % 3 = 0 THEN '{V.NO_EGGS}' ELSE 'Monster' END AS egg_group_one,
      CASE WHEN p_size % 3 = 2 THEN 'Grass' ELSE '' END AS egg_group_two, 1::INTEGER AS hp_evs, 0::INTEGER AS atk_evs, 0::INTEGER AS def_evs,
      2::INTEGER AS sp_atk_evs, 0::INTEGER AS sp_def_evs, 3::INTEGER AS speed_evs, 3::INTEGER AS gen FROM f""")
def dex_g3(spark, sf):
    return finished(dex.dex(small_pages(spark, sf, page_g3()), 3)[0])


def profile_sql(gen: int) -> str:
    special = "p_partkey % 4 = 3" if gen >= 6 else "false"
    three = "0" if gen >= 6 else "3"
    abilities = f"' ' || {FIRST} || ' - ' || {SECOND}"
    texts = f"'Abilities:' || {abilities}".replace("Abilities:' || ' ' ||", "Abilities: ' ||")
    extra = ""
    if gen in V.EXTRA:
        extra = f"{'CASE WHEN p_size % 2 = 0 THEN ' + chr(39) + 'Yes' + chr(39) + ' ELSE ' + chr(39) + 'No' + chr(39) + ' END' if gen == 8 else 'p_type'} AS {V.EXTRA[gen][0]},"
    blank = "p_size % 7 = 0" if gen >= 6 else "false"
    no_evs = "p_size % 10 = 0" if gen >= 6 else "false"
    return f"""
    SELECT p_partkey AS page_id, {KEY.format(str='VARCHAR')} AS dex_no, p_name AS name,
      CASE WHEN {special} THEN 'special forms' WHEN p_partkey % 4 = 1 THEN 'types = forms = stats' WHEN p_partkey % 4 = 2 THEN 'no types, forms = stats'
        WHEN p_partkey % 4 = 3 THEN 'no types, forms differ from stats' ELSE 'types = forms, one stat table' END AS selector,
      CASE WHEN {special} THEN 1 ELSE 0 END AS special_forms, CASE WHEN p_partkey % 4 IN (1, 2) THEN 2 WHEN p_partkey % 4 = 3 THEN {three} ELSE 0 END AS forms,
      CASE WHEN p_partkey % 4 = 1 THEN 2 ELSE 0 END AS types, CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 2 END AS stats,
      CASE WHEN p_partkey % 4 = 0 THEN 1 ELSE 2 END AS stat_captions, p_brand AS class, 1 AS height_ft,
      CASE p_size % 3 WHEN 0 THEN 'N/A' WHEN 1 THEN '7:1' ELSE 'Always female' END AS male_female_rate,
      trim({texts} || CASE WHEN {special} THEN ' Abilities: Tough' ELSE '' END) AS abilities,
      CASE WHEN {special} THEN 2 ELSE 1 END AS ability_groups, length((p_size * 3)::VARCHAR)::INTEGER AS cptr_rt,
      'Fast' AS exp_growth, CASE WHEN {blank} THEN NULL ELSE p_size * 256 END AS base_egg_steps, {extra}
      CASE p_size % 5 WHEN 0 THEN '' WHEN 1 THEN 'Monster' ELSE 'Monster|Grass' END AS egg_groups,
      CASE WHEN p_partkey % 4 = 1 THEN 2 WHEN {no_evs} THEN 0 ELSE 1 END AS n_ev_blocks
    FROM part"""


def register_profile(gen: int) -> None:
    @query(f"dex_profile_g{gen}", profile_sql(gen))
    def run(spark, sf):
        df = dex.profile(dex_pages(spark, sf, gen), gen).withColumn("abilities", F.trim(F.array_join("abilities", "")))
        return df.withColumn("egg_groups", F.array_join("egg_groups", "|")).withColumn("n_ev_blocks", F.size("evs")).drop("evs")


for _gen in (5, 8):
    register_profile(_gen)


# Pages that lack something: a form's effort heading, the egg groups, or a number of steps.
LOST_HEADING, NO_GROUPS, BAD_STEPS = "p_partkey % 20 = 1", "p_partkey % 20 = 2", "p_partkey % 20 = 3"


def quarantine_sql(gen: int) -> str:
    return f"""
    SELECT p_partkey AS page_id, 'evs: no block for the form' AS reasons, 1::BIGINT AS n FROM part WHERE {LOST_HEADING} AND p_partkey % 4 = 1
    UNION ALL SELECT p_partkey, 'egg_group_one: missing', 2 FROM part WHERE {NO_GROUPS} AND p_size % 5 <> 0
    UNION ALL SELECT p_partkey, 'base_egg_steps: not a number', {2 if gen >= 6 else 3} FROM part
      WHERE {BAD_STEPS}{' AND p_size % 7 <> 0' if gen >= 6 else ''}"""


def register_quarantine(gen: int) -> None:
    @query(f"dex_quarantine_g{gen}", quarantine_sql(gen))
    def run(spark, sf):
        lost = F.replace(C("html"), F.lit("<b>Sandy Form</b><br>1 Speed"), F.lit("<b>Other Form</b><br>1 Speed"))
        bare = F.replace(F.replace(C("html"), F.lit("<a>Monster</a>"), F.lit("-")), F.lit("<a>Grass</a>"), F.lit("-"))
        steps = F.format_number(C("p_size") * 256, 0)
        bad = F.replace(C("html"), F.concat(F.lit("<td>"), steps, F.lit("</td></tr>")), F.lit("<td>many</td></tr>"))
        # the rows meet before they grow to pages
        sizes = table(spark, sf, "part").select("p_partkey", C("p_size").alias("size"))
        rows = plan.spread(table(spark, sf, "part").select(*PART).join(sizes, "p_partkey"))
        pages = rows.select(C("p_partkey").alias("page_id"), F.lit("https://dex.example.org/dex/").alias("url"),
                            F.expr(page_sql(gen)).alias("html"), "p_partkey", C("size").alias("p_size"))
        pages = pages.withColumn("html", F.when(F.expr(LOST_HEADING), lost).when(F.expr(NO_GROUPS), bare)
                                 .when(F.expr(BAD_STEPS), bad).otherwise(C("html"))).drop("p_partkey", "p_size")
        found = dex.dex(pages, gen)[1]
        return found.groupBy("page_id", F.array_join("errors", "; ").alias("reasons")).agg(F.count("*").alias("n"))


for _gen in (5, 8):
    register_quarantine(_gen)
