"""Learnset tables, from pages that Spark renders out of ``part``."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions.literals import sql_value
from folioweave.plans import learnsets
from folioweave.queries.registry import finished, query, spread_table

C = F.col


def lit(s: str) -> str:
    return sql_value(s)


def concat(*parts: str) -> str:
    return f"concat({', '.join(parts)})"


def section(caption: str, rows: str) -> str:
    head = caption.replace("&", "&amp;")
    return concat(lit(f"<table><tr><td><b>{head}</b></td></tr><tr><td>Name</td><td>Type</td></tr>"), rows, lit("</table>"))


def move(body: str, value: str = "'x'", attrs: str = "") -> str:
    """A move row and its description row."""
    return concat(lit(f'<tr><td class="fooinfo"{attrs}>'), value, lit('</td><td class="fooinfo"><a href="/m">'), body,
                  lit('</a></td></tr><tr><td class="text">about it</td></tr>'))


FIRST, SECOND = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"
# level-up: both words, the first one twice for every fourth page; broken pages lose a value
BROKEN = "p_partkey % 50 = 9"


def page_sql(gen: int) -> str:
    roman = {1: "I", 2: "II"}[gen]
    level = concat(
        move(FIRST, "CASE WHEN p_size % 3 = 0 THEN '—' ELSE CAST(p_size AS STRING) END"),
        move(SECOND, f"CASE WHEN {BROKEN} THEN '' ELSE CAST(p_partkey % 60 AS STRING) END"),
        f"CASE WHEN p_partkey % 4 = 0 THEN {move(FIRST, lit('99'))} ELSE '' END")
    tm = concat(move(SECOND, concat(lit("TM"), "CAST(p_size AS STRING)")), move("p_type", lit("HM01")))
    key = concat(lit("#"), "CAST(p_partkey AS STRING)")
    head = ("<td class=\"fooinfo\">x</td>" * 3 + '<td class="fooinfo">') if gen == 1 else ("<td>x</td>" * 11 + "<td>")
    parts = [lit(f"<html><table><tr>{head}"), key, lit("</td></tr></table>"), section(f"Generation {roman} Level Up", level),
             section("TM & HM Attacks", tm)]
    if gen == 2:
        parts.append(f"CASE WHEN p_size % 2 = 0 THEN {section('Egg Moves (Details)', concat(move(FIRST), move(lit('Bite'))))} ELSE '' END")
        parts.append(section("Crystal Move Tutor Attacks", move(lit("Bite"))))
        parts.append(section("Gen I Only Moves", move(SECOND, lit("TM90"), ' colspan="2"')))
    return concat(*parts, lit("</html>"))


def learn_sql(gen: int) -> str:
    key = "lpad(p_partkey::VARCHAR, greatest(4, length(p_partkey::VARCHAR))::INTEGER, '0')"
    ok = f"FROM part WHERE NOT ({BROKEN})"
    joins = "lv FULL JOIN tm USING (dex_no, move)"
    more = ""
    if gen == 2:
        more = f""", eg AS (SELECT {key} AS dex_no, unnest([{FIRST}, 'Bite']) AS move, 'Egg' AS egg_moves {ok} AND p_size % 2 = 0),
        ct AS (SELECT {key} AS dex_no, 'Bite' AS move, '4000 Coins' AS crystal_move_tutor {ok}),
        g1 AS (SELECT {key} AS dex_no, {SECOND} AS move, 'TM90' AS g1_tm_hm {ok})"""
        joins += " FULL JOIN eg USING (dex_no, move) FULL JOIN ct USING (dex_no, move) FULL JOIN g1 USING (dex_no, move)"
    extra = ", egg_moves, crystal_move_tutor, g1_tm_hm" if gen == 2 else ""
    return f"""WITH lv AS (
          SELECT {key} AS dex_no, {FIRST} AS move, CASE WHEN p_size % 3 = 0 THEN '—' ELSE p_size::VARCHAR END AS level_raw {ok}
          UNION ALL SELECT {key}, {SECOND}, (p_partkey % 60)::VARCHAR {ok}
          UNION ALL SELECT {key}, {FIRST}, '99' {ok} AND p_partkey % 4 = 0),
        tm AS (SELECT {key} AS dex_no, {SECOND} AS move, 'TM' || p_size AS tm_hm {ok} UNION ALL SELECT {key}, p_type, 'HM01' {ok}){more}
        SELECT dex_no, move, TRY_CAST(level_raw AS DOUBLE) AS level, level_raw, tm_hm{extra}, {gen}::INTEGER AS gen,
          row_number() OVER (ORDER BY dex_no, CASE WHEN level_raw IS NULL THEN 2 WHEN TRY_CAST(level_raw AS INTEGER) IS NULL THEN 1 ELSE 0 END,
            TRY_CAST(level_raw AS INTEGER) NULLS LAST, level_raw NULLS LAST, tm_hm NULLS LAST, move) - 1 AS position FROM {joins}"""


def pages(spark, sf, gen):
    return spread_table(spark, sf, "part", "p_partkey", "p_name", "p_type", "p_size").select(
        C("p_partkey").alias("page_id"), F.lit("https://dex.example.org/learn/").alias("url"), F.expr(page_sql(gen)).alias("html"))


def register(gen: int) -> None:
    @query(f"learnsets_g{gen}", learn_sql(gen))
    def run(spark, sf):
        return finished(learnsets.learnsets(pages(spark, sf, gen), gen)[0])


register(1)
register(2)


@query("learnsets_two_tables", f"""
    SELECT lpad(p_partkey::VARCHAR, greatest(4, length(p_partkey::VARCHAR))::INTEGER, '0') AS dex_no, u.move, u.level, u.egg_moves FROM part,
      unnest([{{'move': {FIRST}, 'level': '1', 'egg_moves': NULL}}, {{'move': 'Growl', 'level': p_size::VARCHAR, 'egg_moves': NULL}},
              {{'move': 'Bite', 'level': NULL, 'egg_moves': 'Egg'}}, {{'move': 'Charm', 'level': NULL, 'egg_moves': 'Egg'}}]) AS t(u)""")
def two_tables(spark, sf):
    head = "<td>x</td>" * 11 + "<td>"
    page = concat(lit(f"<html><table><tr>{head}#"), "CAST(p_partkey AS STRING)", lit("</td></tr></table>"),
                  section("Generation II Level Up", move(FIRST, lit("1"))), section("TM & HM Attacks", lit("")),
                  section("Generation II Level Up", move(lit("Growl"), "CAST(p_size AS STRING)")),
                  section("Egg Moves (Details)", move(lit("Bite"))), section("Egg Moves", move(lit("Charm"))), lit("</html>"))
    rows = spread_table(spark, sf, "part", "p_partkey", "p_name", "p_size").select(
        C("p_partkey").alias("page_id"), F.lit("https://dex.example.org/learn/").alias("url"), F.expr(page).alias("html"))
    return learnsets.learnsets(rows, 2)[0].select("dex_no", "move", C("level_raw").alias("level"), "egg_moves")


@query("learnsets_quarantine", f"""
    SELECT p_partkey AS page_id, 'level: moves and values differ in number' AS reasons FROM part WHERE {BROKEN}""")
def quarantine(spark, sf):
    bad = learnsets.learnsets(pages(spark, sf, 2), 2)[1]
    return bad.select("page_id", F.array_join("errors", "; ").alias("reasons"))
