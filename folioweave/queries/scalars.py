"""Scalar functions over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import lists as L
from folioweave.functions import numbers as N
from folioweave.functions import text as X
from folioweave.operators import curate
from folioweave.queries.registry import query, spread_table, table

C = F.col


@query("f1_clean_ws", r"""
    SELECT doc_id,
           regexp_replace(regexp_replace(translate(text, chr(13)||chr(10)||chr(9), ''),
             '\A[\s\p{Z}]+', ''), '[\s\p{Z}]+\z', '') AS cleaned,
           CAST(length(text) AS INTEGER) AS n_raw
    FROM documents""")
def f1(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id", X.clean_ws(C("text")).alias("cleaned"), F.length("text").alias("n_raw"))


@query("f2_replace_chain", """
    SELECT p_partkey, replace(replace(replace(p_type, 'ECONOMY', 'ECO'), 'ECO', 'E'), 'STANDARD', 'E') AS short_type
    FROM part""")
def f2(spark, sf):
    pairs = [("ECONOMY", "ECO"), ("ECO", "E"), ("STANDARD", "E")]
    return table(spark, sf, "part").select("p_partkey", X.replace_all(C("p_type"), pairs).alias("short_type"))


@query("f3_zfill", """
    SELECT l_orderkey, l_linenumber,
           CASE WHEN length(l_orderkey::VARCHAR) >= 4 THEN l_orderkey::VARCHAR
                ELSE lpad(l_orderkey::VARCHAR, 4, '0') END AS key4,
           lpad(l_partkey::VARCHAR, 8, '0') AS key8
    FROM lineitem""")
def f3(spark, sf):
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        X.zfill(C("l_orderkey").cast("string"), 4).alias("key4"),
        X.zfill(C("l_partkey").cast("string"), 8).alias("key8"))


@query("f4_case", """
    WITH t AS (SELECT p_partkey, replace(p_name, ' ', '-') || ' ' || lower(p_brand) || 'xY' AS s FROM part)
    SELECT p_partkey,
           array_to_string(list_transform(regexp_extract_all(s, '\\p{L}+|[^\\p{L}]+'),
             lambda x: upper(left(x, 1)) || lower(substr(x, 2))), '') AS titled,
           upper(left(s, 1)) || lower(substr(s, 2)) AS capitalized,
           upper(left(s, 1)) || substr(s, 2) AS upper_first,
           lower(s) AS lowered
    FROM t""".replace("\\\\", "\\"))
def f4(spark, sf):
    s = F.concat(F.replace(C("p_name"), F.lit(" "), F.lit("-")), F.lit(" "), F.lower("p_brand"), F.lit("xY"))
    return table(spark, sf, "part").select("p_partkey", s.alias("s")).select(
        "p_partkey", X.title(C("s")).alias("titled"), X.capitalize(C("s")).alias("capitalized"),
        X.upper_first(C("s")).alias("upper_first"), F.lower("s").alias("lowered"))


@query("f5_strict_numbers", """
    SELECT p_partkey, TRY_CAST(replace(p_brand, 'Brand#', '') AS INTEGER) AS brand_no,
           TRY_CAST(replace(p_brand, 'Brand#1', '') AS DOUBLE) AS brand_tail,
           TRY_CAST(replace(p_brand, 'Brand#1', '') AS DOUBLE) IS NULL AS bad
    FROM part""")
def f5(spark, sf):
    tail = F.replace(C("p_brand"), F.lit("Brand#1"), F.lit(""))
    return table(spark, sf, "part").select(
        "p_partkey", N.to_int(F.replace(C("p_brand"), F.lit("Brand#"), F.lit(""))).alias("brand_no"),
        N.to_double(tail).alias("brand_tail"), N.bad_number(tail, N.to_double(tail)).alias("bad"))


@query("f6_int_or_raw", """
    WITH t AS (SELECT p_partkey, replace(p_brand, 'Brand#1', '') AS s FROM part)
    SELECT p_partkey, CASE WHEN regexp_matches(s, '^[0-9]+$') THEN TRY_CAST(s AS INTEGER) END AS num, s AS num_raw
    FROM t""")
def f6(spark, sf):
    num, raw = N.int_or_raw(F.replace(C("p_brand"), F.lit("Brand#1"), F.lit("")))
    return table(spark, sf, "part").select("p_partkey", num.alias("num"), raw.alias("num_raw"))


@query("f7_to_numeric", """
    SELECT event_id, TRY_CAST(CASE WHEN event_type = 'click' THEN value::VARCHAR ELSE event_type END AS DOUBLE) AS num
    FROM events""")
def f7(spark, sf):
    text = F.when(C("event_type") == "click", C("value").cast("string")).otherwise(C("event_type"))
    return table(spark, sf, "events").select("event_id", N.to_numeric(text).alias("num"))


@query("f8_feet_inches", """
    SELECT p_partkey, round((p_size // 12) + (p_size % 12) / 12.0::DOUBLE, 2) AS feet,
           round((p_partkey % 9) + ((p_partkey % 12) / 12.0::DOUBLE), 2) AS other_feet
    FROM part""")
def f8(spark, sf):
    marks = F.format_string("%d'%02d\" / %d’%d\"", F.floor(C("p_size") / 12), C("p_size") % 12,
                            C("p_partkey") % 9, C("p_partkey") % 12)
    both = N.feet_inches(marks)
    return table(spark, sf, "part").select(
        "p_partkey", L.at(both, 0).alias("feet"), L.at(both, 1).alias("other_feet"))


@query("f9_unit_number", """
    SELECT p_partkey, round(p_retailprice, 2) AS lbs, round(p_retailprice * 2, 2) AS lbs_two FROM part""")
def f9(spark, sf):
    text = F.concat(F.format_number("p_retailprice", 2), F.lit("lbs / "),
                    F.format_number(C("p_retailprice") * 2, 2), F.lit("lbs"))
    w = N.unit_number(text, "lbs")
    return table(spark, sf, "part").select("p_partkey", L.at(w, 0).alias("lbs"), L.at(w, 1).alias("lbs_two"))


@query("f10_reduce_ratio", """
    WITH c AS (SELECT c_nationkey AS k, count(*) AS a FROM customer GROUP BY 1),
         s AS (SELECT s_nationkey AS k, count(*) AS b FROM supplier GROUP BY 1)
    SELECT k AS nationkey, (100 * a // gcd(100 * a, 100 * b))::VARCHAR || ':' ||
           (100 * b // gcd(100 * a, 100 * b))::VARCHAR AS ratio
    FROM c JOIN s USING (k)""")
def f10(spark, sf):
    c = table(spark, sf, "customer").groupBy(C("c_nationkey").alias("nationkey")).agg(F.count("*").alias("a"))
    s = table(spark, sf, "supplier").groupBy(C("s_nationkey").alias("nationkey")).agg(F.count("*").alias("b"))
    return c.join(s, "nationkey").select("nationkey", N.reduce_ratio(C("a"), C("b")).alias("ratio"))


@query("f10_large", """
    SELECT p_partkey, (9007199254740993 + p_partkey * 2)::VARCHAR || ':1' AS ratio FROM part""")
def f10_large(spark, sf):
    large = (C("p_partkey") * 2 + F.lit(9007199254740993)).cast("decimal(20,0)")
    return spread_table(spark, sf, "part", "p_partkey").select("p_partkey", N.reduce_ratio(large, F.lit(1).cast("decimal(20,0)")).alias("ratio"))


@query("f11_gender_rate", """
    WITH t AS (SELECT p_partkey, p_size % 5 = 4 AS unknown,
                      CASE WHEN p_size % 3 = 0 THEN '0' ELSE '87.5' END AS m,
                      CASE WHEN p_size % 7 = 0 THEN '0' ELSE '12.5' END AS f FROM part)
    SELECT p_partkey, CASE WHEN unknown THEN 'N/A' WHEN m = '0' AND f = '0' THEN 'N/A'
           WHEN m = '0' THEN 'Always female' WHEN f = '0' THEN 'Always male' ELSE '7:1' END AS rate
    FROM t""")
def f11(spark, sf):
    size = C("p_size")
    male = F.when(size % 3 == 0, "0").otherwise("87.5")
    female = F.when(size % 7 == 0, "0").otherwise("12.5")
    return table(spark, sf, "part").select("p_partkey", N.gender_rate(size % 5 == 4, male, female).alias("rate"))


@query("f12_slices", """
    SELECT p_partkey, p_type[:-3] AS cut_end, p_type[2:4] AS middle, p_type[-3:] AS tail, p_type[4:-3] AS inner_part
    FROM part""")
def f12(spark, sf):
    t = C("p_type")
    return table(spark, sf, "part").select(
        "p_partkey", X.py_slice(t, 0, -2).alias("cut_end"), X.py_slice(t, 1, 4).alias("middle"),
        X.py_slice(t, -3).alias("tail"), X.py_slice(t, 3, -2).alias("inner_part"))


@query("f13_split2", """
    SELECT p_partkey, split_part(p_name, ' ', 1) AS one, split_part(p_name, ' ', 2) AS two,
           CASE WHEN p_size % 2 = 0 THEN 'none' ELSE split_part(p_name, ' ', 1) END AS padded
    FROM part""")
def f13(spark, sf):
    one, two = L.split2(C("p_name"), " ")
    padded, _ = L.split2(F.when(C("p_size") % 2 == 0, "").otherwise(C("p_name")), " ", "none")
    return table(spark, sf, "part").select("p_partkey", one.alias("one"), two.alias("two"), padded.alias("padded"))


@query("f14_split_nested", """
    SELECT p_partkey, 2::INTEGER AS n_groups, len(string_split(p_name, ' '))::INTEGER AS n_first,
           array_to_string(string_split(p_name, ' '), '+') AS first_group, p_brand AS second_last
    FROM part""")
def f14(spark, sf):
    g = L.split_nested(F.concat(F.replace(C("p_name"), F.lit(" "), F.lit(" - ")), F.lit(" | x - "), C("p_brand")), " | ", " - ")
    return table(spark, sf, "part").select("p_partkey", g.alias("g")).select(
        "p_partkey", F.size("g").alias("n_groups"), F.size(L.at(C("g"), 0)).alias("n_first"),
        F.array_join(L.at(C("g"), 0), "+").alias("first_group"), L.at(L.at(C("g"), 1), -1).alias("second_last"))


@query("f15_stat_vector", """
    SELECT l_orderkey, l_linenumber, (l_linenumber % 10)::INTEGER AS hp, 0::INTEGER AS atk, 0::INTEGER AS dfn,
           (l_quantity::INTEGER % 10)::INTEGER AS spa, 0::INTEGER AS spd, 3::INTEGER AS spe
    FROM lineitem""")
def f15(spark, sf):
    cell = F.format_string("%d HP<br>%d Sp. Attack<br>3 Anything", C("l_linenumber") % 10,
                           C("l_quantity").cast("int") % 10)
    v = L.stat_vector(F.split(cell, "<br>"))
    names = ["hp", "atk", "dfn", "spa", "spd", "spe"]
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", v.alias("v")).select(
        "l_orderkey", "l_linenumber", *[L.at(C("v"), i).alias(n) for i, n in enumerate(names)])


@query("f16_region_suffix", """
    WITH t AS (SELECT p_partkey, lpad(p_partkey::VARCHAR, greatest(4, length(p_partkey::VARCHAR))::INTEGER, '0') AS k,
               CASE p_size % 6 WHEN 0 THEN NULL WHEN 1 THEN 'Alolan ' || p_name WHEN 2 THEN 'Galarian Form'
                    WHEN 3 THEN 'Hisuian' WHEN 4 THEN 'Paldean x' ELSE p_type END AS form FROM part)
    SELECT p_partkey, CASE WHEN form IS NULL THEN k WHEN form LIKE 'Alolan%' THEN k || 'a'
             WHEN form LIKE 'Galarian%' THEN k || 'g' WHEN form LIKE 'Hisuian%' THEN k || 'h'
             WHEN form LIKE 'Paldean%' THEN k || 'p' ELSE k || lower(left(form, 2)) END AS suffixed,
           CASE WHEN form LIKE 'Alolan%' THEN 'Alolan Form' WHEN form LIKE 'Galarian%' THEN 'Galarian Form'
             WHEN form LIKE 'Hisuian%' THEN 'Hisuian Form' WHEN form LIKE 'Paldean%' THEN 'Paldean Form'
             ELSE form END AS label
    FROM t""")
def f16(spark, sf):
    n = C("p_size") % 6
    form = (F.when(n == 1, F.concat(F.lit("Alolan "), C("p_name"))).when(n == 2, F.lit("Galarian Form"))
            .when(n == 3, F.lit("Hisuian")).when(n == 4, F.lit("Paldean x")).when(n == 5, C("p_type")))
    key = X.zfill(C("p_partkey").cast("string"), 4)
    return table(spark, sf, "part").select("p_partkey", key.alias("k"), form.alias("form")).select(
        "p_partkey", X.region_suffix(C("k"), C("form")).alias("suffixed"), X.region_label(C("form")).alias("label"))


@query("f17_form_suffix", """
    WITH t AS (SELECT p_partkey, p_type, lpad(p_partkey::VARCHAR, 8, '0') || lower(left(p_type, 2)) AS k FROM part)
    SELECT p_partkey, CASE WHEN p_type = 'PROMO' THEN left(k, 8) WHEN p_type = 'ECONOMY' THEN left(k, 8) || 'eco'
           ELSE k END AS dex_key FROM t""")
def f17(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey", "p_type", X.form_suffix(F.lpad(C("p_partkey").cast("string"), 8, "0"), C("p_type")).alias("dex_key"))
    base = F.left(C("dex_key"), F.lit(8))
    rules = [curate.rule({"p_type": "PROMO"}, {"dex_key": base}),
             curate.rule({"p_type": "ECONOMY"}, {"dex_key": F.concat(base, F.lit("eco"))})]
    return curate.apply_rules(df, rules).drop("p_type")


@query("f18_strip_parens", """
    SELECT p_partkey, p_name || ' kept' AS bare FROM part""")
def f18(spark, sf):
    text = F.concat(C("p_name"), F.lit(" (first "), C("p_type"), F.lit(") kept  ("), C("p_brand"), F.lit(")"))
    return table(spark, sf, "part").select("p_partkey", X.strip_parens(text).alias("bare"))


@query("f19_recode", """
    SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'Finished' WHEN 'O' THEN '' ELSE o_orderstatus END AS status
    FROM orders""")
def f19(spark, sf):
    return table(spark, sf, "orders").select(
        "o_orderkey", X.recode(C("o_orderstatus"), {"F": "Finished", "O": ""}).alias("status"))


@query("f20_blank_to_null", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN NULL ELSE o_orderstatus END AS status,
           NULLIF(CASE WHEN o_custkey % 3 = 0 THEN '' ELSE o_orderpriority END, '') AS priority
    FROM orders""")
def f20(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", X.recode(C("o_orderstatus"), {"O": ""}).alias("status"),
        F.when(C("o_custkey") % 3 == 0, "").otherwise(C("o_orderpriority")).alias("priority"))
    return curate.blank_to_null(df)


PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED"]


@query("f21_rank_of", """
    SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 0 WHEN '2-HIGH' THEN 1 WHEN '3-MEDIUM' THEN 2
           WHEN '4-NOT SPECIFIED' THEN 3 END::INTEGER AS rank FROM orders""")
def f21(spark, sf):
    return table(spark, sf, "orders").select("o_orderkey", curate.rank_of(C("o_orderpriority"), PRIORITIES).alias("rank"))


@query("f22_predicates", """
    SELECT p_type, count(*) FILTER (WHERE p_name LIKE 'red%') AS n_starts,
           count(*) FILTER (WHERE p_name LIKE '%ring') AS n_ends,
           count(*) FILTER (WHERE p_name LIKE '%e w%') AS n_contains,
           count(*) FILTER (WHERE regexp_matches(p_brand, '^Brand#[12]\\d')) AS n_regex
    FROM part GROUP BY p_type""")
def f22(spark, sf):
    name = C("p_name")
    return table(spark, sf, "part").groupBy("p_type").agg(
        F.count_if(name.startswith("red")).alias("n_starts"), F.count_if(name.endswith("ring")).alias("n_ends"),
        F.count_if(name.contains("e w")).alias("n_contains"),
        F.count_if(X.matches_at_start(C("p_brand"), r"Brand#[12]\d")).alias("n_regex"))


@query("f23_rstrip_set", """
    SELECT p_partkey, rtrim(p_name || CASE p_size % 3 WHEN 0 THEN ', ' WHEN 1 THEN ',' ELSE ' ,, ' END, ', ') AS cut,
           substr(', ' || p_type, 3) AS led FROM part""")
def f23(spark, sf):
    n = C("p_size") % 3
    tail = F.when(n == 0, F.lit(", ")).when(n == 1, F.lit(",")).otherwise(F.lit(" ,, "))
    return table(spark, sf, "part").select(
        "p_partkey", X.rstrip_set(F.concat(C("p_name"), tail), ", ").alias("cut"),
        X.py_slice(F.concat(F.lit(", "), C("p_type")), 2).alias("led"))


@query("f24_between_affixes", "SELECT p_partkey, p_name AS learned, p_type AS held FROM part")
def f24(spark, sf):
    return table(spark, sf, "part").select(
        "p_partkey",
        X.between_affixes(F.concat(F.lit("after "), C("p_name"), F.lit(" learned")), "after ", " learned").alias("learned"),
        X.between_affixes(F.concat(F.lit("hold "), C("p_type")), "hold ").alias("held"))
