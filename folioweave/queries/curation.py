"""Projection, rules, dedup, joins, row generation, sorting and quality over the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import lists as L
from folioweave.functions import numbers as N
from folioweave.functions import text as X
from folioweave.operators import curate, joins, order, quality, rows
from folioweave.queries.registry import query, table
from folioweave.session import cut_lineage

C = F.col
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
RANK = "CAST(left(o_orderpriority, 1) AS INTEGER) - 1"
KEY4 = "lpad({k}::VARCHAR, greatest(4, length({k}::VARCHAR))::INTEGER, '0')"


@query("p1_record", """
    SELECT p_partkey AS page_id, p_name AS name, p_brand AS class, p_size AS base_hp, p_retailprice AS weight_lb,
           '' AS form FROM part""")
def p1(spark, sf):
    return table(spark, sf, "part").select(
        C("p_partkey").alias("page_id"), C("p_name").alias("name"), C("p_brand").alias("class"),
        C("p_size").alias("base_hp"), C("p_retailprice").alias("weight_lb"), F.lit("").alias("form"))


@query("p2_route", """
    SELECT event_id, CASE WHEN event_type = 'click' THEN replace(props, '{"k": ', 'c') ELSE '' END AS item_used,
           CASE WHEN event_type = 'view' THEN replace(props, '}', 'v') ELSE '' END AS item_held,
           CASE WHEN event_type NOT IN ('click', 'view') THEN replace(props, '"', '') ELSE '' END AS other_condition
    FROM events""")
def p2(spark, sf):
    text = C("props")
    out = curate.route(text, C("event_type"), {
        "item_used": (["click"], X.replace_all(text, [('{"k": ', "c")])),
        "item_held": (["view"], X.replace_all(text, [("}", "v")])),
        "other_condition": ([], X.replace_all(text, [('"', "")])),
    }, default="other_condition")
    return table(spark, sf, "events").select("event_id", *[c.alias(n) for n, c in out.items()])


@query("p3_drop", "SELECT n_nationkey, n_name FROM nation")
def p3(spark, sf):
    return table(spark, sf, "nation").drop("n_regionkey")


SUFFIXED = f"""k AS (SELECT p_partkey, {KEY4.format(k='p_partkey')} ||
    CASE p_size % 4 WHEN 0 THEN 'a' WHEN 1 THEN 'meg' ELSE '' END AS dex_key FROM part)"""


def suffixed(spark, sf):
    n = C("p_size") % 4
    tail = F.when(n == 0, "a").when(n == 1, "meg").otherwise("")
    return table(spark, sf, "part").select(
        "p_partkey", F.concat(X.zfill(C("p_partkey").cast("string"), 4), tail).alias("dex_key"))


@query("p4_key_between", f"WITH {SUFFIXED} SELECT p_partkey, dex_key FROM k WHERE dex_key BETWEEN '0001' AND '0151'")
def p4(spark, sf):
    return suffixed(spark, sf).filter(curate.key_between(C("dex_key"), "0001", "0151"))


@query("p5_not_matching", f"""
    WITH {SUFFIXED} SELECT p_partkey, dex_key, regexp_matches(dex_key, '^\\d{{4}}[a-z]') AS loose
    FROM k WHERE NOT regexp_matches(dex_key, '^\\d{{4}}[a-z]$')""")
def p5(spark, sf):
    return suffixed(spark, sf).filter(curate.not_matching(C("dex_key"), r"\d{4}[a-z]$")).select(
        "p_partkey", "dex_key", X.matches_at_start(C("dex_key"), r"\d{4}[a-z]").alias("loose"))


@query("p6_exclude", f"""
    WITH {SUFFIXED}, n AS (SELECT p_partkey, CASE WHEN p_partkey % 10 = 3 THEN NULL ELSE dex_key END AS dex_key FROM k)
    SELECT p_partkey, dex_key FROM n WHERE dex_key IS NULL OR dex_key NOT IN ('0020a', '0075a', '0496', '0101meg')""")
def p6(spark, sf):
    df = suffixed(spark, sf).withColumn("dex_key", F.when(C("p_partkey") % 10 != 3, C("dex_key")))
    return curate.exclude(df, "dex_key", ["0020a", "0075a", "0496", "0101meg"])


@query("p6_exclude_join", f"""
    WITH {SUFFIXED} SELECT p_partkey, dex_key FROM k
    WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 48)""")
def p6_join(spark, sf):
    banned = table(spark, sf, "lineitem").filter("l_quantity > 48").select("l_partkey")
    return curate.exclude(suffixed(spark, sf), "p_partkey", banned)


@query("p7_drop_where", """
    SELECT o_orderkey, o_orderstatus FROM orders
    WHERE NOT (o_orderstatus = 'F' AND o_orderpriority LIKE '5%')""")
def p7(spark, sf):
    cond = (C("o_orderstatus") == "F") & C("o_orderpriority").startswith("5")
    return curate.drop_where(table(spark, sf, "orders"), cond).select("o_orderkey", "o_orderstatus")


@query("p8_prune", """
    SELECT 'o_orderkey' AS kept, count(o_orderkey) AS n_values FROM orders
    UNION ALL SELECT 'o_custkey', count(o_custkey) FROM orders
    UNION ALL SELECT 'partly', count(*) FROM orders WHERE o_orderstatus = 'P'""")
def p8(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.lit(None).cast("string").alias("none_one"),
        F.when(C("o_totalprice") < 0, "x").alias("none_two"), F.when(C("o_orderstatus") == "P", "y").alias("partly"))
    kept = curate.prune_null_columns(df)
    counts = kept.agg(*[F.count(c).alias(c) for c in kept.columns])
    return counts.unpivot([], kept.columns, "kept", "n_values")


@query("u1_assign", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'N/A' ELSE o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderstatus = 'P' THEN 'none' ELSE o_orderpriority END AS o_orderpriority FROM orders""")
def u1(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    return curate.assign_where(df, C("o_orderstatus") == "P", {"o_orderstatus": "N/A", "o_orderpriority": "none"})


@query("u2_rules", """
    WITH a AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, o_custkey, '' AS place, '' AS note FROM orders),
    b AS (SELECT * REPLACE (CASE WHEN o_custkey % 10 = 0 THEN 'Galar' WHEN o_orderpriority LIKE '1%' THEN 'Alola' ELSE place END AS place,
          CASE WHEN o_orderstatus = 'F' THEN 'done' ELSE note END AS note) FROM a),
    c AS (SELECT * REPLACE (CASE WHEN place = 'Galar' THEN 'S' ELSE o_orderstatus END AS o_orderstatus,
          CASE WHEN place = 'Galar' THEN '' ELSE place END AS place) FROM b)
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'S' AND note = 'done' THEN 'both' ELSE note END AS note,
           o_orderstatus, place FROM c""")
def u2(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", (C("o_custkey") % 10).alias("cust_digit"),
        F.lit("").alias("place"), F.lit("").alias("note"))
    rules = [
        curate.rule({"o_orderpriority": ("starts", "1")}, {"place": "Alola"}),
        curate.rule({"cust_digit": 0}, {"place": "Galar"}),
        curate.rule({"o_orderstatus": "F"}, {"note": "done"}),
        curate.rule({"place": "Galar"}, {"o_orderstatus": "S", "place": ""}),
        curate.rule({"o_orderstatus": "S", "note": "done"}, {"note": "both"}),
    ]
    return curate.apply_rules(df, rules).select("o_orderkey", "note", "o_orderstatus", "place")


@query("u2_column_values", """
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE o_orderpriority END AS a,
      CASE WHEN o_custkey % 2 = 0 THEN CASE WHEN o_orderstatus = 'F' THEN 'new' ELSE o_orderpriority END || '!' ELSE o_clerk END AS b,
      CASE WHEN o_custkey % 3 = 0 THEN 'last' ELSE o_orderstatus END AS o_orderstatus FROM (SELECT *, 'c' AS o_clerk FROM orders)""")
def u2_columns(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", C("o_orderpriority").alias("a"), F.lit("c").alias("b"))
    df = df.withColumn("even", C("o_custkey") % 2).withColumn("third", C("o_custkey") % 3)
    rules = [curate.rule({"o_orderstatus": "F"}, {"a": "new"}),
             curate.rule({"even": 0}, {"b": F.concat(C("a"), F.lit("!"))}),  # reads what the rule before wrote
             curate.rule({"third": 0}, {"o_orderstatus": "last"})]
    return curate.apply_rules(df, rules).select("o_orderkey", "a", "b", "o_orderstatus")


@query("u3_move", """
    WITH a AS (SELECT p_partkey, p_name AS item, p_type || ' red small' AS other, '' AS color, '' AS size FROM part),
    b AS (SELECT p_partkey, replace(item, 'red', '') AS item, replace(other, 'red', '') AS other,
          'Red' AS color, size FROM a),
    c AS (SELECT p_partkey, replace(CASE WHEN item LIKE '%small%' OR other LIKE '%small%' THEN 'Tiny' ELSE item END, 'small', '') AS item,
          replace(other, 'small', '') AS other, color FROM b)
    SELECT p_partkey, replace(item, 'ring', '') AS item, replace(other, 'ring', '') AS other, color,
           CASE WHEN item LIKE '%ring%' OR other LIKE '%ring%' THEN 'Round' ELSE '' END AS size FROM c""")
def u3(spark, sf):
    df = table(spark, sf, "part").select(
        "p_partkey", C("p_name").alias("item"), F.concat(C("p_type"), F.lit(" red small")).alias("other"),
        F.lit("").alias("color"), F.lit("").alias("size"))
    moves = [curate.Move("red", "color", "Red"), curate.Move("small", "item", "Tiny"), curate.Move("ring", "size", "Round")]
    return curate.move_conditions(df, moves, ["item", "other"])


@query("u3_move_documents", """
    WITH f AS (SELECT doc_id, contains(text, 'the') AS t, contains(replace(text, 'the', ''), 'and') AS a,
               replace(replace(text, 'the', ''), 'and', '') AS rest FROM documents)
    SELECT doc_id, CASE WHEN t THEN 'the' ELSE '' END AS article, CASE WHEN a THEN 'and' ELSE '' END AS junction,
           rest AS text FROM f""")
def u3_documents(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "text", F.lit("").alias("article"), F.lit("").alias("junction"))
    return curate.move_conditions(df, [curate.Move("the", "article", "the"), curate.Move("and", "junction", "and")], ["text"])


@query("u4_affix", """
    WITH a AS (SELECT p_partkey, CASE p_size % 3 WHEN 0 THEN 'after ' || p_name || ' learned'
               WHEN 1 THEN 'hold ' || p_name ELSE 'Attack > ' || p_type END AS o FROM part)
    SELECT p_partkey, CASE WHEN o LIKE '%learned' THEN substr(o, 7, length(o) - 14) ELSE '' END AS move_learned,
           CASE WHEN o LIKE 'hold %' THEN substr(o, 6) ELSE '' END AS item_held,
           CASE WHEN o LIKE 'Attack%' THEN o ELSE '' END AS stat, '' AS other_condition,
           CASE WHEN o LIKE 'Attack%' THEN 'status' ELSE 'level' END AS method FROM a""")
def u4(spark, sf):
    n = C("p_size") % 3
    text = (F.when(n == 0, F.concat(F.lit("after "), C("p_name"), F.lit(" learned")))
            .when(n == 1, F.concat(F.lit("hold "), C("p_name"))).otherwise(F.concat(F.lit("Attack > "), C("p_type"))))
    df = table(spark, sf, "part").select(
        "p_partkey", text.alias("other_condition"), F.lit("status").alias("method"),
        *[F.lit("").alias(c) for c in ("move_learned", "item_held", "stat")])
    df = curate.move_by_affix(df, "other_condition", "move_learned", "after ", " learned", also={"method": "level"},
                              test=C("other_condition").endswith("learned"))
    df = curate.move_by_affix(df, "other_condition", "item_held", "hold ", also={"method": "level"})
    return curate.move_by_affix(df, "other_condition", "stat", "Attack", keep_affix=True)


@query("u5_rename", """
    SELECT event_id, CASE event_type WHEN 'click' THEN 'item' WHEN 'error' THEN 'miscellaneous' ELSE event_type END AS method,
           CASE WHEN event_type = 'view' THEN 'Friendship' ELSE '' END AS stat FROM events""")
def u5(spark, sf):
    df = table(spark, sf, "events").select("event_id", C("event_type").alias("method"), F.lit("").alias("stat"))
    rules = [curate.rule({"method": "click"}, {"method": "item"}),
             curate.rule({"method": "error"}, {"method": "miscellaneous"}),
             curate.rule({"method": "view"}, {"stat": "Friendship"})]
    return curate.apply_rules(df, rules)


@query("u6_annotate", """
    SELECT n_nationkey, n_name, CASE WHEN n_name IN ('NATION_3', 'NATION_7') THEN 'cannot be changed here' END AS notes FROM nation""")
def u6(spark, sf):
    df = table(spark, sf, "nation").select("n_nationkey", "n_name", F.lit(None).cast("string").alias("notes"))
    return curate.annotate(df, "n_name", ["NATION_3", "NATION_7"], {"notes": "cannot be changed here"})


@query("a1_dedup", f"""
    SELECT o_custkey, o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey
      ORDER BY {RANK}, o_orderkey) AS rn FROM orders) WHERE rn = 1""")
def a1(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", curate.rank_of(C("o_orderpriority"), PRIORITIES).alias("rank"))
    return curate.dedup_first(df, ["o_custkey"], ["rank", "o_orderkey"]).drop("rank")


@query("a2_distinct_list", """
    SELECT l_orderkey, string_agg(x, ',' ORDER BY x) AS flags FROM
      (SELECT DISTINCT l_orderkey, l_returnflag || l_linestatus AS x FROM lineitem) GROUP BY 1""")
def a2(spark, sf):
    flag = F.concat("l_returnflag", "l_linestatus")
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.array_join(F.array_sort(F.collect_set(flag)), ",").alias("flags"))


@query("a2_first_seen", """
    SELECT p_partkey, CASE WHEN w[1] = w[2] THEN w[1] ELSE w[1] || ',' || w[2] END AS seen
    FROM (SELECT p_partkey, string_split(p_name, ' ') AS w FROM part)""")
def a2_first(spark, sf):
    w = F.split("p_name", " ")
    twice = F.concat(w, F.reverse(w))
    return table(spark, sf, "part").select("p_partkey", F.array_join(F.array_distinct(twice), ",").alias("seen"))


@query("a3_counts", """
    SELECT conv_id, count(*) FILTER (WHERE role = 'user') AS n_user, count(*) FILTER (WHERE length(text) > 200) AS n_long
    FROM conversations GROUP BY 1""")
def a3(spark, sf):
    return table(spark, sf, "conversations").groupBy("conv_id").agg(
        F.count_if(C("role") == "user").alias("n_user"), F.count_if(F.length("text") > 200).alias("n_long"))


@query("e1_explode", """
    SELECT p_partkey, (u.pos - 1)::INTEGER AS form_index, u.form FROM part,
      unnest(string_split(p_name, ' ')) WITH ORDINALITY AS u(form, pos)""")
def e1(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("forms"))
    return rows.explode_forms(df, "forms")


@query("e2_derive", """
    WITH f AS (SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN ['', 'Mega ' || split_part(p_name, ' ', 1)]
        WHEN p_size % 5 = 1 THEN (CASE WHEN p_type = 'PROMO' THEN ['Male', 'Female'] WHEN p_size > 25 THEN string_split(p_name, ' ') ELSE [''] END)
        ELSE [''] END AS forms FROM part)
    SELECT p_partkey, array_to_string(forms, '|') AS forms, len(forms)::INTEGER AS n_forms FROM f""")
def e2(spark, sf):
    none = F.array().cast("array<string>")
    mega = F.concat(F.lit("Mega "), F.split_part(C("p_name"), F.lit(" "), F.lit(1)))
    special = F.when(C("p_size") % 5 == 0, F.array(mega, mega)).otherwise(none)
    alternates = F.when(C("p_size") > 25, F.split("p_name", " ")).otherwise(none)
    forms = rows.derive_forms(special, alternates, C("p_size") % 5 == 1, {"PROMO": ["Male", "Female"]}, C("p_type"))
    return table(spark, sf, "part").select("p_partkey", forms.alias("f")).select(
        "p_partkey", F.array_join("f", "|").alias("forms"), F.size("f").alias("n_forms"))


@query("e3_repeat", """
    WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS w, p_size % 4 AS n FROM part)
    SELECT p_partkey, repeat(w[1] || ',', n) || w[2] AS items FROM w""")
def e3(spark, sf):
    counts = F.array(C("p_size") % 4, F.lit(1))
    return table(spark, sf, "part").select(
        "p_partkey", F.array_join(L.repeat_items(F.split("p_name", " "), counts), ",").alias("items"))


@query("j1_outer", """
    WITH c AS (SELECT c_nationkey AS k, count(*) AS n_cust FROM customer WHERE c_nationkey < 20 GROUP BY 1),
         s AS (SELECT s_nationkey AS k, count(*) AS n_supp FROM supplier WHERE s_nationkey > 4 GROUP BY 1)
    SELECT k AS nationkey, n_cust, n_supp FROM c FULL JOIN s USING (k)""")
def j1(spark, sf):
    c = (table(spark, sf, "customer").filter("c_nationkey < 20").groupBy(C("c_nationkey").alias("nationkey"))
         .agg(F.count("*").alias("n_cust")))
    s = (table(spark, sf, "supplier").filter("s_nationkey > 4").groupBy(C("s_nationkey").alias("nationkey"))
         .agg(F.count("*").alias("n_supp")))
    return joins.outer_merge(c, s, ["nationkey"])


@query("j1_null_keys", """
    WITH c AS (SELECT NULLIF(c_nationkey, 3) AS k, count(*) AS n_cust FROM customer WHERE c_nationkey < 20 GROUP BY 1),
         s AS (SELECT NULLIF(NULLIF(s_nationkey, 7), 8) AS k, count(*) AS n_supp FROM supplier WHERE s_nationkey > 4 GROUP BY 1)
    SELECT coalesce(c.k, s.k) AS nationkey, n_cust, n_supp FROM c FULL JOIN s ON c.k IS NOT DISTINCT FROM s.k""")
def j1_null(spark, sf):
    c = table(spark, sf, "customer").filter("c_nationkey < 20").groupBy(F.expr("nullif(c_nationkey, 3)").alias("nationkey"))
    s = table(spark, sf, "supplier").filter("s_nationkey > 4").groupBy(F.expr("nullif(nullif(s_nationkey, 7), 8)").alias("nationkey"))
    return joins.outer_merge(c.agg(F.count("*").alias("n_cust")), s.agg(F.count("*").alias("n_supp")), ["nationkey"])


CHAIN = """
    WITH a AS (SELECT o_custkey AS k, left(o_orderpriority, 1) AS p, min(o_orderkey) AS first_order FROM orders GROUP BY 1, 2),
    b AS (SELECT o_custkey AS k, left(o_orderpriority, 1) AS p, o_orderkey AS late_order FROM orders WHERE o_totalprice > 400000),
    c AS (SELECT c_custkey AS k, '1' AS p, c_mktsegment AS segment FROM customer),
    d AS (SELECT s_suppkey AS k, '2' AS p, s_acctbal AS balance FROM supplier)
    SELECT k, p, first_order, late_order, segment, balance
    FROM a FULL JOIN b USING (k, p) FULL JOIN c USING (k, p) FULL JOIN d USING (k, p)"""


def chain_frames(spark, sf):
    o = table(spark, sf, "orders").select(
        C("o_custkey").alias("k"), F.left("o_orderpriority", F.lit(1)).alias("p"), "o_orderkey", "o_totalprice")
    return [
        o.groupBy("k", "p").agg(F.min("o_orderkey").alias("first_order")),
        o.filter("o_totalprice > 400000").select("k", "p", C("o_orderkey").alias("late_order")),
        table(spark, sf, "customer").select(C("c_custkey").alias("k"), F.lit("1").alias("p"), C("c_mktsegment").alias("segment")),
        table(spark, sf, "supplier").select(C("s_suppkey").alias("k"), F.lit("2").alias("p"), C("s_acctbal").alias("balance")),
    ]


@query("j2_outer_chain", CHAIN)
def j2(spark, sf):
    return joins.outer_merge_all(chain_frames(spark, sf), ["k", "p"])


@query("j2_outer_chain_even", CHAIN)
def j2_even(spark, sf):
    # the same merge with two keys named as heavy: one that all frames may hold, one that some lack
    return joins.outer_merge_all(chain_frames(spark, sf), ["k", "p"], heavy=[(7, "1"), (10, "2")], slices=4)


@query("j2_skewed", """
    WITH l AS (SELECT CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS k, l_orderkey, l_linenumber FROM lineitem),
    s AS (SELECT s_suppkey - 1 AS k, s_acctbal AS balance FROM supplier), c AS (SELECT c_custkey AS k, c_mktsegment AS segment FROM customer)
    SELECT k, l_orderkey, l_linenumber, balance, segment FROM l FULL JOIN s USING (k) FULL JOIN c USING (k)""")
def j2_skewed(spark, sf):
    # a third of the rows have one key, which nobody names
    key = F.when(C("l_orderkey") % 3 == 0, 0).otherwise(C("l_orderkey"))
    return joins.outer_merge_all([
        table(spark, sf, "lineitem").select(key.cast("long").alias("k"), "l_orderkey", "l_linenumber"),
        table(spark, sf, "supplier").select((C("s_suppkey") - 1).cast("long").alias("k"), C("s_acctbal").alias("balance")),
        table(spark, sf, "customer").select(C("c_custkey").cast("long").alias("k"), C("c_mktsegment").alias("segment")),
    ], ["k"], rows=1000)


@query("j3_lookup", """
    SELECT p_partkey, CASE p_type WHEN 'PROMO' THEN 'promo!' WHEN 'ECONOMY' THEN p_name END AS found FROM part""")
def j3(spark, sf):
    m = F.create_map(F.lit("PROMO"), F.lit("promo!"), F.lit("ECONOMY"), C("p_name"))
    return table(spark, sf, "part").select("p_partkey", L.lookup(m, C("p_type")).alias("found"))


@query("j3_lookup_dim", "SELECT c_custkey, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND n_regionkey = 1")
def j3_dim(spark, sf):
    dim = table(spark, sf, "nation").filter("n_regionkey = 1").withColumnRenamed("n_nationkey", "c_nationkey")
    return joins.lookup_column(table(spark, sf, "customer"), dim, "c_nationkey", "n_name").select("c_custkey", "n_name")


@query("j5_zip", """
    WITH w AS (SELECT p_partkey, string_split(p_name, ' ') AS a, string_split(p_brand, '#') AS b FROM part)
    SELECT p_partkey, a[1] || '=' || b[1] || ';' || a[2] || '=' || b[2] AS zipped, len(a) = len(b) AS even FROM w""")
def j5(spark, sf):
    z, ok = L.zip_lists(a=F.split("p_name", " "), b=F.split("p_brand", "#"))
    joined = F.transform(z, lambda e: F.concat(e["a"], F.lit("="), e["b"]))
    return table(spark, sf, "part").select("p_partkey", F.array_join(joined, ";").alias("zipped"), ok.alias("even"))


@query("j6_constant_on_rows", """
    SELECT p_partkey, unnest(string_split(p_name, ' ')) AS move, 'Egg' AS egg_moves FROM part WHERE p_size % 2 = 0""")
def j6(spark, sf):
    none = F.array().cast("array<string>")
    moves = F.when(C("p_size") % 2 == 0, F.split("p_name", " ")).otherwise(none)
    return table(spark, sf, "part").select("p_partkey", F.explode(moves).alias("move")).withColumn("egg_moves", F.lit("Egg"))


@query("j7_semi_anti", """
    SELECT s_suppkey, s_suppkey IN (SELECT l_suppkey FROM lineitem WHERE l_quantity = 50) AS sold_full
    FROM supplier WHERE s_nationkey IN (SELECT n_nationkey FROM nation WHERE n_regionkey < 3)""")
def j7(spark, sf):
    near = table(spark, sf, "nation").filter("n_regionkey < 3").select(C("n_nationkey").alias("s_nationkey"))
    supp = table(spark, sf, "supplier").join(near, "s_nationkey", "left_semi").select("s_suppkey")
    sold = (table(spark, sf, "lineitem").filter("l_quantity = 50").select(C("l_suppkey").alias("s_suppkey")).distinct()
            .withColumn("hit", F.lit(True)))
    return supp.join(sold, "s_suppkey", "left").select("s_suppkey", F.coalesce("hit", F.lit(False)).alias("sold_full"))


@query("x1_append", """
    SELECT n_nationkey, n_name, n_regionkey FROM nation UNION ALL VALUES (100, 'ADDED', NULL), (101, NULL, 3)""")
def x1(spark, sf):
    return rows.append_rows(table(spark, sf, "nation"),
                            [{"n_nationkey": 100, "n_name": "ADDED"}, {"n_nationkey": 101, "n_regionkey": 3}])


@query("x2_clone", """
    SELECT p_partkey, p_type, p_name FROM part UNION ALL
    SELECT p_partkey, t, p_name || s FROM part, (VALUES ('SMALL', ' sm'), ('LARGE', ' la'), ('SUPER', ' su')) AS c(t, s)
    WHERE p_type = 'PROMO'""")
def x2(spark, sf):
    df = table(spark, sf, "part").select("p_partkey", "p_type", "p_name")
    changes = [{"p_type": t, "p_name": F.concat(C("p_name"), F.lit(s))}
               for t, s in (("SMALL", " sm"), ("LARGE", " la"), ("SUPER", " su"))]
    return rows.clone_rows(df, C("p_type") == "PROMO", changes)


@query("x3_union", """
    SELECT c_custkey AS k, c_name AS name, c_mktsegment AS segment, NULL::DOUBLE AS balance FROM customer
    UNION ALL SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
    UNION ALL SELECT n_nationkey, n_name, NULL, NULL FROM nation""")
def x3(spark, sf):
    return rows.union_all([
        table(spark, sf, "customer").select(C("c_custkey").alias("k"), C("c_name").alias("name"), C("c_mktsegment").alias("segment")),
        table(spark, sf, "supplier").select(C("s_suppkey").alias("k"), C("s_name").alias("name"), C("s_acctbal").alias("balance")),
        table(spark, sf, "nation").select(C("n_nationkey").cast("bigint").alias("k"), C("n_name").alias("name")),
    ])


def checked_orders(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", "o_totalprice",
        F.when(C("o_custkey") % 11 == 0, "Not listed").otherwise(C("o_custkey").cast("string")).alias("raw"))
    num = N.to_int(C("raw"))
    return quality.validate(df.withColumn("num", num), {
        "not a number": N.bad_number(C("raw"), C("num")),
        "open": C("o_orderstatus") == "O",
        "cheap": C("o_totalprice") < 5000,
    })


@query("q1_reasons", """
    SELECT reason, count(*) AS n FROM (SELECT unnest([CASE WHEN o_custkey % 11 = 0 THEN 'not a number' END,
      CASE WHEN o_orderstatus = 'O' THEN 'open' END, CASE WHEN o_totalprice < 5000 THEN 'cheap' END]) AS reason FROM orders)
    WHERE reason IS NOT NULL GROUP BY 1""")
def q1(spark, sf):
    return quality.error_counts(checked_orders(spark, sf))


BAD = "(o_custkey % 11 = 0 OR o_orderstatus = 'O' OR o_totalprice < 5000)"


@query("q2_quarantine", f"""
    SELECT 'bad' AS part, count(*) AS n, sum(o_orderkey)::BIGINT AS keys FROM orders WHERE {BAD}
    UNION ALL SELECT 'good', count(*), sum(o_orderkey)::BIGINT FROM orders WHERE NOT {BAD}""")
def q2(spark, sf):
    good, bad = quality.write_split(checked_orders(spark, sf), "orders")
    def tell(df, name):
        return df.agg(F.count("*").alias("n"), F.sum("o_orderkey").alias("keys")).select(F.lit(name).alias("part"), "n", "keys")
    return tell(good, "good").unionByName(tell(bad, "bad"))


@query("o1_sort", """
    SELECT l_orderkey, l_linenumber, l_partkey,
      row_number() OVER (ORDER BY l_shipdate NULLS LAST, l_orderkey, l_linenumber, l_partkey) - 1 AS position FROM lineitem""")
def o1(spark, sf):
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return order.with_position(order.sort_by(df, ["l_shipdate"], ["l_orderkey", "l_linenumber", "l_partkey"])).drop("l_shipdate")


@query("o2_sort_by_rank", f"""
    SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'zz' ELSE o_orderpriority END AS method,
      row_number() OVER (ORDER BY o_custkey, {RANK}, o_orderkey) - 1 AS position FROM orders""")
def o2(spark, sf):
    df = table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", C("o_orderpriority").alias("method"),
        curate.rank_of(C("o_orderpriority"), PRIORITIES).alias("method_rank"))
    df = curate.apply_rules(df, [curate.rule({"method": "1-URGENT"}, {"method": "zz"})])
    return order.with_position(order.sort_by_rank(df, ["o_custkey"], ["method_rank"], ["o_orderkey"])).drop("o_custkey")


@query("o3_base_key", f"""
    SELECT {KEY4.format(k='p_partkey')} || lower(left(u.form, 2)) AS dex_key, (u.pos - 1)::INTEGER AS form_index,
      row_number() OVER (ORDER BY {KEY4.format(k='p_partkey')}, u.pos, p_partkey) - 1 AS position FROM part,
      unnest(string_split(p_name, ' ')) WITH ORDINALITY AS u(form, pos)""")
def o3(spark, sf):
    df = rows.explode_forms(table(spark, sf, "part").select("p_partkey", F.split("p_name", " ").alias("forms")), "forms")
    df = df.withColumn("base", X.zfill(C("p_partkey").cast("string"), 4))
    ordered = order.with_position(order.sort_by_base_key(df, "base", "form_index", ["p_partkey"]))
    return ordered.select(X.form_suffix(C("base"), C("form")).alias("dex_key"), "form_index", "position")


@query("o4_mixed", """
    WITH t AS (SELECT o_custkey, o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN NULL WHEN 1 THEN o_orderpriority
               ELSE (o_orderkey % 97)::VARCHAR END AS raw FROM orders)
    , c AS (SELECT o_custkey, o_orderkey, CASE WHEN raw IS NULL THEN 2 WHEN TRY_CAST(raw AS INTEGER) IS NULL THEN 1 ELSE 0 END AS class,
      TRY_CAST(raw AS INTEGER) AS num, raw FROM t)
    SELECT *, row_number() OVER (ORDER BY o_custkey, class, num NULLS LAST, raw NULLS LAST, o_orderkey) - 1 AS position FROM c""")
def o4(spark, sf):
    k = C("o_orderkey") % 4
    raw = F.when(k == 1, C("o_orderpriority")).when(k > 1, (C("o_orderkey") % 97).cast("string"))
    num, text = N.int_or_raw(C("raw"))
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", raw.alias("raw")).withColumn("num", num)
    df = df.withColumn("class", order.mixed_class(C("num"), C("raw")))
    return order.with_position(df.orderBy(C("o_custkey"), *order.mixed_order(C("num"), C("raw")), C("o_orderkey")))


@query("edge_curation", f"""
    WITH a AS (SELECT o_custkey, o_orderkey, {KEY4.format(k='o_custkey')} AS k, o_orderpriority AS method, o_orderstatus,
        CASE WHEN o_orderpriority LIKE '1%' THEN 'hold ' || o_orderstatus || ', ' ELSE '' END AS item_used,
        CASE WHEN o_orderpriority LIKE '1%' THEN '' ELSE 'Daytime, after ' || o_orderstatus || ' learned' END AS other,
        '' AS time_of_day, '' AS move, {RANK} AS rank, 0 AS stage FROM orders),
    b AS (SELECT * FROM a UNION ALL BY NAME SELECT 7 AS o_custkey, -1 AS o_orderkey, '0007' AS k, '1-URGENT' AS method, 'F' AS o_orderstatus,
        'added' AS item_used, '' AS other, '' AS time_of_day, '' AS move, 0 AS rank, 1 AS stage),
    c AS (SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY k, o_orderstatus ORDER BY rank, stage, o_orderkey) = 1),
    d AS (SELECT * REPLACE (CASE WHEN contains(other, 'Daytime') THEN 'Daytime' ELSE time_of_day END AS time_of_day, replace(other, 'Daytime', '') AS other) FROM c),
    e AS (SELECT * REPLACE (CASE WHEN suffix(item_used, ', ') THEN rtrim(item_used, ', ') ELSE item_used END AS item_used,
        CASE WHEN starts_with(other, ', ') THEN substr(other, 3) ELSE other END AS other) FROM d),
    f AS (SELECT * REPLACE (CASE WHEN suffix(other, 'learned') THEN substr(other, 7, length(other) - 14) ELSE move END AS move,
        CASE WHEN suffix(other, 'learned') THEN '' ELSE other END AS other,
        CASE WHEN suffix(other, 'learned') THEN '5-LOW' ELSE method END AS method) FROM e)
    SELECT k, o_orderstatus, o_orderkey, CASE WHEN method = '5-LOW' THEN 'level' ELSE method END AS method, NULLIF(item_used, '') AS item_used,
      NULLIF(time_of_day, '') AS time_of_day, NULLIF(move, '') AS move FROM f WHERE k BETWEEN '0001' AND '0905' AND k <> '0020'""")
def edge_curation(spark, sf):
    text = F.concat(F.lit("hold "), C("o_orderstatus"), F.lit(", "))
    cond = F.concat(F.lit("Daytime, after "), C("o_orderstatus"), F.lit(" learned"))
    routed = curate.route(text, C("o_orderpriority"), {"item_used": (["1-URGENT"], text), "other": ([], cond)}, default="other")
    df = table(spark, sf, "orders").select(
        "o_orderkey", X.zfill(C("o_custkey").cast("string"), 4).alias("k"), C("o_orderpriority").alias("method"), "o_orderstatus",
        *[c.alias(n) for n, c in routed.items()], *[F.lit("").alias(c) for c in ("time_of_day", "move", "weather")],
        curate.rank_of(C("o_orderpriority"), PRIORITIES).alias("rank"), F.lit(0).alias("stage"))
    df = rows.append_rows(df, [{"o_orderkey": -1, "k": "0007", "method": "1-URGENT", "o_orderstatus": "F", "item_used": "added", "other": "",
                                "time_of_day": "", "move": "", "weather": "", "rank": 0, "stage": 1}])
    # edits never touch the keys or ranks, so they may run before the dedup's shuffle
    df = curate.move_conditions(df, [curate.Move("Daytime", "time_of_day", "Daytime")], ["item_used", "other"])
    df = curate.apply_rules(df, [
        curate.rule({"item_used": ("ends", ", ")}, {"item_used": X.rstrip_set(C("item_used"), ", ")}),
        curate.rule({"other": ("starts", ", ")}, {"other": X.py_slice(C("other"), 2)})])
    df = curate.move_by_affix(df, "other", "move", "after ", " learned", also={"method": "5-LOW"}, test=C("other").endswith("learned"))
    df = curate.apply_rules(df, [curate.rule({"method": "5-LOW"}, {"method": "level"})])
    df = curate.dedup_first(df, ["k", "o_orderstatus"], ["rank", "stage", "o_orderkey"]).drop("rank", "stage")
    df = curate.exclude(df.filter(curate.key_between(C("k"), "0001", "0905")), "k", ["0020"])
    # which columns hold values is known only after a run, so that run is kept
    return curate.prune_null_columns(cut_lineage(curate.blank_to_null(df)))
