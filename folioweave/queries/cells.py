"""HTML selection over the pages table."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import lists as L
from folioweave.functions import text as X
from folioweave.operators import forms, html, joins
from folioweave.queries.registry import query, spread_table, table
from folioweave.sources.pages import read_pages

C = F.col

CLEAN = r"""clean AS (SELECT page_id, regexp_replace(html,
    '(?is)<script\b.*?(?:</script\b[^>]*>|\z)|<style\b.*?(?:</style\b[^>]*>|\z)|<!--.*?(?:-->|\z)|<[/!?A-Za-z][^<>]*\z', '', 'g') AS h FROM pages)"""
TOK = CLEAN + r""", tok AS (SELECT page_id, u.tok, u.pos - 1 AS pos FROM clean,
    unnest(regexp_extract_all(h, '<[^>]*>|[^<]+')) WITH ORDINALITY AS u(tok, pos)),
    tag AS (SELECT page_id, pos, tok, CASE WHEN tok LIKE '<%' THEN
      lower(regexp_extract(tok, '^<(/?[A-Za-z][A-Za-z0-9]*)', 1)) ELSE '#text' END AS tag FROM tok)"""
LI = r"li AS (SELECT page_id, regexp_extract_all(h, '(?s)<li>(.*?)</li>', 1) AS li FROM clean)"
BARE = r"regexp_replace({x}, '<[^>]*>', '', 'g')"


def pages(spark, sf):
    return read_pages(spark, f"{sf}/pages.parquet")


def nodes(spark, sf):
    return pages(spark, sf).select("page_id", html.flat_nodes(C("html")).alias("n"))


@query("h1_tokens", f"WITH {TOK} SELECT page_id, tag, count(*) AS n FROM tag GROUP BY ALL")
def h1(spark, sf):
    return html.shred(pages(spark, sf)).groupBy("page_id", "tag").agg(F.count("*").alias("n"))


# pieces whose tags a plain pattern gets wrong, before and after a page that ends with a whole tag
ODD_START = "<p title='Attack > Defense'>a < b <i>x</i> 3 <4</p>"
ODD_END = "<em>last</em><script>var t = '<p>no</p>';"


@query("h1_grammar", f"""
    WITH {TOK}, t AS (SELECT page_id, tag, count(*) AS n FROM tag GROUP BY ALL
      UNION ALL SELECT page_id, unnest(['p', '#text', 'i', '#text', '/i', '#text', '/p', 'em', '#text', '/em']), 1 FROM pages)
    SELECT page_id, tag, sum(n)::BIGINT AS n FROM t GROUP BY ALL""")
def h1_grammar(spark, sf):
    # a cut-off tag at the end of a page goes first, as the page alone would lose it
    whole = html.clean_html(C("html"))
    odd = pages(spark, sf).select("page_id", "url", F.concat(F.lit(ODD_START), whole, F.lit(ODD_END)).alias("html"))
    return html.shred(odd).groupBy("page_id", "tag").agg(F.count("*").alias("n"))


@query("h1_depth", f"""
    WITH {TOK}, d AS (SELECT page_id, pos, greatest(0, sum((tag = 'p')::INT) OVER w -
        coalesce(sum((tag = '/p')::INT) OVER (PARTITION BY page_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS depth
      FROM tag WINDOW w AS (PARTITION BY page_id ORDER BY pos))
    SELECT page_id, max(depth)::BIGINT AS max_depth, sum(depth)::BIGINT AS sum_depth FROM d GROUP BY 1""")
def h1_depth(spark, sf):
    toks = html.depth_of(html.shred(pages(spark, sf), cluster=True), "p")
    return toks.groupBy("page_id").agg(F.max("depth").alias("max_depth"), F.sum("depth").alias("sum_depth"))


@query("h2_nth", f"""
    WITH {CLEAN}, {LI}
    SELECT page_id, {BARE.format(x='li[1]')} AS first_li, {BARE.format(x='li[3]')} AS third_li,
           {BARE.format(x='li[-1]')} AS last_li, {BARE.format(x='li[-3]')} AS third_last FROM li""")
def h2(spark, sf):
    n = C("n")
    def item(k):
        li = html.nth(html.where(n, html.is_tag("li")), k)["pos"]
        return html.full_text(html.span(n, li, html.first_pos(n, html.is_tag("/li"), after=li)))
    picks = {"first_li": 0, "third_li": 2, "last_li": -1, "third_last": -3}
    found = F.size(html.where(n, html.is_tag("li")))
    return nodes(spark, sf).select(
        "page_id", *[F.when(found > (k if k >= 0 else -k - 1), item(k)).alias(a) for a, k in picks.items()])


@query("h3_attr", f"""
    WITH {CLEAN} SELECT page_id, {BARE.format(x="regexp_extract(h, '(?s)<div class=.ad.>(.*?)</div>', 1)")} AS ad,
      len(regexp_extract_all(h, '<[a-z][^>]* class='))::INTEGER AS n_class,
      len(list_filter(regexp_extract_all(h, '<a href="([^"]*)"', 1), lambda x: x LIKE '/t%'))::INTEGER AS n_t_links,
      len(list_filter(regexp_extract_all(h, '<a href="([^"]*)"', 1), lambda x: x LIKE '%th%'))::INTEGER AS n_th_links
    FROM clean""")
def h3(spark, sf):
    n = C("n")
    is_a = html.is_tag("a")
    ad = html.section(n, html.all_of(html.is_tag("div"), html.attr_equals("class", "ad")), html.is_tag("/div"))
    tags = html.where(n, lambda x: ~html.is_text(x) & ~x["tag"].startswith("/"))
    return nodes(spark, sf).select(
        "page_id", html.full_text(ad).alias("ad"),
        (F.size(tags) - F.size(html.where(tags, html.attr_absent("class")))).alias("n_class"),
        F.size(html.where(n, html.all_of(is_a, html.attr_starts("href", "/t")))).alias("n_t_links"),
        F.size(html.where(n, html.all_of(is_a, html.attr_contains("href", "th")))).alias("n_th_links"))


ARTICLE = BARE.format(x=r"regexp_extract(h, '(?s)<article[^>]*>(.*?)(?:</article|\z)', 1)")


@query("h4_section", f"WITH {CLEAN} SELECT page_id, {ARTICLE} AS body FROM clean")
def h4(spark, sf):
    body = html.section(C("n"), html.is_tag("article"), html.is_tag("/article"))
    return nodes(spark, sf).select("page_id", html.full_text(body).alias("body"))


@query("h5_rows", f"""
    WITH {CLEAN}, {LI} SELECT page_id, u.pos::INTEGER AS pos, {BARE.format(x='u.li')} AS item
    FROM li, unnest(li.li) WITH ORDINALITY AS u(li, pos) WHERE u.pos > 2 AND u.pos % 2 = 1""")
def h5(spark, sf):
    items = html.capture_all(html.clean_html(C("html")), r"(?s)<li>(.*?)</li>")
    numbered = F.transform(items, lambda x, i: F.struct((i + 1).alias("pos"), x.alias("li")))
    return pages(spark, sf).select("page_id", F.inline(html.every(numbered, start=3, step=2))).select(
        "page_id", "pos", F.regexp_replace("li", "<[^>]*>", "").alias("item"))


@query("h6_label", f"""
    WITH {TOK} SELECT a.page_id, b.tok AS heading FROM tag a JOIN tag b
      ON a.page_id = b.page_id AND b.pos = a.pos + 1 WHERE a.tag = 'h1'""")
def h6(spark, sf):
    def beside(x):
        return html.nth_after(C("n"), x["pos"], 1)["tok"]
    found = F.transform(html.where(C("n"), html.is_tag("h1")), beside)
    return nodes(spark, sf).select("page_id", F.explode(found).alias("heading"))


@query("h6_next_turn", """
    SELECT a.conv_id, a.turn, b.text AS reply FROM conversations a
    LEFT JOIN conversations b ON a.conv_id = b.conv_id AND b.turn = a.turn + 1 WHERE a.role = 'user'""")
def h6_turn(spark, sf):
    conv = table(spark, sf, "conversations")
    return joins.value_below(conv, ["conv_id"], "turn", C("role") == "user", "text", out="reply")


@query("h7_after_br", rf"""
    WITH {CLEAN} SELECT page_id, NULLIF(regexp_extract(h, '(?is)<br\s*/?>([^<]+)', 1), '') AS after_br,
      len(regexp_extract_all(h, '(?is)<br\s*/?>([^<]+)', 1))::INTEGER AS n_after FROM clean""")
def h7(spark, sf):
    got = html.text_after(C("n"), "br")
    return nodes(spark, sf).select("page_id", html.nth(got, 0).alias("after_br"), F.size(got).alias("n_after"))


@query("h8_text", f"""
    WITH {TOK} SELECT page_id, string_agg(tok, '' ORDER BY pos) AS page_text FROM tag WHERE tag = '#text' GROUP BY 1""")
def h8(spark, sf):
    return nodes(spark, sf).select("page_id", html.full_text(C("n")).alias("page_text"))


@query("h8_entities", """
    SELECT p_partkey, p_name || ' 😀 😀 é üñ£ ' || chr(128512 + (p_partkey % 60)::INTEGER) || ' & &unknown; ' AS text,
      'x&y' || p_size AS title FROM part""")
def h8_entities(spark, sf):
    k = (C("p_partkey") % 60).cast("int")
    body = F.concat(F.lit("<p title='x&amp;y"), C("p_size").cast("string"), F.lit("'>"), C("p_name"),
                    F.lit(" &#128512; &#x1F600; &#x000E9; &uuml;&ntilde;&pound; &#"), (k + 128512).cast("string"), F.lit("; &amp; &unknown; </p>"))
    rows = spread_table(spark, sf, "part", "p_partkey", "p_size", "p_name").select("p_partkey", html.flat_nodes(body).alias("n"))
    return rows.select("p_partkey", html.unescape(html.full_text(C("n"))).alias("text"),
                       html.attr(html.nth(C("n"), 0)["tok"], "title").alias("title"))


@query("h9_code", f"""
    WITH {CLEAN} SELECT page_id, list_transform(regexp_extract_all(h, '<a href="([^"]*)"', 1),
      lambda x: upper(left(replace(replace(x, '/', ''), ',', ''), 1)) || lower(substr(replace(replace(x, '/', ''), ',', ''), 2)))[1] AS code
    FROM clean""")
def h9(spark, sf):
    first = html.nth(html.capture_all(html.clean_html(C("html")), '<a href="([^"]*)"'), 0)
    return pages(spark, sf).select("page_id", X.code_from_path(first, "/", ",").alias("code"))


@query("h10_records", f"""
    WITH {CLEAN}, {LI} SELECT page_id, u.pos AS row_no, {BARE.format(x='u.li')} AS title,
      regexp_extract(u.li, 'href="([^"]*)"', 1) AS href FROM li, unnest(li.li) WITH ORDINALITY AS u(li, pos)""")
def h10(spark, sf):
    toks = html.number_rows(html.shred(pages(spark, sf), cluster=True), "li")
    inside = toks.filter(C("tag").isin("li", "a") | (C("kind") == "text"))
    first_a = html.first_of(C("tag") == "a", html.attr(C("tok"), "href"))
    title = html.first_of(C("kind") == "text", C("tok"))
    return html.records(inside, {"title": title, "href": first_a}).select("page_id", "row_no", "title", "href")


@query("h11_icons", rf"""
    WITH {CLEAN} SELECT page_id, len(regexp_extract_all(h, '<b>'))::INTEGER AS n_bold,
      (page_id % 4)::INTEGER AS n_img FROM clean""")
def h11(spark, sf):
    icons = F.repeat(F.lit("<IMG src='/i.png'>"), (C("page_id") % 4).cast("int"))
    body = F.concat(icons, html.clean_html(C("html")))
    return pages(spark, sf).select(
        "page_id", html.icon_count(body, r"<b\b").alias("n_bold"), html.icon_count(body, r"<img\b").alias("n_img"))


@query("h12_capture", f"""
    SELECT page_id, regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
      len(regexp_extract_all(html, 'href="([^"]*)"', 1))::INTEGER AS n_href,
      regexp_extract_all(html, 'href="([^"]*)"', 1)[1] AS first_href FROM pages""")
def h12(spark, sf):
    hrefs = html.capture_all(C("html"), 'href="([^"]*)"')
    return pages(spark, sf).select(
        "page_id", html.capture(C("html"), '<html lang="([a-z]+)"').alias("lang"),
        F.size(hrefs).alias("n_href"), html.nth(hrefs, 0).alias("first_href"))


@query("h13_segments", """
    SELECT l_orderkey, l_linenumber, l_linenumber::INTEGER AS base_hp, (l_quantity::INTEGER % 10)::INTEGER AS base_atk,
      ((l_quantity::INTEGER + 1) % 10)::INTEGER AS other_atk, 2::INTEGER AS n_forms FROM lineitem""")
def h13(spark, sf):
    q = C("l_quantity").cast("int")
    cell = F.format_string("%d HP<br>%d Attack<br><b>Other</b><br>%d Attack<br>", C("l_linenumber"), q % 10, (q + 1) % 10)
    m = L.segments_to_map(cell, default_key="Normal")
    base, other = L.stat_vector(L.lookup(C("m"), F.lit("Normal"))), L.stat_vector(L.lookup(C("m"), F.lit("Other")))
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", m.alias("m"))
    return df.select("l_orderkey", "l_linenumber", base.alias("b"), other.alias("o"), F.size("m").alias("n_forms")).select(
        "l_orderkey", "l_linenumber", L.at(C("b"), 0).alias("base_hp"), L.at(C("b"), 1).alias("base_atk"),
        L.at(C("o"), 1).alias("other_atk"), "n_forms")


@query("h14_flag", """
    SELECT page_id, CASE WHEN html LIKE '%</body>%' THEN 'Yes' ELSE 'No' END AS closed,
      CASE WHEN regexp_matches(html, '>\\s*The\\s*<') THEN 'Yes' ELSE 'No' END AS has_the FROM pages""")
def h14(spark, sf):
    closed = F.when(F.exists(C("n"), html.is_tag("/body")), "Yes").otherwise("No")
    return nodes(spark, sf).select("page_id", closed.alias("closed"), html.has_text(C("n"), "The").alias("has_the"))


@query("h15_default", r"""
    WITH b AS (SELECT page_id, regexp_extract_all(html, '<li>(?:<[^>]*>)*([^<]*)', 1) AS li FROM pages)
    SELECT page_id, coalesce(li[6], 'N/A') AS sixth, CASE WHEN len(li) >= 6 THEN 'long' ELSE 'N/A' END AS kind FROM b""")
def h15(spark, sf):
    items = html.capture_all(C("html"), r"<li>(?:<[^>]*>)*([^<]*)")
    guard = F.size("li") >= 6
    return pages(spark, sf).select("page_id", items.alias("li")).select(
        "page_id", html.with_default(guard, html.nth(C("li"), 5)).alias("sixth"),
        html.with_default(guard, F.lit("long")).alias("kind"))


@query("h16_next", rf"""
    WITH {CLEAN} SELECT page_id,
      {BARE.format(x="regexp_extract(h, '(?s)<h1.*?<p[^>]*>(.*?)(?:<p[ >]|</p|</article|" + chr(92) + "z)', 1)")} AS first_par,
      {BARE.format(x="regexp_extract(h, '(?s)<h1.*?<p[^>]*>.*?<p[^>]*>(.*?)(?:<p[ >]|</p|</article|" + chr(92) + "z)', 1)")} AS second_par
    FROM clean""")
def h16(spark, sf):
    n = C("n")
    stop = html.is_tag("p", "/p", "/article")
    def par(k):
        return html.full_text(html.next_section(n, html.is_tag("h1"), html.is_tag("p"), stop, k))
    return nodes(spark, sf).select("page_id", par(1).alias("first_par"), par(2).alias("second_par"))


COUNTS = ", ".join(rf"len(regexp_extract_all(h, '(?i)<{t}[\s/>]'))::BIGINT AS n_{t}" for t in ("p", "li", "b", "br"))


@query("h17_profile", f"WITH {CLEAN} SELECT page_id, {COUNTS} FROM clean")
def h17(spark, sf):
    return html.profile(pages(spark, sf), ["p", "li", "b", "br"])


@query("j4_resolve", f"""
    WITH {CLEAN}, t AS (SELECT page_id, {COUNTS} FROM clean),
    c AS (SELECT page_id, n_p % 4 AS nt, n_li % 4 AS nf, n_br % 4 AS ns, i FROM t, (VALUES (0), (1)) AS f(i))
    SELECT page_id, i::INTEGER AS form_index,
      CASE WHEN nt = nf AND nf = ns THEN 'map' WHEN nt = nf AND ns = 1 THEN 'map' WHEN nt = 0 THEN 'shared'
           WHEN nf = ns THEN 'shared' ELSE 'map' END AS type_mode,
      CASE WHEN nt = nf AND nf = ns THEN i WHEN nt = nf AND ns = 1 THEN 0 WHEN nt = 0 AND nf = ns THEN i
           ELSE least(i, 1) END::INTEGER AS stat_index FROM c""")
def j4(spark, sf):
    counts = html.profile(pages(spark, sf), ["p", "li", "br"]).select(
        "page_id", (C("n_p") % 4).alias("nt"), (C("n_li") % 4).alias("nf"), (C("n_br") % 4).alias("ns"),
        F.explode(F.array(F.lit(0), F.lit(1))).alias("form_index"))
    mode, stat = forms.resolve_forms(C("nt"), C("nf"), C("ns"), C("form_index"), gen=7)
    return counts.select("page_id", "form_index", mode.alias("type_mode"), stat.cast("int").alias("stat_index"))
