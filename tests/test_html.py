"""Selectors on small invented pages."""

import pytest
from pyspark.sql import functions as F

from folioweave.operators import fields, html
from folioweave.sources import pages as S

C = F.col

NESTED = """<html><body>
<table class="outer"><tr><td class="lab">Name<td class="lab">Types<td class="lab">Note<tr><td class="cen">First<br>second line</td><td class="cen">
 <table><tr><td width="50%">Plant</td><td><img src="/t/grass.gif"></td></tr>
        <tr><td width="50%">Sandy</td><td><img src="/t/ground.gif"><img src="/t/rock.gif"></td></tr></table> tail </td>
 <td class="cen big">A &amp; B&nbsp;&#233;</td></tr>
<tr><td><b>Bold</b></td><td>x</td><td>y</td></tr>
<tr><td>skip</td></tr>
<tr><td class="cen">v1</td><td class="cen">v2</td>"""


def docs(spark, *bodies, labels=()):
    pages = spark.createDataFrame([(i, f"http://x/{i}", b) for i, b in enumerate(bodies)], S.PAGE_SCHEMA)
    return fields.with_labels(fields.documents(pages), list(labels))


def pick(spark, expr, *bodies, labels=()):
    return [r[0] for r in docs(spark, *bodies, labels=labels).orderBy("page_id").select(F.expr(expr)).collect()]


D = fields.Doc()


def test_cells_of_nested_table_with_unclosed_tags(spark):
    got = pick(spark, "transform(cells, c -> concat_ws(',', c.depth, c.row_no, c.col_no))", NESTED)[0]
    assert got == ["1,1,1", "1,1,2", "1,1,3", "1,2,1", "1,2,2", "2,1,1", "2,1,2", "2,2,1", "2,2,2", "1,2,3",
                   "1,3,1", "1,3,2", "1,3,3", "1,4,1", "1,5,1", "1,5,2"]


def test_label_value_and_truncated_end(spark):
    labels = ["Name", "Types", "Note", "Bold"]
    assert pick(spark, D.value("Name", 1), NESTED, labels=labels) == ["First"]
    assert pick(spark, D.value("Name", 1, n=1), NESTED, labels=labels) == ["second line"]
    assert pick(spark, D.value("Note", 3), NESTED, labels=labels) == ["A & B é"]
    assert pick(spark, D.value("Bold", 2, mode="bold", offset=2, cls="cen"), NESTED, labels=labels) == ["v2"]
    assert pick(spark, D.nth(D.own_texts(D.beside_cell("Bold")), 0), NESTED, labels=labels) == ["x"]
    assert pick(spark, D.value("Missing", 1), NESTED, labels=["Missing"]) == [None]


def test_nested_content_does_not_leak(spark):
    labels = ["Types"]
    cell = D.value_cell("Types", 2)
    assert pick(spark, f"transform({D.own_texts(cell)}, t -> trim(t))", NESTED, labels=labels)[0][-1] == "tail"
    assert "Plant" not in pick(spark, D.own_texts(cell), NESTED, labels=labels)[0]
    assert [t.strip() for t in pick(spark, D.all_texts(cell), NESTED, labels=labels)[0] if t.strip()] == ["Plant", "Sandy", "tail"]
    assert pick(spark, D.values_in(cell, starts="/t/"), NESTED, labels=labels) == [["/t/grass.gif", "/t/ground.gif", "/t/rock.gif"]]
    assert pick(spark, f"size({D.rows_in(cell)})", NESTED, labels=labels) == [2]


def test_class_texts_count_by_text_node(spark):
    body = "<table><tr><td class='a'>1<br>2</td><td class='b a'>3</td><td>4</td></tr></table>"
    assert pick(spark, D.class_texts("a"), body) == [["1", "2", "3"]]
    assert pick(spark, D.class_texts(None), body) == [["4"]]
    assert pick(spark, D.nth(D.class_texts("a"), -3), body) == ["1"]


def test_text_between_cells_has_no_owner(spark):
    body = "<table>\n<tr>\n<td>a</td> stray <td>b</td>\n</tr> stray\n<tr><td>c</td></tr></table> after"
    assert pick(spark, "transform(texts, t -> t.text)", body) == [["a", "b", "c"]]


def test_icons(spark):
    body = "<table><tr><td class='c'>&nbsp;</td><td class='c'><img src='x'><img src='x'></td></tr></table>"
    assert pick(spark, f"array({D.icons(D.nth(D.cells('c'), 0))}, {D.icons(D.nth(D.cells('c'), 1))}, {D.icons(D.nth(D.cells('c'), 2))})", body) == [[0, 2, None]]


def test_script_text_is_no_markup(spark):
    body = "<script>var t = '<table><tr><td>no</td>';</script><!-- <td>no</td> --><style>td{}</style><table><tr><td>yes</td></tr></table>"
    assert pick(spark, "transform(texts, t -> t.text)", body) == [["yes"]]


def test_tokens_rebuild_the_clean_page(spark, sf):
    pages = S.read_pages(spark, f"{sf}/pages.parquet")
    joined = html.shred(pages).groupBy("page_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "tok"))), lambda x: x["tok"]), "").alias("joined"))
    bad = pages.join(joined, "page_id").filter(html.clean_html(C("html")) != C("joined")).count()
    assert bad == 0


@pytest.mark.parametrize("tag, want", [
    ('<a href="x y">', "x y"), ("<a href='q'>", "q"), ("<a href=bare class=c>", "bare"), ("<a data-href='n'>", None), ('<a href="">', None),
    ('<A HREF = "Up">', "Up"), ("<a href='/p?a=1&amp;b=2'>", "/p?a=1&b=2"), ("<a title='1 > 0' href=/x>", "/x"),
])
def test_attr(spark, tag, want):
    assert spark.range(1).select(html.attr(F.lit(tag), "href")).first()[0] == want


@pytest.mark.parametrize("text, want", [
    ("a &amp; b", "a & b"), ("&amp;lt;", "&lt;"), ("&#233;&#xE9;&eacute;", "ééé"), ("&#8217;", "’"), ("&unknown; & x", "&unknown; & x"),
    ("100% &copy", "100% &copy"), ("&#128512;&#x1F600;&#x000E9;", "😀😀é"), ("&uuml;&ntilde;&pound;&thetasym;&yuml;", "üñ£ϑÿ"),
    ("&#65 &#x41.", "A A."), ("&#0;&#xD800;&#1114112;&#99999999999;", "\ufffd" * 4), ("&#150;", "–"), ("&;&#;&#x;&", "&;&#;&#x;&"), (None, None),
])
def test_unescape(spark, text, want):
    assert spark.range(1).select(html.unescape(F.lit(text))).first()[0] == want


def test_quoted_marks_lone_signs_and_cut_scripts(spark):
    body = "<table><tr><td title='Attack > Defense'>v</td><td>a < b <td>c</td><td x=\"'>\" y='\">'>d <3</td></tr></table><script>t='<td>no</td>'"
    assert pick(spark, "transform(texts, t -> t.text)", body) == [["v", "a < b ", "c", "d <3"]]
    assert pick(spark, "transform(cells, c -> c.col_no)", body) == [[1, 2, 3, 4]]
    flat = spark.range(1).select(html.flat_nodes(F.lit("x<p a='>'>1 < 2</p> it's <b>don't</b><!-- > --><a href='cut")).alias("n")).first().n
    assert [(x.tag, x.tok) for x in flat] == [("#text", "x"), ("p", "<p a='>'>"), ("#text", "1 < 2"), ("/p", "</p>"), ("#text", " it's "),
                                              ("b", "<b>"), ("#text", "don't"), ("/b", "</b>")]


def test_long_pages_do_not_fill_the_stack(spark):
    for body in ("a < " * 200_000, "<p " + "a='b' " * 100_000 + ">x", "<p>" * 100_000, "<p a=\"" + "x" * 300_000):
        assert spark.createDataFrame([(body,)], "h string").select(F.size(html.flat_nodes(C("h")))).first()[0] >= 0


def test_links_in_nested_containers(spark):
    body = "<div><div>..</div><a href=/2></div><a href=/no><div><a href=/3><div><a href=/4></div></div></div><div><a href=/5>"
    pages = spark.createDataFrame([(1, "http://x/", body)], S.PAGE_SCHEMA)
    got = [(r.container_no, r.href) for r in S.discover_links(pages, "div", "a", "href").orderBy("pos").collect()]
    assert got == [(1, "/2"), (2, "/3"), (2, "/4"), (3, "/5")]
    assert [r.href for r in S.discover_links(pages, "div", "a", "href", first_n=1).collect()] == ["/2"]


def test_links_by_container(spark):
    body = ("<select name='S'><option value='/a'><option value='#'></select><select name='T'><option value='/b'></select>"
            "<select name='S'><option value='/c'><option value='/d'>")
    pages = spark.createDataFrame([(1, "http://x/", body)], S.PAGE_SCHEMA)
    def got(**kw):
        return [(r.container_no, r.href) for r in S.discover_links(pages, "select", "option", "value", **kw).orderBy("pos").collect()]
    assert got() == [(1, "/a"), (2, "/b"), (3, "/c"), (3, "/d")]
    assert got(first_n=2) == [(1, "/a"), (2, "/b")]
    assert got(container_attr=("name", "S"), drop=()) == [(1, "/a"), (1, "#"), (2, "/c"), (2, "/d")]


def test_page_formats(spark, tmp_path):
    rows = [(1, "http://x/1", "<p>one\n, \"two\"</p>"), (2, "http://x/2", "<b>")]
    df = spark.createDataFrame(rows, S.PAGE_SCHEMA)
    df.write.parquet(str(tmp_path / "p"))
    df.write.json(str(tmp_path / "j"))
    df.write.option("header", True).option("escape", '"').csv(str(tmp_path / "c"))
    for fmt, name in (("parquet", "p"), ("json", "j"), ("csv", "c")):
        got = sorted(tuple(r) for r in S.read_pages(spark, str(tmp_path / name), fmt).collect())
        assert got == rows, fmt
    folder = tmp_path / "t"
    folder.mkdir()
    (folder / "a.html").write_text("<i>\nx")
    got = S.read_pages(spark, str(folder), "text").collect()
    assert len(got) == 1 and got[0].html == "<i>\nx" and got[0].url.endswith("a.html")


def plain_links(tokens, first_n=None, own_only=False):
    """What a reader with a stack finds: ``(container_no, href)`` of links inside outermost boxes."""
    depth = since = no = 0
    out = []
    for tok in tokens:
        if tok in ("<div>", "<div class=q>"):
            if not since and (not own_only or "class=q" in tok):
                since, no = depth + 1, no + 1
            depth += 1
        elif tok == "</DIV >":
            if depth <= since:
                since = 0
            depth = max(depth - 1, 0)
        elif tok.startswith("<a ") and since and (first_n is None or no <= first_n):
            out.append((no, tok[len("<a href=/"):-1]))
    return out


@pytest.mark.parametrize("kw", [{}, {"first_n": 2}, {"container_attr": ("class", "q")}])
def test_links_of_random_boxes_match_a_stack(spark, kw):
    import random

    rnd = random.Random(7)
    kinds = ["<div>", "<div class=q>", "</DIV >", "</DIV >", "<a>", "text <", "<divider>", "<!-- <div> -->", "<p title='</div>'>"]
    pages = []
    for _ in range(300):
        toks = [rnd.choice(kinds) for _ in range(rnd.randint(0, 40))]
        pages.append([f"<a href=/{i}>" if t == "<a>" else t for i, t in enumerate(toks)])
    df = spark.createDataFrame([(i, "http://x/", " ".join(p)) for i, p in enumerate(pages)], S.PAGE_SCHEMA)
    got = S.discover_links(df, "div", "a", "href", **kw).orderBy("page_id", "pos").collect()
    want = [(i, k + 1, no, f"/{h}") for i, p in enumerate(pages)
            for k, (no, h) in enumerate(plain_links(p, kw.get("first_n"), "container_attr" in kw))]
    assert [(r.page_id, r.pos, r.container_no, r.href) for r in got] == want


def test_a_container_may_be_the_item(spark):
    page = "<li value=1><li value=2></li></li><li value=3><li value=4>"
    df = spark.createDataFrame([(1, "http://x/", page), (2, "http://x/", None), (3, "http://x/", "")], S.PAGE_SCHEMA)
    got = S.discover_links(df, "li", "li", "value").orderBy("pos").collect()
    assert [(r.page_id, r.container_no, r.href) for r in got] == [(1, 1, "2"), (1, 2, "4")]


def test_pages_with_very_many_links_and_boxes(spark):
    n = 20_000
    one = "<div>" + "".join(f"<a href=/{i}>x</a>" for i in range(n)) + "</div>"
    many = "".join(f"<div><a href=/{i}>x</a></div></div>" for i in range(n))
    df = spark.createDataFrame([(1, "http://x/", one), (2, "http://x/", many)], S.PAGE_SCHEMA)
    got = S.discover_links(df, "div", "a", "href").groupBy("page_id").agg(
        F.count("*").alias("n"), F.max("container_no").alias("boxes"), F.max("pos").alias("pos")).orderBy("page_id").collect()
    assert [tuple(r) for r in got] == [(1, n, 1, n), (2, n, n, n)]


def test_noise_is_cut_only_where_there_is_some(spark):
    pages = ["a <b>c</b>", "a<SCRIPT x>1 < 2</script >b", "x<style>y", "p <!-- q --> r <!-- s", "t <b cut", "t < 3", "t </", "<", "u <!x", "", None]
    got = [r[0] for r in spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, h string").orderBy("i")
           .select(html.clean_html(F.col("h"))).collect()]
    whole = [r[0] for r in spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, h string").orderBy("i")
             .select(F.regexp_replace("h", html.NOISE, "")).collect()]
    assert got == whole


def test_closing_tags_ride_with_the_tag_before(spark):
    page = ("<table><tr><td>a</td> lost <td class='c'>b<br>c</td>\n</tr> lost <tr><td><table><tr><td>in</td></tr></table>after</td></tr></table>"
            "<td>out</td>")
    pages = spark.createDataFrame([(1, page), (2, "</td>")], "page_id LONG, html STRING")
    shut = html.structure(pages, fold=True)
    # seven closing tags of page 1 are no rows, the one behind the text "after" is; the one of page 2 has no tag before it
    assert shut.filter("page_id = 1").count() == 15 and shut.count() == 16
    docs = {r.page_id: r for r in fields.documents(pages).collect()}
    assert docs[2].cells == [] and docs[2].texts == []
    texts = [(t.text, t.direct) for t in docs[1].texts]
    assert texts == [("a", True), ("b", True), ("c", True), ("in", True), ("after", True)]
    assert [c.first for c in docs[1].cells] == ["a", "b", None, "in", None]
    # a cell ends behind its texts and before what follows it
    cells, at = docs[1].cells, {t.text: t.pos for t in docs[1].texts}
    assert at["a"] < cells[0].stop < cells[1].pos < at["c"] < cells[1].stop < cells[2].pos
    assert at["in"] < cells[3].stop < at["after"] < cells[2].stop
