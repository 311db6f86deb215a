"""Selecting cells out of stored HTML.

Two shapes are used, both plain Catalyst expressions:

* *flat nodes*: one array column per page, made in place by a regular expression.
  No shuffle; enough for everything that needs document order only.
* *structured nodes*: the token table with table depth, row and cell numbers. Pages are
  hash-partitioned by ``page_id`` while they are still compact, so exploding, the two
  window sorts and the regrouping all run on that one exchange.

A page is one source row before and after, so what is regrouped is bounded by the page.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from html.entities import name2codepoint

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from folioweave.functions.lists import let
from folioweave.functions.literals import sql_list
from folioweave.operators import plan

# scripts, styles and comments end at the end of the page if nothing else ends them; so does a tag that is cut off
NOISE = (r"(?is)<script\b.*?(?:</script\b[^>]*+>|\z)|<style\b.*?(?:</style\b[^>]*+>|\z)|<!--.*?(?:-->|\z)"
         r"|<[/!?A-Za-z][^<>]*+\z")
# A tag is '<', an optional '/' and a letter, and runs to the first '>' outside quoted values. Possessive loops keep
# no way back, so a long page does not fill the matcher's stack.
MARKUP = r"""</?[A-Za-z](?:[^>="']++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+>|<[/!?][^>]*+>"""
WORDS = r"(?:[^<]++|<(?![A-Za-z/!?]))"
TOKEN = rf"{MARKUP}|{WORDS}++|<"
TAG = r"^<(/?[A-Za-z][A-Za-z0-9]*)"

# names that pages use most; a lookup meets them first
COMMON = ["amp", "lt", "gt", "quot", "apos", "nbsp", "eacute", "rsquo", "ndash", "mdash"]


def _names() -> dict[str, str]:
    """Character references by name: those of HTML 4, which page parsers know, from the language's own table."""
    table = {"apos": "'"} | {n: chr(c) for n, c in name2codepoint.items()}
    return {f"{n};": table[n] for n in dict.fromkeys([*COMMON, *table])}


def _old_codes() -> dict[str, str]:
    """Numbers 128 to 159, which stand for the characters of windows-1252."""
    return {f"{b:X}": bytes([b]).decode("cp1252") for b in range(128, 160) if b not in (129, 141, 143, 144, 157)}


# ---------------------------------------------------------------- text and attributes


def clean_html(html: Column) -> Column:
    """Page source without scripts, styles, comments and a tag that is cut off at the end.

    Most pages have none of these, which plain searches tell; only the others go through the pattern.
    """
    low, last = F.lower(html), F.substring_index(html, "<", -1)
    cut_off = html.contains("<") & ~last.contains(">") & last.rlike(r"\A[/!?A-Za-z]")
    return F.when(low.contains("<script") | low.contains("<style") | html.contains("<!--") | cut_off,
                  F.regexp_replace(html, NOISE, "")).otherwise(html)


def written_attr(tok: Column, name: str) -> Column:
    """Value of an attribute as it is written, '' when absent or empty, by one look at the tag."""
    value = r"""["']?((?<=")[^"]*(?=")|(?<=')[^']*(?=')|(?<!["'])[^\s"'>]+)"""
    # most tags do not hold the name at all, which a plain search tells
    return F.when(~F.lower(tok).contains(name.lower()), F.lit("")).otherwise(F.regexp_extract(tok, rf"(?i)\s{name}\s*=\s*{value}", 1))


def raw_attr(tok: Column, name: str) -> Column:
    """Value of an attribute as it is written, NULL when absent or empty; enough for class names and numbers."""
    return F.nullif(written_attr(tok, name), F.lit(""))


def attr(tok: Column, name: str) -> Column:
    """Value of an attribute of an opening tag, NULL when absent or empty."""
    return decoded(tok, raw_attr(tok, name))


def decoded(tok: Column, value: Column) -> Column:
    """A value of a tag with its character references decoded; most tags have none."""
    return F.when(tok.contains("&"), let(value, unescape)).otherwise(value)


def has_attr(tok: Column, name: str) -> Column:
    return tok.rlike(rf"(?i)\s{name}(\s|=|/|>)")


def unescape(c: Column) -> Column:
    """Named and numeric character references to characters, in one pass.

    Numbers outside the character range give the replacement character; a name needs its semicolon, a number does not.
    """
    # one literal, folded to a map when the query is planned
    pairs = "\x01".join(f"{name}\x02{char}" for name, char in _names().items())
    table = F.str_to_map(F.lit(pairs), F.lit("\x01"), F.lit("\x02"))
    old = F.expr(f"map({sql_list([x for kv in _old_codes().items() for x in kv])})")
    runs = F.regexp_extract_all(c, F.lit(r"&#[0-9]+;?|&#[xX][0-9A-Fa-f]+;?|&[A-Za-z0-9]+;|[^&]+|&"), F.lit(0))

    # what is read more than once is bound to a variable: an expression is computed anew wherever it stands
    def number(r: Column) -> Column:
        def hexed(dec: Column) -> Column:
            return F.when(dec != "", F.when(F.length(dec) <= 7, F.conv(dec, 10, 16)).otherwise("FFFFFF")).otherwise(
                F.upper(F.regexp_extract(r, r"^&#[xX]0*([0-9A-Fa-f]+);?$", 1)))

        def char(digits: Column, wide: Column) -> Column:
            bad = (F.length(digits) > 6) | (wide > "0010FFFF") | wide.between("0000D800", "0000DFFF") | (wide == "00000000")
            # the old codes are two digits
            late = F.when(F.length(digits) == 2, F.try_element_at(old, digits))
            return (F.when(digits == "", F.when(r.rlike("^&#[xX]?0+;?$"), F.lit("\ufffd")).otherwise(r))
                    .when(bad, F.lit("\ufffd"))
                    .otherwise(F.coalesce(late, F.decode(F.unhex(wide), "UTF-32"))))

        digits = let(F.regexp_extract(r, r"^&#0*([0-9]+);?$", 1), hexed)
        return let(digits, lambda d: let(F.lpad(d, 8, "0"), lambda w: char(d, w)))

    def one(r: Column) -> Column:
        return (F.when(~r.startswith("&"), r).when(r.startswith("&#"), number(r))
                .otherwise(F.coalesce(F.try_element_at(table, F.substr(r, F.lit(2))), r)))

    return F.when(c.contains("&"), F.array_join(F.transform(runs, one), "")).otherwise(c)


def icon_count(cell_html: Column, pattern: str = r"<img\b") -> Column:
    """How many icons a cell holds; 0 for a blank or missing cell."""
    return F.coalesce(F.regexp_count(cell_html, F.lit(f"(?i){pattern}")), F.lit(0))


def capture(c: Column, pattern: str, group: int = 1) -> Column:
    """First capture, NULL without a match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def capture_all(c: Column, pattern: str, group: int = 1) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(group))


# ---------------------------------------------------------------- flat nodes (no shuffle)


def flat_nodes(html: Column) -> Column:
    """Array of ``(pos, tag, tok)`` in document order; text has tag ``#text``.

    ``pos`` is the index in the array, so it can be used to slice.
    """
    toks = F.regexp_extract_all(clean_html(html), F.lit(TOKEN), F.lit(0))
    return F.transform(
        toks,
        lambda t, i: F.struct(
            i.alias("pos"),
            F.when(is_markup(t), F.lower(F.regexp_extract(t, TAG, 1))).otherwise(F.lit("#text")).alias("tag"),
            t.alias("tok"),
        ),
    )


def some_tags(html: Column, *names: str) -> Column:
    """Array of the tags of these names (lower case, '/' first for closing tags) as written, in document order.

    The page is read by the same grammar as in :func:`flat_nodes`, but only the tags asked for leave the matcher.
    """
    one_of = "|".join(re.escape(n) for n in dict.fromkeys(names))
    wanted = MARKUP.partition("|<[/!?]")[0].replace("</?[A-Za-z]", f"<(?i:{one_of})(?![A-Za-z0-9])", 1)
    toks = F.regexp_extract_all(clean_html(html), F.lit(rf"({wanted})|{TOKEN}"), F.lit(1))
    return F.array_remove(toks, "")


# The three below are SQL text, as the selectors in ``fields`` are: they nest, and one parse costs less than many calls.


def _let(value: str, var: str, body: str) -> str:
    return f"get(transform(array({value}), {var} -> {body}), 0)"


def levels(marks: str) -> str:
    """How deep each opening and closing tag lies, as ``array<struct<level, at, x>>``; no list grows on the way.

    ``marks`` are longs, ``4 * at + 2 * own + open``, in order of ``at``, the place of a tag. A tag's place among all and
    among those of its kind gives the tags of the other kind before it, and so the running depth: before an opening tag,
    after a closing one. A closing tag without an opening one is left out: it is the first to reach its depth below zero.
    """
    def measured(m: str) -> str:
        numbered = f"transform({m}, (x, k) -> struct(x, k))"
        both = [f"transform(filter(n, e -> e.x % 2 = {bit}), (e, j) -> struct({level} AS level, shiftright(e.x, 2) AS at, e.x AS x))"
                for bit, level in ((1, "2 * j - e.k"), (0, "e.k - 2 * j - 1"))]
        return _let(numbered, "n", f"concat({both[0]}, {both[1]})")

    lost = _let("sort_array(filter(f, e -> e.level < 0))", "s",
                "filter(transform(s, (e, i) -> CASE WHEN i = 0 OR get(s, i - 1).level <> e.level THEN e.x END), x -> x IS NOT NULL)")
    matched = f"CASE WHEN exists(f, e -> e.level < 0) THEN {measured(f'array_except(m, {lost})')} ELSE f END"
    return _let(marks, "m", _let(measured("m"), "f", matched))


def outermost(marks: str, every: bool) -> str:
    """Places where the outermost elements begin and end in turn, of ``marks`` as in :func:`levels`.

    With ``every`` all elements count, otherwise those marked ``own``, wherever they lie. What nothing ends has no end.
    """
    def ends(found: str) -> str:
        return f"sort_array(transform(filter({found}, e -> e.level = 0), e -> e.at))"

    if every:
        return ends(levels(marks))
    # ordered by level and place, an element's end stands right behind its beginning
    after = "CASE WHEN get(p, i + 1).level = e.level THEN 4 * get(p, i + 1).at END"
    pairs = f"transform(p, (e, i) -> CASE WHEN e.x & 3 = 3 THEN array_compact(array(4 * e.at + 1, {after})) END)"
    own = _let(f"sort_array({levels(marks)})", "p", f"sort_array(flatten(array_compact({pairs})))")
    return ends(levels(own))


def inside(places: str, borders: str) -> str:
    """``array<struct<no, at>>``: those of the sorted ``places`` between a beginning and its end in ``borders``, with its number.

    Places and borders are sorted together; how many borders stand before a place tells whether it is inside. A place that
    is a border itself counts as before it.
    """
    both = f"sort_array(concat(transform({places}, e -> 2 * e), transform({borders}, e -> 2 * e + 1)))"
    only = f"filter(transform({both}, (x, k) -> struct(x, k)), e -> e.x % 2 = 0)"
    before = f"transform({only}, (e, j) -> struct(e.k - j AS n, shiftright(e.x, 1) AS at))"
    return f"transform(filter({before}, e -> e.n % 2 = 1), e -> struct(CAST(shiftright(e.n + 1, 1) AS INT) AS no, e.at AS at))"


def is_markup(tok: Column) -> Column:
    """True for a tag or declaration, false for text, which may begin with a lone '<'."""
    return tok.rlike(r"\A<[A-Za-z/!?]")


def where(nodes: Column, pred: Callable[[Column], Column]) -> Column:
    """Nodes that satisfy a predicate, in document order."""
    return F.filter(nodes, pred)


def is_tag(*tags: str) -> Callable[[Column], Column]:
    return lambda n: n["tag"].isin(*tags)


def is_text(n: Column) -> Column:
    return n["tag"] == "#text"


def attr_equals(name: str, value: str) -> Callable[[Column], Column]:
    return lambda n: F.coalesce(attr(n["tok"], name) == value, F.lit(False))


def attr_absent(name: str) -> Callable[[Column], Column]:
    return lambda n: ~has_attr(n["tok"], name)


def attr_starts(name: str, prefix: str) -> Callable[[Column], Column]:
    return lambda n: F.coalesce(attr(n["tok"], name).startswith(prefix), F.lit(False))


def attr_contains(name: str, part: str) -> Callable[[Column], Column]:
    return lambda n: F.coalesce(attr(n["tok"], name).contains(part), F.lit(False))


def all_of(*preds: Callable[[Column], Column]) -> Callable[[Column], Column]:
    def both(n: Column) -> Column:
        out = F.lit(True)
        for p in preds:
            out = out & p(n)
        return out

    return both


def nth(nodes: Column, n: int) -> Column:
    """n-th match, 0-based; negative counts from the end; NULL outside."""
    return F.try_element_at(nodes, F.lit(n + 1 if n >= 0 else n))


def nth_after(nodes: Column, pos: Column, n: int) -> Column:
    """The node ``n`` places after a position, NULL behind the end."""
    return F.get(nodes, pos + n)


def span(nodes: Column, start: Column, stop: Column) -> Column:
    """Nodes strictly after position ``start`` and before ``stop`` (to the end if NULL)."""
    first = start + F.lit(1)
    last = F.coalesce(stop, F.size(nodes))
    return F.when(
        start.isNotNull(), F.slice(nodes, first + 1, F.greatest(F.lit(0), last - first))
    ).otherwise(F.slice(nodes, 1, 0))


def after_pos(nodes: Column, pos: Column) -> Column:
    """Nodes after a position. A slice evaluates the position once, a filter would per node."""
    return F.slice(nodes, pos + 2, F.size(nodes))


def first_pos(nodes: Column, pred: Callable[[Column], Column], after: Column | None = None) -> Column:
    """Position of the first node (after a position) that satisfies the predicate."""
    rest = nodes if after is None else after_pos(nodes, after)
    return nth(F.filter(rest, pred), 0)["pos"]


def texts(nodes: Column) -> Column:
    return F.transform(F.filter(nodes, is_text), lambda n: n["tok"])


def full_text(nodes: Column, sep: str = "") -> Column:
    """All text below an element, joined in document order."""
    return F.array_join(texts(nodes), sep)


def text_after(nodes: Column, tag: str) -> Column:
    """Text nodes that directly follow a given tag (``br`` for text after a line break)."""
    hit = F.filter(
        nodes, lambda n: is_text(n) & (F.get(nodes, n["pos"] - 1)["tag"] == tag)
    )
    return F.transform(hit, lambda n: n["tok"])


def section(nodes: Column, start: Callable[[Column], Column], stop: Callable[[Column], Column]) -> Column:
    """Nodes from the first match of ``start`` to the next match of ``stop`` or the page end."""
    return let(first_pos(nodes, start), lambda s: span(nodes, s, first_pos(nodes, stop, after=s)))


def next_section(
    nodes: Column,
    anchor: Callable[[Column], Column],
    start: Callable[[Column], Column],
    stop: Callable[[Column], Column],
    k: int = 1,
) -> Column:
    """The k-th section that opens after an anchor, up to its stop or the page end."""
    opened = nth(F.filter(after_pos(nodes, first_pos(nodes, anchor)), start), k - 1)["pos"]
    return let(opened, lambda s: span(nodes, s, first_pos(nodes, stop, after=s)))


def every(nodes: Column, start: int = 1, step: int = 1) -> Column:
    """Items from the 1-based position ``start`` on whose position fits the step's parity."""
    return F.filter(nodes, lambda n, i: (i + 1 >= start) & ((i + 1 - start) % step == 0))


def has_text(nodes: Column, text: str, yes: str = "Yes", no: str = "No") -> Column:
    """Yes/No flag for an optional section known by its text."""
    found = F.exists(nodes, lambda n: is_text(n) & (F.trim(n["tok"]) == text))
    return F.when(found, F.lit(yes)).otherwise(F.lit(no))


def with_default(guard: Column, value: Column, default: str = "N/A") -> Column:
    """Value of an optional section, the default where the section is missing."""
    return F.when(guard, value).otherwise(F.lit(default))


# ---------------------------------------------------------------- token table


def shred(pages: DataFrame, keep: Sequence[str] = (), partitions: int | None = None,
          cluster: bool = False) -> DataFrame:
    """One row per token: ``page_id, pos, kind, tag, tok`` plus the columns in ``keep``.

    ``cluster=True`` hash-partitions the compact pages by ``page_id`` first, which every
    later per-page window or aggregate then reuses. ``pos`` is 0-based.
    """
    src = pages.select("page_id", *keep, "html")
    if cluster:
        # a fixed count: coalescing by size would pack too many compact pages into one task
        src = src.repartition(partitions or plan.page_partitions(pages), "page_id")
    toks = F.regexp_extract_all(clean_html(F.col("html")), F.lit(TOKEN), F.lit(0))
    long = src.select("page_id", *keep, F.posexplode(toks).alias("pos", "tok"))
    markup = is_markup(F.col("tok"))
    return long.select(
        "page_id",
        *keep,
        "pos",
        F.when(~markup, F.lit("text")).when(F.col("tok").startswith("</"), F.lit("close"))
        .otherwise(F.lit("open")).alias("kind"),
        F.when(markup, F.lower(F.regexp_extract("tok", TAG, 1))).otherwise(F.lit("#text")).alias("tag"),
        "tok",
    )


def _running(w: WindowSpec) -> WindowSpec:
    return w.rowsBetween(Window.unboundedPreceding, Window.currentRow)


def depth_of(tokens: DataFrame, tag: str) -> DataFrame:
    """Add ``depth``: how many elements of ``tag`` are open at each token."""
    w = Window.partitionBy("page_id").orderBy("pos")
    opened = F.sum((F.col("tag") == tag).cast("int")).over(_running(w))
    closed = F.sum((F.col("tag") == f"/{tag}").cast("int")).over(
        w.rowsBetween(Window.unboundedPreceding, -1)
    )
    return tokens.withColumn("depth", F.greatest(F.lit(0), opened - F.coalesce(closed, F.lit(0))))


# one token per tag together with the text that follows it; text after a table stands alone,
# since it lies one level further out than the closing tag
_TAG_AND_TEXT = rf"(?i:</table)\b[^>]*+>|(?:{MARKUP}){WORDS}*+|{WORDS}++|<"
# the closing tags of a cell and of a row, as most pages write them, and the text behind each
_SHUT = rf"(?i:</t[dh]\s*+>){WORDS}*+", rf"(?i:</tr\s*+>){WORDS}*+"
# a tag that ends a table takes none of them along, since what follows lies one level further out
_TAG_AND_SHUT = _TAG_AND_TEXT.replace(
    f"(?:{MARKUP}){WORDS}*+", f"(?=(?i:</table))(?:{MARKUP}){WORDS}*+|(?:{MARKUP}){WORDS}*+(?:{_SHUT[0]})?+(?:{_SHUT[1]})?+")
_WITH_ATTRS = ["table", "td", "th", "img", "a"]
_PLACED = ["table", "tr", "td", "th", "/table", "/tr", "/td", "/th", "img", "a"]


def tag_name(tok: Column) -> Column:
    """Name of a tag, lower case, with '/' for closing tags; the tags that pages use most are known by their beginning."""
    known = None
    for name in ("td", "tr", "table", "th", "br", "/table", "/tr", "/td"):
        hit = tok.startswith(f"<{name}>") | tok.startswith(f"<{name} ")
        known = F.when(hit, F.lit(name)) if known is None else known.when(hit, F.lit(name))
    return known.otherwise(F.lower(F.regexp_extract(tok, TAG, 1)))


def table_tokens(pages: DataFrame, keep: Sequence[str] = (), partitions: int | None = None, fold: bool = False) -> DataFrame:
    """Tags with the text after them, and their table ``depth``, clustered by page.

    Columns ``pos`` (a multiple of four, so that a text may be placed at ``pos + 1``), ``tag`` (with '/' for
    closing tags), ``tok`` (tags whose attributes are asked for) and ``text``. Compared with one row per tag and per text this
    halves the rows that are sorted, and the tag before a text needs no look-back.

    With ``fold`` the closing tags of a cell and a row, which stand right behind a tag and its text, are part of that row
    (``_shut``: 0 none, 1 the cell's, 2 the row's); they count from ``pos + 2`` on. The text behind them, which lies in no
    cell, is left out. That halves the rows once more.
    """
    src = pages.select("page_id", *keep, "html")
    # a fixed count: coalescing by size would pack too many compact pages into one task
    src = src.repartition(partitions or plan.page_partitions(pages), "page_id")
    # compact pages are sorted at little cost; the tags then come out in order, which leaves the sorts below one pass
    src = src.sortWithinPartitions("page_id")
    toks = F.regexp_extract_all(clean_html(F.col("html")), F.lit(_TAG_AND_SHUT if fold else _TAG_AND_TEXT), F.lit(0))
    long = src.select("page_id", *keep, F.posexplode(toks).alias("_i", "tok"))
    # a look at two characters, which for most tags needs no pattern
    markup = F.col("tok").startswith("<t") | F.col("tok").startswith("</") | is_markup(F.col("tok"))
    long = long.select("page_id", *keep, (F.col("_i") * 4).alias("pos"), "tok", markup.alias("_markup"))
    tag = F.when(F.col("_markup"), tag_name(F.col("tok"))).otherwise(F.lit("/table"))
    long = long.select("page_id", *keep, "pos", tag.alias("tag"), "tok", "_markup", F.expr("instr(tok, '>')").alias("_first"))
    # where the tag ends: at the first '>' if no value in quotes can hold it, or else where the grammar says
    plain = F.expr("""NOT (contains(substr(tok, _first + 1), '"') OR contains(substr(tok, _first + 1), "'"))""")
    end = (F.when(~F.col("_markup"), F.lit(0)).when(plain, F.col("_first"))
           .otherwise(F.length(F.regexp_extract("tok", rf"\A(?:{MARKUP})", 0))))
    long = long.withColumn("_end", end)
    text = "substr(tok, _end + 1)"
    if fold:
        # a text as the pattern takes it holds no '</'
        tail = F.expr("CASE WHEN _markup AND locate('</', tok, _end + 1) > 0 THEN locate('</', tok, _end + 1) ELSE 0 END")
        long = long.withColumn("_tail", tail)
        text = "CASE WHEN _tail = 0 THEN substr(tok, _end + 1) ELSE substr(tok, _end + 1, _tail - _end - 1) END"
    # the sorts below move only what is read later: attributes of a few tags, and the text
    long = long.select(
        "page_id", *keep, "pos", "tag", "_markup",
        F.expr(f"CASE WHEN tag IN ({sql_list(_WITH_ATTRS)}) THEN substr(tok, 1, _end) ELSE '' END").alias("tok"),
        F.expr(text).alias("text"),
        *([F.expr("CASE WHEN _tail = 0 THEN 0 WHEN lower(substr(tok, _tail)) LIKE '%</tr%' THEN 2 ELSE 1 END").alias("_shut")]
          if fold else []),
    )
    page = Window.partitionBy("page_id").orderBy("pos")
    closing = F.col("_markup") & (F.col("tag") == "/table")
    opened = F.sum((F.col("tag") == "table").cast("int")).over(_running(page))
    closed = F.sum(closing.cast("int")).over(page.rowsBetween(Window.unboundedPreceding, -1))
    placed = long.withColumn("depth", F.greatest(F.lit(0), opened - F.coalesce(closed, F.lit(0))))
    # after the window, so that the test does not repeat the expressions above
    shut = F.col("_shut") > 0 if fold else F.lit(False)
    return placed.filter(F.col("tag").isin(_PLACED) | (F.col("text") != "") | shut)


def structure(pages: DataFrame, keep: Sequence[str] = (), partitions: int | None = None, fold: bool = False) -> DataFrame:
    """Tags of every page with their text, each placed in its table, row and cell.

    Adds to :func:`table_tokens`: ``tbl``/``row``/``cell`` (positions of the opening tags),
    ``row_no``/``col_no`` (1-based), ``cell_cls`` (class of the cell) and ``stop`` (position
    where an opened table, row or cell ends, NULL at a truncated end). Missing closing tags do
    no harm. All these windows share one sort, by page, depth and position. ``fold`` is as there.
    """
    tokens = table_tokens(pages, keep, partitions, fold)
    level = _running(Window.partitionBy("page_id", "depth").orderBy("pos"))
    tag, pos = F.col("tag"), F.col("pos")
    is_tbl, is_row, is_cell = tag == "table", tag == "tr", tag.isin("td", "th")
    closes = F.col("_markup") & (tag == "/table")

    # closing tags that are part of a row hold from behind it on
    cell_shut, row_shut = (F.col("_shut") > 0, F.col("_shut") == 2) if fold else (F.lit(False), F.lit(False))

    def since(flag: Column, closed: Sequence[str] = (), shut: Column | None = None) -> Column:
        # -1 once a closing tag ends the element, so text between elements has no owner
        if shut is None:
            return F.last(F.when(flag, pos), ignorenulls=True).over(level)
        mark = F.when(shut, F.lit(-1)).when(flag, pos).when(tag.isin(*closed), F.lit(-1))
        if not fold:
            return F.last(mark, ignorenulls=True).over(level)
        # the row itself still lies in the element
        own = F.when(flag, pos).when(tag.isin(*closed), F.lit(-1))
        return F.coalesce(own, F.last(mark, ignorenulls=True).over(level.rowsBetween(Window.unboundedPreceding, -1)))

    def seen(flag: Column) -> Column:
        return F.sum(flag.cast("int")).over(level)

    out = tokens.select(
        "*",
        since(is_tbl).alias("tbl"),
        since(is_row, ["/tr"], row_shut).alias("row"),
        since(is_cell, ["/td", "/th", "/tr"], cell_shut).alias("cell"),
        F.last(F.when(is_cell, F.coalesce(raw_attr(F.col("tok"), "class"), F.lit(""))), ignorenulls=True)
        .over(level).alias("_cls"),
        seen(is_row).alias("_rows"),
        seen(is_cell).alias("_cells"),
        F.when(closes, pos).alias("_tbl_stop"),
        F.when((tag == "tr") | closes, pos).alias("_row_stop"),
        F.when(tag.isin("td", "th", "/td", "/th", "tr", "/tr") | closes, pos).when(cell_shut, pos + 2).alias("_cell_stop"),
    )
    # IGNORE NULLS moves one pointer forward, so the look-ahead stays linear
    nxt = "lead({c}, 1) ignore nulls over (partition by page_id, depth order by pos)"
    out = out.select(
        "*",
        F.last(F.when(is_tbl, F.col("_rows")), ignorenulls=True).over(level).alias("_rows0"),
        F.last(F.when(is_row | is_tbl, F.col("_cells")), ignorenulls=True).over(level).alias("_cells0"),
        F.when(is_tbl, F.expr(nxt.format(c="_tbl_stop")))
        .when(is_row, F.expr(nxt.format(c="_row_stop")))
        .when(is_cell & cell_shut, pos + 2)
        .when(is_cell, F.expr(nxt.format(c="_cell_stop")))
        .alias("stop"),
    )
    in_tbl = F.col("depth") > 0
    in_row = in_tbl & (F.col("row") > F.col("tbl"))
    in_cell = in_row & (F.col("cell") > F.col("row"))
    kept = [c for c in tokens.columns if c not in ("_markup", "_shut")]
    return out.select(
        *kept,
        F.when(in_tbl, F.col("tbl")).alias("tbl"),
        F.when(in_row, F.col("row")).alias("row"),
        F.when(in_cell, F.col("cell")).alias("cell"),
        F.when(in_row, F.col("_rows") - F.col("_rows0")).alias("row_no"),
        F.when(in_cell, F.col("_cells") - F.col("_cells0")).alias("col_no"),
        F.when(in_cell, F.col("_cls")).alias("cell_cls"),
        "stop",
    )


# ---------------------------------------------------------------- rows of records


def records(structured: DataFrame, spec: dict[str, Column], keep: Sequence[str] = ()) -> DataFrame:
    """One output row per table row, all fields picked in one aggregate.

    ``spec`` maps a field to an aggregate over the row's tokens, see :func:`first_of` and
    :func:`joined_of`. The grouping keys start with ``page_id``, so the page partitioning holds.
    """
    rows = structured.filter(F.col("row").isNotNull())
    return rows.groupBy("page_id", *keep, "row", "row_no").agg(
        *[c.alias(name) for name, c in spec.items()]
    )


def first_of(cond: Column, value: Column) -> Column:
    """Value at the first token (in document order) where the condition holds."""
    return F.min_by(value, F.when(cond & value.isNotNull(), F.col("pos")))


def joined_of(cond: Column, value: Column) -> Column:
    """All values where the condition holds, joined in document order."""
    pairs = F.sort_array(F.collect_list(F.when(cond, F.struct("pos", value.alias("v")))))
    return F.array_join(F.transform(pairs, lambda p: p["v"]), "")


def profile(pages: DataFrame, tags: Sequence[str]) -> DataFrame:
    """Node counts per page, straight from the page text (no explode, no shuffle)."""
    body = clean_html(F.col("html"))
    return pages.select(
        "page_id",
        *[F.regexp_count(body, F.lit(rf"(?i)<{t}[\s/>]")).cast("bigint").alias(f"n_{t}") for t in tags],
    )


def number_rows(tokens: DataFrame, tag: str) -> DataFrame:
    """Treat every ``tag`` element as a row: adds ``row`` (opening position) and ``row_no``."""
    page = _running(Window.partitionBy("page_id").orderBy("pos"))
    opened = F.col("tag") == tag
    return tokens.select(
        "*",
        F.last(F.when(opened, F.col("pos")), ignorenulls=True).over(page).alias("row"),
        F.sum(opened.cast("int")).over(page).alias("row_no"),
    )
