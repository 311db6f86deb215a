"""Fields of a page, looked up by class, label, caption or neighbour.

:func:`documents` regroups the structured tokens of a page into three arrays, and
:class:`Doc` writes selectors over them as Spark SQL text: parsing one expression per field
costs far less than building each lambda from Column objects. A row's arrays never hold more
than that one page.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions.literals import sql_list, sql_value
from folioweave.operators import html, plan

PLACE = ["depth", "tbl", "row", "cell", "row_no", "col_no"]


def documents(pages: DataFrame, keep: Sequence[str] = (), partitions: int | None = None) -> DataFrame:
    """One row per page with sorted arrays ``cells``, ``texts`` and ``tags``.

    * ``cells``: place, ``stop``, ``cls``, ``align``, ``colspan``, ``first`` (the text right behind the cell's tag, which is
      the first of its own texts; NULL when there is none)
    * ``texts`` inside cells: place, ``cls`` of the cell, ``prev`` tag, ``direct`` (child of the cell
      itself), ``text`` with entities decoded
    * ``tags``: tables, rows, images and links: place, ``stop``, ``tag``, ``cls`` (tables), ``val`` (src of images,
      href of links), ``title``
    """
    toks = html.structure(pages, keep, partitions, fold=True)
    # most texts are read twice, as a text and with their cell
    toks = toks.withColumn("_decoded", html.unescape(F.when(F.col("cell").isNotNull(), F.nullif("text", F.lit("")))))
    tok, tag, pos = F.col("tok"), F.col("tag"), F.col("pos")
    direct = tag.startswith("/") | tag.isin("td", "th", "br", "img", "hr", "input")
    cell = F.struct("pos", "stop", *PLACE, F.nullif("cell_cls", F.lit("")).alias("cls"),
                    html.raw_attr(tok, "align").alias("align"), html.raw_attr(tok, "colspan").alias("colspan"),
                    F.col("_decoded").alias("first"))
    text = F.struct((pos + 1).alias("pos"), *PLACE, F.col("cell_cls").alias("cls"), tag.alias("prev"),
                    direct.alias("direct"), F.col("_decoded").alias("text"))
    # attributes only of the tags that are asked for them
    val = html.decoded(tok, F.when(tag == "img", html.raw_attr(tok, "src")).when(tag == "a", html.raw_attr(tok, "href")))
    title = F.when(tag.isin("img", "a"), html.attr(tok, "title"))
    box_cls = F.when(tag == "table", html.raw_attr(tok, "class"))
    node = F.struct("pos", "stop", *PLACE, "tag", F.col("cell_cls").alias("in_cls"),
                    box_cls.alias("cls"), val.alias("val"), title.alias("title"))

    # made before the grouping, which would work the expressions out by itself at a higher price
    found = toks.select(
        "page_id", *keep,
        F.when(tag.isin("td", "th"), cell).alias("cells"),
        F.when(F.col("_decoded").isNotNull(), text).alias("texts"),
        F.when(tag.isin("table", "tr", "img", "a"), node).alias("tags"),
    )
    return plan.group_in_order(found).groupBy("page_id", *keep).agg(
        *[F.sort_array(F.collect_list(c)).alias(c) for c in ("cells", "texts", "tags")])


def with_labels(docs: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Add ``named``: the few texts that contain one of the labels, found once for all lookups."""
    found = " OR ".join(f"contains(t.text, {sql_value(x)})" for x in dict.fromkeys(labels))
    return docs.withColumn("named", F.expr(f"filter(texts, t -> t.cell IS NOT NULL AND ({found or 'false'}))"))


class Doc:
    """Selectors as SQL text; nest them and wrap the outermost in ``F.expr``."""

    # picking

    @staticmethod
    def nth(arr: str, n: int) -> str:
        return f"get({arr}, {n})" if n >= 0 else f"try_element_at({arr}, {n})"

    @staticmethod
    def let(value: str, body: str, var: str) -> str:
        """``body`` with ``var`` standing for ``value``, which is computed once."""
        return f"get(transform(array({value}), {var} -> {body}), 0)"

    # cells

    @staticmethod
    def cells(cls: str | None = None, where: str = "true") -> str:
        """All cells of exactly this class, page-wide."""
        by_class = f"c.cls = {sql_value(cls)}" if cls else "true"
        return f"filter(cells, c -> {by_class} AND ({where}))"

    @staticmethod
    def class_texts(cls: str | None) -> str:
        """Direct texts of every cell that carries a class token (None: cells without class)."""
        test = f"array_contains(split(t.cls, ' '), {sql_value(cls)})" if cls else "t.cls = ''"
        return f"transform(filter(texts, t -> t.direct AND {test}), t -> t.text)"

    def own_texts(self, cell: str) -> str:
        """Texts that are direct children of a cell."""
        return self.let(cell, "transform(filter(texts, t -> t.cell = b.pos AND t.direct), t -> t.text)", "b")

    def own_text(self, cell: str) -> str:
        """The first of :meth:`own_texts`; most cells carry it, which spares the look through the texts."""
        later = self.nth("transform(filter(texts, t -> t.cell = b.pos AND t.direct), t -> t.text)", 0)
        return self.let(cell, f"CASE WHEN b.first IS NOT NULL THEN b.first WHEN b.pos IS NOT NULL THEN {later} END", "b")

    def all_texts(self, cell: str) -> str:
        """Every text below a cell, nested tables included."""
        inside = "t.pos > b.pos AND (b.stop IS NULL OR t.pos < b.stop)"
        return self.let(cell, f"transform(filter(texts, t -> {inside}), t -> t.text)", "b")

    def texts_with(self, box: str, test: str) -> str:
        """Texts below a cell, row or table that satisfy a test on ``t``."""
        inside = "t.pos > b.pos AND (b.stop IS NULL OR t.pos < b.stop)"
        return self.let(box, f"transform(filter(texts, t -> {inside} AND ({test})), t -> t.text)", "b")

    def texts_after(self, cell: str, tag: str) -> str:
        """Direct texts of a cell that follow a given tag."""
        return self.let(
            cell, f"transform(filter(texts, t -> t.cell = b.pos AND t.prev = {sql_value(tag)}), t -> t.text)", "b")

    def values_in(self, cell: str, tag: str = "img", starts: str = "") -> str:
        """src or href values of a tag below a cell, optionally with a known start."""
        inside = "g.pos > b.pos AND (b.stop IS NULL OR g.pos < b.stop)"
        kept = f"AND startswith(g.val, {sql_value(starts)})" if starts else ""
        return self.let(
            cell, f"transform(filter(tags, g -> g.tag = {sql_value(tag)} AND {inside} {kept}), g -> g.val)", "b")

    def icons(self, cell: str) -> str:
        """Icons in a cell: 0 when blank, at least 1 when it holds anything; NULL without a cell."""
        return self.let(
            cell,
            "CASE WHEN b.pos IS NULL THEN NULL ELSE size(filter(tags, g -> g.tag = 'img' AND g.cell = b.pos)) END", "b")

    # labels

    @staticmethod
    def labels(label: str, mode: str = "text", where: str = "true") -> str:
        """Texts that name a cell: its own text, a bold or heading child's text, or part of it.

        ``where`` is a further test on ``t``, such as a range of positions.
        """
        v = sql_value(label)
        test = {
            "text": f"t.text = {v} AND t.direct",
            "bold": f"t.text = {v} AND t.prev = 'b'",
            "heading": f"t.text = {v} AND t.prev = 'h2'",
            "contains": f"contains(t.text, {v}) AND t.direct",
            "starts": f"startswith(t.text, {v}) AND t.direct",
            "bold_contains": f"contains(t.text, {v}) AND t.prev = 'b'",
            "heading_contains": f"contains(t.text, {v}) AND t.prev = 'h2'",
        }[mode]
        return f"filter(named, t -> {test} AND ({where}))"

    def value_cell(self, label: str, cell: int = 1, mode: str = "text", offset: int = 1, cls: str | None = None,
                   where: str = "true") -> str:
        """Cell number ``cell`` of the row ``offset`` below the label's row.

        With ``cls`` the number counts only cells of exactly that class. The first label
        that has such a cell decides.
        """
        by_class = f" AND c.cls = {sql_value(cls)}" if cls else ""
        row = f"filter(cells, c -> c.tbl = t.tbl AND c.row_no = t.row_no + {offset}{by_class})"
        per_label = f"transform({self.labels(label, mode, where)}, t -> get({row}, {cell - 1}))"
        return f"get(filter({per_label}, c -> c IS NOT NULL), 0)"

    def row_below(self, label: str, mode: str = "text", offset: int = 1) -> str:
        """The whole row below a label's row, as a struct with pos and stop."""
        row = f"filter(tags, g -> g.tag = 'tr' AND g.tbl = t.tbl AND g.row_no = t.row_no + {offset})"
        found = f"filter(transform({self.labels(label, mode)}, t -> get({row}, 0)), r -> r IS NOT NULL)"
        return f"get({found}, 0)"

    def beside_cell(self, label: str, mode: str = "bold", step: int = 1, cls: str | None = None,
                    where: str = "true") -> str:
        """The ``step``-th cell right of a label cell in its row; ``cls`` counts one class only."""
        by_class = f" AND c.cls = {sql_value(cls)}" if cls else ""
        right = f"filter(cells, c -> c.tbl = t.tbl AND c.row_no = t.row_no AND c.col_no > t.col_no{by_class})"
        per_label = f"transform({self.labels(label, mode, where)}, t -> get({right}, {step - 1}))"
        return f"get(filter({per_label}, c -> c IS NOT NULL), 0)"

    def value(self, label: str, cell: int = 1, mode: str = "text", offset: int = 1, cls: str | None = None,
              n: int = 0, where: str = "true") -> str:
        """n-th direct text of the value cell."""
        found = self.value_cell(label, cell, mode, offset, cls, where)
        return self.own_text(found) if n == 0 else self.nth(self.own_texts(found), n)

    # nested tables

    def rows_in(self, cell: str) -> str:
        """Row tags of tables nested in a cell."""
        inside = "g.pos > b.pos AND (b.stop IS NULL OR g.pos < b.stop)"
        return self.let(cell, f"filter(tags, g -> g.tag = 'tr' AND {inside})", "b")

    # tables by caption

    def tables(self, label: str, mode: str = "contains") -> str:
        """Tables that hold a label, innermost, in page order: structs with pos and stop."""
        return f"filter(tags, g -> g.tag = 'table' AND exists({self.labels(label, mode)}, t -> t.tbl = g.pos))"

    @staticmethod
    def cell_in(table: str, where: str) -> str:
        """Cells of one table that satisfy a test on ``c``."""
        return f"get(transform(array({table}), b -> filter(cells, c -> c.tbl = b.pos AND ({where}))), 0)"


def in_list(col: str, values: Sequence[object]) -> str:
    return f"{col} IN ({sql_list(values)})"
