"""Evolution tables: record pages to a curated edge list, one plan for all generations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.functions import text as X
from folioweave.operators import curate, html, order, quality, rows
from folioweave.plans import edge_values as V
from folioweave.session import scratch_path

C = F.col
KEY_PREFIX = "View Pokedex for #"  # fixed value: start of a key link's title
RANKS = ["method_rank", "games_rank", "stage", "page_id", "row"]
WIDE = [*V.COLUMNS[6][:1], "evolves_from_form", "evolves_to", "evolves_to_form", *V.COLUMNS[6][2:]]


def extract_edges(pages: DataFrame, gen: int) -> DataFrame:
    """One row per data row of the method pages, conditions routed to their columns, with ``errors``.

    Keeps ``page_id`` and ``row``, the position of the row's tag, as arrival order. A page of an unknown method and a row
    without both keys come with their reason.
    """
    tagged = pages.withColumn("method", F.regexp_extract("url", r"/evolution/([a-z]+)", 1))
    toks = html.structure(tagged, keep=["method"])

    def in_class(name: str) -> Column:
        return F.array_contains(F.split("cell_cls", r"\s+"), name)

    def key(cell: int) -> Column:
        title = html.attr(C("tok"), "title")
        return html.first_of((C("tag") == "a") & (C("col_no") == cell), title)

    def form(cell: int) -> Column:
        return html.first_of((C("tag") == "small") & (C("col_no") == cell), text)

    text = F.nullif(html.unescape(C("text")), F.lit(""))
    own = C("tag").isin("td", "br") | C("tag").startswith("/")
    found = html.records(toks, {
        "_from": key(1),
        "evolves_from_form": form(1),
        "_to": key(3),
        "evolves_to_form": form(3),
        "level": html.first_of(own & in_class("cell-num"), text),
        "_text": html.joined_of(in_class("cell-med-text"), text),
        "_cells": F.count_if(C("tag") == "td"),
    }, keep=["method"])
    found = found.filter(C("_cells") > 0)  # a row of headings is no data

    def number(c: str) -> Column:
        return F.left(F.replace(C(c), F.lit(KEY_PREFIX), F.lit("")), F.lit(4))

    out = {
        "page_id": C("page_id"), "row": C("row"),
        "evolves_from": X.region_suffix(number("_from"), C("evolves_from_form")),
        "evolves_from_form": C("evolves_from_form"),
        "evolves_to": X.region_suffix(number("_to"), C("evolves_to_form")),
        "evolves_to_form": C("evolves_to_form"),
        "method": C("method"), "level": C("level"),
    }
    if gen >= 7:
        out["evolves_from_form"] = X.region_label(C("evolves_from_form"))
        out["evolves_to_form"] = X.region_label(C("evolves_to_form"))
    if gen == 1:
        out["item_used"] = X.replace_all(C("_text"), V.FIRST_GEN_CUTS)
    else:
        text = X.strip(C("_text"))
        out.update(curate.route(text, C("method"), {
            "item_used": (["stone"], X.replace_all(text, V.STONE_CUTS[gen])),
            "item_held": (["trade"], X.replace_all(text, V.TRADE_CUTS)),
            "other_condition": ([], X.replace_all(text, V.OTHER_CUTS[gen])),
        }, default="other_condition"))
    for c in WIDE:
        out.setdefault(c, F.lit(""))
    table = found.select(*[v.alias(k) for k, v in out.items()], C("_from").isNull().alias("_no_from"), C("_to").isNull().alias("_no_to"))
    checked = quality.validate(table, {
        "evolves_from: missing": C("_no_from"), "evolves_to: missing": C("_no_to"),
        "method: unknown": ~C("method").isin(*V.METHODS)})
    return checked.drop("_no_from", "_no_to")


def _rules(table: list[tuple], gen: int) -> list[curate.Rule]:
    return [curate.rule(match, values) for match, values in V.of_gen(table, gen)]


def add_rows(df: DataFrame, gen: int) -> DataFrame:
    """First edits, added rows, copied rows, second edits. Adds ``stage`` to the arrival order."""
    df = curate.apply_rules(df, _rules(V.FIRST_RULES, gen)).withColumn("stage", F.lit(0))
    blank = {c: "" for c in WIDE}
    added = [{**blank, **r, "stage": 1, "page_id": 0, "row": i} for i, r in enumerate(V.ADDED.get(gen, []))]
    df = rows.append_rows(df, added)
    if gen in V.DROPPED_FORMS:
        df = curate.drop_where(df, C("evolves_to_form").isin(*V.DROPPED_FORMS[gen]))
    if gen >= 6:
        copies = [{"evolves_from": a, "evolves_to": b, "stage": F.lit(2)} for a, b in V.COPIES]
        df = rows.clone_rows(df, C("evolves_from") == V.COPIED_FROM, copies)
    return curate.apply_rules(df, _rules(V.SECOND_RULES, gen))


def add_ranks(df: DataFrame, gen: int) -> DataFrame:
    """Ranks and a copy of every duplicate-key column as it is before the texts move.

    In generation 9 added rows count as their own variant.
    """
    method_rank = curate.rank_of(C("method"), V.METHODS)
    if gen in V.FIRST_RANK:
        method_rank = F.when(C("evolves_to").isin(V.FIRST_RANK[gen]), F.lit(0)).otherwise(method_rank)
    games_rank = curate.rank_of(C("versions"), V.GAMES[gen]) if gen in V.GAMES else F.lit(0)
    extra = {f"key_{c}": C(c) for c in V.EXTRA_KEYS.get(gen, [])}
    if gen == 9:
        extra["key_variant"] = (C("stage") == 1).cast("int")
    return df.withColumns({"method_rank": method_rank, "games_rank": games_rank, **extra})


def dedup(df: DataFrame) -> DataFrame:
    """First row per key by rank and arrival."""
    keys = ["evolves_from", "evolves_to", *[c for c in df.columns if c.startswith("key_")]]
    return curate.dedup_first(df, keys, RANKS)


def move_texts(df: DataFrame, gen: int) -> DataFrame:
    """Rules and moves that sort conditions into their columns."""
    if gen == 1:
        return curate.apply_rules(df, _rules(V.LAST_RULES, gen))
    df = curate.apply_rules(df, _rules(V.BEFORE_MOVES, gen))
    moves = [curate.Move(*m) for m in V.of_gen(V.MOVES, gen)]
    df = curate.move_conditions(df, moves, ["item_used", "other_condition"])
    df = curate.apply_rules(df, _rules(V.AFTER_MOVES, gen))
    if gen >= 4:
        item, other = C("item_used"), C("other_condition")
        df = curate.apply_rules(df, [
            curate.rule({"item_used": ("ends", ", ")}, {"item_used": X.rstrip_set(item, ", ")}, ["item_used"]),
            curate.rule({"item_used": ("ends", ",")}, {"item_used": X.rstrip_set(item, ",")}, ["item_used"]),
            curate.rule({"other_condition": ("starts", ", ")}, {"other_condition": X.py_slice(other, 2)}, ["other_condition"]),
            curate.rule({"other_condition": ("ends", ", ")}, {"other_condition": X.rstrip_set(other, ", ")}, ["other_condition"]),
        ])
        level = {"method": "level"}
        df = curate.move_by_affix(df, "other_condition", "move_learned", "after ", " learned", also=level,
                                  test=C("other_condition").endswith("learned"))
        df = curate.move_by_affix(df, "other_condition", "item_held", "hold ", also=level)
    df = curate.move_by_affix(df, "other_condition", "stat", "Attack", keep_affix=True)
    return curate.apply_rules(df, _rules(V.LAST_RULES, gen))


def keep_generation(df: DataFrame, gen: int) -> DataFrame:
    """Number and blank clean-up, then the rows that belong to the generation."""
    df = curate.blank_to_null(df.withColumn("level", C("level").try_cast("double")))
    if gen >= 3:
        df = df.withColumn("other_condition", X.upper_first(C("other_condition")))
    if V.KEY_LIMIT[gen]:
        for key in ("evolves_from", "evolves_to"):
            df = df.filter(curate.key_between(C(key), "0001", V.KEY_LIMIT[gen])
                           & curate.not_matching(C(key), V.NOT_IN_GEN[gen]))
    if gen in V.DROPPED_ROWS:
        cond = F.lit(True)
        for col, value in V.DROPPED_ROWS[gen].items():
            cond = cond & (C(col) == value)
        df = curate.drop_where(df, cond)
    if gen in V.EXCLUDED:
        df = curate.exclude(df, "evolves_to", V.EXCLUDED[gen])
    return df


def ranked_edges(edges: DataFrame, gen: int) -> DataFrame:
    """Edges after the first edits and added rows, with ranks; ``errors`` names versions the generation does not know."""
    df = add_ranks(add_rows(edges, gen), gen)
    return quality.validate(df, {"versions: unknown": C("games_rank").isNull(), "method: unknown": C("method_rank").isNull()})


def curate_edges(ranked: DataFrame, gen: int) -> DataFrame:
    """Ranked edges to the generation's table, with ranks kept for sorting.

    One shuffle, by the duplicate key. The text edits never touch the key copies or ranks, so
    they give the same rows before the dedup as after it. Done before, they run in the map
    tasks, and the window keeps the last filters from being pushed down into the edit chain,
    where each would repeat its expressions.
    """
    df = keep_generation(dedup(move_texts(ranked, gen)), gen)
    return df.select(*V.COLUMNS[gen], *RANKS)


def evolutions(pages: DataFrame, gen: int, prune: bool = True, ordered: bool = True) -> tuple[DataFrame, DataFrame]:
    """(the evolution table of one generation, quarantined rows with their reasons).

    The pages are read once: what they hold is written and both results read it.
    """
    good, bad = quality.write_split(extract_edges(pages, gen), f"edges-g{gen}")
    good, late = quality.split_quarantine(ranked_edges(good, gen))
    df = curate_edges(good, gen)
    reasons = ["page_id", "row", "errors"]
    bad = bad.select(*reasons).unionByName(late.select(*reasons))
    if prune and gen >= 2:
        # the columns to keep are known only after a run: the run that writes the rows tells
        df = curate.write_pruned(df, scratch_path(pages.sparkSession, f"edges-g{gen}-table"), keep=RANKS)
    table = order.sort_by_rank(df, ["evolves_from", "evolves_to"], RANKS, []) if ordered else df.drop(*RANKS)
    return table, bad
