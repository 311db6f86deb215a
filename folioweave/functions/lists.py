"""Split, pad, zip, repeat and fold arrays and maps."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names of the six slots, in order; unknown names fall to the last one.
STATS = ["HP", "Attack", "Defense", "Sp. Attack", "Sp. Defense", "Speed"]


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row.

    A lambda re-evaluates whatever outer expression it mentions for every element, so
    anything costly that a lambda needs is bound here first.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def at(arr: Column, i: int) -> Column:
    """0-based element, negative from the end, NULL outside."""
    return F.try_element_at(arr, F.lit(i + 1 if i >= 0 else i))


def split_literal(c: Column, sep: str) -> Column:
    return F.split(c, r"\Q" + sep + r"\E")


def split2(c: Column, sep: str, default: str = "") -> tuple[Column, Column]:
    """First two parts; a missing first part becomes ``default``, a missing second ''."""
    return pair(split_literal(c, sep), default)


def pair(arr: Column, default: str = "") -> tuple[Column, Column]:
    """First two items of an array, padded."""
    first, second = at(arr, 0), at(arr, 1)
    empty = first.isNull() | (first == "")
    return (
        F.when(empty, F.lit(default)).otherwise(first),
        F.coalesce(second, F.lit("")),
    )


def split_nested(c: Column, outer: str, inner: str) -> Column:
    """Groups by one separator, items within a group by another."""
    return F.transform(split_literal(c, outer), lambda g: split_literal(g, inner))


def repeat_items(arr: Column, counts: Column) -> Column:
    """Item i of ``arr`` repeated ``counts[i]`` times; extra items of either side drop."""
    n = F.least(F.size(arr), F.size(counts))
    zipped = F.zip_with(F.slice(arr, 1, n), F.slice(counts, 1, n), F.array_repeat)
    return F.flatten(zipped)


def zip_lists(**cols: Column) -> tuple[Column, Column]:
    """(zipped array of structs, 'lengths agree' flag)."""
    named = list(cols.items())
    sizes = [F.size(c) for _, c in named]
    ok = F.lit(True)
    for s in sizes[1:]:
        ok = ok & (s == sizes[0])
    idx = F.sequence(F.lit(0), F.greatest(*sizes) - 1) if len(sizes) > 1 else F.sequence(F.lit(0), sizes[0] - 1)
    longest = F.greatest(*sizes) if len(sizes) > 1 else sizes[0]
    body = F.transform(
        idx, lambda i: F.struct(*[F.get(c, i).alias(name) for name, c in named])
    )
    return F.when(longest > 0, body).otherwise(F.slice(body, 1, 0)), ok


def lookup(m: Column, key: Column) -> Column:
    """Value of ``key`` in a map, NULL when it is missing."""
    return F.try_element_at(m, key)


def stat_vector(items: Column, number_first: bool = True, slots: Sequence[str] = STATS) -> Column:
    """'2 HP' (or 'HP 2') items to one INT per slot, default 0.

    The last item naming a slot wins; a name outside the first five slots counts as the last.
    """
    pattern = r"^(\d)\s*(.*)$" if number_first else r"^(.*?)\s*(\d+)\s*$"
    num_grp, name_grp = (1, 2) if number_first else (2, 1)

    def entry(x: Column) -> Column:
        name = F.regexp_extract(x, pattern, name_grp)
        slot = F.lit(len(slots))
        for i in range(len(slots) - 1, 0, -1):
            slot = F.when(name.startswith(slots[i - 1]), F.lit(i)).otherwise(slot)
        number = F.regexp_extract(x, pattern, num_grp).try_cast("int")
        return F.struct(slot.alias("slot"), number.alias("n"))

    parsed = F.filter(F.transform(items, entry), lambda e: e["n"].isNotNull())

    def pick(found: Column, k: int) -> Column:
        hits = F.filter(found, lambda e: e["slot"] == k)
        return F.coalesce(at(hits, -1)["n"], F.lit(0))

    return let(parsed, lambda found: F.array(*[pick(found, k + 1) for k in range(len(slots))]))


def segments_to_map(c: Column, default_key: str = "") -> Column:
    """``A<br>B`` or ``<b>x</b><br>A<br><b>y</b><br>B`` to a map heading -> items.

    Text before the first heading is filed under ``default_key``; of repeated headings the
    last one wins.
    """
    parts = F.split(c, r"(?i)<b>")

    def entry(x: Column, i: Column) -> Column:
        headed = (i > 0) & x.contains("</b>")
        key = F.when(headed, F.substring_index(x, "</b>", 1)).otherwise(F.lit(default_key))
        rest = F.when(headed, F.regexp_replace(x, r"(?s)\A.*?</b>", "")).otherwise(x)
        items = F.filter(F.split(rest, r"(?i)<br\s*/?>"), lambda s: F.trim(s) != "")
        return F.struct(key.alias("key"), items.alias("value"))

    entries = F.filter(F.transform(parts, entry), lambda e: F.size(e["value"]) > 0)

    def build(found: Column) -> Column:
        last = F.filter(
            found,
            lambda e, i: ~F.exists(F.slice(found, i + 2, F.size(found)), lambda later: later["key"] == e["key"]),
        )
        return F.map_from_entries(last)

    return let(entries, build)
