"""URL resolution, canonical form and host tests as Spark expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_ROOT = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"


def host(url: Column) -> Column:
    """Lower-case host without user part and port, NULL when there is none."""
    authority = F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    return F.lower(F.nullif(authority, F.lit("")))


def _fold_dots(path: Column) -> Column:
    parts = F.split(path, "/")
    last = F.element_at(parts, -1)
    folded = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda acc, s: F.when(s == ".", acc)
        .when(s == "..", F.when(F.size(acc) > 1, F.slice(acc, F.lit(1), F.size(acc) - 1)).otherwise(acc))
        .otherwise(F.concat(acc, F.array(s))),
    )
    tail = F.when(last.isin(".", ".."), F.lit("/")).otherwise(F.lit(""))
    return F.concat(F.array_join(folded, "/"), tail)


def resolve_url(base: Column, href: Column) -> Column:
    """Absolute URL of ``href`` seen on page ``base``."""
    root = F.regexp_extract(base, _ROOT, 1)
    scheme = F.regexp_extract(base, _SCHEME, 1)
    no_frag = F.regexp_extract(base, r"^([^#]*)", 1)
    no_query = F.regexp_extract(base, r"^([^?#]*)", 1)
    path = F.substr(no_query, F.length(root) + 1)
    folder = F.when(path.contains("/"), F.regexp_extract(path, r"^(.*/)", 1)).otherwise(F.lit("/"))

    rel_path = F.regexp_extract(href, r"^([^?#]*)", 1)
    rel_rest = F.substr(href, F.length(rel_path) + 1)
    full_path = F.when(href.startswith("/"), rel_path).otherwise(F.concat(folder, rel_path))
    dotted = full_path.rlike(r"/\.\.?(/|\z)")
    merged = F.concat(root, F.when(dotted, _fold_dots(full_path)).otherwise(full_path), rel_rest)
    return (
        F.when(href.rlike(_SCHEME), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href == "", base)
        .when(href.startswith("#"), F.concat(no_frag, href))
        .when(href.startswith("?"), F.concat(no_query, href))
        .otherwise(merged)
    )


def canonical_url(url: Column) -> Column:
    """Fragment dropped, scheme and host lower-cased, empty path to '/', query sorted."""
    root = F.regexp_extract(url, _ROOT, 1)
    no_frag = F.regexp_extract(url, r"^([^#]*)", 1)
    path = F.regexp_extract(F.substr(no_frag, F.length(root) + 1), r"^([^?]*)", 1)
    query = F.regexp_extract(no_frag, r"\?(.*)$", 1)
    ordered = F.array_join(F.array_sort(F.split(query, "&")), "&")
    return F.concat(
        F.lower(root),
        F.when(path == "", F.lit("/")).otherwise(path),
        F.when(query == "", F.lit("")).otherwise(F.concat(F.lit("?"), ordered)),
    )


def host_allowed(url: Column, allowed: Sequence[str]) -> Column:
    """True if the host is an allowed one or lies below it. An empty list allows every url."""
    if not allowed:
        return F.lit(True)
    names = "|".join(r"\Q" + d.lower() + r"\E" for d in allowed)
    return F.coalesce(host(url).rlike(rf"(?:\A|\.)(?:{names})\z"), F.lit(False))
