"""Stored pages, and what a crawl would ask for next."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioweave.functions import urls as U
from folioweave.functions.literals import sql_value
from folioweave.operators import curate, html, plan

PAGE_SCHEMA = "page_id BIGINT, url STRING, html STRING"


def read_pages(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Pages as ``page_id, url, html``.

    ``parquet``/``orc``/``json`` hold these columns; ``text`` reads one page per file, the
    file's path being the url and a hash of it the id; ``csv`` expects quoted, multi-line html.
    """
    if fmt == "text":
        raw = spark.read.text(path, wholetext=True)
        url = F.col("_metadata.file_path")
        return raw.select(F.xxhash64(url).alias("page_id"), url.alias("url"), F.col("value").alias("html"))
    reader = spark.read.schema(PAGE_SCHEMA)
    if fmt == "csv":
        reader = reader.option("header", True).option("multiLine", True).option("escape", '"')
    return reader.format(fmt).load(path)


def discover_links(pages: DataFrame, container: str, item: str, attr: str,
                   first_n: int | None = None, drop: Sequence[str] = ("#",),
                   container_attr: tuple[str, str] | None = None) -> DataFrame:
    """Attribute of every ``item`` inside a ``container``, in page order.

    A container ends where its own closing tag stands, or at the end of the page; containers inside one belong to it, and
    only outermost ones are numbered. Result ``page_id, url, container_no, pos, href`` with 1-based numbers; ``pos`` counts
    within the page before anything is dropped. Runs in the scan's stage, without a shuffle; the time for a page grows with
    its tags as a sort does, however many links or containers it has.
    """
    # a generator for every step: what Spark infers or pushes down for the next one then reads a column
    cols = {"_toks": html.some_tags(F.col("html"), container, f"/{container}", item)}
    step = plan.pin(pages, cols, keep=["page_id", "url"])
    own = "0"
    if container_attr:
        name, value = container_attr
        test = F.transform("_toks", lambda t: F.coalesce(html.attr(t, name) == value, F.lit(False)))
        step = plan.pin(step, {"_own": test}, keep=["page_id", "url", "_toks"])
        own = "CASE WHEN get(_own, CAST(e.at AS INT)) THEN 2 ELSE 0 END"
    box, link = sql_value(container), sql_value(item)
    named = f"transform(_toks, (t, i) -> struct(lower(regexp_extract(t, {sql_value(html.TAG)}, 1)) AS tag, bigint(i) AS at))"
    boxes = (f"transform(filter(d, e -> e.tag IN ({box}, concat('/', {box}))), "
             f"e -> 4 * e.at + CASE WHEN e.tag = {box} THEN 1 + {own} ELSE 0 END)")
    held = html.inside(f"transform(filter(d, e -> e.tag = {link}), e -> e.at)", html.outermost(boxes, container_attr is None))
    few = f"filter({held}, e -> e.no <= {int(first_n)})" if first_n is not None else held
    found = f"transform({few}, e -> struct(e.no AS container_no, get(_toks, CAST(e.at AS INT)) AS tok))"
    step = plan.pin(step, {"_found": F.expr(f"get(transform(array({named}), d -> {found}), 0)")}, keep=["page_id", "url"])
    long = step.select("page_id", "url", F.posexplode("_found").alias("_p", "_l"))
    out = plan.pin(long, {"container_no": F.col("_l.container_no"), "pos": F.col("_p") + 1,
                          "href": html.attr(F.col("_l.tok"), attr)}, keep=["page_id", "url"]).filter(F.col("href").isNotNull())
    return curate.drop_where(out, F.col("href").isin(*drop)) if drop else out


def resolve_links(links: DataFrame, base: str = "url", href: str = "href", out: str = "target") -> DataFrame:
    """Add the absolute url of every link, worked out once even if it is filtered on later."""
    return plan.pin(links, {out: U.resolve_url(F.col(base), F.col(href))}, keep=links.columns)


def filter_hosts(df: DataFrame, url_col: str, allowed: Sequence[str]) -> DataFrame:
    """Keep urls on an allowed host or below it."""
    return df.filter(U.host_allowed(F.col(url_col), allowed))


def dedup_urls(df: DataFrame, url_col: str, order: Sequence[str]) -> DataFrame:
    """One row per canonical url, the first in the given order; adds ``canonical_url``."""
    return curate.dedup_first(
        df.withColumn("canonical_url", U.canonical_url(F.col(url_col))), ["canonical_url"], order
    )


def tag_pages(pages: DataFrame, values: Sequence[str], tag: str, part: Column,
              rank: str | None = None) -> DataFrame:
    """Keep the pages whose url part is a member of an ordered list; the member becomes a column."""
    member = F.when(part.isin(*values), part)
    out = pages.withColumn(tag, member).filter(F.col(tag).isNotNull())
    return out.withColumn(rank, curate.rank_of(F.col(tag), values)) if rank else out


def frontier(links: DataFrame, pages: DataFrame, target: str = "target", url: str = "url") -> DataFrame:
    """Distinct canonical targets for which no page is stored yet.

    Targets are made distinct first (pre-aggregated in every task), so a link that is on
    every page reaches the anti join once.
    """
    want = links.select(U.canonical_url(F.col(target)).alias("canonical_url")).distinct()
    have = pages.select(U.canonical_url(F.col(url)).alias("canonical_url")).distinct()
    return want.join(have, "canonical_url", "left_anti")
