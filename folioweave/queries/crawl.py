"""Sources and link discovery over the pages table."""

from __future__ import annotations

from pyspark.sql import functions as F

from folioweave.functions import urls as U
from folioweave.queries.registry import query, table
from folioweave.sources import pages as S

C = F.col
ALLOWED = ["example.com", "example.org"]
LANGS = ["en", "de", "fr", "es"]

HOST = r"lower(regexp_extract({u}, '^[A-Za-z]+://([^/?#:]*)', 1))"
ROOT = r"regexp_extract({u}, '^([A-Za-z]+://[^/?#]*)', 1)"
CANON = r"""regexp_extract({u}, '^([^?#]*)', 1) ||
    CASE WHEN regexp_extract({u}, '^[^?#]*\?([^#]*)', 1) = '' THEN '' ELSE '?' ||
    array_to_string(list_sort(string_split(regexp_extract({u}, '^[^?#]*\?([^#]*)', 1), '&')), '&') END"""
LINKS = r"""links AS (SELECT page_id, url, u.href, u.pos FROM pages,
    unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) WITH ORDINALITY AS u(href, pos))"""


def links(spark, sf):
    return S.discover_links(S.read_pages(spark, f"{sf}/pages.parquet"), "nav", "a", "href")


@query("s1_pages", f"""
    SELECT {HOST.format(u='url')} AS host, count(*) AS n_pages, sum(length(html))::BIGINT AS n_chars
    FROM pages GROUP BY 1""")
def s1(spark, sf):
    pages = S.read_pages(spark, f"{sf}/pages.parquet")
    return pages.groupBy(U.host(C("url")).alias("host")).agg(
        F.count("*").alias("n_pages"), F.sum(F.length("html")).alias("n_chars"))


@query("s2_links", f"WITH {LINKS} SELECT page_id, pos::INTEGER AS pos, href FROM links")
def s2(spark, sf):
    return links(spark, sf).select("page_id", "pos", "href")


@query("s2_first_n", f"WITH {LINKS} SELECT page_id, pos::INTEGER AS container_no, href FROM links WHERE pos <= 3 AND href <> '/The'")
def s2_first(spark, sf):
    pages = S.read_pages(spark, f"{sf}/pages.parquet")
    return S.discover_links(pages, "li", "a", "href", first_n=3, drop=["#", "/The"]).select(
        "page_id", "container_no", "href")


@query("s2_nested", """
    SELECT page_id, u.pos::INTEGER AS pos, u.href FROM pages,
      unnest(['/1/' || page_id, '/2/' || page_id, '/3/' || page_id]) WITH ORDINALITY AS u(href, pos)""")
def s2_nested(spark, sf):
    def to(n):
        return F.concat(F.lit(f"<a href=/{n}/"), C("page_id").cast("string"), F.lit(">x</a>"))
    boxes = F.concat(F.lit("<section><section>"), to(1), F.lit("<section></section></section>"), to(2), F.lit("</section>"),
                     F.lit("<a href=/out>x</a><section>"), to(3))
    pages = S.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", boxes.alias("html"))
    return S.discover_links(pages, "section", "a", "href").select("page_id", "pos", "href")


@query("s3_entities", f"""
    SELECT page_id, {ROOT.format(u='url')} || '/p?a=' || page_id || '&b=2' AS target FROM pages""")
def s3_entities(spark, sf):
    link = F.concat(F.lit("<nav><a title='1 > 0' href='/p?a="), C("page_id").cast("string"), F.lit("&amp;b=2'>x</a></nav>"))
    pages = S.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url", link.alias("html"))
    return S.resolve_links(S.discover_links(pages, "nav", "a", "href")).select("page_id", "target")


@query("s3_resolve", f"""
    WITH {LINKS}, v AS (SELECT page_id, pos, url, href, substr(href, 2) AS bare,
        {ROOT.format(u='url')} AS root, regexp_extract(url, '^([^?#]*)', 1) AS page,
        regexp_extract(url, '^([^#]*)', 1) AS whole FROM links)
    SELECT page_id, pos::INTEGER AS pos, root || href AS plain,
      CASE pos % 7 WHEN 0 THEN 'http://other.example.org' || href
        WHEN 1 THEN regexp_extract(url, '^([a-z]+):', 1) || '://cdn.example.net' || href
        WHEN 2 THEN page || '?q=' || bare WHEN 3 THEN whole || '#' || bare
        WHEN 4 THEN regexp_extract(page, '^(.*/)', 1) || bare
        WHEN 5 THEN regexp_replace(page, '^([a-z]+://[^/]*)(/.*)?/[^/]*/[^/]*$', '\\1\\2') || '/up' || href
        ELSE url END AS varied
    FROM v""")
def s3(spark, sf):
    bare = F.substr(C("href"), F.lit(2))
    k = C("pos") % 7
    varied = (F.when(k == 0, F.concat(F.lit("http://other.example.org"), C("href")))
              .when(k == 1, F.concat(F.lit("//cdn.example.net"), C("href")))
              .when(k == 2, F.concat(F.lit("?q="), bare)).when(k == 3, F.concat(F.lit("#"), bare))
              .when(k == 4, bare).when(k == 5, F.concat(F.lit("../up"), C("href"))).otherwise(F.lit("")))
    return links(spark, sf).select(
        "page_id", "pos", U.resolve_url(C("url"), C("href")).alias("plain"), U.resolve_url(C("url"), varied).alias("varied"))


@query("s4_hosts", f"""
    SELECT page_id, {HOST.format(u='url')} AS host FROM pages
    WHERE regexp_matches({HOST.format(u='url')}, '(^|\\.)example\\.(com|org)$')""")
def s4(spark, sf):
    pages = S.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url")
    return S.filter_hosts(pages, "url", ALLOWED).select("page_id", U.host(C("url")).alias("host"))


@query("s4_open", "SELECT page_id, url FROM pages")
def s4_open(spark, sf):
    return S.filter_hosts(S.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url"), "url", [])


@query("s5_urls", f"SELECT {CANON.format(u='url')} AS canonical_url, min(page_id) AS page_id FROM pages GROUP BY 1")
def s5(spark, sf):
    pages = S.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url")
    return S.dedup_urls(pages, "url", ["page_id"]).select("canonical_url", "page_id")


@query("s6_tagged", """
    SELECT page_id, regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS lang,
           CASE regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) WHEN 'en' THEN 0 WHEN 'de' THEN 1 ELSE 2 END::INTEGER AS lang_rank
    FROM pages WHERE regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) IN ('en', 'de', 'fr')""")
def s6(spark, sf):
    pages = S.read_pages(spark, f"{sf}/pages.parquet").select("page_id", "url")
    part = F.regexp_extract("url", r"^[a-z]+://[^/]+/([a-z]+)/", 1)
    return S.tag_pages(pages, ["en", "de", "fr"], "lang", part, rank="lang_rank").drop("url")


TARGETS = f"targets AS (SELECT page_id, {ROOT.format(u='url')} || href AS target FROM links)"


@query("s7_frontier", f"""
    WITH {LINKS}, {TARGETS}
    SELECT DISTINCT target AS canonical_url FROM targets
    WHERE target NOT IN (SELECT {CANON.format(u='url')} FROM pages)""")
def s7(spark, sf):
    pages = S.read_pages(spark, f"{sf}/pages.parquet")
    return S.frontier(S.resolve_links(links(spark, sf)), pages)


@query("crawl_frontier", f"""
    WITH {LINKS}, {TARGETS}, t AS (SELECT DISTINCT target FROM targets
      WHERE regexp_matches({HOST.format(u='target')}, '(^|\\.)example\\.(com|org)$')
        AND target NOT IN (SELECT {CANON.format(u='url')} FROM pages))
    SELECT {HOST.format(u='target')} AS host, count(*) AS n_links FROM t GROUP BY 1""")
def crawl_frontier(spark, sf):
    pages = S.read_pages(spark, f"{sf}/pages.parquet")
    wanted = S.filter_hosts(S.resolve_links(links(spark, sf)), "target", ALLOWED)
    return (S.frontier(wanted, pages).groupBy(U.host(C("canonical_url")).alias("host"))
            .agg(F.count("*").alias("n_links")))
