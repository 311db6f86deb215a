"""Sinks and streams: write, read back, compare with the batch answer."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from folioweave.operators import curate, order
from folioweave.queries import crawl, curation
from folioweave.queries.registry import SQL, query, table
from folioweave.session import scratch_path
from folioweave.sinks import tables as K
from folioweave.sources import pages as S
from folioweave.streaming import pages as T
from folioweave.streaming.seen import SeenUrls, stream_unseen
from folioweave.streaming.winners import Winners

C = F.col


@query("k1_table", "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders")
def k1(spark, sf):
    name = f"fw_{uuid.uuid4().hex}"
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    K.write_table(df, name, path=scratch_path(spark, "k1"))
    return spark.table(name)


@query("k2_csv", "SELECT c_custkey, c_name, c_mktsegment FROM customer")
def k2(spark, sf):
    path = scratch_path(spark, "k2")
    K.write_csv(table(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment"), path)
    return spark.read.option("header", True).schema("c_custkey BIGINT, c_name STRING, c_mktsegment STRING").csv(path)


@query("k3_single_file", """
    SELECT p_partkey, p_name, row_number() OVER (ORDER BY p_name NULLS LAST, p_partkey) - 1 AS position FROM part""")
def k3(spark, sf):
    path = scratch_path(spark, "k3")
    K.export_sorted(table(spark, sf, "part").select("p_partkey", "p_name"), path, ["p_name"], ["p_partkey"])
    # the files by name, the lines as they stand in a file
    lines = spark.read.option("header", True).schema("p_partkey BIGINT, p_name STRING").csv(path).select(
        "*", C("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line"))
    return order.with_position(lines.orderBy("file", "line")).drop("file", "line")


@query("k4_by_generation", """
    SELECT (p_partkey % 9 + 1)::INTEGER AS gen, count(*) AS n, sum(p_partkey)::BIGINT AS keys FROM part GROUP BY 1""")
def k4(spark, sf):
    path = scratch_path(spark, "k4")
    K.write_by_gen(table(spark, sf, "part").withColumn("gen", (C("p_partkey") % 9 + 1).cast("int")), path)
    return spark.read.parquet(path).groupBy("gen").agg(F.count("*").alias("n"), F.sum("p_partkey").alias("keys"))


@query("t1_stream_links", f"WITH {crawl.LINKS} SELECT page_id, pos::INTEGER AS pos, href FROM links")
def t1(spark, sf):
    sink, ckpt = scratch_path(spark, "t1"), scratch_path(spark, "t1-ckpt")

    def links(batch):
        return S.discover_links(batch, "nav", "a", "href").select("page_id", "pos", "href")

    T.stream_pages(spark, T.table_pattern(f"{sf}/pages.parquet"), sink, ckpt, links).awaitTermination()
    return T.read_sink(spark, sink)


@query("t2_stream_urls", f"SELECT DISTINCT {crawl.CANON.format(u='url')} AS canonical_url FROM pages")
def t2(spark, sf):
    sink, ckpt = scratch_path(spark, "t2"), scratch_path(spark, "t2-ckpt")
    fresh = T.stream_dedup_urls(T.read_page_stream(spark, T.table_pattern(f"{sf}/pages.parquet")))
    T.stream_to_folder(fresh, sink, ckpt, lambda b: b.select("canonical_url")).awaitTermination()
    return T.read_sink(spark, sink)


@query("t2_seen_store", f"""
    SELECT DISTINCT {crawl.CANON.format(u='url')} AS canonical_url, 1::BIGINT AS n_rows FROM pages""")
def t2_store(spark, sf):
    """All pages arrive twice, in four files; a url must come out of one batch only."""
    arrivals, ckpt = scratch_path(spark, "seen-in"), scratch_path(spark, "seen-ckpt")
    pages = S.read_pages(spark, f"{sf}/pages.parquet").withColumn("html", F.lit(""))
    for files in (3, 1):
        pages.repartition(files).write.mode("append").parquet(arrivals)
    store = SeenUrls(spark, scratch_path(spark, "seen"), buckets=16)
    stream_unseen(T.read_page_stream(spark, arrivals, max_files=2), store, ckpt, order=["page_id"]).awaitTermination()
    return store.admitted().groupBy("canonical_url").agg(F.count("*").alias("n_rows"))


@query("s7_incremental", f"""
    WITH {crawl.LINKS}, {crawl.TARGETS}
    SELECT DISTINCT target AS canonical_url FROM targets
    WHERE target NOT IN (SELECT {crawl.CANON.format(u='url')} FROM pages)""")
def s7_store(spark, sf):
    """The frontier against a store of known pages, which is read in place."""
    store = SeenUrls(spark, scratch_path(spark, "known"), buckets=16)
    store.admit(S.read_pages(spark, f"{sf}/pages.parquet"), 0)
    return store.unseen(S.resolve_links(crawl.links(spark, sf)), "target")


@query("a1_arrivals", SQL["a1_dedup"])
def a1_arrivals(spark, sf):
    """The dedup of all orders, built in three arrivals of which the second comes twice."""
    orders = table(spark, sf, "orders").select(
        "o_custkey", "o_orderkey", "o_orderpriority", curate.rank_of(C("o_orderpriority"), curation.PRIORITIES).alias("rank"))
    store = Winners(spark, scratch_path(spark, "winners"), orders.schema.toDDL(), ["o_custkey"], ["rank", "o_orderkey"], buckets=16)
    for batch in (0, 1, 1, 2):
        store.merge(orders.filter(C("o_orderkey") % 3 == batch), batch)
    return store.read().drop("rank")
