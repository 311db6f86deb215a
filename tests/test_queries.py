"""Every registered query against its SQL on the smallest tables, and the shape of its plan."""

import datetime
import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from folioweave.functions import numbers as N
from folioweave.operators import fields, html, plan
from folioweave.plans import dex, edges, learnsets, moves
from folioweave.queries import catalog
from folioweave.queries import dex as qdex
from folioweave.queries import learnsets as qlearnsets
from folioweave.queries import moves as qmoves
from folioweave.sources import pages as S

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()
QUERIES, SQL = catalog.QUERIES, catalog.SQL


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    con.sql("set timezone='UTC'")
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{sf}/{t}.parquet'")
    return con


def plain(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def lines(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf, duck, name):
    df = QUERIES[name](spark, sf)
    shape = df._jdf.queryExecution().executedPlan().toString()
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert bad not in shape
    want = duck.sql(SQL[name])
    columns = want.columns
    assert sorted(df.columns) == sorted(columns)
    assert lines(df.columns, df.collect()) == lines(columns, want.fetchall())


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("job", [
    lambda p: moves.extract_moves(p, 8), lambda p: dex.extract(p, 9), lambda p: learnsets.sections(p, 2),
    lambda p: edges.extract_edges(p, 8)])
def test_page_plans_use_one_exchange(spark, sf, job):
    shape = job(S.read_pages(spark, f"{sf}/pages.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert shape.count("Exchange hashpartitioning") == 1


def test_page_tasks_follow_the_size_of_the_pages(spark, monkeypatch):
    monkeypatch.setattr(plan, "PAGE_BYTES", 1000)
    ids = spark.range(100).select(F.col("id").alias("page_id"))
    made = ids.select("page_id", F.repeat(F.lit("x"), F.lit(2000)).alias("html"))
    assert plan.page_partitions(made) == 200
    # a join is not taken for the product of its sides
    assert plan.page_partitions(made.join(ids, "page_id").withColumn("html", F.lit("x"))) == plan.shuffle_partitions(made)


@pytest.mark.parametrize("name", ["f10_large", "h8_entities"])
def test_rows_that_take_long_are_dealt_over_all_tasks(spark, sf, name):
    shape = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert shape.count("Exchange RoundRobinPartitioning") == 1


@pytest.mark.parametrize("make", [lambda s, sf: qmoves.move_pages(s, sf, 6), lambda s, sf: qdex.dex_pages(s, sf, 9),
                                  lambda s, sf: qdex.small_pages(s, sf, qdex.page_g1()), lambda s, sf: qlearnsets.pages(s, sf, 2)])
def test_pages_are_made_in_all_tasks(spark, sf, make):
    assert make(spark, sf).rdd.getNumPartitions() == plan.shuffle_partitions(spark.range(1))


def test_a_reference_is_read_a_few_times_only(spark):
    shape = spark.range(1).select(html.unescape(F.col("id").cast("string")).alias("x"))._jdf.queryExecution().analyzed().toString()
    assert shape.lower().count("regexp_extract(") <= 3


def test_tags_are_grouped_as_they_stand(spark, sf):
    docs = fields.documents(S.read_pages(spark, f"{sf}/pages.parquet"))
    docs.count()
    shape = docs._jdf.queryExecution().executedPlan().toString()
    assert shape.count("SortAggregate") == 1 and "ObjectHashAggregate" not in shape


def test_attributes_are_read_once(spark):
    shape = spark.range(1).select(html.written_attr(F.col("id").cast("string"), "class").alias("x"))._jdf.queryExecution().analyzed().toString()
    assert shape.count("regexp_extract(") == 1


def test_gcd_of_pairs_that_take_many_steps(spark):
    a, b = 1, 1
    while a + b < 1 << 63:
        a, b = a + b, a
    rows = [(a, b), (b, a), (2 * 3 * 5 ** 8 * 7, 5 ** 9 * 11), (0, 0), (0, 6), (-12, 18)]
    got = spark.createDataFrame(rows, "a long, b long").select("a", "b", N.gcd(F.col("a"), F.col("b"))).collect()
    assert [r[2] for r in got] == [math.gcd(r[0], r[1]) for r in got]


def test_label_lookup_moves_no_tokens(spark, sf):
    shape = QUERIES["h6_label"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in shape and shape.count("FileScan") == 1


@pytest.mark.parametrize("name, columns", [
    ("p4_key_between", "p_partkey,p_size"), ("a1_dedup", "o_orderkey,o_custkey,o_orderpriority"), ("s4_hosts", "page_id,url"),
    ("h1_tokens", "page_id,html"),
])
def test_scans_read_only_what_they_need(spark, sf, name, columns):
    shape = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    read = shape.split("ReadSchema: struct<")[1].split(">")[0]
    assert ",".join(f.split(":")[0] for f in read.split(",")) == columns
