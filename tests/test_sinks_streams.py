"""Sinks fail when the target exists; a stream gives the batch answer and survives a restart."""

import shutil

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from folioweave.queries import catalog
from folioweave.session import cut_lineage
from folioweave.sinks import tables as K
from folioweave.sources import pages as S
from folioweave.streaming import pages as T

C = F.col


def test_table_and_files_fail_if_they_exist(spark, tmp_path):
    df = spark.range(5).withColumn("gen", C("id") % 2)
    for write in (lambda: K.write_csv(df, str(tmp_path / "c")), lambda: K.write_by_gen(df, str(tmp_path / "g")),
                  lambda: K.export_sorted(df, str(tmp_path / "s"), ["id"], [])):
        write()
        with pytest.raises(AnalysisException):
            write()
    K.write_table(df, "fw_test_table", path=str(tmp_path / "t"))
    with pytest.raises(AnalysisException):
        K.write_table(df, "fw_test_table", path=str(tmp_path / "t"))


def test_export_is_sorted_over_numbered_files(spark, tmp_path):
    df = spark.range(1000).select((999 - C("id")).alias("id")).repartition(7)
    K.export_sorted(df, str(tmp_path / "s"), ["id"], [], rows_per_file=300)
    files = sorted((tmp_path / "s").glob("part-*"))
    assert len(files) >= 4
    assert [int(x) for f in files for x in f.read_text().split()[1:]] == list(range(1000))


def test_one_generation_spreads_over_files(spark, tmp_path):
    K.write_by_gen(spark.range(1000).withColumn("gen", F.lit(1)), str(tmp_path / "g"), rows_per_file=200)
    assert len(list((tmp_path / "g" / "gen=1").glob("*.parquet"))) >= 5


def test_stream_equals_batch_after_a_restart(spark, sf, tmp_path):
    whole = S.read_pages(spark, f"{sf}/pages.parquet")
    arrivals, sink, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    arrivals.mkdir()
    for part in (0, 1):
        whole.filter(C("page_id") % 2 == part).coalesce(1).write.parquet(str(tmp_path / f"p{part}"))

    def links(df):
        return S.discover_links(df, "nav", "a", "href")

    for part in (0, 1):
        for f in (tmp_path / f"p{part}").glob("*.parquet"):
            shutil.copy(f, arrivals / f"{part}-{f.name}")
        T.stream_pages(spark, str(arrivals), sink, ckpt, links, max_files=1).awaitTermination()
    got = T.read_sink(spark, sink).select("page_id", "pos", "href")
    want = links(whole).select("page_id", "pos", "href")
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


@pytest.mark.parametrize("name", ["t1_stream_links", "t2_stream_urls"])
def test_streamed_table_may_be_a_file_or_a_folder(spark, tmp_path, name):
    rows = [(i, f"http://a.org/{i}", f"<nav><a href='/x{i}'>x</a></nav>") for i in range(4)]
    pages, file, folder = spark.createDataFrame(rows, S.PAGE_SCHEMA), tmp_path / "file", tmp_path / "folder"
    pages.repartition(2).write.parquet(str(folder / "pages.parquet"))
    pages.coalesce(1).write.parquet(str(tmp_path / "one"))
    file.mkdir()
    shutil.copy(next((tmp_path / "one").glob("*.parquet")), file / "pages.parquet")
    assert [catalog.QUERIES[name](spark, str(at)).count() for at in (file, folder)] == [4, 4]


def test_stream_state_holds_no_pages(spark, sf):
    fresh = T.stream_dedup_urls(T.read_page_stream(spark, sf, glob="pages.parquet"))
    assert fresh.columns == ["page_id", "url", "canonical_url"]


def test_stream_keeps_each_url_once_across_batches(spark, tmp_path):
    arrivals, sink, ckpt = tmp_path / "in", str(tmp_path / "out"), str(tmp_path / "ckpt")
    for n, urls in enumerate([["http://a.org/x#1", "http://a.org/y"], ["http://a.org/x#2", "http://a.org/z?b=1&a=2"], ["http://a.org/z?a=2&b=1"]]):
        spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], S.PAGE_SCHEMA).coalesce(1).write.mode("append").parquet(str(arrivals))
        fresh = T.stream_dedup_urls(T.read_page_stream(spark, str(arrivals), max_files=1))
        T.stream_to_folder(fresh, sink, ckpt, lambda b: b.select("canonical_url")).awaitTermination()
    got = sorted(r[0] for r in T.read_sink(spark, sink).collect())
    assert got == ["http://a.org/x", "http://a.org/y", "http://a.org/z?a=2&b=1"]


def test_cut_lineage_uses_the_named_folder(spark):
    df = cut_lineage(spark.range(10).withColumn("x", C("id") * 2))
    assert df.count() == 10 and "Scan ExistingRDD" in df._jdf.queryExecution().executedPlan().toString()
