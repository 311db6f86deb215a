"""Stores that grow by arrivals equal the answer at once, also after replayed batches, and do not shuffle what is stored."""

import random
import re

from pyspark.sql import functions as F

from folioweave.operators import curate
from folioweave.sources import pages as S
from folioweave.streaming import pages as T
from folioweave.streaming.seen import SeenUrls, stream_unseen
from folioweave.streaming.winners import Winners

C = F.col
URLS = [["http://a.org/x#1", "http://a.org/y", None, "http://a.org/x"], ["http://a.org/x#2", "http://a.org/z?b=1&a=2"],
        [], ["http://a.org/z?a=2&b=1", None, "http://a.org/w"]]


def pages_of(spark, urls):
    return spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], S.PAGE_SCHEMA)


def admitted(store):
    return sorted(tuple(r) for r in store.admitted().select("canonical_url", "page_id").collect())


WANT = [("http://a.org/w", 2), ("http://a.org/x", 0), ("http://a.org/y", 1), ("http://a.org/z?a=2&b=1", 1)]


def test_each_url_is_admitted_once_and_replays_change_nothing(spark, tmp_path):
    store = SeenUrls(spark, str(tmp_path / "seen"), buckets=4)
    for n, urls in enumerate(URLS):
        store.admit(pages_of(spark, urls), n, order=["page_id"])
        store.admit(pages_of(spark, urls), n, order=["page_id"])  # replay of the newest batch
    assert admitted(store) == WANT
    store.admit(pages_of(spark, URLS[1]), 1, order=["page_id"])  # replay of an old one
    assert admitted(store) == WANT
    assert sorted(r[0] for r in store.known().collect()) == [u for u, _ in WANT]


def test_a_failure_between_rows_and_urls_is_mended_by_the_replay(spark, tmp_path):
    store = SeenUrls(spark, str(tmp_path / "seen"), buckets=4)
    store.admit(pages_of(spark, URLS[0]), 0, order=["page_id"])
    whole, store.add = store.add, lambda *a: (_ for _ in ()).throw(RuntimeError("lost"))
    try:
        store.admit(pages_of(spark, URLS[1]), 1, order=["page_id"])
    except RuntimeError:
        pass
    store.add = whole
    for n in (1, 2, 3):
        store.admit(pages_of(spark, URLS[n]), n, order=["page_id"])
    assert admitted(store) == WANT


def test_a_store_is_opened_again_with_its_own_buckets(spark, tmp_path):
    path = str(tmp_path / "seen")
    first = SeenUrls(spark, path, buckets=4)
    first.admit(pages_of(spark, URLS[0]), 0, order=["page_id"])
    spark.sql(f"DROP TABLE {first.table}")  # as in a new session: the definition is gone, the files stay
    again = SeenUrls(spark, path, buckets=9)
    assert again.buckets == 4
    assert sorted(r[0] for r in again.known().collect()) == ["http://a.org/x", "http://a.org/y"]
    for n in (1, 2, 3):
        again.admit(pages_of(spark, URLS[n]), n, order=["page_id"])
    assert admitted(again) == WANT


def test_compacting_keeps_all_urls_in_fewer_files(spark, tmp_path):
    store = SeenUrls(spark, str(tmp_path / "seen"), buckets=4)
    for n, urls in enumerate(URLS):
        store.admit(pages_of(spark, urls), n, order=["page_id"])
    assert store.compact(3) == 2
    assert sorted(r[0] for r in store.known().collect()) == [u for u, _ in WANT]
    assert store.compact(4) == 1
    got = store.admit(pages_of(spark, [u for us in URLS for u in us] + ["http://a.org/new"]), 4, order=["page_id"])
    assert [r[0] for r in got.select("canonical_url").collect()] == ["http://a.org/new"]


def test_the_stored_side_is_not_shuffled(spark, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as with a store too large to broadcast
    try:
        store = SeenUrls(spark, str(tmp_path / "seen"), buckets=16)
        for n in (0, 1):
            store.admit(spark.range(500).select(C("id").alias("page_id"), F.format_string("http://a.org/%d", C("id") + 300 * n).alias("url")), n)
        new = store.unseen(spark.range(2000).select(F.format_string("http://a.org/%d", "id").alias("url")))
        assert new.count() == 1200
        plan = new._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    lines = plan.split("== Initial Plan ==")[0].splitlines()
    depth = [re.search(r"[A-Za-z]", x).start() if re.search(r"[A-Za-z]", x) else 0 for x in lines]
    at = next(i for i, x in enumerate(lines) if "Bucketed: true" in x)
    above, level = [], depth[at]
    for i in range(at - 1, -1, -1):
        if depth[i] < level:
            above.append(lines[i])
            level = depth[i]
            if "SortMergeJoin" in lines[i]:
                break
    assert "SortMergeJoin" in above[-1]
    assert not [x for x in above if "Exchange" in x or "QueryStage" in x]


def test_stream_without_arrival_time_has_no_state(spark, tmp_path):
    arrivals, ckpt = tmp_path / "in", tmp_path / "ckpt"
    for urls in URLS:
        pages_of(spark, urls).coalesce(1).write.mode("append").parquet(str(arrivals))
        store = SeenUrls(spark, str(tmp_path / "seen"), buckets=4)
        stream_unseen(T.read_page_stream(spark, str(arrivals), max_files=1), store, str(ckpt), order=["page_id"]).awaitTermination()
    assert sorted(u for u, _ in admitted(store)) == [u for u, _ in WANT]
    assert not (ckpt / "state").exists()


# ---------------------------------------------------------------- winners

SCHEMA = "k BIGINT, rank INT, id BIGINT, v STRING"


def arrivals_of(n=400, seed=3):
    rnd = random.Random(seed)
    rows = [(rnd.choice([None, 7, 7, 7, rnd.randrange(60)]), rnd.choice([None, 1, 2, 3]), i, f"v{i}") for i in range(n)]
    return [rows[:150], rows[150:160], [], rows[160:]], rows


def sorted_rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_winners_of_four_batches_equal_the_table_at_once(spark, tmp_path):
    batches, rows = arrivals_of()
    store = Winners(spark, str(tmp_path / "w"), SCHEMA, ["k"], ["rank", "id"], buckets=8)
    assert store.read().count() == 0
    for n, batch in enumerate(batches):
        df = spark.createDataFrame(batch, SCHEMA)
        store.merge(df, n)
        store.merge(df, n)  # replayed
    best = {}
    for r in rows:  # independent of the library: smallest rank, unknown ranks last, then id
        at = (r[1] is None, r[1] or 0, r[2])
        if r[0] not in best or at < best[r[0]][0]:
            best[r[0]] = (at, r)
    want = sorted((r for _, r in best.values()), key=repr)
    assert sorted_rows(store.read()) == want
    once = curate.dedup_first(spark.createDataFrame(rows, SCHEMA), ["k"], ["rank", "id"])
    assert sorted_rows(once) == want


def test_only_touched_buckets_are_written(spark, tmp_path):
    store = Winners(spark, str(tmp_path / "w"), SCHEMA, ["k"], ["rank", "id"], buckets=8)
    store.merge(spark.range(200).selectExpr("id AS k", "1 AS rank", "id", "'a' AS v"), 0)
    before = store._manifest()
    assert len(before) == 8
    touched = store.merge(spark.createDataFrame([(5, 0, 900, "b")], SCHEMA), 1)
    after = store._manifest()
    assert len(touched) == 1 and [b for b in after if after[b] != before[b]] == touched
    assert store.read().filter("k = 5").collect()[0]["v"] == "b" and store.read().count() == 200


def test_a_batch_that_dies_before_its_manifest_is_not_seen(spark, tmp_path):
    store = Winners(spark, str(tmp_path / "w"), SCHEMA, ["k"], ["rank", "id"], buckets=4)
    store.merge(spark.createDataFrame([(1, 2, 1, "a")], SCHEMA), 0)
    manifest, store._manifest = store._manifest, lambda before=None: (_ for _ in ()).throw(RuntimeError("lost"))
    better = spark.createDataFrame([(1, 1, 2, "b")], SCHEMA)
    try:
        store.merge(better, 1)
    except RuntimeError:
        pass
    store._manifest = manifest
    assert store.read().collect()[0]["v"] == "a"
    store.merge(better, 1)
    assert store.read().collect()[0]["v"] == "b"


def test_other_columns_and_another_order_do_no_harm(spark, tmp_path):
    store = Winners(spark, str(tmp_path / "w"), SCHEMA, ["k"], ["rank", "id"], buckets=4)
    df = spark.createDataFrame([("a", 1, 5, 2, "x")], "v STRING, id BIGINT, k BIGINT, rank INT, _winner_bucket STRING")
    store.merge(df, 0)
    assert [tuple(r) for r in store.read().collect()] == [(5, 2, 1, "a")]
