"""Urls that earlier arrivals brought, stored in hash buckets on disk instead of in a stream's state.

The store is a parquet table, bucketed by canonical url, with one partition for each batch. A batch is made distinct,
what is left of it is shuffled into the table's buckets and joined with what lies there; the stored side is read in place,
without an exchange. What a stream keeps in memory does not grow, however many urls it has met.

A batch counts only batches with a smaller number as known and writes its own partition as a whole. So a batch that is
replayed after a failure, or after a lost executor, gives the same rows again.

Cases: rows whose url is null are never new and never known; of equal urls in one batch the first in the given order
stays; an empty batch writes an empty partition; columns that are not kept are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioweave.functions import urls as U
from folioweave.functions.literals import sql_value
from folioweave.operators import curate

KEY = "canonical_url"


class SeenUrls:
    """The store at ``path``; a new one has ``buckets`` buckets, an old one keeps the number it was made with.

    Give so many buckets that one of them, sorted by url, suits a task: a bucket of 200 MB holds about two million urls.
    Batches add files to every bucket; :meth:`compact` puts old batches together. One writer at a time.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path = spark, path.rstrip("/")
        self.buckets = self._settled(buckets)
        # the definition lives in the session's catalog only; the files and their folders say the rest
        self.table = f"fw_seen_{spark.range(1).select(F.hex(F.xxhash64(F.lit(self.path)))).first()[0].lower()}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} ({KEY} STRING, batch_id BIGINT) USING parquet "
                  f"PARTITIONED BY (batch_id) CLUSTERED BY ({KEY}) SORTED BY ({KEY}) INTO {self.buckets} BUCKETS "
                  f"LOCATION {sql_value(self.path + '/urls')}")
        self._refresh()

    def _settled(self, buckets: int) -> int:
        # beside the partitions, so that the table's folder is there before its first batch; a dot hides it from scans
        at = f"{self.path}/urls/.buckets"
        try:
            return self.spark.read.schema("n INT").json(at).first()["n"]
        except AnalysisException:
            self.spark.range(1).select(F.lit(int(buckets)).alias("n")).coalesce(1).write.json(at)
            return int(buckets)

    def _refresh(self) -> None:
        self.spark.catalog.recoverPartitions(self.table)
        self.spark.catalog.refreshTable(self.table)

    def known(self, before: int | None = None) -> DataFrame:
        """Stored urls, of batches below ``before`` if given; each once, but for batches replayed out of turn."""
        rows = self.spark.table(self.table)
        return (rows if before is None else rows.filter(F.col("batch_id") < before)).select(KEY)

    def unseen(self, rows: DataFrame, url: str = "url", order: Sequence[Column | str] = (),
               keep: Sequence[str] = (), before: int | None = None) -> DataFrame:
        """First row per canonical url that the store does not hold: ``canonical_url`` and the columns in ``keep``.

        Rows are made distinct within the tasks first, so a url that is on every page reaches the join once.
        """
        keyed = rows.select(U.canonical_url(F.col(url)).alias(KEY), *[c for c in dict.fromkeys(keep) if c != KEY])
        keyed = keyed.filter(F.col(KEY).isNotNull())
        first = curate.dedup_first(keyed, [KEY], order or list(keep)) if keep else keyed.distinct()
        return first.join(self.known(before), KEY, "left_anti")

    def add(self, fresh: DataFrame, batch_id: int) -> None:
        """Store the urls of a batch as its own partition, in place of what it held.

        ``fresh`` must not read the store; write it first, as :meth:`admit` does.
        """
        fresh.select(KEY).createOrReplaceTempView(f"{self.table}_fresh")
        # one task a bucket, so that a batch adds one file to each bucket
        self.spark.sql(f"INSERT OVERWRITE TABLE {self.table} PARTITION (batch_id = {int(batch_id)}) "
                       f"SELECT /*+ REPARTITION({self.buckets}, {KEY}) */ {KEY} FROM {self.table}_fresh")
        self.spark.catalog.dropTempView(f"{self.table}_fresh")
        self._refresh()

    def admit(self, batch: DataFrame, batch_id: int, url: str = "url", order: Sequence[Column | str] = (),
              keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
        """Rows of a batch with urls that no earlier batch had, written below the store and read back; their urls are stored.

        The rows are written before the urls: a failure between the two leaves a store that gives the same rows again.
        """
        at = f"{self.path}/admitted/batch_id={int(batch_id)}"
        self.unseen(batch, url, order, keep, before=batch_id).write.mode("overwrite").parquet(at)
        fresh = self.spark.read.parquet(at)
        self.add(fresh, batch_id)
        return fresh

    def admitted(self) -> DataFrame:
        """Rows of all batches, each canonical url once."""
        return self.spark.read.parquet(f"{self.path}/admitted").drop("batch_id")

    def compact(self, below: int) -> int:
        """Put the urls of all batches with a number under ``below`` into one partition; gives the number of partitions left.

        That partition carries the smallest number, ``-1``. Batches under ``below`` can no longer be replayed. It is written
        before the old ones are dropped; a failure between leaves urls twice, which does no harm to an anti join.
        """
        at = f"{self.path}/compact/below={int(below)}"
        self.known(before=below).distinct().write.mode("overwrite").parquet(at)
        self.add(self.spark.read.parquet(at), -1)
        spec = [int(r[0].partition("=")[2]) for r in self.spark.sql(f"SHOW PARTITIONS {self.table}").collect()]
        for old in spec:
            if 0 <= old < below:
                # an empty overwrite clears the files, then the partition goes
                self.add(self.spark.createDataFrame([], f"{KEY} STRING"), old)
                self.spark.sql(f"ALTER TABLE {self.table} DROP IF EXISTS PARTITION (batch_id = {old})")
        return len([x for x in spec if not 0 <= x < below])


def stream_unseen(pages: DataFrame, store: SeenUrls, checkpoint: str, url: str = "url",
                  order: Sequence[Column | str] = (), keep: Sequence[str] = ("page_id", "url")) -> StreamingQuery:
    """First page per canonical url across arrivals, without a stream state; read :meth:`SeenUrls.admitted`.

    Runs until everything present is handled.
    """
    return (
        pages.writeStream.foreachBatch(lambda batch, n: store.admit(batch, n, url, order, keep) and None)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
