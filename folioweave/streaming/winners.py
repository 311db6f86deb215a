"""A deduplicated table that grows by arrivals: the stored winner of a key meets the candidates of a batch.

Rows lie in hash buckets of their key. A batch reads only the buckets that its keys fall into, takes the first row per key
of what is stored and what came, and writes these buckets anew into a folder of its own. A manifest then names the folder
of every bucket; it is one small file a batch, written last, so readers see a batch as a whole or not at all.

A batch builds on the newest manifest below its own number. Replayed, it reads the same rows and writes the same result
under a new manifest of the same number, whatever an earlier try left behind.

Cases: null keys are a key like any other; ties end with the last column of ``order``, which should be unique; rows that
are equal in all of it count once; an empty batch publishes what was there; columns come by name, in the store's order.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioweave.operators import curate

MANIFEST = "bucket INT, folder STRING"
SLOT = "_winner_bucket"


class Winners:
    """The table at ``path`` with the columns of ``schema`` (DDL), first row per ``keys`` in ``order``.

    ``buckets`` bounds the manifest and what the driver holds: one row a bucket. It must stay the same for one path.
    Folders that no manifest names any more are left for the store to clear.
    """

    def __init__(self, spark: SparkSession, path: str, schema: str, keys: Sequence[str], order: Sequence[Column | str],
                 buckets: int = 64):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.keys, self.order, self.buckets = list(keys), list(order), int(buckets)
        self.columns = spark.createDataFrame([], schema).columns

    def _manifest(self, before: int | None = None) -> dict[int, str]:
        """Folder of every bucket in the newest manifest, of those below ``before`` if given."""
        try:
            rows = self.spark.read.schema(f"{MANIFEST}, batch_id BIGINT").parquet(f"{self.path}/manifest")
        except AnalysisException:
            return {}
        rows = rows if before is None else rows.filter(F.col("batch_id") < before)
        newest = rows.agg(F.max("batch_id")).first()[0]
        return {} if newest is None else {r["bucket"]: r["folder"] for r in rows.filter(F.col("batch_id") == newest).collect()
                                          if r["bucket"] is not None}

    def _rows(self, folders: dict[int, str]) -> DataFrame:
        paths = [f"{self.path}/rows/{folder}/{SLOT}={bucket}" for bucket, folder in sorted(folders.items())]
        if not paths:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*paths)

    def read(self) -> DataFrame:
        """The table after the newest batch."""
        return self._rows(self._manifest())

    def merge(self, batch: DataFrame, batch_id: int) -> list[int]:
        """Merge a batch; gives the buckets that were written anew.

        Candidates are cut down to one row per key within the tasks, so a key with most of a batch's rows does no harm.
        """
        slot = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")
        came, folder = f"{self.path}/came/{int(batch_id)}-{uuid.uuid4().hex}", f"{int(batch_id)}-{uuid.uuid4().hex}"
        first = curate.dedup_first(batch.select(*self.columns), self.keys, self.order)
        # written once: the batch is read for its buckets and for the merge
        first.write.parquet(came)
        few = self.spark.read.schema(self.schema).parquet(came)
        touched = sorted(r[0] for r in few.select(slot.alias("b")).distinct().collect())
        stored = self._manifest(before=batch_id)
        if touched:
            old = self._rows({b: f for b, f in stored.items() if b in set(touched)})
            merged = curate.dedup_first(old.unionByName(few), self.keys, self.order)
            # a bucket is written by few tasks: those that hold its keys
            (merged.withColumn(SLOT, slot).repartition(len(touched), SLOT)
             .write.partitionBy(SLOT).parquet(f"{self.path}/rows/{folder}"))
        now = stored | dict.fromkeys(touched, folder)
        # a row without a bucket keeps the manifest of an empty table readable
        lines = [(b, f) for b, f in sorted(now.items())] or [(None, None)]
        (self.spark.createDataFrame(lines, MANIFEST).coalesce(1)
         .write.mode("overwrite").parquet(f"{self.path}/manifest/batch_id={int(batch_id)}"))
        return touched
