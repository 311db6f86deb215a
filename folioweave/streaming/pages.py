"""Structured Streaming over arriving page files."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from folioweave.functions import urls as U
from folioweave.sources.pages import PAGE_SCHEMA


def read_page_stream(spark: SparkSession, path: str, max_files: int = 1000, glob: str | None = None) -> DataFrame:
    """Pages from files that arrive in a folder; ``glob`` picks files by name."""
    reader = spark.readStream.schema(PAGE_SCHEMA).option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)


def table_pattern(path: str) -> str:
    """A pattern that fits ``path`` alone, so that a stream may read a table that is one file as well as one that is a folder."""
    folder, _, name = path.rstrip("/").rpartition("/")
    return f"{folder}/[{name[0]}]{name[1:]}"


def stream_to_folder(pages: DataFrame, sink: str, checkpoint: str,
                     extract: Callable[[DataFrame], DataFrame]) -> StreamingQuery:
    """Extract from streamed pages and append to a parquet folder, one folder per batch.

    Runs until everything present is handled. ``extract`` sees a plain DataFrame, so the
    per-page windows are allowed. A batch that is replayed after a failure overwrites its own
    folder, so the sink holds each page's rows once. Read it back with :func:`read_sink`.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        extract(batch).write.mode("overwrite").parquet(f"{sink}/batch_id={batch_id}")

    return (
        pages.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_pages(spark: SparkSession, path: str, sink: str, checkpoint: str,
                 extract: Callable[[DataFrame], DataFrame], max_files: int = 1000,
                 glob: str | None = None) -> StreamingQuery:
    """:func:`stream_to_folder` over the page files of a folder."""
    return stream_to_folder(read_page_stream(spark, path, max_files, glob), sink, checkpoint, extract)


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    return spark.read.parquet(sink).drop("batch_id")


def stream_dedup_urls(pages: DataFrame, arrived: str | None = None, delay: str = "1 day",
                      keep: Sequence[str] = ("page_id", "url")) -> DataFrame:
    """First page per canonical url across arrivals; only the columns in ``keep`` go through the state's shuffle.

    With an arrival time the state is kept for ``delay`` only; without one it grows with the
    number of distinct urls, which suits runs that end (``availableNow``). A url seen many times
    meets its state in one task: bound the batches with ``max_files``.
    """
    few = dict.fromkeys([*keep, *([arrived] if arrived else [])])
    keyed = pages.select(*few, U.canonical_url(F.col("url")).alias("canonical_url"))
    if arrived is None:
        return keyed.dropDuplicates(["canonical_url"])
    return keyed.withWatermark(arrived, delay).dropDuplicatesWithinWatermark(["canonical_url"])
