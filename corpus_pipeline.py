"""From raw documents to packed training sequences; every stage reads what the stage before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioweave.llm import mixing, packing, quality, simhash, toxicity
from folioweave.llm.common import fresh, settle, table, text_key, words
from folioweave.llm.queries import WORD_BPE

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: No stage but the mix can be said in SQL as a whole: toxicity is learned.
ORACLE_SQL = None


def clean_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules, without the lines that too many documents of their source share."""
    got = quality.apply_report(docs.select(*COLUMNS), quality.line_report(docs))
    text = F.col("quality.clean_text")
    return got.where("quality.kept").withColumn("text", text).withColumn(
        "n_chars", F.when(F.col("quality.bad_lines").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long"))
    ).select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below one half; the model learns from the labelled ones among them."""
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return docs.select(*COLUMNS, toxicity.score(F.col("text"), model).alias("score")).where("score < 0.5").select(*COLUMNS)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the row with the smallest id, and of equal ids the one with the smallest text hash.

    Rows without an id come last in their group. A row is known by its id and text; copies of it count once.
    """
    rows = docs.select(F.struct("doc_id", text_key(F.col("text")).alias("text")).alias("row"), F.struct(*COLUMNS).alias("body"))
    groups = simhash.near_duplicates(rows.select("row", "row.doc_id", "body.text"), key="group")
    first = groups.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "row")).alias("first")).select("first.row")
    return rows.groupBy("row").agg(F.min("body").alias("body")).join(first, "row", "left_semi").select("body.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    size, = fresh(docs, "size")
    sized = docs.select(*COLUMNS, F.size(words(F.col("text"))).cast("long").alias(size))
    got = mixing.mix(sized, size).where("copies > 0")
    return got.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("turn")).select(*COLUMNS)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packed pieces of all documents."""
    return packing.digest(packing.pack_documents(docs, WORD_BPE), packing.id_bytes(WORD_BPE), "doc_id")


STAGES = [
    ("quality rules", clean_lines),
    ("toxicity", drop_toxic),
    ("simhash near-dedup", one_of_each),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
