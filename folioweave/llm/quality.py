"""Quality rules: counts inside each text, and lines that many documents of one host share.

Everything is DataFrame expressions. A line is normalised (lower case, single blanks) and hashed to 96 bits; a host's
limit for a line is a number of distinct documents, where copies of one text count once. Lines above the limit are
removed, and a document that loses too much is rejected.

Defined cases: a null text is an empty one; null hosts form one host; repeated rows get equal verdicts; an empty table
gives an empty result; other columns of the input pass through, and one that has the name of the result column is replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioweave.llm.common import fresh, let, settle, text_key, words

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 5
#: A line in more distinct documents of a host than this goes, also where it is a small share of a very large host.
MAX_LINE_DOCS = 10_000


def line_key(line_words: Column) -> Column:
    """Hashes of a normalised line, from its words."""
    plain = F.lower(F.array_join(line_words, " "))
    return F.struct(F.xxhash64(plain).alias("a"), F.hash(plain).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def _covered(word: Column, windows: Column) -> Column:
    """Words inside windows that occur twice or more. Sorting brings equal windows together; ``windows`` are their hashes,
    and the words themselves decide where hashes are equal."""
    tagged = F.transform(windows, lambda h, i: F.struct(
        h.alias("h"), F.concat_ws(" ", F.slice(word, i + 1, WINDOW)).alias("t"), i.alias("i")))

    def same(x: Column, y: Column) -> Column:
        return F.coalesce((x["h"] == y["h"]) & (x["t"] == y["t"]), F.lit(False))

    def places(s: Column) -> Column:
        return F.filter(
            F.transform(s, lambda x, j: F.when(same(x, F.get(s, j - 1)) | same(x, F.get(s, j + 1)), x["i"])),
            lambda p: p.isNotNull())

    def reach(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda x, k: F.least(F.lit(WINDOW), F.coalesce(F.get(p, k + 1) - x, F.lit(WINDOW)))),
            F.lit(0), lambda a, x: a + x)

    return let(F.sort_array(tagged), lambda s: let(F.sort_array(places(s)), reach))


def repeat_words(word: Column) -> Column:
    """Words in windows of five found twice or more, the first included. Linear where nothing repeats."""
    def windows(h: Column) -> Column:
        return F.when(
            F.size(h) >= WINDOW,
            F.transform(F.sequence(F.lit(0), F.size(h) - WINDOW),
                        lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(WINDOW)])),
        ).otherwise(F.array().cast("array<bigint>"))

    def count(w: Column) -> Column:
        return F.when(F.size(F.array_distinct(w)) == F.size(w), F.lit(0)).otherwise(_covered(word, w))

    return let(F.transform(word, lambda x: F.xxhash64(x)), lambda h: let(windows(h), count)).cast("long")


def text_facts(text: Column, min_words: int, max_repeat_pct: int) -> Column:
    """Struct of the counts of one text, whether the base rules fail, and its lines as (key, words)."""
    whole = F.coalesce(text, F.lit(""))

    def facts(by_line: Column) -> Column:
        lines = F.transform(by_line, lambda v: F.struct(line_key(v).alias("line"), F.size(v).alias("words")))
        return let(F.flatten(by_line), lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"), repeat_words(w).alias("n_repeat_words"), lines.alias("lines")))

    def whole_facts(full: Column) -> Column:
        return let(let(F.transform(full, lambda x: words(x)), facts), lambda s: F.struct(
            s["n_words"].alias("n_words"),
            F.length(F.translate(whole, SPACES, "")).cast("long").alias("word_chars"),
            (F.length(whole) - F.length(F.translate(whole, SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size(full) - F.size(F.array_distinct(full))).cast("long").alias("n_dup_lines"),
            s["n_repeat_words"].alias("n_repeat_words"),
            ((s["n_words"] < min_words) | (100 * s["n_repeat_words"] > max_repeat_pct * s["n_words"])).alias("base_failed"),
            s["lines"].alias("lines")))

    return let(F.filter(_lines(text), lambda x: F.length(F.translate(x, SPACES, "")) > 0), whole_facts)


def line_report(docs: DataFrame, text: str = "text", host: str = "source", *, min_words: int = 10,
                max_repeat_pct: int = 20, min_docs: int = 10, host_share: float = 0.02, min_left: int = 5,
                max_removed: float = 0.8, max_docs: int | None = MAX_LINE_DOCS) -> DataFrame:
    """One row per host and text: ``host, key``, the counts, ``removed`` words, ``bad_lines``, ``kept``.

    A line goes when more than ``max(min_docs, host_share * documents of the host)`` distinct documents of its host hold
    it, or more than ``max_docs`` (not below ``min_docs``; None for no such limit), however large the host. A
    document is depleted, and so rejected, when fewer than ``min_left`` words stay or more than ``max_removed`` of its words
    go. Texts are read once; after that only hashes move.
    """
    facts = settle(
        docs.select(F.col(host).alias("host"), text_key(F.col(text)).alias("key"),
                    text_facts(F.col(text), min_words, max_repeat_pct).alias("facts"))
        .groupBy("host", "key").agg(F.first("facts").alias("facts")), "line-facts")
    if max_docs is not None and max_docs < min_docs:
        raise ValueError("max_docs is below min_docs")
    shared = F.col("n") > host_share * F.col("docs")
    if max_docs is not None:
        shared = shared | (F.col("n") > max_docs)
    held = (facts.select("host", "key", F.inline("facts.lines"))
            .groupBy("host", "key", "line").agg(F.sum("words").alias("words")))
    hosts = facts.groupBy("host").agg(F.count("*").alias("docs"))
    often = (held.groupBy("host", "line").agg(F.count("*").alias("n"))
             .where(F.col("n") > min_docs).alias("f")
             .join(hosts.alias("h"), F.col("f.host").eqNullSafe(F.col("h.host")))
             .where(shared).select("f.host", "f.line"))
    lost = (held.alias("x").join(often.alias("o"), F.col("x.host").eqNullSafe(F.col("o.host"))
                                 & (F.col("x.line") == F.col("o.line")))
            .groupBy("x.host", "x.key")
            .agg(F.sum("x.words").alias("removed"), F.collect_set("x.line").alias("bad_lines")))
    removed = F.coalesce(F.col("removed"), F.lit(0).cast("long"))
    whole = F.col("facts.n_words")
    depleted = (removed > 0) & ((whole - removed < min_left) | (removed > max_removed * whole))
    return (facts.alias("d").join(lost.alias("l"), F.col("d.host").eqNullSafe(F.col("l.host"))
                                  & (F.col("d.key") == F.col("l.key")), "left")
            .select("d.host", "d.key",
                    *[F.col(f"facts.{c}").alias(c) for c in
                      ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")],
                    removed.alias("removed"), "bad_lines",
                    (~F.col("facts.base_failed") & ~depleted).alias("kept")))


def apply_report(docs: DataFrame, report: DataFrame, text: str = "text", host: str = "source",
                 out: str = "quality") -> DataFrame:
    """``docs`` and a struct ``out`` with the report's columns and ``clean_text``, the text without its bad lines."""
    rows = docs.drop(out)
    h, k, body = fresh(rows, "host_key", "text_key", "report")
    named = report.select(F.col("host").alias(h), F.col("key").alias(k), F.struct(
        *[c for c in report.columns if c not in ("host", "key")]).alias(body))
    r = rows.withColumn(k, text_key(F.col(text))).alias("r")
    joined = r.join(named.alias("n"), F.col(f"r.{host}").eqNullSafe(F.col(f"n.{h}"))
                    & (F.col(f"r.{k}") == F.col(f"n.{k}")), "left")
    left = F.filter(_lines(F.col(text)), lambda x: ~F.array_contains(F.col(f"{body}.bad_lines"), line_key(words(x))))
    clean = F.when(F.col(f"{body}.bad_lines").isNull(), F.col(text)).otherwise(F.array_join(left, "\n"))
    return joined.select(*[F.col(f"r.{c}") for c in rows.columns],
                         F.col(body).withField("clean_text", clean).alias(out))
