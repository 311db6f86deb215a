"""Quality rules against a plain recount, and the defined edge cases."""

import re
from collections import Counter, defaultdict

from folioweave.llm import quality
from folioweave.llm.queries import quality_query

COLUMNS = "doc_id long, text string, source string, quality string, facts int, key string"


def recount(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    covered = {i + k for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered))


def check(spark, rows, **limits):
    docs = spark.createDataFrame([(i, t, s, "x", 1, "k") for i, t, s in rows], COLUMNS)
    got = quality.apply_report(docs, quality.line_report(docs, **limits)).collect()
    min_docs, share = limits.get("min_docs", 10), limits.get("host_share", 0.02)
    held, hosts = defaultdict(set), defaultdict(set)
    keys = lambda t: [" ".join(x.split()).lower() for x in re.split("\n", t or "") if x.split()]
    for _, t, s in rows:
        hosts[s].add(t or "")
        for k in keys(t):
            held[s, k].add(t or "")
    want = []
    for i, t, s in rows:
        facts = recount(t)
        gone = sum(len(k.split()) for k in keys(t) if len(held[s, k]) > max(min_docs, share * len(hosts[s])))
        failed = facts[0] < 10 or 100 * facts[4] > 20 * facts[0]
        want.append((i, facts, gone, not failed and not (gone and (facts[0] - gone < 5 or gone > 0.8 * facts[0]))))
    q = [r["quality"] for r in got]
    have = [(r["doc_id"], (x["n_words"], x["word_chars"], x["n_symbols"], x["n_dup_lines"], x["n_repeat_words"]),
             x["removed"], x["kept"]) for r, x in zip(got, q)]
    assert sorted(have, key=repr) == sorted(want, key=repr)
    return got


def test_counts_lines_and_verdicts(spark):
    shared = "This line stands on every page"
    rows = [(i, f"{shared}\nThe text number {i} has its own words here today {i} {i * 7}", "a") for i in range(8)]
    rows += [(20 + i, f"{shared.upper()}  \n w{i}", "a") for i in range(3)]
    rows += [(30, f"{shared}\nalone on this host but long enough to stay", "b")]
    rows += [(40, "one two three four five six one two three four five nine ten", "b")]
    rows += [(41, None, "a"), (42, "", None), (43, " \t\n\x0b ", None), (44, "a b c d e " * 3000, "b")]
    rows += [(45, "x\ny\nx\n\n  \nx # * $ %", None), (None, "é ü ß é ü ß é ü ß é ü ß", "b")]
    rows += [rows[0], rows[0]]
    got = check(spark, rows, min_docs=3, host_share=0.0)
    clean = {r["doc_id"]: r["quality"]["clean_text"] for r in got}
    assert clean[1] == "The text number 1 has its own words here today 1 7"
    assert clean[30].startswith(shared) and clean[41] is None


def test_copies_count_once(spark):
    rows = [(i, "the same text in every copy of it, with more than ten words in it", "a") for i in range(30)]
    got = check(spark, rows, min_docs=3, host_share=0.0)
    assert all(r["quality"]["kept"] for r in got)


def test_limit_grows_with_the_host(spark):
    rows = [(i, f"common line of words\nown words {i} of the document number {i} and some more {i}", "a") for i in range(20)]
    assert all(r["quality"]["removed"] == 0 for r in check(spark, rows, min_docs=3, host_share=1.0))
    assert all(r["quality"]["removed"] == 4 for r in check(spark, rows, min_docs=3, host_share=0.5))


def test_limit_has_an_upper_end(spark):
    lines = {"stands in thirty": 30, "stands in twenty": 20, "stands in twelve": 12}
    docs = spark.range(3000).selectExpr(
        "id AS doc_id", "'a' AS source", "concat_ws('\n', " + ", ".join(
            f"CASE WHEN id < {n} THEN '{line}' END" for line, n in lines.items())
        + ", concat('own words of the document with the number ', id, ' and some more of them here')) AS text")
    for max_docs, gone in [(None, 0), (20, 30), (12, 50), (10, 62)]:
        got = quality.apply_report(docs, quality.line_report(docs, max_docs=max_docs)).where("quality.removed > 0")
        assert sum(r["quality"]["removed"] for r in got.collect()) == 3 * gone


def test_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    assert quality.apply_report(docs, quality.line_report(docs)).count() == 0


def test_query_runs_no_python(spark, sf):
    shape = quality_query(spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in shape and "Arrow" not in shape and "Cartesian" not in shape
