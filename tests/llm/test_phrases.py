"""Phrase collocations against plain counting."""

import random
import re
from collections import Counter

import pytest

from folioweave.llm import phrases

SCHEMA = "lang string, text string, prefix string, n int"


def plain(rows, top=2000, least=10):
    small = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    f, total = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(small)):
            w = [x for x in re.split("[ \t]+", piece) if x]
            total[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    found = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    out = []
    for (lang, p), a in found.items():
        if len(p) == 2 and any(q != p and 100 * b >= 50 * a and (q[:2] == p or q[1:] == p)
                               for (other, q), b in found.items() if other == lang and len(q) == 3):
            continue
        cuts = [(1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.append((lang, " ".join(p), a, f[lang, p[:k]], f[lang, p[k:]], total[lang], score))
    out.sort(key=lambda r: (r[0].encode(), -r[6], -r[2], r[1].encode()))
    ranked, seen = [], Counter()
    for r in out:
        seen[r[0]] += 1
        if seen[r[0]] <= top:
            ranked.append((r[0], seen[r[0]], *r[1:]))
    return ranked


def texts():
    rnd = random.Random(3)
    words = ["the", "The", "of", "new", "york", "york", "city", "é", "É", "a", "日本", "x" * 300, "b\x00", "#"]
    rows = []
    for i in range(300):
        t = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", "  ", "\t", ", ", ".\n", "\r", "\x0b"]) for _ in range(rnd.randint(0, 60)))
        rows.append((rnd.choice(["en", "en", "de", None, "und"]), t))
    rows += [("en", "new york city " * 50)] * 3 + [("fr", "a a a a a"), ("fr", None), ("de", ""), ("hot", "z " * 30_000)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return texts()


def got(spark, rows, **kw):
    docs = spark.createDataFrame([(a, b, "p", 1) for a, b in rows], SCHEMA).repartition(3)
    return [tuple(r) for r in phrases.collocations(docs, **kw).orderBy("lang", "rank").collect()]


def test_equals_plain_counts(spark, rows):
    assert got(spark, rows) == plain(rows)


def test_full_tries_and_bursts_change_nothing(spark, rows, monkeypatch):
    assert got(spark, rows, max_entries=40, burst=2, top=7) == plain(rows, 7)


def test_words_are_numbered_anew_when_there_are_too_many(spark, rows, monkeypatch):
    from pyspark import TaskContext  # noqa: F401

    monkeypatch.setattr(phrases, "MAX_WORDS", 4)
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 200)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([a or "und" for a, _ in rows]), pa.array([b or "" for _, b in rows])], ["lang", "text"])
    sums = Counter()
    for b in phrases._count(40, 2)(iter([batch])):
        for lang, prefix, last, n in zip(*[c.to_pylist() for c in b.columns]):
            sums[lang, prefix, last] += n
    whole = Counter()
    for b in phrases._count(10**6, 10**6)(iter([batch])):
        for lang, prefix, last, n in zip(*[c.to_pylist() for c in b.columns]):
            whole[lang, prefix, last] += n
    assert sums == whole


def test_merge_carries_open_groups_over_batches():
    import pyarrow as pa

    rnd = random.Random(1)
    rows = sorted(((rnd.choice("ab"), rnd.choice(["p", "p q", "r"]), rnd.choice([None, "s", "t"]), rnd.randint(1, 4))
                   for _ in range(200)), key=lambda r: (r[1], r[0], r[2] is not None, r[2]))
    want = Counter()
    for lang, prefix, last, n in rows:
        want[lang, prefix, None] += n
        if last is not None:
            want[lang, prefix, last] += n
    for size in (1, 3, 50, 200):
        batches = [pa.RecordBatch.from_arrays(
            [pa.array(list(c), t) for c, t in zip(zip(*rows[i:i + size]), phrases.SCHEMA.types)], phrases.SCHEMA.names)
            for i in range(0, len(rows), size)]
        found = [r for b in phrases._merge(5)(iter(batches)) for r in zip(*[c.to_pylist() for c in b.columns])]
        assert sorted(found, key=str) == sorted(((*k, n) for k, n in want.items() if n >= 5), key=str)


def test_large_counts_are_exact(spark):
    a, l, r = 9_007_199_254_740, 9_007_199_254_741, 9_007_199_254_743
    row = spark.sql(f"SELECT {phrases.whole_score('a', 'l', 'r')} AS s FROM VALUES ({a}L, {l}L, {r}L) AS t(a, l, r)").first()
    assert row.s == 1000000 * a * a // (l * r)


def test_empty_table(spark):
    assert got(spark, []) == []
