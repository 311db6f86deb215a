"""Scalar functions against plain Python on samples and generated text."""

import math
import random

import pytest
from pyspark.sql import functions as F

from folioweave.functions import lists as L
from folioweave.functions import numbers as N
from folioweave.functions import text as X
from folioweave.functions import urls as U

C = F.col
SAMPLES = [
    "", " ", "abc", "  abc\t ", "a\r\n\tb", "Élan vital", "they're HERE", "ab-cd 3ef", "0007", "12345", "x, , ", ", x", "ÀB cd",
    "Mr. Mime Jr.", "tab\there", " wide ", "under_score", "A", "aB", "100%",
]


def column(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i INT, s STRING")
    return [r[0] for r in df.orderBy("i").select(expr(C("s"))).collect()]


def generated(n=200, seed=3):
    rng = random.Random(seed)
    alphabet = "abC dE-'9é,\t.Z"
    return ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 12))) for _ in range(n)]


@pytest.mark.parametrize("ours, plain", [
    (X.strip, str.strip),
    (lambda c: X.zfill(c, 4), lambda s: s.rjust(4, "0")),
    (X.title, str.title),
    (X.capitalize, str.capitalize),
    (X.upper_first, lambda s: s[:1].upper() + s[1:]),
    (lambda c: X.py_slice(c, 0, -2), lambda s: s[:-2]),
    (lambda c: X.py_slice(c, -3), lambda s: s[-3:]),
    (lambda c: X.py_slice(c, 2, 5), lambda s: s[2:5]),
    (lambda c: X.py_slice(c, 1, -1), lambda s: s[1:-1]),
    (lambda c: X.rstrip_set(c, ", "), lambda s: s.rstrip(", ")),
    (lambda c: X.replace_all(c, [("a", "bb"), ("b", "")]), lambda s: s.replace("a", "bb").replace("b", "")),
])
def test_text_like_python(spark, ours, plain):
    values = SAMPLES + generated()
    assert column(spark, values, ours) == [plain(v) for v in values]


def test_regex_characters_are_literal(spark):
    assert column(spark, ["a.b|c"], lambda c: X.replace_all(c, [(".", "+"), ("|", "\\")])) == ["a+b\\c"]
    assert column(spark, ["a.b.c"], lambda c: L.at(L.split_literal(c, "."), 1)) == ["b"]


def test_feet_and_pounds(spark):
    got = column(spark, ["5'11\"", "5’11”", "1'00\" / 2'06\"", "tall"], N.feet_inches)
    assert got == [[5.92], [5.92], [1.0, 2.5], [None]]
    assert column(spark, ["1,234.5lbs", "10.0lbs / 20.0lbs"], lambda c: N.unit_number(c, "lbs")) == [[1234.5], [10.0, 20.0]]


def test_int_or_raw_keeps_text(spark):
    assert column(spark, ["12", "—", "30 %", "007", "9" * 30], lambda c: N.int_or_raw(c)[0]) == [12, None, None, 7, None]


def test_gcd_against_math(spark):
    rng = random.Random(1)
    pairs = [(rng.randrange(10 ** 15), rng.randrange(10 ** 15)) for _ in range(100)] + [(0, 5), (5, 0), (0, 0), (8750, 1250)]
    # neighbouring Fibonacci numbers need the most steps
    a, b = 1, 1
    while b < 2 ** 62:
        a, b = b, a + b
    pairs.append((a, b))
    df = spark.createDataFrame(pairs, "a BIGINT, b BIGINT")
    assert [r[0] for r in df.select(N.gcd(C("a"), C("b"))).collect()] == [math.gcd(x, y) for x, y in pairs]


@pytest.mark.parametrize("male, female, want", [
    ("87.5", "12.5", "7:1"), ("50", "50", "1:1"), ("0", "100", "Always female"), ("100", "0", "Always male"), ("0", "0", "N/A"),
])
def test_gender_rate(spark, male, female, want):
    row = spark.range(1).select(N.gender_rate(F.lit(False), F.lit(male), F.lit(female))).first()
    assert row[0] == want
    assert spark.range(1).select(N.gender_rate(F.lit(True), F.lit(male), F.lit(female))).first()[0] == "N/A"


def test_region_suffix(spark):
    df = spark.createDataFrame([("0019", "Alolan Rattata"), ("0052", "Galarian Form"), ("0710", "Average Size"), ("0001", None)], "k STRING, f STRING")
    got = [tuple(r) for r in df.select(X.region_suffix(C("k"), C("f")), X.region_label(C("f"))).collect()]
    assert got == [("0019a", "Alolan Form"), ("0052g", "Galarian Form"), ("0710av", "Average Size"), ("0001", None)]


def test_segments_and_vectors(spark):
    cells = ["2 HP<br>1 Speed<br>", "<b>X</b><br>1 HP<br><b>Y</b><br>2 Attack<br>", "3 Sp. Defense<br><b>Z</b><br>1 Defense", "", None]
    got = column(spark, cells, lambda c: L.segments_to_map(c, "Normal"))
    assert got == [{"Normal": ["2 HP", "1 Speed"]}, {"X": ["1 HP"], "Y": ["2 Attack"]},
                   {"Normal": ["3 Sp. Defense"], "Z": ["1 Defense"]}, {}, None]
    vec = column(spark, ["2 HP|1 Sp. Attack|3 Anything"], lambda c: L.stat_vector(L.split_literal(c, "|")))
    assert vec == [[2, 0, 0, 1, 0, 3]]


def test_repeated_heading_keeps_the_last(spark):
    assert column(spark, ["<b>A</b><br>1 HP<br><b>A</b><br>2 HP"], L.segments_to_map) == [{"A": ["2 HP"]}]


def test_repeat_and_zip(spark):
    df = spark.createDataFrame([(["a", "b"], [3, 1], ["x"])], "a ARRAY<STRING>, n ARRAY<INT>, s ARRAY<STRING>")
    zipped, ok = L.zip_lists(a=C("a"), s=C("s"))
    row = df.select(L.repeat_items(C("a"), C("n")), zipped, ok).first()
    assert row[0] == ["a", "a", "a", "b"] and row[2] is False
    assert [tuple(x) for x in row[1]] == [("a", "x"), ("b", None)]


@pytest.mark.parametrize("base, href, want", [
    ("http://a.org/b/c?q#f", "d", "http://a.org/b/d"),
    ("http://a.org/b/c", "/d", "http://a.org/d"),
    ("http://a.org/b/c", "../d", "http://a.org/d"),
    ("http://a.org/b/c/", "./d/../e", "http://a.org/b/c/e"),
    ("http://a.org", "d", "http://a.org/d"),
    ("https://a.org/b", "//c.org/x", "https://c.org/x"),
    ("http://a.org/b?q=1#f", "?p=2", "http://a.org/b?p=2"),
    ("http://a.org/b?q=1#f", "#g", "http://a.org/b?q=1#g"),
    ("http://a.org/b?q=1#f", "", "http://a.org/b?q=1#f"),
    ("http://a.org/b", "http://c.org/", "http://c.org/"),
    ("http://a.org/b/c", "../../../d", "http://a.org/d"),
])
def test_resolve_like_urljoin(spark, base, href, want):
    from urllib.parse import urljoin

    assert spark.range(1).select(U.resolve_url(F.lit(base), F.lit(href))).first()[0] == want == urljoin(base, href)


def test_canonical_url_and_hosts(spark):
    def canon(u):
        return spark.range(1).select(U.canonical_url(F.lit(u))).first()[0]

    assert canon("HTTP://A.Org/x?b=2&a=1#top") == "http://a.org/x?a=1&b=2"
    assert canon("http://a.org") == canon("http://a.org/#x") == "http://a.org/"

    def ok(u):
        return spark.range(1).select(U.host_allowed(F.lit(u), ["a.org"])).first()[0]

    assert ok("http://www.a.org/x") and ok("http://user@a.org:80/") and not ok("http://ba.org/") and not ok("http://a.org.evil.net/")
