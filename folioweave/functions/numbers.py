"""Numbers out of scraped text. Nothing here throws: bad text becomes NULL."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from folioweave.functions.lists import let


def to_int(c: Column) -> Column:
    return c.try_cast("int")


def to_double(c: Column) -> Column:
    return c.try_cast("double")


def bad_number(raw: Column, parsed: Column) -> Column:
    """True where text was present but did not parse."""
    return raw.isNotNull() & parsed.isNull()


def int_or_raw(c: Column) -> tuple[Column, Column]:
    """(INT, raw text): the number where the text is all digits, and the text itself."""
    return F.when(c.rlike(r"\A[0-9]+\z"), c.try_cast("int")), c


def to_numeric(c: Column) -> Column:
    """Whole-column coercion to DOUBLE, anything unparsable to NULL."""
    return c.try_cast("double")


def feet_inches(c: Column) -> Column:
    """``5'11"`` (straight or curly marks, alternates split by ' / ') to an array of feet."""
    one = r"^\s*(\d+)['’](\d+)"

    def parse(x: Column) -> Column:
        ft = F.regexp_extract(x, one, 1).try_cast("double")
        inch = F.regexp_extract(x, one, 2).try_cast("double")
        return F.round(ft + inch / F.lit(12), 2)

    return F.transform(F.split(c, " / "), parse)


def unit_number(c: Column, unit: str) -> Column:
    """``1,234.5lbs`` (alternates split by ' / ') to an array of DOUBLE."""
    bare = F.replace(F.replace(c, F.lit(","), F.lit("")), F.lit(unit), F.lit(""))
    return F.transform(F.split(bare, " / "), lambda x: x.try_cast("double"))


def gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor of two BIGINTs: Euclid's steps over a constant range.

    92 steps cover every pair of 64-bit numbers; finished pairs just carry on unchanged. Most pairs are done after 8, and
    only the others take the remaining 84.
    """
    start = F.struct(F.abs(a).cast("bigint").alias("x"), F.abs(b).cast("bigint").alias("y"))

    def step(acc: Column, _: Column) -> Column:
        live = acc["y"] != 0
        return F.struct(
            F.when(live, acc["y"]).otherwise(acc["x"]).alias("x"),
            F.when(live, acc["x"] % acc["y"]).otherwise(acc["y"]).alias("y"),
        )

    def steps(pair: Column, n: int) -> Column:
        return F.aggregate(F.array(*[F.lit(i) for i in range(n)]), pair, step)

    return let(steps(start, 8), lambda s: F.when(s["y"] == 0, s["x"]).otherwise(steps(s, 84)["x"]))


def reduce_ratio(a: Column, b: Column) -> Column:
    """``'p:q'`` for 100*a and 100*b, cut to whole numbers and divided by their gcd."""
    p = (a * F.lit(100)).cast("bigint")
    q = (b * F.lit(100)).cast("bigint")
    return let(F.struct(p.alias("p"), q.alias("q"), gcd(p, q).alias("g")), lambda r: F.when(
        r["g"] > 0,
        F.concat(F.call_function("div", r["p"], r["g"]).cast("string"), F.lit(":"), F.call_function("div", r["q"], r["g"]).cast("string")),
    ))


def gender_rate(unknown: Column, male: Column, female: Column, zero_zero: str = "N/A") -> Column:
    """Ratio category from two percentage texts and a 'no ratio' flag."""
    m, f = to_double(male), to_double(female)
    return (
        F.when(unknown, F.lit("N/A"))
        .when((male == "0") & (female == "0"), F.lit(zero_zero))
        .when(male == "0", F.lit("Always female"))
        .when(female == "0", F.lit("Always male"))
        .otherwise(reduce_ratio(m, f))
    )
