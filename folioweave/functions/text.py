"""String clean-up, slicing, casing, recoding and predicates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Everything that counts as blank at either end: ASCII blanks, the four separator
# controls, NEL, and Unicode separators (which include the no-break space).
BLANK = r"[\s\x1c-\x1f\x85\p{Z}]"


def strip(c: Column) -> Column:
    """Remove blanks (including no-break spaces) at both ends."""
    return F.regexp_replace(c, rf"\A{BLANK}+|{BLANK}+\z", "")


def drop_controls(c: Column) -> Column:
    """Remove CR, LF and TAB anywhere."""
    return F.translate(c, "\r\n\t", "")


def clean_ws(c: Column) -> Column:
    """Remove CR, LF and TAB anywhere, then strip both ends."""
    return strip(drop_controls(c))


def replace_all(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Literal replacements, applied in the order given."""
    for old, new in pairs:
        c = F.replace(c, F.lit(old), F.lit(new))
    return c


def zfill(c: Column, width: int) -> Column:
    """Left-pad with zeros to ``width``; longer values are kept whole."""
    return F.lpad(c, F.greatest(F.lit(width), F.length(c)), F.lit("0"))


def capitalize(c: Column) -> Column:
    """First character upper, the rest lower."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.lower(F.substr(c, F.lit(2))))


def upper_first(c: Column) -> Column:
    """First character upper, the rest untouched."""
    return F.concat(F.upper(F.left(c, F.lit(1))), F.substr(c, F.lit(2)))


def title(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter, lower-case the other letters."""
    runs = F.regexp_extract_all(c, F.lit(r"\p{L}+|[^\p{L}]+"), F.lit(0))
    return F.array_join(F.transform(runs, capitalize), "")


def py_slice(c: Column, start: int = 0, stop: int | None = None) -> Column:
    """Characters ``[start:stop]``; negative positions count from the end."""
    n = F.length(c)
    lo = F.lit(start) if start >= 0 else F.greatest(F.lit(0), n + F.lit(start))
    if stop is None:
        hi = n
    else:
        hi = F.lit(stop) if stop >= 0 else n + F.lit(stop)
    return F.substr(c, lo + F.lit(1), F.greatest(F.lit(0), hi - lo))


def rstrip_set(c: Column, chars: str) -> Column:
    """Remove any trailing characters that belong to ``chars``."""
    return F.rtrim(c, F.lit(chars))


def between_affixes(c: Column, prefix: str = "", suffix: str = "") -> Column:
    """Text left after cutting as many characters as ``prefix`` and ``suffix`` have."""
    return py_slice(c, len(prefix), -len(suffix) if suffix else None)


def strip_parens(c: Column) -> Column:
    """Delete every parenthesised note together with the blanks before it."""
    return F.regexp_replace(c, r"\s*\(.*?\)", "")


def matches_at_start(c: Column, pattern: str) -> Column:
    """True if ``pattern`` matches beginning at the first character."""
    return c.rlike(rf"\A(?:{pattern})")


def recode(c: Column, mapping: Mapping[str, str]) -> Column:
    """Swap listed values, keep all others."""
    out = None
    for old, new in mapping.items():
        hit = c == F.lit(old)
        out = F.when(hit, F.lit(new)) if out is None else out.when(hit, F.lit(new))
    return c if out is None else out.otherwise(c)


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def code_from_path(c: Column, prefix: str, suffix: str, case: str = "capitalize") -> Column:
    """Image or link path to a code word: cut the known prefix and suffix text, then case."""
    word = replace_all(c, [(prefix, ""), (suffix, "")])
    return {"capitalize": capitalize, "title": title, "none": lambda x: x}[case](word)


# Region words that get a one-letter key suffix.
REGION_SUFFIXES = {"Alolan": "a", "Galarian": "g", "Hisuian": "h", "Paldean": "p"}


def region_suffix(key: Column, form: Column) -> Column:
    """Key plus the region letter, or plus the first two letters of any other form."""
    tail = None
    for region, letter in REGION_SUFFIXES.items():
        hit = form.startswith(region)
        tail = F.when(hit, F.lit(letter)) if tail is None else tail.when(hit, F.lit(letter))
    return F.when(form.isNull(), key).otherwise(
        F.concat(key, tail.otherwise(F.lower(F.left(form, F.lit(2)))))
    )


def region_label(form: Column) -> Column:
    """Uniform '<Region> Form' label for regional forms, other labels unchanged."""
    out = None
    for region in REGION_SUFFIXES:
        hit = form.startswith(region)
        label = F.lit(f"{region} Form")
        out = F.when(hit, label) if out is None else out.when(hit, label)
    return out.otherwise(form)


def form_suffix(key: Column, form: Column) -> Column:
    """Key plus the first two letters of the form name, lower-cased."""
    return F.concat(key, F.lower(F.left(form, F.lit(2))))
