"""Column expressions on text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def blank(c: Column) -> Column:
    """Null, or nothing but white space."""
    return c.isNull() | (F.trim(c.cast("string")) == "")


def filled(c: Column) -> Column:
    """The value, null where blank."""
    return F.when(~blank(c), c)


def full_match(c: Column, pattern: str) -> Column:
    return c.rlike(rf"\A(?:{pattern})\z")


def part(c: Column, separator: str, i: int) -> Column:
    """The i-th part from 0, trimmed; null where there is none or it is blank."""
    return filled(F.trim(F.try_element_at(F.split(c, F.lit(rf"\Q{separator}\E")), F.lit(i + 1))))


def template(text: str, columns: list[str]) -> Column:
    """The text with {column} replaced by the value, ? for null and for names that are no column."""
    import re

    pieces, at = [], 0
    for m in re.finditer(r"\{(\w+)\}", text):
        pieces += [F.lit(text[at : m.start()]), F.coalesce(F.col(m[1]).cast("string"), F.lit("?")) if m[1] in columns else F.lit("?")]
        at = m.end()
    return F.concat(*pieces, F.lit(text[at:])) if pieces else F.lit(text)


def normal_label(c: Column) -> Column:
    """CamelCase split, lower case, runs of other signs as one blank."""
    split = F.regexp_replace(c, r"(?<=[a-z0-9])(?=[A-Z])", " ")
    return F.trim(F.regexp_replace(F.lower(split), r"[^a-z0-9]+", " "))


def no_leading_zeros(c: Column) -> Column:
    """Key form of a code: trimmed, upper case, leading zeros of a number dropped."""
    return F.regexp_replace(F.upper(F.trim(c)), r"^0+(?=\d+$)", "")


def first_date(c: Column, formats: list[str]) -> Column:
    """The date by the first format that parses; null if none does."""
    return F.coalesce(*[F.try_to_date(F.trim(c), f) for f in formats])


def content_hash(c: Column, bits: int = 256) -> Column:
    if bits not in (224, 256, 384, 512):
        raise ValueError(f"no SHA-2 of {bits} bits")
    return F.concat(F.lit(f"sha{bits}:"), F.sha2(c, bits))


def row_hash(*columns: Column) -> Column:
    """A hash of the values in order, null as empty text; equal rows have equal hashes."""
    return F.sha2(F.to_json(F.array(*[F.coalesce(c.cast("string"), F.lit("")) for c in columns])), 256)
