"""Tagging conventions as data: one table of fields, compiled into column expressions that compose tags and take them apart."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawloom.operators.tags import Field, compose

#: Columns of a convention: template and group number the groups of a tag, place orders the fields in a group; width is that of a field of fixed
#: width, else null; pattern says what its text may be (null: anything but separators and brackets).
CONVENTION = "template string, group int, place int, field string, prefix string, suffix string, width int, pattern string, required boolean"
#: Fields of a dash-separated convention (PG-1415109, 36"-PG-1415109-D341H-H).
DASHED = [
    ("item", 0, 0, "fluid", "", "", None, "[A-Z]+", True), ("item", 1, 0, "unit", "", "", 2, r"\d", True), ("item", 1, 1, "sequence", "", "", 3, r"\d", True), ("item", 1, 2, "subline", "", "", None, r"\d+", False),
    ("segment", 0, 0, "diameter", "", "", None, r'\d+(?:/\d+)?"', False), ("segment", 1, 0, "fluid", "", "", None, "[A-Z]+", True),
    ("segment", 2, 0, "unit", "", "", 2, r"\d", True), ("segment", 2, 1, "sequence", "", "", 3, r"\d", True), ("segment", 2, 2, "subline", "", "", None, r"\d+", False),
    ("segment", 3, 0, "piping_class", "", "", None, r"[A-Z]\d[A-Z0-9]*", False), ("segment", 4, 0, "insul_purpose", "", "", None, "[A-Z]+", False),
]
#: Fields of a packed convention (LS362920131, AG362090006-44"(1C6AS)-S(45)(40)).
PACKED = [
    ("item", 0, 0, "fluid", "", "", None, "[A-Z]+", True), ("item", 0, 1, "system", "", "", 2, r"\d", True), ("item", 0, 2, "unit", "", "", 2, r"\d", True), ("item", 0, 3, "sequence", "", "", None, r"\d+", True),
    ("segment", 0, 0, "fluid", "", "", None, "[A-Z]+", True), ("segment", 0, 1, "system", "", "", 2, r"\d", True), ("segment", 0, 2, "unit", "", "", 2, r"\d", True), ("segment", 0, 3, "sequence", "", "", None, r"\d+", True),
    ("segment", 1, 0, "diameter", "", "", None, r'\d+(?:/\d+)?"', True), ("segment", 1, 1, "piping_class", "(", ")", None, None, False),
    ("segment", 2, 0, "insul_type", "", "", None, "[A-Z]+", False), ("segment", 2, 1, "insul_purpose", "(", ")", None, None, False), ("segment", 2, 2, "insul_thick", "(", ")", None, None, False),
]


def load(table: DataFrame) -> dict[str, list[list[tuple]]]:
    """The templates of a convention table: groups of fields in order. A convention is a few rows of settings."""
    out: dict = {}
    for r in sorted(map(tuple, table.select(*[c.split()[0] for c in CONVENTION.split(", ")]).collect()), key=lambda r: r[:3]):
        out.setdefault(r[0], {}).setdefault(r[1], []).append(r)
    return {name: [groups[g] for g in sorted(groups)] for name, groups in out.items()}


def _groups(template: list[list[tuple]]) -> list[list[Field]]:
    return [[Field(f[3], f[4] or "", f[5] or "", bool(f[8])) for f in group] for group in template]


def _field(f: tuple) -> str:
    _, _, _, _, prefix, suffix, width, pattern, required = f
    text = pattern or r"[^()\-]+"
    text = f"(?:{text}){{{width}}}" if width else text
    one = f"{re.escape(prefix or '')}({text}){re.escape(suffix or '')}"
    return one if required else f"(?:{one})?"


def pattern_of(template: list[list[tuple]], separator: str = "-") -> str:
    """The regular expression of a template's tags, a capture for each field. An optional group is there with its separator or not at all."""
    dash, parts, started = re.escape(separator), [], False
    for n, group in enumerate(template):
        needed = any(f[8] for f in group)
        body = "".join(map(_field, group))
        if not needed:
            # not empty, since an empty group drops with its separator
            body = f"(?={'|'.join(re.escape(f[4]) if f[4] else '(?:' + (f[7] or r'[^()-]') + ')' for f in group)}){body}"
        if not started and not needed and any(f[8] for g in template[n + 1 :] for f in g):
            parts.append(f"(?:{body}{dash})?")
            continue
        lead = dash if started else ""
        parts.append(f"{lead}{body}" if needed else f"(?:{lead}{body})?")
        started = True
    return r"\A" + "".join(parts) + r"\z"


def compose_tag(template: list[list[tuple]], fields: dict[str, Column], separator: str = "-") -> Column:
    """The tag; null if a required field is blank, a field has another width than its own or a text that its pattern does not allow."""
    fits, fields = [], {k: F.trim(v.cast("string")) for k, v in fields.items()}
    for group in template:
        for f in group:
            c = fields.get(f[3], F.lit(None).cast("string"))
            text = f[7] or r"[^()\-]+"
            text = f"(?:{text}){{{f[6]}}}" if f[6] else text
            fits.append(F.coalesce(c == "", F.lit(True)) | c.rlike(rf"\A{text}\z"))
    ok = F.lit(True)
    for x in fits:
        ok = ok & x
    return F.when(ok, compose(_groups(template), fields, separator))


def decode_tag(template: list[list[tuple]], tag: Column, separator: str = "-") -> Column:
    """struct of the fields in the order of the template, null where one is not there; null as a whole if the tag does not follow the template."""
    pattern, names = pattern_of(template, separator), [f[3] for g in template for f in g]
    text = F.trim(tag)
    return F.when(text.rlike(pattern), F.struct(*[F.nullif(F.regexp_extract(text, pattern, i + 1), F.lit("")).alias(n) for i, n in enumerate(names)]))
