"""Business tags: decoding and composition as column expressions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from drawloom.functions.text import filled


@dataclass(frozen=True)
class Field:
    name: str
    prefix: str = ""
    suffix: str = ""
    required: bool = False


def compose(groups: list[list[Field]], fields: dict[str, Column], separator: str = "-") -> Column:
    """Groups of fields joined by the separator; an empty group drops with its separator; null if a required field is blank or nothing is left."""
    parts, missing = [], F.lit(False)
    for group in groups:
        texts = []
        for f in group:
            v = filled(fields.get(f.name, F.lit(None)).cast("string"))
            texts.append(F.coalesce(F.concat(F.lit(f.prefix), v, F.lit(f.suffix)), F.lit("")))
            if f.required:
                missing = missing | v.isNull()
        parts.append(F.nullif(F.concat(*texts), F.lit("")))
    text = F.concat_ws(separator, *parts)
    return F.when(~missing & (text != ""), text)


def missing_fields(groups: list[list[Field]], fields: dict[str, Column]) -> Column:
    """Names of required fields without value."""
    names = [F.when(filled(fields.get(f.name, F.lit(None)).cast("string")).isNull(), F.lit(f.name)) for g in groups for f in g if f.required]
    return F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")


def decode(
    tag: Column, fluid: Column, unit_digits: int = 2, sequence_digits: int = 3, system_digits: int = 0, suffix: Column | str | None = None, separator: str = "-", unit_codes: list[str] | None = None,
) -> Column:
    """struct(system, unit, sequence, unit_known) of an item tag: what follows the first separator, or the fluid code where there is none.

    The suffix (of all rows or a column) is cut; null unless digits of at least
    the needed length are left. unit_known: whether unit_codes has the unit (false without codes).
    """
    need, s, u = system_digits + unit_digits + sequence_digits, system_digits, unit_digits
    end = F.lit(suffix) if isinstance(suffix, str) else suffix if suffix is None else F.coalesce(suffix, F.lit(""))

    def after(tag: Column) -> Column:
        at = F.instr(tag, separator)
        return F.when(at > 0, F.substr(tag, at + len(separator))).when(F.startswith(tag, fluid), F.substr(tag, F.length(fluid) + 1)).otherwise(tag)

    def core(text: Column) -> Column:
        return text if end is None else F.when(F.endswith(text, end), F.substr(text, F.lit(1), F.length(text) - F.length(end))).otherwise(text)

    def parts(core: Column) -> Column:
        ok = core.rlike(r"\A[0-9]+\z") & (F.length(core) >= need)
        unit = F.substr(core, F.lit(s + 1), F.lit(u))
        known = unit.isin(unit_codes) if unit_codes else F.lit(False)
        return F.when(ok, F.struct(F.nullif(F.substr(core, F.lit(1), F.lit(s)), F.lit("")).alias("system"), unit.alias("unit"), F.substr(core, F.lit(s + u + 1), F.lit(sequence_digits)).alias("sequence"), known.alias("unit_known")))

    return _once(_once(_once(tag, after), core), parts)


def _once(value: Column, f) -> Column:
    """f(value) with the value worked out once for each row, however often f names it."""
    return F.element_at(F.transform(F.array(value), f), 1)
