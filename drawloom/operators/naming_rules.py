"""Naming rules as data: each rule is one stage of a plan that fills a field of every system and carries along what went wrong."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawloom.functions.text import filled, no_leading_zeros
from drawloom.operators.naming import member_value, sequence


@dataclass(frozen=True)
class Link:
    """A table of its own that lists the values which pick a row: its rows of the same value (`on`) and the same or a blank unit, their lists together."""

    table: str
    on: str
    unit: str
    column: str


@dataclass(frozen=True)
class Scope:
    """Only keys count that the table has for the value of a field: rows where `key` is that field, their `column`."""

    table: str
    key: str
    column: str
    field: str


@dataclass(frozen=True)
class Rule:
    """How a field is found. Of several rules for one field the first that gives a value counts.

    source: member (most frequent value of members' `column`), lookup (the one value of `column` in the table's rows of the keys), select (the one row
    left of them), column (`column` of the row that select chose for the field `keys[0]`), const, anchor, sequence (number within the fields `keys`).
    keys: fields whose values are the table's columns `on`. match, match_column or link: the field that a row must list. prefer: pairs (field or
    "service", column) that decide between rows while several are left. label: what a candidate is called.
    """

    name: str
    source: str
    keys: tuple[str, ...] = ()
    table: str = ""
    on: tuple[str, ...] = ()
    column: str = ""
    value: str = ""
    match: str = ""
    match_column: str = ""
    link: Link | None = None
    scope: Scope | None = None
    prefer: tuple[tuple[str, str], ...] = ()
    label: str = ""
    width: int = field(default=3)


def issues(rules: list[Rule], tables: dict[str, list[str]], members: list[str]) -> list[str]:
    """What is wrong with the rules before any data is read: unknown sources, tables and columns, fields used before they are found. tables: their columns."""
    out, known = [], set()
    for r in rules:
        say = lambda x, r=r: out.append(f"{r.name}: {x}")
        if r.source not in ("member", "lookup", "select", "column", "const", "anchor", "sequence"):
            say(f"unknown source {r.source}")
        if r.source == "member" and r.column not in members:
            say(f"members have no {r.column}")
        for k in [*r.keys, *([r.match] if r.match else []), *([r.scope.field] if r.scope else [])]:
            if k not in known:
                say(f"{k} is not found before it")
        if r.source in ("lookup", "select"):
            for t, columns in ((r.table, [*r.on, r.column, *([r.match_column] if r.match_column else []), *(c for _, c in r.prefer)]), *([(r.link.table, [r.link.on, r.link.unit, r.link.column])] if r.link else []), *([(r.scope.table, [r.scope.key, r.scope.column])] if r.scope else [])):
                if t not in tables:
                    say(f"unknown table {t}")
                else:
                    out += [f"{r.name}: {t} has no column {c}" for c in columns if c and c not in tables[t]]
            if len(r.on) != len(r.keys):
                say("as many columns as keys are needed")
        known.add(r.name)
    return out


def _key(c: Column) -> Column:
    return no_leading_zeros(c.cast("string"))


def _listed(c: Column) -> Column:
    return F.array_remove(F.transform(F.split(F.coalesce(c.cast("string"), F.lit("")), "[,;]"), lambda x: _key(x)), "")


def _words(c: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.upper(F.coalesce(c, F.lit(""))), F.lit("([A-Z0-9]+)"), 1))


def _given(name: str) -> Column:
    return F.col(f"f_{name}").isNotNull()


def _put(state: DataFrame, rule: Rule, value: Column, problem: Column, candidates: Column | None = None, row: Column | None = None) -> DataFrame:
    """The rule's outcome where the field has no value yet: a value clears what earlier rules complained of."""
    f, p, c, done = f"f_{rule.name}", f"p_{rule.name}", f"c_{rule.name}", _given(rule.name)
    value = filled(value.cast("string"))
    told = F.when(problem.isNotNull(), F.concat(p, F.array(problem))).otherwise(F.col(p))
    none = F.array().cast("array<string>")
    cols = {
        f: F.when(done, F.col(f)).otherwise(value),
        p: F.when(done | value.isNotNull(), none).otherwise(told),
        c: F.when(done | value.isNotNull(), none).when(F.size(cand := F.coalesce(candidates if candidates is not None else none, none)) > 0, cand).otherwise(F.col(c)),
    }
    if row is not None:
        cols[f"r_{rule.name}"] = F.when(done, F.col(f"r_{rule.name}")).otherwise(row)
    return state.withColumns(cols)


def _with_rows(state: DataFrame, rule: Rule, rows: DataFrame) -> DataFrame:
    """state with the array `_rows` of what rows has for the rule's keys; rows: columns k0, k1, ... and x."""
    keys = [f"k{i}" for i in range(len(rule.keys))]
    if not keys:
        return state.join(rows.agg(F.collect_list("x").alias("_rows")), F.lit(True), "left")
    by = rows.groupBy(*keys).agg(F.collect_list("x").alias("_rows"))
    return state.withColumns({k: _key(F.col(f"f_{f}")) for k, f in zip(keys, rule.keys)}).join(by, keys, "left").drop(*keys)


def _what(rule: Rule) -> Column:
    return F.concat(F.lit(" for " + "/".join(rule.keys) + " "), F.concat_ws("/", *[F.col(f"f_{k}") for k in rule.keys])) if rule.keys else F.lit("")


def _lookup(state: DataFrame, rule: Rule, tables: dict[str, DataFrame]) -> DataFrame:
    t = tables[rule.table]
    rows = t.select(*[_key(F.col(c)).alias(f"k{i}") for i, c in enumerate(rule.on)], F.coalesce(F.col(rule.column).cast("string"), F.lit("")).alias("x"))
    s = _with_rows(state, rule, rows.distinct())
    found = F.array_sort(F.array_remove(F.coalesce("_rows", F.array().cast("array<string>")), ""))
    asked = _all_given(rule.keys)
    problem = F.when(~asked, F.lit(None)).when(F.col("_rows").isNull(), F.concat(F.lit(f"{rule.table} has no row"), _what(rule))).when(F.size(found) > 1, F.concat(F.lit(f"{rule.table} has {rule.column} more than once"), _what(rule))).when(F.size(found) == 0, F.concat(F.lit(f"{rule.table} has no {rule.column}"), _what(rule)))
    return _put(s, rule, F.when(asked & (F.size(found) == 1), F.get(found, F.lit(0))), problem, F.when(asked & (F.size(found) > 1), found)).drop("_rows")


def _all_given(names) -> Column:
    out = F.lit(True)
    for n in names:
        out = out & _given(n)
    return out


def _listing(t: DataFrame, rule: Rule, tables: dict[str, DataFrame]) -> DataFrame:
    """The table with `_list`, the values that pick a row."""
    if not rule.match or not (rule.link or rule.match_column):
        return t.withColumn("_list", F.array().cast("array<string>"))
    if not rule.link:
        return t.withColumn("_list", _listed(F.col(rule.match_column)))
    m = tables[rule.link.table].select(_key(F.col(rule.link.on)).alias("_on"), _key(F.col(rule.link.unit)).alias("_unit"), _listed(F.col(rule.link.column)).alias("_items"))
    # a blank unit links the value everywhere
    by = m.groupBy("_on", F.coalesce("_unit", F.lit("")).alias("_unit")).agg(F.array_distinct(F.flatten(F.collect_list("_items"))).alias("_items"))
    every, own = by.where("_unit = ''").select("_on", F.col("_items").alias("_e")), by.where("_unit <> ''").select("_on", "_unit", F.col("_items").alias("_o"))
    x = t.withColumns({"_on": _key(F.col(rule.column)), "_unit": _key(F.col(rule.on[0]))}).join(every, "_on", "left").join(own, ["_on", "_unit"], "left")
    none = F.array().cast("array<string>")
    return x.withColumn("_list", F.array_union(F.coalesce("_e", none), F.coalesce("_o", none))).drop("_on", "_unit", "_e", "_o")


def _select(state: DataFrame, rule: Rule, tables: dict[str, DataFrame]) -> DataFrame:
    t = tables[rule.table]
    cells = F.create_map(*[x for c in t.columns for x in (F.lit(c), F.col(c).cast("string"))])
    keys = [_key(F.col(c)).alias(f"k{i}") for i, c in enumerate(rule.on)]
    label = F.coalesce(F.col(rule.label or rule.column).cast("string"), F.lit(""))
    scope_key = _key(F.col(rule.on[0])) if rule.on else F.lit(None).cast("string")
    s = _with_rows(state, rule, _listing(t, rule, tables).select(*keys, F.struct(cells.alias("cells"), F.col("_list").alias("list"), label.alias("label"), scope_key.alias("first")).alias("x")))
    s = s.withColumn("_rows", F.coalesce("_rows", F.array().cast(s.schema["_rows"].dataType)))
    needs = [*rule.keys, *([rule.match] if rule.match else []), *([rule.scope.field] if rule.scope else [])]
    asked = _all_given(needs)
    s = s.withColumn("_ok", F.col("_rows"))
    if rule.scope:
        allowed = tables[rule.scope.table].groupBy(_key(F.col(rule.scope.key)).alias("_scope")).agg(F.collect_set(_key(F.col(rule.scope.column))).alias("_in"))
        s = s.withColumn("_scope", _key(F.col(f"f_{rule.scope.field}"))).join(allowed, "_scope", "left").drop("_scope")
        s = s.withColumn("_ok", F.filter("_rows", lambda x: F.coalesce(F.array_contains("_in", x["first"]), F.lit(False)))).drop("_in")
    if rule.match:
        want = _key(F.col(f"f_{rule.match}"))
        s = s.withColumn("_hits", F.filter("_ok", lambda x: F.coalesce(F.array_contains(x["list"], want), F.lit(False))))
        if rule.keys:  # the only row, if it lists nothing
            s = s.withColumn("_hits", F.when((F.size("_hits") == 0) & (F.size("_ok") == 1) & (F.size(F.get("_ok", F.lit(0))["list"]) == 0), F.col("_ok")).otherwise(F.col("_hits")))
    else:
        s = s.withColumn("_hits", F.when(F.size("_ok") == 1, F.col("_ok")).otherwise(F.slice("_ok", 1, 0)))
    for name, column in rule.prefer:
        s = s.withColumn("_hits", F.when(F.size("_hits") < 2, F.col("_hits")).otherwise(_preferred(name, column)))
    n, one = F.size("_hits"), F.get("_hits", F.lit(0))
    problem = F.when(~asked | (n == 1), F.lit(None)).when(F.size("_rows") == 0, F.concat(F.lit(f"{rule.table} allows nothing"), _what(rule)))
    if rule.scope:
        problem = problem.when(F.size("_ok") == 0, F.concat(F.lit(f"{rule.scope.table} gives {rule.scope.field} "), f"f_{rule.scope.field}", F.lit(f" no row of {rule.table}"), _what(rule)))
    problem = problem.when(n > 1, F.concat(F.lit(f"{rule.table} has several rows that fit"), _what(rule))).otherwise(F.concat(F.lit(f"{rule.table} has no row that fits"), _what(rule)))
    labels = F.array_sort(F.array_distinct(F.transform(F.when(n > 1, F.col("_hits")).otherwise(F.col("_ok")), lambda x: x["label"])))
    candidates = F.when(asked & (n != 1) & (F.lit(bool(rule.keys)) | (n > 1)), labels)
    row = F.when(asked & (n == 1), one["cells"])
    return _put(s, rule, row[rule.column], problem, candidates, row).drop("_rows", "_ok", "_hits")


def _preferred(name: str, column: str) -> Column:
    """Of the rows in _hits those that the tie-breaker is for; all, if it is for none."""
    if name != "service":
        same = F.filter("_hits", lambda x: F.coalesce(_key(x["cells"][column]) == _key(F.col(f"f_{name}")), F.lit(False)))
        return F.when(F.size(same) > 0, same).otherwise(F.col("_hits"))
    all_words = F.transform("_hits", lambda x: _words(x["cells"][column]))
    common = F.aggregate(all_words, F.get(all_words, F.lit(0)), lambda a, w: F.array_intersect(a, w))
    scored = F.transform("_hits", lambda x: F.struct(F.size(F.filter("_texts", lambda w: F.arrays_overlap(w, F.array_except(_words(x["cells"][column]), common)))).alias("score"), x.alias("x")))
    best = F.array_max(F.transform(scored, lambda x: x["score"]))
    return F.when(best > 0, F.transform(F.filter(scored, lambda x: x["score"] == best), lambda x: x["x"])).otherwise(F.col("_hits"))


def resolve_fields(systems: DataFrame, members: DataFrame, tables: dict[str, DataFrame], rules: list[Rule], texts: DataFrame | None = None, system: str = "system", anchor: str = "anchor") -> DataFrame:
    """One row per system: system, anchor, a column for each field, problems and candidates (map of field and labels).

    members: system and the columns that member rules name; texts: system, text. Where a key of a rule has no value the rule says nothing, since
    the key's own rule has told. Keys ignore leading zeros and case. The rows of a reference table for one key are taken together, so they
    have to be reference data in size; systems, members and texts may be of any size.
    """
    names = list(dict.fromkeys(r.name for r in rules))
    none = F.array().cast("array<string>")
    state = systems.select(F.col(system), F.col(anchor), *[x for n in names for x in (F.lit(None).cast("string").alias(f"f_{n}"), none.alias(f"p_{n}"), none.alias(f"c_{n}"), F.lit(None).cast("map<string,string>").alias(f"r_{n}"))])
    if texts is not None:
        said = texts.where(F.col("text").isNotNull()).groupBy(system).agg(F.collect_list(_words(F.col("text"))).alias("_texts"))
        state = state.join(said, system, "left")
    state = state.withColumn("_texts", F.coalesce("_texts", F.array().cast("array<array<string>>")) if texts is not None else F.array().cast("array<array<string>>"))
    numbered = []
    for r in rules:
        nothing = F.lit(None).cast("string")
        if r.source == "member":
            most = member_value(members, system, r.column).select(system, F.col(r.column).cast("string").alias("_v"))
            state = _put(state.join(most, system, "left"), r, F.col("_v"), F.when(F.col("_v").isNull(), F.lit(f"no member has {r.column}"))).drop("_v")
        elif r.source == "lookup":
            state = _lookup(state, r, tables)
        elif r.source == "select":
            state = _select(state, r, tables)
        elif r.source == "column":
            state = _put(state, r, F.col(f"r_{r.keys[0]}")[r.column], nothing)
        elif r.source == "const":
            state = _put(state, r, F.lit(r.value), nothing)
        elif r.source == "anchor":
            state = _put(state, r, F.col(anchor), nothing)
        else:
            numbered.append(r)
    for r in numbered:  # once all scopes are known
        counted = sequence(state.select(system, anchor, *[f"f_{k}" for k in r.keys]), [f"f_{k}" for k in r.keys] or [F.lit(1)], anchor, system, r.width, "_v").select(system, "_v")
        state = _put(state.join(counted, system, "left"), r, F.col("_v"), F.lit(None).cast("string")).drop("_v")
    told = F.flatten(F.array(*[F.col(f"p_{n}") for n in names]))
    open_ = F.map_filter(F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[F.col(f"c_{n}") for n in names])), lambda _, v: F.size(v) > 0)
    return state.select(system, anchor, *[F.col(f"f_{n}").alias(n) for n in names], told.alias("problems"), open_.alias("candidates"))
