"""Declarative data quality: a suite of expectations as data, compiled to one plan."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawloom.functions.text import blank, full_match, template
from drawloom.tables import cut, drop, scratch

RANK = {"clean": 0, "flag": 1, "quarantine": 2, "drop": 3, "fail": 4}
STATE = {0: "clean", 1: "flagged", 2: "quarantined", 3: "dropped", 4: "failed"}


@dataclass(frozen=True)
class Expectation:
    id: str
    table: str
    kind: str
    gate: str = "flag"
    severity: str = "warn"
    detail: str = ""
    column: str | None = None
    columns: tuple[str, ...] = ()
    scope: tuple[str, ...] = ()
    ref: str | None = None  # name of a reference set or pattern
    where: tuple[str, str, str] | None = None


@dataclass(frozen=True)
class Subject:
    """A table with the columns that identify its rows."""

    rows: DataFrame
    id: str
    kind: str
    keep: tuple[str, ...] = field(default=())  # columns that details may name, if not all


def uncomposable(tag: Column) -> Column:
    """Not a line tag: blank, with white space inside, ending in - , or /, or without a run of three digits; outer white space does not count."""
    tag = F.regexp_replace(tag, r"^\s+|\s+$", "")
    return blank(tag) | tag.rlike(r"\s") | tag.rlike(r"[-,/]$") | ~tag.rlike(r"[0-9]{3,}")


def where(df: DataFrame, w: tuple[str, str, str] | None) -> DataFrame:
    """Rows by (column, eq|neq|contains, value); null is not equal to any value and contains none."""
    if w is None:
        return df
    c, op, v = F.col(w[0]).cast("string"), w[1], w[2]
    if op == "eq":
        return df.where(c == v)
    if op == "neq":
        return df.where(~c.eqNullSafe(F.lit(v)))
    if op == "contains":
        return df.where(c.contains(v))
    raise ValueError(f"unknown filter {op}")


def _chain(columns: tuple[str, ...]) -> Column:
    """A parent that is not contained in its child; child first."""
    broken = F.lit(False)
    for child, parent in zip(columns, columns[1:]):
        broken = broken | (~blank(F.col(child)) & ~blank(F.col(parent)) & ~F.contains(F.col(child), F.col(parent)))
    return broken


def violations(e: Expectation, s: Subject, refs: dict, edges: DataFrame | None = None, decode=None) -> DataFrame | None:
    """The rows of s.rows that break e, with n and attrs where the detail may name them; None if the reference is missing."""
    rows, c = where(s.rows, e.where), F.col(e.column) if e.column else None
    if e.kind == "not_null":
        return rows.where(blank(c))
    if e.kind == "all_null":
        bad = F.lit(True)
        for x in e.columns:
            bad = bad & blank(F.col(x))
        return rows.where(bad)
    if e.kind == "uncomposable_tag":
        return rows.where(uncomposable(c))
    if e.kind == "in_set":
        if refs.get(e.ref) is None:
            return None
        ok = refs[e.ref].select(F.col(refs[e.ref].columns[0]).cast("string").alias("_ok")).distinct()
        return rows.where(~blank(c)).join(ok, c.cast("string") == F.col("_ok"), "left_anti")
    if e.kind == "match_regex":
        if refs.get(e.ref) is None:
            return None
        return rows.where(~blank(c) & ~full_match(c, refs[e.ref]))
    if e.kind == "prefix_chain":
        return rows.where(_chain(e.columns))
    if e.kind == "roundtrip":
        return rows.where(~blank(c) & decode(c).isNull())
    if e.kind == "unique_anchor":
        many = rows.where(~blank(c)).groupBy(*e.scope, e.column).agg(F.countDistinct(s.id).alias("n")).where("n > 1")
        return rows.join(many, [*e.scope, e.column])
    if e.kind == "line_attr_inconsistent":
        sets = rows.where(~blank(c)).groupBy(*e.scope, e.column).agg(*[F.size(F.collect_set(F.when(~blank(F.col(a)), F.col(a)))).alias(f"_{a}") for a in e.columns])
        names = F.concat_ws(", ", *[F.when(F.col(f"_{a}") > 1, F.lit(a)) for a in e.columns])
        bad = sets.select(*e.scope, e.column, names.alias("attrs")).where("attrs <> ''")
        return rows.join(bad, [*e.scope, e.column])
    if e.kind == "orphan_node":
        if edges is None:
            return None
        ends = edges.select(F.col(edges.columns[0]).alias("_end")).union(edges.select(edges.columns[1])).distinct()
        return rows.join(ends, F.col(s.id) == F.col("_end"), "left_anti")
    if e.kind == "null_flag":
        return rows.where(c.isNull())
    if e.kind == "confined":
        here = [x for x in e.columns if x in rows.columns]
        bad = F.lit(False)
        for x in here:
            bad = bad | F.col(x).isNotNull()
        return rows.where(bad)
    raise ValueError(f"unknown expectation {e.kind}")


def evaluate(suite: list[Expectation], subjects: dict[str, Subject], refs: dict, edges: DataFrame | None = None, decode=None) -> tuple[DataFrame, DataFrame, list[str]]:
    """(marks, summary, skipped): a row per expectation and object that breaks it; per expectation evaluated rows, violations, ledger rows, and the mass-failure warning."""
    marks, skipped, spark = None, [], next(iter(subjects.values())).rows.sparkSession
    totals = None
    for e in suite:
        s = subjects.get(e.table)
        bad = None if s is None else violations(e, s, refs, edges, decode)
        if bad is None:
            skipped.append(e.id)
            continue
        group = [*e.scope, e.column] if e.kind in ("unique_anchor", "line_attr_inconsistent") else [s.id]
        m = bad.select(
            F.lit(e.id).alias("flag"), F.lit(e.table).alias("table"), F.lit(s.kind).alias("object_kind"), F.col(s.id).cast("string").alias("object_id"), F.lit(e.gate).alias("gate"), F.lit(RANK[e.gate]).alias("rank"),
            F.lit(e.severity).alias("severity"), F.concat_ws("|", *[F.coalesce(F.col(g).cast("string"), F.lit("")) for g in group]).alias("ledger_key"), template(e.detail, bad.columns).alias("detail"),
        )
        n = where(s.rows, e.where).agg(F.lit(e.id).alias("flag"), F.count("*").alias("n_evaluated"))
        marks = m if marks is None else marks.unionByName(m)
        totals = n if totals is None else totals.unionByName(n)
    if marks is None:
        empty = spark.createDataFrame([], "flag string, table string, object_kind string, object_id string, gate string, rank int, severity string, ledger_key string, detail string")
        return empty, spark.createDataFrame([], "flag string, n_evaluated long, n_objects long, n_ledger long, mass_failure boolean"), skipped
    found = marks.groupBy("flag").agg(F.countDistinct("object_id").alias("n_objects"), F.countDistinct("ledger_key").alias("n_ledger"), F.first("gate").alias("gate"), F.first("severity").alias("severity"))
    summary = totals.join(found, "flag", "left").select("flag", "n_evaluated", F.coalesce("n_objects", F.lit(0)).cast("long").alias("n_objects"), F.coalesce("n_ledger", F.lit(0)).cast("long").alias("n_ledger"), mass_failure(F.col("gate"), F.col("severity"), F.col("n_evaluated"), F.col("n_objects")).alias("mass_failure"))
    return marks, summary, skipped


def mass_failure(gate: Column, severity: Column, evaluated: Column, found: Column) -> Column:
    """Over half of at least 20 rows break it, and it is neither a hard failure nor a note."""
    return F.coalesce((gate != "fail") & (severity != "info") & (evaluated >= 20) & (found / evaluated > 0.5), F.lit(False))


def ledger(marks: DataFrame) -> DataFrame:
    """One row per expectation and object, or per anchor where the expectation is on anchors."""
    w = Window.partitionBy("flag", "ledger_key").orderBy("object_id")
    return marks.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "rank")


def gates(marks: DataFrame) -> DataFrame:
    """The highest gate of each object: table, object_id, quality_gate."""
    state = F.element_at(F.create_map(*[x for k, v in STATE.items() for x in (F.lit(k), F.lit(v))]), F.col("rank"))
    return marks.where("gate <> 'fail'").groupBy("table", "object_id").agg(F.max("rank").alias("rank")).select("table", "object_id", state.alias("quality_gate"))


def apply_gate(rows: DataFrame, table: str, id_col: str, gate: DataFrame) -> DataFrame:
    """rows with quality_gate set anew: clean unless gate has the row."""
    g = gate.where(F.col("table") == table).select(F.col("object_id").alias("_id"), F.col("quality_gate").alias("_gate"))
    return rows.drop("quality_gate").join(g, F.col(id_col).cast("string") == F.col("_id"), "left").withColumn("quality_gate", F.coalesce("_gate", F.lit("clean"))).drop("_id", "_gate")


def write_then_raise(marks: DataFrame, path: str) -> None:
    """Append the ledger first; then raise if an invariant is broken."""
    ledger(marks).write.mode("append").parquet(path)
    if marks.where("gate = 'fail'").agg(F.count("*") > 0).first()[0]:
        raise RuntimeError("quality: an invariant is broken; the ledger is written")


def anchor_multiplicity(rows: DataFrame, anchor: list[str], id_col: str) -> DataFrame:
    """How many anchors have n distinct ids, for each n."""
    return rows.groupBy(*anchor).agg(F.countDistinct(id_col).alias("n_ids")).groupBy("n_ids").agg(F.count("*").alias("n_anchors"))


def null_class_profile(rows: DataFrame, klass: str, by: list[str], catch_all: list[str]) -> DataFrame:
    """Rows, rows without class and rows of a catch-all class, with percentages, per group."""
    none, other = F.count_if(blank(F.col(klass))), F.count_if(F.col(klass).isin(catch_all))
    pct = lambda n: F.round(100.0 * n / F.count("*"), 2)
    return rows.groupBy(*by).agg(F.count("*").alias("n"), none.alias("n_null"), other.alias("n_catch_all"), pct(none).alias("pct_null"), pct(other).alias("pct_catch_all"))


def lineage_trace(rows: DataFrame, source: DataFrame, key: list[str], column: str) -> DataFrame:
    """Rows with the value re-read from the source and whether it is the same."""
    s = source.select(*key, F.col(column).alias("source_value"))
    return rows.select(*key, F.col(column).alias("value")).join(s, key, "left").withColumn("same", F.col("value").eqNullSafe(F.col("source_value")))


def neighbour_colours(rows: DataFrame, edges: DataFrame, id_col: str, tag: str, rounds: int, src: str = "src", dst: str = "dst") -> DataFrame:
    """(id, colour_0, ..., colour_<rounds>): 0 stands for the tag alone, each further round for the colour before and the multiset of the neighbours' colours before.

    Objects of one colour look alike as far as `rounds` steps away. A multiset is taken as its size, two sums and a checksum of its hashes,
    which Spark adds up before it shuffles, so that an object of very many neighbours is no more work than others. Edges count both ways and
    once each; edges to objects that rows lacks, to themselves or to null do not.
    """
    low = lambda c, seed: F.xxhash64(F.lit(seed), c).bitwiseAND(F.lit(0xFFFFFFFF))
    e = edges.select(F.col(src).alias("_id"), F.col(dst).alias("_other")).where("_id <> _other")
    with scratch() as keep:
        e = keep(e.unionByName(e.select(F.col("_other").alias("_id"), F.col("_id").alias("_other"))).distinct(), "both-ways")
        out = keep(rows.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("_id"), F.xxhash64(F.col(tag).cast("string")).alias("colour_0")).dropDuplicates(["_id"]), "colours")
        for r in range(rounds):
            now = f"colour_{r}"
            near = e.join(out.select(F.col("_id").alias("_other"), F.col(now).alias("_c")), "_other").groupBy("_id").agg(F.count("*").alias("_n"), F.sum(low(F.col("_c"), 1)).alias("_a"), F.sum(low(F.col("_c"), 2)).alias("_b"), F.bit_xor(F.xxhash64(F.lit(3), "_c")).alias("_x"))
            before, out = out, keep(out.join(near, "_id", "left").select(*out.columns, F.xxhash64(now, *[F.coalesce(c, F.lit(0)) for c in ("_n", "_a", "_b", "_x")]).alias(f"colour_{r + 1}")), "colours")
            drop(before)
        return cut(out.withColumnRenamed("_id", id_col), "colours")


def collider_diagnostics(rows: DataFrame, edges: DataFrame, anchor: list[str], id_col: str, attrs: list[str], tag: str, rounds: tuple[int, ...] = (1, 3)) -> DataFrame:
    """Of each anchor that several ids share: n_ids, n_attrs (different attributes) and n_colours_<r> (ids that their neighbourhood tells apart after r rounds)."""
    colours = neighbour_colours(rows, edges, id_col, tag, max(rounds)).select(F.col(id_col), *[f"colour_{r}" for r in rounds])
    x = rows.join(colours, id_col, "left").withColumn("_attrs", F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\0")) for c in attrs]))
    return x.groupBy(*anchor).agg(F.countDistinct(id_col).alias("n_ids"), F.countDistinct("_attrs").alias("n_attrs"), *[F.countDistinct(f"colour_{r}").alias(f"n_colours_{r}") for r in rounds]).where("n_ids > 1")
