"""Naming of systems and matching against reference data."""

from __future__ import annotations

from collections.abc import Callable
from decimal import ROUND_HALF_UP, Decimal
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawloom.functions.text import blank, no_leading_zeros, normal_label
from drawloom.operators.tags import Field, compose, missing_fields
from drawloom.tables import cut, scratch

#: A block of labels is so many times one of the reference, as its labels are worked on side by side; cells of an edit table's row in one go.
_LANES, _CELLS = 8, 1_000_000


def member_value(members: DataFrame, system: str, value: str) -> DataFrame:
    """The most frequent filled value over a system's members; of equally frequent ones the lowest."""
    n = members.where(~blank(F.col(value))).groupBy(system, value).agg(F.count("*").alias("n"))
    w = Window.partitionBy(system).orderBy(F.col("n").desc(), F.col(value))
    return n.withColumn("_r", F.row_number().over(w)).where("_r = 1").select(system, value)


def lookup(rows: DataFrame, table: DataFrame, on: list[tuple[str, str]], value: str, id_col: str) -> DataFrame:
    """rows' id with the one distinct filled value for their key; else null with problem none, several or blank and the candidates. Keys ignore leading zeros and case."""
    t = table.select(*[no_leading_zeros(F.col(b).cast("string")).alias(f"_k{i}") for i, (_, b) in enumerate(on)], F.col(value).alias("_v"))
    r = rows.select(id_col, *[no_leading_zeros(F.col(a).cast("string")).alias(f"_k{i}") for i, (a, _) in enumerate(on)])
    j = r.join(t.withColumn("_hit", F.lit(True)), [f"_k{i}" for i in range(len(on))], "left")
    g = j.groupBy(id_col).agg(F.array_sort(F.collect_set(F.when(~blank(F.col("_v")), F.col("_v")))).alias("candidates"), F.coalesce(F.bool_or("_hit"), F.lit(False)).alias("_any"))
    n = F.size("candidates")
    return g.select(id_col, F.when(n == 1, F.col("candidates")[0]).alias(value), F.when(n == 1, F.lit(None)).when(n > 1, "several").when(F.col("_any"), "blank").otherwise("none").alias("problem"), "candidates")


def select(rows: DataFrame, id_col: str, table: DataFrame, on: list[tuple[str, str]], value: str, label: str, scope: tuple[str, DataFrame, str, str] | None = None, match: tuple[str, str] | None = None, ties: list[tuple[str, str]] = ()) -> DataFrame:
    """For each row the value of the one table row that is left after each stage: id, value, problem, candidates (labels).

    on: pairs (column of rows, column of table). scope: (column of rows, scope table, its
    key, its column for the table's first key): only listed keys stay. match: (column of rows,
    list column): the table rows whose comma or semicolon list has the value, or the only
    row if its list is empty; without match, the only row. ties: pairs of columns; while several are left, those where the
    pair is equal, if any is. problem: none, scope, unlisted or several. Keys ignore leading zeros
    and case, null equals nothing.
    """
    k = lambda c: no_leading_zeros(F.col(c).cast("string"))
    items = lambda c: F.array_remove(F.transform(F.split(F.coalesce(F.col(c).cast("string"), F.lit("")), "[,;]"), lambda x: no_leading_zeros(F.trim(x))), "")
    keys = [f"_k{i}" for i in range(len(on))]
    r = rows.select(id_col, *[k(a).alias(n) for n, (a, _) in zip(keys, on)], (k(scope[0]) if scope else F.lit(None).cast("string")).alias("_scope"), (k(match[0]) if match else F.lit(None).cast("string")).alias("_want"), *[k(a).alias(f"_t{i}") for i, (a, _) in enumerate(ties)])
    t = table.select(*[k(b).alias(n) for n, (_, b) in zip(keys, on)], F.col(value).alias("_v"), F.col(label).cast("string").alias("_label"), (items(match[1]) if match else F.array().cast("array<string>")).alias("_list"), *[k(b).alias(f"_u{i}") for i, (_, b) in enumerate(ties)], F.lit(True).alias("_row"))
    j = r.join(t, keys, "left")
    if scope:
        allowed = scope[1].select(k(scope[2]).alias("_scope"), k(scope[3]).alias("_k0"), F.lit(True).alias("_in")).distinct()
        j = j.join(allowed, ["_scope", "_k0"], "left")
    else:
        j = j.withColumn("_in", F.lit(True))
    listed = F.coalesce(F.array_contains("_list", F.col("_want")), F.lit(False)) if match else F.lit(False)
    equal = F.array(*[F.coalesce(F.col(f"_t{i}") == F.col(f"_u{i}"), F.lit(False)) for i in range(len(ties))]).cast("array<boolean>")
    one = F.struct(F.col("_v").alias("v"), F.col("_label").alias("label"), F.coalesce("_in", F.lit(False)).alias("ok"), listed.alias("hit"), (F.size("_list") == 0).alias("open"), equal.alias("equal"))
    g = j.groupBy(id_col).agg(F.collect_list(F.when(F.col("_row"), one)).alias("_all"))
    g = g.withColumn("_ok", F.filter("_all", lambda x: x["ok"])).withColumn("_hits", F.filter("_ok", lambda x: x["hit"]))
    g = g.withColumn("_hits", F.when((F.size("_hits") == 0) & (F.size("_ok") == 1) & F.get("_ok", F.lit(0))["open"], F.col("_ok")).otherwise(F.col("_hits")))
    alike_by = lambda i: F.filter("_hits", lambda x: F.get(x["equal"], F.lit(i)))
    for alike in map(alike_by, range(len(ties))):
        g = g.withColumn("_hits", F.when((F.size("_hits") > 1) & (F.size(alike) > 0), alike).otherwise(F.col("_hits")))
    n = F.size("_hits")
    problem = F.when(n == 1, F.lit(None)).when(n > 1, "several").when(F.size("_all") == 0, "none").when(F.size("_ok") == 0, "scope").otherwise("unlisted")
    left = F.when(n > 1, F.col("_hits")).when(n == 0, F.col("_ok"))
    labels = F.coalesce(F.array_sort(F.array_distinct(F.filter(F.transform(left, lambda x: x["label"]), lambda x: x.isNotNull()))), F.array().cast("array<string>"))
    return g.select(id_col, F.when(n == 1, F.get("_hits", F.lit(0))["v"]).alias(value), problem.alias("problem"), labels.alias("candidates"))


def list_join(rows: DataFrame, table: DataFrame, key: str, cell: str) -> DataFrame:
    """rows joined with the table rows whose comma or semicolon list has the key."""
    t = table.withColumn("_item", F.explode(F.split(F.col(cell), r"\s*[,;]\s*"))).where("_item <> ''")
    return rows.join(t.withColumn("_item", no_leading_zeros(F.col("_item"))), no_leading_zeros(F.col(key).cast("string")) == F.col("_item")).drop("_item")


def prefer(candidates: DataFrame, system: str, score: Column) -> DataFrame:
    """Where a system has several candidates and a positive score, those of the best score; else all."""
    w = Window.partitionBy(system)
    c = candidates.withColumn("_s", score).withColumn("_n", F.count("*").over(w)).withColumn("_top", F.max("_s").over(w))
    return c.where((F.col("_n") == 1) | (F.col("_top") <= 0) | (F.col("_s") == F.col("_top"))).drop("_s", "_n", "_top")


def service_score(description: Column, others: Column, texts: Column) -> Column:
    """In how many texts a word occurs that this description has and that is not common to all candidates. others: array of the other candidates' descriptions; texts: array of text."""
    words = lambda c: F.array_distinct(F.regexp_extract_all(F.upper(F.coalesce(c, F.lit(""))), F.lit("([A-Z0-9]{3,})"), 1))
    common = F.aggregate(others, words(description), lambda a, o: F.array_intersect(a, words(o)))
    own = F.when(F.size(others) > 0, F.array_except(words(description), common)).otherwise(words(description))
    return F.size(F.filter(texts, lambda t: F.exists(own, lambda w: F.array_contains(words(t), w))))


def first_rule(rules: list[Column]) -> Column:
    """The value of the first rule that gives one."""
    return F.coalesce(*rules)


def sequence(rows: DataFrame, scope: list[str], anchor: str, label: str, width: int, name: str = "sequence") -> DataFrame:
    """Numbers from 1 in each scope by anchor (missing last), then label; zero-padded, never cut."""
    w = Window.partitionBy(*scope).orderBy(F.coalesce(F.col(anchor).cast("string"), F.lit("~")), label)
    n = F.row_number().over(w).cast("string")
    return rows.withColumn(name, F.when(F.length(n) >= width, n).otherwise(F.lpad(n, width, "0")))


def render(rows: DataFrame, groups: list[list[Field]], columns: dict[str, Column], name: str = "name", separator: str = "-") -> DataFrame:
    """rows with the name by template and the required fields that are missing."""
    return rows.withColumns({name: compose(groups, columns, separator), "missing": missing_fields(groups, columns)})


def merge_same_name(rows: DataFrame, name: str, label: str, members: str) -> DataFrame:
    """One row per name: sorted labels, number of systems and of members; unnamed systems stay one by one."""
    key = F.coalesce(F.col(name), F.concat(F.lit("?"), F.col(label).cast("string")))
    return rows.groupBy(key.alias("_key")).agg(F.max(name).alias(name), F.array_sort(F.collect_set(F.col(label).cast("string"))).alias("labels"), F.count("*").alias("n_systems"), F.sum(members).alias("n_members")).drop("_key")


def service_texts(opcs: DataFrame, components: DataFrame) -> DataFrame:
    """(object_id, texts): each connector's text for its segment and the components on it."""
    t = opcs.where("description is not null and on_segment is not null").select(F.col("on_segment").alias("segment_id"), "description").distinct()
    on = t.select(F.col("segment_id").alias("object_id"), "description").unionByName(t.join(components.select("segment_id", "component_id"), "segment_id").select(F.col("component_id").alias("object_id"), "description"))
    return on.groupBy("object_id").agg(F.array_sort(F.collect_set("description")).alias("texts"))


def reference_issues(table: DataFrame, key: list[str], value: str, allowed: DataFrame | None = None) -> DataFrame:
    """Keys with several values (conflict) and values that are not allowed (unknown)."""
    k = F.concat_ws("|", *[F.col(c).cast("string") for c in key])
    out = table.groupBy(k.alias("key")).agg(F.array_join(F.array_sort(F.collect_set(F.col(value).cast("string"))), ",").alias("detail"), F.countDistinct(value).alias("_n")).where("_n > 1").select(F.lit("conflict").alias("issue"), "key", "detail")
    if allowed is not None:
        ok = allowed.select(F.col(allowed.columns[0]).alias(value)).distinct()
        out = out.unionByName(table.where(F.col(value).isNotNull()).join(ok, value, "left_anti").select(F.lit("unknown").alias("issue"), k.alias("key"), F.col(value).cast("string").alias("detail")).distinct())
    return out


def coverage(rows: DataFrame, field: str, by: list[str]) -> DataFrame:
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(~blank(F.col(field))).alias("n_resolved")).withColumn("share", F.round(F.col("n_resolved") / F.col("n"), 4))


def convention_issues(rules: list[dict], sources: set[str], tables: dict[str, list[str]]) -> list[str]:
    """What is wrong with naming rules (Field, Source, Table, Column): unknown source, table or column. Rules are a few settings, not data."""
    out = []
    for r in rules:
        if r.get("Source") not in sources:
            out.append(f"{r.get('Field')}: unknown source {r.get('Source')}")
        if r.get("Table") and r["Table"] not in tables:
            out.append(f"{r.get('Field')}: unknown table {r['Table']}")
        elif r.get("Table") and r.get("Column") and r["Column"] not in tables[r["Table"]]:
            out.append(f"{r.get('Field')}: {r['Table']} has no column {r['Column']}")
    return out


def naming_report(named: DataFrame, name: str, members: str) -> DataFrame:
    """One row: systems, named ones, members, the largest, and the most frequent missing field."""
    miss = named.select(F.explode("missing").alias("m")).groupBy("m").agg(F.count("*").alias("n")).agg(F.max_by("m", F.struct("n", "m")).alias("most_missing"))
    return named.agg(F.count("*").alias("n_systems"), F.count(name).alias("n_named"), F.sum(members).alias("n_members"), F.max(members).alias("largest")).join(miss, F.lit(True), "left")


def label_match(rows: DataFrame, label: str, reference: DataFrame, ref_label: str, target: str) -> DataFrame:
    """rows with the least target whose normalised label is equal; null where there is none."""
    r = reference.groupBy(normal_label(F.col(ref_label)).alias("_key")).agg(F.min(target).alias("match"))
    return rows.withColumn("_key", normal_label(F.col(label))).join(r, "_key", "left").drop("_key")


def _edits(least: float) -> Column:
    """Edits that labels of lengths la and lb may differ by at a similarity of `least`, which is rounded to 6 digits."""
    return F.floor(F.greatest("la", "lb") * F.lit(1 - least + 1e-6)).cast("int")


def _segments(reference: DataFrame, lengths: DataFrame, least: float) -> DataFrame:
    """Each reference label b in k + 1 parts of even length, for each length la of labels that may match it: columns la, lb, part, text, b."""
    r = reference.join(lengths.withColumnRenamed("l", "la"), _near(least)).withColumn("k", _edits(least))
    i, short = F.col("part"), F.expr("k + 1 - lb % (k + 1)")  # the last parts are one longer
    start = F.expr("part * (lb div (k + 1))") + F.greatest(F.lit(0), i - short)
    r = r.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("k"))))
    return r.select("la", "lb", "part", "b", F.substr("b", (start + 1).cast("int"), F.expr("CAST(lb div (k + 1) AS INT)") + F.when(i >= short, 1).otherwise(0)).alias("text"))


def _substrings(labels: DataFrame, lengths: DataFrame, least: float) -> DataFrame:
    """Of each label a the pieces that a part of a reference label can have stayed whole in: within as many places as the edits before and after the part allow."""
    d = labels.join(lengths.withColumnRenamed("l", "lb"), _near(least)).withColumn("k", _edits(least))
    i, short = F.col("part"), F.expr("k + 1 - lb % (k + 1)")
    d = d.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("k"))))
    start = (F.expr("part * (lb div (k + 1))") + F.greatest(F.lit(0), i - short)).cast("int")
    size = F.expr("CAST(lb div (k + 1) AS INT)") + F.when(i >= short, 1).otherwise(0)
    longer, after = F.col("la") - F.col("lb"), F.col("k") - i
    low, high = F.greatest(F.lit(0), start - i, start + longer - after), F.least(F.col("la") - size, start + i, start + longer + after)
    d = d.withColumns({"size": size, "low": low, "high": high}).where("low <= high").withColumn("at", F.explode(F.sequence("low", "high")))
    return d.select("la", "lb", "part", "a", F.substr("a", F.col("at") + 1, F.col("size")).alias("text"))


def _near(least: float) -> Column:
    return F.abs(F.col("la") - F.col("lb")) <= F.greatest("la", "lb") * F.lit(1 - least + 1e-6)


def _similarity() -> Column:
    return F.round(1 - F.levenshtein("a", "b") / F.nullif(F.greatest("la", "lb"), F.lit(0)), 6)


def _best_of(pairs: DataFrame, least: float) -> DataFrame:
    return _best(pairs.withColumn("similarity", _similarity()).where(F.col("similarity") >= least))


def _best(s: DataFrame) -> DataFrame:
    best = s.groupBy("a", "la").agg(F.min(F.struct((-F.col("similarity")).alias("order"), "b", "similarity")).alias("best"))
    return best.select("a", "la", "best.b", "best.similarity")


def fuzzy_candidates(rows: DataFrame, label: str, reference: DataFrame, ref_label: str, least: float = 0.5, block: int = 1000, steps: tuple[float, ...] = (0.85,)) -> DataFrame:
    """For each distinct label the most similar reference label (1 - edits / longer length) of at least `least`, for review; of equally similar ones the lowest.

    Labels within k edits of each other share one of k + 1 parts at nearly the same place: each step looks up the
    labels' pieces among the reference's parts and so finds all pairs of its similarity or more, so what it finds is a label's
    best. Labels without one go on to the next, lower step. At low similarity the parts are too short to tell labels apart, and
    most pairs are found several times over: what is left after the steps is compared once with all reference labels of a fitting
    length, in blocks of about `block` of these. The result is that of all with all.
    """
    with scratch() as keep:
        size = lambda df, c, n: df.select(c).distinct().select(normal_label(F.col(c)).alias(n)).distinct().withColumn(f"l{n}", F.length(n))
        left, b = keep(size(rows, label, "a"), "labels"), keep(size(reference, ref_label, "b"), "reference")
        lengths = keep(b.select(F.col("lb").alias("l")).distinct(), "lengths")
        found = []
        for step in sorted((x for x in steps if x > least), reverse=True):
            asked = keep(left.select(F.col("la").alias("l")).distinct(), "asked")
            parts, pieces = _segments(b, asked, step), _substrings(left, lengths, step)
            pairs = pieces.join(parts, ["la", "lb", "part", "text"]).select("a", "b", "la", "lb")
            found.append(keep(_best_of(pairs, step), "best"))
            left = keep(left.join(found[-1], "a", "left_anti"), "labels")
        found.append(_best(_in_blocks(left, b, least, block, keep)))
        out = found[0]
        for f in found[1:]:
            out = out.unionByName(f)
        return cut(out.select(F.col("a").alias("label"), F.col("b").alias("suggested"), "similarity"), "similar-labels")


def _in_blocks(a: DataFrame, b: DataFrame, least: float, block: int, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    """The best of all pairs (a, b) of lengths that allow `least`: each block of labels of one length meets each block of the reference, once."""
    sizes = a.groupBy("la").agg(F.ceil(F.count("*") / (_LANES * block)).alias("na"))
    sizes = keep(sizes.crossJoin(b.agg(F.greatest(F.ceil(F.count("*") / block), F.lit(1)).alias("nb"))), "blocks")  # one row per length
    tasks = min(sizes.agg(F.sum(F.col("na") * F.col("nb"))).first()[0] or 1, 2000)  # so many tasks, however few bytes they get
    dealt = lambda n: F.pmod(F.xxhash64(n), f"n{n}").alias(f"b{n}")
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(f"n{n}") - 1)).alias(f"b{n}")
    blocks = lambda df: df.repartition(tasks, "la", "ba", "bb").groupBy("la", "ba", "bb")
    left = blocks(a.join(sizes, "la").select("la", "a", dealt("a"), every("b")))
    right = blocks(b.join(sizes, _near(least)).select("la", "b", dealt("b"), every("a")))
    return left.cogroup(right).applyInArrow(_most_similar(least), "a string, la int, b string, similarity double")


def _most_similar(least: float) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    """Of a block of labels of one length the best among a block of the reference, if at least `least`."""

    def run(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        la, words, reference = key[0].as_py(), left["a"].to_pylist(), sorted(right["b"].to_pylist())
        step = max(1, _CELLS // (la + 1))
        out = [_best_edits(words[i : i + step], la, reference) for i in range(0, len(words), step)]
        found = [(w, reference[k], x) for i, (which, like) in enumerate(out) for w, k, x in zip(words[i * step :], which.tolist(), like.tolist()) if x >= least]
        a, b, like = zip(*found) if found else ((), (), ())
        return pa.table([pa.array(a, pa.string()), pa.array([la] * len(a), pa.int32()), pa.array(b, pa.string()), pa.array(like, pa.float64())], ["a", "la", "b", "similarity"])

    return run


def _best_edits(words: list[str], la: int, reference: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """For each of the words, all of la code points, the number of the first most similar reference label and the similarity (-1: none); reference is sorted.

    The rows of the edit table are worked out for all words at once, a cell being edits - column, and those of a prefix that the
    label before has too are there already; what is deeper than memory allows is done again.
    """
    n, depth = len(words), max(map(len, reference), default=0)
    kind = np.int8 if max(la, depth) < 120 else np.int16 if max(la, depth) < 32_000 else np.int32
    letters, text = np.unique(np.frombuffer("".join(words).encode("utf-32-le"), "<u4"), return_inverse=True)
    number = {chr(c): i for i, c in enumerate(letters)}
    text = np.ascontiguousarray(text.reshape(n, la).T, np.uint8 if len(letters) < 256 else np.uint32)
    held = max(1, min(depth + 1, 32 * _CELLS // ((la + 1) * n)))
    table = np.zeros((held + 2, la + 1, n), kind)
    rows = [list(t) for t in table]
    equal, cost = np.empty((la, n), bool), np.empty((la, n), kind)
    which, best, before = np.zeros(n, np.int64), np.full(n, -1.0), ""
    for k, b in enumerate(reference):
        shared = next((i for i, (x, y) in enumerate(zip(before, b)) if x != y), min(len(before), len(b)))
        at = min(shared, held - 1)
        for i in range(at, len(b)):
            to = i + 1 if i + 1 < held else held + i % 2
            old, new, lines = table[at], table[to], rows[to]
            np.equal(text, number.get(b[i], -1), out=equal) if b[i] in number else equal.fill(False)
            np.subtract(old[:-1], equal, out=cost)
            new[0] = i + 1
            np.minimum(np.add(old[1:], 1, out=new[1:]), cost, out=new[1:])
            for x, y in zip(lines, lines[1:]):
                np.minimum(x, y, out=y)
            at = to
        before = b
        if la or b:
            like = _similarities(max(la, len(b)))[rows[at][la].astype(np.int64) + la]
            more = like > best
            which[more], best[more] = k, like[more]
    return which, best


@lru_cache(1000)
def _similarities(longer: int) -> np.ndarray:
    """Of each number of edits what _similarity() says."""
    return np.array([float(Decimal(repr(1 - d / longer)).quantize(Decimal("0.000001"), ROUND_HALF_UP)) for d in range(longer + 1)])


def gap_ranking(used: DataFrame, covered: DataFrame, code: str, boundary: Column | None = None) -> DataFrame:
    """Codes in use without cover, by boundary-forming first, then by count: with rank.

    Codes are dealt by ranges of that order; a code's rank is its number in its range after the sizes of the ranges before.
    """
    flag = boundary if boundary is not None else F.lit(False)
    n = used.where(~blank(F.col(code))).groupBy(code).agg(F.count("*").alias("n"), F.bool_or(flag).alias("boundary")).join(covered.select(code).distinct(), code, "left_anti")
    order = [F.col("boundary").desc(), F.col("n").desc(), F.col(code)]
    with scratch() as keep:
        dealt = keep(n.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "gaps")
        # one row per range
        sizes = dealt.groupBy("_range").agg(F.count("*").alias("_size")).withColumn("_before", F.sum("_size").over(Window.orderBy("_range")) - F.col("_size"))
        numbered = dealt.withColumn("_n", F.row_number().over(Window.partitionBy("_range").orderBy(*order)))
        ranked = numbered.join(sizes.drop("_size"), "_range").withColumn("rank", F.col("_before") + F.col("_n"))
        return cut(ranked.drop("_range", "_n", "_before"), "gap-ranks")


def seed_aliases(seeds: DataFrame, label: str, reference: DataFrame, ref_label: str, target: str) -> tuple[DataFrame, DataFrame]:
    """(resolved, missing) of alias seeds by label."""
    m = label_match(seeds, label, reference, ref_label, target)
    return m.where("match is not null"), m.where("match is null").drop("match")
