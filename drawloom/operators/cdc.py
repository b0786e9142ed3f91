"""Change between two versions by business anchor, never by element id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawloom.functions.text import blank, row_hash


def latest_two(rows: DataFrame, key: str | list[str], time: str, tie: str) -> DataFrame:
    """The two newest versions of each key with version_rank 1 (newest) and 2; a null time is the oldest; keys with one version are left out."""
    keys = [key] if isinstance(key, str) else key
    w = Window.partitionBy(*keys).orderBy(F.col(time).desc_nulls_last(), F.col(tie).desc())
    n = Window.partitionBy(*keys)
    return rows.withColumn("version_rank", F.row_number().over(w)).where("version_rank <= 2").withColumn("_n", F.count("*").over(n)).where("_n = 2").drop("_n")


def anchor(*columns: str) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])


def opc_anchor(drawing: Column, tag: Column, mate: Column, text: Column) -> Column:
    """Drawing with the first filled of tag, bare mate id, upper-case text."""
    bare = F.regexp_replace(mate, "^SP", "")
    return F.concat_ws("|", F.coalesce(drawing, F.lit("")), F.coalesce(F.when(~blank(tag), tag), F.when(~blank(bare), bare), F.upper(text), F.lit("")))


def content_hashes(rows: DataFrame, eng: list[str], audit: list[str]) -> DataFrame:
    """content_hash_eng over the engineering columns; content_hash_audit over those and ids and answer-key columns."""
    e = row_hash(*[F.col(c) for c in eng])
    return rows.withColumn("content_hash_eng", e).withColumn("content_hash_audit", row_hash(e, *[F.col(c) for c in audit]))


def enrich_neighbours(objects: DataFrame, edges: DataFrame, id_col: str, anchor_col: str, scope: list[str] | None = None) -> DataFrame:
    """Adds neighbours and outgoing: sorted anchors of the distinct neighbour ids (an anchor as often as ids have it), and of those it flows to.

    edges: scope, from_id, to_id, flow_sense (none, forward, reverse, both).
    """
    scope = scope or []
    fwd, rev = F.col("flow_sense").isin("forward", "both"), F.col("flow_sense").isin("reverse", "both")
    both = edges.select(*scope, F.col("from_id").alias("a"), F.col("to_id").alias("b"), fwd.alias("out")).unionByName(edges.select(*scope, F.col("to_id").alias("a"), F.col("from_id").alias("b"), rev.alias("out")))
    both = both.where("a <> b").groupBy(*scope, "a", "b").agg(F.bool_or("out").alias("out"))
    named = objects.select(*scope, F.col(id_col).alias("b"), F.col(anchor_col).alias("_anchor")).distinct()
    lists = both.join(named, [*scope, "b"]).groupBy(*scope, "a").agg(F.array_sort(F.collect_list("_anchor")).alias("neighbours"), F.array_sort(F.collect_list(F.when(F.col("out"), F.col("_anchor")))).alias("outgoing"))
    none = F.array().cast("array<string>")
    return objects.join(lists.withColumnRenamed("a", id_col), [*scope, id_col], "left").withColumns({"neighbours": F.coalesce("neighbours", none), "outgoing": F.coalesce("outgoing", none)})


def aggregate_lines(pieces: DataFrame, keys: list[str], id_col: str, attrs: list[str], uncomposable: Column, lines_of: str | None = None) -> DataFrame:
    """One row per line: sorted distinct filled values of each attribute, piece_ids, piece_count, inconsistent (attributes with several values).

    Pieces whose tag cannot be composed are left out. lines_of: a column with a
    list of neighbour lines, united without the line itself.
    """
    sets = [F.array_sort(F.collect_set(F.when(~blank(F.col(a)), F.col(a).cast("string")))).alias(a) for a in attrs]
    more = [F.array_sort(F.array_distinct(F.flatten(F.collect_list(lines_of)))).alias(lines_of)] if lines_of else []
    out = pieces.where(~uncomposable).groupBy(*keys).agg(*sets, F.array_sort(F.collect_set(F.col(id_col).cast("string"))).alias("piece_ids"), F.countDistinct(id_col).alias("piece_count"), *more)
    if lines_of:
        out = out.withColumn(lines_of, F.array_remove(lines_of, anchor(*keys)))
    return out.withColumn("inconsistent", F.filter(F.array(*[F.when(F.size(a) > 1, F.lit(a)) for a in attrs]), lambda x: x.isNotNull()))


def changed_fields(pairs: Column | None, columns: list[str]) -> Column:
    """Names of the columns that differ between the structs old and new of a row, comma-joined."""
    names = [F.when(~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}")), F.lit(c)) for c in columns]
    return F.concat_ws(",", F.filter(F.array(*names), lambda x: x.isNotNull()))


def diff(old: DataFrame, new: DataFrame, keys: list[str], id_col: str, attrs: list[str], order: str | None = None) -> DataFrame:
    """New, Modified and Deleted objects: keys, change_type, old_id, new_id, old_hash, new_hash, detail.

    In each bucket (equal keys) objects of equal attributes vanish in pairs; what
    is left is paired by (order, id) as Modified, the rest is New or Deleted.
    Null and missing order counts as last, null keys as empty text.
    """
    def side(df: DataFrame, newest_first: bool) -> DataFrame:
        by = F.coalesce(F.col(order).cast("double") if order else F.lit(None).cast("double"), F.lit(1e6))
        d = df.select(*[F.coalesce(F.col(k).cast("string"), F.lit("")).alias(k) for k in keys], F.col(id_col).cast("string").alias("id"), by.alias("by"), row_hash(*[F.col(a) for a in attrs]).alias("hash"), F.struct(*[F.col(a).cast("string").alias(a) for a in attrs]).alias("x"))
        o = (F.col("by").desc(), F.col("id").desc()) if newest_first else (F.col("by"), F.col("id"))
        return d.withColumn("r", F.row_number().over(Window.partitionBy(*keys, "hash").orderBy(*o)))

    a, b = side(old, False).alias("a"), side(new, True).alias("b")
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in [*keys, "hash", "r"]]
    cols = lambda s: [F.col(f"{s}.{c}") for c in (*keys, "id", "by", "hash", "x")]
    met = a.join(b, on, "full_outer")
    gone = met.where("b.r is null").select(*cols("a"))
    come = met.where("a.r is null").select(*cols("b"))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy("by", "id"))
    left, right = gone.withColumn("r", rank).alias("o"), come.withColumn("r", rank).alias("n")
    pairs = left.join(right, [F.col(f"o.{k}") == F.col(f"n.{k}") for k in [*keys, "r"]], "full_outer")
    pairs = pairs.select(*[F.coalesce(f"o.{k}", f"n.{k}").alias(k) for k in keys], F.col("o.id").alias("old_id"), F.col("n.id").alias("new_id"), F.col("o.hash").alias("old_hash"), F.col("n.hash").alias("new_hash"), F.col("o.x").alias("old"), F.col("n.x").alias("new"))
    kind = F.when(F.col("old_hash").isNull(), "New").when(F.col("new_hash").isNull(), "Deleted").otherwise("Modified")
    return pairs.select(*keys, kind.alias("change_type"), "old_id", "new_id", "old_hash", "new_hash", F.when(kind == "Modified", changed_fields(None, attrs)).otherwise("").alias("detail"))


def delta_id(*columns: str) -> Column:
    return F.sha2(F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]), 256)


def summarize(deltas: DataFrame, by: list[str] | None = None) -> DataFrame:
    n = lambda t: F.count_if(F.col("change_type") == t).alias(f"n_{t.lower()}")
    return deltas.groupBy(*(by or [])).agg(n("New"), n("Modified"), n("Deleted"))


def run_cdc(grains: dict[str, tuple[DataFrame, DataFrame, list[str], str, list[str], str | None]]) -> DataFrame:
    """The deltas of all grains (name: old, new, keys, id, attributes, order) in one plan, with grain, anchor and cdc_id."""
    out = None
    for grain, (old, new, keys, id_col, attrs, order) in grains.items():
        d = diff(old, new, keys, id_col, attrs, order).withColumns({"grain": F.lit(grain), "anchor": anchor(*keys)}).drop(*keys)
        out = d if out is None else out.unionByName(d)
    return out.withColumn("cdc_id", delta_id("grain", "anchor", "change_type", "old_id", "new_id", "old_hash", "new_hash"))
