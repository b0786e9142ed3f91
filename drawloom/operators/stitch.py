"""Cross-drawing stitch of off-page connectors."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawloom.functions.text import blank, filled
from drawloom.operators.graph import connected_components
from drawloom.operators.topology import edge_id
from drawloom.tables import cut, drop, scratch


#: White space of any script, as signs of a class that reads the same in Java and RE2.
SPACE = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"


def to_from(text: Column) -> Column:
    """struct(dir TO|FROM|null, text): the leading word in any case, and the rest of the whole text without white space around it."""
    lead = rf"(?i)\A[{SPACE}]*(to|from)(?![\p{{L}}\p{{M}}\p{{N}}_])"
    word = F.upper(F.regexp_extract(text, lead, 1))
    rest = F.regexp_replace(F.regexp_replace(text, rf"{lead}[{SPACE}:]*", ""), rf"\A[{SPACE}]+|[{SPACE}]+\z", "")
    return F.struct(F.nullif(word, F.lit("")).alias("dir"), filled(rest).alias("text"))


def harvest(nodes: DataFrame, tag: str = "PipeOffPageConnector") -> DataFrame:
    """Off-page connectors as one record for both dialects."""
    g, a = (lambda n: F.col("ga").getItem(n)), (lambda n: F.col("attrs").getItem(n))
    return nodes.where((F.col("tag") == tag) & ~F.col("in_catalogue")).select(
        "content_hash", "ord", F.col("node_id").alias("eid"), F.col("document").alias("home"), g("PairedDrawingNumber").alias("paired"), g("OPCTag").alias("opctag"), F.col("node_id").alias("guid_self"),
        F.coalesce(g("PairedWithGUID"), g("PairingGUID")).alias("guid_mate"), g("OPCType").alias("opc_type"), g("FlowDirection").alias("flow_direction"), a("ComponentClassURI").alias("class_uri"), g("Description").alias("description"), to_from(g("Description")).alias("to_from"),
    )


def match_by_tag(opcs: DataFrame, key: str = "opctag", id_col: str = "eid", home: str = "home", paired: str = "paired") -> DataFrame:
    """(a, b, rule) of tags that exactly two records share, in different drawings where both are told to be, a < b."""
    w = Window.partitionBy(key)
    two = opcs.where(~blank(F.col(key))).withColumn("_n", F.count("*").over(w)).where("_n = 2")
    g = two.groupBy(key).agg(F.min(F.struct(F.col(id_col).alias("id"), F.col(home).alias("home"), F.col(paired).alias("paired"))).alias("x"), F.max(F.struct(F.col(id_col).alias("id"), F.col(home).alias("home"), F.col(paired).alias("paired"))).alias("y"))
    fits = lambda p, h: F.coalesce(F.col(p) == F.col(h), F.lit(True))
    return g.where(fits("x.paired", "y.home") & fits("y.paired", "x.home")).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.lit("tag").alias("rule"))


def _greedy(batch):
    """Pairs (x, y) of a bucket's records in order of x: the first free owner of the key that x names."""
    import pyarrow as pa

    rec, key, names = (batch.column(c).to_pylist() for c in ("rec", "key", "names"))
    owners: dict = {}
    for r, k, n in sorted(zip(rec, key, names), key=lambda t: t[0]):
        if not n:
            owners.setdefault(k, []).append(r)
    at, taken, pairs = dict.fromkeys(owners, 0), set(), []
    for x, k in sorted((r, k) for r, k, n in zip(rec, key, names) if n):
        if x in taken or k not in owners:
            continue
        own = owners[k]
        while at[k] < len(own) and own[at[k]] in taken:
            at[k] += 1
        i = at[k]
        # x itself may own the key that it names
        while i < len(own) and (own[i] == x or own[i] in taken):
            i += 1
        if i < len(own):
            taken.update((x, own[i]))
            pairs.append((x, own[i]))
    t = batch.schema.field("rec").type
    return pa.table([pa.array([p[0] for p in pairs], t), pa.array([p[1] for p in pairs], t)], names=["x", "y"])


def _first_pairs(rows: DataFrame) -> DataFrame:
    """(x, y) of the pairs that are the least of both their records, without listing the pairs of a key."""
    w = Window.partitionBy("key").orderBy("rec")
    two = lambda side, of: rows.where(side).withColumn("_n", F.row_number().over(w)).where("_n <= 2").groupBy("key").agg(F.array_sort(F.collect_list("rec")).alias(of))
    other = lambda of: F.when(F.element_at(of, 1) != F.col("rec"), F.element_at(of, 1)).when(F.size(of) > 1, F.element_at(of, 2))
    ahead = rows.where("names").join(two("not names", "o"), "key").select("rec", F.struct(F.col("rec").alias("x"), other("o").alias("y")).alias("p"))
    back = rows.where("not names").join(two("names", "o"), "key").select("rec", F.struct(other("o").alias("x"), F.col("rec").alias("y")).alias("p"))
    least = ahead.unionByName(back).where("p.x is not null and p.y is not null").groupBy("rec").agg(F.min("p").alias("p"))
    return least.groupBy("p").agg(F.count("*").alias("_n")).where("_n = 2").select("p.x", "p.y")


def match_by_guid(opcs: DataFrame, id_col: str = "eid", mine: str = "guid_self", mate: str = "guid_mate", most: int = 500_000) -> DataFrame:
    """(a, b, rule) of records of which one names the other, with or without SP before it, a < b; each record in at most one pair.

    Greedy in order of the naming record, then of the named one: a pair is taken
    unless an earlier one has taken either end. Which pairs wait for each other is told by the connected components of
    records and keys, which take a number of rounds that grows with the logarithm of their length. Components of up to `most` rows go to tasks
    whole, many to a task; a larger one gives off the pairs that are first for both ends, round by round, and
    its components are looked at anew after each doubling of the rounds, so any size is matched exactly. The records of
    a key are never paired with each other. Ids are taken as unique; null ids and blank keys match nothing.
    """
    bare = lambda c: F.regexp_replace(F.col(c).cast("string"), "^SP", "")
    side = lambda c, names: opcs.where(~blank(F.col(c)) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("rec"), bare(c).alias("key"), F.lit(names).alias("names"))
    kind = dict(opcs.dtypes)[id_col]
    with scratch() as keep:
        rows = keep(side(mate, True).unionByName(side(mine, False)).distinct(), "mates")
        both = rows.groupBy("key").agg((F.max("names") & ~F.min("names")).alias("both")).where("both").select("key")
        left = keep(rows.join(both, "key", "left_semi"), "mates")
        taken, rounds = [], 1
        while not left.isEmpty():
            # a record's rows are joined by its id, a key's by the key
            link = left.select(F.concat(F.lit("r"), F.col("rec").cast("string")).alias("src"), F.concat(F.lit("k"), "key").alias("dst"))
            parts = connected_components(link)
            placed = keep(left.join(parts.where("node like 'k%'").select(F.expr("substr(node, 2)").alias("key"), "component"), "key"), "placed")
            drop(parts)
            size = placed.groupBy("component").agg(F.count("*").alias("n"))
            size = keep(size, "sizes")
            small = placed.join(size.where(F.col("n") <= most), "component", "left_semi")
            total = size.where(F.col("n") <= most).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
            bucket = F.pmod(F.xxhash64("component"), F.lit(max(1, -(-total // max(1, most // 4)))))
            taken.append(keep(small.select("rec", "key", "names", bucket.alias("bucket")).groupBy("bucket").applyInArrow(_greedy, f"x {kind}, y {kind}"), "taken"))
            left = keep(placed.join(size.where(F.col("n") > most), "component", "left_semi").drop("component"), "mates")
            for _ in range(rounds):
                if left.isEmpty():
                    break
                taken.append(keep(_first_pairs(left), "taken"))
                if taken[-1].isEmpty():  # where any pair is left, one of them is the first
                    left = left.limit(0)
                    break
                gone = taken[-1].select(F.col("x").alias("rec")).union(taken[-1].select("y"))
                before, left = left, keep(left.join(gone, "rec", "left_anti"), "mates")
                drop(before)
            rounds *= 2
        pairs = reduce(DataFrame.unionByName, taken) if taken else opcs.sparkSession.createDataFrame([], f"x {kind}, y {kind}")
        return cut(pairs.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), F.lit("guid").alias("rule")), "guid-pairs")


def match_pairs(opcs: DataFrame, id_col: str = "eid") -> tuple[DataFrame, DataFrame]:
    """(pairs, unmatched): pairs by tag first, then by id among the rest."""
    tag = match_by_tag(opcs, id_col=id_col)
    ends = lambda p: p.select(F.col("a").alias(id_col)).union(p.select("b"))
    rest = opcs.join(ends(tag), id_col, "left_anti")
    guid = match_by_guid(rest, id_col)
    return tag.unionByName(guid), rest.join(ends(guid), id_col, "left_anti")


def offpage_edges(pairs: DataFrame) -> DataFrame:
    """Derived edges without flow sense, least end first, each once."""
    kind = F.lit("OffPage")
    return pairs.select(F.least("a", "b").alias("from_id"), F.greatest("a", "b").alias("to_id")).distinct().select(edge_id(F.col("from_id"), F.col("to_id"), kind).alias("connection_id"), "from_id", "to_id", kind.alias("conn_type"), F.lit(True).alias("derived"), F.lit("none").alias("flow_sense"))


def open_boundaries(unmatched: DataFrame, id_col: str = "eid", tag: str = "opctag") -> DataFrame:
    return unmatched.select(F.col(id_col).cast("string").alias("object_id"), F.lit("opc").alias("object_kind"), F.lit("unmatched_opc").alias("flag"), F.lit("info").alias("severity"), F.lit("flag").alias("gate"), F.lit("assemble").alias("stage"), F.format_string("off-page connector %s (tag %s) has no partner", F.col(id_col).cast("string"), F.coalesce(F.col(tag).cast("string"), F.lit("?"))).alias("detail"))


def opc_entities(opcs: DataFrame, pairs: DataFrame, components: DataFrame | None = None, id_col: str = "eid") -> DataFrame:
    """One row per connector with matched and the segment it is on."""
    ends = pairs.select(F.col("a").alias(id_col)).union(pairs.select("b")).distinct().withColumn("_m", F.lit(True))
    out = opcs.join(ends, id_col, "left").withColumn("matched", F.coalesce("_m", F.lit(False))).drop("_m")
    if components is not None:
        on = components.groupBy("content_hash", F.col("component_id").alias(id_col)).agg(F.min("segment_id").alias("on_segment"))
        out = out.join(on, ["content_hash", id_col], "left")
    return out


def stitch_stats(opcs: DataFrame, pairs: DataFrame, unmatched: DataFrame) -> DataFrame:
    """One row: total, pairs, open, and whether 2 pairs + open = total."""
    parts = opcs.select(F.lit(1).alias("t"), F.lit(0).alias("p"), F.lit(0).alias("o")).unionByName(pairs.select(F.lit(0).alias("t"), F.lit(1).alias("p"), F.lit(0).alias("o"))).unionByName(unmatched.select(F.lit(0).alias("t"), F.lit(0).alias("p"), F.lit(1).alias("o")))
    n = parts.agg(F.coalesce(F.sum("t"), F.lit(0)).alias("n_total"), F.coalesce(F.sum("p"), F.lit(0)).alias("n_pairs"), F.coalesce(F.sum("o"), F.lit(0)).alias("n_open"))
    return n.withColumn("conserved", 2 * F.col("n_pairs") + F.col("n_open") == F.col("n_total"))
