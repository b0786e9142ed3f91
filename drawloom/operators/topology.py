"""Reconstruction of inline topology: relational over node tables, edges and polylines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawloom.functions.text import blank, filled
from drawloom.operators.graph import connected_components
from drawloom.tables import cut, drop, scratch

# Element tags that are components, by dialect.
COMPONENT_TAGS = {
    "DEXPI": [
        "PipingComponent", "PipeConnectorSymbol", "PipeOffPageConnector", "PipeFlowArrow", "PropertyBreak", "ProcessInstrumentationFunction", "InstrumentComponent", "ProcessInstrument",
        "InstrumentationLoopFunction", "ActuatingSystem", "Nozzle", "Equipment",
    ],
    "POSTPROC": ["PipingComponent", "PipeOffPageConnector", "ProcessInstrument", "InstrumentComponent", "Nozzle", "Equipment", "PropertyBreak"],
}
VALVES = ["GateValve", "GlobeValve", "BallValve", "ButterflyValve", "CheckValve"]


def extract_objects(nodes: DataFrame, tags: list[str]) -> DataFrame:
    """Instances of the given tags, the first per document and id, with owner segment and a location (own, middle of the centre line, middle of the extent)."""
    mid = F.try_element_at("pts", (F.floor(F.size("pts") / 2) + 1).cast("int"))
    x = F.coalesce("x", mid["x"], (F.col("extent.x0") + F.col("extent.x1")) / 2)
    y = F.coalesce("y", mid["y"], (F.col("extent.y0") + F.col("extent.y1")) / 2)
    w = Window.partitionBy("content_hash", "node_id").orderBy("ord")
    rows = nodes.where(F.col("tag").isin(tags) & ~F.col("in_catalogue") & F.col("node_id").isNotNull()).withColumn("_n", F.row_number().over(w)).where("_n = 1")
    return rows.select("content_hash", "document", "ord", F.col("node_id").alias("component_id"), F.col("attrs").getItem("ComponentClass").alias("component_class"), F.col("attrs").getItem("ComponentClassURI").alias("component_class_uri"), F.col("ga").getItem("ItemTag").alias("tag"), F.col("tag").alias("kind"), F.col("owner_segment").alias("segment_id"), x.alias("x"), y.alias("y"), "nodes")


def raw_edges(nodes: DataFrame) -> DataFrame:
    """(content_hash, from_id, to_id) that Connection elements state."""
    a = lambda n: F.col("attrs").getItem(n)
    return nodes.where("tag = 'Connection' and not in_catalogue").select("content_hash", "owner_segment", "ord", a("FromID").alias("from_id"), a("ToID").alias("to_id"))


def arc_position(points: DataFrame, lines: DataFrame, point: list[str], line: str) -> DataFrame:
    """For each point (keys, x, y) the distance along its line (line key, pts) of the nearest place on it.

    Legs of no length are skipped; of equally near legs the first counts; lines
    of fewer than two points give null.
    """
    legs = lines.select(line, F.posexplode(F.arrays_zip(F.slice("pts", 1, F.greatest(F.size("pts") - 1, F.lit(0))).alias("a"), F.slice("pts", 2, F.greatest(F.size("pts") - 1, F.lit(0))).alias("b"))).alias("leg", "ab"))
    ax, ay, bx, by = F.col("ab.a.x"), F.col("ab.a.y"), F.col("ab.b.x"), F.col("ab.b.y")
    legs = legs.select(line, "leg", ax.alias("ax"), ay.alias("ay"), bx.alias("bx"), by.alias("by"), F.hypot(bx - ax, by - ay).alias("len"))
    run = Window.partitionBy(line).orderBy("leg").rowsBetween(Window.unboundedPreceding, -1)
    legs = legs.withColumn("before", F.coalesce(F.sum("len").over(run), F.lit(0.0))).where("len > 0")
    j = points.join(legs, line, "left")
    t = ((F.col("x") - F.col("ax")) * (F.col("bx") - F.col("ax")) + (F.col("y") - F.col("ay")) * (F.col("by") - F.col("ay"))) / (F.col("len") * F.col("len"))
    t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
    away = F.hypot(F.col("x") - (F.col("ax") + t * (F.col("bx") - F.col("ax"))), F.col("y") - (F.col("ay") + t * (F.col("by") - F.col("ay"))))
    keys = list(dict.fromkeys([*point, line]))
    return j.groupBy(*keys).agg(F.min_by(F.col("before") + t * F.col("len"), F.struct(away, "leg")).alias("arc"))


def order_inline(members: DataFrame, segment: list[str], arc: str, tie: str, reverse: Column | None = None) -> DataFrame:
    """inline_index from 0 and inline_count along each segment, by arc, then document order; both the other way where reverse is true."""
    up = Window.partitionBy(*segment).orderBy(F.col(arc).asc_nulls_last(), tie)
    down = Window.partitionBy(*segment).orderBy(F.col(arc).desc_nulls_last(), F.col(tie).desc())
    n = F.row_number().over(up) if reverse is None else F.when(reverse, F.row_number().over(down)).otherwise(F.row_number().over(up))
    return members.withColumns({"inline_index": n - 1, "inline_count": F.count("*").over(Window.partitionBy(*segment))})


def chain_edges(ordered: DataFrame, segment: list[str], node: str, index: str, reverse: Column | None = None) -> DataFrame:
    """from_id -> to_id of neighbours along each segment; rows without node go; reversed where `reverse` is true; no self loops."""
    w = Window.partitionBy(*segment).orderBy(index)
    e = ordered.where(F.col(node).isNotNull()).withColumn("_next", F.lead(node).over(w)).where(F.col("_next").isNotNull() & (F.col("_next") != F.col(node)))
    r = F.lit(False) if reverse is None else F.coalesce(reverse, F.lit(False))
    return e.select(*segment, F.when(r, F.col("_next")).otherwise(F.col(node)).alias("from_id"), F.when(r, F.col(node)).otherwise(F.col("_next")).alias("to_id"))


def adjacency(edges: DataFrame, a: str = "from_id", b: str = "to_id", scope: list[str] | None = None) -> DataFrame:
    """(node, neighbour, direction out|in|both) of distinct directed edges."""
    s = scope or []
    e = edges.select(*s, F.col(a).alias("node"), F.col(b).alias("neighbour"), F.lit(1).alias("o"), F.lit(0).alias("i")).unionByName(edges.select(*s, F.col(b).alias("node"), F.col(a).alias("neighbour"), F.lit(0).alias("o"), F.lit(1).alias("i")))
    g = e.where("node <> neighbour").groupBy(*s, "node", "neighbour").agg(F.max("o").alias("o"), F.max("i").alias("i"))
    return g.select(*s, "node", "neighbour", F.when((F.col("o") == 1) & (F.col("i") == 1), "both").when(F.col("o") == 1, "out").otherwise("in").alias("direction"))


def in_graph(nodes: DataFrame, edges: DataFrame, node: str, klass: str | None = None, classes: list[str] | None = None, a: str = "from_id", b: str = "to_id") -> DataFrame:
    """Nodes (of the given classes) that are an end of an edge."""
    ends = edges.select(F.col(a).alias(node)).union(edges.select(F.col(b).alias(node))).distinct()
    rows = nodes.where(F.col(klass).isin(classes)) if klass else nodes
    return rows.join(ends, node, "left_semi")


def isolation_sets(edges: DataFrame, nodes: DataFrame, cap: int = 8, skipped: Column | None = None) -> DataFrame:
    """(node, stops, n_stops): for each node that is no stop, the stops that bound the region it reaches without passing one.

    nodes: node, is_stop. Regions are the components of the graph without stops.
    Nodes of skipped classes are walked through but have no row; regions of no or
    over `cap` stops have none either.
    """
    flag = nodes.select("node", "is_stop")
    e = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    # both sides grow with the graph: merged, or Spark would broadcast what is small only as a compressed file
    e = e.join(flag.select(F.col("node").alias("a"), F.col("is_stop").alias("sa")).hint("merge"), "a").join(flag.select(F.col("node").alias("b"), F.col("is_stop").alias("sb")).hint("merge"), "b")
    parts = connected_components(e.where("not sa and not sb"), "a", "b")
    free = flag.where("not is_stop").join(parts.hint("merge"), "node", "left").select("node", F.coalesce("component", "node").alias("component"))
    touch = e.where("sa <> sb").select(F.when(F.col("sa"), F.col("b")).otherwise(F.col("a")).alias("node"), F.when(F.col("sa"), F.col("a")).otherwise(F.col("b")).alias("stop"))
    sets = touch.join(free.hint("merge"), "node").groupBy("component").agg(F.array_sort(F.collect_set("stop")).alias("stops")).where(F.size("stops") <= cap)
    out = free.join(sets.hint("merge"), "component").select("node", "stops", F.size("stops").cast("long").alias("n_stops"))
    return out if skipped is None else out.join(nodes.where(skipped).select("node").hint("merge"), "node", "left_anti")


def wire_equipment(nodes: DataFrame, equipment_tag: str = "Equipment", nozzle_tag: str = "Nozzle") -> DataFrame:
    """Equipment with a tag and at least one nozzle directly in it: id, tag, class, sorted nozzle_ids."""
    n = nodes.where("not in_catalogue")
    nozzle = n.where(F.col("tag") == nozzle_tag).select("content_hash", F.col("parent_ord").alias("ord"), F.col("node_id").alias("nozzle_id"))
    own = n.where(F.col("tag") == equipment_tag).select("content_hash", "document", "ord", F.col("node_id").alias("equipment_id"), F.coalesce(filled(F.col("ga").getItem("ItemTag")), filled(F.col("attrs").getItem("TagName"))).alias("tag"), F.col("attrs").getItem("ComponentClass").alias("equipment_class"))
    return own.where("tag is not null").join(nozzle, ["content_hash", "ord"]).groupBy("content_hash", "document", "equipment_id", "tag", "equipment_class").agg(F.array_sort(F.collect_set("nozzle_id")).alias("nozzle_ids"))


def build_connections(directed: DataFrame, stated: DataFrame, nozzles: DataFrame, scope: list[str] | None = None) -> DataFrame:
    """One row per undirected pair (from_id < to_id): connection_id, flow_sense, derived, conn_type.

    directed: from_id, to_id of known flow or, with flows = false, of adjacency only.
    """
    s = scope or []
    d = directed if "flows" in directed.columns else directed.withColumn("flows", F.lit(True))
    lo, hi = F.least("from_id", "to_id"), F.greatest("from_id", "to_id")
    pair = d.where("from_id <> to_id").select(*s, lo.alias("lo"), hi.alias("hi"), (F.col("flows") & (F.col("from_id") == lo)).alias("fwd"), (F.col("flows") & (F.col("from_id") == hi)).alias("rev"))
    pair = pair.groupBy(*s, "lo", "hi").agg(F.bool_or("fwd").alias("fwd"), F.bool_or("rev").alias("rev"))
    given = stated.select(*s, lo.alias("lo"), hi.alias("hi"), F.lit(True).alias("given")).distinct()
    noz = nozzles.select(*s, F.col(nozzles.columns[-1]).alias("_z")).distinct()
    n1, n2 = noz.select(*s, F.col("_z").alias("lo"), F.lit(True).alias("n1")), noz.select(*s, F.col("_z").alias("hi"), F.lit(True).alias("n2"))
    x = pair.join(given, [*s, "lo", "hi"], "left").join(n1, [*s, "lo"], "left").join(n2, [*s, "hi"], "left")
    flow = F.when(F.col("fwd") & F.col("rev"), "both").when(F.col("fwd"), "forward").when(F.col("rev"), "reverse").otherwise("none")
    kind = F.when(F.coalesce("n1", "n2", F.lit(False)), "Nozzle").otherwise("Process")
    return x.select(*s, edge_id(F.col("lo"), F.col("hi"), kind).alias("connection_id"), F.col("lo").alias("from_id"), F.col("hi").alias("to_id"), kind.alias("conn_type"), F.coalesce(~F.col("given"), F.lit(True)).alias("derived"), flow.alias("flow_sense"))


def edge_id(a: Column, b: Column, kind: Column) -> Column:
    a, b = a.cast("string"), b.cast("string")
    return F.sha2(F.concat_ws("|", F.least(a, b), F.greatest(a, b), kind), 256)


def _linked(pairs: Column, kind: str) -> Column:
    """The connected components of an array of structs (a, b), each an array of its nodes: pair by pair, those that it touches become one."""
    def join(sets, p):
        hit = lambda s: F.array_contains(s, p["a"]) | F.array_contains(s, p["b"])
        return F.concat(F.filter(sets, lambda s: ~hit(s)), F.array(F.array_distinct(F.concat(F.array(p["a"], p["b"]), F.flatten(F.filter(sets, hit))))))

    return F.aggregate(pairs, F.array().cast(f"array<array<{kind}>>"), join)


def drawing_stats(components: DataFrame, edges: DataFrame, drawing: str = "content_hash", node: str = "component_id", klass: str = "component_class", small: int = 64) -> DataFrame:
    """Per drawing: components, valves, valves in the graph, edges, linked nodes and connected components.

    No component spans drawings: those of up to `small` edges are searched in a row of their own each, larger ones together by rounds of joins.
    """
    c = components.groupBy(drawing).agg(F.count("*").alias("n_components"), F.count_if(F.col(klass).isin(VALVES)).alias("n_valves"))
    with scratch() as keep:
        edges = keep(edges.select(drawing, "from_id", "to_id"), "drawn")
        v = in_graph(components, edges, node, klass, VALVES).groupBy(drawing).agg(F.count("*").alias("n_valves_linked"))
        e = edges.groupBy(drawing).agg(F.count("*").alias("n_edges"))
        known = edges.where("from_id is not null and to_id is not null")
        of = lambda size: known.join(e.where(size).select(drawing).hint("merge"), drawing, "left_semi")
        pairs = of(F.col("n_edges") <= small).groupBy(drawing).agg(F.collect_list(F.struct(F.col("from_id").alias("a"), F.col("to_id").alias("b"))).alias("pairs"))
        sets = pairs.select(drawing, _linked(F.col("pairs"), edges.schema["from_id"].dataType.simpleString()).alias("sets"))
        g = sets.select(drawing, F.size(F.flatten("sets")).cast("long").alias("n_nodes"), F.size("sets").cast("long").alias("n_parts"))
        key = lambda x: F.concat_ws("|", drawing, x)
        parts = connected_components(of(F.col("n_edges") > small).select(key("from_id").alias("src"), key("to_id").alias("dst")))
        g = g.unionByName(parts.groupBy(F.substring_index("node", "|", 1).alias(drawing)).agg(F.count("*").alias("n_nodes"), F.countDistinct("component").alias("n_parts")))
        return cut(c.join(v, drawing, "left").join(e, drawing, "left").join(g, drawing, "left").na.fill(0), "drawing-stats")


def dominant(rows: DataFrame, group: list[str], value: str, order: str) -> DataFrame:
    """The most frequent filled value of each group; of equally frequent ones the first seen by `order`."""
    n = rows.where(~blank(F.col(value))).groupBy(*group, value).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    return n.groupBy(*group).agg(F.max_by(value, F.struct("n", -F.col("first"))).alias(value))


def down_tree(tree: DataFrame, marks: DataFrame, node: str, parent: str, mark: str) -> DataFrame:
    """(node, mark): each node's own mark or that of its nearest marked ancestor, however far above; null if none has one.

    Each round doubles how far up a node looks, and takes along only nodes that are still looking, so a
    tree of depth n takes log2(n) rounds. A node without row of its own ends the search, and so does null; nodes on a
    cycle without a mark have none. Of several marks or parents of a node the least counts.
    """
    m = marks.where(F.col(mark).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min(mark).alias("mark"))
    start = tree.where(F.col(node).isNotNull()).groupBy(F.col(node).alias("node")).agg(F.min(parent).alias("up"))
    looking = "mark is null and up is not null"
    with scratch() as keep:
        now = keep(start.join(m, "node", "left"), "tree")
        n_nodes, n = now.agg(F.count("*"), F.count_if(F.expr(looking))).first()
        reach = 1
        # after a round has looked past as many levels as there are nodes, only cycles are left
        while n and reach <= n_nodes:
            above = now.select(F.col("node").alias("up"), F.col("mark").alias("_m"), F.col("up").alias("_u"))
            # a node that has found its mark stays to be looked up by those below it
            step = now.where(looking).join(above, "up", "left").select("node", F.when(F.col("_m").isNull(), F.col("_u")).alias("up"), F.col("_m").alias("mark"))
            before, now = now, keep(step.unionByName(now.where(f"not ({looking})")), "tree")
            drop(before)
            n, reach = now.agg(F.count_if(F.expr(looking))).first()[0], 2 * reach
        return cut(now.select("node", "mark"), "marks")


def line_hierarchy(segments: DataFrame, packages: DataFrame) -> DataFrame:
    """Members per start-up package, unit, system, subline: the package of a unit by the reference table, of most segments where several fit."""
    p = segments.join(packages, "unit", "left")
    best = p.groupBy("pns_tag", "package").agg(F.count("*").alias("n")).groupBy("pns_tag").agg(F.max_by("package", F.struct("n", "package")).alias("package"))
    order = F.regexp_replace("package", r"\D", "")
    return segments.join(best, "pns_tag", "left").groupBy("package", order.alias("package_order"), "unit", "pns_tag", "subline_tag").agg(F.count("*").alias("n_segments"))


def drawing_number(attribute: Column, path: Column) -> Column:
    """The sheet's DrawingNumber attribute; where it is missing or empty, the file's name without folder, .xml and a format suffix."""
    stem = F.regexp_replace(F.regexp_extract(path, r"([^/]*)\z", 1), r"(?i)\.xml\z", "")
    return F.coalesce(F.nullif(attribute, F.lit("")), F.regexp_replace(stem, r"_(Dexpi|Post)\z", ""))
