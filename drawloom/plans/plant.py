"""From files of drawings to object tables, change, stitch and facts: the operators in their order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawloom.functions.text import blank, filled
from drawloom.operators import cdc, quality, topology
from drawloom.operators.tags import Field, compose, decode
from drawloom.sources.xml import SEGMENT

#: Tag templates of the dash-separated convention: item, system, segment, subline.
ITEM = [[Field("fluid", required=True)], [Field("core", required=True)]]
SEGMENT_TAG = [[Field("diameter")], [Field("fluid", required=True)], [Field("core", required=True)], [Field("class")], [Field("purpose")]]

# Generic attribute names of segment columns, the first populated one counts.
SEGMENT_ATTRS = {
    "fluid": ["OperFluidCode", "FluidCode"], "diameter": ["NominalDiameter"], "piping_materials_class": ["PipingMaterialsClass", "PipingClass"], "insul_type": ["InsulType"], "insul_purpose": ["InsulPurpose"],
    "insul_thick": ["InsulThick"], "item_tag": ["ItemTag"], "tag_suffix": ["TagSuffix"], "src_turnover": ["TurnoverSystem", "src_turnover"], "src_subsystem": ["TurnoverSubsystem", "src_subsystem"],
}
ANSWER_KEY = ["src_turnover", "src_subsystem"]


def read_segment_attrs(nodes: DataFrame) -> DataFrame:
    """Segments with their attributes; a tag only in TagName counts as the item tag."""
    rows = nodes.where((F.col("tag") == SEGMENT) & ~F.col("in_catalogue") & F.col("node_id").isNotNull())
    get = lambda names: F.coalesce(*[filled(F.col("ga").getItem(n)) for n in names])
    cols = {c: get(names) for c, names in SEGMENT_ATTRS.items()}
    cols["item_tag"] = F.coalesce(cols["item_tag"], filled(F.col("attrs").getItem("TagName")))
    return rows.dropDuplicates(["content_hash", "node_id"]).select("content_hash", "document", "ord", F.col("node_id").alias("segment_id"), F.col("parent_id").alias("system_id"), "pts", *[v.alias(c) for c, v in cols.items()])


def segments(nodes: DataFrame) -> DataFrame:
    """Segments with decoded unit and composed tags."""
    s = read_segment_attrs(nodes)
    s = s.withColumn("_d", decode(F.col("item_tag"), F.col("fluid")))
    core = F.substring_index("item_tag", "-", -1)
    f = {"fluid": F.col("fluid"), "core": core, "diameter": F.col("diameter"), "class": F.col("piping_materials_class"), "purpose": F.col("insul_purpose")}
    line = dict(f, core=F.when(~blank(F.col("tag_suffix")), F.regexp_replace(core, F.concat(F.col("tag_suffix"), F.lit("$")), "")).otherwise(core))
    return s.withColumns({"unit": F.col("_d.unit"), "seg_tag": F.coalesce(compose(SEGMENT_TAG, f), F.col("item_tag")), "subline_tag": compose(ITEM, f), "pns_tag": compose(ITEM, line)}).drop("_d", "tag_suffix")


def components(nodes: DataFrame, dialect: str = "POSTPROC") -> DataFrame:
    """Components with their place along the segment, by arc of their connection points or location, then document order."""
    c = topology.extract_objects(nodes, topology.COMPONENT_TAGS[dialect])
    lines = nodes.where(F.col("tag") == SEGMENT).select(F.concat_ws("|", "content_hash", "node_id").alias("line"), "pts")
    at = F.when(F.size("nodes") > 0, F.transform("nodes", lambda n: F.struct(n["x"].alias("x"), n["y"].alias("y")))).otherwise(F.array(F.struct("x", "y")))
    points = c.where("segment_id is not null").select(F.concat_ws("|", "content_hash", "segment_id").alias("line"), "content_hash", "component_id", F.explode(at).alias("p")).select("line", "content_hash", "component_id", "p.x", "p.y")
    arcs = topology.arc_position(points, lines, ["content_hash", "component_id", "x", "y"], "line").groupBy("content_hash", "component_id").agg(F.avg("arc").alias("arc"))
    on = c.where("segment_id is not null").join(arcs, ["content_hash", "component_id"], "left")
    ordered = topology.order_inline(on, ["content_hash", "segment_id"], "arc", "ord")
    off = c.where("segment_id is null").withColumns({"arc": F.lit(None).cast("double"), "inline_index": F.lit(None).cast("int"), "inline_count": F.lit(None).cast("long")})
    return ordered.unionByName(off, allowMissingColumns=True).withColumn("is_valve", F.coalesce(F.col("component_class").isin(topology.VALVES), F.lit(False)))


def connections(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """Edges of neighbours along segments, and of equipment with its nozzles."""
    chain = topology.chain_edges(parts.where("segment_id is not null"), ["content_hash", "segment_id"], "component_id", "inline_index").select("content_hash", "from_id", "to_id").withColumn("flows", F.lit(True))
    wired = topology.wire_equipment(nodes).select("content_hash", F.col("equipment_id").alias("from_id"), F.explode("nozzle_ids").alias("to_id"), F.lit(False).alias("flows"))
    stated = topology.raw_edges(nodes).select("content_hash", "from_id", "to_id")
    return topology.build_connections(chain.unionByName(wired), stated, wired.select("content_hash", F.col("from_id").alias("node")).union(wired.select("content_hash", "to_id")), ["content_hash"])


def silver(nodes: DataFrame, dialect: str = "POSTPROC") -> dict[str, DataFrame]:
    c = components(nodes, dialect)
    return {"components": c, "segments": segments(nodes), "equipment": topology.wire_equipment(nodes), "connections": connections(nodes, c)}


def plant_cdc(old: dict[str, DataFrame], new: dict[str, DataFrame]) -> DataFrame:
    """Deltas of lines, components and equipment between two versions of drawings (the document column says which belong together).

    Lines have attributes as sets and their components' classes in order (routing); components are
    buckets of (line, class) with the attributes of their line's position; equipment has its number of nozzles.
    """
    def shapes(v):
        seg = v["segments"].withColumn("drawing", F.element_at(F.split("document", "/"), -1))
        attrs = ["fluid", "unit", "diameter", "piping_materials_class", "insul_type", "insul_purpose", "insul_thick"]
        line = cdc.aggregate_lines(seg, ["drawing", "seg_tag"], "segment_id", attrs, quality.uncomposable(F.col("subline_tag")))
        line = line.select("drawing", F.col("seg_tag").alias("anchor_tag"), F.element_at("piece_ids", 1).alias("uid"), *[F.array_join(a, ",").alias(a) for a in attrs])
        parts = v["components"].where("kind not in ('Equipment', 'Nozzle', 'PipeOffPageConnector') and segment_id is not null")
        parts = parts.join(seg.select("content_hash", "segment_id", "drawing", "seg_tag"), ["content_hash", "segment_id"])
        parts = cdc.enrich_neighbours(parts.withColumn("_anchor", cdc.anchor("drawing", "seg_tag", "component_class")), v["connections"], "component_id", "_anchor", ["content_hash"])
        part = parts.select("drawing", "seg_tag", "component_class", F.col("component_id").alias("uid"), "tag", F.array_join("neighbours", ";").alias("connectivity"), F.array_join("outgoing", ";").alias("flow_direction"), "inline_index")
        gear = v["equipment"].select("tag", F.col("equipment_id").alias("uid"), "equipment_class", F.size("nozzle_ids").alias("nozzle_count"), F.element_at(F.split("document", "/"), -1).alias("drawing"))
        return attrs, line, part, gear

    attrs, l0, p0, g0 = shapes(old)
    _, l1, p1, g1 = shapes(new)
    return cdc.run_cdc({
        "line": (l0, l1, ["drawing", "anchor_tag"], "uid", attrs, None),
        "component": (p0, p1, ["drawing", "seg_tag", "component_class"], "uid", ["tag", "connectivity", "flow_direction"], "inline_index"),
        "equipment": (g0, g1, ["tag"], "uid", ["equipment_class", "nozzle_count"], None),
    })
