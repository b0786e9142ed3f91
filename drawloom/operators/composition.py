"""From bi-temporal history to facts: one snapshot of all kinds, mapped together."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawloom.functions.text import blank
from drawloom.operators import facts, rules
from drawloom.operators.facts import CATCH_ALL, ORACLE, iri, unpivot
from drawloom.operators.history import current_truth
from drawloom.tables import cut, scratch

#: What the attributes of each kind hold; what a row lacks is null.
ATTRS = {
    "component": "tag string, component_class string, component_class_uri string, kind string, segment_id string",
    "equipment": "tag string, equipment_class string, nozzle_ids array<string>",
    "connection": "from_id string, to_id string, from_node string, to_node string, conn_type string, derived boolean, flow_sense string",
    "connector": "opctag string, opc_type string, flow_direction string, matched boolean, to_from_text string, on_segment string, component_class_uri string",
}
#: Attributes of a line and of its pieces.
LINE_ATTRS = ["fluid", "unit", "diameter", "piping_materials_class", "insul_type", "insul_purpose", "insul_thick"]
#: Attributes of a piece that belong to the answer key.
ANSWER_KEY = ["start_up_package", "process_unit", "pipeline_system"]
OFF_PAGE = ["OffPage", "Off-Page continuation"]


def line_attrs(attrs: list[str] = LINE_ATTRS, answer_key: list[str] = ANSWER_KEY) -> str:
    many = ", ".join(f"{a} array<string>" for a in attrs)
    one = ", ".join(f"{a}: string" for a in ["segment_id", *attrs, *answer_key])
    return f"{many}, piece_count long, inconsistent boolean, pieces array<struct<{one}>>"


def snapshot(kinds: dict[str, DataFrame], valid: Column | None = None, tx: Column | None = None) -> dict[str, DataFrame]:
    """Each kind's rows at the same pair of times, with the attributes as columns and `unreadable` where they aren't JSON of an object.

    kinds: history rows (anchor, attrs, valid_from, valid_to, tx_from, tx_to) of component, equipment, connection, connector and line; kinds may be left out.
    With one time given the other axis is free, with none rows open on both count (see history.current_truth).
    """
    out = {}
    for kind, rows in kinds.items():
        schema = {**ATTRS, "line": line_attrs()}[kind]
        x = F.from_json("attrs", f"{schema}, _bad string", {"columnNameOfCorruptRecord": "_bad"})
        now = current_truth(rows, valid, tx).select(F.col("anchor").cast("string").alias("anchor"), x.alias("_x"), "valid_from", "valid_to", "tx_from", "tx_to")
        out[kind] = now.select("anchor", "_x.*", "valid_from", "valid_to", "tx_from", "tx_to").withColumnRenamed("_bad", "unreadable")
    return out


def classes_by_tag(components: DataFrame) -> DataFrame:
    """(tag, harvested): what the component rows that repeat an equipment item say of its class; of several the latest, then the largest anchor."""
    told = components.where((F.col("kind") == "Equipment") & ~blank(F.col("tag")) & ~blank(F.col("component_class")))
    return told.groupBy("tag").agg(F.max_by("component_class", F.struct("valid_from", "tx_from", "anchor", "component_class")).alias("harvested"))


def equipment_with_classes(equipment: DataFrame, components: DataFrame) -> DataFrame:
    """equipment with its own class, or that of the component rows of the same tag."""
    j = equipment.join(classes_by_tag(components), "tag", "left")
    return j.withColumn("equipment_class", F.when(blank(F.col("equipment_class")), F.col("harvested")).otherwise(F.col("equipment_class"))).drop("harvested")


def class_quads(components: DataFrame, by_uri: DataFrame, by_label: DataFrame, boundary: DataFrame) -> DataFrame:
    """What is known of each class that a component has: its place in the tree, and its match in the reference library or that it waits for one."""
    known = components.where(~blank(F.col("component_class")) & ~F.col("component_class").isin(CATCH_ALL))
    pairs = known.select("component_class", "component_class_uri").distinct()
    forming = rules.boundary_forming(pairs.select("component_class").distinct(), boundary).withColumn("forming", F.lit(True))
    r = rules.resolve_class(pairs.join(forming, "component_class", "left"), "component_class_uri", "component_class", by_uri, by_label, F.coalesce("forming", F.lit(False)))
    return unpivot(r, iri("class", F.col("component_class")), [
        ("rdfs:subClassOf", F.lit("urn:plant:class/Component"), "iri"), ("rdlMatch", F.col("resolved_uri"), "iri"), ("rdlMatchType", F.col("bridge"), "string"),
        ("pendingReview", F.when(F.col("pending_review"), F.lit("true")), "boolean"), ("rdlPending", F.when(F.col("resolved_uri").isNull(), F.lit("true")), "boolean"),
    ])


def component_facts(rows: DataFrame) -> DataFrame:
    """Of components; a blank or catch-all class is left out as a literal."""
    klass = F.when(~blank(F.col("component_class")) & ~F.col("component_class").isin(CATCH_ALL), F.col("component_class"))
    out = facts.component_quads(rows, "anchor", "component_class", "tag", iri("segment", F.col("segment_id")))
    return out.unionByName(unpivot(rows, iri("component", F.col("anchor")), [("componentClass", klass, "string")]))


def equipment_facts(rows: DataFrame) -> DataFrame:
    """Of equipment, its nozzles and its classes, which are a tree of their own."""
    klass = F.when(~blank(F.col("equipment_class")), F.col("equipment_class"))
    rows = rows.withColumn("equipment_class", klass)
    own = unpivot(rows, iri("equipment", F.col("anchor")), [("rdf:type", iri("class", F.col("equipment_class")), "iri")])
    tree = unpivot(rows.select("equipment_class").distinct(), iri("class", F.col("equipment_class")), [("rdfs:subClassOf", F.lit("urn:plant:class/Equipment"), "iri"), ("rdlPending", F.lit("true"), "boolean")])
    nozzles = rows.select("anchor", F.explode("nozzle_ids").alias("n"))
    of = unpivot(nozzles, iri("nozzle", F.col("n")), [("rdf:type", F.lit("urn:plant:class/Nozzle"), "iri"), ("partOf", iri("equipment", F.col("anchor")), "iri")])
    return reduce(DataFrame.unionByName, [facts.equipment_quads(rows, "anchor", "tag", "equipment_class", "nozzle_ids"), own, tree, of])


def connection_facts(rows: DataFrame) -> DataFrame:
    """Of connections; off-page ones join connectors, others components."""
    rows = rows.withColumnRenamed("anchor", "connection_id").withColumn("flow_sense", F.coalesce("flow_sense", F.lit("none")))
    off = F.coalesce(F.col("conn_type").isin(OFF_PAGE), F.lit(False))
    more = unpivot(rows, iri("connection", F.col("connection_id")), [("flowSense", F.col("flow_sense"), "string"), ("fromNode", F.col("from_node"), "string"), ("toNode", F.col("to_node"), "string")])
    return facts.connection_quads(rows.where(~off)).unionByName(facts.connection_quads(rows.where(off), "opc")).unionByName(more)


def connector_facts(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("to_from", F.struct(F.col("to_from_text").alias("text")))
    return facts.opc_quads(rows, "anchor").unionByName(unpivot(rows, iri("opc", F.col("anchor")), [("componentClassUri", F.col("component_class_uri"), "iri")]))


def line_facts(rows: DataFrame, attrs: list[str] = LINE_ATTRS, answer_key: list[str] = ANSWER_KEY) -> DataFrame:
    """Of lines, all values of each attribute, and of their pieces, which hold as long as the line's row does; answer-key columns only in their own graph."""
    s = iri("line", F.col("anchor"))
    out = facts.line_quads(rows, ["anchor"], attrs)
    out = out.unionByName(unpivot(rows, s, [("pieceCount", F.col("piece_count"), "integer"), ("attrInconsistent", F.col("inconsistent").cast("string"), "boolean")]))
    pieces = rows.select(F.col("anchor").alias("_line"), F.explode("pieces").alias("_p"), "valid_from", "valid_to", "tx_from", "tx_to").select("_line", "_p.*", "valid_from", "valid_to", "tx_from", "tx_to")
    out = out.unionByName(facts.segment_quads(pieces, "segment_id", attrs, answer_key, iri("line", F.col("_line"))))
    return out.unionByName(facts.temporal_quads(pieces, iri("segment", F.col("segment_id"))))


def confined(quads: DataFrame, predicates: list[str], home: str = ORACLE) -> DataFrame:
    """quads, with an error when they are read if one of the answer key's predicates stands outside its graph."""
    leak = F.col("p").isin(predicates) & (F.col("graph") != home)
    return quads.where(F.when(leak, F.raise_error(F.concat(F.lit("answer key outside its graph: "), "p", F.lit(" of "), "s"))).otherwise(F.lit(True)).cast("boolean"))


def rejects(now: dict[str, DataFrame]) -> DataFrame:
    """(kind, anchor, reason) of rows that are not mapped, and of lines that are, but without pieces."""
    reasons = {
        "component": F.when(F.col("kind") == "Equipment", "equipment_duplicate"),
        "connection": F.when(F.col("derived").isNull(), "derived_not_told"),
        "line": F.when(F.coalesce(F.size("pieces"), F.lit(0)) < 1, "line_without_pieces"),
    }
    out = []
    for kind, rows in now.items():
        told = F.when(F.col("anchor").isNull(), "no_identity").when(F.col("unreadable").isNotNull(), "attrs_unreadable")
        out.append(rows.select(F.lit(kind).alias("kind"), "anchor", F.coalesce(told, reasons.get(kind, F.lit(None).cast("string"))).alias("reason")).where("reason is not null"))
    return reduce(DataFrame.unionByName, out)


def build_dataset(kinds: dict[str, DataFrame], fluids: DataFrame, boundary: DataFrame, by_uri: DataFrame, by_label: DataFrame, valid: Column | None = None, tx: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(facts, rejects) of all kinds' histories at one pair of times.

    fluids: fluid_code, category, subcategory; boundary: component_class, role; by_uri: key, target,
    match_type; by_label: key, target. Component rows of kind Equipment repeat an item of the equipment
    table: they give it their class by its tag and are rejected. Connections that don't say whether they are
    derived are rejected, lines without pieces are mapped and told. Facts are a set: rows that
    say the same give one. Empty tables give the reference facts alone.
    """
    with scratch() as keep:
        # each kind is read once, however many of its properties become facts
        now = {k: keep(v, f"snapshot-{k}") for k, v in snapshot(kinds, valid, tx).items()}
        bad = cut(rejects(now), "rejects")
        return cut(confined(_all_facts(now, fluids, boundary, by_uri, by_label).distinct(), ANSWER_KEY), "facts"), bad


def _all_facts(now: dict[str, DataFrame], fluids: DataFrame, boundary: DataFrame, by_uri: DataFrame, by_label: DataFrame) -> DataFrame:
    good = {k: v.where("anchor is not null and unreadable is null") for k, v in now.items()}
    spark = fluids.sparkSession
    out = [facts.ontology_skeleton(spark), facts.refdata_quads(fluids, boundary)]
    put = lambda rows, kind, quads: out.extend([quads, facts.temporal_quads(rows, iri(kind, F.col("anchor")))])
    if "component" in good:
        parts = good["component"].where("not coalesce(kind = 'Equipment', false)")
        put(parts, "component", component_facts(parts))
        out.append(class_quads(parts, by_uri, by_label, boundary))
    if "equipment" in good:
        gear = equipment_with_classes(good["equipment"], good["component"]) if "component" in good else good["equipment"]
        put(gear, "equipment", equipment_facts(gear))
    if "connection" in good:
        edges = good["connection"].where("derived is not null")
        put(edges, "connection", connection_facts(edges))
    if "connector" in good:
        put(good["connector"], "opc", connector_facts(good["connector"]))
    if "line" in good:
        put(good["line"], "line", line_facts(good["line"]))
    return reduce(DataFrame.unionByName, out)

