"""Facts as one long table (graph, s, p, o, o_kind, o_datatype), partitioned by graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawloom.functions.text import blank
from drawloom.sources.triples import to_lines

MASTER, ORACLE, REFDATA, TEMPORAL, INFERRED = "masterdata", "oracle", "refdata", "temporal", "inferred"
#: Class names that a source gives where it knows none.
CATCH_ALL = ["CustomPipingComponent", "CustomEquipment", "CustomInstrumentationLoopFunction", "CustomObject"]
XSD = {"boolean": "boolean", "int": "integer", "bigint": "integer", "double": "double", "float": "double", "date": "date", "timestamp": "dateTime", "string": "string"}


def iri(kind: str, *parts: Column) -> Column:
    """The name of an object by the parts that are not null; null if none is."""
    text = [p.cast("string") for p in parts]
    return F.when(F.coalesce(*text).isNotNull(), F.concat(F.lit(f"urn:plant:{kind}/"), F.concat_ws("/", *text)))


def unpivot(rows: DataFrame, subject: Column, properties: list[tuple], graph: str = MASTER) -> DataFrame:
    """A quad for each row and property whose object is not null.

    properties: (predicate, column, kind iri or an XSD type name[, graph]).
    """
    structs = [F.struct(F.lit(p[3] if len(p) > 3 else graph).alias("graph"), F.lit(p[0]).alias("p"), p[1].cast("string").alias("o"), F.lit("iri" if p[2] == "iri" else "literal").alias("o_kind"), (F.lit(None).cast("string") if p[2] == "iri" else F.lit(p[2])).alias("o_datatype")) for p in properties]
    x = rows.select(subject.alias("s"), F.explode(F.array(*structs)).alias("q")).where("s is not null and q.o is not null")
    return x.select("q.graph", "s", "q.p", "q.o", "q.o_kind", "q.o_datatype")


def ontology_skeleton(spark) -> DataFrame:
    """The classes of the model and their subclass edges."""
    # Class, superclass.
    tree = [
        ("PlantObject", None), ("Component", "PlantObject"), ("Valve", "Component"), ("UnclassifiedComponent", "Component"), ("PipingSegment", "PlantObject"), ("PipingLine", "PlantObject"),
        ("Equipment", "PlantObject"), ("Nozzle", "PlantObject"), ("Connection", "PlantObject"), ("OffPageConnector", "Component"), ("Drawing", "PlantObject"), ("System", "PlantObject"),
        ("UtilitySystem", "System"), ("ProcessSystem", "System"), ("Fluid", "PlantObject"), ("BoundaryRole", "PlantObject"), ("Function", "PlantObject"),
    ]
    rows = [(MASTER, f"urn:plant:class/{c}", "rdf:type", "owl:Class", "iri", None) for c, _ in tree] + [(MASTER, f"urn:plant:class/{c}", "rdfs:subClassOf", f"urn:plant:class/{u}", "iri", None) for c, u in tree if u]
    return spark.createDataFrame(rows, "graph string, s string, p string, o string, o_kind string, o_datatype string")


def component_class(c: Column) -> Column:
    """The class to assert: unclassified where it is blank or a catch-all."""
    return F.when(blank(c) | c.isin(CATCH_ALL), F.lit("UnclassifiedComponent")).otherwise(c)


def component_quads(rows: DataFrame, id_col: str, klass: str, tag: str | None = None, part_of: Column | None = None, uri: str | None = None, pending: Column | None = None) -> DataFrame:
    s = iri("component", F.col(id_col))
    props = [("rdf:type", iri("class", component_class(F.col(klass))), "iri"), ("needsReview", F.when(blank(F.col(klass)) | F.col(klass).isin(CATCH_ALL), F.lit("true")), "boolean")]
    if tag:
        props.append(("tag", F.when(~blank(F.col(tag)), F.col(tag)), "string"))
    if part_of is not None:
        props.append(("partOf", part_of, "iri"))
    if uri:
        props.append(("rdlMatch", F.col(uri), "iri"))
    if pending is not None:
        props.append(("pendingReview", F.when(pending, F.lit("true")), "boolean"))
    return unpivot(rows, s, props)


def segment_quads(rows: DataFrame, id_col: str, attrs: list[str], answer_key: list[str], line: Column | None = None) -> DataFrame:
    """Attributes into the master graph, answer-key columns into their own graph only."""
    props = [("rdf:type", F.lit("urn:plant:class/PipingSegment"), "iri")] + [(a, F.col(a), "string") for a in attrs] + [(a, F.col(a), "string", ORACLE) for a in answer_key]
    if line is not None:
        props.append(("partOf", line, "iri"))
    return unpivot(rows, iri("segment", F.col(id_col)), props)


def line_quads(rows: DataFrame, keys: list[str], multi: list[str]) -> DataFrame:
    """A quad for each value of the array columns of aggregated lines."""
    out = unpivot(rows, iri("line", *[F.col(k) for k in keys]), [("rdf:type", F.lit("urn:plant:class/PipingLine"), "iri")])
    for m in multi:
        out = out.unionByName(unpivot(rows.select(*keys, F.explode(m).alias("_v")), iri("line", *[F.col(k) for k in keys]), [(m, F.col("_v"), "string")]))
    return out


def equipment_quads(rows: DataFrame, id_col: str, tag: str, klass: str | None, nozzles: str | None) -> DataFrame:
    s = iri("equipment", F.col(id_col))
    out = unpivot(rows, s, [("rdf:type", F.lit("urn:plant:class/Equipment"), "iri"), ("tag", F.col(tag), "string"), *([("equipmentClass", F.col(klass), "string")] if klass else [])])
    if nozzles:
        out = out.unionByName(unpivot(rows.select(id_col, F.explode(nozzles).alias("_n")), s, [("hasNozzle", iri("nozzle", F.col("_n")), "iri")]))
    return out


def connection_quads(rows: DataFrame, node: str = "component") -> DataFrame:
    """The reified edge, connectedTo both ways and flowsTo by flow_sense; derived is mandatory."""
    a, b = iri(node, F.col("from_id")), iri(node, F.col("to_id"))
    props = [("rdf:type", F.lit("urn:plant:class/Connection"), "iri"), ("from", a, "iri"), ("to", b, "iri"), ("derived", F.col("derived").cast("string"), "boolean"), ("connType", F.col("conn_type"), "string")]
    out = unpivot(rows, iri("connection", F.col("connection_id")), props)
    fwd, rev = F.col("flow_sense").isin("forward", "both"), F.col("flow_sense").isin("reverse", "both")
    ahead = unpivot(rows, a, [("connectedTo", b, "iri"), ("flowsTo", F.when(fwd, b), "iri")])
    return out.unionByName(ahead).unionByName(unpivot(rows, b, [("connectedTo", a, "iri"), ("flowsTo", F.when(rev, a), "iri")]))


def opc_quads(rows: DataFrame, id_col: str = "eid") -> DataFrame:
    """Connectors; one ends on its segment unless its flow_direction (if rows has it) is a signal's or its type an instrument's, as its business type does not tell a pipe."""
    s = iri("opc", F.col(id_col))
    flow = F.col("flow_direction").cast("string") if "flow_direction" in rows.columns else F.lit(None).cast("string")
    has = lambda c, part: F.coalesce(F.lower(c).contains(part), F.lit(False))
    piping = ~has(flow, "signal") & ~has(F.col("opc_type"), "instrument")
    return unpivot(rows, s, [("rdf:type", F.lit("urn:plant:class/OffPageConnector"), "iri"), ("tag", F.col("opctag"), "string"), ("opcType", F.col("opc_type"), "string"), ("flowSense", flow, "string"), ("matched", F.col("matched").cast("string"), "boolean"), ("toFrom", F.col("to_from.text"), "string"), ("terminates", F.when(piping, iri("segment", F.col("on_segment"))), "iri")])


def refdata_quads(fluids: DataFrame, boundary: DataFrame, crosswalk: DataFrame | None = None) -> DataFrame:
    out = unpivot(fluids, iri("fluid", F.col("fluid_code")), [("rdf:type", F.lit("urn:plant:class/Fluid"), "iri"), ("category", F.col("category"), "string"), ("subcategory", F.nullif(F.col("subcategory"), F.lit("")), "string")], REFDATA)
    out = out.unionByName(unpivot(boundary, iri("class", F.col("component_class")), [("boundaryRole", F.col("role"), "string")], REFDATA))
    if crosswalk is not None:
        out = out.unionByName(unpivot(crosswalk, F.col("rds_uri"), [("closeMatch", F.when(F.col("match_type") == "close", F.col("plm_uri")), "iri"), ("exactMatch", F.when(F.col("match_type") == "exact", F.col("plm_uri")), "iri")], REFDATA))
    return out


def contradictions(boundary: DataFrame) -> DataFrame:
    """Classes with more than one role."""
    return boundary.groupBy("component_class").agg(F.array_sort(F.collect_set("role")).alias("roles")).where(F.size("roles") > 1)


def system_quads(members: DataFrame, member: Column, system: str) -> DataFrame:
    """Membership through a function node, never directly."""
    s = iri("system", F.col(system))
    f = F.concat(s, F.lit("/function"))
    out = unpivot(members.select(system).distinct(), s, [("rdf:type", F.lit("urn:plant:class/System"), "iri"), ("hasFunction", f, "iri")])
    return out.unionByName(unpivot(members, member, [("participatesIn", f, "iri")]))


def temporal_quads(rows: DataFrame, subject: Column) -> DataFrame:
    return unpivot(rows, subject, [("validFrom", F.col("valid_from"), "date"), ("validTo", F.col("valid_to"), "date"), ("txFrom", F.col("tx_from"), "dateTime"), ("txTo", F.col("tx_to"), "dateTime")], TEMPORAL)


def leaked(quads: DataFrame, forbidden: list[str], home: str = ORACLE) -> DataFrame:
    """Answer-key predicates outside their graph; must be empty."""
    return quads.where(F.col("p").isin(forbidden) & (F.col("graph") != home))


def match(quads: DataFrame, s: str | None = None, p: str | None = None, o: str | None = None, graph: str | None = None) -> DataFrame:
    out = quads
    for c, v in (("s", s), ("p", p), ("o", o), ("graph", graph)):
        if v is not None:
            out = out.where(F.col(c) == v)
    return out


def predicates_used(quads: DataFrame) -> DataFrame:
    return quads.groupBy("graph", "p").agg(F.count("*").alias("n"))


def merge(*quads: DataFrame) -> DataFrame:
    """The union as a set; dealt out first, so that no task that reads a file holds all facts made of it."""
    out = quads[0]
    for q in quads[1:]:
        out = out.unionByName(q)
    return out.repartition(*out.columns).distinct()


def wide(quads: DataFrame, predicates: list[str], graph: str | None = None) -> DataFrame:
    """One row per subject with the least object of each predicate."""
    q = quads.where(F.col("p").isin(predicates)) if graph is None else quads.where(F.col("p").isin(predicates) & (F.col("graph") == graph))
    return q.groupBy("s").agg(*[F.min(F.when(F.col("p") == p, F.col("o"))).alias(p.split(":")[-1]) for p in predicates])


def fingerprint(quads: DataFrame) -> DataFrame:
    """Per graph the number of distinct lines and an order-free combination of their hashes."""
    lines = to_lines(quads, graphs=True).select("value", F.regexp_extract("value", r"<([^>]*)> \.$", 1).alias("graph")).distinct()
    h = F.sha2("value", 256)
    word = lambda i: F.bit_xor(F.conv(F.substr(h, F.lit(1 + 15 * i), F.lit(15)), 16, 10).cast("long"))
    return lines.groupBy("graph").agg(F.count("*").alias("n"), F.concat_ws("-", *[F.lpad(F.lower(F.hex(word(i))), 15, "0") for i in range(4)]).alias("fingerprint"))


def write_graphs(quads: DataFrame, path: str) -> None:
    """Replace the graphs that quads has, leave the others."""
    quads.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("graph").parquet(path)
