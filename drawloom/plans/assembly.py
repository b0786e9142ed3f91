"""From history to facts, systems and master data on the given tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from drawloom.operators import composition, conventions, history, naming, quality, stitch, systems, topology
from drawloom.operators.naming_rules import Link, Rule, resolve_fields
from drawloom.plans import streams
from drawloom.plans.change import t
from drawloom.tables import cut

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


KINDS = ["component", "equipment", "connection", "connector", "line"]


def plant_history(spark, d):
    """Each conversation as a plant object whose kind follows from its id; each turn a version of it, two turns of one valid date."""
    c = t(spark, d, "conversations").select("conv_id", "turn", "role", F.char_length("text").cast("long").alias("n"))
    one = lambda *xs: F.element_at(F.array(*[F.lit(x) for x in xs]), (F.col("n") % len(xs) + 1).cast("int"))
    text = lambda *xs: F.concat(*[F.lit(x) if isinstance(x, str) else x.cast("string") for x in xs])
    ids, n = F.col("conv_id"), F.col("n")
    tag = text("T", F.expr("conv_id div 5 % 300"))
    piece = lambda i: F.struct(text("P", ids, "-", F.lit(i)).alias("segment_id"), F.col("role").alias("fluid"), (n % 4 + i).cast("string").alias("diameter"), one("A", "B", "C").alias("process_unit"))
    shapes = {
        "component": F.struct(tag.alias("tag"), one("GateValve", "BallValve", "CustomObject", "", "Drum").alias("component_class"), F.when(n % 3 == 0, text("rds:", one("GateValve", "BallValve", "CustomObject", "", "Drum"))).alias("component_class_uri"), F.when(ids % 15 == 0, "Equipment").otherwise("Piping").alias("kind"), text("P", n % 50).alias("segment_id")),
        "equipment": F.struct(tag.alias("tag"), F.when(n % 4 == 0, "Vessel").alias("equipment_class"), F.slice(F.array(text(ids, "-1"), text(ids, "-2")), F.lit(1), (n % 3).cast("int")).alias("nozzle_ids")),
        "connection": F.struct(text(ids - 2).alias("from_id"), text(ids + 3).alias("to_id"), F.when(n % 5 == 0, "OffPage").otherwise("Piping").alias("conn_type"), F.when(n % 11 != 0, n % 2 == 0).alias("derived"), one("forward", "reverse", "both", "none").alias("flow_sense")),
        "connector": F.struct(text("O", ids).alias("opctag"), one("PipingOffUnit", "InstrumentOffUnit").alias("opc_type"), F.when(n % 3 == 0, "FlowIn").alias("flow_direction"), (n % 2 == 0).alias("matched"), F.col("role").alias("to_from_text"), text("P", n % 50).alias("on_segment")),
        "line": F.struct(F.array("role").alias("fluid"), F.array_distinct(F.array((n % 4).cast("string"), (n % 6).cast("string"))).alias("diameter"), (n % 3).alias("piece_count"), (n % 4 != n % 6).alias("inconsistent"), F.slice(F.array(piece(1), piece(2)), F.lit(1), (n % 3).cast("int")).alias("pieces")),
    }
    attrs = F.to_json(shapes[KINDS[-1]])
    for i, k in enumerate(KINDS[:-1]):
        attrs = F.when(ids % 5 == i, F.to_json(shapes[k])).otherwise(attrs)
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.expr("turn div 2 * 10") + ids % 7).cast("int"))
    tx = F.timestamp_seconds(F.lit(1704067200) + F.col("turn") * 864000 + ids % 5 * 3600)
    events = c.select("conv_id", F.lit("Modified").alias("change_type"), attrs.alias("attrs"), day.alias("valid_from"), tx.alias("tx"), F.lpad(F.col("turn").cast("string"), 6, "0").alias("delta_id"))
    rows, _ = history.apply_events(events, ["conv_id"])
    rows = cut(rows.withColumnRenamed("conv_id", "anchor"), "history")
    return {k: rows.where(F.col("anchor") % 5 == i) for i, k in enumerate(KINDS)}


_HISTORY = """WITH c AS (SELECT conv_id AS id, turn, role, CAST(length(text) AS BIGINT) AS n FROM conversations),
k AS (SELECT *, ['GateValve', 'BallValve', 'CustomObject', '', 'Drum'][n % 5 + 1] AS class FROM c),
v AS (SELECT *, DATE '2024-01-01' + CAST(turn // 2 * 10 + id % 7 AS INT) AS day, make_timestamp((1704067200 + turn * 864000 + id % 5 * 3600) * 1000000) AS ts,
  CASE id % 5 WHEN 0 THEN concat_ws('|', class, n % 3 = 0, n % 50) WHEN 1 THEN concat_ws('|', n % 4 = 0, n % 3) WHEN 2 THEN concat_ws('|', n % 5 = 0, n % 11 = 0, n % 2, n % 4) WHEN 3 THEN concat_ws('|', n % 2, n % 3 = 0, n % 50, role)
  ELSE concat_ws('|', role, n % 4, n % 6, n % 3) END AS attrs FROM k),
e AS (SELECT *, lag(attrs) OVER w AS before FROM v WINDOW w AS (PARTITION BY id ORDER BY ts, turn)),
x AS (SELECT *, lead(ts) OVER w AS nts, lead(day) OVER w AS nday FROM e WHERE before IS NULL OR before <> attrs WINDOW w AS (PARTITION BY id ORDER BY ts, turn)),
h AS (SELECT *, CASE WHEN nday > day THEN nday END AS valid_to, CASE WHEN nday = day THEN nts END AS tx_to FROM x),
s AS (SELECT * FROM h WHERE day <= DATE '2024-01-15' AND (valid_to IS NULL OR DATE '2024-01-15' < valid_to) AND ts <= TIMESTAMP '2024-01-25 12:00:00' AND (tx_to IS NULL OR TIMESTAMP '2024-01-25 12:00:00' < tx_to)) """


def history_facts(spark, d):
    fluids = spark.createDataFrame([("user", "Process", ""), ("assistant", "Utility", "Steam")], "fluid_code string, category string, subcategory string")
    boundary = spark.createDataFrame([("GateValve", "isolation"), ("Drum", "none")], "component_class string, role string")
    by_uri = spark.createDataFrame([("rds:BallValve", "plm:Ball", "exact"), ("rds:GateValve", "plm:Gate", "close")], "key string, target string, match_type string")
    by_label = spark.createDataFrame([("GateValve", "plm:GateByLabel")], "key string, target string")
    return composition.build_dataset(plant_history(spark, d), fluids, boundary, by_uri, by_label, F.lit("2024-01-15").cast("date"), F.lit("2024-01-25 12:00:00").cast("timestamp"))


def _told(graph, s, p, o, kind, datatype, source, where="true"):
    return f"SELECT '{graph}' AS graph, {s} AS s, '{p}' AS p, CAST({o} AS VARCHAR) AS o, '{kind}' AS o_kind, {datatype and repr(datatype) or 'NULL'} AS o_datatype FROM {source} WHERE ({where}) AND {s} IS NOT NULL AND {o} IS NOT NULL"


def _facts_sql():
    m, c = "masterdata", lambda k: f"'urn:plant:{k}/' || "
    klass = lambda k: f"'urn:plant:class/{k}'"
    out = []

    def put(s, p, o, kind, source, where="true", graph=m):
        out.append(_told(graph, s, p, o, "iri" if kind == "iri" else "literal", None if kind == "iri" else kind, source, where))

    id_, tag = "CAST(id AS VARCHAR)", "'T' || (id // 5 % 300)"
    part, good = "s", "id % 5 = 0 AND id % 15 <> 0"
    node = c("component") + id_
    plain = "class NOT IN ('CustomObject', '')"
    put(node, "rdf:type", f"CASE WHEN {plain} THEN 'urn:plant:class/' || class ELSE 'urn:plant:class/UnclassifiedComponent' END", "iri", part, good)
    put(node, "needsReview", "'true'", "boolean", part, f"{good} AND NOT ({plain})")
    put(node, "tag", tag, "string", part, good)
    put(node, "partOf", "'urn:plant:segment/P' || (n % 50)", "iri", part, good)
    put(node, "componentClass", "class", "string", part, f"{good} AND {plain}")
    cls = "(SELECT DISTINCT class, n % 3 = 0 AS has_uri FROM s WHERE id % 5 = 0 AND id % 15 <> 0)"
    uri, label = "(has_uri AND class IN ('GateValve', 'BallValve'))", "class = 'GateValve'"
    put(c("class") + "class", "rdfs:subClassOf", klass("Component"), "iri", cls, plain)
    put(c("class") + "class", "rdlMatch", f"CASE WHEN {uri} AND class = 'GateValve' THEN 'plm:Gate' WHEN {uri} THEN 'plm:Ball' WHEN {label} THEN 'plm:GateByLabel' END", "iri", cls, plain)
    put(c("class") + "class", "rdlMatchType", f"CASE WHEN {uri} AND class = 'GateValve' THEN 'close' WHEN {uri} THEN 'exact' WHEN {label} THEN 'label' END", "string", cls, plain)
    put(c("class") + "class", "pendingReview", "'true'", "boolean", cls, label)
    put(c("class") + "class", "rdlPending", "'true'", "boolean", cls, f"{plain} AND NOT ({uri} OR {label})")
    eq = f"(SELECT s.*, coalesce(CASE WHEN n % 4 = 0 THEN 'Vessel' END, told) AS eclass FROM s LEFT JOIN (SELECT {tag} AS tag, arg_max(class, (day, ts, {id_}, class)) AS told FROM s WHERE id % 15 = 0 AND class <> '' GROUP BY 1) g ON g.tag = {tag.replace('id', 's.id')} WHERE id % 5 = 1)"
    node = c("equipment") + id_
    put(node, "rdf:type", klass("Equipment"), "iri", eq)
    put(node, "rdf:type", "'urn:plant:class/' || eclass", "iri", eq)
    put(node, "tag", tag, "string", eq)
    put(node, "equipmentClass", "eclass", "string", eq)
    put("'urn:plant:class/' || eclass", "rdfs:subClassOf", klass("Equipment"), "iri", eq)
    put("'urn:plant:class/' || eclass", "rdlPending", "'true'", "boolean", eq)
    nz = "(SELECT *, id || '-' || i AS nozzle FROM s, (SELECT unnest([1, 2]) AS i) WHERE id % 5 = 1 AND i <= n % 3)"
    put(node, "hasNozzle", "'urn:plant:nozzle/' || nozzle", "iri", nz)
    put("'urn:plant:nozzle/' || nozzle", "rdf:type", klass("Nozzle"), "iri", nz)
    put("'urn:plant:nozzle/' || nozzle", "partOf", node, "iri", nz)
    edge = "(SELECT *, CASE WHEN n % 5 = 0 THEN 'opc' ELSE 'component' END AS ends, ['forward', 'reverse', 'both', 'none'][n % 4 + 1] AS flow FROM s WHERE id % 5 = 2 AND n % 11 <> 0)"
    node, a, b = c("connection") + id_, "'urn:plant:' || ends || '/' || (id - 2)", "'urn:plant:' || ends || '/' || (id + 3)"
    put(node, "rdf:type", klass("Connection"), "iri", edge)
    put(node, "from", a, "iri", edge)
    put(node, "to", b, "iri", edge)
    put(node, "derived", "(n % 2 = 0)", "boolean", edge)
    put(node, "connType", "CASE WHEN n % 5 = 0 THEN 'OffPage' ELSE 'Piping' END", "string", edge)
    put(node, "flowSense", "flow", "string", edge)
    put(a, "connectedTo", b, "iri", edge)
    put(b, "connectedTo", a, "iri", edge)
    put(a, "flowsTo", b, "iri", edge, "flow IN ('forward', 'both')")
    put(b, "flowsTo", a, "iri", edge, "flow IN ('reverse', 'both')")
    opc, node = "(SELECT * FROM s WHERE id % 5 = 3)", c("opc") + id_
    put(node, "rdf:type", klass("OffPageConnector"), "iri", opc)
    put(node, "tag", "'O' || id", "string", opc)
    put(node, "opcType", "CASE WHEN n % 2 = 0 THEN 'PipingOffUnit' ELSE 'InstrumentOffUnit' END", "string", opc)
    put(node, "flowSense", "CASE WHEN n % 3 = 0 THEN 'FlowIn' END", "string", opc)
    put(node, "matched", "(n % 2 = 0)", "boolean", opc)
    put(node, "toFrom", "role", "string", opc)
    put(node, "terminates", "'urn:plant:segment/P' || (n % 50)", "iri", opc, "n % 2 = 0")
    line, node = "(SELECT * FROM s WHERE id % 5 = 4)", c("line") + id_
    put(node, "rdf:type", klass("PipingLine"), "iri", line)
    put(node, "fluid", "role", "string", line)
    put(node, "diameter", "n % 4", "string", line)
    put(node, "diameter", "n % 6", "string", line)
    put(node, "pieceCount", "n % 3", "integer", line)
    put(node, "attrInconsistent", "(n % 4 <> n % 6)", "boolean", line)
    piece = "(SELECT *, 'urn:plant:segment/P' || id || '-' || i AS seg FROM s, (SELECT unnest([1, 2]) AS i) WHERE id % 5 = 4 AND i <= n % 3)"
    put("seg", "rdf:type", klass("PipingSegment"), "iri", piece)
    put("seg", "partOf", node, "iri", piece)
    put("seg", "fluid", "role", "string", piece)
    put("seg", "diameter", "n % 4 + i", "string", piece)
    put("seg", "process_unit", "['A', 'B', 'C'][n % 3 + 1]", "string", piece, graph="oracle")
    for node, source, where in ((c("component") + id_, "s", good), (c("equipment") + id_, "s", "id % 5 = 1"), (c("connection") + id_, edge, "true"), (c("opc") + id_, opc, "true"), (c("line") + id_, line, "true"), ("seg", piece, "true")):
        for p, o, kind in (("validFrom", "day", "date"), ("validTo", "valid_to", "date"), ("txFrom", "ts", "dateTime"), ("txTo", "tx_to", "dateTime")):
            put(node, p, o, kind, source, where, graph="temporal")
    return " UNION ".join(out)


@query("p11_facts_of_history", _HISTORY + _facts_sql())
def p11(spark, d):
    """All facts of the plant objects; the tree of classes and the reference data are fixed and left out here."""
    quads, _ = history_facts(spark, d)
    fixed = ["PlantObject", *(c for c in ("Component", "Valve", "UnclassifiedComponent", "PipingSegment", "PipingLine", "Equipment", "Nozzle", "Connection", "OffPageConnector", "Drawing", "System", "UtilitySystem", "ProcessSystem", "Fluid", "BoundaryRole", "Function"))]
    tree = F.col("s").isin([f"urn:plant:class/{c}" for c in fixed])
    return quads.where(~tree & (F.col("graph") != "refdata"))


#: What tells the attributes' texts of one anchor apart, in the order of those texts; for the kinds that can be rejected.
_TEXT_ORDER = """CASE id % 5 WHEN 0 THEN concat('"component_class":"' || class || '",', CASE WHEN n % 3 = 0 THEN '"component_class_uri":"rds:' || class || '",' END, '"kind"', ',"segment_id":"P' || (n % 50) || '"', '}')
  WHEN 2 THEN concat('"', CASE WHEN n % 5 = 0 THEN 'OffPage' ELSE 'Piping' END, '"', CASE WHEN n % 11 <> 0 THEN ',"derived":' || CAST(n % 2 = 0 AS VARCHAR) END, ',"flow_sense":"' || ['forward', 'reverse', 'both', 'none'][n % 4 + 1] || '"', '}')
  ELSE concat('[', coalesce('"' || role || '"', 'null'), '],[', coalesce('"' || (n % 4) || '"', 'null'), CASE WHEN n % 4 <> n % 6 THEN ',"' || (n % 6) || '"' END, ']') END"""
#: The history with turns of one number in the order of their attributes' texts, and those without a number first.
_ORDERED_HISTORY = _HISTORY.replace("lag(attrs) OVER w AS before FROM v", f"lag(attrs) OVER w AS before FROM (SELECT *, {_TEXT_ORDER} AS told FROM v)").replace("ORDER BY ts, turn)", "ORDER BY ts NULLS FIRST, turn NULLS FIRST, told)")


@query("p11_rejects", _ORDERED_HISTORY + """SELECT 'component' AS kind, CAST(id AS VARCHAR) AS anchor, 'equipment_duplicate' AS reason FROM s WHERE id % 15 = 0 UNION ALL
SELECT 'connection', CAST(id AS VARCHAR), 'derived_not_told' FROM s WHERE id % 5 = 2 AND coalesce(n % 11 = 0, true) UNION ALL SELECT 'line', CAST(id AS VARCHAR), 'line_without_pieces' FROM s WHERE id % 5 = 4 AND coalesce(n % 3 = 0, true)""")
def p11r(spark, d):
    return history_facts(spark, d)[1]


def turn_history(spark, d):
    """Conversations as anchors, turns as versions of which two share a valid date."""
    c = t(spark, d, "conversations").select("conv_id", F.lit("Modified").alias("change_type"), F.concat("role", (F.char_length("text") % 7).cast("string")).alias("attrs"), F.expr("date_add(DATE'2024-01-01', int(turn div 2 * 10 + conv_id % 7))").alias("valid_from"), F.timestamp_seconds(F.lit(1704067200) + F.col("turn") * 864000 + F.col("conv_id") % 5 * 3600).alias("tx"), F.lpad(F.col("turn").cast("string"), 6, "0").alias("delta_id"))
    return history.apply_events(c, ["conv_id"])[0]


_TURNS = """WITH v AS (SELECT conv_id, turn, role || CAST(length(text) % 7 AS VARCHAR) AS attrs, DATE '2024-01-01' + CAST(turn // 2 * 10 + conv_id % 7 AS INT) AS day, make_timestamp((1704067200 + turn * 864000 + conv_id % 5 * 3600) * 1000000) AS ts FROM conversations),
e AS (SELECT *, lag(attrs) OVER w AS before FROM v WINDOW w AS (PARTITION BY conv_id ORDER BY ts, turn)),
x AS (SELECT *, lead(ts) OVER w AS nts, lead(day) OVER w AS nday FROM e WHERE before IS NULL OR before <> attrs WINDOW w AS (PARTITION BY conv_id ORDER BY ts, turn)),
h AS (SELECT *, CASE WHEN nday > day THEN nday END AS valid_to, CASE WHEN nday = day THEN nts END AS tx_to FROM x) """


@query("j09_as_of_both_axes", _TURNS + """, o AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 0 ELSE doc_id % 5000 END AS conv_id, CASE WHEN doc_id % 50 <> 7 THEN DATE '2024-01-01' + CAST(n_chars % 45 AS INT) END AS day, make_timestamp((1704067200 + n_chars % 97 * 86400) * 1000000) AS ts FROM documents)
SELECT doc_id, attrs, h.day AS since FROM o LEFT JOIN h ON h.conv_id = o.conv_id AND h.day <= o.day AND (valid_to IS NULL OR o.day < valid_to) AND h.ts <= o.ts AND (tx_to IS NULL OR o.ts < tx_to)""")
def j09b(spark, d):
    """Each document at its own valid date and transaction time; a third of them asks for one anchor, some have no date."""
    n = F.col("n_chars")
    o = t(spark, d, "documents").select("doc_id", F.when(F.col("doc_id") % 3 == 0, F.lit(0)).otherwise(F.col("doc_id") % 5000).cast("long").alias("conv_id"), F.when(F.col("doc_id") % 50 != 7, F.date_add(F.lit("2024-01-01").cast("date"), (n % 45).cast("int"))).alias("day"), F.timestamp_seconds(F.lit(1704067200) + n % 97 * 86400).alias("ts"))
    return history.as_of_both(o, turn_history(spark, d), "conv_id", "day", "ts").select("doc_id", F.col("as_of_attrs").alias("attrs"), F.col("as_of_from").alias("since"))


def plant(spark, d):
    """Runs of forty documents as ten pieces of pipe, each of three parts and a boundary, with equipment at some of their ends."""
    x = t(spark, d, "documents").select(F.col("doc_id").alias("node")).distinct().selectExpr("node", "node div 40 AS block", "node % 40 AS pos", "node % 40 div 4 AS piece")
    edge_flow = "CASE (block + piece) % 5 WHEN 0 THEN 'forward' WHEN 1 THEN 'reverse' WHEN 2 THEN 'both' ELSE 'none' END"
    parts = x.selectExpr("node", "CASE WHEN pos % 4 <> 3 THEN concat('F', piece) END AS fluid", "CASE WHEN piece = 5 AND block % 7 = 0 THEN 'flare' WHEN piece = 8 AND block % 5 = 1 THEN 'steam_condensate' ELSE 'process' END AS fluid_class", "CASE WHEN pos % 4 <> 3 THEN 'inner' WHEN (block + piece) % 6 = 0 THEN 'relief' ELSE 'boundary' END AS role", "CAST(NULL AS STRING) AS tag")
    first, last = x.where("pos = 0 AND block % 3 <> 2"), x.where("pos = 36 AND block % 4 = 0")
    gear = lambda s, k, name: s.selectExpr(f"-(block * 2 + {k}) AS node", "CAST(NULL AS STRING) AS fluid", "CAST(NULL AS STRING) AS fluid_class", "'equipment' AS role", f"concat('{name}', lpad(block, 9, '0')) AS tag")
    nodes = parts.unionByName(gear(first, 1, "E")).unionByName(gear(last, 2, "G"))
    runs = x.where("pos <> 39").selectExpr("node AS src", "node + 1 AS dst", f"CASE WHEN pos % 4 >= 2 THEN {edge_flow} ELSE 'none' END AS flow_sense").join(x.select(F.col("node").alias("dst")), "dst", "left_semi").select("src", "dst", "flow_sense")
    ends = first.selectExpr("-(block * 2 + 1) AS src", "node AS dst", "'none' AS flow_sense").unionByName(last.selectExpr("-(block * 2 + 2) AS src", "node AS dst", "'none' AS flow_sense"))
    return nodes, runs.unionByName(ends)


_PLANT = """WITH RECURSIVE x AS (SELECT DISTINCT doc_id AS node, doc_id // 40 AS block, doc_id % 40 AS pos, doc_id % 40 // 4 AS piece FROM documents),
f AS (SELECT DISTINCT block, piece, block * 40 + 4 * piece AS fragment, piece = 5 AND block % 7 = 0 AS flare, (piece = 5 AND block % 7 = 0) OR (piece = 8 AND block % 5 = 1) AS own,
  piece = 0 AND block % 3 <> 2 AS e, piece = 9 AND block % 4 = 0 AND (block * 40 + 36) IN (SELECT node FROM x) AS g FROM x WHERE pos % 4 <> 3),
a AS (SELECT *, CASE WHEN own THEN 'utility:F' || piece WHEN e THEN 'process:E' || lpad(CAST(block AS VARCHAR), 9, '0') WHEN g THEN 'process:G' || lpad(CAST(block AS VARCHAR), 9, '0') END AS system, CASE WHEN own THEN 'own' WHEN e OR g THEN 'equipment' END AS rule FROM f),
b AS (SELECT block, piece AS j, node AS boundary, (block + piece) % 5 AS s, (block + piece) % 6 = 0 AS relief FROM x WHERE pos % 4 = 3),
l AS (SELECT c.block, c.piece AS x, n.piece AS y, c.fragment, n.fragment AS neighbour, boundary, n.flare, c.rule, CASE WHEN n.piece = c.piece + 1 THEN s = 1 ELSE s = 0 END AS supply, n.flare AND CASE WHEN n.piece = c.piece + 1 THEN s = 0 ELSE s = 1 END AS discharge
  FROM a c JOIN a n ON n.block = c.block AND abs(n.piece - c.piece) = 1 JOIN b ON b.block = c.block AND b.j = least(c.piece, n.piece)),
r AS (SELECT block, piece, system, fragment AS consumer, 0 AS hops FROM a WHERE system IS NOT NULL UNION ALL SELECT l.block, l.x, r.system, r.consumer, r.hops + 1 FROM r JOIN l ON l.block = r.block AND l.y = r.piece WHERE l.rule IS NULL AND NOT supply AND NOT discharge AND hops < 10),
m AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY block, piece ORDER BY hops, system, consumer) = 1),
t AS (SELECT a.block, a.piece, a.fragment, coalesce(m.system, 'pending:F' || a.piece) AS system, coalesce(a.rule, CASE WHEN m.system IS NULL THEN 'pending' ELSE 'junction' END) AS rule, m.hops, m.consumer FROM a LEFT JOIN m USING (block, piece)) """


@query("g07_trace_systems", _PLANT + """SELECT node, fragment, system, rule, hops, consumer FROM x JOIN t USING (block, piece) WHERE pos % 4 <> 3
UNION ALL SELECT -(block * 2 + 1), NULL, 'process:E' || lpad(CAST(block AS VARCHAR), 9, '0'), 'equipment', 0, NULL FROM f WHERE e UNION ALL SELECT -(block * 2 + 2), NULL, 'process:G' || lpad(CAST(block AS VARCHAR), 9, '0'), 'equipment', 0, NULL FROM f WHERE g
UNION ALL SELECT boundary, fragment, system, 'relief', 0, fragment FROM b JOIN t ON t.block = b.block AND t.piece = CASE s WHEN 0 THEN j WHEN 1 THEN j + 1 END WHERE relief""")
def g07t(spark, d):
    return systems.trace_systems(*plant(spark, d))[0]


@query("g07_consumer_guards", _PLANT + "SELECT fragment, neighbour, boundary, CASE WHEN supply THEN 'supply' ELSE 'flare' END AS guard FROM l WHERE (rule IS NULL OR rule <> 'own') AND (supply OR discharge)")
def g07g(spark, d):
    return systems.trace_systems(*plant(spark, d))[1]


@query("o04_greedy_mates", """WITH RECURSIVE d AS (SELECT DISTINCT doc_id AS x, doc_id // 10 AS b, doc_id % 10 AS p FROM documents), n AS (SELECT d.b, d.p, (d.p * 7 + d.b) % 10 AS m FROM d JOIN d o ON o.b = d.b AND o.p = (d.p * 7 + d.b) % 10 WHERE (d.p * 7 + d.b) % 10 <> d.p),
r AS (SELECT DISTINCT b, -1 AS p, CAST([] AS BIGINT[]) AS taken, false AS hit, CAST(0 AS BIGINT) AS m FROM d UNION ALL
  SELECT r.b, r.p + 1, CASE WHEN n.m IS NOT NULL AND NOT list_contains(taken, r.p + 1) AND NOT list_contains(taken, n.m) THEN list_concat(taken, [r.p + 1, n.m]) ELSE taken END, n.m IS NOT NULL AND NOT list_contains(taken, r.p + 1) AND NOT list_contains(taken, n.m), n.m FROM r LEFT JOIN n ON n.b = r.b AND n.p = r.p + 1 WHERE r.p < 9)
SELECT b * 10 + least(p, m) AS a, b * 10 + greatest(p, m) AS b FROM r WHERE hit""")
def o04g(spark, d):
    """Documents that name one another within their ten, so that pairs wait for each other."""
    x = t(spark, d, "documents").select("doc_id").distinct().selectExpr("doc_id AS eid", "CAST(doc_id AS STRING) AS guid_self", "concat(CASE WHEN doc_id % 2 = 1 THEN 'SP' ELSE '' END, doc_id div 10 * 10 + (doc_id % 10 * 7 + doc_id div 10) % 10) AS guid_mate")
    return stitch.match_by_guid(x).select("a", "b")


@query("r14_marks_down_the_tree", """WITH RECURSIVE n AS (SELECT doc_id, doc_id % 200 AS pos, CASE WHEN n_chars % 37 = 0 THEN 'M' || CAST(n_chars % 100 AS VARCHAR) END AS own, CASE WHEN doc_id % 200 > 0 THEN doc_id - 1 - n_chars % least(doc_id % 200, 2) END AS up FROM documents),
r AS (SELECT doc_id, own AS mark FROM n WHERE up IS NULL UNION ALL SELECT n.doc_id, coalesce(n.own, r.mark) FROM n JOIN r ON n.up = r.doc_id) SELECT doc_id AS node, mark FROM r""")
def r14m(spark, d):
    """Runs of two hundred documents as trees about as deep; every thirty-seventh length is a mark."""
    x = t(spark, d, "documents").selectExpr("doc_id", "CASE WHEN n_chars % 37 = 0 THEN concat('M', n_chars % 100) END AS mark", "CASE WHEN doc_id % 200 > 0 THEN doc_id - 1 - n_chars % least(doc_id % 200, 2) END AS up")
    return topology.down_tree(x, x.where("mark is not null"), "doc_id", "up", "mark")


_WORDS = "SELECT DISTINCT lower(w) AS {n} FROM (SELECT unnest(regexp_extract_all(lower(text), '[a-z]{{4,}}')) AS w FROM {t})"


@query("n16_similar_words", "WITH a AS (" + _WORDS.format(n="a", t="conversations") + "), b AS (" + _WORDS.format(n="b", t="benchmark") + """), s AS (SELECT a, b, round(1 - levenshtein(a, b) / greatest(length(a), length(b)), 6) AS similarity FROM a JOIN b ON abs(length(a) - length(b)) <= 0.51 * greatest(length(a), length(b)))
SELECT a AS label, b AS suggested, similarity FROM s WHERE similarity >= 0.5 QUALIFY row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) = 1""")
def n16w(spark, d):
    """The words of all conversations against those of the benchmark's items."""
    words = lambda n: t(spark, d, n).select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit("([a-z]{4,})"), 1)).alias("w"))
    return naming.fuzzy_candidates(words("conversations"), "w", words("benchmark"), "w")


_FIELDS = """WITH f AS (SELECT doc_id, upper(lang) AS fluid, lpad(CAST(doc_id % 100 AS VARCHAR), 2, '0') AS system, lpad(CAST(n_chars % 100 AS VARCHAR), 2, '0') AS unit, lpad(CAST(n_chars % 1000 AS VARCHAR), 3, '0') AS seq,
  CASE WHEN n_chars % 3 = 0 THEN CAST(n_chars % 40 + 1 AS VARCHAR) || '"' END AS diameter, CASE WHEN n_chars % 4 = 0 THEN 'D' || CAST(n_chars % 500 AS VARCHAR) || 'H' END AS class, CASE WHEN n_chars % 5 < 2 THEN 'S' END AS kind, CASE WHEN n_chars % 7 = 0 THEN 'H' END AS purpose, CASE WHEN n_chars % 5 = 0 THEN CAST(n_chars % 90 AS VARCHAR) END AS thick FROM documents) """


def tag_fields(spark, d):
    n = F.col("n_chars")
    two = lambda c, w=2: F.lpad(c.cast("string"), w, "0")
    return t(spark, d, "documents").select("doc_id", F.upper("lang").alias("fluid"), two(F.col("doc_id") % 100).alias("system"), two(n % 100).alias("unit"), two(n % 1000, 3).alias("sequence"), F.when(n % 3 == 0, F.concat((n % 40 + 1).cast("string"), F.lit('"'))).alias("diameter"), F.when(n % 4 == 0, F.concat(F.lit("D"), (n % 500).cast("string"), F.lit("H"))).alias("piping_class"), F.when(n % 5 < 2, "S").alias("insul_type"), F.when(n % 7 == 0, "H").alias("insul_purpose"), F.when(n % 5 == 0, (n % 90).cast("string")).alias("insul_thick"))


def there_and_back(spark, d, rows, template):
    """Tags by the convention's template, and the fields that decoding them gives."""
    layout = conventions.load(spark.createDataFrame(rows, conventions.CONVENTION))[template]
    x = tag_fields(spark, d)
    x = x.withColumn("tag", conventions.compose_tag(layout, {c: F.col(c) for c in x.columns if c != "doc_id"}))
    names = [f[3] for g in layout for f in g]
    back = x.withColumn("back", conventions.decode_tag(layout, F.col("tag")))
    return back.select("doc_id", "tag", F.when(F.col("back").isNotNull(), F.concat_ws("|", *[F.coalesce(F.col("back")[n], F.lit("")) for n in names])).alias("fields"))


@query("r12_packed_tags", _FIELDS + """SELECT doc_id, CASE WHEN diameter IS NOT NULL THEN fluid || system || unit || seq || '-' || diameter || coalesce('(' || class || ')', '') || CASE WHEN kind IS NULL AND purpose IS NULL AND thick IS NULL THEN '' ELSE '-' || coalesce(kind, '') || coalesce('(' || purpose || ')', '') || coalesce('(' || thick || ')', '') END END AS tag,
CASE WHEN diameter IS NOT NULL THEN concat_ws('|', fluid, system, unit, seq, diameter, coalesce(class, ''), coalesce(kind, ''), coalesce(purpose, CASE WHEN thick IS NOT NULL THEN thick END, ''), CASE WHEN purpose IS NULL THEN '' ELSE coalesce(thick, '') END) END AS fields FROM f""")
def r12p(spark, d):
    """The packed convention: a single bracket after the insulation type is read as the purpose, the first of the two."""
    return there_and_back(spark, d, conventions.PACKED, "segment")


@query("r12_dashed_tags", _FIELDS + "SELECT doc_id, concat_ws('-', diameter, fluid, unit || seq, class, purpose) AS tag, concat_ws('|', coalesce(diameter, ''), fluid, unit, seq, '', coalesce(class, ''), coalesce(purpose, '')) AS fields FROM f")
def r12d(spark, d):
    return there_and_back(spark, d, conventions.DASHED, "segment")


_STEP = "c{r} AS (SELECT c.id, md5(c.c || '|' || coalesce(s.near, '')) AS c FROM c{q} c LEFT JOIN (SELECT u.a AS id, string_agg(n.c, ',' ORDER BY n.c) AS near FROM u JOIN c{q} n ON n.id = u.b GROUP BY 1) s USING (id))"


@query("q19_colliders", """WITH n AS (SELECT doc_id AS id, lang || '-' || CAST(n_chars % 300 AS VARCHAR) AS anchor, source FROM documents), e AS (SELECT doc_id AS a, doc_id + 1 AS b FROM documents WHERE doc_id % 5 <> 4 UNION SELECT doc_id, doc_id - n_chars % 7 FROM documents WHERE n_chars % 2 = 0),
u AS (SELECT DISTINCT a, b FROM (SELECT a, b FROM e UNION ALL SELECT b, a FROM e) WHERE a <> b AND a IN (SELECT id FROM n) AND b IN (SELECT id FROM n)), c0 AS (SELECT id, anchor AS c FROM n), """ + ", ".join(_STEP.format(r=r, q=r - 1) for r in (1, 2, 3)) + """
SELECT anchor, count(*) AS n_ids, count(DISTINCT source) AS n_attrs, count(DISTINCT c1.c) AS n_colours_1, count(DISTINCT c3.c) AS n_colours_3 FROM n JOIN c1 USING (id) JOIN c3 USING (id) GROUP BY anchor HAVING count(*) > 1""")
def q19c(spark, d):
    """Documents that share an anchor, and how far their neighbours tell them apart."""
    x = t(spark, d, "documents").select(F.col("doc_id").alias("id"), F.concat_ws("-", "lang", (F.col("n_chars") % 300).cast("string")).alias("anchor"), "source", "n_chars")
    e = x.where("id % 5 <> 4").select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst")).unionByName(x.where("n_chars % 2 = 0").select(F.col("id").alias("src"), (F.col("id") - F.col("n_chars") % 7).alias("dst")))
    return quality.collider_diagnostics(x, e, ["anchor"], "id", ["source"], "anchor")


ORACLES["t04_deletions_and_collisions"] = streams.ORACLES["st2_whole_history"]


def t04d(spark, d):
    """The turns of conversations with deletions and collisions, folded in one batch: rows and anomalies."""
    n = F.char_length("text")
    kind = F.when(n % 5 == 0, "Deleted").when(n % 5 == 1, "New").otherwise("Modified")
    e = t(spark, d, "conversations").select("conv_id", kind.alias("change_type"), F.concat("role", (n % 4).cast("string")).alias("attrs"), F.expr("date_add(DATE'2024-01-01', int(turn div 2 * 10))").alias("valid_from"), F.timestamp_seconds(F.lit(1704067200) + F.col("turn") * 86400).alias("tx"), F.lpad(F.col("turn").cast("string"), 6, "0").alias("delta_id"))
    rows, odd = history.apply_events(e, ["conv_id"])
    told = rows.select(F.col("conv_id").alias("key"), F.lit("row").alias("what"), "attrs", "valid_from", "valid_to", F.unix_micros("tx_from").alias("tx_from_us"), F.unix_micros("tx_to").alias("tx_to_us"))
    none = lambda kind: F.lit(None).cast(kind)
    return told.unionByName(odd.select(F.col("conv_id").alias("key"), F.col("reason").alias("what"), none("string").alias("attrs"), none("date").alias("valid_from"), none("date").alias("valid_to"), F.unix_micros("tx").alias("tx_from_us"), none("long").alias("tx_to_us")))


QUERIES["t04_deletions_and_collisions"] = t04d


_AREAS = [("0", "A1"), ("01", "A2"), ("2", "A3"), ("2", "A4"), ("3", ""), ("4", "A1")]
_FUNCTIONS = [("0", "F1", "HP", "A1"), ("0", "F2", "LP", "A9"), ("1", "F3", "ACID", "A2"), ("00", "F4", "TRIM", "A1"), ("4", "F5", "ONLY", ""), ("3", "F6", "X", "A1"), ("3", "F7", "Y", "A2")]
_LINKS = [("F1", "0", "AG;FG"), ("F2", "", "AG, LF"), ("F3", "", "AG"), ("F4", "0", "LF"), ("F6", "", "FG"), ("F7", "3", "FG,AG")]


def _rows_sql(rows):
    return ", ".join("(" + ", ".join(f"'{c}'" for c in r) + ")" for r in rows)


@query("n03_naming_rules", f"""WITH m AS (SELECT conv_id, CAST(length(text) % 6 AS VARCHAR) AS unit, ['AG', 'FG', 'LF'][length(text) % 3 + 1] AS fluid FROM conversations),
u AS (SELECT conv_id, unit FROM m GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY count(*) DESC, unit) = 1), l AS (SELECT conv_id, fluid FROM m GROUP BY 1, 2 QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY count(*) DESC, fluid) = 1),
areas AS (SELECT regexp_replace(c0, '^0+(.)', '\\1') AS unit, c1 AS area FROM (VALUES {_rows_sql(_AREAS)}) v(c0, c1)), functions AS (SELECT regexp_replace(c0, '^0+(.)', '\\1') AS unit, c1 AS code, c2 AS what, c3 AS area FROM (VALUES {_rows_sql(_FUNCTIONS)}) v(c0, c1, c2, c3)),
links AS (SELECT c0 AS code, c1 AS unit, string_split(replace(replace(c2, ' ', ''), ';', ','), ',') AS fluids FROM (VALUES {_rows_sql(_LINKS)}) v(c0, c1, c2)),
a AS (SELECT u.conv_id, u.unit, l.fluid, count(area) AS n_rows, count(DISTINCT nullif(area, '')) AS n_areas, min(nullif(area, '')) AS area FROM u JOIN l USING (conv_id) LEFT JOIN areas ON areas.unit = u.unit GROUP BY 1, 2, 3),
b AS (SELECT conv_id, unit, fluid, n_rows, n_areas, CASE WHEN n_areas = 1 THEN area END AS area FROM a),
f AS (SELECT b.conv_id, g.code, g.what, g.area IS NOT DISTINCT FROM b.area AND b.area IS NOT NULL AS same, EXISTS (SELECT 1 FROM links k WHERE k.code = g.code AND k.unit IN ('', g.unit) AND list_contains(k.fluids, b.fluid)) AS hit, NOT EXISTS (SELECT 1 FROM links k WHERE k.code = g.code AND k.unit IN ('', g.unit)) AS bare, count(*) OVER (PARTITION BY b.conv_id) AS n FROM b JOIN functions g ON g.unit = b.unit),
h AS (SELECT *, bool_or(same) OVER (PARTITION BY conv_id) AS tied FROM f WHERE hit OR (n = 1 AND bare)), p AS (SELECT conv_id, count(*) AS n, min(code) AS code, min(what) AS what, list_sort(list(code)) AS codes FROM h WHERE same OR NOT tied GROUP BY 1),
r AS (SELECT b.*, CASE WHEN p.n = 1 THEN p.code END AS code, CASE WHEN p.n = 1 THEN p.what END AS what, p.n AS hits, p.codes, (SELECT list_sort(list(DISTINCT code)) FROM functions g WHERE g.unit = b.unit) AS every FROM b LEFT JOIN p USING (conv_id))
SELECT conv_id, unit, fluid, area, code, what, lpad(CAST(row_number() OVER (PARTITION BY area, code ORDER BY CAST(conv_id % 50 AS VARCHAR), conv_id) AS VARCHAR), CAST(greatest(2, length(CAST(row_number() OVER (PARTITION BY area, code ORDER BY CAST(conv_id % 50 AS VARCHAR), conv_id) AS VARCHAR))) AS INT), '0') AS number,
  concat_ws('; ', CASE WHEN n_rows = 0 THEN 'areas has no row for unit ' || unit WHEN n_areas > 1 THEN 'areas has area more than once for unit ' || unit WHEN n_areas = 0 THEN 'areas has no area for unit ' || unit END,
  CASE WHEN every IS NULL THEN 'functions allows nothing for unit ' || unit WHEN hits > 1 THEN 'functions has several rows that fit for unit ' || unit WHEN hits IS NULL THEN 'functions has no row that fits for unit ' || unit END) AS problems,
  CASE WHEN code IS NULL THEN array_to_string(CASE WHEN hits > 1 THEN codes ELSE every END, ',') END AS candidates FROM r""")
def n03r(spark, d):
    """Each conversation as a system whose members are its turns, named by rules that are data."""
    c = t(spark, d, "conversations").select("conv_id", F.char_length("text").alias("n"))
    members = c.select(F.col("conv_id").alias("system"), (F.col("n") % 6).cast("string").alias("unit"), F.element_at(F.array(F.lit("AG"), F.lit("FG"), F.lit("LF")), (F.col("n") % 3 + 1).cast("int")).alias("fluid"))
    systems_ = c.select(F.col("conv_id").alias("system")).distinct().withColumn("anchor", (F.col("system") % 50).cast("string"))
    tables = {"areas": spark.createDataFrame(_AREAS, "unit string, area string"), "functions": spark.createDataFrame(_FUNCTIONS, "unit string, code string, what string, area string"), "links": spark.createDataFrame(_LINKS, "code string, unit string, fluids string")}
    rules = [
        Rule("unit", "member", column="unit"), Rule("fluid", "member", column="fluid"), Rule("area", "lookup", ("unit",), "areas", ("unit",), "area"),
        Rule("code", "select", ("unit",), "functions", ("unit",), "code", match="fluid", link=Link("links", "code", "unit", "fluids"), prefer=(("area", "area"),), label="code"),
        Rule("what", "column", ("code",), column="what"), Rule("number", "sequence", ("area", "code"), width=2),
    ]
    x = resolve_fields(systems_, members, tables, rules)
    return x.select(F.col("system").alias("conv_id"), "unit", "fluid", "area", "code", "what", "number", F.array_join("problems", "; ").alias("problems"), F.when(F.col("code").isNull(), F.array_join(F.col("candidates")["code"], ",")).alias("candidates"))
