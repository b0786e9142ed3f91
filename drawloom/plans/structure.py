"""Topology, graph, tag, stitch and quality queries on the given tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from drawloom.operators import graph, quality, stitch, tags, topology
from drawloom.operators.tags import Field
from drawloom.plans.change import t
from drawloom.sources import sheets, xml

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def part_files(spark, d):
    """An XML payload for each brand and thousand of part keys, made by Spark from `part`; its path is brand/thousand."""
    clean = lambda c: F.regexp_replace(F.col(c).cast("string"), "[<>&\"']", " ")
    item = F.concat(F.lit('<PipingComponent ID="'), F.col("p_partkey").cast("string"), F.lit('" ComponentClass="'), clean("p_type"), F.lit('"><GenericAttributes><GenericAttribute Name="ItemTag" Value="'), clean("p_name"), F.lit('"/></GenericAttributes><Position><Location X="'), F.col("p_size").cast("string"), F.lit('" Y="1"/></Position></PipingComponent>'))
    ends = F.concat(F.lit('<Connection FromID="'), F.col("p_partkey").cast("string"), F.lit('" ToID="'), (F.col("p_partkey") + 1).cast("string"), F.lit('"/>'))
    body = t(spark, d, "part").groupBy("p_brand", F.expr("p_partkey div 1000").alias("block")).agg(F.array_join(F.array_sort(F.collect_list(item)), "").alias("items"), F.array_join(F.array_sort(F.collect_list(ends)), "").alias("ends"))
    text = F.concat(F.lit('<?xml version="1.0" encoding="UTF-8"?><PlantModel><ShapeCatalogue>'), "items", F.lit('</ShapeCatalogue><PipingNetworkSegment ID="'), F.translate("p_brand", "#", "-"), F.lit('">'), "items", "ends", F.lit("</PipingNetworkSegment></PlantModel>"))
    return body.select(F.concat_ws("/", "p_brand", "block").alias("path"), F.encode(text, "UTF-8").alias("content"))


@query("s02_shred_xml", """SELECT p_brand AS document, CAST(p_partkey AS VARCHAR) AS component_id, regexp_replace(p_type, '[<>&"'']', ' ', 'g') AS component_class, regexp_replace(p_name, '[<>&"'']', ' ', 'g') AS tag, CAST(p_size AS DOUBLE) AS x, translate(p_brand, '#', '-') AS segment_id FROM part""")
def s02(spark, d):
    n = xml.shred(part_files(spark, d))
    return topology.extract_objects(n, topology.COMPONENT_TAGS["DEXPI"]).select(F.substring_index("document", "/", 1).alias("document"), "component_id", "component_class", "tag", "x", "segment_id")


@query("r02_raw_edges", "SELECT CAST(p_partkey AS VARCHAR) AS from_id, CAST(p_partkey + 1 AS VARCHAR) AS to_id, translate(p_brand, '#', '-') AS owner_segment FROM part")
def r02(spark, d):
    return topology.raw_edges(xml.shred(part_files(spark, d))).select("from_id", "to_id", "owner_segment")


@query("s03_recover_text", "SELECT doc_id, length(text) + 4 AS n_chars FROM documents")
def s03(spark, d):
    bad = F.concat(F.lit("<a>"), "text", F.lit("&#x1;&#31;z"))
    return t(spark, d, "documents").select("doc_id", F.char_length(xml.recover_text(F.encode(bad, "UTF-8"))).cast("long").alias("n_chars"))


@query("s05_clean_sheet", "SELECT CASE WHEN trim(p_brand) IN ('nan', 'none') THEN '' ELSE trim(p_brand) END AS p_brand, CAST(p_size AS VARCHAR) AS size, regexp_replace(CAST(p_retailprice AS VARCHAR), '^(-?[0-9]+)\\.0$', '\\1') AS price FROM part")
def s05(spark, d):
    s = sheets.clean_sheet(t(spark, d, "part").select(F.col("p_brand").alias(" P_Brand "), F.col("p_size").cast("double").alias("Size"), F.col("p_retailprice").alias("PRICE")))
    return s.select("p_brand", "size", "price")


@query("s06_fluid_catalogue", "SELECT n_name AS fluid_code, CAST(n_regionkey AS VARCHAR) AS category, '' AS subcategory, CAST(n_nationkey AS VARCHAR) AS description FROM nation WHERE n_nationkey % 4 <> 0")
def s06(spark, d):
    s = t(spark, d, "nation").select(F.when(F.col("n_nationkey") % 4 != 0, F.col("n_name")).alias("c"), "n_regionkey", F.lit(None).cast("string").alias("sub"), "n_nationkey")
    return sheets.fluid_catalogue(s, "c", "n_regionkey", "sub", "n_nationkey")


_ROLE = "CASE WHEN p_size % 5 = 0 THEN 'isolation' WHEN p_size % 5 = 1 THEN 'trap' WHEN p_size % 5 = 2 THEN 'other' ELSE '' END"


@query("s07_boundary_sets", f"SELECT DISTINCT p_type AS component_class, {_ROLE} AS role FROM part WHERE {_ROLE} IN ('isolation', 'trap')")
def s07(spark, d):
    return sheets.with_default(sheets.boundary_sets(t(spark, d, "part").withColumn("role", F.expr(_ROLE)), "p_type", "role"))


@query("s08_unit_codes", "SELECT CAST(c_nationkey AS VARCHAR) AS unit_code FROM customer UNION SELECT CAST(s_suppkey AS VARCHAR) FROM supplier")
def s08(spark, d):
    return sheets.unit_codes((t(spark, d, "customer"), "c_nationkey"), (t(spark, d, "supplier"), "s_suppkey"))


@query("s10_tag_convention", "SELECT p_brand, p_size, string_agg(p_partkey || '=' || p_type, ';' ORDER BY p_partkey) AS fields FROM part GROUP BY p_brand, p_size")
def s10(spark, d):
    x = sheets.tag_convention(t(spark, d, "part"), "p_brand", "p_size", "p_partkey", ["p_type"])
    return x.select("p_brand", "p_size", F.array_join(F.transform("fields", lambda f: F.concat(f["p_partkey"].cast("string"), F.lit("="), f["p_type"])), ";").alias("fields"))


def members(spark, d):
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_extendedprice").alias("arc"), (F.col("l_linenumber").cast("long") * 1_000_000_000 + F.col("l_partkey") * 10_000 + F.col("l_suppkey")).alias("ord"), "l_returnflag")


_ORD = "CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 10000 + l_suppkey"


@query("r04_order_inline", f"SELECT l_orderkey, l_partkey, {_ORD} AS ord, CASE WHEN l_orderkey % 2 = 1 THEN row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, {_ORD} DESC) ELSE row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice, {_ORD}) END - 1 AS inline_index, count(*) OVER (PARTITION BY l_orderkey) AS inline_count FROM lineitem")
def r04(spark, d):
    return topology.order_inline(members(spark, d), ["l_orderkey"], "arc", "ord", F.col("l_orderkey") % 2 == 1).select("l_orderkey", "l_partkey", "ord", F.col("inline_index").cast("long").alias("inline_index"), "inline_count")


@query("r05_chain_edges", f"WITH x AS (SELECT l_orderkey, l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY {_ORD}) AS b, l_returnflag = 'R' AS r FROM lineitem) SELECT l_orderkey, CASE WHEN r THEN b ELSE a END AS from_id, CASE WHEN r THEN a ELSE b END AS to_id FROM x WHERE b IS NOT NULL AND a <> b")
def r05(spark, d):
    return topology.chain_edges(members(spark, d), ["l_orderkey"], "l_partkey", "ord", F.col("l_returnflag") == "R")


@query("r06_adjacency", "WITH e AS (SELECT l_partkey AS a, l_suppkey AS b FROM lineitem), u AS (SELECT a AS node, b AS neighbour, 1 AS o, 0 AS i FROM e UNION ALL SELECT b, a, 0, 1 FROM e) SELECT node, neighbour, CASE WHEN max(o) = 1 AND max(i) = 1 THEN 'both' WHEN max(o) = 1 THEN 'out' ELSE 'in' END AS direction FROM u WHERE node <> neighbour GROUP BY node, neighbour")
def r06(spark, d):
    return topology.adjacency(t(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@query("r03_arc_position", """WITH v AS (SELECT vec_id, embedding FROM embeddings), leg AS (SELECT vec_id, i AS leg, embedding[2*i-1]::DOUBLE AS ax, embedding[2*i]::DOUBLE AS ay, embedding[2*i+1]::DOUBLE AS bx, embedding[2*i+2]::DOUBLE AS cy FROM v, range(1, 8) r(i)),
l AS (SELECT *, sqrt((bx-ax)*(bx-ax)+(cy-ay)*(cy-ay)) AS len FROM leg), p AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY vec_id ORDER BY leg ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM l),
q AS (SELECT p.*, embedding[31]::DOUBLE AS x, embedding[32]::DOUBLE AS y FROM p JOIN v USING (vec_id) WHERE len > 0), z AS (SELECT *, greatest(0, least(1, ((x-ax)*(bx-ax)+(y-ay)*(cy-ay))/(len*len))) AS t FROM q),
w AS (SELECT *, sqrt((x-(ax+t*(bx-ax)))*(x-(ax+t*(bx-ax)))+(y-(ay+t*(cy-ay)))*(y-(ay+t*(cy-ay)))) AS away FROM z)
SELECT vec_id, round(arg_min(before + t * len, (away, leg)), 5) AS arc FROM w GROUP BY vec_id""")
def r03(spark, d):
    e = t(spark, d, "embeddings")
    at = lambda i: F.col("embedding")[i].cast("double")
    lines = e.select("vec_id", F.array(*[F.struct(at(2 * i).alias("x"), at(2 * i + 1).alias("y")) for i in range(8)]).alias("pts"))
    points = e.select("vec_id", at(30).alias("x"), at(31).alias("y"))
    return topology.arc_position(points, lines, ["vec_id"], "vec_id").select("vec_id", F.round("arc", 5).alias("arc"))


@query("r07_in_graph", "SELECT p_partkey FROM part WHERE p_size > 25 AND p_partkey IN (SELECT l_partkey FROM lineitem)")
def r07(spark, d):
    e = t(spark, d, "lineitem").select(F.col("l_partkey").alias("from_id"), F.col("l_partkey").alias("to_id"))
    return topology.in_graph(t(spark, d, "part").where("p_size > 25"), e, "p_partkey").select("p_partkey")


def forest(spark, d, cut_by=7):
    """A path-like forest over parts: k to k // 2, cut where k is a multiple."""
    p = t(spark, d, "part").select(F.col("p_partkey").cast("long").alias("k"))
    return p.where(f"k > 1 and k % {cut_by} <> 0").select(F.col("k").alias("src"), F.floor(F.col("k") / 2).cast("long").alias("dst"))


@query("g01_connected_components", """WITH RECURSIVE up AS (SELECT CAST(p_partkey AS BIGINT) AS node, CAST(p_partkey AS BIGINT) AS root FROM part UNION ALL SELECT node, root // 2 FROM up WHERE root > 1 AND root % 7 <> 0),
n AS (SELECT node, min(root) AS component FROM up GROUP BY node), e AS (SELECT CAST(p_partkey AS BIGINT) AS a FROM part WHERE p_partkey > 1 AND p_partkey % 7 <> 0)
SELECT node, component FROM n WHERE node IN (SELECT a FROM e UNION SELECT a // 2 FROM e)""")
def g01(spark, d):
    return graph.connected_components(forest(spark, d))


@query("r08_isolation_sets", """WITH RECURSIVE nodes AS (SELECT CAST(p_partkey AS BIGINT) AS k FROM part), e AS (SELECT k AS a, k // 2 AS b FROM nodes WHERE k > 1),
up AS (SELECT k AS node, k AS root FROM nodes WHERE k % 5 <> 0 UNION ALL SELECT node, root // 2 FROM up WHERE root > 1 AND (root // 2) % 5 <> 0),
c AS (SELECT node, min(root) AS component FROM up GROUP BY node), t AS (SELECT CASE WHEN a % 5 = 0 THEN b ELSE a END AS node, CASE WHEN a % 5 = 0 THEN a ELSE b END AS stop FROM e WHERE (a % 5 = 0) <> (b % 5 = 0)),
s AS (SELECT component, list_sort(list(DISTINCT stop)) AS stops FROM t JOIN c USING (node) GROUP BY component)
SELECT node, array_to_string(stops, ',') AS stops, CAST(len(stops) AS BIGINT) AS n_stops FROM c JOIN s USING (component) WHERE len(stops) <= 8""")
def r08(spark, d):
    n = t(spark, d, "part").select(F.col("p_partkey").cast("long").alias("node"), (F.col("p_partkey") % 5 == 0).alias("is_stop"))
    e = n.where("node > 1").select(F.col("node").alias("src"), F.floor(F.col("node") / 2).cast("long").alias("dst"))
    return topology.isolation_sets(e, n).select("node", F.array_join("stops", ",").alias("stops"), "n_stops")


@query("r16_build_connections", """WITH f AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem WHERE l_partkey <> l_suppkey), u AS (SELECT least(a, b) AS lo, greatest(a, b) AS hi, bool_or(a < b) AS fwd, bool_or(a > b) AS rev FROM f GROUP BY 1, 2)
SELECT lo AS from_id, hi AS to_id, CASE WHEN fwd AND rev THEN 'both' WHEN fwd THEN 'forward' ELSE 'reverse' END AS flow_sense, NOT EXISTS (SELECT 1 FROM lineitem WHERE l_returnflag = 'R' AND least(l_partkey, l_suppkey) = lo AND greatest(l_partkey, l_suppkey) = hi) AS derived, CASE WHEN lo % 9 = 0 OR hi % 9 = 0 THEN 'Nozzle' ELSE 'Process' END AS conn_type FROM u""")
def r16(spark, d):
    e = t(spark, d, "lineitem").select(F.col("l_partkey").alias("from_id"), F.col("l_suppkey").alias("to_id"), "l_returnflag")
    z = e.select(F.col("from_id").alias("z")).union(e.select("to_id")).where("z % 9 = 0").distinct()
    return topology.build_connections(e.drop("l_returnflag"), e.where("l_returnflag = 'R'"), z).select("from_id", "to_id", "flow_sense", "derived", "conn_type")


@query("r17_drawing_stats", """WITH c AS (SELECT CAST(l_orderkey AS VARCHAR) AS g, l_partkey AS k FROM lineitem), x AS (SELECT l_orderkey, l_partkey AS a, lead(l_partkey) OVER (PARTITION BY l_orderkey ORDER BY CAST(l_linenumber AS BIGINT) * 1000000000 + l_partkey * 10000 + l_suppkey) AS b FROM lineitem), e AS (SELECT CAST(l_orderkey AS VARCHAR) AS g, a, b FROM x WHERE b IS NOT NULL AND a <> b)
SELECT c.g AS drawing, count(*) AS n_components, coalesce(any_value(n.n), 0) AS n_edges FROM c LEFT JOIN (SELECT g, count(*) AS n FROM e GROUP BY g) n ON n.g = c.g GROUP BY c.g""")
def r17(spark, d):
    m = members(spark, d).withColumn("drawing", F.col("l_orderkey").cast("string"))
    e = topology.chain_edges(m, ["drawing"], "l_partkey", "ord")
    c = m.select("drawing", F.col("l_partkey").alias("component_id"), F.lit("GateValve").alias("component_class"))
    s = topology.drawing_stats(c, e, "drawing")
    return s.select("drawing", "n_components", "n_edges")


@query("r14_dominant_value", "WITH c AS (SELECT user_id, event_type, count(*) AS n, min(event_id) AS f FROM events GROUP BY 1, 2) SELECT user_id, event_type FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) = 1")
def r14(spark, d):
    return topology.dominant(t(spark, d, "events"), ["user_id"], "event_type", "event_id")


@query("r10_decode_tag", """WITH x AS (SELECT c_custkey, regexp_extract(c_name, '#(.*)$', 1) AS core FROM customer) SELECT c_custkey, substr(core, 1, 2) AS unit, substr(core, 3, 3) AS sequence FROM x WHERE regexp_full_match(core, '[0-9]+') AND length(core) >= 5""")
def r10(spark, d):
    c = t(spark, d, "customer").select("c_custkey", tags.decode(F.col("c_name"), F.lit("Customer"), separator="#").alias("x"))
    return c.where("x is not null").select("c_custkey", "x.unit", "x.sequence")


@query("r10_decode_more", """WITH x AS (SELECT l_orderkey, l_linenumber, l_orderkey + 10000000 AS n, l_suppkey % 3 = 0 AS two, CASE WHEN l_linenumber % 2 = 0 THEN 'XY' END AS suffix FROM lineitem) SELECT l_orderkey, l_linenumber, substr(CAST(n AS VARCHAR), 1, 1) AS system, substr(CAST(n AS VARCHAR), 2, 2) AS unit, substr(CAST(n AS VARCHAR), 4, 3) AS sequence, substr(CAST(n AS VARCHAR), 2, 2) IN ('00', '01') AS unit_known FROM x WHERE NOT two""")
def r10m(spark, d):
    x = t(spark, d, "lineitem").withColumn("suffix", F.when(F.col("l_linenumber") % 2 == 0, "XY"))
    tag = F.concat(F.lit("PG-"), F.when(F.col("l_suppkey") % 3 == 0, "14-").otherwise(""), (F.col("l_orderkey") + 10000000).cast("string"), F.coalesce("suffix", F.lit("")))
    x = x.select("l_orderkey", "l_linenumber", tags.decode(tag, F.lit("PG"), system_digits=1, suffix=F.col("suffix"), unit_codes=["00", "01"]).alias("x"))
    return x.where("x is not null").select("l_orderkey", "l_linenumber", "x.*")


@query("r18_drawing_number", r"""SELECT l_orderkey, l_linenumber, CASE WHEN l_linenumber % 3 = 0 THEN l_returnflag WHEN l_linenumber % 3 = 1 THEN 'P-' || l_partkey ELSE 'P-' || l_partkey || '_Dexpi_x' END AS drawing_number FROM lineitem""")
def r18(spark, d):
    n, p = F.col("l_linenumber") % 3, F.col("l_partkey").cast("string")
    path = F.concat(F.lit("/in/a_Dexpi.xml/P-"), p, F.when(n == 1, F.when(F.col("l_suppkey") % 2 == 0, "_Dexpi.XML").otherwise("_Post.xml")).otherwise("_Dexpi_x.xml"))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", topology.drawing_number(F.when(n == 0, F.col("l_returnflag")).when(n == 1, ""), path).alias("drawing_number"))


@query("q03_uncomposable_trimmed", "SELECT o_orderkey, NOT (o_custkey % 4 = 0 AND o_orderkey >= 100) AS bad FROM orders")
def q03t(spark, d):
    k, n = F.col("o_custkey") % 4, F.col("o_orderkey").cast("string")
    tag = F.when(k == 0, F.concat(F.lit(" \t PG-"), n, F.lit(" "))).when(k == 1, F.concat(F.lit("PG "), n)).when(k == 2, F.concat(F.lit("PG"), n, F.lit("- "))).otherwise("  ")
    return t(spark, d, "orders").select("o_orderkey", quality.uncomposable(tag).alias("bad"))


@query("r11_compose_tag", """SELECT p_partkey, CASE WHEN p_size % 4 <> 0 THEN concat_ws('-', CASE WHEN p_size % 3 <> 0 THEN CAST(p_size AS VARCHAR) || '"' END, p_brand, nullif(coalesce(CASE WHEN p_size % 2 = 0 THEN 'T' || p_type END, ''), '')) END AS tag, CASE WHEN p_size % 4 = 0 THEN 'brand' ELSE '' END AS missing FROM part""")
def r11(spark, d):
    groups = [[Field("size", suffix='"')], [Field("brand", required=True)], [Field("kind", prefix="T")]]
    s = F.col("p_size")
    cols = {"size": F.when(s % 3 != 0, s), "brand": F.when(s % 4 != 0, F.col("p_brand")), "kind": F.when(s % 2 == 0, F.col("p_type"))}
    return t(spark, d, "part").select("p_partkey", tags.compose(groups, cols).alias("tag"), F.array_join(tags.missing_fields(groups, cols), ",").alias("missing"))


@query("r19_line_hierarchy", """WITH s AS (SELECT l_orderkey % 50 AS unit, l_returnflag AS pns_tag, l_linestatus AS subline_tag FROM lineitem), p AS (SELECT s.pns_tag, 'SUP-' || (unit % 3) AS package, count(*) AS n FROM s GROUP BY 1, 2), b AS (SELECT pns_tag, package FROM p QUALIFY row_number() OVER (PARTITION BY pns_tag ORDER BY n DESC, package DESC) = 1)
SELECT package, regexp_replace(package, '[^0-9]', '', 'g') AS package_order, unit, pns_tag, subline_tag, count(*) AS n_segments FROM s LEFT JOIN b USING (pns_tag) GROUP BY ALL""")
def r19(spark, d):
    s = t(spark, d, "lineitem").select((F.col("l_orderkey") % 50).alias("unit"), F.col("l_returnflag").alias("pns_tag"), F.col("l_linestatus").alias("subline_tag"))
    packages = s.select("unit").distinct().select("unit", F.concat(F.lit("SUP-"), (F.col("unit") % 3).cast("string")).alias("package"))
    return topology.line_hierarchy(s, packages)


@query("g03_neighbours", "WITH e AS (SELECT l_partkey AS a, l_suppkey AS b FROM lineitem) SELECT DISTINCT node, neighbour FROM (SELECT a AS node, b AS neighbour FROM e UNION ALL SELECT b, a FROM e) WHERE node <> neighbour")
def g03(spark, d):
    return graph.neighbours(t(spark, d, "lineitem"), "l_partkey", "l_suppkey")


@query("g03_flow_between_whole", """WITH e AS (SELECT DISTINCT l_partkey AS a, l_suppkey AS b FROM lineitem), p AS (SELECT DISTINCT l_suppkey AS a, l_partkey AS b FROM lineitem)
SELECT a, b, CASE WHEN f AND r THEN 'both' WHEN f THEN 'forward' WHEN r THEN 'reverse' ELSE 'none' END AS flow FROM (SELECT a, b, EXISTS (SELECT 1 FROM e WHERE e.a = p.a AND e.b = p.b) AS f, EXISTS (SELECT 1 FROM e WHERE e.a = p.b AND e.b = p.a) AS r FROM p)""")
def g03fw(spark, d):
    e = t(spark, d, "lineitem")
    return graph.flow_between(e, e.select(F.col("l_suppkey").alias("a"), F.col("l_partkey").alias("b")).distinct(), "l_partkey", "l_suppkey")


def tree(spark, d):
    n = t(spark, d, "nation").select(F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("child"), F.concat(F.lit("r"), F.col("n_regionkey").cast("string")).alias("parent"))
    return n.unionByName(t(spark, d, "customer").select(F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("child"), F.concat(F.lit("n"), F.col("c_nationkey").cast("string")).alias("parent")))


@query("g05_transitive_subclasses", """WITH RECURSIVE e AS (SELECT 'n' || n_nationkey AS child, 'r' || n_regionkey AS parent FROM nation UNION ALL SELECT 'c' || c_custkey, 'n' || c_nationkey FROM customer), s AS (SELECT 'r' || r_regionkey AS root, 'r' || r_regionkey AS node FROM region UNION ALL SELECT root, child FROM s JOIN e ON e.parent = s.node) SELECT root, node FROM s""")
def g05(spark, d):
    return graph.descendants(tree(spark, d), t(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string"))))


@query("g06_closure_check", """SELECT count(*) + any_value(n) + any_value(r) AS n_agree, CAST(0 AS BIGINT) AS n_only_expected, CAST(0 AS BIGINT) AS n_only_inferred, any_value(n) AS n_asserted FROM customer JOIN nation ON c_nationkey = n_nationkey, (SELECT count(*) AS n FROM nation), (SELECT count(*) AS r FROM region)""")
def g06(spark, d):
    e = tree(spark, d)
    roots = t(spark, d, "region").select(F.concat(F.lit("r"), F.col("r_regionkey").cast("string")).alias("root"))
    two = e.alias("x").join(e.alias("y"), F.col("x.child") == F.col("y.parent")).select(F.col("x.parent").alias("root"), F.col("y.child").alias("node")).where("root like 'r%'")
    one = e.where("parent like 'r%'").select(F.col("parent").alias("root"), F.col("child").alias("node"))
    return graph.closure_check(roots.select("root", F.col("root").alias("node")).unionByName(one).unionByName(two), graph.descendants(e, roots), one, ["root", "node"])


@query("g07_partition_systems", """WITH RECURSIVE n AS (SELECT CAST(p_partkey AS BIGINT) AS k, p_partkey % 13 = 0 AS cut FROM part), up AS (SELECT k AS node, k AS root FROM n WHERE NOT cut UNION ALL SELECT node, root // 2 FROM up WHERE root > 1 AND (root // 2) % 13 <> 0),
f AS (SELECT node, min(root) AS fragment FROM up GROUP BY node), o AS (SELECT fragment, min(CASE WHEN node % 10 = 0 THEN lpad(CAST(node AS VARCHAR), 9, '0') END) AS own FROM f GROUP BY fragment),
e AS (SELECT k AS a, k // 2 AS b FROM n WHERE k > 1), t AS (SELECT a AS node, b AS other FROM e UNION ALL SELECT b, a FROM e), c AS (SELECT fragment, min(lpad(CAST(other AS VARCHAR), 9, '0')) AS consumer FROM t JOIN f USING (node) WHERE other % 10 = 0 GROUP BY fragment)
SELECT node, CASE WHEN coalesce(own, consumer) IS NOT NULL THEN 'process:' || coalesce(own, consumer) ELSE 'pending:F' END AS system FROM f JOIN o USING (fragment) LEFT JOIN c USING (fragment)""")
def g07(spark, d):
    k = F.col("p_partkey").cast("long")
    n = t(spark, d, "part").select(k.alias("node"), F.lit("F").alias("fluid"), F.lit("process").alias("fluid_class"), (k % 13 == 0).alias("is_boundary"), F.when(k % 10 == 0, F.lpad(k.cast("string"), 9, "0")).alias("anchor"))
    e = n.where("node > 1").select(F.col("node").alias("src"), F.floor(F.col("node") / 2).cast("long").alias("dst"))
    return graph.partition_systems(n, e, ["utility", "flare"])


_PAIR = "SELECT min(o_orderkey) AS a, max(o_orderkey) AS b FROM orders GROUP BY o_custkey, CAST(o_orderdate AS DATE) HAVING count(*) = 2"


def opcs(spark, d):
    o = t(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("eid"), F.lit(None).cast("string").alias("home"), F.lit(None).cast("string").alias("paired"), F.concat_ws("|", F.col("o_custkey").cast("string"), F.to_date("o_orderdate").cast("string")).alias("opctag"), F.col("o_orderkey").cast("string").alias("guid_self"), F.lit(None).cast("string").alias("guid_mate"))


@query("o03_match_by_tag", _PAIR)
def o03(spark, d):
    return stitch.match_by_tag(opcs(spark, d)).select("a", "b")


@query("o04_match_by_guid", "SELECT o_orderkey AS a, o_orderkey + 1 AS b FROM orders WHERE o_orderkey % 4 = 0 AND o_orderkey + 1 IN (SELECT o_orderkey FROM orders)")
def o04(spark, d):
    x = opcs(spark, d).withColumn("guid_mate", F.when(F.col("eid") % 4 == 0, F.concat(F.lit("SP"), (F.col("eid") + 1).cast("string"))))
    return stitch.match_by_guid(x).select("a", "b")


@query("o06_offpage_edges", f"SELECT a AS from_id, b AS to_id, 'OffPage' AS conn_type, true AS derived, 'none' AS flow_sense FROM ({_PAIR})")
def o06(spark, d):
    return stitch.offpage_edges(stitch.match_by_tag(opcs(spark, d))).drop("connection_id")


@query("o07_open_boundaries", f"SELECT CAST(o_orderkey AS VARCHAR) AS object_id, 'unmatched_opc' AS flag FROM orders WHERE o_orderkey NOT IN (SELECT a FROM ({_PAIR}) UNION SELECT b FROM ({_PAIR}))")
def o07(spark, d):
    return stitch.open_boundaries(stitch.match_pairs(opcs(spark, d))[1]).select("object_id", "flag")


@query("o08_opc_entities", f"SELECT o_orderkey AS eid, o_orderkey IN (SELECT a FROM ({_PAIR}) UNION SELECT b FROM ({_PAIR})) AS matched FROM orders")
def o08(spark, d):
    x = opcs(spark, d)
    return stitch.opc_entities(x, stitch.match_pairs(x)[0]).select("eid", "matched")


@query("o09_stitch_stats", f"SELECT (SELECT count(*) FROM orders) AS n_total, count(*) AS n_pairs, (SELECT count(*) FROM orders) - 2 * count(*) AS n_open, true AS conserved FROM ({_PAIR})")
def o09(spark, d):
    x = opcs(spark, d)
    pairs, rest = stitch.match_pairs(x)
    s = stitch.stitch_stats(x, pairs, rest)
    return s.select(*[F.col(c).cast("long").alias(c) for c in ("n_total", "n_pairs", "n_open")], "conserved")


@query("o02_to_from_whole", """WITH x AS (SELECT doc_id, text, upper(nullif(regexp_extract(text, '(?i)\\A[{S}]*(to|from)([^\\p{L}\\p{M}\\p{N}_]|\\z)', 1), '')) AS dir FROM documents)
SELECT doc_id, dir, nullif(regexp_replace(regexp_replace(CASE WHEN dir IS NULL THEN text ELSE regexp_replace(text, '(?i)\\A[{S}]*(to|from)[{S}:]*', '') END, '\\A[{S}]+', ''), '[{S}]+\\z', ''), '') AS rest FROM x""".replace("{S}", stitch.SPACE))
def o02w(spark, d):
    return t(spark, d, "documents").select("doc_id", stitch.to_from(F.col("text")).alias("x")).select("doc_id", "x.dir", F.col("x.text").alias("rest"))


def subjects(spark, d):
    return {
        "lines": quality.Subject(t(spark, d, "lineitem").withColumn("id", F.concat_ws("-", *[F.col(c).cast("string") for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")])), "id", "line"),
        "customers": quality.Subject(t(spark, d, "customer").withColumn("seg", F.when(F.col("c_custkey") % 9 != 0, F.col("c_mktsegment"))), "c_custkey", "customer"),
        "parts": quality.Subject(t(spark, d, "part"), "p_partkey", "part"),
    }


SUITE = [
    quality.Expectation("seg_missing", "customers", "not_null", column="seg", detail="customer {c_custkey} of {nothing}"),
    quality.Expectation("seg_unknown", "customers", "in_set", column="seg", ref="segments", gate="quarantine", detail="{seg} is not known"),
    quality.Expectation("type_pattern", "parts", "match_regex", column="p_type", ref="pattern", detail="{p_type}"),
    quality.Expectation("brand_chain", "parts", "prefix_chain", columns=("p_name", "p_brand"), severity="info"),
    quality.Expectation("unused_part", "parts", "orphan_node", severity="info", detail="part {p_partkey} unused"),
    quality.Expectation("brand_anchor", "parts", "unique_anchor", column="p_type", scope=("p_brand",), severity="info", detail="{n} parts"),
    quality.Expectation("line_mixed", "lines", "line_attr_inconsistent", column="l_orderkey", columns=("l_linestatus", "l_returnflag"), gate="quarantine", detail="{attrs}"),
    quality.Expectation("name_uncomposable", "parts", "uncomposable_tag", column="p_brand", gate="quarantine", where=("p_type", "contains", "BRASS")),
    quality.Expectation("flag_missing", "lines", "null_flag", column="l_returnflag", gate="fail", severity="error"),
    quality.Expectation("no_reference", "parts", "in_set", column="p_type", ref="missing"),
]


def evaluated(spark, d):
    refs = {"segments": t(spark, d, "customer").where("c_mktsegment <> 'BUILDING'").select("c_mktsegment"), "pattern": "[A-Z]+ [A-Z]+ [A-Z]+"}
    edges = t(spark, d, "lineitem").select("l_partkey", F.col("l_partkey").alias("b")).where("l_partkey % 3 = 0")
    return quality.evaluate(SUITE, subjects(spark, d), refs, edges)


_Q = """WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS seg FROM customer),
l AS (SELECT *, concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS id FROM lineitem),
m AS (
  SELECT 'seg_missing' AS flag, 'customers' AS tab, CAST(c_custkey AS VARCHAR) AS id, CAST(c_custkey AS VARCHAR) AS lk, 1 AS rank, 'customer ' || c_custkey || ' of ?' AS detail FROM c WHERE seg IS NULL
  UNION ALL SELECT 'seg_unknown', 'customers', CAST(c_custkey AS VARCHAR), CAST(c_custkey AS VARCHAR), 2, seg || ' is not known' FROM c WHERE seg = 'BUILDING'
  UNION ALL SELECT 'type_pattern', 'parts', CAST(p_partkey AS VARCHAR), CAST(p_partkey AS VARCHAR), 1, p_type FROM part WHERE NOT regexp_full_match(p_type, '[A-Z]+ [A-Z]+ [A-Z]+')
  UNION ALL SELECT 'brand_chain', 'parts', CAST(p_partkey AS VARCHAR), CAST(p_partkey AS VARCHAR), 1, '' FROM part WHERE NOT contains(p_name, p_brand)
  UNION ALL SELECT 'unused_part', 'parts', CAST(p_partkey AS VARCHAR), CAST(p_partkey AS VARCHAR), 1, 'part ' || p_partkey || ' unused' FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey % 3 = 0)
  UNION ALL SELECT 'brand_anchor', 'parts', CAST(p_partkey AS VARCHAR), p_brand || '|' || p_type, 1, n || ' parts' FROM (SELECT *, count(*) OVER (PARTITION BY p_brand, p_type) AS n FROM part) WHERE n > 1
  UNION ALL SELECT 'line_mixed', 'lines', id, CAST(l_orderkey AS VARCHAR), 2, concat_ws(', ', CASE WHEN s > 1 THEN 'l_linestatus' END, CASE WHEN r > 1 THEN 'l_returnflag' END) FROM l JOIN (SELECT l_orderkey, count(DISTINCT l_linestatus) AS s, count(DISTINCT l_returnflag) AS r FROM l GROUP BY 1) g USING (l_orderkey) WHERE s > 1 OR r > 1
  UNION ALL SELECT 'name_uncomposable', 'parts', CAST(p_partkey AS VARCHAR), CAST(p_partkey AS VARCHAR), 2, '' FROM part WHERE contains(p_type, 'BRASS') AND NOT regexp_matches(p_brand, '[0-9]{3,}')
) """


@query("q15_evaluate_suite", _Q + "SELECT flag, tab AS table_name, id AS object_id, detail FROM m")
def q15(spark, d):
    return evaluated(spark, d)[0].select("flag", F.col("table").alias("table_name"), "object_id", "detail")


@query("q16_gate_rollup", _Q + "SELECT tab AS table_name, id AS object_id, CASE max(rank) WHEN 1 THEN 'flagged' ELSE 'quarantined' END AS quality_gate FROM m GROUP BY tab, id")
def q16(spark, d):
    return quality.gates(evaluated(spark, d)[0]).withColumnRenamed("table", "table_name")


@query("q15_ledger", _Q + "SELECT flag, lk AS ledger_key, min(id) AS object_id FROM m GROUP BY flag, lk")
def q15l(spark, d):
    return quality.ledger(evaluated(spark, d)[0]).select("flag", "ledger_key", "object_id")


@query("q17_mass_failure", _Q + """, t AS (SELECT 'seg_missing' AS flag, count(*) AS n FROM customer UNION ALL SELECT 'seg_unknown', count(*) FROM customer UNION ALL SELECT f, (SELECT count(*) FROM part) FROM (VALUES ('type_pattern'), ('brand_chain'), ('unused_part'), ('brand_anchor')) v(f) UNION ALL SELECT f, (SELECT count(*) FROM lineitem) FROM (VALUES ('line_mixed'), ('flag_missing')) v(f) UNION ALL SELECT 'name_uncomposable', count(*) FROM part WHERE contains(p_type, 'BRASS')),
s AS (SELECT flag, count(DISTINCT id) AS k, count(DISTINCT lk) AS l FROM m GROUP BY flag)
SELECT t.flag, n AS n_evaluated, coalesce(k, 0) AS n_objects, coalesce(l, 0) AS n_ledger, coalesce(t.flag NOT IN ('brand_chain', 'unused_part', 'brand_anchor', 'flag_missing') AND n >= 20 AND k / n > 0.5, false) AS mass_failure FROM t LEFT JOIN s USING (flag)""")
def q17(spark, d):
    return evaluated(spark, d)[1]


@query("k05_apply_gate", _Q + "SELECT p_partkey, coalesce(CASE g WHEN 1 THEN 'flagged' WHEN 2 THEN 'quarantined' END, 'clean') AS quality_gate FROM part LEFT JOIN (SELECT id, max(rank) AS g FROM m WHERE tab = 'parts' GROUP BY id) x ON x.id = CAST(p_partkey AS VARCHAR)")
def k05(spark, d):
    return quality.apply_gate(t(spark, d, "part"), "parts", "p_partkey", quality.gates(evaluated(spark, d)[0])).select("p_partkey", "quality_gate")


@query("q21_ledger_views", _Q + "SELECT flag, rank, count(DISTINCT lk) AS n FROM m GROUP BY flag, rank")
def q21(spark, d):
    return quality.ledger(evaluated(spark, d)[0]).groupBy("flag", F.when(F.col("gate") == "flag", 1).otherwise(2).alias("rank")).agg(F.count("*").alias("n"))


@query("q10_orphans", "SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_partkey % 3 = 0)")
def q10(spark, d):
    e = quality.Expectation("x", "parts", "orphan_node")
    return quality.violations(e, subjects(spark, d)["parts"], {}, t(spark, d, "lineitem").where("l_partkey % 3 = 0").select("l_partkey", F.col("l_partkey").alias("b"))).select("p_partkey")


@query("q02_all_null", "SELECT c_custkey FROM customer WHERE c_custkey % 9 = 0 AND c_custkey % 4 = 0")
def q02(spark, d):
    s = quality.Subject(subjects(spark, d)["customers"].rows.withColumn("nat", F.when(F.col("c_custkey") % 4 != 0, F.col("c_nationkey"))), "c_custkey", "customer")
    return quality.violations(quality.Expectation("x", "c", "all_null", columns=("seg", "nat")), s, {}).select("c_custkey")


@query("q07_roundtrip_whole", "SELECT c_custkey FROM customer WHERE length(regexp_extract(c_name, '#(.*)$', 1)) < 11")
def q07w(spark, d):
    s = quality.Subject(t(spark, d, "customer"), "c_custkey", "customer")
    return quality.violations(quality.Expectation("x", "c", "roundtrip", column="c_name"), s, {}, decode=lambda c: tags.decode(c, F.lit("x"), 2, 9, separator="#")).select("c_custkey")


@query("q12_confined", "SELECT CAST(0 AS BIGINT) AS n_leaked, count(*) FILTER (WHERE c_custkey % 9 <> 0) AS n_other FROM customer")
def q12(spark, d):
    s = subjects(spark, d)
    none = quality.violations(quality.Expectation("x", "parts", "confined", columns=("turnover",)), s["parts"], {}).agg(F.count("*").alias("n_leaked"))
    some = quality.violations(quality.Expectation("x", "customers", "confined", columns=("seg",)), s["customers"], {}).agg(F.count("*").alias("n_other"))
    return none.join(some, F.lit(True))


@query("q19_anchor_multiplicity", "SELECT n_ids, count(*) AS n_anchors FROM (SELECT count(DISTINCT p_partkey) AS n_ids FROM part GROUP BY p_brand, p_type) GROUP BY n_ids")
def q19(spark, d):
    return quality.anchor_multiplicity(t(spark, d, "part"), ["p_brand", "p_type"], "p_partkey")


@query("q20_null_class_profile", "SELECT c_nationkey, count(*) AS n, count(*) FILTER (WHERE c_custkey % 9 = 0) AS n_null, count(*) FILTER (WHERE c_custkey % 9 <> 0 AND c_mktsegment = 'MACHINERY') AS n_catch_all, round(100.0 * count(*) FILTER (WHERE c_custkey % 9 = 0) / count(*), 2) AS pct_null FROM customer GROUP BY c_nationkey")
def q20(spark, d):
    return quality.null_class_profile(subjects(spark, d)["customers"].rows, "seg", ["c_nationkey"], ["MACHINERY"]).drop("pct_catch_all")


@query("q22_lineage_trace", "SELECT CAST(p_partkey AS VARCHAR) AS component_id, regexp_replace(p_name, '[<>&\"'']', ' ', 'g') AS value, p_partkey % 10 <> 0 AS same FROM part")
def q22(spark, d):
    n = topology.extract_objects(xml.shred(part_files(spark, d)), ["PipingComponent"])
    table = n.select("component_id", "tag").withColumn("tag", F.col("tag"))
    source = t(spark, d, "part").select(F.col("p_partkey").cast("string").alias("component_id"), F.when(F.col("p_partkey") % 10 == 0, F.lit("!")).otherwise(F.regexp_replace("p_name", "[<>&\"']", " ")).alias("tag"))
    return quality.lineage_trace(table, source, ["component_id"], "tag").select("component_id", "value", "same")


@query("q23_profiles", "SELECT p_brand, count(*) AS n, count(*) FILTER (WHERE p_size > 25) AS n_large, round(count(*) FILTER (WHERE p_size > 25) / count(*), 4) AS share FROM part GROUP BY p_brand")
def q23(spark, d):
    return t(spark, d, "part").groupBy("p_brand").agg(F.count("*").alias("n"), F.count_if(F.col("p_size") > 25).alias("n_large"), F.round(F.count_if(F.col("p_size") > 25) / F.count("*"), 4).alias("share"))
