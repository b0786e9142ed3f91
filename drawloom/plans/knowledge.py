"""Fact, rule, naming and maintenance queries on the given tables, each with its SQL twin."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from drawloom.functions.text import normal_label
from drawloom.operators import checks, facts, naming, rules
from drawloom.operators.tags import Field
from drawloom.plans.change import t
from drawloom.sources import files, triples
from drawloom.tables import replace_slice, shared_dir

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


# ---- facts ----


def customer_quads(spark, d):
    c = t(spark, d, "customer").withColumn("class", F.when(F.col("c_custkey") % 5 == 0, "CustomObject").otherwise(F.col("c_mktsegment")))
    return facts.component_quads(c, "c_custkey", "class", "c_name", facts.iri("nation", F.col("c_nationkey")))


_CQ = """WITH q AS (SELECT 'urn:plant:component/' || c_custkey AS s, 'rdf:type' AS p, 'urn:plant:class/' || CASE WHEN c_custkey % 5 = 0 THEN 'UnclassifiedComponent' ELSE c_mktsegment END AS o, 'iri' AS o_kind FROM customer
UNION ALL SELECT 'urn:plant:component/' || c_custkey, 'needsReview', 'true', 'literal' FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT 'urn:plant:component/' || c_custkey, 'tag', c_name, 'literal' FROM customer
UNION ALL SELECT 'urn:plant:component/' || c_custkey, 'partOf', 'urn:plant:nation/' || c_nationkey, 'iri' FROM customer) """


@query("p02_component_quads", _CQ + "SELECT s, p, o, o_kind FROM q")
def p02(spark, d):
    return customer_quads(spark, d).select("s", "p", "o", "o_kind")


@query("p13_predicates_used", _CQ + "SELECT 'masterdata' AS graph, p, count(*) AS n FROM q GROUP BY p")
def p13(spark, d):
    return facts.predicates_used(customer_quads(spark, d))


@query("p13_match_pattern", _CQ + "SELECT s, o FROM q WHERE p = 'partOf' AND o = 'urn:plant:nation/3'")
def p13m(spark, d):
    return facts.match(customer_quads(spark, d), p="partOf", o="urn:plant:nation/3", graph="masterdata").select("s", "o")


@query("p13_merge_graphs", _CQ + "SELECT count(*) AS n FROM q")
def p13g(spark, d):
    q = customer_quads(spark, d)
    return facts.merge(q, q.where("p = 'tag'"), q.where("p = 'partOf'")).agg(F.count("*").alias("n"))


@query("p14_wide_facts", "SELECT 'urn:plant:component/' || c_custkey AS s, c_name AS tag, 'urn:plant:nation/' || c_nationkey AS \"partOf\" FROM customer")
def p14(spark, d):
    return facts.wide(customer_quads(spark, d), ["tag", "partOf"])


@query("p03_segment_quads", "SELECT graph, count(*) AS n, count(DISTINCT s) AS n_subjects FROM (SELECT 'masterdata' AS graph, s_suppkey AS s FROM supplier UNION ALL SELECT 'masterdata', s_suppkey FROM supplier UNION ALL SELECT 'oracle', s_suppkey FROM supplier WHERE s_suppkey % 3 = 0) GROUP BY graph")
def p03(spark, d):
    s = t(spark, d, "supplier").withColumn("src_turnover", F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")))
    return facts.segment_quads(s, "s_suppkey", ["s_name"], ["src_turnover"]).groupBy("graph").agg(F.count("*").alias("n"), F.countDistinct("s").alias("n_subjects"))


@query("p04_line_quads", "SELECT 'urn:plant:line/' || l_orderkey AS s, 'l_returnflag' AS p, l_returnflag AS o FROM lineitem GROUP BY ALL UNION ALL SELECT DISTINCT 'urn:plant:line/' || l_orderkey, 'rdf:type', 'urn:plant:class/PipingLine' FROM lineitem")
def p04(spark, d):
    x = t(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_returnflag").alias("l_returnflag"))
    return facts.line_quads(x, ["l_orderkey"], ["l_returnflag"]).select("s", "p", "o")


@query("p05_equipment_quads", "SELECT 'urn:plant:equipment/' || n_nationkey AS s, 'hasNozzle' AS p, 'urn:plant:nozzle/' || s_suppkey AS o FROM nation JOIN supplier ON s_nationkey = n_nationkey UNION ALL SELECT DISTINCT 'urn:plant:equipment/' || n_nationkey, 'tag', n_name FROM nation JOIN supplier ON s_nationkey = n_nationkey UNION ALL SELECT DISTINCT 'urn:plant:equipment/' || n_nationkey, 'rdf:type', 'urn:plant:class/Equipment' FROM nation JOIN supplier ON s_nationkey = n_nationkey")
def p05(spark, d):
    x = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).groupBy("n_nationkey", "n_name").agg(F.collect_set("s_suppkey").alias("nozzles"))
    return facts.equipment_quads(x, "n_nationkey", "n_name", None, "nozzles").select("s", "p", "o")


def connections(spark, d):
    o = t(spark, d, "orders")
    return o.select(F.col("o_orderkey").alias("connection_id"), F.col("o_custkey").alias("from_id"), (F.col("o_orderkey") + 1_000_000).alias("to_id"), F.lit("Process").alias("conn_type"), (F.col("o_orderkey") % 2 == 0).alias("derived"), F.when(F.col("o_orderkey") % 3 == 0, "forward").when(F.col("o_orderkey") % 3 == 1, "both").otherwise("none").alias("flow_sense"))


@query("p06_connection_quads", "SELECT p, count(*) AS n FROM (SELECT unnest(['rdf:type', 'from', 'to', 'derived', 'connType', 'connectedTo', 'connectedTo']) AS p FROM orders UNION ALL SELECT 'flowsTo' FROM orders WHERE o_orderkey % 3 <> 2 UNION ALL SELECT 'flowsTo' FROM orders WHERE o_orderkey % 3 = 1) GROUP BY p")
def p06(spark, d):
    return facts.connection_quads(connections(spark, d)).groupBy("p").agg(F.count("*").alias("n"))


@query("p15_derived_edges", "SELECT count(*) AS n_edges, count(*) FILTER (WHERE o_orderkey % 2 = 0) AS n_derived, CAST(0 AS BIGINT) AS n_without FROM orders")
def p15(spark, d):
    w = facts.wide(facts.connection_quads(connections(spark, d)), ["rdf:type", "derived"]).where("type = 'urn:plant:class/Connection'")
    return w.agg(F.count("*").alias("n_edges"), F.count_if(F.col("derived") == "true").alias("n_derived"), F.count_if(F.col("derived").isNull()).alias("n_without"))


@query("p08_refdata_quads", "SELECT p, count(*) AS n FROM (SELECT unnest(['rdf:type', 'category', 'subcategory']) AS p FROM nation UNION ALL SELECT 'boundaryRole' FROM (SELECT DISTINCT p_type FROM part)) GROUP BY p")
def p08(spark, d):
    fluids = t(spark, d, "nation").select(F.col("n_name").alias("fluid_code"), F.lit("Process").alias("category"), F.col("n_regionkey").cast("string").alias("subcategory"))
    boundary = t(spark, d, "part").select(F.col("p_type").alias("component_class"), F.lit("isolation").alias("role")).distinct()
    return facts.refdata_quads(fluids, boundary).groupBy("p").agg(F.count("*").alias("n"))


@query("p08_contradictions", "SELECT p_type AS component_class, array_to_string(list_sort(list(DISTINCT CASE WHEN p_size % 2 = 0 THEN 'isolation' ELSE 'trap' END)), ',') AS roles FROM part GROUP BY p_type HAVING count(DISTINCT p_size % 2) > 1")
def p08c(spark, d):
    b = t(spark, d, "part").select(F.col("p_type").alias("component_class"), F.when(F.col("p_size") % 2 == 0, "isolation").otherwise("trap").alias("role"))
    return facts.contradictions(b).select("component_class", F.array_join("roles", ",").alias("roles"))


@query("p09_system_quads", "SELECT 'urn:plant:component/' || s_suppkey AS s, 'participatesIn' AS p, 'urn:plant:system/' || s_nationkey || '/function' AS o FROM supplier UNION ALL SELECT DISTINCT 'urn:plant:system/' || s_nationkey, 'rdf:type', 'urn:plant:class/System' FROM supplier UNION ALL SELECT DISTINCT 'urn:plant:system/' || s_nationkey, 'hasFunction', 'urn:plant:system/' || s_nationkey || '/function' FROM supplier")
def p09(spark, d):
    return facts.system_quads(t(spark, d, "supplier"), facts.iri("component", F.col("s_suppkey")), "s_nationkey").select("s", "p", "o")


@query("p10_temporal_quads", "SELECT 'urn:plant:order/' || o_orderkey AS s, 'validFrom' AS p, strftime(o_orderdate, '%Y-%m-%d') AS o FROM orders")
def p10(spark, d):
    o = t(spark, d, "orders").select("o_orderkey", F.to_date("o_orderdate").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), F.lit(None).cast("timestamp").alias("tx_from"), F.lit(None).cast("timestamp").alias("tx_to"))
    return facts.temporal_quads(o, facts.iri("order", F.col("o_orderkey"))).select("s", "p", "o")


@query("p12_oracle_confined", "SELECT count(*) AS n FROM supplier WHERE s_suppkey % 3 = 0")
def p12(spark, d):
    s = t(spark, d, "supplier").withColumn("src_turnover", F.when(F.col("s_suppkey") % 3 == 0, F.col("s_name")))
    q = facts.segment_quads(s, "s_suppkey", ["s_name"], ["src_turnover"])
    wrong = q.withColumn("graph", F.lit("masterdata"))
    return facts.leaked(q.unionByName(wrong), ["src_turnover"]).agg(F.count("*").alias("n"))


@query("p17_fingerprint", _CQ + "SELECT 'masterdata' AS graph, count(DISTINCT (s, p, o)) AS n, true AS same FROM q")
def p17(spark, d):
    q = customer_quads(spark, d)
    a, b = facts.fingerprint(q), facts.fingerprint(q.unionByName(q.where("p = 'tag'")).orderBy("o")).select("graph", F.col("fingerprint").alias("again"))
    return a.join(b, "graph").select("graph", "n", (F.col("fingerprint") == F.col("again")).alias("same"))


@query("k07_ntriples_round_trip", "SELECT 'urn:plant:doc/' || doc_id AS s, 'text' AS p, text AS o FROM documents UNION ALL SELECT 'urn:plant:doc/' || doc_id, 'lang', 'urn:plant:lang/' || lang FROM documents")
def k07(spark, d):
    docs = t(spark, d, "documents")
    q = facts.unpivot(docs, facts.iri("doc", F.col("doc_id")), [("text", F.col("text"), "string"), ("lang", facts.iri("lang", F.col("lang")), "iri")])
    path = f"{shared_dir(spark)}/lines-{uuid.uuid4().hex}"
    triples.to_lines(q).write.text(path)
    return triples.scan_ntriples(spark, path).select("s", "p", "o")


@query("s13_extract_mappings", "SELECT 'http://a/' || p_partkey AS left_uri, 'http://b/' || p_size AS right_uri, CASE WHEN p_size % 3 = 0 THEN 'exact' ELSE 'close' END AS match_type FROM part WHERE p_partkey % 4 <> 0 AND p_size % 3 <> 2 GROUP BY ALL")
def s13(spark, d):
    p = t(spark, d, "part")
    a, b = F.concat(F.lit("http://a/"), F.col("p_partkey").cast("string")), F.concat(F.lit("http://b/"), F.col("p_size").cast("string"))
    turned, bad = F.col("p_partkey") % 2 == 0, F.col("p_partkey") % 4 == 0
    kind = F.when(F.col("p_size") % 3 == 0, "exactMatch").when(F.col("p_size") % 3 == 1, "closeMatch").otherwise("relatedMatch")
    q = p.select(F.when(turned, b).otherwise(a).alias("s"), F.concat(F.lit("http://www.w3.org/2004/02/skos/core#"), kind).alias("p"), F.when(bad, b).when(turned, a).otherwise(b).alias("o"))
    return triples.extract_mappings(q, "//a/", "//b/")["mapped"]


@query("s15_distinct_values", "SELECT DISTINCT trim(p_type) AS p_type FROM part WHERE trim(p_type) <> ''")
def s15(spark, d):
    return files.distinct_values(t(spark, d, "part"), "p_type")


_NORM = "trim(regexp_replace(lower(regexp_replace({c}, '([a-z0-9])([A-Z])', '\\1 \\2', 'g')), '[^a-z0-9]+', ' ', 'g'))"


@query("s16_last_of_each_label", "WITH x AS (SELECT " + _NORM.format(c="p_brand") + " AS key, 'u/' || p_partkey AS uri, p_brand AS label, p_partkey AS o FROM part) SELECT key, arg_max(uri, o) AS uri, arg_max(label, o) AS label FROM x GROUP BY key")
def s16(spark, d):
    p = t(spark, d, "part").select(F.col("p_brand").alias("label"), F.concat(F.lit("u/"), F.col("p_partkey").cast("string")).alias("uri"), F.col("p_partkey").alias("o"))
    return files.last_of_each(p, "label", "uri", "o")


@query("k04_replace_slice", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag <> 'R' UNION ALL SELECT l_orderkey, l_linenumber, 'R' FROM lineitem WHERE l_quantity > 40")
def k04(spark, d):
    x = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag", "l_quantity")
    new = x.where("l_quantity > 40").withColumn("l_returnflag", F.lit("R"))
    return replace_slice(x, F.col("l_returnflag") == "R", new).drop("l_quantity")


@query("k08_snapshot_as_of", "SELECT o_orderkey FROM orders WHERE o_orderkey % 2 = 0")
def k08(spark, d):
    from drawloom.tables import read_as_of, write_snapshot

    path = f"{shared_dir(spark)}/snapshots-{uuid.uuid4().hex}"
    o = t(spark, d, "orders").select("o_orderkey")
    write_snapshot(o.where("o_orderkey % 2 = 0"), path, "first")
    write_snapshot(o, path, "second")
    return read_as_of(spark, path, 0)


# ---- rules ----


@query("l01_classify_fluids", "SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'flare' WHEN c_mktsegment = 'MACHINERY' AND c_nationkey % 2 = 0 THEN 'steam_condensate' WHEN c_mktsegment = 'FURNITURE' THEN 'process' ELSE 'utility' END AS fluid_class FROM customer")
def l01(spark, d):
    c = t(spark, d, "customer")
    seg = F.col("c_mktsegment")
    category = F.when(seg == "BUILDING", "Flare").when(seg == "MACHINERY", "Utility").when(seg == "FURNITURE", "Process").otherwise("Other")
    return c.select("c_custkey", rules.fluid_class(category, F.when(F.col("c_nationkey") % 2 == 0, "Low Steam").otherwise("steam")).alias("fluid_class"))


@query("l01_catalogue_join", "SELECT p_partkey, CASE WHEN n_regionkey = 0 THEN 'flare' WHEN n_regionkey = 1 THEN 'process' ELSE 'utility' END AS fluid_class FROM part LEFT JOIN nation ON n_nationkey = p_size")
def l01c(spark, d):
    fluids = t(spark, d, "nation").select(F.col("n_nationkey").cast("long").alias("fluid_code"), F.when(F.col("n_regionkey") == 0, "Flare").when(F.col("n_regionkey") == 1, "Process").otherwise("Utility").alias("category"), F.lit("").alias("subcategory"))
    return rules.classify_fluids(t(spark, d, "part").select("p_partkey", F.col("p_size").cast("long").alias("fluid_code")), fluids).select("p_partkey", "fluid_class")


@query("l02_boundary_forming", "SELECT p_partkey FROM part WHERE p_type IN (SELECT p_type FROM part WHERE p_size % 10 = 0)")
def l02(spark, d):
    p = t(spark, d, "part")
    b = p.where("p_size % 10 = 0").select(F.col("p_type").alias("component_class"), F.lit("trap").alias("role"))
    return rules.boundary_forming(p, b.unionByName(p.select(F.col("p_type").alias("component_class"), F.lit("other").alias("role"))), "p_type").select("p_partkey")


@query("l03_resolve_class", """SELECT p_partkey, coalesce(u.target, l.target) AS resolved_uri, CASE WHEN u.target IS NOT NULL THEN u.match_type WHEN l.target IS NOT NULL THEN 'label' END AS bridge, coalesce(CASE WHEN u.target IS NOT NULL THEN u.match_type = 'close' WHEN l.target IS NOT NULL THEN true END AND p_size > 25, false) AS pending_review FROM part
LEFT JOIN (SELECT n_nationkey AS k, arg_min('n' || n_nationkey, n_nationkey) AS target, CASE WHEN n_nationkey % 2 = 0 THEN 'exact' ELSE 'close' END AS match_type FROM nation GROUP BY n_nationkey) u ON u.k = p_size LEFT JOIN (SELECT DISTINCT p_brand AS k, 'b' || p_brand AS target FROM part WHERE p_brand LIKE '%1%') l ON l.k = p_brand""")
def l03(spark, d):
    p = t(spark, d, "part").withColumn("uri", F.col("p_size").cast("string"))
    n = t(spark, d, "nation")
    by_uri = n.select(F.col("n_nationkey").cast("string").alias("key"), F.concat(F.lit("n"), F.col("n_nationkey").cast("string")).alias("target"), F.when(F.col("n_nationkey") % 2 == 0, "exact").otherwise("close").alias("match_type"))
    by_uri = by_uri.unionByName(by_uri.where("match_type = 'exact'").withColumns({"match_type": F.lit("close"), "target": F.lit("a")}))
    by_label = t(spark, d, "part").where("p_brand like '%1%'").select(F.col("p_brand").alias("key"), F.concat(F.lit("b"), "p_brand").alias("target")).distinct()
    return rules.resolve_class(p, "uri", "p_brand", by_uri, by_label, F.col("p_size") > 25).select("p_partkey", "resolved_uri", "bridge", "pending_review")


def flows(spark, d):
    x = t(spark, d, "lineitem").select(F.col("l_partkey").cast("long").alias("src"), (F.col("l_suppkey") + 1_000_000).cast("long").alias("dst")).distinct()
    return x.unionByName(x.where("src % 3 = 0").select(F.col("dst").alias("src"), F.col("src").alias("dst")))


_FLOW = "WITH e AS (SELECT DISTINCT CAST(l_partkey AS BIGINT) AS a, CAST(l_suppkey + 1000000 AS BIGINT) AS b FROM lineitem), f AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e WHERE a % 3 = 0), o AS (SELECT a, b FROM f WHERE NOT EXISTS (SELECT 1 FROM f g WHERE g.a = f.b AND g.b = f.a)) "


@query("l05_flare_guard", _FLOW + "SELECT a AS node, b AS neighbour FROM o WHERE b % 4 = 0")
def l05(spark, d):
    e = flows(spark, d)
    f = e.select(F.col("dst").alias("node")).union(e.select("src")).distinct().select("node", F.when(F.col("node") % 4 == 0, "flare").otherwise("utility").alias("fluid_class"))
    return rules.flare_guard(e, f)


@query("l06_supply_tie_in", _FLOW + "SELECT b AS node, a AS neighbour FROM o")
def l06(spark, d):
    return rules.supply_tie_in(flows(spark, d))


@query("l07_relief_attribution", _FLOW + "SELECT b AS valve, a AS protects, a = min(a) OVER (PARTITION BY b) AS single FROM o WHERE b % 5 = 0")
def l07(spark, d):
    e = flows(spark, d)
    return rules.relief_attribution(e, e.where("dst % 5 = 0").select("dst"))


@query("l08_allocate", "SELECT event_id, CASE event_type WHEN 'click' THEN CASE WHEN value >= 50 THEN 'up' ELSE 'down' END WHEN 'view' THEN 'up' WHEN 'purchase' THEN 'down' END AS side FROM events")
def l08(spark, d):
    kind = F.when(F.col("event_type") == "click", "boundary").when(F.col("event_type") == "view", "trap").when(F.col("event_type") == "purchase", "interface").otherwise("none")
    return t(spark, d, "events").select("event_id", rules.allocate(kind, F.lit("up"), F.lit("down"), F.col("value") >= 50, F.lit("up"), F.lit("up"), F.lit("down"), F.lit("up")).alias("side"))


@query("l08_allocation_sides", "SELECT l_orderkey, l_linenumber, CASE l_linenumber % 6 WHEN 0 THEN CASE WHEN l_quantity <= l_tax * 500 THEN 'a' ELSE 'b' END WHEN 1 THEN 'steam' WHEN 2 THEN 'upstream' WHEN 3 THEN l_returnflag WHEN 4 THEN 'equipment' END AS side FROM lineitem")
def l08s(spark, d):
    n, x = F.col("l_linenumber") % 6, F.lit
    kind = F.when(n == 0, "boundary").when(n == 1, "trap").when(n == 2, "sampling").when(n == 3, "interface").when(n == 4, "instrument").otherwise("other")
    side = rules.allocate(kind, x("a"), x("b"), F.col("l_quantity") <= F.col("l_tax") * 500, x("steam"), x("upstream"), F.col("l_returnflag"), x("equipment"))
    return t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", side.alias("side"))


@query("l04_component_fluid", "SELECT l_orderkey, l_linenumber, o_orderpriority AS fluid FROM (SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 7 <> 0 THEN l_orderkey END AS seg FROM lineitem) LEFT JOIN (SELECT o_orderkey, o_orderpriority FROM orders WHERE o_custkey % 5 <> 0) ON o_orderkey = seg")
def l04(spark, d):
    c = t(spark, d, "lineitem").select("l_orderkey", "l_linenumber", F.when(F.col("l_partkey") % 7 != 0, F.col("l_orderkey")).alias("segment_id"))
    s = t(spark, d, "orders").select(F.col("o_orderkey").alias("segment_id"), F.when(F.col("o_custkey") % 5 != 0, F.col("o_orderpriority")).alias("fluid"))
    return rules.component_fluid(c, s).select("l_orderkey", "l_linenumber", "fluid")


@query("l01_flare_by_category_only", "SELECT p_partkey, CASE WHEN p_size % 5 = 0 THEN 'flare' WHEN p_size % 5 = 1 AND p_partkey % 2 = 0 THEN 'steam_condensate' WHEN p_size % 5 = 2 THEN 'process' ELSE 'utility' END AS fluid_class FROM part")
def l01f(spark, d):
    n = F.col("p_size") % 5
    category = F.when(n == 0, "Flare").when(n == 1, "Utility").when(n == 2, "Process").when(n == 3, "Utility")
    sub = F.when(n == 1, F.when(F.col("p_partkey") % 2 == 0, "Flare Steam").otherwise("Flare header")).otherwise("Flare")
    return t(spark, d, "part").select("p_partkey", rules.fluid_class(category, sub).alias("fluid_class"))


@query("l09_unknown_kinds", "SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'S|utility|' || o_orderpriority WHEN 'O' THEN 'S|process|' || o_custkey END AS key FROM orders")
def l09u(spark, d):
    kind = F.when(F.col("o_orderstatus") == "F", "utility").when(F.col("o_orderstatus") == "O", "process").otherwise("drain")
    return t(spark, d, "orders").select("o_orderkey", rules.fragment_key(F.lit("S"), kind, F.col("o_orderpriority"), F.col("o_custkey").cast("string")).alias("key"))


@query("l09_fragment_key", "SELECT c_custkey, CASE WHEN c_custkey % 4 <> 0 AND c_nationkey % 2 = 0 THEN 'S1|utility|' || c_mktsegment WHEN c_custkey % 4 <> 0 AND c_custkey % 3 <> 0 THEN 'S1|process|' || c_name END AS key FROM customer")
def l09(spark, d):
    k = F.col("c_custkey")
    return t(spark, d, "customer").select("c_custkey", rules.fragment_key(F.when(k % 4 != 0, "S1"), F.when(F.col("c_nationkey") % 2 == 0, "utility").otherwise("process"), F.col("c_mktsegment"), F.when(k % 3 != 0, F.col("c_name"))).alias("key"))


@query("l10_materialise", _FLOW + "SELECT p, count(*) AS n FROM (SELECT 'flaresTo' AS p FROM o WHERE b % 4 = 0 UNION ALL SELECT 'suppliedBy' FROM o UNION ALL SELECT 'protects' FROM o WHERE b % 5 = 0 UNION ALL SELECT 'fluidClass' FROM nation) GROUP BY p")
def l10(spark, d):
    e = flows(spark, d)
    f = e.select(F.col("dst").alias("node")).distinct().select("node", F.when(F.col("node") % 4 == 0, "flare").alias("fluid_class"))
    classes = t(spark, d, "nation").select(F.col("n_name").alias("fluid_code"), F.lit("utility").alias("fluid_class"))
    q = rules.materialise(classes, rules.flare_guard(e, f), rules.supply_tie_in(e), rules.relief_attribution(e, e.where("dst % 5 = 0").select("dst")))
    return facts.predicates_used(q).select("p", "n")


@query("l14_parity_pairs", _FLOW + "SELECT count(*) FILTER (WHERE x AND y) AS n_agree, count(*) FILTER (WHERE x AND NOT y) AS n_left_only, count(*) FILTER (WHERE NOT x AND y) AS n_right_only FROM (SELECT a % 7 <> 0 AS x, a % 11 <> 0 AS y FROM o)")
def l14(spark, d):
    s = rules.supply_tie_in(flows(spark, d))
    return rules.parity_pairs(s.where("neighbour % 7 <> 0"), s.where("neighbour % 11 <> 0"), ["node", "neighbour"])


@query("l15_parity_classes", "SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'utility' ELSE c_mktsegment END AS left_value, CASE WHEN c_custkey % 7 = 0 THEN 'utility' ELSE c_mktsegment END AS right_value FROM customer WHERE (c_custkey % 5 = 0) <> (c_custkey % 7 = 0)")
def l15(spark, d):
    c = t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    return rules.parity_classes(c.where("c_custkey % 5 <> 0"), c.where("c_custkey % 7 <> 0"), "c_custkey", "c_mktsegment")


@query("l16_parity_sets", _FLOW + ", m AS (SELECT b AS valve, list(DISTINCT a) AS s FROM o WHERE a % 2 = 0 GROUP BY b), i AS (SELECT b AS valve, min(a) AS one FROM o GROUP BY b) SELECT coalesce(m.valve, i.valve) AS valve, CASE WHEN s IS NULL THEN 'left_only' WHEN one IS NULL THEN 'right_only' WHEN NOT list_contains(s, one) THEN 'mismatch' WHEN len(s) > 1 THEN 'multi' ELSE 'agree' END AS state FROM i FULL JOIN m ON m.valve = i.valve")
def l16(spark, d):
    s = rules.supply_tie_in(flows(spark, d))
    one = s.groupBy(F.col("node").alias("valve")).agg(F.min("neighbour").alias("n"))
    return rules.parity_sets(one, s.where("neighbour % 2 = 0").select(F.col("node").alias("valve"), F.col("neighbour").alias("n")), "valve", "n")


@query("l17_preflight", "SELECT 'nothing' AS missing, 'tag' AS forbidden, false AS ok FROM (SELECT count(*) FROM customer)")
def l17(spark, d):
    r = rules.preflight(customer_quads(spark, d), ["partOf", "nothing"], ["tag", "src_turnover"])
    return r.select(F.array_join("missing", ",").alias("missing"), F.array_join("forbidden", ",").alias("forbidden"), "ok")


@query("l13_freshness", "SELECT 'masterdata' AS graph, false AS fresh FROM (SELECT count(*) FROM customer)")
def l13(spark, d):
    q = customer_quads(spark, d)
    return rules.freshness(facts.fingerprint(q.where("p = 'tag'")).select("graph", "fingerprint"), facts.fingerprint(q).select("graph", "fingerprint")).select("graph", "fresh")


@query("l18_verdicts", _FLOW + "SELECT b % 10 AS grp, count(*) AS found, CASE WHEN count(*) = count(*) FILTER (WHERE a % 3 <> 0) THEN 'ok' ELSE 'check' END AS verdict FROM f WHERE b >= 1000000 GROUP BY 1")
def l18(spark, d):
    e = flows(spark, d).where("dst >= 1000000")
    g = e.groupBy((F.col("dst") % 10).alias("grp")).agg(F.count("*").alias("found"), F.count_if(F.col("src") % 3 != 0).alias("expected"))
    return rules.verdict(g).select("grp", "found", "verdict")


@query("l18_guards_disjoint", _FLOW + "SELECT count(*) AS n_both FROM o x JOIN o y ON x.a = y.b AND x.b = y.a")
def l18d(spark, d):
    e = flows(spark, d)
    f = e.select(F.col("dst").alias("node"), F.lit("flare").alias("fluid_class")).distinct()
    return rules.flare_guard(e, f).join(rules.supply_tie_in(e), ["node", "neighbour"]).agg(F.count("*").alias("n_both"))


@query("l19_rule_card", "SELECT 'in' AS direction, 'partOf' AS p, 'urn:plant:component/' || c_custkey AS other FROM customer WHERE c_nationkey = 7")
def l19(spark, d):
    return rules.rule_card(customer_quads(spark, d), "urn:plant:nation/7")


@query("l20_class_distribution", "SELECT CASE WHEN n_regionkey = 0 THEN 'flare' WHEN n_regionkey = 1 THEN 'process' ELSE 'utility' END AS fluid_class, count(*) AS n FROM part LEFT JOIN nation ON n_nationkey = p_size GROUP BY 1")
def l20(spark, d):
    return l01c(spark, d).groupBy("fluid_class").agg(F.count("*").alias("n"))


@query("l21_fluid_span", "SELECT l_returnflag, count(DISTINCT l_suppkey) AS n_systems, count(DISTINCT l_partkey) AS n_components FROM lineitem GROUP BY l_returnflag")
def l21(spark, d):
    return rules.fluid_span(t(spark, d, "lineitem"), "l_returnflag", "l_suppkey", "l_partkey")


# ---- naming ----


@query("n01_member_value", "WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2) SELECT user_id, event_type FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1")
def n01(spark, d):
    return naming.member_value(t(spark, d, "events"), "user_id", "event_type")


@query("n02_lookup", "SELECT c_custkey, CASE WHEN count(DISTINCT n_name) = 1 THEN max(n_name) END AS n_name, CASE WHEN count(DISTINCT n_name) = 1 THEN NULL WHEN count(DISTINCT n_name) > 1 THEN 'several' ELSE 'none' END AS problem FROM customer LEFT JOIN nation ON CASE WHEN c_custkey % 3 = 0 THEN c_nationkey + 100 WHEN c_custkey % 3 = 1 THEN c_nationkey ELSE n_nationkey END = n_nationkey GROUP BY c_custkey")
def n02(spark, d):
    n = t(spark, d, "nation").select(F.lpad(F.col("n_nationkey").cast("string"), 4, "0").alias("k"), "n_name")
    n = n.unionByName(n.withColumn("k", F.lit("999")))
    k = F.col("c_custkey")
    c = t(spark, d, "customer").select("c_custkey", F.when(k % 3 == 0, F.col("c_nationkey") + 100).when(k % 3 == 1, F.col("c_nationkey")).otherwise(F.lit(999)).cast("string").alias("code"))
    return naming.lookup(c, n, [("code", "k")], "n_name", "c_custkey").select("c_custkey", "n_name", "problem")


@query("j08_list_join", "SELECT n_nationkey, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def j08(spark, d):
    r = t(spark, d, "nation").groupBy("n_regionkey").agg(F.array_join(F.array_sort(F.collect_list(F.lpad(F.col("n_nationkey").cast("string"), 3, "0"))), "; ").alias("cell")).join(t(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select("cell", "r_name")
    return naming.list_join(t(spark, d, "nation").select("n_nationkey"), r, "n_nationkey", "cell").select("n_nationkey", "r_name")


@query("n04_prefer", "WITH c AS (SELECT l_orderkey, l_partkey, l_suppkey, CASE WHEN l_returnflag = 'R' THEN l_linenumber ELSE 0 END AS s, l_linenumber FROM lineitem) SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber FROM c QUALIFY count(*) OVER (PARTITION BY l_orderkey) = 1 OR max(s) OVER (PARTITION BY l_orderkey) <= 0 OR s = max(s) OVER (PARTITION BY l_orderkey)")
def n04(spark, d):
    x = t(spark, d, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag")
    return naming.prefer(x, "l_orderkey", F.when(F.col("l_returnflag") == "R", F.col("l_linenumber")).otherwise(0)).drop("l_returnflag")


@query("n06_sequence", "SELECT c_custkey, CASE WHEN length(CAST(n AS VARCHAR)) >= 3 THEN CAST(n AS VARCHAR) ELSE lpad(CAST(n AS VARCHAR), 3, '0') END AS sequence FROM (SELECT c_custkey, row_number() OVER (PARTITION BY c_nationkey ORDER BY CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE '~' END, c_name) AS n FROM customer)")
def n06(spark, d):
    c = t(spark, d, "customer").withColumn("a", F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment")))
    return naming.sequence(c, ["c_nationkey"], "a", "c_name", 3).select("c_custkey", "sequence")


@query("n07_first_rule", "SELECT c_custkey, coalesce(CASE WHEN c_custkey % 5 = 0 THEN 'five' END, CASE WHEN c_custkey % 3 = 0 THEN 'three' END, 'none') AS v FROM customer")
def n07(spark, d):
    k = F.col("c_custkey")
    return t(spark, d, "customer").select("c_custkey", naming.first_rule([F.when(k % 5 == 0, "five"), F.when(k % 3 == 0, "three"), F.lit("none")]).alias("v"))


def named(spark, d):
    s = t(spark, d, "supplier").join(t(spark, d, "nation"), F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "n_name", F.when(F.col("s_suppkey") % 4 != 0, F.col("n_regionkey").cast("string")).alias("region"), F.lit(1).cast("long").alias("members"))
    return naming.render(s, [[Field("region", required=True)], [Field("nation", prefix="N")]], {"region": F.col("region"), "nation": F.col("n_name")})


_NAMED = "WITH s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 4 <> 0 THEN n_regionkey || '-N' || n_name END AS name FROM supplier JOIN nation ON s_nationkey = n_nationkey) "


@query("n08_render", _NAMED + "SELECT s_suppkey, name, CASE WHEN name IS NULL THEN 'region' ELSE '' END AS missing FROM s")
def n08(spark, d):
    return named(spark, d).select("s_suppkey", "name", F.array_join("missing", ",").alias("missing"))


@query("n09_merge_same_name", _NAMED + "SELECT name, string_agg(CAST(s_suppkey AS VARCHAR), ',' ORDER BY CAST(s_suppkey AS VARCHAR)) AS labels, count(*) AS n_systems, count(*) AS n_members FROM s GROUP BY coalesce(name, '?' || s_suppkey), name")
def n09(spark, d):
    return naming.merge_same_name(named(spark, d), "name", "s_suppkey", "members").select("name", F.array_join("labels", ",").alias("labels"), "n_systems", "n_members")


@query("n14_naming_report", _NAMED + "SELECT count(*) AS n_systems, count(name) AS n_named, count(*) AS n_members, CAST(1 AS BIGINT) AS largest, 'region' AS most_missing FROM s")
def n14(spark, d):
    return naming.naming_report(named(spark, d), "name", "members")


@query("n10_service_texts_whole", "WITH o AS (SELECT o_orderkey, o_orderstatus AS seg, c_mktsegment AS txt FROM orders JOIN customer ON o_custkey = c_custkey) SELECT object_id, array_to_string(list_sort(list(DISTINCT txt)), ',') AS texts FROM (SELECT seg AS object_id, txt FROM o UNION ALL SELECT l_returnflag, txt FROM o JOIN (SELECT DISTINCT l_linestatus, l_returnflag FROM lineitem) ON seg = l_linestatus) GROUP BY object_id")
def n10w(spark, d):
    o = t(spark, d, "orders").join(t(spark, d, "customer"), F.col("o_custkey") == F.col("c_custkey")).select(F.col("o_orderstatus").alias("on_segment"), F.col("c_mktsegment").alias("description"))
    c = t(spark, d, "lineitem").select(F.col("l_linestatus").alias("segment_id"), F.col("l_returnflag").alias("component_id")).distinct()
    return naming.service_texts(o, c).select("object_id", F.array_join("texts", ",").alias("texts"))


@query("n11_reference_issues", "SELECT 'conflict' AS issue, p_brand AS key, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS detail FROM part GROUP BY p_brand HAVING count(DISTINCT p_type) > 1 UNION ALL SELECT DISTINCT 'unknown', p_brand, p_type FROM part WHERE p_type NOT IN (SELECT p_type FROM part WHERE p_size < 20)")
def n11(spark, d):
    p = t(spark, d, "part")
    return naming.reference_issues(p, ["p_brand"], "p_type", p.where("p_size < 20").select("p_type"))


@query("n12_coverage", "SELECT c_mktsegment, count(*) AS n, count(*) FILTER (WHERE c_custkey % 3 <> 0) AS n_resolved, round(count(*) FILTER (WHERE c_custkey % 3 <> 0) / count(*), 4) AS share FROM customer GROUP BY c_mktsegment")
def n12(spark, d):
    return naming.coverage(t(spark, d, "customer").withColumn("f", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name"))), "f", ["c_mktsegment"])


@query("n15_label_match", "WITH r AS (SELECT " + _NORM.format(c="p_type") + " AS k, min(p_partkey) AS match FROM part WHERE p_size % 2 = 0 GROUP BY 1) SELECT p_partkey, match FROM part LEFT JOIN r ON k = " + _NORM.format(c="p_type"))
def n15(spark, d):
    p = t(spark, d, "part")
    return naming.label_match(p.select("p_partkey", F.upper("p_type").alias("l")), "l", p.where("p_size % 2 = 0").select("p_type", F.col("p_partkey").alias("k")), "p_type", "k").select("p_partkey", "match")


@query("n16_fuzzy_candidates", """WITH a AS (SELECT DISTINCT {n1} AS a FROM part), b AS (SELECT DISTINCT {n2} AS b FROM part), s AS (SELECT a, b, round(1 - levenshtein(a, b) / greatest(length(a), length(b)), 6) AS similarity FROM a, b)
SELECT a AS label, b AS suggested, similarity FROM s WHERE similarity >= 0.5 QUALIFY row_number() OVER (PARTITION BY a ORDER BY similarity DESC, b) = 1""".replace("{n1}", _NORM.format(c="p_type")).replace("{n2}", _NORM.format(c="p_type || 'x'")))
def n16(spark, d):
    p = t(spark, d, "part")
    return naming.fuzzy_candidates(p, "p_type", p.select(F.concat("p_type", F.lit("x")).alias("r")), "r")


@query("n17_gap_ranking", "SELECT p_brand, n, boundary, CAST(row_number() OVER (ORDER BY boundary DESC, n DESC, p_brand) AS BIGINT) AS rank FROM (SELECT p_brand, count(*) AS n, bool_or(p_size > 45) AS boundary FROM part WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_partkey % 97 = 0) GROUP BY p_brand)")
def n17(spark, d):
    p = t(spark, d, "part")
    return naming.gap_ranking(p, p.where("p_partkey % 97 = 0"), "p_brand", F.col("p_size") > 45).withColumn("rank", F.col("rank").cast("long"))


@query("n18_seed_aliases", "SELECT p_partkey, p_partkey % 3 <> 0 AS found FROM part")
def n18(spark, d):
    seeds = t(spark, d, "part").select("p_partkey", F.concat(F.lit("lab"), F.col("p_partkey").cast("string")).alias("l"))
    ok, missing = naming.seed_aliases(seeds, "l", seeds.where("p_partkey % 3 <> 0").select(F.upper("l").alias("r"), F.col("p_partkey").alias("u")), "r", "u")
    return ok.select("p_partkey", F.lit(True).alias("found")).unionByName(missing.select("p_partkey", F.lit(False).alias("found")))


@query("n15_normal_label", "SELECT p_partkey, " + _NORM.format(c="p_name") + " AS k FROM part")
def n15n(spark, d):
    return t(spark, d, "part").select("p_partkey", normal_label(F.col("p_name")).alias("k"))


# ---- checks on facts ----

_OPCS = """WITH c AS (SELECT 'urn:plant:opc/' || c_custkey AS opc, ['Piping OPC', 'Utility OPC', 'Instrument OPC'][c_custkey % 3 + 1] AS opcType, c_custkey % 2 = 0 AS matched, CASE WHEN c_custkey % 3 <> 2 AND c_custkey % 7 <> 0 THEN 'urn:plant:segment/' || c_nationkey END AS seg FROM customer),
e AS (SELECT 'urn:plant:opc/' || o_custkey AS opc_a, 'urn:plant:opc/' || (o_custkey + 3) AS opc_b, o_orderkey FROM orders) """


def connector_facts(spark, d):
    """Customers as connectors on the segment of their nation, orders as edges to the customer three keys on."""
    k = F.col("c_custkey")
    opcs = t(spark, d, "customer").select(k.alias("eid"), F.col("c_name").alias("opctag"), F.element_at(F.array(F.lit("Piping OPC"), F.lit("Utility OPC"), F.lit("Instrument OPC")), (k % 3 + 1).cast("int")).alias("opc_type"), (k % 2 == 0).alias("matched"), F.struct(F.lit("to").alias("text")).alias("to_from"), F.col("c_nationkey").alias("on_segment"), F.when(k % 7 == 0, "SignalOffPageConnector").otherwise("FlowInPipeOffPageConnector").alias("flow_direction"))
    edges = t(spark, d, "orders").select(F.col("o_orderkey").alias("connection_id"), F.col("o_custkey").alias("from_id"), (F.col("o_custkey") + 3).alias("to_id"), F.lit("OffPage").alias("conn_type"), F.lit(True).alias("derived"), F.lit("none").alias("flow_sense"))
    return facts.opc_quads(opcs).unionByName(facts.connection_quads(edges, "opc"))


@query("p15_connector_coverage", _OPCS + "SELECT opcType, count(*) AS n, count(*) FILTER (WHERE matched) AS n_matched, count(seg) AS n_terminating FROM c GROUP BY opcType")
def p15c(spark, d):
    return checks.connector_coverage(connector_facts(spark, d))


@query("p15_edges_across", _OPCS + "SELECT 'urn:plant:connection/' || o_orderkey AS connection, opc_a, opc_b, 'true' AS derived FROM e WHERE opc_a IN (SELECT opc FROM c) AND opc_b IN (SELECT opc FROM c)")
def p15e(spark, d):
    return checks.edges_across(connector_facts(spark, d))


@query("p15_walk_across", _OPCS + "SELECT a.seg AS segment_a, opc_a, opc_b, b.seg AS segment_b FROM e JOIN c a ON a.opc = opc_a JOIN c b ON b.opc = opc_b WHERE a.seg <> b.seg")
def p15w(spark, d):
    return checks.walk_across(connector_facts(spark, d))


@query("p16_completeness", "SELECT count(*) AS n, count(*) AS with_derived, count(*) AS with_connType, CAST(0 AS BIGINT) AS with_tag FROM orders")
def p16c(spark, d):
    return checks.completeness(connector_facts(spark, d), "Connection", ["derived", "connType", "tag"])


@query("p16_also_typed", "SELECT DISTINCT 'urn:plant:segment/' || p_partkey AS s, 'urn:plant:class/Valve' AS type FROM part WHERE p_partkey % 5 = 0")
def p16t(spark, d):
    """Every fifth segment is a valve too, which is a component."""
    p = t(spark, d, "part")
    s = facts.iri("segment", F.col("p_partkey"))
    q = facts.unpivot(p, s, [("rdf:type", F.lit("urn:plant:class/PipingSegment"), "iri"), ("rdf:type", F.when(F.col("p_partkey") % 5 == 0, F.lit("urn:plant:class/Valve")), "iri")])
    return checks.also_typed(q.unionByName(facts.ontology_skeleton(spark)), ["PipingSegment", "PipingLine"], "Component")


@query("n03_select", """WITH c AS (SELECT o_orderkey, l_partkey AS v, l_linenumber AS lab, o_orderkey % 11 <> 0 AS ok, CASE WHEN l_linenumber % 4 = 0 THEN '' ELSE l_linestatus END AS cell, o_orderstatus AS want, l_linenumber = o_orderkey % 7 + 1 AS eq FROM orders JOIN lineitem ON l_orderkey = o_orderkey),
s AS (SELECT *, count(*) FILTER (WHERE ok) OVER (PARTITION BY o_orderkey) AS n FROM c),
h AS (SELECT *, ok AND (cell = want OR (n = 1 AND cell = '')) AS hit FROM s),
m AS (SELECT *, count(*) FILTER (WHERE hit) OVER w AS n_hit, count(*) FILTER (WHERE hit AND eq) OVER w AS n_eq FROM h WINDOW w AS (PARTITION BY o_orderkey)),
k AS (SELECT *, CASE WHEN n_hit > 1 AND n_eq > 0 THEN hit AND eq ELSE hit END AS last FROM m),
g AS (SELECT o_orderkey, count(*) FILTER (WHERE last) AS n_last, max(n) AS n, min(v) FILTER (WHERE last) AS v, list_sort(list(DISTINCT CAST(lab AS VARCHAR)) FILTER (WHERE last)) AS a, list_sort(list(DISTINCT CAST(lab AS VARCHAR)) FILTER (WHERE ok)) AS b FROM k GROUP BY o_orderkey)
SELECT o.o_orderkey, CASE WHEN n_last = 1 THEN v END AS l_partkey, CASE WHEN g.o_orderkey IS NULL THEN 'none' WHEN n_last = 1 THEN NULL WHEN n_last > 1 THEN 'several' WHEN n = 0 THEN 'scope' ELSE 'unlisted' END AS problem, CASE WHEN n_last > 1 THEN array_to_string(a, ',') WHEN n_last = 0 AND n > 0 THEN array_to_string(b, ',') ELSE '' END AS candidates FROM orders o LEFT JOIN g ON g.o_orderkey = o.o_orderkey""")
def n03(spark, d):
    """Each order's line by status list, in the scope of its customer's group, by line number where several are left."""
    o, line = t(spark, d, "orders"), t(spark, d, "lineitem")
    rows = o.select("o_orderkey", (F.col("o_custkey") % 5).alias("group"), "o_orderstatus", (F.col("o_orderkey") % 7 + 1).alias("number"))
    table = line.select("l_orderkey", "l_partkey", "l_linenumber", F.when(F.col("l_linenumber") % 4 == 0, "").otherwise(F.col("l_linestatus")).alias("cell"))
    allowed = o.where("o_orderkey % 11 <> 0").select((F.col("o_custkey") % 5).alias("group"), "o_orderkey")
    out = naming.select(rows, "o_orderkey", table, [("o_orderkey", "l_orderkey")], "l_partkey", "l_linenumber", ("group", allowed, "group", "o_orderkey"), ("o_orderstatus", "cell"), [("number", "l_linenumber")])
    return out.withColumn("candidates", F.array_join("candidates", ","))
