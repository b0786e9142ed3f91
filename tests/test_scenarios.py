"""Small scenarios of the operators: what a query over the given tables cannot show."""

import datetime as dt

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from drawloom.operators import cdc, facts, graph, history, landing, naming, quality, rules, stitch, tags, topology
from drawloom.operators.tags import Field
from drawloom.sources import sheets, triples
from drawloom.tables import create_table, history_of, read_as_of, replace_slice, write_lists, write_snapshot, write_table

D = dt.date
T = dt.datetime


# ---- stitch ----


def opc(spark, rows):
    return spark.createDataFrame(rows, "eid string, home string, paired string, opctag string, guid_self string, guid_mate string")


def test_pairs_by_tag_and_guid(spark):
    x = opc(spark, [
        ("a1", "D1", "D2", "T1", "a1", None), ("a2", "D2", "D1", "T1", "a2", None),  # a pair by tag
        ("b1", "D1", "D9", "T2", "b1", None), ("b2", "D2", "D1", "T2", "b2", None),  # the homes disagree
        ("c1", "D1", None, "T3", "c1", None), ("c2", "D2", None, "T3", "c2", None), ("c3", "D3", None, "T3", "c3", None),  # three share a tag
        ("d1", "D1", None, None, "SP77", "78"), ("d2", "D2", None, " ", "78", None), ("e1", "D1", None, None, "e1", "nobody"),
    ])
    pairs, rest = stitch.match_pairs(x)
    assert sorted(tuple(r) for r in pairs.collect()) == [("a1", "a2", "tag"), ("d1", "d2", "guid")]
    s = stitch.stitch_stats(x, pairs, rest).first()
    assert (s["n_total"], s["n_pairs"], s["n_open"], s["conserved"]) == (10, 2, 6, True)
    assert stitch.open_boundaries(rest).count() == 6
    assert all(r["derived"] and r["flow_sense"] == "none" and r["from_id"] < r["to_id"] for r in stitch.offpage_edges(pairs).collect())


def test_guid_match_is_one_to_one(spark):
    x = opc(spark, [("a", None, None, None, "a", "b"), ("b", None, None, None, "b", "c"), ("c", None, None, None, "c", "a")])
    pairs = stitch.match_by_guid(x).collect()
    ends = [e for p in pairs for e in (p["a"], p["b"])]
    assert len(ends) == len(set(ends)) and len(pairs) == 1


def mates(spark, names):
    ids = sorted({x for p in names for x in p})
    return opc(spark, [(i, None, None, None, i, dict(names).get(i)) for i in ids])


@pytest.mark.parametrize("names, want, left", [
    ([("1", "2"), ("2", "3"), ("3", "4")], [("1", "2"), ("3", "4")], []),  # a chain
    ([("1", "2"), ("2", "3"), ("3", "4"), ("4", "5"), ("5", "6"), ("6", "7")], [("1", "2"), ("3", "4"), ("5", "6")], ["7"]),
    ([("1", "5"), ("2", "5"), ("5", "6")], [("1", "5")], ["2", "6"]),  # a shared mate
    ([("2", "3"), ("3", "1"), ("4", "1")], [("1", "4"), ("2", "3")], []),  # by the naming record, not by the lesser end
])
def test_guid_match_leaves_no_pair_of_free_records(spark, names, want, left):
    pairs, rest = stitch.match_pairs(mates(spark, names))
    assert sorted((p["a"], p["b"]) for p in pairs.collect()) == want
    assert sorted(r["eid"] for r in rest.collect()) == left


def test_guid_match_of_shared_guids(spark):
    x = opc(spark, [("1", None, None, None, "1", "S"), ("2", None, None, None, "2", "S"), ("5", None, None, None, "S", None), ("6", None, None, None, "SPS", None)])
    assert sorted((p["a"], p["b"]) for p in stitch.match_by_guid(x).collect()) == [("1", "5"), ("2", "6")]


def test_to_from(spark):
    df = spark.createDataFrame([("To V-101",), ("FROM: pump",), ("tower",), (None,), ("to",)], "t string")
    assert [tuple(r[0]) if r[0] else None for r in df.select(stitch.to_from(F.col("t"))).collect()] == [("TO", "V-101"), ("FROM", "pump"), (None, "tower"), (None, None), ("TO", None)]


def test_to_from_of_whole_texts(spark):
    x = ["To flare,\nsheet 2, Größe\n", "\u00a0from\t: Kühler, a", "Toön, b", "\n\t tower,\n x \n", " \n\u2003", "To", "from\u0301 x", None]
    df = spark.createDataFrame([(t,) for t in x], "t string").select(stitch.to_from(F.col("t")).alias("x")).select("x.*")
    assert [tuple(r) for r in df.collect()] == [("TO", "flare,\nsheet 2, Größe"), ("FROM", "Kühler, a"), (None, "Toön, b"), (None, "tower,\n x"), (None, None), ("TO", None), (None, "from\u0301 x"), (None, None)]


def test_to_from_of_every_document(spark):
    from drawloom import catalog

    d = "/root/testdata/sf0.001"
    got = catalog.QUERIES["o02_to_from_whole"](spark, d)
    assert got.count() == spark.read.parquet(f"{d}/documents.parquet").count()
    assert got.where("contains(rest, ',')").count() > 0


# ---- naming ----


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        row, up = [i + 1], row
        for j, y in enumerate(b):
            row.append(min(up[j + 1] + 1, row[j] + 1, up[j] + (x != y)))
    return row[-1]


@pytest.mark.parametrize("least, block", [(0.5, 1000), (0.5, 3), (0.7, 3), (0.0, 7)])
def test_fuzzy_candidates_are_those_of_all_with_all(spark, least, block):
    import random

    r = random.Random(7)
    words = ["valve", "abcdefgh", "gate valve", "heat exchanger", "pump", "x", "ab", "reducer", "elbow", "check valve"]
    other = ["vlave", "abxdexgh", "y", "ba", "", "###"]
    for w in words:
        for _ in range(3):
            c = list(w)
            for _ in range(1 + len(c) // 4):
                i = r.randrange(len(c))
                k = r.randrange(3)
                if k == 0:
                    c[i] = r.choice("abcdexyz")
                elif k == 1 and i + 1 < len(c):
                    c[i], c[i + 1] = c[i + 1], c[i]
                elif len(c) > 1:
                    del c[i]
            other.append(" ".join("".join(c).split()))
    want = {}
    for a in {"" if w == "###" else w for w in other}:
        best = min(((-round(1 - edits(a, b) / max(len(a), len(b)), 6), b) for b in words), default=None)
        if -best[0] >= least:
            want[a] = (best[1], -best[0])
    x = spark.createDataFrame([(w,) for w in other], "l string")
    ref = spark.createDataFrame([(w,) for w in words], "r string")
    got = {t["label"]: (t["suggested"], t["similarity"]) for t in naming.fuzzy_candidates(x, "l", ref, "r", least, block).collect()}
    assert got == want
    assert least > 0.6 or got["vlave"] == ("valve", 0.6)
    assert got["abxdexgh"] == ("abcdefgh", 0.75)


# ---- change ----


def side(spark, rows):
    return spark.createDataFrame(rows, "k string, id string, v string, pos int")


def test_redrawn_objects_give_no_delta(spark):
    old = side(spark, [("x", "1", "a", 0), ("x", "2", "a", 1), ("y", "3", None, None)])
    new = side(spark, [("x", "91", "a", 0), ("x", "92", "a", 1), ("y", "93", "", None)])
    assert cdc.diff(old, new, ["k"], "id", ["v"], "pos").count() == 0


def test_bucket_pairs_by_position(spark):
    old = side(spark, [("x", "1", "a", 0), ("x", "2", "b", 1), ("x", "3", "c", 2), (None, "9", "q", 0)])
    new = side(spark, [("x", "11", "a", 0), ("x", "12", "B", 1), ("", "19", "Q", 0), ("z", "20", "n", 0)])
    got = sorted((r["k"], r["change_type"], r["old_id"], r["new_id"], r["detail"]) for r in cdc.diff(old, new, ["k"], "id", ["v"], "pos").collect())
    assert got == [("", "Modified", "9", "19", "v"), ("x", "Deleted", "3", None, ""), ("x", "Modified", "2", "12", "v"), ("z", "New", None, "20", "")]


def test_answer_key_changes_the_audit_hash_only(spark):
    df = spark.createDataFrame([(1, "a", "t1"), (2, "a", "t2")], "id int, attr string, turnover string")
    a, b = cdc.content_hashes(df, ["attr"], ["id", "turnover"]).collect()
    assert a["content_hash_eng"] == b["content_hash_eng"] and a["content_hash_audit"] != b["content_hash_audit"]


def test_resplit_line_is_the_same_line(spark):
    p = lambda rows: spark.createDataFrame(rows, "d string, tag string, id int, fluid string")
    bad = quality.uncomposable(F.col("tag"))
    one = cdc.aggregate_lines(p([("D", "PG-1001", 1, "PG"), ("D", "to here", 5, "PG")]), ["d", "tag"], "id", ["fluid"], bad)
    two = cdc.aggregate_lines(p([("D", "PG-1001", 7, "PG"), ("D", "PG-1001", 8, None)]), ["d", "tag"], "id", ["fluid"], bad)
    assert cdc.diff(one.withColumn("u", F.lit("x")), two.withColumn("u", F.lit("y")), ["d", "tag"], "u", ["fluid"]).count() == 0
    mixed = cdc.aggregate_lines(p([("D", "PG-1001", 7, "PG"), ("D", "PG-1001", 8, "N")]), ["d", "tag"], "id", ["fluid"], bad).first()
    assert mixed["inconsistent"] == ["fluid"] and mixed["piece_count"] == 2


def test_latest_two_versions(spark):
    df = spark.createDataFrame([("a", T(2024, 1, 1), "h1"), ("a", T(2024, 2, 1), "h2"), ("a", None, "h3"), ("b", T(2024, 1, 1), "h4")], "d string, t timestamp, h string")
    assert [(r["d"], r["h"], r["version_rank"]) for r in cdc.latest_two(df, "d", "t", "h").orderBy("version_rank").collect()] == [("a", "h2", 1), ("a", "h1", 2)]


# ---- history ----

EVENT = "k string, change_type string, attrs string, valid_from date, tx timestamp, delta_id string"


def fold(spark, *rows, prior=None):
    e = spark.createDataFrame([("K", kind, a, v, t, f"d{i}") for i, (kind, a, v, t) in enumerate(rows)], EVENT)
    r, odd = history.apply_events(e, ["k"], prior)
    key = lambda x: (x[1], x[3], x[0])
    return sorted(((x["attrs"], x["valid_from"], x["valid_to"], x["tx_from"], x["tx_to"]) for x in r.collect()), key=key), [x["reason"] for x in odd.collect()]


def test_as_of_latest_answers_every_row_once(spark):
    h = spark.createDataFrame([
        ("K", "a", D(2024, 1, 1), D(2024, 2, 1), T(2024, 1, 2), None), ("K", "b", D(2024, 2, 1), None, T(2024, 2, 2), T(2024, 2, 5)), ("K", "c", D(2024, 2, 1), D(2024, 3, 1), T(2024, 2, 5), T(2024, 3, 2)),
    ], "k string, attrs string, valid_from date, valid_to date, tx_from timestamp, tx_to timestamp")
    x = spark.createDataFrame([(1, "K", D(2023, 1, 1)), (2, "K", D(2024, 1, 1)), (3, "K", D(2024, 1, 31)), (4, "K", D(2024, 2, 1)), (5, "K", D(2024, 2, 1)), (6, "K", D(2024, 3, 1)), (7, "other", D(2024, 2, 1)), (8, None, D(2024, 2, 1)), (9, "K", None)], "i int, k string, at date")
    got = sorted(tuple(r) for r in history.as_of_latest(x, h, "k", "at").select("i", "as_of_attrs").collect())
    assert got == [(1, None), (2, "a"), (3, "a"), (4, "c"), (5, "c"), (6, None), (7, None), (8, None), (9, None)]


def test_whole_queries_have_no_filter_on_their_input(spark):
    from drawloom import catalog

    d = "/root/testdata/sf0.001"
    rows = lambda q: catalog.QUERIES[q](spark, d)
    assert rows("j09_as_of_join_whole").select("o_orderkey").distinct().count() == spark.read.parquet(f"{d}/orders.parquet").count()
    assert rows("g03_flow_between_whole").count() == spark.read.parquet(f"{d}/lineitem.parquet").select("l_partkey", "l_suppkey").distinct().count()
    assert rows("q07_roundtrip_whole").where("c_custkey % 2 = 1").count() > 0


def test_forward_change_closes_valid_time_only(spark):
    rows, odd = fold(spark, ("New", "a", D(2024, 1, 1), T(2024, 1, 2)), ("Modified", "b", D(2024, 3, 1), T(2024, 3, 2)))
    assert rows == [("a", D(2024, 1, 1), D(2024, 3, 1), T(2024, 1, 2), None), ("b", D(2024, 3, 1), None, T(2024, 3, 2), None)] and not odd


def test_correction_closes_transaction_time_only(spark):
    rows, _ = fold(spark, ("New", "a", D(2024, 1, 1), T(2024, 1, 2)), ("Modified", "b", D(2024, 1, 1), T(2024, 1, 9)))
    assert rows == [("a", D(2024, 1, 1), None, T(2024, 1, 2), T(2024, 1, 9)), ("b", D(2024, 1, 1), None, T(2024, 1, 9), None)]


def test_deleted_closes_both_and_no_op_changes_nothing(spark):
    rows, odd = fold(spark, ("New", "a", D(2024, 1, 1), T(2024, 1, 2)), ("Modified", "a", D(2024, 2, 1), T(2024, 2, 2)), ("Deleted", None, D(2024, 3, 1), T(2024, 3, 2)))
    assert rows == [("a", D(2024, 1, 1), D(2024, 3, 1), T(2024, 1, 2), T(2024, 3, 2))] and not odd


def test_anomalies(spark):
    rows, odd = fold(spark, ("Deleted", None, D(2024, 1, 1), T(2024, 1, 1)), ("New", "x", D(2024, 1, 1), T(2024, 1, 2)), ("Modified", "y", D(2023, 1, 1), T(2024, 1, 3)))
    assert odd == ["deleted_without_current", "anchor_collision", "retroactive_correction"] and len(rows) == 1


def test_deleted_before_the_open_row_closes_it(spark):
    rows, odd = fold(spark, ("New", "a", D(2024, 2, 1), T(2024, 2, 2)), ("Deleted", None, D(2024, 1, 1), T(2024, 3, 2)))
    assert rows == [("a", D(2024, 2, 1), D(2024, 1, 1), T(2024, 2, 2), T(2024, 3, 2))] and not odd


def test_words_common_to_some_candidates_still_tell_them_apart(spark):
    c = spark.createDataFrame([(1, "RED PUMP", ["RED FAN PUMP", "BLUE PUMP"]), (1, "RED FAN PUMP", ["RED PUMP", "BLUE PUMP"]), (1, "BLUE PUMP", ["RED PUMP", "RED FAN PUMP"])], "s int, d string, o array<string>")
    best = naming.prefer(c, "s", naming.service_score(F.col("d"), F.col("o"), F.array(F.lit("the red one"))))
    assert {r["d"] for r in best.collect()} == {"RED PUMP", "RED FAN PUMP"}


def test_fold_goes_on_from_open_rows_and_as_of(spark):
    e = spark.createDataFrame([("K", "New", "a", D(2024, 1, 1), T(2024, 1, 2), "d0")], EVENT)
    prior, _ = history.apply_events(e, ["k"])
    e = spark.createDataFrame([("K", "Modified", "b", D(2024, 2, 1), T(2024, 2, 2), "d1")], EVENT)
    rows, _ = history.apply_events(e, ["k"], prior)
    at = lambda d: [r["attrs"] for r in history.current_truth(rows, valid=F.lit(d).cast("date")).collect()]
    assert (at("2024-01-31"), at("2024-02-01"), at("2023-12-31")) == (["a"], ["b"], [])
    assert [r["attrs"] for r in history.current_truth(rows).collect()] == ["b"]


def test_dates_of_six_formats(spark):
    df = spark.createDataFrame([(s,) for s in ("2024/03/03", "2024-03-03", "03MAR24", "03-Mar-24", "03/03/2024", "03MAR2024", "soon")], "d string")
    days = [r[0] for r in df.select(history.first_date(F.col("d"), history.DATE_FORMATS)).collect()]
    assert days[:6] == [D(2024, 3, 3)] * 6 and days[6] is None
    assert history.rejected_dates(df, "d").count() == 1


# ---- quality ----


def test_uncomposable_tags(spark):
    tags_ = [None, " ", "PG 1001", "PG-1001-", "PG-1001,", "PG/", "PG-12", "PG-1001"]
    df = spark.createDataFrame([(t,) for t in tags_], "t string")
    assert [r[0] for r in df.select(quality.uncomposable(F.col("t"))).collect()] == [True] * 7 + [False]


def test_invariant_writes_the_ledger_then_raises(spark, tmp_path):
    s = {"edges": quality.Subject(spark.createDataFrame([(1, True), (2, None)], "id int, derived boolean"), "id", "connection")}
    marks, _, skipped = quality.evaluate([quality.Expectation("no_flag", "edges", "null_flag", column="derived", gate="fail", severity="error"), quality.Expectation("x", "nowhere", "not_null", column="a")], s, {})
    assert skipped == ["x"]
    with pytest.raises(RuntimeError):
        quality.write_then_raise(marks, str(tmp_path / "ledger"))
    assert spark.read.parquet(str(tmp_path / "ledger")).count() == 1
    assert quality.gates(marks).count() == 0


def test_prefix_chain_is_containment_and_where_filters(spark):
    df = spark.createDataFrame([(1, "X-PG-1001", "PG-1001", "PG"), (2, "PG-1", "N-1", "N"), (3, None, "N", "N")], "id int, seg string, sub string, pns string")
    e = quality.Expectation("c", "t", "prefix_chain", columns=("seg", "sub", "pns"))
    assert [r["id"] for r in quality.violations(e, quality.Subject(df, "id", "s"), {}).collect()] == [2]
    assert quality.where(df, ("seg", "neq", "PG-1")).count() == 2 and quality.where(df, ("seg", "contains", "PG")).count() == 2


# ---- topology, graph ----


def test_components_match_plain_search(spark):
    import random

    r = random.Random(4)
    edges = [(r.randint(0, 300), r.randint(0, 300)) for _ in range(200)] + [(500, 500 + i) for i in range(1, 200)] + [(i, i + 1) for i in range(1000, 1100)] + [(7, 7)]
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    got = {x["node"]: x["component"] for x in graph.connected_components(spark.createDataFrame(edges, "src int, dst int")).collect()}
    assert got == {n: find(n) for n in up}
    assert graph.connected_components(spark.createDataFrame([], "src int, dst int")).count() == 0


def test_descendants_end_on_cycles(spark):
    e = spark.createDataFrame([("b", "a"), ("c", "b"), ("a", "c"), ("d", "x")], "child string, parent string")
    assert {tuple(r) for r in graph.descendants(e, spark.createDataFrame([("a",)], "r string")).collect()} == {("a", "a"), ("a", "b"), ("a", "c")}


def test_equipment_needs_tag_and_nozzle(spark):
    n = spark.createDataFrame([("h", "d", 1, "E1", None, "Equipment", {"t": "V"}), ("h", "d", 2, "N1", 1, "Nozzle", {}), ("h", "d", 3, "E2", None, "Equipment", {}), ("h", "d", 4, "N2", 3, "Nozzle", {}), ("h", "d", 5, "E3", None, "Equipment", {"t": "W"})], "content_hash string, document string, ord int, node_id string, parent_ord int, tag string, g map<string,string>")
    n = n.withColumns({"in_catalogue": F.lit(False), "ga": F.create_map(F.lit("ItemTag"), F.col("g").getItem("t")), "attrs": F.create_map().cast("map<string,string>")})
    assert [(r["tag"], r["nozzle_ids"]) for r in topology.wire_equipment(n).collect()] == [("V", ["N1"])]


def test_marks_go_down_the_tree(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 2), (4, 3), (5, None)], "n int, p int")
    marks = spark.createDataFrame([(1, "a"), (3, "c")], "n int, m string")
    assert {r["node"]: r["mark"] for r in topology.down_tree(tree, marks, "n", "p", "m").collect()} == {1: "a", 2: "a", 3: "c", 4: "c", 5: None}


# ---- rules: the plant of one supply, one consumer, one flare sink and one relief valve ----


def test_rule_scenario(spark):
    fluids = spark.createDataFrame([("PG", "Process", ""), ("N", "Utility", "Nitrogen"), ("SF", "Flare", ""), ("LS", "Utility", "Steam / Condensate")], "fluid_code string, category string, subcategory string")
    got = {r["fluid_code"]: r["fluid_class"] for r in rules.classify_fluids(spark.createDataFrame([("PG",), ("N",), ("SF",), ("LS",), ("??",)], "fluid_code string"), fluids).collect()}
    assert got == {"PG": "process", "N": "utility", "SF": "flare", "LS": "steam_condensate", "??": "utility"}
    edges = spark.createDataFrame([("N1", "C1"), ("C1", "F1"), ("C1", "RV1")], "src string, dst string")
    classes = spark.createDataFrame([("N1", "utility"), ("C1", "process"), ("F1", "flare"), ("RV1", "process")], "node string, fluid_class string")
    assert [tuple(r) for r in rules.flare_guard(edges, classes).collect()] == [("C1", "F1")]
    assert ("C1", "N1") in [tuple(r) for r in rules.supply_tie_in(edges).collect()]
    relief = rules.relief_attribution(edges, spark.createDataFrame([("RV1",)], "v string"))
    assert [tuple(r) for r in relief.collect()] == [("RV1", "C1", True)]
    both = edges.union(spark.createDataFrame([("F1", "C1")], edges.schema))
    assert rules.flare_guard(both, classes).count() == 0
    b = spark.createDataFrame([("CheckValve", "isolation"), ("GateValve", "isolation"), ("X", "other")], "component_class string, role string")
    comps = spark.createDataFrame([(1, "CheckValve"), (2, "GateValve"), (3, "X")], "id int, component_class string")
    assert [r["id"] for r in rules.boundary_forming(comps, b).collect()] == [2]


def test_publication_gate_and_provenance(spark):
    a = spark.createDataFrame([(1,), (2,)], "k int")
    assert rules.may_publish(rules.parity_pairs(a, a, ["k"]), "f", "f") and not rules.may_publish(rules.parity_pairs(a, a, ["k"]), "f", "g")
    assert not rules.may_publish(rules.parity_pairs(a, a.limit(1), ["k"]), "f", "f")
    assert rules.provenance(spark, "r1", {"masterdata": "f"}, {"flaresTo": "L5"}).count() == 3


# ---- facts ----


def test_quads_as_lines_and_back(spark, tmp_path):
    q = spark.createDataFrame([("masterdata", "urn:a", "p", 'say "hi"\n\\t\ttab é', "literal", None), ("masterdata", "urn:a", "p", "5", "literal", "integer"), ("oracle", "urn:a", "q", "urn:b", "iri", None)], "graph string, s string, p string, o string, o_kind string, o_datatype string")
    back = triples.from_lines(triples.to_lines(q, graphs=True))
    assert sorted(map(str, back.select(q.columns).collect())) == sorted(map(str, q.collect()))
    path = str(tmp_path / "quads")
    facts.write_graphs(q, path)
    facts.write_graphs(q.where("graph = 'oracle'").withColumn("o", F.lit("urn:c")), path)
    got = {(r["graph"], r["o"]) for r in spark.read.parquet(path).collect()}
    assert len(got) == 3 and ("oracle", "urn:c") in got and ("masterdata", "5") in got
    assert facts.ontology_skeleton(spark).where("p = 'rdf:type'").count() == 17


def test_catch_all_classes_are_unclassified(spark):
    df = spark.createDataFrame([(1, "CustomObject"), (2, None), (3, "GateValve"), (4, "MyCustomObject")], "id int, c string")
    q = facts.component_quads(df, "id", "c").where("p = 'rdf:type'")
    assert sorted(r["o"].split("/")[-1] for r in q.collect()) == ["GateValve", "MyCustomObject", "UnclassifiedComponent", "UnclassifiedComponent"]


# ---- tags, naming, sheets, tables ----


def test_decode_and_compose(spark):
    df = spark.createDataFrame([("PG-1415109",), ("PG1415109",), ("PG-14",), ("PG-14x5109",), (None,)], "t string")
    got = [r[0] for r in df.select(tags.decode(F.col("t"), F.lit("PG"))).collect()]
    assert [x and (x["unit"], x["sequence"]) for x in got] == [("14", "151"), ("14", "151"), None, None, None]
    g = [[Field("a", "<", ">")], [Field("b", required=True)], [Field("c"), Field("d")]]
    row = spark.range(1).select(tags.compose(g, {"a": F.lit("1"), "b": F.lit("2")}).alias("x"), tags.compose(g, {"a": F.lit("1")}).alias("y"), tags.compose(g, {"b": F.lit("2"), "c": F.lit("3"), "d": F.lit("4")}).alias("z")).first()
    assert tuple(row) == ("<1>-2", None, "2-34")


def test_lookup_problems_and_prefer(spark):
    table = spark.createDataFrame([("011", "A"), ("12", "B"), ("12", "C"), ("13", " ")], "code string, v string")
    rows = spark.createDataFrame([(1, "11"), (2, "0012"), (3, "13"), (4, "99")], "id int, code string")
    got = {r["id"]: (r["v"], r["problem"]) for r in naming.lookup(rows, table, [("code", "code")], "v", "id").collect()}
    assert got == {1: ("A", None), 2: (None, "several"), 3: (None, "blank"), 4: (None, "none")}
    c = spark.createDataFrame([(1, "FEED PUMP", "BOILER FEED"), (1, "BOILER FEED", "FEED PUMP"), (2, "X", "")], "s int, d string, o string")
    best = naming.prefer(c, "s", naming.service_score(F.col("d"), F.array("o"), F.array(F.lit("to boiler"), F.lit("feed"))))
    assert {(r["s"], r["d"]) for r in best.collect()} == {(1, "BOILER FEED"), (2, "X")}
    assert naming.convention_issues([{"Field": "f", "Source": "zzz"}, {"Field": "g", "Source": "lookup", "Table": "t", "Column": "c"}], {"lookup"}, {"t": ["a"]}) == ["f: unknown source zzz", "g: t has no column c"]


def test_sheets(spark):
    s = sheets.clean_sheet(spark.createDataFrame([(" a ", 9.0), ("NaN", None), ("b", 2.5)], "` Name ` string, X double"))
    assert [tuple(r) for r in s.collect()] == [("a", "9"), ("b", "2.5")]
    b = spark.createDataFrame([("GateValve", "Isolation", "yes"), ("Pump", "none such", "yes"), ("Trap", "trap", "no")], "c string, r string, f string")
    assert [tuple(r) for r in sheets.boundary_sets(b, "c", "r", "f").collect()] == [("GateValve", "isolation")]
    assert sheets.rejected_roles(b, "c", "r").count() == 1
    assert sheets.with_default(sheets.boundary_sets(b.limit(0), "c", "r")).count() == len(sheets.DEFAULT_BOUNDARY)


def test_tables(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string")
    write_snapshot(df.limit(1), at("s"), "one")
    write_snapshot(df, at("s"), "two")
    assert (read_as_of(spark, at("s"), 0).count(), read_as_of(spark, at("s")).count(), history_of(spark, at("s")).count()) == (1, 2, 2)
    write_table(df, at("t"), partitions=["p"], dynamic=True)
    write_table(df.where("id = 1").withColumn("id", F.lit(7)), at("t"), partitions=["p"], dynamic=True)
    assert sorted(r["id"] for r in spark.read.parquet(at("t")).collect()) == [2, 7]
    once = replace_slice(df, F.col("p") == "a", df.limit(0))
    assert replace_slice(once, F.col("p") == "a", df.limit(0)).count() == once.count() == 1
    write_lists(df, at("c"), "csv")
    assert spark.read.csv(at("c"), header=True).count() == 2
    spark.sql("DROP TABLE IF EXISTS scenario_t")
    create_table(spark, "scenario_t", "id int, p string", ["p"])
    assert spark.table("scenario_t").columns == ["id", "p"]
    spark.sql("DROP TABLE scenario_t")


def test_project_codes_and_gates(spark):
    df = spark.createDataFrame([("216097C-A22", b"abc"), ("-x", b"a"), (None, None)], "n string, c binary")
    got = df.select(landing.project_code(F.col("n")).alias("p"), landing.size_gated_text(F.col("c"), F.length("c"), 2).alias("t")).collect()
    assert [tuple(r) for r in got] == [("216097C", None), (None, "a"), (None, None)]
    with pytest.raises(ValueError):
        from drawloom.functions.text import content_hash

        content_hash(F.lit("a"), 100)


def test_fold_streams_a_long_history_across_batches(spark):
    n = 25000  # more than two Arrow batches
    e = spark.range(n).select(F.lit("hot").alias("k"), F.lit("Modified").alias("change_type"), (F.col("id") % 2).cast("string").alias("attrs"), F.date_add(F.lit(D(2024, 1, 1)), F.col("id").cast("int")).alias("valid_from"), F.timestamp_seconds(F.col("id")).alias("tx"), F.col("id").cast("string").alias("delta_id"))
    r, odd = history.apply_events(e, ["k"])
    w = Window.partitionBy("k").orderBy("valid_from")
    chained = r.withColumn("next", F.lead("valid_from").over(w)).agg(F.count("*"), F.count_if(F.col("valid_to").eqNullSafe(F.col("next"))), F.count_if("current")).first()
    assert tuple(chained) == (n, n, 1) and odd.count() == 0


def test_fold_goes_on_from_prior_rows_of_anchors_with_events(spark):
    prior = spark.createDataFrame([
        ("K", "a", D(2024, 1, 1), None, T(2024, 1, 1), None, None), ("K", "b", D(2024, 1, 5), None, T(2024, 1, 5), None, None), ("quiet", "c", D(2024, 1, 1), None, T(2024, 1, 1), None, None), (None, "d", D(2024, 1, 1), None, T(2024, 1, 1), None, None),
    ], "k string, attrs string, valid_from date, valid_to date, tx_from timestamp, tx_to timestamp, superseded_by_delta string")
    e = spark.createDataFrame([("K", "Modified", "e", D(2024, 2, 1), T(2024, 2, 2), "d1"), (None, "New", "f", D(2024, 2, 1), None, "d2"), ("L", None, None, None, T(2024, 2, 2), None)], EVENT)
    r, odd = history.apply_events(e, ["k"], prior)
    got = sorted(((x["k"], x["attrs"], x["valid_from"], x["valid_to"], x["superseded_by_delta"]) for x in r.collect()), key=repr)
    assert got == sorted([("K", "a", D(2024, 1, 1), None, None), ("K", "b", D(2024, 1, 5), D(2024, 2, 1), "d1"), ("K", "e", D(2024, 2, 1), None, None), (None, "f", D(2024, 2, 1), None, None), ("L", None, None, None, None)], key=repr)
    assert odd.count() == 0
    assert [x.count() for x in history.apply_events(e.limit(0), ["k"], prior)] == [0, 0]


def test_gaps_are_ranked_across_ranges(spark):
    used = spark.range(3000).select(F.explode(F.sequence(F.lit(0), F.col("id") % 7)).alias("x"), F.concat(F.lit("c"), F.col("id")).alias("code"))
    got = naming.gap_ranking(used, used.where("code = 'c6'"), "code", F.col("code").endswith("3"))
    want = sorted({(not c.endswith("3"), -(i % 7 + 1), c) for i in range(3000) if (c := f"c{i}") != "c6"})
    assert [x["code"] for x in got.orderBy("rank").collect()] == [c for _, _, c in want]
    assert [x["rank"] for x in got.select("rank").orderBy("rank").collect()] == list(range(1, 3000))
    assert naming.gap_ranking(used.limit(0), used, "code").count() == 0


def test_select_goes_by_stage(spark):
    table = spark.createDataFrame([("01", "U1", "A,B", "x"), ("1", "U2", "b;c", "y"), ("2", "U3", "", "x"), ("3", "U4", None, "x"), ("3", "U5", "Z", "y")], "k string, v string, l string, side string")
    rows = spark.createDataFrame([(1, "1", "s", "a", None), (2, "1", "s", "b", None), (3, "1", "s", "b", "Y"), (4, "2", "s", "q", None), (5, "3", "s", "q", None), (6, "9", "s", "a", None), (7, "1", "other", "a", None), (8, None, "s", "a", None), (9, "1", "s", None, None)], "i int, k string, scope string, want string, side string")
    scope = spark.createDataFrame([("s", "1"), ("s", "2"), ("s", "3"), ("s", "1")], "scope string, k string")
    got = {x["i"]: (x["v"], x["problem"], x["candidates"]) for x in naming.select(rows, "i", table, [("k", "k")], "v", "v", ("scope", scope, "scope", "k"), ("want", "l"), [("side", "side")]).collect()}
    assert got == {
        1: ("U1", None, []), 2: (None, "several", ["U1", "U2"]), 3: ("U2", None, []), 4: ("U3", None, []), 5: (None, "unlisted", ["U4", "U5"]),
        6: (None, "none", []), 7: (None, "scope", []), 8: (None, "none", []), 9: (None, "unlisted", ["U1", "U2"]),
    }
    one = naming.select(rows.where("i = 4"), "i", table, [("k", "k")], "v", "v").first()
    assert (one["v"], one["problem"]) == ("U3", None)
    assert naming.select(rows, "i", table.limit(0), [("k", "k")], "v", "v").where("problem = 'none'").count() == 9


def test_checks_find_what_is_wrong(spark):
    from drawloom.operators import checks

    q = lambda *x: spark.createDataFrame([(g, s, p, o, "iri", None) for g, s, p, o in x], "graph string, s string, p string, o string, o_kind string, o_datatype string")
    c = "urn:plant:class/"
    bad = q(("masterdata", "a", "rdf:type", c + "OffPageConnector"), ("masterdata", "a", "opcType", "Utility Connector"), ("masterdata", "a", "flowSense", "SignalOffPageConnector"), ("masterdata", "a", "terminates", "seg"), ("masterdata", "v", "rdf:type", c + "Component"), ("results", "sys", "hasFunction", "v"), ("masterdata", "f", "rdf:type", c + "Fluid"))
    assert [x["opc"] for x in checks.wrongly_terminating(bad).collect()] == ["a"]
    assert [tuple(x) for x in checks.direct_members(bad, ["Component", "Equipment"]).collect()] == [("sys", "v")]
    assert [tuple(x) for x in checks.misplaced(bad, "Fluid", "refdata").collect()] == [("masterdata", 1)]
    none = bad.limit(0)
    assert checks.wrongly_terminating(none).count() == checks.walk_across(none).count() == checks.connector_coverage(none).count() == 0
    assert tuple(checks.completeness(none, "Fluid", ["tag"]).first()) == (0, 0)


def test_a_utility_connector_on_a_pipe_ends_on_its_segment(spark):
    rows = spark.createDataFrame([(1, "t", "Utility Connector", "FlowOutPipeOffPageConnector", True, None, "S"), (2, "t", "Piping", "SignalOffPageConnector", True, None, "S"), (3, "t", "Instrument OPC", None, True, None, "S"), (4, "t", None, None, True, None, "S"), (5, "t", "Piping", None, True, None, None)], "eid int, opctag string, opc_type string, flow_direction string, matched boolean, to_from struct<text: string>, on_segment string")
    on = facts.match(facts.opc_quads(rows), p="terminates")
    assert sorted((x["s"], x["o"]) for x in on.collect()) == [("urn:plant:opc/1", "urn:plant:segment/S"), ("urn:plant:opc/4", "urn:plant:segment/S")]
    assert facts.match(facts.opc_quads(rows.drop("flow_direction")), p="terminates").count() == 3
