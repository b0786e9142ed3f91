import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from drawloom.operators import composition, history, stitch, systems, topology

HISTORY = "anchor string, attrs string, valid_from date, valid_to date, tx_from timestamp, tx_to timestamp"
DAY, TX = dt.date(2024, 1, 1), dt.datetime(2024, 2, 1)


def gold(spark, rows):
    """(anchor, attributes[, valid_from, valid_to, tx_from, tx_to]) as history rows."""
    full = [(a, x if isinstance(x, str) or x is None else json.dumps(x), *(more or (DAY, None, TX, None))) for a, x, *more in rows]
    return spark.createDataFrame(full, HISTORY)


def dataset(spark, kinds, by_uri=(), by_label=(), **at):
    fluids = spark.createDataFrame([("SF", "Flare", "")], "fluid_code string, category string, subcategory string")
    boundary = spark.createDataFrame([("GateValve", "isolation")], "component_class string, role string")
    uris = spark.createDataFrame(list(by_uri), "key string, target string, match_type string")
    labels = spark.createDataFrame(list(by_label), "key string, target string")
    quads, bad = composition.build_dataset({k: gold(spark, v) for k, v in kinds.items()}, fluids, boundary, uris, labels, **at)
    return {(r["graph"], r["s"].split("/", 1)[-1] if r["s"].startswith("urn:plant:") else r["s"], r["p"], r["o"]) for r in quads.collect()}, {tuple(r) for r in bad.collect()}


def says(facts, s, p):
    return {o for _, x, q, o in facts if x == s and q == p}


def test_equipment_class_comes_from_the_latest_skipped_duplicate(spark):
    later = (DAY + dt.timedelta(1), None, TX, None)
    facts, bad = dataset(spark, {
        "component": [("c1", {"tag": "V-1", "kind": "Equipment", "component_class": "HeatExchangers"}), ("c2", {"tag": "V-1", "kind": "Equipment", "component_class": "VerticalDrums"}, *later), ("c3", {"tag": "V-2", "kind": "Equipment"}), ("c4", {"tag": "V-1", "component_class": "BallValve"})],
        "equipment": [("e1", {"tag": "V-1", "nozzle_ids": ["n1"]}), ("e2", {"tag": "V-2"}), ("e3", {"tag": "V-1", "equipment_class": "Own"})],
    })
    assert bad == {("component", c, "equipment_duplicate") for c in ("c1", "c2", "c3")}
    assert (says(facts, "e1", "equipmentClass"), says(facts, "e2", "equipmentClass"), says(facts, "e3", "equipmentClass")) == ({"VerticalDrums"}, set(), {"Own"})
    assert says(facts, "VerticalDrums", "rdfs:subClassOf") == {"urn:plant:class/Equipment"} and says(facts, "n1", "partOf") == {"urn:plant:equipment/e1"}
    assert not [f for f in facts if f[1] in ("c1", "c2", "c3")] and says(facts, "c4", "rdf:type") == {"urn:plant:class/BallValve"}


def test_classes_resolve_by_uri_before_label_and_wait_otherwise(spark):
    rows = [("a", {"component_class": "GateValve", "component_class_uri": "u1"}), ("b", {"component_class": "GateValve"}), ("c", {"component_class": "Pump"}), ("d", {"component_class": "CustomObject"}), ("e", {})]
    facts, _ = dataset(spark, {"component": rows}, [("u1", "plm:x", "exact")], [("GateValve", "plm:y")])
    assert says(facts, "GateValve", "rdlMatch") == {"plm:x", "plm:y"} and says(facts, "GateValve", "rdlMatchType") == {"exact", "label"} and says(facts, "GateValve", "pendingReview") == {"true"}
    assert says(facts, "Pump", "rdlPending") == {"true"} and not says(facts, "CustomObject", "rdlPending")
    assert says(facts, "d", "rdf:type") == says(facts, "e", "rdf:type") == {"urn:plant:class/UnclassifiedComponent"} and not says(facts, "d", "componentClass")


def test_lines_with_and_without_pieces_and_the_answer_key(spark):
    piece = {"segment_id": "s1", "fluid": "SF", "process_unit": "14", "start_up_package": "P1"}
    facts, bad = dataset(spark, {"line": [("l1", {"fluid": ["SF", "CV"], "piece_count": 1, "inconsistent": True, "pieces": [piece]}), ("l2", {"fluid": ["SF"]}), ("l3", {"pieces": []})]})
    assert bad == {("line", "l2", "line_without_pieces"), ("line", "l3", "line_without_pieces")}
    assert says(facts, "l1", "fluid") == {"SF", "CV"} and says(facts, "l2", "rdf:type") == {"urn:plant:class/PipingLine"}
    assert says(facts, "s1", "partOf") == {"urn:plant:line/l1"} and says(facts, "s1", "validFrom") == {"2024-01-01"}
    assert {g for g, _, p, _ in facts if p in composition.ANSWER_KEY} == {"oracle"}


def test_one_pair_of_times_for_all_kinds(spark):
    d2, t2 = dt.date(2024, 3, 1), dt.datetime(2024, 4, 1)
    kinds = {
        "component": [("c", {"tag": "old"}, DAY, d2, TX, None), ("c", {"tag": "new"}, d2, None, t2, None)],
        "connector": [("o", {"opctag": "wrong", "opc_type": "Piping", "on_segment": "s"}, DAY, None, TX, t2), ("o", {"opctag": "right", "opc_type": "Instrument", "on_segment": "s"}, DAY, None, t2, None)],
    }
    tags = lambda **at: {o for _, _, p, o in dataset(spark, kinds, **at)[0] if p == "tag"}
    day, time = (lambda x: F.lit(x)), (lambda x: F.lit(str(x)).cast("timestamp"))
    assert tags() == {"new", "right"}
    assert tags(valid=day(dt.date(2024, 2, 1)), tx=time(dt.datetime(2024, 3, 1))) == {"old", "wrong"}
    assert tags(valid=day(dt.date(2024, 2, 1)), tx=time(dt.datetime(2024, 5, 1))) == {"old", "right"}
    facts, _ = dataset(spark, kinds, valid=day(dt.date(2024, 2, 1)))
    assert says(facts, "o", "txTo") == {"2024-04-01 00:00:00"} and says(facts, "o", "terminates") == {"urn:plant:segment/s"}


def test_connections_and_rows_that_are_not_mapped(spark):
    facts, bad = dataset(spark, {
        "connection": [("k1", {"from_id": "a", "to_id": "b", "conn_type": "Piping", "derived": False, "flow_sense": "reverse"}), ("k2", {"from_id": "x", "to_id": "y", "conn_type": "OffPage", "derived": True}), ("k3", {"from_id": "a", "to_id": "b"})],
        "component": [(None, {"tag": "t"}), ("bad", "not json"), ("none", None)],
    })
    assert bad == {("connection", "k3", "derived_not_told"), ("component", None, "no_identity"), ("component", "bad", "attrs_unreadable")}
    assert ("masterdata", "b", "flowsTo", "urn:plant:component/a") in facts and not says(facts, "a", "flowsTo")
    assert says(facts, "x", "connectedTo") == {"urn:plant:opc/y"} and says(facts, "k2", "flowSense") == {"none"} and not says(facts, "k3", "from")
    assert says(facts, "none", "rdf:type") == {"urn:plant:class/UnclassifiedComponent"}


def test_answer_key_outside_its_graph_is_an_error(spark):
    q = spark.createDataFrame([("masterdata", "s", "process_unit")], "graph string, s string, p string")
    with pytest.raises(Exception, match="answer key outside its graph: process_unit of s"):
        composition.confined(q, ["process_unit"]).collect()
    assert composition.confined(q, ["other"]).count() == 1


def test_empty_histories(spark):
    facts, bad = dataset(spark, dict.fromkeys(("component", "equipment", "connection", "connector", "line"), []))
    assert bad == set() and {g for g, *_ in facts} == {"masterdata", "refdata"}


def test_as_of_both_axes_equals_comparing_all(spark):
    r = random.Random(4)
    day = lambda: dt.date(1969, 6, 1) + dt.timedelta(r.randrange(1200))
    time = lambda: dt.datetime(2024, 1, 1) + dt.timedelta(hours=r.randrange(400))
    maybe = lambda f, p=0.2: None if r.random() < p else f()
    rows = [(r.choice([1, 1, 1, 2, 3, None]), f"a{i}", maybe(day, 0.05), maybe(day), maybe(time, 0.05), maybe(time)) for i in range(300)]
    asked = [(i, r.choice([1, 1, 2, 4, None]), maybe(day, 0.05), maybe(time, 0.05)) for i in range(200)] + [(999, 1, dt.date(9999, 12, 31), dt.datetime(2024, 6, 1))]
    h = spark.createDataFrame(rows, "k long, attrs string, valid_from date, valid_to date, tx_from timestamp, tx_to timestamp")
    got = history.as_of_both(spark.createDataFrame(asked, "i long, k long, v date, t timestamp"), h, "k", "v", "t").select("i", "as_of_attrs").collect()
    want = []
    for i, k, v, t in asked:
        hits = [a for x, a, b, c, d, e in rows if None not in (k, v, t, x, b, d) and k == x and b <= v and (c is None or v < c) and d <= t and (e is None or t < e)]
        want += [(i, a) for a in hits or [None]]
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr) and len(got) > 400


def test_slabs_hold_each_day_once(spark):
    r = random.Random(1)
    for a, z in [(0, 1), (5, 5), (9, 3), (-20, 700), (0, 1 << 22), (19_000, 1 << 22)] + [(x := r.randrange(-500, 3000), x + r.randrange(900)) for _ in range(20)]:
        s = spark.range(1).select(F.explode(history._slabs_of(F.lit(a).cast("long"), F.lit(z).cast("long"))).alias("s")).select("s.*").collect()
        held = sorted((x["slab"] << x["width"], (x["slab"] + 1) << x["width"]) for x in s)
        assert len(held) < 100 and sum(y - x for x, y in held) == max(0, z - a)
        assert not held or (held[0][0], held[-1][1]) == (a, z) and all(p[1] == q[0] for p, q in zip(held, held[1:]))


def greedy(rows):
    bare = lambda g: g.removeprefix("SP") if g else g
    taken, out = set(), []
    for x, _, mate in sorted(rows):
        if x in taken or not mate:
            continue
        for y, mine, _ in sorted(rows):
            if y != x and y not in taken and mine and bare(mine) == bare(mate):
                taken |= {x, y}
                out.append((min(x, y), max(x, y)))
                break
    return sorted(out)


@pytest.mark.parametrize(("most", "n"), [(500_000, 150), (8, 40), (1, 16)])
def test_guid_pairs_equal_the_greedy_loop(spark, most, n):
    r = random.Random(n)
    rows = [(i, f"g{r.randrange(n)}" if r.random() < 0.9 else None, r.choice(["", "SP"]) + f"g{r.randrange(n)}" if r.random() < 0.9 else None) for i in range(n)]
    df = spark.createDataFrame(rows, "eid long, guid_self string, guid_mate string")
    got = stitch.match_by_guid(df, most=most)
    assert sorted((x["a"], x["b"]) for x in got.collect()) == greedy(rows)


def test_guid_pairs_along_a_chain_and_of_one_key(spark):
    n = 10_000
    chain = spark.range(n).selectExpr("id AS eid", "concat('g', id) AS guid_self", f"CASE WHEN id < {n - 1} THEN concat('SPg', id + 1) END AS guid_mate")
    got = sorted((x["a"], x["b"]) for x in stitch.match_by_guid(chain).collect())
    assert got == [(i, i + 1) for i in range(0, n, 2)]
    one = spark.range(3000).selectExpr("id AS eid", "CASE WHEN id % 3 = 0 THEN 'k' END AS guid_self", "CASE WHEN id % 3 = 1 THEN 'k' END AS guid_mate")
    assert sorted((x["a"], x["b"]) for x in stitch.match_by_guid(one).collect()) == [(3 * i, 3 * i + 1) for i in range(1000)]
    assert stitch.match_by_guid(one.limit(0)).count() == 0


def test_marks_reach_down_any_depth(spark):
    rows = [(i, i - 1 if i % 300 else None) for i in range(900)] + [(1000, 1001), (1001, 1000), (1002, 77_777), (None, 3), (1003, 1003)]
    marks = [(0, "a"), (250, "b"), (250, "c"), (600, "d"), (650, None)]
    got = {r["node"]: r["mark"] for r in topology.down_tree(spark.createDataFrame(rows, "n long, p long"), spark.createDataFrame(marks, "n long, m string"), "n", "p", "m").collect()}
    assert got == {i: "a" if i < 250 else "b" if i < 300 else "d" if i >= 600 else None for i in range(900)} | dict.fromkeys((1000, 1001, 1002, 1003))


def run_systems(spark, parts, edges, gear=()):
    nodes = [(*p, None) for p in parts] + [(n, None, None, "equipment", tag) for n, tag in gear]
    n = spark.createDataFrame(nodes, "node long, fluid string, fluid_class string, role string, tag string")
    out, guards = systems.trace_systems(n, spark.createDataFrame(edges, "src long, dst long, flow_sense string"))
    return {r["node"]: (r["system"], r["rule"], r["hops"]) for r in out.collect()}, {(r["fragment"], r["neighbour"], r["guard"]) for r in guards.collect()}


def chain(n, flow="none"):
    """n pieces of one part each, with a boundary between neighbours: parts 0, 2, 4, ..., boundaries 1, 3, ..."""
    parts = [(2 * i, f"F{i}", "process", "inner") for i in range(n)] + [(2 * i + 1, None, None, "boundary") for i in range(n - 1)]
    return parts, [(i, i + 1, flow) for i in range(2 * n - 2)]


def test_ten_pieces_reach_their_consumer(spark):
    parts, edges = chain(10)
    got, guards = run_systems(spark, parts, [*edges, (100, 18, None)], [(100, "V1")])
    assert [got[2 * i] for i in range(10)] == [("process:V1", "junction", 9 - i) for i in range(9)] + [("process:V1", "equipment", 0)] and not guards
    assert 1 not in got and got[100] == ("process:V1", "equipment", 0)


def test_nearest_consumer_then_least_and_same_fluid_stops(spark):
    parts, edges = chain(5)
    got, _ = run_systems(spark, parts, [*edges, (100, 0, "none"), (101, 8, "none")], [(100, "V2"), (101, "V1")])
    assert [got[2 * i][0] for i in range(5)] == ["process:V2", "process:V2", "process:V1", "process:V1", "process:V1"]
    same = [(n, "F" if f else f, c, r) for n, f, c, r in parts]
    got, _ = run_systems(spark, same, [*edges, (100, 0, "none")], [(100, "V2")])
    assert got[2] == ("pending:F", "pending", None)


def test_guards_and_relief(spark):
    # flow runs from the piece with equipment into the next one: a supply, no consumer; the other way round it is one
    parts, edges = chain(2, "forward")
    got, guards = run_systems(spark, parts, [*edges, (100, 0, "none")], [(100, "V")])
    assert got[2] == ("pending:F1", "pending", None) and (2, 0, "supply") in guards
    got, guards = run_systems(spark, *(lambda p, e: (p, [*e, (100, 0, "none")]))(*chain(2, "reverse")), [(100, "V")])
    assert got[2] == ("process:V", "junction", 1) and (2, 0, "supply") not in guards
    # a flare is no consumer of what flows into it, but may be one where the direction is unknown
    flare = lambda flow: ([(0, "P", "process", "inner"), (1, None, None, "relief"), (2, "SF", "flare", "inner")], [(0, 1, flow), (1, 2, flow)])
    got, guards = run_systems(spark, *flare("forward"))
    assert got[0] == ("pending:P", "pending", None) and guards == {(0, 2, "flare")} and got[2] == ("utility:SF", "own", 0)
    assert got[1] == ("pending:P", "relief", 0)
    got, guards = run_systems(spark, *flare("none"))
    assert got[0] == ("utility:SF", "junction", 1) and not guards and 1 not in got


def test_a_boundary_of_many_neighbours(spark):
    n = 400
    parts = [(i, f"F{i % 3}", "process", "inner") for i in range(n)] + [(-1, None, None, "boundary")]
    got, _ = run_systems(spark, parts, [(i, -1, "none") for i in range(n)] + [(1000, 0, "none")], [(1000, "V")])
    # those of the fluid of the piece at the equipment are served over one of another fluid, two boundaries' steps away
    assert {got[i] for i in range(n) if i % 3} == {("process:V", "junction", 1)} and {got[i] for i in range(3, n, 3)} == {("process:V", "junction", 2)}
