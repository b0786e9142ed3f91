"""What showed only on larger tables than the given ones, on few rows that have it."""

import os
import random

import pyarrow as pa
import pyarrow.parquet as pq

from drawloom import catalog
from drawloom.operators import naming, rules, topology
from drawloom.sources import xml
from tests.oracle import TABLES, same
from tests.test_scenarios import edits

D = "/root/testdata/sf0.001"


def tables(at, **changed):
    """The given tables, some with other rows: a folder."""
    for t in TABLES:
        if t in changed:
            pq.write_table(pa.Table.from_pylist(changed[t], pq.read_schema(f"{D}/{t}.parquet").remove_metadata()), f"{at}/{t}.parquet")
        else:
            os.symlink(f"{D}/{t}.parquet", f"{at}/{t}.parquet")
    return str(at)


def test_no_part_has_the_id_of_a_supplier(spark, tmp_path):
    part = [{"p_partkey": k, "p_brand": f"Brand#{i}"} for i, k in enumerate([5, 1_000_005, 1_000_007])]
    supplier = [{"s_suppkey": 5}, {"s_suppkey": 7}]
    line = [{"l_partkey": p, "l_suppkey": s} for p, s in [(5, 5), (1_000_005, 5), (1_000_005, 7), (1_000_007, 5)]]
    d = tables(tmp_path, part=part, supplier=supplier, lineitem=line)
    out = catalog.QUERIES["c03_enrich_neighbours"](spark, d)
    assert same(out, catalog.ORACLES["c03_enrich_neighbours"], d) == 5
    assert sorted((r["anchor"], r["neighbours"], r["n_out"]) for r in out.collect()) == [
        ("Brand#0", "supplier", 1), ("Brand#1", "supplier,supplier", 2), ("Brand#2", "supplier", 1), ("supplier", "Brand#0,Brand#1,Brand#2", 0), ("supplier", "Brand#1", 0),
    ]


def unmapped_lengths(ids):
    """Two versions of each component that say the same, at lengths whose remainder by 3 is 1 and 2; the second is known too late."""
    return [{"conv_id": i, "turn": turn, "role": "user", "text": "x" * n} for i in ids for turn, n in ((1, 1), (3, 101))]


def test_versions_that_say_the_same_are_one_in_facts(spark, tmp_path):
    d = tables(tmp_path, conversations=unmapped_lengths([25]))
    out = catalog.QUERIES["p11_facts_of_history"](spark, d)
    assert same(out, catalog.ORACLES["p11_facts_of_history"], d) > 5
    assert out.where("s = 'urn:plant:component/25' and p = 'validTo'").count() == 0


def test_versions_that_say_the_same_are_one_in_rejects(spark, tmp_path):
    d = tables(tmp_path, conversations=unmapped_lengths([15]))
    out = catalog.QUERIES["p11_rejects"](spark, d)
    assert same(out, catalog.ORACLES["p11_rejects"], d) == 1
    assert [tuple(r) for r in out.select("kind", "anchor", "reason").collect()] == [("component", "15", "equipment_duplicate")]


def test_rejects_of_turns_with_one_number_and_without_text(spark, tmp_path):
    r = random.Random(5)
    one = lambda i: {"conv_id": r.choice([i, i, i, i, None]), "turn": r.choice([0, 1, 1, 2, 3, None]), "role": r.choice(["user", "assistant", None]), "text": r.choice([None, *("x" * r.randint(0, 130) for _ in range(5))])}
    d = tables(tmp_path, conversations=[one(i) for i in range(600) for _ in range(r.randint(1, 4))])
    out = catalog.QUERIES["p11_rejects"](spark, d)
    assert same(out, catalog.ORACLES["p11_rejects"], d) > 50
    # what is no length has neither a known origin nor pieces
    (tmp_path / "empty").mkdir()
    d = tables(tmp_path / "empty", conversations=[{"conv_id": i, "turn": 0, "role": "user", "text": None} for i in (2, 4)])
    out = catalog.QUERIES["p11_rejects"](spark, d)
    assert same(out, catalog.ORACLES["p11_rejects"], d) == 2


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_isolation_sets_are_not_broadcast(spark):
    assert "Broadcast" not in plan_of(catalog.QUERIES["r08_isolation_sets"](spark, D))[1]


def test_systems_are_not_broadcast(spark):
    assert "Broadcast" not in plan_of(catalog.QUERIES["g07_partition_systems"](spark, D))[1]


def test_decoding_works_a_tag_out_once(spark):
    # at most once in the filter and once for each of the columns that are taken from it
    assert plan_of(catalog.QUERIES["r10_decode_more"](spark, D))[0].lower().count("instr(") <= 5


def test_small_drawings_need_no_rounds_of_joins(spark, monkeypatch):
    rows = [("d1", 1, 2), ("d1", 2, 3), ("d1", 5, 5), ("d1", 6, 7), ("d1", 7, 3), ("d2", 1, 9), ("d2", 4, 1), ("d3", 2, 8), ("d3", 4, 6), ("d3", 6, 8), ("d3", 3, None)]
    edges = spark.createDataFrame(rows, "content_hash string, from_id long, to_id long")
    parts = spark.createDataFrame([("d1", 1, "GateValve"), ("d2", 1, "GateValve"), ("d3", 2, "x"), ("d4", 11, "x")], "content_hash string, component_id long, component_class string")
    given, real = [], topology.connected_components
    monkeypatch.setattr(topology, "connected_components", lambda e, *a: (given.append(e.count()), real(e, *a))[1])
    stats = lambda **x: sorted(tuple(r) for r in topology.drawing_stats(parts, edges, **x).select("content_hash", "n_components", "n_valves_linked", "n_edges", "n_nodes", "n_parts").collect())
    assert stats() == [("d1", 1, 1, 5, 6, 2), ("d2", 1, 1, 2, 3, 1), ("d3", 1, 0, 4, 4, 1), ("d4", 1, 0, 0, 0, 0)]
    assert given == [0]
    assert stats(small=4) == stats(small=0) == stats() and given[1:3] == [5, 10]


def test_facts_are_dealt_out_before_they_become_a_set(spark):
    plan = plan_of(catalog.QUERIES["p13_merge_graphs"](spark, D))[0]
    assert "RepartitionByExpression" in plan


def test_derived_facts_become_a_set_before_they_become_texts(spark):
    ids = spark.createDataFrame([(1, 2), (1, 2), (3, None)], "node long, neighbour long")
    relief = spark.createDataFrame([(1, 2), (1, 2)], "valve long, protects long")
    fluids = spark.createDataFrame([("a", "b"), ("a", "b")], "fluid_code string, fluid_class string")
    out = rules.materialise(fluids, ids, ids, relief)
    assert out.count() == 4
    assert not [x for x in plan_of(out)[0].splitlines() if "Aggregate" in x and "graph#" in x]


def test_payloads_go_to_python_once_and_as_arrow(spark):
    good, bad, worse = b'<a ID="1" k="v"><P ID="2"/></a>', b'<a ID="1">&#1;</a>', b"<a"
    files = spark.createDataFrame([("good", good), ("bad", bad), ("worse", worse), ("none", None)], "path string, content binary")
    out = xml.shred(files)
    assert "MapInArrow" in plan_of(out)[1] and "MapInPandas" not in plan_of(out)[1]
    got = sorted((r["document"], r["ord"], r["node_id"], r["attrs"], r["error"] is None) for r in out.collect())
    assert got == [("bad", 0, "1", {"ID": "1"}, True), ("good", 0, "1", {"ID": "1", "k": "v"}, True), ("good", 1, "2", {"ID": "2"}, True), ("none", -1, None, None, False), ("worse", -1, None, None, False)]


def most_similar(labels, reference, least):
    alike = lambda a, b: round(1 - edits(a, b) / max(len(a), len(b)), 6)
    best = {a: min((-alike(a, b), b) for b in reference if a or b) for a in labels}
    return {a: (b, -x) for a, (x, b) in best.items() if -x >= least}


def random_labels(r, n, letters, longest):
    return sorted({"".join(r.choice(letters) for _ in range(r.randint(1, longest))) for _ in range(n)})


def test_labels_of_low_similarity_meet_each_reference_label_once(spark, monkeypatch):
    r = random.Random(11)
    labels, reference = random_labels(r, 60, "abcdef", 12) + ["x" * 40], random_labels(r, 30, "abcdef", 9)
    asked, real = [], naming._segments
    monkeypatch.setattr(naming, "_segments", lambda b, lengths, least: (asked.append(least), real(b, lengths, least))[1])
    frame = lambda words: spark.createDataFrame([(w,) for w in words], "w string")
    out = naming.fuzzy_candidates(frame(labels), "w", frame(reference), "w", 0.5, 4)
    assert {x["label"]: (x["suggested"], x["similarity"]) for x in out.collect()} == most_similar(labels, reference, 0.5)
    # parts of labels are looked up only where they are long enough to tell labels apart
    assert asked == [0.85]


def test_edits_of_long_labels_in_little_memory(monkeypatch):
    r = random.Random(12)
    for cells in (1, 60, 1_000_000):
        monkeypatch.setattr(naming, "_CELLS", cells)
        for size in (0, 1, 9, 130):
            labels, reference = sorted({"".join(r.choice("aé漢😀") for _ in range(size)) for _ in range(5)}), ["", *random_labels(r, 12, "aé漢😀z", 20)]
            which, best = naming._best_edits(labels, size, reference)
            want = most_similar(labels, reference, 0)
            assert {a: (reference[k], x) for a, k, x in zip(labels, which.tolist(), best.tolist())} == want


def test_similarities_are_rounded_as_spark_does(spark):
    pairs = [(d, m) for m in (1, 3, 7, 64, 128, 320, 640) for d in range(m + 1)]
    got = spark.createDataFrame(pairs, "d int, m int").selectExpr("d", "m", "round(1 - d / m, 6) AS x").collect()
    assert all(naming._similarities(g["m"])[g["d"]] == g["x"] for g in got)
