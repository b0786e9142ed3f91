import random
import re

import pytest
from pyspark.sql import functions as F

from drawloom.operators import conventions as C
from drawloom.operators import quality


def layouts(spark, rows):
    return C.load(spark.createDataFrame(rows, C.CONVENTION))


@pytest.mark.parametrize(("rows", "template", "tag", "fields"), [
    (C.PACKED, "item", "LS362920131", {"fluid": "LS", "system": "36", "unit": "29", "sequence": "20131"}),
    (C.PACKED, "segment", 'AG362090006-44"(1C6AS)-S(45)(40)', {"fluid": "AG", "system": "36", "unit": "20", "sequence": "90006", "diameter": '44"', "piping_class": "1C6AS", "insul_type": "S", "insul_purpose": "45", "insul_thick": "40"}),
    (C.PACKED, "segment", 'AG3620-1"', None),
    (C.PACKED, "segment", 'AG36200-1"', {"fluid": "AG", "system": "36", "unit": "20", "sequence": "0", "diameter": '1"'}),
    (C.DASHED, "item", "PG-1415109", {"fluid": "PG", "unit": "14", "sequence": "151", "subline": "09"}),
    (C.DASHED, "segment", '36"-PG-1415109-D341H-H', {"diameter": '36"', "fluid": "PG", "unit": "14", "sequence": "151", "subline": "09", "piping_class": "D341H", "insul_purpose": "H"}),
    (C.DASHED, "segment", "PG-14151-H", {"fluid": "PG", "unit": "14", "sequence": "151", "insul_purpose": "H"}),
    (C.DASHED, "segment", "PG-14151-D341H", {"fluid": "PG", "unit": "14", "sequence": "151", "piping_class": "D341H"}),
    (C.DASHED, "segment", "PG-1415x", None), (C.DASHED, "segment", "PG--14151", None), (C.DASHED, "item", "", None), (C.DASHED, "item", None, None),
])
def test_known_tags_there_and_back(spark, rows, template, tag, fields):
    layout = layouts(spark, rows)[template]
    x = spark.createDataFrame([(tag,)], "tag string").select("tag", C.decode_tag(layout, F.col("tag")).alias("x"))
    got = x.first()["x"]
    assert (got and {k: v for k, v in got.asDict().items() if v is not None}) == fields
    if fields:
        assert x.select(C.compose_tag(layout, {k: F.col("x")[k] for k in got.asDict()})).first()[0] == tag


def test_widths_patterns_and_required_fields_are_held_to(spark):
    layout = layouts(spark, C.DASHED)["item"]
    lit = lambda **x: spark.range(1).select(C.compose_tag(layout, {k: F.lit(v) for k, v in x.items()})).first()[0]
    assert lit(fluid=" PG ", unit="14", sequence="151") == "PG-14151"
    assert lit(fluid="PG", unit="4", sequence="151") is lit(fluid="PG", unit="14") is lit(fluid="p1", unit="14", sequence="151") is lit() is None


def test_a_convention_is_data(spark):
    own = [("t", 1, 0, "b", "<", ">", 2, "[0-9]", False), ("t", 0, 0, "a", "", "", None, "[a-z]+", True), ("t", 2, 0, "c", "", "", None, None, False)]
    layout = layouts(spark, own)["t"]
    assert re.match(p := C.pattern_of(layout).replace(r"\z", r"\Z"), "ab-<12>-x") and re.match(p, "ab-x") and not re.match(p, "ab-<1>-x")
    r = spark.createDataFrame([("ab-<12>",)], "t string").select(C.decode_tag(layout, F.col("t")).alias("x")).first()["x"]
    assert r.asDict() == {"a": "ab", "b": "12", "c": None}


def test_colours_equal_refinement_by_sorted_neighbours(spark):
    r = random.Random(3)
    nodes = [(i, r.choice("ab")) for i in range(80)] + [(200, None)]
    edges = [(r.randrange(80), r.randrange(90)) for _ in range(90)] + [(200, 1), (3, None), (4, 4)]
    ids = {n for n, _ in nodes}
    near = {i: {b if a == i else a for a, b in edges if i in (a, b) and a != b and a in ids and b in ids} for i in ids}
    colour, want = dict(nodes), []
    for _ in range(3):
        want.append(colour)
        colour = {i: (colour[i], tuple(sorted((repr(colour[j]) for j in near[i])))) for i in ids}
    want.append(colour)
    rows = spark.createDataFrame([*nodes, (0, nodes[0][1])], "id long, tag string")
    got = quality.neighbour_colours(rows, spark.createDataFrame(edges, "src long, dst long"), "id", "tag", 3).collect()
    assert len(got) == 81
    for k in range(4):
        classes = lambda pairs: {frozenset(i for i, c in pairs if c == x) for x in {c for _, c in pairs}}
        assert classes([(x["id"], x[f"colour_{k}"]) for x in got]) == classes(list(want[k].items()))


def test_colliders_without_edges_and_rows(spark):
    rows = spark.createDataFrame([(1, "t", "x"), (2, "t", "y"), (3, "u", "x")], "id long, tag string, a string")
    none = spark.createDataFrame([], "src long, dst long")
    got = quality.collider_diagnostics(rows, none, ["tag"], "id", ["a"], "tag").collect()
    assert [tuple(x) for x in got] == [("t", 2, 2, 1, 1)]
    assert quality.collider_diagnostics(rows.limit(0), none, ["tag"], "id", ["a"], "tag").count() == 0
