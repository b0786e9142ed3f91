import pytest

from drawloom.operators.naming_rules import Link, Rule, Scope, issues, resolve_fields

RULES = [
    Rule("unit", "member", column="unit"), Rule("fluid", "member", column="fluid"),
    Rule("area", "lookup", ("unit",), "areas", ("unit",), "area"),
    Rule("code", "select", ("unit",), "functions", ("unit",), "code", match="fluid", link=Link("links", "code", "unit", "fluids"), prefer=(("service", "what"), ("area", "area")), label="code"),
    Rule("what", "column", ("code",), column="what"),
    Rule("plant", "const", value="P1"), Rule("code", "const", value=""),
    Rule("number", "sequence", ("area", "code"), width=2),
]
TABLES = {
    "areas": [("14", "A1"), ("009", "A2"), ("20", "A3"), ("20", "A4"), ("30", "")],
    "functions": [("14", "F1", "FLARE HP", "A1"), ("14", "F2", "FLARE LP", "A9"), ("9", "F3", "ACID GAS", "A2"), ("40", "F4", "ONLY", ""), ("14", "F5", "STEAM", "A1"), ("50", "F6", "X", "A1"), ("50", "F7", "Y", "A1")],
    "links": [("F1", "14", "AG;FG"), ("F2", "", "AG, LF"), ("F3", "", "AG"), ("F5", "15", "ST"), ("F6", "", "WA"), ("F7", "", "WA")],
}
SCHEMAS = {"areas": "unit string, area string", "functions": "unit string, code string, what string, area string", "links": "code string, unit string, fluids string"}


def resolve(spark, members, texts=None, rules=RULES, anchors=None, tables=TABLES):
    names = sorted({m[0] for m in members})
    s = spark.createDataFrame([(n, (anchors or {}).get(n)) for n in names], "system string, anchor string")
    m = spark.createDataFrame(members, "system string, unit string, fluid string")
    t = {k: spark.createDataFrame(v, SCHEMAS[k]) for k, v in tables.items()}
    x = spark.createDataFrame(texts, "system string, text string") if texts else None
    return {r["system"]: r for r in resolve_fields(s, m, t, rules, x).collect()}


def test_fields_of_systems(spark):
    got = resolve(spark, [
        ("a", "14", "FG"), ("a", "14", "FG"), ("a", "9", "AG"), ("b", "9", "AG"), ("c", "14", "LF"), ("d", "40", "ZZ"), ("e", "14", "ZZ"), ("f", "99", "AG"), ("g", "20", "AG"), ("h", None, "AG"), ("i", "30", "AG"),
    ])
    say = lambda s: (got[s]["unit"], got[s]["area"], got[s]["code"], got[s]["what"])
    assert say("a") == ("14", "A1", "F1", "FLARE HP") and got["a"]["problems"] == []  # most members; the unit's own link
    assert say("b") == ("9", "A2", "F3", "ACID GAS")  # 009 is 9, and a blank unit links everywhere
    assert say("c") == ("14", "A1", "F2", "FLARE LP")
    assert say("d")[2:] == ("F4", "ONLY")  # the unit's only row, which lists nothing
    assert say("e")[2] is None and got["e"]["problems"] == ["functions has no row that fits for unit 14"] and got["e"]["candidates"] == {"code": ["F1", "F2", "F5"]}
    assert got["f"]["problems"] == ["areas has no row for unit 99", "functions allows nothing for unit 99"]
    assert got["g"]["problems"][0] == "areas has area more than once for unit 20" and got["g"]["candidates"]["area"] == ["A3", "A4"]
    assert got["h"]["problems"] == ["no member has unit"]  # what depends on it says nothing
    assert got["i"]["problems"][0] == "areas has no area for unit 30" and got["i"]["plant"] == "P1"


def test_tie_breakers_in_their_order(spark):
    members = [("a", "14", "AG"), ("b", "14", "AG"), ("c", "50", "WA")]
    got = resolve(spark, members, [("a", "to LP header"), ("a", None), ("c", "nothing of it")])
    assert got["a"]["code"] == "F2"  # the service text names what tells the rows apart
    assert got["b"]["code"] == "F1"  # no text: the row of the same area
    assert got["c"]["code"] is None and got["c"]["candidates"] == {"code": ["F6", "F7"]} and got["c"]["problems"][-1] == "functions has several rows that fit for unit 50"


def test_a_later_rule_clears_what_an_earlier_one_told(spark):
    rules = [*RULES[:3], Rule("area", "const", value="A0")]
    got = resolve(spark, [("f", "99", "AG"), ("a", "14", "AG")], rules=rules)
    assert (got["f"]["area"], got["f"]["problems"], got["f"]["candidates"]) == ("A0", [], {}) and got["a"]["area"] == "A1"


def test_scope_and_no_keys(spark):
    scoped = [*RULES[:3], Rule("code", "select", ("unit",), "functions", ("unit",), "code", match="fluid", link=Link("links", "code", "unit", "fluids"), scope=Scope("areas", "area", "unit", "area"), label="code")]
    got = resolve(spark, [("a", "14", "FG"), ("b", "30", "AG")], rules=scoped)
    assert got["a"]["code"] == "F1"
    wrong = {**TABLES, "areas": [("14", "A1"), ("15", "A2")]}
    scoped[3] = Rule("code", "select", ("unit",), "functions", ("unit",), "code", scope=Scope("links", "fluids", "unit", "area"), label="code")
    got = resolve(spark, [("a", "14", "FG")], rules=scoped, tables=wrong)
    assert got["a"]["problems"] == ["links gives area A1 no row of functions for unit 14"]
    free = [Rule("code", "select", (), "functions", (), "code")]
    assert resolve(spark, [("a", "14", "FG")], rules=free, tables={**TABLES, "functions": TABLES["functions"][:1]})["a"]["code"] == "F1"
    many = resolve(spark, [("a", "14", "FG")], rules=free)["a"]
    assert many["code"] is None and many["problems"] == ["functions has no row that fits"]


def test_numbers_in_their_scope_by_anchor(spark):
    got = resolve(spark, [("a", "14", "FG"), ("b", "14", "FG"), ("c", "14", "FG"), ("d", "9", "AG")], anchors={"a": "V9", "b": None, "c": "V1"})
    assert {k: r["number"] for k, r in got.items()} == {"c": "01", "a": "02", "b": "03", "d": "01"}


def test_rules_are_checked_before_data(spark):
    tables = {k: [c.split()[0] for c in v.split(", ")] for k, v in SCHEMAS.items()}
    assert issues(RULES, tables, ["unit", "fluid"]) == []
    bad = [Rule("a", "guess"), Rule("b", "lookup", ("z",), "areas", ("unit",), "none"), Rule("c", "select", ("a", "b"), "gone", ("unit",), "x"), Rule("d", "member", column="q"), Rule("e", "select", ("a",), "functions", ("unit",), "code", match="f")]
    assert issues(bad, tables, ["unit"]) == ["a: unknown source guess", "b: z is not found before it", "b: areas has no column none", "c: unknown table gone", "c: as many columns as keys are needed", "d: members have no q", "e: f is not found before it"]


@pytest.mark.parametrize("members", [[]])
def test_no_systems(spark, members):
    assert resolve(spark, members) == {}
