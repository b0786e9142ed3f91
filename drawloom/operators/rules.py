"""Node-local classification rules, derived facts and parity checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawloom.operators.facts import INFERRED, iri, unpivot

ROLES = ["isolation", "positive", "relief", "trap"]


def fluid_class(category: Column, subcategory: Column) -> Column:
    """flare, steam_condensate, process or utility, by the category; unknown is utility. Steam and Condensate count as parts of the subcategory, in this case."""
    sub = F.coalesce(subcategory, F.lit(""))
    steam = (category == "Utility") & (sub.contains("Steam") | sub.contains("Condensate"))
    return F.when(category == "Flare", "flare").when(steam, "steam_condensate").when(category == "Process", "process").otherwise("utility")


def classify_fluids(codes: DataFrame, fluids: DataFrame, code: str = "fluid_code") -> DataFrame:
    """codes with fluid_class; codes that the catalogue lacks are utility."""
    return codes.join(fluids, code, "left").withColumn("fluid_class", fluid_class(F.col("category"), F.col("subcategory")))


def boundary_forming(components: DataFrame, boundary: DataFrame, klass: str = "component_class") -> DataFrame:
    """Components whose class has one of the four roles (a check valve never)."""
    b = boundary.where(F.col("role").isin(ROLES) & (F.col("component_class") != "CheckValve")).select(F.col("component_class").alias(klass)).distinct()
    return components.join(b, klass, "left_semi")


def resolve_class(rows: DataFrame, uri: str, label: str, by_uri: DataFrame, by_label: DataFrame, boundary: Column) -> DataFrame:
    """rows with resolved_uri, bridge (uri before label, exact before close) and pending_review (close or label, on boundary-forming classes only).

    by_uri: key, target, match_type; by_label: key, target.
    """
    rank = F.when(F.col("match_type") == "exact", 0).otherwise(1)
    u = by_uri.groupBy(F.col("key").alias(uri)).agg(F.min_by(F.struct("target", "match_type"), F.struct(rank, "target")).alias("_u"))
    n = by_label.groupBy(F.col("key").alias(label)).agg(F.min("target").alias("_l"))
    j = rows.join(u, uri, "left").join(n, label, "left")
    bridge = F.when(F.col("_u").isNotNull(), F.col("_u.match_type")).when(F.col("_l").isNotNull(), "label")
    return j.withColumns({"resolved_uri": F.coalesce("_u.target", "_l"), "bridge": bridge, "pending_review": F.coalesce(bridge.isin("close", "label") & boundary, F.lit(False))}).drop("_u", "_l")


def _one_way(edges: DataFrame) -> DataFrame:
    """Directed edges (src, dst) whose reverse is not there."""
    e = edges.select("src", "dst").where("src <> dst").distinct()
    return e.join(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")), ["src", "dst"], "left_anti")


def flare_guard(edges: DataFrame, fluids: DataFrame) -> DataFrame:
    """(node, neighbour): flow goes one way into a neighbour whose fluid is flare. fluids: node, fluid_class."""
    f = fluids.where("fluid_class = 'flare'").select(F.col("node").alias("dst"))
    return _one_way(edges).join(f, "dst", "left_semi").select(F.col("src").alias("node"), F.col("dst").alias("neighbour"))


def supply_tie_in(edges: DataFrame) -> DataFrame:
    """(node, neighbour): flow comes one way from the neighbour."""
    return _one_way(edges).select(F.col("dst").alias("node"), F.col("src").alias("neighbour"))


def relief_attribution(edges: DataFrame, relief: DataFrame) -> DataFrame:
    """(valve, protects): one-way inflow of each relief valve, all of them; `single` marks the least."""
    r = relief.select(F.col(relief.columns[0]).alias("dst")).distinct()
    all_of = _one_way(edges).join(r, "dst", "left_semi").select(F.col("dst").alias("valve"), F.col("src").alias("protects"))
    least = all_of.groupBy("valve").agg(F.min("protects").alias("_m"))
    return all_of.join(least, "valve").select("valve", "protects", (F.col("protects") == F.col("_m")).alias("single"))


def allocate(kind: Column, side_a: Column, side_b: Column, a_first: Column, steam: Column, upstream: Column, interface: Column, equipment: Column) -> Column:
    """The side that an object on a boundary belongs to; null for unknown kinds.

    Boundary valves and blinds: side_a if it is commissioned first (at equal priority too), else side_b;
    traps: the steam side; sampling: upstream; interface valves: the flare or drain side that they are the interface to;
    vessel and column instruments: the equipment's system.
    """
    out = F.when(kind == "boundary", F.when(a_first, side_a).otherwise(side_b))
    for name, side in (("trap", steam), ("sampling", upstream), ("interface", interface), ("instrument", equipment)):
        out = out.when(kind == name, side)
    return out


def component_fluid(components: DataFrame, segments: DataFrame, segment: str = "segment_id", fluid: str = "fluid") -> DataFrame:
    """components with the fluid of the segment that they are part of; null without a segment, or if the segment has none."""
    s = segments.where(F.col(segment).isNotNull()).groupBy(segment).agg(F.min(fluid).alias(fluid))
    return components.join(s, segment, "left")


def fragment_key(package: Column, klass: Column, fluid: Column, anchor: Column) -> Column:
    """Identity of a system fragment: package, utility, fluid or package, process, anchor; null where a part is missing and for other kinds."""
    return F.when(package.isNotNull() & (klass == "utility") & fluid.isNotNull(), F.concat_ws("|", package, F.lit("utility"), fluid)).when(package.isNotNull() & (klass == "process") & anchor.isNotNull(), F.concat_ws("|", package, F.lit("process"), anchor))


def materialise(classes: DataFrame, flare: DataFrame, supply: DataFrame, relief: DataFrame) -> DataFrame:
    """Derived facts as a set: fluidClass, flaresTo, suppliedBy, protects.

    Rows are made distinct by their two columns before they become texts, which takes tasks far less memory; predicates keep the kinds apart.
    """
    c = lambda n: iri("component", F.col(n))
    out = unpivot(classes.select("fluid_code", "fluid_class").distinct(), iri("fluid", F.col("fluid_code")), [("fluidClass", F.col("fluid_class"), "string")], INFERRED)
    for rows, a, p, b in ((flare, "node", "flaresTo", "neighbour"), (supply, "node", "suppliedBy", "neighbour"), (relief, "valve", "protects", "protects")):
        out = out.unionByName(unpivot(rows.select(a, b).distinct(), c(a), [(p, c(b), "iri")], INFERRED))
    return out


def provenance(spark, run: str, inputs: dict[str, str], rules: dict[str, str]) -> DataFrame:
    """Facts on the run: its inputs' fingerprints and the rule of each predicate."""
    s = f"urn:plant:run/{run}"
    rows = [(INFERRED, s, "rdf:type", "prov:Activity", "iri", None)] + [(INFERRED, s, f"used/{g}", f, "literal", "string") for g, f in sorted(inputs.items())] + [(INFERRED, s, f"rule/{p}", r, "literal", "string") for p, r in sorted(rules.items())]
    return spark.createDataFrame(rows, "graph string, s string, p string, o string, o_kind string, o_datatype string")


def parity_pairs(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """One row: pairs in both sets, only left, only right."""
    j = left.select(*keys).distinct().withColumn("_l", F.lit(1)).join(right.select(*keys).distinct().withColumn("_r", F.lit(1)), keys, "full_outer")
    a, b = F.col("_l").isNotNull(), F.col("_r").isNotNull()
    return j.agg(F.count_if(a & b).alias("n_agree"), F.count_if(a & ~b).alias("n_left_only"), F.count_if(~a & b).alias("n_right_only"))


def parity_classes(left: DataFrame, right: DataFrame, key: str, value: str, default: str = "utility") -> DataFrame:
    """Rows where the classes differ; a missing one is the default."""
    j = left.select(key, F.col(value).alias("left_value")).join(right.select(key, F.col(value).alias("right_value")), key, "full_outer")
    j = j.withColumns({"left_value": F.coalesce("left_value", F.lit(default)), "right_value": F.coalesce("right_value", F.lit(default))})
    return j.where("left_value <> right_value")


def parity_sets(single: DataFrame, many: DataFrame, key: str, value: str) -> DataFrame:
    """Per key agree, mismatch, multi (agrees, among several), left_only or right_only, of one answer against a set."""
    m = many.groupBy(key).agg(F.array_sort(F.collect_set(value)).alias("_many"))
    j = single.select(key, F.col(value).alias("_one")).join(m, key, "full_outer")
    inside = F.array_contains("_many", F.col("_one"))
    state = F.when(F.col("_many").isNull(), "left_only").when(F.col("_one").isNull(), "right_only").when(~inside, "mismatch").when(F.size("_many") > 1, "multi").otherwise("agree")
    return j.select(key, state.alias("state"))


def preflight(quads: DataFrame, required: list[str], forbidden: list[str]) -> DataFrame:
    """One row: required predicates that are missing, forbidden ones that are there, and ok."""
    have = quads.where(F.col("p").isin([*required, *forbidden])).agg(F.collect_set("p").alias("have"))
    lit = lambda xs: F.array(*[F.lit(x) for x in xs]) if xs else F.array().cast("array<string>")
    return have.select(F.array_sort(F.array_except(lit(required), "have")).alias("missing"), F.array_sort(F.array_intersect(lit(forbidden), "have")).alias("forbidden")).withColumn("ok", (F.size("missing") == 0) & (F.size("forbidden") == 0))


def may_publish(parity: DataFrame, fingerprint_before: str, fingerprint_now: str) -> bool:
    """Only where parity has no differences and the inputs are the same; one aggregate row reaches the driver."""
    r = parity.first()
    return fingerprint_before == fingerprint_now and r["n_left_only"] == 0 and r["n_right_only"] == 0


def freshness(derived: DataFrame, inputs: DataFrame) -> DataFrame:
    """Per input graph whether the fingerprint that the derived facts were made from is the present one. derived, inputs: graph, fingerprint."""
    return inputs.join(derived.withColumnRenamed("fingerprint", "used"), "graph", "left").select("graph", "fingerprint", "used", F.col("fingerprint").eqNullSafe(F.col("used")).alias("fresh"))


def verdict(counts: DataFrame, expected: str = "expected", found: str = "found") -> DataFrame:
    return counts.withColumn("verdict", F.when(F.col(found) == F.col(expected), "ok").otherwise("check"))


def rule_card(quads: DataFrame, subject: str) -> DataFrame:
    """All facts about one subject, in both directions."""
    ahead = quads.where(F.col("s") == subject).select(F.lit("out").alias("direction"), "p", F.col("o").alias("other"))
    return ahead.unionByName(quads.where((F.col("o") == subject) & (F.col("o_kind") == "iri")).select(F.lit("in").alias("direction"), "p", F.col("s").alias("other")))


def fluid_span(rows: DataFrame, fluid: str, system: str, component: str) -> DataFrame:
    return rows.groupBy(fluid).agg(F.countDistinct(system).alias("n_systems"), F.countDistinct(component).alias("n_components"))
