"""Commissioning systems: fragments of one fluid, traced to the consumer that they serve."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from drawloom.operators.graph import connected_components
from drawloom.tables import cut, drop, scratch

#: Fluid classes whose connected networks are systems of their own.
SELF_OWNING = ["flare", "steam_condensate"]


def _both_ways(edges: DataFrame) -> DataFrame:
    """(node, other, flow): out where flow runs one way from node to other, in where it comes one way, free where it is unknown or both."""
    sense = F.col("flow_sense")
    e = edges.where("src is not null and dst is not null and src <> dst").select("src", "dst", F.when(sense == "forward", "out").when(sense == "reverse", "in").otherwise("free").alias("flow"))
    back = e.select(F.col("dst").alias("node"), F.col("src").alias("other"), F.when(F.col("flow") == "out", "in").when(F.col("flow") == "in", "out").otherwise("free").alias("flow"))
    both = e.select(F.col("src").alias("node"), F.col("dst").alias("other"), "flow").unionByName(back)
    # several edges between two nodes: one way only if all that tell agree
    told = F.collect_set("flow")
    return both.groupBy("node", "other").agg(F.when(F.size(told) == 1, F.element_at(told, 1)).when(F.array_contains(told, "in") & F.array_contains(told, "out"), "free").otherwise(F.when(F.array_contains(told, "in"), "in").otherwise("out")).alias("flow"))


def _guard(flare: Column, at_neighbour: Column, at_fragment: Column) -> Column:
    """Why a neighbour beyond a boundary is no consumer: flow runs from it into the fragment (supply), or from the fragment into a flare; null if it may be one.

    at_neighbour, at_fragment: flow as either side sees its edge to the boundary.
    """
    into_fragment = (at_neighbour == "out") & (at_fragment == "in")
    into_neighbour = (at_fragment == "out") & (at_neighbour == "in")
    return F.when(into_fragment, "supply").when(flare & into_neighbour, "flare")


def trace_systems(nodes: DataFrame, edges: DataFrame, self_owning: list[str] = SELF_OWNING) -> tuple[DataFrame, DataFrame]:
    """(systems, guards).

    nodes: node, fluid, fluid_class, role (inner, boundary, relief or equipment), tag (of equipment); edges: src, dst, flow_sense.
    systems: node, fragment, system, rule, hops, consumer. Fragments are inner nodes of one fluid that are
    joined by edges. Fragments of a self-owning class are the system utility:fluid (rule own). A
    fragment with an edge to equipment is that item's system (equipment); of several the least tag counts. Others
    join the nearest fragment of another fluid beyond a boundary that has a system (junction): each round goes one boundary further, of
    equally near ones the least system counts, until no more is reached; what is left waits (pending:fluid). A
    neighbour that flows into the fragment is a supply and one of a flare that the fragment flows into is a discharge: neither
    is a consumer, and guards has a row for each. A relief device takes the system that flows into it one
    way (relief); boundaries themselves have none. guards: fragment, neighbour, boundary, guard.

    A boundary's neighbours are not paired: each round sums up at each boundary what arrives there by fluid and
    flow. Null nodes and edges to unknown nodes are left out; edges within a boundary or between two
    boundaries end the trace.
    """
    with scratch() as keep:
        n = keep(nodes.where("node is not null").select("node", "fluid", "fluid_class", F.coalesce("role", F.lit("inner")).alias("role"), "tag").dropDuplicates(["node"]), "nodes")
        e = keep(_both_ways(edges).join(n.select(F.col("node").alias("other"), F.col("role").alias("o_role"), F.col("fluid").alias("o_fluid"), F.col("tag").alias("o_tag")), "other").join(n.select("node", "role", "fluid"), "node"), "edges")
        inner = n.where("role = 'inner'")
        parts = connected_components(e.where("role = 'inner' and o_role = 'inner' and fluid <=> o_fluid"), "node", "other")
        frag = keep(inner.join(parts, "node", "left").select("node", "fluid", "fluid_class", F.coalesce("component", "node").alias("fragment")), "fragments")
        drop(parts)
        of = frag.select("node", "fragment")
        about = frag.groupBy("fragment").agg(F.min("fluid").alias("fluid"), F.min("fluid_class").alias("fluid_class"))
        gear = e.where("role = 'inner' and o_role = 'equipment' and o_tag is not null").join(of, "node").groupBy("fragment").agg(F.min("o_tag").alias("gear"))
        own = F.coalesce(F.col("fluid_class").isin(self_owning), F.lit(False))
        kinds = keep(about.join(gear, "fragment", "left").select("fragment", "fluid", (F.col("fluid_class") == "flare").alias("flare"), F.when(own, F.concat_ws(":", F.lit("utility"), "fluid")).when(F.col("gear").isNotNull(), F.concat(F.lit("process:"), "gear")).alias("system"), F.when(own, "own").when(F.col("gear").isNotNull(), "equipment").alias("rule")), "kinds")
        touch = keep(e.where("role = 'inner' and o_role in ('boundary', 'relief')").join(of, "node").select("fragment", F.col("other").alias("boundary"), "flow").distinct().join(kinds.select("fragment", "fluid", F.coalesce("flare", F.lit(False)).alias("flare")), "fragment"), "touch")
        seen = [keep(kinds.where("system is not null").select("fragment", "system", "rule", F.lit(0).alias("hops"), F.col("fragment").alias("consumer")), "front")]
        left = keep(touch.join(kinds.where("system is null"), "fragment", "left_semi"), "left")
        while not seen[-1].isEmpty():
            best = F.min(F.struct("system", "consumer")).alias("best")
            at = touch.join(seen[-1], "fragment").groupBy("boundary", F.col("fluid").alias("y_fluid"), F.col("flare").alias("y_flare"), F.col("flow").alias("y_flow")).agg(best)
            found = left.join(at, "boundary").where(~F.col("fluid").eqNullSafe(F.col("y_fluid")) & _guard(F.col("y_flare"), F.col("y_flow"), F.col("flow")).isNull())
            found = found.groupBy("fragment").agg(F.min("best").alias("best")).select("fragment", "best.system", F.lit("junction").alias("rule"), F.lit(len(seen)).alias("hops"), "best.consumer")
            seen.append(keep(found, "front"))
            before, left = left, keep(left.join(seen[-1], "fragment", "left_anti"), "left")
            drop(before)
        told = keep(reduce(DataFrame.unionByName, seen), "told")
        pending = kinds.select("fragment", "fluid").join(told, "fragment", "left").select("fragment", F.coalesce("system", F.concat_ws(":", F.lit("pending"), "fluid")).alias("system"), F.coalesce("rule", F.lit("pending")).alias("rule"), "hops", "consumer")
        members = of.join(pending, "fragment").select("node", "fragment", "system", "rule", "hops", "consumer")
        items = n.where("role = 'equipment' and tag is not null").select("node", F.lit(None).cast(dict(of.dtypes)["fragment"]).alias("fragment"), F.concat(F.lit("process:"), "tag").alias("system"), F.lit("equipment").alias("rule"), F.lit(0).alias("hops"), F.lit(None).cast(dict(of.dtypes)["fragment"]).alias("consumer"))
        # what flows into a relief device: a fragment's system or the equipment itself
        into = e.where("o_role = 'relief' and flow = 'out'").select("node", F.col("other").alias("device"))
        sides = members.select("node", "fragment", "system").unionByName(items.select("node", "fragment", "system"))
        relief = into.join(sides, "node").groupBy("device").agg(F.min(F.struct("system", "fragment")).alias("x"))
        relief = relief.select(F.col("device").alias("node"), "x.fragment", "x.system", F.lit("relief").alias("rule"), F.lit(0).alias("hops"), F.col("x.fragment").alias("consumer"))
        systems = cut(members.unionByName(items).unionByName(relief), "systems")
        # one row for each kind of neighbour at a boundary: the least fragment of a fluid and flow stands for its like
        kind = touch.groupBy("boundary", F.col("fluid").alias("y_fluid"), F.col("flare").alias("y_flare"), F.col("flow").alias("y_flow")).agg(F.min("fragment").alias("neighbour"))
        stopped = touch.join(kinds.where("not coalesce(rule = 'own', false)"), "fragment", "left_semi").join(kind, "boundary").where(~F.col("fluid").eqNullSafe(F.col("y_fluid")))
        guards = cut(stopped.select("fragment", "neighbour", "boundary", _guard(F.col("y_flare"), F.col("y_flow"), F.col("flow")).alias("guard")).where("guard is not null"), "guards")
    return systems, guards
