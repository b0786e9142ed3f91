"""Checks on a table of facts: connectors, edges across drawings, completeness, typing and membership."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawloom.operators import facts, graph

_CLASS = "urn:plant:class/"
_OPC = _CLASS + "OffPageConnector"


def of_class(quads: DataFrame, cls: str) -> DataFrame:
    """The subjects of a class, once each."""
    return facts.match(quads, p="rdf:type", o=_CLASS + cls).select("s").distinct()


def completeness(quads: DataFrame, cls: str, predicates: list[str]) -> DataFrame:
    """One row: subjects of the class (n) and how many have each predicate (with_<predicate>)."""
    has = lambda p: F.max((F.col("p") == p).cast("int"))
    is_it = F.max(((F.col("p") == "rdf:type") & (F.col("o") == _CLASS + cls)).cast("int"))
    s = quads.where(F.col("p").isin(["rdf:type", *predicates])).groupBy("s").agg(is_it.alias("_is"), *[has(p).alias(f"_{p}") for p in predicates]).where("_is = 1")
    return s.agg(F.count("*").alias("n"), *[F.count_if(F.col(f"_{p}") == 1).alias(f"with_{p}") for p in predicates])


def connectors(quads: DataFrame) -> DataFrame:
    """One row per connector: opc, opcType, flowSense, matched, terminates; null where a fact is missing."""
    w = facts.wide(quads, ["rdf:type", "opcType", "flowSense", "matched", "terminates"])
    return w.where(F.col("type") == _OPC).select(F.col("s").alias("opc"), "opcType", "flowSense", "matched", "terminates")


def wrongly_terminating(quads: DataFrame) -> DataFrame:
    """Connectors of a signal or an instrument that end on a segment; must be empty."""
    has = lambda c, part: F.coalesce(F.lower(F.col(c)).contains(part), F.lit(False))
    return connectors(quads).where(F.col("terminates").isNotNull() & (has("flowSense", "signal") | has("opcType", "instrument")))


def connector_coverage(quads: DataFrame) -> DataFrame:
    """By type of connector: how many, how many matched and how many ending on a segment."""
    return connectors(quads).groupBy("opcType").agg(F.count("*").alias("n"), F.count_if(F.col("matched") == "true").alias("n_matched"), F.count("terminates").alias("n_terminating"))


def edges_across(quads: DataFrame) -> DataFrame:
    """(connection, opc_a, opc_b, derived) of the off-page edges both ends of which are connectors."""
    e = facts.wide(quads, ["connType", "from", "to", "derived"]).where("connType = 'OffPage'").select(F.col("s").alias("connection"), F.col("from").alias("opc_a"), F.col("to").alias("opc_b"), "derived")
    opc = of_class(quads, "OffPageConnector")
    return e.join(opc.withColumnRenamed("s", "opc_a"), "opc_a", "left_semi").join(opc.withColumnRenamed("s", "opc_b"), "opc_b", "left_semi").select("connection", "opc_a", "opc_b", "derived")


def walk_across(quads: DataFrame) -> DataFrame:
    """(segment_a, opc_a, opc_b, segment_b): segments that continue on another one across drawings."""
    on = facts.match(quads, p="terminates").select("s", "o").distinct()
    w = edges_across(quads).join(on.select(F.col("s").alias("opc_a"), F.col("o").alias("segment_a")), "opc_a").join(on.select(F.col("s").alias("opc_b"), F.col("o").alias("segment_b")), "opc_b")
    return w.where("segment_a <> segment_b").select("segment_a", "opc_a", "opc_b", "segment_b")


def also_typed(quads: DataFrame, classes: list[str], under: str) -> DataFrame:
    """Subjects (s, type) of one of the classes that also have a type at or below `under` in the class tree; must be empty for functional objects under physical ones."""
    tree = facts.match(quads, p="rdfs:subClassOf").select(F.col("s").alias("child"), F.col("o").alias("parent"))
    root = quads.sparkSession.createDataFrame([(_CLASS + under,)], "root string")
    below = graph.descendants(tree, root).select(F.col("node").alias("o")).distinct()
    types = facts.match(quads, p="rdf:type")
    own = types.where(F.col("o").isin([_CLASS + c for c in classes])).select("s").distinct()
    return types.join(below, "o", "left_semi").join(own, "s", "left_semi").select("s", F.col("o").alias("type")).distinct()


def direct_members(quads: DataFrame, physical: list[str]) -> DataFrame:
    """(system, member): physical objects that a system has as a function itself, not through a function node; must be empty."""
    objects = facts.match(quads, p="rdf:type").where(F.col("o").isin([_CLASS + c for c in physical])).select(F.col("s").alias("member")).distinct()
    return facts.match(quads, p="hasFunction").select(F.col("s").alias("system"), F.col("o").alias("member")).join(objects, "member", "left_semi").select("system", "member").distinct()


def misplaced(quads: DataFrame, cls: str, home: str) -> DataFrame:
    """By graph other than `home`: how many subjects of the class it has; must be empty."""
    return facts.match(quads, p="rdf:type", o=_CLASS + cls).where(F.col("graph") != home).groupBy("graph").agg(F.countDistinct("s").alias("n"))
