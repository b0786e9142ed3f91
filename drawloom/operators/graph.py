"""Connected components and other iterative graph operators over edge DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawloom.tables import cut, drop, scratch


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", rounds: int = 60) -> DataFrame:
    """(node, component): the least node of each connected component, for every node in an edge.

    Large-star and small-star rounds by turns, each written to the shared folder,
    until the edges stay as they are; per round only a count and two checksums
    reach the driver, and joins are merged, never broadcast through it. Self loops keep their node; edges with a null end are left out.
    """
    with scratch() as keep:
        base = keep(edges.select(F.col(f"`{src}`").alias("u"), F.col(f"`{dst}`").alias("v")).where("u is not null and v is not null").distinct(), "base")
        now = keep(base.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
        mark = _mark(now)
        for _ in range(rounds):
            if not mark[0]:
                break
            with scratch() as once:
                both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
                # tables of their own, so that joining them back can split the rows of a node of many edges
                least = once(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
                large = once(both.where("v > u").join(least.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
                low = once(large.groupBy("u").agg(F.min("v").alias("m")), "low")
                # small star: u's smaller neighbours, and u itself, point to the least of them
                small = large.join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(low.select("u", F.col("m").alias("v")))
                before, now = now, keep(small.where("u <> v").distinct(), "edges")
                drop(before)
            new = _mark(now)
            if new == mark:
                break
            mark = new
        else:
            raise RuntimeError("connected_components: no fixed point within the given rounds")
        nodes = base.select(F.col("u").alias("node")).union(base.select("v")).distinct()
        roots = now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        return cut(nodes.join(roots.hint("merge"), "node", "left").select("node", F.coalesce("root", "node").alias("component")), "components")


def neighbours(edges: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """(node, neighbour) both ways, each once, without self loops."""
    e = edges.select(F.col(f"`{src}`").alias("node"), F.col(f"`{dst}`").alias("neighbour"))
    return e.unionByName(e.select(F.col("neighbour").alias("node"), F.col("node").alias("neighbour"))).where("node <> neighbour").distinct()


def flow_between(edges: DataFrame, pairs: DataFrame, src: str = "src", dst: str = "dst") -> DataFrame:
    """pairs (a, b) with flow none, forward, reverse or both, by directed edges."""
    e = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).distinct()
    f, r = e.withColumn("_f", F.lit(True)), e.select(F.col("b").alias("a"), F.col("a").alias("b"), F.lit(True).alias("_r"))
    j = pairs.join(f, ["a", "b"], "left").join(r, ["a", "b"], "left")
    flow = F.when(F.col("_f") & F.col("_r"), "both").when(F.col("_f"), "forward").when(F.col("_r"), "reverse").otherwise("none")
    return j.withColumn("flow", flow).drop("_f", "_r")


def descendants(edges: DataFrame, roots: DataFrame, child: str = "child", parent: str = "parent", rounds: int = 100) -> DataFrame:
    """(root, node) for every node under each root, the root included: a frontier joined with the tree until it is empty.

    Only the size of the frontier reaches the driver; cycles end because found pairs are not followed again.
    """
    e = edges.select(F.col(parent).alias("up"), F.col(child).alias("node")).distinct()
    front = roots.select(F.col(roots.columns[0]).alias("root"), F.col(roots.columns[0]).alias("node")).distinct()
    seen = cut(front, "closure")
    front = seen
    for _ in range(rounds):
        front = front.select("root", F.col("node").alias("up")).join(e, "up").select("root", "node").distinct()
        front = cut(front.join(seen, ["root", "node"], "left_anti"), "closure")
        if front.isEmpty():
            return seen
        seen = cut(seen.unionByName(front), "closure")
    raise RuntimeError("descendants: the frontier is not empty after the given rounds")


def closure_check(expected: DataFrame, inferred: DataFrame, asserted: DataFrame, keys: list[str]) -> DataFrame:
    """One row: pairs in both, only expected, only inferred, and directly asserted."""
    j = expected.select(*keys).distinct().withColumn("_e", F.lit(1)).join(inferred.select(*keys).distinct().withColumn("_i", F.lit(1)), keys, "full_outer")
    j = j.join(asserted.select(*keys).distinct().withColumn("_a", F.lit(1)), keys, "left")
    n = lambda c: F.count_if(c)
    e, i = F.col("_e").isNotNull(), F.col("_i").isNotNull()
    return j.agg(n(e & i).alias("n_agree"), n(e & ~i).alias("n_only_expected"), n(~e & i).alias("n_only_inferred"), n(F.col("_a").isNotNull()).alias("n_asserted"))


def partition_systems(nodes: DataFrame, edges: DataFrame, self_owning: list[str]) -> DataFrame:
    """(node, system) for nodes (node, fluid, fluid_class, is_boundary, anchor): fragments of one fluid cut at boundaries, named.

    Fragments of a self-owning class are the system of their fluid (utility) or
    part; others take the least anchor that touches them (the consumer), and
    fragments of the same name are one system. Fragments without anchor are named
    by their fluid as pending.
    """
    n = nodes.select("node", "fluid", "fluid_class", "is_boundary", "anchor")
    e = edges.select(F.col("src").alias("a"), F.col("dst").alias("b"))
    side = lambda c: n.select(F.col("node").alias(c), *[F.col(x).alias(f"{c}_{x}") for x in ("fluid", "is_boundary", "anchor")])
    e = e.join(side("a").hint("merge"), "a").join(side("b").hint("merge"), "b")
    same = e.where("a_fluid = b_fluid and not a_is_boundary and not b_is_boundary")
    inner = n.where("not is_boundary")
    parts = connected_components(same, "a", "b")
    frag = inner.join(parts.hint("merge"), "node", "left").withColumn("fragment", F.coalesce("component", "node")).drop("component")
    near = e.select(F.col("a").alias("node"), F.col("b_anchor").alias("touch")).unionByName(e.select(F.col("b").alias("node"), F.col("a_anchor").alias("touch")))
    touch = near.where("touch is not null").join(frag.select("node", "fragment").hint("merge"), "node").groupBy("fragment").agg(F.min("touch").alias("consumer"))
    owner = cut(frag.groupBy("fragment").agg(F.first("fluid").alias("f_fluid"), F.first("fluid_class").alias("f_class"), F.min("anchor").alias("own_anchor")).join(touch.hint("merge"), "fragment", "left"), "fragments")
    anchor = F.coalesce("own_anchor", "consumer")
    name = F.when(F.col("f_class").isin(self_owning), F.concat_ws(":", F.lit("utility"), "f_fluid")).when(anchor.isNotNull(), F.concat_ws(":", F.lit("process"), anchor)).otherwise(F.concat_ws(":", F.lit("pending"), "f_fluid"))
    return frag.select("node", "fragment").join(owner.select("fragment", name.alias("system")).hint("merge"), "fragment").select("node", "system")
