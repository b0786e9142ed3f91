"""Facts as lines of N-Triples and N-Quads, and mappings between vocabularies."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_LINE = r'^\s*<([^>]*)>\s+<([^>]*)>\s+(?:<([^>]*)>|"(.*)"(?:\^\^<([^>]*)>|@([A-Za-z0-9-]+))?)\s*(?:<([^>]*)>\s*)?\.\s*$'


def escaped(c: Column) -> Column:
    for a, b in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def unescaped(c: Column) -> Column:
    mark = "\x01"
    c = F.replace(c, F.lit("\\\\"), F.lit(mark))
    for a, b in (('\\"', '"'), ("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return F.replace(c, F.lit(mark), F.lit("\\"))


def to_lines(quads: DataFrame, graphs: bool = False) -> DataFrame:
    """Column value: a line per quad (graph, s, p, o, o_kind iri|literal, o_datatype); with graphs the fourth term too."""
    literal = F.concat(F.lit('"'), escaped(F.col("o")), F.lit('"'), F.coalesce(F.concat(F.lit("^^<"), F.col("o_datatype"), F.lit(">")), F.lit("")))
    o = F.when(F.col("o_kind") == "iri", F.concat(F.lit("<"), F.col("o"), F.lit(">"))).otherwise(literal)
    end = F.concat(F.lit(" <"), F.col("graph"), F.lit("> .")) if graphs else F.lit(" .")
    return quads.select(F.concat(F.lit("<"), F.col("s"), F.lit("> <"), F.col("p"), F.lit("> "), o, end).alias("value"))


def from_lines(lines: DataFrame, column: str = "value") -> DataFrame:
    """(graph, s, p, o, o_kind, o_datatype) of the lines that are triples or quads; others are left out."""
    g = lambda i: F.nullif(F.regexp_extract(column, _LINE, i), F.lit(""))
    iri = g(3)
    rows = lines.where(F.col(column).rlike(_LINE))
    return rows.select(g(7).alias("graph"), g(1).alias("s"), g(2).alias("p"), F.coalesce(iri, unescaped(F.regexp_extract(column, _LINE, 4))).alias("o"), F.when(iri.isNotNull(), "iri").otherwise("literal").alias("o_kind"), g(5).alias("o_datatype"))


def scan_ntriples(spark: SparkSession, path: str) -> DataFrame:
    return from_lines(spark.read.text(path))


_SKOS = "http://www.w3.org/2004/02/skos/core#"


def extract_mappings(facts: DataFrame, left: str, right: str) -> dict[str, DataFrame]:
    """SKOS matches between two vocabularies known by a substring of their URIs: mapped (exact, close), related, rejected.

    Direction does not matter; a match whose ends are not one of each side is rejected.
    """
    kind = F.when(F.col("p") == _SKOS + "exactMatch", "exact").when(F.col("p") == _SKOS + "closeMatch", "close").when(F.col("p") == _SKOS + "relatedMatch", "related")
    m = facts.withColumn("match_type", kind).where("match_type is not null")
    is_left, is_right = (lambda c: F.instr(c, left) > 0), (lambda c: F.instr(c, right) > 0)
    ahead = is_left(F.col("s")) & is_right(F.col("o"))
    back = is_right(F.col("s")) & is_left(F.col("o"))
    m = m.select(F.when(ahead, F.col("s")).when(back, F.col("o")).alias("left_uri"), F.when(ahead, F.col("o")).when(back, F.col("s")).alias("right_uri"), "match_type", "s", "o").distinct()
    good = m.where("left_uri is not null").select("left_uri", "right_uri", "match_type").distinct()
    return {"mapped": good.where("match_type <> 'related'"), "related": good.where("match_type = 'related'"), "rejected": m.where("left_uri is null").select("s", "o", "match_type")}
