"""Reference sheets: header row and rows as small DataFrames, cleaned alike."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def cell(c: Column) -> Column:
    """Text of a cell: trimmed, 9.0 as 9, nan and none and null as empty."""
    t = F.trim(F.coalesce(c.cast("string"), F.lit("")))
    t = F.when(F.lower(t).isin("nan", "none"), "").otherwise(t)
    return F.regexp_replace(t, r"^(-?\d+)\.0$", "$1")


def clean_sheet(rows: DataFrame) -> DataFrame:
    """Lower-case trimmed column names, cells as text, rows without any text dropped."""
    out = rows.select(*[cell(F.col(f"`{c}`")).alias(c.strip().lower()) for c in rows.columns])
    return out.where(F.concat_ws("", *[F.col(f"`{c}`") for c in out.columns]) != "")


def read_ref_sheet(spark: SparkSession, path: str) -> DataFrame:
    return clean_sheet(spark.read.csv(path, header=True))


def fluid_catalogue(sheet: DataFrame, code: str, category: str, subcategory: str, description: str) -> DataFrame:
    """(fluid_code, category, subcategory, description); rows without a code go."""
    pick = {"fluid_code": code, "category": category, "subcategory": subcategory, "description": description}
    return sheet.select(*[cell(F.col(c)).alias(n) for n, c in pick.items()]).where("fluid_code <> ''")


#: Classes that bound a system where no sheet says otherwise, with their role.
DEFAULT_BOUNDARY = [
    ("GateValve", "isolation"), ("GlobeValve", "isolation"), ("BallValve", "isolation"), ("ButterflyValve", "isolation"), ("PlugValve", "isolation"),
    ("BlindFlange", "positive"), ("SpectacleBlind", "positive"), ("SpringLoadedGlobeSafetyValve", "relief"), ("SteamTrap", "trap"),
]


def boundary_sets(sheet: DataFrame, klass: str, role: str, flag: str | None = None) -> DataFrame:
    """(component_class, role) of classes flagged yes, or with a role where there is no flag column; unknown roles are left out (see rejected_roles)."""
    rows = sheet.select(cell(F.col(klass)).alias("component_class"), F.lower(cell(F.col(role))).alias("role"), (F.lower(cell(F.col(flag))).isin("yes", "y", "true", "1") if flag else F.lit(True)).alias("yes"))
    return rows.where("component_class <> '' and yes and role in ('isolation', 'positive', 'relief', 'trap')").select("component_class", "role").distinct()


def rejected_roles(sheet: DataFrame, klass: str, role: str) -> DataFrame:
    r = F.lower(cell(F.col(role)))
    return sheet.where((r != "") & ~r.isin("isolation", "positive", "relief", "trap")).select(F.col(klass).alias("component_class"), r.alias("role"))


def with_default(rows: DataFrame) -> DataFrame:
    """The default boundary set where rows is empty; decided inside the plan by an anti join on a constant."""
    spark = rows.sparkSession
    some = rows.limit(1).select(F.lit(1).alias("one"))
    default = spark.createDataFrame(DEFAULT_BOUNDARY, "component_class string, role string").withColumn("one", F.lit(1)).join(F.broadcast(some), "one", "left_anti").drop("one")
    return rows.unionByName(default)


def unit_codes(*sheets: tuple[DataFrame, str]) -> DataFrame:
    """Distinct codes of several sheets' code columns."""
    out = None
    for sheet, column in sheets:
        part = sheet.select(cell(F.col(column)).alias("unit_code")).where("unit_code <> ''")
        out = part if out is None else out.unionByName(part)
    return out.distinct()


def naming_patterns(sheet: DataFrame, obj: str, pattern: str) -> DataFrame:
    return sheet.select(cell(F.col(obj)).alias("object"), cell(F.col(pattern)).alias("pattern")).where("object <> '' and pattern <> ''").groupBy("object").agg(F.min("pattern").alias("pattern"))


def tag_convention(sheet: DataFrame, obj: str, group: str, order: str, fields: list[str]) -> DataFrame:
    """One row per object and group: its template fields in sheet order."""
    return sheet.groupBy(obj, group).agg(F.array_sort(F.collect_list(F.struct(order, *fields))).alias("fields"))
