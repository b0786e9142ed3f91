"""Scans of raw files and tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scan_files(spark: SparkSession, path: str, pattern: str = "*.xml", recursive: bool = True) -> DataFrame:
    """One row per file: path, modificationTime, length, content."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", str(recursive).lower()).load(path)


def scan_table(spark: SparkSession, name_or_path: str) -> DataFrame:
    """A Parquet path (it has a slash) or a table of the catalogue, by qualified name."""
    return spark.read.parquet(name_or_path) if "/" in name_or_path else spark.table(name_or_path)


def read_list(spark: SparkSession, path: str, column: str) -> DataFrame:
    """Distinct non-blank values of `column` of a CSV with header (.csv) or of JSON lines (records, or plain strings in `value`)."""
    rows = spark.read.csv(path, header=True) if path.rstrip("/").endswith(".csv") else spark.read.json(path)
    return distinct_values(rows, column)


def distinct_values(rows: DataFrame, column: str) -> DataFrame:
    v = F.trim(F.col(column).cast("string"))
    return rows.select(v.alias(column)).where(F.coalesce(v, F.lit("")) != "").distinct()


def last_of_each(labels: DataFrame, label: str, uri: str, order: str) -> DataFrame:
    """Normalised label -> (uri, label); of labels that normalise alike the last by `order` wins."""
    from drawloom.functions.text import normal_label

    return labels.groupBy(normal_label(F.col(label)).alias("key")).agg(F.max_by(F.struct(F.col(uri).alias("uri"), F.col(label).alias("label")), F.struct(order, uri)).alias("x")).select("key", "x.uri", "x.label")
