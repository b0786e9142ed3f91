"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's own setting: shuffle files go when the query that wrote them ends, not when the driver happens to collect garbage.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir; where that is unset, a new folder if all executors are in this process, else an error."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        context = spark.sparkContext
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        at = getattr(context, "_drawloom_dir", None) or tempfile.mkdtemp(prefix="drawloom-")
        context._drawloom_dir = at
    return at.rstrip("/")


def cut(df: DataFrame, name: str, **options) -> DataFrame:
    """Write df as a Parquet table in the shared folder and read it again: short lineage, and lost executors cost no recomputation.

    The shuffle files of the query go as soon as its table is complete. options are the Parquet writer's.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(_SHUFFLES_GO, None)
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(_SHUFFLES_GO, before) if before is not None else spark.conf.unset(_SHUFFLES_GO)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


@contextmanager
def scratch() -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """cut() for tables that are deleted at the end of the block."""
    held: list[DataFrame] = []

    def keep(df: DataFrame, name: str, **options) -> DataFrame:
        held.append(cut(df, name, **options))
        return held[-1]

    try:
        yield keep
    finally:
        for t in held:
            drop(t)


def drop(df: DataFrame) -> None:
    """Delete a table made by cut() that no later plan reads."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df._cut_path)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def replace_slice(table: DataFrame, slice_of, new: DataFrame) -> DataFrame:
    """table without the rows of the slice (null is not in it), and the new ones; running it twice changes nothing."""
    from pyspark.sql import functions as F

    return table.where(~F.coalesce(slice_of, F.lit(False))).unionByName(new)


def create_table(spark: SparkSession, name: str, schema: str, partitions: list[str] | None = None) -> None:
    """A Parquet table of the catalogue from a DDL schema."""
    by = f" PARTITIONED BY ({', '.join(partitions)})" if partitions else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema}) USING parquet{by}")


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partitions: list[str] | None = None, dynamic: bool = False) -> None:
    w = df.write.mode(mode)
    if dynamic:
        w = w.option("partitionOverwriteMode", "dynamic")
    (w.partitionBy(*partitions) if partitions else w).parquet(path)


def write_lists(df: DataFrame, path: str, form: str = "json") -> None:
    """Result lists as JSON lines, or as CSV with header."""
    df.write.json(path) if form == "json" else df.write.option("header", True).csv(path)


def write_snapshot(df: DataFrame, path: str, note: str = "") -> int:
    """A further version of the table at path: a folder of its own and a row in the manifest; its number from 0."""
    spark = df.sparkSession
    version = _versions(spark, path)
    df.write.parquet(f"{path}/v{version:06d}")
    spark.createDataFrame([(version, note)], "version int, note string").coalesce(1).write.mode("append").parquet(f"{path}/manifest")
    return version


def _versions(spark: SparkSession, path: str) -> int:
    p = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/manifest")
    if not p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p):
        return 0
    return spark.read.parquet(f"{path}/manifest").count()


def history_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/manifest")


def read_as_of(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The given version, or the newest."""
    return spark.read.parquet(f"{path}/v{_versions(spark, path) - 1 if version is None else version:06d}")


def bucket(key: str, buckets: int):
    """The bucket of a row by its key, as a column; null keys have one too."""
    from pyspark.sql import functions as F

    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def write_bucketed(df: DataFrame, path: str, key: str, buckets: int, mode: str = "append") -> None:
    """df into the table at path, whose files lie in one folder per bucket of the key's hash; each task writes to few of them, and a bucket may be written by several."""
    dealt = df.withColumn("bucket", bucket(key, buckets))
    dealt.repartition("bucket", key).write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def read_buckets(spark: SparkSession, path: str, schema, touched: list[int] | None = None) -> DataFrame:
    """The table at path, empty if there is none; with `touched` only those buckets' files are listed and read."""
    from pyspark.sql.types import IntegerType, StructType

    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        return spark.createDataFrame([], schema)
    out = spark.read.schema(StructType([*(f for f in schema if f.name != "bucket")]).add("bucket", IntegerType())).parquet(path)
    return (out if touched is None else out.where(out["bucket"].isin(touched))).drop("bucket")


def _touched(batch: DataFrame, key: str, buckets: int) -> list[int]:
    """The buckets that batch has keys in: at most `buckets` numbers."""
    return sorted(r[0] for r in batch.select(bucket(key, buckets)).distinct().collect())


def append_bucketed(batch: DataFrame, path: str, key: str, buckets: int = 64, order: str | None = None) -> None:
    """Append batch's rows of keys that the table lacks (see landing.append_unseen), reading only the buckets that batch touches. Running it again adds nothing."""
    from drawloom.operators.landing import append_unseen

    known = read_buckets(batch.sparkSession, path, batch.schema, _touched(batch, key, buckets))
    write_bucketed(append_unseen(batch, known, key, order), path, key, buckets)


def replace_bucketed(path: str, key: str, new: DataFrame, gone: DataFrame, buckets: int = 64) -> None:
    """The table without the rows of the keys of gone and new, and with the rows of new; only their buckets are read and written, and running it again changes nothing.

    The buckets' new rows are written in full to the shared folder before they take the place of the old ones. A bucket of which nothing is left is
    not overwritten by Spark, so its rows go by an empty folder.
    """
    spark = new.sparkSession
    keys = new.select(key).unionByName(gone.select(key)).distinct()
    with scratch() as keep:
        keys = keep(keys, "replaced")
        touched = _touched(keys, key, buckets)
        if not touched:
            return
        old = read_buckets(spark, path, new.schema, touched)
        known = keys.withColumnRenamed(key, "_key")
        stays = old.join(known, old[key].eqNullSafe(known["_key"]), "left_anti")
        rows = keep(stays.unionByName(new), "buckets")
        write_bucketed(rows, path, key, buckets, "overwrite")
        left = {r[0] for r in rows.select(bucket(key, buckets)).distinct().collect()}
        for b in set(touched) - left:
            at = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/bucket={b}")
            at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)
