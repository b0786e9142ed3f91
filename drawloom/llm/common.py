"""What the operators of this subpackage share: row keys and batch helpers."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from drawloom.tables import cut, drop, scratch, shared_dir

__all__ = ["ascii_lower", "batch", "cut", "ddl", "drop", "fresh_names", "keyed", "once", "pieces", "raw", "scratch", "shared_dir", "table", "with_key"]


def keyed(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Columns id, text (null: empty) and the row key (k1, k2).

    The key is the id (nulls as one value) with a hash of the text, so that
    repeated ids with different texts stay apart; rows that agree in both are
    alike in every result. All other columns are left out, so no name clashes.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    d = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), text.alias("text"))
    return d.select("id", "text", F.coalesce("id", F.lit(-(2**63))).alias("k1"), F.xxhash64("text").alias("k2"))


def fresh_names(df: DataFrame, n: int) -> list[str]:
    """n column names that df does not have, in whatever case."""
    taken = {c.lower() for c in df.columns}
    return [x for x in (f"key_{i}" for i in range(len(taken) + n)) if x not in taken][:n]


def with_key(df: DataFrame, id_col: str, text_col: str, k1: str, k2: str) -> DataFrame:
    """df with the row key of keyed() in the columns k1 and k2."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return df.withColumns({k1: F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(2**63))), k2: F.xxhash64(text)})


def pieces(batches: Iterator[pa.RecordBatch], col: str = "text", size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about `size` bytes of column col, which keeps numpy temporaries small."""
    for b in batches:
        if not b.num_rows:
            continue
        lens = pc.fill_null(pc.binary_length(b.column(col)), 0).to_numpy(zero_copy_only=False)
        part = np.cumsum(lens, dtype=np.int64) // size
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), b.num_rows]
        for i, j in zip(edges, edges[1:]):
            yield b.slice(i, j - i)


def once(key, make: Callable):
    """make(), called once in each Python process. Functions reach the workers by value, so a module's own globals would be new in each task."""
    held = sys.modules.setdefault("_drawloom_process", types.ModuleType("_drawloom_process")).__dict__.setdefault("made", {})
    if key not in held:
        held[key] = make()
    return held[key]


def raw(column: pa.Array) -> list[bytes]:
    """The values of a string or binary column as bytes, null as empty."""
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t.type) for c, t in zip(columns, schema)], schema=schema)


def ddl(schema: pa.Schema) -> str:
    """The same schema for Spark."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in from_arrow_schema(schema))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
