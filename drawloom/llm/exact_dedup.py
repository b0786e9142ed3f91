"""Exact deduplication by content-defined chunk recipes.

A text is cut where the hash of the 32 bytes before a place has its low bits
zero, so equal texts have equal chunks. Each row first becomes a short recipe,
the ordered list of its chunks' fingerprints; only rows whose recipe occurs
again send chunk bytes, once per distinct chunk and task, to verify that each
fingerprint stands for one content. Where it doesn't, the chunk's bytes join its
identifier. Texts are equal exactly if their lists of verified identifiers are.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawloom.llm.common import batch, cut, ddl, keyed, pieces, raw, table
from drawloom.llm.names import doubled, eights, joined

_RECIPE = pa.schema([("id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("digest", pa.string()), ("chunks", pa.list_(pa.binary()))])
_CHUNK = pa.schema([("fp", pa.binary()), ("bytes", pa.binary())])
_EXACT = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("at", pa.int64()), ("fp", pa.binary()), ("bytes", pa.binary())])


def _cuts(texts: list[bytes], bits: int, longest: int) -> list[list[bytes]]:
    """Chunks of each text: about 2**bits bytes on average, none over `longest`."""
    buf, starts, lens = joined(texts)
    x = doubled(doubled(eights(buf), 8), 16)
    marks = np.flatnonzero((x & np.uint64((1 << bits) - 1)) == 0) + 32
    out = []
    for t, s, n in zip(texts, starts.tolist(), lens.tolist()):
        a, z = np.searchsorted(marks, (s + 32, s + n))
        edges, last = [0], 0
        for m in [*(marks[a:z] - s).tolist(), n]:
            while m - last > longest:
                last += longest
                edges.append(last)
            if m > last:
                edges.append(m)
                last = m
        out.append([t[i:j] for i, j in zip(edges, edges[1:])])
    return out


def _fingerprint(chunk: bytes, size: int) -> bytes:
    return hashlib.blake2b(chunk, digest_size=size).digest()


def _recipes(bits, longest, size):
    def run(batches):
        for b in pieces(batches, size=1 << 19):
            texts = [t.lower() for t in raw(b.column("text"))]  # bytes.lower() changes A-Z only
            chunks = [[_fingerprint(c, size) for c in cs] for cs in _cuts(texts, bits, longest)]
            yield batch(_RECIPE, b.column("id"), b.column("k1"), b.column("k2"), [hashlib.sha256(t).hexdigest() for t in texts], chunks)

    return run


def _chunks(bits, longest, size):
    def run(batches):
        for b in pieces(batches, size=1 << 19):
            seen = {}
            for cs in _cuts([t.lower() for t in raw(b.column("text"))], bits, longest):
                seen.update(((_fingerprint(c, size), c), None) for c in cs)
            yield batch(_CHUNK, [x[0] for x in seen], [x[1] for x in seen])

    return run


def _placed(bits, longest, size):
    def run(batches):
        for b in pieces(batches, size=1 << 19):
            cut_texts = _cuts([t.lower() for t in raw(b.column("text"))], bits, longest)
            rows = [(k1, k2, i, _fingerprint(c, size), c) for k1, k2, cs in zip(b.column("k1").to_pylist(), b.column("k2").to_pylist(), cut_texts) for i, c in enumerate(cs)]
            yield batch(_EXACT, *(zip(*rows) if rows else [[]] * 5))

    return run


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", bits: int = 11, longest: int = 1 << 16, fingerprint_bytes: int = 16) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256, and the row key k1, k2.

    Texts are equal if identical after lower-casing A-Z only; null counts as
    empty. Of equal texts the row with the largest id stays (null ids are the
    smallest; of rows that share the largest id, one stays). Extra columns are
    not carried.
    """
    docs = keyed(df, id_col, text_col)
    how = (bits, longest, fingerprint_bytes)
    rows = cut(docs.mapInArrow(_recipes(*how), ddl(_RECIPE)).withColumn("rid", F.monotonically_increasing_id()), "recipes")
    # tables of their own, so that joining them back can split a frequent recipe's rows
    again = cut(rows.groupBy("chunks").agg(F.count("*").alias("n")).where("n > 1").select("chunks"), "again")
    doubtful = rows.join(again, "chunks", "left_semi").select("k1", "k2").distinct()
    texts = docs.join(doubtful, ["k1", "k2"], "left_semi").select("k1", "k2", "text")
    kinds = texts.mapInArrow(_chunks(*how), ddl(_CHUNK)).distinct().groupBy("fp").agg(F.count("*").alias("n"))
    clash = cut(kinds.where("n > 1").select("fp"), "clashes")
    recipes = rows.withColumnRenamed("chunks", "recipe")
    if not clash.isEmpty():
        exact = texts.dropDuplicates(["k1", "k2"]).mapInArrow(_placed(*how), ddl(_EXACT)).join(clash.withColumn("bad", F.lit(True)), "fp", "left")
        ident = F.when(F.col("bad"), F.concat("fp", "bytes")).otherwise(F.col("fp"))
        lists = exact.groupBy("k1", "k2").agg(F.array_sort(F.collect_list(F.struct("at", ident.alias("ident")))).alias("x"))
        lists = lists.select("k1", "k2", F.col("x.ident").alias("exact"))
        recipes = recipes.join(lists, ["k1", "k2"], "left").withColumn("recipe", F.coalesce("exact", "recipe"))
    groups = recipes.groupBy("recipe").agg(F.count("*").alias("group_size"), F.max(F.struct("id", "rid")).alias("stays"))
    groups = cut(groups, "groups")
    out = recipes.join(groups, "recipe")
    return out.select(
        F.col("id").alias(id_col), F.col("stays.id").alias("keep_id"), "group_size",
        (F.col("rid") == F.col("stays.rid")).alias("kept"), F.col("digest").alias("text_sha256"), "k1", "k2",
    )


def drop_exact_copies(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all columns. Rows that repeat both id and text count as one."""
    stay = exact_groups(df, id_col, text_col).where("kept").select(F.col("k1").alias("_x_k1"), F.col("k2").alias("_x_k2"))
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    marked = df.withColumns({"_x_k1": F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(-(2**63))), "_x_k2": F.xxhash64(text)})
    return marked.join(stay, ["_x_k1", "_x_k2"], "left_semi").dropDuplicates(["_x_k1", "_x_k2"]).select(*[F.col(f"`{c}`") for c in df.columns])


def query(spark, sf_dir: str) -> DataFrame:
    """op10: see exact_groups."""
    return exact_groups(table(spark, sf_dir, "documents")).drop("k1", "k2")


ORACLE = """
WITH n AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM n JOIN g ON n.t = g.t
"""
