"""Ranked lexical search the other way round: documents are streamed past the queries.

The items' terms are broadcast as an inverted index, block by block of bounded
size. A first pass over the documents counts the documents, their terms and
the documents that hold each of the items' terms; a second one streams each document's
term counts through the index, adds up its score for all items that share a
term with it, and keeps the best `k` documents of each item in a heap. The tasks'
heaps are written as a table and merged by item.
"""

from __future__ import annotations

import heapq
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from drawloom.llm.common import batch, cut, ddl, pieces, raw, scratch, table
from drawloom.llm.names import ranges

_SEPARATORS = bytes([*range(0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)])
_NULL = -(2**63)
_COUNT = pa.schema([("term", pa.int64()), ("n", pa.int64())])
_HIT = pa.schema([("row", pa.int64()), ("doc", pa.int64()), ("score", pa.int64())])
_DOCS, _TERMS = -1, -2  # what _COUNT counts besides its terms


def _table_of_bytes() -> bytes:
    t = bytearray(range(256))
    for b in _SEPARATORS:
        t[b] = 32
    for b in range(0x41, 0x5B):
        t[b] = b + 32
    return bytes(t)


#: Separators become spaces, A-Z lower case.
_PLAIN = _table_of_bytes()


def terms(text: bytes) -> list[bytes]:
    return text.translate(_PLAIN).split()


class Index:
    """Inverted index of a block of items: for each term the items that hold it."""

    def __init__(self, rows: list[int], texts: list[bytes]):
        self.rows = rows
        of: dict[bytes, list[int]] = {}
        for i, t in enumerate(texts):
            for w in dict.fromkeys(terms(t)):
                of.setdefault(w, []).append(i)
        self.n_items = len(texts)
        self.place = {w: k for k, w in enumerate(of)}
        self.edge = np.concatenate(([0], np.cumsum([len(x) for x in of.values()]))).astype(np.int64)
        self.items = np.fromiter((i for x in of.values() for i in x), np.int64, int(self.edge[-1]))


def _counts(index):
    """Documents with a term, all their terms, and the documents that hold each term of the index: one row of each per task."""

    def run(batches):
        place = index.value.place
        df = np.zeros(len(place), np.int64)
        docs = total = 0
        for b in pieces(batches, size=1 << 21):
            for t in raw(b.column("text")):
                ws = terms(t)
                docs += bool(ws)
                total += len(ws)
                held = [place[w] for w in set(ws) if w in place]
                df[held] += 1
        at = np.flatnonzero(df)
        yield batch(_COUNT, np.concatenate((at, [_DOCS, _TERMS])), np.concatenate((df[at], [docs, total])))

    return run


def _search(index, weights, n_docs, n_terms, k, cells=1 << 21):
    """The best k documents of each item among the task's, by score, then the smallest document id (null before all)."""

    def run(batches):
        x, w = index.value, weights.value
        place = x.place
        heaps: list[list[tuple[int, int]]] = [[] for _ in range(x.n_items)]
        least = np.zeros(x.n_items, np.int64)  # a full heap's lowest score
        rows = max(1, cells // max(1, x.n_items))
        for b in pieces(batches, size=1 << 20):
            ids, texts = b.column("id").to_pylist(), raw(b.column("text"))
            for a in range(0, len(ids), rows):
                doc, term, tf, norm = [], [], [], []
                for d, t in enumerate(texts[a : a + rows]):
                    ws = terms(t)
                    held: dict[int, int] = {}
                    for i in map(place.get, ws):
                        if i is not None:
                            held[i] = held.get(i, 0) + 1
                    doc += [d] * len(held)
                    term += held
                    tf += held.values()
                    norm += [10 + 90 * len(ws) * n_docs // n_terms] * len(held)
                if not doc:
                    continue
                term, tf = np.array(term, np.int64), np.array(tf, np.int64)
                gain = w[term] * (1_000_000_000 * tf // (1000 * tf + 8 * np.array(norm, np.int64)))
                n = x.edge[term + 1] - x.edge[term]
                score = np.zeros((min(rows, len(ids) - a), x.n_items), np.int64)
                np.add.at(score.reshape(-1), np.repeat(np.array(doc, np.int64) * x.n_items, n) + x.items[ranges(x.edge[term], n)], np.repeat(gain, n))
                # what ties with a full heap's lowest score may have the smaller id
                for d, i in zip(*(y.tolist() for y in np.nonzero((score >= least) & (score > 0)))):
                    one = (int(score[d, i]), -(_NULL if ids[a + d] is None else ids[a + d]))
                    if len(heaps[i]) < k:
                        heapq.heappush(heaps[i], one)
                    else:
                        heapq.heappushpop(heaps[i], one)
                    if len(heaps[i]) == k:
                        least[i] = heaps[i][0][0]
        out = [(x.rows[i], None if -d == _NULL else -d, s) for i, h in enumerate(heaps) for s, d in h]
        for a in range(0, len(out), 50_000):
            yield batch(_HIT, *zip(*out[a : a + 50_000]))

    return run


def search(items: DataFrame, docs: DataFrame, k: int = 10, item_col: str = "item_id", item_text: str = "text", id_col: str = "doc_id", text_col: str = "text", block_bytes: int = 16 << 20, block_items: int = 100_000) -> DataFrame:
    """One row per item and rank: item_id, rank, doc_id, score; documents with a score above 0 only.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased.
    Null texts have no terms; a null document id comes before all others of the same score.
    Each row of either table counts for itself, repeated or not, so an item that stands twice
    has its ranks twice. Without items, or documents with terms, there are no rows. Extra columns
    are not carried. Items go to blocks by hash, of block_bytes and block_items in the mean;
    each block is an index that is broadcast, and reads the documents twice.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    with scratch() as keep:
        # a table, so that a row keeps its number
        rows = keep(items.select(F.col(f"`{item_col}`").alias("item_id"), F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("text"), F.monotonically_increasing_id().alias("row")), "items")
        n, size = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
        blocks = max(1, -(-n // block_items), -(-size // block_bytes))
        found = []
        for b in range(blocks):
            block = rows.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == b).orderBy("row").collect()
            if not block:
                continue
            index = Index([r["row"] for r in block], [r["text"].encode() for r in block])
            held = spark.sparkContext.broadcast(index)
            counted = {r["term"]: r["n"] for r in docs.select("text").mapInArrow(_counts(held), ddl(_COUNT)).groupBy("term").agg(F.sum("n").alias("n")).collect()}
            n_docs, n_terms = counted.get(_DOCS, 0), counted.get(_TERMS, 0)
            if not n_docs:
                continue
            weights = [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * counted.get(t, 0) + 1))) for t in range(len(index.place))]
            weights = spark.sparkContext.broadcast(np.array(weights, np.int64))
            hits = keep(docs.mapInArrow(_search(held, weights, n_docs, n_terms, k), ddl(_HIT)), "heaps")
            # the table's files are read several to a task, where the window first keeps k rows of each item
            found.append(keep(_best(hits, "row", k), "block-ranks"))
            held.unpersist()
            weights.unpersist()
        return cut(_all(spark, found).join(rows, "row").select("item_id", "rank", F.col("doc").alias(id_col), "score"), "ranks")


def _best(hits: DataFrame, by: str, k: int) -> DataFrame:
    w = Window.partitionBy(by).orderBy(F.desc("score"), F.asc_nulls_first("doc"))
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _all(spark: SparkSession, found: list[DataFrame]) -> DataFrame:
    out = spark.createDataFrame([], "row long, doc long, score long, rank int")
    for f in found:
        out = out.unionByName(f)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op13: the ten best documents of each benchmark item."""
    return search(table(spark, sf_dir, "benchmark"), table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws, row_number() OVER () AS r FROM documents
), dn AS (SELECT r, doc_id, len(ws) AS n, ws FROM d WHERE len(ws) > 0
), s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM dn
), i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS w FROM benchmark
), t AS (SELECT r, w, count(*) AS tf FROM (SELECT r, unnest(ws) AS w FROM dn) WHERE w IN (SELECT w FROM i) GROUP BY r, w
), g AS (SELECT w, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, s GROUP BY w, docs
), p AS (
  SELECT item_id, r, CAST(sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total)))) AS BIGINT) AS score
  FROM t JOIN dn USING (r) JOIN g USING (w) JOIN i USING (w), s GROUP BY item_id, r
), k AS (SELECT item_id, doc_id, score, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INT) AS rank FROM p JOIN dn USING (r) WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10
"""
