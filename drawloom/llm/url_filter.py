"""Exact URL filtering by a cascade of Bloom filters.

Level 0 holds the listed keys; level 1 the unlisted keys of the corpus that
level 0 passes by mistake; level 2 the listed keys that level 1 passes by
mistake; and so on until a level passes none. Over the keys it was built on, the
complete universe of the corpus, the cascade answers exactly. Spark builds each
level: false positives are found in parallel and bits are combined before and
after the shuffle.

Filters that would be over `most_bytes` are built in shards by the hash of the
key, each of about `shard_bytes`. One shard is collected and broadcast, and rows are judged as they are
scanned. Of several shards none goes to the driver: their words are sent to the
tasks that rows are dealt to by shard (and by a salt, so that a frequent URL is
spread), where they come first, and the rows stream past them.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from drawloom.llm.common import ascii_lower, batch, cut, ddl, scratch, table
from drawloom.llm.names import mix

_WORD = pa.schema([("shard", pa.int32()), ("word", pa.int64()), ("bits", pa.int64())])
_SALTS = 16
_ABOUT = r"(?s)^.*?://([^/?#]*)([^?#]*)"

#: Rules as verdict and host/path.
RULES = [("block", "com/en/"), ("allow", "example.com/en/7"), ("allow", "net/de/"), ("block", "example.net/de/8"), ("block", "org/es/")]


def host_of(url: Column) -> Column:
    """From after the first :// to / ? # or the end, A-Z lower-cased; else empty."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _ABOUT, 1), F.lit("")))


def path_of(url: Column) -> Column:
    """From after the host to ? # or the end; empty without ://."""
    return F.coalesce(F.regexp_extract(url, _ABOUT, 2), F.lit(""))


def longest_rule(host: Column, path: Column, rules: list[tuple[str, str]], what: str = "rule") -> Column:
    """The rule (or its verdict) of greatest length whose host is the url's or above it and whose path starts the url's; else null."""
    out = F.lit(None).cast("string")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        h, slash, p = rule.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        out = F.when(fits, F.lit(rule if what == "rule" else verdict)).otherwise(out)
    return out


def _at(h1: np.ndarray, h2: np.ndarray, level: int, bits: int, hashes: int) -> np.ndarray:
    """Bit numbers of each key in a level; every level hashes anew."""
    a = mix(h1, np.full(len(h1), level + 1, np.uint64))
    b = mix(h2, np.full(len(h2), level + 1, np.uint64)) | np.uint64(1)
    return ((a[:, None] + b[:, None] * np.arange(hashes, dtype=np.uint64)[None, :]) % np.uint64(bits)).astype(np.int64)


def _passes(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).all(axis=1)


def _uint(c) -> np.ndarray:
    return np.asarray(c, np.int64).view(np.uint64)


def _encode(level, bits, hashes):
    def run(batches):
        for b in batches:
            shards = b.column("shard").to_numpy()
            h1, h2 = _uint(b.column("h1")), _uint(b.column("h2"))
            for shard in np.unique(shards):
                mine = shards == shard
                at = np.unique(_at(h1[mine], h2[mine], level, bits, hashes))
                word, first = np.unique(at >> 6, return_index=True)
                set_bits = np.bitwise_or.reduceat(np.uint64(1) << (at & 63).astype(np.uint64), first)
                yield batch(_WORD, np.full(len(word), shard, np.int32), word, set_bits.view(np.int64))

    return run


class Cascade:
    """levels: (number, bits, hashes, words) of each; keys it was built on are judged exactly."""

    def __init__(self, levels: list[tuple[int, int, int, np.ndarray]]):
        self.levels = levels

    def listed(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        out = np.full(len(h1), len(self.levels) % 2 == 1)
        left = np.arange(len(h1))
        for k, (number, bits, hashes, words) in enumerate(self.levels):
            ok = _passes(words, _at(h1[left], h2[left], number, bits, hashes))
            out[left[~ok]] = k % 2 == 1
            left = left[ok]
        return out


class Filters:
    """The levels of all shards: (number, bits, hashes, words), words in the driver if there is one shard, else a table (shard, word, bits)."""

    def __init__(self, shards: int):
        self.shards, self.levels = shards, []

    def shard_of(self, h2: Column) -> Column:
        return F.pmod(F.xxhash64(h2), F.lit(self.shards)).cast("int")

    def add(self, number: int, bits: int, hashes: int, words: DataFrame) -> None:
        if self.shards == 1:
            found = words.toArrow()  # at most most_bytes, as the shard's size says
            held = np.zeros((bits >> 6) + 1, np.uint64)
            held[found.column("word").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
            words = held
        self.levels.append((number, bits, hashes, words))

    def judged(self, rows: DataFrame, levels: list) -> DataFrame:
        """rows with a boolean column listed, by the given levels; rows has h1 and h2."""
        if self.shards == 1:
            held = rows.sparkSession.sparkContext.broadcast(levels)

            @F.pandas_udf("boolean")
            def test(h1: pd.Series, h2: pd.Series) -> pd.Series:
                return pd.Series(Cascade(held.value).listed(_uint(h1), _uint(h2)))

            return rows.withColumn("listed", test("h1", "h2"))
        row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
        rows = rows.select(self.shard_of(F.col("h2")).alias("shard"), F.pmod(F.xxhash64(row), F.lit(_SALTS)).cast("int").alias("salt"), F.lit(-1).alias("level"), F.col("h1").alias("a"), F.col("h2").alias("b"), row.alias("row"))
        salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1)))
        every = rows
        for k, (_, _, _, words) in enumerate(levels):
            every = every.unionByName(words.select("shard", salts.alias("salt"), F.lit(k).alias("level"), F.col("word").alias("a"), F.col("bits").alias("b"), F.lit(None).cast(rows.schema["row"].dataType).alias("row")))
        every = every.repartition("shard", "salt").sortWithinPartitions("shard", "salt", F.desc("level"))
        out = StructType([StructField("row", rows.schema["row"].dataType), StructField("listed", BooleanType())])
        return every.mapInArrow(_stream([x[:3] for x in levels]), out).select("row.*", "listed")


def _stream(levels: list[tuple[int, int, int]]):
    """Words of all levels of a shard, then its rows (level -1), then the next shard."""

    def run(batches):
        last, cascade = None, None
        for b in batches:
            shard, salt, level = (b.column(c).to_numpy() for c in ("shard", "salt", "level"))
            change = np.flatnonzero((np.diff(shard) != 0) | (np.diff(salt) != 0) | (np.diff(level) != 0)) + 1
            edges = [0, *change.tolist(), b.num_rows] if b.num_rows else []
            for i, j in zip(edges, edges[1:]):
                if (shard[i], salt[i]) != last:
                    last = (shard[i], salt[i])
                    cascade = Cascade([(number, bits, hashes, np.zeros((bits >> 6) + 1, np.uint64)) for number, bits, hashes in levels])
                x, y = (_uint(b.column(c).slice(i, j - i)) for c in ("a", "b"))
                if level[i] >= 0:
                    cascade.levels[level[i]][3][x.astype(np.int64)] = y
                else:
                    yield pa.RecordBatch.from_arrays([b.column("row").slice(i, j - i), pa.array(cascade.listed(x, y))], ["row", "listed"])

    return run


def build_filters(keys: DataFrame, keep, rate: float = 0.02, most_bytes: int = 64 << 20, shard_bytes: int = 4 << 20) -> Filters:
    """The cascade over the columns h1, h2 (hashes of the key) and listed (boolean) of distinct keys."""
    hashes = max(1, round(-math.log2(rate)))
    each = hashes / math.log(2)
    n_in, n_out = keys.agg(F.count_if("listed"), F.count_if(~F.col("listed"))).first()
    size = math.ceil(1.2 * (n_in + rate * n_out) * each / 8)
    filters = Filters(1 if size <= most_bytes else math.ceil(size / shard_bytes))
    keys = keys.withColumn("shard", filters.shard_of(F.col("h2")))
    inside, outside = keys.where("listed").select("h1", "h2", "shard"), keys.where("not listed").select("h1", "h2", "shard")
    while True:
        most = inside.groupBy("shard").count().agg(F.max("count")).first()[0]
        if not most:
            return filters
        k, bits = len(filters.levels), max(64, math.ceil(most * each))
        words = inside.mapInArrow(_encode(k, bits, hashes), ddl(_WORD)).groupBy("shard", "word").agg(F.bit_or("bits").alias("bits"))
        filters.add(k, bits, hashes, keep(words, "words"))
        wrong = keep(filters.judged(outside, filters.levels[-1:]).where("listed").drop("listed"), "false-positives")
        inside, outside = wrong, inside


def judge(
    pages: DataFrame, listed_keys: DataFrame, rules: list[tuple[str, str]] = RULES, id_col: str = "page_id", url_col: str = "url", most_bytes: int = 64 << 20, shard_bytes: int = 4 << 20,
) -> DataFrame:
    """One row per input row: id, host, path, rule, verdict.

    listed_keys: columns host, path, listed for every key of the pages (null
    listed: false; a key is listed if one of its rows is). A rule's verdict goes
    before the list's. Null urls and urls without :// have empty host and path
    and are one key. Repeated rows are judged each; extra columns are not carried.
    """
    h = lambda host, path: (F.xxhash64(host, path), F.xxhash64(F.lit(7), path, host))
    k1, k2 = h(F.col("host"), F.col("path"))
    with scratch() as keep:
        keys = listed_keys.select(k1.alias("h1"), k2.alias("h2"), F.coalesce("listed", F.lit(False)).alias("listed")).groupBy("h1", "h2").agg(F.bool_or("listed").alias("listed"))
        filters = build_filters(keep(keys, "keys"), keep, most_bytes=most_bytes, shard_bytes=shard_bytes)
        if filters.shards > 1:  # their words are read when the result is
            filters.levels = [(*x[:3], cut(x[3], "filter")) for x in filters.levels]
    url = F.col(f"`{url_col}`").cast("string")
    rows = pages.select(F.col(f"`{id_col}`").alias("id"), host_of(url).alias("host"), path_of(url).alias("path"))
    rows = filters.judged(rows.select("id", "host", "path", k1.alias("h1"), k2.alias("h2")), filters.levels)
    own = F.when(F.col("listed"), F.lit("block")).otherwise(F.lit("allow"))
    rule, verdict = (longest_rule(F.col("host"), F.col("path"), rules, w) for w in ("rule", "verdict"))
    return rows.select(F.col("id").alias(id_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"))


def thin_keys(pages: DataFrame, thin: int = 1000) -> DataFrame:
    """The keys of all pages; listed are those of which a page has under `thin` characters of HTML (null: none)."""
    return pages.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), (F.coalesce(F.char_length("html"), F.lit(0)) < thin).alias("listed"))


def query(spark, sf_dir: str) -> DataFrame:
    """op4: see judge; listed are the keys of thin pages."""
    pages = table(spark, sf_dir, "pages")
    return judge(pages, thin_keys(pages))


def _sql_rules() -> tuple[str, str]:
    rule, verdict = "", ""
    for v, r in sorted(RULES, key=lambda x: -len(x[1])):
        h, slash, p = r.partition("/")
        fits = f"(host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{slash}{p}')"
        rule += f" WHEN {fits} THEN '{r}'"
        verdict += f" WHEN {fits} THEN '{v}'"
    return rule, verdict


ORACLE = """
WITH p AS (
  SELECT page_id, html,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), l AS (SELECT host, path, bool_or(coalesce(length(html), 0) < 1000) AS listed FROM p GROUP BY host, path)
SELECT page_id, p.host, p.path, CASE{rule} END AS rule,
  coalesce(CASE{verdict} END, CASE WHEN listed THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT page_id, host, path FROM p) p JOIN l USING (host, path)
""".replace("{rule}", _sql_rules()[0]).replace("{verdict}", _sql_rules()[1])
