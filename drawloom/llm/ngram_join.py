"""Similarity self-join on five-word shingles by chosen paths.

Each set chooses, in each of several runs, those of its shingles whose hash for
that run is below 1 / (threshold * size), so sets that are alike choose shared
ones. Rows that chose the same shingle form a bucket; buckets over `small` rows
split again, up to `depth` times, on sampled coordinates of the rows' min-hash
sketches. A pair as similar as the threshold survives a level with the
probability of a critical branching process; the number of runs follows from
that and the target recall. Frequent shingles need no special care: a bucket
grows only by sets that chose the shingle, that is with 1 / size.

A pair belongs to the first of the buckets that both its sets are in, so it is looked at
in one bucket only, whatever the number of runs. There the sketches are
compared first; sets that have a possible partner send their shingles to the
bucket, where those pairs are compared exactly. A bucket that exceeds a block (of a bounded
number of sets and of shingles) is compared block by block, so that no task holds
an unbounded one. Sets that are equal are one representative with a
size, so copies are never expanded. Pairs never leave a task: it gives for each
member the number of documents linked to it there and one edge of a spanning forest.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawloom.llm.common import batch, cut, ddl, fresh_names, keyed, pieces, raw, scratch, table, with_key
from drawloom.llm.names import mix, word_names
from drawloom.operators.graph import connected_components

WORDS = 5
_ODD = 0x9E3779B97F4A7C15
COORDINATES = 64
_SET = pa.schema([
    ("id", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64()), ("n", pa.int32()), ("f1", pa.int64()), ("f2", pa.int64()), ("paths", pa.list_(pa.int64())), ("sketch", pa.binary()),
])
_TOKENS = pa.schema([("c", pa.int64()), ("tokens", pa.list_(pa.int64()))])
_PATH = pa.schema([("c", pa.int64()), ("p", pa.int64()), ("sketch", pa.binary())])
_NEAR = pa.schema([("p", pa.int64()), ("c", pa.int64())])
_LINK = pa.schema([("c", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])


def runs_for(recall: float, depth: int) -> int:
    """Runs after which a pair at the threshold is found with probability `recall` even if all `depth` levels are needed."""
    q = 1.0
    for _ in range(depth):
        q = 1 - math.exp(-q)
    return math.ceil(math.log(1 - recall) / math.log(1 - q))


def shingle_sets(texts: list[bytes], words: int = WORDS) -> list[np.ndarray]:
    """Sorted distinct 64-bit names of the runs of `words` words of each text.

    Words are runs of bytes other than white space, with A-Z lower-cased. A text
    of fewer words is one shingle, one without words has none.
    """
    names, edge, counts = word_names([t.lower() for t in texts])
    if not len(names):
        return [names for _ in texts]
    grams = names
    for k in range(1, words):
        grams = mix(grams[:-1], names[k:]) if len(names) > k else grams[:0]
    out = []
    for e, n in zip(edge.tolist(), counts.tolist()):
        if n >= words:
            out.append(np.unique(grams[e : e + n - words + 1]))
        elif n:
            x = names[e : e + 1] ^ np.uint64(n)
            for k in range(1, n):
                x = mix(x, names[e + k : e + k + 1])
            out.append(x)
        else:
            out.append(names[:0])
    return out


def _sets(words, threshold, runs):
    seeds = mix(np.arange(runs, dtype=np.uint64), np.full(runs, 5, np.uint64))
    odd = (seeds | np.uint64(1))[:, None]
    spread = (mix(np.arange(COORDINATES, dtype=np.uint64), np.full(COORDINATES, 6, np.uint64)) | np.uint64(1))[:, None]

    def least(s: np.ndarray) -> bytes:
        """16 bits of each coordinate's least hash."""
        out = np.full(COORDINATES, 2**64 - 1, np.uint64)
        for a in range(0, len(s), 512):
            np.minimum(out, (s[None, a : a + 512] * spread).min(axis=1), out=out)
        return (mix(out, out) >> np.uint64(48)).astype(np.uint16).tobytes()

    def run(batches):
        for b in pieces(batches, size=1 << 19):
            sets = shingle_sets(raw(b.column("text")), words)
            n, f1, f2, paths, sketches = [], [], [], [], []
            for s in sets:
                n.append(len(s))
                y = mix(s, s)
                f1.append(int(np.add.reduce(y).astype(np.int64)))
                f2.append(int(np.bitwise_xor.reduce(y * np.uint64(_ODD)).astype(np.int64)) if len(s) else 0)
                sketches.append(least(s))
                if len(s):
                    limit = min(2**64 - 1, int(2**64 / (threshold * len(s))))
                    r, t = np.nonzero(s[None, :] * odd < np.uint64(limit))
                    paths.append(mix(s[t], seeds[r]).view(np.int64))
                else:
                    paths.append(np.empty(0, np.int64))
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(p) for p in paths]))).astype(np.int32))
            lists = pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(paths)))
            yield batch(_SET, b.column("id"), b.column("k1"), b.column("k2"), np.array(n, np.int32), f1, f2, lists, sketches)

    return run


def _tokens(words):
    def run(batches):
        for b in pieces(batches, size=1 << 19):
            sets = shingle_sets(raw(b.column("text")), words)
            offsets = pa.array(np.concatenate(([0], np.cumsum([len(s) for s in sets]))).astype(np.int32))
            yield batch(_TOKENS, b.column("c"), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(sets).view(np.int64))))

    return run


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, COORDINATES)


def _deeper(threshold):
    """Each path goes on with each coordinate of probability 1 / (threshold * COORDINATES), and the value there."""
    limit = np.uint64(int(2**64 / (threshold * COORDINATES)))
    every = np.arange(COORDINATES, dtype=np.uint64)

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            p = b.column("p").to_numpy().view(np.uint64)
            row, i = np.nonzero(mix(p[:, None], every[None, :]) < limit)
            value = _sketches(b.column("sketch"))[row, i].astype(np.uint64)
            new = mix(p[row], (i.astype(np.uint64) << np.uint64(16)) + value)
            yield batch(_PATH, b.column("c").to_numpy()[row], new.view(np.int64), b.column("sketch").take(pa.array(row)))

    return run


def _grouped(batches, keys, columns):
    """Lists of rows with equal keys, which come one after another."""
    held, last = [], None
    for b in batches:
        for key, row in zip(zip(*(b.column(k).to_pylist() for k in keys)), zip(*(columns[c](b.column(c)) for c in columns))):
            if key != last:
                if len(held) > 1:
                    yield last, held
                held, last = [], key
            held.append(row)
    if len(held) > 1:
        yield last, held


def _forest(n: int, i: np.ndarray, j: np.ndarray) -> list[int]:
    """The root of each of n members after joining the pairs."""
    root = list(range(n))

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, z in zip(i.tolist(), j.tolist()):
        a, z = find(a), find(z)
        if a != z:
            root[max(a, z)] = min(a, z)
    return [find(x) for x in range(n)]


def _lists(column: pa.Array) -> list[np.ndarray]:
    flat, off = column.values.to_numpy(), column.offsets.to_numpy()
    return [flat[a:z].copy() for a, z in zip(off, off[1:])]


def _here(p: int, paths: list[np.ndarray], side: np.ndarray) -> np.ndarray:
    """Which pairs (row before column) belong to bucket p: no smaller path is common to both, and where there are two blocks they are of different ones."""
    k = len(paths)
    if k == 2:
        a, z = (x[x < p] for x in paths)
        return np.array([[False, not np.isin(a, z).any()], [False, False]])
    out = np.triu(np.ones((k, k), bool), 1)
    if side.any() and not side.all():
        out &= side[:, None] != side[None, :]
    every = np.concatenate(paths)
    row = np.repeat(np.arange(k), [len(x) for x in paths])
    smaller = every < p
    _, column, times = np.unique(every[smaller], return_inverse=True, return_counts=True)
    again = times[column] > 1
    row, column = row[smaller][again], column[again]
    if len(row):
        _, column = np.unique(column, return_inverse=True)
        for a in range(0, int(column.max()) + 1, 1024):
            m = np.zeros((k, 1024), np.float32)
            mine = (column >= a) & (column < a + 1024)
            m[row[mine], column[mine] - a] = 1
            out &= m @ m.T == 0
    return out


def _candidates(threshold, slack):
    """The members (p, c) of each bucket that have a pair there whose sketches and sizes allow the threshold."""
    least = math.ceil((threshold - slack) * COORDINATES)

    def run(batches):
        out = []
        columns = {"c": pa.Array.to_pylist, "n": pa.Array.to_pylist, "sketch": _sketches, "paths": _lists, "side": pa.Array.to_pylist}
        for (p, _, _), rows in _grouped(batches, ("p", "b1", "b2"), columns):
            c, n, side = [r[0] for r in rows], np.array([r[1] for r in rows]), np.array([r[4] for r in rows])
            ok = _here(p, [r[3] for r in rows], side)
            ok &= np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :]) - 1
            s = np.stack([r[2] for r in rows])
            for a in range(0, len(c), 64):
                ok[a : a + 64] &= (s[a : a + 64, None, :] == s[None, :, :]).sum(2) >= least
            out += [(p, c[k]) for k in np.flatnonzero(ok.any(0) | ok.any(1)).tolist()]
            if len(out) > 5000:
                yield batch(_NEAR, *zip(*out))
                out = []
        if out:
            yield batch(_NEAR, *zip(*out))

    return run


def _shared_tokens(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections."""
    k = len(sets)
    every = np.concatenate(sets)
    order = np.argsort(every, kind="stable")
    v = every[order]
    row = np.repeat(np.arange(k), [len(s) for s in sets])[order]
    same = v[1:] == v[:-1]
    often = np.concatenate((same, [False])) | np.concatenate(([False], same))
    v, row = v[often], row[often]
    out = np.zeros((k, k), np.float32)
    if len(v):
        column = np.concatenate(([0], np.cumsum(v[1:] != v[:-1])))
        width = 1024
        for a in range(0, int(column[-1]) + 1, width):
            i, j = np.searchsorted(column, (a, a + width))
            m = np.zeros((k, min(width, int(column[-1]) + 1 - a)), np.float32)
            m[row[i:j], column[i:j] - a] = 1
            out += m @ m.T
    np.fill_diagonal(out, [len(s) for s in sets])
    return out


def _compare(threshold):
    """Links of each member of a bucket (or of two blocks of one), and edges of a spanning forest."""

    def run(batches):
        out = []
        columns = {"c": pa.Array.to_pylist, "size": pa.Array.to_pylist, "tokens": _lists, "paths": _lists, "side": pa.Array.to_pylist}
        for (p, _, _), rows in _grouped(batches, ("p", "b1", "b2"), columns):
            c, sets = [r[0] for r in rows], [r[2] for r in rows]
            size, side = np.array([r[1] for r in rows], np.int64), np.array([r[4] for r in rows])
            n = np.array([len(s) for s in sets], np.int64)
            i, j = np.nonzero(_here(p, [r[3] for r in rows], side))
            if not len(i):
                continue
            both = np.array([np.isin(sets[0], sets[1], assume_unique=True).sum()]) if len(c) == 2 else np.rint(_shared_tokens(sets)[i, j]).astype(np.int64)
            ok = both / (n[i] + n[j] - both) >= threshold
            i, j = i[ok], j[ok]
            links = np.bincount(i, size[j], len(c)) + np.bincount(j, size[i], len(c))
            out += [(c[k], int(links[k]), c[x]) for k, x in enumerate(_forest(len(c), i, j)) if links[k]]
            if len(out) > 5000:
                yield batch(_LINK, *zip(*out))
                out = []
        if out:
            yield batch(_LINK, *zip(*out))

    return run


def _counted(members: DataFrame, keep) -> DataFrame:
    """Buckets of at least two members: p, their number, and two checksums of the members; a table of its own, so that joining it back can split a large bucket."""
    return keep(members.groupBy("p").agg(F.count("*").alias("m"), F.bit_xor(F.xxhash64("c")).alias("x1"), F.bit_xor(F.xxhash64("c", F.lit(1))).alias("x2")).where("m > 1"), "buckets")


def _placed(rows: DataFrame, block: int, keep) -> DataFrame:
    """Rows (p, c, n, ...) of a bucket over one block once for each pair of blocks (b1 <= b2) that theirs is in; side: 1 in the second of two.

    A block is `block` rows, fewer where sets are so large that these would have over 1000 * block shingles.
    """
    sizes = rows.groupBy("p").agg(F.count("*").alias("m"), F.max("n").alias("most"))
    limit = F.greatest(F.lit(1), F.least(F.lit(block), F.floor(F.lit(1000 * block) / F.col("most"))))
    rows = rows.join(keep(sizes.select("p", F.ceil(F.col("m") / limit).cast("int").alias("blocks")), "sizes"), "p")
    mine = F.pmod(F.xxhash64("c"), "blocks").cast("int")
    placed = rows.withColumn("mine", mine).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    b1, b2 = F.least("mine", "other"), F.greatest("mine", "other")
    placed = placed.withColumns({"b1": b1, "b2": b2, "side": ((b1 != b2) & (F.col("mine") == b2)).cast("int")}).drop("mine", "other", "blocks")
    return placed.repartition("p", "b1", "b2").sortWithinPartitions("p", "b1", "b2")


def _classes(docs: DataFrame, threshold: float, words: int, recall: float, small: int, depth: int, block: int, slack: float) -> DataFrame:
    """docs (from keyed()) with n (set size), class_id, n_links, and stays: whether the row's key is that of its class's first row."""
    with scratch() as keep:
        rows = keep(docs.mapInArrow(_sets(words, threshold, runs_for(recall, depth)), ddl(_SET)), "sets")
        first = F.min(F.struct(F.col("id").isNull().alias("no_id"), "k1", "k2"))
        kind = rows.where("n > 0").groupBy("n", "f1", "f2").agg(F.count("*").alias("size"), F.min("id").alias("least_id"), first.alias("first"), F.min(F.struct("k1", "k2", "paths", "sketch")).alias("r"))
        kind = keep(kind.select("n", "f1", "f2", "size", "least_id", "first", "r.*").withColumn("c", F.monotonically_increasing_id()), "kinds")

        level = kind.select("c", F.explode(F.array_distinct("paths")).alias("p"), "sketch")
        leaves = []
        for d in range(1, depth + 1):
            counted = _counted(level, keep)
            level = level.join(counted, "p")
            leaves.append(level if d == depth else level.where(F.col("m") <= small))
            if d < depth:
                deeper = level.where(F.col("m") > small).select("c", "p", "sketch").mapInArrow(_deeper(threshold), ddl(_PATH))
                level = keep(deeper.dropDuplicates(["c", "p"]), "paths")
        found = leaves[0].select("c", "p", "m", "x1", "x2")
        for x in leaves[1:]:
            found = found.unionByName(x.select("c", "p", "m", "x1", "x2"))
        found = keep(found, "found")
        # of buckets with the same members one is enough
        once = keep(found.groupBy("m", "x1", "x2").agg(F.min("p").alias("p")).select("p"), "once")
        members = keep(found.join(once, "p").select("c", "p"), "members")
        # a set chooses a number of paths that depends on the number of runs only
        paths = keep(members.groupBy("c").agg(F.collect_list("p").alias("paths")), "lists")
        buckets = members.join(paths, "c").join(kind.select("c", "n", "sketch"), "c")
        near = keep(_placed(buckets, block, keep).mapInArrow(_candidates(threshold, slack), ddl(_NEAR)).distinct(), "near")

        live = near.select("c").distinct().join(kind.select("c", "k1", "k2"), "c")
        tokens = keep(docs.join(live, ["k1", "k2"]).select("c", "text").dropDuplicates(["c"]).mapInArrow(_tokens(words), ddl(_TOKENS)), "tokens")
        live = near.join(kind.select("c", "n", "size"), "c").join(paths, "c")
        placed = _placed(live, block, keep).join(tokens, "c").repartition("p", "b1", "b2").sortWithinPartitions("p", "b1", "b2")
        links = keep(placed.mapInArrow(_compare(threshold), ddl(_LINK)), "links")

        reach = connected_components(links.where("root <> c"), "c", "root").withColumnRenamed("node", "c")
        number = links.groupBy("c").agg(F.sum("links").alias("links"))
        kinds = kind.select("c", "n", "f1", "f2", "size", "least_id", "first").join(number, "c", "left").join(reach, "c", "left").withColumn("component", F.coalesce("component", "c"))
        kinds = keep(kinds, "classes")
        least = keep(kinds.groupBy("component").agg(F.min("least_id").alias("class_id"), F.min("first").alias("head")), "least")
        kinds = keep(kinds.join(least, "component").select("n", "f1", "f2", "class_id", "head", (F.coalesce("links", F.lit(0)) + F.col("size") - 1).alias("n_links")), "classes")
        alone = F.col("n") == 0
        stays = alone | ((F.col("k1") == F.col("head.k1")) & (F.col("k2") == F.col("head.k2")))
        out = rows.drop("paths", "sketch").join(kinds, ["n", "f1", "f2"], "left")
        out = out.select("id", F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.col("n").cast("long").alias("set_size"), "k1", "k2", stays.alias("stays"))
        return cut(out, "similar")


def similar_groups(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.8, words: int = WORDS,
    recall: float = 0.999, small: int = 64, depth: int = 3, block: int = 1024, slack: float = 0.25,
) -> DataFrame:
    """One row per input row: id, class_id, n_links, set_size, the row key k1, k2, and stays (the row's key is that of its class's first row: of least id, null last).

    n_links: the other rows whose shingle sets have a Jaccard similarity of at
    least `threshold`, copies included; class_id: the least id that is reached over such
    links (the own id where there are none). Sketches rule a pair out if their
    estimate is below threshold - slack, five standard deviations. Null texts
    count as empty and, like texts without words, link to nothing. Null ids take
    part; a class of null ids only has class_id null. Extra columns are not carried.
    """
    return _classes(keyed(df, id_col, text_col), threshold, words, recall, small, depth, block, slack).withColumnRenamed("id", id_col)


def keep_one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """One row of each class, one of least id (null ids last), with all columns; rows without words all stay.

    Of rows that agree in id and text, one stays.
    """
    k1, k2, times = fresh_names(df, 3)
    groups = similar_groups(df, id_col, text_col, **how).where("stays").groupBy("k1", "k2").agg(F.count_if(F.col("set_size") > 0).alias("times"))
    marked = with_key(df, id_col, text_col, k1, k2).join(groups.toDF(k1, k2, times), [k1, k2])
    names = [F.col(f"`{c}`") for c in df.columns]
    once = marked.where(F.col(times) <= 1).select(*names)
    return once.unionByName(marked.where(F.col(times) > 1).dropDuplicates([k1, k2]).select(*names))


def query(spark, sf_dir: str) -> DataFrame:
    """op2: see similar_groups."""
    return similar_groups(table(spark, sf_dir, "documents")).drop("k1", "k2", "stays")
