"""Removal of repeated passages by distributed prefix doubling.

All positions of all texts would take about 20 times the input on disk in the
first round, so the doubling runs over anchors. Every 200-byte string holds one, the
least 64-byte name among its 137 (the leftmost of equals), and equal strings
have theirs at equal places; it is one in about 60 positions.

1. First round: Spark ranks the anchors by their 64 bytes. Those of unique rank
   end here, with all the strings that they stand for. Of the others, whose whole
   surroundings (all the 200-byte strings that they stand for) occur again lose
   them; one row of each kind of surroundings goes on.
2. Rounds at growing offsets, to the right and to the left of the anchor: the pair
   of its rank and the name of the 17 bytes next to it, then of the 17 after
   these, of the next 34, of the next 68, which is past 200 bytes. In each round Spark
   counts equal pairs, sorts those that recur and numbers them in that order; the
   numbers are the new ranks. Anchors of unique rank stop in that direction.
3. How far an anchor's rank was shared to either side leaves a range of string
   starts around it; those positions are ranked by their 200 bytes. This makes
   exact what step 2 knows to the next offset only.

Names are 64-bit fingerprints of bytes (the first rank; steps 2 and 3 tell two
different strings within it apart with 64 and 128 bits more); ranks are numbers that
Spark deals out. A frequent name, kind or pair is counted with partial sums in each
task, and its rows are only joined with a table of counts, which AQE splits.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawloom.llm.common import batch, cut, ddl, drop, fresh_names, keyed, pieces, raw, scratch, table, with_key
from drawloom.llm.names import doubled, eights, joined, mix, ranges, sliding_min

GRAM = 64
_ANCHOR = pa.schema([("k1", pa.int64()), ("k2", pa.int64()), ("lo", pa.int64()), ("span", pa.int32()), ("rel", pa.int32()), ("g", pa.int64()), ("s", pa.int64()), ("t", pa.int64())])
_SIDE = pa.schema([("u", pa.int64()), ("lo", pa.int64()), ("side", pa.int32()), ("rank", pa.int64()), *[(f"n{j}", pa.int64()) for j in range(4)]])
_WINDOW = pa.schema([("u", pa.int64()), ("at", pa.int64()), ("single", pa.bool_()), ("w1", pa.int64()), ("w2", pa.int64())])
_OUT = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("spans", pa.list_(pa.struct([("a", pa.int64()), ("z", pa.int64())]))), ("n_removed", pa.int64()), ("kept", pa.binary())])


def _grams(buf: np.ndarray) -> np.ndarray:
    """Names of the 64 bytes at each position, doubled from the 8 bytes themselves."""
    return doubled(doubled(doubled(eights(buf), 8), 16), 32)


def _window_names(x: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """Names of the `length` bytes (128 to 256) at each position in `at`, from 64-byte names."""
    z = np.uint64(seed)
    return mix(mix(x[at] ^ z, x[at + 64]), mix(x[at + length - 128] ^ z, x[at + length - 64]))


_SEEDS = (0, 0x5DEECE66D)


def _extents(length: int) -> list[int]:
    """Bytes beside an anchor after each round; the last makes `length` bytes with the anchor's own."""
    return [(length - GRAM) >> k for k in (3, 2, 1, 0)]


def _anchors(length: int, most: int = 1 << 20):
    """The anchors of each text; of long texts in parts of `most` string starts, so that memory has a bound."""
    width = length - GRAM + 1
    low = np.uint64(0xFFFFFFFF)

    def parts(b):
        k1, k2, base, texts = [], [], [], []
        for i, j, t in zip(b.column("k1").to_pylist(), b.column("k2").to_pylist(), raw(b.column("text"))):
            for a in range(0, len(t) - length + 1, most):
                k1.append(i)
                k2.append(j)
                base.append(a)
                texts.append(t[a : a + most + length - 1] if len(t) > most else t)
                if len(texts[-1]) >= most:
                    yield k1, k2, base, texts
                    k1, k2, base, texts = [], [], [], []
        if texts:
            yield k1, k2, base, texts

    def run(batches):
        for b in pieces(batches, size=1 << 19):
            for k1, k2, base, texts in parts(b):
                buf, starts, lens = joined(texts, length + 100)
                at = ranges(starts, lens - length + 1)
                x = _grams(buf)
                ordered = (x & ~low) | np.arange(len(x), dtype=np.uint64)
                anchor = (sliding_min(ordered, width)[at] & low).astype(np.int64)
                first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
                lo, hi, anchor = at[first], at[np.append(first[1:], len(at)) - 1], anchor[first]
                shape = (((anchor - lo) << 16) + (hi - lo)).astype(np.uint64)
                s, t = (mix(mix(_window_names(x, lo, length, seed), _window_names(x, hi, length, seed)), shape).view(np.int64) for seed in _SEEDS)
                doc = np.searchsorted(starts, lo, "right") - 1
                key = [np.array(c, np.int64)[doc] for c in (k1, k2, base)]
                yield batch(_ANCHOR, key[0], key[1], key[2] + lo - starts[doc], (hi - lo).astype(np.int32), (anchor - lo).astype(np.int32), x[anchor].view(np.int64), s, t)

    return run


def _sides(length: int):
    """Of each kind of surroundings two rows, side 0 to the right and 1 to the left: names of what each round adds, as far as its strings go."""
    extents = _extents(length)
    reach = extents[-1]

    def named(names: dict, at: np.ndarray, n: int) -> np.ndarray:
        k = 1 << (n.bit_length() - 1)
        return mix(names[k][at], names[k][at + n - k])

    def run(batches):
        for b in pieces(batches, size=1 << 19):
            u = b.column("u").to_numpy()
            edges = b.column("edges").to_pylist()
            doc = np.repeat(np.arange(len(u)), [len(e) for e in edges])
            lo, span, rel, g = (np.array([e[c] for es in edges for e in es], np.int64) for c in ("lo", "span", "rel", "g"))
            # only the strings that the anchors stand for are named, not the whole texts
            texts = raw(b.column("text"))
            parts = [texts[d][i : i + n + length] for d, i, n in zip(doc.tolist(), lo.tolist(), span.tolist())]
            for i in range(0, len(parts), 4000):
                some = slice(i, i + 4000)
                buf, starts, lens = joined(parts[some], 2 * length)
                names = {8: eights(buf)}
                for k in (8, 16, 32, 64):
                    names[2 * k] = doubled(names[k], k)
                p, n = starts + rel[some], len(starts)
                for side, room in ((0, reach - rel[some] + span[some]), (1, rel[some])):
                    columns, before = [], 0
                    for e in extents:
                        at = p + GRAM + before if side == 0 else p - e
                        ok = room >= e
                        name = named(names, np.where(ok, at, 0), e - before).view(np.int64)
                        columns.append(pa.array(name, pa.int64(), mask=~ok))
                        before = e
                    yield batch(_SIDE, u[doc[some]], lo[some], np.full(n, side, np.int32), g[some], *columns)

    return run


def _windows(length: int):
    def run(batches):
        for b in pieces(batches, size=1 << 19):
            u, single, base, parts, size = [], [], [], [], 0
            for i, text, runs in zip(b.column("u").to_pylist(), raw(b.column("text")), b.column("runs").to_pylist()):
                for r in runs:
                    u.append(i)
                    single.append(r["single"])
                    base.append(r["a"])
                    parts.append(text[r["a"] : r["z"] + length])
                    size += len(parts[-1])
                    if size > 1 << 20:
                        yield named(u, single, base, parts)
                        u, single, base, parts, size = [], [], [], [], 0
            if parts:
                yield named(u, single, base, parts)

    def named(u, single, base, parts):
        buf, starts, lens = joined(parts, length + 100)
        counts = lens - length + 1
        at = ranges(starts, counts)
        row = np.repeat(np.arange(len(lens)), counts)
        x = _grams(buf)
        w1, w2 = (_window_names(x, at, length, seed).view(np.int64) for seed in _SEEDS)
        return batch(_WINDOW, np.array(u, np.int64)[row], np.array(base, np.int64)[row] + at - starts[row], np.array(single)[row], w1, w2)

    return run


def _removed(batches):
    for b in pieces(batches, size=1 << 22):
        out = [[] for _ in _OUT]
        for i, text, spans in zip(b.column("id").to_pylist(), raw(b.column("text")), b.column("spans").to_pylist()):
            merged: list[list[int]] = []
            for a, z in sorted((s["a"], s["z"]) for s in spans or ()):
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], z)
                else:
                    merged.append([a, z])
            kept, end = [], 0
            for a, z in merged:
                kept.append(text[end:a])
                end = z
            kept.append(text[end:])
            for column, v in zip(out, (i, len(text), [{"a": a, "z": z} for a, z in merged], sum(z - a for a, z in merged), b"".join(kept))):
                column.append(v)
        yield batch(_OUT, *out)


def _reach(sides: DataFrame, length: int, keep) -> DataFrame:
    """(u, lo, left, right): the bytes up to which an anchor may share either side with another one, by rounds of growing offsets."""
    extents = _extents(length)
    rows, found = sides, []
    for j, e in enumerate(extents):
        pair = ["side", "rank", f"n{j}"]
        live = rows.where(F.col(f"n{j}").isNotNull())
        often = live.groupBy(*pair).agg(F.count("*").alias("n")).where("n > 1").select(*pair)
        ranks = keep(often.repartitionByRange(*pair).sortWithinPartitions(*pair).withColumn("new", F.monotonically_increasing_id()), "ranks")
        rows = keep(live.join(ranks, pair).select("u", "lo", "side", F.col("new").alias("rank"), *[f"n{k}" for k in range(j + 1, 4)]), "ranked")
        # what is shared ends before the next offset
        found.append(rows.select("u", "lo", "side", F.lit(extents[j + 1] - 1 if j < 3 else e).alias("reach")))
    every = sides.select("u", "lo", "side", F.lit(extents[0] - 1).alias("reach"))
    for x in found:
        every = every.unionByName(x)
    side = lambda k: F.max(F.when(F.col("side") == k, F.col("reach")))
    return every.groupBy("u", "lo").agg(side(1).alias("left"), side(0).alias("right"))


def repeated_spans(keyed_docs: DataFrame, length: int = 200) -> DataFrame:
    """(k1, k2, spans): byte ranges (a to z) of each text whose every `length`-byte string starts in at least one other place.

    keyed_docs: from common.keyed(). Ranges may overlap; texts without any have
    no row. All other tables that are written on the way are deleted. length:
    128 to 256.
    """
    docs = keyed_docs.where(F.octet_length("text") >= length).select("k1", "k2", "text")
    with scratch() as keep:
        anchors = keep(docs.mapInArrow(_anchors(length), ddl(_ANCHOR)), "anchors")
        # tables of their own, so that joining them back can split a frequent name's rows
        often = anchors.groupBy("g").agg(F.count("*").alias("n"), ((F.min("s") == F.max("s")) & (F.min("t") == F.max("t"))).alias("pure")).where("n > 1")
        often = keep(often.select("g", "pure"), "names")
        alive = keep(anchors.join(often, "g"), "alive")
        drop(anchors)
        # one row for each different surrounding of an ambiguous name
        kinds = alive.where("not pure").groupBy("g", "s", "t").agg(F.count("*").alias("n"), F.min(F.struct("k1", "k2", "lo", "span", "rel")).alias("x"))
        kinds = keep(kinds.select("g", "s", "t", "n", "x.*"), "kinds")
        again = alive.where("not pure").join(kinds.where("n > 1").select("g", "s", "t"), ["g", "s", "t"])
        whole = alive.where("pure").select("k1", "k2", "lo", "span").unionByName(again.select("k1", "k2", "lo", "span"))
        whole = whole.select("k1", "k2", F.col("lo").alias("a"), (F.col("lo") + F.col("span") + length).alias("z"))

        open_names = keep(kinds.groupBy("g").agg(F.min("n").alias("least")).where("least = 1").select("g"), "open")
        kind = F.struct("g", "lo", "span", "rel", (F.col("n") == 1).alias("single"))
        edges = keep(kinds.join(open_names, "g").groupBy("k1", "k2").agg(F.collect_list(kind).alias("edges")).withColumn("u", F.monotonically_increasing_id()), "edges")
        near = keep(docs.join(edges, ["k1", "k2"]).select("u", "text", "edges"), "near")
        with scratch() as keep_round:
            sides = keep_round(near.mapInArrow(_sides(length), ddl(_SIDE)), "sides")
            reach = keep(_reach(sides, length, keep_round), "reach")
        # string starts around the anchor at lo + rel that both sides allow
        at = edges.select("u", F.explode("edges").alias("e")).select("u", "e.*").join(reach, ["u", "lo"])
        p = F.col("lo") + F.col("rel")
        a, z = F.greatest(F.col("lo"), p - F.col("left")), F.least(F.col("lo") + F.col("span"), p + F.col("right") - (length - GRAM))
        runs = at.select("u", "single", a.alias("a"), z.alias("z")).where("a <= z").groupBy("u").agg(F.collect_list(F.struct("a", "z", "single")).alias("runs"))
        windows = keep(near.select("u", "text").join(runs, "u").mapInArrow(_windows(length), ddl(_WINDOW)), "windows")
        drop(near)
        twice = keep(windows.groupBy("w1", "w2").agg(F.count("*").alias("n")).where("n > 1").select("w1", "w2"), "twice")
        found = windows.where("single").join(twice, ["w1", "w2"]).select("u", "at").distinct()
        rest = keep(_islands(found, length).join(edges.select("u", "k1", "k2"), "u").select("k1", "k2", "a", "z"), "rest")
        drop(windows)
        drop(twice)
        return cut(whole.unionByName(rest).groupBy("k1", "k2").agg(F.collect_list(F.struct("a", "z")).alias("spans")), "spans")


def _islands(found: DataFrame, length: int) -> DataFrame:
    """(u, a, z) from string starts (u, at): neighbours as one range, never over the border of a block of positions, which bounds the window."""
    block: Column = F.floor(F.col("at") / 65536)
    island = F.col("at") - F.row_number().over(Window.partitionBy("u", "block").orderBy("at"))
    rows = found.withColumn("block", block).withColumn("island", island)
    return rows.groupBy("u", "block", "island").agg(F.min("at").alias("a"), (F.max("at") + length).alias("z"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200) -> DataFrame:
    """One row per input row: id, n_bytes, spans (removed runs a to z), n_removed, kept (the bytes that stay).

    Null texts count as empty; texts under `length` bytes stay whole. Rows that
    repeat both id and text are occurrences of each other, so each loses what
    they have in common. Columns other than the two named are not carried.
    """
    docs = keyed(df, id_col, text_col)
    spans = repeated_spans(docs, length)
    return docs.join(spans, ["k1", "k2"], "left").select("id", "text", "spans").mapInArrow(_removed, ddl(_OUT)).withColumnRenamed("id", id_col)


def cut_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str = "n_chars", length: int = 200) -> DataFrame:
    """The rows of df with what stays of their texts (bytes of characters cut in two left out) and its length in chars_col, if df has that column.

    Rows of which no more than white space is left go, unless their text was
    that already. Rows that lose nothing stay as they are, null texts too.
    """
    k1, k2, found = fresh_names(df, 3)
    spans = repeated_spans(keyed(df, id_col, text_col), length).toDF(k1, k2, found)
    marked = with_key(df, id_col, text_col, k1, k2).join(spans, [k1, k2], "left")

    @F.pandas_udf("string")
    def left(texts: pd.Series, spans: pd.Series) -> pd.Series:
        out = []
        for t, s in zip(texts, spans):
            if s is None:
                out.append(t)
                continue
            raw_text, kept, end = t.encode(), [], 0
            for a, z in sorted((x["a"], x["z"]) for x in s):
                if a > end:
                    kept.append(raw_text[end:a].decode(errors="ignore"))
                end = max(end, z)
            kept.append(raw_text[end:].decode(errors="ignore"))
            out.append("".join(kept))
        return pd.Series(out, dtype=object)

    # once a row: where Spark may repeat it for the filter, each task runs it in a second Python process, which then stays
    left = left.asNondeterministic()
    changed = marked.where(F.col(found).isNotNull()).withColumn(text_col, left(F.col(f"`{text_col}`"), F.col(found)))
    changed = changed.where(F.col(f"`{text_col}`").rlike(r"\S"))
    if chars_col in df.columns:
        changed = changed.withColumn(chars_col, F.char_length(F.col(f"`{text_col}`")).cast(df.schema[chars_col].dataType))
    whole = marked.where(F.col(found).isNull())
    names = [F.col(f"`{c}`") for c in df.columns]
    return whole.select(*names).unionByName(changed.select(*names))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: see remove_repeats; digest columns only."""
    out = remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def brute(texts: list[bytes], length: int = 200) -> list[tuple[int, int, str]]:
    """n_removed, n_spans and digest per text, from a dictionary of all strings (for tests)."""
    seen: dict[bytes, int] = {}
    for t in texts:
        for i in range(len(t) - length + 1):
            seen[t[i : i + length]] = seen.get(t[i : i + length], 0) + 1
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(t)) if gone[i] and not (i and gone[i - 1]))
        out.append((sum(gone), runs, hashlib.sha256(bytes(c for c, x in zip(t, gone) if not x)).hexdigest()))
    return out
