"""Alignment of two tokenizers' tokens by sparse token-byte incidence matrices.

Both tokenizers give the bytes that each of their tokens covers. The matrix A has a
row for each token of the first and a column for each byte, B the same for the
second, both in CSR form built here. Gustavson's row products give A Bᵀ: its nonzeros
are the links, its values the bytes that two tokens share. Bytes where both sides
end a token cut the tokens into groups; with E the incidence of bytes and groups,
(A E)(B E)ᵀ links all tokens of a group.

Texts are cut where white space begins, which is where both tokenizers end a token,
so the matrices have a diagonal block for each chunk, and the products of a chunk
are made once however often it occurs. How often two ids are linked in the
corpus is counted in buckets: a bucket is the documents of about `bucket_bytes` of text,
with its documents' chunks, its chunks' id pairs and their
counts. The counts are added up by pair and go back to the buckets that hold the pair.
A bucket has megabytes: it lies in rows of 64 KB, and Python gets one bucket at a time.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from drawloom.llm.chunk_store import WHITE, Grown, Lists, Store, byte_letters, byte_level, chunks_cr
from drawloom.llm.common import batch, cut, ddl, once, pieces, raw, scratch, table
from drawloom.llm.names import ranges

_LONGS, _INTS = pa.list_(pa.int64()), pa.list_(pa.int32())
_HELD = pa.schema([
    ("doc_id", _LONGS), ("sizes", pa.binary()), ("sha", pa.list_(pa.string())), ("doc_chunks", pa.binary()), ("chunk", pa.binary()), ("times", pa.binary()), ("chunk_links", pa.binary()), ("pair", pa.binary()), ("n_pairs", pa.int64()),
])
_BUCKET = pa.schema([("bucket", pa.int64()), ("part", pa.int32()), ("held", pa.binary()), ("a", _INTS), ("b", _INTS), ("n", _LONGS)])
#: Bytes of `held` in a row, and of a row group of their table: what Spark's readers, sorts and batches hold at once counts rows, not bytes.
_PART_BYTES, _GROUP_BYTES = 64 << 10, 16 << 20
_DOC = pa.schema([
    ("id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()), ("n_links", pa.int64()), ("n_group_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()), ("groups_sha256", pa.string()),
])
_PAIR = pa.struct([("a", pa.int32()), ("b", pa.int32())])
_LINKS = pa.schema([
    ("id", pa.int64()), ("a_ids", _INTS), ("b_ids", _INTS), ("a_ends", _INTS), ("b_ends", _INTS),
    ("links", pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32()), ("bytes", pa.int32())]))), ("group_links", pa.list_(_PAIR)), ("groups", pa.string()),
])


class Csr:
    """A sparse matrix: row i has the columns cols[edge[i] : edge[i + 1]] with the values there."""

    def __init__(self, edge: np.ndarray, cols: np.ndarray, values: np.ndarray, n_cols: int):
        self.edge, self.cols, self.values, self.n_cols = edge, cols, values, n_cols

    @property
    def n_rows(self) -> int:
        return len(self.edge) - 1

    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(self.n_rows), np.diff(self.edge))

    def transposed(self) -> Csr:
        order = np.argsort(self.cols, kind="stable")
        edge = np.concatenate(([0], np.cumsum(np.bincount(self.cols, minlength=self.n_cols))))
        return Csr(edge, self.rows()[order], self.values[order], self.n_rows)

    def times(self, other: Csr) -> Csr:
        """Gustavson: row i of the product is the sum of other's rows k, each times the value at (i, k)."""
        n = other.edge[self.cols + 1] - other.edge[self.cols]
        at = ranges(other.edge[self.cols], n) if len(n) else n
        place = np.repeat(self.rows(), n) * other.n_cols + other.cols[at]
        values = np.repeat(self.values, n) * other.values[at]
        if len(place) and (np.diff(place) < 0).any():
            order = np.argsort(place, kind="stable")
            place, values = place[order], values[order]
        first = np.flatnonzero(np.concatenate(([True], np.diff(place) > 0))) if len(place) else place
        values = np.add.reduceat(values, first) if len(first) else values
        row, col = np.divmod(place[first], max(1, other.n_cols))
        return Csr(np.concatenate(([0], np.cumsum(np.bincount(row, minlength=self.n_rows)))), col, values, other.n_cols)

    def row_sums(self, of: np.ndarray) -> np.ndarray:
        """The product with a vector."""
        sums = np.concatenate(([0], np.cumsum(self.values * of[self.cols])))
        return sums[self.edge[1:]] - sums[self.edge[:-1]]


def incidence(ends: np.ndarray, n_bytes: int) -> Csr:
    """Of tokens that end at `ends`, in order, and the bytes that they cover."""
    return Csr(np.concatenate(([0], ends)), np.arange(n_bytes), np.ones(n_bytes, np.int64), n_bytes)


def _groups(a_ends: np.ndarray, b_ends: np.ndarray, n_bytes: int) -> tuple[np.ndarray, Csr]:
    """Bytes where both sides end a token, and the incidence of bytes and the groups between them."""
    common = np.intersect1d(a_ends, b_ends, assume_unique=True)
    group = np.searchsorted(common, np.arange(n_bytes), "right")
    return common, Csr(np.arange(n_bytes + 1), group, np.ones(n_bytes, np.int64), len(common))


class Pair:
    """Two tokenizers as functions from strings to ids, with the bytes of each id."""

    def __init__(self, path_a: str, path_b: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        self.a, plain, special = byte_level(path_a)
        self.a.encode_special_tokens = True
        self.parting, self.mark = byte_level(path_a)[0], special[0] if special else ""
        self.parted = self.parting.token_to_id(self.mark) if special else None
        letters = byte_letters()
        self.bytes_a = [b""] * (max(self.a.get_vocab().values()) + 1)
        for token, i in self.a.get_vocab().items():
            self.bytes_a[i] = bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()
        model = sentencepiece_model_pb2.ModelProto()
        with open(path_b, "rb") as f:
            model.ParseFromString(f.read())
        # the space before a text is its own here, so that a chunk from the middle of one gets none
        spaced = model.normalizer_spec.add_dummy_prefix
        model.normalizer_spec.add_dummy_prefix = False
        self.b = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        names = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(names)]
        inside = re.compile(f"[^▁{WHITE}][▁{WHITE}]")
        joins = any(inside.search(p.replace("\r", "\u0001")) for i, p in enumerate(names) if not self.b.is_byte(i))
        spec = model.normalizer_spec
        self.cuts = plain and spaced and not joins and spec.name == "identity" and not spec.remove_extra_whitespaces and model.trainer_spec.model_type == model.trainer_spec.BPE
        if not spaced:
            raise ValueError("the second tokenizer adds no space before a text")
        self.len_a = np.fromiter(map(len, self.bytes_a), np.int64, len(self.bytes_a))
        self.len_b = np.fromiter(map(len, self.bytes_b), np.int64, len(self.bytes_b))

    def _ids_a(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids and the number of each text's. One call for many texts: the special token's string parts them before anything else is done, unless a text holds it."""
        joined = self.mark.join([*texts, ""]) if self.mark else ""
        if not self.mark or joined.count(self.mark) != len(texts):
            each = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
            return np.fromiter((i for x in each for i in x), np.int64), np.fromiter(map(len, each), np.int64, len(each))
        many = np.array(self.parting.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
        return many[many != self.parted], np.diff(np.flatnonzero(many == self.parted), prepend=-1) - 1

    def ids(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A's ids, B's ids, number of each text's A ids, of its B ids) of each text as it stands; none of either where one side's bytes aren't the text's."""
        a, n_a = map(np.concatenate, zip(*[self._ids_a(texts[i : i + 4096]) for i in range(0, len(texts), 4096)]))
        b = self.b.encode(texts, num_threads=1)
        n_b = np.fromiter(map(len, b), np.int64, len(b))
        b = np.fromiter((i for x in b for i in x), np.int64, int(n_b.sum()))
        # where each text has as many bytes as its tokens and all bytes together are alike, each text's are
        want = [t.encode() for t in texts]
        size = np.fromiter(map(len, want), np.int64, len(want))
        whole, good = b"".join(want), np.ones(len(texts), bool)
        for ids, n, known, lens in ((a, n_a, self.bytes_a, self.len_a), (b, n_b, self.bytes_b, self.len_b)):
            ends = np.cumsum(n)
            if (_sums(lens[ids], n) != size).any() or b"".join(map(known.__getitem__, ids.tolist())) != whole:
                good &= [b"".join(map(known.__getitem__, ids[e - k : e].tolist())) == t for e, k, t in zip(ends.tolist(), n.tolist(), want)]
        if good.all():
            return a, b, n_a, n_b
        return a[np.repeat(good, n_a)], b[np.repeat(good, n_b)], n_a * good, n_b * good


def _sums(x: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Sums of n[0], n[1], ... values of x."""
    y, ends = np.concatenate(([0], np.cumsum(x))), np.cumsum(n)
    return y[ends] - y[ends - n]


class Chunks:
    """What is known of each chunk of a process."""

    def __init__(self, pair: Pair):
        self.pair = pair
        self.store = Store(self._fill, self._empty, most=200_000, most_chars=6 << 20)
        self._empty()

    def _empty(self) -> None:
        self.numbers = {c: Grown(np.int64) for c in ("n_a", "n_b", "n_groups", "n_links", "n_group_links")}
        self.links, self.text = Lists(np.int64), []

    def _fill(self, new: list[str]) -> None:
        p = self.pair
        a, b, n_a, n_b = p.ids(new)
        a_ends, b_ends = np.cumsum(p.len_a[a]), np.cumsum(p.len_b[b])
        n_bytes = int(a_ends[-1]) if len(a_ends) else 0
        left, right = incidence(a_ends, n_bytes), incidence(b_ends, n_bytes)
        links = left.times(right.transposed())
        common, of_group = _groups(a_ends, b_ends, n_bytes)
        a_group, b_group = left.times(of_group), right.times(of_group)
        in_group = lambda x: np.bincount(x.cols, minlength=len(common))
        per_a = np.diff(links.edge)
        # a chunk without tokens, whose bytes differ, has none of what follows either
        over = lambda x: _sums(x, n_a)
        n_links = over(per_a)
        first = np.concatenate(([True], np.diff(a_group.cols) > 0)) if len(a) else np.empty(0, bool)
        n_groups = over(first)
        # row sums of (A E)(B E)ᵀ, without its pairs
        shared = over((a_group.values > 0) * in_group(b_group)[a_group.cols]) if len(a) else n_groups
        for c, x in zip(self.numbers, (n_a, n_b, n_groups, n_links, shared)):
            self.numbers[c].add(x)
        self.links.add(a[links.rows()] << 32 | b[links.cols], n_links)
        self.text += _group_texts(a, b, in_group(a_group), in_group(b_group), n_groups)


def _group_texts(a, b, in_a, in_b, n_groups) -> list[str]:
    """`a1,a2|b1;a3|b2,b3` of each chunk: all ids in the order of their groups, first the A ids of each, with what follows each id."""
    both = np.cumsum(in_a + in_b)
    place = lambda first, n: ranges(first, n) if len(n) else n
    ids = np.empty(len(a) + len(b), np.int64)
    ids[place(both - in_a - in_b, in_a)], ids[place(both - in_b, in_b)] = a, b
    after = np.zeros(len(ids), np.int64)
    after[both - in_b - 1], after[both - 1] = 1, 2
    n_groups = np.asarray(n_groups)
    after[both[np.cumsum(n_groups)[n_groups > 0] - 1] - 1] = 3
    text: list[str] = [""] * (2 * len(ids))
    text[::2], text[1::2] = map(str, ids.tolist()), map(",|;\n".__getitem__, after.tolist())
    found = iter("".join(text).split("\n"))
    return [next(found) if n else "" for n in n_groups.tolist()]


def _of_process(path_a: str, path_b: str) -> Chunks:
    return once(("overlap", path_a, path_b), lambda: Chunks(Pair(path_a, path_b)))


def _by_bytes(chunk: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same with numbers of a byte: a chunk that occurs more often stands more than once."""
    if len(times) and times.max() > 255:
        n = -(-times // 255)
        last = np.cumsum(n) - 1
        chunk, rest = np.repeat(chunk, n), times - 255 * (n - 1)
        times = np.full(len(chunk), 255, np.int64)
        times[last] = rest
    return chunk, times


class _Bucket:
    """Documents and their distinct chunks, until they are rows of _BUCKET."""

    def __init__(self):
        self.ids, self.sizes, self.sha, self.n_chunks, self.chunk, self.times, self.bytes = [], [], [], [], [], [], 0

    def rows(self, bucket: int, links: Lists) -> pa.RecordBatch:
        chunk = np.concatenate(self.chunk) if self.chunk else np.empty(0, np.int64)
        times = np.concatenate(self.times) if self.times else np.empty(0, np.int64)
        held, chunk = np.unique(chunk, return_inverse=True)
        pair, n_links = links.of(held)
        kinds, pair = np.unique(pair, return_inverse=True)
        n = np.zeros(len(kinds), np.int64)
        np.add.at(n, pair, np.repeat(np.bincount(chunk, times, len(held)).astype(np.int64), n_links))
        u4 = lambda x: np.asarray(x, "<u4").tobytes()
        whole = batch(
            _HELD, [self.ids], [np.array(self.sizes, "<i8").tobytes()], [self.sha], [u4(self.n_chunks)], [u4(chunk)], [times.astype(np.uint8).tobytes()], [u4(n_links)], [u4(pair)], [len(kinds)],
        )
        return _parts(bucket, whole, (kinds >> 32).astype(np.int32), (kinds & (2**32 - 1)).astype(np.int32), n)


def _parts(bucket: int, whole: pa.RecordBatch, a, b, n) -> pa.RecordBatch:
    """The rows of a bucket; its pairs stand in the first."""
    sent = whole.serialize().to_pybytes()
    held = [sent[i : i + _PART_BYTES] for i in range(0, len(sent), _PART_BYTES)]
    none = [None] * (len(held) - 1)
    return batch(_BUCKET, [bucket] * len(held), range(len(held)), held, [a, *none], [b, *none], [n, *none])


def _buckets(path_a, path_b, bucket_bytes):
    def run(batches):
        known = _of_process(path_a, path_b)
        number, held = TaskContext.get().partitionId() << 32, _Bucket()
        for b in pieces(batches, size=1 << 18):
            if len(known.store.place) > known.store.most or known.store.chars > known.store.most_chars:
                if held.ids:  # its chunks' numbers end here
                    yield held.rows(number, known.links)
                    number, held = number + 1, _Bucket()
                known.store.trim()
            texts = [t.decode() for t in raw(b.column("text"))]
            split = [[] if not t else chunks_cr(" " + t) if known.pair.cuts else [" " + t] for t in texts]
            at = known.store.numbers([c for cs in split for c in cs])
            numbers = [x[at] for x in known.numbers.values()]
            a = 0
            for doc, cs in zip(b.column("id").to_pylist(), split):
                z = a + len(cs)
                mine, good = at[a:z], a < z and numbers[0][a:z].all()
                held.ids.append(doc)
                held.sizes.append([int(x[a:z].sum()) if good else 0 for x in numbers])
                held.sha.append(hashlib.sha256(";".join(map(known.text.__getitem__, mine.tolist())).encode()).hexdigest() if good else "")
                chunk, times = _by_bytes(*np.unique(mine, return_counts=True)) if good else (mine[:0], mine[:0])
                held.n_chunks.append(len(chunk))
                held.chunk.append(chunk)
                held.times.append(times)
                a = z
            held.bytes += b.nbytes
            if held.bytes >= bucket_bytes:
                yield held.rows(number, known.links)
                number, held = number + 1, _Bucket()
        if held.ids:
            yield held.rows(number, known.links)

    return run


def _documents(parts: pa.Table, back: pa.Table) -> pa.Table:
    """The rows of _DOC of one bucket; back has its pairs' counts in the corpus."""
    bucket = pa.ipc.read_record_batch(pa.py_buffer(b"".join(parts.sort_by("part").column("held").to_pylist())), _HELD)
    get = lambda c: bucket.column(c)[0]
    u4 = lambda c: np.frombuffer(get(c).as_buffer(), "<u4").astype(np.int64)
    ids = get("doc_id").as_py()
    sizes = np.frombuffer(get("sizes").as_buffer(), "<i8").reshape(len(ids), -1)
    n, best = np.zeros(get("n_pairs").as_py(), np.int64), np.zeros(get("n_pairs").as_py(), np.int64)
    at = back.column("at").to_numpy()
    n[at], best[at] = back.column("times").to_numpy(), back.column("best").to_numpy()
    pair, edge = u4("pair"), np.concatenate(([0], np.cumsum(u4("chunk_links"))))
    chunk, times, docs = u4("chunk"), np.frombuffer(get("times").as_buffer(), np.uint8).astype(np.int64), np.concatenate(([0], np.cumsum(u4("doc_chunks"))))

    def of_docs(x):
        """Sums over the links of each document."""
        y = np.concatenate(([0], np.cumsum(x[pair])))
        per_chunk = y[edge[1:]] - y[edge[:-1]]
        y = np.concatenate(([0], np.cumsum(per_chunk[chunk] * times)))
        return y[docs[1:]] - y[docs[:-1]]

    return pa.Table.from_batches([batch(_DOC, ids, *sizes.T, of_docs(best), of_docs(n), get("sha").as_py())])


def alignment_counts(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text", bucket_bytes: int = 4 << 20) -> DataFrame:
    """One row per row of df: id, n_a, n_b, n_groups, n_links, n_group_links, n_best, count_sum, groups_sha256.

    The first tokenizer reads a space and the text, the second the text, before which it puts a
    space itself. n_group_links are the pairs of tokens that share a group; a pair of ids counts as often as links hold
    it in all of df; n_best are the links whose count is the highest of their second id, ties included. Null and empty
    texts, and those whose bytes a tokenizer changes, have zeros and ''. Null and repeated ids are rows like others;
    extra columns are not carried; an empty table gives no rows.
    """
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    with scratch() as keep:
        rows = keep(docs.mapInArrow(_buckets(path_a, path_b, bucket_bytes), ddl(_BUCKET)), "token-buckets", **{"parquet.block.size": _GROUP_BYTES})
        pairs = rows.select("bucket", F.posexplode(F.arrays_zip("a", "b", "n")).alias("at", "x")).select("bucket", "at", "x.a", "x.b", "x.n")
        totals = keep(pairs.groupBy("a", "b").agg(F.sum("n").alias("times")), "pair-counts")
        most = totals.groupBy("b").agg(F.max("times").alias("most"))
        known = totals.join(most, "b").select("a", "b", "times", (F.col("times") == F.col("most")).alias("best"))
        back = pairs.select("bucket", "at", "a", "b").join(known, ["a", "b"]).select(F.col("bucket").alias("of"), "at", "times", "best")
        # a cogroup sends one bucket at a time to Python; a batch of a join's rows would hold all buckets of its partition
        full = rows.drop("a", "b", "n").groupBy("bucket").cogroup(back.groupBy("of"))
        return cut(full.applyInArrow(_documents, ddl(_DOC)), "alignments").withColumnRenamed("id", id_col)


def _aligned(path_a, path_b):
    def run(batches):
        pair = _of_process(path_a, path_b).pair
        for b in pieces(batches, size=1 << 17):
            out = []
            texts = [t.decode() for t in raw(b.column("text"))]
            for doc, t in zip(b.column("id").to_pylist(), texts):
                a, z, _, _ = pair.ids([" " + t if t else ""])
                a_ends, b_ends = np.cumsum(pair.len_a[a]), np.cumsum(pair.len_b[z])
                n = int(a_ends[-1]) if len(a) else 0
                left, right = incidence(a_ends, n), incidence(b_ends, n)
                links = left.times(right.transposed())
                common, of_group = _groups(a_ends, b_ends, n)
                ga, gb = left.times(of_group), right.times(of_group)
                shared = Csr(ga.edge, ga.cols, np.ones(len(ga.cols), np.int64), ga.n_cols).times(gb.transposed())
                count = lambda x: np.bincount(x.cols, minlength=len(common))
                groups = _group_texts(a, z, count(ga), count(gb), [len(common)])[0]
                as_rows = lambda m, *more: [dict(zip(("a", "b", "bytes"), x)) for x in zip(m.rows().tolist(), m.cols.tolist(), *more)]
                out.append((doc, a, z, a_ends, b_ends, as_rows(links, links.values.tolist()), as_rows(shared), groups))
            yield batch(_LINKS, *zip(*out))

    return run


def alignments(df: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of df: id, a_ids, b_ids, a_ends, b_ends (bytes), links (token numbers and shared bytes), group_links (token numbers), groups; without tokens all lists are empty."""
    docs = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    return docs.mapInArrow(_aligned(path_a, path_b), ddl(_LINKS)).withColumnRenamed("id", id_col)


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def query(spark, sf_dir: str) -> DataFrame:
    """op12: see alignment_counts."""
    return alignment_counts(table(spark, sf_dir, "documents"), *tokenizer_paths())
