"""Token ids in files of fixed-width bit-packed blocks.

A file is one shard of the corpus, in ascending order of document ids (nulls
first): a header, the documents' ids, the place after each document's last token,
the byte offset of each block, and the blocks. A block holds `block` token ids of
as many bits each as the vocabulary's largest id needs, so any id is found
without reading the blocks before it, and a block is unpacked by a few numpy
operations on whole 64-bit words. All numbers are little-endian.

| bytes | holds |
|---|---|
| 8 | `DLBITS01` |
| 4, 4 | bits of an id; ids in a block, a multiple of 64 |
| 8, 8, 8, 8 | shard's first number (its task), second number (in the task); documents; ids |
| 8 each | documents' ids; -2**63 stands for null |
| 8 each | ids up to each document's end |
| 8 each | blocks' offsets from the first block, and the end of the last one |
| | blocks; the last one padded to a multiple of 64 ids |
| 1 | line feed |

Spark writes each file in one piece through its own commit of a task, so a lost
executor or a task run twice leaves no half or double file.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from drawloom.llm.chunk_store import encoder
from drawloom.llm.common import batch, cut, ddl, drop, keyed, pieces, raw, shared_dir, table

_MAGIC = b"DLBITS01"
_HEAD = "<8sIIQQQQ"
_NULL = -(2**63)
_LANES = 64
_FILE = pa.schema([("file", pa.binary())])
_DOC = pa.schema([
    ("shard", pa.int64()), ("part", pa.int64()), ("at", pa.int64()), ("id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64()), ("tokens", pa.binary()),
])


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    """ids in `width` bits each, the first id in the lowest bits; padded with zeros to a multiple of 64 ids."""
    n = -(-len(ids) // _LANES)
    lanes = np.zeros((n, _LANES), np.uint64)
    lanes.reshape(-1)[: len(ids)] = ids
    lanes = np.ascontiguousarray(lanes.T)
    words = np.zeros((width, n), np.uint64)
    for i in range(_LANES):
        w, s = divmod(i * width, 64)
        words[w] |= lanes[i] << np.uint64(s)
        if s + width > 64:
            words[w + 1] |= lanes[i] >> np.uint64(64 - s)
    return np.ascontiguousarray(words.T).astype("<u8").tobytes()


def unpack_bits(data: memoryview | bytes, width: int) -> np.ndarray:
    """All ids of some blocks, padding included."""
    words = np.ascontiguousarray(np.frombuffer(data, "<u8").reshape(-1, width).T)
    mask = np.uint64((1 << width) - 1)
    lanes = np.empty((_LANES, words.shape[1]), np.uint32)
    for i in range(_LANES):
        w, s = divmod(i * width, 64)
        x = words[w] >> np.uint64(s)
        if s + width > 64:
            x = x | (words[w + 1] << np.uint64(64 - s))
        lanes[i] = x & mask
    return np.ascontiguousarray(lanes.T).reshape(-1)


def pack_shard(ids: np.ndarray, doc_ids: np.ndarray, ends: np.ndarray, width: int, block: int, shard: int, part: int) -> bytes:
    n_blocks = -(-len(ids) // block)
    size = block * width // 8
    last = len(ids) - (n_blocks - 1) * block if n_blocks else 0
    offsets = np.arange(n_blocks + 1, dtype=np.uint64) * np.uint64(size)
    if n_blocks:
        offsets[-1] = (n_blocks - 1) * size + -(-last // _LANES) * width * 8
    step = max(1, (1 << 17) // block) * block  # what is packed at once stays in the processor's cache
    body = [pack_bits(ids[i : i + step], width) for i in range(0, len(ids), step)]
    head = struct.pack(_HEAD, _MAGIC, width, block, shard, part, len(doc_ids), len(ids))
    return b"".join([head, doc_ids.astype("<i8").tobytes(), ends.astype("<u8").tobytes(), offsets.astype("<u8").tobytes(), *body])


class Shard:
    """A file's documents and ids; data may be bytes or a memory map, of which only the blocks asked for are read."""

    def __init__(self, data):
        self.data = memoryview(data)
        magic, self.width, self.block, self.shard, self.part, n_docs, self.n_ids = struct.unpack_from(_HEAD, self.data)
        if magic != _MAGIC:
            raise ValueError("not a file of packed token ids")
        at = struct.calcsize(_HEAD)
        self.doc_ids = np.frombuffer(self.data, "<i8", n_docs, at)
        self.ends = np.frombuffer(self.data, "<u8", n_docs, at + 8 * n_docs).astype(np.int64)
        self.offsets = np.frombuffer(self.data, "<u8", -(-self.n_ids // self.block) + 1, at + 16 * n_docs).astype(np.int64)
        self.body = at + 16 * n_docs + 8 * len(self.offsets)

    def ids(self, first: int, last: int) -> np.ndarray:
        """The ids at first, ..., last - 1 of the shard, from the blocks that hold them."""
        first, last = max(0, first), min(last, self.n_ids)
        if first >= last:
            return np.empty(0, np.uint32)
        a, z = first // self.block, -(-last // self.block)
        found = unpack_bits(self.data[self.body + self.offsets[a] : self.body + self.offsets[z]], self.width)
        return found[first - a * self.block : last - a * self.block]

    def document(self, i: int) -> np.ndarray:
        return self.ids(int(self.ends[i - 1]) if i else 0, int(self.ends[i]))

    def documents(self, at_once: int = 1 << 20) -> Iterator[tuple[int, int, np.ndarray]]:
        """Number, first place and ids of each document; `at_once` ids, or one document, are unpacked at a time."""
        i, n = 0, len(self.ends)
        while i < n:
            first = int(self.ends[i - 1]) if i else 0
            j = max(i + 1, int(np.searchsorted(self.ends, first + at_once, "right")))
            got = self.ids(first, int(self.ends[j - 1]))
            start = first
            for k in range(i, j):
                end = int(self.ends[k])
                yield k, start, got[start - first : end - first]
                start = end
            i = j


def id_bits(tokenizer: str, end: int | None) -> int:
    """Bits of the largest id that the tokenizer or `end` can give."""
    from tokenizers import Tokenizer

    largest = max(Tokenizer.from_file(tokenizer).get_vocab(with_added_tokens=True).values())
    return max(1, max(largest, end or 0).bit_length())


def _files(tokenizer, end, width, block, shard_ids):
    tail = np.array([] if end is None else [end], np.uint32)

    def run(batches):
        encode = encoder(tokenizer)
        shard, part = TaskContext.get().partitionId(), 0
        docs, lengths, held, n = [], [], [], 0

        def out():
            ids = np.concatenate(held) if held else tail[:0]
            return batch(_FILE, [pack_shard(ids, np.array(docs, np.int64), np.cumsum(lengths), width, block, shard, part)])

        for b in pieces(batches, size=1 << 22):
            values, counts = encode([t.decode() for t in raw(b.column("text"))])
            at = 0
            for doc, k in zip(b.column("k1").to_pylist(), counts.tolist()):
                docs.append(doc)
                lengths.append(k + len(tail))
                held += [values[at : at + k], tail]
                at += k
                n += k + len(tail)
                if n >= shard_ids:
                    yield out()
                    part += 1
                    docs, lengths, held, n = [], [], [], 0
        if docs:
            yield out()

    return run


def write(df: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end: int | None = 0, block: int = 4096, shard_ids: int = 1 << 22) -> None:
    """Files of about shard_ids ids (more if one document has more) in a new folder.

    Null texts are empty; null ids come first, rows that share an id in the order of their
    texts' hashes, repeated rows each for itself. An empty table writes no file. Extra columns
    are not written. Rows are dealt to tasks by ranges of id, hash and place in the input, so
    not even rows that are all alike gather in one task.
    """
    if block % _LANES:
        raise ValueError("block must be a multiple of 64")
    order = ["k1", "k2", "row"]
    docs = keyed(df, id_col, text_col).select("k1", "k2", F.monotonically_increasing_id().alias("row"), "text")
    docs = docs.repartitionByRange(*order).sortWithinPartitions(*order).select("k1", "text")
    files = docs.mapInArrow(_files(tokenizer, end, id_bits(tokenizer, end), block, shard_ids), ddl(_FILE))
    # a string of Spark is any bytes: the text writer adds the line feed alone
    files.select(F.col("file").cast("string").alias("value")).write.option("maxRecordsPerFile", 1).text(folder)


def _documents(with_tokens):
    def run(batches):
        for b in batches:
            for data in b.column("content"):
                s = Shard(data.as_buffer())
                rows = []
                size = 0
                for k, first, ids in s.documents():
                    doc = int(s.doc_ids[k])
                    ids = ids.astype("<u4").tobytes()
                    rows.append((s.shard, s.part, k, None if doc == _NULL else doc, first, len(ids) // 4, zlib.crc32(ids), ids if with_tokens else None))
                    size += len(ids) if with_tokens else 0
                    if len(rows) == 5000 or size > 1 << 24:
                        yield batch(_DOC, *zip(*rows))
                        rows, size = [], 0
                if rows:
                    yield batch(_DOC, *zip(*rows))

    return run


def read(spark: SparkSession, folder: str, with_tokens: bool = True) -> DataFrame:
    """One row per document of the files: shard, part, at (its number in the file), id, first (its place in the file), n_tokens, ids_crc32, tokens (32-bit ids)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("content").mapInArrow(_documents(with_tokens), ddl(_DOC))


def with_starts(docs: DataFrame, group: int = 1024) -> DataFrame:
    """read()'s rows, already written as a table, with `start`: the ids of all documents before.

    Sums run in three steps: over the files of a task, over `group` tasks, over the groups.
    """
    files = docs.groupBy("shard", "part").agg(F.sum("n_tokens").alias("n")).withColumn("group", F.floor(F.col("shard") / group))
    shards = files.groupBy("group", "shard").agg(F.sum("n").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("group").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    groups = shards.groupBy("group").agg(F.sum("n").alias("n")).select("group", before.alias("before_group"))
    so_far = lambda of, by: F.coalesce(F.sum("n").over(Window.partitionBy(of).orderBy(by).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = shards.select("group", "shard", so_far("group", "shard").alias("before_shard"))
    files = files.select("group", "shard", "part", so_far("shard", "part").alias("before_part"))
    starts = files.join(shards, ["group", "shard"]).join(groups, "group").select("shard", "part", (F.col("before_group") + F.col("before_shard") + F.col("before_part")).alias("before"))
    return docs.join(starts, ["shard", "part"]).withColumn("start", F.col("before") + F.col("first")).drop("before")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op11: the files of all documents, read back; the ids as their CRC-32."""
    folder = f"{shared_dir(spark)}/token-files-{uuid.uuid4().hex}"
    write(table(spark, sf_dir, "documents"), folder, tokenizer_path())
    files = spark.read.format("binaryFile").load(folder)
    docs = cut(read(spark, folder, with_tokens=False).drop("tokens"), "token-files-read")
    files._cut_path = folder
    drop(files)
    out = with_starts(docs)
    return out.select(F.col("id").alias("doc_id"), "start", "n_tokens", "ids_crc32")
