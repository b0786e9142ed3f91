import glob
import mmap
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest
from tokenizers import Tokenizer

from drawloom.llm.chunk_store import encoder
from drawloom.llm.token_files import Shard, id_bits, pack_bits, pack_shard, query, read, tokenizer_path, unpack_bits, with_starts, write

WHITE = [chr(c) for c in [*range(9, 14), 28, 31, 32, 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200D), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]]


def odd_texts(n=400, seed=3):
    r = random.Random(seed)
    parts = ["a", "The", "don't", "'s", "x²", "été", "日本", "12", "!!", "<|endoftext|>", "😀", "\x00", "é", ";", "▁", "<0x0A>", "<s>"]
    return ["".join(r.choice(parts if r.random() < 0.5 else WHITE + [" ", "  ", "\n", "\r\n", "\n\n"]) for _ in range(r.randrange(12))) for _ in range(n)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@pytest.mark.parametrize("width", [1, 5, 15, 16, 17, 31, 32])
def test_bits_round_trip(width):
    r = np.random.default_rng(width)
    for n in (0, 1, 63, 64, 65, 5000):
        ids = r.integers(0, 1 << width, n).astype(np.uint32)
        assert (unpack_bits(pack_bits(ids, width), width)[:n] == ids).all()
    x = pack_bits(np.array([1, 2, 3], np.uint32), 17)
    assert int.from_bytes(x, "little") == 1 | 2 << 17 | 3 << 34 and len(x) == 17 * 8


def test_random_access_reads_only_blocks_asked_for():
    r = np.random.default_rng(1)
    ids = r.integers(0, 50257, 1000).astype(np.uint32)
    ends = np.array([0, 3, 3, 700, 1000])
    data = bytearray(pack_shard(ids, np.arange(5), ends, 16, 128, 7, 2))
    s = Shard(bytes(data))
    assert (s.shard, s.part, s.width) == (7, 2, 16)
    for a, z in [(0, 1000), (0, 0), (127, 129), (128, 256), (999, 1000), (500, 400), (990, 5000)]:
        assert (s.ids(a, z) == ids[a:z]).all()
    assert [s.document(i).tolist() for i in range(5)] == [ids[a:z].tolist() for a, z in zip([0, *ends], ends)]
    assert [x.tolist() for _, _, x in s.documents(at_once=10)] == [s.document(i).tolist() for i in range(5)]
    data[s.body : s.body + 128 * 2 * 5] = bytes(128 * 2 * 5)  # blocks before the sixth are gone
    assert (Shard(bytes(data)).ids(640, 1000) == ids[640:]).all()
    with pytest.raises(ValueError):
        Shard(b"x" * 100)


def test_chunks_equal_whole_texts():
    tok = Tokenizer.from_file(tokenizer_path())
    texts = odd_texts(3000) + pq.read_table("/root/testdata/sf0.001/documents.parquet").column("text").to_pylist()
    texts = [t or "" for t in texts]
    values, n = encoder(tokenizer_path())(texts)
    at = 0
    for t, k in zip(texts, n.tolist()):
        assert values[at : at + k].tolist() == tok.encode(t, add_special_tokens=False).ids, ascii(t[:200])
        at += k


def test_files_hold_all_in_order(spark, tmp_path):
    tok = Tokenizer.from_file(tokenizer_path())
    rows = [(i * 7 % 400, t, "x", 1) for i, t in enumerate(odd_texts())] + [(None, "null id", "x", 1), (None, None, "x", 1), (5, "twice", "x", 1), (5, "twice", "x", 1), (9000, "word " * 60_000, "x", 1), (9001, "", "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, part string, id int").repartition(5)
    write(df, f"{tmp_path}/t", tokenizer_path(), shard_ids=700)
    files = glob.glob(f"{tmp_path}/t/part-*")
    assert len(files) > 5
    got = sorted((r.asDict() for r in with_starts(read(spark, f"{tmp_path}/t"), group=2).collect()), key=lambda r: r["start"])
    at = 0
    for r in got:
        ids = np.frombuffer(r["tokens"], "<u4")
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), crc(ids))
        at += len(ids)
    ids = [-1 if r["id"] is None else r["id"] for r in got]
    assert ids == sorted(ids)
    want = sorted((-1 if i is None else i, crc([*tok.encode(t or "", add_special_tokens=False).ids, 0])) for i, t, *_ in rows)
    assert sorted(zip(ids, (r["ids_crc32"] for r in got))) == want
    # one file by a memory map
    with open(files[0], "rb") as f:
        s = Shard(mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ))
        mine = [r for r in got if (r["shard"], r["part"]) == (s.shard, s.part)]
        k = len(mine) // 2
        assert s.document(k).tolist() == np.frombuffer(mine[k]["tokens"], "<u4").tolist()


def test_empty_table(spark, tmp_path):
    df = spark.createDataFrame([], "doc_id long, text string")
    write(df, f"{tmp_path}/t", tokenizer_path())
    assert with_starts(read(spark, f"{tmp_path}/t")).count() == 0
    assert id_bits(tokenizer_path(), 0) == 16 and id_bits(tokenizer_path(), 1 << 16) == 17


def test_query_over_whole_table(spark):
    tok = Tokenizer.from_file(tokenizer_path())
    d = "/root/testdata/sf0.001"
    t = pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"]).sort_by("doc_id").to_pylist()
    want, at = [], 0
    for r in t:
        ids = [*tok.encode(r["text"] or "", add_special_tokens=False).ids, 0]
        want.append((r["doc_id"], at, len(ids), crc(ids)))
        at += len(ids)
    assert sorted(map(tuple, query(spark, d).collect())) == want
