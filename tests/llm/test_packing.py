import random
from collections import defaultdict

import numpy as np
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from drawloom.llm.packing import Packer, pack, tokenizer_path, word_tokenizer


def test_every_id_once_and_no_padding(spark):
    r = random.Random(2)
    words = ["The", "naïve", "don't", "x²", "ÉTÉ", "áb", "日本語", "$$$", "it's!!", "2024", "İstanbul", "fin ish"]
    texts = [" \n\t"[i % 3].join(r.choice(words) for _ in range(r.choice([0, 1, 5, 300, 3000]))) for i in range(60)] + ["", None, "the " * 4095, "the " * 8191]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as id", "'x' as tokens").repartition(3)
    rows = pack(df, tokenizer_path()).collect()
    tok = Tokenizer.from_file(tokenizer_path())
    docs, seqs = defaultdict(list), defaultdict(list)
    for x in rows:
        ids = np.frombuffer(x["tokens"], "<u4")
        assert len(ids) == x["length"] > 0
        docs[x["doc_id"]].append((x["start"], ids, x["doc_tokens"]))
        seqs[x["sequence_id"]].append((x["offset"], len(ids)))
    for i, t in enumerate(texts):
        want = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
        got = sorted(docs[i], key=lambda p: p[0])
        assert np.concatenate([p[1] for p in got]).tolist() == want and {p[2] for p in got} == {len(want)}
        assert [p[0] for p in got] == np.cumsum([0, *(len(p[1]) for p in got)])[:-1].tolist()
    for s in seqs.values():
        at = 0
        for offset, n in sorted(s):
            assert offset == at
            at += n
        assert at <= 4096 and at & (at - 1) == 0


def test_level_choice_is_least_sum_of_squares():
    r = np.random.default_rng(1)
    p = Packer(16, 0, 1000)
    for d in range(300):
        n = int(r.integers(1, 16))
        c = p.count.copy()
        total = lambda x: int((x[1:16] ** 2).sum())
        options = []
        for level in range(0, 16 - n + 1):
            if level == 0 or c[level]:
                x = c.copy()
                x[level] -= level > 0
                x[level + n] += 1
                options.append(total(x))
        p.add(d, np.zeros(n, np.uint32))
        assert total(p.count) == min(options)


def test_word_tokenizer_equals_whole_texts():
    tok = Tokenizer.from_file(tokenizer_path())
    texts = [t for t in pq.read_table("/root/testdata/sf0.01/documents.parquet").column("text").to_pylist()]
    texts += ["it's ''s I'LL we'Ve 'S x'dy", "e\u0301 caf\u00e9 \u0130 \u01c4 ﬁ ß ẞ ΑΣ Σ.", "a<|endoftext|>b <|x|>", "1²3 ½ ٣ x1y22", "a\x1cb\x85c\xa0d\u2003e\u200bf\x00g", "😀 日本語, ไทย", "ŉ ǅ ĳ Ĳ ſ µ ª º × ÷", "\ufeff¡¿«»"]
    texts += ["".join(chr(c) for c in range(a, a + 40) if not 0xD800 <= c < 0xE000) for a in range(1, 0x600, 37)]
    encode = word_tokenizer(tokenizer_path(), None, words=500)
    for i in range(0, len(texts), 50):
        for t, ids in zip(texts[i : i + 50], encode([t.encode() for t in texts[i : i + 50]])):
            assert ids.tolist() == tok.encode(t, add_special_tokens=False).ids, t[:200]


def test_empty_and_nulls(spark):
    df = spark.createDataFrame([(None, None), (1, "a"), (1, "a")], "doc_id long, text string")
    assert sorted((str(r["doc_id"]), r["length"]) for r in pack(df, tokenizer_path()).collect()) == [("1", 2), ("1", 2), ("None", 1)]
    assert pack(df.limit(0), tokenizer_path()).count() == 0


def test_other_tokenizers_are_used_whole():
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    tok = Tokenizer.from_file(path)
    texts = ["It's  LOUD\n\n naïve 2024", "", "a<|endoftext|>b"]
    assert [x.tolist() for x in word_tokenizer(path, 7)([t.encode() for t in texts])] == [[*tok.encode(t, add_special_tokens=False).ids, 7] for t in texts]


def test_close_keeps_windows_as_they_were_placed():
    r = np.random.default_rng(3)
    for window, n in ((16, 200), (4096, 300), (64, 1), (64, 0)):
        p = Packer(window, 0, 10_000)
        rows, docs = [], [int(r.integers(1, 3 * window)) for _ in range(n)]
        for d, k in enumerate(docs):
            rows += p.add(d, np.full(k, d, np.uint32))
        waits = sum(len(x[2]) for ws in p.open.values() for w in ws for x in w)
        rows += p.close()
        seqs, seen = defaultdict(int), defaultdict(list)
        for doc, start, length, ids, total, seq, at in rows:
            assert at == seqs[seq] and len(ids) == 4 * length > 0
            seqs[seq] += length
            seen[doc].append((start, length))
        assert all(x <= window and x & (x - 1) == 0 for x in seqs.values())
        for d, k in enumerate(docs):
            at = 0
            for start, length in sorted(seen[d]):
                assert start == at
                at += length
            assert at == k
        assert 2 * p.placed >= waits - 2 * window
