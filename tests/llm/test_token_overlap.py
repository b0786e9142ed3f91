import glob
import hashlib
from collections import Counter
from contextlib import contextmanager

import numpy as np
import pyarrow.parquet as pq
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from drawloom.llm.chunk_store import byte_letters
from drawloom.llm import token_overlap
from drawloom.llm.token_overlap import Csr, alignment_counts, alignments, query, tokenizer_paths
from tests.llm.test_token_files import odd_texts

SIZES = ("n_a", "n_b", "n_groups", "n_links", "n_group_links", "n_best", "count_sum", "groups_sha256")


def plain(rows):
    """Each row's sizes by loops over tokens, each text encoded whole by the libraries' own calls."""
    path_a, path_b = tokenizer_paths()
    a_tok, b_tok, letters = Tokenizer.from_file(path_a), sentencepiece.SentencePieceProcessor(model_file=path_b), byte_letters()
    a_tok.encode_special_tokens = True
    docs, count = [], Counter()
    for i, t in rows:
        spans_a, spans_b = [], []
        if t:
            for spans, ids, to_bytes in (
                (spans_a, a_tok.encode(" " + t, add_special_tokens=False).ids, lambda k: bytes(letters[c] for c in a_tok.id_to_token(k)) if k < 50256 else a_tok.id_to_token(k).encode()),
                (spans_b, b_tok.encode(t), lambda k: bytes([int(b_tok.id_to_piece(k)[3:5], 16)]) if b_tok.is_byte(k) else b_tok.id_to_piece(k).replace("▁", " ").encode()),
            ):
                at, whole = 0, b""
                for k in ids:
                    x = to_bytes(k)
                    spans.append((k, at, at + len(x)))
                    at, whole = at + len(x), whole + x
                if whole != (" " + t).encode():
                    spans_a.clear()
                    spans_b.clear()
                    break
        links = [(a, b) for a, s, e in spans_a for b, s2, e2 in spans_b if s < e2 and s2 < e]
        ends = sorted({e for *_, e in spans_a} & {e for *_, e in spans_b})
        groups = [([a for a, _, e in spans_a if lo < e <= hi], [b for b, _, e in spans_b if lo < e <= hi]) for lo, hi in zip([0, *ends], ends)]
        count.update(links)
        docs.append((i, len(spans_a), len(spans_b), groups, links))
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for i, na, nb, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((i, na, nb, len(groups), len(links), sum(len(x) * len(y) for x, y in groups), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links), hashlib.sha256(text.encode()).hexdigest() if groups else ""))
    return out


def short(rows):
    return sorted(rows, key=repr)


def test_products_equal_dense_ones():
    r = np.random.default_rng(4)
    for n, k, m in ((5, 7, 3), (1, 1, 1), (40, 30, 20), (3, 0, 2), (0, 4, 4)):
        x, y = r.integers(0, 3, (n, k)) * (r.random((n, k)) < 0.3), r.integers(0, 3, (k, m)) * (r.random((k, m)) < 0.3)

        def sparse(d):
            at = np.nonzero(d)
            return Csr(np.concatenate(([0], np.cumsum((d != 0).sum(1)))).astype(np.int64), at[1], d[at], d.shape[1])

        def dense(c):
            d = np.zeros((c.n_rows, c.n_cols), int)
            d[c.rows(), c.cols] = c.values
            return d

        assert (dense(sparse(x).times(sparse(y))) == x @ y).all()
        assert (dense(sparse(x).transposed()) == x.T).all()
        v = r.integers(0, 5, k)
        assert (sparse(x).row_sums(v) == x @ v).all()


def test_equals_loops_on_odd_texts(spark):
    rows = list(enumerate([*odd_texts(300, 8), "a\r\n\nb c;\r d", "x" * 300, "plain words, twice. plain words, twice.", "many " * 700, None, "", " ", "naïve 日本語 text"])) + [(None, "null id"), (1, "again"), (1, "again")]
    df = spark.createDataFrame([(i, t, 1, "x") for i, t in rows], "doc_id long, text string, bucket int, a string").repartition(3)
    got = alignment_counts(df, *tokenizer_paths(), bucket_bytes=2000).select("doc_id", *SIZES).collect()
    assert short(map(tuple, got)) == short(plain(rows))


def test_long_text_and_empty_table(spark):
    text = "long words and \n\n more;\r " * 20_000 + "ü" * 5000
    df = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    got = {r["doc_id"]: r for r in alignment_counts(df, *tokenizer_paths()).collect()}
    a = Tokenizer.from_file(tokenizer_paths()[0])
    # a chunk that occurs 20,000 times in one text
    assert got[1]["count_sum"] > 4 * 20_000**2
    assert got[1]["n_a"] == len(a.encode(" " + text, add_special_tokens=False).ids) and got[2]["n_a"] > 0
    assert alignment_counts(df.limit(0), *tokenizer_paths()).count() == 0


def test_links_by_token(spark):
    rows = [(1, "unbelievable tokenizers 日本"), (2, ""), (3, "▁changed"), (4, None)]
    got = {r["doc_id"]: r for r in alignments(spark.createDataFrame(rows, "doc_id long, text string"), *tokenizer_paths()).collect()}
    want = {r[0]: r for r in plain(rows)}
    for i, _ in rows:
        r, w = got[i], want[i]
        assert (len(r["a_ids"]), len(r["b_ids"]), len(r["links"]), len(r["group_links"])) == (w[1], w[2], w[4], w[5])
        starts = lambda e: [0, *e][:-1]
        a, b = list(zip(starts(r["a_ends"]), r["a_ends"])), list(zip(starts(r["b_ends"]), r["b_ends"]))
        assert [(x["a"], x["b"], x["bytes"]) for x in r["links"]] == [(i, j, min(e, f) - max(s, t)) for i, (s, e) in enumerate(a) for j, (t, f) in enumerate(b) if s < f and t < e]
        assert (hashlib.sha256(r["groups"].encode()).hexdigest() if r["groups"] else "") == w[8]


def test_query_over_whole_table(spark):
    d = "/root/testdata/sf0.001"
    t = pq.read_table(f"{d}/documents.parquet", columns=["doc_id", "text"]).to_pylist()
    few = [(r["doc_id"], r["text"]) for r in t if len(r["text"] or "") < 3000]
    df = spark.createDataFrame(few, "doc_id long, text string")
    assert short(map(tuple, alignment_counts(df, *tokenizer_paths()).select("doc_id", *SIZES).collect())) == short(plain(few))
    assert query(spark, d).count() == len(t)


def test_buckets_go_in_small_rows_and_one_by_one(spark, monkeypatch):
    """No step holds all buckets of its task: 40 buckets of one task lie in small rows of several row groups, and Python's batches are single buckets; one without pairs is a bucket too."""
    groups, sizes, plans, real, cut = [], [], [], token_overlap.scratch, token_overlap.cut

    @contextmanager
    def seen():
        with real() as keep:

            def spy(df, name, **options):
                out = keep(df, name, **options)
                if name == "token-buckets":
                    for f in glob.glob(f"{out._cut_path.removeprefix('file:')}/*.parquet"):
                        m = pq.ParquetFile(f).metadata
                        groups.extend((m.row_group(i).num_rows, m.row_group(i).total_byte_size) for i in range(m.num_row_groups))
                    sizes.extend(r[0] for r in out.select(F.length("held")).collect())
                return out

            yield spy

    def last(df, name, **options):
        plans.append(df._jdf.queryExecution().toString())
        return cut(df, name, **options)

    monkeypatch.setattr(token_overlap, "scratch", seen)
    monkeypatch.setattr(token_overlap, "cut", last)
    words = [hashlib.md5(str(i).encode()).hexdigest()[:8] for i in range(80_000)]
    df = spark.createDataFrame([(i, " ".join(words[1000 * i : 1000 * i + 40_000])) for i in range(40)], "doc_id long, text string").coalesce(1)
    got = alignment_counts(df, *tokenizer_paths(), bucket_bytes=1).collect()
    assert sum(n for n, _ in groups) == len(sizes) > len(got) == 40
    assert len(groups) > 1 and max(size for _, size in groups) < 40 << 20 and max(sizes) <= 64 << 10
    assert "CoGroups" in plans[0] and "collect_list" not in plans[0]
    monkeypatch.undo()
    assert short(map(tuple, got)) == short(map(tuple, alignment_counts(df, *tokenizer_paths(), bucket_bytes=64 << 20).collect()))
    none = spark.createDataFrame([(1, None), (2, "")], "doc_id long, text string")
    assert short(map(tuple, alignment_counts(none, *tokenizer_paths()).select("doc_id", *SIZES).collect())) == short(plain([(1, None), (2, "")]))
