import math
import re
from collections import Counter

import numpy as np
import pytest

from drawloom.llm.gumbel_segments import Vocabulary, decode, model_path, sample_rows, sample_segmentations
from drawloom.llm.names import mix


@pytest.fixture(scope="module")
def vocab():
    return Vocabulary(model_path())


def every_path(vocab, text):
    """All segmentations with their probability."""

    def unit(u):
        if not u:
            return [((), 0.0)]
        out = []
        for j in range(1, len(u) + 1):
            hit = vocab.weight.get(u[:j])
            if hit is None and j == 1:
                hit = (tuple(vocab.single(u[0])), vocab.rare)
            if hit is not None:
                head = hit[0] if isinstance(hit[0], tuple) else (hit[0],)
                out += [(head + t, hit[1] + w) for t, w in unit(u[j:])]
        return out

    paths = [((), 0.0)]
    for u in re.findall("▁*[^▁]+|▁+", vocab.sp.normalize(text)):
        paths = [(a + b, x + y) for a, x in paths for b, y in unit(u)]
    total = np.logaddexp.reduce([w for _, w in paths])
    return {p: math.exp(w - total) for p, w in paths}


def seeds(n, s=0):
    return mix(np.arange(n, dtype=np.uint64), np.full(n, s + 1, np.uint64))


@pytest.mark.parametrize("text", ["in it", "the é☃"])
def test_samples_follow_the_law_without_replacement(vocab, text):
    law = every_path(vocab, text)
    n, k = 6000, 3
    got = sample_rows([text] * n, seeds(n), vocab, k)
    k = min(k, len(law))
    first, second = Counter(), Counter()
    for found in got:
        keys = [tuple(x[0].tolist()) for x in found]
        assert len(set(keys)) == len(keys) == k and all(x in law for x in keys)
        assert [x[2] for x in found] == sorted((x[2] for x in found), reverse=True)
        assert all(abs(x[1] - math.log(law[key])) < 1e-9 for x, key in zip(found, keys))
        first[keys[0]] += 1
        second[keys[1]] += 1
    want_second = Counter()
    for a, p in law.items():
        for b, q in law.items():
            if a != b:
                want_second[b] += p * q / (1 - p)
    for key, p in law.items():
        for seen, want in ((first[key], p), (second[key], want_second[key])):
            assert abs(seen / n - want) < 4 * math.sqrt(want * (1 - want) / n) + 2e-3
    # the mean of indicator / inclusion is 1 for each path (the estimator is unbiased); check the sum of probabilities
    weights = [sum(math.exp(x[1] - x[3]) for x in found) for found in got]
    assert abs(np.mean(weights) - 1) < 0.05


def test_few_segmentations_and_batches(vocab):
    texts = ["", "a", "ab cd efgh ijk" * 20, "x\ny\tz  w", "日本"]
    s = seeds(5)
    together = sample_rows(texts, s, vocab, 4)
    alone = [sample_rows([t], s[i : i + 1], vocab, 4)[0] for i, t in enumerate(texts)]
    for a, b in zip(together, alone):
        assert [(x[0].tolist(), round(x[2], 9), round(x[3], 9)) for x in a] == [(x[0].tolist(), round(x[2], 9), round(x[3], 9)) for x in b]
    assert [len(x) for x in together] == [min(4, len(every_path(vocab, t))) if len(t) < 20 else 4 for t in texts]
    assert together[0][0][0].tolist() == [] and together[0][0][3] == 0.0


def test_round_trip(spark, vocab):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").selectExpr("doc_id", "text", "1 as sample", "'x' as ids")
    rows = decode(sample_segmentations(docs, model_path(), k=3), model_path()).collect()
    want = {r["doc_id"]: vocab.sp.decode(vocab.sp.encode(r["text"])) for r in docs.collect()}
    assert all(r["decoded"] == want[r["doc_id"]] for r in rows)
    assert len({(r["doc_id"], r["ids"]) for r in rows}) == len(rows) >= 2 * len(want)
    odd = spark.createDataFrame([(None, None), (1, "a b"), (1, "a b")], "doc_id long, text string")
    got = sample_segmentations(odd, model_path()).collect()
    assert len({bytes(r["ids"]) for r in got if r["doc_id"] == 1}) == 2 and len(got) == 5
    assert sample_segmentations(odd.limit(0), model_path()).count() == 0


def test_query_branches_more_than_once(spark):
    from pyspark.sql import functions as F

    from drawloom.llm.gumbel_segments import query

    out = query(spark, "/root/testdata/sf0.001").groupBy("doc_id").agg(F.max("sample").alias("k"), F.countDistinct("ids_crc32").alias("n"))
    assert out.where("k = 4 and n = 4").count() > 0 and out.where("k > 4").count() == 0
