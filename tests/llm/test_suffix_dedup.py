import random

import pytest

from drawloom.llm.suffix_dedup import brute, cut_repeats, remove_repeats

from pyspark.sql import functions as F


def corpus(seed, n=40):
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdeé") for _ in range(r.randint(1, 7)))
    prose = lambda k: " ".join(word() for _ in range(k))
    shared = [prose(60) for _ in range(3)]
    texts = []
    for i in range(n):
        t = prose(r.randint(0, 120))
        for _ in range(r.randint(0, 2)):
            s = r.choice(shared)
            a = r.randint(0, 80)
            t = t[: len(t) // 2] + s[a : a + r.randint(150, 330)] + t[len(t) // 2 :]
        texts.append(t)
    texts += [texts[3], texts[3], "ab" * 300, "ab" * 180, "x" * 199, "x" * 200, "x" * 205, "", None, texts[5] + "!", prose(90)]
    long = texts[7] * 5
    return texts + [long[: len(long) // 2] + "q" + long[len(long) // 2 :]]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_equals_brute_force(spark, seed):
    texts = corpus(seed)
    df = spark.createDataFrame([(i if i != 9 else None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, k1 string, g int")
    got = remove_repeats(df).select("doc_id", "n_removed", F.size("spans"), F.sha2("kept", 256)).collect()
    want = brute([(t or "").encode() for t in texts])
    assert sorted(tuple(r)[1:] for r in got) == sorted(want)
    got = {r[0]: tuple(r)[1:] for r in got}
    assert all(got[i if i != 9 else None] == w for i, w in enumerate(want))


def test_repeated_rows_and_empty(spark):
    t = " ".join(str(i * 7919) for i in range(60))
    df = spark.createDataFrame([(1, t), (1, t), (2, "short")], "doc_id long, text string")
    rows = sorted((r["doc_id"], r["n_bytes"] - r["n_removed"]) for r in remove_repeats(df).collect())
    assert rows == [(1, 0), (1, 0), (2, 5)]
    assert remove_repeats(df.limit(0)).count() == 0
