import math
import random
import re
from collections import Counter

import pytest

from drawloom.llm.reversed_search import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words(t):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))


def plain(items, docs, k):
    held = [(d, words(t)) for d, t in docs]
    held = [(d, Counter(w), len(w)) for d, w in held if w]
    n, total = len(held), sum(x[2] for x in held)
    df = Counter(w for _, c, _ in held for w in c)
    out = []
    for item, t in items:
        scored = []
        for d, c, size in held:
            m = 100 - 90 + (90 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[w] + 1))) * ((1_000_000_000 * c[w]) // (1000 * c[w] + 8 * m)) for w in set(words(t)) if w in c)
            if s > 0:
                scored.append((-s, -1 if d is None else d, d))
        out += [(item, r + 1, x[2], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:2])[:k])]
    return sorted(out, key=repr)


def data(seed=1):
    r = random.Random(seed)
    vocabulary = ["w%d" % i for i in range(60)] + ["Été", "ÉTÉ", "日本", "x_y", "A1-b2", "don't", "\x00z"]
    text = lambda n: " ".join(vocabulary[min(int(r.expovariate(0.08)), len(vocabulary) - 1)] for _ in range(n))
    docs = [(i, text(r.choice([0, 1, 8, 60]))) for i in range(300)] + [(None, "w50 w51"), (7, "w50 w51"), (7, "w50 w51"), (400, None), (401, "w1 " * 30_000)] + [(500 + i, "same w9 text") for i in range(40)]
    items = [(i, text(12)) for i in range(25)] + [(3, "w50"), (3, "w51 same"), (None, "w1"), (90, None), (91, "unseen"), (91, "")]
    return items, docs


@pytest.mark.parametrize("how", [{}, {"k": 3, "block_items": 4}, {"block_bytes": 300}])
def test_equals_scores_of_all_pairs(spark, how):
    items, docs = data()
    i = spark.createDataFrame([(a, t, 1, 2) for a, t in items], "item_id int, text string, row int, score int")
    d = spark.createDataFrame([(a, t, 1, 2) for a, t in docs], "doc_id long, text string, id int, item string").repartition(7)
    got = search(i, d, **how).select("item_id", "rank", "doc_id", "score").collect()
    assert sorted(map(tuple, got), key=repr) == plain(items, docs, how.get("k", 10))


def test_empty_tables(spark):
    items, docs = data()
    i, d = spark.createDataFrame(items, "item_id int, text string"), spark.createDataFrame(docs, "doc_id long, text string")
    assert search(i.limit(0), d).count() == 0 and search(i, d.limit(0)).count() == 0
    assert search(i, d.where("text is null")).count() == 0
