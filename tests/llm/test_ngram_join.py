import random

import pytest

from drawloom.llm.ngram_join import keep_one_of_each, runs_for, shingle_sets, similar_groups


def corpus(seed=3):
    r = random.Random(seed)
    words = lambda n: [r.choice("ab cd ef gh ij kl mn op qr st uv wx yz".split()) + str(r.randint(0, 40)) for _ in range(n)]
    texts = []
    for n in (3, 8, 30, 60, 200, 400):
        base = words(n)
        for _ in range(12):
            t = list(base)
            for _ in range(r.randint(0, max(1, n // 60))):
                t[r.randrange(n)] = "new" + str(r.random())
            texts.append(" ".join(t))
        texts.append("\t ".join(base).upper())
    hot = words(40)
    texts += [" ".join(words(30) + hot) for _ in range(30)]
    return texts + ["", None, " \n", "one", "one", "ONE", "one two"]


def plain(texts, threshold=0.8):
    sets = []
    for t in texts:
        w = (t or "").lower().split()
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    links = {i: {j for j in range(len(sets)) if j != i and sets[i] and sets[j] and len(sets[i] & sets[j]) / len(sets[i] | sets[j]) >= threshold} for i in range(len(sets))}
    least = {}
    for i in links:
        todo, seen = [i], {i}
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        least[i] = min(seen)
    return sets, links, least


@pytest.mark.parametrize("small,block", [(64, 1024), (4, 5)])
def test_equals_brute_force(spark, small, block):
    texts = corpus()
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").selectExpr("*", "1 as c", "'x' as p", "0 as n")
    sets, links, least = plain(texts)
    got = {r["doc_id"]: r for r in similar_groups(df, small=small, block=block, recall=0.99999).collect()}
    assert {i: (got[i]["class_id"], got[i]["n_links"], got[i]["set_size"]) for i in got} == {i: (least[i], len(links[i]), len(sets[i])) for i in links}


def test_recall_at_the_default(spark):
    """All links of the given table, by brute force over an index of shingles, at the default recall."""
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    sets, links, least = plain_by_index([t for _, t in rows])
    got = {r["doc_id"]: r for r in similar_groups(df).collect()}
    want = sum(len(x) for x in links.values())
    assert sum(got[rows[i][0]]["n_links"] for i in links) == want and want > 100
    assert all(got[rows[i][0]]["n_links"] == len(links[i]) for i in links)


def plain_by_index(texts, threshold=0.8):
    sets, index = [], {}
    for i, t in enumerate(texts):
        w = "".join(c.lower() if c.isascii() else c for c in t or "").split()
        sets.append({tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set())
        for g in sets[-1]:
            index.setdefault(g, []).append(i)
    links = {i: {j for j in {j for g in s for j in index[g]} if j != i and len(s & sets[j]) / len(s | sets[j]) >= threshold} for i, s in enumerate(sets)}
    return sets, links, None


def test_very_long_texts(spark):
    long = " ".join(str(i * i) for i in range(60_000))
    df = spark.createDataFrame([(1, long), (2, long.replace(" 81 ", " x ")), (3, long[: len(long) // 2])], "doc_id long, text string")
    assert {r["doc_id"]: (r["class_id"], r["n_links"]) for r in similar_groups(df, block=4).collect()} == {1: (1, 1), 2: (1, 1), 3: (3, 0)}


def test_shingles_match_words():
    texts = corpus()
    for t, s in zip(texts, shingle_sets([(t or "").encode() for t in texts])):
        w = (t or "").lower().split()
        assert len(s) == (len({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}) if w else 0)


def test_keep_one_nulls_and_empty(spark):
    df = spark.createDataFrame([(5, "a b c d e f"), (2, "A b c d e f"), (None, None), (7, ""), (2, "A b c d e f")], "doc_id long, text string")
    assert sorted(str(r["doc_id"]) for r in keep_one_of_each(df).collect()) == ["2", "7", "None"]
    same = [(None, "q w e r t y"), (None, "q w e r t y"), (None, "q w e r t  y"), (2, "a s d f g h"), (2, "a s d f  g h"), (2, "a s d f g h"), (9, "a s d f g h")]
    df = spark.createDataFrame(same, "doc_id long, text string").selectExpr("*", "1 as k1", "2 as key_0", "3 as stays")
    left = keep_one_of_each(df)
    assert left.columns == df.columns and sorted(str(r["doc_id"]) for r in left.collect()) == ["2", "None"]
    assert similar_groups(df.limit(0)).count() == 0
    assert runs_for(0.999, 3) == 15
