import hashlib
import random

import pytest

from drawloom.llm.exact_dedup import drop_exact_copies, exact_groups


def rows():
    r = random.Random(5)
    base = [" ".join(str(r.random()) for _ in range(r.randint(0, 900))) for _ in range(20)]
    texts = base + [b.upper() for b in base[:8]] + base[:3] + [base[4][:-1], base[4] + "x", "É", "é", "", None, "z" * 200_000, "Z" * 200_000, "z" * 199_999]
    return [(i, t) for i, t in enumerate(texts)]


def lower(t):
    return (t or "").encode().lower()


@pytest.mark.parametrize("fingerprint_bytes", [16, 1])
def test_groups_equal_plain_grouping(spark, fingerprint_bytes):
    data = rows()
    df = spark.createDataFrame([(i, t, "a", 1) for i, t in data], "doc_id long, text string, chunks string, recipe int")
    want = {}
    for i, t in data:
        want.setdefault(lower(t), []).append(i)
    got = {r["doc_id"]: r for r in exact_groups(df, fingerprint_bytes=fingerprint_bytes).collect()}
    assert len(got) == len(data)
    for i, t in data:
        g, r = want[lower(t)], got[i]
        assert (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) == (max(g), len(g), i == max(g), hashlib.sha256(lower(t)).hexdigest())


def test_nulls_repeats_and_empty_table(spark):
    df = spark.createDataFrame([(None, "A"), (3, "a"), (3, "a"), (None, None)], "doc_id long, text string")
    got = exact_groups(df).collect()
    assert sum(r["kept"] for r in got) == 2 and {r["keep_id"] for r in got} == {3, None}
    assert drop_exact_copies(df).count() == 2
    assert exact_groups(df.limit(0)).count() == 0
