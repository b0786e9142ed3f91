import numpy as np
import pytest
from pyspark.sql import functions as F

from drawloom.llm.common import scratch
from drawloom.llm.url_filter import Cascade, build_filters, host_of, judge, path_of

URLS = [
    (1, "https://WWW.Example.com/en/7?x=1#y"), (2, "http://a.com/en/9"), (3, "x://b.net/de/8"), (4, "x://example.net/de/81"), (5, "ftp://c.org/es/"), (6, None), (7, "no scheme"),
    (8, "http://com/en/"), (9, "http://xcom/en/"), (10, "http://h.org"), (11, "http://h.org?q"), (12, "http://sub.example.com/en/70"), (1, "a://ÉX.com#://z/"), (13, "http://a\nb.com/c\nd"), (14, ""),
]


@pytest.mark.parametrize("most_bytes,shard_bytes", [(1 << 20, 1), (0, 3)])
def test_hosts_paths_rules_and_list(spark, most_bytes, shard_bytes):
    df = spark.createDataFrame(URLS, "page_id long, url string").selectExpr("*", "1 as host", "2 as h1", "'x' as listed")
    keys = df.select(host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), F.col("page_id").isin(10, 6).alias("listed"))
    got = sorted((tuple(r) for r in judge(df, keys, most_bytes=most_bytes, shard_bytes=shard_bytes).collect()), key=repr)
    want = [
        (1, "www.example.com", "/en/7", "example.com/en/7", "allow"), (2, "a.com", "/en/9", "com/en/", "block"), (3, "b.net", "/de/8", "net/de/", "allow"),
        (4, "example.net", "/de/81", "example.net/de/8", "block"), (5, "c.org", "/es/", "org/es/", "block"), (6, "", "", None, "block"), (7, "", "", None, "block"),
        (8, "com", "/en/", "com/en/", "block"), (9, "xcom", "/en/", None, "allow"), (10, "h.org", "", None, "block"), (11, "h.org", "", None, "block"),
        (12, "sub.example.com", "/en/70", "example.com/en/7", "allow"), (1, "Éx.com", "", None, "allow"), (13, "a\nb.com", "/c\nd", None, "allow"), (14, "", "", None, "block"),
    ]
    assert got == sorted(want, key=repr)
    assert judge(df.limit(0), keys.limit(0)).count() == 0


def test_cascade_is_exact(spark):
    keys = spark.range(20_000).select(F.xxhash64("id").alias("h1"), F.xxhash64("id", F.lit(3)).alias("h2"), (F.col("id") % 7 == 0).alias("listed"))
    t = keys.toPandas()
    with scratch() as keep:
        filters = build_filters(keys, keep, rate=0.2)
        assert filters.shards == 1 and len(filters.levels) > 3
        assert (Cascade(filters.levels).listed(t.h1.to_numpy().view(np.uint64), t.h2.to_numpy().view(np.uint64)) == t.listed.to_numpy()).all()
        sharded = build_filters(keys, keep, rate=0.2, most_bytes=0, shard_bytes=400)
        assert sharded.shards > 5 and len(sharded.levels) > 3
        rows = keys.select("h1", "h2", F.col("listed").alias("want")).union(keys.limit(1).selectExpr("h1", "h2", "listed"))
        got = sharded.judged(rows.union(rows), sharded.levels)
        assert got.where("listed <> want").count() == 0 and got.count() == 40_002
