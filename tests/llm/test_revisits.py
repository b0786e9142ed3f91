from pyspark.sql import functions as F

from drawloom.llm.revisits import canonical_url, resolve_revisits


def test_resolution(spark):
    h = lambda **x: {k.replace("_", "-"): v for k, v in x.items()}
    rows = [
        (1, "http://www.A.com:80/x/?utm_source=q", 5, "response", None, h(ETag='"1"', Date="d1", Server="s")),
        (2, "https://a.com/x", 50, "response", None, h(ETag='"2"', Date="d2", date="late", Server="s")),
        (3, "https://a.com/x", 50, "response", None, h(ETag='"3"', Date="d3")),
        (10, "https://a.com/x#f", 50, "revisit", None, h(etag='W/"1"', Date="n", Server="new")),
        (11, "https://a.com/x", 51, "revisit", None, h(etag='"3"')),
        (12, "https://a.com/x", 900, "revisit", None, h(etag='"2"')),
        (13, "https://a.com/x", 5, "revisit", None, None),
        (14, "https://a.com/x", 60, "revisit", None, h(x="y")),
        (15, None, None, "revisit", "q", None),
        (17, None, 1, "response", "q", None), (18, "", 9, "revisit", "q", None), (19, "https://a.com/x", None, "response", "r", h(a="b")), (20, "https://a.com/x", None, "revisit", "r", None),
        (21, "https://c.com", 1, "response", "d1", h(etag='"1"')), (22, "https://c.com", 2, "revisit", "d2", h(etag='"1"')), (23, "https://c.com", 3, "revisit", "d1", h(etag='"2"')),
        (16, "https://b.com/?b=1&ref=x", 7, "request", None, None),
    ]
    df = spark.createDataFrame(rows, "record_id long, url string, ts long, kind string, digest string, headers map<string,string>").withColumn("slice", F.lit(1)).withColumn("far", F.lit(2))
    for width in (10, 10_000):
        got = {r["record_id"]: (r["source_id"], r["status"], r["headers"]) for r in resolve_revisits(df, width).collect()}
        assert got == {
            10: (1, "resolved", {"etag": 'W/"1"', "date": "n", "server": "s"}), 11: (3, "resolved", {"etag": '"3"', "date": "d3"}), 12: (3, "mismatch", {"etag": '"2"'}),
            13: (None, "without_response", {}), 14: (3, "unverified", {"etag": '"3"', "date": "d3"}), 15: (None, "without_response", {}),
            18: (None, "without_response", {}), 20: (None, "without_response", {}), 22: (21, "mismatch", {"etag": '"1"'}), 23: (21, "resolved", {"etag": '"2"'}),
        }
    assert {r["record_id"] for r in resolve_revisits(df).where("ts is null").collect()} == {15, 20}
    assert resolve_revisits(df.limit(0)).count() == 0
    assert df.where("record_id = 16").select(canonical_url(F.col("url"))).first()[0] == "b.com?b=1"
