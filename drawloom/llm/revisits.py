"""Resolution of not-modified revisits of an archive, as joins and windows of Spark.

Each revisit takes the latest earlier full response of its canonical URL. The
as-of join runs in two levels, so that a URL with a great part of all captures
is spread: inside a slice of time by a window, and for what the slice lacks by
the last response of each earlier slice, of which a URL has few. Payloads are not
moved, only the response's id, digest and headers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawloom.llm.common import ascii_lower, table

#: Headers that a not-modified answer may bring up to date.
PERMITTED = ["cache-control", "content-location", "date", "etag", "expires", "last-modified", "vary"]


def canonical_url(url: Column) -> Column:
    """host/path?query of a url: scheme, www., default port, fragment, tracking parameters and final slashes go, A-Z of the host are lower-cased; null counts as empty."""
    u = F.regexp_replace(F.coalesce(url, F.lit("")), r"(?s)#.*$", "")
    rest = F.regexp_replace(u, r"^[A-Za-z][A-Za-z0-9+.-]*://", "")
    host = F.regexp_replace(ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?]*)", 1)), r"^www\.|:(80|443)$", "")
    path = F.regexp_replace(F.regexp_extract(rest, r"(?s)^[^/?]*([^?]*)", 1), r"/+$", "")
    query = F.regexp_replace(F.regexp_extract(rest, r"(?s)\?(.*)$", 1), r"(^|&)(utm_[a-z]+|ref)=[^&]*", "")
    query = F.regexp_replace(query, r"^&+", "")
    return F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(F.lit("")))


def lower_names(headers: Column) -> Column:
    """The headers with lower-case names; of names that differ in case only, the first stays; null is no headers."""
    entries = F.map_entries(F.coalesce(headers, F.create_map().cast("map<string,string>")))
    names = F.transform(entries, lambda e: F.lower(e["key"]))
    first = F.filter(entries, lambda e, i: F.array_position(names, F.lower(e["key"])) == i + 1)
    return F.map_from_entries(F.transform(first, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))))


def merge_headers(response: Column, revisit: Column) -> Column:
    """The response's headers with those of the revisit that it may bring up to date."""
    new = F.map_filter(revisit, lambda k, v: k.isin(PERMITTED) & v.isNotNull())
    return F.map_concat(F.map_filter(response, lambda k, v: ~F.map_contains_key(new, k)), new)


def validators_agree(response: Column, revisit: Column, digests: tuple[Column, Column]) -> Column:
    """True or false by the strongest validator that both have (digest, etag without weakness mark, last-modified); null if there is none."""
    tag = lambda h: F.regexp_replace(F.try_element_at(h, F.lit("etag")), "^W/", "")
    seen = lambda h: F.try_element_at(h, F.lit("last-modified"))
    return F.coalesce(digests[0] == digests[1], tag(response) == tag(revisit), seen(response) == seen(revisit))


def resolve_revisits(records: DataFrame, slice_width: int = 86_400) -> DataFrame:
    """One row per revisit: record_id, canonical_url, ts, source_id, status, digest, headers.

    records: record_id (long), url, ts (long), kind (response or revisit, others
    are ignored), digest and headers (map<string,string>), any of them null. A
    revisit is resolved if the validators agree, unverified if there is none to
    compare, a mismatch if they differ (headers are then its own), and
    without_response if no response of the URL has a smaller ts. Of responses at
    the same ts the largest record_id counts. A null ts is at no known time: such a
    response is earlier than nothing, such a revisit has none before it, and its ts
    stays null. Null urls, and those of which nothing is left, are no url that could have a response. Repeated revisits give a row each. Extra columns are not carried.
    """
    r = records.select(
        F.col("record_id").cast("long").alias("record_id"), canonical_url(F.col("url")).alias("canonical_url"),
        F.col("ts").cast("long").alias("ts"), F.col("kind").alias("kind"), F.col("digest").alias("digest"), lower_names(F.col("headers")).alias("headers"),
    ).where(F.col("kind").isin("response", "revisit"))
    known = F.col("ts").isNotNull() & (F.col("canonical_url") != "")
    lost = r.where((F.col("kind") == "revisit") & ~known)
    r = r.where(known).withColumn("slice", F.floor(F.col("ts") / slice_width))
    full = F.when(F.col("kind") == "response", F.struct("record_id", "digest", "headers"))
    # at the same ts a revisit comes first: a response is earlier only if its ts is smaller
    order = Window.partitionBy("canonical_url", "slice").orderBy("ts", F.col("kind").desc(), "record_id").rowsBetween(Window.unboundedPreceding, -1)
    here = r.withColumn("near", F.last(full, ignorenulls=True).over(order)).where("kind = 'revisit'")
    ends = r.where("kind = 'response'").groupBy("canonical_url", "slice").agg(F.max_by(F.struct("record_id", "digest", "headers"), F.struct("ts", "record_id")).alias("end"))
    needed = here.where("near is null").select("canonical_url", "slice").distinct().withColumn("end", F.lit(None).cast(ends.schema["end"].dataType))
    before = Window.partitionBy("canonical_url").orderBy("slice", F.col("end").isNotNull())
    far = ends.unionByName(needed).withColumn("far", F.last("end", ignorenulls=True).over(before.rowsBetween(Window.unboundedPreceding, -1))).where("end is null").select("canonical_url", "slice", "far")
    x = here.join(far, ["canonical_url", "slice"], "left").withColumn("source", F.coalesce("near", "far")).drop("slice", "near", "far")
    x = x.unionByName(lost.withColumn("source", F.lit(None).cast(x.schema["source"].dataType)))
    agree = validators_agree(F.col("source.headers"), F.col("headers"), (F.col("source.digest"), F.col("digest")))
    status = F.when(F.col("source").isNull(), "without_response").when(agree, "resolved").when(~agree, "mismatch").otherwise("unverified")
    x = x.withColumn("status", status)
    took = F.col("status").isin("resolved", "unverified")
    return x.select(
        "record_id", "canonical_url", "ts", F.col("source.record_id").alias("source_id"), "status",
        F.when(took, F.col("source.digest")).otherwise(F.col("digest")).alias("digest"),
        F.when(took, merge_headers(F.col("source.headers"), F.col("headers"))).otherwise(F.col("headers")).alias("headers"),
    )


def captures(pages: DataFrame) -> DataFrame:
    """Two captures of each page, as pages has no archive records: a full response at ts 10 * page_id (not for each 11th) and a later revisit.

    Each 7th revisit has another etag; each 5th has no etag, and each 10th no
    last-modified either.
    """
    i = F.col("page_id")
    tag = F.concat(F.lit('"'), F.md5(F.coalesce("html", F.lit(""))), F.lit('"'))
    day = F.concat(F.lit("day "), (i % 28).cast("string"))
    when = lambda c, v: F.when(c, v)
    response = pages.where("page_id % 11 <> 0").select(
        (i * 2).alias("record_id"), "url", (i * 10).alias("ts"), F.lit("response").alias("kind"), F.lit(None).cast("string").alias("digest"),
        F.create_map(F.lit("Content-Type"), F.lit("text/html"), F.lit("ETag"), tag, F.lit("Last-Modified"), day, F.lit("Date"), F.concat(F.lit("at "), (i * 10).cast("string"))).alias("headers"),
    )
    revisit = pages.select(
        (i * 2 + 1).alias("record_id"), F.concat(F.col("url"), F.lit("#again")).alias("url"), (i * 10 + 5 + (i % 4) * 1000).alias("ts"), F.lit("revisit").alias("kind"), F.lit(None).cast("string").alias("digest"),
        F.create_map(
            F.lit("etag"), when(i % 5 != 0, F.when(i % 7 == 0, F.lit('"other"')).otherwise(F.concat(F.lit("W/"), tag))), F.lit("last-modified"), when(i % 10 != 0, day),
            F.lit("date"), F.concat(F.lit("later "), i.cast("string")), F.lit("content-type"), F.lit("x/y"),
        ).alias("headers"),
    )
    return response.unionByName(revisit)


def query(spark, sf_dir: str) -> DataFrame:
    """op3: see resolve_revisits, over captures of all pages."""
    out = resolve_revisits(captures(table(spark, sf_dir, "pages")), slice_width=100_000)
    h = lambda name: F.try_element_at("headers", F.lit(name))
    return out.select(
        "record_id", "canonical_url", "ts", "source_id", "status", h("etag").alias("etag"), h("last-modified").alias("last_modified"), h("date").alias("date"),
        h("content-type").alias("content_type"), F.size("headers").cast("long").alias("n_headers"),
    )


ORACLE = r"""
WITH p AS (
  SELECT page_id AS i, '"' || md5(coalesce(html, '')) || '"' AS tag, 'day ' || (page_id % 28) AS day,
    regexp_replace(coalesce(url, ''), '#.*$', '', 's') AS u, url IS NULL AS no_url FROM pages
), q AS (SELECT *, regexp_replace(u, '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS r FROM p
), k AS (SELECT i, tag, day,
    regexp_replace(lower(regexp_extract(r, '^([^/?]*)', 1)), '^www\.|:(80|443)$', '', 'g') || regexp_replace(regexp_extract(r, '^[^/?]*([^?]*)', 1), '/+$', '') AS base,
    regexp_replace(regexp_replace(regexp_extract(r, '\?(.*)$', 1), '(^|&)(utm_[a-z]+|ref)=[^&]*', '', 'g'), '^&+', '') AS qs FROM q
), c AS (SELECT i, tag, day, base || CASE WHEN qs <> '' THEN '?' || qs ELSE '' END AS canonical_url FROM k
), res AS (SELECT i * 2 AS id, canonical_url, i * 10 AS ts, tag, day, 'at ' || (i * 10) AS dt FROM c WHERE i % 11 <> 0
), rev AS (SELECT i * 2 + 1 AS record_id, canonical_url, i * 10 + 5 + (i % 4) * 1000 AS ts,
    CASE WHEN i % 5 <> 0 THEN CASE WHEN i % 7 = 0 THEN '"other"' ELSE 'W/' || tag END END AS tag, CASE WHEN i % 10 <> 0 THEN day END AS day, 'later ' || i AS dt FROM c
), j AS (
  SELECT rev.*, m.id AS source_id, m.tag AS rtag, m.day AS rday, m.dt AS rdt FROM rev LEFT JOIN (
    SELECT rev.record_id, res.*, row_number() OVER (PARTITION BY rev.record_id ORDER BY res.ts DESC, res.id DESC) AS n
    FROM rev JOIN res ON res.canonical_url = rev.canonical_url AND rev.canonical_url <> '' AND res.ts < rev.ts) m ON m.record_id = rev.record_id AND m.n = 1
), s AS (SELECT *, coalesce(rtag = regexp_replace(tag, '^W/', ''), rday = day) AS agree FROM j
), t AS (SELECT *, CASE WHEN source_id IS NULL THEN 'without_response' WHEN agree THEN 'resolved' WHEN NOT agree THEN 'mismatch' ELSE 'unverified' END AS status FROM s)
SELECT record_id, canonical_url, ts, source_id, status,
  CASE WHEN status IN ('resolved', 'unverified') THEN coalesce(tag, rtag) ELSE tag END AS etag,
  CASE WHEN status IN ('resolved', 'unverified') THEN coalesce(day, rday) ELSE day END AS last_modified, dt AS date,
  CASE WHEN status IN ('resolved', 'unverified') THEN 'text/html' ELSE 'x/y' END AS content_type, CAST(4 AS BIGINT) AS n_headers
FROM t
"""
