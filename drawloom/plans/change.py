"""Landing, change and history queries on the given tables, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from drawloom.functions.text import content_hash, part, row_hash
from drawloom.operators import cdc, history, landing
from drawloom.sources.files import scan_table

QUERIES, ORACLES = {}, {}


def query(name, sql=None):
    def put(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return put


def t(spark, d, name):
    return scan_table(spark, f"{d}/{name}.parquet")


@query("b01_content_hash", "SELECT page_id, 'sha256:' || sha256(html) AS content_hash, CAST(strlen(html) AS BIGINT) AS n_bytes FROM pages")
def b01(spark, d):
    return t(spark, d, "pages").select("page_id", content_hash(F.col("html")).alias("content_hash"), F.octet_length("html").cast("long").alias("n_bytes"))


@query("k02_append_unseen", "SELECT 'sha256:' || sha256(html) AS content_hash, min(page_id) AS page_id FROM pages WHERE sha256(html) NOT IN (SELECT sha256(html) FROM pages WHERE page_id % 2 = 0) GROUP BY 1")
def k02(spark, d):
    p = t(spark, d, "pages").select(content_hash(F.col("html")).alias("content_hash"), "page_id")
    return landing.append_unseen(p, p.where("page_id % 2 = 0"), "content_hash", "page_id")


@query("k09_run_summary", "WITH p AS (SELECT sha256(text) AS h, doc_id FROM documents), t AS (SELECT DISTINCT h FROM p WHERE doc_id % 3 = 0) SELECT count(*) AS n_read, count(DISTINCT CASE WHEN h NOT IN (SELECT h FROM t) THEN h END) AS n_inserted, count(*) - count(DISTINCT CASE WHEN h NOT IN (SELECT h FROM t) THEN h END) AS n_skipped FROM p")
def k09(spark, d):
    p = t(spark, d, "documents").select(content_hash(F.col("text")).alias("content_hash"), "doc_id")
    return landing.run_summary(p, p.where("doc_id % 3 = 0"), "content_hash")


@query("b03_detect_format", """SELECT p_partkey, CASE WHEN contains(lower(p_type), 'brass') THEN 'DEXPI' WHEN p_size % 2 = 0 THEN 'POSTPROC' WHEN p_size > 10 THEN 'DEXPI' END AS source_format,
  CASE WHEN contains(lower(p_type), 'brass') THEN 'APPLICATION' WHEN p_size % 2 = 0 THEN 'SEGMENT_TAGNAME' WHEN p_size > 10 THEN 'SEGMENT_PRESENT' ELSE 'UNKNOWN' END AS method FROM part""")
def b03(spark, d):
    args = (F.col("p_type"), "BRASS", F.col("p_size") % 2 == 0, F.col("p_size") > 10)
    return t(spark, d, "part").select("p_partkey", landing.detect_format(*args).alias("source_format"), landing.format_method(*args).alias("method"))


@query("b05_latest_revision", "SELECT o_custkey, arg_max(o_orderstatus, (o_orderdate, -o_orderkey)) AS revision, CAST(max(o_orderdate) AS DATE) AS revision_date FROM orders GROUP BY o_custkey")
def b05(spark, d):
    o = t(spark, d, "orders").select("o_custkey", F.struct(F.col("o_orderkey").cast("int").alias("ord"), F.col("o_orderstatus").alias("number"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("date")).alias("x"))
    best = landing.latest_label(F.col("labels"))
    return o.groupBy("o_custkey").agg(F.collect_list("x").alias("labels")).select("o_custkey", best["number"].alias("revision"), best["date"].cast("date").alias("revision_date"))


@query("b06_project_code", "SELECT c_custkey, nullif(trim(split_part(c_name, '#', 2)), '') AS project_code, nullif(trim(split_part(c_name, '#', 3)), '') AS third FROM customer")
def b06(spark, d):
    return t(spark, d, "customer").select("c_custkey", part(F.col("c_name"), "#", 1).alias("project_code"), part(F.col("c_name"), "#", 2).alias("third"))


@query("b07_project_code_mismatches", "SELECT count(*) FILTER (WHERE p_size % 3 = 0 AND split_part(p_type, ' ', 1) <> split_part(p_type, ' ', 2)) AS n_mismatch FROM part")
def b07(spark, d):
    p = t(spark, d, "part").select(F.when(F.col("p_size") % 3 == 0, "OVERRIDE").alias("project_code_source"), F.split_part("p_type", F.lit(" "), F.lit(1)).alias("derived_project_code"), F.split_part("p_type", F.lit(" "), F.lit(2)).alias("project_code"))
    return landing.project_code_mismatches(p)


@query("b09_size_gated_text", "SELECT page_id, CASE WHEN strlen(html) <= 2000 THEN html END AS content_text FROM pages")
def b09(spark, d):
    return t(spark, d, "pages").select("page_id", landing.size_gated_text(F.encode("html", "UTF-8"), F.octet_length("html"), 2000).alias("content_text"))


@query("c01_latest_two_versions", "WITH r AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC) AS version_rank, count(*) OVER (PARTITION BY user_id) AS n FROM events) SELECT user_id, event_id, version_rank FROM r WHERE version_rank <= 2 AND n >= 2")
def c01(spark, d):
    return cdc.latest_two(t(spark, d, "events"), "user_id", "ts", "event_id").select("user_id", "event_id", F.col("version_rank").cast("long").alias("version_rank"))


def versions(spark, d):
    """orders as the old version; the new one lacks some, changes some, adds some and has other row ids."""
    old = t(spark, d, "orders").select(F.col("o_orderkey").cast("long").alias("key"), (F.col("o_orderkey") * 2).alias("uid"), "o_custkey", "o_orderstatus", F.col("o_totalprice").cast("decimal(18,2)").alias("price"))
    new = old.where("key % 11 <> 0").withColumns({"uid": F.col("uid") + 1, "o_orderstatus": F.when(F.col("key") % 13 == 0, "Z").otherwise(F.col("o_orderstatus")), "price": F.when(F.col("key") % 17 == 0, F.col("price") + 1).otherwise(F.col("price")).cast("decimal(18,2)")})
    more = old.where("key % 19 = 0").withColumns({"key": F.col("key") + 1_000_000_000, "uid": F.col("uid") + 1})
    return old, new.unionByName(more)


@query("c08_diff_orders", """WITH o AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, CAST(o_totalprice AS DECIMAL(18,2)) AS p FROM orders),
n AS (SELECT k, c, CASE WHEN k % 13 = 0 THEN 'Z' ELSE s END AS s, CASE WHEN k % 17 = 0 THEN p + 1 ELSE p END AS p, k * 2 + 1 AS uid FROM o WHERE k % 11 <> 0 UNION ALL SELECT k + 1000000000, c, s, p, k * 2 + 1 FROM o WHERE k % 19 = 0)
SELECT CAST(coalesce(o.k, n.k) AS VARCHAR) AS key, CASE WHEN o.k IS NULL THEN 'New' WHEN n.k IS NULL THEN 'Deleted' ELSE 'Modified' END AS change_type, CAST(o.k * 2 AS VARCHAR) AS old_id, CAST(n.uid AS VARCHAR) AS new_id,
  CASE WHEN o.k IS NOT NULL AND n.k IS NOT NULL THEN concat_ws(',', CASE WHEN o.s <> n.s THEN 'o_orderstatus' END, CASE WHEN o.p <> n.p THEN 'price' END) ELSE '' END AS detail
FROM o FULL JOIN n ON o.k = n.k WHERE o.k IS NULL OR n.k IS NULL OR o.c <> n.c OR o.s <> n.s OR o.p <> n.p""")
def c08(spark, d):
    old, new = versions(spark, d)
    return cdc.diff(old, new, ["key"], "uid", ["o_custkey", "o_orderstatus", "price"]).select("key", "change_type", "old_id", "new_id", "detail")


@query("c11_summarize_deltas", """WITH o AS (SELECT o_orderkey AS k, o_orderstatus AS s FROM orders), n AS (SELECT k, CASE WHEN k % 13 = 0 THEN 'Z' ELSE s END AS s FROM o WHERE k % 11 <> 0 UNION ALL SELECT k + 1000000000, s FROM o WHERE k % 19 = 0)
SELECT count(*) FILTER (WHERE o.k IS NULL) AS n_new, count(*) FILTER (WHERE o.s <> n.s) AS n_modified, count(*) FILTER (WHERE n.k IS NULL) AS n_deleted FROM o FULL JOIN n ON o.k = n.k""")
def c11(spark, d):
    old, new = versions(spark, d)
    return cdc.summarize(cdc.diff(old, new, ["key"], "uid", ["o_orderstatus"]))


@query("c08_diff_buckets", """WITH o AS (SELECT l_orderkey AS k, l_returnflag AS f, l_linenumber AS id, CAST(l_quantity AS BIGINT) AS q FROM lineitem),
n AS (SELECT k, f, id + 100 AS id, CASE WHEN (k + id) % 5 = 0 THEN q + 7 ELSE q END AS q FROM o WHERE (k + id) % 7 <> 0),
a AS (SELECT *, row_number() OVER (PARTITION BY k, f, q ORDER BY id) AS r FROM o), b AS (SELECT *, row_number() OVER (PARTITION BY k, f, q ORDER BY id DESC) AS r FROM n),
x AS (SELECT *, row_number() OVER (PARTITION BY k, f ORDER BY CAST(id AS VARCHAR)) AS m FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.k = a.k AND b.f = a.f AND b.q = a.q AND b.r = a.r)),
y AS (SELECT *, row_number() OVER (PARTITION BY k, f ORDER BY CAST(id AS VARCHAR)) AS m FROM b WHERE NOT EXISTS (SELECT 1 FROM a WHERE b.k = a.k AND b.f = a.f AND b.q = a.q AND b.r = a.r))
SELECT CAST(coalesce(x.k, y.k) AS VARCHAR) AS bucket, coalesce(x.f, y.f) AS flag, CASE WHEN x.k IS NULL THEN 'New' WHEN y.k IS NULL THEN 'Deleted' ELSE 'Modified' END AS change_type, CAST(x.id AS VARCHAR) AS old_id, CAST(y.id AS VARCHAR) AS new_id
FROM x FULL JOIN y ON x.k = y.k AND x.f = y.f AND x.m = y.m""")
def c08b(spark, d):
    old = t(spark, d, "lineitem").select(F.col("l_orderkey").alias("bucket"), F.col("l_returnflag").alias("flag"), F.col("l_linenumber").cast("long").alias("id"), F.col("l_quantity").cast("long").alias("q"))
    new = old.where("(bucket + id) % 7 <> 0").select("bucket", "flag", (F.col("id") + 100).alias("id"), F.when((F.col("bucket") + F.col("id")) % 5 == 0, F.col("q") + 7).otherwise(F.col("q")).alias("q"))
    return cdc.diff(old, new, ["bucket", "flag"], "id", ["q"]).select("bucket", "flag", "change_type", "old_id", "new_id")


@query("c03_enrich_neighbours", """WITH e AS (SELECT DISTINCT l_partkey AS a, -1 - l_suppkey AS b FROM lineitem), u AS (SELECT a, b, true AS out FROM e UNION ALL SELECT b, a, false FROM e),
o AS (SELECT p_partkey AS id, p_brand AS anchor FROM part UNION ALL SELECT -1 - s_suppkey, 'supplier' FROM supplier)
SELECT o.id, o.anchor, coalesce(array_to_string(list_sort(list(n.anchor) FILTER (WHERE n.anchor IS NOT NULL)), ','), '') AS neighbours, count(*) FILTER (WHERE u.out) AS n_out FROM o LEFT JOIN u ON u.a = o.id LEFT JOIN o n ON n.id = u.b GROUP BY o.id, o.anchor""")
def c03(spark, d):
    """Parts and suppliers as objects; suppliers have the negative ids, so that no number of parts reaches them."""
    e = t(spark, d, "lineitem").select(F.col("l_partkey").cast("long").alias("from_id"), (-1 - F.col("l_suppkey")).cast("long").alias("to_id"), F.lit("forward").alias("flow_sense"))
    o = t(spark, d, "part").select(F.col("p_partkey").cast("long").alias("id"), F.col("p_brand").alias("anchor")).unionByName(t(spark, d, "supplier").select((-1 - F.col("s_suppkey")).cast("long").alias("id"), F.lit("supplier").alias("anchor")))
    return cdc.enrich_neighbours(o, e, "id", "anchor").select("id", "anchor", F.array_join("neighbours", ",").alias("neighbours"), F.size("outgoing").cast("long").alias("n_out"))


@query("c04_content_hashes", """SELECT count(DISTINCT (n_nationkey, n_regionkey)) AS n_eng, count(DISTINCT (n_nationkey, n_regionkey, n_name)) AS n_audit, count(*) AS n FROM nation""")
def c04(spark, d):
    n = cdc.content_hashes(t(spark, d, "nation"), ["n_nationkey", "n_regionkey"], ["n_name"])
    return n.agg(F.countDistinct("content_hash_eng").alias("n_eng"), F.countDistinct("content_hash_audit").alias("n_audit"), F.count("*").alias("n"))


@query("c06_aggregate_lines", """SELECT l_orderkey, array_to_string(list_sort(list(DISTINCT l_linestatus)), ',') AS linestatus, array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS returnflag, count(DISTINCT l_linenumber) AS piece_count,
  concat_ws(',', CASE WHEN count(DISTINCT l_linestatus) > 1 THEN 'l_linestatus' END, CASE WHEN count(DISTINCT l_returnflag) > 1 THEN 'l_returnflag' END) AS inconsistent FROM lineitem WHERE l_quantity > 5 GROUP BY l_orderkey""")
def c06(spark, d):
    x = cdc.aggregate_lines(t(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", ["l_linestatus", "l_returnflag"], F.col("l_quantity") <= 5)
    return x.select("l_orderkey", F.array_join("l_linestatus", ",").alias("linestatus"), F.array_join("l_returnflag", ",").alias("returnflag"), "piece_count", F.array_join("inconsistent", ",").alias("inconsistent"))


@query("c12_run_cdc_grains", """WITH o AS (SELECT c_custkey AS k, c_mktsegment AS m, c_nationkey AS n FROM customer), w AS (SELECT k, CASE WHEN k % 7 = 0 THEN 'X' ELSE m END AS m, n FROM o WHERE k % 9 <> 0), s AS (SELECT s_suppkey AS k, s_nationkey AS n FROM supplier), v AS (SELECT k, CASE WHEN k % 3 = 0 THEN n + 1 ELSE n END AS n FROM s)
SELECT 'customer' AS grain, CAST(coalesce(o.k, w.k) AS VARCHAR) AS anchor, CASE WHEN w.k IS NULL THEN 'Deleted' ELSE 'Modified' END AS change_type FROM o LEFT JOIN w ON o.k = w.k WHERE w.k IS NULL OR o.m <> w.m
UNION ALL SELECT 'supplier', CAST(s.k AS VARCHAR), 'Modified' FROM s JOIN v ON s.k = v.k WHERE s.n <> v.n""")
def c12(spark, d):
    o = t(spark, d, "customer").select(F.col("c_custkey").alias("k"), F.col("c_mktsegment").alias("m"), F.col("c_nationkey").alias("n"))
    w = o.where("k % 9 <> 0").withColumn("m", F.when(F.col("k") % 7 == 0, "X").otherwise(F.col("m")))
    s = t(spark, d, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_nationkey").alias("n"))
    v = s.withColumn("n", F.when(F.col("k") % 3 == 0, F.col("n") + 1).otherwise(F.col("n")))
    return cdc.run_cdc({"customer": (o, w, ["k"], "k", ["m", "n"], None), "supplier": (s, v, ["k"], "k", ["n"], None)}).select("grain", "anchor", "change_type")


def event_stream(spark, d):
    e = t(spark, d, "events")
    day = F.to_date("ts")
    return e.select("user_id", F.lit("Modified").alias("change_type"), F.col("event_type").alias("attrs"), day.alias("valid_from"), F.col("ts").alias("tx"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("delta_id"))


_FOLD = """WITH e AS (SELECT user_id, event_id, event_type, ts, CAST(ts AS DATE) AS day, lag(event_type) OVER w AS before FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
k AS (SELECT *, lead(ts) OVER w AS nts, lead(day) OVER w AS nday FROM e WHERE before IS NULL OR before <> event_type WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
h AS (SELECT user_id, event_type AS attrs, day AS valid_from, CASE WHEN nday > day THEN nday END AS valid_to, ts AS tx_from, CASE WHEN nday = day THEN nts END AS tx_to, nts IS NULL AS current FROM k) """


@query("t05_apply_events", _FOLD + "SELECT user_id, attrs, valid_from, valid_to, epoch_us(tx_from) AS tx_from_us, epoch_us(tx_to) AS tx_to_us, current FROM h")
def t05(spark, d):
    rows, _ = history.apply_events(event_stream(spark, d), ["user_id"])
    return rows.select("user_id", "attrs", "valid_from", "valid_to", F.unix_micros("tx_from").alias("tx_from_us"), F.unix_micros("tx_to").alias("tx_to_us"), "current")


@query("t06_current_truth", _FOLD + "SELECT user_id, attrs FROM h WHERE current")
def t06(spark, d):
    rows, _ = history.apply_events(event_stream(spark, d), ["user_id"])
    return history.current_truth(rows).select("user_id", "attrs")


@query("t06_as_of_valid", _FOLD + ", m AS (SELECT CAST(to_timestamp(CAST(avg(epoch(ts)) AS BIGINT)) AS DATE) AS v FROM events) SELECT user_id, attrs, valid_from FROM h, m WHERE valid_from <= v AND (valid_to IS NULL OR v < valid_to)")
def t06v(spark, d):
    rows, _ = history.apply_events(event_stream(spark, d), ["user_id"])
    v = t(spark, d, "events").agg(F.to_date(F.timestamp_seconds(F.round(F.avg(F.unix_micros(F.col("ts").cast("timestamp")) / 1e6)).cast("long"))).alias("v"))
    return history.current_truth(rows.join(F.broadcast(v), F.lit(True)), valid=F.col("v")).select("user_id", "attrs", "valid_from")


@query("t11_history_counts", _FOLD + "SELECT current, count(*) AS n FROM h GROUP BY current")
def t11(spark, d):
    rows, _ = history.apply_events(event_stream(spark, d), ["user_id"])
    return rows.groupBy("current").agg(F.count("*").alias("n"))


@query("t09_first_version", _FOLD + "SELECT user_id, attrs, valid_from FROM h QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY tx_from, valid_from) = 1")
def t09(spark, d):
    rows, _ = history.apply_events(event_stream(spark, d), ["user_id"])
    return history.first_version(rows, ["user_id"]).select("user_id", "attrs", "valid_from")


@query("j09_as_of_join_whole", _FOLD + """, o AS (SELECT o_orderkey, o_custkey % 2000 AS user_id, make_date(2024, 1, day(o_orderdate)) AS day FROM orders),
g AS (SELECT p.user_id, p.day, attrs, valid_to FROM (SELECT DISTINCT user_id, day FROM o) p JOIN h ON h.user_id = p.user_id AND valid_from <= p.day QUALIFY row_number() OVER (PARTITION BY p.user_id, p.day ORDER BY valid_from DESC, tx_from DESC, tx_to DESC NULLS FIRST) = 1)
SELECT o_orderkey, o.user_id, CASE WHEN valid_to IS NULL OR o.day < valid_to THEN attrs END AS attrs FROM o LEFT JOIN g ON g.user_id = o.user_id AND g.day = o.day""")
def j09w(spark, d):
    """Every order at its own day, in the month of the events (orders end years before them); a quarter of the keys has no history."""
    rows, _ = history.apply_events(event_stream(spark, d), ["user_id"])
    o = t(spark, d, "orders").select("o_orderkey", (F.col("o_custkey") % 2000).cast("long").alias("user_id"), F.make_date(F.lit(2024), F.lit(1), F.dayofmonth("o_orderdate")).alias("at"))
    return history.as_of_latest(o, rows, "user_id", "at").select("o_orderkey", "user_id", F.col("as_of_attrs").alias("attrs"))


@query("t04_deleted_and_collisions")
def t04(spark, d):
    e = event_stream(spark, d).withColumn("change_type", F.when(F.hash("delta_id") % 5 == 0, "Deleted").when(F.hash("delta_id") % 5 == 1, "New").otherwise("Modified"))
    _, odd = history.apply_events(e, ["user_id"])
    return odd.groupBy("reason").agg(F.count("*").alias("n"))


@query("t07_diff_snapshots", """WITH n AS (SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN 'X' ELSE c_mktsegment END AS m FROM customer WHERE c_custkey % 8 <> 0 UNION ALL SELECT c_custkey + 10000000, c_mktsegment FROM customer WHERE c_custkey % 10 = 0)
SELECT coalesce(o.c_custkey, n.c_custkey) AS c_custkey, CASE WHEN o.c_custkey IS NULL THEN 'New' WHEN n.c_custkey IS NULL THEN 'Deleted' ELSE 'Modified' END AS change_type FROM customer o FULL JOIN n ON o.c_custkey = n.c_custkey WHERE o.c_custkey IS NULL OR n.c_custkey IS NULL OR o.c_mktsegment <> n.m""")
def t07(spark, d):
    o = t(spark, d, "customer").select("c_custkey", "c_mktsegment")
    n = o.where("c_custkey % 8 <> 0").withColumn("c_mktsegment", F.when(F.col("c_custkey") % 6 == 0, "X").otherwise(F.col("c_mktsegment")))
    n = n.unionByName(o.where("c_custkey % 10 = 0").withColumn("c_custkey", F.col("c_custkey") + 10_000_000))
    return history.diff_snapshots(o, n, "c_custkey", ["c_mktsegment"]).select("c_custkey", "change_type")


@query("t12_strip_prefix", "SELECT c_custkey, substr(c_name, 10) AS tail FROM customer")
def t12(spark, d):
    return t(spark, d, "customer").select("c_custkey", history.strip_prefix(F.col("c_name"), F.lit("Customer#")).alias("tail"))


@query("t13_pieces_of_lines", "SELECT l_orderkey, string_agg(l_linenumber || ':' || l_returnflag, ',' ORDER BY l_linenumber, l_returnflag) AS pieces FROM lineitem GROUP BY l_orderkey")
def t13(spark, d):
    x = history.pieces_of(t(spark, d, "lineitem"), ["l_orderkey"], "l_linenumber", ["l_returnflag"])
    return x.select("l_orderkey", F.array_join(F.transform("pieces", lambda p: F.concat_ws(":", p["l_linenumber"].cast("string"), p["l_returnflag"])), ",").alias("pieces"))


@query("t08_content_key", "SELECT c_mktsegment, count(DISTINCT (c_nationkey, c_mktsegment)) AS n_keys FROM customer GROUP BY c_mktsegment")
def t08(spark, d):
    return t(spark, d, "customer").withColumn("k", row_hash(F.col("c_nationkey"), F.col("c_mktsegment"))).groupBy("c_mktsegment").agg(F.countDistinct("k").alias("n_keys"))
