"""The streams over the events table, run to its end; each with its SQL twin."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from drawloom.plans.change import _FOLD
from drawloom.streaming import streams
from drawloom.tables import shared_dir

QUERIES, ORACLES = {}, {}
_EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"

_TURN = "conv_id long, turn long, role string, text string"


def _fresh(spark):
    at = f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"
    return f"{at}/table", f"{at}/state"


def st1(spark, d):
    """The events as a stream of files, landed once per (user, type)."""
    target, state = _fresh(spark)
    e = streams.file_stream(spark, d, _EVENTS, "events.parquet").withColumn("key", F.concat_ws("|", F.col("user_id").cast("string"), "event_type"))
    streams.land_stream(e.select("key", "event_id"), target, state, "key", "event_id")
    return spark.read.parquet(target)


def st2(spark, d):
    """History rows opened by the events as they come."""
    target, state = _fresh(spark)
    e = streams.file_stream(spark, d, _EVENTS, "events.parquet").select("user_id", F.col("event_type").alias("attrs"), F.to_date("ts").alias("valid_from"), F.col("ts").cast("timestamp").alias("tx"), F.lpad(F.col("event_id").cast("string"), 12, "0").alias("delta_id"))
    streams.to_table(streams.opened_rows(e, "user_id"), target, state)
    return spark.read.parquet(target).where("reason is null").select(F.col("key").alias("user_id"), "attrs", "valid_from", F.unix_micros("tx_from").alias("tx_from_us"))


def st1k(spark, d):
    """The turns of all conversations as a stream of files, landed once per conversation."""
    target, state = _fresh(spark)
    c = streams.file_stream(spark, f"{d}/conversations.parquet*", _TURN).select("conv_id", "turn", F.char_length("text").cast("long").alias("n"))
    streams.to_table(streams.first_rows(c, "conv_id", "turn"), target, state)
    return spark.read.schema(c.schema).parquet(target)


def st2h(spark, d):
    """The whole history that the turns make as they come, deletions and collisions included."""
    target, state = _fresh(spark)
    c = streams.file_stream(spark, f"{d}/conversations.parquet*", _TURN)
    n = F.char_length("text")
    kind = F.when(n % 5 == 0, "Deleted").when(n % 5 == 1, "New").otherwise("Modified")
    tx = F.timestamp_seconds(F.lit(1704067200) + F.col("turn") * 86400)
    e = c.select("conv_id", kind.alias("change_type"), F.concat("role", (n % 4).cast("string")).alias("attrs"), F.expr("date_add(DATE'2024-01-01', int(turn div 2 * 10))").alias("valid_from"), tx.alias("tx"), F.lpad(F.col("turn").cast("string"), 6, "0").alias("delta_id"))
    versions = streams.history_stream(e, "conv_id")
    streams.to_table(versions, target, state)
    rows, odd = streams.settled(spark.read.schema(versions.schema).parquet(target))
    us = lambda c: F.unix_micros(c)
    told = rows.select("key", F.lit("row").alias("what"), "attrs", "valid_from", "valid_to", us("tx_from").alias("tx_from_us"), us("tx_to").alias("tx_to_us"))
    return told.unionByName(odd.select("key", F.col("reason").alias("what"), F.lit(None).cast("string").alias("attrs"), F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"), us("tx").alias("tx_from_us"), F.lit(None).cast("long").alias("tx_to_us")))


QUERIES |= {"st1_first_turns": st1k, "st2_whole_history": st2h}
ORACLES |= {
    "st1_first_turns": "SELECT conv_id, min(turn) AS turn, CAST(length(arg_min(text, turn)) AS BIGINT) AS n FROM conversations GROUP BY conv_id",
    "st2_whole_history": """WITH RECURSIVE v AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS i, CASE length(text) % 5 WHEN 0 THEN 'Deleted' WHEN 1 THEN 'New' ELSE 'Modified' END AS kind, role || CAST(length(text) % 4 AS VARCHAR) AS attrs, DATE '2024-01-01' + CAST(turn // 2 * 10 AS INT) AS day, (1704067200 + turn * 86400) * 1000000 AS us FROM conversations),
r AS (SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, false AS open, CAST(NULL AS VARCHAR) AS attrs, CAST(NULL AS DATE) AS since, CAST(NULL AS BIGINT) AS us, CAST(NULL AS VARCHAR) AS what, CAST(NULL AS VARCHAR) AS c_attrs, CAST(NULL AS DATE) AS c_from, CAST(NULL AS DATE) AS c_to, CAST(NULL AS BIGINT) AS c_tx, CAST(NULL AS BIGINT) AS c_tz FROM v UNION ALL
SELECT v.conv_id, v.i, CASE WHEN r.open AND v.kind = 'Deleted' THEN false ELSE true END,
  CASE WHEN NOT r.open THEN v.attrs WHEN v.kind IN ('New', 'Deleted') OR v.attrs = r.attrs THEN r.attrs ELSE v.attrs END, CASE WHEN NOT r.open THEN v.day WHEN v.kind IN ('New', 'Deleted') OR v.attrs = r.attrs THEN r.since ELSE v.day END, CASE WHEN NOT r.open THEN v.us WHEN v.kind IN ('New', 'Deleted') OR v.attrs = r.attrs THEN r.us ELSE v.us END,
  CASE WHEN NOT r.open THEN CASE WHEN v.kind = 'Deleted' THEN 'deleted_without_current' END WHEN v.kind = 'New' THEN 'anchor_collision' WHEN v.kind = 'Deleted' OR v.attrs <> r.attrs THEN 'row' END,
  r.attrs, r.since, CASE WHEN v.kind = 'Deleted' OR v.day > r.since THEN v.day END, CASE WHEN r.open AND v.kind <> 'New' THEN r.us ELSE v.us END, CASE WHEN v.kind = 'Deleted' OR v.day = r.since THEN v.us END FROM r JOIN v ON v.conv_id = r.conv_id AND v.i = r.i + 1)
SELECT conv_id AS key, what, CASE WHEN what = 'row' THEN c_attrs END AS attrs, CASE WHEN what = 'row' THEN c_from END AS valid_from, CASE WHEN what = 'row' THEN c_to END AS valid_to, c_tx AS tx_from_us, CASE WHEN what = 'row' THEN c_tz END AS tx_to_us FROM r WHERE what IS NOT NULL
UNION ALL SELECT conv_id, 'row', attrs, since, NULL, us, NULL FROM (SELECT *, max(i) OVER (PARTITION BY conv_id) AS m FROM r) WHERE open AND i = m""",
}

QUERIES |= {"st1_stream_landing": st1, "st2_stream_history": st2}
ORACLES |= {
    "st1_stream_landing": "SELECT user_id || '|' || event_type AS key, min(event_id) AS event_id FROM events GROUP BY 1",
    "st2_stream_history": _FOLD + "SELECT user_id, attrs, valid_from, epoch_us(tx_from) AS tx_from_us FROM h",
}
