"""Bi-temporal history: valid time by transaction time, as a fold over each anchor's sorted events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from drawloom.functions.text import first_date

DATE_FORMATS = ["yyyy/MM/dd", "yyyy-MM-dd", "ddMMMyy", "dd-MMM-yy", "dd/MM/yyyy", "ddMMMyyyy"]


def valid_from(revisions: DataFrame, drawing: str, date: str) -> DataFrame:
    """The latest parsed revision date of each drawing."""
    return revisions.groupBy(drawing).agg(F.max(first_date(F.col(date), DATE_FORMATS)).alias("valid_from"))


def rejected_dates(revisions: DataFrame, date: str) -> DataFrame:
    return revisions.where(F.col(date).isNotNull() & first_date(F.col(date), DATE_FORMATS).isNull())


def attrs_json(rows: DataFrame, columns: list[str]) -> Column:
    """Canonical text of attributes: null is empty, fixed order."""
    return F.to_json(F.struct(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in sorted(columns)]))


def build_events(deltas: DataFrame, dates: DataFrame, attrs: DataFrame, drawing: str, object_id: str) -> tuple[DataFrame, DataFrame]:
    """(events, skipped): deltas with the valid date of their drawing and the attributes of the new object; skipped ones have a reason."""
    e = deltas.join(dates, drawing, "left").join(attrs, object_id, "left")
    reason = F.when(F.col("valid_from").isNull(), "no_valid_date").when((F.col("change_type") != "Deleted") & F.col("attrs").isNull(), "no_attributes")
    e = e.withColumn("reason", reason)
    return e.where("reason is null").drop("reason"), e.where("reason is not null")


def apply_events(events: DataFrame, anchor: list[str], prior: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows, anomalies) after the events of each anchor in order of (tx, delta_id).

    events: anchor, change_type, attrs, valid_from, tx, delta_id. New or Modified
    opens a row where none is open; equal attributes change nothing; an equal
    valid_from closes the transaction interval only (a correction), a later one
    the valid interval only, an earlier one is an anomaly and changes nothing;
    New on an open row is an anomaly; Deleted closes both, at whatever date, and where nothing is open
    opens an empty row and is an anomaly. prior: open rows that the fold starts from, for
    anchors that are not null and have events; of several for one anchor the last by tx_from goes on, the others stay as they are.

    Each task streams its events in order and holds one open row, however long an anchor's history is.
    """
    e = events.select(*anchor, F.lit(True).alias("_event"), F.unix_micros(F.col("tx").cast("timestamp")).alias("_tx"), F.col("delta_id").cast("string").alias("_by"), F.col("change_type").cast("string").alias("_kind"), F.unix_date(F.col("valid_from").cast("date")).alias("_from"), F.col("attrs").cast("string").alias("_attrs"))
    if prior is not None:
        known = prior.where("valid_to is null and tx_to is null").dropna(subset=anchor)
        e = e.unionByName(known.select(*anchor, F.lit(False).alias("_event"), F.unix_micros(F.col("tx_from").cast("timestamp")).alias("_tx"), F.col("superseded_by_delta").cast("string").alias("_by"), F.lit(None).cast("string").alias("_kind"), F.unix_date(F.col("valid_from").cast("date")).alias("_from"), F.col("attrs").cast("string").alias("_attrs")))
    e = e.repartition(*anchor).sortWithinPartitions(*anchor, "_event", "_tx", "_by", "_kind", "_from", "_attrs")
    types = {f.name: f.dataType.simpleString() for f in e.schema.fields}
    out = ", ".join([*(f"`{c}` {types[c]}" for c in anchor), "attrs string, _a int, _z int, _ta bigint, _tz bigint, superseded_by_delta string, reason string, delta_id string, _tx bigint"])
    folded = e.mapInArrow(_fold(len(anchor)), out)
    day, time = (lambda c: F.date_from_unix_date(c)), (lambda c: F.timestamp_micros(c))
    rows = folded.where("reason is null").select(*anchor, "attrs", day("_a").alias("valid_from"), day("_z").alias("valid_to"), time("_ta").alias("tx_from"), time("_tz").alias("tx_to"), "superseded_by_delta")
    return rows.withColumn("current", F.col("valid_to").isNull() & F.col("tx_to").isNull()), folded.where("reason is not null").select(*anchor, "reason", "delta_id", time("_tx").alias("tx"))


def _fold(n: int):
    """Rows and anomalies of sorted events; the first n columns are the anchor, then whether it is an event, tx, delta, kind, valid_from, attrs."""

    def run(batches):
        import pyarrow as pa

        # row: [attrs, valid_from, valid_to, tx_from, tx_to, superseded_by]
        key, now, waiting = None, None, []
        for b in batches:
            out = []

            def put(row=None, odd=(None, None, None)):
                out.append((*key, *(row or [None] * 6), *odd))

            for x in zip(*(c.to_pylist() for c in b.columns)):
                is_event, tx, by, kind, since, attrs = x[n:]
                if x[:n] != key:
                    if now and not waiting:
                        put(now)
                    key, now, waiting = x[:n], None, []
                if not is_event:
                    # what was open before comes out only if events follow
                    waiting.append([attrs, since, None, tx, None, by])
                    continue
                if waiting:
                    *rest, now = waiting
                    waiting = []
                    for row in rest:
                        put(row)
                opened = [attrs, since, None, tx, None, None]
                dated = now and since is not None and now[1] is not None
                if now is None:
                    now = opened
                    if kind == "Deleted":
                        now[0] = "{}" if attrs is None else attrs
                        put(odd=("deleted_without_current", by, tx))
                elif kind == "New":
                    put(odd=("anchor_collision", by, tx))
                elif kind == "Deleted":
                    put([now[0], now[1], since, now[3], tx, by])
                    now = None
                elif attrs == now[0]:
                    pass
                elif dated and since < now[1]:
                    put(odd=("retroactive_correction", by, tx))
                elif dated and since == now[1]:
                    put([*now[:4], tx, by])
                    now = opened
                else:
                    put([*now[:2], since, now[3], now[4], by])
                    now = opened
            if out:
                yield _arrow(pa, b.schema, n, out)
            schema = b.schema
        if now and not waiting:
            yield _arrow(pa, schema, n, [(*key, *now, None, None, None)])

    return run


def _arrow(pa, schema, n: int, rows: list[tuple]):
    t = [*(schema.field(i).type for i in range(n)), pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64()]
    names = [*schema.names[:n], "attrs", "_a", "_z", "_ta", "_tz", "superseded_by_delta", "reason", "delta_id", "_tx"]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), t)], names=names)


def current_truth(rows: DataFrame, valid: Column | None = None, tx: Column | None = None) -> DataFrame:
    """Rows that hold at the given times, intervals half-open; with one axis given the other is free; with none, rows open on both."""
    if valid is None and tx is None:
        return rows.where("valid_to is null and tx_to is null")
    out = rows
    if valid is not None:
        out = out.where((F.col("valid_from") <= valid) & (F.col("valid_to").isNull() | (valid < F.col("valid_to"))))
    if tx is not None:
        out = out.where((F.col("tx_from") <= tx) & (F.col("tx_to").isNull() | (tx < F.col("tx_to"))))
    return out


def as_of(left: DataFrame, history: DataFrame, key: str, at: str) -> DataFrame:
    """left with all rows of the history that hold at left.at on the valid axis, on any transaction time; compared once per key and date."""
    h = history.select(F.col(key).alias("_h"), F.col("attrs").alias("as_of_attrs"), F.col("valid_from").alias("_a"), F.col("valid_to").alias("_z"))
    asked = left.select(F.col(key).alias("_k"), F.col(at).alias("_at")).distinct()
    hits = asked.join(h, (F.col("_k") == F.col("_h")) & (F.col("_a") <= F.col("_at")) & (F.col("_z").isNull() | (F.col("_at") < F.col("_z")))).select("_k", "_at", "as_of_attrs")
    return left.join(hits, (F.col(key) == F.col("_k")) & (F.col(at) == F.col("_at")), "left").drop("_k", "_at")


def as_of_latest(left: DataFrame, history: DataFrame, key: str, at: str) -> DataFrame:
    """Each row of left once, with the attributes that hold at left.at on the valid axis after all corrections; null where there are none.

    Of rows of one valid_from the last by transaction time counts. Looked up once per
    key and date, by union and last(), so that a key has at most two rows per date in a window.
    """
    latest = F.max_by(F.struct("attrs", "valid_to"), F.struct("tx_from", F.col("tx_to").isNull(), "tx_to", "attrs"))
    h = history.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k"), F.col("valid_from").alias("_at")).agg(latest.alias("_h"))
    asked = left.select(F.col(key).alias("_k"), F.to_date(at).alias("_at")).where("_k is not null and _at is not null").distinct()
    # at the same date the history comes first: a row holds from its valid_from on
    w = Window.partitionBy("_k").orderBy("_at", F.col("_ask")).rowsBetween(Window.unboundedPreceding, 0)
    both = h.withColumn("_ask", F.lit(False)).unionByName(asked.withColumn("_ask", F.lit(True)), allowMissingColumns=True)
    found = both.withColumn("_h", F.last("_h", ignorenulls=True).over(w)).where("_ask").select("_k", "_at", F.when(F.col("_h.valid_to").isNull() | (F.col("_at") < F.col("_h.valid_to")), F.col("_h.attrs")).alias("as_of_attrs"))
    return left.join(found, (F.col(key) == F.col("_k")) & (F.to_date(at) == F.col("_at")), "left").drop("_k", "_at")


#: Slabs of time are 1, 8, 64, ... days wide; the open end lies after the last date that Spark knows.
_SLABS = range(0, 22, 3)
_FAR = 1 << 22


def _numbered(slabs: Column, width: int) -> Column:
    return F.transform(slabs, lambda i: F.struct(F.lit(width).alias("width"), i.alias("slab")))


def _slabs_of(first: Column, last: Column) -> Column:
    """The fewest slabs that make up the days first, ..., last - 1, as structs of width (a power of two) and number; each day lies in exactly one."""
    up = lambda c, s: F.shiftright(c + F.lit((1 << s) - 1), s)
    none = F.array().cast("array<bigint>")
    run = lambda a, z: F.when(a < z, F.sequence(a, z - 1)).otherwise(none)
    parts = []
    for s in _SLABS:
        lo, hi = up(first, s), F.shiftright(last, s)
        if s == _SLABS[-1]:
            held = run(lo, hi)
        else:
            wide_lo, wide_hi = 8 * up(first, s + 3), 8 * F.shiftright(last, s + 3)
            held = F.when(wide_lo < wide_hi, F.concat(run(lo, wide_lo), run(wide_hi, hi))).otherwise(run(lo, hi))
        parts.append(_numbered(held, s))
    return F.concat(*parts)


def as_of_both(left: DataFrame, history: DataFrame, key: str, valid: str, tx: str) -> DataFrame:
    """left with every row of its key's history that holds at left's valid date and was recorded at its transaction time, as as_of_attrs, as_of_from; null where there is none.

    Intervals are half-open, open ends hold on; a null key, date or time matches nothing, nor do rows that start at null or
    before they end. Valid time is cut into slabs of several widths: each row of history is dealt
    to the few slabs that make up its interval (at most 14 of one width), each date asked for to the one slab of each width that holds it, so a
    row meets the dates inside its interval only, once each, and a key with most of all rows is split by its
    slabs. Transaction times are compared there. Dates and times are looked up once per key.
    """
    day = lambda c: F.unix_date(F.to_date(c)).cast("long")
    h = history.where(F.col(key).isNotNull() & F.col("valid_from").isNotNull() & F.col("tx_from").isNotNull()).select(
        F.col(key).alias("_k"), "attrs", "valid_from", "tx_from", "tx_to",
        F.explode(_slabs_of(day("valid_from"), F.coalesce(day("valid_to"), F.lit(_FAR).cast("long")))).alias("_s"),
    ).select("_k", "_s.*", "attrs", "valid_from", F.col("tx_from").alias("_ta"), F.col("tx_to").alias("_tz"))
    asked = left.select(F.col(key).alias("_k"), F.to_date(valid).alias("_v"), F.col(tx).cast("timestamp").alias("_t")).dropna().distinct()
    points = asked.select("*", F.explode(F.array(*[F.struct(F.lit(s).alias("width"), F.shiftright(day("_v"), s).alias("slab")) for s in _SLABS])).alias("_s")).select("_k", "_v", "_t", "_s.*")
    hits = points.join(h, ["_k", "width", "slab"]).where((F.col("_ta") <= F.col("_t")) & (F.col("_tz").isNull() | (F.col("_t") < F.col("_tz"))))
    hits = hits.select("_k", "_v", "_t", F.col("attrs").alias("as_of_attrs"), F.col("valid_from").alias("as_of_from"))
    on = (F.col(key) == F.col("_k")) & (F.to_date(valid) == F.col("_v")) & (F.col(tx).cast("timestamp") == F.col("_t"))
    return left.join(hits, on, "left").drop("_k", "_v", "_t")


def diff_snapshots(old: DataFrame, new: DataFrame, id_col: str, columns: list[str]) -> DataFrame:
    """New, Modified and Deleted ids by comparing the columns (answer-key columns are not among them)."""
    h = lambda df, n: df.select(F.col(id_col), F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias(n), attrs_json(df, columns).alias(f"{n}_attrs"))
    j = h(old, "o").join(h(new, "n"), id_col, "full_outer")
    kind = F.when(F.col("o").isNull(), "New").when(F.col("n").isNull(), "Deleted").when(F.col("o_attrs") != F.col("n_attrs"), "Modified")
    return j.select(id_col, kind.alias("change_type"), F.col("n_attrs").alias("attrs")).where("change_type is not null")


def object_history(rows: DataFrame, anchor: str, value) -> DataFrame:
    return rows.where(F.col(anchor) == value).orderBy("tx_from", "valid_from")


def first_version(rows: DataFrame, anchor: list[str]) -> DataFrame:
    w = Window.partitionBy(*anchor).orderBy("tx_from", "valid_from")
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def strip_prefix(uid: Column, prefix: Column) -> Column:
    """The tag after a known prefix; the tag may hold the separator."""
    return F.when(F.startswith(uid, prefix), F.substr(uid, F.length(prefix) + 1))


def pieces_of(rows: DataFrame, line: list[str], id_col: str, columns: list[str]) -> DataFrame:
    return rows.groupBy(*line).agg(F.array_sort(F.collect_list(F.struct(id_col, *columns))).alias("pieces"))
