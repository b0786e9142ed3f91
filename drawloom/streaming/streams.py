"""Structured Streaming: continuous landing and continuous history, run to what is available now."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from drawloom.operators.landing import append_unseen

BINARY_FILE = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, path: str, schema: str, pattern: str = "*", form: str = "parquet", files_per_batch: int = 1000) -> DataFrame:
    """New files under path as a stream."""
    return spark.readStream.format(form).schema(schema).option("pathGlobFilter", pattern).option("maxFilesPerTrigger", files_per_batch).load(path)


def land_stream(stream: DataFrame, target: str, checkpoint: str, key: str, order: str | None = None) -> None:
    """Append each micro-batch's unseen keys to the Parquet table at target. A batch that is run again after a failure adds nothing twice, since its keys are then seen."""

    def put(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        at = spark._jvm.org.apache.hadoop.fs.Path(target)
        there = at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at)
        known = spark.read.schema(batch.schema).parquet(target) if there else batch.limit(0)
        append_unseen(batch, known, key, order).write.mode("append").parquet(target)

    stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def opened_rows(events: DataFrame, key: str) -> DataFrame:
    """The history rows that a stream of changes opens, per key in order of (tx, delta_id), and what it may not apply.

    events: key (long), attrs, valid_from (date), tx (timestamp), delta_id. State per
    key is the open row only. Late changes (a valid_from before the open row's) come
    out with their reason instead of a row.
    """

    def step(k, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        attrs, since = state.get if state.exists else (None, None)
        opened = state.exists
        rows = []
        batch = pd.concat(list(frames)).sort_values(["tx", "delta_id"])
        for a, day, tx, delta in zip(batch["attrs"], batch["valid_from"], batch["tx"], batch["delta_id"]):
            if opened and a == attrs:
                continue
            late = opened and day < since
            rows.append((k[0], a, day, tx, delta, "retroactive_correction" if late else None))
            if not late:
                attrs, since, opened = a, day, True
        if opened:
            state.update((attrs, since))
        yield pd.DataFrame(rows, columns=["key", "attrs", "valid_from", "tx_from", "delta_id", "reason"])

    out = "key long, attrs string, valid_from date, tx_from timestamp, delta_id string, reason string"
    return events.groupBy(key).applyInPandasWithState(step, out, "attrs string, since date", "append", GroupStateTimeout.NoTimeout)


def first_rows(stream: DataFrame, key: str, order: str) -> DataFrame:
    """The stream's rows of keys that have not come before, one per key: the least by `order` of the micro-batch that brings the key first.

    State per key is that it has come, so no micro-batch reads the table that the stream lands in. Nulls are one key; of equal order the
    row that comes first in its task.
    """

    def step(k, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        best = None
        for f in frames:
            if not state.exists and len(f):
                f = f if best is None else pd.concat([best, f])
                best = f.sort_values(order, kind="stable", na_position="last").head(1)
        if best is not None:
            state.update((True,))
            yield best

    return stream.groupBy(key).applyInPandasWithState(step, stream.schema, "seen boolean", "append", GroupStateTimeout.NoTimeout)


_ROW = ["attrs", "valid_from", "valid_to", "tx_from", "tx_to", "superseded_by_delta"]


def history_stream(events: DataFrame, key: str) -> DataFrame:
    """The whole history that a stream of changes makes, row versions as they open and close, and what may not be applied.

    events: key (long), change_type, attrs, valid_from (date), tx (timestamp), delta_id, applied per key in order of (tx, delta_id) as
    history.apply_events does: Deleted closes both axes, an equal valid date is a correction, an earlier one, New on an open row and Deleted without one
    are anomalies. An event of a transaction before those of an earlier micro-batch comes out as late_transaction and changes nothing. State per key
    is its open row and its last transaction. Of a row that has been open at the end of a micro-batch and closes later two versions come out, see settled.
    """

    def step(k, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, opened, attrs, since, tx_from, last = state.get if state.exists else (0, False, None, None, None, None)
        now, fresh, out = [attrs, since, None, tx_from, None, None] if opened else None, False, []
        odd = lambda reason, by, tx: out.append((k[0], None, *[None] * 6, False, reason, by, tx))
        put = lambda row, closed: out.append((k[0], n, *row, closed, None, None, None))
        before = last
        batch = pd.concat(list(frames)).astype(object)
        batch = batch.where(batch.notna(), None).sort_values(["tx", "delta_id"])
        for kind, attrs, day, tx, by in zip(*(batch[c] for c in ("change_type", "attrs", "valid_from", "tx", "delta_id"))):
            if before is not None and tx is not None and tx < before:
                odd("late_transaction", by, tx)
                continue
            last = tx if last is None or tx is not None and tx > last else last
            dated = now is not None and day is not None and now[1] is not None
            if now is None:
                n, now, fresh = n + 1, [attrs, day, None, tx, None, None], True
                if kind == "Deleted":
                    now[0] = "{}" if attrs is None else attrs
                    odd("deleted_without_current", by, tx)
            elif kind == "New":
                odd("anchor_collision", by, tx)
            elif kind == "Deleted":
                put([*now[:2], day, now[3], tx, by], True)
                now = None
            elif attrs == now[0]:
                pass
            elif dated and day < now[1]:
                odd("retroactive_correction", by, tx)
            else:
                same = dated and day == now[1]
                put([*now[:2], None if same else day, now[3], tx if same else None, by], True)
                n, now, fresh = n + 1, [attrs, day, None, tx, None, None], True
        if now is not None and fresh:
            put(now, False)
        state.update((n, now is not None, *((now[0], now[1], now[3]) if now else (None, None, None)), last))
        yield pd.DataFrame(out, columns=["key", "n", *_ROW, "closed", "reason", "delta_id", "tx"])

    out = "key long, n int, attrs string, valid_from date, valid_to date, tx_from timestamp, tx_to timestamp, superseded_by_delta string, closed boolean, reason string, delta_id string, tx timestamp"
    held = "n int, opened boolean, attrs string, since date, tx_from timestamp, last timestamp"
    return events.groupBy(key).applyInPandasWithState(step, out, held, "append", GroupStateTimeout.NoTimeout)


def settled(versions: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, anomalies) of what history_stream has put out: of each row its closed version, if it has one."""
    rows = versions.where("reason is null").groupBy("key", "n").agg(F.max_by(F.struct(*_ROW), "closed").alias("x")).select("key", "x.*")
    return rows.withColumn("current", F.col("valid_to").isNull() & F.col("tx_to").isNull()), versions.where("reason is not null").select("key", "reason", "delta_id", "tx")


def to_table(stream: DataFrame, target: str, checkpoint: str) -> None:
    stream.writeStream.format("parquet").option("path", target).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start().awaitTermination()
