import datetime as dt
import os
import random

import pytest

from drawloom import tables
from drawloom.operators import history
from drawloom.streaming import streams

EVENTS = "k long, change_type string, attrs string, valid_from date, tx timestamp, delta_id string"


def batches(seed=5, keys=25, n=3):
    """n lots of events, each later than the one before in transaction time; valid dates go back and forth."""
    r = random.Random(seed)
    out, i = [], 0
    for b in range(n):
        rows = []
        for _ in range(120):
            i += 1
            day = dt.date(2024, 1, 1) + dt.timedelta(r.choice([0, 0, 5, 9, 30 * b, 10 * b + 3]))
            rows.append((r.randrange(keys), r.choice(["New", "Modified", "Modified", "Modified", "Deleted"]), r.choice(["a", "b", "c"]), day, dt.datetime(2024, 1, 1 + b) + dt.timedelta(seconds=r.randrange(60)), f"{i:05d}"))
        out.append(rows)
    return out


def feed(spark, path, lots):
    for i, rows in enumerate(lots):
        spark.createDataFrame(rows, EVENTS).coalesce(1).write.mode("append").parquet(path)
        for f in os.listdir(path):
            if f.endswith(".parquet") and not f.startswith("lot"):
                os.rename(f"{path}/{f}", f"{path}/lot{i}.parquet")
                crc = f"{path}/.{f}.crc"
                if os.path.exists(crc):
                    os.remove(crc)
                os.utime(f"{path}/lot{i}.parquet", (1_700_000_000 + i * 100,) * 2)


def settled(spark, path, target, state, per_batch):
    e = streams.file_stream(spark, path, EVENTS, "lot*.parquet", files_per_batch=per_batch)
    versions = streams.history_stream(e, "k")
    streams.to_table(versions, target, state)
    return streams.settled(spark.read.schema(versions.schema).parquet(target))


def plain(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_three_micro_batches_equal_the_batch_fold(spark, tmp_path):
    lots = batches()
    feed(spark, f"{tmp_path}/in", lots)
    rows, odd = settled(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", 1)
    want, wrong = history.apply_events(spark.createDataFrame([x for lot in lots for x in lot], EVENTS), ["k"])
    columns = ["attrs", "valid_from", "valid_to", "tx_from", "tx_to", "superseded_by_delta", "current"]
    assert plain(rows, "key", *columns) == plain(want, "k", *columns)
    assert plain(odd, "key", "reason", "delta_id", "tx") == plain(wrong, "k", "reason", "delta_id", "tx")
    assert {r["reason"] for r in odd.collect()} == {"anchor_collision", "deleted_without_current", "retroactive_correction"}


def test_late_transactions_are_told_and_a_restart_goes_on(spark, tmp_path):
    first, second, _ = batches(6)
    feed(spark, f"{tmp_path}/in", [second])
    settled(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", 1)
    feed(spark, f"{tmp_path}/in2", [[], first])
    os.rename(f"{tmp_path}/in2/lot1.parquet", f"{tmp_path}/in/lot1.parquet")
    rows, odd = settled(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", 1)
    known = {x[0] for x in second}
    assert {r["delta_id"] for r in odd.where("reason = 'late_transaction'").collect()} == {x[5] for x in first if x[0] in known}
    again, _ = settled(spark, f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state", 1)
    assert again.count() == rows.count()


def test_first_rows_come_once_over_micro_batches(spark, tmp_path):
    feed(spark, f"{tmp_path}/in", batches(7))
    e = streams.file_stream(spark, f"{tmp_path}/in", EVENTS, "lot*.parquet", files_per_batch=1)
    streams.to_table(streams.first_rows(e, "k", "delta_id"), f"{tmp_path}/out", f"{tmp_path}/state")
    got = sorted((r["k"], r["delta_id"]) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    want = {}
    for lot in batches(7):
        for k, best in {x[0]: min(y[5] for y in lot if y[0] == x[0]) for x in lot}.items():
            want.setdefault(k, best)
    assert got == sorted(want.items())


def test_append_reads_only_the_buckets_it_touches(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "key string, v int"
    df = lambda rows: spark.createDataFrame(rows, schema)
    tables.append_bucketed(df([(f"k{i}", i) for i in range(200)] + [(None, -1)]), path, "key", 16)
    more = df([("k5", 99), ("new", 1), ("new", 2), (None, -2)])
    touched = tables._touched(more, "key", 16)
    assert len(touched) <= 3
    aside = []
    for b in range(16):
        if b not in touched and os.path.isdir(f"{path}/bucket={b}"):
            os.rename(f"{path}/bucket={b}", f"{tmp_path}/{b}")
            os.mkdir(f"{path}/bucket={b}")
            with open(f"{path}/bucket={b}/part-0.parquet", "w") as f:
                f.write("not to be read")
            aside.append(b)
    assert len(aside) >= 12
    for _ in range(2):
        tables.append_bucketed(more, path, "key", 16, "v")
    for b in aside:
        os.remove(f"{path}/bucket={b}/part-0.parquet")
        os.rmdir(f"{path}/bucket={b}")
        os.rename(f"{tmp_path}/{b}", f"{path}/bucket={b}")
    got = sorted(map(tuple, tables.read_buckets(spark, path, more.schema).collect()), key=repr)
    want = [(f"k{i}", i) for i in range(200)] + [("new", 1)]
    assert [x for x in got if x[0]] == sorted(want, key=repr)


def test_replace_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    path, schema = f"{tmp_path}/t", "key string, v int"
    df = lambda rows: spark.createDataFrame(rows, schema)
    tables.append_bucketed(df([(f"k{i}", i) for i in range(50)]), path, "key", 16)
    files = lambda: set(tables.read_buckets(spark, path, df([]).schema).inputFiles())
    before = files()
    for _ in range(2):
        tables.replace_bucketed(path, "key", df([("k1", 100), ("x", 7)]), df([("k2", 0), ("k3", 0)]), 16)
    got = {r["key"]: r["v"] for r in tables.read_buckets(spark, path, df([]).schema).collect()}
    assert got == {f"k{i}": i for i in range(50) if i not in (1, 2, 3)} | {"k1": 100, "x": 7}
    assert len(before & files()) >= len(before) - 4
    # a bucket of which nothing is left
    tables.replace_bucketed(path, "key", df([]), df([(k, 0) for k in got]), 16)
    assert tables.read_buckets(spark, path, df([]).schema).count() == 0
    tables.replace_bucketed(path, "key", df([]), df([]), 16)


def test_missing_table_is_empty(spark, tmp_path):
    assert tables.read_buckets(spark, f"{tmp_path}/none", spark.createDataFrame([], "key string").schema, [1]).count() == 0


@pytest.mark.parametrize("n", [1])
def test_buckets_of_equal_keys_are_equal(spark, n):
    x = spark.createDataFrame([("a",), ("a",), (None,)], "key string").select(tables.bucket("key", 8).alias("b")).collect()
    assert x[0] == x[1] and 0 <= x[2]["b"] < 8
