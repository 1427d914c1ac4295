"""Sinks: retried batches replace themselves, upserts apply once, empty batches skip."""

import datetime
import os

import pytest
from pyspark.sql import functions as F

from metroflow.session import fresh_dir
from metroflow.streaming import sinks as K
from metroflow.streaming import upkeep as UP

SCHEMA = "vehicle_id string, event_time timestamp_ntz, id string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(v, datetime.datetime(2024, 1, 1, 0, 0, t), i, x)
                                  for v, t, i, x in rows], SCHEMA)


def test_append_retry_replaces_itself(spark):
    t = fresh_dir(spark, "t-append")
    b = frame(spark, [("v1", 1, "e1", 1), ("v2", 2, "e2", 2)])
    K.append_batch(b, 0, t, qid="q")
    K.append_batch(b, 0, t, qid="q")  # the retry
    K.append_batch(frame(spark, [("v3", 3, "e3", 3)]), 1, t, qid="q")
    assert K.read_appended(spark, t).count() == 3


KEY, ORDER = ["vehicle_id"], ["event_time", "id"]


def latest(spark, root):
    return sorted((r["vehicle_id"] or "-", r["id"]) for r in K.read_latest(spark, root, frame(spark, []).schema, KEY, ORDER).collect())


def test_upsert_keeps_the_newest_row_per_key(spark):
    root = fresh_dir(spark, "t-latest")
    assert latest(spark, root) == []
    b0 = frame(spark, [("v1", 1, "e1", 1), ("v2", 2, "e2", 2), (None, 3, "e3", 3)])
    b1 = frame(spark, [("v1", 0, "e4", 4), ("v2", 5, "e5", 5), ("v2", 4, "e7", 7), (None, 6, "e6", 6)])  # v1 row is older
    K.upsert_latest(b0, 0, root, KEY, ORDER, qid="q")
    for _ in range(2):  # the second one is a retry
        K.upsert_latest(b1, 1, root, KEY, ORDER, qid="q")
    K.upsert_latest(b0.filter("vehicle_id is not null"), 0, root, KEY, ORDER, qid="other")  # the same rows under another checkpoint
    assert latest(spark, root) == [("-", "e3"), ("-", "e6"), ("v1", "e1"), ("v2", "e5")]


def test_a_batch_writes_its_own_rows_only(spark):
    """O(batch): however many keys the table has, a batch writes at most one row per key of its own, and no other file."""
    root = fresh_dir(spark, "t-delta")
    K.upsert_latest(frame(spark, [(f"v{i}", i % 60, f"e{i}", i) for i in range(500)]), 0, root, KEY, ORDER, qid="q")
    local = root.replace("file:", "")
    before = {p for p, _, files in os.walk(local) for _ in files}
    K.upsert_latest(frame(spark, [("v1", 59, "x", 0), ("v1", 58, "y", 0), ("w", 1, "z", 0)]), 1, root, KEY, ORDER, qid="q")
    assert spark.read.parquet(f"{root}/batch=q-1").count() == 2
    new = {p for p, _, files in os.walk(local) for _ in files} - before
    assert new and all("/batch=q-1" in p for p in new)
    assert K.list_names(spark, root) == ["batch=q-0", "batch=q-1"]
    assert len(latest(spark, root)) == 501


def test_fold_keeps_the_answer_at_every_step(spark):
    root, schema = fresh_dir(spark, "t-fold"), frame(spark, []).schema

    def write(i, qid="q"):
        K.upsert_latest(frame(spark, [("v1", i, f"e{i}", i), (f"w{i}", i, f"f{i}", i), (None, i, f"k{i}", i)]), i, root, KEY, ORDER, qid=qid)

    want = []
    for i in range(6):
        write(i)
        want = sorted([r for r in want if r[0] != "v1"] + [("v1", f"e{i}"), (f"w{i}", f"f{i}"), ("-", f"k{i}")])
        if i in (2, 4):
            assert UP.fold_latest(spark, root, schema, KEY, ORDER) > 1
        assert latest(spark, root) == want
    keyed = [n for n in K.list_names(spark, root) if "keyed=true" in K.list_names(spark, f"{root}/{n}")]
    assert len(keyed) == 5  # both folds, what the second covered since the first, and batch 5
    write(1)  # a batch that a fold has covered and deleted runs again
    assert latest(spark, root) == want
    for _ in range(2):
        UP.fold_latest(spark, root, schema, KEY, ORDER)
    assert latest(spark, root) == want


def test_fold_that_stopped_half_way(spark, monkeypatch):
    root, schema = fresh_dir(spark, "t-fold-stop"), frame(spark, []).schema
    for i in range(3):
        K.upsert_latest(frame(spark, [("v1", i, f"e{i}", i), (None, i, f"k{i}", i)]), i, root, KEY, ORDER, qid="q")
    want = [("-", "k0"), ("-", "k1"), ("-", "k2"), ("v1", "e2")]
    UP.fold_latest(spark, root, schema, KEY, ORDER)

    def stop(spark, path):
        raise KeyboardInterrupt

    monkeypatch.setattr(UP, "_delete", stop)
    with pytest.raises(KeyboardInterrupt):
        UP.fold_latest(spark, root, schema, KEY, ORDER)
    assert latest(spark, root) == want
    monkeypatch.undo()
    UP.fold_latest(spark, root, schema, KEY, ORDER)
    assert latest(spark, root) == want


def history(spark, table, **kw):
    return sorted((str(r["event_date"]), r["id"]) for r in K.read_days(spark, table, **kw).collect())


def dated(spark, rows):
    return spark.createDataFrame([(datetime.date(2024, 1, d) if d else None, i) for d, i in rows], "event_date date, id string")


def test_history_by_date(spark):
    t = fresh_dir(spark, "t-days")
    schema = "id string, from_batch string, event_date date"
    assert K.read_days(spark, t, schema=schema).count() == 0
    b0, b1 = dated(spark, [(1, "a"), (2, "b"), (None, "n")]), dated(spark, [(2, "c"), (3, "d")])
    for b, i in ((b0, 0), (b1, 1), (b1, 1), (b0, 0)):  # both batches are retried
        K.append_by_date(b, i, t, qid="q")
    every = [("2024-01-01", "a"), ("2024-01-02", "b"), ("2024-01-02", "c"), ("2024-01-03", "d"), ("None", "n")]
    assert history(spark, t) == every
    assert history(spark, t, first="2024-01-02", last="2024-01-02") == every[1:3]
    assert history(spark, t, first="2024-01-03") == every[3:4]
    assert history(spark, t, days=["2024-01-01", "2023-12-31"]) == every[:1]
    assert K.read_days(spark, t, first="2025-01-01", schema=schema).count() == 0
    # only the folders of the days are listed
    files = K.read_days(spark, t, first="2024-01-02", last="2024-01-02").inputFiles()
    assert len(files) == 2 and all("/event_date=2024-01-02/" in f for f in files)


def test_packed_days_hold_the_same_rows(spark, monkeypatch):
    t = fresh_dir(spark, "t-pack")
    rows = [dated(spark, [(1, f"a{i}"), (2, f"b{i}"), (3, f"c{i}")]) for i in range(4)]
    for i in range(3):
        K.append_by_date(rows[i], i, t, qid="q")
    want = history(spark, t)
    assert UP.pack_days(spark, t, "2024-01-03") == ["2024-01-01", "2024-01-02"]  # the third day is still open
    assert history(spark, t) == want
    for day, n in (("01", 1), ("02", 1), ("03", 3)):
        assert len(K.list_names(spark, f"{t}/event_date=2024-01-{day}")) == n
    assert UP.pack_days(spark, t, "2024-01-03") == []
    assert {r[0] for r in K.read_days(spark, t).select("from_batch").distinct().collect()} == {"q-0", "q-1", "q-2"}
    # late rows reach a packed day, and the job stops while it puts the day in place: the next one finishes it
    K.append_by_date(rows[3], 3, t, qid="q")
    want = history(spark, t)
    replace, stopped = UP._replace, []

    def stop(*args):
        stopped.append(args)
        raise KeyboardInterrupt

    monkeypatch.setattr(UP, "_replace", stop)
    with pytest.raises(KeyboardInterrupt):
        UP.pack_days(spark, t, "2024-01-02")
    assert stopped and history(spark, t) == want
    monkeypatch.setattr(UP, "_replace", replace)
    UP.pack_days(spark, t, "2024-01-02", sort_by="id")
    assert history(spark, t) == want
    assert len(K.list_names(spark, f"{t}/event_date=2024-01-01")) == 1


def test_unseen_rows(spark):
    t = fresh_dir(spark, "t-unseen")
    first = dated(spark, [(1, "a"), (2, "b"), (None, "n"), (1, None), (1, "")])

    def store(b, i, qid):
        K.append_by_date(K.unseen(b, i, t, "id", qid=qid), i, t, qid=qid)

    store(first, 0, "q")
    store(first, 0, "q")  # a retry sees nothing of its own
    assert K.read_days(spark, t).count() == 5
    again = dated(spark, [(1, "a"), (2, "a"), (2, "b"), (2, "c"), (2, "c"), (1, None), (None, "n")])
    store(again, 0, "r")
    got = sorted((str(r["event_date"]), r["id"] or "-") for r in K.read_days(spark, t).filter("from_batch = 'r-0'").collect())
    assert got == [("2024-01-01", "-"), ("2024-01-02", "a"), ("2024-01-02", "c"), ("None", "n")]


def test_fan_out_skips_empty_and_writes_all(spark):
    calls = []
    run = K.fan_out([lambda b, i, q: calls.append(("a", i, b.count())), lambda b, i, q: calls.append(("b", i))])
    run(frame(spark, []), 0)
    run(frame(spark, [("v1", 1, "e1", 1)]), 1)
    assert calls == [("a", 1, 1), ("b", 1)]


def test_stamp_is_injectable(spark):
    df = K.stamp(frame(spark, [("v1", 1, "e1", 1)]), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    assert df.first()["processed_at"].isoformat() == "2024-01-01T00:00:00"


def test_max_counters(spark):
    t = fresh_dir(spark, "t-max")
    df = spark.createDataFrame([("k1", 1), ("k2", 5)], "k string, count long")
    K.merge_max(df, 0, t, qid="q")
    K.merge_max(spark.createDataFrame([("k1", 3)], "k string, count long"), 1, t, qid="q")
    assert sorted(tuple(r) for r in K.read_max(spark, t, ["k"], "count").collect()) == [("k1", 3), ("k2", 5)]


def test_counts_of_two_checkpoints_add_up(spark):
    t = fresh_dir(spark, "t-two")
    for qid, batch, n in (("q-a", 0, 1), ("q-a", 1, 3), ("q-b", 0, 2)):
        K.merge_max(spark.createDataFrame([("k", n)], "k string, count long"), batch, t, qid=qid)
    assert [tuple(r) for r in K.read_max(spark, t, ["k"], "count").collect()] == [("k", 5)]


def test_folded_counts(spark):
    t = fresh_dir(spark, "t-fold-counts")
    at = [datetime.datetime(2024, 1, 1, h) for h in range(3)]

    def count(h, n, batch, qid="q"):
        K.merge_max(spark.createDataFrame([(at[h], n)], "window_end timestamp_ntz, count long"), batch, t, qid=qid)

    def read():
        return sorted((r[0].hour, r[1]) for r in K.read_max(spark, t, ["window_end"], "count").collect())

    count(1, 1, 0), count(1, 4, 1), count(2, 2, 1, "r"), count(1, 2, 0, "r")
    assert read() == [(1, 6), (2, 2)]
    assert UP.fold_counts(spark, t, ["window_end"], "count") == 4 and read() == [(1, 6), (2, 2)]
    count(1, 5, 2)
    for _ in range(2):
        UP.fold_counts(spark, t, ["window_end"], "count")
        assert read() == [(1, 7), (2, 2)]
    for _ in range(3):  # closed windows leave the running counts
        UP.fold_counts(spark, t, ["window_end"], "count", at[1])
    assert read() == [(2, 2)]


def test_empty_key_is_no_key(spark):
    root = fresh_dir(spark, "t-empty-key")
    rows = [("", 1, "e1", 1), ("", 1, "e2", 2), (None, 1, "e3", 3), ("v1", 1, "e4", 4), ("v1", 2, "e5", 5)]
    K.upsert_latest(frame(spark, rows), 0, root, ["vehicle_id"], ["event_time"], qid="q")
    assert sorted(r["id"] for r in K.read_latest(spark, root, frame(spark, []).schema, ["vehicle_id"], ["event_time"]).collect()) == ["e1", "e2", "e3", "e5"]


def test_latest_of_few_equals_latest_by_key(spark, monkeypatch):
    """Repeated keys, keyless rows and none at all; also with more repeated keys than are looked up."""
    from metroflow.operators import state
    rows = [(f"v{i}", 0, f"e{i}", i) for i in range(50)] + [("v1", 5, "later", 1), ("v1", 3, "mid", 1), ("v2", 0, "e2", 2), ("", 1, "x", 1), ("", 1, "x", 1), (None, 2, "y", 2)]
    for some in (rows, rows[:50], rows[-3:], []):
        df = frame(spark, some) if some else frame(spark, rows).where("1 = 0")
        want = sorted(map(str, state.latest_by_key(df, KEY, ORDER).collect()))
        for most in (100_000, 1):
            monkeypatch.setattr(state, "MOST_REPEATED", most)
            assert sorted(map(str, state.latest_of_few(df, KEY, ORDER).collect())) == want
