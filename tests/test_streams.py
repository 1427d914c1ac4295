"""Streams equal batch; late rows; duplicates; restart; supervision."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from metroflow.functions.cells import box_ranges
from metroflow.operators import parse as PA
from metroflow.operators import predicates as P
from metroflow.plans import api, queries as QY, serving
from metroflow.session import fresh_dir
from metroflow.sources import feeds as FD
from metroflow.sources import records as R
from metroflow.streaming import jobs as J
from metroflow.streaming import sinks as K


def _diff(a, b):
    return a.exceptAll(b).count() + b.exceptAll(a).count()


def test_stream_latest_equals_batch(spark):
    out = QY.drain_vehicle_feed(spark, SF_SMALL, lambda m, o, c: J.vehicle_job(m, o, c, available_now=True))
    streamed = J.read_latest(spark, out, "vehicles").select("id", "vehicle_id")
    batch = api.latest_by_key(PA.vehicles(FD.vehicle_messages(R.vehicles(spark, SF_SMALL))), "vehicle_id",
                              ["event_time", "id"]).select("id", "vehicle_id")
    assert _diff(streamed, batch) == 0
    hist = J.read_history(spark, out)
    assert hist.count() == R.vehicles(spark, SF_SMALL).count()
    assert "event_date" in hist.columns
    # history is laid out by event date: a date filter prunes files, a reading of days lists no others
    day = hist.filter(F.col("event_date") == "2024-01-29")
    p = day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in p and "event_date" in p
    assert day.count() == R.vehicles(spark, SF_SMALL).filter(F.to_date("ts") == "2024-01-29").count()
    listed = J.read_history(spark, out, "2024-01-29", "2024-01-29")
    assert {f.split("/event_date=")[1][:10] for f in listed.inputFiles()} == {"2024-01-29"} and listed.count() == day.count()
    assert J.fold_latest(spark, out, "vehicles") > 1
    assert _diff(J.read_latest(spark, out, "vehicles").select("id", "vehicle_id"), batch) == 0


def test_trailing_hours_of_the_stored_history(spark):
    """E7 on the stored history lists the trailing days only, packed or not, and equals the answer on all rows."""
    out = QY.drain_vehicle_feed(spark, SF_SMALL, lambda m, o, c: J.vehicle_job(m, o, c, available_now=True))
    whole = api.route_stats_report(J.read_history(spark, out), "2024-01-20 07:45:30", limit=1000, time_col="event_time").collect()
    assert whole
    for _ in range(2):
        got = serving.route_stats_report(spark, out, "2024-01-20 07:45:30", limit=1000)
        listed = {f.split("/event_date=")[1][:10] for f in got.inputFiles()}  # what the scan's file index holds
        assert min(listed) == "2024-01-19" and len(listed) == 12
        assert got.collect() == whole
        J.pack_history(spark, out, "2024-01-25")
    assert len(K.list_names(spark, f"{out}/vehicle_history/event_date=2024-01-19")) == 1


def test_box_search_reads_few_row_groups(spark):
    """ranges of cells reach the scan, and row groups outside them are not read."""
    import glob

    import pyarrow.parquet as pq

    out = QY.drain_vehicle_feed(spark, SF_SMALL, lambda m, o, c: J.vehicle_job(m, o, c, available_now=True))
    J.pack_history(spark, out, "9999-01-01", file_bytes=4000)
    got = serving.vehicles_in_box(spark, out, QY.BOX)
    p = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(cell," in p
    every = J.read_history(spark, out).filter(P.usable_position() & P.in_box(*QY.BOX))
    assert got.select("id").exceptAll(every.select("id")).count() == 0 and got.count() == every.count() > 0
    groups = []
    for f in glob.glob(f"{out.replace('file:', '')}/vehicle_history/event_date=*/batch=*/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        at = [meta.row_group(0).column(c).path_in_schema for c in range(meta.num_columns)].index("cell")
        groups += [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
    ranges = box_ranges(*QY.BOX)
    read = [s for s in groups if s.has_min_max and any(a <= s.max and s.min <= b for a, b in ranges)]
    assert 0 < len(read) < len(groups) / 2


def test_late_rows_and_closed_windows(spark):
    """Stored rows = closed windows; late rows of those are dropped, of open ones counted; the running counts don't grow."""
    got = QY.stream_route_windows(spark, SF_SMALL)
    closed, open_ = got.filter("closed"), got.filter("not closed")
    assert closed.count() > 0 and open_.count() > 0
    total = got.agg(F.sum("count")).first()[0]
    v = R.vehicles(spark, SF_SMALL)
    late = v.filter(QY._late(v)).count()
    assert v.count() - late <= total < v.count()  # some late rows were dropped
    assert closed.dropDuplicates(["window_start", "line_id", "route_id"]).count() == closed.count()


def test_running_counts_fold_to_open_windows(spark):
    out, ck = fresh_dir(spark, "t-runs"), fresh_dir(spark, "ck-runs")
    path = fresh_dir(spark, "landing-runs")
    v = R.vehicles(spark, SF_SMALL)
    for day in (10, 20, 31):  # three polls, in order of time
        FD.publish(FD.vehicle_messages(v.filter(F.dayofmonth("ts").between(day - 10, day - 1))), path=path)
        msgs = FD.landing_stream(spark, path, "vehicles")
        J.await_all(spark, [job(msgs, out, ck, "1 day", available_now=True) for job in (J.route_stats_job, J.route_windows_job)])
    before = sorted(map(tuple, J.read_route_counts(spark, out).collect()))
    for _ in range(3):
        J.fold_route_stats(spark, out)
        assert sorted(map(tuple, J.read_route_counts(spark, out).collect())) == before
    end = J.read_route_windows(spark, out).agg(F.max("window_end")).first()[0]
    running = K.read_appended(spark, f"{out}/route_stats")
    assert running.filter(F.col("window_end") <= F.lit(end)).count() == 0  # no growing update log
    assert len(K.list_names(spark, f"{out}/route_stats")) <= 2


def test_route_stats_stream_equals_batch_and_short_watermark_drops(spark):
    full = QY.drain_vehicle_feed(spark, SF_SMALL, lambda m, o, c: J.route_stats_job(m, o, c, "400 days",
                                                                                    available_now=True))
    streamed = J.read_route_stats(spark, full)
    batch = api.hourly_route_stats(PA.vehicles(FD.vehicle_messages(R.vehicles(spark, SF_SMALL)))
                                   .withColumnRenamed("event_time", "ts").drop("ts")
                                   .join(R.vehicles(spark, SF_SMALL).select("id", "ts"), "id"))
    assert streamed.count() == batch.count()
    short = QY.drain_vehicle_feed(spark, SF_SMALL, lambda m, o, c: J.route_stats_job(m, o, c, "1 hour",
                                                                                     available_now=True))
    total_short = J.read_route_stats(spark, short).agg(F.sum("count")).first()[0]
    total_full = streamed.agg(F.sum("count")).first()[0]
    assert total_short < total_full  # late rows beyond the watermark are dropped


def test_stream_dedup_within_watermark(spark):
    v = R.vehicles(spark, SF_SMALL)
    replay = R.replay_duplicates(v)
    path = fresh_dir(spark, "landing-dup")
    FD.publish(FD.vehicle_messages(replay.repartition(4, "id")), path=path)
    out, ck = fresh_dir(spark, "t-dup"), fresh_dir(spark, "ck-dup")
    q = J.vehicle_job(FD.landing_stream(spark, path, "vehicles", max_files=1), out, ck,
                      watermark="400 days", dedup_key="id", available_now=True)
    q.awaitTermination()
    assert J.read_history(spark, out).count() == v.count()


def test_restart_picks_up_only_new_files(spark):
    v = R.vehicles(spark, SF_SMALL)
    path = fresh_dir(spark, "landing-restart")
    out, ck = fresh_dir(spark, "t-restart"), fresh_dir(spark, "ck-restart")
    FD.publish(FD.vehicle_messages(v.filter(F.col("event_id") < 500)), path=path)
    J.vehicle_job(FD.landing_stream(spark, path, "vehicles"), out, ck, available_now=True).awaitTermination()
    FD.publish(FD.vehicle_messages(v.filter(F.col("event_id") >= 500)), path=path)
    J.vehicle_job(FD.landing_stream(spark, path, "vehicles"), out, ck, available_now=True).awaitTermination()
    assert J.read_history(spark, out).count() == v.count()


def test_other_feeds_and_supervision(spark):
    path = fresh_dir(spark, "landing-alerts")
    FD.publish(FD.alert_messages(R.alerts(spark, SF_SMALL)), path=path)
    FD.publish(R.vehicles(spark, SF_SMALL).limit(1).select(F.lit("alerts").alias("feed"),
                                                             F.lit(None).cast("string").alias("key"),
                                                             F.lit("{not json").alias("value")), path=path)
    out, ck = fresh_dir(spark, "t-alerts"), fresh_dir(spark, "ck-alerts")
    q = J.feed_job(FD.landing_stream(spark, path, "alerts"), "alerts", out, ck, available_now=True)
    J.await_all(spark, [q])
    assert K.read_appended(spark, f"{out}/alerts").count() == R.alerts(spark, SF_SMALL).count()
    assert K.read_appended(spark, f"{out}/rejects/alerts").count() == 1
    latest = J.read_latest(spark, out, "alerts")
    assert latest.count() == R.alerts(spark, SF_SMALL).count()

    # the second poll re-sends the even alerts as SEVERE: latest state keeps one version each
    FD.publish(FD.alert_messages(R.alert_polls(spark, SF_SMALL).filter(F.col("doc_id") % 2 == 0)), path=path)
    J.await_all(spark, [J.feed_job(FD.landing_stream(spark, path, "alerts"), "alerts", out, ck, available_now=True)])
    latest = J.read_latest(spark, out, "alerts")
    assert latest.count() == R.alerts(spark, SF_SMALL).count()
    assert latest.filter(F.col("severity") == "SEVERE").count() == \
        R.alerts(spark, SF_SMALL).filter((F.col("doc_id") % 2 == 0) | (F.col("severity") == "SEVERE")).count()

    bad = fresh_dir(spark, "landing-bad")
    FD.publish(FD.vehicle_messages(R.vehicles(spark, SF_SMALL).limit(5)), path=bad)

    def boom(batch, bid, qid):
        raise RuntimeError("sink down")

    q2 = J._start(FD.landing_stream(spark, bad, "vehicles"), K.fan_out([boom]), "boom",
                  fresh_dir(spark, "ck-boom"), {"availableNow": True})
    with pytest.raises(Exception):
        J.await_all(spark, [q2])


def test_triggers_and_registry():
    from metroflow import schemas as SC
    assert J.trigger_options("vehicles") == {"processingTime": "30 seconds"}
    assert J.trigger_options("alerts") == {"processingTime": "60 seconds"}
    assert J.trigger_options("equipment", available_now=True) == {"availableNow": True}
    assert len(SC.LINE_FEEDS) == 8 and SC.feed("outages_upcoming").poll_seconds == 120
    with pytest.raises(KeyError):
        SC.feed("nope")


def test_topic_source_needs_connector(spark):
    """The topic source is configured per feed; without the connector jar it fails at load."""
    with pytest.raises(Exception, match="(?i)kafka"):
        FD.topic_stream(spark, "broker:9092", "alerts", starting="earliest", max_offsets=1000)


def test_await_all_ignores_failures_of_other_queries(spark):
    """An earlier failed query of the session neither fails nor cuts short a later wait."""
    bad = fresh_dir(spark, "landing-bad2")
    FD.publish(FD.vehicle_messages(R.vehicles(spark, SF_SMALL).limit(5)), path=bad)

    def boom(batch, bid, qid):
        raise RuntimeError("sink down")

    failed = J._start(FD.landing_stream(spark, bad, "vehicles"), K.fan_out([boom]), "boom2",
                      fresh_dir(spark, "ck-boom2"), {"availableNow": True})
    with pytest.raises(Exception, match="sink down"):
        J.await_all(spark, [failed])
    with pytest.raises(Exception, match="sink down"):
        J.await_all(spark, [failed])  # already ended: its failure is still reported

    path, out, ck = fresh_dir(spark, "landing-ok"), fresh_dir(spark, "out-ok"), fresh_dir(spark, "ck-ok")
    FD.publish(FD.vehicle_messages(R.vehicles(spark, SF_SMALL).repartition(4, "id")), path=path)
    good = J.vehicle_job(FD.landing_stream(spark, path, "vehicles", max_files=1), out, ck, available_now=True)
    J.await_all(spark, [good])
    assert not good.isActive and good.exception() is None
    assert J.read_history(spark, out).count() == R.vehicles(spark, SF_SMALL).count()
