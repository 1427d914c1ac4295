"""Streams -> stored tables -> API: the dashboard answers on stored tables equal the batch answers."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from metroflow.operators.state import latest_by_key
from metroflow.plans import api, serving
from metroflow.plans import queries as QY
from metroflow.session import fresh_dir
from metroflow.sources import feeds as FD
from metroflow.sources import records as R
from metroflow.streaming import jobs as J
from metroflow.streaming import sinks as K


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_api_on_stored_tables_equals_batch(spark):
    root, ck = fresh_dir(spark, "serve"), fresh_dir(spark, "serve-ck")
    land = {k: fresh_dir(spark, f"land-{k}") for k in ("vehicles", "alerts", "outages", "equipment")}
    v = R.vehicles(spark, SF_SMALL)
    FD.publish(FD.vehicle_messages(v.repartition(4, "id")), path=land["vehicles"])
    FD.publish(FD.alert_messages(R.alert_polls(spark, SF_SMALL)), path=land["alerts"])
    om = FD.outage_messages(R.outages(spark, SF_SMALL))
    cur, upc = fresh_dir(spark, "land-cur"), fresh_dir(spark, "land-upc")
    FD.publish(om.filter(F.col("feed") == "outages_current"), path=cur)
    FD.publish(om.filter(F.col("feed") == "outages_upcoming"), path=upc)
    FD.publish(FD.equipment_messages(R.equipment(spark, SF_SMALL)), path=land["equipment"])

    qs = [
        J.vehicle_job(FD.landing_stream(spark, land["vehicles"], "vehicles", max_files=2), root, ck,
                      available_now=True),
        J.route_stats_job(FD.landing_stream(spark, land["vehicles"], "vehicles"), root, ck, QY.STREAM_WATERMARK,
                          available_now=True),
        J.feed_job(FD.landing_stream(spark, land["alerts"], "alerts"), "alerts", root, ck, available_now=True),
        J.feed_job(FD.landing_stream(spark, cur, "outages_current"), "outages_current", root, ck,
                   available_now=True),
        J.feed_job(FD.landing_stream(spark, upc, "outages_upcoming"), "outages_upcoming", root, ck,
                   available_now=True),
        J.feed_job(FD.landing_stream(spark, land["equipment"], "equipment"), "equipment", root, ck,
                   available_now=True),
    ]
    J.await_all(spark, qs)
    for q in qs:
        q.awaitTermination()
    t = serving.tables(spark, root)

    # latest vehicles and the chart
    batch_latest = QY._latest(spark, SF_SMALL, "id")
    assert _same(t["vehicle_latest"].select("id"), batch_latest.select("id"))
    assert _same(api.top_routes_chart(t["vehicle_latest"]), QY.top_routes(spark, SF_SMALL))
    # alerts: latest versions, status per route
    assert _same(t["alerts_latest"].select("id", "severity", "updated"),
                 QY._alerts_latest(spark, SF_SMALL).select("id", "severity", "updated"))
    act = api.active_at(t["alerts_latest"], QY.ALERTS_AS_OF)
    assert _same(api.route_alert_status(spark, act), QY.system_status(spark, SF_SMALL))
    # elevators
    cols = ["outage_id", "equipment_id", "station", "is_current", "outage_start", "outage_end"]
    # two line items may share an id: the stored table keeps the current one of them
    records = latest_by_key(R.outages(spark, SF_SMALL), "outage_id", ["is_current"])
    assert _same(t["outages"].select(*cols), records.select(*cols))
    assert _same(api.equipment_availability(t["equipment"], t["outages"]),
                 QY.equipment_availability(spark, SF_SMALL))
    # the latest tables keep the processing time, so health can be judged on them
    health = api.component_health("vehicles_tracking", t["vehicle_latest"], "processed_at", F.current_timestamp(), 3600)
    assert health.first()["status"] == "OPERATIONAL"
    stale = api.component_health("vehicles_tracking", t["vehicle_latest"], "processed_at",
                                 F.current_timestamp() + F.expr("INTERVAL 2 HOURS"), 3600)
    assert stale.first()["status"] == "DEGRADED"
    # summary row and windowed counts
    batch_latest_all = QY._latest(spark, SF_SMALL, "line_id", "route_id")
    batch_act = api.active_at(QY._alerts_latest(spark, SF_SMALL, "start", "end"), QY.ALERTS_AS_OF)
    s = api.summary(t["vehicle_latest"], t["outages"], act, t["equipment"])
    assert _same(s, api.summary(batch_latest_all, records, batch_act, R.equipment(spark, SF_SMALL)))
    assert _same(t["route_stats"], QY.route_stats_hourly(spark, SF_SMALL))


def _outage_poll(at, *equipment):
    items = ", ".join(f'{{"equipment_id": "{e}", "outage_start_date_time": "2024-01-01T00:00:00"}}' for e in equipment)
    return f'{{"timestamp": {at}, "data": {{"nyct_ene": {{"outages": [{items}]}}}}}}'


def test_outages_without_ids_follow_the_newest_poll(spark):
    root, ck, path = fresh_dir(spark, "polls"), fresh_dir(spark, "polls-ck"), fresh_dir(spark, "polls-in")

    def poll(*messages):
        spark.createDataFrame([(m,) for m in messages], "value string").coalesce(1).write.mode("append").text(path)
        J.await_all(spark, [J.feed_job(FD.landing_stream(spark, path, "outages_current"), "outages_current", root, ck,
                                       available_now=True)])
        return sorted(r["equipment_id"] for r in serving.outages_latest(spark, root).collect())

    assert poll(_outage_poll(100, "EL1", "EL2")) == ["EL1", "EL2"]
    assert poll(_outage_poll(200, "EL2", ""), _outage_poll(150, "EL1")) == ["", "EL2"]
    assert poll("not json") == ["", "EL2"]
    assert poll(_outage_poll(300)) == []  # an empty poll: nothing is out of service
    assert J.read_rejects(spark, root, "outages_current").count() == 1
    assert J.read_rejects(spark, root, "alerts").count() == 0


def test_vehicle_rejects_with_dedup_come_from_their_own_job(spark):
    root, ck, path = fresh_dir(spark, "rej"), fresh_dir(spark, "rej-ck"), fresh_dir(spark, "rej-in")
    good = '{"line_id": "L", "timestamp": 100, "data": [{"id": "a", "vehicle_id": "v"}]}'
    spark.createDataFrame([(good,), (good,), ("{broken",)], "value string").write.mode("append").text(path)
    stream = FD.landing_stream(spark, path, "vehicles")
    J.await_all(spark, [J.vehicle_job(stream, root, ck, "1 hour", "id", available_now=True),
                        J.rejects_job(stream, "vehicles", root, ck, available_now=True)])
    assert serving.vehicle_history(spark, root).count() == 1
    assert [r["raw"] for r in J.read_rejects(spark, root, "vehicles").collect()] == ["{broken"]


def test_line_feeds_are_read_by_one_scan(spark):
    """The registered line feeds by one scan of their folders; a folder that is no line feed isn't listed."""
    from metroflow import schemas as SC
    plan = QY.stream_feed_union(spark, SF_SMALL)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Exchange" not in text
    lines = {f.split("/key=")[1].split("/")[0] for f in plan.inputFiles()}
    assert lines == set(SC.LINE_FEEDS) < {r["line_id"] for r in R.vehicles(spark, SF_SMALL).select("line_id").distinct().collect()}
    assert {r["source"] for r in plan.select("source").distinct().collect()} == lines


def test_a_feeds_batch_is_never_kept_in_memory(spark, monkeypatch):
    """A poll may be larger than the executors' memory: its rows are written as they are decoded, rejects and poll time too."""
    from pyspark.sql.classic.dataframe import DataFrame

    def kept(*a, **k):
        raise AssertionError("kept in memory")
    monkeypatch.setattr(DataFrame, "persist", kept)
    root, ck, path = fresh_dir(spark, "kept"), fresh_dir(spark, "kept-ck"), fresh_dir(spark, "kept-in")
    FD.publish(FD.outage_messages(R.outages(spark, SF_SMALL)).where("feed = 'outages_current'"), path=path, per_file=2)
    spark.createDataFrame([("not json",)], "value string").write.mode("append").text(path)
    J.await_all(spark, [J.feed_job(FD.landing_stream(spark, path, "outages_current"), "outages_current", root, ck, available_now=True)])
    cols = ["outage_id", "equipment_id", "station", "outage_start", "outage_end"]
    want = latest_by_key(R.outages(spark, SF_SMALL).where("is_current"), "outage_id", ["outage_start"])
    assert _same(serving.outages_latest(spark, root).select("outage_id"), want.select("outage_id"))
    assert J.read_rejects(spark, root, "outages_current").count() == 1
    assert spark.read.parquet(f"{root}/outages").select(*cols).exceptAll(R.outages(spark, SF_SMALL).where("is_current").select(*cols)).count() == 0


def test_landed_files_are_small(spark):
    path = fresh_dir(spark, "gz")
    FD.publish(FD.vehicle_messages(R.vehicles(spark, SF_SMALL).limit(25).coalesce(1)), path=path, per_file=10)
    names = [n for n in K.list_names(spark, path)]
    assert len(names) == 3 and all(n.endswith(".gz") for n in names)
    assert FD.landing_batch(spark, path, "vehicles").count() == 25
