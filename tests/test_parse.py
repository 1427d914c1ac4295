"""Parser edge cases (FIXTURES.md §A3) on literal messages."""

import json

from pyspark.sql import functions as F

from metroflow import schemas as SC
from metroflow.functions.time import normalize_time
from metroflow.operators import parse as PA


def msgs(spark, *values):
    return spark.createDataFrame([("f", None, v) for v in values], SC.MESSAGE)


def alert_env(*entities, ts=1705276680):
    return json.dumps({"timestamp": ts, "data": {"header": {"timestamp": ts}, "entity": list(entities)}})


def tr(*pairs):
    return {"translation": [{"language": lang, "text": t} for lang, t in pairs]}


def test_decode_rejects_malformed_and_missing_data(spark):
    m = msgs(spark, '{"line_id": "A", "timestamp": 1, "data": [', '{"line_id": "A", "timestamp": 1}', None,
             '{"line_id": "A", "timestamp": 1, "data": []}')
    d = PA.decode(m, SC.VEHICLE_ENVELOPE)
    reasons = [r["_reason"] for r in d.collect()]
    assert reasons == ["malformed", "missing_fields", "malformed", None]
    assert PA.rejected(d).count() == 3


def test_alert_edge_cases(spark):
    ents = [
        {"id": "a1", "alert": {"header_text": tr(("es", "x"), ("en", "first"), ("en", "second")),
                               "informed_entity": [{"route_id": "A"}, {"route_id": "B"}, {"route_id": "A"}, {}],
                               "active_period": [{"start": 100, "end": 200}, {"start": 300}]}},
        {"id": "a2", "alert": {"header_text": tr(("es", "x")), "active_period": []}},
        {"id": "a3", "alert": {"cause": "C", "effect": "E"}},
        {"id": "a4"},
    ]
    out = {r["id"]: r for r in PA.alerts(msgs(spark, alert_env(*ents))).collect()}
    assert set(out) == {"a1", "a2", "a3"}
    assert out["a1"]["header"] == "first" and out["a1"]["routes"] == ["A", "B"]
    assert out["a1"]["start"].isoformat() == "1970-01-01T00:01:40" and out["a1"]["end"] is not None
    assert out["a2"]["header"] == "" and out["a2"]["start"] is None and out["a2"]["routes"] == []
    assert out["a3"]["header"] == "" and out["a3"]["description"] == ""
    assert (out["a3"]["alert_type"], out["a3"]["effect"]) == ("C", "E")
    assert out["a2"]["alert_type"] == "" and out["a1"]["updated"].isoformat() == "2024-01-14T23:58:00"


def test_outage_and_equipment_defaults(spark):
    o = json.dumps({"timestamp": 1, "data": {"nyct_ene": {"outages": [
        {"equipment_id": "EQ1", "outage_start_date_time": "2024-01-05T10:00:00"},
        {"station": {"name": "Main St"}, "reason": {"reason_name": "Repair"},
         "estimated_return_date_time": "1704067200"}]}}})
    rows = PA.outages(msgs(spark, o), "upcoming").orderBy("equipment_id").collect()
    assert [(r["equipment_id"], r["station"], r["borough"], r["reason"], r["is_current"]) for r in rows] == \
        [("", "Main St", "", "Repair", False), ("EQ1", "", "", "", False)]
    assert rows[0]["outage_end"].isoformat() == "2024-01-01T00:00:00"
    assert rows[1]["outage_start"].isoformat() == "2024-01-05T10:00:00" and rows[1]["outage_end"] is None
    e = json.dumps({"timestamp": 1, "data": {"nyct_ene_equipments": {"equipments": [{"equipment_id": "EQ9"}]}}})
    r = PA.equipment(msgs(spark, e)).first()
    assert (r["equipment_id"], r["station"], r["ada"]) == ("EQ9", "", False)


def test_vehicle_line_from_envelope_and_stops(spark):
    v = json.dumps({"line_id": "ACE", "timestamp": 1704067200,
                    "data": [{"id": "e1", "route_id": "A"}, {"id": "e2", "line_id": "X", "timestamp": 5}]})
    rows = PA.vehicles(msgs(spark, v)).orderBy("id").collect()
    assert [(r["line_id"], r["timestamp"]) for r in rows] == [("ACE", 1704067200), ("X", 5)]
    t = json.dumps({"line_id": "ACE", "timestamp": 1, "data": [
        {"id": "t1", "stops": [{"stop_id": "S1", "arrival": 10}, {"stop_id": "S2", "departure": 20}]},
        {"id": "t2", "stops": []}, {"id": "t3"}]})
    st = PA.stop_times(PA.trip_updates(msgs(spark, t))).orderBy("id", "stop_index").collect()
    assert [(r["id"], r["stop_index"], r["stop_id"]) for r in st] == \
        [("t1", 0, "S1"), ("t1", 1, "S2"), ("t2", None, None), ("t3", None, None)]


def test_normalize_time(spark):
    df = spark.createDataFrame([("1704067200",), ("1704067200123",), ("2024-01-01T00:00:00.5",),
                                (None,), ("garbage",), ("  1704067200 ",)], "x string")
    got = [r[0] for r in df.select(normalize_time("x")).collect()]
    assert [g.isoformat() if g else None for g in got] == [
        "2024-01-01T00:00:00", "2024-01-01T00:00:00.123000", "2024-01-01T00:00:00.500000", None, None,
        "2024-01-01T00:00:00"]


def test_conform_alternative_names(spark):
    df = spark.createDataFrame([("h1", None, None, ["A"]), (None, "h2", None, None)],
                               "header_text string, header string, affected_routes array<string>, routes array<string>")
    out = PA.conform(df, PA.ALERT_ALIASES).select("header", "routes").collect()
    assert [(r["header"], r["routes"]) for r in out] == [("h2", ["A"]), ("h1", [])] or \
        [(r["header"], r["routes"]) for r in out] == [("h1", ["A"]), ("h2", [])]


def test_json_publish_roundtrip_keeps_nulls_out(spark):
    from metroflow.sources import feeds as FD
    df = spark.createDataFrame([(1, "x")], "event_id long, s string")
    m = df.select(F.to_json(F.struct(F.col("event_id"), F.lit(None).cast("string").alias("gone"))).alias("v"))
    assert m.first()["v"] == '{"event_id":1}'
    assert FD.PER_MESSAGE == 100
