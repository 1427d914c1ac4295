"""Box search by cells, text search by trigrams, records under other names, distinct sketches."""

import random

import pytest
from pyspark.sql import functions as F

from metroflow.functions.cells import MAP, box_ranges, cell, in_cells
from metroflow.operators import aggregate as A
from metroflow.operators import parse as PA
from metroflow.operators import predicates as P
from metroflow.operators import textindex as TI
from metroflow.plans import api
from metroflow.session import fresh_dir

BOXES = [(40.70, 40.80, -74.00, -73.90), (-90.0, 90.0, -180.0, 180.0), (40.7, 40.7, -73.9, -73.9), (-1.0, 1.0, -1.0, 1.0), (89.99, 90.0, 179.9, 180.0),
         (41.0, 40.0, 0.0, 1.0), (-200.0, 200.0, 10.0, 10.5)]


@pytest.mark.parametrize("box", BOXES)
@pytest.mark.parametrize("most", [1, 4, 32, 500])
def test_ranges_cover_the_box(spark, box, most):
    ranges = box_ranges(*box, most=most)
    assert len(ranges) <= most and all(a <= b for a, b in ranges) and all(x[1] < y[0] - 1 for x, y in zip(ranges, ranges[1:]))
    if box[0] > box[1]:
        assert ranges == []


def test_positions_in_a_box_lie_in_its_ranges(spark):
    rng = random.Random(5)
    rows = [(rng.uniform(40.5, 41.0), rng.uniform(-74.3, -73.6)) for _ in range(3000)]
    rows += [(a, b) for a in (40.70, 40.80, 90.0, -90.0, 0.0) for b in (-74.00, -73.90, 180.0, -180.0, 0.0)] + [(None, 1.0), (1.0, None), (float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "latitude double, longitude double").withColumn("cell", cell("latitude", "longitude"))
    assert df.where("cell is null").count() == 3 and df.where("cell < 0 or cell >= 4294967296").count() == 0
    for box in BOXES:
        for most in (1, 8, 32):
            inside = df.where(P.in_box(*box)).where("not isnan(latitude)")
            assert inside.where(~in_cells("cell", *box, most=most)).count() == 0
    few = df.where(in_cells("cell", *BOXES[0])).count()
    assert few < df.where(P.in_box(*BOXES[0])).count() * 1.5 + 20  # the cover is close
    assert MAP[0] == -90.0


TEXTS = ["Bolt Street", "bolt", "BO", "b", "", None, "Straße 日本語 xyz", "a" * 5000 + "needle" + "b" * 5000, "Bolt Street", "per%cent_ and \\ and .*", "ab\nc  d"]


def test_trigram_search_equals_the_scan(spark):
    rows = [(k, t, TEXTS[-1 - k]) for k, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "id int, one string, two string")
    path = fresh_dir(spark, "t-index")
    TI.build(df, ["one", "two"], path, files=3)
    assert TI.search(spark, path, "").count() == len({t for t in TEXTS if t})
    for term in ["bolt", "BOLT s", "b", "bo", "日本", "本語 x", "needle", "aaaneedleb", "%", "._", ".*", "\\", "\n", "zzz", "c  d", "ß", "y"]:
        want = {k for k, a, b in rows if any(x is not None and term.lower() in x.lower() for x in (a, b))}
        found = TI.search(spark, path, term)
        assert {r["id"] for r in TI.rows_with(df, ["id"], ["one", "two"], found).collect()} == want, term
        got = TI.terms_of(df, ["one", "two"], found.select(F.lit(term).alias("term"), "text"))
        assert sorted(r["id"] for r in got.collect()) == sorted(want), term  # a row that holds it twice is there once
    plan = TI.candidates(spark, path, "bolt")._jdf.queryExecution().executedPlan().toString()
    assert "In(trigram, [bol,olt])" in plan
    assert "StringStartsWith(trigram,bo)" in TI.candidates(spark, path, "bo")._jdf.queryExecution().executedPlan().toString()
    assert TI.search(spark, path, "e").count() >= 1
    empty = fresh_dir(spark, "t-index")
    TI.build(df.where("1 = 0"), ["one"], empty)
    assert TI.search(spark, empty, "bolt").count() == 0


def test_records_under_any_name(spark):
    values = ['{"data": [{"id": "a", "header": "h", "affected_routes": ["1", "2"], "updated_at": 1704067200}, {"id": "b", "header_text": "", "header": "own"}]}',
              '[{"id": "c", "routes": [], "cause": "X", "updated": "2024-01-01T00:00:00Z"}]', "not json", None, "[]", '{"data": 3}', '{"data": [{"id": {"x": 1}}]}']
    rows = PA.named_records(spark.createDataFrame([(v,) for v in values], "value string"), "alerts").collect()
    got = {r["id"]: r for r in rows}
    assert len(rows) == 4 and got["a"]["routes"] == ["1", "2"] and got["b"]["header"] == "own" and got["b"]["routes"] == []
    assert got["c"]["alert_type"] == "X" and got["c"]["updated"] == got["a"]["updated"]
    v = spark.createDataFrame([('[{"id": "v", "position": {"latitude": 40.5, "longitude": -74}, "trip": {"route_id": "A"}, "timestamp": "1704067200"}]',)], "value string")
    r = PA.named_records(v, "vehicles").first()
    assert (r["latitude"], r["longitude"], r["route_id"]) == (40.5, -74.0, "A") and r["event_time"] == got["a"]["updated"]


def test_listings_take_either_spelling(spark):
    """E2-E5 on the API's columns, on the feed's, and on both at once."""
    o = spark.createDataFrame([("1", "Main", "", True), ("2", "", "Side", True), ("3", None, "Main St", True)], "outage_id string, station string, station_name string, is_current boolean") \
        .withColumns({c: F.lit("x") for c in ("borough", "equipment_type")})
    assert [r["outage_id"] for r in api.outages_listing(o, station="main").collect()] == ["1", "3"]
    page = spark.createDataFrame([("1", "Main", "current", "x", None)], "outage_id string, station_name string, type string, status string, outage_start timestamp_ntz")
    got = api.outages_listing(page.withColumns({c: F.lit("x") for c in ("borough", "equipment_type")}), kind="current").first()
    assert got["station"] == "Main" and got["latest_status"] == "x"
    q = spark.createDataFrame([("e", "Main", True)], "equipment_id string, station_name string, ada boolean").withColumns({c: F.lit("x") for c in ("borough", "equipment_type")})
    assert api.equipment_listing(q, station="ma", ada=True).count() == 1
    a = spark.createDataFrame([("a", "Delays", "", "SEVERE", None)], "id string, header_text string, description_text string, severity string, affected_routes array<string>") \
        .withColumns({"alert_type": F.lit(None).cast("string"), "effect": F.lit(None).cast("string")})
    r = api.alerts_listing(a, severity="severe", search="delay").first()
    assert r["header"] == "Delays" and r["routes"] == []
    v = spark.createDataFrame([("v", (40.75, -73.95, 1.0))], "id string, position struct<latitude double, longitude double, bearing double>").withColumn("route_id", F.lit("A"))
    assert api.vehicles_listing(v, box=(40.7, 40.8, -74.0, -73.9)).count() == 1


def test_sketches_merge_to_any_span(spark):
    n = 30_000
    rows = spark.range(n).select((F.lit(1704067200) + F.col("id") % 90000).cast("timestamp").cast("timestamp_ntz").alias("ts"),
                                 F.when(F.col("id") % 50 != 0, F.concat(F.lit("v"), F.col("id") % 7000)).alias("v"), (F.col("id") % 3).alias("line"))
    sketches = A.distinct_sketches(rows, "ts", "1 hour", "v", "line")
    assert sketches.count() <= 26 * 3
    exact = rows.agg(F.count_distinct("v")).first()[0]
    r = A.merged_distinct(sketches).first()
    assert r["low"] <= exact <= r["high"] and r["high"] - r["low"] < 0.12 * exact
    for r in A.merged_distinct(sketches, "line").join(rows.groupBy("line").agg(F.count_distinct("v").alias("n")), "line").collect():
        assert r["low"] <= r["n"] <= r["high"]


def test_postings_are_lists_of_blocks(spark, monkeypatch):
    """No row per text and trigram, however many texts share it; two builds of small and large blocks find the same."""
    rows = spark.createDataFrame([(k, f"Service {k} suspended {chr(0x10000 + k)}") for k in range(300)], "id int, one string").repartition(2)
    path = fresh_dir(spark, "t-blocks")
    TI.build(rows, ["one"], path, files=2)
    kept = spark.read.parquet(f"{path}/postings")
    sizes = kept.where("trigram = 'sus'").selectExpr("size(text_ids) AS n").collect()
    assert sum(r["n"] for r in sizes) == 300 and len(sizes) < 30
    assert TI.search(spark, path, "Suspended").count() == 300 and TI.search(spark, path, chr(0x10007)).count() == 1
    plan = TI.rows_with(rows, ["id"], ["one"], TI.search(spark, path, "Suspended"))._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi, ((_id" in plan  # rows meet the texts by hashes, not by the texts
