"""Route dimension rules on the codes where the prefix ladders collide."""

import pytest
from pyspark.sql import functions as F

from metroflow.functions import routes as RD

# route, kind, family, dim colour, ui colour, alerts-page colour, api colour, page type
CASES = [
    ("A", "subway", "IND", "#0039A6", "#0039A6", "#0039A6", "#0039A6", "subway"),
    ("B", "subway", "IND", "#FF6319", "#F2C75C", "#F2C75C", "#FF6319", "subway"),
    ("M", "subway", "IND", "#FF6319", "#4D92FB", "#4D92FB", "#FF6319", "subway"),
    ("Q", "subway", "BMT", "#FCCC0A", "#9467BD", "#9467BD", "#FCCC0A", "subway"),
    ("S", "subway", "S", "#808183", "#808183", "#808183", "#808183", "subway"),
    ("G", "subway", None, "#6CBE45", "#6CBE45", "#6CBE45", "#6CBE45", "subway"),
    ("SIR", "railway", "SIR", "#0039A6", "#0039A6", "#0039A6", "#000000", "railway"),
    ("SI", "railway", "SIR", "#0039A6", "#808183", "#000000", "#0039A6", "subway"),
    ("B41", "bus", "BUS", "#F2C75C", "#F2C75C", "#F2C75C", "#000000", "bus-brooklyn"),
    ("Bx12", "bus", "BUS", "#00AF87", "#F2C75C", "#F2C75C", "#000000", "bus-brooklyn"),
    ("Bx", "other", None, "#000000", "#00AF87", "#00AF87", "#000000", "bus-brooklyn"),
    ("M15", "bus", "BUS", "#4D92FB", "#4D92FB", "#4D92FB", "#000000", "bus-manhattan"),
    ("Q58", "bus", "BUS", "#9467BD", "#9467BD", "#9467BD", "#000000", "bus-queens"),
    ("X27", "express", "EXPRESS", "#E60000", "#E60000", "#E60000", "#000000", "bus-express"),
    ("SIM1", "simexpress", "SIMEXPRESS", "#FF9900", "#FF9900", "#FF9900", "#000000", "bus-staten-island-express"),
    ("9", "other", None, "#000000", "#000000", "#000000", "#000000", "subway"),
    ("", "other", None, "#000000", "#000000", "#000000", "#000000", "subway"),
    (None, "other", None, "#000000", "#000000", "#000000", "#000000", "subway"),
]


@pytest.fixture(scope="module")
def table(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "r string")
    out = df.select("r", RD.route_kind("r").alias("kind"), RD.route_family("r").alias("family"),
                    RD.route_color("r").alias("dim"), RD.route_color("r", "ui").alias("ui"),
                    RD.route_color("r", "alerts_page").alias("page"), RD.route_color("r", "api").alias("api"),
                    RD.page_route_type("r").alias("ptype"))
    return {r["r"]: r for r in out.collect()}


@pytest.mark.parametrize("case", CASES, ids=[str(c[0]) for c in CASES])
def test_route_rules(table, case):
    r = table[case[0]]
    assert (r["kind"], r["family"], r["dim"], r["ui"], r["page"], r["api"], r["ptype"]) == case[1:]


def test_chart_colour_default_and_labels(spark):
    from metroflow.functions import classify as C
    df = spark.createDataFrame([("SIR", "SIR"), ("SIM1", "OTHER"), (None, "ACE"), (None, None), ("Z9", "x")],
                               "r string, line string")
    lab = df.select(C.chart_label("r", "line").alias("label"))
    got = lab.select("label", RD.route_color("label", "chart").alias("c")).collect()
    assert [tuple(x) for x in got] == [("Staten Island Railway", "#808183"), ("SIM 1", "#FF9900"),
                                       ("ACE Line", "#0039A6"), ("Non-revenue", "#FCCC0A"),
                                       ("Z9", "#996633")]


def test_box_covers_every_imputed_point(spark):
    from metroflow.plans import api
    codes = ["1", "4", "N", "B", "G", "L", "J", "7", "A", "SIM1"]
    df = spark.createDataFrame([(f"E{i}", c, None, None, None) for i, c in enumerate(codes * 20)],
                               "id string, route_id string, latitude double, longitude double, bearing double")
    out = api.impute_positions(df).withColumn("b", RD.route_box("route_id"))
    bad = out.filter(~(F.col("latitude").between(F.col("b.lat_lo"), F.col("b.lat_hi"))
                       & F.col("longitude").between(F.col("b.lon_lo"), F.col("b.lon_hi"))
                       & F.col("bearing").between(0, 359) & F.col("is_imputed")))
    assert bad.count() == 0


def test_routes_dim_is_fixed_size(spark):
    dim = RD.routes_dim(spark)
    assert dim.count() == len(RD.SUBWAY_CODES) + 1
    assert dim.filter(F.col("route_id") == "SIR").first()["family"] == "SIR"
