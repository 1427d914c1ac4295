"""Opened tables and memoized rule expressions."""

from pyspark.sql import functions as F

from metroflow.functions import classify as C
from metroflow.functions import routes as RD
from metroflow.sources import records as R
from metroflow.sources import tables as T

from conftest import SF_SMALL


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_tables_and_records_are_opened_once_per_session(spark):
    assert R.vehicles(spark, SF_SMALL) is R.vehicles(spark, SF_SMALL)
    assert R.vehicles(spark, SF_SMALL + "/") is R.vehicles(spark, SF_SMALL)
    a = T.read_table(spark, SF_SMALL, "part", ["p_partkey"])
    assert a.columns == ["p_partkey"]
    T.refresh(spark)
    fresh = R.vehicles(spark, SF_SMALL)
    assert fresh is R.vehicles(spark, SF_SMALL)
    # an opened frame is a plan, not data: it re-reads on every action
    assert not fresh.storageLevel.useMemory
    assert fresh.count() == spark.read.parquet(T.table_path(SF_SMALL, "events")).count()


def test_rule_expressions_are_built_once_per_column_name(spark):
    assert RD.route_color("route_id", "ui") is RD.route_color("route_id", "ui")
    assert RD.route_color("route_id", "ui") is not RD.route_color("route_id", "api")
    assert C.severity("severity", "header", "description") is C.severity("severity", "header", "description")
    # a Column argument is not memoized (it is not a plain value)
    assert RD.route_kind(F.col("r")) is not RD.route_kind(F.col("r"))
    df = spark.createDataFrame([("A",), ("M15",)], "route_id string")
    got = {r.route_id: r.c for r in df.select("route_id", RD.route_color("route_id", "ui").alias("c")).collect()}
    assert got == {"A": "#0039A6", "M15": "#4D92FB"}
