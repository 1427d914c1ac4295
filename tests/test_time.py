"""Time helpers give the same answers whatever the session time zone (DST included)."""

import pytest
from pyspark.sql import functions as F

from metroflow.functions import time as TM


@pytest.mark.parametrize("tz", ["UTC", "America/New_York", "Asia/Kolkata"])
def test_zone_free(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        df = spark.createDataFrame([("2024-07-01 00:00:00.7",), ("2024-01-15 12:00:00",)], "s string") \
            .select(F.col("s").cast("timestamp_ntz").alias("t"))
        r = df.select(TM.epoch_seconds("t").alias("e"), TM.to_wall_time(TM.to_event_time("t")).alias("rt"),
                      TM.from_epoch_seconds(TM.epoch_seconds("t")).alias("b"), "t").collect()
        assert [x.e for x in r] == [1719792000, 1705320000]
        assert all(x.rt == x.t for x in r)
        assert [str(x.b) for x in r] == ["2024-07-01 00:00:00", "2024-01-15 12:00:00"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_board_date(spark):
    df = spark.createDataFrame([("2024-01-05 13:04:00",), (None,)], "s string") \
        .select(F.col("s").cast("timestamp_ntz").alias("t"))
    got = [r[0] for r in df.select(TM.board_date("t", "Indefinite")).collect()]
    assert got == ["Jan 05, 2024 1:04 PM", "Indefinite"]


@pytest.mark.parametrize("tz", ["UTC", "America/New_York"])
def test_offsets_and_fractions(spark, tz):
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", tz)
    try:
        rows = ["2024-01-01T12:00:00Z", "2024-01-01T12:00:00+05:00", "2024-01-01 12:00:00", "2024-01-01T12:00:00.25",
                "1704110400", "1704110400000", "1704110400.5", "UTC", ""]
        df = spark.createDataFrame([(r,) for r in rows], "s string")
        got = [str(r[0]) for r in df.select(TM.normalize_time("s")).collect()]
        noon = "2024-01-01 12:00:00"
        assert got == [noon, "2024-01-01 07:00:00", noon, noon + ".250000", noon, noon, noon + ".500000", "None", "None"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
