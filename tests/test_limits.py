"""Limits and paging: bounds checked, pages concatenate to the whole ordered result."""

import pytest
from pyspark.sql import functions as F

from metroflow.operators import order as O


def test_limit_bounds():
    assert O.check_limit(None) == 100
    assert O.check_limit(1) == 1 and O.check_limit(1000) == 1000
    for bad in (0, -1, 1001):
        with pytest.raises(ValueError):
            O.check_limit(bad)


def test_pages_concatenate_to_whole(spark):
    df = spark.range(0, 53).select((F.col("id") % 7).alias("g"), F.col("id").cast("string").alias("k"))
    whole = [tuple(r) for r in O.ordered(df, [F.col("g").desc()], ["k"]).collect()]
    pages = []
    for p in range(6):
        pages += [tuple(r) for r in O.page(df, p, 10, [F.col("g").desc()], ["k"]).collect()]
    assert pages == whole


def test_keyset_paging_equals_offset_paging(spark):
    df = spark.range(0, 40).select((F.col("id") % 5).alias("g"), F.col("id").alias("k"))
    seen, after = [], None
    while True:
        page = [tuple(r) for r in O.page_after(df, 7, ["g"], ["k"], after).collect()]
        if not page:
            break
        seen += page
        after = page[-1]
    assert seen == [tuple(r) for r in df.orderBy("g", "k").collect()]


def test_top_is_take_ordered(spark):
    df = spark.range(0, 100).select((F.col("id") % 9).alias("n"), F.col("id").alias("k"))
    top = O.top(df, 3, [F.col("n").desc()], ["k"])
    assert [tuple(r) for r in top.collect()] == [(8, 8), (8, 17), (8, 26)]
    assert "TakeOrderedAndProject" in top._jdf.queryExecution().executedPlan().toString()


def test_cluster_conf_scales_with_input():
    from metroflow.session import cluster_conf
    big = cluster_conf(100 * 10**12, executors=1000, cores_per_executor=8)
    small = cluster_conf(10 * 10**9, executors=10, cores_per_executor=4)
    assert int(big["spark.sql.shuffle.partitions"]) >= 24_000
    assert int(small["spark.sql.shuffle.partitions"]) == 120
    assert big["spark.sql.adaptive.enabled"] == "true" and int(big["spark.sql.autoBroadcastJoinThreshold"]) <= 64 << 20
    assert big["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] == "true"
