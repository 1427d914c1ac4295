"""Plan checks: pushdown, top-k, one exchange for latest state, no cartesian/UDF anywhere."""

import pytest

from conftest import SF_SMALL
from metroflow.plans import catalog


def plan(df) -> str:
    """The formatted physical plan, untruncated."""
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


catalog.load_all()
QUERIES = dict(catalog.QUERIES)  # the training-data operators fit models and write stages: they have tests of their own
BATCH = [n for n in QUERIES if not n.startswith(catalog.STORED)]


@pytest.mark.parametrize("name", BATCH)
def test_no_cartesian_no_python(spark, name):
    p = plan(QUERIES[name](spark, SF_SMALL))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
        assert bad not in p, f"{name}: {bad}"


def test_pushdown_and_pruning(spark):
    from metroflow.plans import api
    from metroflow.sources import records as R
    out = api.outages_listing(R.outages(spark, SF_SMALL), station="bolt", limit=None)
    p = plan(out)
    assert "EqualTo(l_linestatus,O)" in p  # is_current pushed through its CASE to the scan
    assert "l_extendedprice" not in p  # pruned column


def test_topk_and_single_exchange(spark):
    p = plan(QUERIES["top_routes"](spark, SF_SMALL))
    assert "TakeOrderedAndProject" in p
    p = plan(QUERIES["vehicles_latest"](spark, SF_SMALL))
    tree = p.split("\n\n")[0]
    assert tree.count("Exchange (") == 1 and tree.count("Scan parquet") == 1
    assert "partial_max_by" in p
    p = plan(QUERIES["system_status"](spark, SF_SMALL)).split("\n\n")[0]
    assert "BroadcastHashJoin LeftOuter BuildRight" in p and "SortMergeJoin" not in p


# Queries whose sources are each read exactly once (a table may appear twice only
# when two record tables derive from it, e.g. part for equipment and outages).
SCAN_ONCE = {"summary_stats": 5, "feed_health": 4, "system_status": 1, "vehicles_dedup": 1,
             "equipment_availability": 3, "alerts_latest": 1, "vehicles_latest": 1, "top_routes": 1}


@pytest.mark.parametrize("name", sorted(SCAN_ONCE))
def test_each_source_read_once(spark, name):
    # the formatted plan names each scan twice (tree and details), subqueries included
    assert plan(QUERIES[name](spark, SF_SMALL)).count("Scan parquet") == 2 * SCAN_ONCE[name]


def test_route_stats_report_reads_only_the_trailing_hours(spark):
    p = plan(QUERIES["route_stats_24h"](spark, SF_SMALL))
    assert "GreaterThanOrEqual(ts,2024-01-29T00:00)" in p  # the cutoff reaches the scan


@pytest.mark.parametrize("as_of", ["2024-01-30 00:00:00", "2024-01-20 07:45:30"])
def test_route_stats_report_equals_the_unpruned_answer(spark, as_of):
    from metroflow.plans import api
    from metroflow.sources import records as R
    v = R.vehicles(spark, SF_SMALL)
    pruned = api.route_stats_report(v, as_of, limit=1000)
    whole = api.recent_route_stats(api.hourly_route_stats(v), as_of, limit=1000)
    assert whole.count() > 0
    assert pruned.exceptAll(whole).count() == 0 and whole.exceptAll(pruned).count() == 0


def test_building_a_query_runs_no_job(spark):
    """Queries are lazy: nothing executes until the caller's action. (Opening a
    table reads one Parquet footer for its schema, once per session: done first.)"""
    st = spark.sparkContext.statusTracker()
    for name in BATCH:
        QUERIES[name](spark, SF_SMALL)
    ran = {}
    for name in BATCH:
        before = len(st.getJobIdsForGroup(None))
        QUERIES[name](spark, SF_SMALL)
        ran[name] = len(st.getJobIdsForGroup(None)) - before
    assert {k: v for k, v in ran.items() if v} == {}


def test_route_stats_report_prunes_history_partitions(spark):
    from metroflow.operators import parse as PA
    from metroflow.plans import api
    from metroflow.session import fresh_dir
    from metroflow.sources import feeds as FD
    from metroflow.sources import records as R
    from metroflow.streaming import sinks as K
    from pyspark.sql import functions as F
    parsed = PA.vehicles(FD.vehicle_messages(R.vehicles(spark, SF_SMALL))).withColumn(
        "event_date", F.to_date("event_time"))
    table = fresh_dir(spark, "t-history")
    K.append_by_date(parsed, 0, table, qid="q")
    history = K.read_days(spark, table)
    as_of = "2024-01-20 07:45:30"
    pruned = api.route_stats_report(history, as_of, limit=1000, time_col="event_time")
    p = plan(pruned)
    assert "PartitionFilters: [isnotnull(event_date" in p and "(event_date#" in p and ">= 2024-01-19)" in p
    whole = api.recent_route_stats(api.hourly_route_stats(history, "event_time"), as_of, limit=1000)
    assert whole.count() > 0
    assert pruned.exceptAll(whole).count() == 0 and whole.exceptAll(pruned).count() == 0
