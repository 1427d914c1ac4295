"""Stored tables for serving: what the streaming jobs write, opened as
DataFrames so the composite queries of ``plans.api`` run on them directly
(latest state is reduced from one row per key and batch, not from history).

Layout under ``root`` (see ``streaming.jobs``)::

    vehicle_history/event_date=*/batch=*     appended reports, closed days packed
    vehicle_latest/batch=*/keyed=*           newest row per vehicle of each batch
    route_stats/batch=*                      update-mode window counts (max on read)
    route_windows/window_date=*/batch=*      closed windows
    alerts/, alerts_latest/alerts/           every version, newest per id and batch
    outages/, outages_latest/outages_{current,upcoming}/
    equipment/, equipment_latest/equipment/
    polls/<feed>/batch=*                     time of the newest poll in each batch
    rejects/<feed>/batch=*                   messages that did not decode
"""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflow.functions.cells import in_cells
from metroflow.functions.time import from_epoch_seconds
from metroflow.operators import predicates as P
from metroflow.operators.state import latest_by_key
from metroflow.plans import api
from metroflow.streaming import jobs as J
from metroflow.streaming import sinks as K


def newest_poll(rows: DataFrame, spark: SparkSession, root: str, kind: str) -> DataFrame:
    """The rows that the feed's newest poll still sent; one that left the feed is no longer current."""
    polls = K.read_appended(spark, f"{root}/polls/{kind}", "poll_time bigint") if K.has_rows(spark, f"{root}/polls/{kind}") else None
    if polls is None:
        return rows
    return rows.filter(F.col("fetch_time") >= polls.agg(from_epoch_seconds(F.max("poll_time"))).scalar())


def vehicle_latest(spark: SparkSession, root: str) -> DataFrame:
    return J.read_latest(spark, root, "vehicles")


def vehicle_history(spark: SparkSession, root: str, first=None, last=None) -> DataFrame:
    return J.read_history(spark, root, first, last)


def route_stats_report(spark: SparkSession, root: str, as_of, line_id: str | None = None, hours: int = api.STATS_HOURS,
                       limit: int | None = None) -> DataFrame:
    """E7 on the stored history: lists and reads only the days of the trailing ``hours``."""
    as_of = datetime.datetime.fromisoformat(str(as_of))
    rows = J.read_history(spark, root, (as_of - datetime.timedelta(hours=hours)).date())
    return api.route_stats_report(rows, as_of, line_id, hours, limit, "event_time")


def vehicles_in_box(spark: SparkSession, root: str, box: tuple, first=None, last=None) -> DataFrame:
    """F17 on the stored history: Z-order ranges of the box are pushed to the scan, the box itself is checked."""
    rows = J.read_history(spark, root, first, last)
    return rows.filter(in_cells(J.HISTORY_CELL, *box) & P.usable_position() & P.in_box(*box))


def alerts_latest(spark: SparkSession, root: str) -> DataFrame:
    return J.read_latest(spark, root, "alerts")


def outages_latest(spark: SparkSession, root: str) -> DataFrame:
    """The outages of the newest poll of the current and upcoming feeds, the newest
    version of each (an outage moves from one feed to the other)."""
    cur, upc = (newest_poll(J.read_latest(spark, root, kind), spark, root, kind)
                for kind in ("outages_current", "outages_upcoming"))
    return latest_by_key(cur.unionByName(upc), "outage_id", ["fetch_time", "is_current"])


def equipment_latest(spark: SparkSession, root: str) -> DataFrame:
    return J.read_latest(spark, root, "equipment")


def route_stats(spark: SparkSession, root: str) -> DataFrame:
    return J.read_route_stats(spark, root)


#: The feeds of each component.
COMPONENTS = {"vehicles_tracking": ["vehicles"], "service_alerts": ["alerts"],
              "elevator_monitoring": ["outages_current", "outages_upcoming", "equipment"]}


def feed_health(spark: SparkSession, root: str, as_of: dict, limits: dict | None = None) -> DataFrame:
    """E11 from the figures that the batches took while they were written; no stored table is scanned.

    ``as_of`` has the time at which each component is judged.
    """
    parts = []
    for name, feeds in COMPONENTS.items():
        rows = K.read_health(spark, f"{root}/health/{feeds[0]}")
        for f in feeds[1:]:
            rows = rows.unionByName(K.read_health(spark, f"{root}/health/{f}"))
        figures = rows.agg(F.sum("n_rows").alias("n_rows"), F.max("last_event").alias("last_processed_at"))
        parts.append(api.judged_health(name, figures, as_of[name], (limits or api.HEALTH_LIMITS)[name]))
    return api.feed_health(parts)


def tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """All stored tables by name (lazy; nothing is read until a query runs)."""
    return {
        "vehicle_history": vehicle_history(spark, root),
        "vehicle_latest": vehicle_latest(spark, root),
        "alerts_latest": alerts_latest(spark, root),
        "outages": outages_latest(spark, root),
        "equipment": equipment_latest(spark, root),
        "route_stats": route_stats(spark, root),
        "route_windows": J.read_route_windows(spark, root),
    }
