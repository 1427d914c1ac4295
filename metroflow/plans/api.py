"""Composite queries of the API and dashboard.

Each takes DataFrames of the stored tables (history, latest state, alerts,
outages, equipment) plus parameters and returns a lazy DataFrame: no action
runs inside. The same functions serve batch tables and tables written by the
streaming jobs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metroflow.functions import classify as C
from metroflow.functions import routes as RD
from metroflow.functions.time import board_date
from metroflow.operators import aggregate as A
from metroflow.operators import order as O
from metroflow.operators import parse as PA
from metroflow.operators import predicates as P
from metroflow.operators.state import latest_by_key

# Parameter defaults of the dashboard (fixed values).
TOP_ROUTES_N = 10
RECENT_ALERTS_N = 5
BOARD_ROWS_PER_PAGE = 10
BOARD_ORDER_BY = "station_name"
STATS_WINDOW = "1 hour"
STATS_HOURS = 24
# Freshness limits per component, seconds: three poll intervals (30 s, 60 s, 120 s).
HEALTH_LIMITS = {"vehicles_tracking": 90, "service_alerts": 180, "elevator_monitoring": 360}


# --- state -----------------------------------------------------------------

def latest_vehicles(history: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """A11 + K3: newest report per vehicle_id by (ts, event_id); reports without a vehicle id kept.

    ``columns`` narrows the rows before the shuffle (the aggregate carries whole rows).
    """
    if columns:
        keep = list(dict.fromkeys(["vehicle_id", "ts", "event_id"] + list(columns)))
        history = history.select(*keep)
    return latest_by_key(history, "vehicle_id", ["ts", "event_id"])


def latest_alerts(polls: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Newest version per alert id by poll time (``columns`` narrows the shuffled rows)."""
    if columns:
        polls = polls.select(*list(dict.fromkeys(["id", "updated"] + list(columns))))
    return latest_by_key(polls, "id", ["updated"], keep_keyless=False)


def prepare_alerts(polls: DataFrame, search: str | None = None, keep_description: bool = False) -> DataFrame:
    """Row-local work done before any shuffle: classes (C1-C3), route colours (J1), the
    card text (P22) and the search match (F11). The full description is then
    dropped, so a latest-state exchange moves a few small columns per alert
    instead of whole texts."""
    a = classify_alerts(polls).withColumn("card_text", C.cut_description("description"))
    if search:
        a = a.withColumn("search_hit", P.text_contains(search, "header", "description"))
    return a if keep_description else a.drop("description")


def active_at(alerts: DataFrame, as_of) -> DataFrame:
    """A5: alerts whose (first) active period covers ``as_of``; no period means always active."""
    t = F.lit(as_of).cast("timestamp_ntz")
    return alerts.filter((F.col("start").isNull() | (F.col("start") <= t))
                         & (F.col("end").isNull() | (F.col("end") > t)))


# --- enrich ----------------------------------------------------------------

def classify_alerts(alerts: DataFrame) -> DataFrame:
    """C1-C3 + J1: severity, type, effect and per-route colours of each alert."""
    return alerts.select(
        "*",
        C.severity("severity", "header", "description").alias("severity_class"),
        C.alert_type("alert_type", "header").alias("alert_type_class"),
        C.alert_effect("effect", "header").alias("effect_class"),
        RD.route_colors("routes", "ui").alias("route_colors"),
    )


def impute_positions(vehicles: DataFrame) -> DataFrame:
    """P20 + J5: fill a missing position from the route's box, deterministically.

    Draws come from md5(id): hex digits 1-8 for latitude, 9-16 for
    longitude, 17-24 for bearing, each mapped to [0, 1). The box lookup is
    an expression over the fixed box table, so no join is planned.
    """
    box = RD.route_box("route_id")

    def unit(part: int) -> Column:
        hexs = F.substring(F.md5(F.col("id")), 1 + 8 * part, 8)
        return F.conv(hexs, 16, 10).cast("bigint") / F.lit(4294967296.0)

    missing = F.col("latitude").isNull() | F.col("longitude").isNull()
    return vehicles.select(
        *[c for c in vehicles.columns if c not in ("latitude", "longitude", "bearing")],
        F.when(missing, box["lat_lo"] + (box["lat_hi"] - box["lat_lo"]) * unit(0))
         .otherwise(F.col("latitude")).alias("latitude"),
        F.when(missing, box["lon_lo"] + (box["lon_hi"] - box["lon_lo"]) * unit(1))
         .otherwise(F.col("longitude")).alias("longitude"),
        F.coalesce(F.col("bearing"), unit(2) * F.lit(359.0)).alias("bearing"),
        missing.alias("is_imputed"),
    )


def nest_position(df: DataFrame) -> DataFrame:
    """Position struct(latitude, longitude, bearing)."""
    rest = [c for c in df.columns if c not in ("latitude", "longitude", "bearing")]
    return df.select(*rest, F.struct("latitude", "longitude", "bearing").alias("position"))


def unnest_position(df: DataFrame) -> DataFrame:
    rest = [c for c in df.columns if c != "position"]
    return df.select(*rest, "position.*")


# --- listings (E2-E5) --------------------------------------------------------

def vehicles_listing(latest: DataFrame, route_id: str | None = None, route_type: str | None = None,
                     family: str | None = None, box: tuple | None = None, mode: str = "dim",
                     limit: int | None = O.DEFAULT_LIMIT) -> DataFrame:
    """Vehicles filtered by route, route type, family and box (all ANDed), key order.

    A nested position is taken apart where the box asks for it.
    """
    if box is not None:
        latest = PA.conform(latest, PA.VEHICLE_ALIASES)
    preds = [P.route_is(route_id), P.route_type_is(route_type, mode=mode), P.family_is(family)]
    if box is not None:
        preds.append(P.usable_position() & P.in_box(*box))
    out = P.where_all(latest, *preds)
    return _limited(out, ["id"], limit)


def alerts_listing(alerts: DataFrame, route_id: str | None = None, severity: str | None = None,
                   search: str | None = None, limit: int | None = O.DEFAULT_LIMIT) -> DataFrame:
    """Classified alerts filtered by route, severity (after classification) and text.

    Takes raw alerts or ones from ``prepare_alerts`` (then the search must match its ``search``).
    """
    alerts = PA.conform(alerts, PA.ALERT_ALIASES)
    a = alerts if "severity_class" in alerts.columns else classify_alerts(alerts)
    hit = None
    if search:
        hit = F.col("search_hit") if "search_hit" in a.columns else P.text_contains(search, "header", "description")
    out = P.where_all(a, P.route_in_array(route_id), P.equals_ignore_case(severity, "severity_class"), hit)
    return _limited(out, ["id"], limit)


def outages_listing(outages: DataFrame, station: str | None = None, borough: str | None = None,
                    equipment_type: str | None = None, kind: str | None = "current", regex: bool = False,
                    limit: int | None = O.DEFAULT_LIMIT) -> DataFrame:
    """Outages by type and case-insensitive substring filters; either spelling of their columns."""
    outages = PA.conform(outages, PA.OUTAGE_ALIASES)
    out = P.where_all(outages, P.outage_type_is(kind),
                      P.text_contains(station, "station", regex=regex),
                      P.text_contains(borough, "borough", regex=regex),
                      P.text_contains(equipment_type, "equipment_type", regex=regex))
    return _limited(out, ["outage_id"], limit)


def equipment_listing(equipment: DataFrame, station: str | None = None, borough: str | None = None,
                      equipment_type: str | None = None, ada: bool | None = None, regex: bool = False,
                      limit: int | None = O.DEFAULT_LIMIT) -> DataFrame:
    """E5: equipment by substring filters and the tri-state ada flag; either spelling of their columns."""
    equipment = PA.conform(equipment, PA.EQUIPMENT_ALIASES)
    out = P.where_all(equipment, P.text_contains(station, "station", regex=regex),
                      P.text_contains(borough, "borough", regex=regex),
                      P.text_contains(equipment_type, "equipment_type", regex=regex),
                      P.is_value(ada, "ada"))
    return _limited(out, ["equipment_id"], limit)


def _limited(df: DataFrame, key: list[str], limit: int | None) -> DataFrame:
    """A limit is checked and applied after ordering by the key; None, which a caller must name, is the whole listing."""
    if limit is None:
        return df
    return O.top(df, O.check_limit(limit), [], key)


# --- aggregates (E1, E6, E7, J4) --------------------------------------------

def route_alert_status(spark: SparkSession, alerts: DataFrame, routes: list[str] | None = None,
                       mode: str = "dim") -> DataFrame:
    """Per route, alert count, severe count, status and colour.

    One explode + groupBy replaces a pair of counts per route; the reduced
    counts (at most one row per route) join the route dimension, whose size
    is fixed by the route list. ``mode='reference'`` keeps the API's route list
    and its exact comparison of the stored severity with 'severe'.
    """
    if mode == "reference":
        routes = routes or RD.REFERENCE_SUBWAY_LIST
        severe = F.col("severity") == F.lit("severe")
        base = alerts
    else:
        routes = routes or (RD.SUBWAY_CODES + ["SIR"])
        base = alerts if "severity_class" in alerts.columns else classify_alerts(alerts)
        severe = F.col("severity_class") == "SEVERE"
    per = (base
           .select("id", severe.alias("_severe"), F.explode(F.array_distinct("routes")).alias("route_id"))
           .filter(F.col("route_id").isin(*routes))
           .groupBy("route_id")
           .agg(F.count(F.lit(1)).alias("alerts_count"),
                F.count_if(F.col("_severe")).alias("severe_count")))
    # ``per`` has at most one row per listed route, so broadcasting it is bounded by the list.
    dim = spark.createDataFrame([(r,) for r in routes], "route_id string")
    return (dim.join(F.broadcast(per), "route_id", "left")
            .select("route_id",
                    F.coalesce("alerts_count", F.lit(0)).alias("alerts_count"),
                    F.coalesce("severe_count", F.lit(0)).alias("severe_count"))
            .withColumn("status", C.route_status("severe_count", "alerts_count"))
            .withColumn("color", RD.route_color("route_id", "api")))


def hourly_route_stats(history: DataFrame, time_col: str = "ts") -> DataFrame:
    """A10: vehicles per (hour window, line, route)."""
    return A.windowed_count(history, time_col, STATS_WINDOW, "line_id", "route_id")


def route_stats_report(history: DataFrame, as_of, line_id: str | None = None, hours: int = STATS_HOURS,
                       limit: int | None = None, time_col: str = "ts") -> DataFrame:
    """E7 straight from the reports, reading only the trailing ``hours``.

    A window that starts at or after the cutoff holds only reports at or after
    it, so the reports are filtered on their own time before the aggregate:
    that predicate reaches the Parquet scan (and prunes ``event_date``
    partitions of a stored history), where F14 on the window start could not.
    Windows this cuts short start before the cutoff and F14 drops them.
    """
    start = P.cutoff(as_of, hours)
    h = history.filter(F.col(time_col) >= start)
    if "event_date" in history.columns:
        h = h.filter(F.col("event_date") >= F.to_date(start))
    return recent_route_stats(hourly_route_stats(h, time_col), as_of, line_id, hours, limit)


def recent_route_stats(stats: DataFrame, as_of, line_id: str | None = None,
                       hours: int = STATS_HOURS, limit: int | None = O.DEFAULT_LIMIT) -> DataFrame:
    """Windows of the last ``hours`` before ``as_of``, newest first, limited."""
    out = P.where_all(stats, P.is_value(line_id, "line_id"), P.since(as_of, hours))
    return O.top(out, O.check_limit(limit), [F.col("window_start").desc()], ["line_id", "route_id"])


def equipment_status(equipment: DataFrame, outages: DataFrame) -> DataFrame:
    """J4 + A4 in one pass (one row): equipment total, equipment with a current
    outage, current and upcoming outage counts.

    Outages reduce to one row per equipment before a full outer join with the
    equipment table, so each table is scanned once and the join moves at
    most one row per equipment from each side.
    """
    cur = P.is_current()
    per = outages.groupBy("equipment_id").agg(F.count_if(cur).alias("_cur"), F.count_if(~cur).alias("_upc"))
    eq = equipment.select("equipment_id", F.lit(True).alias("_eq"))
    j = eq.join(per, "equipment_id", "full")
    known = F.coalesce(F.col("_eq"), F.lit(False))
    return j.agg(
        F.count_if(known).alias("total_equipment"),
        F.count_if(known & (F.coalesce(F.col("_cur"), F.lit(0)) > 0)).alias("out_of_service"),
        F.coalesce(F.sum("_cur"), F.lit(0)).cast("bigint").alias("current_outages"),
        F.coalesce(F.sum("_upc"), F.lit(0)).cast("bigint").alias("upcoming_outages"),
    )


def equipment_availability(equipment: DataFrame, outages: DataFrame) -> DataFrame:
    """Equipment total, equipment with a current outage, in-service share (one row)."""
    st = equipment_status(equipment, outages)
    return st.select("total_equipment", "out_of_service",
                     A.share(F.col("total_equipment") - F.col("out_of_service"), F.col("total_equipment"))
                     .alias("in_service_percentage"))


def vehicle_figures(latest: DataFrame) -> DataFrame:
    """A1-A3, A7 in one aggregation (one row): totals, distinct lines, per-line and
    per-route count maps. ``cube(line, route)`` yields per-line, per-route and
    total groups from one exchange; the one-row fold then runs over those few
    groups only."""
    c = latest.cube("line_id", "route_id").agg(
        F.count(F.lit(1)).alias("n"), F.count("vehicle_id").alias("nv"), F.grouping_id().alias("g"))
    g, n = F.col("g"), F.col("n").cast("string")

    def kv(col: str) -> Column:
        return F.concat(F.coalesce(F.col(col), F.lit("null")), F.lit(":"), n)

    return c.agg(
        F.coalesce(F.sum(F.when(g == 3, F.col("n"))), F.lit(0)).alias("total_vehicles"),
        F.coalesce(F.sum(F.when(g == 3, F.col("nv"))), F.lit(0)).alias("active_vehicles"),
        F.count_if((g == 1) & F.col("line_id").isNotNull()).alias("active_lines"),
        F.array_join(F.array_sort(F.collect_list(F.when(g == 1, kv("line_id")))), ",").alias("vehicles_by_line"),
        F.array_join(F.array_sort(F.collect_list(F.when(g == 2, kv("route_id")))), ",").alias("vehicles_by_route"),
    )


def summary(latest: DataFrame, outages: DataFrame, active_alerts: DataFrame, equipment: DataFrame) -> DataFrame:
    """One row of system figures; maps are sorted ``key:count`` strings.

    Three independent pipelines (vehicles, alerts, equipment with outages),
    each one scalar subquery returning a struct, so every source is read
    once and the row is assembled without a join.
    """
    spark = latest.sparkSession
    veh = vehicle_figures(latest).select(F.struct("*")).scalar()
    eqs = equipment_status(equipment, outages).select(F.struct("*")).scalar()
    n_alerts = active_alerts.select(F.count(F.lit(1))).scalar()
    row = spark.range(1).select(veh.alias("v"), eqs.alias("e"), n_alerts.alias("active_alerts"))
    return row.select(
        "v.total_vehicles", "v.active_vehicles", "v.active_lines", "v.vehicles_by_line", "v.vehicles_by_route",
        F.col("e.current_outages").alias("current_elevator_outages"),
        F.col("e.upcoming_outages").alias("upcoming_elevator_outages"),
        "active_alerts", "e.total_equipment",
        A.share(F.col("e.total_equipment") - F.col("e.out_of_service"), F.col("e.total_equipment"))
        .alias("in_service_percentage"),
    )


def component_health(name: str, table: DataFrame, processed_at: str, as_of, limit_s: int) -> DataFrame:
    """A15 for one table: rows, newest processing time, age and status.

    ``as_of=None`` judges the table at its own newest processing time (age 0).
    """
    agg = table.agg(F.count(F.lit(1)).alias("n_rows"), F.max(processed_at).alias("last_processed_at"))
    return judged_health(name, agg, as_of, limit_s)


def judged_health(name: str, figures: DataFrame, as_of, limit_s: int) -> DataFrame:
    """A15 from figures known already (``n_rows``, ``last_processed_at``), such as those a stream's batches took."""
    t = F.col("last_processed_at") if as_of is None else (
        as_of if isinstance(as_of, Column) else F.lit(as_of).cast("timestamp_ntz"))
    age = F.timestamp_diff("SECOND", F.col("last_processed_at"), t)
    return figures.select(
        F.lit(name).alias("component"), "n_rows", "last_processed_at", age.alias("age_seconds"),
        F.when(F.col("n_rows") == 0, F.lit("DOWN"))
         .when(age <= limit_s, F.lit("OPERATIONAL"))
         .otherwise(F.lit("DEGRADED")).alias("status"),
    )


def feed_health(components: list[DataFrame]) -> DataFrame:
    """Component rows plus an overall row (OPERATIONAL only if all are).

    The overall figures come from a window over the component rows (one row
    per component, a fixed handful), and are emitted once by an explode, so
    each source table is read once.
    """
    rows = components[0]
    for c in components[1:]:
        rows = rows.unionByName(c)
    w = Window.partitionBy(F.lit(0))
    cols = ["component", "n_rows", "last_processed_at", "age_seconds", "status"]
    r = rows.select(
        *cols,
        F.sum("n_rows").over(w).alias("_n"),
        F.max("last_processed_at").over(w).alias("_last"),
        F.max("age_seconds").over(w).alias("_age"),
        F.min((F.col("status") == "OPERATIONAL").cast("int")).over(w).alias("_ok"),
        F.row_number().over(w.orderBy("component")).alias("_rn"),
    )
    own = F.struct(*[F.col(c) for c in cols])
    overall = F.struct(
        F.lit("overall").alias("component"), F.col("_n").alias("n_rows"), F.col("_last").alias("last_processed_at"),
        F.col("_age").alias("age_seconds"),
        F.when(F.col("_ok") == 1, F.lit("OPERATIONAL")).otherwise(F.lit("DEGRADED")).alias("status"))
    out = r.select(F.explode(F.when(F.col("_rn") == 1, F.array(own, overall)).otherwise(F.array(own))).alias("x"))
    return out.select("x.*")


# --- boards (E8-E10) -------------------------------------------------------

def top_routes_chart(latest: DataFrame, n: int = TOP_ROUTES_N) -> DataFrame:
    """Top n routes by active vehicles; chart label (C9) and chart colour."""
    counts = latest.groupBy("route_id", "line_id").agg(F.count(F.lit(1)).alias("count"))
    top_n = O.top(counts, n, [F.col("count").desc()], ["route_id", "line_id"])
    label = C.chart_label("route_id", "line_id")
    return top_n.select("route_id", "line_id", "count", label.alias("label"),
                        RD.route_color(label, "chart").alias("color"))


def recent_alerts_card(alerts: DataFrame, n: int = RECENT_ALERTS_N) -> DataFrame:
    """Newest n alerts with card defaults."""
    top_n = O.top(alerts, n, [F.col("updated").desc()], ["id"])
    return top_n.select(
        "id", "updated",
        F.coalesce(F.when(F.col("header") != "", F.col("header")), F.lit(C.DEFAULT_HEADER)).alias("title"),
        F.coalesce(F.when(F.col("severity") != "", F.col("severity")), F.lit(C.DEFAULT_SEVERITY_CHIP)).alias("chip"),
        (F.col("card_text") if "card_text" in alerts.columns else C.cut_description("description")).alias("text"),
    )


def outages_board(outages: DataFrame, kind: str = "current", equipment_type: str | None = None,
                  station: str | None = None, search: str | None = None) -> DataFrame:
    """E10 rows: type, station (server side), exact equipment type and text search (client side)."""
    rows = outages_listing(outages, station=station, kind=kind, limit=None)
    rows = P.where_all(rows, P.is_value(equipment_type, "equipment_type"),
                       P.text_contains(search, "station", "serving", "reason"))
    return rows.select(
        "outage_id", F.col("station").alias("station_name"), "equipment_id", "equipment_type", "serving",
        "reason", "outage_start", "outage_end", F.col("latest_status").alias("status"),
        board_date("outage_start", "N/A").alias("start_text"),
        board_date("outage_end", "Indefinite").alias("end_text"),
    )


def board_page(board: DataFrame, page_no: int = 0, page_size: int = BOARD_ROWS_PER_PAGE,
               order_by: str = BOARD_ORDER_BY, ascending: bool = True) -> DataFrame:
    """O5 + O6: one page of the sorted board (ties broken by outage_id)."""
    return O.page(board, page_no, page_size, [O.sort_key(order_by, ascending)], ["outage_id"])


def board_count(board: DataFrame, page_size: int = BOARD_ROWS_PER_PAGE) -> DataFrame:
    """A16: 'Showing x of y'."""
    return board.agg(F.count(F.lit(1)).alias("n_matches")).select(
        F.least(F.lit(page_size).cast("bigint"), F.col("n_matches")).alias("n_shown"), "n_matches")
