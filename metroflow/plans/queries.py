"""Registered queries: each binds a composite of ``plans.api`` to the record
tables of a data folder, next to its DuckDB oracle.

Fixed parameters of the checks (as_of times, search words, routes) are the
values of FIXTURES.md; every query reads whole tables.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflow.functions import classify as C
from metroflow.functions import routes as RD
from metroflow.operators import aggregate as A
from metroflow.operators import predicates as P
from metroflow.operators import textindex as TI
from metroflow.operators.state import dedup
from metroflow.plans import api
from metroflow.plans import oracle as S
from metroflow.plans.catalog import register
from metroflow.sources import records as R

# Fixed as_of values and parameters of the registered queries.
EVENTS_AS_OF = "2024-01-30 00:00:00"
ALERTS_AS_OF = "2024-01-15 00:00:00"
HEALTH_VEHICLES_AS_OF = "2024-01-31 00:00:00"
HEALTH_OUTAGES_AS_OF = "1999-01-01 00:00:00"
BOX = (40.70, 40.80, -74.00, -73.90)


def _latest(spark, d, *columns: str) -> DataFrame:
    """Latest report per vehicle, carrying only ``columns`` (plus key and order) through the shuffle."""
    return api.latest_vehicles(R.vehicles(spark, d), list(columns) or None)


def _alerts_latest(spark, d, *columns: str, search: str | None = None) -> DataFrame:
    """Latest alert versions; with ``columns``, prepared (classified, text dropped) before the shuffle."""
    polls = R.alert_polls(spark, d)
    if not columns:
        return api.latest_alerts(polls)
    return api.latest_alerts(api.prepare_alerts(polls, search=search), list(columns))


def _routes_str(col: str = "routes"):
    return F.array_join(col, ",").alias("routes_str")


W = S.with_records

# ---------------------------------------------------------------------------
# state
# ---------------------------------------------------------------------------


@register("vehicles_latest", W("SELECT id, vehicle_id, route_id, line_id, latitude, longitude, ts "
                               "FROM vehicles_latest", "vehicles_latest"))
def vehicles_latest(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d, "id", "route_id", "line_id", "latitude", "longitude").select(
        "id", "vehicle_id", "route_id", "line_id", "latitude", "longitude", "ts")


@register("vehicles_dedup", W("SELECT id, vehicle_id, route_id, ts FROM vehicles", "vehicles"))
def vehicles_dedup(spark: SparkSession, d: str) -> DataFrame:
    v = R.vehicles(spark, d).select("event_id", "id", "vehicle_id", "route_id", "ts")
    return dedup(R.replay_duplicates(v), "id").select("id", "vehicle_id", "route_id", "ts")


@register("alerts_latest", W("SELECT id, severity, updated, header, routes_str FROM alerts_latest", "alerts_latest"))
def alerts_latest(spark: SparkSession, d: str) -> DataFrame:
    return _alerts_latest(spark, d, "severity", "header", "routes").select(
        "id", "severity", "updated", "header", _routes_str())


# ---------------------------------------------------------------------------
# enrich
# ---------------------------------------------------------------------------

_LAT_LO, _LAT_HI, _LON_LO, _LON_HI = S.sql_route_box("route_id")


@register("vehicles_imputed", W(f"""
SELECT id, route_id,
       CASE WHEN latitude IS NULL OR longitude IS NULL
            THEN {_LAT_LO} + ({_LAT_HI} - {_LAT_LO}) * {S.sql_unit('id', 0)} ELSE latitude END AS latitude,
       CASE WHEN latitude IS NULL OR longitude IS NULL
            THEN {_LON_LO} + ({_LON_HI} - {_LON_LO}) * {S.sql_unit('id', 1)} ELSE longitude END AS longitude,
       coalesce(bearing, {S.sql_unit('id', 2)} * CAST(359 AS DOUBLE)) AS bearing,
       (latitude IS NULL OR longitude IS NULL) AS is_imputed
FROM vehicles""", "vehicles"))
def vehicles_imputed(spark: SparkSession, d: str) -> DataFrame:
    return api.impute_positions(R.vehicles(spark, d)).select(
        "id", "route_id", "latitude", "longitude", "bearing", "is_imputed")


@register("vehicle_status", W("""
SELECT id, current_status, stop_id,
       concat_ws(' ', CASE current_status WHEN 0 THEN 'Incoming at' WHEN 1 THEN 'Stopped at'
                                          WHEN 2 THEN 'In transit to' ELSE 'Unknown' END, stop_id) AS status_text
FROM vehicles""", "vehicles"))
def vehicle_status(spark: SparkSession, d: str) -> DataFrame:
    v = R.vehicles(spark, d)
    return v.select("id", "current_status", "stop_id",
                    C.vehicle_status_text("current_status", "stop_id").alias("status_text"))


@register("alert_severity", W(f"""
SELECT id, severity, {S.sql_severity('severity', 'header', 'description')} AS severity_class
FROM alerts""", "alerts"))
def alert_severity(spark: SparkSession, d: str) -> DataFrame:
    a = R.alerts(spark, d)
    return a.select("id", "severity", C.severity("severity", "header", "description").alias("severity_class"))


@register("alert_severity_page", W(f"""
SELECT id, severity, {S.sql_severity_page('severity', 'header')} AS severity_class
FROM alerts""", "alerts"))
def alert_severity_page(spark: SparkSession, d: str) -> DataFrame:
    a = R.alerts(spark, d)
    return a.select("id", "severity", C.severity_page("severity", "header").alias("severity_class"))


@register("alert_type", W(f"""
SELECT id, alert_type, {S.sql_alert_type('alert_type', 'header')} AS alert_type_class
FROM alerts""", "alerts"))
def alert_type(spark: SparkSession, d: str) -> DataFrame:
    a = R.alerts(spark, d)
    return a.select("id", "alert_type", C.alert_type("alert_type", "header").alias("alert_type_class"))


@register("alert_effect", W(f"""
SELECT id, effect, {S.sql_alert_effect('effect', 'header')} AS effect_class
FROM alerts""", "alerts"))
def alert_effect(spark: SparkSession, d: str) -> DataFrame:
    a = R.alerts(spark, d)
    return a.select("id", "effect", C.alert_effect("effect", "header").alias("effect_class"))


_SEEN_ROUTES_SQL = ("(SELECT route_id FROM vehicles UNION SELECT route_1 FROM alerts "
                    "UNION SELECT route_2 FROM alerts)")


def _seen_routes(spark, d) -> DataFrame:
    """Distinct route codes seen in vehicles and alerts (one aggregate over both)."""
    v = R.vehicles(spark, d).select("route_id")
    a = R.alerts(spark, d).select(F.explode("routes").alias("route_id"))
    return v.unionByName(a).distinct()


@register("route_type", W(f"""
SELECT route_id, {S.sql_page_route_type('route_id')} AS route_type,
       {S.sql_page_route_label('route_id')} AS route_label,
       {S.sql_route_kind('route_id')} AS kind, {S.sql_route_family('route_id')} AS family,
       {S.sql_is_bus('route_id')} AS is_bus
FROM {_SEEN_ROUTES_SQL} r""", "vehicles", "alerts"))
def route_type(spark: SparkSession, d: str) -> DataFrame:
    r = _seen_routes(spark, d)
    return r.select("route_id", RD.page_route_type("route_id").alias("route_type"),
                    RD.page_route_label("route_id").alias("route_label"),
                    RD.route_kind("route_id").alias("kind"), RD.route_family("route_id").alias("family"),
                    RD.is_bus_route("route_id").alias("is_bus"))


@register("route_color", W(f"""
SELECT route_id, {S.sql_dim_color('route_id')} AS color, {S.sql_ui_color('route_id')} AS color_ui,
       {S.sql_ui_color('route_id', 'alerts_page')} AS color_alerts_page,
       {S.sql_ui_color('route_id', 'chart')} AS color_chart, {S.sql_api_color('route_id')} AS color_api
FROM {_SEEN_ROUTES_SQL} r""", "vehicles", "alerts"))
def route_color(spark: SparkSession, d: str) -> DataFrame:
    r = _seen_routes(spark, d)
    return r.select("route_id", RD.route_color("route_id").alias("color"),
                    RD.route_color("route_id", "ui").alias("color_ui"),
                    RD.route_color("route_id", "alerts_page").alias("color_alerts_page"),
                    RD.route_color("route_id", "chart").alias("color_chart"),
                    RD.route_color("route_id", "api").alias("color_api"))


@register("alert_route_colors", W(f"""
SELECT id, CASE WHEN route_1 = route_2 THEN route_1 || ':' || {S.sql_ui_color('route_1')}
                ELSE route_1 || ':' || {S.sql_ui_color('route_1')} || ',' || route_2 || ':' || {S.sql_ui_color('route_2')}
           END AS route_colors
FROM alerts""", "alerts"))
def alert_route_colors(spark: SparkSession, d: str) -> DataFrame:
    return api.classify_alerts(R.alerts(spark, d)).select("id", "route_colors")


# ---------------------------------------------------------------------------
# listings
# ---------------------------------------------------------------------------

_VL_COLS = ["id", "vehicle_id", "route_id", "line_id"]


@register("vehicles_list", W("""
SELECT id, vehicle_id, route_id, line_id, latitude, longitude, bearing, ts AS event_time
FROM vehicles_latest WHERE route_id = 'A'""", "vehicles_latest"))
def vehicles_list(spark: SparkSession, d: str) -> DataFrame:
    listed = api.vehicles_listing(api.nest_position(_latest(spark, d, "id", "route_id", "line_id", "latitude", "longitude", "bearing")), route_id="A", limit=None)
    return api.unnest_position(listed).select(*_VL_COLS, "latitude", "longitude", "bearing",
                                              F.col("ts").alias("event_time"))


@register("vehicles_subway", W(f"SELECT id, vehicle_id, route_id, line_id FROM vehicles_latest "
                               f"WHERE {S.sql_route_kind('route_id')} = 'subway'", "vehicles_latest"))
def vehicles_subway(spark: SparkSession, d: str) -> DataFrame:
    return api.vehicles_listing(_latest(spark, d, *_VL_COLS), route_type="subway", limit=None).select(*_VL_COLS)


@register("vehicles_subway_ref", W(f"SELECT id, vehicle_id, route_id, line_id FROM vehicles_latest "
                                   f"WHERE route_id IN ({S.in_list(RD.REFERENCE_SUBWAY_LIST)})", "vehicles_latest"))
def vehicles_subway_ref(spark: SparkSession, d: str) -> DataFrame:
    return api.vehicles_listing(_latest(spark, d, *_VL_COLS), route_type="subway", mode="reference", limit=None).select(*_VL_COLS)


@register("vehicles_bus", W(f"SELECT id, vehicle_id, route_id, line_id FROM vehicles_latest "
                            f"WHERE {S.sql_route_kind('route_id')} = 'bus'", "vehicles_latest"))
def vehicles_bus(spark: SparkSession, d: str) -> DataFrame:
    return api.vehicles_listing(_latest(spark, d, *_VL_COLS), route_type="bus", limit=None).select(*_VL_COLS)


@register("vehicles_bus_ref", W("SELECT id, vehicle_id, route_id, line_id FROM vehicles_latest "
                                "WHERE regexp_matches(route_id, '^[BMQSBx]')", "vehicles_latest"))
def vehicles_bus_ref(spark: SparkSession, d: str) -> DataFrame:
    return api.vehicles_listing(_latest(spark, d, *_VL_COLS), route_type="bus", mode="reference", limit=None).select(*_VL_COLS)


@register("vehicles_bus_page", W("SELECT id, vehicle_id, route_id, line_id FROM vehicles_latest "
                                 "WHERE (route_id LIKE 'M%' AND length(route_id) > 1) "
                                 "OR (route_id LIKE 'B%' AND length(route_id) > 1) OR route_id LIKE 'Bx%' "
                                 "OR (route_id LIKE 'Q%' AND length(route_id) > 1)", "vehicles_latest"))
def vehicles_bus_page(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d, *_VL_COLS).filter(P.page_bus_filter("BUS")).select(*_VL_COLS)


@register("vehicles_express", W("SELECT id, vehicle_id, route_id, line_id FROM vehicles_latest WHERE route_id LIKE 'X%'",
                                "vehicles_latest"))
def vehicles_express(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d, *_VL_COLS).filter(P.page_bus_filter("EXPRESS")).select(*_VL_COLS)


@register("vehicles_simexpress", W("SELECT id, vehicle_id, route_id, line_id FROM vehicles_latest WHERE route_id LIKE 'SIM%'",
                                   "vehicles_latest"))
def vehicles_simexpress(spark: SparkSession, d: str) -> DataFrame:
    return _latest(spark, d, *_VL_COLS).filter(P.page_bus_filter("SIMEXPRESS")).select(*_VL_COLS)


# E2-E5 with the default limit: the first 100 by key


@register("vehicles_limited", W("SELECT id, vehicle_id FROM vehicles_latest ORDER BY id LIMIT 100", "vehicles_latest"))
def vehicles_limited(spark: SparkSession, d: str) -> DataFrame:
    return api.vehicles_listing(_latest(spark, d, "id")).select("id", "vehicle_id")


@register("alerts_limited", W("SELECT id, updated FROM alerts_latest ORDER BY id LIMIT 100", "alerts_latest"))
def alerts_limited(spark: SparkSession, d: str) -> DataFrame:
    return api.alerts_listing(_alerts_latest(spark, d, "updated", "severity_class")).select("id", "updated")


@register("outages_limited", W("SELECT outage_id, station FROM outages WHERE is_current ORDER BY outage_id LIMIT 100", "outages"))
def outages_limited(spark: SparkSession, d: str) -> DataFrame:
    return api.outages_listing(R.outages(spark, d)).select("outage_id", "station")


@register("equipment_limited", W("SELECT equipment_id, station FROM equipment ORDER BY equipment_id LIMIT 100", "equipment"))
def equipment_limited(spark: SparkSession, d: str) -> DataFrame:
    return api.equipment_listing(R.equipment(spark, d)).select("equipment_id", "station")


@register("vehicles_family", W(f"SELECT id, vehicle_id, route_id, line_id, {S.sql_route_family('route_id')} AS family "
                               f"FROM vehicles_latest WHERE {S.sql_route_family('route_id')} = 'IND'",
                               "vehicles_latest"))
def vehicles_family(spark: SparkSession, d: str) -> DataFrame:
    out = api.vehicles_listing(_latest(spark, d, *_VL_COLS), family="IND", limit=None)
    return out.select(*_VL_COLS, RD.route_family("route_id").alias("family"))


@register("vehicles_in_box", W(f"""
SELECT id, latitude, longitude FROM vehicles_latest
WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND latitude <> 0 AND longitude <> 0
  AND latitude BETWEEN {BOX[0]} AND {BOX[1]} AND longitude BETWEEN {BOX[2]} AND {BOX[3]}""", "vehicles_latest"))
def vehicles_in_box(spark: SparkSession, d: str) -> DataFrame:
    return api.vehicles_listing(_latest(spark, d, "id", "latitude", "longitude"), box=BOX, limit=None).select("id", "latitude", "longitude")


@register("alerts_by_route", W("SELECT id, routes_str FROM alerts_latest WHERE route_1 = 'A' OR route_2 = 'A'",
                               "alerts_latest"))
def alerts_by_route(spark: SparkSession, d: str) -> DataFrame:
    return api.alerts_listing(_alerts_latest(spark, d, "routes", "severity_class"), route_id="A", limit=None).select("id", _routes_str())


@register("alerts_severe", W(f"""
SELECT id, severity_class FROM (
  SELECT id, {S.sql_severity('severity', 'header', 'description')} AS severity_class FROM alerts_latest) t
WHERE upper(severity_class) = 'SEVERE'""", "alerts_latest"))
def alerts_severe(spark: SparkSession, d: str) -> DataFrame:
    return api.alerts_listing(_alerts_latest(spark, d, "severity_class"), severity="severe", limit=None).select("id", "severity_class")


@register("alerts_search", W("""
SELECT id, header FROM alerts_latest
WHERE contains(lower(header), 'delay') OR contains(lower(description), 'delay')""", "alerts_latest"))
def alerts_search(spark: SparkSession, d: str) -> DataFrame:
    return api.alerts_listing(_alerts_latest(spark, d, "header", "severity_class", "search_hit", search="Delay"),
                              search="Delay", limit=None).select("id", "header")


@register("outages_search", W("""
SELECT outage_id, station, borough, equipment_type FROM outages
WHERE is_current AND contains(lower(station), 'bolt') AND contains(lower(borough), 'brook')""", "outages"))
def outages_search(spark: SparkSession, d: str) -> DataFrame:
    out = api.outages_listing(R.outages(spark, d), station="Bolt", borough="BROOK", kind="current", limit=None)
    return out.select("outage_id", "station", "borough", "equipment_type")


@register("outages_search_regex", W("""
SELECT outage_id, station FROM outages
WHERE NOT is_current AND regexp_matches(station, '(?i)^(red|blue) ')""", "outages"))
def outages_search_regex(spark: SparkSession, d: str) -> DataFrame:
    out = api.outages_listing(R.outages(spark, d), station="^(red|blue) ", kind="upcoming", regex=True, limit=None)
    return out.select("outage_id", "station")


@register("equipment_ada", W("""
SELECT equipment_id, station, equipment_type, ada FROM equipment
WHERE ada AND contains(lower(equipment_type), 'elev')""", "equipment"))
def equipment_ada(spark: SparkSession, d: str) -> DataFrame:
    out = api.equipment_listing(R.equipment(spark, d), equipment_type="elev", ada=True, limit=None)
    return out.select("equipment_id", "station", "equipment_type", "ada")


@register("current_outages", W("SELECT outage_id, equipment_id, station FROM outages WHERE is_current", "outages"))
def current_outages(spark: SparkSession, d: str) -> DataFrame:
    return R.outages(spark, d).filter(P.is_current()).select("outage_id", "equipment_id", "station")


# ---------------------------------------------------------------------------
# aggregates
# ---------------------------------------------------------------------------

@register("vehicles_by_line", W("SELECT line_id, count(*) AS count FROM vehicles_latest GROUP BY line_id",
                                "vehicles_latest"))
def vehicles_by_line(spark: SparkSession, d: str) -> DataFrame:
    return A.count_by(_latest(spark, d, "line_id"), "line_id")


@register("vehicles_by_route", W("SELECT route_id, count(*) AS count FROM vehicles_latest GROUP BY route_id",
                                 "vehicles_latest"))
def vehicles_by_route(spark: SparkSession, d: str) -> DataFrame:
    return A.count_by(_latest(spark, d, "route_id"), "route_id")


@register("route_counts", W("SELECT line_id, route_id, count(*) AS count FROM vehicles_latest GROUP BY ALL",
                            "vehicles_latest"))
def route_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.count_by(_latest(spark, d, "line_id", "route_id"), "line_id", "route_id")


_ACTIVE_SQL = (f"(SELECT * FROM alerts_latest WHERE (\"start\" IS NULL OR \"start\" <= TIMESTAMP '{ALERTS_AS_OF}') "
               f"AND (\"end\" IS NULL OR \"end\" > TIMESTAMP '{ALERTS_AS_OF}'))")


@register("active_alerts", W(f"SELECT count(*) AS active_alerts FROM {_ACTIVE_SQL} a", "alerts_latest"))
def active_alerts(spark: SparkSession, d: str) -> DataFrame:
    return api.active_at(_alerts_latest(spark, d, "start", "end"), ALERTS_AS_OF).agg(F.count(F.lit(1)).alias("active_alerts"))


_STATUS_ROUTES = RD.SUBWAY_CODES + ["SIR"]


@register("system_status", W(f"""
, act AS (SELECT id, route_1, route_2,
                 {S.sql_severity('severity', 'header', 'description')} AS sev FROM {_ACTIVE_SQL} a),
x AS (SELECT id, route_1 AS route_id, sev FROM act UNION SELECT id, route_2 AS route_id, sev FROM act),
r AS (SELECT unnest([{S.in_list(_STATUS_ROUTES)}]) AS route_id),
c AS (SELECT r.route_id, count(x.id) AS alerts_count, count(x.id) FILTER (WHERE x.sev = 'SEVERE') AS severe_count
      FROM r LEFT JOIN x ON x.route_id = r.route_id GROUP BY r.route_id)
SELECT route_id, alerts_count, severe_count,
       CASE WHEN severe_count > 0 THEN 'delay' WHEN alerts_count > 0 THEN 'caution' ELSE 'good' END AS status,
       {S.sql_api_color('route_id')} AS color
FROM c""", "alerts_latest").replace("\n, act AS", ", act AS", 1))
def system_status(spark: SparkSession, d: str) -> DataFrame:
    act = api.active_at(_alerts_latest(spark, d, "start", "end", "routes", "severity_class"), ALERTS_AS_OF)
    return api.route_alert_status(spark, act, _STATUS_ROUTES)


@register("system_status_ref", W(f"""
, x AS (SELECT id, route_1 AS route_id, severity FROM alert_polls
        UNION ALL SELECT id, route_2, severity FROM alert_polls WHERE route_2 <> route_1),
r AS (SELECT unnest([{S.in_list(RD.REFERENCE_SUBWAY_LIST)}]) AS route_id),
c AS (SELECT r.route_id, count(x.id) AS alerts_count,
             count(x.id) FILTER (WHERE x.severity = 'severe') AS severe_count
      FROM r LEFT JOIN x ON x.route_id = r.route_id GROUP BY r.route_id)
SELECT route_id, alerts_count, severe_count,
       CASE WHEN severe_count > 0 THEN 'delay' WHEN alerts_count > 0 THEN 'caution' ELSE 'good' END AS status,
       {S.sql_api_color('route_id')} AS color
FROM c""", "alert_polls").replace("\n, x AS", ", x AS", 1))
def system_status_ref(spark: SparkSession, d: str) -> DataFrame:
    """E6 as the API computes it: every stored alert document (both polls), its 22-code
    route list, and the exact 'severe' comparison (so 'delay' never shows)."""
    polls = R.alert_polls(spark, d).select("id", "severity", "routes")
    return api.route_alert_status(spark, polls, mode="reference")


@register("route_stats_hourly", W("""
SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour AS window_end,
       line_id, route_id, count(*) AS count
FROM vehicles GROUP BY ALL""", "vehicles"))
def route_stats_hourly(spark: SparkSession, d: str) -> DataFrame:
    return api.hourly_route_stats(R.vehicles(spark, d))


@register("route_stats_24h", W(f"""
SELECT * FROM (
  SELECT time_bucket(INTERVAL 1 hour, ts) AS window_start, time_bucket(INTERVAL 1 hour, ts) + INTERVAL 1 hour AS window_end,
         line_id, route_id, count(*) AS count
  FROM vehicles GROUP BY ALL) s
WHERE window_start >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 24 hour
ORDER BY window_start DESC, line_id, route_id LIMIT 100""", "vehicles"))
def route_stats_24h(spark: SparkSession, d: str) -> DataFrame:
    return api.route_stats_report(R.vehicles(spark, d), EVENTS_AS_OF)


@register("distinct_stations", W("SELECT DISTINCT station FROM outages WHERE is_current", "outages"))
def distinct_stations(spark: SparkSession, d: str) -> DataFrame:
    return R.outages(spark, d).filter(P.is_current()).select("station").distinct().orderBy("station")


@register("vehicle_bounds", W("""
SELECT min(latitude) AS min_lat, max(latitude) AS max_lat, min(longitude) AS min_lon, max(longitude) AS max_lon
FROM vehicles_latest WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND latitude <> 0 AND longitude <> 0""",
                              "vehicles_latest"))
def vehicle_bounds(spark: SparkSession, d: str) -> DataFrame:
    return A.bounds(_latest(spark, d, "latitude", "longitude").filter(P.usable_position()))


_AVAIL_SQL = """
SELECT count(*) AS total_equipment,
       count(*) FILTER (WHERE equipment_id IN (SELECT equipment_id FROM outages WHERE is_current)) AS out_of_service,
       round((count(*) - count(*) FILTER (WHERE equipment_id IN (SELECT equipment_id FROM outages WHERE is_current)))
             * 100.0 / count(*), 2) AS in_service_percentage
FROM equipment"""


@register("equipment_availability", W(f"""
SELECT total_equipment, out_of_service, CAST(in_service_percentage AS DOUBLE) AS in_service_percentage
FROM ({_AVAIL_SQL}) t""", "equipment", "outages"))
def equipment_availability(spark: SparkSession, d: str) -> DataFrame:
    return api.equipment_availability(R.equipment(spark, d), R.outages(spark, d))


@register("summary_stats", W(f"""
, vl AS (SELECT line_id, count(*) AS n FROM vehicles_latest GROUP BY ALL),
vr AS (SELECT route_id, count(*) AS n FROM vehicles_latest GROUP BY ALL),
av AS (SELECT total_equipment, CAST(in_service_percentage AS DOUBLE) AS in_service_percentage FROM ({_AVAIL_SQL}) t)
SELECT (SELECT count(*) FROM vehicles_latest) AS total_vehicles,
       (SELECT count(DISTINCT vehicle_id) FROM vehicles_latest) AS active_vehicles,
       (SELECT count(DISTINCT line_id) FROM vehicles_latest) AS active_lines,
       (SELECT string_agg(line_id || ':' || CAST(n AS VARCHAR), ',' ORDER BY line_id || ':' || CAST(n AS VARCHAR)) FROM vl) AS vehicles_by_line,
       (SELECT string_agg(route_id || ':' || CAST(n AS VARCHAR), ',' ORDER BY route_id || ':' || CAST(n AS VARCHAR)) FROM vr) AS vehicles_by_route,
       (SELECT count(*) FILTER (WHERE is_current) FROM outages) AS current_elevator_outages,
       (SELECT count(*) FILTER (WHERE NOT is_current) FROM outages) AS upcoming_elevator_outages,
       (SELECT count(*) FROM {_ACTIVE_SQL} a) AS active_alerts,
       (SELECT total_equipment FROM av) AS total_equipment,
       (SELECT in_service_percentage FROM av) AS in_service_percentage""",
                             "vehicles_latest", "alerts_latest", "equipment", "outages").replace("\n, vl AS", ", vl AS", 1))
def summary_stats(spark: SparkSession, d: str) -> DataFrame:
    act = api.active_at(_alerts_latest(spark, d, "start", "end"), ALERTS_AS_OF)
    return api.summary(_latest(spark, d, "line_id", "route_id"), R.outages(spark, d), act, R.equipment(spark, d))


@register("feed_health", W(f"""
, comp AS (
  SELECT 'vehicles_tracking' AS component, count(*) AS n_rows, max(ts) AS last_processed_at,
         (epoch_us(TIMESTAMP '{HEALTH_VEHICLES_AS_OF}') - epoch_us(max(ts))) // 1000000 AS age_seconds,
         {api.HEALTH_LIMITS['vehicles_tracking']} AS lim FROM vehicles
  UNION ALL
  SELECT 'service_alerts', count(*), max(updated),
         (epoch_us(TIMESTAMP '{ALERTS_AS_OF}') - epoch_us(max(updated))) // 1000000, {api.HEALTH_LIMITS['service_alerts']}
  FROM alert_polls
  UNION ALL
  SELECT 'elevator_monitoring', count(*), max(outage_start),
         (epoch_us(TIMESTAMP '{HEALTH_OUTAGES_AS_OF}') - epoch_us(max(outage_start))) // 1000000, {api.HEALTH_LIMITS['elevator_monitoring']}
  FROM outages),
rows AS (SELECT component, n_rows, last_processed_at, age_seconds,
                CASE WHEN n_rows = 0 THEN 'DOWN' WHEN age_seconds <= lim THEN 'OPERATIONAL' ELSE 'DEGRADED' END AS status
         FROM comp)
SELECT * FROM rows
UNION ALL
SELECT 'overall', sum(n_rows)::BIGINT, max(last_processed_at), max(age_seconds),
       CASE WHEN bool_and(status = 'OPERATIONAL') THEN 'OPERATIONAL' ELSE 'DEGRADED' END FROM rows""",
                           "vehicles", "alert_polls", "outages").replace("\n, comp AS", ", comp AS", 1))
def feed_health(spark: SparkSession, d: str) -> DataFrame:
    out = R.outages(spark, d)
    return api.feed_health([
        api.component_health("vehicles_tracking", R.vehicles(spark, d), "ts", HEALTH_VEHICLES_AS_OF,
                             api.HEALTH_LIMITS["vehicles_tracking"]),
        api.component_health("service_alerts", R.alert_polls(spark, d), "updated", ALERTS_AS_OF,
                             api.HEALTH_LIMITS["service_alerts"]),
        api.component_health("elevator_monitoring", out, "outage_start", HEALTH_OUTAGES_AS_OF,
                             api.HEALTH_LIMITS["elevator_monitoring"]),
    ])


# ---------------------------------------------------------------------------
# boards
# ---------------------------------------------------------------------------

_CHART_LABEL = ("CASE WHEN route_id IS NULL OR route_id = '' OR route_id = 'Unknown' THEN "
                "CASE WHEN line_id IS NOT NULL AND line_id <> '' AND line_id <> 'Unknown' THEN line_id || ' Line' "
                "ELSE 'Non-revenue' END WHEN route_id = 'SIR' THEN 'Staten Island Railway' "
                "WHEN route_id LIKE 'SIM%' THEN 'SIM ' || substr(route_id, 4) ELSE route_id END")


@register("top_routes", W(f"""
SELECT route_id, line_id, count, label, {S.sql_ui_color('label', 'chart')} AS color FROM (
  SELECT route_id, line_id, count, {_CHART_LABEL} AS label FROM (
    SELECT route_id, line_id, count(*) AS count FROM vehicles_latest GROUP BY ALL
    ORDER BY count DESC, route_id, line_id LIMIT 10) t) u""", "vehicles_latest"))
def top_routes(spark: SparkSession, d: str) -> DataFrame:
    return api.top_routes_chart(_latest(spark, d, "route_id", "line_id"))


@register("recent_alerts", W("""
SELECT id, updated,
       CASE WHEN header IS NULL OR header = '' THEN 'Service Alert' ELSE header END AS title,
       CASE WHEN severity IS NULL OR severity = '' THEN 'Medium' ELSE severity END AS chip,
       CASE WHEN length(description) > 120 THEN substr(description, 1, 120) || '...'
            WHEN description IS NULL OR description = '' THEN 'No description available.'
            ELSE description END AS text
FROM alerts_latest ORDER BY updated DESC, id LIMIT 5""", "alerts_latest"))
def recent_alerts(spark: SparkSession, d: str) -> DataFrame:
    return api.recent_alerts_card(_alerts_latest(spark, d, "header", "severity", "card_text"))


_BOARD_SQL = """
SELECT outage_id, station AS station_name, equipment_id, equipment_type, serving, reason, outage_start, outage_end,
       latest_status AS status,
       coalesce(strftime(outage_start, '%b %d, %Y %-I:%M %p'), 'N/A') AS start_text,
       coalesce(strftime(outage_end, '%b %d, %Y %-I:%M %p'), 'Indefinite') AS end_text
FROM outages
WHERE is_current AND equipment_type = 'ELEVATOR'
  AND (contains(lower(station), 'rep') OR contains(lower(serving), 'rep') OR contains(lower(reason), 'rep'))"""


def _board(spark, d):
    return api.outages_board(R.outages(spark, d), kind="current", equipment_type="ELEVATOR", search="rep")


@register("outages_board", W(_BOARD_SQL, "outages"))
def outages_board(spark: SparkSession, d: str) -> DataFrame:
    return _board(spark, d)


@register("outages_board_count", W(f"SELECT least(10, count(*)) AS n_shown, count(*) AS n_matches FROM ({_BOARD_SQL}) b",
                                   "outages"))
def outages_board_count(spark: SparkSession, d: str) -> DataFrame:
    return api.board_count(_board(spark, d))


@register("outages_page", W(f"""
SELECT * FROM ({_BOARD_SQL}) b ORDER BY outage_start DESC NULLS LAST, outage_id LIMIT 10 OFFSET 20""", "outages"))
def outages_page(spark: SparkSession, d: str) -> DataFrame:
    return api.board_page(_board(spark, d), page_no=2, order_by="outage_start", ascending=False)


# ---------------------------------------------------------------------------
# parse: records -> JSON envelopes -> parser -> records (the oracle reads the records)
# ---------------------------------------------------------------------------

from metroflow.functions.time import epoch_seconds, normalize_time  # noqa: E402
from metroflow.operators import parse as PA  # noqa: E402
from metroflow.sources import feeds as FD  # noqa: E402

_VEH_OUT = ["id", "line_id", "trip_id", "route_id", "start_time", "start_date", "vehicle_id", "current_status",
            "current_stop_sequence", "stop_id", "latitude", "longitude", "bearing", "timestamp"]
_VEH_OUT_SQL = ", ".join(f'"{c}"' if c == "timestamp" else c for c in _VEH_OUT)


@register("feed_roundtrip", W(f"SELECT {_VEH_OUT_SQL}, date_trunc('second', ts) AS event_time FROM vehicles",
                              "vehicles"))
def feed_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    msgs = FD.vehicle_messages(R.vehicles(spark, d))
    return PA.vehicles(msgs).select(*_VEH_OUT, "event_time")


def _broken_messages(v: DataFrame) -> DataFrame:
    """One message per report; those of every 97th are cut off."""
    elem = F.struct(*[F.col(c) for c in FD._VEHICLE_FIELDS])
    env = F.to_json(F.struct(F.col("line_id"), F.col("timestamp"), F.array(elem).alias("data")))
    value = F.when(F.col("event_id") % 97 == 0, F.substring(env, 1, 20)).otherwise(env)
    return v.select(F.lit("vehicles").alias("feed"), F.col("line_id").alias("key"), value.alias("value"))


@register("vehicles_clean", W(f"SELECT {_VEH_OUT_SQL} FROM vehicles WHERE event_id % 97 <> 0", "vehicles"))
def vehicles_clean(spark: SparkSession, d: str) -> DataFrame:
    return PA.vehicles(_broken_messages(R.vehicles(spark, d))).select(*_VEH_OUT)


@register("feed_rejects", W("SELECT 'vehicles' AS feed, 'malformed' AS reason, count(*) AS n_rejected "
                            "FROM vehicles WHERE event_id % 97 = 0", "vehicles"))
def feed_rejects(spark: SparkSession, d: str) -> DataFrame:
    rej = PA.rejected(PA.decode(_broken_messages(R.vehicles(spark, d)), FD.SC.VEHICLE_ENVELOPE))
    return rej.groupBy("feed", "reason").agg(F.count(F.lit(1)).alias("n_rejected"))


@register("trip_stop_times", W("""
, k AS (SELECT unnest([0, 1, 2]) AS k)
SELECT v.id, v.trip_id, CAST(k.k AS INT) AS stop_index, 'R' || CAST((v.event_id + k.k) % 60 AS VARCHAR) AS stop_id,
       CASE WHEN k.k = 0 THEN NULL ELSE v."timestamp" + 120 * k.k END AS arrival,
       CASE WHEN k.k = 2 THEN NULL ELSE v."timestamp" + 120 * k.k + 30 END AS departure,
       CASE WHEN k.k = 0 THEN NULL ELSE date_trunc('second', v.ts) + to_seconds(120 * k.k) END AS arrival_time
FROM vehicles v, k WHERE v.event_id % 20 <> 0
UNION ALL
SELECT id, trip_id, NULL, NULL, NULL, NULL, NULL FROM vehicles WHERE event_id % 20 = 0""",
                               "vehicles").replace("\n, k AS", ", k AS", 1))
def trip_stop_times(spark: SparkSession, d: str) -> DataFrame:
    trips = PA.trip_updates(FD.trip_update_messages(R.vehicles(spark, d)))
    return PA.stop_times(trips).select("id", "trip_id", "stop_index", "stop_id", "arrival", "departure",
                                       "arrival_time")


@register("alerts_flatten", W("""
SELECT id, coalesce(alert_type, '') AS alert_type, effect, header, description, "start", "end", updated, severity,
       routes_str
FROM alerts""", "alerts"))
def alerts_flatten(spark: SparkSession, d: str) -> DataFrame:
    parsed = PA.alerts(FD.alert_messages(R.alerts(spark, d)))
    return parsed.select("id", "alert_type", "effect", "header", "description", "start", "end", "updated",
                         "severity", _routes_str())


_OUT_COLS = ["outage_id", "equipment_id", "station", "borough", "equipment_type", "serving", "outage_start",
             "outage_end", "reason", "latest_status", "is_current"]


@register("outages_flatten", W(f"SELECT {', '.join(_OUT_COLS)} FROM outages", "outages"))
def outages_flatten(spark: SparkSession, d: str) -> DataFrame:
    msgs = FD.outage_messages(R.outages(spark, d))
    return PA.outages(msgs, kind=F.col("feed")).select(*_OUT_COLS)


_EQ_COLS = ["equipment_id", "station", "borough", "equipment_type", "serving", "ada"]


@register("equipment_flatten", W(f"SELECT {', '.join(_EQ_COLS)} FROM equipment", "equipment"))
def equipment_flatten(spark: SparkSession, d: str) -> DataFrame:
    return PA.equipment(FD.equipment_messages(R.equipment(spark, d))).select(*_EQ_COLS)


@register("normalize_time", W("""
SELECT event_id,
       CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('millisecond', ts)
                         WHEN 2 THEN ts ELSE NULL END AS event_time
FROM vehicles""", "vehicles"))
def normalize_time_q(spark: SparkSession, d: str) -> DataFrame:
    v = R.vehicles(spark, d)
    eid = F.col("event_id")
    raw = (F.when(eid % 4 == 0, epoch_seconds("ts").cast("string"))
           .when(eid % 4 == 1, F.timestamp_diff("MILLISECOND", F.lit("1970-01-01").cast("timestamp_ntz"),
                                                F.col("ts")).cast("string"))
           .when(eid % 4 == 2, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
           .when(eid % 8 == 3, F.lit("not a time")))
    return v.select("event_id", normalize_time(raw).alias("event_time"))


@register("feed_union", W("SELECT id, line_id AS source, vehicle_id, route_id, line_id FROM vehicles", "vehicles"))
def feed_union(spark: SparkSession, d: str) -> DataFrame:
    """The positions of all line feeds as one feed, each with the line it came from."""
    return _line_positions(FD.vehicle_messages(R.vehicles(spark, d)))


def _line_positions(feeds: DataFrame) -> DataFrame:
    return PA.vehicles(feeds).select("id", F.col("line_id").alias("source"), "vehicle_id", "route_id", "line_id")


@register("feed_union_kinds", W("""
SELECT id, 'vehicles' AS source, vehicle_id, route_id, line_id FROM vehicles
UNION ALL
SELECT id, 'trip_updates', vehicle_id, route_id, line_id FROM vehicles""", "vehicles"))
def feed_union_kinds(spark: SparkSession, d: str) -> DataFrame:
    v = R.vehicles(spark, d)
    pos = PA.vehicles(FD.vehicle_messages(v)).select("id", F.lit("vehicles").alias("source"), "vehicle_id",
                                                     "route_id", "line_id")
    trips = PA.trip_updates(FD.trip_update_messages(v)).select("id", F.lit("trip_updates").alias("source"),
                                                               "vehicle_id", "route_id", "line_id")
    return pos.unionByName(trips)


# ---------------------------------------------------------------------------
# streams: the vehicle feed lands as files, a stream drains it with availableNow
# ---------------------------------------------------------------------------

from metroflow.session import fresh_dir  # noqa: E402
from metroflow.streaming import jobs as J  # noqa: E402
from metroflow.streaming import sinks as K  # noqa: E402

STREAM_WATERMARK = "400 days"  # longer than the disorder of the landed files, so no row is late


def land_vehicle_feed(spark: SparkSession, d: str, files: int | None = None, messages=FD.vehicle_messages) -> tuple[str, int]:
    """Write the vehicle feed as JSON-lines files, hash-split by report id (event time jumps between files); (folder, number of files)."""
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    path = fresh_dir(spark, "landing-vehicles")
    FD.publish(messages(R.vehicles(spark, d).repartition(n, "id")), path=path)
    return path, max(n, len(K.list_names(spark, path)))


def drain_vehicle_feed(spark: SparkSession, d: str, job, messages=FD.vehicle_messages) -> str:
    """Land the feed, drain it in several micro-batches with ``job(messages, out, checkpoint)``."""
    path, n = land_vehicle_feed(spark, d, messages=messages)
    out, ck = fresh_dir(spark, "tables"), fresh_dir(spark, "checkpoints")
    msgs = FD.landing_stream(spark, path, "vehicles", max_files=max(1, n // 4))
    q = job(msgs, out, ck)
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
    return out


_SVL_COLS = ["id", "vehicle_id", "route_id", "line_id", "latitude", "longitude", "event_time"]


@register("stream_vehicles_latest", W("""
SELECT id, vehicle_id, route_id, line_id, latitude, longitude, date_trunc('second', ts) AS event_time FROM (
  SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY date_trunc('second', ts) DESC, id DESC) AS rn
  FROM vehicles WHERE vehicle_id IS NOT NULL) t WHERE rn = 1
UNION ALL
SELECT id, vehicle_id, route_id, line_id, latitude, longitude, date_trunc('second', ts) FROM vehicles
WHERE vehicle_id IS NULL""", "vehicles"))
def stream_vehicles_latest(spark: SparkSession, d: str) -> DataFrame:
    out = drain_vehicle_feed(spark, d, lambda m, o, c: J.vehicle_job(m, o, c, available_now=True))
    return J.read_latest(spark, out, "vehicles").select(*_SVL_COLS)


@register("stream_route_stats", W("""
SELECT time_bucket(INTERVAL 1 hour, date_trunc('second', ts)) AS window_start,
       time_bucket(INTERVAL 1 hour, date_trunc('second', ts)) + INTERVAL 1 hour AS window_end,
       line_id, route_id, count(*) AS count
FROM vehicles GROUP BY ALL""", "vehicles"))
def stream_route_stats(spark: SparkSession, d: str) -> DataFrame:
    out = drain_vehicle_feed(spark, d, lambda m, o, c: J.route_stats_job(m, o, c, STREAM_WATERMARK,
                                                                         available_now=True))
    return J.read_route_stats(spark, out)


@register("stream_rejects", W("SELECT 'vehicles' AS feed, 'malformed' AS reason, count(*) AS n_rejected, "
                              "(SELECT count(*) FROM vehicles WHERE event_id % 97 <> 0) AS n_stored "
                              "FROM vehicles WHERE event_id % 97 = 0", "vehicles"))
def stream_rejects(spark: SparkSession, d: str) -> DataFrame:
    """P4 in the stream: cut-off messages are kept as rejects, the others reach the history."""
    out = drain_vehicle_feed(spark, d, lambda m, o, c: J.vehicle_job(m, o, c, available_now=True), _broken_messages)
    stored = J.read_history(spark, out).select(F.count(F.lit(1))).scalar()
    return J.read_rejects(spark, out, "vehicles").groupBy("feed", "reason").agg(F.count(F.lit(1)).alias("n_rejected")) \
        .withColumn("n_stored", stored)


@register("stream_outages_current", W("""
SELECT count(*) AS total_equipment, count(*) FILTER (WHERE out_now) AS out_of_service,
       CAST(round((count(*) - count(*) FILTER (WHERE out_now)) * 100.0 / count(*), 2) AS DOUBLE) AS in_service_percentage
FROM (SELECT equipment_id IN (SELECT equipment_id FROM outages WHERE is_current AND equipment_type = 'ELEVATOR') AS out_now
      FROM equipment) t""", "equipment", "outages"))
def stream_outages_current(spark: SparkSession, d: str) -> DataFrame:
    """A4/J4 on stored tables: the first poll sends every current outage, the second those of
    elevators only; what left the feed is not current any more."""
    from metroflow.plans import serving

    path, out, ck = (fresh_dir(spark, n) for n in ("landing-outages", "tables", "checkpoints"))
    now = R.outages(spark, d).filter(P.is_current())
    polls = [(now, R.ALERT_POLL_1), (now.filter(P.is_value("ELEVATOR", "equipment_type")), R.ALERT_POLL_1 + 120)]
    for rows, at in polls:
        FD.publish(FD.outage_messages(rows, poll=F.lit(at).cast("bigint")), path=path, per_file=FD.ENVELOPES_PER_FILE)
    q = J.feed_job(FD.landing_stream(spark, path, "outages_current"), "outages_current", out, ck, available_now=True)
    J.await_all(spark, [q])
    return api.equipment_availability(R.equipment(spark, d), serving.outages_latest(spark, out))


@register("stream_feed_union", W(f"SELECT id, line_id AS source, vehicle_id, route_id, line_id FROM vehicles "
                                 f"WHERE line_id IN ({S.in_list(FD.SC.LINE_FEEDS)})", "vehicles"))
def stream_feed_union(spark: SparkSession, d: str) -> DataFrame:
    """Feeds landed in a folder per line; the registered line feeds are read by one scan."""
    path = fresh_dir(spark, "landing-lines")
    FD.publish(FD.vehicle_messages(R.vehicles(spark, d)), path=path, by_key=True)
    return _line_positions(FD.landing_lines(spark, path))


LATE_BY = "2 days"
_LATE_SQL = "(event_id % 20 = 7 AND ts < (SELECT max(ts) FROM vehicles) - INTERVAL 1 day)"


def _late(v: DataFrame):
    """Reports that arrive after all others: every 20th one but those of the last day."""
    newest = v.agg(F.max("ts")).scalar()
    return (F.col("event_id") % 20 == 7) & (F.col("ts") < newest - F.expr("INTERVAL 1 DAY"))


@register("stream_route_windows", W(f"""
, w AS (SELECT time_bucket(INTERVAL 1 hour, date_trunc('second', ts)) AS window_start, line_id, route_id, {_LATE_SQL} AS late,
               date_trunc('second', ts) AS ts FROM vehicles),
mark AS (SELECT max(ts) - INTERVAL {LATE_BY} AS t FROM w WHERE NOT late)
SELECT window_start, window_start + INTERVAL 1 hour AS window_end, line_id, route_id, count(*) AS count,
       window_start + INTERVAL 1 hour <= t AS closed
FROM w, mark WHERE NOT late OR window_start + INTERVAL 1 hour > t GROUP BY ALL""", "vehicles").replace("\n, w AS", ", w AS", 1))
def stream_route_windows(spark: SparkSession, d: str) -> DataFrame:
    """Closed windows are stored once and leave late reports out, open ones are running counts that take them in."""
    path, out, ck = (fresh_dir(spark, n) for n in ("landing-late", "tables", "checkpoints"))
    v = R.vehicles(spark, d)
    for rows in (v.filter(~_late(v)), v.filter(_late(v))):
        FD.publish(FD.vehicle_messages(rows), path=path)
        msgs = FD.landing_stream(spark, path, "vehicles")
        J.await_all(spark, [job(msgs, out, ck, LATE_BY, available_now=True) for job in (J.route_stats_job, J.route_windows_job)])
    J.fold_route_stats(spark, out)
    return J.read_route_counts(spark, out)


@register("stream_replay", W("SELECT id, vehicle_id, route_id, date_trunc('second', ts) AS event_time FROM vehicles", "vehicles"))
def stream_replay(spark: SparkSession, d: str) -> DataFrame:
    """T7 beyond the watermark: the whole feed is read again under a new checkpoint; the history holds each report once."""
    path, n = land_vehicle_feed(spark, d)
    out = fresh_dir(spark, "tables")
    for k in range(2):
        msgs = FD.landing_stream(spark, path, "vehicles", max_files=max(1, n // (2 + k)))
        J.await_all(spark, [J.vehicle_job(msgs, out, fresh_dir(spark, "checkpoints"), available_now=True, unseen_key="id")])
    return J.read_history(spark, out).select("id", "vehicle_id", "route_id", "event_time")


@register("stream_history_24h", W(f"""
SELECT * FROM (
  SELECT time_bucket(INTERVAL 1 hour, date_trunc('second', ts)) AS window_start, time_bucket(INTERVAL 1 hour, date_trunc('second', ts)) + INTERVAL 1 hour AS window_end,
         line_id, route_id, count(*) AS count
  FROM vehicles GROUP BY ALL) s
WHERE window_start >= TIMESTAMP '{EVENTS_AS_OF}' - INTERVAL 24 hour
ORDER BY window_start DESC, line_id, route_id LIMIT 100""", "vehicles"))
def stream_history_24h(spark: SparkSession, d: str) -> DataFrame:
    """E7 on the stored history, closed days packed: only the trailing days are listed and read."""
    from metroflow.plans import serving

    out = drain_vehicle_feed(spark, d, lambda m, o, c: J.vehicle_job(m, o, c, available_now=True))
    J.pack_history(spark, out, EVENTS_AS_OF)
    return serving.route_stats_report(spark, out, EVENTS_AS_OF)


@register("stream_history_in_box", W(f"""
SELECT id, latitude, longitude FROM vehicles
WHERE latitude <> 0 AND longitude <> 0
  AND latitude BETWEEN {BOX[0]} AND {BOX[1]} AND longitude BETWEEN {BOX[2]} AND {BOX[3]}""", "vehicles"))
def stream_history_in_box(spark: SparkSession, d: str) -> DataFrame:
    """F17 on the stored history: days packed in Z-order, the box as ranges of cells."""
    from metroflow.plans import serving

    out = drain_vehicle_feed(spark, d, lambda m, o, c: J.vehicle_job(m, o, c, available_now=True))
    J.pack_history(spark, out, "9999-01-01")
    return serving.vehicles_in_box(spark, out, BOX).select("id", "latitude", "longitude")


@register("stream_active_vehicles", W("""
SELECT line_id, count(DISTINCT vehicle_id) AS exact, TRUE AS within_bounds FROM vehicles GROUP BY line_id
UNION ALL SELECT 'all', count(DISTINCT vehicle_id), TRUE FROM vehicles""", "vehicles"))
def stream_active_vehicles(spark: SparkSession, d: str) -> DataFrame:
    """Distinct vehicles per line and over all, merged from the hourly sketches that the batches
    stored, with their bounds checked against exact counts."""
    out = drain_vehicle_feed(spark, d, lambda m, o, c: J.vehicle_job(m, o, c, available_now=True, writers=(J.sketch_writer(o),)))
    got = J.active_vehicles(spark, out, "line_id").unionByName(J.active_vehicles(spark, out).withColumn("line_id", F.lit("all")))
    v = R.vehicles(spark, d).select("line_id", "vehicle_id")
    exact = v.groupBy("line_id").agg(F.count_distinct("vehicle_id").alias("exact")) \
        .unionByName(v.agg(F.count_distinct("vehicle_id").alias("exact")).withColumn("line_id", F.lit("all")))
    return exact.join(got, "line_id").select("line_id", "exact", F.col("exact").between(F.col("low"), F.col("high")).alias("within_bounds"))


def _land(spark: SparkSession, messages: DataFrame, kind: str, out: str) -> None:
    path = fresh_dir(spark, f"landing-{kind}")
    FD.publish(messages, path=path, per_file=FD.ENVELOPES_PER_FILE)
    J.await_all(spark, [J.feed_job(FD.landing_stream(spark, path, kind), kind, out, fresh_dir(spark, "checkpoints"), available_now=True)])


@register("stream_feed_health", W(f"""
, comp AS (
  SELECT 'vehicles_tracking' AS component, count(*) AS n_rows, date_trunc('second', max(ts)) AS last_processed_at,
         TIMESTAMP '{HEALTH_VEHICLES_AS_OF}' AS as_of, {api.HEALTH_LIMITS['vehicles_tracking']} AS lim FROM vehicles
  UNION ALL
  SELECT 'service_alerts', count(*), max(updated), TIMESTAMP '{ALERTS_AS_OF}', {api.HEALTH_LIMITS['service_alerts']} FROM alert_polls
  UNION ALL
  SELECT 'elevator_monitoring', (SELECT count(*) FROM outages) + (SELECT count(*) FROM equipment), make_timestamp({R.ALERT_POLL_1}::BIGINT * 1000000),
         TIMESTAMP '{ALERTS_AS_OF}', {api.HEALTH_LIMITS['elevator_monitoring']}),
aged AS (SELECT *, (epoch_us(as_of) - epoch_us(last_processed_at)) // 1000000 AS age_seconds FROM comp),
judged AS (SELECT component, n_rows, last_processed_at, age_seconds,
                CASE WHEN n_rows = 0 THEN 'DOWN' WHEN age_seconds <= lim THEN 'OPERATIONAL' ELSE 'DEGRADED' END AS status FROM aged)
SELECT * FROM judged
UNION ALL
SELECT 'overall', sum(n_rows)::BIGINT, max(last_processed_at), max(age_seconds),
       CASE WHEN bool_and(status = 'OPERATIONAL') THEN 'OPERATIONAL' ELSE 'DEGRADED' END FROM judged""",
                                  "vehicles", "alert_polls", "outages", "equipment").replace("\n, comp AS", ", comp AS", 1))
def stream_feed_health(spark: SparkSession, d: str) -> DataFrame:
    """A15/E11 from the figures that the batches took; the vehicles are too old by then, the other feeds are not."""
    from metroflow.plans import serving

    out = drain_vehicle_feed(spark, d, lambda m, o, c: J.vehicle_job(m, o, c, available_now=True))
    _land(spark, FD.alert_messages(R.alert_polls(spark, d)), "alerts", out)
    outages = FD.outage_messages(R.outages(spark, d))
    for kind in ("outages_current", "outages_upcoming"):
        _land(spark, outages.filter(F.col("feed") == kind), kind, out)
    _land(spark, FD.equipment_messages(R.equipment(spark, d)), "equipment", out)
    return serving.feed_health(spark, out, {"vehicles_tracking": HEALTH_VEHICLES_AS_OF, "service_alerts": ALERTS_AS_OF, "elevator_monitoring": ALERTS_AS_OF})


@register("stream_summary_days", W("""
, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY vehicle_id ORDER BY date_trunc('second', ts) DESC, id DESC) AS rn
                       FROM vehicles WHERE vehicle_id IS NOT NULL) WHERE rn = 1
        UNION ALL SELECT *, 1 FROM vehicles WHERE vehicle_id IS NULL),
vl AS (SELECT line_id, count(*) AS n FROM l GROUP BY ALL),
vr AS (SELECT route_id, count(*) AS n FROM l GROUP BY ALL)
SELECT (SELECT count(*) FROM l) AS total_vehicles, (SELECT count(vehicle_id) FROM l) AS active_vehicles,
       (SELECT count(DISTINCT line_id) FROM l) AS active_lines,
       (SELECT string_agg(line_id || ':' || CAST(n AS VARCHAR), ',' ORDER BY line_id || ':' || CAST(n AS VARCHAR)) FROM vl) AS vehicles_by_line,
       (SELECT string_agg(route_id || ':' || CAST(n AS VARCHAR), ',' ORDER BY route_id || ':' || CAST(n AS VARCHAR)) FROM vr) AS vehicles_by_route""",
                                   "vehicles").replace("\n, l AS", ", l AS", 1))
def stream_summary_days(spark: SparkSession, d: str) -> DataFrame:
    """E1/A1-A3/A9 from one row per vehicle of each closed day, and the history of the open ones."""
    out = drain_vehicle_feed(spark, d, lambda m, o, c: J.vehicle_job(m, o, c, available_now=True))
    J.summarize_days(spark, out, EVENTS_AS_OF)
    return api.vehicle_figures(J.latest_from_days(spark, out))


SEARCH_TERMS = ["rep", "Copper ", "bo", "e", "no such text"]


@register("stored_outages_search", W(" UNION ALL ".join(
    f"SELECT '{t}' AS term, outage_id, equipment_id FROM outages WHERE contains(lower(station), '{t.lower()}') "
    f"OR contains(lower(serving), '{t.lower()}') OR contains(lower(reason), '{t.lower()}')" for t in SEARCH_TERMS), "outages"))
def stored_outages_search(spark: SparkSession, d: str) -> DataFrame:
    """F7/F12 by trigram postings of the distinct texts, short terms included."""
    columns, path = ["station", "serving", "reason"], fresh_dir(spark, "text-index")
    rows = R.outages(spark, d)
    TI.build(rows, columns, path)
    hits = [TI.search(spark, path, t).select(F.lit(t).alias("term"), "text") for t in SEARCH_TERMS]
    found = functools.reduce(DataFrame.unionByName, hits)
    return TI.terms_of(rows.select("outage_id", "equipment_id", *columns), columns, found).select("term", "outage_id", "equipment_id")


@register("stored_alerts_search", W("SELECT id, header FROM alerts WHERE contains(lower(header), 'suspended') "
                                    "OR contains(lower(description), 'suspended')", "alerts"))
def stored_alerts_search(spark: SparkSession, d: str) -> DataFrame:
    """F11 by trigram postings of headers and whole descriptions."""
    path, rows = fresh_dir(spark, "text-index"), R.alerts(spark, d).select("id", "header", "description")
    TI.build(rows, ["header", "description"], path)
    return TI.rows_with(rows, ["id"], ["header", "description"], TI.search(spark, path, "Suspended")).select("id", "header")


_RENAMED = ["equipment_id", "station", "borough", "equipment_type", "serving", "outage_start", "outage_end", "reason", "latest_status", "is_current"]


@register("outages_renamed", W(f"SELECT {', '.join(_RENAMED)}, 0 AS n_routes FROM outages", "outages"))
def outages_renamed(spark: SparkSession, d: str) -> DataFrame:
    """Outages under three spellings (feed, API, dashboard), decoded as VARIANT and listed by E4."""
    o = R.outages(spark, d)
    start, end = FD._iso(F.col("outage_start")), FD._iso(F.col("outage_end"))
    kind = F.when(F.col("is_current"), F.lit("current")).otherwise(F.lit("upcoming"))
    same = ["equipment_id", "equipment_type", "serving"]
    feed = F.struct(*same, F.struct(F.col("station").alias("name"), "borough").alias("station"), start.alias("outage_start_date_time"),
                    end.alias("estimated_return_date_time"), F.struct(F.col("reason").alias("reason_name")).alias("reason"),
                    F.struct(F.col("latest_status").alias("status_name")).alias("latest_status"), kind.alias("type"))
    page = F.struct(*same, F.col("station").alias("station_name"), "borough", start.alias("outage_start"), end.alias("outage_end"), "reason",
                    F.col("latest_status").alias("status"), kind.alias("type"), F.array().cast("array<string>").alias("trains"))
    own = F.struct(*same, "station", "borough", start.alias("outage_start"), end.alias("outage_end"), "reason", "latest_status", "is_current")
    spelt = F.pmod(F.xxhash64("outage_id"), F.lit(3))
    value = F.when(spelt == 0, F.to_json(F.struct(F.array(feed).alias("data")))).when(spelt == 1, F.to_json(F.array(page))).otherwise(F.to_json(F.array(own)))
    rows = PA.named_records(o.select(value.alias("value")), "outages")
    return api.outages_listing(rows, kind=None, limit=None).select(*_RENAMED, F.size("routes").alias("n_routes"))


@register("alerts_renamed", W("SELECT id, severity, updated, header, routes_str FROM alerts_latest WHERE route_1 = 'A' OR route_2 = 'A'", "alerts_latest"))
def alerts_renamed(spark: SparkSession, d: str) -> DataFrame:
    """Latest alerts with the API's column names go through E3 as they are."""
    a = api.latest_alerts(R.alert_polls(spark, d)).withColumnsRenamed({"header": "header_text", "description": "description_text",
                                                                         "updated": "updated_at", "routes": "affected_routes"})
    return api.alerts_listing(a, route_id="A", limit=None).select("id", "severity", "updated", "header", _routes_str())


@register("outages_without_ids", W("SELECT equipment_id || '@' || strftime(outage_start, '%Y-%m-%dT%H:%M:%S') AS outage_id, equipment_id, station, is_current FROM outages", "outages"))
def outages_without_ids(spark: SparkSession, d: str) -> DataFrame:
    """The feed's outages carry no id; equipment and start name one."""
    msgs = FD.outage_messages(R.outages(spark, d), with_id=False)
    return PA.outages(msgs, kind=F.col("feed")).select("outage_id", "equipment_id", "station", "is_current")


@register("normalize_time_zoned", W("""
SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('millisecond', ts)
                                   WHEN 2 THEN date_trunc('millisecond', ts) ELSE ts END AS event_time FROM vehicles""", "vehicles"))
def normalize_time_zoned(spark: SparkSession, d: str) -> DataFrame:
    """P16 on ISO text with Z and with an offset, and on epochs with a fraction."""
    eid, ts = F.col("event_id"), F.col("ts")
    there = ts + F.expr("INTERVAL '05:30' HOUR TO MINUTE")
    micros = F.timestamp_diff("MICROSECOND", F.lit("1970-01-01").cast("timestamp_ntz"), ts)
    raw = (F.when(eid % 4 == 0, F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
           .when(eid % 4 == 1, F.concat(F.date_format(there, "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("+05:30")))
           .when(eid % 4 == 2, F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSS"), F.lit("+00:00")))
           .otherwise((micros.cast("decimal(20,0)") / F.lit(1000000).cast("decimal(7,0)")).cast("decimal(20,6)").cast("string")))
    return R.vehicles(spark, d).select("event_id", normalize_time(raw).alias("event_time"))


@register("stream_restart", W("SELECT id, vehicle_id, route_id, date_trunc('second', ts) AS event_time FROM vehicles", "vehicles"))
def stream_restart(spark: SparkSession, d: str) -> DataFrame:
    """The job ends and starts again from its checkpoint; what landed in between is read once, nothing twice."""
    path, out, ck = (fresh_dir(spark, n) for n in ("landing-restart", "tables", "checkpoints"))
    for k in range(2):
        FD.publish(FD.vehicle_messages(R.vehicles(spark, d).filter(F.col("event_id") % 2 == k)), path=path)
        J.await_all(spark, [J.vehicle_job(FD.landing_stream(spark, path, "vehicles"), out, ck, available_now=True)])
    return J.read_history(spark, out).select("id", "vehicle_id", "route_id", "event_time")
