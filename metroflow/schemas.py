"""Fixed schemas of the feeds and tables, and the feed registry.

Schemas are explicit and never inferred. Epoch fields are ``bigint`` (JSON
numbers read into a timestamp field would count as seconds, which breaks
millisecond input); times are normalised after parsing.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()


def _f(name, dtype, nullable=True):
    return T.StructField(name, dtype, nullable)


def struct(*fields) -> T.StructType:
    return T.StructType([_f(*f) for f in fields])


CORRUPT = "_corrupt_record"

# --- feed elements ------------------------------------------------------------

STOP = struct(("stop_id", S), ("arrival", L), ("departure", L))

TRIP_UPDATE = struct(
    ("id", S), ("line_id", S), ("trip_id", S), ("route_id", S), ("start_time", S), ("start_date", S),
    ("vehicle_id", S), ("stops", T.ArrayType(STOP)), ("timestamp", L))

VEHICLE = struct(
    ("id", S), ("line_id", S), ("trip_id", S), ("route_id", S), ("start_time", S), ("start_date", S),
    ("vehicle_id", S), ("current_status", I), ("current_stop_sequence", I), ("stop_id", S),
    ("latitude", D), ("longitude", D), ("bearing", D), ("timestamp", L))

TRANSLATED = struct(("translation", T.ArrayType(struct(("language", S), ("text", S)))))

ALERT = struct(
    ("cause", S), ("effect", S), ("severity", S), ("header_text", TRANSLATED), ("description_text", TRANSLATED),
    ("informed_entity", T.ArrayType(struct(("route_id", S)))),
    ("active_period", T.ArrayType(struct(("start", L), ("end", L)))))

ALERT_ENTITY = struct(("id", S), ("alert", ALERT))

STATION = struct(("name", S), ("borough", S))

OUTAGE = struct(
    ("outage_id", S), ("equipment_id", S), ("station", STATION), ("equipment_type", S), ("serving", S),
    ("outage_start_date_time", S), ("estimated_return_date_time", S),
    ("reason", struct(("reason_name", S))), ("latest_status", struct(("status_name", S))))

EQUIPMENT = struct(
    ("equipment_id", S), ("station", STATION), ("equipment_type", S), ("serving", S), ("ada", B))

# --- envelopes: {poll time, payload} -------------------------------------------

TRIP_ENVELOPE = struct(("line_id", S), ("timestamp", L), ("data", T.ArrayType(TRIP_UPDATE)))
VEHICLE_ENVELOPE = struct(("line_id", S), ("timestamp", L), ("data", T.ArrayType(VEHICLE)))
ALERT_ENVELOPE = struct(
    ("timestamp", L),
    ("data", struct(("header", struct(("timestamp", L))), ("entity", T.ArrayType(ALERT_ENTITY)))))
OUTAGE_ENVELOPE = struct(
    ("timestamp", L), ("data", struct(("nyct_ene", struct(("outages", T.ArrayType(OUTAGE)))))))
EQUIPMENT_ENVELOPE = struct(
    ("timestamp", L),
    ("data", struct(("nyct_ene_equipments", struct(("equipments", T.ArrayType(EQUIPMENT)))))))

# --- messages (what a topic or landing folder holds) ------------------------------

MESSAGE = struct(("feed", S), ("key", S), ("value", S))

# --- stored tables ---------------------------------------------------------------

ROUTE_STATS = struct(("window_start", T.TimestampNTZType()), ("window_end", T.TimestampNTZType()),
                     ("line_id", S), ("route_id", S), ("count", L))


@dataclass(frozen=True)
class Feed:
    """One feed: where it is published, how it is shaped, what keys a row, where it is stored."""
    kind: str
    topic: str
    envelope: T.StructType
    key: tuple[str, ...]
    tables: tuple[str, ...]
    poll_seconds: int


# Line feeds of the vehicle/trip topics (message key = line id).
LINE_FEEDS = ["ACE", "G", "NQRW", "1234567", "BDFM", "JZ", "L", "SIR"]

FEEDS: dict[str, Feed] = {
    "vehicles": Feed("vehicles", "vehicle_positions", VEHICLE_ENVELOPE, ("vehicle_id",),
                     ("vehicle_history", "vehicle_latest", "route_stats"), 30),
    "trip_updates": Feed("trip_updates", "trip_updates", TRIP_ENVELOPE, ("trip_id",), ("trip_stops",), 30),
    "alerts": Feed("alerts", "service_alerts", ALERT_ENVELOPE, ("id",), ("alerts",), 60),
    "outages_current": Feed("outages_current", "elevator_outages_current", OUTAGE_ENVELOPE,
                            ("outage_id",), ("outages",), 120),
    "outages_upcoming": Feed("outages_upcoming", "elevator_outages_upcoming", OUTAGE_ENVELOPE,
                             ("outage_id",), ("outages",), 120),
    "equipment": Feed("equipment", "elevator_equipment", EQUIPMENT_ENVELOPE, ("equipment_id",), ("equipment",), 120),
}


def feed(kind: str) -> Feed:
    if kind not in FEEDS:
        raise KeyError(f"unknown feed {kind!r}; known: {sorted(FEEDS)}")
    return FEEDS[kind]
