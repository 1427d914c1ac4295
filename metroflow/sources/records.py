"""Flat feed records derived from the data folder's tables.

These are the parsed shapes of the four feeds (vehicle positions, alerts,
elevator equipment, elevator outages). Each builder is a narrow projection of
one scan (outages: one join), so it scales with its input and adds no
shuffle except the outage join, which Spark plans by size (AQE).

The rules match ``metroflow.plans.oracle.RECORD_SQL`` one for one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflow.functions.time import epoch_seconds, from_epoch_seconds
from metroflow.sources.tables import per_session, read_table

# ---------------------------------------------------------------------------
# Fixed values of the record rules (FIXTURES.md §B).
# ---------------------------------------------------------------------------
VEHICLE_ROUTES = ("1,2,3,4,5,6,7,A,C,E,B,D,F,M,G,J,Z,L,N,Q,R,W,S,SIR,"
                  "M15,B41,Bx12,Q58,X27,SIM1").split(",")
LINE_OF_ROUTES = [
    ("1234567", ["1", "2", "3", "4", "5", "6", "7"]),
    ("ACE", ["A", "C", "E"]),
    ("BDFM", ["B", "D", "F", "M"]),
    ("NQRW", ["N", "Q", "R", "W"]),
    ("JZ", ["J", "Z"]),
]
OWN_LINE_ROUTES = ["G", "L", "SIR"]
OTHER_LINE = "OTHER"
ALERT_KINDS = ("Delays on line|Service suspended|Station closed|Trains run slow|Detour for riders|"
               "Planned work|Track maintenance|Trains skip stops|Local trains run express|"
               "Reduced service|Emergency activity|Notice").split("|")
ALERT_ROUTES_1 = "1,2,3,A,C,E,B,D,F,M,G,L,N,Q,S,SIR,M15,B41,Bx12,Q58,X27,SIM1".split(",")
ALERT_ROUTES_2 = "A,B,G,7".split(",")
ALERT_SEVERITIES = ["UNKNOWN", "SEVERE", "MODERATE", "LOW", None]
ALERT_PERIOD_BASE = 1704067200          # 2024-01-01 00:00:00 UTC
ALERT_POLL_1 = 1705276680               # 2024-01-14 23:58:00 UTC
ALERT_POLL_2 = ALERT_POLL_1 + 60
BOROUGHS = "MANHATTAN,BROOKLYN,QUEENS,BRONX,STATEN ISLAND".split(",")
START_TIME = "00:00:00"
START_DATE = "20240101"
# ---------------------------------------------------------------------------


def _pick(values: list, idx_1based: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), idx_1based.cast("int"))


@per_session
def vehicles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle position records, one per event."""
    e = read_table(spark, sf_dir, "events", ["event_id", "ts", "user_id", "event_type"])
    route = _pick(VEHICLE_ROUTES, (F.col("user_id") * 7 + F.col("event_id") % 3) % len(VEHICLE_ROUTES) + 1)
    e = e.withColumn("route_id", route)
    r = F.col("route_id")
    line = F.when(r.isin(*LINE_OF_ROUTES[0][1]), F.lit(LINE_OF_ROUTES[0][0]))
    for name, routes in LINE_OF_ROUTES[1:]:
        line = line.when(r.isin(*routes), F.lit(name))
    line = line.when(r.isin(*OWN_LINE_ROUTES), r).otherwise(F.lit(OTHER_LINE))
    no_pos = F.col("event_type") == "error"
    eid = F.col("event_id")
    return e.select(
        "event_id",
        F.concat(F.lit("E"), eid.cast("string")).alias("id"),
        line.alias("line_id"),
        "route_id",
        F.concat(F.lit("T"), F.col("user_id").cast("string"), F.lit("_"), r).alias("trip_id"),
        F.lit(START_TIME).alias("start_time"),
        F.lit(START_DATE).alias("start_date"),
        F.when(eid % 50 != 0, F.concat(F.lit("V"), F.col("user_id").cast("string"))).alias("vehicle_id"),
        (eid % 4).cast("int").alias("current_status"),
        (eid % 40).cast("int").alias("current_stop_sequence"),
        F.concat(F.lit("R"), (eid % 60).cast("string")).alias("stop_id"),
        F.when(~no_pos, F.lit(40.5) + (eid % 500).cast("double") / F.lit(1000.0)).alias("latitude"),
        F.when(~no_pos, F.lit(-74.25) + (eid % 700).cast("double") / F.lit(1000.0)).alias("longitude"),
        F.when(~no_pos, (eid % 360).cast("double")).alias("bearing"),
        "ts",
        epoch_seconds("ts").alias("timestamp"),
    )


@per_session
def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alert records of the first poll, one per document (the whole text is the description)."""
    d = read_table(spark, sf_dir, "documents", ["doc_id", "text"])
    did = F.col("doc_id")
    kind = _pick(ALERT_KINDS, did % len(ALERT_KINDS) + 1)
    r1 = _pick(ALERT_ROUTES_1, did % len(ALERT_ROUTES_1) + 1)
    r2 = _pick(ALERT_ROUTES_2, did % len(ALERT_ROUTES_2) + 1)
    sev = F.lit(None).cast("string")
    for i, s in enumerate(ALERT_SEVERITIES):
        if s is not None:
            sev = F.when(did % 5 == i, F.lit(s)).otherwise(sev)
    start_epoch = F.lit(ALERT_PERIOD_BASE).cast("bigint") + (did % 20) * 86400
    end_epoch = F.when(did % 3 != 0, F.lit(ALERT_PERIOD_BASE).cast("bigint") + (did % 20 + 5) * 86400)
    no_period = did % 11 == 0
    return d.select(
        "doc_id",
        F.concat(F.lit("alert-"), did.cast("string")).alias("id"),
        F.when(did % 7 != 0, F.lit("N/A")).alias("alert_type"),
        F.when(did % 4 == 0, F.lit("SIGNIFICANT_DELAYS")).otherwise(F.lit("N/A")).alias("effect"),
        F.when(did % 9 == 2, F.lit("")).when(did % 9 == 3, F.lit(""))
         .otherwise(F.concat(kind, F.lit(": "), r1, F.lit(" and "), r2, F.lit(" trains"))).alias("header"),
        F.when(did % 9 == 4, F.lit("")).otherwise(F.col("text")).alias("description"),
        F.when(~no_period, from_epoch_seconds(start_epoch)).alias("start"),
        F.when(~no_period, from_epoch_seconds(end_epoch)).alias("end"),
        from_epoch_seconds(F.lit(ALERT_POLL_1).cast("bigint")).alias("updated"),
        sev.alias("severity"),
        F.array_distinct(F.array(r1, r2, r1)).alias("routes"),
    )


@per_session
def alert_polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both polls, as the alert table holds them before latest-state reduction.

    The second poll repeats the even documents 60 s later as SEVERE. Both
    versions come from one scan: each record explodes into its poll versions.
    """
    a = alerts(spark, sf_dir)
    poll2 = from_epoch_seconds(F.lit(ALERT_POLL_2).cast("bigint"))
    versions = F.when(F.col("doc_id") % 2 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    v = a.withColumn("_poll", F.explode(versions))
    second = F.col("_poll") == 2
    return (v.withColumn("updated", F.when(second, poll2).otherwise(F.col("updated")))
            .withColumn("severity", F.when(second, F.lit("SEVERE")).otherwise(F.col("severity")))
            .drop("_poll"))


def replay_duplicates(vehicles: DataFrame) -> DataFrame:
    """Repeated input: reports with event_id % 10 = 3 arrive twice (one scan, explode)."""
    copies = F.when(F.col("event_id") % 10 == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return vehicles.withColumn("_copy", F.explode(copies)).drop("_copy")


def _equipment_cols(p_partkey: Column, p_name: Column, p_size: Column, p_type: Column) -> list[Column]:
    return [
        p_name.alias("station"),
        _pick(BOROUGHS, p_partkey % len(BOROUGHS) + 1).alias("borough"),
        F.when(p_size % 2 == 0, F.lit("ELEVATOR")).otherwise(F.lit("ESCALATOR")).alias("equipment_type"),
        p_type.alias("serving"),
    ]


@per_session
def equipment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Elevator/escalator equipment, one per part."""
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_size"])
    return p.select(
        F.concat(F.lit("EQ"), F.col("p_partkey").cast("string")).alias("equipment_id"),
        *_equipment_cols(F.col("p_partkey"), F.col("p_name"), F.col("p_size"), F.col("p_type")),
        (F.col("p_size") % 3 == 0).alias("ada"),
    )


@per_session
def outages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outages, one per line item, described by the part's equipment."""
    li = read_table(spark, sf_dir, "lineitem",
                    ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_returnflag",
                     "l_linestatus", "l_shipdate"])
    p = read_table(spark, sf_dir, "part", ["p_partkey", "p_name", "p_type", "p_size"])
    j = li.join(p, li["l_partkey"] == p["p_partkey"], "inner")
    start = F.to_date("l_shipdate")
    return j.select(
        # (order, line, part, supplier) identifies a line item; (order, line) alone does not
        F.concat_ws("-", F.concat(F.lit("OUT"), F.col("l_orderkey").cast("string")),
                    F.col("l_linenumber").cast("string"), F.col("l_partkey").cast("string"), F.col("l_suppkey").cast("string")).alias("outage_id"),
        F.concat(F.lit("EQ"), F.col("l_partkey").cast("string")).alias("equipment_id"),
        *_equipment_cols(F.col("p_partkey"), F.col("p_name"), F.col("p_size"), F.col("p_type")),
        start.cast("timestamp_ntz").alias("outage_start"),
        F.when(F.col("l_quantity") >= 10, F.date_add(start, F.col("l_quantity").cast("int")))
         .cast("timestamp_ntz").alias("outage_end"),
        F.when(F.col("l_returnflag") == "R", F.lit("Repair"))
         .when(F.col("l_returnflag") == "A", F.lit("Scheduled Maintenance"))
         .otherwise(F.lit("Capital Replacement")).alias("reason"),
        F.when(F.col("l_linestatus") == "O", F.lit("OUT_OF_SERVICE")).otherwise(F.lit("PLANNED")).alias("latest_status"),
        (F.col("l_linestatus") == "O").alias("is_current"),
    )
