"""Feed parsing (P1-P19, P25): decode, split valid/rejected, unwrap, flatten.

Every parser takes any DataFrame with a string/binary ``value`` column, so a
batch frame, a file stream and a topic stream run the same code. Parsing is
per row (``from_json`` + ``explode``): no exchange, and Catalyst prunes the
JSON schema to the fields a query selects.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroflow import schemas as SC
from metroflow.functions.time import from_epoch_seconds, normalize_time
from metroflow.operators.predicates import has_field


def decode(messages: DataFrame, envelope: T.StructType, required: list[str] | None = None) -> DataFrame:
    """``value`` -> ``msg`` struct, plus ``_valid`` and ``_reason``.

    Malformed JSON is caught by the corrupt-record column; an envelope that
    parses but lacks a required field (``data`` by default) is rejected too,
    since a shape mismatch decodes to nulls without an error.

    The parsed struct comes out of a one-element ``explode``: filters on it
    cannot be pushed below the Generate, so Catalyst cannot inline
    ``from_json`` into each predicate and every message is parsed once.
    A frame that is decoded already is returned as it is.
    """
    if "_valid" in messages.columns:
        return messages
    schema = T.StructType(envelope.fields + [T.StructField(SC.CORRUPT, T.StringType(), True)])
    parsed = F.from_json(F.col("value").cast("string"), schema,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": SC.CORRUPT})
    req = required or ["data"]
    ok = F.lit(True)
    for r in req:
        ok = ok & F.col(f"msg.{r}").isNotNull()
    broken = F.col("value").isNull() | F.col(f"msg.{SC.CORRUPT}").isNotNull() | F.col("msg").isNull()
    return (messages.select("*", F.explode(F.array(parsed)).alias("msg"))
            .withColumn("_reason", F.when(broken, F.lit("malformed")).when(~ok, F.lit("missing_fields")))
            .withColumn("_valid", F.col("_reason").isNull()))


def valid(decoded: DataFrame) -> DataFrame:
    return decoded.filter(F.col("_valid"))


def rejected(decoded: DataFrame) -> DataFrame:
    """Rows that failed decoding, with the raw text kept for inspection."""
    cols = [c for c in ("feed", "key") if c in decoded.columns]
    return decoded.filter(~F.col("_valid")).select(*cols, F.col("value").cast("string").alias("raw"),
                                                   F.col("_reason").alias("reason"))


def _d(col: Column, default) -> Column:
    """Default for a missing key (a JSON null gets it too)."""
    return F.coalesce(col, F.lit(default))


def vehicles(messages: DataFrame) -> DataFrame:
    """One row per vehicle position; the line comes from the envelope when absent."""
    dec = valid(decode(messages, SC.VEHICLE_ENVELOPE))
    v = dec.select("msg.line_id", F.col("msg.timestamp").alias("poll_time"),
                   F.explode("msg.data").alias("v"))
    return v.select(
        F.col("v.id").alias("id"),
        F.coalesce(F.col("v.line_id"), F.col("line_id")).alias("line_id"),
        *[F.col(f"v.{c}").alias(c) for c in ("trip_id", "route_id", "start_time", "start_date", "vehicle_id",
                                              "current_status", "current_stop_sequence", "stop_id",
                                              "latitude", "longitude", "bearing")],
        F.coalesce(F.col("v.timestamp"), F.col("poll_time")).alias("timestamp"),
        from_epoch_seconds(F.coalesce(F.col("v.timestamp"), F.col("poll_time"))).alias("event_time"),
        from_epoch_seconds(F.col("poll_time")).alias("fetch_time"),
    )


def trip_updates(messages: DataFrame) -> DataFrame:
    """One row per trip update (stops still nested)."""
    dec = valid(decode(messages, SC.TRIP_ENVELOPE))
    t = dec.select("msg.line_id", F.col("msg.timestamp").alias("poll_time"), F.explode("msg.data").alias("t"))
    return t.select(
        F.col("t.id").alias("id"),
        F.coalesce(F.col("t.line_id"), F.col("line_id")).alias("line_id"),
        *[F.col(f"t.{c}").alias(c) for c in ("trip_id", "route_id", "start_time", "start_date", "vehicle_id")],
        F.coalesce(F.col("t.stops"), F.array()).alias("stops"),
        F.coalesce(F.col("t.timestamp"), F.col("poll_time")).alias("timestamp"),
    )


def stop_times(trips: DataFrame) -> DataFrame:
    """One row per stop; a trip without stops keeps one row of nulls."""
    keep = [c for c in trips.columns if c != "stops"]
    s = trips.select(*keep, F.posexplode_outer("stops").alias("stop_index", "s"))
    return s.select(*keep, "stop_index", F.col("s.stop_id").alias("stop_id"),
                    F.col("s.arrival").alias("arrival"), F.col("s.departure").alias("departure"),
                    normalize_time(F.col("s.arrival")).alias("arrival_time"),
                    normalize_time(F.col("s.departure")).alias("departure_time"))


def first_translation(translated: Column, language: str = "en") -> Column:
    """P10: text of the first translation in ``language``, else ''."""
    tr = F.filter(translated.getField("translation"), lambda t: t.getField("language") == language)
    return F.coalesce(F.try_element_at(tr, F.lit(1)).getField("text"), F.lit(""))


def distinct_routes(informed: Column) -> Column:
    """Route ids in first-seen order, without repeats or nulls."""
    ids = F.transform(informed, lambda e: e.getField("route_id"))
    return F.coalesce(F.array_distinct(F.filter(ids, lambda r: r.isNotNull())), F.array().cast("array<string>"))


def alerts(messages: DataFrame) -> DataFrame:
    """One row per entity that holds an alert."""
    dec = valid(decode(messages, SC.ALERT_ENVELOPE))
    e = dec.select(F.coalesce(F.col("msg.data.header.timestamp"), F.col("msg.timestamp")).alias("feed_time"),
                   F.explode("msg.data.entity").alias("e"))
    e = e.filter(has_field("e.alert"))
    a = F.col("e.alert")
    first_period = F.try_element_at(a.getField("active_period"), F.lit(1))
    return e.select(
        _d(F.col("e.id"), "").alias("id"),
        _d(a.getField("cause"), "").alias("alert_type"),
        _d(a.getField("effect"), "").alias("effect"),
        first_translation(a.getField("header_text")).alias("header"),
        first_translation(a.getField("description_text")).alias("description"),
        normalize_time(first_period.getField("start")).alias("start"),
        normalize_time(first_period.getField("end")).alias("end"),
        normalize_time(F.col("feed_time")).alias("updated"),
        a.getField("severity").alias("severity"),
        distinct_routes(a.getField("informed_entity")).alias("routes"),
    )


def _station_cols(o: Column) -> list[Column]:
    return [
        _d(o.getField("equipment_id"), "").alias("equipment_id"),
        _d(o.getField("station").getField("name"), "").alias("station"),
        _d(o.getField("station").getField("borough"), "").alias("borough"),
        _d(o.getField("equipment_type"), "").alias("equipment_type"),
        _d(o.getField("serving"), "").alias("serving"),
    ]


def outages(messages: DataFrame, kind: str | Column = "current") -> DataFrame:
    """One row per outage; ``is_current`` from the feed kind.

    ``kind`` is 'current', 'upcoming', or a Column holding the feed name.
    """
    dec = valid(decode(messages, SC.OUTAGE_ENVELOPE))
    if isinstance(kind, str):
        cur = F.lit(kind == "current")
    else:
        cur = kind == F.lit("outages_current")
    o = dec.select(cur.alias("is_current"), F.col("msg.timestamp").alias("poll_time"),
                   F.explode("msg.data.nyct_ene.outages").alias("o"))
    x = F.col("o")
    return o.select(
        # the feed's outages carry no id: the equipment and the start name one
        F.coalesce(F.nullif(x.getField("outage_id"), F.lit("")), F.when(
            F.coalesce(x.getField("equipment_id"), F.lit("")) != "",
            F.concat_ws("@", x.getField("equipment_id"), x.getField("outage_start_date_time")))).alias("outage_id"),
        *_station_cols(x),
        normalize_time(x.getField("outage_start_date_time")).alias("outage_start"),
        normalize_time(x.getField("estimated_return_date_time")).alias("outage_end"),
        _d(x.getField("reason").getField("reason_name"), "").alias("reason"),
        _d(x.getField("latest_status").getField("status_name"), "").alias("latest_status"),
        "is_current",
        from_epoch_seconds(F.col("poll_time")).alias("fetch_time"),
    )


def equipment(messages: DataFrame) -> DataFrame:
    """One row per equipment."""
    dec = valid(decode(messages, SC.EQUIPMENT_ENVELOPE))
    q = dec.select(F.col("msg.timestamp").alias("poll_time"),
                   F.explode("msg.data.nyct_ene_equipments.equipments").alias("q"))
    x = F.col("q")
    return q.select(*_station_cols(x), _d(x.getField("ada"), False).alias("ada"),
                    from_epoch_seconds(F.col("poll_time")).alias("fetch_time"))


def conform(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Take the first present of several alternative names for each canonical column.

    ``aliases`` maps canonical name -> alternatives in order of preference. An
    empty text counts as absent as long as another name has a value.
    Array-typed canonical columns that end up null become empty arrays. A frame
    of canonical columns is returned as it is.
    """
    present = {f.name: f.dataType for f in df.schema.fields}
    out = df
    for canon, alts in aliases.items():
        names = [c for c in [canon] + list(alts) if c in present]
        if names in ([], [canon]):
            continue
        filled = [F.nullif(F.col(c), F.lit("")) for c in names if isinstance(present[c], T.StringType)]
        val = F.coalesce(*filled, *[F.col(c) for c in names])
        out = out.withColumn(canon, val).drop(*[a for a in names if a != canon])
    if "type" in present and "is_current" not in present and "outage_start" in present:
        out = out.withColumn("is_current", F.col("type") == "current").drop("type")
    if "position" in present and "latitude" not in present:
        out = out.select(*[c for c in out.columns if c != "position"], "position.*")
    for f in out.schema.fields:
        if f.name in aliases and isinstance(f.dataType, T.ArrayType):
            out = out.withColumn(f.name, F.coalesce(F.col(f.name), F.array().cast(f.dataType)))
    return out


# Alternative names used by the different layers (canonical -> alternatives).
ALERT_ALIASES = {"header": ["header_text"], "description": ["description_text"],
                 "routes": ["affected_routes"], "updated": ["updated_at"]}
OUTAGE_ALIASES = {"station": ["station_name"], "latest_status": ["status"], "routes": ["trains"]}
VEHICLE_ALIASES: dict[str, list[str]] = {}  # the position may be nested
EQUIPMENT_ALIASES = {"station": ["station_name"]}

# Records as other layers send them: column -> type and the places it may be in, first with a value wins.
NAMED = {
    "alerts": {"id": ("string", ["id"]), "alert_type": ("string", ["alert_type", "cause"]), "effect": ("string", ["effect"]),
               "header": ("string", ["header_text", "header"]), "description": ("string", ["description_text", "description"]),
               "updated": ("string", ["updated_at", "updated"]), "severity": ("string", ["severity"]),
               "routes": ("array<string>", ["affected_routes", "routes"])},
    "outages": {"equipment_id": ("string", ["equipment_id"]), "station": ("string", ["station.name", "station_name", "station"]),
                "borough": ("string", ["station.borough", "borough"]), "equipment_type": ("string", ["equipment_type"]),
                "serving": ("string", ["serving"]), "outage_start": ("string", ["outage_start_date_time", "outage_start"]),
                "outage_end": ("string", ["estimated_return_date_time", "outage_end"]), "reason": ("string", ["reason.reason_name", "reason"]),
                "latest_status": ("string", ["latest_status.status_name", "latest_status", "status"]), "type": ("string", ["type"]),
                "is_current": ("boolean", ["is_current"]), "routes": ("array<string>", ["trains", "routes"])},
    "vehicles": {"id": ("string", ["id"]), "line_id": ("string", ["line_id"]), "trip_id": ("string", ["trip_id", "trip.trip_id"]),
                 "route_id": ("string", ["route_id", "trip.route_id"]), "vehicle_id": ("string", ["vehicle_id", "vehicle.id"]),
                 "latitude": ("double", ["latitude", "position.latitude"]), "longitude": ("double", ["longitude", "position.longitude"]),
                 "bearing": ("double", ["bearing", "position.bearing"]), "event_time": ("string", ["timestamp", "event_time"])},
    "equipment": {"equipment_id": ("string", ["equipment_id"]), "station": ("string", ["station.name", "station_name", "station"]),
                  "borough": ("string", ["station.borough", "borough"]), "equipment_type": ("string", ["equipment_type"]),
                  "serving": ("string", ["serving"]), "ada": ("boolean", ["ada"])},
}
NAMED_TIMES = {"updated", "outage_start", "outage_end", "event_time"}


def named_records(messages: DataFrame, kind: str) -> DataFrame:
    """Rows of messages whose records go by any of the layers' names, decoded once as VARIANT.

    A message is a list of records or an object that holds them in ``data``.
    A missing list is an empty list, a missing ``is_current`` follows ``type``;
    a value of another type than its column's is absent. No second schema is
    needed per spelling.
    """
    value = F.try_parse_json(F.col("value").cast("string"))
    one = messages.select(F.explode(F.array(value)).alias("m"))
    records = F.coalesce(F.try_variant_get("m", "$.data", "array<variant>"), F.try_variant_get("m", "$", "array<variant>"))
    rows = one.select(F.explode(records).alias("r"))
    cols = []
    for name, (kind_of, places) in NAMED[kind].items():
        got = [F.try_variant_get("r", f"$.{p}", kind_of) for p in places]
        col = F.coalesce(*(F.nullif(c, F.lit("")) for c in got), *got[-1:]) if kind_of == "string" else F.coalesce(*got)
        if kind_of.startswith("array"):
            col = F.coalesce(col, F.array().cast(kind_of))
        cols.append((normalize_time(col) if name in NAMED_TIMES else col).alias(name))
    out = rows.select(*cols)
    if "type" in NAMED[kind]:
        out = out.withColumn("is_current", F.coalesce(F.col("is_current"), F.col("type") == "current")).drop("type")
    return out
