"""Feed messages: encoding records as keyed JSON envelopes (K6, the publish
side) and reading feeds as streams or batches (S1, S2).

A message frame has ``feed``, ``key`` and ``value`` (JSON text), the shape of
a topic record. Encoding is per row (``to_json``); the alert and elevator
feeds pack up to ``per_message`` entities into one envelope, grouped by a
dense integer id, so a message never holds more than that many entities.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflow import schemas as SC
from metroflow.functions.time import epoch_seconds
from metroflow.sources import records as R

PER_MESSAGE = 100
#: Messages a landed file holds at most: reports, and envelopes of up to PER_MESSAGE records.
REPORTS_PER_FILE, ENVELOPES_PER_FILE = 100_000, 500


def _message(feed: str | Column, key: Column, envelope: Column) -> list[Column]:
    f = F.lit(feed) if isinstance(feed, str) else feed
    return [f.alias("feed"), key.cast("string").alias("key"), F.to_json(envelope).alias("value")]


_VEHICLE_FIELDS = [f.name for f in SC.VEHICLE.fields]


def vehicle_messages(vehicles: DataFrame) -> DataFrame:
    """One message per position report, keyed by the line (the feed it came from)."""
    elem = F.struct(*[F.col(c) for c in _VEHICLE_FIELDS])
    env = F.struct(F.col("line_id"), F.col("timestamp"), F.array(elem).alias("data"))
    return vehicles.select(*_message("vehicles", F.col("line_id"), env))


def trip_stops(vehicles: DataFrame) -> Column:
    """Stops k = 0, 1, 2 of a report's trip: stop R((event_id+k) % 60), arrival epoch+120k
    (none for k=0), departure 30 s later (none for k=2); no stops when event_id % 20 = 0."""
    eid, ts = F.col("event_id"), F.col("timestamp")
    stops = []
    for k in range(3):
        arr = ts + 120 * k
        stops.append(F.struct(
            F.concat(F.lit("R"), ((eid + k) % 60).cast("string")).alias("stop_id"),
            (F.lit(None).cast("bigint") if k == 0 else arr).alias("arrival"),
            (F.lit(None).cast("bigint") if k == 2 else arr + 30).alias("departure")))
    return F.when(eid % 20 == 0, F.array().cast(f"array<{SC.STOP.simpleString()}>")).otherwise(F.array(*stops))


def trip_update_messages(vehicles: DataFrame) -> DataFrame:
    """One trip-update message per report (the trip it serves, with its next stops)."""
    elem = F.struct(F.col("id"), F.col("line_id"), F.col("trip_id"), F.col("route_id"), F.col("start_time"),
                    F.col("start_date"), F.col("vehicle_id"), trip_stops(vehicles).alias("stops"),
                    F.col("timestamp"))
    env = F.struct(F.col("line_id"), F.col("timestamp"), F.array(elem).alias("data"))
    return vehicles.select(*_message("trip_updates", F.col("line_id"), env))


def _translations(text: Column, did: Column, with_variants: bool) -> Column:
    """Translation list of a text; ``with_variants`` adds the first-match edge cases."""
    t = F.struct
    en = F.array(t(F.lit("en").alias("language"), text.alias("text")))
    if not with_variants:
        return en
    return (F.when(did % 9 == 1, F.array(t(F.lit("es").alias("language"), F.lit("Aviso").alias("text")),
                                         t(F.lit("en").alias("language"), text.alias("text")),
                                         t(F.lit("en").alias("language"), F.lit("Second English").alias("text"))))
            .when(did % 9 == 2, F.array(t(F.lit("es").alias("language"), F.lit("Aviso").alias("text"))))
            .otherwise(en))


def alert_entities(alerts: DataFrame) -> DataFrame:
    """Alert entities of each record, with the edge cases of FIXTURES.md §A3:
    first/none/absent English header, absent description, zero/one/two
    periods, one route named twice, and an entity without an alert."""
    did = F.col("doc_id")
    start_e, end_e = epoch_seconds("start"), epoch_seconds("end")
    period = F.struct(start_e.alias("start"), end_e.alias("end"))
    periods = (F.when(F.col("start").isNull(), F.array().cast("array<struct<start:bigint,end:bigint>>"))
               .when(did % 11 == 1, F.array(period, F.struct((start_e + 86400).alias("start"),
                                                             (end_e + 86400).alias("end"))))
               .otherwise(F.array(period)))
    r1, r2 = F.element_at("routes", 1), F.coalesce(F.try_element_at("routes", F.lit(2)), F.element_at("routes", 1))
    informed = F.array(*[F.struct(r.alias("route_id")) for r in (r1, r2, r1)])
    header = F.when(did % 9 == 3, F.lit(None)).otherwise(F.struct(_translations(F.col("header"), did, True)
                                                                  .alias("translation")))
    desc = F.when(did % 9 == 4, F.lit(None)).otherwise(F.struct(_translations(F.col("description"), did, False)
                                                                .alias("translation")))
    alert = F.struct(F.col("alert_type").alias("cause"), F.col("effect"), F.col("severity"),
                     header.alias("header_text"), desc.alias("description_text"),
                     informed.alias("informed_entity"), periods.alias("active_period"))
    ent = F.struct(F.col("id"), alert.alias("alert"))
    extra = F.struct(F.concat(F.lit("notice-"), did.cast("string")).alias("id"),
                     F.lit(None).cast(SC.ALERT).alias("alert"))
    ents = F.when(did % 13 == 0, F.array(ent, extra)).otherwise(F.array(ent))
    return alerts.select(did.alias("_n"), epoch_seconds("updated").alias("_poll"), ents.alias("_ents"))


def alert_messages(alerts: DataFrame, per_message: int = PER_MESSAGE) -> DataFrame:
    """Alert feed messages: up to ``per_message`` alerts per envelope, one envelope per (poll, chunk)."""
    e = alert_entities(alerts)
    g = (e.groupBy("_poll", F.floor(F.col("_n") / per_message).alias("_chunk"))
         .agg(F.flatten(F.collect_list("_ents")).alias("entity")))
    data = F.struct(F.struct(F.col("_poll").alias("timestamp")).alias("header"), F.col("entity"))
    env = F.struct(F.col("_poll").alias("timestamp"), data.alias("data"))
    return g.select(*_message("alerts", F.col("_chunk"), env))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")


def outage_messages(outages: DataFrame, poll: Column | None = None, per_message: int = PER_MESSAGE, with_id: bool = True) -> DataFrame:
    """Current and upcoming outage feeds (by ``is_current``), up to ``per_message`` per envelope.

    ``with_id`` adds the records' ids; feeds carry none (equipment and start then name an outage).
    """
    # chunk by order number: at most 100 orders (and their few line items) per envelope
    n = F.element_at(F.split(F.substr(F.col("outage_id"), F.lit(4)), "-"), 1).cast("bigint")
    flat = [*(["outage_id"] if with_id else []), "equipment_id", "station", "borough", "equipment_type", "serving",
            "outage_start", "outage_end", "reason", "latest_status"]
    poll = poll if poll is not None else F.lit(R.ALERT_POLL_1).cast("bigint")
    # the records are shuffled flat, with times as numbers, and spelt as the feed does in their envelope
    g = (outages.select(F.col("is_current"), F.floor(n / per_message).alias("_chunk"), F.struct(*flat).alias("o"))
         .groupBy("is_current", "_chunk").agg(F.collect_list("o").alias("_flat")))

    def elem(o: Column) -> Column:
        return F.struct(
            *([o["outage_id"].alias("outage_id")] if with_id else []), o["equipment_id"].alias("equipment_id"),
            F.struct(o["station"].alias("name"), o["borough"].alias("borough")).alias("station"),
            o["equipment_type"].alias("equipment_type"), o["serving"].alias("serving"),
            _iso(o["outage_start"]).alias("outage_start_date_time"),
            _iso(o["outage_end"]).alias("estimated_return_date_time"),
            F.struct(o["reason"].alias("reason_name")).alias("reason"),
            F.struct(o["latest_status"].alias("status_name")).alias("latest_status"))

    g = g.select("is_current", "_chunk", F.transform("_flat", elem).alias("outages"))
    feed = F.when(F.col("is_current"), F.lit("outages_current")).otherwise(F.lit("outages_upcoming"))
    env = F.struct(poll.alias("timestamp"),
                   F.struct(F.struct(F.col("outages")).alias("nyct_ene")).alias("data"))
    return g.select(*_message(feed, F.col("_chunk"), env))


def equipment_messages(equipment: DataFrame, poll: Column | None = None, per_message: int = PER_MESSAGE) -> DataFrame:
    """Equipment feed, up to ``per_message`` per envelope."""
    n = F.substr(F.col("equipment_id"), F.lit(3)).cast("bigint")
    elem = F.struct(F.col("equipment_id"),
                    F.struct(F.col("station").alias("name"), F.col("borough")).alias("station"),
                    F.col("equipment_type"), F.col("serving"), F.col("ada"))
    poll = poll if poll is not None else F.lit(R.ALERT_POLL_1).cast("bigint")
    g = (equipment.select(F.floor(n / per_message).alias("_chunk"), elem.alias("q"))
         .groupBy("_chunk").agg(F.collect_list("q").alias("equipments")))
    env = F.struct(poll.alias("timestamp"),
                   F.struct(F.struct(F.col("equipments")).alias("nyct_ene_equipments")).alias("data"))
    return g.select(*_message("equipment", F.col("_chunk"), env))


# --- sources ------------------------------------------------------------------


def topic_stream(spark: SparkSession, bootstrap: str, kind: str, starting: str = "latest",
                 fail_on_data_loss: bool = True, max_offsets: int | None = None) -> DataFrame:
    """Subscribe to a feed's topic. Needs the Kafka connector on the classpath.

    Records that the topic no longer holds fail the query unless ``fail_on_data_loss`` is False.
    """
    f = SC.feed(kind)
    r = (spark.readStream.format("kafka")
         .option("kafka.bootstrap.servers", bootstrap)
         .option("subscribe", f.topic)
         .option("startingOffsets", starting)
         .option("failOnDataLoss", str(fail_on_data_loss).lower()))
    if max_offsets:
        r = r.option("maxOffsetsPerTrigger", str(max_offsets))
    return r.load().select(F.lit(kind).alias("feed"), F.col("key").cast("string").alias("key"),
                           F.col("value").cast("string").alias("value"))


def landing_stream(spark: SparkSession, path: str, kind: str, max_files: int | None = None) -> DataFrame:
    """A landing folder of JSON-lines message files (one envelope per line) as a stream."""
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return _landed(r.load(path), kind)


def landing_batch(spark: SparkSession, path: str, kind: str) -> DataFrame:
    """Batch twin of ``landing_stream``."""
    return _landed(spark.read.text(path), kind)


def landing_lines(spark: SparkSession, path: str, lines: list[str] = SC.LINE_FEEDS) -> DataFrame:
    """The registered line feeds, each in its folder below ``path``, by one scan; other folders aren't listed."""
    return _landed(spark.read.option("basePath", path).text(f"{path}/key={{{','.join(lines)}}}"), "vehicles")


def _landed(lines: DataFrame, kind: str) -> DataFrame:
    """Message frame of landed lines; the key is there where the folder has one folder per key."""
    key = F.col("key") if "key" in lines.columns else F.lit(None)
    return lines.select(F.lit(kind).alias("feed"), key.cast("string").alias("key"), "value")


def publish(messages: DataFrame, bootstrap: str | None = None, path: str | None = None, by_key: bool = False,
            per_file: int = REPORTS_PER_FILE) -> None:
    """K6: write keyed messages to each feed's topic (``bootstrap``) or to a landing folder (``path``).

    ``by_key`` makes one folder per key under ``path``, for feeds of few keys
    such as the line feeds; readers of the root then give the key back (U1).
    Landed files are gzipped, since JSON repeats its names in every record. Such a file is
    read by one task, so it holds at most ``per_file`` messages.
    """
    if bootstrap:
        topics = F.create_map(*[x for k, f in SC.FEEDS.items() for x in (F.lit(k), F.lit(f.topic))])
        (messages.select(F.try_element_at(topics, F.col("feed")).alias("topic"), "key", "value")
         .write.format("kafka").option("kafka.bootstrap.servers", bootstrap).save())
    elif path:
        landed = {"compression": "gzip", "maxRecordsPerFile": per_file}
        if by_key:
            messages.select("key", "value").write.mode("append").options(**landed).partitionBy("key").text(path)
        else:
            messages.select("value").write.mode("append").options(**landed).text(path)
    else:
        raise ValueError("publish needs bootstrap or path")
