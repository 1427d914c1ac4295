"""Structured Streaming jobs.

``vehicle_job`` parses the vehicle feed and, in one ``foreachBatch`` (K5),
appends the history by event date (K1) and the batch's newest row per vehicle
(K2), and optionally drops repeats, within the watermark or of what the
history holds (T7). ``route_stats_job`` keeps tumbling counts per route in the
state store with a watermark (T6/T8) and appends its updates;
``route_windows_job`` stores each window once, when the watermark closes it.
``feed_job`` stores any other feed. Each job has its own checkpoint under a
root (T2); triggers follow the feed's poll interval (T4) unless
``available_now`` drains what is there and stops.
"""

from __future__ import annotations

import time

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from metroflow import schemas as SC
from metroflow.functions.cells import cell
from metroflow.functions.time import to_event_time, to_wall_time
from metroflow.operators import parse as PA
from metroflow.operators.aggregate import distinct_sketches, merged_distinct
from metroflow.operators.state import latest_by_key
from metroflow.plans.api import STATS_WINDOW
from metroflow.streaming import sinks as K
from metroflow.streaming import upkeep as UP

# What makes a row the newest of its key, by feed (feeds re-send every record on each poll).
LATEST_ORDER = {"vehicles": ["event_time", "id"], "alerts": ["updated"], "equipment": ["fetch_time"],
                "outages_current": ["fetch_time"], "outages_upcoming": ["fetch_time"]}
# The time that tells how fresh a feed is.
HEALTH_TIME = {"alerts": "updated", "equipment": "fetch_time", "outages_current": "fetch_time", "outages_upcoming": "fetch_time"}
HISTORY, HISTORY_CELL = "vehicle_history", "cell"


def trigger_options(kind: str, available_now: bool = False) -> dict:
    """T4: processing-time trigger at the feed's poll interval, or availableNow for drains."""
    if available_now:
        return {"availableNow": True}
    return {"processingTime": f"{SC.feed(kind).poll_seconds} seconds"}


def _start(df: DataFrame, fn, name: str, checkpoint: str, trigger: dict) -> StreamingQuery:
    return (df.writeStream.queryName(name).foreachBatch(fn).outputMode("append")
            .option("checkpointLocation", checkpoint).trigger(**trigger).start())


def sketch_writer(out_root: str):
    """A writer of the batch's distinct vehicles per hour and line as sketches, by date."""
    def sketches(rows, bid, qid):
        hourly = distinct_sketches(rows, "event_time", STATS_WINDOW, "vehicle_id", "line_id")
        K.append_by_date(hourly.withColumn("window_date", F.to_date("window_start")), bid, f"{out_root}/vehicle_sketches", "window_date", qid=qid)
    return sketches


def active_vehicles(spark: SparkSession, out_root: str, *keys: str, first=None, last=None) -> DataFrame:
    """Distinct vehicles (estimate and bounds) of the days from ``first`` to ``last``, merged from hourly sketches."""
    schema = "window_start timestamp_ntz, line_id string, sketch binary, window_date date"
    return merged_distinct(K.read_days(spark, f"{out_root}/vehicle_sketches", first, last, schema=schema, date_col="window_date"), *keys)


def parsed_vehicles(messages: DataFrame, watermark: str | None = None, dedup_key: str | None = None) -> DataFrame:
    """Parsed positions with ``event_ts`` (TIMESTAMP for the watermark) and ``event_date``."""
    v = PA.vehicles(messages).withColumn("event_ts", to_event_time("event_time")) \
        .withColumn("event_date", F.to_date("event_time"))
    if watermark:
        v = v.withWatermark("event_ts", watermark)
        if dedup_key:
            v = v.dropDuplicatesWithinWatermark([dedup_key])  # T7
    return v


def vehicle_job(messages: DataFrame, out_root: str, checkpoint: str, watermark: str | None = None,
                dedup_key: str | None = None, available_now: bool = False,
                name: str = "vehicles", unseen_key: str | None = None, writers: tuple = ()) -> StreamingQuery:
    """History (append, by event date) + newest row per vehicle + rejects.

    A message is decoded once, in the stream; the writers split the batch. With
    ``dedup_key`` the stream itself must hold parsed rows, so rejected messages
    are then stored by a ``rejects_job`` next to this one. With ``unseen_key``
    rows that the history holds already are dropped, however old they are
    (a feed replayed under a new checkpoint). ``writers`` get the batch's
    parsed rows too, such as ``sketch_writer``.
    """
    more = writers
    history_table = f"{out_root}/{HISTORY}"

    def history(rows, bid, qid):
        rows, seen = K.observed(rows, "event_time")
        K.append_by_date(rows.withColumn(HISTORY_CELL, cell("latitude", "longitude")), bid, history_table, qid=qid)
        K.append_health(messages.sparkSession, seen, bid, f"{out_root}/health/vehicles", qid)

    def latest(rows, bid, qid):
        K.upsert_latest(rows.drop("event_date"), bid, latest_path(out_root, "vehicles"), list(SC.feed("vehicles").key),
                        LATEST_ORDER["vehicles"], qid=qid)

    def store(rows, bid, qid):
        if unseen_key:
            rows = K.unseen(rows, bid, history_table, unseen_key, qid=qid)
        rows = rows.persist()
        try:
            history(rows, bid, qid)
            latest(rows, bid, qid)
            for w in more:
                w(rows, bid, qid)
        finally:
            rows.unpersist()

    def parsed(batch, bid, qid):
        store(K.stamp(parsed_vehicles(batch)).drop("event_ts"), bid, qid)

    if dedup_key:
        source, writers = K.stamp(parsed_vehicles(messages, watermark, dedup_key)).drop("event_ts"), [store]
    else:
        source, writers = PA.decode(messages, SC.VEHICLE_ENVELOPE), [parsed, _rejects_writer("vehicles", out_root)]
    return _start(source, K.fan_out(writers), name, f"{checkpoint}/{name}", trigger_options("vehicles", available_now))


def latest_path(out_root: str, kind: str) -> str:
    return f"{out_root}/vehicle_latest" if kind == "vehicles" else f"{out_root}/{SC.feed(kind).tables[0]}_latest/{kind}"


def row_schema(spark: SparkSession, kind: str):
    """Schema of a feed's stored rows."""
    parser = PA.vehicles if kind == "vehicles" else PARSERS[kind]
    return K.stamp(parser(spark.createDataFrame([], SC.MESSAGE))).schema


def read_latest(spark: SparkSession, out_root: str, kind: str) -> DataFrame:
    """The newest row per key of a feed, and its keyless rows."""
    return K.read_latest(spark, latest_path(out_root, kind), row_schema(spark, kind), list(SC.feed(kind).key), LATEST_ORDER[kind])


def fold_latest(spark: SparkSession, out_root: str, kind: str) -> int:
    """Fold a feed's change folders (an ordinary job, see ``streaming.upkeep``)."""
    return UP.fold_latest(spark, latest_path(out_root, kind), row_schema(spark, kind), list(SC.feed(kind).key), LATEST_ORDER[kind])


DAYS = "vehicle_days"


def summarize_days(spark: SparkSession, out_root: str, before) -> list[str]:
    """The newest row per vehicle of each closed day that has none yet, and keyless rows (an ordinary job).

    A day is scanned once, when it is new. ``before`` closes a day, as for ``pack_history``.
    """
    table, done = f"{out_root}/{DAYS}", []
    have = set(K.stored_days(spark, table))
    for day in K.stored_days(spark, f"{out_root}/{HISTORY}"):
        if day[:1].isdigit() and day < str(before)[:10] and day not in have:
            rows = read_history(spark, out_root, day, day).drop(K.FROM_BATCH)
            newest = latest_by_key(rows, list(SC.feed("vehicles").key), LATEST_ORDER["vehicles"])
            newest.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(K.DATE_COL).parquet(table)
            done.append(day)
    return done


def latest_from_days(spark: SparkSession, out_root: str, last=None) -> DataFrame:
    """The newest row per vehicle up to the day ``last``: summarized days, and the history of the others."""
    table = f"{out_root}/{DAYS}"
    schema = row_schema(spark, "vehicles").add(HISTORY_CELL, "long").add(K.DATE_COL, "date")
    have = set(K.stored_days(spark, table))
    limit = str(last or "9999-99-99")[:10]
    days = [d for d in K.stored_days(spark, f"{out_root}/{HISTORY}") if not d[:1].isdigit() or d <= limit]
    part = K.read_days(spark, table, days=[d for d in days if d in have], schema=schema)
    new = K.read_days(spark, f"{out_root}/{HISTORY}", days=[d for d in days if d not in have], schema=schema)
    return latest_by_key(part.unionByName(new), list(SC.feed("vehicles").key), LATEST_ORDER["vehicles"])


def read_history(spark: SparkSession, out_root: str, first=None, last=None) -> DataFrame:
    """The vehicle history, or its days from ``first`` to ``last``: no other day is listed or read."""
    schema = row_schema(spark, "vehicles").add(HISTORY_CELL, "long").add(K.FROM_BATCH, "string").add(K.DATE_COL, "date")
    return K.read_days(spark, f"{out_root}/{HISTORY}", first, last, schema=schema)


def pack_history(spark: SparkSession, out_root: str, before, file_bytes: int = UP.FILE_BYTES) -> list[str]:
    """Rewrite closed days as full files in Z-order, so that a box search skips row groups (an ordinary job)."""
    return UP.pack_days(spark, f"{out_root}/{HISTORY}", before, file_bytes, HISTORY_CELL)


def _rejects_writer(kind: str, out_root: str):
    def rejects(batch, bid, qid):
        bad = PA.rejected(batch)
        if not bad.isEmpty():
            K.append_batch(bad, bid, f"{out_root}/rejects/{kind}", qid=qid)
    return rejects


def rejects_job(messages: DataFrame, kind: str, out_root: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Store a feed's rejected messages alone (next to a job that holds parsed rows)."""
    bad = PA.decode(messages, SC.feed(kind).envelope).filter(~F.col("_valid"))
    return _start(bad, K.fan_out([_rejects_writer(kind, out_root)]), f"{kind}_rejects", f"{checkpoint}/{kind}_rejects",
                  trigger_options(kind, available_now))


REJECTS = "feed string, key string, raw string, reason string"


def read_rejects(spark: SparkSession, out_root: str, kind: str) -> DataFrame:
    table = f"{out_root}/rejects/{kind}"
    if not K.has_rows(spark, table):
        return spark.createDataFrame([], REJECTS)
    return K.read_appended(spark, table, REJECTS).drop(K.BATCH_COL)


def windowed_route_counts(parsed: DataFrame, watermark: str, window: str = STATS_WINDOW) -> DataFrame:
    """Per (window, line, route) running counts; needs a watermark for bounded state."""
    w = F.window(F.col("event_ts"), window)
    g = (parsed.withWatermark("event_ts", watermark)
         .groupBy(w.alias("w"), "line_id", "route_id").agg(F.count(F.lit(1)).alias("count")))
    return g.select(to_wall_time(F.col("w.start")).alias("window_start"),
                    to_wall_time(F.col("w.end")).alias("window_end"), "line_id", "route_id", "count")


def route_stats_job(messages: DataFrame, out_root: str, checkpoint: str, watermark: str,
                    available_now: bool = False, name: str = "route_stats") -> StreamingQuery:
    """Update-mode window counts, appended per batch and reduced by max on read."""
    counts = windowed_route_counts(parsed_vehicles(messages), watermark)

    def store(batch, bid, qid):
        K.merge_max(batch, bid, f"{out_root}/route_stats", qid=qid)

    return (counts.writeStream.queryName(name).outputMode("update").foreachBatch(K.fan_out([store]))
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(**trigger_options("vehicles", available_now)).start())


def read_route_stats(spark: SparkSession, out_root: str) -> DataFrame:
    return K.read_max(spark, f"{out_root}/route_stats", ["window_start", "window_end", "line_id", "route_id"],
                      "count", SC.ROUTE_STATS)


def route_windows_job(messages: DataFrame, out_root: str, checkpoint: str, watermark: str,
                      available_now: bool = False, name: str = "route_windows") -> StreamingQuery:
    """T8 in append mode: a window is stored once, when the watermark passes its end (T6: later rows of it are dropped).

    Stored rows = closed windows, by the day of their start; nothing is updated or folded.
    """
    counts = windowed_route_counts(parsed_vehicles(messages), watermark).withColumn("window_date", F.to_date("window_start"))

    def store(batch, bid, qid):
        K.append_by_date(batch, bid, f"{out_root}/route_windows", "window_date", qid=qid)

    return (counts.writeStream.queryName(name).outputMode("append").foreachBatch(K.fan_out([store]))
            .option("checkpointLocation", f"{checkpoint}/{name}")
            .trigger(**trigger_options("vehicles", available_now)).start())


def read_route_windows(spark: SparkSession, out_root: str, first=None, last=None) -> DataFrame:
    """Closed windows, of all days or of those from ``first`` to ``last``."""
    schema = SC.struct(*((f.name, f.dataType) for f in SC.ROUTE_STATS.fields), ("window_date", T.DateType()))
    return K.read_days(spark, f"{out_root}/route_windows", first, last, schema=schema, date_col="window_date").select(*SC.ROUTE_STATS.names)


def read_route_counts(spark: SparkSession, out_root: str) -> DataFrame:
    """Closed windows as stored, and the running counts of those still open (``closed`` tells them apart)."""
    done = read_route_windows(spark, out_root)
    end = done.agg(F.max("window_end")).scalar()
    running = read_route_stats(spark, out_root).filter(F.coalesce(F.col("window_end") > end, F.lit(True)))
    return done.withColumn("closed", F.lit(True)).unionByName(running.withColumn("closed", F.lit(False)))


def fold_route_stats(spark: SparkSession, out_root: str, closed: bool = True) -> int:
    """Fold the running counts (an ordinary job); with ``closed``, windows stored by ``route_windows_job`` leave them."""
    end = read_route_windows(spark, out_root).agg(F.max("window_end")).first()[0] if closed else None
    return UP.fold_counts(spark, f"{out_root}/route_stats", ["window_start", "window_end", "line_id", "route_id"], "count", end)


PARSERS = {
    "alerts": PA.alerts,
    "equipment": PA.equipment,
    "trip_updates": lambda m: PA.stop_times(PA.trip_updates(m)),
    "outages_current": lambda m: PA.outages(m, "current"),
    "outages_upcoming": lambda m: PA.outages(m, "upcoming"),
}

def feed_job(messages: DataFrame, kind: str, out_root: str, checkpoint: str, available_now: bool = False,
             rejects: bool = True) -> StreamingQuery:
    """Store one non-vehicle feed: append every version (K1), keep the batch's
    newest version per key (A14/K2), rejected messages (P4)
    and the time of the newest poll (an empty poll has no rows to tell it).

    A message is decoded once, in the stream, and never kept in memory: the batch's rows
    are written as they come, and its newest versions are taken from what was written.
    Only a batch with rejected messages is decoded again, for these."""
    f = SC.feed(kind)
    table = f.tables[0]

    def store(batch, bid, qid):
        spark = batch.sparkSession
        told = Observation()
        batch_seen = batch.observe(told, F.max(F.when(F.col("_valid"), F.col("msg.timestamp"))).alias("poll_time"),
                                   F.count_if(~F.col("_valid")).alias("n_rejected"))
        rows = K.stamp(PARSERS[kind](batch_seen))
        written, seen = K.observed(rows, HEALTH_TIME.get(kind, "processed_at"))
        target = K.append_batch(written, bid, f"{out_root}/{table}", qid=qid)
        K.append_health(spark, seen, bid, f"{out_root}/health/{kind}", qid)
        if kind in LATEST_ORDER:
            K.upsert_latest(spark.read.schema(rows.schema).parquet(target), bid, latest_path(out_root, kind), list(f.key),
                            LATEST_ORDER[kind], qid=qid, few=True)
        got = told.get
        polled = spark.createDataFrame([(got["poll_time"],)], "poll_time bigint")
        K.append_batch(polled.coalesce(1), bid, f"{out_root}/polls/{kind}", qid=qid)
        if rejects and got["n_rejected"]:
            _rejects_writer(kind, out_root)(batch, bid, qid)

    return _start(PA.decode(messages, f.envelope), K.fan_out([store], persist=False), kind, f"{checkpoint}/{kind}",
                  trigger_options(kind, available_now))


def await_all(spark: SparkSession, queries: list[StreamingQuery], timeout_s: float | None = None) -> None:
    """Wait until all queries have ended; the first failure among them stops the rest and is raised.

    With ``timeout_s``, TimeoutError is raised if some still run by then; they
    are left running, so nothing is stopped half way.

    The session's "any termination" signal also fires for other queries (and
    keeps an old failure until reset), so it only wakes us up: failures are
    read from these queries themselves, also when they ended before the wait.
    """
    deadline = None if timeout_s is None else time.monotonic() + timeout_s
    try:
        while any(q.isActive for q in queries):
            left = None if deadline is None else deadline - time.monotonic()
            if left is not None and left <= 0:
                running = ", ".join(q.name or str(q.id) for q in queries if q.isActive)
                raise TimeoutError(f"still running after {timeout_s} s: {running}")
            try:
                spark.streams.awaitAnyTermination(left)
            except Exception:  # raised for any failed query of the session; ours are checked below
                pass
            spark.streams.resetTerminated()
            _raise_first_failure(queries)
        _raise_first_failure(queries)
    finally:
        if any((not q.isActive) and q.exception() is not None for q in queries):
            for q in queries:
                if q.isActive:
                    q.stop()


def _raise_first_failure(queries: list[StreamingQuery]) -> None:
    for q in queries:
        if not q.isActive and q.exception() is not None:
            raise q.exception()
