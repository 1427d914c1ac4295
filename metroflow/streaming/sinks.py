"""Micro-batch sinks (K1-K5, K7), idempotent under retries.

A batch that fails is retried with the same batch id, and after a restart
from the checkpoint a batch may run again. Every write is therefore named by
``<query id>-<batch id>`` and replaces itself:

* ``append_batch`` (K1) overwrites ``<table>/batch=<tag>``; readers see the
  union of batch folders.
* ``append_by_date`` (K1) is the same for histories with an event date, laid
  out date first: ``<table>/event_date=<day>/batch=<tag>``, by dynamic
  partition overwrite. ``read_days`` lists the folders of the days it is
  asked for and no others.
* ``upsert_latest`` (K2/K3) appends the batch's newest row per key. The
  newest row of all batches is the same ``max_by`` on read: late, repeated
  and retried rows cannot change it, so a batch costs O(batch) and nothing
  has to be swapped. Rows without a key are kept as they are, never merged.
* ``merge_max`` appends monotone counters (windowed counts in update mode);
  they are reduced by ``max`` when read.

What is appended is folded by the ordinary jobs of ``streaming.upkeep``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from metroflow.operators.state import latest_by_key, latest_of_few, present

BATCH_COL = "batch"
DATE_COL = "event_date"
FROM_BATCH = "from_batch"


def query_id(df: DataFrame) -> str:
    """Id of the streaming query running this ``foreachBatch`` call ('batch' outside a stream)."""
    sc = df.sparkSession.sparkContext
    return sc.getLocalProperty("sql.streaming.queryId") or "batch"


def stamp(df: DataFrame, now: Column | None = None) -> DataFrame:
    """K7: processing-time column (injectable for tests)."""
    return df.withColumn("processed_at", now if now is not None else F.current_timestamp())


# --- folder names, over the Hadoop FileSystem (any cluster store) ---------------

def file_system(spark: SparkSession, path: str):
    """The store of ``path`` and the path in it."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, hidden ones left out; none if it isn't there."""
    fs, p = file_system(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(n for n in names if not n.startswith(("_", ".")))


def has_rows(spark: SparkSession, table: str) -> bool:
    """Whether any batch has been appended to the table."""
    return bool(list_names(spark, table))


# --- K1 -----------------------------------------------------------------------

def append_batch(batch: DataFrame, batch_id: int, table: str, partition_by: list[str] | None = None,
                 qid: str | None = None) -> str:
    """K1: write the batch to its own folder; a retried batch overwrites only itself."""
    qid = qid or query_id(batch)
    target = f"{table}/{BATCH_COL}={qid}-{batch_id}"
    w = batch.write.mode("overwrite").option("compression", "zstd")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(target)
    return target


def read_appended(spark: SparkSession, table: str, schema=None) -> DataFrame:
    """All batch folders of an appended table (``batch`` and partition columns included)."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    return r.option("basePath", table).parquet(f"{table}/{BATCH_COL}=*")


def append_by_date(batch: DataFrame, batch_id: int, table: str, date_col: str = DATE_COL, qid: str | None = None) -> None:
    """K1 for histories: one folder per day and batch. A retried batch overwrites its own folders.

    No shuffle by day: a live batch is nearly all of one day. The rows carry
    their batch (``from_batch``), which packing a day keeps.
    """
    tag = f"{qid or query_id(batch)}-{batch_id}"
    (batch.withColumns({FROM_BATCH: F.lit(tag), BATCH_COL: F.lit(tag)}).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(date_col, BATCH_COL).parquet(table))


def stored_days(spark: SparkSession, table: str, date_col: str = DATE_COL) -> list[str]:
    """The days that a table by date holds, from its folder names."""
    head = f"{date_col}="
    return [n[len(head):] for n in list_names(spark, table) if n.startswith(head)]


def read_days(spark: SparkSession, table: str, first=None, last=None, days: list | None = None, schema=None,
              date_col: str = DATE_COL) -> DataFrame:
    """Rows of a table by date: of all days, of those from ``first`` to ``last``, or of ``days``.

    Only the folders of those days are listed and read. Rows without a date
    (no event time) are in a table's whole reading only.
    """
    have = stored_days(spark, table, date_col)
    if days is not None:
        wanted = {str(d) for d in days}
        have = [d for d in have if d in wanted]
    elif first is not None or last is not None:
        lo, hi = str(first or "0000-00-00")[:10], str(last or "9999-99-99")[:10]
        have = [d for d in have if d[:1].isdigit() and lo <= d <= hi]
    if not have:
        if schema is None:
            raise ValueError(f"no such days in {table}, and no schema")
        return spark.createDataFrame([], schema)
    r = spark.read if schema is None else spark.read.schema(schema)
    rows = r.option("basePath", table).parquet(*[f"{table}/{date_col}={d}" for d in have])
    return rows if schema is None else rows.select(*spark.createDataFrame([], schema).columns)


# --- K2/K3 ----------------------------------------------------------------------

KEYED = "keyed"


def upsert_latest(batch: DataFrame, batch_id: int, root: str, key: list[str], order: list[str],
                  qid: str | None = None, few: bool = False) -> None:
    """K2/K3: append the batch's newest row per key, and its keyless rows, under ``root``.

    ``few``: keys seldom repeat within the batch (see ``latest_of_few``).
    """
    has_key = F.lit(True)
    for k in key:
        has_key = has_key & present(k)
    newest = (latest_of_few if few else latest_by_key)(batch, key, order).withColumn(KEYED, has_key)
    append_batch(newest, batch_id, root, [KEYED], qid=qid)


def read_latest(spark: SparkSession, root: str, schema, key: list[str], order: list[str]) -> DataFrame:
    """The newest row per key over all batches, and the keyless rows: one scan, one aggregate."""
    if not has_rows(spark, root):
        return spark.createDataFrame([], schema)
    rows = read_appended(spark, root, schema)
    return latest_by_key(rows.select(*[f.name for f in schema.fields]), key, order)


# --- counters ---------------------------------------------------------------------

def merge_max(batch: DataFrame, batch_id: int, table: str, qid: str | None = None) -> None:
    """Append update-mode rows of monotone counters (reduced on read by ``read_max``)."""
    append_batch(batch, batch_id, table, qid=qid)


def newest_counts(rows: DataFrame, key: list[str], value: str) -> DataFrame:
    """Each query's newest (greatest) value per key; ``_qid`` is the query of a row's batch."""
    qid = F.regexp_extract(BATCH_COL, r"^(.*)-[0-9]+$", 1)
    return rows.groupBy(*key, qid.alias("_qid")).agg(F.max(value).alias(value))


def read_max(spark: SparkSession, table: str, key: list[str], value: str, schema=None) -> DataFrame:
    """Value per key of an update-mode counter table: each query's newest (its greatest), summed over queries.

    A query id stands for one checkpoint, whose counts start from zero. To read
    the same input again under a new checkpoint, use a new table.
    """
    if not has_rows(spark, table):
        if schema is None:
            raise ValueError(f"empty table {table} and no schema")
        return spark.createDataFrame([], schema)
    return newest_counts(read_appended(spark, table), key, value).groupBy(*key).agg(F.sum(value).alias(value))


# --- A15: health, measured while a batch is written ------------------------------------------

HEALTH = "n_rows bigint, last_event timestamp_ntz, processed_at timestamp"


def observed(rows: DataFrame, event_col: str) -> tuple[DataFrame, Observation]:
    """``rows`` that count themselves while a write reads them: no second pass, no scan of the table later."""
    seen = Observation()
    return rows.observe(seen, F.count(F.lit(1)).alias("n_rows"), F.max(event_col).alias("last_event"),
                        F.max("processed_at").alias("processed_at")), seen


def append_health(spark: SparkSession, seen: Observation, batch_id: int, table: str, qid: str) -> None:
    """One row of figures per batch, replaced by a retry like the batch itself."""
    got = seen.get
    row = spark.createDataFrame([(got["n_rows"], got["last_event"], got["processed_at"])], HEALTH)
    append_batch(row.coalesce(1), batch_id, table, qid=qid)


def read_health(spark: SparkSession, table: str) -> DataFrame:
    """One row: rows written, newest event, newest processing time of a component."""
    rows = read_appended(spark, table, HEALTH) if has_rows(spark, table) else spark.createDataFrame([], HEALTH)
    return rows.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.max("last_event").alias("last_event"),
                    F.max("processed_at").alias("processed_at"))


# --- T7 beyond the watermark ------------------------------------------------------------

def unseen(batch: DataFrame, batch_id: int, table: str, key: str, date_col: str = DATE_COL, qid: str | None = None) -> DataFrame:
    """The batch's rows whose ``key`` the history by date doesn't hold yet, one per key and day.

    A repeat has the day of its original, so only the days of the batch are
    read, two columns of them. Rows this very batch stored before a retry do
    not count as seen. Rows without a key or day cannot be told and stay.
    """
    spark = batch.sparkSession
    tag = f"{qid or query_id(batch)}-{batch_id}"
    known = present(key) & F.col(date_col).isNotNull()
    once = batch.filter(known).dropDuplicates([date_col, key]).unionByName(batch.filter(~known))
    days = [str(r[0]) for r in batch.select(date_col).distinct().collect()]  # of one batch: a few days
    schema = f"{key} {batch.schema[key].dataType.simpleString()}, {FROM_BATCH} string, {date_col} date"
    stored = read_days(spark, table, days=days, schema=schema, date_col=date_col).filter(F.col(FROM_BATCH) != tag)
    return once.join(stored.select(date_col, key), [date_col, key], "left_anti").select(*batch.columns)


# --- K4/K5 --------------------------------------------------------------------------

def fan_out(writers, persist: bool = True):
    """K4 + K5: a ``foreachBatch`` function that persists the batch once (unless a single
    writer reads it once), skips it when empty, and hands it to every writer ``(batch_df, batch_id, qid)``."""
    def run(batch: DataFrame, batch_id: int) -> None:
        qid = query_id(batch)
        if persist:
            batch.persist()
        try:
            if batch.isEmpty():
                return
            for w in writers:
                w(batch, batch_id, qid)
        finally:
            if persist:
                batch.unpersist()
    return run
