"""Ordinary jobs that keep the streams' tables small: run them now and then beside the streams.

None of them changes an answer. What a fold writes can be read beside what
it folds (a maximum of maxima), so it needs no lock and may stop anywhere:
the next run folds what is left. A fold deletes what the fold before it had
covered, so a reader that listed a table keeps its files until two folds
later.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflow.operators.state import latest_by_key
from metroflow.streaming import sinks as K

FILE_BYTES = 256 << 20


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = K.file_system(spark, path)
    fs.delete(p, True)


def _covered(spark: SparkSession, table: str) -> list[str]:
    """Folders that an earlier fold covered; the list is a one-column text table beside them."""
    path = f"{table}/_covered"
    fs, p = K.file_system(spark, path)
    return [r[0] for r in spark.read.text(path).collect()] if fs.exists(p) else []


def _folded(spark: SparkSession, table: str, rows: DataFrame, names: list[str], tag: str, partition_by: list[str]) -> None:
    """Write ``rows`` as the folder ``tag``, delete what the last fold covered and note what this one does."""
    before = _covered(spark, table)
    rows.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{table}/{K.BATCH_COL}={tag}")
    for n in before:
        _delete(spark, f"{table}/{n}")
    left = [n for n in names if n not in before]
    spark.createDataFrame([(n,) for n in left], "value string").coalesce(1).write.mode("overwrite").text(f"{table}/_covered")


def fold_latest(spark: SparkSession, root: str, schema, key: list[str], order: list[str]) -> int:
    """Fold the change folders of a latest-state table (K2) into one row per key; how many folders it covered.

    Keyless rows aren't versions of anything: they stay where they are.
    """
    names = [n for n in K.list_names(spark, root) if f"{K.KEYED}=true" in K.list_names(spark, f"{root}/{n}")]
    if len(names) < 2:
        return 0
    columns = [f.name for f in schema.fields]
    rows = spark.read.schema(schema).option("basePath", root).parquet(*[f"{root}/{n}/{K.KEYED}=true" for n in names])
    newest = latest_by_key(rows.select(*columns), key, order, keep_keyless=False).withColumn(K.KEYED, F.lit(True))
    covered = [f"{n}/{K.KEYED}=true" for n in names]
    _folded(spark, root, newest, covered, f"fold-{uuid.uuid4().hex}", [K.KEYED])
    return len(names)


def fold_counts(spark: SparkSession, table: str, key: list[str], value: str, closed_before=None, end_col: str = "window_end") -> int:
    """Fold an update-mode counter table into one row per key and query; how many folders it covered.

    With ``closed_before`` (a time), windows that ended by then are left out:
    they are final in the table of closed windows. A folded row keeps the query of its
    counts: folder names end in a number, and a fold's is above all batch ids.
    """
    names = K.list_names(spark, table)
    if len(names) < 2:
        return 0
    rows = spark.read.option("basePath", table).parquet(*[f"{table}/{n}" for n in names])
    if closed_before is not None:
        rows = rows.filter(F.col(end_col) > F.lit(closed_before).cast("timestamp_ntz"))
    newest = K.newest_counts(rows, key, value)
    no = F.lit(f"-{10**15 + uuid.uuid4().int % 10**15}")
    before = _covered(spark, table)
    newest.withColumn(K.BATCH_COL, F.concat("_qid", no)).drop("_qid").write.mode("overwrite") \
        .option("partitionOverwriteMode", "dynamic").partitionBy(K.BATCH_COL).parquet(table)
    for n in before:
        _delete(spark, f"{table}/{n}")
    spark.createDataFrame([(n,) for n in names if n not in before], "value string").coalesce(1).write.mode("overwrite").text(f"{table}/_covered")
    return len(names)


def pack_days(spark: SparkSession, table: str, before, file_bytes: int = FILE_BYTES, sort_by: str | None = None,
              date_col: str = K.DATE_COL) -> list[str]:
    """Rewrite each day before ``before`` that holds more than one folder as files of about ``file_bytes``; the days packed.

    With ``sort_by`` a day is range-partitioned and sorted by that column, so
    its files and row groups hold narrow ranges of it. Rows are the same, each with
    its ``from_batch``. Days must be closed: behind the watermark, so that no
    batch writes to them.

    A day is written aside first and then takes the place of the folders it
    was read from. If the job stops in between, the next run finishes that day: what
    was written aside tells by ``from_batch`` which folders it replaces.
    """
    aside = f"{table}/_packed"
    for day in [d for d in K.stored_days(spark, aside, date_col)]:
        fs, p = K.file_system(spark, f"{aside}/{date_col}={day}/_SUCCESS")
        if fs.exists(p):
            _replace(spark, table, aside, day, date_col)
        else:
            _delete(spark, f"{aside}/{date_col}={day}")
    done = []
    for day in K.stored_days(spark, table, date_col):
        folder = f"{table}/{date_col}={day}"
        if not day[:1].isdigit() or day >= str(before)[:10] or len(K.list_names(spark, folder)) < 2:
            continue
        fs, p = K.file_system(spark, folder)
        files = max(1, -(-fs.getContentSummary(p).getLength() // file_bytes))
        rows = spark.read.parquet(folder).drop(K.BATCH_COL)
        rows = rows.repartitionByRange(files, sort_by).sortWithinPartitions(sort_by) if sort_by else rows.coalesce(files)
        rows.write.mode("overwrite").parquet(f"{aside}/{date_col}={day}")
        _replace(spark, table, aside, day, date_col)
        done.append(day)
    return done


def _replace(spark: SparkSession, table: str, aside: str, day: str, date_col: str) -> None:
    new, folder = f"{aside}/{date_col}={day}", f"{table}/{date_col}={day}"
    held = {r[0] for r in spark.read.parquet(new).select(K.FROM_BATCH).distinct().collect()}
    for n in K.list_names(spark, folder):
        own = n.partition("=")[2]
        if own in held or own.startswith("packed-"):
            _delete(spark, f"{folder}/{n}")
    fs, source = K.file_system(spark, new)
    target = K.file_system(spark, f"{folder}/{K.BATCH_COL}=packed-{uuid.uuid4().hex}")[1]
    fs.mkdirs(target.getParent())
    if not fs.rename(source, target):
        raise OSError(f"could not move {new} to {target}")
