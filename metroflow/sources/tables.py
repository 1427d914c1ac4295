"""Table scans (S3): Parquet tables of a data folder, read with explicit columns.

Column lists are explicit so the scan's ReadSchema holds only what a query
uses; filters written on top push down to the Parquet reader.

Tables are opened once per session (``opened``): the lazy relation and the
frames derived from it are kept, the way a Spark user registers a table once
and queries it many times. Nothing is cached in memory: each action re-reads
the files. ``refresh`` forgets the opened frames (new files in a folder).
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


_OPENED = "_metroflow_opened"


def opened(spark: SparkSession, key: tuple, build: Callable[[], DataFrame]) -> DataFrame:
    """The frame built once per session for ``key`` (a lazy plan, not data)."""
    memo = spark.__dict__.setdefault(_OPENED, {})
    df = memo.get(key)
    if df is None:
        df = memo[key] = build()
    return df


def refresh(spark: SparkSession) -> None:
    """Forget the opened tables, so the next query lists the folders again."""
    spark.__dict__.pop(_OPENED, None)


def per_session(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """Decorator: a ``(spark, sf_dir)`` source builder runs once per session and folder."""
    @functools.wraps(fn)
    def wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
        return opened(spark, (fn.__module__, fn.__qualname__, sf_dir.rstrip("/")), lambda: fn(spark, sf_dir))
    return wrapper


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    if name not in TABLE_NAMES:
        raise ValueError(f"unknown table {name!r}")
    path = table_path(sf_dir, name)
    df = opened(spark, ("table", path), lambda: spark.read.parquet(path))
    return df.select(*columns) if columns else df

