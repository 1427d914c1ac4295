"""Registry of named queries: each has a Spark builder ``(spark, sf_dir) -> DataFrame``
and, where the result is expressible in SQL, DuckDB oracle text over the
pre-registered tables of the data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

# Queries that write tables first (a drained feed, an index) and read them; all others are lazy.
STORED = ("stream_", "stored_")

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from metroflow.plans import queries  # noqa: F401
