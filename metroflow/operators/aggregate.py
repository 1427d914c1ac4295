"""Aggregations (A1-A16) as reusable DataFrame steps.

Counts and min/max reduce partially in each map task before the exchange,
so hot keys (a route holding a third of all rows) cost one row per task in
the shuffle. Maps are returned as sorted ``k:v`` strings built from the
already-reduced groups, never from raw rows (see ``plans.api.vehicle_figures``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def count_by(df: DataFrame, *keys: str, name: str = "count") -> DataFrame:
    """Rows per key, sorted by key."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).orderBy(*keys)


def windowed_count(df: DataFrame, ts: str, duration: str, *keys: str, name: str = "count") -> DataFrame:
    """A10: rows per (tumbling window, keys); window bounds as columns."""
    w = F.window(F.col(ts), duration)
    return (df.groupBy(w.alias("w"), *keys)
            .agg(F.count(F.lit(1)).alias(name))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), *keys, name))


SKETCH_LG_K = 12  # 4096 registers: a relative standard error of 1.04 / sqrt(4096) = 1.6 %


def distinct_sketches(df: DataFrame, ts: str, duration: str, value: str, *keys: str) -> DataFrame:
    """An HLL sketch of the distinct values per (tumbling window, keys): a few kB that merge with any others."""
    w = F.window(F.col(ts), duration)
    return (df.filter(F.col(value).isNotNull()).groupBy(w.alias("w"), *keys)
            .agg(F.hll_sketch_agg(value, F.lit(SKETCH_LG_K)).alias("sketch"))
            .select(F.col("w.start").alias("window_start"), *keys, "sketch"))


def merged_distinct(sketches: DataFrame, *keys: str, sigmas: float = 3.0) -> DataFrame:
    """Estimate of the distinct values over any set of sketches, with bounds of ``sigmas`` standard errors."""
    error = sigmas * 1.04 / (1 << SKETCH_LG_K) ** 0.5
    got = sketches.groupBy(*keys).agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("estimate"))
    return got.withColumns({"low": F.floor(F.col("estimate") / (1 + error)), "high": F.ceil(F.col("estimate") / (1 - error))})


def bounds(df: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Bounding box."""
    return df.agg(F.min(lat).alias("min_lat"), F.max(lat).alias("max_lat"),
                  F.min(lon).alias("min_lon"), F.max(lon).alias("max_lon"))


def share(part: Column, whole: Column, digits: int = 2) -> Column:
    """Percentage part/whole rounded; null when whole is 0."""
    return F.round(F.try_divide(part.cast("double") * 100.0, whole.cast("double")), digits)
