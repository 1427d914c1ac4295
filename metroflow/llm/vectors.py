"""Embedding columns as numpy matrices."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def valid(v: Column) -> Column:
    """Not null, not empty, all components finite and non-null, and not all zero."""
    ok = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(v) > 0) & ok & F.exists(v, lambda x: x != 0), F.lit(False))


def usable(df: DataFrame, id_col: str, vector_col: str, *more: str) -> DataFrame:
    """(id, v, size, ...) of the valid vectors; ``size`` is their length."""
    rows = df.where(valid(F.col(vector_col))).select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), *more)
    return rows.withColumn("size", F.size("v"))


def lengths(rows: DataFrame) -> list[int]:
    """The lengths that occur. Vectors of one table mostly have one: each further one is fitted and searched for itself."""
    return sorted(r[0] for r in rows.select("size").distinct().collect())


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of equal-length lists as a double matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 0))


def sample(rows: DataFrame, limit: int, salt: str) -> np.ndarray:
    """At most ``limit`` vectors, those of least keyed hash of their id."""
    got = rows.select("v", F.xxhash64("id", F.lit(salt)).alias("h"), "id").orderBy("h", "id").limit(limit).select("v").collect()
    return np.array([r[0] for r in got], np.float64)


def dots(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed alike wherever a row stands."""
    return (np.ascontiguousarray(x) * np.ascontiguousarray(y)).sum(1)
