"""Latest state per key and de-duplication (A11, A14, K3, T7 batch twin).

``latest_by_key`` is one ``max_by`` aggregate: Spark runs a partial aggregate
in every map task before the exchange, so a key that holds a third of all rows
still sends one row per map task across the shuffle, never the whole group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType


def _as_list(x: str | list[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def present(key: str) -> Column:
    """K3: whether a row has this key; null and empty text are no key."""
    return F.col(key).isNotNull() & (F.col(key).cast("string") != "")


def latest_by_key(df: DataFrame, key: str | list[str], order: str | list[str], keep_keyless: bool = True) -> DataFrame:
    """Newest row per key, newest meaning the greatest ``order`` tuple.

    Rows whose key is null or empty are never merged: they are kept as they
    are (``keep_keyless``) or dropped. One scan and one aggregate serve both: a
    keyless row is a group of its own. Ties on ``order`` keep the row of the
    greatest hash over all columns but the processing time, so a retry keeps the same one.
    """
    keys, order_cols = _as_list(key), _as_list(order)
    cols = df.columns
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & present(k)
    src = df if keep_keyless else df.filter(has_key)
    row = F.when(~has_key, F.monotonically_increasing_id())
    tie = F.xxhash64(*[f.name for f in df.schema.fields if not isinstance(f.dataType, MapType) and f.name != "processed_at"])
    return (
        src.withColumn("_row", row).groupBy(*keys, "_row")
        .agg(F.max_by(F.struct(*cols), F.struct(*order_cols, tie.alias("_tie"))).alias("_latest"))
        .select("_latest.*")
    )


#: Repeated keys that are looked up in every task.
MOST_REPEATED = 100_000


def latest_of_few(df: DataFrame, key: str | list[str], order: str | list[str]) -> DataFrame:
    """``latest_by_key`` of rows whose keys seldom repeat, such as a poll's records.

    Only hashes of keys are shuffled first; then the rows of repeated ones alone, the others are the
    newest of their key as they are. Beyond ``MOST_REPEATED`` of these all rows go through the aggregate.
    ``df`` is read up to three times, so it should be stored rows.
    """
    keys = _as_list(key)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & present(k)
    named = df.withColumn("_key", F.when(has_key, F.xxhash64(*keys)))
    again = (named.where("_key is not null").groupBy("_key").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
             .select("_key").limit(MOST_REPEATED + 1))
    hashes = [r[0] for r in again.collect()]  # at most MOST_REPEATED + 1
    if not hashes:
        return df
    if len(hashes) > MOST_REPEATED:
        return latest_by_key(df, keys, order)
    repeated = df.sparkSession.createDataFrame([(h, True) for h in hashes], "_key long, _again boolean")
    marked = named.join(F.broadcast(repeated), "_key", "left")
    once, more = (marked.where(c).select(*df.columns) for c in (F.col("_again").isNull(), F.col("_again")))
    return once.unionByName(latest_by_key(more, keys, order))


def dedup(df: DataFrame, key: str | list[str]) -> DataFrame:
    """Drop repeated records: one row per key (map-side combined, one exchange)."""
    return df.dropDuplicates(_as_list(key))
