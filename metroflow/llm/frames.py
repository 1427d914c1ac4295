"""Helpers on DataFrames shared by the operators: written cuts of lineage, groups streamed in a task, components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflow.session import fresh_dir


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read again: later jobs survive lost executors without redoing it."""
    spark = df.sparkSession
    path = fresh_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_hash(text_col: str) -> Column:
    """A hash of the text, which tells rows of one id (or of none) apart."""
    return F.xxhash64(F.col(text_col).cast("string"))


def group_map(df: DataFrame, keys: list[str], fn: Callable[[tuple, Iterator[pa.Table]], Iterator[pa.RecordBatch]],
              schema: str, order: list[str] | None = None, parts: int | None = None) -> DataFrame:
    """Run ``fn(key, tables)`` for each group. Groups of a partition are streamed one after another, their rows in ``order``.
    ``parts``: how many partitions to deal the groups to, for rows that are large (else Spark's settings decide).

    ``fn`` gets a group as an iterator of tables, so that it decides what to hold.
    """
    dealt = df.repartition(parts, *keys) if parts else df.repartition(*keys)
    dealt = dealt.sortWithinPartitions(*keys, *(order or []))

    def run(batches):
        yield from _streamed(batches, keys, fn)

    return dealt.mapInArrow(run, schema)


def _streamed(batches, keys, fn):
    pieces = _pieces(batches, keys)
    ahead = next(pieces, None)
    while ahead is not None:
        key = ahead[0]
        state = [ahead]

        def own():
            while state[0] is not None and state[0][0] == key:
                table = state[0][1]
                state[0] = next(pieces, None)
                yield table

        group = own()
        yield from fn(key, group)
        for _ in group:  # what fn left unread
            pass
        ahead = state[0]


def _pieces(batches, keys):
    for batch in batches:
        if not batch.num_rows:
            continue
        cols = [batch.column(k).to_pylist() for k in keys]
        rows = list(zip(*cols))
        first = 0
        for i in range(1, len(rows) + 1):
            if i == len(rows) or rows[i] != rows[first]:
                yield rows[first], batch.slice(first, i - first)
                first = i


def join_counted(rows: DataFrame, groups: DataFrame, keys: list[str], n_col: str = "n", share: int = 1000, how: str = "left") -> DataFrame:
    """``rows`` joined with ``groups`` (one row per key, ``n_col`` its number of rows) so that no key's rows go to one task.

    Keys with over 1/``share`` of the rows of ``groups`` are fewer than ``share``: they're broadcast, and their rows
    spread over as many salted keys as there are shuffle partitions. Null keys meet nothing. The salt is a hash of the
    row's keyed-on and plain columns, so a task that runs again deals its rows alike.
    """
    spark = rows.sparkSession
    groups = written(groups, "counted")
    total = groups.agg(F.coalesce(F.sum(n_col), F.lit(0))).first()[0]
    hot = groups.where(F.col(n_col) * share > total).select(*keys, F.lit(partitions(spark)).alias("__salts"))
    plain = [f.name for f in rows.schema.fields if f.dataType.typeName() not in ("map", "variant")]
    dealt = rows.join(F.broadcast(hot), keys, "left").withColumn(
        "__salt", F.coalesce(F.pmod(F.xxhash64(*plain), F.col("__salts")), F.lit(0).cast("long"))).drop("__salts")
    spread = groups.join(F.broadcast(hot), keys, "left").withColumn(
        "__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.coalesce("__salts", F.lit(1)).cast("long") - 1))).drop("__salts")
    return dealt.join(spread, [*keys, "__salt"], how).drop("__salt")


def components(edges: DataFrame, a: str = "a", b: str = "b", name: str = "components") -> DataFrame:
    """Connected components of undirected ``edges``: one row (node, label) per node of an edge; label is its smallest node.

    Alternating large-star and small-star rounds. Every step is a minimum per
    node, pre-aggregated before its shuffle, and a join that AQE can split on
    a hot node; each round is written to the shared folder. Rounds grow with
    the logarithm of the longest chain.
    """
    spark = edges.sparkSession
    e = written(edges.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).where("u < v").distinct(), name)
    if e.isEmpty():
        return e.select(F.col("u").alias("node"), F.col("v").alias("label"))
    before = None
    while True:
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()  # u > v: each node to a smaller one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.explode(F.array(
            F.struct(F.col("u").alias("u"), F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*")
        e = written(small.where("u <> v").distinct(), name).select(F.col("v").alias("u"), F.col("u").alias("v"))
        now = e.agg(F.count(F.lit(1)), F.countDistinct("v"), F.sum(F.hash("u", "v").cast("long"))).first()
        if now == before and now[0] == now[1]:  # a star: every node but the centres has one edge, and no round changes it
            break
        before = now
    labels = e.select(F.col("v").alias("node"), F.col("u").alias("label"))
    return labels.union(labels.select(F.col("label").alias("node"), "label").distinct())


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
