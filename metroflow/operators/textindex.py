"""Substring search by trigram postings.

``build`` stores each distinct text once and postings of the distinct trigrams of
its lower-cased form, sorted by trigram, so a search reads the row groups of its
trigrams instead of all texts. A posting lists the texts of one block (some thousand
texts) that have the trigram: no row per text and trigram is made or moved. A term's trigrams are intersected (texts that
have all of them) and the texts left are checked for the term itself. Two
end marks behind each text start a trigram at every character, so a term of one or
two characters is a range of trigrams that begin with it.

A text is named by a hash; texts that share one are kept apart by the check.
Postings of a trigram that most texts have are split over files, and their
intersection is a count that combines in tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflow.operators.predicates import text_contains

END = "\u0000"
POSTINGS = "trigram string, text_ids array<long>"
#: Postings of a block, and the ways in which blocks with the same trigram are dealt out.
BLOCK, WAYS = 2_000_000, 8


def _id(text: Column | str) -> Column:
    return F.xxhash64(text)


def _block(ids: list[int], codes: list[np.ndarray]) -> pa.RecordBatch:
    """Postings of some texts, from each one's distinct trigrams as numbers."""
    each, who = np.concatenate(codes), np.repeat(np.array(ids, np.int64), [len(c) for c in codes])
    order = np.argsort(each, kind="stable")
    kinds, first = np.unique(each[order], return_index=True)
    chars = np.stack([kinds >> np.uint64(42), kinds >> np.uint64(21) & np.uint64(0x1FFFFF), kinds & np.uint64(0x1FFFFF)], 1)
    joined = chars.astype("<u4").tobytes().decode("utf-32-le")
    lists = pa.ListArray.from_arrays(pa.array(np.append(first, len(each)), pa.int32()), pa.array(who[order]))
    return pa.RecordBatch.from_arrays([pa.array([joined[k:k + 3] for k in range(0, len(joined), 3)], pa.string()), lists], ["trigram", "text_ids"])


def trigrams(batches):
    """(trigram, text_ids) of each block of (text_id, lower-cased text): the text's distinct pieces of
    three characters, one starting at each character, two end marks behind the text."""
    for b in batches:
        ids, codes, size = [], [], 0
        for k, t in zip(b.column("text_id").to_pylist(), b.column("low").to_pylist()):
            c = np.frombuffer((t + END + END).encode("utf-32-le"), "<u4").astype(np.uint64)
            ids.append(k)
            codes.append(np.unique(c[:-2] << np.uint64(42) | c[1:-1] << np.uint64(21) | c[2:]))
            size += len(codes[-1])
            if size >= BLOCK:
                yield _block(ids, codes)
                ids, codes, size = [], [], 0
        if ids:
            yield _block(ids, codes)


def build(rows: DataFrame, columns: list[str], path: str, files: int | None = None) -> None:
    """Write the distinct texts of ``columns`` and their postings below ``path``."""
    spark = rows.sparkSession
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    text = rows.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("text"))
    text.where("text is not null and text <> ''").distinct().select(_id("text").alias("text_id"), "text") \
        .write.mode("overwrite").parquet(f"{path}/texts")
    postings = spark.read.parquet(f"{path}/texts").select("text_id", F.lower("text").alias("low")).mapInArrow(trigrams, POSTINGS)
    postings.repartition(n, "trigram", F.pmod(F.element_at("text_ids", 1), F.lit(WAYS))).sortWithinPartitions("trigram") \
        .write.mode("overwrite").parquet(f"{path}/postings")


def candidates(spark: SparkSession, path: str, term: str) -> DataFrame:
    """Ids of the texts that may hold ``term``: those with all of its trigrams."""
    postings = spark.read.schema(POSTINGS).parquet(f"{path}/postings")
    low = term.lower()
    if len(low) < 3:
        return postings.where(F.col("trigram").startswith(low)).select(F.explode("text_ids").alias("text_id")).distinct()
    grams = sorted({low[i:i + 3] for i in range(len(low) - 2)})
    some = postings.where(F.col("trigram").isin(*grams)).select("trigram", F.explode("text_ids").alias("text_id"))
    return some.groupBy("text_id").agg(F.count_distinct("trigram").alias("n")).where(F.col("n") == len(grams)).select("text_id")


def search(spark: SparkSession, path: str, term: str) -> DataFrame:
    """(text_id, text) of the distinct texts that contain ``term``, whatever its case. An empty term finds every text."""
    texts = spark.read.schema("text_id long, text string").parquet(f"{path}/texts")
    if not term:
        return texts
    return texts.join(candidates(spark, path, term), "text_id", "left_semi").where(text_contains(term, "text"))


def terms_of(rows: DataFrame, columns: list[str], found: DataFrame) -> DataFrame:
    """``rows`` with ``term``, once per term of ``found`` (term, text) that one of ``columns`` contains."""
    per_text = found.groupBy("text").agg(F.collect_set("term").alias("terms"))  # as many as terms are searched for
    out, names = rows, []
    for k, c in enumerate(columns):
        names.append(f"_terms{k}")
        out = out.join(per_text.select(F.col("text").alias(f"_text{k}"), F.col("terms").alias(names[-1])), F.col(c) == F.col(f"_text{k}"), "left").drop(f"_text{k}")
    every = F.array_distinct(F.flatten(F.array(*[F.coalesce(F.col(n), F.array().cast("array<string>")) for n in names])))
    return out.withColumn("term", F.explode(every)).drop(*names)


def rows_with(rows: DataFrame, key: list[str], columns: list[str], found: DataFrame) -> DataFrame:
    """The rows of which one of ``columns`` is a text of ``found``.

    Rows meet the found texts by hashes (64 bits and SHA-256), so no text is shuffled and one
    that a third of all rows share is joined as often as it is found: once.
    """
    def named(text: Column) -> Column:
        return F.struct(_id(text).alias("_id"), F.sha2(text, 256).alias("_sha"))

    each = rows.select(*key, F.explode(F.array_distinct(F.array(*[named(F.col(c).cast("string")) for c in columns]))).alias("t"))
    known = found.select(named(F.col("text")).alias("t"))
    hits = each.select(*key, "t.*").join(known.select("t.*"), ["_id", "_sha"], "left_semi").select(*key).distinct()
    return rows.join(hits, key, "left_semi")
