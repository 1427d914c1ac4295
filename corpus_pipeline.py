"""A training corpus from raw documents: STAGES in order, each (spark, docs, sf_dir) -> DataFrame.

Every stage's result is written as Parquet and read again as the next one's
``docs``; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from metroflow.llm import jaccard_join, mixing, pieces, quality, substring_dedup
from metroflow.llm.frames import text_hash, written
from metroflow.llm.queries import PIECE_MODEL, mix_targets

ORACLE_SQL = None


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject (score of 0.3 or more)."""
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    scored = quality.score(docs, quality.fit(docs, labels, "quality"), keep=docs.columns, name="__score")
    return scored.where(F.col("__score") >= 0.3).select(docs.columns)


def _named(docs: DataFrame) -> DataFrame:
    """``docs`` with what names a document, null-safely: its id (0 and a flag if null) and a hash of its text."""
    return docs.withColumns({"__id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0).cast("long")), "__no": F.col("doc_id").isNull(),
                             "__hash": text_hash("text")})


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group whose 5-word shingles link at 0.8 or more: the smallest id, null ids last, then the least hash of the text.

    A wordless text is a group of its own. Of rows that repeat an id (or have none) and a text, one stays.
    """
    group = jaccard_join.jaccard_components(docs, n=5, percent=80, with_group=True)
    each = written(group.select("group", F.struct(F.col("doc_id").isNull().alias("__no"), F.coalesce("doc_id", F.lit(0).cast("long")).alias("__id"),
                                                  F.col("text_hash").alias("__hash")).alias("one")), "near-groups")
    first = each.where("group is not null").groupBy("group").agg(F.min("one").alias("one")).select("one.*")
    blank = each.where("group is null").select("one.*").distinct()
    name = ["__id", "__no", "__hash"]
    others = [c for c in docs.columns if c not in ("doc_id", "text")]
    one = F.row_number().over(Window.partitionBy(*name).orderBy(F.xxhash64(*others, F.lit(0))))  # of repeated rows, whatever their other columns
    kept = _named(docs).join(first.union(blank).select(*name), name, "left_semi")
    return kept.withColumn("__row", one).where("__row = 1").select(docs.columns)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words of 50-word windows that occur earlier go; a text of which nothing stays goes too."""
    name = ["__id", "__no", "__hash"]
    done = substring_dedup.substring_dedup(docs, window=50, with_text=True).where("n_removed > 0").select(
        F.coalesce("doc_id", F.lit(0).cast("long")).alias("__id"), F.col("doc_id").isNull().alias("__no"), F.col("text_hash").alias("__hash"),
        F.col("kept_text").alias("__kept")).dropDuplicates(name)
    cut = _named(docs).join(done, name, "left").withColumn("text", F.coalesce("__kept", "text"))
    cut = cut.where(F.col("__kept").isNull() | (F.col("__kept") != ""))
    return cut.withColumn("n_chars", F.when(F.col("__kept").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType)) \
        .select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Half of the tokens, drawn so that sources, languages and topics near their tempered targets."""
    counted = docs.withColumn("__tokens", mixing.n_tokens(F.col("text")))
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": mixing.topic_of(F.col("text"), F.col("__tokens"))}
    small = written(counted.select(*[c.alias(d) for d, c in dims.items()], F.col("__tokens").alias("n_tokens")), "mix-counts")
    mixed = mixing.drawn(counted, dims, mix_targets(small), 0.5, F.col("__tokens"), [F.col("doc_id"), F.col("text")])
    return mixed.where("__sampled").select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces."""
    keep = [c for c in docs.columns if c != "text"]
    return pieces.encoded(docs, PIECE_MODEL, keep=keep)


STAGES = [("quality", keep_good), ("near duplicates", one_of_each), ("repeats", cut_repeats), ("mix", mix_sources), ("pieces", encode)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{k}")
    return docs
