"""Registered queries of the operators: each applies one, with production parameters, to its whole table."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from metroflow.llm import ann_forest, collocations, divergence, embedding_dedup, jaccard_join, language_id, mixing, pieces, quality, substring_dedup, toxicity, url_filter, warc
from metroflow.llm.frames import written

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query
def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = language_id.held_out("doc_id", 4, 2)
    model = language_id.fit(docs.where(~out))
    got = language_id.predict(docs, model)
    return got.select("doc_id", out.alias("held_out"), "lang_pred", "score", "ambiguous")


@_query
def op2_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, sf_dir, "documents"), n=3, percent=90)


@_query
def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(_table(spark, sf_dir, "documents"), window=20)


#: host, path, verdict (fixed values)
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@_query
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(_table(spark, sf_dir, "pages"), rules)


ORACLES["op6_url_filters"] = """
WITH a AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM a),
c AS (SELECT page_id, translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM b),
r(rh, rp, rv) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in URL_RULES) + """),
m AS (SELECT page_id, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(rv, length(rh || rp)) AS verdict
      FROM c JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY page_id)
SELECT c.page_id, c.host, c.path, m.rule, coalesce(m.verdict, 'allow') AS verdict FROM c LEFT JOIN m USING (page_id)"""


@_query
def op4_ann_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann_forest.search(_table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


@_query
def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), threshold=0.98)


ORACLES["op10_embedding_dedup"] = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL),
n AS (SELECT *, sqrt(list_inner_product(e, e)) AS s FROM v),
l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM n a JOIN n b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_inner_product(a.e, b.e) >= 0.98 * a.s * b.s),
c AS (SELECT x, y FROM l UNION SELECT c.x, l.y FROM c JOIN l ON c.y = l.x)
SELECT vec_id, (SELECT count(*) FROM l WHERE x = vec_id) AS n_links,
       least(vec_id, coalesce((SELECT min(y) FROM c WHERE x = vec_id), vec_id)) AS component_id,
       vec_id <= coalesce((SELECT min(y) FROM c WHERE x = vec_id), vec_id) AS kept FROM embeddings"""


@_query
def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = language_id.held_out("doc_id", 5, 0)
    got = quality.score(docs, quality.fit(docs, labels.where(~out), "quality"))
    return got.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@_query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    out = language_id.held_out("doc_id", 5, 0)
    got = toxicity.score(docs, toxicity.fit(docs, labels.where(~out), "toxic"))
    return got.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                      F.size("passages").alias("n_passages"))


#: The public tokenizer file; a parameter, never part of the repository.
PIECE_MODEL = os.environ.get("PIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


@_query
def op7_sentencepiece_dropout(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encoded(_table(spark, sf_dir, "documents"), PIECE_MODEL)


def mix_targets(counted: DataFrame) -> dict[str, dict[str, float]]:
    """Tempered targets: sources by the root of their tokens, languages by the power 0.7, topics by 0.8."""
    return {d: mixing.tempered(counted, F.col("n_tokens"), F.col(d), power) for d, power in (("source", 0.5), ("lang", 0.7), ("topic", 0.8))}


@_query
def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    counted = written(docs.withColumn("n_tokens", mixing.n_tokens(F.col("text"))).select(
        "doc_id", "source", "lang", mixing.topic_of(F.col("text"), F.col("n_tokens")).alias("topic"), "n_tokens", F.xxhash64("text").alias("text_hash")), "mix-counts")
    got = mixing.mix(counted, mix_targets(counted), share=0.5, text_col="text_hash")
    return got.select("doc_id", "source", "lang", "topic", "n_tokens", "weight", "probability", "sampled")


@_query
def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.read(warc.write(_table(spark, sf_dir, "pages"))).where("record_type is null or record_type <> 'warcinfo' or error is not null")
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.col("archive"), F.lit(": "), F.col("error"))).cast("string")).otherwise(F.col("payload_digest"))
    return records.select(warc.key_of("record_id").alias("page_id"), "payload_bytes", sound.alias("payload_digest"), "record_type",
                          warc.key_of("refers_to").alias("refers_to"))


ORACLES["op12_warc"] = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS n, lower(sha256(b)) AS h FROM p),
m AS (SELECT *, min(page_id) OVER (PARTITION BY h) AS low FROM d)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, h AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> low THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> low THEN low END AS refers_to FROM m"""


@_query
def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"), least=30, top=50)


ORACLES["op11_divergence"] = r"""
WITH d AS (SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT i, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS raw FROM d),
t AS (SELECT i, lang, source, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM w),
kept AS (SELECT lang, term, count(*) AS c FROM t GROUP BY ALL HAVING count(DISTINCT i) >= 30),
v AS (SELECT lang, count(*) AS v, sum(c) AS n FROM kept GROUP BY ALL),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, t.source, t.term, count(*) AS c FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
gn AS (SELECT g.lang, g.source, coalesce(sum(c.c), 0) AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL),
p AS (SELECT gn.lang, gn.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 5)::HUGEINT) // (gn.n + 5 * v.v)::HUGEINT AS p
      FROM gn JOIN kept k USING (lang) JOIN v USING (lang) LEFT JOIN c ON c.lang = gn.lang AND c.source = gn.source AND c.term = k.term),
q AS (SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (k.c + 5)::HUGEINT) // (v.n + 5 * v.v)::HUGEINT AS q FROM kept k JOIN v USING (lang)),
pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(s.value, 0) AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL) s
          ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT p.lang, p.source, p.term AS item, p.p - q.q AS value FROM p JOIN q USING (lang, term) WHERE p.c > 0 AND p.p > q.q),
r AS (SELECT lang, source, 'pair' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM pairs
      UNION ALL
      SELECT * FROM (SELECT lang, source, 'term' AS part, item, value, row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, encode(item)) AS rank FROM terms) WHERE rank <= 50)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INT) AS rank FROM r"""


@_query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), least=30, inside=80, top=2000)


ORACLES["op13_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM d),
w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[\x20\x09]+'), lambda x: x <> '') AS ws FROM p),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(ws) - k + 2), lambda i: ws[i:i + k - 1])) AS g FROM w, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE len(ws) >= k),
f AS (SELECT lang, k, g, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY ALL),
c AS (SELECT lang, k, g, f AS a FROM f WHERE k > 1),
sub AS (SELECT c.lang, c.g[s:s + z - 1] AS g, max(c.a) AS most FROM c, (SELECT unnest([2, 3]) AS z), (SELECT unnest([1, 2, 3]) AS s)
        WHERE z < c.k AND s + z - 1 <= c.k GROUP BY ALL),
kept AS (SELECT c.* FROM c LEFT JOIN sub ON c.lang = sub.lang AND c.g = sub.g WHERE sub.most IS NULL OR 100 * sub.most < 80 * c.a),
cuts AS (SELECT kept.lang, kept.g, a, j, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f)::HUGEINT AS score
         FROM kept JOIN (SELECT unnest([1, 2, 3]) AS j) ON j < kept.k JOIN f l ON l.lang = kept.lang AND l.g = kept.g[1:j] JOIN f r ON r.lang = kept.lang AND r.g = kept.g[j + 1:kept.k]),
one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, g ORDER BY score, j) AS o FROM cuts) WHERE o = 1),
ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(array_to_string(g, ' '))) AS rank,
                  array_to_string(g, ' ') AS phrase, a, l, r, score FROM one)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000"""
