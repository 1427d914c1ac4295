"""Operators on tables with missing or shared ids, vectors of several lengths, endless hosts, clashing columns and no rows."""

import collections
import time

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F
from test_operators import NEAR, brute_removed, words

from metroflow.llm import ann_forest, embedding_dedup, frames, jaccard_join, language_id, mixing, pieces, quality, queries, substring_dedup, toxicity, url_filter

PASSAGE = words(71, 40, 9999)


def passages(ids):
    return [(i, f"{words(1000 + k, 30, 9999)} {PASSAGE} {words(5000 + k, 17, 9999)}") for k, i in enumerate(ids)]


@pytest.mark.parametrize("ids", [[None] * 250, [7] * 250, [*range(100), *[None] * 60, *[5] * 60, *range(30)]])
def test_substring_dedup_of_missing_and_shared_ids(spark, ids):
    rows = passages(ids)
    rows += rows[:40]  # repeated rows
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = substring_dedup.substring_dedup(df, 20).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute_removed(rows, 20)


def test_substring_dedup_costs_the_same_without_ids(spark):
    took = []
    for ids in (range(3000), [None] * 3000, [1] * 3000):
        df = frames.written(spark.createDataFrame(passages(ids), "doc_id long, text string").repartition(8), "passages")
        t = time.perf_counter()
        assert substring_dedup.substring_dedup(df, 20).agg(F.sum("n_removed")).first()[0] >= 2999 * 40  # and words beside it that happen to be equal
        took.append(time.perf_counter() - t)
    assert max(took[1:]) <= 2 * took[0] + 2


def vectors(spark):
    rng = np.random.Generator(np.random.PCG64(12))
    rows = []
    for size in (3, 8, 40):
        x = rng.standard_normal((60, size))
        x[30:] = x[:30] * 1.5 + 0.01 * rng.standard_normal((30, size))
        rows += [(int(rng.integers(40)) if rng.random() < 0.9 else None, [float(a) for a in v], int(rng.integers(2))) for v in x]
    rows += [(rows[0][0], rows[0][1], rows[0][2]), (rows[0][0], rows[0][1], 1 - rows[0][2]), (3, None, 1), (3, [0.0] * 8, 1), (None, None, 1), (4, rows[5][1], None),
             (5, [1.0, 1.0], 1), (6, [2.0, 2.0], 1), (6, [-1.0, 1.0], 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int"), rows


def test_embedding_dedup_of_shared_ids_and_lengths(spark):
    """A row out per row in; two rows of one id are two vectors; vectors of any length link with their like."""
    df, rows = vectors(spark)
    good = [bool(v) and any(v) and y is not None for _, v, y in rows]
    up, n = list(range(len(rows))), [0] * len(rows)

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    for a, (_, x, y) in enumerate(rows):
        for b in range(a):
            z, w = rows[b][1:]
            if good[a] and good[b] and y == w and len(x) == len(z):
                if np.dot(x, z) >= 0.98 * np.sqrt(np.dot(x, x) * np.dot(z, z)):
                    n[a], n[b] = n[a] + 1, n[b] + 1
                    up[find(a)] = find(b)
    low = collections.defaultdict(list)
    for k, (i, *_) in enumerate(rows):
        if i is not None:
            low[find(k)].append(i)
    want = [(i, n[k], min(low[find(k)], default=None)) for k, (i, *_) in enumerate(rows)]
    got = embedding_dedup.near_duplicates(df, lists=4).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id) for r in got), key=str) == sorted(want, key=str)
    assert all(r.kept == (r.vec_id == r.component_id) for r in got) and max(n) > 0


def test_ann_forest_of_several_lengths(spark):
    df, rows = vectors(spark)
    rows = [(i, v) for i, v, _ in rows if i is not None and v and any(v)]
    got = collections.defaultdict(list)
    for r in ann_forest.search(df, F.col("id") % 20 == 0, k=5).orderBy("rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q in {i for i, _ in rows if i % 20 == 0}:
        sizes = {len(v) for i, v in rows if i == q}
        if len(sizes) == 1 and sum(i == q for i, _ in rows) == 1:  # an id of one vector: its neighbours by brute force
            x = next(v for i, v in rows if i == q)
            best = {}
            for i, v in rows:
                if i != q and len(v) == len(x):
                    best[i] = max(best.get(i, -np.inf), float(np.dot(x, v)))
            assert [i for i, _ in got[q]] == sorted(best, key=lambda i: (-best[i], i))[:5]


def test_url_filter_of_long_hosts(spark):
    """A host of a megabyte has as many candidate keys as the rules have labels and lengths."""
    hosts = ["a." * 500_000 + "example.net", "." * 300_000, "x" * 500_000 + ".net", ".net", "net", "com.example.net.", ""]
    rows = [(k, f"http://{h}/en/{'p' * 1000}") for k, h in enumerate(hosts)]
    df = spark.createDataFrame(rows, "page_id long, url string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")
    host, path = url_filter.host_and_path(F.col("url"))
    most = df.select(F.max(F.size(url_filter.candidate_keys(host, path, [1, 4], 2)))).first()[0]
    assert most <= 4
    url_filter.judge(df.limit(1), rules).collect()
    t = time.perf_counter()
    got = {r.page_id: (r.rule, r.verdict) for r in url_filter.judge(df, rules).collect()}
    took = time.perf_counter() - t
    t = time.perf_counter()
    url_filter.judge(df.where("page_id > 2"), rules).collect()
    assert took <= time.perf_counter() - t + 1  # three megabytes of hosts take less than a second more
    want = {}
    for k, h in enumerate(hosts):
        fit = [(len(a + b), a + b, v) for a, b, v in queries.URL_RULES if (h == a or h.endswith("." + a)) and f"/en/{'p' * 1000}".startswith(b)]
        want[k] = max(fit)[1:] if fit else (None, "allow")
    assert got == want


CLASH = ["weight", "probability", "cell", "sampled", "topic", "score", "pieces", "n_pieces", "lossless", "n_tokens", "key", "group", "seq", "t", "y", "id", "v", "n", "k"]


@pytest.fixture(scope="module")
def clashing(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    return docs.withColumns({c: F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASH})


def test_pipeline_with_clashing_columns(spark, clashing):
    """Every stage keeps such columns as they are; the last one's own results replace the three it names."""
    import corpus_pipeline as p
    plain, docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), clashing
    for k, (name, stage) in enumerate(p.STAGES):
        columns = docs.columns
        docs, plain = (frames.written(stage(spark, d, SF_SMALL), f"clash-{k}") for d in (docs, plain))
        assert docs.count() == plain.count(), name
        if k < len(p.STAGES) - 1:
            assert docs.columns == columns, name
            bad = [F.col(c) != F.concat(F.lit(c), F.col("doc_id").cast("string")) for c in CLASH]
            assert docs.where(" or ".join(f"{c} <> concat('{c}', doc_id)" for c in CLASH)).count() == 0 and bad, name
    assert docs.where("not lossless").count() == 0 and "weight" in docs.columns


def test_operators_with_clashing_columns(spark, clashing):
    docs, labels = clashing, spark.read.parquet(f"{SF_SMALL}/labels.parquet")
    n = docs.count()
    assert jaccard_join.jaccard_components(docs, 3, 90).count() == n
    assert language_id.predict(docs, language_id.fit(docs)).count() == n
    assert quality.score(docs, quality.fit(docs, labels, "quality")).count() == n
    assert toxicity.score(docs, toxicity.fit(docs, labels, "toxic")).count() == n
    assert pieces.encoded(docs, queries.PIECE_MODEL).columns == ["doc_id", "n_pieces", "pieces", "lossless"]
    mixed = mixing.mix(docs.withColumn("n_tokens", F.lit(3)), {"topic": {"topic1": 0.5}, "lang": {"en": 0.5}}, share=0.5)
    assert mixed.where("sampled and probability > 0 and weight >= 0 and size(cell) = 2").count() > 0 and len(set(mixed.columns)) == len(mixed.columns)
    vecs = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").withColumns({c: F.lit("x") for c in ("id", "v", "size", "key", "list", "n", "leaf", "query")})
    assert embedding_dedup.near_duplicates(vecs).count() == vecs.count()
    assert ann_forest.search(vecs, F.col("id") % 20 == 0, k=2).count() == 2 * vecs.where("vec_id % 20 = 0").count()


def test_mixing_bounds_its_cells(spark):
    many = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.col("id").cast("string").alias("source"), F.lit(2).alias("n_tokens"))
    targets = mixing.tempered(many, F.col("n_tokens"), F.col("source"), 0.5)
    assert mixing.mix(many, {"source": targets}, share=0.5).where("probability between 0.49 and 0.51").count() == 500
    with pytest.raises(ValueError, match="cells"):
        mixing.mix(many, {"source": targets}, share=0.5, most=100)
    with pytest.raises(ValueError, match="values"):
        mixing.tempered(many, F.col("n_tokens"), F.col("source"), 0.5, most=100)


def test_rows_without_ids_are_held_out(spark):
    df = spark.createDataFrame([(None, "a"), (1, "b")], "doc_id long, text string")
    assert df.where("doc_id is null").select(language_id.held_out("doc_id", 4, 2)).first()[0] is True


def test_empty_tables(spark):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where("1 = 0")
    assert jaccard_join.jaccard_components(docs, 3, 90).count() == 0
    assert substring_dedup.substring_dedup(docs, 20).count() == 0
    for name, stage in p.STAGES:
        assert stage(spark, docs, SF_SMALL).count() == 0, name


def test_stages_on_odd_rows(spark):
    """Null and shared ids, empty texts and repeated rows pass all stages in a row."""
    import corpus_pipeline as p
    docs = spark.createDataFrame([(i, t, "en", f"s{k % 3}" if k % 4 else None, len(t) if t else None) for k, (i, t) in enumerate(NEAR)],
                                 spark.read.parquet(f"{SF_SMALL}/documents.parquet").schema)
    for name, stage in p.STAGES[1:]:
        docs = frames.written(stage(spark, docs, SF_SMALL), "odd-stage")
    assert docs.where("not lossless").count() == 0 and docs.count() > 0
