"""Each operator against brute force or held-out truth, and its stated edge cases: nulls, empty and long
texts, ties, repeated rows, empty tables, extra columns with clashing names."""

import collections
import hashlib

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from metroflow.llm import (ann_forest, embedding_dedup, frames, jaccard_join, language_id, mixing, pieces, quality, queries,
                           substring_dedup, toxicity, url_filter)
from metroflow.llm.labelled import logistic
from metroflow.llm.words import Words, sequence_hash, signed

DOCS = "doc_id long, text string, lang string, source string, n_chars long, key string, v int, token int"


def words(k, n, alphabet=97):
    rng = np.random.Generator(np.random.PCG64(k))
    return " ".join(f"w{x}" for x in rng.integers(0, alphabet, n))


BASE, OTHER, PASSAGE = words(1, 60, 9999), words(2, 70, 9999), words(3, 30, 9999)
ODD = [(1, None), (2, ""), (3, "  \n\t"), (4, "one"), (5, "One"), (6, "one two"), (7, "a b c"), (8, "A  B\nc"), (10, BASE), (11, BASE),
       (12, BASE + " x"), (13, BASE.replace("w", "W")), (14, "head " + PASSAGE + " tail"), (15, OTHER + " " + PASSAGE), (15, OTHER),
       (16, "ha " * 90), (17, "é▁ü \u3000 日本 😀 | q"), (18, "x" * 5000), (18, "x" * 5000), (None, "no id at all"), (-4, PASSAGE),
       (20, words(5, 20_000, 9999)), (21, words(5, 20_000, 9999) + " more"), (22, words(6, 400, 40))]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, "en" if k % 3 else None, None if k % 5 == 0 else f"s{k % 2}", len(t) if t else None, "k", k, k) for k, (i, t) in enumerate(ODD)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def none(odd):
    return odd.where("1 = 0")


def sets(rows, n):
    for i, t in rows:
        w = (t or "").encode().lower().split()
        yield i, {tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_components(rows, n, percent):
    s = list(sets(rows, n))
    up = list(range(len(s)))

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    where = collections.defaultdict(list)
    for k, (_, x) in enumerate(s):
        seen = collections.Counter()
        for g in x:
            seen.update(where[g])
            where[g].append(k)
        for j, m in seen.items():
            if 100 * m >= percent * (len(x) + len(s[j][1]) - m):
                up[find(j)] = find(k)
    low = {}
    for k, (i, x) in enumerate(s):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(x), low.get(find(k)) if x else i) for k, (i, x) in enumerate(s)), key=str)


@pytest.mark.parametrize("n,percent,block", [(3, 90, 400_000), (5, 80, 300)])
def test_jaccard_components(odd, n, percent, block):
    got = jaccard_join.jaccard_components(odd, n, percent, block_shingles=block).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(ODD, n, percent)


def test_jaccard_large_near_copies(spark):
    """A large group of near copies, split into blocks and over the bound of a shared shingle, stays one group."""
    rng = np.random.Generator(np.random.PCG64(4))
    base, rows = words(8, 120, 9999).split(), []
    for k in range(400):
        w = list(base)
        for p in rng.integers(0, len(w), 1 + k % 4):
            w[p] = f"z{k}"
        rows.append((k, " ".join(w)))
    rows += [(1000 + k, words(100 + k, 100, 9999)) for k in range(50)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = jaccard_join.jaccard_components(df, 3, 80, block_shingles=6000, shared_block=50).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows, 3, 80)


def brute_removed(rows, window):
    """Per row (id, words, removed, digest); rows that share an id and words are one document, other texts of an id go by a hash of their words."""
    def place(t):
        return int(signed(np.array([sequence_hash(Words([t.encode()]).hashes())], np.uint64))[0])
    order = sorted({(i if i is not None else -2**63, t or "") for i, t in rows}, key=lambda x: (x[0], place(x[1])))
    rank = {x: k for k, x in enumerate(order)}
    first, out = {}, {}
    split = {x: x[1].encode().split() for x in order}
    for x, w in split.items():
        for k in range(len(w) - window + 1):
            first.setdefault(tuple(w[k:k + window]), []).append((rank[x], x, k))
    for x, w in split.items():
        cover = [False] * len(w)
        for k in range(len(w) - window + 1):
            if any(d < rank[x] or (y == x and s < k) for d, y, s in first[tuple(w[k:k + window])]):
                cover[k:k + window] = [True] * window
        kept = [a for a, c in zip(w, cover) if not c]
        out[x] = (len(w), sum(cover), hashlib.sha256(b" ".join(kept)).hexdigest())
    return sorted(((i, *out[(i if i is not None else -2**63, t or "")]) for i, t in rows), key=str)


@pytest.mark.parametrize("window", [5, 20])
def test_substring_dedup(odd, window):
    got = substring_dedup.substring_dedup(odd, window).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute_removed(ODD, window)


def test_substring_dedup_of_the_table(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    got = queries.op3_substring_dedup(spark, SF_SMALL).collect()
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute_removed(rows, 20)


def test_jaccard_of_the_table(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").collect()]
    got = queries.op2_ngram_jaccard_join(spark, SF_SMALL).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == brute_components(rows, 3, 90)


def test_language_id(spark, odd, none):
    got = queries.op1_language_id(spark, SF_SMALL).join(spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "lang"), "doc_id").toPandas()
    out = got[got.held_out]
    assert len(got) == 200 and (out.lang == out.lang_pred).mean() >= 0.95 and got.score.between(0, 1).all()
    model = language_id.fit(odd, sample=10)  # one language
    own = {r.doc_id: (r.lang_pred, r.score) for r in language_id.predict(odd, model).collect()}
    assert own[1] == own[2] == own[3] == ("und", 0.0) and own[4] == ("en", 1.0)
    assert {r.lang_pred for r in language_id.predict(odd, language_id.fit(none)).collect()} == {"und"}
    assert language_id.predict(none, model).count() == 0
    many = language_id.codewords(12)
    assert min((many[i] != many[j]).sum() for i in range(12) for j in range(i)) >= 8


def embeddings(spark):
    rng = np.random.Generator(np.random.PCG64(9))
    x = rng.standard_normal((300, 8)).astype(np.float32)
    x[40:80] = x[40]  # a large group of equal vectors
    x[80:110] = x[80] + 0.02 * rng.standard_normal((30, 8))
    rows = [(k, [float(a) for a in v], None if k == 5 else k % 2 if k < 40 else 7) for k, v in enumerate(x)]
    rows += [(900, None, 1), (901, [], 1), (902, [0.0] * 8, 1), (903, [float("nan")] * 8, 1), (904, [1.0, None] * 4, 1), (905, [1.0], 1),
             (906, rows[3][1], 1), (907, [float("inf")] * 8, 1)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"), rows


def usable(v):
    return v is not None and len(v) == 8 and all(a is not None and np.isfinite(a) for a in v) and any(v)


def test_ann_forest(spark):
    df, rows = embeddings(spark)
    good = [(i, np.array(v, float)) for i, v, _ in rows if usable(v)]
    hits = total = 0
    got = collections.defaultdict(list)
    for r in ann_forest.search(df, F.col("id") % 20 == 0, k=20, block=50).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    for q, x in good:
        if q % 20 == 0:
            want = sorted(((-(x * v).sum(), i) for i, v in good if i != q))[:20]
            hits += len({i for _, i in want} & {i for i, _ in got[q]})
            total += 20
            assert len(got[q]) == 20 and got[q] == sorted(got[q], key=lambda z: (-z[1], z[0]))
    assert hits / total >= 0.9 and set(got) == {i for i, _ in good if i % 20 == 0}
    few = ann_forest.search(df.where("vec_id < 12"), F.col("id") == 0).collect()
    assert [r.rank for r in few] == list(range(1, 12))  # all candidates, exactly
    assert ann_forest.search(df.where("1 = 0"), F.lit(True)).count() == 0


def test_ann_recall_on_the_table(spark):
    e = spark.read.parquet(f"{SF_SMALL}/embeddings.parquet").toPandas()
    x, ids = np.stack(e.embedding).astype(float), e.vec_id.to_numpy()
    got = queries.op4_ann_forest(spark, SF_SMALL).toPandas().groupby("query_id").vec_id.apply(set)
    recall = []
    for k in np.flatnonzero(ids % 20 == 0):
        s = x @ x[k]
        s[k] = -np.inf
        recall.append(len(got[ids[k]] & set(ids[np.lexsort((ids, -s))[:20]])) / 20)
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize("block", [4096, 16])
def test_embedding_dedup(spark, block):
    df, rows = embeddings(spark)
    n, up = collections.Counter(), {i: i for i, *_ in rows}

    def find(a):
        while up[a] != a:
            a = up[a]
        return a
    good = [(i, np.array(v, float), y) for i, v, y in rows if usable(v) and y is not None]
    for a, (i, x, y) in enumerate(good):
        for j, z, w in good[:a]:
            if y == w and (x * z).sum() >= 0.98 * np.sqrt((x * x).sum() * (z * z).sum()):
                n.update((i, j))
                p, q = find(i), find(j)
                up[max(p, q)] = min(p, q)
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in embedding_dedup.near_duplicates(df, block=block, lists=8).collect()}
    assert got == {i: (n[i], find(i), find(i) == i) for i, *_ in rows}
    assert embedding_dedup.near_duplicates(df.where("1 = 0")).count() == 0


def test_quality(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    got = queries.op5_quality_classifier(spark, "/root/testdata/sf0.01").join(labels, "doc_id").toPandas()
    out = got[got.held_out]
    assert (out.predicted == out.quality).mean() >= 0.9 and got.score.between(0, 1).all()
    model = quality.fit(docs, labels)
    scored = quality.score(odd, model).collect()
    assert len(scored) == len(ODD) and all(0 <= r.score <= 1 for r in scored)
    assert {r.score for r in quality.score(odd, quality.fit(odd, labels.where("1 = 0"))).collect()} == {0.5}
    assert quality.score(none, model).count() == 0


def test_toxicity(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    big = "/root/testdata/sf0.1"
    got = queries.op8_toxicity(spark, big).where("held_out").join(spark.read.parquet(f"{big}/labels.parquet"), "doc_id").toPandas()
    assert got[got.toxic == 1].predicted.mean() >= 0.85 and got[got.toxic == 0].predicted.mean() <= 0.03  # rows it didn't learn from
    model = toxicity.fit(docs, labels)
    assert {r.score for r in toxicity.score(odd, toxicity.fit(odd, labels.where("1 = 0"))).collect()} == {float(1 / (1 + np.exp(35)))}
    assert toxicity.score(odd, model).count() == len(ODD) and toxicity.score(none, model).count() == 0


@pytest.mark.parametrize("best", [1.0, 2.0, 3.0, 4.0, 5.0])
@pytest.mark.parametrize("marked", [3, 30, 400])
def test_calibration_keeps_the_order(best, marked):
    """The fit on classes that x parts well stops at its optimum, with a slope above 0."""
    rng = np.random.Generator(np.random.PCG64(4))
    y = np.r_[np.ones(marked, int), np.zeros(9 * marked, int)]
    x, w = np.where(y == 1, best + rng.normal(0, 0.2, len(y)), 0.0), np.ones(len(y))
    a, b = logistic(x, y, w)
    target = np.where(y == 1, (marked + 1) / (marked + 2), 1 / (9 * marked + 2))
    rest = target - 1 / (1 + np.exp(-(a * x + b)))
    assert a > 0 and abs(rest.sum()) < 1e-3 and abs((rest * x).sum()) < 1e-3


def test_few_toxic_documents_carry_tokens():
    assert [toxicity.least_z(n) for n in (0, 10, 60)] == [2.0] * 3 and [toxicity.least_z(n) for n in (240, 6000)] == [3.0] * 2 and 2 < toxicity.least_z(120) < 3


def test_maximal_segments():
    """Against the definition: the best segment, then the same left and right of it."""
    def brute(s, at=0):
        best = max(((sum(s[i:j]), -(j - i), i, j) for i in range(len(s)) for j in range(i + 1, len(s) + 1)), default=(0, 0, 0, 0))
        if best[0] <= 0:
            return []
        _, _, i, j = best
        return brute(s[:i], at) + [(at + i, at + j - 1, best[0])] + brute(s[j:], at + j)
    rng = np.random.Generator(np.random.PCG64(2))
    for _ in range(60):
        s = np.where(rng.random(24) < 0.3, rng.random(24) * 4, -1.0)
        at = np.flatnonzero(s > 0)
        got = toxicity.segments(at, s[at], 1.0)
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in brute(s.tolist())]
        assert np.allclose([x for *_, x in got], [x for *_, x in brute(s.tolist())])


def test_url_filters(spark):
    urls = [None, "", "no scheme/x", "http://a.net/q", "http://A.NET", "https://x.example.net/en/1?a=/b", "https://myexample.net/en/", "http://example.com/de/#t",
            "http://org/fr/", "http://w.org/fr/x", "http://worg/fr/", "://.net/", "http://a..net/y", "x://y://example.com/de/", "http://é.net/ß"]
    pages = spark.createDataFrame([(k, u, "h") for k, u in enumerate(urls)] + [(3, urls[3], "again")], "page_id long, url string, rule string")
    rules = spark.createDataFrame(queries.URL_RULES, "host string, path string, verdict string")

    def brute(u):
        if not u or "://" not in u:
            return "", "", None, "allow"
        rest = u.split("://", 1)[1]
        k = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host, rest = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:k]), rest[k:]
        path = rest[:min([rest.find(c) for c in "?#" if c in rest], default=len(rest))]
        fit = [(len(h + p), h + p, v) for h, p, v in queries.URL_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return host, path, max(fit)[1] if fit else None, max(fit)[2] if fit else "allow"
    got = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(pages, rules).collect())
    assert [x[:3] for x in got] == [x[:3] for x in sorted((k, *brute(u)) for k, u in [*enumerate(urls), (3, urls[3])])]
    assert sorted(map(str, got)) == sorted(str((k, *brute(u))) for k, u in [*enumerate(urls), (3, urls[3])])
    assert url_filter.judge(pages.where("1 = 0"), rules).count() == 0
    assert {r.verdict for r in url_filter.judge(pages, rules.where("1 = 0")).collect()} == {"allow"}


def test_cascade_is_exact_with_many_levels(spark):
    keys = spark.range(40_000).select(F.xxhash64("id").alias("h1"), F.xxhash64("id", F.lit(1)).alias("h2"), (F.col("id") % 7 == 0).alias("listed")).cache()
    c = url_filter.build(keys)
    t = keys.toPandas()
    h = np.stack([t.h1.to_numpy(), t.h2.to_numpy()], 1).view(np.uint64)
    assert (c.test(h) == t.listed.to_numpy()).all() and len(c.levels) > 2
    with pytest.raises(ValueError):
        url_filter.build(keys, max_bytes=64)


def test_pieces(spark, odd, none):
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=queries.PIECE_MODEL)
    plain = {r.v: r for r in pieces.encoded(odd, queries.PIECE_MODEL, dropout=0.0, keep=["v"]).collect()}
    for k, (_, t) in enumerate(ODD):
        r = plain[k]
        assert (r.pieces is None and r.lossless is None) if t is None else (r.lossless and r.n_pieces == len(r.pieces))
        if t and "▁" not in t:
            assert r.pieces == sp.encode(t)
    drop = pieces.encoded(odd, queries.PIECE_MODEL, dropout=0.3, keep=["v"])
    rows = {r.v: r for r in drop.collect()}
    assert rows == {r.v: r for r in drop.repartition(5).collect()} and rows[8].pieces != plain[8].pieces
    other = {r.v: r.pieces for r in pieces.encoded(odd, queries.PIECE_MODEL, dropout=0.3, seed=5, keep=["v"]).collect()}
    assert other[8] != rows[8].pieces
    back = {r.doc_id: r.text for r in pieces.decoded(drop, queries.PIECE_MODEL, id_col="v").collect()}
    assert back == {k: t for k, (_, t) in enumerate(ODD)}
    assert pieces.encoded(none, queries.PIECE_MODEL).count() == 0


def test_piece_rounds_equal_the_agenda(monkeypatch):
    v = pieces.vocabulary(queries.PIECE_MODEL)
    texts, lanes = [t for _, t in ODD[4:17] if t], np.arange(13) % 3
    one = pieces.encode(v, texts, lanes[:len(texts)], 0.2, 3)
    monkeypatch.setattr(pieces, "LONG", 3)
    two = pieces.encode(v, texts, lanes[:len(texts)], 0.2, 3)
    assert all(np.array_equal(a, b) for a, b in zip(one, two))


def test_raking():
    rng = np.random.Generator(np.random.PCG64(6))
    have = rng.integers(50, 500, (3, 4, 2)).astype(float)
    goals = [np.array([0.3, 0.3, 0.4]), np.array([0.25] * 4), np.array([0.6, 0.4])]
    take = mixing.rake(have, goals, 0.3 * have.sum())
    free = have * 0.3
    for _ in range(500):  # plain iterative proportional fitting, where no cell is full
        for axis, g in enumerate(goals):
            other = tuple(i for i in range(3) if i != axis)
            free = free * (g * 0.3 * have.sum() / free.sum(other)).reshape([-1 if i == axis else 1 for i in range(3)])
    assert (free <= have).all() and np.allclose(take, free, rtol=1e-6)
    full = mixing.rake(have, [np.array([0.98, 0.01, 0.01]), *goals[1:]], 0.9 * have.sum())
    assert (full <= have + 1e-9).all() and full.sum() <= 0.9 * have.sum() + 1e-6


def test_mixing(spark, odd, none):
    n = mixing.n_tokens(F.col("text"))
    assert [r[0] for r in odd.orderBy("v").select(n).collect()] == [len((t or "").encode().split()) for _, t in ODD]
    counted = odd.withColumn("n_tokens", n)
    got = mixing.mix(counted, {"source": {"s0": 0.5, "s1": 0.3}, "lang": {"en": 0.7}}, share=0.5).collect()
    assert len(got) == len(ODD) and all(0 <= r.probability <= 1 for r in got)
    assert len({r.sampled for r in got if r.text == "x" * 5000 and r.cell == got[0].cell}) <= 1
    assert {tuple(r.cell) for r in got} <= {(a, b) for a in ("s0", "s1", "(other)") for b in ("en", "(other)")}
    assert mixing.mix(none.withColumn("n_tokens", n), {"lang": {"en": 1.0}}, share=0.5).count() == 0
    r = queries.op9_mixing(spark, "/root/testdata/sf0.01").toPandas()
    part = (r.probability * r.n_tokens).groupby(r.lang).sum() / (r.probability * r.n_tokens).sum()
    want = r.n_tokens.groupby(r.lang).sum() ** 0.7
    assert np.allclose(part, want / want.sum(), atol=0.03)


def test_components(spark):
    rng = np.random.Generator(np.random.PCG64(3))
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000 + k, 1001 + k) for k in range(60)] + [(5, 5)]
    up = {}

    def find(a):
        while up.setdefault(a, a) != a:
            a = up[a]
        return a
    for a, b in edges:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    got = {r.node: r.label for r in frames.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {a: find(a) for a in {x for e in edges for x in e if e[0] != e[1]}}
    assert frames.components(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_oracles(spark, duck, name):
    from tools.check_oracle import rows
    got, want = queries.QUERIES[name](spark, SF_SMALL).toPandas(), duck.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_pipeline(spark):
    import corpus_pipeline as p
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    n = [docs.count()]
    for k, (_, stage) in enumerate(p.STAGES):
        columns = docs.columns
        docs = frames.written(stage(spark, docs, SF_SMALL), f"test-{k}")
        n.append(docs.count())
        assert docs.columns == columns if k < len(p.STAGES) - 1 else "pieces" in docs.columns
    assert n == sorted(n, reverse=True) and n[-1] > 0 and n[4] == n[5]
    assert docs.where("not lossless").count() == 0


BRIDGE, SHARED, NAMELESS = (words(k, 80, 9999).split() for k in (31, 32, 33))


def changed(w, *at):
    return " ".join("changed%d" % k if k in at else x for k, x in enumerate(w))


#: Near copies of rows that have no id or share one: a null id links 50 with 51, two texts are called 52, a group has no id at all.
NEAR = [*ODD, (50, changed(BRIDGE, 0)), (None, changed(BRIDGE)), (51, changed(BRIDGE, 79)), (52, changed(SHARED)), (52, changed(NAMELESS, 79)),
        (53, changed(SHARED, 79)), (54, changed(NAMELESS)), (None, "no name " + BASE[:200] + " " + words(34, 90, 9999)),
        (None, "no name " + BASE[:200] + " " + words(34, 90, 9999) + " end"), (None, "no id at all"), (None, "nor here"), (None, ""), (3, "  \n\t"), (50, changed(BRIDGE, 0))]


@pytest.mark.parametrize("n,percent,block", [(3, 94, 400_000), (3, 94, 150), (5, 80, 400_000)])
def test_jaccard_links_of_null_and_shared_ids(spark, n, percent, block):
    df = spark.createDataFrame(NEAR, "doc_id long, text string")
    got = jaccard_join.jaccard_components(df, n, percent, block_shingles=block).collect()
    want = brute_components(NEAR, n, percent)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == want
    assert (51, 78 if n == 3 else 76, 50) in want  # only by way of the row without an id


def near_rows(spark):
    return spark.createDataFrame([(i, t, "en", f"s{k}", len(t) if t else None, "k", k, k) for k, (i, t) in enumerate(NEAR)], DOCS)


def test_pipeline_keeps_one_row_of_each_group(spark):
    import corpus_pipeline as p
    df = near_rows(spark)
    got = [(r.doc_id, r.text) for r in p.one_of_each(spark, df, SF_SMALL).collect()]
    s = list(sets(NEAR, 5))
    group = list(range(len(s)))  # brute force: the smallest label spreads over links
    for _ in s:
        for a in range(len(s)):
            for b in range(a):
                x, y = s[a][1], s[b][1]
                if (x and y and 100 * len(x & y) >= 80 * len(x | y)) or NEAR[a] == NEAR[b]:
                    group[a] = group[b] = min(group[a], group[b])
    members = collections.defaultdict(list)
    for k, g in enumerate(group):
        members[g].append(NEAR[k])
    assert len(got) == len(members) and len(set(got)) == len(got)
    for m in members.values():
        own = [x for x in got if x in m]
        assert len(own) == 1 and own[0][0] == min((i for i, _ in m if i is not None), default=None)


def test_pipeline_cuts_the_own_text_of_null_and_shared_ids(spark):
    import corpus_pipeline as p
    rows = NEAR + [(60, words(41, 200, 9999)), (61, "a b " + words(41, 200, 9999)), (61, "another text of this id"), (None, words(41, 200, 9999)[:600] + " c d")]
    df = spark.createDataFrame([(i, t, "en", "s", len(t) if t else None, "k", k, k) for k, (i, t) in enumerate(rows)], DOCS)
    out = p.cut_repeats(spark, df, SF_SMALL).collect()
    empty = hashlib.sha256(b"").hexdigest()
    want = sorted(((i, h) for i, _, removed, h in brute_removed(rows, 50) if not (removed and h == empty)), key=str)
    assert sorted(((r.doc_id, hashlib.sha256(b" ".join((r.text or "").encode().split())).hexdigest()) for r in out), key=str) == want
    assert all(r.n_chars == len(r.text) for r in out if r.text)


def test_pieces_of_every_occurrence_are_drawn_apart(spark):
    word = "internationalization"
    rows = [(k, " ".join([word] * 40)) for k in range(30)] + [(None, f"{k} {word}") for k in range(30)]
    got = pieces.encoded(spark.createDataFrame(rows, "doc_id long, text string"), queries.PIECE_MODEL).collect()
    v = pieces.vocabulary(queries.PIECE_MODEL)

    def cuts(r):
        """The pieces of each word: a word begins with a space."""
        out = []
        for p in r.pieces:
            if v.raw[p].startswith(b" "):
                out.append([])
            out[-1].append(p)
        return [tuple(x) for x in out]
    named, nameless = [cuts(r) for r in got if r.doc_id is not None], [cuts(r)[-1] for r in got if r.doc_id is None]
    assert all(r.lossless for r in got) and all(len(x) == 40 for x in named)
    assert min(len(set(x)) for x in named) > 4  # within a document
    assert len({x[0] for x in named}) > 4 and len(set(nameless)) > 4  # at one place of many documents
    assert len({tuple(x) for x in named}) == 30
