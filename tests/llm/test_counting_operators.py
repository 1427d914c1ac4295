"""Divergence audit, WARC archives and collocations against brute force, with their stated edge cases."""

import collections
import gzip
import hashlib
import io
import itertools
import re
import zlib

import numpy as np
import pytest
from conftest import SF_SMALL
from pyspark.sql import functions as F

from metroflow.llm import collocations, divergence, frames, queries, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, term string, value int, rank int, k int, phrase string, n int"
PAGES = "page_id long, url string, html string, digest string, id int, payload string"


def text(k, n, alphabet=40):
    rng = np.random.Generator(np.random.PCG64(k))
    return "".join(f"w{x}" + ",.;:!?\n\t"[rng.integers(8)] * (rng.random() < 0.1) + " " for x in (rng.zipf(1.3, n) % alphabet).tolist())


TEXTS = [None, "", "  \n\t..", "Zwölf Boxkämpfer", "a a a a a a. a a", "É é 日本 日本語 x1y2z3", "tab\tand\x0bfeed\x0c\rend", "The the THE tHe", "x" * 3000,
         *(text(k, 60) for k in range(40)), text(99, 6000), text(98, 300), text(98, 300), "ha " * 400]
ROWS = [(None if k == 7 else k // 2 if k % 9 == 0 else k, t, [None, "", "en", "de", "en"][k % 5], [None, "s1", "", "s2", "s3", "s1"][k % 6], 1, "t", 2, 3, 4, "p", 5)
        for k, t in enumerate(TEXTS)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, DOCS)


def lower(t):
    return t.translate({c: c + 32 for c in range(65, 91)})


# --- divergence ---------------------------------------------------------------------------


def brute_divergence(rows, least, top):
    seen, docs_of, groups = collections.defaultdict(collections.Counter), collections.defaultdict(collections.Counter), collections.defaultdict(set)
    for r in rows:
        t, lang, source = (x or "" for x in r[1:4])
        groups[lang].add(source)
        terms = [lower(x) for x in re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", t)]
        seen[lang, source].update(terms)
        docs_of[lang].update(set(terms))
    out = []
    for lang, sources in groups.items():
        kept = sorted(t for t, n in docs_of[lang].items() if n >= least)
        total = collections.Counter()
        for s in sources:
            total.update({t: seen[lang, s][t] for t in kept})

        def p(c):
            n = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}
        of, q = {s: p(seen[lang, s]) for s in sources}, p(total)
        for s in sources:
            pairs = sorted(((-sum(abs(of[s][t] - of[o][t]) for t in kept), o.encode()) for o in sources if o != s))
            out += [(lang, s, "pair", o.decode(), -v, k + 1) for k, (v, o) in enumerate(pairs)]
            terms = sorted((q[t] - of[s][t], t.encode()) for t in kept if seen[lang, s][t] and of[s][t] > q[t])
            out += [(lang, s, "term", t.decode(), -v, k + 1) for k, (v, t) in enumerate(terms[:top])]
    return sorted(out)


@pytest.mark.parametrize("least,top,block", [(3, 50, 512), (1, 7, 1), (2, 3, 2), (10**6, 50, 512)])
def test_divergence(docs, least, top, block):
    got = divergence.audit(docs, least=least, top=top, block=block)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(tuple(r) for r in got.collect()) == brute_divergence(ROWS, least, top)


def test_divergence_of_many_sources_and_large_counts(spark):
    rows = [(k, text(k, 30), "en", f"s{k % 37}", 1, "", 0, 0, 0, "", 0) for k in range(150)]
    assert sorted(tuple(r) for r in divergence.audit(spark.createDataFrame(rows, DOCS), 5, 4, block=10).collect()) == brute_divergence(rows, 5, 4)
    big = spark.createDataFrame([(3 * 10**12, 7 * 10**12, 11)], "c long, n long, v long")  # 10**9 * c is beyond 64 bits
    assert big.select(divergence.share(F.col("c"), F.col("n"), F.col("v"))).first()[0] == 1 + 10**9 * (3 * 10**12 + 5) // (7 * 10**12 + 55)


def test_divergence_of_nothing(docs):
    assert divergence.audit(docs.where("1 = 0")).collect() == []


def test_join_counted_splits_a_hot_key(spark):
    """A key with a third of all rows is dealt over all partitions; null keys meet nothing."""
    rows = spark.range(9000).select("id", F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 9 != 1, F.col("id").cast("string")).alias("key"))
    groups = rows.where("key is not null").groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("low"))
    # the tables here are small enough for Spark to broadcast, and to put into one partition
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    was = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        got = frames.join_counted(rows, groups, ["key"])
        where = got.where("key = 'hot'").groupBy(F.spark_partition_id()).count().collect()
        assert len(where) > 1 and max(r[1] for r in where) < 2000
        assert got.where("key = 'hot' and low = 0 and n = 3000").count() == 3000
        assert got.count() == 9000 and got.where("low is null").count() == 1000
    finally:
        for k, v in was.items():
            spark.conf.set(k, v)


# --- archives ------------------------------------------------------------------------------

LONG = "é" * 60
HTML = [(5, "http://a.b/c d", "<p>" + LONG), (2, None, "<p>" + LONG), (2, "http://x", None), (3, "http://x\r\nWARC-Type: y", ""), (9, "u", "short"), (8, "u", "short"),
        (None, "u", "<p>" + LONG), (None, "v", "only null " * 20), (11, "u", "y" * 99), (12, "u", "y" * 99), (13, "u", "y" * 100), (14, "u", "y" * 100),
        (15, "u", "\r\n\r\nWARC/1.1\r\n\r\n" * 20), (-7, "u", "big " * 400_000), (21, "u", "big " * 400_000), (30, "u", "z" * 200), (30, "u", "z" * 200)]


@pytest.fixture(scope="module")
def pages(spark):
    return spark.createDataFrame([(i, u, h, "d", 1, "p") for i, u, h in HTML], PAGES)


def brute_pages():
    low = collections.defaultdict(list)
    for i, _, h in HTML:
        low[h or ""].append(i)
    for i, _, h in HTML:
        b = (h or "").encode()
        first = min((x for x in low[h or ""] if x is not None), default=None)
        later = len(b) >= 100 and len(low[h or ""]) > 1 and i != first
        yield i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if later else "response", first if later else None


@pytest.mark.parametrize("archive_bytes", [1 << 28, 700])
def test_warc_round_trip(pages, archive_bytes):
    manifest = warc.write(pages, archive_bytes=archive_bytes)
    records = warc.read(manifest, with_payload=True)
    got = records.where("record_type <> 'warcinfo'").select(warc.key_of("record_id"), "payload_bytes", "payload_digest", "record_type", warc.key_of("refers_to"), "error").collect()
    assert sorted(((*r[:5],) for r in got), key=str) == sorted(brute_pages(), key=str) and not any(r.error for r in got)
    assert manifest.agg(F.sum("records")).first()[0] == len(HTML)
    texts = {bytes(r.payload).decode() for r in records.where("record_type = 'response'").collect()}
    assert texts == {h or "" for _, _, h in HTML}
    assert warc.unmatched_revisits(records).count() == 0
    assert warc.unmatched_revisits(records.where("record_id <> '<urn:page:-7>'")).collect() == [("<urn:page:-7>", 1)]
    targets = {r.target_uri for r in records.where("record_type <> 'warcinfo'").collect()}
    assert targets == {None, "http://a.b/c%20d", "http://x", "http://x%0D%0AWARC-Type:%20y", "u", "v"}
    folder = manifest.first().archive.rsplit("/", 1)[0]
    assert warc.archives(pages.sparkSession, folder).count() == manifest.count()


def test_warc_members_are_records(pages):
    """Other readers agree: each member alone decompresses to one record that ends with two line ends."""
    n = 0
    for r in warc.write(pages).collect():
        data = open(re.sub("^file:/+", "/", r.archive), "rb").read()
        assert gzip.decompress(data).count(b"WARC/1.1\r\nWARC-Type: ") == r.records + 1
        while data:
            z = zlib.decompressobj(31)
            one = z.decompress(data) + z.flush()
            data, n = z.unused_data, n + 1
            head, _, rest = one.partition(b"\r\n\r\n")
            size = int(re.search(rb"Content-Length: (\d+)$", head).group(1))
            assert rest[size:] == b"\r\n\r\n" and one.startswith(b"WARC/1.1\r\n")
            assert f"sha256:{hashlib.sha256(rest[:size]).hexdigest()}".encode() in head
    assert n >= len(HTML) + 1


class Slow(io.RawIOBase):
    """A stream that gives a few bytes at a time."""

    def __init__(self, data, step=7):
        self.data, self.step = io.BytesIO(data), step

    def read(self, n=-1):
        return self.data.read(min(n, self.step) if n > 0 else self.step)


def member(fields, block, end=b"\r\n\r\n", length=None):
    head = "\r\n".join(["WARC/1.0", *(f"{k}: {v}" for k, v in fields), f"Content-Length: {len(block) if length is None else length}", "", ""])
    return gzip.compress(head.encode() + block + end)


def test_warc_reader_of_foreign_and_broken_records():
    good = warc.page_record(1, "u", b"payload" * 50, hashlib.sha256(b"payload" * 50).hexdigest(), None, "2024-01-01T00:00:00Z")
    sha1 = member([("WARC-Type", "resource"), ("warc-record-id", "<a>"), ("WARC-Payload-Digest", "sha1:" + __import__("base64").b32encode(hashlib.sha1(b"abc").digest()).decode())], b"abc")
    folded = member([("WARC-Type", "metadata"), ("WARC-Target-URI", "x\r\n y")], b"")
    bad = {"block digest": member([("WARC-Type", "resource"), ("WARC-Block-Digest", "sha256:00")], b"abc"),
           "payload digest": member([("WARC-Type", "resource"), ("WARC-Payload-Digest", "md5:00")], b"abc"),
           "a record doesn't end where its member does": member([("WARC-Type", "resource")], b"abc", b"\r\n\r\nmore"),
           "a block shorter than its Content-Length": member([("WARC-Type", "resource")], b"abc", length=900),
           "no Content-Length": member([("WARC-Type", "resource")], b"abc", length="x"),
           "no WARC version line": gzip.compress(b"HTTP/1.1 200 OK\r\n\r\n"), "an unfinished line": gzip.compress(b"WARC/1.1"),
           "a field without a colon": gzip.compress(b"WARC/1.1\r\nnonsense\r\n\r\n")}
    data = good + sha1 + folded
    for x in bad.values():
        data += x + good
    for step in (7, 1 << 20):
        got = list(warc.read_archive(Slow(data, step), with_payload=True))
        assert [r.get("error") for r in got] == [None, None, None, *itertools.chain.from_iterable((e, None) for e in bad)]
        assert got[1]["payload"] == b"abc" and got[2]["target_uri"] == "x y"
        assert got[0]["payload_digest"] == hashlib.sha256(b"payload" * 50).hexdigest() and got[0]["payload_bytes"] == 350
        assert [r["offset"] for r in got][:3] == [0, len(good), len(good) + len(sha1)]
    hurt = bytearray(good * 3)
    hurt[len(good) + 25:len(good) + 60] = b"\xff" * 35  # the second member can't be decompressed: the third is still found
    got = list(warc.read_archive(Slow(bytes(hurt), 1 << 20)))
    assert got[0].get("error") is None and got[1]["error"].startswith("gzip") and got[-1].get("error") is None and got[-1]["record_id"] == "<urn:page:1>"
    cut = list(warc.read_archive(Slow(good + good[:-20])))
    assert [r.get("error") for r in cut] == [None, "truncated member"]


def test_warc_of_nothing(pages):
    manifest = warc.write(pages.where("1 = 0"))
    assert manifest.count() == 0 and warc.read(manifest).count() == 0


# --- collocations ----------------------------------------------------------------------------


def brute_counts(rows):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(r[1] or "")):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f[lang].update(tuple(w[i:i + k]) for k in range(1, 5) for i in range(len(w) - k + 1))
    return f, n


def brute_collocations(rows, least, inside, top):
    f, n = brute_counts(rows)
    out = []
    for lang, c in f.items():
        cand = {g: a for g, a in c.items() if len(g) > 1 and a >= least}
        best = collections.Counter()
        for g, a in cand.items():
            for k in range(2, len(g)):
                for i in range(len(g) - k + 1):
                    best[g[i:i + k]] = max(best[g[i:i + k]], a)
        got = []
        for g, a in cand.items():
            if g in best and 100 * best[g] >= inside * a:
                continue
            score, k = min((2_000_000 * a // (c[g[:k]] + c[g[k:]]), k) for k in range(1, len(g)))
            got.append((-score, -a, " ".join(g).encode(), c[g[:k]], c[g[k:]]))
        out += [(lang, r + 1, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(got)[:top])]
    return sorted(out)


@pytest.mark.parametrize("least,inside,top,block", [(3, 80, 2000, 1 << 24), (2, 50, 20, 2000), (1, 101, 100_000, 300)])
def test_collocations(docs, least, inside, top, block):
    got = collocations.collocations(docs, least=least, inside=inside, top=top, block_bytes=block)
    assert sorted(tuple(r) for r in got.collect()) == brute_collocations(ROWS, least, inside, top)


@pytest.mark.parametrize("block", [200, 5000, 1 << 24])
def test_counts_over_many_ranges(docs, block):
    f, n = brute_counts(ROWS)
    want = {(lang, len(g), " ".join(g), a) for lang, c in f.items() for g, a in c.items() if a >= 2} | {(lang, 0, "", x) for lang, x in n.items() if x}
    assert {tuple(r) for r in collocations.counts(docs, least=2, block_bytes=block).collect()} == want


def test_automata_hold_their_paths():
    rng = np.random.Generator(np.random.PCG64(8))
    for n, alphabet in ((0, 3), (1, 1), (400, 3), (3000, 50)):
        paths, weights = collocations.summed([rng.integers(0, alphabet, n) for _ in range(4)], rng.integers(1, 3, n), alphabet)
        a = collocations.Automaton.build(paths, weights)
        back, w = collocations.Automaton.unpack(a.pack()).paths()
        assert all((x == y).all() for x, y in zip(back, paths)) and (w == weights).all()
        same = collocations.Automaton.build(paths, np.ones_like(weights))
        if n == 400:  # equal right languages are one state: there are at most 7 sets of 3 labels
            assert len(same.levels[3][0]) <= 7 < len(np.unique(paths[0] * 9 + paths[1] * 3 + paths[2]))


def test_collocations_of_nothing(docs):
    assert collocations.collocations(docs.where("1 = 0")).collect() == []


def test_new_queries_on_given_tables(spark, duck):
    from tools.check_oracle import rows
    for name in ("op11_divergence", "op12_warc", "op13_collocations"):
        s, o = queries.QUERIES[name](spark, SF_SMALL).toPandas(), duck.execute(queries.ORACLES[name]).df()
        assert rows(s[sorted(o.columns)]) == rows(o) and len(s)
