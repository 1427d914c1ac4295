"""URL filters by a Bloom filter cascade.

Rules name a host and a path prefix; a rule fits its host and all subdomains
whose path starts with its prefix, and the longest fitting rule decides. A
url's candidate keys are its host's suffixes (at dots, of at most as many labels as a
rule's host has) joined with its path's prefixes of the lengths that rules have. Whether a key is listed is answered by
a cascade built over all candidate keys of the corpus: level 0 is a Bloom
filter of the listed keys, level 1 one of the unlisted corpus keys that pass
level 0, level 2 one of the listed keys that pass level 1, and so on until none
passes wrongly. So membership is exact for every key of the corpus, without a
join: the cascade is a few bits per listed key and is broadcast. Its size is
counted before it is built and may not exceed ``max_bytes``.

Actions are a second cascade over the listed keys alone.

Edge cases: a null url or one without ``://`` has host and path '', no rule, and
the default verdict. A host without dots is its own only suffix. Repeated rows
and pages are judged each; only the named columns are read. With no rules, or an
empty table, the cascade is empty and nothing is listed.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflow.llm.frames import written
from metroflow.llm.words import U, mix

MAX_BYTES = 256 << 20


class Level:
    def __init__(self, depth: int, n: int, rate: float):
        self.depth = depth
        self.hashes = max(1, round(math.log2(1 / rate)))
        self.bits = max(64, math.ceil(n * 1.4427 * math.log2(1 / rate) / 64) * 64)
        self.words = np.zeros(self.bits // 64, U)

    def places(self, h: np.ndarray) -> np.ndarray:
        """Bit places of each key hash (two 64-bit columns): (keys, hashes)."""
        step = mix(h[:, 1] + U(self.depth))
        start = mix(h[:, 0] ^ U(0x5DEECE66D * (self.depth + 1)))
        return (start[:, None] + np.arange(self.hashes, dtype=U)[None] * (step | U(1))[:, None]) % U(self.bits)

    def test(self, h: np.ndarray) -> np.ndarray:
        p = self.places(h)
        return ((self.words[p >> U(6)] >> (p & U(63))) & U(1)).all(1)


class Cascade:
    def __init__(self, levels: list[Level]):
        self.levels = levels

    def test(self, h: np.ndarray) -> np.ndarray:
        """Whether each key (of the universe it was built over) is listed."""
        listed, open_ = np.zeros(len(h), bool), np.arange(len(h))
        for k, level in enumerate(self.levels):
            passes = level.test(h[open_])
            listed[open_[~passes]] = k % 2 == 1
            open_ = open_[passes]
        listed[open_] = len(self.levels) % 2 == 1
        return listed


def _pairs(batch) -> np.ndarray:
    return np.stack([batch.column("h1").to_numpy(), batch.column("h2").to_numpy()], 1).view(U)


def build(universe: DataFrame, max_bytes: int = MAX_BYTES, max_levels: int = 64) -> Cascade:
    """A cascade over ``universe``: rows (h1, h2, listed), a row per key."""
    spark = universe.sparkSession
    n = {r[0]: r[1] for r in universe.groupBy("listed").count().collect()}
    r, s = n.get(True, 0), n.get(False, 0)
    levels: list[Level] = []
    size = r
    while size and len(levels) < max_levels:
        depth = len(levels)
        rate = min(0.5, max(1e-9, math.sqrt(r / (2 * s)))) if depth == 0 and s else 0.5
        level = Level(depth, size, rate)
        if sum(len(x.words) for x in [*levels, level]) * 8 > max_bytes:
            raise ValueError(f"the cascade needs over {max_bytes} bytes; raise max_bytes or split the list")
        encoded = depth % 2 == 0
        held = spark.sparkContext.broadcast((levels, level))

        def bits(batches, encoded=encoded, held=held):
            earlier, level = held.value
            for b in batches:
                h = _pairs(b)
                for x in earlier:
                    h = h[x.test(h)]
                p = np.unique(level.places(h).ravel())
                word, first = np.unique(p >> U(6), return_index=True)
                if len(word):
                    value = np.bitwise_or.reduceat(U(1) << (p & U(63)), first)
                    yield pa.RecordBatch.from_arrays([pa.array(word.astype(np.int64)), pa.array(value.view(np.int64))], ["word", "value"])

        side = universe.where(F.col("listed") == encoded)
        got = side.mapInArrow(bits, "word long, value long").groupBy("word").agg(F.bit_or("value").alias("value")).toPandas()  # at most bits / 64 rows
        level.words[got["word"].to_numpy(np.int64)] = got["value"].to_numpy(np.int64).view(U)
        levels.append(level)
        held = spark.sparkContext.broadcast(levels)

        def passing(batches, held=held):
            for b in batches:
                h = _pairs(b)
                for x in held.value:
                    h = h[x.test(h)]
                yield pa.RecordBatch.from_arrays([pa.array([len(h)], pa.int64())], ["n"])

        wrong = universe.where(F.col("listed") != encoded).mapInArrow(passing, "n long").agg(F.sum("n")).first()[0]
        size = wrong or 0
    if size:
        raise ValueError("the cascade did not end: two keys share their hashes")
    return Cascade(levels)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both '' without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(host) + 1), r"^[^?#]*", 0)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lower, F.lit("")), F.coalesce(path, F.lit(""))


def candidate_keys(host: Column, path: Column, lengths: list[int], labels: int) -> Column:
    """Every rule that could fit: host suffixes of at most ``labels`` labels, joined with path prefixes."""
    suffixes = F.array_distinct(F.array(*[F.substring_index(host, ".", -k) for k in range(1, max(1, labels) + 1)]))
    prefixes = F.filter(F.array(*[F.when(F.length(path) >= k, F.substr(path, F.lit(1), F.lit(k))) for k in lengths] or [F.lit(None).cast("string")]),
                        lambda p: p.isNotNull())
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.concat(s, p))))


def _hashed(key: Column) -> tuple[Column, Column]:
    return F.xxhash64(key), F.xxhash64(F.lit("second"), key)


def judge(pages: DataFrame, rules: DataFrame, id_col: str = "page_id", url_col: str = "url", default: str = "allow",
          max_bytes: int = MAX_BYTES) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every page; ``rules``: (host, path, verdict block or allow), one row per host and path."""
    spark = pages.sparkSession
    host, path = host_and_path(F.col(url_col).cast("string"))
    src = pages.select(F.col(id_col).alias("page_id"), host.alias("host"), path.alias("path"))
    lengths = sorted(r[0] for r in rules.select(F.length("path")).distinct().collect())
    labels = rules.agg(F.max(F.size(F.split("host", r"\.", -1)))).first()[0] or 1  # a suffix of more labels can't be listed
    src = src.withColumn("keys", F.array_distinct(candidate_keys(F.col("host"), F.col("path"), lengths, labels)))
    named = rules.select(F.concat("host", "path").alias("key"), F.col("verdict"))
    keys = src.select(F.explode("keys").alias("key"), F.lit(False).alias("listed")).union(named.select("key", F.lit(True)))
    h1, h2 = _hashed(F.col("key"))
    universe = written(keys.groupBy("key").agg(F.max("listed").alias("listed")).select(h1.alias("h1"), h2.alias("h2"), "listed"), "url-keys")
    member = build(universe, max_bytes)
    blocked = build(named.select(h1.alias("h1"), h2.alias("h2"), (F.col("verdict") == "block").alias("listed")), max_bytes)
    held = spark.sparkContext.broadcast((member, blocked))
    hashed = src.withColumn("h", F.transform("keys", lambda k: F.array(F.xxhash64(k), F.xxhash64(F.lit("second"), k))))

    def run(batches):
        member, blocked = held.value
        for b in batches:
            keys, flat = b.column("keys"), b.column("h")
            offs = keys.offsets.to_numpy().astype(np.int64)
            h = flat.flatten().flatten().to_numpy().reshape(-1, 2).view(U) if len(keys.flatten()) else np.empty((0, 2), U)
            offs = offs - offs[0]
            text = keys.flatten()
            row = np.repeat(np.arange(len(keys)), np.diff(offs))
            hit = np.flatnonzero(member.test(h)) if len(h) else np.empty(0, np.int64)
            found = text.take(pa.array(hit, pa.int64())).to_pylist()
            rule, verdict = [None] * len(keys), [default] * len(keys)
            block = blocked.test(h[hit]) if len(hit) else []
            for r, k, is_block in zip(row[hit].tolist(), found, block):
                if rule[r] is None or len(k) > len(rule[r]):
                    rule[r], verdict[r] = k, "block" if is_block else "allow"
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("host"), b.column("path"), pa.array(rule, pa.string()), pa.array(verdict, pa.string())],
                                             ["page_id", "host", "path", "rule", "verdict"])
    kind = src.schema["page_id"].dataType.simpleString()
    return hashed.mapInArrow(run, f"page_id {kind}, host string, path string, rule string, verdict string")
