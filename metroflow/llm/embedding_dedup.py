"""Embedding near-dedup by product quantisation: links of equal label and cosine at least ``threshold``.

Equal vectors of a label form one class, compared once. Vectors are scaled to
length 1; a cosine of t is a distance of r = sqrt(2 - 2 t). Coarse centroids and, for
the residuals, a codebook per subspace are fitted on at most ``sample`` vectors.
Every vector is a member of its nearest centroid's inverted list (one per label and
centroid), stored with its residual's codes and the length of its coding error.

A vector probes its own list and those of higher number that can hold a
neighbour: its distance to the plane between the two centroids is at most r. That is
sufficient: of two linked vectors the one in the lower list always probes the other's.
In a list, the table of distances from the probe's residual to the codewords
gives the distance to each coded member; one that exceeds r by more than the
member's coding error can't link, the others are compared exactly, in double precision
on the original vectors. So no link is lost: the index is exact at any size.

A task holds one block of a list, of about ``block`` members dealt by hash, and streams
its probes. It returns counts of links per vector and only those links that
connect its vectors (a spanning forest), never all pairs.

Edge cases: a null label, or a vector that is null, empty, zero, or holds null or non-finite
components: no links, its own component, kept. Vectors of different lengths have no
cosine and don't link; each length has an index of its own. Rows that repeat a vector and
label link with each other, whatever their ids; rows that share an id are vectors each, and a
null id names no component: such a component has the least id of its others, or
null if it has none. An empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflow.llm.frames import components, group_map, join_counted, written
from metroflow.llm.jaccard_join import _Union
from metroflow.llm.vectors import dots, lengths, matrix, sample, usable, valid

LINKS = "a long, b long, links long"
LISTS, PARTS, WORDS, SAMPLE, BLOCK = 32, 8, 64, 8192, 4096


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.sqrt((x * x).sum(1))[:, None]


def _means(x: np.ndarray, k: int, rng, rounds: int = 10) -> np.ndarray:
    """k-means centres, at most ``k``."""
    c = np.unique(x[rng.choice(len(x), min(k, len(x)), replace=False)], axis=0)
    for _ in range(rounds):
        near = ((c * c).sum(1) - 2 * x @ c.T).argmin(1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = np.where(n[:, None] > 0, total / np.maximum(n, 1)[:, None], c)
    return np.unique(c, axis=0)


class Index:
    def __init__(self, x: np.ndarray, lists: int, parts: int, words: int, seed: int = 11):
        rng = np.random.Generator(np.random.PCG64(seed))
        x = _unit(x)
        self.coarse = _means(x, lists, rng)
        self.bounds = np.linspace(0, x.shape[1], min(parts, x.shape[1]) + 1).astype(int)
        rest = x - self.coarse[self.nearest(x)]
        self.books = [_means(rest[:, a:b], words, rng) for a, b in zip(self.bounds[:-1], self.bounds[1:])]

    def distances(self, x):
        return np.maximum(0, (x * x).sum(1)[:, None] - 2 * x @ self.coarse.T + (self.coarse ** 2).sum(1))

    def nearest(self, x):
        return self.distances(x).argmin(1)

    def encode(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of residuals and the length of the error that coding makes."""
        codes, error = np.empty((len(rest), len(self.books)), np.uint8), np.zeros(len(rest))
        for k, (a, b) in enumerate(zip(self.bounds[:-1], self.bounds[1:])):
            book, part = self.books[k], rest[:, a:b]
            codes[:, k] = ((book * book).sum(1) - 2 * part @ book.T).argmin(1)
            error += ((part - book[codes[:, k]]) ** 2).sum(1)
        return codes, np.sqrt(error)

    def table(self, rest: np.ndarray) -> list[np.ndarray]:
        """Squared distances of residuals to all codewords, per subspace."""
        return [((rest[:, a:b, None] - book.T[None]) ** 2).sum(1) for book, a, b in zip(self.books, self.bounds[:-1], self.bounds[1:])]

    def probes(self, x: np.ndarray, own: np.ndarray, r: float) -> np.ndarray:
        """Which lists each vector probes: its own, and higher ones that may hold a vector within r."""
        d = self.distances(x)
        gap = np.sqrt(((self.coarse[own][:, None] - self.coarse[None]) ** 2).sum(2))
        to_plane = (d - d[np.arange(len(x)), own][:, None]) / (2 * np.maximum(gap, 1e-12))
        return ((to_plane <= r + 1e-9) & (np.arange(len(self.coarse))[None] > own[:, None])) | (np.arange(len(self.coarse))[None] == own[:, None])


def _classes(rows: DataFrame) -> DataFrame:
    """``rows`` (id, v, label, size) with ``key``, a digest of the vector's components."""
    types = {f.name: f.dataType.simpleString() for f in rows.schema.fields}

    def run(batches):
        for b in batches:
            ends = np.cumsum(b.column("size").to_numpy())
            flat = b.column("v").flatten().to_numpy(zero_copy_only=False).astype(np.float64) + 0.0  # -0.0 equals 0.0
            digests = [hashlib.blake2b(flat[i:j].tobytes(), digest_size=16).digest() for i, j in zip(np.concatenate(([0], ends[:-1])), ends)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(digests, pa.binary())], [*b.schema.names, "key"])
    return rows.mapInArrow(run, ", ".join(f"{n} {t}" for n, t in types.items()) + ", key binary")


def _compare(index, r: float, threshold: float):
    """Group function: a block of an inverted list (probe false) and then its probes."""
    def run(key, tables):
        ids, parts, mult, code, err = [], [], [], [], []
        base = None
        for t in tables:
            probe = np.array(t.column("probe").to_pylist(), bool)
            cut = int(np.argmax(probe)) if probe.any() else len(probe)
            if cut:
                m = t.slice(0, cut)
                ids.append(m.column("id").to_numpy())
                parts.append(matrix(m.column("v")))
                mult.append(m.column("n").to_numpy())
                code.append(np.frombuffer(b"".join(m.column("code").to_pylist()), np.uint8).reshape(cut, -1))
                err.append(m.column("error").to_numpy())
            if cut == len(probe) or not ids:
                continue
            if base is None:
                ix = index.value
                own, base, weight, codes, error = (np.concatenate(x) for x in (ids, parts, mult, code, err))
                centre, size = ix.coarse[key[1]], np.sqrt((base * base).sum(1))
                union, node = _Union(len(own)), {}
                place = {int(i): k for k, i in enumerate(own)}
            linked = np.zeros(len(own), np.int64)
            for at in range(cut, len(probe), 128):
                part = t.slice(at, min(128, len(probe) - at))
                q, x, qn, home = part.column("id").to_numpy(), matrix(part.column("v")), part.column("n").to_numpy(), np.array(part.column("home").to_pylist(), bool)
                rest = _unit(x) - centre
                far = np.zeros((len(x), len(own)))
                for k, tab in enumerate(ix.table(rest)):
                    far += tab[:, codes[:, k]]
                may = np.sqrt(far) <= r + error[None] + 1e-9
                may &= ~home[:, None] | (q[:, None] < own[None])  # a pair of one list once
                row, col = np.nonzero(may)
                ok = np.zeros(len(row), bool)
                for k in range(0, len(row), 200_000):
                    a, b = row[k:k + 200_000], col[k:k + 200_000]
                    ok[k:k + 200_000] = dots(x[a], base[b]) >= threshold * np.sqrt((x * x).sum(1))[a] * size[b]
                row, col = row[ok], col[ok]
                if not len(row):
                    continue
                linked += np.bincount(col, qn[row], len(own)).astype(np.int64)
                count = np.bincount(row, weight[col], len(q)).astype(np.int64)
                pairs = []
                for i, j in zip(row.tolist(), col.tolist()):
                    me = place.get(int(q[i]))
                    if me is None:
                        me = node.get(int(q[i]))
                        if me is None:
                            me = node[int(q[i])] = len(union.up)
                            union.up.append(me)
                    if union.join(me, j):
                        pairs.append((int(q[i]), int(own[j])))
                hit = np.flatnonzero(count)
                yield _found(q[hit], count[hit], pairs)
            hit = np.flatnonzero(linked)
            if len(hit):
                yield _found(own[hit], linked[hit], [])
    return run


def _found(ids, counts, pairs) -> pa.RecordBatch:
    """Rows (a, b null, links of a) and (a, b, 0)."""
    a = np.concatenate((ids, [p[0] for p in pairs])).astype(np.int64)
    b = pa.array([None] * len(ids) + [p[1] for p in pairs], pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a), b, pa.array(np.concatenate((counts, np.zeros(len(pairs), np.int64))).astype(np.int64))], ["a", "b", "links"])


def near_duplicates(df: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    lists: int = LISTS, parts: int = PARTS, words: int = WORDS, sample_size: int = SAMPLE, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept`` (see the module's notes)."""
    ok = F.col("label").isNotNull() & valid(F.col("v"))
    every = df.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v"), F.col(label_col).alias("label"))
    rows = usable(every.where("label is not null"), "id", "v", "label")
    keyed = written(_classes(rows), "embedding-classes")
    # a class is equal vectors of a label and length; it goes by a number of its own, whatever its rows' ids are
    classes = keyed.groupBy("label", "size", "key").agg(F.min("id").alias("low"), F.count(F.lit(1)).alias("n"), F.min("v").alias("v"))
    classes = written(classes.withColumn("id", F.monotonically_increasing_id()), "embedding-groups")
    found = reduce(DataFrame.union, [_links(classes.where(F.col("size") == n), threshold, lists, parts, words, sample_size, block) for n in lengths(keyed)] or
                   [df.sparkSession.createDataFrame([], LINKS)])
    found = written(found, "embedding-links")
    links = found.where("links > 0").groupBy("a").agg(F.sum("links").alias("links"))
    component = components(found.where("b is not null").select("a", "b")).withColumnRenamed("label", "component")
    named = classes.select("label", "size", "key", "id", "low", "n").join(links, F.col("id") == F.col("a"), "left").join(component, F.col("id") == F.col("node"), "left") \
        .withColumn("component", F.coalesce("component", "id"))
    least = named.groupBy("component").agg(F.min("low").alias("component_id"))
    named = named.join(least, "component").select("label", "size", "key", "n", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    each = join_counted(keyed.select("id", "label", "size", "key"), named, ["label", "size", "key"], how="inner").select(F.col("id").alias("vec_id"), "n_links", "component_id")
    alone = every.where(~ok).select(F.col("id").alias("vec_id"), F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return each.union(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.col("component_id").isNull()))


def _links(classes: DataFrame, threshold: float, lists: int, parts: int, words: int, sample_size: int, block: int) -> DataFrame:
    """(a, b, links) among classes (id, label, v, n) of vectors of one length."""
    spark = classes.sparkSession
    index = spark.sparkContext.broadcast(Index(sample(classes, sample_size, "codebooks"), lists, parts, words))
    r = float(np.sqrt(max(0.0, 2 - 2 * threshold)))
    v, label = (classes.schema[c].dataType.simpleString() for c in ("v", "label"))

    def assign(batches):
        for b in batches:
            ix, x = index.value, _unit(matrix(b.column("v")))
            own = ix.nearest(x)
            codes, error = ix.encode(x - ix.coarse[own])
            asks = [np.flatnonzero(p).tolist() for p in ix.probes(x, own, r)]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(own.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(error), pa.array(asks, pa.list_(pa.int32()))],
                                             [*b.schema.names, "list", "code", "error", "asks"])

    coded = written(classes.select("label", "id", "n", "v").mapInArrow(assign, f"label {label}, id long, n long, v {v}, list int, code binary, error double, asks array<int>"), "embedding-codes")
    sizes = coded.groupBy("label", "list").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks"))
    cols = ["label", "list", "blk", "id", "n", "v", "code", "error", "home", "probe"]
    members = coded.join(sizes, ["label", "list"]).withColumn("blk", F.pmod(F.xxhash64("id"), F.col("blocks"))) \
        .withColumn("home", F.lit(False)).withColumn("probe", F.lit(False)).select(cols)
    asked = coded.select("label", F.col("list").alias("own"), F.explode("asks").alias("list"), "id", "n", "v").join(sizes, ["label", "list"]) \
        .withColumn("blk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))) \
        .withColumn("home", F.col("own") == F.col("list")).withColumn("probe", F.lit(True)) \
        .withColumn("code", F.lit(None).cast("binary")).withColumn("error", F.lit(None).cast("double")).select(cols)
    return group_map(members.union(asked), ["label", "list", "blk"], _compare(index, r, threshold), LINKS, ["probe"])
