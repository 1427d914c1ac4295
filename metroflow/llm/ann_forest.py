"""Approximate nearest neighbours: a forest of random-projection trees with one priority queue.

Nearness is the largest inner product. Vectors get one more component that
makes their lengths equal (0 for a query), so that order by distance is order by inner
product. Trees are fitted on at most ``sample`` vectors: a node's plane is the
difference of two random sample vectors, cut at the median of its sample. Every
vector is then put into one leaf of each tree.

A query's search keeps one queue over all trees, of nodes by the largest
distance to a plane on their far side; it opens leaves until they hold
``search_share`` times the number of vectors (of ``trees`` times that in all).
Queries meet leaves by a shuffle on (tree, leaf); a leaf of many vectors is split
into blocks of about ``block`` by hash, so that equal vectors don't fill a task.
The first leaves give a bound, the k-th score found so far; the others return
only what reaches it. Scores are inner products in double precision on the
original vectors, ties go to the smaller id.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components
take no part, neither do null ids. Vectors of different lengths have no inner product: each
length has a forest of its own. A query with no more than ``k`` candidates in a small table gets all of them: up to 127 vectors a
tree is one leaf. Rows that repeat an id count as one candidate, the nearest. An empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import heapq
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflow.llm.frames import group_map, written
from metroflow.llm.vectors import dots, lengths, matrix, sample, usable

TREES, DEPTH, SAMPLE, SEARCH_SHARE, BLOCK = 8, 6, 16_384, 1.5, 4096


class Forest:
    def __init__(self, x: np.ndarray, trees: int, depth: int, longest: float, seed: int = 7):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.longest = longest
        x = self.extended(x)
        depth = max(0, min(depth, int(np.log2(max(1, len(x)) / 64)))) if len(x) else 0
        self.trees, self.depth, inner = trees, depth, 2 ** depth - 1
        self.planes, self.cuts = np.zeros((trees, inner, x.shape[1])), np.zeros((trees, inner))
        for t in range(trees):
            own = {0: np.arange(len(x))}
            for k in range(inner):
                i = own.pop(k)
                if len(i) > 1:
                    a, b = x[rng.choice(i, 2, replace=False)]
                    n = a - b
                    n = n / np.linalg.norm(n) if n.any() else rng.standard_normal(len(a)) / np.sqrt(len(a))
                    p = x[i] @ n
                    self.planes[t, k], self.cuts[t, k] = n, np.median(p)
                    right = p > self.cuts[t, k]
                else:
                    right = np.zeros(len(i), bool)
                own[2 * k + 1], own[2 * k + 2] = i[~right], i[right]
        self.sizes = np.zeros((trees, 2 ** depth), np.int64)

    def extended(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        more = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, self.longest - (x * x).sum(1)))
        return np.concatenate((x, more[:, None]), 1)

    def leaves(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each vector in each tree."""
        x, out = self.extended(x), np.zeros((len(x), self.trees), np.int64)
        for t in range(self.trees):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + ((x * self.planes[t][at]).sum(1) > self.cuts[t][at])
            out[:, t] = at - (2 ** self.depth - 1)
        return out

    def search(self, x: np.ndarray, want: float) -> list[list[tuple[int, int]]]:
        """Per query, (tree, leaf) in the order of the shared queue, until the leaves hold ``want`` vectors."""
        side = np.einsum("qd,tnd->qtn", self.extended(x, query=True), self.planes) - self.cuts
        out, inner = [], 2 ** self.depth - 1
        for q in range(len(x)):
            found, held = [], 0
            queue = [(-np.inf, t, 0) for t in range(self.trees)]
            while queue and held < want:
                gap, t, k = heapq.heappop(queue)
                if k >= inner:
                    found.append((t, k - inner))
                    held += self.sizes[t, k - inner]
                    continue
                s = side[q, t, k]
                heapq.heappush(queue, (max(gap, s), t, 2 * k + 1))
                heapq.heappush(queue, (max(gap, -s), t, 2 * k + 2))
            out.append(found)
        return out


def _meet(rows: DataFrame, probes: DataFrame, k: int) -> DataFrame:
    """(query, id, score): of each block of a leaf, a query's ``k`` nearest that reach its bound."""
    cols = ["tree", "leaf", "blk", "id", "v", "bound", "probe"]
    both = rows.withColumn("bound", F.lit(0.0)).withColumn("probe", F.lit(False)).select(cols).union(
        probes.withColumn("probe", F.lit(True)).select(cols))

    def run(_, tables):
        ids, parts = [], []
        base = None
        for t in tables:
            probe = np.array(t.column("probe").to_pylist(), bool)
            cut = int(np.argmax(probe)) if probe.any() else len(probe)
            if cut:
                ids.append(t.column("id").to_numpy()[:cut])
                parts.append(matrix(t.column("v").slice(0, cut)))
            if cut == len(probe) or not ids:
                continue
            if base is None:
                own, base = np.concatenate(ids), np.concatenate(parts)
            for at in range(cut, len(probe), 256):
                part = t.slice(at, min(256, len(probe) - at))
                q, x, bound = part.column("id").to_numpy(), matrix(part.column("v")), part.column("bound").to_numpy()
                near = x @ base.T
                near[q[:, None] == own[None]] = -np.inf
                slack = 1e-9 * (1 + np.abs(near[np.isfinite(near)]).max(initial=0))
                limit = bound - slack
                if near.shape[1] > k:
                    limit = np.maximum(limit, np.partition(near, -k, axis=1)[:, -k] - slack)
                row, col = np.nonzero((near >= limit[:, None]) & (near > -np.inf))
                score = dots(x[row], base[col])
                by = np.lexsort((own[col], -score, row))
                row, col, score = row[by], col[by], score[by]
                place = np.arange(len(row)) - np.searchsorted(row, row)
                keep = place < k  # ties by id are already in order
                yield pa.RecordBatch.from_arrays([pa.array(q[row[keep]]), pa.array(own[col[keep]]), pa.array(score[keep])], ["query", "id", "score"])

    return group_map(both, ["tree", "leaf", "blk"], run, "query long, id long, score double", ["probe"])


def _nearest(found: DataFrame, k: int) -> DataFrame:
    one = found.groupBy("query", "id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return one.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def search(df: DataFrame, queries: Column, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", trees: int = TREES,
           depth: int = DEPTH, sample_size: int = SAMPLE, search_share: float = SEARCH_SHARE, block: int = BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): for each row where ``queries`` (on column ``id``) holds, its ``k`` nearest other rows found."""
    rows = usable(df.where(F.col(id_col).isNotNull()), id_col, vector_col)
    empty = df.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    parts = [_search(rows.where(F.col("size") == n).drop("size"), queries, k, trees, depth, sample_size, search_share, block) for n in lengths(rows)]
    return reduce(DataFrame.union, parts or [empty])


def _search(rows: DataFrame, queries: Column, k: int, trees: int, depth: int, sample_size: int, search_share: float, block: int) -> DataFrame:
    """``search`` among vectors (id, v) of one length."""
    spark = rows.sparkSession
    total, longest = rows.agg(F.count(F.lit(1)), F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x))).first()
    forest = Forest(sample(rows, sample_size, "forest"), trees, depth, longest)
    held = spark.sparkContext.broadcast(forest)
    v = rows.schema["v"].dataType.simpleString()

    def route(batches):
        for b in batches:
            leaves = held.value.leaves(matrix(b.column("v")))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(list(leaves), pa.list_(pa.int64()))], [*b.schema.names, "leaves"])

    routed = written(rows.mapInArrow(route, f"id long, v {v}, leaves array<long>"), "forest-rows")
    each = routed.select("id", "v", F.posexplode("leaves").alias("tree", "leaf"))
    for t, leaf, n in each.groupBy("tree", "leaf").count().collect():  # trees * 2**depth rows
        forest.sizes[t, leaf] = n
    full = spark.sparkContext.broadcast(forest)
    blocks = np.maximum(1, -(-forest.sizes // block)).tolist()
    first = trees

    def probe(batches):
        for b in batches:
            found = full.value.search(matrix(b.column("v")), search_share * total)
            row = [i for i, f in enumerate(found) for t, leaf in f for _ in range(blocks[t][leaf])]
            flat = [(t, leaf, k, n < first) for f in found for n, (t, leaf) in enumerate(f) for k in range(blocks[t][leaf])]
            taken = b.take(pa.array(row, pa.int64()))
            yield pa.RecordBatch.from_arrays([*taken.columns, *(pa.array([x[i] for x in flat], kind) for i, kind in enumerate((pa.int32(), pa.int64(), pa.int64(), pa.bool_())))],
                                             ["id", "v", "tree", "leaf", "blk", "early"])

    asked = written(routed.where(queries).select("id", "v").mapInArrow(probe, f"id long, v {v}, tree int, leaf long, blk long, early boolean"), "forest-probes")
    count = F.element_at(F.element_at(F.array(*[F.array(*map(F.lit, b)) for b in blocks]), F.col("tree") + 1), (F.col("leaf") + 1).cast("int"))
    base = each.withColumn("blk", F.pmod(F.xxhash64("id"), count.cast("long"))).select(F.col("tree").cast("int"), "leaf", "blk", "id", "v")
    early = written(_meet(base, asked.where("early").withColumn("bound", F.lit(float("-inf"))), k), "forest-first")
    bound = _nearest(early, k).where(F.col("rank") == k).select(F.col("query").alias("id"), F.col("score").alias("bound"))
    late = asked.where("not early").join(bound, "id", "left").withColumn("bound", F.coalesce("bound", F.lit(float("-inf"))))
    best = _nearest(early.union(_meet(base, late, k)), k)
    return best.select(F.col("query").alias("query_id"), F.col("rank").cast("int").alias("rank"), F.col("id").alias("vec_id"), "score")
