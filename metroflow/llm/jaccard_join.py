"""N-gram Jaccard join: prefix-tree join over globally ordered shingle sets.

A document's set is its distinct ``n``-word shingles, as 64-bit hashes. Two
documents link when ``100 * intersection >= percent * union``; the result is
one row per document with the smallest document id reachable by links.

1. Equal sets form one class, named by a hash of the set; from here on a class is one set.
   Ids come in again at the end, when a component takes its smallest one.
2. Prefix filter. All sets share one order of shingles: a hash-chosen part of
   them first, rarest first, then the others by hash, then very frequent ones.
   Linked sets share a shingle among their first ``size - ceil(size * t) + 1``,
   so a set whose prefix holds only shingles of its own links with nothing.
   Only the hash-chosen part is counted, which is a fixed share of the
   shingles and longer than the prefix.
3. Of the sets that share a prefix shingle, those whose parity sketches (a bit per
   hash bucket, the parity of its shingles) differ in more bits than linked sets may
   differ in shingles are told apart; the others, directly or in a chain, form a
   candidate group. Only which sets hang together is kept, never all pairs: a set is
   compared with those it isn't connected with yet. A shingle in more than
   ``shared_block`` prefixes connects its sets without a look at the sketches.
4. Each group's sets go once to a task, which keeps them in a path-compressed
   trie in the order of hashes. A set walks the trie: the overlap of a shared
   path is counted once for all sets below, and a subtree is left when the
   lengths that remain can't reach the needed overlap, or when all below is
   already connected with the set.
5. A group of more than ``block_shingles`` shingles is split into blocks by
   hash. Blocks are joined within themselves; a few members of each block's
   largest component are joined across blocks, 64 blocks at a time; then every
   set outside the group's largest component walks the tries of all blocks.
   So every pair that may link is examined or already connected, no task holds
   more than a block, and a group of near copies costs no quadratic work.

Edge cases: a null, empty or wordless text has an empty set, size 0, and links
with nothing (its component is its own id). Repeated rows give a row each. A
null id takes the smallest non-null id of its component, else null; texts that
share an id link each on its own. Other columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroflow.llm.frames import components, group_map, join_counted, text_hash, written
from metroflow.llm.words import mix, sequence_hash, shingle_sets, signed

#: A shingle in more than this share of a task's documents, and of half this share of all, is very frequent.
FREQUENT = 0.01
BLOCK_SHINGLES = 400_000
SHARED_BLOCK = 4096
SKETCH_BITS = 4096
HUB_MEMBERS = 32
HUB_BLOCKS = 64


def prefix_length(size, percent: int):
    """How many first shingles of a set of ``size`` must hold one of any linked set's."""
    return size - (-(-size * percent // 100)) + 1


def links(common: int, x: int, y: int, percent: int) -> bool:
    return (100 + percent) * common >= percent * (x + y)


def most_apart(x, y, percent: int):
    """In how many shingles two linked sets of these sizes differ at most."""
    return (x + y) * (100 - percent) // (100 + percent)


def sketch(s: np.ndarray, percent: int) -> bytes:
    """Parities of the set's shingles by hash bucket. Two sets' sketches differ in no more bits than the sets in shingles.

    A longer sketch folds to a shorter one (by halves), so sets of unlike sizes compare.
    """
    bits = 64
    while bits < min(SKETCH_BITS, 4 * most_apart(len(s), len(s), percent) + 64):
        bits *= 2
    odd = np.bincount((mix(s ^ np.uint64(0x5851F42D)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


class Sketches:
    """Sketches of many sets, for comparing pairs in bulk."""

    def __init__(self, sizes: np.ndarray, raw: list[bytes], percent: int):
        self.sizes, self.percent = sizes, percent
        self.words = np.array([len(r) // 8 for r in raw], np.int64)
        self.row, self.by = np.zeros(len(raw), np.int64), {}
        for w in np.unique(self.words).tolist():
            at = np.flatnonzero(self.words == w)
            self.row[at] = np.arange(len(at))
            self.by[w] = np.frombuffer(b"".join(raw[i] for i in at.tolist()), np.uint64).reshape(len(at), w)

    def _folded(self, i: np.ndarray, width: int, to: int) -> np.ndarray:
        x = self.by[width][self.row[i]]
        return np.bitwise_xor.reduce(x.reshape(len(i), width // to, to), axis=1) if width > to else x

    def may_link(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether each pair's sizes and sketches allow a link."""
        x, y = self.sizes[i], self.sizes[j]
        out = 100 * np.minimum(x, y) >= self.percent * np.maximum(x, y)
        near = np.flatnonzero(out)
        wide, other = self.words[i[near]], self.words[j[near]]
        for a, b in {*zip(wide.tolist(), other.tolist())}:
            own = near[(wide == a) & (other == b)]
            for k in range(0, len(own), 50_000):
                at = own[k:k + 50_000]
                to = min(a, b)
                apart = np.bitwise_count(self._folded(i[at], a, to) ^ self._folded(j[at], b, to)).sum(1)
                out[at] = apart <= most_apart(x[at], y[at], self.percent)
        return out


class _Union:
    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        self.up[max(i, j)] = min(i, j)
        return i != j


class _Node:
    __slots__ = ("part", "depth", "low", "high", "members", "children", "any", "whole")


class Trie:
    """A path-compressed trie of ascending arrays; ``walk`` reports links of a probe outside its own component."""

    def __init__(self, sets: list[np.ndarray], percent: int, union: _Union):
        self.sets, self.percent, self.union = sets, percent, union
        order = sorted(range(len(sets)), key=lambda i: sets[i].astype(">u8").tobytes())
        shared = [0] * (len(order) + 1)  # of each set with the one before
        for k in range(1, len(order)):
            x, y = sets[order[k - 1]], sets[order[k]]
            m = min(len(x), len(y))
            differ = np.flatnonzero(x[:m] != y[:m])
            shared[k] = int(differ[0]) if len(differ) else m
        self.roots = self._build(order, shared)

    def _build(self, order: list[int], shared: list[int]) -> list[_Node]:
        """Nodes of the ranges of sorted sets that share a path, made without recursion."""
        roots: list[_Node] = []
        work = [(0, len(order), 0, roots)]
        while work:
            lo, hi, depth, out = work.pop()
            first = lo
            for k in range(lo + 1, hi + 1):
                if k < hi and shared[k] > depth:
                    continue
                node = _Node()
                own = order[first:k]
                end = min([len(self.sets[own[0]]), *shared[first + 1:k]]) if k - first > 1 else len(self.sets[own[0]])
                node.part, node.depth = self.sets[own[0]][depth:end], end
                sizes = [len(self.sets[i]) for i in own]
                node.low, node.high = min(sizes), max(sizes)
                node.members = [i for i in own if len(self.sets[i]) == end]
                node.any, node.whole, node.children = own[0], k - first == 1, []
                rest = first + len(node.members)  # a set that ends here sorts before those that go on
                if rest < k:
                    work.append((rest, k, end, node.children))
                out.append(node)
                first = k
        return roots

    def walk(self, x: np.ndarray, me: int):
        """Yield sets that link with ``x`` and aren't connected with ``me`` yet; the caller joins them."""
        percent, n, find = self.percent, len(x), self.union.find
        work = [(node, 0, 0, False) for node in self.roots]
        while work:
            node, at, common, seen = work.pop()
            if seen:  # its children are done: is all below one component?
                node.whole = all(c.whole and find(c.any) == find(node.any) for c in node.children) and all(
                    find(i) == find(node.any) for i in node.members)
                continue
            if node.whole and find(node.any) == find(me):
                continue
            if len(node.part):
                pos = np.searchsorted(x[at:], node.part)
                inside = pos < n - at
                common += int(np.count_nonzero(x[at:][pos[inside]] == node.part[inside]))
                at += int(pos[-1])
                if at < n and x[at] == node.part[-1]:
                    at += 1
            size = min(max(n - at + node.depth, node.low), node.high)  # the most favourable below
            if not links(common + min(n - at, size - node.depth), n, size, percent):
                continue
            for i in node.members:
                if find(i) != find(me) and links(common, n, len(self.sets[i]), percent):
                    yield i
            if node.children:
                if not node.whole:
                    work.append((node, 0, 0, True))
                work.extend((c, at, common, False) for c in node.children)


def _read(tables, column="set") -> tuple[list[int], list[np.ndarray]]:
    ids, sets = [], []
    for t in tables:
        col = t.column(column)
        values, offs = col.values.to_numpy().view(np.uint64), col.offsets.to_numpy()
        ids += t.column("key").to_pylist()
        sets += [values[a:b].copy() for a, b in zip(offs[:-1], offs[1:])]
    return ids, sets


def _edges(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.int64()), pa.array([p[1] for p in pairs], pa.int64())], ["a", "b"])


def join_within(ids: list[int], sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that connect all linked sets (a spanning forest of the link graph)."""
    union, out = _Union(len(sets)), []
    if len(sets) < 2:
        return out
    trie = Trie(sets, percent, union)
    for me, x in enumerate(sets):
        for i in trie.walk(x, me):
            if union.join(me, i):
                out.append((ids[me], ids[i]))
    return out


def _sized(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> DataFrame:
    """Pass 1: (id, hash of the text, size, key of the set, sketch) per document, and per task its frequent shingles."""
    def run(batches):
        most, counts, seen, docs_seen = [], (np.empty(0, np.uint64), np.empty(0, np.int64)), 0, 0

        def folded():
            v, c = np.unique(np.concatenate(most), return_counts=True)
            both, at = np.unique(np.concatenate([counts[0], v]), return_inverse=True)
            total = np.bincount(at, np.concatenate([counts[1], c])).astype(np.int64)
            keep = total >= max(2, FREQUENT * docs_seen / 4)  # a lossy count: it only orders the shingles
            return both[keep], total[keep]

        for b in batches:
            sizes, keys, marks = [], [], []
            for s in shingle_sets(b.column("t").to_pylist(), n):
                sizes.append(len(s))
                keys.append(sequence_hash(s) if len(s) else 0)
                marks.append(sketch(s, percent))
                docs_seen += 1
                if len(s):
                    most.append(s)
                    seen += len(s)
                    if seen > 2_000_000:
                        counts, most, seen = folded(), [], 0
            yield pa.RecordBatch.from_arrays(
                [b.column("id"), b.column("text_hash"), pa.array(sizes, pa.int64()), pa.array(np.array(keys, np.uint64).view(np.int64)),
                 pa.nulls(len(sizes), pa.list_(pa.int64())), pa.nulls(len(sizes), pa.list_(pa.int64())), pa.array(marks, pa.binary())],
                ["id", "text_hash", "size", "key", "hot", "hot_n", "sketch"])
        if most:
            counts = folded()
        keep = counts[1] >= max(3, FREQUENT * docs_seen)
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.int64()), pa.array([0], pa.int64()), pa.array([-docs_seen], pa.int64()), pa.array([0], pa.int64()),
             pa.array([counts[0][keep].view(np.int64)], pa.list_(pa.int64())), pa.array([counts[1][keep]], pa.list_(pa.int64())),
             pa.nulls(1, pa.binary())], ["id", "text_hash", "size", "key", "hot", "hot_n", "sketch"])

    src = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("text_hash"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return src.mapInArrow(run, "id long, text_hash long, size long, key long, hot array<long>, hot_n array<long>, sketch binary")


def _frequent(sized: DataFrame) -> np.ndarray:
    """Shingles in over half of FREQUENT of all documents, ascending: at most the mean set size * 2 / FREQUENT values."""
    marks = sized.where("hot is not null")
    total = marks.agg(F.sum("size")).first()[0] or 0
    hot = (marks.select(F.explode(F.arrays_zip("hot", "hot_n")).alias("x")).groupBy("x.hot").agg(F.sum("x.hot_n").alias("n"))
           .where(F.col("n") >= max(3, -total * FREQUENT / 2)))
    return np.sort(np.array([r[0] for r in hot.select("hot").collect()], np.int64).view(np.uint64))


def _prefix_entries(docs, id_col, text_col, n, percent, hot) -> DataFrame:
    """Pass 2: rows (token, key, size, counted). counted: how many counted tokens the set has; -1: surely in the prefix."""
    spark = docs.sparkSession
    hot_b = spark.sparkContext.broadcast(hot)
    share = min(1.0, 1.8 * (1 - percent / 100))
    limit = np.uint64(int(share * (2**64 - 1)))

    def run(batches):
        hot = hot_b.value
        for b in batches:
            cols = [[], [], [], []]
            for s in shingle_sets(b.column("t").to_pylist(), n):
                size = len(s)
                if not size:
                    continue
                key = np.uint64(sequence_hash(s))
                # which ones are counted is decided by a second mix, so that the walk's order (by hash) stays free
                rank = mix(s ^ np.uint64(0xA5A5A5A5))
                frequent = np.isin(s, hot, assume_unique=True) if len(hot) else np.zeros(size, bool)
                count = (rank <= limit) & ~frequent
                k = int(count.sum())
                own = s[count]
                cols[0].append(own)
                cols[1].append(np.full(k, key))
                cols[2].append(np.full(k, size, np.int64))
                cols[3].append(np.full(k, k, np.int64))
                more = prefix_length(size, percent) - k
                if more > 0:
                    rest, order = s[~count], np.lexsort((rank[~count], frequent[~count]))
                    sure = rest[order[:more]]
                    cols[0].append(sure)
                    cols[1].append(np.full(len(sure), key))
                    cols[2].append(np.full(len(sure), size, np.int64))
                    cols[3].append(np.full(len(sure), -1, np.int64))
                if sum(map(len, cols[0][-64:])) > 200_000 or len(cols[0]) > 2000:
                    yield _entries(cols)
                    cols = [[], [], [], []]
            if cols[0]:
                yield _entries(cols)

    src = docs.select(F.col(text_col).cast("string").cast("binary").alias("t"))
    return src.mapInArrow(run, "token long, key long, size long, counted long")


def _entries(cols) -> pa.RecordBatch:
    a = [np.concatenate(c) for c in cols]
    return pa.RecordBatch.from_arrays([pa.array(signed(a[0])), pa.array(signed(a[1].astype(np.uint64))), pa.array(a[2]), pa.array(a[3])],
                                      ["token", "key", "size", "counted"])


def _candidates(entries: DataFrame, percent: int) -> DataFrame:
    """(token, key) of prefixes that hold a token of another set."""
    one = entries.repartition("token").dropDuplicates(["token", "key"])
    df = one.withColumn("df", F.count(F.lit(1)).over(Window.partitionBy("token"))).where("df > 1 or counted < 0")
    p = F.col("size") - F.ceil(F.col("size") * percent / F.lit(100)) + 1
    sure = F.col("counted") < 0
    # counted tokens with df 1 come first and were left out: place the others behind them
    order = Window.partitionBy("key").orderBy(sure.cast("int"), "df", "token")
    shared = F.sum((~sure).cast("long")).over(Window.partitionBy("key"))
    top = F.max("counted").over(Window.partitionBy("key"))
    kept = (df.withColumn("rank", F.row_number().over(order)).withColumn("shared", shared).withColumn("top", top)
            .where(sure | (F.col("rank") + F.col("top") - F.col("shared") <= p)).where("df > 1"))
    return kept.select("token", "key")


def _whole_groups(batches, at_least: int = 100_000):
    """Tables of whole token groups from batches sorted by token."""
    held, n = [], 0
    for b in batches:
        if not b.num_rows:
            continue
        held.append(b)
        n += b.num_rows
        if n < at_least:
            continue
        t = pa.Table.from_batches(held)
        token = t.column("token").to_numpy()
        cut = int(np.searchsorted(token, token[-1]))
        if cut:
            yield t.slice(0, cut)
            held, n = t.slice(cut).to_batches(), t.num_rows - cut
    if held:
        yield pa.Table.from_batches(held)


def _alike(t: pa.Table, percent: int) -> np.ndarray:
    """Pairs of rows (of one token) that connect all rows whose sizes and sketches allow a link."""
    token = t.column("token").to_numpy()
    marks = Sketches(t.column("size").to_numpy(), t.column("sketch").to_pylist(), percent)
    first = np.flatnonzero(np.concatenate(([True], token[1:] != token[:-1])))
    size = np.diff(np.append(first, len(token)))
    place, total = np.arange(len(token)) - np.repeat(first, size), np.repeat(size, size)
    out = []
    for lag in range(1, 16):  # small groups: all their pairs, a distance at a time
        i = np.flatnonzero((total <= 16) & (place + lag < total))
        if not len(i):
            break
        ok = marks.may_link(i, i + lag)
        out.append(np.stack([i[ok], i[ok] + lag], 1))
    for a, n in zip(first[size > 16].tolist(), size[size > 16].tolist()):
        label = np.arange(n)
        for x in range(n):  # a set against all that it isn't connected with
            rest = np.flatnonzero(label != label[x])
            if not len(rest):
                break
            hit = rest[marks.may_link(np.full(len(rest), a + x), a + rest)]
            if len(hit):
                joined, one = np.unique(label[hit], return_index=True)
                out.append(np.stack([np.full(len(joined), a + x), a + hit[one]], 1))
                label[np.isin(label, joined)] = label[x]
    return np.concatenate(out) if out else np.empty((0, 2), np.int64)


def _group_edges(cand: DataFrame, sets: DataFrame, percent: int, shared_block: int) -> DataFrame:
    """Edges (a, b) between keys that make the candidate groups. cand: (token, key); sets: (key, size, sketch)."""
    count = cand.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min("key").alias("hub"))
    wide = cand.join(count.where(F.col("n") > shared_block), "token").where("key <> hub").select(F.col("key").alias("a"), F.col("hub").alias("b"))
    rest = cand.join(sets, "key").join(count.where((F.col("n") > 1) & (F.col("n") <= shared_block)).select("token"), "token")

    def run(batches):
        for t in _whole_groups(batches):
            pairs = _alike(t, percent)
            if len(pairs):
                key = t.column("key").to_numpy()
                e = np.unique(np.stack([np.minimum(key[pairs[:, 0]], key[pairs[:, 1]]), np.maximum(key[pairs[:, 0]], key[pairs[:, 1]])], 1), axis=0)
                yield pa.RecordBatch.from_arrays([pa.array(e[:, 0]), pa.array(e[:, 1])], ["a", "b"])
    near = rest.select("token", "key", "size", "sketch").repartition("token").sortWithinPartitions("token", "size", "key").mapInArrow(run, "a long, b long")
    return near.union(wide)


def _set_rows(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, n: int) -> DataFrame:
    """(grp, key, set) of the wanted classes, from the text of one document of the class."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), text_hash(text_col).alias("text_hash"), F.col(text_col).cast("string").cast("binary").alias("t"))
    src = src.join(wanted, src["id"].eqNullSafe(wanted["rep"]) & (src["text_hash"] == wanted["rep_hash"])).select("grp", "key", "t")

    def run(batches):
        for b in batches:
            keys = b.column("key").to_pylist()
            sets = list(shingle_sets(b.column("t").to_pylist(), n))
            ok = [i for i, s in enumerate(sets) if len(s) and int(np.uint64(sequence_hash(s)).view(np.int64)) == keys[i]]
            yield pa.RecordBatch.from_arrays(
                [b.column("grp").take(pa.array(ok, pa.int64())), b.column("key").take(pa.array(ok, pa.int64())),
                 pa.array([signed(sets[i]) for i in ok], pa.list_(pa.int64()))], ["grp", "key", "set"])

    return src.mapInArrow(run, "grp long, key long, set array<long>")


def _within(rows: DataFrame, keys: list[str], percent: int) -> DataFrame:
    def run(_, tables):
        ids, sets = _read(tables)
        pairs = join_within(ids, sets, percent)
        if pairs:
            yield _edges(pairs)
    return group_map(rows, keys, run, "a long, b long")


def _against(rows: DataFrame, percent: int) -> DataFrame:
    """Blocks (probe false) against the probes of their group, which come after them."""
    def run(_, tables):
        ids, sets, labels, trie, union = [], [], [], None, None
        for t in tables:
            probe = np.array(t.column("probe").to_pylist())
            cut = int(np.argmax(probe)) if probe.any() else len(probe)
            if cut:
                i, s = _read([t.slice(0, cut)])
                ids, sets, labels = ids + i, sets + s, labels + t.column("label").to_pylist()[:cut]
            if cut == len(probe):
                continue
            pairs = []
            i, s = _read([t.slice(cut)])
            for key, x, label in zip(i, s, t.column("label").to_pylist()[cut:]):
                if trie is None:
                    union, first = _Union(len(sets) + 1), {}
                    for k, lab in enumerate(labels):
                        union.join(k, first.setdefault(lab, k))
                    trie = Trie(sets, percent, union)
                me = first.get(label, len(sets))
                if me == len(sets):  # a probe of no component in this block: a fresh node stands for it
                    union.up.append(len(union.up))
                    me = first[label] = len(union.up) - 1
                for k in trie.walk(x, me):
                    if union.join(me, k):
                        pairs.append((key, ids[k]))
            if pairs:
                yield _edges(pairs)
    return group_map(rows, ["grp", "blk"], run, "a long, b long", ["probe"])


def _labelled(rows: DataFrame, edges: DataFrame) -> DataFrame:
    c = components(edges)
    return rows.join(c.select(F.col("node").alias("key"), "label"), "key", "left").withColumn("label", F.coalesce("label", "key"))


def _linked(rows: DataFrame, percent: int, block: int) -> DataFrame:
    """Edges (a, b) that connect all linked sets of each group; rows: (grp, key, set)."""
    rows = written(rows.withColumn("n", F.size("set")), "jaccard-sets")
    sizes = rows.groupBy("grp").agg(F.sum("n").alias("total"))
    big = written(sizes.where(F.col("total") > block).withColumn("blocks", F.ceil(F.col("total") / block)), "jaccard-big")
    small = rows.join(big, "grp", "left_anti")
    found = _within(small.select("grp", "key", "set"), ["grp"], percent)
    if big.isEmpty():
        return found
    large = rows.join(big, "grp").withColumn("blk", F.pmod(F.xxhash64("key"), F.col("blocks")))
    large = written(large.select("grp", "blk", "blocks", "key", "set"), "jaccard-blocks")
    edges = written(_within(large.select("grp", "blk", "key", "set"), ["grp", "blk"], percent), "jaccard-links")
    now = written(_labelled(large, edges), "jaccard-labels")
    most = now.agg(F.max("blocks")).first()[0]
    # some members of each block's largest component, joined 64 blocks at a time
    per = now.groupBy("grp", "blk", "label").agg(F.count(F.lit(1)).alias("c"))
    lead = per.groupBy("grp", "blk").agg(F.max_by("label", F.struct("c", "label")).alias("label"))
    hubs = now.join(lead, ["grp", "blk", "label"]).withColumn(
        "k", F.row_number().over(Window.partitionBy("grp", "blk").orderBy(F.xxhash64("key"), "key"))).where(F.col("k") <= HUB_MEMBERS)
    hubs = written(hubs.select("grp", "blk", "key", "set"), "jaccard-hubs")
    all_edges = edges
    while most > 1:
        up = hubs.withColumn("blk", F.floor(F.col("blk") / HUB_BLOCKS))
        more = written(_within(up, ["grp", "blk"], percent), "jaccard-hub-links")
        all_edges = all_edges.union(more)
        most = -(-most // HUB_BLOCKS)
        hubs = up.withColumn("k", F.row_number().over(Window.partitionBy("grp", "blk").orderBy(F.xxhash64("key"), "key"))) \
            .where(F.col("k") <= HUB_MEMBERS).drop("k")
    now = written(_labelled(large, all_edges), "jaccard-labels")
    per = now.groupBy("grp", "label").agg(F.count(F.lit(1)).alias("c"))
    lead = per.groupBy("grp").agg(F.max_by("label", F.struct("c", "label")).alias("lead"))
    rest = now.join(lead, "grp").where("label <> lead")
    if not rest.isEmpty():
        probes = rest.select("grp", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("blk"), "key", "set", "label")
        both = now.select("grp", "blk", "key", "set", "label", F.lit(False).alias("probe")).union(
            probes.withColumn("probe", F.lit(True)))
        all_edges = all_edges.union(written(_against(both, percent), "jaccard-last-links"))
    return found.union(all_edges)


def jaccard_components(docs: DataFrame, n: int = 3, percent: int = 90, id_col: str = "doc_id", text_col: str = "text",
                       block_shingles: int = BLOCK_SHINGLES, shared_block: int = SHARED_BLOCK, with_group: bool = False) -> DataFrame:
    """One row per document: ``doc_id``, ``n_shingles``, ``component_id`` (see the module's notes).

    ``with_group`` adds ``text_hash`` and ``group``, a name of the component that needs no id (null for an empty set).
    """
    sized = written(_sized(docs, id_col, text_col, n, percent), "jaccard-sizes")
    each = sized.where("hot is null").select("id", "text_hash", "size", "key")
    # a document of the class: that of the smallest id, else one of those without
    classes = each.where("size > 0").groupBy("key").agg(
        F.min("id").alias("rep"), F.coalesce(F.min_by("text_hash", "id"), F.min("text_hash")).alias("rep_hash"), F.count(F.lit(1)).alias("n"))
    entries = _prefix_entries(docs, id_col, text_col, n, percent, _frequent(sized))
    cand = written(_candidates(entries, percent), "jaccard-prefixes")
    sets = sized.where("size > 0").dropDuplicates(["key"]).select("key", "size", "sketch")
    groups = components(_group_edges(cand, sets, percent, shared_block))
    wanted = groups.select(F.col("node").alias("key"), F.col("label").alias("grp")).join(classes, "key")
    rows = _set_rows(docs, wanted, id_col, text_col, n).dropDuplicates(["key"])
    label = components(_linked(rows, percent, block_shingles))
    linked = written(label.select(F.col("node").alias("key"), "label").join(classes, "key").select("key", "label", "rep"), "jaccard-linked")
    low = written(linked.groupBy("label").agg(F.min("rep").alias("component")), "jaccard-lowest")
    found = linked.join(low, "label").select("key", "label", "component")
    named = classes.join(found, "key", "left").select(
        "key", F.coalesce("component", "rep").alias("component"), F.coalesce("label", "key").alias("group"), "n")
    # documents of equal sets are as many as their copies: their classes come back to them by counted keys; empty sets have none
    cols = [F.col("id").alias("doc_id"), F.col("size").alias("n_shingles"), F.coalesce("component", "id").alias("component_id"),
            *(["text_hash", "group"] if with_group else [])]
    alone = each.where("size = 0").select("*", F.lit(None).cast("long").alias("component"), F.lit(None).cast("long").alias("group"))
    return join_counted(each.where("size > 0"), named, ["key"]).select(cols).union(alone.select(cols))
