"""Phrase collocations with weighted acyclic automata: counts of all n-grams up to four words, then part lookups.

A text is split into pieces at ``[.,;:!?\\x0A-\\x0D]`` and these into words at blanks and tabs, only A-Z lower-cased.

1. Shards. A task takes texts of one language, about a block of bytes at a time. Every word starts one path of
   four labels (END behind a piece's end), so the count of an n-gram is the weight of all paths that begin
   with it. Sorted paths are built into an acyclic automaton from the last level up: states whose arcs (label, target;
   the count on the last one) are equal become one state.
2. Union by prefix range. Automata are cut at the range bounds, which are quantiles of a sample of paths, and
   go to their range as one compressed row each. A task unions the automata of a range: paths are sorted and their weights
   summed, then weights are summed per prefix. It returns n-grams of at least ``least``, and the
   first and last prefix of each length whatever their weight: only these can go on in the next range, and sums over
   ranges complete them. A word or phrase that makes up a third of all text is a path per shard, or many ranges.
3. Part lookups. Phrases of two to four words are composed with the counts of their parts by joins on the part
   (a part isn't rarer than its phrase, so it's among the counts), parts asked very often by salted keys. Each
   phrase keeps its lowest-scoring cut.
4. A phrase goes if its words lie inside a longer one with ``100 f(longer) >= inside * f``: the greatest longer count
   per inner phrase is a maximum that combines in tasks.

A block is of ``BLOCK_BYTES``, or the root of 256 bytes times all text where that is more, and there are as many ranges as
blocks; so the bounds that are broadcast grow with the root of the input (twelve thousand at 50 GB of text).

Arithmetic is exact: products are decimals of 38 digits. Words are compared as they are, not by hashes.

Edge cases: null text is empty, null language is ``und`` and '' a language; texts without words add nothing; an
empty table gives an empty result; repeated rows are documents each; other columns are ignored.
"""

from __future__ import annotations

import math
from bisect import bisect_left

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflow.llm.frames import group_map, join_counted, partitions, written
from metroflow.llm.words import U, Words, mix, utf8

BLOCK_BYTES, DEPTH, SAMPLES, HELD = 1 << 22, 4, 24, 1_500_000
_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?\n\x0b\x0c\r"]] = True
_APART = _BREAK.copy()
_APART[[9, 32]] = True


# --- automata --------------------------------------------------------------------------


def _heads(paths: list[np.ndarray]) -> list[np.ndarray]:
    """For each k, the places in sorted paths where the first k + 1 labels change."""
    out, new = [], np.zeros(len(paths[0]), bool)
    new[:1] = True
    for p in paths:
        new = new.copy()
        new[1:] |= p[1:] != p[:-1]
        out.append(np.flatnonzero(new))
    return out


class Automaton:
    """Sorted distinct paths of equal length with weights. ``levels[k]``: each state's first arc, the arcs' labels and targets."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.levels = levels

    @staticmethod
    def build(paths: list[np.ndarray], weights: np.ndarray) -> Automaton:
        heads, target, levels = _heads(paths), weights, []
        for k in range(len(paths) - 1, -1, -1):
            label = paths[k][heads[k]]
            first = np.searchsorted(heads[k], heads[k - 1]) if k else np.zeros(1, np.int64)
            first, label, target, state = _shared(first, label, target)
            levels.append((first, label, target))
            target = state
        return Automaton(levels[::-1])

    def paths(self) -> tuple[list[np.ndarray], np.ndarray]:
        """All paths in order, and their weights."""
        out, state = [], np.zeros(1, np.int64)
        for first, label, target in self.levels:
            ends = np.append(first[1:], len(label))
            n = (ends - first)[state]
            arc = np.repeat(first[state] - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum())
            out = [x.repeat(n) for x in out] + [label[arc]]
            state = target[arc]
        return out, state

    def pack(self) -> bytes:
        arrays = [a for level in self.levels for a in level]
        head = np.array([len(a) for a in arrays], np.int64)
        wide = 8 if any(len(a) and int(a.max()) >= 1 << 32 for a in arrays) else 4
        data = b"".join(np.ascontiguousarray(a, f"<u{wide}").tobytes() for a in arrays)
        return bytes([wide, len(self.levels)]) + head.tobytes() + data

    @staticmethod
    def unpack(data: bytes) -> Automaton:
        wide, depth = data[0], data[1]
        sizes = np.frombuffer(data, np.int64, 3 * depth, 2).tolist()
        at, arrays = 2 + 24 * depth, []
        for n in sizes:
            arrays.append(np.frombuffer(data, f"<u{wide}", n, at).astype(np.int64))
            at += n * wide
        return Automaton([tuple(arrays[i:i + 3]) for i in range(0, len(arrays), 3)])


def _shared(first: np.ndarray, label: np.ndarray, target: np.ndarray):
    """States with equal arcs as one: (first, label, target) of the states that stay, and each old state's new one."""
    if not len(label):
        return first, label, target, np.arange(len(first))
    n = np.diff(np.append(first, len(label)))
    place = np.arange(len(label)) - np.repeat(first, n)
    arc = mix(mix(label.astype(U) * U(0x9E3779B97F4A7C15) + target.astype(U)) + place.astype(U))
    h = mix(np.add.reduceat(arc, first) + n.astype(U))
    _, lead, back = np.unique(h, return_index=True, return_inverse=True)
    lead = lead[back]
    same = n[lead] == n  # equal hashes are compared
    at = np.repeat(np.where(same, first[lead], first), n) + place
    unlike = (label[at] != label) | (target[at] != target)
    same &= ~np.logical_or.reduceat(unlike, first)
    lead = np.where(same, lead, np.arange(len(first)))
    stay = lead == np.arange(len(first))
    arcs = np.repeat(stay, n)
    new = np.cumsum(stay) - 1
    return np.concatenate(([0], np.cumsum(n[stay])[:-1])).astype(np.int64), label[arcs], target[arcs], new[lead]


def summed(paths: list[np.ndarray], weights: np.ndarray, words: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct paths of four labels up to ``words`` in order, weights of equal ones added."""
    bits = max(1, words.bit_length())
    high, low = ((paths[i].astype(np.int64) << bits) | paths[i + 1] for i in (0, 2))
    if 4 * bits > 63:
        (high_of, high), (low_of, low) = (np.unique(x, return_inverse=True) for x in (high, low))
        key = high * len(low_of) + low
        del high_of, low_of
    else:
        key = (high << 2 * bits) | low
    del high, low
    order = np.argsort(key, kind="stable")
    key, weights = key[order], weights[order]
    new = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))[:len(key)])
    weights = np.add.reduceat(weights, new) if len(new) else weights
    order = order[new]
    return [p[order] for p in paths], weights


def _vocabulary(flat: pa.Array) -> tuple[list[bytes], np.ndarray]:
    """(distinct words in byte order, each occurrence's place among them from 1; 0 is END)."""
    coded = flat.dictionary_encode()
    order = pc.sort_indices(coded.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(1, len(order) + 1)
    return coded.dictionary.take(pa.array(order)).to_pylist(), rank[coded.indices.to_numpy()]


def text_paths(texts: list[bytes | None]) -> tuple[list[bytes], list[np.ndarray]]:
    """(words in byte order, the four labels of the path that each word of the texts starts)."""
    w = Words(texts, lower=True, space=_APART)
    n = len(w.starts)
    ends = np.concatenate(([0], np.cumsum(w.ends - w.starts)))
    data = np.ascontiguousarray(w.data[~_APART[w.data]])
    words, label = _vocabulary(pa.Array.from_buffers(pa.large_binary(), n, [None, pa.py_buffer(ends), pa.py_buffer(data)]))
    piece = np.searchsorted(np.flatnonzero(_BREAK[w.data]), w.starts).astype(np.int32)  # words of a piece have as many breaks before them
    label = label.astype(np.int32)
    paths = [label]
    for k in range(1, DEPTH):
        nxt = np.zeros(n, np.int32)
        if n > k:
            nxt[:-k] = np.where(piece[k:] == piece[:-k], label[k:], 0)
        paths.append(nxt)
    return words, paths


def _cut(words: list[bytes], paths: list[np.ndarray], bounds: list[tuple]) -> list[int]:
    """Places in sorted paths of the first path that isn't less than each bound (four words, b'' is END)."""
    out = []
    for bound in bounds:
        lo, hi = 0, len(paths[0])
        for k, word in enumerate(bound):
            at = bisect_left(words, word) if word else -1
            there = at < 0 or (at < len(words) and words[at] == word)
            label = at + 1
            part = paths[k][lo:hi]
            lo, hi = lo + int(np.searchsorted(part, label)), lo + int(np.searchsorted(part, label, "right")) if there else 0
            if not there or lo == hi:
                break
        out.append(lo)
    return out


# --- shards and ranges -----------------------------------------------------------------


def _by_language(batches, block: int):
    """(language, texts) of about ``block`` bytes each."""
    held, size, total = {}, {}, 0
    for b in batches:
        for lang, t in zip(b.column("lang").to_pylist(), utf8(b.column("t"))):
            if not t:
                continue
            held.setdefault(lang, []).append(t)
            size[lang] = size.get(lang, 0) + len(t)
            total += len(t)
            if total >= block:
                lang = max(size, key=size.get)
                yield lang, held.pop(lang)
                total -= size.pop(lang)
    while held:
        yield held.popitem()


def _shards(docs: DataFrame, bounds, block: int) -> DataFrame:
    """(part, lang, words, automaton): automata of the texts, cut at the range bounds."""
    def run(batches):
        of = {}
        for k, (lang, *path) in enumerate(bounds.value):
            of.setdefault(lang, []).append((k, tuple(path)))
        langs = [b[0] for b in bounds.value]
        for lang, texts in _by_language(batches, block):
            words, paths = text_paths(texts)
            del texts
            if not words:
                continue
            paths, weights = summed(paths, np.ones(len(paths[0]), np.int64), len(words))
            mine = of.get(lang, [])
            base = bisect_left(langs, lang)
            at = [0, *_cut(words, paths, [p for _, p in mine]), len(weights)]
            for k, (a, b) in enumerate(zip(at[:-1], at[1:])):
                if a == b:
                    continue
                part = [p[a:b] for p in paths]
                used = np.unique(np.concatenate([np.unique(p) for p in part] + [np.zeros(1, np.int64)]))  # END is 0 here too
                own = Automaton.build([np.searchsorted(used, p) for p in part], weights[a:b])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([base + k], pa.int32()), pa.array([lang], pa.string()), pa.array([_press(b" ".join(words[i - 1] for i in used[1:].tolist()))], pa.binary()),
                     pa.array([_press(own.pack())], pa.binary())], ["part", "lang", "words", "automaton"])
    return docs.mapInArrow(run, "part int, lang string, words binary, automaton binary")


def _press(data: bytes) -> bytes:
    return len(data).to_bytes(8, "little") + (pa.compress(data, "zstd", asbytes=True) if data else b"")


def _unpress(data: bytes) -> bytes:
    n = int.from_bytes(data[:8], "little")
    return pa.decompress(data[8:], n, "zstd", asbytes=True) if n else b""


def _union(parts: list[tuple]) -> tuple[list[bytes], list[np.ndarray], np.ndarray]:
    """Union of (words, paths, weights), weights of equal paths added."""
    sizes = [len(w) for w, _, _ in parts]
    words, label = _vocabulary(pa.array([x for w, _, _ in parts for x in w], pa.large_binary()))
    at = np.concatenate(([0], np.cumsum(sizes)))
    maps = [np.concatenate(([0], label[a:b])).astype(np.int32) for a, b in zip(at[:-1], at[1:])]
    paths = [np.concatenate([m[p[k]] for m, (_, p, _) in zip(maps, parts)]) for k in range(DEPTH)]
    paths, weights = summed(paths, np.concatenate([x for _, _, x in parts]), len(words))
    return words, paths, weights


def _range_counts(least: int):
    """Group function: the counts of a range of one language."""
    def run(key, tables):
        parts, held, shrunk = [], 0, 0
        for t in tables:
            for words, data in zip(t.column("words").to_pylist(), t.column("automaton").to_pylist()):
                paths, weights = Automaton.unpack(_unpress(data)).paths()
                text = _unpress(words)
                parts.append((text.split(b" ") if text else [], paths, weights))
                held += len(weights)
                if held > max(HELD, 2 * shrunk):
                    parts = [_union(parts)]
                    held = shrunk = len(parts[0][2])
        words, paths, weights = _union(parts)
        rows = [(0, "", int(weights.sum()))]
        for k, head in enumerate(_heads(paths)):
            f = np.add.reduceat(weights, head)
            want = f >= least
            want[[0, -1]] = True
            want &= paths[k][head] > 0
            places = np.flatnonzero(want)
            labels = [p[head[places]].tolist() for p in paths[:k + 1]]
            rows += [(k + 1, b" ".join([words[i - 1] for i in g]).decode("utf-8", "replace"), n) for g, n in zip(zip(*labels), f[places].tolist())]
        for i in range(0, len(rows), 100_000):
            part = rows[i:i + 100_000]
            yield pa.RecordBatch.from_arrays([pa.array([key[1]] * len(part), pa.string()), pa.array([r[0] for r in part], pa.int32()),
                                              pa.array([r[1] for r in part]), pa.array([r[2] for r in part], pa.int64())], ["lang", "k", "phrase", "f"])
    return run


def _bounds(docs: DataFrame, block: int, total: int) -> list[tuple]:
    """Range bounds (language and four words each): quantiles of a sample of paths, one fewer than ranges."""
    ranges = math.ceil(total / block)
    if ranges < 2:
        return []
    want = SAMPLES * ranges  # paths, one per stride of words of sampled texts
    stride, share = 16, min(1.0, want * 16 * 6 * 2 / total)

    def run(batches):
        for b in batches:
            rows = []
            for lang, t in zip(b.column("lang").to_pylist(), utf8(b.column("t"))):
                words, paths = text_paths([t])
                words = [b"", *words]
                rows += [(lang, *(words[p[i]] for p in paths)) for i in range(len(t or b"") % stride, len(paths[0]), stride)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.string()), *(pa.array([r[k] for r in rows], pa.binary()) for k in range(1, 5))],
                                                 ["lang", "a", "b", "c", "d"])

    got = docs.sample(share, seed=13).mapInArrow(run, "lang string, a binary, b binary, c binary, d binary")
    got = sorted((r[0], *(bytes(x) for x in r[1:])) for r in got.limit(4 * want).collect())
    return sorted({got[len(got) * k // ranges] for k in range(1, ranges)}) if got else []


def counts(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(lang, k, phrase, f): n-grams of k = 1 to 4 words that occur at least ``least`` times, and k = 0: all words of a language."""
    spark = docs.sparkSession
    src = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"), F.col(text_col).cast("string").alias("t"))
    total = src.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0)).cast("long")).first()[0]
    block = max(block_bytes, math.isqrt(256 * total))
    bounds = spark.sparkContext.broadcast(_bounds(src, block, total))
    rows = group_map(_shards(src, bounds, block), ["part", "lang"], _range_counts(least), "lang string, k int, phrase string, f long",
                     parts=max(partitions(spark), math.ceil(total / block)))
    return rows.groupBy("lang", "k", "phrase").agg(F.sum("f").alias("f")).where((F.col("k") == 0) | (F.col("f") >= least))


def _part(words: Column, start: int, length: Column | int) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, least: int = 30, inside: int = 80, top: int = 2000, text_col: str = "text", lang_col: str = "lang",
                 block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` (see the module's notes)."""
    found = written(counts(docs, least, text_col, lang_col, block_bytes), "collocation-counts")
    words = F.split("phrase", " ", -1)
    phrases = found.where("k > 1").select("lang", "k", "phrase", F.col("f").alias("a"), words.alias("w"))

    longer = phrases.where("k > 2").withColumn("size", F.explode(F.sequence(F.lit(2), F.col("k") - 1))) \
        .withColumn("start", F.explode(F.sequence(F.lit(1), F.col("k") - F.col("size") + 1)))
    longer = longer.groupBy("lang", F.array_join(F.slice("w", F.col("start"), F.col("size")), " ").alias("phrase")).agg(F.max("a").alias("most"))
    kept = phrases.join(longer, ["lang", "phrase"], "left").where(
        F.col("most").isNull() | (F.col("most").cast("decimal(20,0)") * 100 < F.col("a").cast("decimal(20,0)") * inside)).drop("most")

    cuts = kept.withColumn("cut", F.explode(F.sequence(F.lit(1), F.col("k") - 1)))
    sides = F.array(F.struct(F.lit(0).alias("side"), F.array_join(F.slice("w", F.lit(1), F.col("cut")), " ").alias("part")),
                    F.struct(F.lit(1).alias("side"), F.array_join(F.slice("w", F.col("cut") + 1, F.col("k") - F.col("cut")), " ").alias("part")))
    asked = written(cuts.select("lang", "phrase", "a", "cut", F.explode(sides).alias("x")).select("lang", "phrase", "a", "cut", "x.side", "x.part"), "collocation-parts")
    known = found.where("k > 0").select("lang", F.col("phrase").alias("part"), "f")
    known = asked.groupBy("lang", "part").agg(F.count(F.lit(1)).alias("n")).join(known, ["lang", "part"])
    both = join_counted(asked, known, ["lang", "part"], how="inner").groupBy("lang", "phrase", "a", "cut").agg(
        F.max(F.when(F.col("side") == 0, F.col("f"))).alias("l"), F.max(F.when(F.col("side") == 1, F.col("f"))).alias("r"))
    score = F.call_function("div", F.lit(2_000_000).cast("decimal(7,0)") * F.col("a").cast("decimal(20,0)"), (F.col("l") + F.col("r")).cast("decimal(20,0)"))
    scored = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "cut", "l", "r")).alias("x")).select("lang", "phrase", "a", "x.*")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    best = scored.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return best.join(found.where("k = 0").select("lang", F.col("f").alias("n")), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
