"""Source divergence audit by count-cell ranking: how a source's use of terms differs from other sources' and from its language's.

Terms are runs of letters and characters beyond ASCII, only A-Z lower-cased. A language keeps the terms that
occur in at least ``least`` of its documents. A group is a (language, source) that occurs. With N the
occurrences of kept terms in a group or language and V the number of kept terms, a kept term that occurs c times has
p = 1 + floor(10^9 (c + 5) / (N + 5 V)), in exact integers.

A value depends on a term's counts alone. So terms are grouped by cell, (count in the group, count in the language):

1. Tasks count terms per group in pieces of text of ``CHUNK`` bytes, in Arrow dictionaries; counts are summed before
   their shuffle.
2. p, q and f = p - q are worked out per cell, not per term. Cells are ranked by f: equal values are merged, and only
   values whose cumulative multiplicity before them is less than ``top`` can hold a top term. As each value holds a
   term at least, that are at most ``top`` values, so a partial top-k precedes the shuffle.
3. Only terms of those cells are expanded, in UTF-8 order within a value, again behind a partial top-k.

Pairs: the value of two groups of a language is the sum over kept terms of |p - q|. The terms of a language are dealt to buckets of about ``TERMS``; a
task streams those of one bucket as rows of a matrix (terms by groups) that hold p by the cell of each count,
and adds up |p - q| for all pairs of columns, less what two absent counts give. It returns one sum per pair
of groups, not per term. Over ``block`` groups of a language are cut into blocks, each pair of blocks a task's.

Edge cases: null text, language and source are read as ''; a group without terms occurs, with p of
a count of 0; V = 0 gives pairs of value 0 and no terms; repeated rows are documents each; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflow.llm.frames import group_map, written
from metroflow.llm.words import PUNCTUATION, Words, chunks, utf8

CHUNK, BLOCK, STEP, TERMS = 1 << 23, 512, 64, 4096
_APART = PUNCTUATION.copy()
_APART[48:58] = True  # digits are no letters


def term_codes(texts: list[bytes | None]) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(terms, the code of each occurrence, each text's first occurrence): the terms of some texts in a dictionary."""
    w = Words(texts, lower=True, space=_APART)
    size = w.ends - w.starts
    ends = np.concatenate(([0], np.cumsum(size)))
    data = w.data[~_APART[w.data]]  # what is left between the terms' bounds
    flat = pa.Array.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends), pa.py_buffer(np.ascontiguousarray(data))])
    coded = flat.dictionary_encode()
    return coded.dictionary, coded.indices.to_numpy(), w.offsets


def _counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): partial counts of occurrences and documents."""
    def run(batches):
        for b in batches:
            texts = utf8(b.column("t"))
            pairs = pa.StructArray.from_arrays([b.column("lang"), b.column("source")], ["lang", "source"])
            names = pairs.to_pylist()
            code = {}
            group = np.array([code.setdefault((p["lang"], p["source"]), len(code)) for p in names], np.int64)
            groups = list(code)
            for i, j in chunks(texts, CHUNK):
                terms, at, offsets = term_codes(texts[i:j])
                if not len(at):
                    continue
                k = len(terms)
                doc = np.repeat(np.arange(j - i), np.diff(offsets))
                each, n = np.unique(doc * k + at, return_counts=True)  # a term in a document
                own = group[i:j][each // k] * k + each % k
                key, back, docs_of = np.unique(own, return_inverse=True, return_counts=True)
                total = np.zeros(len(key), np.int64)
                np.add.at(total, back, n)
                for s in range(0, len(key), 100_000):
                    part = slice(s, s + 100_000)
                    g, t = key[part] // k, key[part] % k
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([x[0] for x in groups]).take(pa.array(g)), pa.array([x[1] for x in groups]).take(pa.array(g)),
                         pc.cast(terms.take(pa.array(t)), pa.large_string()).cast(pa.string()), pa.array(total[part]), pa.array(docs_of[part])],
                        ["lang", "source", "term", "n", "docs"])
    return docs.mapInArrow(run, "lang string, source string, term string, n long, docs long")


def share(count: Column, total: Column, kept: Column) -> Column:
    """p of a count, exact: 1 + floor(10^9 (count + 5) / (total + 5 kept))."""
    return F.lit(1).cast("long") + F.call_function("div", F.lit(10**9).cast("decimal(10,0)") * (count + 5).cast("decimal(20,0)"),
                                                  (total + 5 * kept).cast("decimal(20,0)"))


def _top_terms(counts: DataFrame, groups: DataFrame, top: int) -> DataFrame:
    """(lang, source, item, value, rank): each group's terms of largest positive p - q."""
    cell = ["lang", "source", "n", "of_lang"]
    cells = counts.groupBy(*cell).agg(F.count(F.lit(1)).alias("terms")).join(groups, ["lang", "source"])
    f = share(F.col("n"), F.col("total"), F.col("kept")) - share(F.col("of_lang"), F.col("lang_total"), F.col("kept"))
    cells = cells.withColumn("value", f).where("value > 0").select(*cell, "terms", "value")
    own = Window.partitionBy("lang", "source").orderBy(F.desc("value"))
    values = cells.groupBy("lang", "source", "value").agg(F.sum("terms").alias("terms")) \
        .withColumn("k", F.row_number().over(own)).where(F.col("k") <= top)
    before = F.sum("terms").over(own.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("terms")
    values = values.withColumn("before", before).where(F.col("before") < top).select("lang", "source", "value")
    chosen = cells.join(values, ["lang", "source", "value"]).select(*cell, "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "term"))
    found = counts.join(chosen, cell).select("lang", "source", F.col("term"), "value").withColumn("rank", rank).where(F.col("rank") <= top)
    return found.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), "value", "rank")


def _add_up(key, tables, block):
    """Sums of |p - q| less |p0 - q0| over a bucket's terms, per pair of groups of the blocks ``key[1]`` and ``key[2]``."""
    base, fill, rows, sums = {}, None, [], None
    last = None

    def flush():
        nonlocal sums, rows
        if not rows:
            return
        p = np.tile(fill, (len(rows), 1))
        at = np.concatenate([np.full(len(c), k) for k, (c, _) in enumerate(rows)])
        p[at, np.concatenate([c for c, _ in rows])] = np.concatenate([v for _, v in rows])
        for a in range(len(fill)):
            sums[a] += np.abs(p - p[:, a:a + 1]).sum(0) - len(rows) * np.abs(fill - fill[a])
        rows = []

    for t in tables:
        term, who, value = t.column("term").to_pylist(), t.column("number").to_numpy(), t.column("p").to_numpy()
        first = 0
        while first < len(term) and term[first] is None:  # the groups themselves come first
            base[int(who[first])] = int(value[first])
            first += 1
        if first == len(term):
            continue
        if fill is None:
            order = np.array(sorted(base), np.int64)
            fill = np.array([base[x] for x in order.tolist()], np.int64)
            sums = np.zeros((len(fill), len(fill)), np.int64)
        col = np.searchsorted(order, who)
        cut = [k for k in range(first, len(term)) if k == first or term[k] != term[k - 1]] + [len(term)]
        for a, b in zip(cut[:-1], cut[1:]):
            if rows and term[a] == last:  # a term that goes on from the batch before
                c, v = rows[-1]
                rows[-1] = (np.concatenate((c, col[a:b])), np.concatenate((v, value[a:b])))
            else:
                if len(rows) == STEP:
                    flush()
                rows.append((col[a:b], value[a:b]))
            last = term[a]
    if fill is None:
        return
    flush()
    a, b = np.nonzero(np.triu(sums, 1))
    keep = np.ones(len(a), bool)
    if key[1] != key[2]:  # pairs within one block are added up by that block's own tasks
        keep = (order[a] // block) != (order[b] // block)
    a, b = a[keep], b[keep]
    for k in range(0, len(a), 100_000):
        x, y = a[k:k + 100_000], b[k:k + 100_000]
        yield pa.RecordBatch.from_arrays([pa.array([key[0]] * len(x), pa.string()), pa.array(order[x]), pa.array(order[y]), pa.array(sums[x, y])],
                                         ["lang", "a", "b", "more"])


def _pairs(counts: DataFrame, groups: DataFrame, block: int) -> DataFrame:
    """(lang, source, item, value, rank): each group's other groups of its language."""
    named = groups.withColumn("number", F.row_number().over(Window.partitionBy("lang").orderBy("source")).cast("long") - 1) \
        .withColumn("blocks", F.ceil(F.count(F.lit(1)).over(Window.partitionBy("lang")) / block)) \
        .withColumn("p0", F.when(F.col("kept") > 0, share(F.lit(0).cast("long"), F.col("total"), F.col("kept"))))
    named = written(named.select("lang", "source", "number", "blocks", "total", "kept", "p0"), "divergence-groups")
    buckets = F.ceil(F.col("kept") / TERMS).cast("int")  # as many as a language has kept terms for, whatever the cluster's size
    cells = counts.select("lang", "source", "n").distinct().join(named, ["lang", "source"]) \
        .select("lang", "source", "n", "number", "blocks", buckets.alias("buckets"), share(F.col("n"), F.col("total"), F.col("kept")).alias("p"))
    mine = F.floor(F.col("number") / block).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks").cast("int") - 1))
    cols = ["lang", "low", "high", "bucket", "term", "number", "p"]

    def dealt(rows):
        return rows.withColumn("other", other).withColumn("low", F.least(mine, "other")).withColumn("high", F.greatest(mine, "other")).select(cols)

    heads = dealt(named.where("kept > 0").withColumn("bucket", F.explode(F.sequence(F.lit(0), buckets - 1))).select(
        "lang", "bucket", F.lit(None).cast("string").alias("term"), "number", "blocks", F.col("p0").alias("p")))
    body = dealt(counts.select("lang", "source", "term", "n").join(cells, ["lang", "source", "n"]).withColumn(
        "bucket", F.pmod(F.xxhash64("term"), F.col("buckets")).cast("int")))
    sums = group_map(heads.union(body), cols[:4], lambda key, tables: _add_up(key, tables, block), "lang string, a long, b long, more long", ["term", "number"])
    sums = sums.groupBy("lang", "a", "b").agg(F.sum("more").alias("more"))
    one = named.select("lang", F.col("number").alias("a"), "source", F.col("p0").alias("pa"), "kept")
    two = named.select("lang", F.col("number").alias("b"), F.col("source").alias("item"), F.col("p0").alias("pb"))
    pairs = one.join(two, "lang").where("a < b").join(sums, ["lang", "a", "b"], "left")
    value = F.when(F.col("kept") > 0, F.col("kept") * F.abs(F.col("pa") - F.col("pb")) + F.coalesce("more", F.lit(0))).otherwise(0).cast("long")
    pairs = pairs.select("lang", "source", "item", value.alias("value"))
    both = pairs.withColumn("way", F.explode(F.array(F.lit(0), F.lit(1)))).select(
        "lang", F.when(F.col("way") == 0, F.col("source")).otherwise(F.col("item")).alias("source"),
        F.when(F.col("way") == 0, F.col("item")).otherwise(F.col("source")).alias("item"), "value")
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", rank.alias("rank"))


def audit(docs: DataFrame, least: int = 30, top: int = 50, text_col: str = "text", lang_col: str = "lang", source_col: str = "source",
          block: int = BLOCK) -> DataFrame:
    """``lang, source, part, item, value, rank`` (see the module's notes)."""
    src = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "t"))))
    seen = _counts(src).groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    seen = written(seen, "divergence-terms")
    kept = seen.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("of_lang")).where(F.col("docs") >= least).drop("docs")
    counts = written(seen.select("lang", "source", "term", "n").join(kept, ["lang", "term"]), "divergence-counts")
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    langs = counts.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_distinct("term").alias("kept"))
    groups = src.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *(F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "lang_total", "kept")))
    groups = written(groups, "divergence-totals")
    return _pairs(counts, groups, block).unionByName(_top_terms(counts, groups, top))
