"""Substring dedup by recompression: remove words of windows that occur earlier.

A window is ``window`` consecutive words of one document. Each word covered by
a window whose word sequence also starts earlier (smaller document id, or the
same document further left) is removed; windows are judged on the input.

Words are named by hash. Rounds then rename: first every maximal run of one
name, then every pair (a, b) with a in the left and b in the right half of the
names, the halves drawn anew each round from the names themselves. Names are
hashes of what they stand for, so they are global without an exchange: equal
text gets equal names everywhere, except near its ends. Each symbol carries
the words that its being there depends on (its context). Two windows with the
same words hold the same symbols among those whose context lies inside them.

1. Documents with the words of an earlier document add no first occurrence: all
   their windows are repeats, and they're set aside by a hash of the sequence.
2. A window is represented by a symbol of the highest round that has one whose
   context lies inside it, the one of least hash; level 0, single words, always has one. Rows (hash of
   the context and the symbol, document) are far fewer than windows. A task
   sends a symbol on once however often it met it: if it met it twice, its
   documents are known to need step 3.
3. Only symbols that occur twice can belong to repeated windows. Windows of
   those are compared by a hash of their words. A task sends on the earliest
   start of a window that it met, and knows the others for repeats; of what it
   sent, all but the globally earliest are repeats too. So a passage in a third
   of all documents costs one row a task.
4. Repeats come back to their document as starts, and its words are cut.

Keys are 64-bit hashes, and windows are compared by two of them (128 bits).

Edge cases: null text has no words (n_words 0, hash of the empty string);
text shorter than a window is kept; extra columns are ignored; rows that share
a document id and words are one document, those of other words are documents of
their own, in the order of a hash of the words; a null id sorts first; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from metroflow.llm.frames import join_counted, text_hash, written
from metroflow.llm.words import U, Words, chunks, fold, mix, running, sequence_hash, signed, span

ROUNDS = 2
FAR = np.int64(1) << 40


def _runs(name, lo, hi, left, right, doc):
    """Round of runs: a maximal run of one name becomes one symbol. It depends on the names at both sides."""
    same = (name[1:] == name[:-1]) & (doc[1:] == doc[:-1])
    first = np.flatnonzero(np.concatenate(([True], ~same)))
    last = np.concatenate((first[1:] - 1, [len(name) - 1]))
    k = last - first + 1
    is_run = k > 1
    new = name[first].copy()
    new[is_run] = mix(new[is_run] * U(0x9FB21C651E98DF25) + k[is_run].astype(U))
    l, r = left[first].copy(), right[last].copy()
    before, after = np.maximum(first - 1, 0), np.minimum(last + 1, len(name) - 1)
    has_before = (first > 0) & (doc[before] == doc[first])
    has_after = (last < len(name) - 1) & (doc[after] == doc[last])
    # every symbol's being a run or not depends on its neighbours
    l = np.where(has_before, np.minimum(l, left[before]), -FAR)
    r = np.where(has_after, np.maximum(r, right[after]), FAR)
    return new, lo[first], hi[last], l, r, doc[first]


def _pairs(name, lo, hi, left, right, doc, salt):
    is_left = (mix(name ^ U(salt)) & U(1)).astype(bool)
    n = len(name)
    joined = np.zeros(n, bool)  # i and i + 1
    joined[:-1] = is_left[:-1] & ~is_left[1:] & (doc[1:] == doc[:-1])
    second = np.concatenate(([False], joined[:-1]))
    after, before = np.minimum(np.arange(n) + 1, n - 1), np.maximum(np.arange(n) - 1, 0)
    l, r = left.copy(), right.copy()
    # a symbol of the left half depends on what follows, one of the right half on what precedes
    same_after = (doc[after] == doc) & (after > np.arange(n))
    same_before = (doc[before] == doc) & (before < np.arange(n))
    r = np.where(is_left, np.where(same_after, np.maximum(r, right[after]), FAR), r)
    l = np.where(is_left, np.where(same_after, np.minimum(l, left[after]), l), l)
    l = np.where(~is_left, np.where(same_before, np.minimum(l, left[before]), -FAR), l)
    r = np.where(~is_left, np.where(same_before, np.maximum(r, right[before]), r), r)
    keep = ~second
    at = np.flatnonzero(joined)
    new, end = name.copy(), hi.copy()
    new[at] = mix(name[at] * U(0xD1342543DE82EF95) + mix(name[at + 1] + U(salt)))
    end[at] = hi[at + 1]
    l[at], r[at] = np.minimum(l[at], l[at + 1]), np.maximum(r[at], r[at + 1])
    return new[keep], lo[keep], end[keep], l[keep], r[keep], doc[keep]


def _least(rank: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """The place of the least rank from each lo to before hi, the first one on ties."""
    if not len(lo):
        return lo
    bits = U(24)  # rank above, place below: places of a range differ by less than 2**24
    table = (rank >> bits << bits) | (np.arange(len(rank), dtype=U) & U(2**24 - 1))
    width = hi - lo
    out, size = np.empty(len(lo), U), 1
    while True:
        pick = (width >= size) & (width < 2 * size)
        out[pick] = np.minimum(table[lo[pick]], table[hi[pick] - size])
        if size * 2 > width.max():
            break
        table = np.minimum(table[:-size], table[size:])
        size *= 2
    place = (out & U(2**24 - 1)).astype(np.int64)
    return lo + ((place - lo) & (2**24 - 1))


def anchors(h: np.ndarray, offsets: np.ndarray, window: int, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, key, place) of every window of the documents whose words ``h`` holds; equal windows get equal keys.

    place: which symbol gave the key; it mostly serves several windows in a row.
    """
    doc = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    n = len(h)
    starts = np.flatnonzero(doc[:max(0, n - window + 1)] == doc[window - 1:]) if n >= window else np.empty(0, np.int64)
    if not len(starts):
        return starts, np.empty(0, U), starts
    i = np.arange(n)
    levels = [(h, i, i)]
    state = (h, i, i, i, i, doc)
    for k in range(rounds):
        state = _runs(*state)
        state = _pairs(*state, salt=0x1234567 + 977 * k)
        ok = state[4] - state[3] < window
        if not ok.any():
            break
        levels.append((state[0][ok], state[3][ok], state[4][ok]))
    keys, at = np.zeros(len(starts), U), np.zeros(len(starts), np.int64)
    open_ = np.arange(len(starts))
    total = running(h)
    for level in range(len(levels) - 1, -1, -1):
        name, left, right = levels[level]
        s = starts[open_]
        lo, hi = np.searchsorted(left, s), np.searchsorted(right, s + window - 1, "right")  # the symbols inside each window
        inside = hi > lo
        j = _least(mix(name + U(level)), lo[inside], hi[inside])
        where = open_[inside]
        keys[where] = mix(name[j] ^ mix(span(total, left[j], right[j] + 1) + U(level)))
        at[where] = j * (len(levels) + 1) + level
        open_ = open_[~inside]
        if not len(open_):
            break
    return starts, keys, at


def _documents(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t"))


def _sha(words: list[bytes]) -> str:
    return hashlib.sha256(b" ".join(words)).hexdigest()


def _sequences(src: DataFrame, more: list[str]) -> DataFrame:
    """(doc_id, seq, n_words, sha): a hash of each document's words, their number and their digest; and the columns ``more``, longs."""
    def run(batches):
        for b in batches:
            texts, seq, n, sha = b.column("t").to_pylist(), [], [], []
            for i, j in chunks(texts):
                w = Words(texts[i:j])
                h = w.hashes()
                seq += [sequence_hash(h[x:y]) for x, y in zip(w.offsets[:-1], w.offsets[1:])]
                n += np.diff(w.offsets).tolist()
                sha += [_sha((t or b"").split()) for t in texts[i:j]]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(signed(np.array(seq, U))), pa.array(n, pa.int64()), pa.array(sha), *(b.column(c) for c in more)],
                                             ["doc_id", "seq", "n_words", "sha", *more])
    return src.mapInArrow(run, "doc_id long, seq long, n_words long, sha string" + "".join(f", {c} long" for c in more))


def _each_window(texts, window, rounds):
    """Per range of texts: (range, word hashes, word offsets, window starts, their keys, the keys' places, their texts)."""
    for i, j in chunks(texts):
        w = Words(texts[i:j])
        h = w.hashes()
        starts, keys, place = anchors(h, w.offsets, window, rounds)
        if len(starts):
            yield i, j, h, w.offsets, starts, keys, place, np.searchsorted(w.offsets, starts, "right") - 1


def _anchor_rows(src: DataFrame, window: int, rounds: int) -> DataFrame:
    """(at, key, seq, sure): keys of each document's windows, a key once a task's batch unless its documents are sure of it."""
    def run(batches):
        for b in batches:
            key, seq = [], []
            for i, j, h, offs, starts, keys, place, doc in _each_window(b.column("t").to_pylist(), window, rounds):
                seqs = np.array([sequence_hash(h[x:y]) for x, y in zip(offs[:-1], offs[1:])], U)
                new = np.concatenate(([True], place[1:] != place[:-1]))  # once for the windows that a symbol serves
                key.append(keys[new])
                seq.append(seqs[doc[new]])
            if not key:
                continue
            key, seq = np.concatenate(key), np.concatenate(seq)
            _, at, count = np.unique(key, return_inverse=True, return_counts=True)
            sure = count[at] > 1
            first = np.unique(key[sure])
            out = [np.concatenate((key[~sure], seq[sure], first)), np.concatenate((key[~sure], key[sure], first)),
                   np.concatenate((seq[~sure], seq[sure], np.zeros(len(first), U))),
                   np.concatenate((np.zeros(int((~sure).sum()), np.int8), np.ones(int(sure.sum()), np.int8), np.full(len(first), 2, np.int8)))]
            for k in range(0, len(out[0]), 200_000):
                s = slice(k, k + 200_000)
                yield pa.RecordBatch.from_arrays([*(pa.array(signed(np.ascontiguousarray(x[s]))) for x in out[:3]), pa.array(out[3][s])], ["at", "key", "seq", "sure"])
    return src.mapInArrow(run, "at long, key long, seq long, sure tinyint")


def _repeated_keys(rows: DataFrame) -> DataFrame:
    """(seq, keys): per document, the keys that occur more than once anywhere."""
    own = Window.partitionBy("at", "key")
    many = rows.withColumn("n", F.count(F.lit(1)).over(own)).withColumn("most", F.max("sure").over(own))
    return many.where("sure = 1 or (sure = 0 and (n > 1 or most = 2))").groupBy("seq").agg(F.collect_set("key").alias("keys"))


def _window_rows(rows: DataFrame, window: int, rounds: int) -> DataFrame:
    """Windows with a repeated key: the batch's earliest of each, and (check null) the starts of the others by document."""
    def run(batches):
        for b in batches:
            wanted, tie, docs = b.column("keys"), b.column("tie").to_numpy(), b.column("id").to_pylist()
            flat, offs = wanted.values.to_numpy().view(U), wanted.offsets.to_numpy()
            order = np.array([-2**63 if x is None else x for x in docs], np.int64)
            met, again = set(), np.zeros(len(docs), bool)  # a repeated row is the same document
            for k, x in enumerate(zip(docs, tie.tolist())):
                again[k] = x in met
                met.add(x)
            parts = []
            for i, j, h, words, starts, keys, _, doc in _each_window(b.column("t").to_pylist(), window, rounds):
                keep = np.isin(keys, flat[offs[i]:offs[j]]) & ~again[doc + i]
                starts, doc = starts[keep], doc[keep]
                one = fold(h, window)[starts]
                two = fold(mix(h + U(0x632BE59BD9B4E019)), window)[starts]
                parts.append((one, two, doc + i, starts - words[doc]))
            if not parts:
                continue
            one, two, doc, start = (np.concatenate(x) for x in zip(*parts))
            by = np.lexsort((start, tie[doc], order[doc], two, one))
            lead = np.concatenate(([True], (one[by][1:] != one[by][:-1]) | (two[by][1:] != two[by][:-1])))[:len(by)]
            c, late = by[lead], by[~lead]
            for k in range(0, len(c), 200_000):
                s = c[k:k + 200_000]
                yield _windows_batch(one[s], two[s], order[doc[s]], tie[doc[s]], start[s], None)
            late = late[np.argsort(doc[late], kind="stable")]
            if len(late):
                cut = np.flatnonzero(np.concatenate(([True], doc[late][1:] != doc[late][:-1])))
                d = doc[late][cut]
                lists = pa.ListArray.from_arrays(pa.array(np.append(cut, len(late)), pa.int32()), pa.array(start[late].astype(np.int32)))
                yield _windows_batch(mix(order[d].view(U) ^ mix(tie[d].view(U))), None, order[d], tie[d], None, lists)
    return rows.mapInArrow(run, "hash long, check long, doc long, tie long, start int, late array<int>")


def _windows_batch(one, two, doc, tie, start, late):
    n = len(doc)
    return pa.RecordBatch.from_arrays(
        [pa.array(signed(one)), pa.nulls(n, pa.int64()) if two is None else pa.array(signed(two)), pa.array(doc), pa.array(tie),
         pa.nulls(n, pa.int32()) if start is None else pa.array(start.astype(np.int32)), pa.nulls(n, pa.list_(pa.int32())) if late is None else late],
        ["hash", "check", "doc", "tie", "start", "late"])


def _repeats(found: DataFrame) -> DataFrame:
    """(doc, tie, starts): per document, the starts of windows that occur earlier."""
    own = Window.partitionBy("hash", "check")
    late = found.withColumn("low", F.min(F.struct("doc", "tie", "start")).over(own)).where("check is null or struct(doc, tie, start) > low")
    return late.groupBy("doc", "tie").agg(F.flatten(F.collect_list(F.coalesce("late", F.array("start")))).alias("starts"))


def _own_texts(src: DataFrame, heads: DataFrame) -> DataFrame:
    """The rows of ``heads`` (id, own, ...) with their text ``t``: the document of that id whose text has the hash ``own``."""
    return src.join(heads, src["doc_id"].eqNullSafe(heads["id"]) & (src["text_hash"] == heads["own"])).drop("doc_id", "text_hash", "own")


def _cut(rows: DataFrame, window: int) -> DataFrame:
    """(seq, text, n_removed, sha) of the documents with repeats."""
    def run(batches):
        for b in batches:
            texts, lists = b.column("t").to_pylist(), b.column("starts").to_pylist()
            kept, removed = [], []
            for t, starts in zip(texts, lists):
                words = t.split()
                edge = np.zeros(len(words) + 1, np.int64)
                s = np.unique(np.array(starts, np.int64))
                np.add.at(edge, s, 1)
                np.add.at(edge, s + window, -1)
                cover = np.cumsum(edge[:-1]) > 0
                kept.append([w for w, c in zip(words, cover.tolist()) if not c])
                removed.append(int(cover.sum()))
            yield pa.RecordBatch.from_arrays(
                [b.column("seq"), pa.array([b" ".join(k).decode() for k in kept]), pa.array(removed, pa.int64()), pa.array([_sha(k) for k in kept])],
                ["seq", "kept", "n_removed", "kept_sha"])
    return rows.mapInArrow(run, "seq long, kept string, n_removed long, kept_sha string")


def substring_dedup(docs: DataFrame, window: int = 20, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text",
                    with_text: bool = False) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_removed, kept_sha256`` (see the module's notes).

    ``with_text`` adds ``seq`` (the hash of the words), ``text_hash`` (of the text as it is) and
    ``kept_text``, the kept words joined by a space: null where nothing was removed.
    """
    src = _documents(docs, id_col, text_col).withColumn("text_hash", text_hash("t"))
    each = written(_sequences(src, ["text_hash"]), "substring-sequences")
    # a sequence stands for one document: the smallest id (null first) that has it, and the hash of one of its texts
    first = each.groupBy("seq").agg(F.min(F.struct("doc_id", "text_hash")).alias("low"), F.count(F.lit(1)).alias("n"))
    first = written(first.select("seq", F.col("low.doc_id").alias("first"), F.col("low.text_hash").alias("own"), "n"), "substring-first")
    # documents of one id (or of none) go by their sequence too; for all others it's left out of the rows
    several = first.where("first is not null").groupBy("first").agg(F.count(F.lit(1)).alias("texts")).where("texts > 1")
    tie = F.when(F.col("first").isNull() | F.col("texts").isNotNull(), F.col("seq")).otherwise(0)
    head = written(join_counted(first.select("seq", "first", "own"), several, ["first"], "texts").select(
        "seq", F.col("first").alias("id"), "own", tie.alias("tie")), "substring-heads")
    wanted = _repeated_keys(_anchor_rows(src, window, rounds))
    texts = _own_texts(src, wanted.join(head, "seq"))
    starts = written(_repeats(_window_rows(texts.select("t", "keys", "id", "tie"), window, rounds)), "substring-repeats")
    place = F.coalesce("id", F.lit(-2**63))
    cut = head.join(starts, (place == starts["doc"]) & (head["tie"] == starts["tie"])).select("seq", "id", "own", "starts")
    done = _cut(_own_texts(src, cut).select("t", "seq", "starts"), window)
    done = (done if with_text else done.drop("kept")).dropDuplicates(["seq"])
    rows = join_counted(each, first.drop("own").join(done, "seq", "left"), ["seq"], how="inner")
    copy = ~F.col("doc_id").eqNullSafe(F.col("first")) & (F.col("n_words") >= window)
    out = rows.select("doc_id", "n_words", F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("long"))).alias("n_removed"),
                      F.when(copy, F.lit(_sha([]))).otherwise(F.coalesce("kept_sha", "sha")).alias("kept_sha256"),
                      *([F.when(copy, F.lit("")).otherwise(F.col("kept")).alias("kept_text"), "seq", "text_hash"] if with_text else []))
    return out
