"""SentencePiece encoding with seeded merge-dropout, and decoding.

Encoding follows a BPE model of pieces with scores: a text's characters (a space written
as U+2581, one more in front) are joined pair by pair, the best-scored pair first, the
leftmost of equals. Here each candidate merge (the place in its word of its start, middle and end,
and the piece it makes) is skipped if a keyed hash falls under ``dropout``, so the same word is
cut differently under different keys. Every occurrence of a word has a key of its own: the seed
with the hash of the document's id and the word's place in the text; a seed always gives the same result.
Characters the model lacks, and U+2581 itself, become byte pieces. Decoding is lossless.

Merges never cross a word's start (no piece holds U+2581 behind another character), so words
are encoded apart, all words of a megabyte at once in numpy. The occurrences of a word go down
one tree of cuts together, a candidate merge (the best one left) a round: those that make it and those
that skip it part there. So the merges are worked out once for each way a word is cut, and
an occurrence costs a hash a round; a word of more than ``LONG`` characters goes by an agenda (a heap of
candidate merges) of its own, once an occurrence.

Edge cases: null text has no pieces (null); '' has none (empty); texts without spaces, of any
length, are one word; repeated rows are encoded alike; for a null id the text's hash makes the key; only the
named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructType

from metroflow.llm.words import U, chunks, mix, mix_int, running, span

SPACE = 0x2581
LONG = 48
DROPOUT, SEED = 0.1, 17
_NONE = np.int64(2**62)


class Vocabulary:
    """Tables of a SentencePiece BPE model with byte pieces."""

    def __init__(self, path: str):
        import sentencepiece

        m = sentencepiece.SentencePieceProcessor(model_file=path)
        n = m.get_piece_size()
        self.byte_ids = np.zeros(256, np.int32)
        raw: list[bytes] = [b""] * n
        pieces: dict[str, int] = {}
        for i in range(n):
            p = m.id_to_piece(i)
            if m.is_byte(i):
                self.byte_ids[int(p[3:5], 16)] = i
                raw[i] = bytes([int(p[3:5], 16)])
            elif not (m.is_control(i) or m.is_unknown(i) or m.is_unused(i)):
                pieces[p] = i
                raw[i] = p.replace("▁", " ").encode()
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("a piece spans two words: words can't be encoded apart")
        self.char = np.full(0x110000, -1, np.int32)
        for p, i in pieces.items():
            if len(p) == 1:
                self.char[ord(p)] = i
        # every way to make a piece of two: key left * n + right; a higher score is a lower rank
        made = [(pieces[p[:k]], pieces[p[k:]], i) for p, i in pieces.items() for k in range(1, len(p)) if p[:k] in pieces and p[k:] in pieces]
        order = {i: r for r, i in enumerate(sorted(set(x[2] for x in made), key=lambda i: (-m.get_score(i), i)))}
        key = np.array([a * n + b for a, b, _ in made], np.int64)
        by = np.argsort(key)
        self.n, self.keys = n, key[by]
        self.made = np.array([x[2] for x in made], np.int32)[by]
        self.rank = np.array([order[x[2]] for x in made], np.int64)[by]
        self.raw = raw
        self.sizes = np.array([len(x) for x in raw], np.int64)
        self.bytes = np.frombuffer(b"".join(raw) + b"\0", np.uint8)
        self.at = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]

    def merge(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of joining pieces a and b; rank -1: no such piece."""
        key = a.astype(np.int64) * self.n + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        ok = (self.keys[at] == key) & (a >= 0) & (b >= 0)
        return np.where(ok, self.rank[at], -1), self.made[at]


@lru_cache(2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def skipped(key: np.ndarray, first: np.ndarray, middle: np.ndarray, end: np.ndarray, piece: np.ndarray, dropout: float) -> np.ndarray:
    """Whether the keyed hash drops a candidate merge; key: of the word's occurrence."""
    place = first.astype(U) * U(0x9E3779B97F4A7C15) + middle.astype(U) * U(0xC2B2AE3D27D4EB4F) + end.astype(U) * U(0x165667B19E3779F9)
    return (mix(mix(key + place) ^ piece.astype(U)) >> U(11)) < U(int(dropout * 2**53))


def agenda(v: Vocabulary, ids: np.ndarray, key: int, dropout: float) -> list[int]:
    """One word's pieces by a heap of candidate merges."""
    n = len(ids)
    piece, after, before, end = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1)), list(range(1, n + 1))
    alive, heap = [True] * n, []

    def offer(places):
        a = np.array([i for i in places if i >= 0 and after[i] < n], np.int64)
        if not len(a):
            return
        b = np.array([after[i] for i in a.tolist()])
        rank, made = v.merge(np.array([piece[i] for i in a.tolist()], np.int32), np.array([piece[i] for i in b.tolist()], np.int32))
        last = np.array([end[i] for i in b.tolist()])
        ok = rank >= 0
        if dropout:
            ok &= ~skipped(np.full(len(a), key, U), a, b, last, made, dropout)
        for i in np.flatnonzero(ok).tolist():
            heapq.heappush(heap, (int(rank[i]), int(a[i]), int(b[i]), int(last[i]), int(made[i])))

    offer(range(n - 1))
    while heap:
        _, i, j, e, made = heapq.heappop(heap)
        if not alive[i] or after[i] != j or not (j < n and alive[j]) or end[j] != e:
            continue  # one of the two has changed since
        piece[i], end[i], after[i], alive[j] = made, e, after[j], False
        if after[i] < n:
            before[after[i]] = i
        offer([before[i], i])
    return [p for p, a in zip(piece, alive) if a]


def gathered(flat: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The stretches flat[first:first + size] one after another."""
    total = np.cumsum(size)
    if not len(total) or not total[-1]:
        return flat[:0]
    return flat[np.repeat(first - np.concatenate(([0], total[:-1])), size) + np.arange(total[-1])]


def encode_words(v: Vocabulary, ids: np.ndarray, offsets: np.ndarray, which: np.ndarray, keys: np.ndarray,
                 dropout: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pieces, offsets, words, cut): the cuts that occur, the word of each, and each occurrence's cut.

    ids, offsets: the distinct words as character pieces; which, keys: each occurrence's word and key. A state is
    a word some of whose candidate merges are decided, with the occurrences that decided alike; a round decides
    the best one left of each state.
    """
    size = np.diff(offsets)
    cut = np.zeros(len(which), np.int64)
    parts, sizes, words, made_cuts = [], [], [], 0
    word = np.flatnonzero(size <= LONG)
    occ = np.flatnonzero(size[which] <= LONG)
    state = (np.cumsum(size <= LONG) - 1)[which[occ]]
    n = size[word]
    lead = np.concatenate(([0], np.cumsum(n)))[:-1]
    piece = gathered(ids, offsets[:-1][word], n)
    first = np.arange(len(piece)) - np.repeat(lead, n)
    end = first + 1
    score, made = np.full(len(piece), _NONE), np.zeros(len(piece), np.int32)  # of each piece with the next one

    def offer(at):
        rank, made[at] = v.merge(piece[at], piece[at + 1])
        score[at] = np.where(rank >= 0, rank * 64 + first[at], _NONE)  # places are below LONG: the leftmost of equals

    inner = np.ones(len(piece), bool)
    inner[lead + n - 1] = False
    offer(np.flatnonzero(inner))
    while len(word):
        best = np.minimum.reduceat(score, lead)
        more = best < _NONE
        if not more.all():  # states that are done leave
            over = ~more
            parts.append(piece[np.repeat(over, n)])
            sizes.append(n[over])
            words.append(word[over])
            done = over[state]
            cut[occ[done]] = (made_cuts + np.cumsum(over) - 1)[state[done]]
            made_cuts += int(over.sum())
            occ, state = occ[~done], (np.cumsum(more) - 1)[state[~done]]
            if not len(occ):
                break
        at = np.flatnonzero((score == np.repeat(best, n)) & np.repeat(more, n))
        word, lead, n = word[more], lead[more], n[more]
        if dropout:
            drop = skipped(keys[occ], first[at][state], first[at + 1][state], end[at + 1][state], made[at][state], dropout)
        else:
            drop = np.zeros(len(occ), bool)
        child = 2 * state + drop
        used = np.zeros(2 * len(word), bool)
        used[child] = True
        state = (np.cumsum(used) - 1)[child]
        kids = np.flatnonzero(used)
        parent, skip = kids >> 1, (kids & 1).astype(bool)
        word, n, old = word[parent], n[parent], lead[parent]
        lead = np.concatenate(([0], np.cumsum(n)))[:-1]
        own = np.repeat(old - lead, n) + np.arange(int(n.sum()))
        place = lead + at[parent] - old
        piece, first, end, score, made = piece[own], first[own], end[own], score[own], made[own]
        score[place[skip]] = _NONE
        i = place[~skip]
        if not len(i):
            continue
        piece[i], end[i] = made[i], end[i + 1]
        keep = np.ones(len(piece), bool)
        keep[i + 1] = False
        score[i] = _NONE
        piece, first, end, score, made = piece[keep], first[keep], end[keep], score[keep], made[keep]
        n = n - ~skip
        i = i - lead[~skip]
        lead = np.concatenate(([0], np.cumsum(n)))[:-1]
        i, low, last = i + lead[~skip], lead[~skip], (lead + n - 1)[~skip]
        offer(np.concatenate((i[i < last], (i - 1)[i > low])))
    seen: dict[tuple[int, int], int] = {}
    for o in np.flatnonzero(size[which] > LONG).tolist():
        k = int(which[o])
        name = (k, int(keys[o]) if dropout else 0)
        if name not in seen:
            p = agenda(v, ids[offsets[k]:offsets[k + 1]], int(keys[o]), dropout)
            parts.append(np.array(p, np.int32))
            sizes.append(np.array([len(p)]))
            words.append(np.array([k]))
            seen[name] = made_cuts
            made_cuts += 1
        cut[o] = seen[name]
    if not parts:
        return np.empty(0, np.int32), np.zeros(1, np.int64), np.empty(0, np.int64), cut
    return np.concatenate(parts).astype(np.int32), np.concatenate(([0], np.cumsum(np.concatenate(sizes)))), np.concatenate(words), cut


def encode(v: Vocabulary, texts: list[str], lanes: np.ndarray, dropout: float, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """(pieces, offsets by text); ``lanes``: each text's number."""
    size = np.fromiter((len(t) + 1 if t else 0 for t in texts), np.int64, len(texts))
    raw = np.frombuffer("".join("▁" + t if t else "" for t in texts).encode("utf-32-le"), np.uint32)
    text_at = np.concatenate(([0], np.cumsum(size)))
    if not len(raw):
        return np.empty(0, np.int32), text_at
    c = np.where(raw == 32, SPACE, raw)
    front = np.zeros(len(raw), bool)
    front[text_at[:-1][size > 0]] = True
    own = (raw == SPACE) & ~front  # U+2581 of the text itself
    ids = v.char[c]
    ids[own] = -1
    gap = (c == SPACE) & ~own
    # a word begins in front of a gap that follows no gap, and around characters without a piece
    begin = front | (gap & ~np.concatenate(([False], gap[:-1]))) | (ids < 0) | np.concatenate(([False], ids[:-1] < 0))
    start = np.flatnonzero(begin)
    stop = np.append(start[1:], len(raw))
    total = running(mix(c.astype(U) + U(0x51ED270B) * own.astype(U)))
    text = np.searchsorted(text_at, start, "right") - 1
    lane = mix(lanes.astype(np.int64).view(U) ^ U(mix_int(seed)))[text]
    key = mix(lane + mix((start - text_at[text]).astype(U)))
    _, first, which = np.unique(span(total, start, stop) + (stop - start).astype(U), return_index=True, return_inverse=True)
    lengths = (stop - start)[first]
    chars = gathered(ids, start[first], lengths)
    word_at = np.concatenate(([0], np.cumsum(lengths)))
    p, at, words, cut = encode_words(v, np.where(chars >= 0, chars, 0), word_at, which, key, dropout)
    own_at, own_size = at[:-1].copy(), np.diff(at)
    # words of one character without a piece: its bytes
    odd = np.flatnonzero(ids[start[first[words]]] < 0)
    if len(odd):
        parts = [v.byte_ids[np.frombuffer(chr(int(raw[start[first[k]]])).encode(), np.uint8)] for k in words[odd].tolist()]
        own_at[odd] = len(p) + np.concatenate(([0], np.cumsum([len(x) for x in parts])))[:-1]
        own_size[odd] = [len(x) for x in parts]
        p = np.concatenate([p, *parts])
    out = gathered(p, own_at[cut], own_size[cut])
    ends = np.concatenate(([0], np.cumsum(own_size[cut])))
    return out, ends[np.searchsorted(start, text_at)]


def decode(v: Vocabulary, pieces: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of the texts of pieces; the space in front of each is dropped."""
    size = v.sizes[pieces]
    data = gathered(v.bytes, v.at[pieces], size)
    at = np.concatenate(([0], np.cumsum(size)))[offsets]
    keep = np.ones(len(data), bool)
    keep[at[:-1][np.diff(at) > 0]] = False
    return data[keep], np.concatenate(([0], np.cumsum(keep)))[at]


def _path(spark, path: str) -> str:
    """The model's name among the files that Spark sends to its executors."""
    spark.sparkContext.addFile(path)
    return path.rsplit("/", 1)[-1]


def encoded(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", dropout: float = DROPOUT, seed: int = SEED,
            keep: list[str] | None = None) -> DataFrame:
    """(doc_id, n_pieces, pieces, lossless) of every row; ``keep`` names columns to carry along instead of doc_id,
    but those of the result's own names.

    lossless: decoding the pieces gives the text back, byte for byte (null for null text).
    """
    name = _path(docs.sparkSession, model)
    lane = F.xxhash64(F.coalesce(F.col(id_col).cast("string"), F.col(text_col).cast("string"), F.lit("")))
    cols = [F.col(c) for c in keep if c not in ("n_pieces", "pieces", "lossless")] if keep else [F.col(id_col).cast("long").alias("doc_id")]
    src = docs.select(*cols, F.col(text_col).cast("string").alias("__t"), lane.alias("__v"))
    schema = StructType([*src.drop("__t", "__v").schema.fields]).add("n_pieces", IntegerType()).add("pieces", ArrayType(IntegerType())).add("lossless", BooleanType())

    def run(batches):
        v = vocabulary(SparkFiles.get(name))
        for b in batches:
            texts, lanes = b.column("__t").to_pylist(), b.column("__v").to_numpy()
            blank = np.array([t is None for t in texts], bool)
            raw = [(t or "").encode() for t in texts]
            for i, j in chunks(raw, 1 << 20):
                p, at = encode(v, [t or "" for t in texts[i:j]], lanes[i:j], dropout, seed)
                data, ends = decode(v, p, at)
                same = data.tobytes() == b"".join(raw[i:j]) and np.array_equal(np.diff(ends), [len(x) for x in raw[i:j]])
                ok = np.ones(j - i, bool) if same else np.array([data[ends[k]:ends[k + 1]].tobytes() == raw[i + k] for k in range(j - i)])
                none = pa.array(blank[i:j])
                lists = pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(p, pa.int32()), mask=none)
                head = [c.slice(i, j - i) for c in b.columns[:-2]]
                yield pa.RecordBatch.from_arrays([*head, pa.array(np.diff(at).astype(np.int32), mask=blank[i:j]), lists, pa.array(ok, mask=blank[i:j])],
                                                 [*b.schema.names[:-2], "n_pieces", "pieces", "lossless"])
    return src.mapInArrow(run, schema)


def decoded(rows: DataFrame, model: str, id_col: str = "doc_id", pieces_col: str = "pieces") -> DataFrame:
    """(doc_id, text) of encoded rows."""
    name = _path(rows.sparkSession, model)

    def run(batches):
        v = vocabulary(SparkFiles.get(name))
        for b in batches:
            col = b.column("p")
            flat, n = col.flatten().to_numpy(), np.array([len(x) if x is not None else 0 for x in col.to_pylist()], np.int64)
            data, ends = decode(v, flat, np.concatenate(([0], np.cumsum(n))))
            text = [data[ends[k]:ends[k + 1]].tobytes().decode() if ok else None for k, ok in enumerate(col.is_valid().to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(text, pa.string())], ["doc_id", "text"])
    return rows.select(F.col(id_col).cast("long").alias("doc_id"), F.col(pieces_col).cast("array<int>").alias("p")).mapInArrow(run, "doc_id long, text string")
