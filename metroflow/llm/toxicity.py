"""Toxicity by maximum-scoring segments of token log-odds.

Tokens are runs of letters and digits, A-Z lower-cased. A token's score is its log-odds
between toxic and other labelled documents, counted at most ``MOST`` times a document, under a Dirichlet
prior in the proportions of all sampled tokens; log-odds under ``MIN_ODDS``, or that their
own deviation doesn't carry (under ``MIN_Z``, less where few toxic documents are known: ``least_z``), count as 0. Beginnings of tokens (of ``STEMS`` bytes) are counted like
tokens, for words that occur in many forms: a token takes the log-odds, its own or of a beginning,
that is the surest. Less a drift, so that the mean score of other text is negative.

All maximal scoring segments of a text are found in one linear scan. Under text like
that of the other documents, the best score among n tokens follows an extreme-value law,
P(S >= s) = 1 - exp(-K n exp(-lambda s)); lambda solves E[exp(lambda s)] = 1 over the
other documents' tokens, K is the likeliest one for their best scores. A segment of at
most ``ALPHA`` expected by chance is a significant passage. A text's evidence, the sum
of lambda s - log(K n) over its significant passages, becomes a probability by a
logistic fit on labelled rows that gave no counts; its slope is never negative, whatever a
few such rows say: more evidence is no less toxic.

Fitted on at most ``per_class`` labelled documents of each class, those of least keyed
hash; the model holds their tokens of significant log-odds. Scoring is a map over whole texts.

Edge cases: null, empty and tokenless texts have no passage and the score of no evidence.
Without labels of both classes no text is toxic (score 0). Repeated rows are scored each;
only the named columns are read; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflow.llm.labelled import labelled_sample, logistic
from metroflow.llm.words import PUNCTUATION, U, Words, chunks, mix, signed

PER_CLASS = 6000
#: PRIOR: the prior's weight as a share of all counted tokens.
PRIOR, MIN_Z, MIN_ODDS, DRIFT, ALPHA = 0.02, 3.0, 2.0, 0.1, 0.01
STEMS, MOST = (4, 5, 6, 7, 8), 4
#: Toxic documents from which on MIN_Z holds, and up to which FEW_Z does; the least slope.
MANY, FEW, FEW_Z, MIN_SLOPE = 240, 60, 2.0, 0.25


def least_z(toxic: int) -> float:
    """How surely a token's log-odds must differ from 0: few documents carry few tokens surely."""
    return MIN_Z - (MIN_Z - FEW_Z) * float(np.clip(np.log(MANY / max(1, toxic)) / np.log(MANY / FEW), 0.0, 1.0))


def segments(place: np.ndarray, score: np.ndarray, drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first, last, score) of a text whose tokens score ``-drift`` but at ``place``.

    Linear time: each segment holds the running sums before and at its end; a new one swallows
    earlier ones back to the last that began lower.
    """
    out: list[tuple[int, int, float, float, int]] = []  # first, last, sum before, sum at end, index of the last one that began lower
    total, at = 0.0, 0
    for p, s in zip(place.tolist(), score.tolist()):
        total -= drift * (p - at)
        at = p + 1
        if s <= 0:
            total += s
            continue
        first, before, end = p, total, total + s
        total = end
        j = len(out) - 1
        while True:
            while j >= 0 and out[j][2] >= before:
                j = out[j][4]
            if j < 0 or out[j][3] >= end:
                out.append((first, p, before, end, j))
                break
            first, before = out[j][0], out[j][2]
            del out[j:]
            j = len(out) - 1
    return [(a, b, r - l) for a, b, l, r, _ in out]


def tokens(texts: list[bytes | None]) -> tuple[Words, list[np.ndarray]]:
    """The texts' tokens; their hashes, and those of their beginnings (0: a token too short for one)."""
    w = Words(texts, lower=True, space=PUNCTUATION)
    size = w.ends - w.starts
    return w, [w.hashes(), *(np.where(size > n, mix(w.hashes(np.minimum(w.ends, w.starts + n)) ^ U(n)), U(0)) for n in STEMS)]


def _counted(w: Words, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashes and their counts, at most MOST of each text."""
    each = [np.unique(h[x:z], return_counts=True) for x, z in zip(w.offsets[:-1], w.offsets[1:])]
    kind, at = np.unique(np.concatenate([e[0] for e in each]), return_inverse=True)
    return kind, np.bincount(at, np.minimum(np.concatenate([e[1] for e in each]), MOST), len(kind)).astype(np.int64)


class Model:
    def __init__(self, tokens: np.ndarray, odds: np.ndarray, sure: np.ndarray, drift: float = DRIFT):
        self.tokens, self.odds, self.sure, self.drift = tokens, odds, sure, drift
        self.known = np.zeros(1 << 18, bool)  # by the hash's first bits, to pass over most tokens
        self.known[tokens >> U(46)] = True
        self.rate, self.k, self.slope, self.offset = 1.0, 1.0, 0.0, -35.0

    def lookup(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which of the hashes the model has, their log-odds and how sure these are."""
        at = np.flatnonzero(self.known[h >> U(46)])
        if not len(at):
            return at, np.empty(0), np.empty(0)
        place = np.minimum(np.searchsorted(self.tokens, h[at]), len(self.tokens) - 1)
        same = self.tokens[place] == h[at]
        return at[same], self.odds[place[same]], self.sure[place[same]]

    def scan(self, texts: list[bytes | None]):
        """Per text: (number of tokens, its maximal scoring segments, its Words, its first token)."""
        for a, b in chunks(texts):
            w, levels = tokens(texts[a:b])
            odds, sure = np.zeros(len(w.starts)), np.zeros(len(w.starts))
            for h in levels:
                at, x, z = self.lookup(h)
                better = z > sure[at]
                odds[at[better]], sure[at[better]] = x[better], z[better]
            hit = np.flatnonzero(sure)
            cut = np.searchsorted(hit, w.offsets)
            score = odds[hit] - self.drift
            for i in range(b - a):
                lo, hi = cut[i], cut[i + 1]
                n = int(w.offsets[i + 1] - w.offsets[i])
                yield n, segments(hit[lo:hi] - w.offsets[i], score[lo:hi], self.drift) if hi > lo else [], w, w.offsets[i], w.text_bounds[i], score[lo:hi]

    def evidence(self, n: int, found) -> tuple[float, list[tuple[int, int, float]]]:
        """(evidence, significant segments) of a text."""
        least = np.log(max(self.k * n, 1e-300))
        good = [(a, b, self.rate * s - least) for a, b, s in found if self.rate * s - least >= -np.log(ALPHA)]
        return sum(x for _, _, x in good), good

    def probability(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * np.log1p(evidence) + self.offset, -35, 35)))


def _rate(score: np.ndarray, count: np.ndarray) -> float:
    """The positive root of E[exp(x s)] = 1."""
    p = count / count.sum()
    if not ((score > 0) & (count > 0)).any():
        return 1.0
    lo, hi = 1e-6, 1e-6
    while (p * np.exp(np.minimum(hi * score, 700))).sum() < 1 and hi < 1e3:
        hi *= 2
    for _ in range(100):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if (p * np.exp(np.minimum(mid * score, 700))).sum() < 1 else (lo, mid)
    return hi


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "toxic", per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    rows, n = labelled_sample(docs, labels, label_col, per_class, "toxicity sample", id_col, text_col)
    spark = docs.sparkSession

    def count(batches):
        for b in batches:
            y, k, texts = b.column("y").to_numpy(), b.column("k").to_numpy(), b.column("t").to_pylist()
            for c in (0, 1):
                for i, j in chunks(own := [texts[i] for i in np.flatnonzero((y == c) & (k % 4 != 0))]):
                    w, levels = tokens(own[i:j])
                    each = [_counted(w, h) for h in levels]
                    t, m = np.concatenate([e[0] for e in each]), np.concatenate([e[1] for e in each])
                    t, m = t[t > 0], m[t > 0]
                    yield pa.RecordBatch.from_arrays([pa.array(signed(t)), pa.array(np.full(len(t), c, np.int32)), pa.array(m.astype(np.int64))], ["token", "y", "n"])

    counts = rows.mapInArrow(count, "token long, y int, n long").groupBy("token").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("a"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("b"))
    counts = counts.persist()
    a, b = counts.agg(F.sum("a"), F.sum("b")).first()
    if not a or not b or not n.get(0) or not n.get(1):
        counts.unpersist()
        return Model(np.empty(0, np.uint64), np.empty(0), np.empty(0))
    total = PRIOR * (a + b)
    prior = F.lit(PRIOR) * (F.col("a") + F.col("b"))
    x, y = F.col("a") + prior, F.col("b") + prior
    odds = F.log(x / (F.lit(a + total) - x)) - F.log(y / (F.lit(b + total) - y))
    table = counts.select("token", "b", odds.alias("odds"), (odds / F.sqrt(1 / x + 1 / y)).alias("z")).where((F.col("z") >= least_z(min(n[1], per_class))) & (F.col("odds") >= MIN_ODDS)).toArrow()
    counts.unpersist()
    known = table.column("token").to_numpy().view(np.uint64)
    order = np.argsort(known)
    model = Model(known[order], table.column("odds").to_numpy()[order], np.abs(table.column("z").to_numpy()[order]))
    first = spark.sparkContext.broadcast(model)

    def plain(batches):
        for b in batches:
            n, seen = 0, [np.empty(0)]
            for m, *_, scores in first.value.scan(b.column("t").to_pylist()):
                n += m
                seen.append(np.round(scores + first.value.drift, 3))
            value, count = np.unique(np.concatenate(seen), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(value, 0.0)), pa.array(np.append(count, n - count.sum()).astype(np.int64))], ["s", "n"])

    got = rows.where("y = 0 and k % 4 <> 0").mapInArrow(plain, "s double, n long").groupBy("s").sum("n").toArrow()  # log-odds of the model
    value, count = got.column(0).to_numpy(), got.column(1).to_numpy().astype(float)
    model.drift = max(DRIFT, float((value * count).sum() / max(1.0, count.sum())) + 0.05)  # the law needs a negative mean
    model.rate = _rate(value - model.drift, count)
    held = spark.sparkContext.broadcast(model)

    def best(batches):
        for b in batches:
            found = [(m, max([s for _, _, s in f], default=0.0)) for m, f, *_ in held.value.scan(b.column("t").to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([float(f[1]) for f in found]),
                                              pa.array([float(x) for x in np.zeros(len(found))]), b.column("y"), b.column("k")], ["n", "s", "e", "y", "k"])

    got = rows.where("y = 0 and k % 4 <> 0").mapInArrow(best, "n long, s double, e double, y int, k int").toArrow()  # at most per_class rows
    size, top = got.column("n").to_numpy().astype(float), got.column("s").to_numpy()
    model.k = max(1e-12, len(size) / max(1e-300, (size * np.exp(-model.rate * top)).sum()))
    held2 = spark.sparkContext.broadcast(model)

    def weigh(batches):
        for b in batches:
            e = [float(held2.value.evidence(m, f)[0]) for m, f, *_ in held2.value.scan(b.column("t").to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column("y"), pa.array(e, pa.float64())], ["y", "e"])

    got = rows.where("k % 4 = 0").mapInArrow(weigh, "y int, e double").toArrow()
    y, e = got.column("y").to_numpy(), np.log1p(got.column("e").to_numpy())
    if len(set(y.tolist())) == 2:
        weight = np.array([n[c] / (y == c).sum() for c in (0, 1)])
        model.slope, model.offset = logistic(e, y, weight[y])
        if model.slope < MIN_SLOPE:
            model.slope = MIN_SLOPE
            model.offset = float(np.log((n[1] + 1) / (n[0] + 1)) - MIN_SLOPE * np.average(e, weights=weight[y]))
    else:
        model.slope, model.offset = 1.0, -2.0
    return model


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, score, passages) of every row; a passage has its first and last byte (from 0) in the UTF-8 text and its evidence."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t"))

    def run(batches):
        m = held.value
        kind = pa.list_(pa.struct([("first", pa.int64()), ("last", pa.int64()), ("evidence", pa.float64())]))
        for b in batches:
            total, spans = [], []
            for n, found, w, lo, base, _ in m.scan(b.column("t").to_pylist()):
                e, good = m.evidence(n, found) if found else (0.0, [])
                total.append(e)
                spans.append([{"first": int(w.starts[lo + i] - base), "last": int(w.ends[lo + j] - base - 1), "evidence": float(x)} for i, j, x in good])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(m.probability(np.array(total))), pa.array(spans, kind)], ["doc_id", "score", "passages"])
    return src.mapInArrow(run, "doc_id long, score double, passages array<struct<first:long,last:long,evidence:double>>")
