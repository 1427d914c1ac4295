"""Language identification by error-correcting output codes.

Every language has a codeword of bits. For each bit a naive Bayes classifier on
letter n-grams (1 to 3 letters, words padded, hashed into ``BINS`` bins) tells
the languages with bit 1 from those with bit 0. Decoding takes the codeword of
least weighted loss: the loss of a bit falls with the margin by which the
classifier agrees, and weighs as much as that bit was right for that language
on documents kept out of the counts. A text whose best two languages lie close
is flagged ambiguous.

Fitted on at most ``sample`` documents per language, those of least keyed hash;
the model has ``BINS`` x bits numbers. Prediction is a map over whole texts.

Edge cases: null text, or text without a letter: ``und`` with score 0, not
ambiguous. Rows of null language are no training rows. Without any training
row all texts are ``und``; with one language it takes all texts with letters,
score 1. Repeated rows count and are predicted each; only the named columns
are read; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from metroflow.llm.words import chunks

BINS = 1 << 15
SAMPLE = 1500
_alpha: list[np.ndarray] = []


def _letters() -> np.ndarray:
    if not _alpha:
        t = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
        _alpha.append(t)
    return _alpha[0]


def grams(texts: list[bytes | None]) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per range of texts: (first, last, bins of all n-grams, the text that each is of)."""
    alpha = _letters()
    for a, b in chunks(texts, 1 << 20):
        low = [(t or b"").decode("utf-8", "replace").lower() for t in texts[a:b]]
        c = np.frombuffer(("\n".join(low) + "\n").encode("utf-32-le", "replace"), np.uint32)
        ends = np.cumsum(np.fromiter((len(t) + 1 for t in low), np.int64, len(low)))
        letter = alpha[np.minimum(c, 0x10FFFF)]
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # one gap after each word
        at = np.flatnonzero(keep)
        c = np.where(letter[at], c[at], 0).astype(np.uint32)
        text = np.searchsorted(ends, at, "right")
        x = np.concatenate((np.zeros(2, np.uint32), c))
        tri = (x[2:] * np.uint32(0x9E3779B1) ^ x[1:-1] * np.uint32(0x85EBCA77) ^ x[:-2] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F)
        two = (x[2:] * np.uint32(0x165667B1) + x[1:-1] * np.uint32(0xD3A2646D)) * np.uint32(0x9E3779B1)
        one = x[2:] * np.uint32(0xB5297A4D)
        whole = (x[1:-1] != 0) | (x[2:] != 0)
        yield a, b, np.stack([tri, two, one], 1)[whole] >> np.uint32(17), text[whole]


def codewords(n: int) -> np.ndarray:
    """+1/-1 codes, a row per language: all different splits for up to 6 languages, else the most distant of seeded random codes."""
    if n < 2:
        return np.zeros((n, 0))
    if n <= 6:
        bits = [[1 if m >> i & 1 else -1 for i in range(n)] for m in range(1, 2 ** (n - 1))]
        return np.array(bits, np.float64).T
    rng, best = np.random.Generator(np.random.PCG64(n)), None
    width = int(np.ceil(10 * np.log2(n)))
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (n, width))
        code = code[:, abs(code.sum(0)) < n]
        gap = min(int((code[i] != code[j]).sum()) for i in range(n) for j in range(i))
        if best is None or gap > best[0]:
            best = (gap, code)
    return best[1]


class Model:
    def __init__(self, langs: list[str], counts: np.ndarray):
        self.langs, self.code = langs, codewords(len(langs))
        p = (counts + 0.5) / (counts + 0.5).sum(1, keepdims=True) if len(langs) else counts
        self.weights = np.stack([np.log(p[w > 0].mean(0) / p[w < 0].mean(0)) for w in self.code.T], 1).astype(np.float32) \
            if self.code.shape[1] else np.zeros((BINS, 0), np.float32)
        self.trust = np.full(self.code.shape, 1 / max(1, self.code.shape[1]))

    def margins(self, texts: list[bytes | None]) -> tuple[np.ndarray, np.ndarray]:
        """(margin of each bit, number of n-grams) of each text."""
        f, n = np.zeros((len(texts), self.weights.shape[1])), np.zeros(len(texts), np.int64)
        for a, b, bins, text in grams(texts):
            if not len(text):
                continue
            first = np.flatnonzero(np.diff(text, prepend=-1))
            total = sum(np.add.reduceat(self.weights[bins[:, k]], first, 0, dtype=np.float64) for k in range(3)) \
                if self.weights.shape[1] else np.zeros((len(first), 0))
            f[a + text[first]] = total
            n[a + text[first]] = np.diff(np.append(first, len(text)))
        return f / np.sqrt(np.maximum(n, 1))[:, None], n

    def losses(self, f: np.ndarray) -> np.ndarray:
        """Weighted loss of each language's codeword."""
        each = np.logaddexp(0, -f[:, None, :] * self.code[None])
        return (each * self.trust[None]).sum(2)

    def predict(self, texts: list[bytes | None]):
        f, n = self.margins(texts)
        if not self.langs:
            return ["und"] * len(texts), np.zeros(len(texts)), np.zeros(len(texts), bool)
        loss = self.losses(f) * self.code.shape[1]
        best = loss.argmin(1)
        p = np.exp(loss.min(1, keepdims=True) - loss)
        score = 1 / p.sum(1)
        return ([self.langs[k] if m else "und" for k, m in zip(best, n)], np.where(n > 0, score, 0.0),
                (n > 0) & (score < 0.6) if len(self.langs) > 1 else np.zeros(len(texts), bool))


def fit(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", sample: int = SAMPLE) -> Model:
    """Fit on ``rows`` (their languages non-null), at most ``sample`` documents per language."""
    spark = rows.sparkSession
    rows = rows.where(F.col(lang_col).isNotNull())
    marks = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("l")).withColumn("u", F.shiftrightunsigned(F.xxhash64("id", F.lit("language sample")), 11))
    sizes = marks.groupBy("l").agg(F.count(F.lit(1)).alias("n"))  # a row per language
    # a share of each language that holds ``sample`` rows almost surely, so that no task sorts a whole language
    marks = marks.join(F.broadcast(sizes), "l").where(F.col("u") < F.least(F.lit(1.0), F.lit(1.5 * sample + 200) / F.col("n")) * F.lit(float(2**53)))
    pick = (marks.withColumn("k", F.row_number().over(Window.partitionBy("l").orderBy("u", "id")))
            .where(F.col("k") <= sample).select("id", "l", "k"))
    langs = sorted(r[0] for r in pick.select("l").distinct().collect())
    texts = rows.select(F.col(id_col).alias("id"), F.col(lang_col).alias("l"), F.col(text_col).cast("string").cast("binary").alias("t"))
    chosen = texts.join(F.broadcast(pick.dropDuplicates(["id", "l"])), ["id", "l"]).select("l", "t", "k").repartition(8)
    index = {x: i for i, x in enumerate(langs)}

    def count(batches):
        total = np.zeros(len(langs) * BINS, np.int64)
        for b in batches:
            keep = [i for i, k in enumerate(b.column("k").to_pylist()) if k % 4]
            lang = np.array([index[x] for x in b.column("l").take(pa.array(keep, pa.int64())).to_pylist()], np.int64)
            for a, _, bins, text in grams(b.column("t").take(pa.array(keep, pa.int64())).to_pylist()):
                if len(text):
                    total += np.bincount((lang[a + text, None] * BINS + bins).ravel(), minlength=len(total))
        yield pa.RecordBatch.from_arrays([pa.array([total], pa.list_(pa.int64()))], ["n"])

    # 8 rows of languages x BINS numbers
    counts = sum((np.array(r[0], np.int64) for r in chosen.mapInArrow(count, "n array<long>").collect()), np.zeros(len(langs) * BINS, np.int64))
    model = Model(langs, counts.reshape(len(langs), BINS))
    held = spark.sparkContext.broadcast(model)

    def right(batches):
        m = held.value
        ok, n = np.zeros(m.code.shape), np.zeros(len(langs))
        for b in batches:
            keep = [i for i, k in enumerate(b.column("k").to_pylist()) if k % 4 == 0]
            lang = np.array([index[x] for x in b.column("l").take(pa.array(keep, pa.int64())).to_pylist()], np.int64)
            f, grams_n = m.margins(b.column("t").take(pa.array(keep, pa.int64())).to_pylist())
            for i in np.flatnonzero(grams_n):
                ok[lang[i]] += f[i] * m.code[lang[i]] > 0
                n[lang[i]] += 1
        yield pa.RecordBatch.from_arrays([pa.array([ok.ravel()], pa.list_(pa.float64())), pa.array([n], pa.list_(pa.float64()))], ["ok", "n"])

    if model.code.shape[1]:
        got = chosen.mapInArrow(right, "ok array<double>, n array<double>").collect()
        ok = sum(np.array(r[0]) for r in got).reshape(model.code.shape)
        trust = (ok + 1) / (sum(np.array(r[1]) for r in got)[:, None] + 2)
        model.trust = trust / trust.sum(1, keepdims=True)
    return model


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, lang_pred, score, ambiguous) of every row."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("t"))

    def run(batches):
        for b in batches:
            lang, score, near = held.value.predict(b.column("t").to_pylist())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(near, pa.bool_())],
                                             ["doc_id", "lang_pred", "score", "ambiguous"])
    return src.mapInArrow(run, "doc_id long, lang_pred string, score double, ambiguous boolean")


def held_out(id_col: str, of: int, at: int) -> Column:
    """Whether a row is kept from learning. A row without an id can't be dealt: it is held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == at, F.lit(True))
