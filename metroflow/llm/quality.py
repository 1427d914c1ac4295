"""Quality classifier: naive Bayes support vectors.

N-grams are taken over words (1 and 2, A-Z lower-cased) and (1 to 3) over the forms of words:
letters, capitals, digits and marks, runs of the first three written once, with a sign where a
word equals the one before. A feature is an indicator: the n-gram occurs, or, for forms,
takes at least 1/64, 1/16 or 1/4 of the text's words. Indicators are scaled by their class
log-count ratio, and a linear hinge-loss model is fitted on them by dual coordinate descent. Its margin becomes
a probability by a logistic fit on rows that the model didn't see, weighted to the
labelled classes' true sizes.

Fitted on at most ``per_class`` labelled documents of each class, those of least keyed
hash. Spark counts the documents of each indicator first; those of fewer than ``MIN_DOCS``
documents are no features, so what is fitted on the driver is bounded by the sample and by
the features, of ``BINS`` at most, not by the length of texts. Scoring is a map over whole texts.

Edge cases: null, empty and wordless texts have no feature and get the score of the bias
alone. Without labels of both classes every score is the share of label 1 (0.5 without any).
Repeated rows are scored each; only the named columns are read; an empty table gives an
empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from metroflow.llm.labelled import labelled_sample, logistic
from metroflow.llm.words import U, Words, chunks, fold, mix

BITS = 20
BINS = 1 << BITS
PER_CLASS, MIN_DOCS = 5000, 3
LEVELS = (0.0, 1 / 64, 1 / 16, 1 / 4)
_FORM = np.array([65 if 65 <= i <= 90 else 48 if 48 <= i <= 57 else 97 if i >= 128 or 97 <= i <= 122 else i for i in range(256)], np.uint8)


class _Forms(Words):
    """Words with each run of small letters, capitals or digits written as one sign."""

    def __init__(self, data: np.ndarray):
        form = _FORM[data]
        same = np.concatenate(([False], form[1:] == form[:-1])) & np.isin(form, (65, 48, 97))
        super().__init__([form[~same].tobytes()])


def features(texts: list[bytes | None]) -> list[np.ndarray]:
    """Each text's indicators, ascending bins."""
    out = []
    for a, b in chunks(texts):
        w = Words(texts[a:b], lower=True)
        h = w.hashes()
        raw = np.frombuffer(b"\n".join([t or b"" for t in texts[a:b]]) + b"\n", np.uint8)
        form = _Forms(raw).hashes()
        again = np.concatenate(([False], h[1:] == h[:-1])) if len(h) else np.zeros(0, bool)
        form = np.where(again, mix(form ^ U(0x7265706561746564)), form)
        grams = [fold(form ^ U(n), n) for n in (1, 2, 3)]
        plain = [fold(h ^ U(0x776F726400 + n), n) for n in (1, 2)]
        for lo, hi in zip(w.offsets[:-1].tolist(), w.offsets[1:].tolist()):
            if lo == hi:
                out.append(np.empty(0, np.int32))
                continue
            own = np.concatenate([g[lo:max(lo, hi - n)] for n, g in enumerate(grams)])
            kind, count = np.unique(own, return_counts=True)
            each = [kind[count >= level * (hi - lo)] + U(k * 0x9E3779B9) for k, level in enumerate(LEVELS)]
            each += [g[lo:max(lo, hi - n)] for n, g in enumerate(plain)]
            out.append(np.unique((mix(np.concatenate(each)) >> U(64 - BITS)).astype(np.int32)))
    return out


def dual_descent(rows: list[np.ndarray], scale: np.ndarray, y: np.ndarray, cost: np.ndarray, epochs: int = 12, seed: int = 3) -> tuple[np.ndarray, float]:
    """Weights and bias of the L2-regularised hinge loss; a row's features are ``scale`` at its indices, and 1 for the bias."""
    w, bias = np.zeros(len(scale)), 0.0
    alpha, size = np.zeros(len(rows)), np.array([(scale[r] ** 2).sum() + 1 for r in rows])
    rng = np.random.Generator(np.random.PCG64(seed))
    values = [scale[r] for r in rows]
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            g = y[i] * (values[i] @ w[rows[i]] + bias) - 1
            new = min(max(alpha[i] - g / size[i], 0.0), cost[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[rows[i]] += step * values[i]
                bias += step
    return w * scale, bias


class Model:
    def __init__(self, weights: np.ndarray, bias: float, slope: float, offset: float):
        self.weights, self.bias, self.slope, self.offset = weights.astype(np.float32), bias, slope, offset

    def margins(self, rows: list[np.ndarray]) -> np.ndarray:
        n = np.array([len(r) for r in rows])
        out = np.full(len(rows), self.bias)
        if n.sum():
            v = self.weights[np.concatenate(rows)].astype(np.float64)
            np.add.at(out, np.repeat(np.arange(len(rows)), n), v)
        return out

    def scores(self, rows: list[np.ndarray]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * self.margins(rows) + self.offset, -35, 35)))


def fit(docs: DataFrame, labels: DataFrame, label_col: str = "quality", per_class: int = PER_CLASS, id_col: str = "doc_id", text_col: str = "text") -> Model:
    rows, n = labelled_sample(docs, labels, label_col, per_class, "quality sample", id_col, text_col)

    def count(batches):
        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column("t").to_pylist()
            for i, j in chunks(texts):
                bins, n = np.unique(np.concatenate(features(texts[i:j])), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(bins), pa.array(n.astype(np.int64))], ["bin", "n"])

    rows = rows.persist()  # the bounded sample
    often = rows.mapInArrow(count, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).where(F.col("n") >= MIN_DOCS).select("bin").toArrow()
    known = np.zeros(BINS, bool)  # at most BINS rows came here
    known[often.column("bin").to_numpy()] = True
    held_known = docs.sparkSession.sparkContext.broadcast(np.packbits(known))

    def run(batches):
        is_known = np.unpackbits(held_known.value, count=BINS).astype(bool)
        for b in batches:
            texts = b.column("t").to_pylist()
            x = [v[is_known[v]] for i, j in chunks(texts) for v in features(texts[i:j])]
            at = np.concatenate(([0], np.cumsum([len(v) for v in x]))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(at), pa.array(np.concatenate(x) if x else np.empty(0, np.int32), pa.int32()))
            yield pa.RecordBatch.from_arrays([b.column("y"), b.column("k"), lists], ["y", "k", "x"])

    got = rows.mapInArrow(run, "y int, k int, x array<int>").toArrow()  # at most 2 * per_class rows of known indicators
    rows.unpersist()
    y, k, lists = got.column("y").to_numpy(), got.column("k").to_numpy(), got.column("x").combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    flat, ends = lists.flatten().to_numpy().astype(np.int64), lists.offsets.to_numpy()[1:] - lists.offsets.to_numpy()[0] if len(lists) else np.zeros(0, np.int64)
    x = np.split(flat, ends[:-1]) if len(lists) else []
    order = np.lexsort((k, y))
    y, k, x = y[order], k[order], [x[i] for i in order]
    if len(set(y.tolist())) < 2:
        total = sum(n.values())
        share = n.get(1, 0) / total if total else 0.5
        return Model(np.zeros(BINS), 0.0, 0.0, float(np.log(max(share, 1e-9) / max(1 - share, 1e-9))))
    held = k % 4 == 0

    def trained(use):
        count = np.ones((2, BINS))
        for r, c in zip([x[i] for i in use], y[use]):
            count[c, r] += 1
        share = count / np.array([[(y[use] == 0).sum() + 2], [(y[use] == 1).sum() + 2]])
        sizes = np.array([(y[use] == 0).sum(), (y[use] == 1).sum()])
        cost = (len(use) / (2 * sizes))[y[use]]
        return dual_descent([x[i] for i in use], np.log(share[1] / share[0]), np.where(y[use] == 1, 1.0, -1.0), cost)

    weight = np.array([n[c] / (y[held] == c).sum() if (y[held] == c).any() else 1.0 for c in (0, 1)])
    seen = np.flatnonzero(~held)
    if len(set(y[held].tolist())) < 2 or len(set(y[seen].tolist())) < 2:
        held, seen, weight = np.ones(len(y), bool), np.arange(len(y)), np.array([1.0, 1.0])
    w, bias = trained(seen)
    margins = Model(w, bias, 1, 0).margins([x[i] for i in np.flatnonzero(held)])
    slope, offset = logistic(margins, y[held], weight[y[held]])
    return Model(w, bias, slope, offset)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", keep: list[str] | None = None,
          name: str = "score") -> DataFrame:
    """(doc_id, score) of every row; ``keep`` names columns to carry along instead of doc_id, ``name`` the score among them."""
    if keep and name in keep:
        raise ValueError(f"the score needs a name of its own, not {name!r}")
    held = docs.sparkSession.sparkContext.broadcast(model)
    cols = [F.col(c) for c in keep] if keep else [F.col(id_col).cast("long").alias("doc_id")]
    src = docs.select(*cols, F.col(text_col).cast("string").cast("binary").alias("__t"))
    schema = src.drop("__t").withColumn(name, F.lit(0.0)).schema

    def run(batches):
        for b in batches:
            if not b.num_rows:
                continue
            texts = b.column("__t").to_pylist()
            s = np.concatenate([held.value.scores(features(texts[i:j])) for i, j in chunks(texts)])  # a few megabytes of text at a time
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(s)], [*b.schema.names[:-1], name])
    return src.mapInArrow(run, schema)
