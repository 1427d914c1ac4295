"""Bounded labelled samples and calibration, shared by the two classifiers."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def labelled_sample(docs: DataFrame, labels: DataFrame, label_col: str, per_class: int, salt: str, id_col: str = "doc_id",
                    text_col: str = "text") -> tuple[DataFrame, dict[int, int]]:
    """(rows (id, t, y, k), number of labelled documents per class): at most ``per_class`` documents of each label, those of least keyed hash.

    Labels other than 0 and 1 are no labels; of several labels of a document the largest counts.
    """
    marks = (labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(F.max(label_col).cast("int").alias("y")))
    n = {r[0]: r[1] for r in marks.groupBy("y").count().collect()}
    # a share of each class that holds per_class rows almost surely, so that no task sorts a whole class
    share = F.create_map(*(F.lit(x) for c in (0, 1) for x in (c, min(1.0, (1.5 * per_class + 200) / max(1, n.get(c, 0))))))
    marks = marks.withColumn("u", F.shiftrightunsigned(F.xxhash64("id", F.lit(salt)), 11)).where(F.col("u") < share[F.col("y")] * F.lit(float(2**53)))
    order = Window.partitionBy("y").orderBy("u", "id")
    pick = marks.withColumn("k", F.row_number().over(order)).where(F.col("k") <= per_class).drop("u")  # at most 2 * per_class rows
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("t"))
    return texts.join(F.broadcast(pick), "id").repartition(8), n


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Slope and offset of a weighted logistic fit of y on x, slightly held back (Platt's targets)."""
    pos, neg = weight[y == 1].sum(), weight[y == 0].sum()
    target = np.where(y == 1, (pos + 1) / (pos + 2), 1 / (neg + 2))
    a, b = 0.0, float(np.log((pos + 1) / (neg + 1)))

    def loss(a: float, b: float) -> float:
        z = a * x + b
        return float((weight * (np.logaddexp(0, z) - target * z)).sum())

    at = loss(a, b)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -35, 35)))
        g, h = weight * (target - p), weight * np.maximum(p * (1 - p), 1e-9)
        m = np.array([[(h * x * x).sum() + 1e-6, (h * x).sum()], [(h * x).sum(), h.sum() + 1e-6]])
        step = np.linalg.solve(m, [(g * x).sum(), g.sum()])
        # a whole step may pass the optimum, the next one back by more: halved until the loss falls
        while np.abs(step).max() >= 1e-9 and loss(a + step[0], b + step[1]) > at + 1e-13 * abs(at):
            step = step / 2
        if np.abs(step).max() < 1e-9:
            break
        a, b = a + step[0], b + step[1]
        at = loss(a, b)
    return float(a), float(b)
