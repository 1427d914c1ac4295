"""Mixing sources to target weights by iterative proportional fitting.

Tokens are summed per cell (source, language, topic). Targets give each value of
a dimension its share of the mix; values they don't name form the cell value '(other)',
whose target is what is left of 1. Cells' tokens are scaled to one dimension's targets after
another, none beyond the tokens it has, until the shares stand still. A document is
drawn with its cell's probability, selected tokens over tokens there, by a keyed hash of its
id and text: every copy of a document is drawn alike, on any cluster.

Only cells that occur are kept, at most ``most`` of them (200,000; more raise an error, since they
would grow with the corpus on the driver), so they're fitted in numpy and, within that bound, broadcast;
documents are only summed and joined, and none is shuffled.

Edge cases: a null source, language or topic is the value '(null)'. Null and empty texts have 0
tokens; they're drawn by their cell's probability. Targets that the tokens can't
meet (a value without tokens) are shared out over the other values; a cell is never drawn
beyond probability 1. Repeated rows are drawn together. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OTHER, NULL = "(other)", "(null)"
ROUNDS, TOLERANCE, MOST_CELLS = 200, 1e-9, 200_000


def n_tokens(text: Column) -> Column:
    """How many words ``[^\\x20\\x09-\\x0D]+`` a text has (0 for null)."""
    spaces = F.translate(F.coalesce(text, F.lit("")), "\t\n\u000b\f\r", "     ")
    return F.size(F.filter(F.split(spaces, " ", -1), lambda w: w != "")).cast("long")


def topic_of(text: Column, tokens: Column) -> Column:
    """A coarse topic by form: table (5 bars or more), note (under 100 words), book (2000 or more), article."""
    bars = F.length(F.coalesce(text, F.lit(""))) - F.length(F.replace(F.coalesce(text, F.lit("")), F.lit("|"), F.lit("")))
    return F.when(bars >= 5, "table").when(tokens < 100, "note").when(tokens >= 2000, "book").otherwise("article")


def rake(tokens: np.ndarray, targets: list[np.ndarray], total: float, rounds: int = ROUNDS) -> np.ndarray:
    """``rake_cells`` on an array with one axis per dimension."""
    at = np.nonzero(tokens)
    out = np.zeros(tokens.shape)
    out[at] = rake_cells(list(at), tokens[at], targets, total, rounds)
    return out


def rake_cells(codes: list[np.ndarray], tokens: np.ndarray, targets: list[np.ndarray], total: float, rounds: int = ROUNDS) -> np.ndarray:
    """Tokens to take of each cell that occurs, at most ``tokens``.

    ``codes``: per dimension, each cell's value; ``targets``: per dimension, the share of each value; ``total``: tokens wanted in all.
    """
    have = tokens.astype(float)
    total = min(float(total), have.sum())
    if not total:
        return np.zeros_like(have)
    goals = []
    for code, share in zip(codes, targets):
        there = np.bincount(code, have, len(share))
        share = np.where(there > 0, share, 0.0)
        share = share / share.sum() if share.sum() else there / there.sum()
        goals.append(_within(share * total, there))
    take = have * (total / have.sum())
    for _ in range(rounds):
        before = take.copy()
        for code, goal in zip(codes, goals):
            take = _scaled(take, have, code, goal)
        if np.abs(take - before).max() <= TOLERANCE * total:
            break
    return take


def _within(goal: np.ndarray, limit: np.ndarray) -> np.ndarray:
    """``goal`` cut to ``limit``, what is cut shared out over the rest."""
    goal = goal.copy()
    for _ in range(len(goal)):
        over = goal > limit
        spare = (goal - limit)[over].sum()
        goal[over] = limit[over]
        free = goal < limit
        if spare <= 1e-12 * max(1.0, goal.sum()) or not goal[free].sum():
            break
        goal[free] += spare * goal[free] / goal[free].sum()
    return np.minimum(goal, limit)


def _scaled(take: np.ndarray, have: np.ndarray, code: np.ndarray, goal: np.ndarray) -> np.ndarray:
    """The cells of each value scaled to its goal, no cell beyond what it has."""
    take, full = take.copy(), np.zeros(len(take), bool)
    while True:
        free = np.bincount(code, np.where(full, 0.0, take), len(goal))
        left = np.maximum(0.0, goal - np.bincount(code, np.where(full, have, 0.0), len(goal)))
        factor = np.divide(left, free, out=np.ones(len(goal)), where=free > 0)
        take = np.where(full, take, take * factor[code])
        over = ~full & (take > have)
        if not over.any():
            return take
        take[over] = have[over]
        full |= over


def _value(c: Column, names: list[str]) -> Column:
    text = F.coalesce(c.cast("string"), F.lit(NULL))
    return F.when(text.isin(names), text).otherwise(OTHER)


def _few(rows: list, what: str, most: int) -> list:
    if len(rows) > most:
        raise ValueError(f"over {most} {what}: group rare ones before mixing, or raise the bound")
    return rows


def tempered(docs: DataFrame, tokens: Column, column: Column, power: float, most: int = MOST_CELLS) -> dict[str, float]:
    """Shares in proportion to a power of each value's tokens: below 1, small values gain. At most ``most`` values, else an error."""
    sums = docs.groupBy(F.coalesce(column.cast("string"), F.lit(NULL)).alias("v")).agg(F.sum(tokens).alias("n"))
    rows = _few(sums.limit(most + 1).collect(), "values", most)
    raw = {r["v"]: float(r["n"] or 0) ** power for r in rows if r["n"]}
    return {k: x / sum(raw.values()) for k, x in sorted(raw.items())}


def drawn(docs: DataFrame, dims: dict[str, Column], targets: dict[str, dict[str, float]], share: float, tokens: Column, key: list[Column],
          seed: int = 29, most: int = MOST_CELLS) -> DataFrame:
    """``docs`` with ``__cell`` (its values), ``__weight`` (its cell's share of the mix), ``__probability`` and ``__sampled``.

    ``dims``: a column per dimension of ``targets``; ``key``: what the draw hashes. Other columns stay as they are.
    """
    spark = docs.sparkSession
    names = [sorted(targets[d]) for d in dims]
    cell = F.array(*[_value(c, n) for c, n in zip(dims.values(), names)])
    sums = docs.groupBy(cell.alias("cell")).agg(F.coalesce(F.sum(tokens), F.lit(0)).alias("n"))
    sums = _few(sums.limit(most + 1).collect(), "cells", most)
    index = [{v: k for k, v in enumerate([*n, OTHER])} for n in names]
    codes = [np.array([ix[r["cell"][i]] for r in sums], np.int64) for i, ix in enumerate(index)]
    have = np.array([r["n"] for r in sums], float)
    shares = [np.array([*(targets[d][n] for n in own), max(0.0, 1 - sum(targets[d].values()))]) for d, own in zip(dims, names)]
    take = rake_cells(codes, have, shares, share * have.sum()) if len(have) else have
    chance = np.divide(take, have, out=np.full_like(have, share), where=have > 0)
    rows = [(r["cell"], float(t / max(take.sum(), 1e-300)), float(min(1.0, c))) for r, t, c in zip(sums, take, chance)]
    table = spark.createDataFrame(rows, "__cell array<string>, __weight double, __probability double")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 11) / F.lit(float(2**53))
    return docs.withColumn("__cell", cell).withColumn("__draw", draw).join(F.broadcast(table), "__cell", "left") \
        .withColumn("__sampled", F.col("__draw") < F.col("__probability")).drop("__draw")


def mix(docs: DataFrame, targets: dict[str, dict[str, float]], share: float, seed: int = 29, id_col: str = "doc_id", text_col: str = "text",
        tokens_col: str = "n_tokens", most: int = MOST_CELLS) -> DataFrame:
    """``docs`` (with a column of token counts and one per dimension of ``targets``) and per row
    ``cell`` (its values), ``weight`` (its cell's share of the mix), ``probability`` and ``sampled``.

    ``share``: how much of all tokens the mix is to hold. Columns of ``docs`` with one of these four names are replaced.
    """
    got = drawn(docs, {d: F.col(d) for d in targets}, targets, share, F.col(tokens_col), [F.col(id_col), F.col(text_col)], seed, most)
    new = ["cell", "weight", "probability", "sampled"]
    return got.select(*[c for c in docs.columns if c not in new], *[F.col(f"__{c}").alias(c) for c in new])
