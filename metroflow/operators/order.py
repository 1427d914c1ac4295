"""Sort, limit, top-k and paging.

Every limited result is ordered by a total order (the user's columns, then
the key), so limits are reproducible. ``orderBy(...).limit(n)`` plans as
TakeOrderedAndProject: each task keeps its own top n, nothing else moves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DEFAULT_LIMIT = 100
MAX_LIMIT = 1000


def check_limit(limit: int | None, default: int = DEFAULT_LIMIT, maximum: int = MAX_LIMIT) -> int:
    """O3: 1..maximum, default when None."""
    n = default if limit is None else int(limit)
    if not 1 <= n <= maximum:
        raise ValueError(f"limit must be between 1 and {maximum}, got {limit}")
    return n


def sort_key(col: str, ascending: bool = True) -> Column:
    """Nulls last in both directions."""
    return F.col(col).asc_nulls_last() if ascending else F.col(col).desc_nulls_last()


def ordered(df: DataFrame, by: list[Column | str], key: list[str]) -> DataFrame:
    """O1: ordered by ``by`` then by the key (total order)."""
    return df.orderBy(*by, *[F.col(k).asc() for k in key])


def top(df: DataFrame, n: int, by: list[Column | str], key: list[str]) -> DataFrame:
    """First n rows of a total order."""
    return ordered(df, by, key).limit(n)


def page(df: DataFrame, page_no: int, page_size: int, by: list[Column | str], key: list[str]) -> DataFrame:
    """Page ``page_no`` (0-based) of ``page_size`` rows."""
    if page_no < 0 or page_size < 1:
        raise ValueError("page_no >= 0 and page_size >= 1")
    return ordered(df, by, key).offset(page_no * page_size).limit(page_size)


def page_after(df: DataFrame, page_size: int, by: list[str], key: list[str], after: tuple | None) -> DataFrame:
    """Key-set paging for deep pages: rows strictly after ``after`` in (by..., key...) ascending order."""
    cols = list(by) + list(key)
    out = df
    if after is not None:
        cond = None
        for i in range(len(cols)):
            eq = [F.col(c) == F.lit(v) for c, v in zip(cols[:i], after[:i])]
            gt = F.col(cols[i]) > F.lit(after[i])
            term = gt
            for e in eq:
                term = term & e
            cond = term if cond is None else cond | term
        out = df.filter(cond)
    return out.orderBy(*cols).limit(page_size)
