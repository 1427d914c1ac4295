"""Column-expression builders (route dimension, classification, time)."""

from __future__ import annotations

import functools

_PLAIN = (str, int, float, bool, type(None))


def named_expr(fn):
    """Build a rule's Column once per set of plain arguments (column names, options).

    A Column is a session-free expression tree, so the same object serves every
    query that applies the rule to the same named column; arguments that are
    Columns themselves are built each time.
    """
    memo: dict = {}

    @functools.wraps(fn)
    def wrapper(*args, **kwargs):
        if not all(isinstance(a, _PLAIN) for a in (*args, *kwargs.values())):
            return fn(*args, **kwargs)
        key = (args, tuple(sorted(kwargs.items())))
        col = memo.get(key)
        if col is None:
            col = memo[key] = fn(*args, **kwargs)
        return col
    return wrapper
