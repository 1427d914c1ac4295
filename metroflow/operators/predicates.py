"""Filters (F1-F19). Every builder returns a Column; ``where_all`` ANDs the
optional ones, so unset parameters add nothing to the plan and set ones push
down to the scan where the column is a stored one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from metroflow.functions import routes as RD


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def where_all(df: DataFrame, *preds: Column | None) -> DataFrame:
    """AND of the given predicates; ``None`` means 'no filter'."""
    ps = [p for p in preds if p is not None]
    return df.filter(reduce(lambda a, b: a & b, ps)) if ps else df


def route_is(route: str | None, col: str = "route_id") -> Column | None:
    """route equality."""
    return None if not route else (F.col(col) == F.lit(route))


def route_type_is(route_type: str | None, col: str = "route_id", mode: str = "dim") -> Column | None:
    """subway, bus, xbus, simbus.

    ``mode='dim'`` uses the route dimension; ``mode='reference'`` reproduces
    the API (subway IN-list with 8 and 9, bus regex that also takes B, M, Q, S).
    """
    if not route_type:
        return None
    t = route_type.lower()
    r = F.col(col)
    if mode == "reference":
        if t == "subway":
            return r.isin(*RD.REFERENCE_SUBWAY_LIST)
        if t == "bus":
            return r.rlike(RD.REFERENCE_BUS_REGEX)
        return None  # the API ignores other values
    kinds = {"subway": ["subway"], "railway": ["railway"], "bus": ["bus"],
             "xbus": ["express"], "simbus": ["simexpress"]}
    if t not in kinds:
        raise ValueError(f"unknown route_type {route_type!r}")
    return RD.route_kind(r).isin(*kinds[t])


def page_bus_filter(family: str, col: str = "route_id") -> Column:
    """the vehicle page's client-side filters for BUS, EXPRESS and SIMEXPRESS."""
    r = F.col(col)
    longer = F.length(r) > 1
    if family == "BUS":
        return ((r.startswith("M") & longer) | (r.startswith("B") & longer)
                | r.startswith("Bx") | (r.startswith("Q") & longer))
    if family == "EXPRESS":
        return r.startswith("X")
    if family == "SIMEXPRESS":
        return r.startswith("SIM")
    raise ValueError(family)


def family_is(family: str | None, col: str = "route_id") -> Column | None:
    """F16: line family (IRT, IND, BMT, S, SIR, BUS, EXPRESS, SIMEXPRESS)."""
    return None if not family else (RD.route_family(F.col(col)) == F.lit(family))


def route_in_array(route: str | None, col: str = "routes") -> Column | None:
    """the alert names the route."""
    return None if not route else F.array_contains(F.col(col), F.lit(route))


def equals_ignore_case(value: str | None, col: Column | str) -> Column | None:
    """severity equality, upper-cased both sides."""
    return None if not value else (F.upper(_c(col)) == F.lit(value.upper()))


def text_contains(text: str | None, *cols: Column | str, regex: bool = False) -> Column | None:
    """case-insensitive substring on any of the columns (null-safe).

    Literal by default; ``regex=True`` treats ``text`` as a pattern, as the
    API does with its unescaped input.
    """
    if not text:
        return None
    if regex:
        pat = "(?i)" + text
        conds = [F.coalesce(_c(c).rlike(pat), F.lit(False)) for c in cols]
    else:
        needle = F.lit(text.lower())
        conds = [F.coalesce(F.lower(_c(c)).contains(needle), F.lit(False)) for c in cols]
    return reduce(lambda a, b: a | b, conds)


def is_value(value, col: str) -> Column | None:
    """Optional equality (tri-state: None means no filter)."""
    return None if value is None else (F.col(col) == F.lit(value))


def outage_type_is(kind: str | None, col: str = "is_current") -> Column | None:
    """F8: 'current' or 'upcoming'."""
    if kind is None:
        return None
    if kind not in ("current", "upcoming"):
        raise ValueError(f"unknown outage type {kind!r}")
    return F.col(col) == F.lit(kind == "current")


def is_current(col: str = "is_current") -> Column:
    """current outages (null counts as not current)."""
    return F.coalesce(F.col(col), F.lit(False))


def cutoff(as_of, hours: float) -> Column:
    """as_of - hours (a constant Catalyst folds, so predicates on it reach the scan)."""
    return F.lit(as_of).cast("timestamp_ntz") - F.expr(f"INTERVAL {int(hours * 3600)} SECONDS")


def since(as_of, hours: float, col: str = "window_start") -> Column:
    """col >= as_of - hours."""
    return F.col(col) >= cutoff(as_of, hours)


def usable_position(lat: str = "latitude", lon: str = "longitude") -> Column:
    """position present and not zero."""
    return (F.col(lat).isNotNull() & F.col(lon).isNotNull()
            & (F.col(lat) != 0) & (F.col(lon) != 0))


def in_box(lat_lo: float, lat_hi: float, lon_lo: float, lon_hi: float,
           lat: str = "latitude", lon: str = "longitude") -> Column:
    """location box."""
    return F.col(lat).between(lat_lo, lat_hi) & F.col(lon).between(lon_lo, lon_hi)


def has_field(col: str) -> Column:
    """keep entities that hold the field."""
    return F.col(col).isNotNull()
