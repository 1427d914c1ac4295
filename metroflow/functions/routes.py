"""Route dimension: colour, family, kind, label and coordinate box of a route.

Everything here is a Column expression over a route-code column, so it stays
inside whole-stage codegen and needs no join: the dimension is a fixed,
bounded set of codes plus prefix rules, which Catalyst folds into a CASE /
map lookup. ``routes_dim`` exposes the same facts as a small DataFrame for
callers that want a join (its size is fixed by the constants below).
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from metroflow.functions import named_expr

# ---------------------------------------------------------------------------
# Fixed values (must equal the dashboard's and the API's for equal results).
# ---------------------------------------------------------------------------

# Subway colours, one entry per route code, as the API serves them
# (its Staten Island code is "SI").
API_COLORS = [
    ("1", "#EE352E"), ("2", "#EE352E"), ("3", "#EE352E"),
    ("4", "#00933C"), ("5", "#00933C"), ("6", "#00933C"),
    ("7", "#B933AD"),
    ("A", "#0039A6"), ("C", "#0039A6"), ("E", "#0039A6"),
    ("B", "#FF6319"), ("D", "#FF6319"), ("F", "#FF6319"), ("M", "#FF6319"),
    ("G", "#6CBE45"),
    ("J", "#996633"), ("Z", "#996633"),
    ("L", "#A7A9AC"),
    ("N", "#FCCC0A"), ("Q", "#FCCC0A"), ("R", "#FCCC0A"), ("W", "#FCCC0A"),
    ("S", "#808183"),
    ("SI", "#0039A6"),
]

# The dashboard's colour literal, entries in the order they are written.
# Keys repeat (M, B, Q): like a JS object literal, the later entry wins.
UI_COLOR_ENTRIES = [
    ("1", "#EE352E"), ("2", "#EE352E"), ("3", "#EE352E"),
    ("4", "#00933C"), ("5", "#00933C"), ("6", "#00933C"),
    ("7", "#B933AD"),
    ("A", "#0039A6"), ("C", "#0039A6"), ("E", "#0039A6"),
    ("B", "#FF6319"), ("D", "#FF6319"), ("F", "#FF6319"), ("M", "#FF6319"),
    ("G", "#6CBE45"),
    ("J", "#996633"), ("Z", "#996633"),
    ("L", "#A7A9AC"),
    ("N", "#FCCC0A"), ("Q", "#FCCC0A"), ("R", "#FCCC0A"), ("W", "#FCCC0A"),
    ("S", "#808183"),
    ("SIR", "#0039A6"),
    ("M", "#4D92FB"),
    ("B", "#F2C75C"),
    ("Bx", "#00AF87"),
    ("Q", "#9467BD"),
    ("X", "#E60000"),
    ("SIM", "#FF9900"),
]

# Bus prefixes and their colours (Manhattan, Brooklyn, Bronx, Queens,
# express, Staten Island express).
BUS_PREFIX_COLORS = [
    ("M", "#4D92FB"), ("B", "#F2C75C"), ("Bx", "#00AF87"),
    ("Q", "#9467BD"), ("X", "#E60000"), ("SIM", "#FF9900"),
]

# Line families of the vehicle page.
FAMILIES = [
    ("IRT", ["1", "2", "3", "4", "5", "6", "7"]),
    ("IND", ["A", "C", "E", "B", "D", "F", "M"]),
    ("BMT", ["L", "N", "Q", "R", "W", "J", "Z"]),
    ("S", ["S"]),
    ("SIR", ["SIR"]),
]

# Coordinate boxes (lat_lo, lat_hi, lon_lo, lon_hi) used to impute a missing
# position, in the order the producer tests them; DEFAULT_BOX otherwise.
ROUTE_BOXES = [
    (["1", "2", "3"], 40.70, 40.85, -74.01, -73.96),
    (["4", "5", "6"], 40.70, 40.85, -73.98, -73.92),
    (["N", "Q", "R", "W"], 40.72, 40.76, -73.99, -73.96),
    (["B", "D", "F", "M"], 40.72, 40.78, -73.99, -73.95),
    (["G"], 40.68, 40.74, -73.95, -73.93),
    (["L"], 40.71, 40.74, -74.01, -73.92),
    (["J", "Z"], 40.67, 40.73, -73.99, -73.88),
    (["7"], 40.74, 40.75, -74.0, -73.84),
    (["A", "C", "E"], 40.70, 40.85, -74.01, -73.97),
]
DEFAULT_BOX = (40.70, 40.88, -74.02, -73.91)

# The API's subway route list (it has 8 and 9 and lacks B, D, F) and its
# bus pattern.
REFERENCE_SUBWAY_LIST = list("123456789ACEGJLMNQRSWZ")
REFERENCE_BUS_REGEX = "^[BMQSBx]"

# Colour defaults: unknown route, unknown chart bar.
NO_COLOR = "#000000"
CHART_DEFAULT_COLOR = "#007AFF"

# ---------------------------------------------------------------------------

SUBWAY_CODES = [code for code, _ in API_COLORS if code != "SI"]
UI_COLORS = dict(UI_COLOR_ENTRIES)  # later entry wins, as in the UI


def _c(route: Column | str) -> Column:
    return F.col(route) if isinstance(route, str) else route


def _lit_map(pairs) -> Column:
    return F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in pairs))


def _lookup(pairs, key: Column) -> Column:
    return F.try_element_at(_lit_map(pairs), key)


@named_expr
def bus_prefix(route: Column | str) -> Column:
    """Longest bus prefix (SIM, Bx, M, B, Q, X) that is followed by a digit, else null."""
    r = _c(route)
    out = F.lit(None).cast("string")
    # Build from the shortest so the longest prefix is tested first.
    for p in ["X", "Q", "B", "M", "Bx", "SIM"]:
        out = F.when(r.rlike(f"^{p}[0-9]"), F.lit(p)).otherwise(out)
    return out


@named_expr
def route_kind(route: Column | str) -> Column:
    """subway, railway, bus, express, simexpress or other (canonical dimension)."""
    r = _c(route)
    p = bus_prefix(r)
    return (
        F.when(r.isin(*SUBWAY_CODES), F.lit("subway"))
        .when(r.isin("SIR", "SI"), F.lit("railway"))
        .when(p == "SIM", F.lit("simexpress"))
        .when(p == "X", F.lit("express"))
        .when(p.isNotNull(), F.lit("bus"))
        .otherwise(F.lit("other"))
    )


@named_expr
def route_family(route: Column | str) -> Column:
    """IRT, IND, BMT, S, SIR, BUS, EXPRESS, SIMEXPRESS or null."""
    r = _c(route)
    p = bus_prefix(r)
    fam_pairs = [(code, fam) for fam, codes in FAMILIES for code in codes]
    return (
        F.when(r == "SI", F.lit("SIR"))
        .when(p == "SIM", F.lit("SIMEXPRESS"))
        .when(p == "X", F.lit("EXPRESS"))
        .when(p.isNotNull(), F.lit("BUS"))
        .otherwise(_lookup(fam_pairs, r))
    )


@named_expr
def route_color(route: Column | str, variant: str = "dim") -> Column:
    """Colour of a route.

    ``dim``          exact code, then the longest bus prefix followed by a digit, else #000000
    ``ui``           dashboard ladder: exact (later literal wins), prefix tests, first character, #000000
    ``alerts_page``  as ``ui`` without the first-character step
    ``chart``        as ``ui`` with default #007AFF
    ``api``          the API's map, exact code only, else #000000
    """
    r = _c(route)
    if variant == "dim":
        exact = _lookup(API_COLORS + [("SIR", "#0039A6")], r)
        bus = _lookup(BUS_PREFIX_COLORS, bus_prefix(r))
        return F.when(r.isNull(), F.lit(NO_COLOR)).otherwise(F.coalesce(exact, bus, F.lit(NO_COLOR)))
    if variant == "api":
        return F.coalesce(_lookup(API_COLORS, r), F.lit(NO_COLOR))
    if variant not in ("ui", "alerts_page", "chart"):
        raise ValueError(f"unknown colour variant {variant!r}")
    pairs = list(UI_COLORS.items())
    longer = F.length(r) > 1
    ladder = (
        F.when(_lookup(pairs, r).isNotNull(), _lookup(pairs, r))
        .when(r.startswith("M") & longer, F.lit(UI_COLORS["M"]))
        .when(r.startswith("B") & longer, F.lit(UI_COLORS["B"]))
        .when(r.startswith("Bx"), F.lit(UI_COLORS["Bx"]))
        .when(r.startswith("Q") & longer, F.lit(UI_COLORS["Q"]))
        .when(r.startswith("X"), F.lit(UI_COLORS["X"]))
        .when(r.startswith("SIM"), F.lit(UI_COLORS["SIM"]))
    )
    if variant != "alerts_page":
        ladder = ladder.when(_lookup(pairs, F.substring(r, 1, 1)).isNotNull(), _lookup(pairs, F.substring(r, 1, 1)))
    default = CHART_DEFAULT_COLOR if variant == "chart" else NO_COLOR
    empty = r.isNull() | (r == "") if variant != "chart" else F.lit(False)
    return F.when(empty, F.lit(NO_COLOR)).otherwise(ladder.otherwise(F.lit(default)))


@named_expr
def route_colors(routes: str, variant: str = "ui") -> Column:
    """J1 over an array of routes: ``route:colour`` pairs joined by commas, in array order."""
    pairs = F.transform(routes, lambda r: F.concat(r, F.lit(":"), route_color(r, variant)))
    return F.array_join(pairs, ",")


@named_expr
def page_route_type(route: Column | str) -> Column:
    """Alert page route type: railway, bus-<borough>, bus-express, bus-staten-island-express, subway."""
    r = _c(route)
    longer = F.length(r) > 1
    return (
        F.when(r.isNull() | (r == ""), F.lit("subway"))
        .when(r == "SIR", F.lit("railway"))
        .when(r.startswith("M") & longer, F.lit("bus-manhattan"))
        .when(r.startswith("B") & longer, F.lit("bus-brooklyn"))
        .when(r.startswith("Bx"), F.lit("bus-bronx"))
        .when(r.startswith("Q") & longer, F.lit("bus-queens"))
        .when(r.startswith("X"), F.lit("bus-express"))
        .when(r.startswith("SIM"), F.lit("bus-staten-island-express"))
        .otherwise(F.lit("subway"))
    )


@named_expr
def page_route_label(route: Column | str) -> Column:
    """Menu label of a route on the alert page."""
    r = _c(route)
    t = page_route_type(r)
    return (
        F.when(t == "railway", F.lit("Staten Island Railway"))
        .when(t.startswith("bus-") & ~t.isin("bus-express", "bus-staten-island-express"), F.concat(F.lit("Bus "), r))
        .when(t == "bus-express", F.concat(F.lit("Express Bus "), r))
        .when(t == "bus-staten-island-express", F.concat(F.lit("Staten Island Express "), r))
        .otherwise(F.concat(F.lit("Line "), F.coalesce(r, F.lit(""))))
    )


@named_expr
def is_bus_route(route: Column | str) -> Column:
    """Vehicle page bus test (true for local, express and SIM buses)."""
    r = _c(route)
    longer = F.length(r) > 1
    return F.coalesce(
        (r.startswith("M") & longer) | (r.startswith("B") & longer) | r.startswith("Bx")
        | (r.startswith("Q") & longer) | r.startswith("X") | r.startswith("SIM"),
        F.lit(False),
    )


@named_expr
def route_box(route: Column | str) -> Column:
    """struct(lat_lo, lat_hi, lon_lo, lon_hi) of a route, first matching box, else the default."""
    r = _c(route)

    def box(lat_lo, lat_hi, lon_lo, lon_hi):
        return F.struct(F.lit(lat_lo).alias("lat_lo"), F.lit(lat_hi).alias("lat_hi"),
                        F.lit(lon_lo).alias("lon_lo"), F.lit(lon_hi).alias("lon_hi"))

    expr = None
    for codes, *b in ROUTE_BOXES:
        cond = r.isin(*codes)
        expr = F.when(cond, box(*b)) if expr is None else expr.when(cond, box(*b))
    return expr.otherwise(box(*DEFAULT_BOX))


def routes_dim(spark: SparkSession, codes: list[str] | None = None) -> DataFrame:
    """The route dimension as a DataFrame (fixed size: one row per code).

    Columns: route_id, kind, family, color, api_color, ui_color, lat_lo, lat_hi, lon_lo, lon_hi.
    """
    codes = codes or (SUBWAY_CODES + ["SIR"])
    base = spark.createDataFrame([(c,) for c in codes], "route_id string")
    b = route_box("route_id")
    return base.select(
        "route_id",
        route_kind("route_id").alias("kind"),
        route_family("route_id").alias("family"),
        route_color("route_id").alias("color"),
        route_color("route_id", "api").alias("api_color"),
        route_color("route_id", "ui").alias("ui_color"),
        b["lat_lo"].alias("lat_lo"), b["lat_hi"].alias("lat_hi"),
        b["lon_lo"].alias("lon_lo"), b["lon_hi"].alias("lon_hi"),
    )
