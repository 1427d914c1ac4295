"""Z-order cells of positions (F17): one number per position, near in number mostly where near in place.

Latitude and longitude are cut into 2**16 steps each and their bits
interleaved, so a cell is a 32-bit number and every quarter of a quarter ... of
the map is one range of numbers. A table sorted by cell holds narrow ranges per
row group; a box is turned into ranges, which Spark pushes to the scan. The
ranges cover the box and a little more, so the box itself is checked after them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 16
# The map: latitude and longitude from, to.
MAP = (-90.0, 90.0, -180.0, 180.0)


def _step(x: Column, lo: float, hi: float) -> Column:
    """The step of a coordinate; what lies outside the map is in the step at its edge."""
    at = F.floor((x - F.lit(lo)) / F.lit(hi - lo) * F.lit(float(1 << BITS)))
    return F.greatest(F.lit(0).cast("long"), F.least(F.lit((1 << BITS) - 1).cast("long"), at))


def _spread(x: Column) -> Column:
    """The bits of a 16-bit number with a zero between each two."""
    for shift, mask in ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555)):
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def cell(lat: str, lon: str) -> Column:
    """The cell of a position, null where a coordinate is null or NaN."""
    a, b = F.col(lat), F.col(lon)
    z = F.shiftleft(_spread(_step(a, *MAP[:2])), 1).bitwiseOR(_spread(_step(b, *MAP[2:])))
    return F.when(a.isNotNull() & b.isNotNull() & ~F.isnan(a) & ~F.isnan(b), z)


def _int_step(x: float, lo: float, hi: float) -> int:
    return max(0, min((1 << BITS) - 1, int((x - lo) / (hi - lo) * (1 << BITS) // 1)))


def box_ranges(lat_lo: float, lat_hi: float, lon_lo: float, lon_hi: float, most: int = 32) -> list[tuple[int, int]]:
    """At most ``most`` ranges of cells (both ends included) that cover the box.

    Squares of the map are quartered, the largest first, as long as they
    stick out of the box and the ranges stay within bounds; squares next to each
    other in number are one range.
    """
    if lat_lo > lat_hi or lon_lo > lon_hi:
        return []
    y0, y1 = (_int_step(x, *MAP[:2]) for x in (lat_lo, lat_hi))
    x0, x1 = (_int_step(x, *MAP[2:]) for x in (lon_lo, lon_hi))
    squares, whole = [(0, 0, BITS, 0)], []  # (row, column, bits of the side, first cell)
    while squares:
        nxt = []
        for y, x, bits, first in squares:
            side = (1 << bits) - 1
            if y > y1 or y + side < y0 or x > x1 or x + side < x0:
                continue
            if bits == 0 or (y0 <= y and y + side <= y1 and x0 <= x and x + side <= x1):
                whole.append((first, first + (1 << 2 * bits) - 1))
                continue
            half, quarter = 1 << (bits - 1), 1 << 2 * (bits - 1)
            nxt += [(y + half * (k >> 1), x + half * (k & 1), bits - 1, first + k * quarter) for k in range(4)]
        nxt = [s for s in nxt if not (s[0] > y1 or s[0] + (1 << s[2]) - 1 < y0 or s[1] > x1 or s[1] + (1 << s[2]) - 1 < x0)]
        if len(_joined(whole + [(f, f + (1 << 2 * b) - 1) for _, _, b, f in nxt])) > most:
            whole += [(f, f + (1 << 2 * b) - 1) for _, _, b, f in squares
                      if (f, f + (1 << 2 * b) - 1) not in whole]  # the coarser cover is enough
            break
        squares = nxt
    return _joined(whole)


def _joined(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def in_cells(col: str, lat_lo: float, lat_hi: float, lon_lo: float, lon_hi: float, most: int = 32) -> Column:
    """Whether a cell lies in the ranges of a box (a superset of the box)."""
    ranges = [F.col(col).between(a, b) for a, b in box_ranges(lat_lo, lat_hi, lon_lo, lon_hi, most)]
    return reduce(or_, ranges, F.lit(False)) if ranges else F.lit(False)
