"""Geometry as native Column expressions (PRJ4, PRJ5, FN20).

``in_polygon`` is the ray-casting test of the reference re-expressed without a
Python UDF: for a literal polygon every edge is unrolled into its own CASE at
plan-build time (so codegen sees constants), for a polygon held in a column
the same per-edge rule runs through ``aggregate`` over the vertex array.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6378137.0


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _edges(polygon: Sequence[Sequence[float]]):
    """Consecutive vertices, the last joined to the first."""
    yield from zip(polygon, [*polygon[1:], polygon[0]])


def bounding_box(polygon: Sequence[Sequence[float]]):
    xs = [float(p[0]) for p in polygon]
    ys = [float(p[1]) for p in polygon]
    return min(xs), min(ys), max(xs), max(ys)


def _edge_crossing(x: Column, y: Column, p1, p2) -> Column | None:
    """1 when the horizontal ray from (x, y) toggles on edge p1-p2, else 0.

    Rule (fixed by the reference): the edge counts when
    min(y1, y2) < y <= max(y1, y2), x <= max(x1, x2), and either the edge is
    vertical or x <= the edge's x at height y.  Horizontal edges never count
    and are dropped here.
    """
    x1, y1 = float(p1[0]), float(p1[1])
    x2, y2 = float(p2[0]), float(p2[1])
    if y1 == y2:
        return None
    cond = (y > F.lit(min(y1, y2))) & (y <= F.lit(max(y1, y2))) & (x <= F.lit(max(x1, x2)))
    if x1 != x2:
        # same operation order as the reference: (y - y1) * (x2 - x1) / (y2 - y1) + x1
        x_int = (y - F.lit(y1)) * F.lit(x2 - x1) / F.lit(y2 - y1) + F.lit(x1)
        cond = cond & (x <= x_int)
    return F.when(cond, F.lit(1)).otherwise(F.lit(0))


def in_polygon(x, y, polygon) -> Column:
    """Point-in-polygon test as a boolean Column; NULL coordinates are outside.

    ``polygon`` is either a Python sequence of ``[x, y]`` vertices (unrolled
    into constant edge tests behind a bounding-box guard) or a Column of type
    ``array<array<double>>`` (evaluated with higher-order functions).
    """
    x, y = _as_col(x).cast("double"), _as_col(y).cast("double")
    if isinstance(polygon, Column):
        return _in_polygon_column(x, y, polygon)
    terms = [t for t in (_edge_crossing(x, y, p1, p2) for p1, p2 in _edges(polygon)) if t is not None]
    if not terms:
        return F.lit(False)
    crossings = terms[0]
    for t in terms[1:]:
        crossings = crossings + t
    minx, miny, maxx, maxy = bounding_box(polygon)
    # cheap guard first: a point outside the box can never be inside
    guard = (x >= F.lit(minx)) & (x <= F.lit(maxx)) & (y > F.lit(miny)) & (y <= F.lit(maxy))
    return F.coalesce(guard & ((crossings % 2) == 1), F.lit(False))


def _in_polygon_column(x: Column, y: Column, polygon: Column) -> Column:
    n = F.size(polygon)

    def crossing(acc, i):
        p1 = F.element_at(polygon, i + 1)
        p2 = F.element_at(polygon, F.pmod(i + 1, n) + 1)
        x1, y1 = F.element_at(p1, 1), F.element_at(p1, 2)
        x2, y2 = F.element_at(p2, 1), F.element_at(p2, 2)
        x_int = F.try_divide((y - y1) * (x2 - x1), (y2 - y1)) + x1
        hit = ((y > F.least(y1, y2)) & (y <= F.greatest(y1, y2)) & (x <= F.greatest(x1, x2))
               & ((x1 == x2) | (x <= x_int)))
        return acc + F.when(hit, 1).otherwise(0)

    total = F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), crossing)
    return F.coalesce((total % 2) == 1, F.lit(False))


def label_regions(x, y, regions: Sequence[tuple[str, Sequence[Sequence[float]]]]) -> Column:
    """First matching region name in priority order, NULL when in none (PRJ5)."""
    expr = None
    for name, poly in regions:
        test = in_polygon(x, y, poly)
        expr = F.when(test, F.lit(name)) if expr is None else expr.when(test, F.lit(name))
    return expr if expr is not None else F.lit(None).cast("string")


def web_mercator_x(lon) -> Column:
    """EPSG:4326 longitude (degrees) to EPSG:3857 x (metres)."""
    return F.lit(EARTH_RADIUS_M) * F.radians(_as_col(lon).cast("double"))


def web_mercator_y(lat) -> Column:
    """EPSG:4326 latitude (degrees) to EPSG:3857 y (metres)."""
    lat_rad = F.radians(_as_col(lat).cast("double"))
    return F.lit(EARTH_RADIUS_M) * F.ln(F.tan(F.lit(math.pi / 4) + lat_rad / 2))
