"""Spatial expressions on plain columns.

A point is two double columns (lon, lat). A polygon (any number of parts and
holes) is one ``array<struct<x1,y1,x2,y2>>`` of edges plus bbox columns: the
even-odd rule over all rings handles holes and multi-part shapes without
special cases.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: mean Earth radius in metres used by the great-circle distance.
EARTH_RADIUS_M = 6371008.0

EDGE_TYPE = "array<struct<x1:double,y1:double,x2:double,y2:double>>"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def haversine_km(
    lon1: Column | str,
    lat1: Column | str,
    lon2: Column | str,
    lat2: Column | str,
    radius_m: float = EARTH_RADIUS_M,
) -> Column:
    """Great-circle distance in kilometres (haversine form), symmetric."""
    x1, y1, x2, y2 = _c(lon1), _c(lat1), _c(lon2), _c(lat2)
    sdlat = F.sin(F.radians(y2 - y1) / 2)
    sdlon = F.sin(F.radians(x2 - x1) / 2)
    a = sdlat * sdlat + F.cos(F.radians(y1)) * F.cos(F.radians(y2)) * sdlon * sdlon
    return F.asin(F.sqrt(a)) * F.lit(2 * radius_m / 1000.0)


def ring_edges(ring: Column) -> Column:
    """``array<array<double>>`` closed ring → array of edges (consecutive pairs)."""
    n = F.size(ring)
    starts = F.slice(ring, 1, n - 1)
    ends = F.slice(ring, 2, n - 1)
    return F.zip_with(
        starts,
        ends,
        lambda a, b: F.struct(
            a[0].alias("x1"), a[1].alias("y1"), b[0].alias("x2"), b[1].alias("y2")
        ),
    )


def rings_to_edges(rings: Column) -> Column:
    """``array<ring>`` → one flat edge array (rings with < 2 points add nothing)."""
    per_ring = F.transform(
        F.filter(rings, lambda r: F.size(r) >= 2), lambda r: ring_edges(r)
    )
    return F.flatten(per_ring)


def edges_bbox(edges: Column) -> dict[str, Column]:
    """Bounding box of an edge array as four scalar columns."""
    xs = F.transform(edges, lambda e: e["x1"])
    ys = F.transform(edges, lambda e: e["y1"])
    return {
        "min_x": F.array_min(xs),
        "min_y": F.array_min(ys),
        "max_x": F.array_max(xs),
        "max_y": F.array_max(ys),
    }


def _cross(px: Column, py: Column, e: Column) -> Column:
    # (edge direction) x (point - start); zero exactly when collinear
    return (e["x2"] - e["x1"]) * (py - e["y1"]) - (e["y2"] - e["y1"]) * (px - e["x1"])


_ON_EDGE = -(1 << 20)  # added per edge the point lies on: drives the total negative


def point_in_polygon(px: Column | str, py: Column | str, edges: Column | str) -> Column:
    """Strict containment (OGC *within*): inside by even-odd, and not on an edge.

    One pass over the edges: an edge whose y-range misses the point is
    skipped after two comparisons; otherwise the cross product decides both
    "point on this edge" and "ray crosses this edge", so rounding can never
    make a point both. An on-edge hit adds a large negative amount, so the
    single test ``total % 2 == 1`` (remainder keeps the sign) means "odd
    crossings and on no edge" - the edge loop is referenced, and run, once.
    Division-free, hence safe under ANSI mode.
    """
    x, y, E = _c(px), _c(py), _c(edges)

    def score(acc, e):
        lo_y, hi_y = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
        d = _cross(x, y, e)
        on_edge = (d == 0) & (x >= F.least(e["x1"], e["x2"])) & (x <= F.greatest(e["x1"], e["x2"]))
        crosses = ((e["y1"] > y) != (e["y2"] > y)) & ((d > 0) == (e["y2"] > e["y1"]))
        return acc + (
            F.when((y < lo_y) | (y > hi_y), 0)
            .when(on_edge, _ON_EDGE)
            .when(crosses, 1)
            .otherwise(0)
        )

    return (F.aggregate(E, F.lit(0), score) % 2) == 1
