"""Strict point-in-polygon on integer coordinates against exact rational arithmetic."""

from fractions import Fraction

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cityscan.functions.geo import point_in_polygon

COORD = st.integers(min_value=0, max_value=8)


def _exact_within(px, py, edges):
    inside = False
    for x1, y1, x2, y2 in edges:
        cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
        if cross == 0 and min(x1, x2) <= px <= max(x1, x2) and min(y1, y2) <= py <= max(y1, y2):
            return False  # on the boundary: not within
        if (y1 > py) != (y2 > py):
            xint = Fraction(x2 - x1) * Fraction(py - y1, y2 - y1) + x1
            if px < xint:
                inside = not inside
    return inside


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(rings=st.lists(st.lists(st.tuples(COORD, COORD), min_size=3, max_size=6), min_size=1, max_size=2))
def test_integer_polygons_match_exact_reference(spark, rings):
    edges = []
    for ring in rings:
        closed = ring + [ring[0]]
        edges += [(float(a[0]), float(a[1]), float(b[0]), float(b[1])) for a, b in zip(closed[:-1], closed[1:])]
    pts = [(i, float(x), float(y)) for i, (x, y) in enumerate((x, y) for x in range(9) for y in range(9))]
    df = spark.createDataFrame([(i, x, y, edges) for i, x, y in pts],
                               "pid int, x double, y double, edges array<struct<x1:double,y1:double,x2:double,y2:double>>")
    got = {r.pid for r in df.where(point_in_polygon("x", "y", "edges")).collect()}
    want = {i for i, x, y in pts if _exact_within(int(x), int(y), [tuple(int(v) for v in e) for e in edges])}
    assert got == want
