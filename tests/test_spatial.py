import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from cityscan.functions.geo import haversine_km, point_in_polygon
from cityscan.operators.nearest import nearest_site, site_load
from cityscan.operators.within import points_in_zones


def _square_edges(x0, y0, x1, y1):
    pts = [(float(a), float(b)) for a, b in [(x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0)]]
    return [(a[0], a[1], b[0], b[1]) for a, b in zip(pts[:-1], pts[1:])]


def _lattice(spark):
    """36 squares 8x8 at pitch 10 with a 2x2 hole; 3,600 integer points."""
    zones = []
    for i in range(6):
        for j in range(6):
            x0, y0 = 10 * i, 10 * j
            e = _square_edges(x0, y0, x0 + 8, y0 + 8) + _square_edges(x0 + 3, y0 + 3, x0 + 5, y0 + 5)
            zones.append((i * 6 + j, e, float(x0), float(y0), float(x0 + 8), float(y0 + 8)))
    z = spark.createDataFrame(zones, "zone int, edges array<struct<x1:double,y1:double,x2:double,y2:double>>, "
                                     "min_x double, min_y double, max_x double, max_y double")
    p = spark.range(3600).select(F.col("id").alias("pid"), (F.col("id") % 60).cast("double").alias("x"),
                                 F.floor(F.col("id") / 60).cast("double").alias("y"))
    return p, z


def _closed_form(x, y):
    i, j = int(x // 10), int(y // 10)
    x0, y0 = 10 * i, 10 * j
    inside = x0 < x < x0 + 8 and y0 < y < y0 + 8
    in_hole = x0 + 3 <= x <= x0 + 5 and y0 + 3 <= y <= y0 + 5
    return (i * 6 + j) if inside and not in_hole and i < 6 and j < 6 else None


def test_lattice_grid_join_equals_closed_form_and_brute_force(spark):
    p, z = _lattice(spark)
    got = sorted((r.pid, r.zone) for r in points_in_zones(p, z, "x", "y", ["zone"], cell_deg=7.0).collect())
    want = sorted((pid, _closed_form(pid % 60, pid // 60)) for pid in range(3600)
                  if _closed_form(pid % 60, pid // 60) is not None)
    assert len(got) == 1440 and got == want
    brute = p.crossJoin(z).where(point_in_polygon("x", "y", "edges"))
    assert sorted((r.pid, r.zone) for r in brute.collect()) == want


@pytest.mark.parametrize("cell", [0.5, 3.0, 25.0, 200.0])
def test_lattice_any_cell_size(spark, cell):
    p, z = _lattice(spark)
    assert points_in_zones(p, z, "x", "y", ["zone"], cell_deg=cell, max_cells=4).count() == 1440


def test_lattice_shuffle_path_when_zones_exceed_broadcast_bound(spark):
    p, z = _lattice(spark)
    df = points_in_zones(p, z, "x", "y", ["zone"], cell_deg=7.0, broadcast_max_bytes=1000)
    assert df.count() == 1440
    plan = plan_text(df)
    assert "SortMergeJoin" in plan or "ShuffledHashJoin" in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_points_in_zones_plan_has_no_nested_loop(spark):
    p, z = _lattice(spark)
    df = points_in_zones(p, z, "x", "y", ["zone"])
    df.count()
    plan = plan_text(df)
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "BroadcastHashJoin" in plan


def _py_pip(x, y, poly):
    inside = False
    for (x1, y1, x2, y2) in poly:
        if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
            inside = not inside
    return inside


def test_random_polygons_match_python_crossing(spark):
    rnd = random.Random(7)
    polys, pts = [], []
    for k in range(20):
        cx, cy, n = rnd.uniform(0, 100), rnd.uniform(0, 100), rnd.randint(3, 9)
        ang = sorted(rnd.uniform(0, 2 * math.pi) for _ in range(n))
        ring = [(cx + rnd.uniform(2, 10) * math.cos(a), cy + rnd.uniform(2, 10) * math.sin(a)) for a in ang]
        ring.append(ring[0])
        polys.append((k, [(a[0], a[1], b[0], b[1]) for a, b in zip(ring[:-1], ring[1:])]))
    pts = [(i, rnd.uniform(0, 110), rnd.uniform(0, 110)) for i in range(400)]
    pdf = spark.createDataFrame(pts, "pid int, x double, y double")
    zdf = spark.createDataFrame(polys, "zone int, edges array<struct<x1:double,y1:double,x2:double,y2:double>>")
    zdf = zdf.withColumns({"min_x": F.array_min(F.transform("edges", lambda e: e.x1)),
                           "max_x": F.array_max(F.transform("edges", lambda e: e.x1)),
                           "min_y": F.array_min(F.transform("edges", lambda e: e.y1)),
                           "max_y": F.array_max(F.transform("edges", lambda e: e.y1))})
    got = sorted((r.pid, r.zone) for r in points_in_zones(pdf, zdf, "x", "y", ["zone"]).collect())
    want = sorted((i, k) for i, x, y in pts for k, e in polys if _py_pip(x, y, e))
    assert got == want


def _hav(lon1, lat1, lon2, lat2, r=6371.008):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin(math.radians(lat2 - lat1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * r * math.asin(math.sqrt(a))


def test_haversine_matches_python(spark):
    df = spark.createDataFrame([(-118.25, 34.05, -118.4, 33.94)], "a double, b double, c double, d double")
    got = df.select(haversine_km("a", "b", "c", "d")).first()[0]
    assert abs(got - _hav(-118.25, 34.05, -118.4, 33.94)) < 1e-9


def _nearest_fixture(spark, n_sites=40, n_pts=300, seed=3):
    rnd = random.Random(seed)
    sites = [(k, f"s{k}", rnd.uniform(-118.7, -118.2), rnd.uniform(33.7, 34.3)) for k in range(n_sites)]
    sites.append((n_sites, "twin", sites[0][2], sites[0][3]))  # equal distance: smaller key wins
    pts = [(str(i % 250) if i % 97 else None, rnd.uniform(-118.8, -118.1), rnd.uniform(33.6, 34.4))
           for i in range(n_pts)]
    pts += [("far", 150.0, -60.0), ("pole", 10.0, 89.9), ("anti", 179.99, 0.0)]  # empty windows, wrap
    return (spark.createDataFrame(pts, "id string, lon double, lat double"),
            spark.createDataFrame(sites, "skey long, name string, lon double, lat double"), pts, sites)


def _brute(pts, sites, by_id):
    best = {}
    for i, (pid, lon, lat) in enumerate(pts):
        cand = min((_hav(lon, lat, s[2], s[3]), s[0]) for s in sites)
        key = pid if by_id else i
        best[key] = min(best.get(key, cand), cand)
    return best


@pytest.mark.parametrize("method,fallback", [("array", 100_000), ("grid", 100_000), ("grid", 0)])
def test_nearest_per_id_equals_brute_force(spark, method, fallback):
    pdf, sdf, pts, sites = _nearest_fixture(spark)
    out = nearest_site(pdf, sdf, "lon", "lat", "lon", "lat", "skey", ["name"], id_cols=["id"], method=method,
                       cell_deg=0.02, broadcast_sites=fallback).collect()
    want = _brute(pts, sites, by_id=True)
    got = {r.id: (r.distance_km, r.skey) for r in out}
    assert set(got) == set(want)
    for k, (d, s) in want.items():
        assert got[k][1] == s and abs(got[k][0] - d) < 1e-6


@pytest.mark.parametrize("method,fallback", [("array", 100_000), ("grid", 100_000), ("grid", 0)])
def test_nearest_per_row_counts_every_row(spark, method, fallback):
    pdf, sdf, pts, sites = _nearest_fixture(spark)
    pdf = pdf.union(pdf.limit(5))  # duplicate rows count twice without id_cols
    near = nearest_site(pdf, sdf, "lon", "lat", "lon", "lat", "skey", ["name"], method=method, cell_deg=0.05,
                        broadcast_sites=fallback)
    load = site_load(near, ["skey"])
    assert load.agg(F.sum("number_of_points")).first()[0] == len(pts) + 5
    want = _brute(pts, sites, by_id=False)
    wl = {}
    for d, s in want.values():
        wl.setdefault(s, []).append(d)
    got = {r.skey: r for r in load.collect()}
    for s, ds in wl.items():
        assert got[s].number_of_points >= len(ds)


def test_nearest_skips_null_coordinates_and_handles_no_sites(spark):
    pdf = spark.createDataFrame([("a", None, 1.0), ("b", 1.0, 1.0)], "id string, lon double, lat double")
    sdf = spark.createDataFrame([(1, 1.0, 1.5)], "skey long, lon double, lat double")
    assert [r.id for r in nearest_site(pdf, sdf, "lon", "lat", "lon", "lat", "skey", id_cols=["id"]).collect()] == ["b"]
    empty = sdf.where("false")
    for m, fb in (("array", 100_000), ("grid", 100_000), ("grid", 0)):
        assert nearest_site(pdf, empty, "lon", "lat", "lon", "lat", "skey", id_cols=["id"], method=m,
                            broadcast_sites=fb).count() == 0


def test_site_load_top_is_a_top_k(spark):
    pdf, sdf, pts, sites = _nearest_fixture(spark)
    near = nearest_site(pdf, sdf, "lon", "lat", "lon", "lat", "skey", ["name"], method="array")
    full = [tuple(r) for r in site_load(near, ["skey"]).collect()]
    top = site_load(near, ["skey"], top=5)
    assert [tuple(r) for r in top.collect()] == full[:5]
    assert "TakeOrderedAndProject" in plan_text(top)


def test_point_in_polygon_degenerate_and_collinear(spark):
    # square with an extra collinear vertex on the bottom edge, plus a degenerate 2-point ring
    square = [(0.0, 0.0, 2.0, 0.0), (2.0, 0.0, 4.0, 0.0), (4.0, 0.0, 4.0, 4.0), (4.0, 4.0, 0.0, 4.0),
              (0.0, 4.0, 0.0, 0.0), (1.0, 1.0, 1.0, 1.0)]
    pts = [(1, 1.0, 2.0), (2, 2.0, 0.0), (3, 4.0, 4.0), (4, 3.0, 3.0), (5, 5.0, 2.0), (6, 1.0, 1.0), (7, 2.0, 4.0)]
    df = spark.createDataFrame([(i, x, y, square) for i, x, y in pts],
                               "pid int, x double, y double, edges array<struct<x1:double,y1:double,x2:double,y2:double>>")
    got = {r.pid for r in df.where(point_in_polygon("x", "y", "edges")).collect()}
    # inside: 1 and 4; on the boundary (edge, vertex, collinear vertex): 2, 3, 7; outside: 5;
    # point 6 lies on the degenerate zero-length edge, which counts as boundary
    assert got == {1, 4}
