"""Adaptive cells of the nearest site: bounded lists on skewed layouts, and the same answers anywhere."""

import math
import random

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from cityscan.operators import nearest
from cityscan.operators.nearest import list_facts, nearest_site, site_cells, site_frame
from conftest import plan_text


def _hav(lon1, lat1, lon2, lat2):
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * 6371.008 * math.asin(min(1.0, math.sqrt(a)))


def _layout(kind, n=600):
    rnd = random.Random(kind)
    spread = [(rnd.uniform(-180, 180), math.degrees(math.asin(rnd.uniform(-1, 1)))) for _ in range(n)]
    if kind == "stacked":
        return spread[: n * 9 // 10] + [(2.35, 48.85)] * (n // 10)
    if kind == "city":
        return spread[: n // 2] + [(2.2 + rnd.random() / 5, 48.8 + rnd.random() / 5) for _ in range(n // 2)]
    if kind == "poles":
        return [(rnd.uniform(-180, 180), rnd.choice((-1, 1)) * rnd.uniform(88, 90)) for _ in range(n)]
    if kind == "antimeridian":
        return [(rnd.choice((-180.0, 180.0, 179.9, -179.9)) + rnd.uniform(-0.05, 0.05) * (i % 2) * 0, rnd.uniform(-60, 60)) for i in range(n)]
    return spread


def _sites(spark, places):
    return spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(places)], "skey long, lon double, lat double")


def _answers(spark, places, points, **kw):
    pdf = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id long, lon double, lat double")
    out = nearest_site(pdf, _sites(spark, places), "lon", "lat", "lon", "lat", "skey", id_cols=["id"], **kw).collect()
    return {r.id: (r.skey, r.distance_km) for r in out}


def _check(places, points, got):
    assert len(got) == len(points)
    for i, (x, y) in enumerate(points):
        d, k = min((_hav(x, y, *s), j) for j, s in enumerate(places))
        assert abs(got[i][1] - d) < 1e-6 and (got[i][0] == k or abs(_hav(x, y, *places[got[i][0]]) - d) < 1e-9)


@pytest.mark.parametrize("kind", ["uniform", "stacked", "city", "poles", "antimeridian"])
@pytest.mark.parametrize("broadcast_sites", [100_000, 0])
def test_any_layout_equals_brute_force(spark, kind, broadcast_sites):
    rnd = random.Random(5)
    points = [(rnd.uniform(-180, 180), rnd.uniform(-90, 90)) for _ in range(150)] + [(2.3, 48.85), (0.0, 90.0), (77.0, -90.0), (180.0, 0.0), (-180.0, 10.0)]
    places = _layout(kind)
    _check(places, points, _answers(spark, places, points, broadcast_sites=broadcast_sites))


@pytest.mark.parametrize("kind", ["uniform", "stacked", "city", "poles"])
def test_candidates_of_a_point_are_bounded(spark, kind):
    cells = site_cells(site_frame(_sites(spark, _layout(kind, 3000)), "lon", "lat", "skey", []))
    sizes = [r[0] for r in cells.select(F.size("_list")).collect()]
    assert max(sizes) <= nearest._LEAF  # no point, wherever it is, meets more sites
    assert len(sizes) <= 3 * 3000 and sum(sizes) <= 12 * 3000
    assert list_facts(cells)[1] < 8 << 20


def test_cells_cover_the_globe_once(spark):
    rnd = random.Random(9)
    places = _layout("city", 400)
    points = [(rnd.uniform(-180, 180), math.degrees(math.asin(rnd.uniform(-1, 1)))) for _ in range(2000)] + places
    pdf = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(points)], "id long, lon double, lat double")
    near = nearest_site(pdf, _sites(spark, places), "lon", "lat", "lon", "lat", "skey")
    assert near.count() == len(points)


def test_many_sites_are_cut_as_tables(spark, monkeypatch):
    monkeypatch.setattr(nearest, "_BLOCK", 60)  # cells with more candidates are cut by joins
    for kind in ("uniform", "city"):
        places = _layout(kind, 500)
        points = places[::9] + [(1.0, 2.0), (-170.0, 80.0)]
        _check(places, points, _answers(spark, places, points))


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(places=st.lists(st.tuples(st.integers(-18, 18), st.integers(-9, 9)), min_size=1, max_size=40),
       points=st.lists(st.tuples(st.integers(-36, 36), st.integers(-18, 18)), min_size=1, max_size=30))
def test_lattices_with_ties_equal_brute_force(spark, places, points):
    places, points = [(x * 10.0, y * 10.0) for x, y in places], [(x * 5.0, y * 5.0) for x, y in points]
    _check(places, points, _answers(spark, places, points))


def test_one_join_a_point_and_no_list_of_all_sites(spark):
    pdf = spark.createDataFrame([(1, 1.0, 2.0)], "id long, lon double, lat double")
    df = nearest_site(pdf, _sites(spark, _layout("uniform", 200)), "lon", "lat", "lon", "lat", "skey", id_cols=["id"])
    df.collect()
    plan = plan_text(df)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan and plan.count("BroadcastHashJoin") >= 1


def test_ties_nulls_and_bad_coordinates(spark):
    sites = spark.createDataFrame([(5, "b", 0.0, 10.0), (None, "z", 0.0, -10.0), (3, "a", 0.0, 10.0), (1, "x", float("nan"), 0.0), (1, "y", 0.0, 91.0)],
                                  "k int, n string, lon double, lat double")
    points = spark.createDataFrame([(1, 0.0, 0.0), (2, 0.0, 5.0), (3, float("nan"), 0.0), (4, None, 0.0)], "id int, lon double, lat double")
    for bound in (100_000, 0):
        got = {r.id: (r.k, r.n) for r in nearest_site(points, sites, "lon", "lat", "lon", "lat", "k", ["n"], id_cols=["id"], broadcast_sites=bound).collect()}
        assert got == {1: (None, "z"), 2: (3, "a")}


@pytest.mark.parametrize("block", [4096, 200])
def test_sites_in_line_are_not_listed_over_and_over(spark, monkeypatch, block):
    # a crowd in rows: seen from afar each site at its border is the nearest in a strip, and so in ever finer cells
    monkeypatch.setattr(nearest, "_BLOCK", block)
    places = [(-118.7 + (k * 6151 % 1013) / 202600.0, 33.7 + (k * 3571 % 991) / 165200.0) for k in range(12000)] + [(0.0, 0.0)]
    if block < 4096:
        places = places[:1500]
    cells = site_cells(site_frame(_sites(spark, places), "lon", "lat", "skey", []))
    sizes = [r[0] for r in cells.select(F.size("_list")).collect()]
    assert max(sizes) <= 16 * nearest._LEAF and sum(sizes) <= 40 * len(places)
    rnd = random.Random(3)
    points = [(-118.7 + rnd.random() / 2, 33.7 + rnd.random() / 2) for _ in range(60)] + [(-118.699, 33.701), (60.0, -30.0)]
    if block < 4096:
        _check(places, points, _answers(spark, places, points))


def test_array_of_many_sites_uses_the_cells(spark):
    places = _layout("uniform", nearest._ARRAY + 1)
    points = places[::40] + [(1.0, 2.0)]
    with pytest.warns(UserWarning, match="the grid is used"):
        got = _answers(spark, places, points, method="array")
    _check(places, points, got)
