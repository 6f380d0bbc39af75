"""Cells inside a zone skip the edge test; heavy cells are salted; the array engine gives the same rows."""

import math
import random

import pytest
from pyspark.sql import functions as F

from cityscan.functions.geo import EDGE_TYPE
from cityscan.operators import within
from cityscan.operators.within import points_in_zones, zone_cells
from cityscan.plans import catalog
from test_spatial import _closed_form, _lattice


def _want(pids):
    return sorted((p, _closed_form(p % 60, p // 60)) for p in pids if _closed_form(p % 60, p // 60) is not None)


@pytest.mark.parametrize("engine", ["native", "arrow"])
@pytest.mark.parametrize("kw", [{}, {"cell_deg": 1.0, "max_cells": 100}, {"broadcast_max_bytes": 0, "skew_sample": 1.0}])
def test_engines_and_joins_agree(spark, engine, kw):
    p, z = _lattice(spark)
    got = points_in_zones(p.repartition(3), z, "x", "y", ["zone"], engine=engine, **kw)
    assert got.columns == ["pid", "x", "y", "zone"]
    assert sorted((r.pid, r.zone) for r in got.collect()) == _want(range(3600))


def test_whole_cells_have_no_edges_and_outer_ones_no_row(spark):
    _, z = _lattice(spark)
    cells = zone_cells(z, 1.0, 200, ["zone", "edges"], edges_col="edges").where("zone = 0")
    rows = {(r._cx, r._cy): r for r in cells.collect()}
    assert rows[(1, 1)]._whole and rows[(1, 1)].edges == []  # inside the square, away from its edges
    assert not rows[(0, 1)]._whole and rows[(0, 1)].edges  # on its left edge
    assert (3, 3) in rows and not rows[(3, 3)]._whole  # on the hole's edge
    big = zone_cells(z.where("zone = 0").withColumn("edges", F.expr("filter(edges, e -> true)")), 0.25, 2000, ["zone", "edges"], edges_col="edges")
    inner = {(r._cx, r._cy) for r in big.collect()}
    assert (16, 16) not in inner  # the middle of the hole


@pytest.mark.parametrize("max_cells, least", [(36, 0.3), (400, 0.6)])
def test_much_of_a_zone_needs_no_edge_test(spark, max_cells, least):
    _, z = _lattice(spark)
    deg = within.grid_plan(z, None, max_cells, carry=["zone"])["cell_deg"]
    cells = zone_cells(z, deg, max_cells, ["zone", "edges"], edges_col="edges")
    area = 36 * (8 * 8 - 2 * 2)
    assert cells.where("_whole").count() * deg * deg / area > least
    assert cells.where("not _whole").agg(F.avg(F.size("edges"))).first()[0] < 8 / 2  # of the zone's eight edges


def test_a_hot_cell_is_dealt_over_many_tasks(spark):
    _, z = _lattice(spark)
    hot = spark.range(4000).select(F.col("id").alias("pid"), F.lit(1.5).alias("x"), F.lit(1.25).alias("y")).repartition(4)
    cold = spark.range(8000).select((F.col("id") + 4000).alias("pid"), (F.col("id") % 60 + 0.5).alias("x"), (F.floor(F.col("id") / 140) + 0.5).alias("y"))
    pts = hot.unionByName(cold)
    cells = zone_cells(z, 7.0, carry=["zone", "edges"], edges_col="edges")
    at = pts.withColumns({"_level": F.lit(0), "_cx": F.floor(F.col("x") / 7.0), "_cy": F.floor(F.col("y") / 7.0)})
    p, c, keys = within._salted(at, cells, pts.columns, 1.0)
    n = [r["count"] for r in p.where("_cx = 0 and _cy = 0").groupBy("_salt").count().collect()]
    assert len(n) > 1 and max(n) <= 3 * min(n)
    assert keys[-1] == "_salt" and c.where("_level = 0 and _cx = 0 and _cy = 0").select("_salt").distinct().count() >= len(n)
    same = points_in_zones(pts, z, "x", "y", ["zone"], broadcast_max_bytes=0, skew_sample=1.0)
    assert same.groupBy("zone").count().orderBy("zone").collect() == points_in_zones(pts, z, "x", "y", ["zone"]).groupBy("zone").count().orderBy("zone").collect()


def test_tasks_of_a_shuffled_join_follow_its_pairs(spark, monkeypatch):
    # few points, few bytes, many pairs: every point meets every zone in one cell
    edges = [(0.0, 0.0, 9.0, 4.0), (9.0, 4.0, 0.0, 9.0), (0.0, 9.0, 0.0, 0.0)]
    z = spark.range(60).select(F.col("id").alias("zone"), (F.col("id") * 0.0).alias("min_x"), F.lit(0.0).alias("min_y"), (F.col("id") * 0.0 + 9.0).alias("max_x"),
                               F.lit(9.0).alias("max_y"), F.array(*[F.struct(*[F.lit(v).alias(n) for n, v in zip(("x1", "y1", "x2", "y2"), e)]) for e in edges]).alias("edges"))
    pts = spark.range(400).select("id", (F.col("id") % 5 + 0.5).alias("x"), F.lit(4.0).alias("y"))
    monkeypatch.setattr(within, "_PAIRS", 1000)
    hits = points_in_zones(pts, z, "x", "y", ["zone"], cell_deg=9.0, broadcast_max_bytes=0, skew_sample=1.0)
    sizes = [r["count"] for r in hits.groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 400 * 60 and max(sizes) <= 6000 and hits.rdd.getNumPartitions() >= 20


def _shape_tables(spark, path, points, zones):
    spark.range(points).select(F.col("id").alias("c_custkey")).write.parquet(f"{path}/customer.parquet")
    spark.range(zones).select(F.col("id").alias("s_suppkey")).write.parquet(f"{path}/supplier.parquet")
    return str(path)


def _counts_and_rows(spark, monkeypatch, d, query):
    """The query's numbers of points by zone, the same by listed pairs, and how many rows its zone join gives."""
    joins, join = [], catalog.points_in_zones
    monkeypatch.setattr(catalog, "points_in_zones", lambda *a, **kw: joins.append((a, kw)) or join(*a, **kw))
    got = {r.zone: r.n_points for r in catalog.QUERIES[query](spark, d).collect()}
    (args, kw), = joins
    listed = join(*args, **{k: v for k, v in kw.items() if k != "count_col"}).groupBy("zone").count().collect()
    return got, {r.zone: r["count"] for r in listed}, join(*args, **kw).count()


def _never_lists_pairs(spark, monkeypatch, tmp_path, query):
    got, want, rows = _counts_and_rows(spark, monkeypatch, _shape_tables(spark, tmp_path, 6000, 80), query)
    assert len(got) == 80 and {z: n for z, n in got.items() if n} == want
    assert rows * 5 < sum(want.values())


def test_shapes_counts_points_without_listing_pairs(spark, monkeypatch, tmp_path):
    _never_lists_pairs(spark, monkeypatch, tmp_path, "shapes")


def _random_zones(spark, n, seed=5):
    rnd, rows = random.Random(seed), []
    for k in range(n):
        cx, cy, size = rnd.uniform(2, 8), rnd.uniform(2, 8), rnd.uniform(0.5, 4)
        ring = [(cx + size * math.cos(a), cy + size * math.sin(a)) for a in sorted(rnd.uniform(0, 6.28) for _ in range(rnd.randint(3, 8)))]
        if k % 5 == 0:
            ring = [(float(round(x)), float(round(y))) for x, y in ring]  # corners and edges where points stand
        edges = [(*a, *b) for a, b in zip(ring, ring[1:] + ring[:1])]
        rows.append((k, edges, *(f(p[i] for p in ring) for f in (min, max) for i in (0, 1))))
    return spark.createDataFrame(rows, f"zone int, edges {EDGE_TYPE}, min_x double, min_y double, max_x double, max_y double")


@pytest.mark.parametrize("engine", ["native", "arrow"])
@pytest.mark.parametrize("kw", [{}, {"broadcast_max_bytes": 0}])
def test_counts_down_a_tree_are_those_of_the_pairs(spark, monkeypatch, engine, kw):
    # small sizes: many crowded cells, deep trees, several groups of a cell, arrays cut many times
    for name, v in (("_PLACES", 3), ("_CROWD", 10), ("_LEAF", 4), ("_FAN", 2), ("_ENTRIES", 64), ("_TREE", 200), ("_GROUP_EDGES", 40)):
        monkeypatch.setattr(within, name, v)
    trees, crowded = [], within._crowded
    monkeypatch.setattr(within, "_crowded", lambda *a: trees.append(crowded(*a)) or trees[0])
    x, y = (F.pmod(F.xxhash64("id", F.lit(s)), F.lit(10_000)) / 1000.0 for s in (1, 2))
    lattice = F.col("id") % 3 == 0  # places with many points, on corners and edges of some zones
    pts = spark.range(6000).select("id", F.when(lattice, F.round(x)).otherwise(x).alias("x"), F.when(lattice, F.round(y)).otherwise(y).alias("y"))
    odd = spark.createDataFrame([(-1, None, 5.0), (-2, float("nan"), 5.0), (-3, 5.0, float("inf")), (-4, 5.0, None)], "id long, x double, y double")
    pts, z = pts.unionByName(odd), _random_zones(spark, 30)
    want = {r.zone: r["count"] for r in points_in_zones(pts, z, "x", "y", ["zone"]).groupBy("zone").count().collect()}
    hits = points_in_zones(pts, z, "x", "y", ["zone"], engine=engine, count_col="n", **kw)
    assert hits.columns == ["zone", "n"]
    assert {r.zone: r.n for r in hits.groupBy("zone").agg(F.sum("n").alias("n")).collect()} == want
    assert trees and trees[0].count() > 30


def test_shapes_arrow_counts_points_without_listing_pairs(spark, monkeypatch, tmp_path):
    _never_lists_pairs(spark, monkeypatch, tmp_path, "shapes_arrow")


def test_shapes_shuffled_counts_points_without_listing_pairs(spark, monkeypatch, tmp_path):
    _never_lists_pairs(spark, monkeypatch, tmp_path, "shapes_shuffled")
