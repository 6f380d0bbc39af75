"""P5: which zone (polygon) holds each point - a grid-cell equi-join.

Each zone is assigned a grid level fine enough that its bounding box covers
at most ``max_cells`` cells (large zones go to coarser levels, so no zone
explodes into many rows). A point gets one cell per level in use, so every
(point, zone) pair meets in exactly one cell: no duplicates, no nested loop.
A cell that no edge of the zone touches lies in it as a whole, and needs no
edge test, or outside, and has no row. In the others candidates are cut by bbox first,
then by the exact edge test (strict *within*: boundary points belong to no zone).

Where only the number of points in each zone is asked for (``count_col``), the pairs are not listed: a cell inside
a zone gives its sum of points, and a cell on a zone's edge that holds many points is cut along a tree of
its points, so the work grows with zones times about the square root of the points.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityscan.functions.geo import EDGE_TYPE, point_in_polygon
from cityscan.session import materialize


# Functions that run in Python workers are pickled by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_AT = ("_level", "_cx", "_cy")

# Size model of one cell-table row: fixed columns, plus one edge struct.
_ROW_BYTES = 96
_EDGE_BYTES = 40

#: A task of a shuffled join meets some so many (point, zone row) pairs of a cell, up to ``_MAX_TASKS`` tasks.
_PAIRS = 20_000_000
_MAX_TASKS = 10_000

#: Counting: in a cell with more places than this, and more pairs of a place and a zone's edge, the places are counted down a tree.
_PLACES, _CROWD = 32, 10_000
#: A leaf of the tree has ``_LEAF`` places, a node ``_FAN`` children.
_LEAF, _FAN = 32, 4
#: Counting: a tree has some so many places, a group's zone rows so many edges, arrays so many entries at once; a task has some
#: so many edges times the square root of their cell's places.
_TREE = 1 << 18
_GROUP_EDGES = 200_000
_ENTRIES = 1 << 17
_WORK = 2_000_000


def zone_cells(
    zones: DataFrame,
    cell_deg: float,
    max_cells: int = 36,
    carry: Sequence[str] = (),
    edges_col: str | None = None,
) -> DataFrame:
    """Zones → one row per covered cell: (level, cx, cy, bbox, carry...).

    With ``edges_col``, each row keeps only the edges a point of that cell can
    need: a ray cast to +x from a point in the cell can only cross (or the
    point lie on) an edge whose y-range meets the cell's row band and which
    reaches the cell's left side. The band is widened by a margin, so the
    clipping never drops a needed edge. ``_whole`` says that the cell lies inside as a whole (no edge's
    bounds meet it, and its centre is inside); cells outside go.
    """
    k = max(int(math.isqrt(max_cells)), 2)
    span = F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))
    # smallest level l with span / (cell * 2^l) <= k - 1  → at most k cells per axis
    lvl = F.greatest(
        F.lit(0),
        F.ceil(F.log2(F.greatest(span, F.lit(1e-300)) / F.lit(cell_deg * (k - 1)))).cast("int"),
    )
    z = zones.withColumn("_level", lvl).withColumn("_c", F.lit(cell_deg) * F.pow(F.lit(2.0), F.col("_level")))
    cells = z.select(
        "_level",
        F.explode(F.sequence(F.floor(F.col("min_x") / F.col("_c")), F.floor(F.col("max_x") / F.col("_c")))).alias("_cx"),
        F.col("min_y"), F.col("max_y"), F.col("min_x"), F.col("max_x"), F.col("_c"),
        *carry,
    ).select(
        "_level", "_cx",
        F.explode(F.sequence(F.floor(F.col("min_y") / F.col("_c")), F.floor(F.col("max_y") / F.col("_c")))).alias("_cy"),
        "min_x", "min_y", "max_x", "max_y", "_c",
        *carry,
    )
    if edges_col:
        c = F.col("_c")
        m = c * F.lit(1e-6)
        names = [n for n in cells.columns if n != edges_col]
        cells = cells.select("*", (F.col("_cy") * c - m).alias("_y0"), ((F.col("_cy") + 1) * c + m).alias("_y1"),
                             (F.col("_cx") * c - m).alias("_x0"), ((F.col("_cx") + 1) * c + m).alias("_x1"))
        # explode(array(v)) computes v once: a filter on it is not pushed below, which would compute it again for each use
        cells = cells.select(*names, "_x1", F.explode(F.array(F.filter(
            edges_col,
            lambda e: (F.greatest(e["y1"], e["y2"]) >= F.col("_y0"))
            & (F.least(e["y1"], e["y2"]) <= F.col("_y1"))
            & (F.greatest(e["x1"], e["x2"]) >= F.col("_x0")),
        ))).alias(edges_col))
        touched = F.exists(edges_col, lambda e: F.least(e["x1"], e["x2"]) <= F.col("_x1"))
        centre = point_in_polygon((F.col("_cx") + 0.5) * c, (F.col("_cy") + 0.5) * c, edges_col)
        whole = F.when(touched, F.lit(False)).when(centre, F.lit(True))
        cells = cells.select(*names, edges_col, F.explode(F.array(whole)).alias("_whole")).where("_whole is not null")
        cells = cells.withColumn(edges_col, F.when(F.col("_whole"), F.array().cast(EDGE_TYPE)).otherwise(F.col(edges_col)))
    return cells.drop("_c")


def _span() -> "F.Column":
    return F.greatest(F.col("max_x") - F.col("min_x"), F.col("max_y") - F.col("min_y"))


def grid_plan(zones: DataFrame, cell_deg: float | None = None, max_cells: int = 36, edges_col: str = "edges",
              carry: Sequence[str] = ()) -> dict:
    """One bounded aggregate over the zones: zone count, the cell size, the grid
    levels that can occur and an upper estimate of the cell table's bytes.

    The default cell size is the median bbox span in as many parts as a side may have. Levels are derived from
    ``ceil(log2(span))`` classes, a superset of the exact levels (at most one
    spare levels per class); a spare level only adds a probe that matches nothing.
    """
    k = max(int(math.isqrt(max_cells)), 2)
    text = F.octet_length(F.to_json(F.struct(*carry))) if carry else F.lit(0)
    r = zones.agg(
        F.count(F.lit(1)).alias("n"),
        F.percentile_approx(_span(), 0.5).alias("median"),
        F.collect_set(F.ceil(F.log2(F.greatest(_span(), F.lit(1e-300))))).alias("classes"),
        F.sum(F.size(edges_col)).alias("edges"), F.sum(text).alias("text"),
    ).first()
    n = int(r["n"] or 0)
    if cell_deg is None:
        m = r["median"]
        cell_deg = float(m) / (k - 1) if m and m > 0 else 0.01
    base = math.log2(cell_deg * (k - 1))
    levels = set()
    for e in r["classes"] or []:
        # log2(span) lies in (e - 1, e]; one more level absorbs rounding of
        # the per-zone level computed on the executors
        for v in (e - 1, e, e + 1):
            levels.add(max(0, math.ceil(v - base)))
    # at most k * k cells a zone; an edge stays in about two rows of k cells
    size = k * k * (n * _ROW_BYTES + int(r["text"] or 0)) + 2 * k * int(r["edges"] or 0) * _EDGE_BYTES
    return {"n_zones": n, "cell_deg": cell_deg, "levels": sorted(levels), "k": k, "bytes": size}


def _salted(p: DataFrame, cells: DataFrame, pcols: Sequence[str], sample: float,
            at: Sequence[str] = _AT) -> tuple[DataFrame, DataFrame, list[str]]:
    """Points and cells of a shuffled join, dealt by the pairs that meet in a cell: its points, by a sample, times its zone rows.

    There are as many tasks as give each some ``_PAIRS`` pairs (at least the session's). A cell of more than half a
    task's pairs gets that many salts; its points are dealt over them and its zone rows repeated for each. Both sides come
    partitioned, as sides of few bytes and many pairs would else be put together into few tasks."""
    at = list(at)
    parts = int(p.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    seen = (p.sample(sample, seed=1) if sample < 1.0 else p).groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
    rows = cells.groupBy(*at).agg(F.count(F.lit(1)).alias("_m")).hint("merge")
    seen = materialize(seen.join(rows, at).select(*at, (F.col("_n") * F.col("_m")).cast("double").alias("_n")))
    total = seen.agg(F.sum("_n")).first()[0] or 0.0
    parts = int(min(max(parts, math.ceil(total / sample / _PAIRS)), _MAX_TASKS))
    # at most 2 * parts cells are that heavy, so the table is small whatever the points
    heavy = F.broadcast(seen.where(F.col("_n") * 2 * parts > total).select(
        *at, F.least(F.lit(parts), F.ceil(F.col("_n") * 2 * parts / F.lit(max(total, 1.0)))).cast("long").alias("_salts")))
    own = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in pcols]) + F.spark_partition_id(), F.col("_salts"))
    p = p.join(heavy, at, "left").withColumn("_salt", F.coalesce(own, F.lit(0).cast("long"))).drop("_salts")
    last = F.coalesce(F.col("_salts"), F.lit(1).cast("long")) - 1
    cells = cells.join(heavy, at, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), last))).drop("_salts")
    at = [*at, "_salt"]
    return p.repartition(parts, *at), cells.repartition(parts, *at), at


def _within_batches(x: str, y: str, edges: str, keep: Sequence[str]):
    """The rows of Arrow batches whose point is in its candidate zone: all edges of a batch in a few array operations."""

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            px, py = (b.column(c).to_numpy(zero_copy_only=False) for c in (x, y))
            lists = b.column(edges)
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            row = np.repeat(np.arange(len(px)), np.diff(offsets))
            flat = tuple(c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
            inside = _crossed(px[row], py[row], flat, row, len(px))
            whole = b.column("_whole").to_numpy(zero_copy_only=False).astype(bool)
            yield b.filter(pa.array(whole | inside)).select(list(keep))

    return test


def _cell_of(cell_deg: float, lon: str, lat: str, levels: Sequence[int]) -> "F.Column":
    """The cell of a point in each level."""
    return F.array(*[
        F.struct(
            F.lit(l).alias("_level"),
            F.floor(F.col(lon) / F.lit(cell_deg * 2.0 ** l)).alias("_cx"),
            F.floor(F.col(lat) / F.lit(cell_deg * 2.0 ** l)).alias("_cy"),
        )
        for l in sorted(levels)
    ]) if levels else F.array().cast("array<struct<_level:int,_cx:bigint,_cy:bigint>>")


def _node_sums(px: np.ndarray, py: np.ndarray, n: np.ndarray) -> tuple[tuple[np.ndarray, ...], list[tuple[np.ndarray, ...]]]:
    """The places in the order of a space-filling curve, and the tree over them: by level, from its one root to the leaves, each
    node's bounds, sum of points and first place. A node has ``_FAN`` successive children, a leaf ``_LEAF`` successive places."""
    code = np.zeros(len(px), np.uint64)
    for shift, v in enumerate((px, py)):
        span = v.max() - v.min()
        q = ((v - v.min()) / (span if span > 0 else 1.0) * 0xFFFFFF).astype(np.uint64)
        for bit in range(24):
            code |= ((q >> np.uint64(bit)) & np.uint64(1)) << np.uint64(2 * bit + shift)
    order = np.argsort(code, kind="stable")
    px, py, n = px[order], py[order], n[order]
    first = np.arange(0, len(px), _LEAF)
    level = (*(np.minimum.reduceat(v, first) for v in (px, py)), *(np.maximum.reduceat(v, first) for v in (px, py)), np.add.reduceat(n, first), first)
    tree = [level]
    while len(level[0]) > 1:
        at = np.arange(0, len(level[0]), _FAN)
        level = (*(np.minimum.reduceat(v, at) for v in level[:2]), *(np.maximum.reduceat(v, at) for v in level[2:4]),
                 np.add.reduceat(level[4], at), level[5][at])
        tree.append(level)
    return (px, py, n), tree[::-1]


def _crossed(ex: np.ndarray, ey: np.ndarray, edge: tuple[np.ndarray, ...], row: np.ndarray, rows: int) -> np.ndarray:
    """For each of ``rows`` points: is it strictly inside, by its edges (point ``row`` meets an edge at the same index)."""
    x1, y1, x2, y2 = edge
    d = (x2 - x1) * (ey - y1) - (y2 - y1) * (ex - x1)
    reach = (ey >= np.minimum(y1, y2)) & (ey <= np.maximum(y1, y2))
    on = reach & (d == 0) & (ex >= np.minimum(x1, x2)) & (ex <= np.maximum(x1, x2))
    crosses = reach & ((y1 > ey) != (y2 > ey)) & ((d > 0) == (y2 > y1))
    n = np.bincount(row, crosses, rows).astype(np.int64)
    return (n % 2 == 1) & (np.bincount(row, on, rows) == 0)


def _numbers(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each index as often as its size says, and the numbers from 0 within each."""
    at = np.repeat(np.arange(len(size)), size)
    return at, np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)


def _leaf_hits(x: np.ndarray, y: np.ndarray, edge: tuple[np.ndarray, ...], pair: np.ndarray) -> np.ndarray:
    """:func:`_crossed` for the blocks of places of leaves: rows of ``x`` and ``y`` meet the edge of their index, and those of a pair are one."""
    x1, y1, x2, y2 = (v[:, None] for v in edge)
    d = (x2 - x1) * (y - y1) - (y2 - y1) * (x - x1)
    starts = np.flatnonzero(np.diff(pair, prepend=-1))
    inside = np.logical_xor.reduceat(((y1 > y) != (y2 > y)) & ((d > 0) == (y2 > y1)), starts, axis=0)
    on = d == 0
    if on.any():
        on &= (y >= np.minimum(y1, y2)) & (y <= np.maximum(y1, y2)) & (x >= np.minimum(x1, x2)) & (x <= np.maximum(x1, x2))
        inside &= ~np.logical_or.reduceat(on, starts, axis=0)
    return inside


def _count_inside(spots: tuple[np.ndarray, ...], edges: tuple[np.ndarray, ...], offsets: np.ndarray, boxes: tuple[np.ndarray, ...],
                  margin: float) -> np.ndarray:
    """Points inside each zone row, down the tree of the places.

    A node no edge's bounds come near is inside or outside as its first place is; others are cut, and the places of leaves
    are tested by themselves. A node keeps the edges that its places need (:func:`zone_cells`)."""
    (px, py, weight), tree = _node_sums(*spots)
    # the places of leaves as blocks of one size; a place that is not a number is inside nothing
    pad = -len(px) % _LEAF
    bx, by, bn = (np.append(v, np.full(pad, fill)).reshape(-1, _LEAF) for v, fill in ((px, np.nan), (py, np.nan), (weight, 0)))
    lo_x, hi_x = np.minimum(edges[0], edges[2]), np.maximum(edges[0], edges[2])
    lo_y, hi_y = np.minimum(edges[1], edges[3]), np.maximum(edges[1], edges[3])
    total = np.zeros(len(offsets) - 1, np.int64)
    row, k = _numbers(np.diff(offsets))
    # pairs of a zone row and a node of a level; entries of a pair and an edge, in the pairs' order
    todo = [(0, np.arange(len(total)), np.zeros(len(total), np.int64), row, offsets[:-1][row] + k)]
    while todo:
        level, rows, nodes, pair, edge = todo.pop()
        if len(edge) > _ENTRIES and len(rows) > 1:
            half = len(rows) // 2
            cut = np.searchsorted(pair, half)
            todo += [(level, rows[:half], nodes[:half], pair[:cut], edge[:cut]), (level, rows[half:], nodes[half:], pair[cut:] - half, edge[cut:])]
            continue
        x0, y0, x1, y1, sums, first = (v[nodes] for v in tree[level])
        keep = (hi_y[edge] >= y0[pair] - margin) & (lo_y[edge] <= y1[pair] + margin) & (hi_x[edge] >= x0[pair] - margin)
        pair, edge = pair[keep], edge[keep]
        near = np.bincount(pair, lo_x[edge] <= x1[pair] + margin, len(rows)) > 0
        far = ~near[pair]
        at = pair[far]
        inside = _crossed(px[first][at], py[first][at], tuple(v[edge[far]] for v in edges), at, len(rows))
        boxed = (x0 > boxes[0][rows]) & (x1 < boxes[2][rows]) & (y0 > boxes[1][rows]) & (y1 < boxes[3][rows])
        whole = inside & boxed
        np.add.at(total, rows[whole], sums[whole])
        near |= inside & ~boxed
        # the pairs that are cut, numbered anew, with their entries
        stay = near[pair]
        pair, edge, rows, nodes = (np.cumsum(near) - 1)[pair[stay]], edge[stay], rows[near], nodes[near]
        size, leaf = np.bincount(pair, minlength=len(rows)), level == len(tree) - 1
        ends = np.cumsum(size)
        # some pairs at a time, as each gives its entries to so many children or places
        bounds = [*np.flatnonzero(np.diff(ends * (_LEAF if leaf else _FAN) // _ENTRIES, prepend=-1)), len(rows)]
        for a, b in zip(bounds, bounds[1:]):
            if leaf:
                i, j, n, r = ends[a] - size[a], ends[b - 1], nodes[a:b], rows[a:b]
                hit = _leaf_hits(bx[nodes[pair[i:j]]], by[nodes[pair[i:j]]], tuple(v[edge[i:j]] for v in edges), pair[i:j])
                lo_bx, lo_by, hi_bx, hi_by = (v[r][:, None] for v in boxes)
                hit &= (bx[n] > lo_bx) & (bx[n] < hi_bx) & (by[n] > lo_by) & (by[n] < hi_by)
                np.add.at(total, r, (hit * bn[n]).sum(axis=1))
                continue
            of, j = _numbers(np.minimum(_FAN, len(tree[level + 1][0]) - nodes[a:b] * _FAN))
            of += a
            at, k = _numbers(size[of])
            todo.append((level + 1, rows[of], nodes[of] * _FAN + j, at, edge[(ends - size)[of][at] + k]))
    return total


def _crowded_counts(lon: str, lat: str, count: str, edges: str, keep: Sequence[str], cell_deg: float):
    """Counts of the zone rows of a cell that holds many places."""

    def counts(key: tuple, places: pa.Table, rows: pa.Table) -> pa.Table:
        spots = tuple(places.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in (lon, lat, count))
        real = np.isfinite(spots[0]) & np.isfinite(spots[1])
        spots = tuple(v[real] for v in spots)
        lists = rows.column(edges).combine_chunks()
        n = np.zeros(rows.num_rows, np.int64)
        if len(spots[0]) and rows.num_rows:
            offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
            flat = tuple(c.to_numpy(zero_copy_only=False) for c in lists.flatten().flatten())
            boxes = tuple(rows.column(c).combine_chunks().to_numpy(zero_copy_only=False) for c in ("min_x", "min_y", "max_x", "max_y"))
            n = _count_inside(spots, flat, offsets, boxes, cell_deg * 2.0 ** key[0].as_py() * 1e-6)
        out = rows.select(list(keep)).append_column(count, pa.array(n, pa.int64()))
        return out.filter(pa.array(n > 0))

    return counts


def _crowds(cells: DataFrame, sizes: DataFrame, edges: str) -> DataFrame | None:
    """The cells whose places are counted down a tree, with the numbers of groups their places and zone rows are dealt into."""
    sizes = sizes.where(F.col("_places") > _PLACES)
    if sizes.isEmpty():
        return None
    per = cells.where(~F.col("_whole")).groupBy(*_AT).agg(F.sum(F.size(edges)).alias("_e"))
    many = materialize(sizes.hint("merge").join(per, list(_AT)).where(F.col("_places") * F.col("_e") > _CROWD).select(
        *_AT, F.ceil(F.col("_places") / _TREE).alias("_a"), F.ceil(F.col("_e") / _GROUP_EDGES).alias("_b"),
        (F.col("_e") * F.sqrt(F.col("_places").cast("double"))).alias("_work")))
    return None if many.isEmpty() else many


def _crowded(p: DataFrame, cells: DataFrame, many: DataFrame, lon: str, lat: str, count: str, zone_cols: Sequence[str], edges: str,
             cell_deg: float) -> DataFrame:
    """Counts of the zone rows with an edge in the cells of ``many``; both sides are dealt into groups of bounded size."""
    rows = cells.where(~F.col("_whole"))
    work = many.agg(F.sum("_work")).first()[0] or 0.0
    parts = int(min(max(p.sparkSession.sparkContext.defaultParallelism, math.ceil(work / _WORK)), _MAX_TASKS))
    many = many.drop("_work")
    share = lambda key, n: F.pmod(F.xxhash64(*key), F.col(n))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    names = [F.col(f"`{c}`") for c in zone_cols]
    keys = [*_AT, "_p", "_z"]
    # what a join takes a table for by estimates says little of its size: neither side is broadcast
    places = p.hint("merge").join(many, list(_AT)).withColumn("_p", share([lon, lat], "_a")).withColumn("_z", every("_b")).select(*keys, lon, lat, count)
    rows = rows.hint("merge").join(many, list(_AT)).withColumn("_z", share(names, "_b")).withColumn("_p", every("_a"))
    rows = rows.select(*keys, *names, "min_x", "min_y", "max_x", "max_y", edges)
    schema = rows.select(*names).schema.add(count, "long")
    two = [d.repartition(parts, *keys).groupBy(*keys) for d in (places, rows)]
    return two[0].cogroup(two[1]).applyInArrow(_crowded_counts(lon, lat, count, edges, list(zone_cols), cell_deg), schema)


def points_in_zones(
    points: DataFrame,
    zones: DataFrame,
    lon: str,
    lat: str,
    zone_cols: Sequence[str],
    edges_col: str = "edges",
    cell_deg: float | None = None,
    max_cells: int = 36,
    broadcast_max_bytes: int = 256 << 20,
    engine: str = "native",
    skew_sample: float = 0.01,
    count_col: str | None = None,
) -> DataFrame:
    """Inner spatial join: every (point, zone) with the point strictly within.

    ``zones`` needs ``edges`` and ``min_x, min_y, max_x, max_y`` columns (see
    :func:`cityscan.sources.geojson.features_to_zones`). Output: all point
    columns plus ``zone_cols``. Zones without edges hold no point. The zone side
    is broadcast when its cell table, estimated by one aggregate over the zone
    dimension, fits ``broadcast_max_bytes``; then the points are not touched when the plan is built
    and keep their partitions. Otherwise both sides shuffle on the cell, in as many tasks as the pairs in the cells take,
    and cells that a ``skew_sample`` of the points finds heavy are salted (a pass over the points' coordinates).
    ``engine="arrow"`` tests the edges of whole batches as arrays in Python workers instead of row by row.

    With ``count_col`` the points are counted, not listed: the output is ``zone_cols`` and numbers whose sums are the zones' numbers of
    points (a zone without a point has no row). The cell table is written, and the points' cells are counted, when the plan is built.
    Points at one place are tested once. ``engine`` tests the places of a cell on an edge; where these are many pairs
    (``_PLACES``, ``_CROWD``), the places are counted down a tree in Python workers.
    """
    if engine not in ("native", "arrow"):
        raise ValueError(f"engine must be 'native' or 'arrow', not {engine!r}")
    zones = zones.where(F.size(edges_col) > 0)
    plan = grid_plan(zones, cell_deg, max_cells, edges_col, zone_cols)
    cell_deg, levels = plan["cell_deg"], plan["levels"]
    cells = zone_cells(zones, cell_deg, max_cells, [*zone_cols, edges_col], edges_col=edges_col)
    pcols, out_cols, at = points.columns, [*points.columns, *zone_cols], list(_AT)
    p = points.where(F.col(lon).isNotNull() & F.col(lat).isNotNull())
    crowded = None
    if count_col is not None:
        pcols, out_cols = [lon, lat, count_col], [*zone_cols, count_col]
        p = p.groupBy(F.col(lon).cast("double").alias(lon), F.col(lat).cast("double").alias(lat)).agg(F.count(F.lit(1)).alias(count_col))
    p = p.withColumn("_cell", F.explode(_cell_of(cell_deg, lon, lat, levels))).select(*pcols, "_cell.*")
    if count_col is not None:
        sizes = p.groupBy(*at).agg(F.count(F.lit(1)).alias("_places"), F.sum(count_col).alias("_sum"))
        cells = materialize(cells)
        many = _crowds(cells, sizes, edges_col)
        if many is not None:
            crowded = _crowded(p, cells, many, lon, lat, count_col, zone_cols, edges_col, cell_deg)
            p = p.hint("merge").join(many.select(*at), at, "left_anti")
        # a cell inside a zone meets the cell's sum, one on its edge the places of the cell
        none = F.lit(None).cast("double")
        sums = sizes.select(none.alias(lon), none.alias(lat), F.col("_sum").alias(count_col), *at, F.lit(True).alias("_whole"))
        p, at = p.select(*pcols, *at, F.lit(False).alias("_whole")).unionByName(sums), [*at, "_whole"]
        skew_sample = 1.0
    if plan["bytes"] <= broadcast_max_bytes:
        if count_col is not None:  # few bytes may be many pairs, and would be put together into one task
            p = p.repartition(4 * p.sparkSession.sparkContext.defaultParallelism, *at, lon, lat)
        j = p.join(F.broadcast(cells), at)
    else:
        p, cells, at = _salted(p, cells, pcols, skew_sample, at)
        j = p.join(cells.hint("merge"), at)
    x, y = F.col(lon), F.col(lat)
    in_box = (x > F.col("min_x")) & (x < F.col("max_x")) & (y > F.col("min_y")) & (y < F.col("max_y"))
    if engine == "native":
        j = j.where(F.when(F.col("_whole"), F.lit(True)).when(in_box, point_in_polygon(x, y, F.col(edges_col))).otherwise(F.lit(False)))
        hits = j.select(*out_cols)
    else:
        out = j.select(*out_cols)
        j = j.where(F.col("_whole") | in_box).select(*out_cols, x.cast("double").alias("_x"), y.cast("double").alias("_y"), F.col(edges_col).alias("_e"), "_whole")
        hits = j.mapInArrow(_within_batches("_x", "_y", "_e", out.columns), out.schema)
    return hits if crowded is None else hits.unionByName(crowded)
