"""P4: nearest site per point by great-circle distance, and the load per site.

Exact, without an all-pairs join of points and sites and without a second look.
Points and sites are unit vectors, so poles and the antimeridian are places like any
other. The cube around the globe is cut into cells, each in eight while more than a few
sites can be the nearest one of some point inside: fine cells where sites crowd,
coarse ones elsewhere. A site cannot be the nearest in a cell if another one is nearer in
all of it, that is, if the whole cell lies on the other one's side of the plane between
them. What is left is the cell's list. Cells do not overlap, so a point meets exactly
one list, by an equi-join on the cell, and its nearest site is on it.

Sites at one position count as one (the first in tie order). While a cell has many
candidates they are rows of a table and are ruled out by grouped maxima and a join; a cell with
at most ``_BLOCK`` of them is finished in one task.

The result is the same however many sites there are; the measured size of the lists only
decides whether they are broadcast or shuffled.

Ties in distance go to the smaller site key (NULL first), then to the smaller
site attributes. The winner's own attributes are returned, so keys may repeat or
be NULL. With ``id_cols`` the result has one row per id (the closest of that id's
rows, NULL ids forming one group); without, one row per point.
"""

from __future__ import annotations

import sys
import warnings
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityscan.functions.geo import EARTH_RADIUS_M
from cityscan.session import materialize

# Functions that run in Python workers are pickled by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A cell with at most so many candidates is not cut further.
_LEAF = 24
#: A cell with at most so many candidates is finished in one task.
_BLOCK = 4096
#: Cells are cut no further once the cuts list a site so many times, on average, those of the cells of a few levels aside.
_REPEAT = 256
_COARSE = 4
#: But a longer list is always cut.
_LONG = 16 * _LEAF
#: So many of its candidates, on average, say how a cell with more than ``_BLOCK`` is cut.
_PIVOTS = 4096
#: ``method="array"`` compares with at most so many sites: above, its work would grow with points times sites.
_ARRAY = 1024
#: The finest cells: 2 / 2**21 of the globe's radius, some six metres.
_MAX_LEVEL = 21
#: A site is ruled out only if it is farther by more than rounding could hide (dot products of unit vectors).
_MARGIN = 2e-14
#: Cells are taken a little larger than they are, for points that rounding puts on a border.
_GROW = 1e-14


def site_frame(sites, site_lon, site_lat, site_key, site_cols):
    """Sites with usable coordinates; ``_site`` holds what is compared and returned, in tie order."""
    x, y = F.col(site_lon), F.col(site_lat)
    ok = x.between(-180.0, 180.0) & y.between(-90.0, 90.0)  # also drops NULL and NaN
    st = sites.where(ok).select(
        x.alias("_slon"), y.alias("_slat"),
        F.struct(F.col(site_key).alias("k"), *[F.col(c).alias(f"c{i}") for i, c in enumerate(site_cols)]).alias("_site"))
    return st.withColumns(_trig("_slon", "_slat", "_s"))


def _trig(lon: str, lat: str, prefix: str) -> dict[str, Column]:
    """Radians and cos(latitude), computed once per row in generated code so
    the per-candidate lambda only does the remaining haversine arithmetic."""
    phi = F.radians(F.col(lat))
    return {f"{prefix}phi": phi, f"{prefix}lam": F.radians(F.col(lon)), f"{prefix}cphi": F.cos(phi)}


def _hav_term(s: Column) -> Column:
    """Haversine term ``a`` between the row's point (_pphi, _plam, _pcphi) and
    candidate ``s``; distance is increasing in ``a``, so candidates are
    ranked by it and the distance is computed once, for the winner."""
    return (F.pow(F.sin((s["_sphi"] - F.col("_pphi")) * 0.5), 2)
            + F.col("_pcphi") * s["_scphi"] * F.pow(F.sin((s["_slam"] - F.col("_plam")) * 0.5), 2))


def _km_from_term(a: Column, radius_m: float) -> Column:
    return F.asin(F.least(F.sqrt(a), F.lit(1.0))) * F.lit(2 * radius_m / 1000.0)


def _best_of(candidates: Column) -> Column:
    """The closest entry of a candidate list as struct(_a, site)."""
    return F.array_min(F.transform(candidates, lambda s: F.struct(_hav_term(s).alias("_a"), s["_site"].alias("_site"))))


def _entry() -> Column:
    return F.struct("_sphi", "_slam", "_scphi", "_site")


def _finish(best: DataFrame, id_cols, site_key, site_cols, radius_m, dist_col) -> DataFrame:
    """``_best`` = struct(_a, site) to id columns, key, site columns, distance, n_points."""
    if id_cols:
        best = best.groupBy(*id_cols).agg(F.min("_best").alias("_best"))
    return best.select(
        *(id_cols or []),
        F.col("_best._site.k").alias(site_key),
        *[F.col(f"_best._site.c{i}").alias(c) for i, c in enumerate(site_cols)],
        _km_from_term(F.col("_best._a"), radius_m).alias(dist_col),
        F.lit(1).cast("long").alias("n_points"),
    )


def nearest_site(
    points: DataFrame,
    sites: DataFrame,
    point_lon: str,
    point_lat: str,
    site_lon: str,
    site_lat: str,
    site_key: str,
    site_cols: Sequence[str] = (),
    id_cols: Sequence[str] | None = None,
    method: str = "auto",
    broadcast_sites: int = 100_000,
    cell_deg: float | None = None,
    radius_m: float = EARTH_RADIUS_M,
    dist_col: str = "distance_km",
    broadcast_max_bytes: int = 256 << 20,
) -> DataFrame:
    """Closest site for each point (or each id).

    ``method="auto"`` or ``"grid"`` uses the cells (:func:`site_cells`). ``"array"`` compares every point
    with every site of a short list (a city's stations); above 1024 sites (or
    ``broadcast_sites``, if fewer) it warns and uses the cells, whose lists are short again. The cells are made when the plan is
    built; the points are not touched. Their lists are broadcast if there are at most
    ``broadcast_sites`` sites and the lists' bytes fit ``broadcast_max_bytes``, else
    points and lists are shuffled by cell (AQE splits a hot cell on the point side).

    Points with a NULL or NaN coordinate are skipped, as are sites without a valid one;
    filter zero coordinates beforehand (:func:`cityscan.functions.valid_coords`).
    Output: ``id_cols``, ``site_key``, ``site_cols``, ``dist_col`` (km) and
    ``n_points`` (1: how many input rows the row stands for).
    """
    if method not in ("auto", "array", "grid"):
        raise ValueError(f"method must be 'auto', 'array' or 'grid', not {method!r}")
    site_cols = [c for c in site_cols if c != site_key]
    st = site_frame(sites, site_lon, site_lat, site_key, site_cols)
    n_sites = st.count()
    keep = list(id_cols or [])
    usable = F.col(point_lon).isNotNull() & F.col(point_lat).isNotNull() & ~F.isnan(point_lon) & ~F.isnan(point_lat)
    pts = points.where(usable).select(*keep, F.col(point_lon).alias("_lon"), F.col(point_lat).alias("_lat"))
    if n_sites == 0:
        best = pts.select(*keep, F.lit(None).cast(_best_type(st)).alias("_best")).where(F.lit(False))
    elif method == "array" and n_sites <= min(broadcast_sites, _ARRAY):
        best = _by_array(pts, st, keep)
    else:
        if method == "array":
            warnings.warn(f"{n_sites} sites exceed {min(broadcast_sites, _ARRAY)}; the grid is used", stacklevel=2)
        cells = site_cells(st, cell_deg, n_sites)
        levels, size = list_facts(cells)
        best = _by_cells(pts, cells, keep, n_sites <= broadcast_sites and size <= broadcast_max_bytes, levels)
    return _finish(best, id_cols, site_key, site_cols, radius_m, dist_col)


def _best_type(st: DataFrame) -> str:
    return f"struct<_a:double,_site:{st.schema['_site'].dataType.simpleString()}>"


def _site_list(st: DataFrame) -> DataFrame:
    """All sites as one list in one row (callers check the number of sites first)."""
    return st.agg(F.collect_list(_entry()).alias("_sites"))


def _by_array(pts: DataFrame, st: DataFrame, keep: list[str]) -> DataFrame:
    # attaches the one-row site list to every point; emits no point x site rows
    p = pts.withColumns(_trig("_lon", "_lat", "_p")).join(F.broadcast(_site_list(st)), F.lit(True), "left")
    # Every point has a best site, so no NULL filter is needed: one would be
    # pushed into the join condition and evaluate the minimum twice.
    return p.select(*keep, _best_of(F.col("_sites")).alias("_best"))


# ---------------------------------------------------------------- cells


def _unit(phi: str, lam: str, cphi: str) -> list[Column]:
    return [F.col(cphi) * F.cos(F.col(lam)), F.col(cphi) * F.sin(F.col(lam)), F.sin(F.col(phi))]


#: The key of the cell of a point (_x, _y, _z), each -1 to 1, among those of ``_level``: its places on the axes, side by side.
PLACE_SQL = " | ".join(
    f"shiftleft(greatest(least(floor((_{axis} + 1.0D) * (pow(2.0D, _level) / 2.0D)), shiftleft(1L, _level) - 1L), 0L), {shift})"
    for axis, shift in (("x", 2 * _MAX_LEVEL), ("y", _MAX_LEVEL), ("z", 0)))


def _corners() -> list[tuple[int, int, int]]:
    return [(0, 0, 0), *[(a, b, c) for a in (-1, 1) for b in (-1, 1) for c in (-1, 1)]]


def _cut(rows: DataFrame, large: DataFrame, deepest: int) -> DataFrame:
    """One cut: rows (level, ix, iy, iz, x, y, z, _entry) of the ``large`` cells (with ``_n`` candidates) to those of finer cells.

    Some ``_PIVOTS`` candidates of a cell, taken by hash, stand for all of them: they say how finely it is cut, and
    a candidate goes where the whole finer cell is nearer to one of them. So a cell's candidates need not
    meet: they are dealt over tasks of some ``_BLOCK`` each, to which the pivots are repeated.
    """
    at = ["level", "ix", "iy", "iz"]
    chunks = F.ceil(F.col("_n") / F.lit(_BLOCK)).cast("long")
    rows = rows.join(large, at).withColumn("_h", F.xxhash64("level", "x", "y", "z"))
    # the hash deals twice: its low part the pivots, its high part the tasks
    pivots = rows.where(F.pmod("_h", F.lit(1 << 20)) * F.col("_n") < F.lit(_PIVOTS << 20)).select(
        *[F.col(n).alias(f"p_{n}") for n in (*at, "x", "y", "z")], F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("p_chunk"))
    entry = rows.schema["_entry"].dataType.simpleString()
    rows = rows.select(*at, F.pmod(F.shiftright("_h", 20), chunks).alias("_chunk"), "_n", "x", "y", "z", "_entry")

    def cut(table: pa.Table, picked: pa.Table) -> pa.Table:
        out = {n: [] for n in at}
        taken = []
        if table.num_rows:
            first = {n: table.column(n)[0].as_py() for n in [*at, "_n"]}
            v = np.column_stack([table.column(n).to_numpy() for n in "xyz"])
            r = np.column_stack([picked.column(f"p_{n}").to_numpy() for n in "xyz"])
            enough = max(_LEAF, _BLOCK * len(r) // (2 * first["_n"]))
            for level, cell, ids in _split_cell(first["level"], (first["ix"], first["iy"], first["iz"]), v, r, enough, deepest):
                taken.append(ids)
                for n, value in zip(at, (level, *cell)):
                    out[n].append(np.full(len(ids), value))
        ids = np.concatenate([*taken, np.zeros(0, np.int64)])
        cells = [pa.array(np.concatenate([*out[n], np.zeros(0)]).astype(np.int64)) for n in at]
        cells[0] = cells[0].cast(pa.int32())
        rest = [table.column(n).combine_chunks().take(pa.array(ids)) for n in ("x", "y", "z", "_entry")]
        return pa.table([*cells, *rest], [*at, "x", "y", "z", "_entry"])

    schema = f"level int, ix long, iy long, iz long, x double, y double, z double, _entry {entry}"
    return rows.groupBy(*at, "_chunk").cogroup(pivots.groupBy(*[f"p_{n}" for n in at], "p_chunk")).applyInArrow(cut, schema)


def _not_beaten(c: np.ndarray, rivals: np.ndarray, centre: np.ndarray, wide: float) -> np.ndarray:
    """Which of the sites ``c`` have a place in the cell where no rival is nearer, as far as two rivals at a time can tell.

    Where a place between two rivals is nearer than a site, so is one of the two. So a site behind the line
    between them goes, though neither beats it in all of the cell; the place taken is that nearest the site.
    """
    left = np.arange(len(c))
    for r in rivals:
        d = r - c[left]
        left = left[~(d @ centre - wide * np.abs(d).sum(axis=1) > _MARGIN)]
    for i, j in [(i, j) for i in range(len(rivals)) for j in range(i)]:
        if len(left) <= _LEAF:
            break
        s, side = c[left], rivals[j] - rivals[i]
        part = np.clip(((s - rivals[i]) @ side) / max(side @ side, 1e-300), 0.0, 1.0)
        d = rivals[i] + part[:, None] * side - s
        left = left[~(d @ centre - wide * np.abs(d).sum(axis=1) > _MARGIN)]
    return left


def _split_cell(level: int, cell: tuple[int, int, int], v: np.ndarray, pivots: np.ndarray | None, enough: int,
                deepest: int) -> Iterator[tuple[int, tuple[int, int, int], np.ndarray]]:
    """(level, cell, candidates) of the cells inside one cell in which at most ``enough`` pivots can be the nearest of
    all pivots; the candidates are those of ``v`` that no pivot beats.

    Without ``pivots``, ``v`` are the pivots, else at least one level is cut. Where many sites lie in line, each is, as
    seen from far away, the nearest in a strip, and ever finer cells would list the same sites over and over. So a cell
    is cut no further once the cuts that led to it have, on average, listed each site ``_REPEAT`` times and its list is not long.
    """
    corners = np.array(_corners(), float)
    eight = [(a, b, e) for a in (0, 1) for b in (0, 1) for e in (0, 1)]

    def prune(level, cell, picked, ids):
        half = 2.0 ** -level
        centre = (np.array(cell) * 2 + 1) * half - 1.0
        wide = half + _GROW
        away = np.maximum(np.abs(centre) - wide, 0.0)
        if (away * away).sum() > 1.0 + 1e-12 or ((np.abs(centre) + wide) ** 2).sum() < 1.0 - 1e-12:
            return None  # the globe does not pass here
        if len(picked):
            c = points[picked]
            rivals = c[np.unique((c @ (centre + corners * wide).T).argmax(axis=0))]
            picked = picked[_not_beaten(c, rivals, centre, wide)]
            ids = picked if pivots is None else ids[_not_beaten(v[ids], rivals, centre, wide)]
        return level, cell, picked, ids

    points = v if pivots is None else pivots
    todo = [(1.0, prune(level, cell, np.arange(len(points)), np.arange(len(v))))]
    while todo:
        times, (at, cell, picked, ids) = todo.pop()
        if (len(picked) <= (enough if times <= _REPEAT else max(enough, _LONG)) or at >= deepest) and (pivots is None or at > level):
            if len(ids):
                yield at, cell, ids
            continue
        parts = [prune(at + 1, (2 * cell[0] + a, 2 * cell[1] + b, 2 * cell[2] + e), picked, ids) for a, b, e in eight]
        parts = [p for p in parts if p]
        if at >= _COARSE:
            times *= sum(len(p[2]) for p in parts) / max(len(picked), 1)
        todo += [(times, p) for p in parts]


def site_cells(sites: DataFrame, cell_deg: float | None = None, n_sites: int | None = None) -> DataFrame:
    """Sites (:func:`site_frame`) to the cells of the globe: (_level, _key, _list of the sites that can be nearest there).

    Written to the shared checkpoint folder. ``cell_deg``: the size below which cells are not cut. ``n_sites``, if
    known, saves looking for cells with many candidates where there cannot be any.
    """
    deepest = _MAX_LEVEL
    if cell_deg:
        deepest = int(np.clip(np.ceil(np.log2(2.0 / np.radians(cell_deg))), 0, _MAX_LEVEL))
    one = sites.groupBy("_slon", "_slat").agg(F.min("_site").alias("_site")).withColumns(_trig("_slon", "_slat", "_s"))
    x, y, z = _unit("_sphi", "_slam", "_scphi")
    zero = F.lit(0).cast("long")
    rows = one.select(F.lit(0).alias("level"), zero.alias("ix"), zero.alias("iy"), zero.alias("iz"), x.alias("x"), y.alias("y"), z.alias("z"),
                      _entry().alias("_entry"))
    at = ["level", "ix", "iy", "iz"]
    small = rows if n_sites is not None and n_sites <= _BLOCK else None
    rows = rows if small is not None else materialize(rows)
    while small is not rows:
        # cells with many candidates are cut by many tasks, those with few go on to a task each
        sizes = rows.groupBy(*at).agg(F.count(F.lit(1)).alias("_n"))
        large = materialize(sizes.where((F.col("_n") > _BLOCK) & (F.col("level") < deepest)))
        if large.isEmpty():
            small = rows if small is None else small.unionByName(rows)
            break
        done = rows.join(large, at, "left_anti")
        small = done if small is None else small.unionByName(done)
        rows = materialize(_cut(rows, large, deepest))
    entry = rows.schema["_entry"].dataType.simpleString()

    def finish(table: pa.Table) -> pa.Table:
        first = {n: table.column(n)[0].as_py() for n in at}
        v = np.column_stack([table.column(n).to_numpy() for n in "xyz"])
        cells = list(_split_cell(first["level"], (first["ix"], first["iy"], first["iz"]), v, None, _LEAF, deepest))
        sizes = np.cumsum([0, *[len(ids) for _, _, ids in cells]])
        entries = table.column("_entry").combine_chunks().take(pa.array(np.concatenate([ids for _, _, ids in cells])))
        lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), entries)
        return pa.table([pa.array([c[0] for c in cells], pa.int32()), pa.array([x << 2 * _MAX_LEVEL | y << _MAX_LEVEL | z for _, (x, y, z), _ in cells], pa.int64()), lists], ["_level", "_key", "_list"])

    return materialize(small.groupBy(*at).applyInArrow(finish, f"_level int, _key long, _list array<{entry}>"))


def list_facts(cells: DataFrame) -> tuple[list[int], int]:
    """The levels in use, and an estimate of the lists' bytes."""
    text = F.octet_length(F.to_json(F.element_at("_list", 1)["_site"]))
    r = cells.agg(F.collect_set("_level"), F.sum(F.size("_list") * (F.lit(64) + text))).first()
    return sorted(r[0] or []), int(r[1] or 0)


def _by_cells(pts: DataFrame, cells: DataFrame, keep: list[str], broadcast: bool, levels: list[int]) -> DataFrame:
    """Each point joined to its cell's list: one key a level in use, of which one has a cell."""
    p = pts.withColumns(_trig("_lon", "_lat", "_p"))
    p = p.withColumns(dict(zip(("_x", "_y", "_z"), _unit("_pphi", "_plam", "_pcphi"))))
    p = p.select(*keep, "_pphi", "_plam", "_pcphi", "_x", "_y", "_z", F.explode(F.lit(levels)).alias("_level"))
    p = p.select(*keep, "_pphi", "_plam", "_pcphi", "_level", F.expr(PLACE_SQL).alias("_key"))
    found = p.join(F.broadcast(cells) if broadcast else cells.hint("merge"), ["_level", "_key"])
    return found.select(*keep, _best_of(F.col("_list")).alias("_best"))


def site_load(
    nearest: DataFrame,
    group_cols: Sequence[str],
    dist_col: str = "distance_km",
    avg_col: str = "average_distance",
    count_col: str = "number_of_points",
    top: int | None = None,
) -> DataFrame:
    """Per site: mean distance and number of points assigned, busiest first.

    ``top`` keeps only the busiest sites (a report; planned as a top-k
    without a full sort); by default every site is returned.
    """
    w = F.col("n_points")
    out = (
        nearest.groupBy(*group_cols)
        .agg(
            F.sum(F.col(dist_col) * w).alias("_sd"),
            F.sum(w).alias(count_col),
        )
        .select(*group_cols, (F.col("_sd") / F.col(count_col)).alias(avg_col), count_col)
        .orderBy(F.desc(count_col), *[F.asc(c) for c in group_cols])
    )
    return out.limit(top) if top is not None else out
