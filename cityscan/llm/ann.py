"""Nearest neighbours by inner product along several shifted Hilbert curves.

Largest inner product becomes smallest distance by one more dimension,
sqrt(M^2 - |x|^2), M being the largest norm; a query has 0 there. Each curve projects
the vectors at random onto a few dimensions, shifts them, and orders them by their
place on a Hilbert curve. The order is cut into blocks of equal size. A query meets
the vectors in the blocks around its own, on every curve; these are ranked by
exact inner product, and the best of all curves are merged and scored again.

How many blocks around is fitted: for a bounded sample of queries the true
neighbours are found by comparing them with every row, and the smallest window is
taken that holds the target share of them on one curve at least. Clustered
vectors need a block or two; vectors without structure need a large part of each
curve, as no order of them keeps neighbours together.

Equal vectors are one point, so a vector that a third of all rows share is one row of
the index; its smallest ids are given back at the end.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityscan.llm.common import checked_broadcast, shared_table

#: The curve's dimensions and bits of each (40 bits a key, so that 12 are left to part equal keys).
DIMS, BITS = 8, 5
#: About so many queries meet a block in one group.
_ASKED = 4096


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places on the Hilbert curve of the rows of ``cells`` (whole numbers below 2^bits).

    Gray-code construction: from the highest bit down, the lower bits of the first
    axis are inverted or exchanged with another axis's, then the axes' bits are interleaved.
    """
    x = cells.astype(np.uint64).T.copy()
    one = np.uint64(1)
    for q in range(bits - 1, 0, -1):
        low = (one << np.uint64(q)) - one
        for i in range(len(x)):
            on = (x[i] >> np.uint64(q)) & one == 1
            swap = (x[0] ^ x[i]) & low
            x[0], x[i] = (np.where(on, x[0] ^ low, x[0] ^ swap), np.where(on, x[i], x[i] ^ swap)) if i else (
                np.where(on, x[0] ^ low, x[0]), np.where(on, x[0] ^ low, x[0]))
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    flip = np.zeros(x.shape[1], np.uint64)
    for q in range(bits - 1, 0, -1):
        flip ^= np.where((x[-1] >> np.uint64(q)) & one == 1, (one << np.uint64(q)) - one, np.uint64(0))
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for q in range(bits - 1, -1, -1):
        for axis in x:
            key = (key << one) | ((axis >> np.uint64(q)) & one)
    return key


class Curves:
    """``count`` seeded projections and shifts for vectors of ``dim`` numbers and largest norm ``norm``."""

    def __init__(self, count: int, dim: int, norm: float, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.norm, self.scale = norm, np.sqrt(dim + 1) / norm
        self.axes = rng.standard_normal((count, dim + 1, DIMS)) / np.sqrt(dim + 1)
        self.shift = rng.random((count, DIMS))

    def keys(self, vectors: np.ndarray, queries: bool) -> np.ndarray:
        """A row a curve: keys as whole numbers in doubles. Queries are scaled to the largest norm."""
        length = np.linalg.norm(vectors, axis=1)
        if queries:
            vectors = vectors * (self.norm / length)[:, None]
            more = np.zeros(len(vectors))
        else:
            more = np.sqrt(np.maximum(0.0, self.norm**2 - length**2))
        points = np.column_stack((vectors, more)) * self.scale
        out = []
        for axes, shift in zip(self.axes, self.shift):
            unit = 0.5 + 0.5 * np.tanh(0.8 * points @ axes)  # near uniform for near normal values
            cells = np.minimum(((unit + shift) / 2 * (1 << BITS)).astype(np.int64), (1 << BITS) - 1)
            out.append(hilbert(cells).astype(float))
        return np.array(out)


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy().reshape(len(flat), -1).astype(float) if len(flat) else np.zeros((0, 1))


def _keyed(curves: Curves, queries: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            rep = b.column("rep").to_numpy()
            part = (rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(52)).astype(float) / 4096
            for c, key in enumerate(curves.keys(_matrix(b.column("vec")), queries)):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(rep), c, np.int32)), b.column("rep"), pa.array(key + part)],
                    names=["curve", "rep", "key"])

    return run


def _best(scores: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of the ``k`` largest of each row, in no order; of equal scores the first columns.

    Scores that differ by rounding only count as equal here; the final order has exact ones.
    """
    if scores.shape[1] <= k:
        return np.tile(np.arange(scores.shape[1]), (len(scores), 1))
    least = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
    near = 1e-12 * np.maximum(1.0, np.abs(least))
    above, equal = scores > least + near, np.abs(scores - least) <= near
    room = k - above.sum(axis=1, keepdims=True)
    return np.nonzero(above | (equal & (np.cumsum(equal, axis=1) <= room)))[1].reshape(len(scores), k)


def _packed(q: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> pa.Table:
    """The ``k`` best of each query; ``ids`` ascend, so that ties go to the smaller id."""
    at = _best(scores, k)
    return pa.table({"q": pa.array(q, pa.int64()), "ids": pa.array(list(ids[at]), pa.list_(pa.int64())),
                     "scores": pa.array(list(np.take_along_axis(scores, at, 1)), pa.list_(pa.float64()))})


_FOUND = "q long, ids array<long>, scores array<double>"


def _exhaustive(q: np.ndarray, vectors: np.ndarray, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                b = b.sort_by("rep")
                yield from _packed(q, b.column("rep").to_numpy(), vectors @ _matrix(b.column("vec")).T, k).to_batches()

    return run


def _block(k: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        asks = table.column("asks").combine_chunks()
        have, want = table.filter(pa.compute.invert(asks)).sort_by("rep"), table.filter(asks)
        if not len(have) or not len(want):
            return _packed(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, 0)), k)
        x, ids = _matrix(have.column("vec")), have.column("rep").to_numpy()
        parts, q, v = [], want.column("rep").to_numpy(), _matrix(want.column("vec"))
        for i in range(0, len(q), 1024):
            parts.append(_packed(q[i:i + 1024], ids, v[i:i + 1024] @ x.T, k))
        return pa.concat_tables(parts)

    return run


def _merge(k: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        ids = table.column("ids").combine_chunks().flatten().to_numpy()
        scores = table.column("scores").combine_chunks().flatten().to_numpy()
        order = np.lexsort((ids, -scores))
        ids = ids[order]
        _, first = np.unique(ids, return_index=True)
        ids = ids[np.sort(first)[:k]]
        return pa.table({"q": pa.array(np.full(len(ids), key[0].as_py()), pa.int64()), "id": pa.array(ids, pa.int64())})

    return run


def _fit_window(points: DataFrame, queries: DataFrame, blocks: DataFrame, asked: DataFrame, n_blocks: int, k: int,
                sample: int, target: float) -> int:
    """The smallest window, in blocks, that holds ``target`` of the sample's true neighbours."""
    rows = queries.orderBy(F.xxhash64("rep"), "rep").limit(sample).collect()
    if not rows:
        return 0
    q, v = np.array([r["rep"] for r in rows]), np.array([r["vec"] for r in rows], float)
    true = (points.mapInArrow(_exhaustive(q, v, k), _FOUND).groupBy("q").applyInArrow(_merge(k), "q long, id long").collect())
    spark = points.sparkSession
    pairs = F.broadcast(spark.createDataFrame([(r["q"], r["id"]) for r in true], "q long, rep long"))
    there = blocks.select("curve", "rep", "block").join(pairs, "rep")
    here = asked.select("curve", F.col("rep").alias("q"), F.col("block").alias("own"))
    gaps = (there.join(here.join(F.broadcast(spark.createDataFrame([(int(x),) for x in q], "q long")), "q"), ["curve", "q"])
            .groupBy("q", "rep").agg(F.min(F.abs(F.col("block") - F.col("own"))).alias("gap")).collect())
    gaps = np.sort([r["gap"] for r in gaps])
    return min(n_blocks - 1, int(gaps[min(len(gaps) - 1, int(np.ceil(target * len(gaps))) - 1)]))


def nearest(vectors: DataFrame, is_query, key: str = "vec_id", vector: str = "embedding", k: int = 20,
            curves: int = 6, block_rows: int = 1024, sample: int = 64, target: float = 0.96) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest rows found for each row that ``is_query(key)``.

    Candidates are all rows but the query's own; nearest is the largest inner product, ties
    go to the smaller id; with fewer candidates all are given. Rows whose id is null
    or whose vector is null, zero, of another length than most, or holds null
    or non-finite numbers take no part. Of rows that share an id, the one with
    the smallest vector counts. No usable rows give no result.
    """
    v = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vec"))
    odd = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    v = v.where(F.col("id").isNotNull() & F.col("vec").isNotNull() & ~F.coalesce(odd, F.lit(True))
                & F.exists("vec", lambda x: x != 0))
    length = v.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").first()
    dim = length["d"] if length else 1
    v = shared_table(v.where(F.size("vec") == dim).groupBy("id").agg(F.min("vec").alias("vec")), "ann-vectors")

    points = shared_table(v.groupBy("vec").agg(F.min("id").alias("rep")), "ann-points")
    order = Window.partitionBy("rep").orderBy("id")
    members = v.join(points, "vec").select("rep", "id")
    copies = shared_table(members.withColumn("r", F.row_number().over(order)).where(F.col("r") <= k + 1).drop("r"), "ann-copies")
    queries = shared_table(members.where(is_query(F.col("id"))), "ann-queries")
    asked_points = points.join(queries.select("rep").distinct(), "rep", "left_semi")

    stats = points.agg(F.count(F.lit(1)).alias("n"), F.max(F.aggregate(
        "vec", F.lit(0.0), lambda a, x: a + x * x)).alias("m")).first()
    n_blocks = max(1, stats["n"] // block_rows)
    lines = Curves(curves, dim, float(np.sqrt(stats["m"] or 1.0)))
    schema = "curve int, rep long, key double"
    keys = shared_table(points.mapInArrow(_keyed(lines, False), schema), "ann-keys")
    probs = [i / n_blocks for i in range(1, n_blocks)] or [0.5]
    cuts = {r["curve"]: r["cuts"] for r in keys.groupBy("curve").agg(
        F.percentile_approx("key", F.array(*map(F.lit, probs)) if len(probs) < 2 else F.lit(probs),
                            F.lit(max(10_000, 20 * n_blocks))).alias("cuts")).collect()}

    def in_blocks(df):
        def run(batches):
            for b in batches:
                c, x = b.column("curve").to_numpy(), b.column("key").to_numpy()
                block = np.zeros(len(c), np.int32)
                for i in np.unique(c):
                    if n_blocks > 1:
                        block[c == i] = np.searchsorted(cuts[i], x[c == i], side="left")
                yield pa.RecordBatch.from_arrays([b.column("curve"), b.column("rep"), pa.array(block)],
                                                 names=["curve", "rep", "block"])
        return shared_table(df.mapInArrow(run, "curve int, rep long, block int"), "ann-blocks")

    blocks = in_blocks(keys)
    asked = in_blocks(asked_points.mapInArrow(_keyed(lines, True), schema))
    window = _fit_window(points, asked_points, blocks, asked, n_blocks, k, sample, target)

    have = blocks.join(points, "rep").select("curve", "block", "rep", "vec", F.lit(False).alias("asks"))
    want = asked.withColumn("block", F.explode(F.sequence(
        F.greatest(F.lit(0), F.col("block") - window), F.least(F.lit(n_blocks - 1), F.col("block") + window))))
    want = want.join(checked_broadcast(shared_table(asked_points, "ann-asked")), "rep").select(
        "curve", "block", "rep", "vec", F.lit(True).alias("asks"))
    # a block's queries are dealt into groups of some _ASKED each, the block's points to every one of them
    asks = shared_table(want.groupBy("curve", "block").agg(F.ceil(F.count(F.lit(1)) / _ASKED).cast("int").alias("groups")), "ann-groups")
    want = want.join(checked_broadcast(asks), ["curve", "block"]).withColumn("group", F.pmod(F.xxhash64("rep"), "groups").cast("int")).drop("groups")
    have = have.join(checked_broadcast(asks), ["curve", "block"]).withColumn(
        "group", F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")
    near = (have.unionByName(want).groupBy("curve", "block", "group").applyInArrow(_block(k + 1), _FOUND)
            .groupBy("q").applyInArrow(_merge(k + 4), "q long, id long"))

    # exact scores of the merged candidates, then copies and the order with ties
    p = points.withColumnRenamed("rep", "id").withColumnRenamed("vec", "x")
    s = near.join(p, "id").join(points.select(F.col("rep").alias("q"), F.col("vec").alias("y")), "q")
    s = s.select("q", F.col("id").alias("rep"), F.aggregate(
        F.zip_with("x", "y", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b).alias("score"))
    out = (s.join(copies, "rep").select("q", F.col("id").alias("vec_id"), "score")
           .join(queries.select(F.col("rep").alias("q"), F.col("id").alias("query_id")), "q").where("vec_id <> query_id"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return out.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


#: The exact neighbours in DuckDB SQL; the same rows where the index is one block, as it is up to 2,047 vectors.
ORACLE_SQL = r"""
  WITH v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS vec FROM embeddings
             WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding::DOUBLE[], lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
               AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
       l AS (SELECT len(vec) AS n FROM v GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1),
       u AS (SELECT id, min(vec) AS vec FROM v, l WHERE len(vec) = l.n GROUP BY id),
       s AS (SELECT q.id AS query_id, x.id AS vec_id,
                    list_reduce(list_transform(range(1, len(q.vec) + 1), lambda i: x.vec[i] * q.vec[i]), lambda a, b: a + b) AS score
             FROM u q JOIN u x ON x.id <> q.id WHERE q.id % 20 = 0)
  SELECT query_id, rank, vec_id, score
  FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) t WHERE rank <= 20"""
