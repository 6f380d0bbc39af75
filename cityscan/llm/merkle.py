"""Merkle manifest of a dataset: one root over all rows, and for each row the path that proves it.

Each row is a leaf: the sha256 of its fields in a fixed encoding. The leaves of a
group, in order of their id, make a binary tree, a last node without a neighbour
being hashed alone; the groups' roots, in order of the group, make the tree of the root.

A tree is stored as blocks, aligned subtrees of ``2 ** BLOCK_HEIGHT`` leaves, one row of a
written table each. The roots of one table's blocks are the leaves of the next, until one block is left.
Inside a block the nodes lie in the van Emde Boas order: the block is split at
half its height, the upper half first, then each lower half, each laid out the same
way. Where a node lies follows from its depth and index alone (``address``), and both the
construction of a block and the retrieval of siblings work by it. Paths are read back from the topmost
blocks down: a block's row gets the path above its root and gives each of its leaves the whole path.

No group meets in one task: leaves are numbered by a range partition, and a task holds one block at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityscan.llm.common import CRC_TABLE_SQL, crc_sql, in_order, shared_table

BLOCK_HEIGHT = 8

_DIGEST = 32


def encoded(column: Column) -> Column:
    """A value as bytes that no two values share: ``-`` for null, else byte count, ``:`` and text."""
    text = column.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]).cast("binary"), 256)


# ---------------------------------------------------------------- the layout of a block


def address(depth: np.ndarray, index: np.ndarray, height: int) -> np.ndarray:
    """Where the ``index``-th node of ``depth`` (0: root) lies in a complete tree of ``height`` levels."""
    if height == 1:
        return np.zeros_like(index)
    top = height // 2
    low = height - top
    out = np.empty_like(index)
    above = depth < top
    if above.any():
        out[above] = address(depth[above], index[above], top)
    if not above.all():
        d, i = depth[~above] - top, index[~above]
        tree = i >> d
        out[~above] = (1 << top) - 1 + tree * ((1 << low) - 1) + address(d, i & ((1 << d) - 1), low)
    return out


@lru_cache(maxsize=64)
def _places(height: int) -> list[list[int]]:
    """By depth, the addresses of a block's nodes; ``height`` is the number of steps from leaf to root."""
    return [address(np.full(1 << d, d), np.arange(1 << d), height + 1).tolist() for d in range(height + 1)]


def _sizes(leaves: int, height: int) -> list[int]:
    """By depth, how many nodes a block of so many leaves has."""
    out = [leaves]
    for _ in range(height):
        out.append((out[-1] + 1) // 2)
    return out[::-1]


def height_of(block_leaves: int, level_leaves: int) -> int:
    """Steps from a block's leaves to its root: all of a block's, or, where the level is one block, as many as it needs."""
    return BLOCK_HEIGHT if level_leaves > 1 << BLOCK_HEIGHT else max(block_leaves - 1, 0).bit_length()


def build_block(leaves: Sequence[str], height: int) -> bytes:
    """The nodes of a block (hexadecimal leaves) as digests in van Emde Boas order; absent nodes are zeros."""
    places, sizes = _places(height), _sizes(len(leaves), height)
    nodes = bytearray(_DIGEST * ((2 << height) - 1))

    def put(d: int, level: list[str]) -> None:
        for at, digest in zip(places[d], level):
            nodes[at * _DIGEST:(at + 1) * _DIGEST] = bytes.fromhex(digest)

    level = list(leaves)
    put(height, level)
    for d in range(height - 1, -1, -1):
        level = [hashlib.sha256("".join(level[2 * i:2 * i + 2]).encode()).hexdigest() for i in range(sizes[d])]
        put(d, level)
    return bytes(nodes)


def node_at(nodes: bytes, places: list[list[int]], depth: int, index: int) -> str:
    at = places[depth][index] * _DIGEST
    return nodes[at:at + _DIGEST].hex()


def siblings(nodes: bytes, leaves: int, height: int, index: int) -> str:
    """A leaf's path inside its block, a step a level: ``l`` or ``r`` and the left or right sibling, or ``-``."""
    places, sizes = _places(height), _sizes(leaves, height)
    out = []
    for d in range(height, 0, -1):
        other = index ^ 1
        out.append("-" if other >= sizes[d] else ("l" if other < index else "r") + node_at(nodes, places, d, other))
        index >>= 1
    return "".join(out)


def steps(path: str) -> Iterator[tuple[str, str]]:
    """The steps of a path as (side, sibling); side is ``l``, ``r`` or ``-``."""
    at = 0
    while at < len(path):
        n = 1 if path[at] == "-" else 1 + 2 * _DIGEST
        yield path[at], path[at + 1:at + n]
        at += n


def fold(leaf: str, path: str) -> str:
    """The root that a leaf and its path lead to."""
    for side, other in steps(path):
        leaf = hashlib.sha256((other + leaf if side == "l" else leaf + other).encode()).hexdigest()
    return leaf


# ---------------------------------------------------------------- trees over tables


def _block_table(leaves: DataFrame, name: str, extra: str) -> DataFrame:
    """``leaves(tree, place, total, digest, extra)`` as one row a block: tree, block, total, members in order, nodes."""
    members = F.sort_array(F.collect_list(F.struct("place", "digest", F.col("extra").alias("extra"))))
    blocks = leaves.groupBy("tree", F.shiftright("place", BLOCK_HEIGHT).alias("block")).agg(
        F.max("total").alias("total"), members.alias("m")).select(
        "tree", "block", "total", F.col("m.digest").alias("digests"), F.col("m.extra").alias("extras"))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for row in range(b.num_rows):
                one = b.slice(row, 1)
                digests = one.column(3)[0].as_py()
                nodes = build_block(digests, height_of(len(digests), one.column(2)[0].as_py()))
                yield pa.RecordBatch.from_arrays(
                    [one.column(0), one.column(1), one.column(2), pa.array([len(digests)], pa.int32()), one.column(4),
                     pa.array([nodes], pa.binary()), pa.array([nodes[:_DIGEST].hex()])],
                    ["tree", "block", "total", "leaves", "extras", "nodes", "root"])

    return shared_table(blocks.mapInArrow(
        build, f"tree string, block long, total long, leaves int, extras array<{extra}>, nodes binary, root string"), name)


def build(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The block tables of all trees, the lowest first, of ``leaves(tree, place, total, digest, extra)``."""
    levels = []
    extra = leaves.schema["extra"].dataType.simpleString()
    while True:
        table = _block_table(leaves, f"{name}-{len(levels)}", extra)
        levels.append(table)
        open_blocks = table.where(F.col("total") > 1 << BLOCK_HEIGHT)
        if open_blocks.isEmpty():
            return levels
        leaves = open_blocks.select("tree", F.col("block").alias("place"), F.shiftright(
            F.col("total") + F.lit((1 << BLOCK_HEIGHT) - 1), BLOCK_HEIGHT).alias("total"), F.col("root").alias("digest"),
            F.lit(0).alias("extra"))
        extra = "int"


def roots(levels: list[DataFrame]) -> DataFrame:
    """``(tree, root)``, one row a tree."""
    out = [t.where(F.col("total") <= 1 << BLOCK_HEIGHT).select("tree", "root") for t in levels]
    for t in out[1:]:
        out[0] = out[0].unionByName(t)
    return out[0]


def paths(levels: list[DataFrame], above: DataFrame, name: str) -> DataFrame:
    """``(tree, place, extra, digest, path)`` of every leaf, with the path ``above(tree, up)`` after a tree's own.

    From the topmost table down: a block's leaves are the blocks of the table below.
    """
    over = None
    for at in range(len(levels) - 1, -1, -1):
        t, top = levels[at], F.col("total") <= 1 << BLOCK_HEIGHT
        first = t.where(top).join(above, "tree", "left")
        rows = first if over is None else first.unionByName(t.where(~top).join(over, ["tree", "block"]))
        extra = t.schema["extras"].dataType.elementType.simpleString()
        rows = rows.select("tree", "block", "total", "leaves", "extras", "nodes", "up")

        def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for row in range(b.num_rows):
                    one = b.slice(row, 1)
                    tree, block, total, n, _, nodes, up = (c[0].as_py() if i != 4 else None for i, c in enumerate(one.columns))
                    h = height_of(n, total)
                    places = _places(h)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tree] * n), pa.array(range(block << BLOCK_HEIGHT, (block << BLOCK_HEIGHT) + n), pa.int64()),
                         one.column(4).flatten(), pa.array([node_at(nodes, places, h, i) for i in range(n)]),
                         pa.array([siblings(nodes, n, h, i) + (up or "") for i in range(n)])],
                        ["tree", "place", "extra", "digest", "path"])

        out = rows.mapInArrow(read, f"tree string, place long, extra {extra}, digest string, path string")
        if at:
            over = shared_table(out.select("tree", F.col("place").alias("block"), F.col("path").alias("up")), f"{name}-paths-{at}")
    return out


_DIGESTS = "leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"
_NEW = tuple(f.split()[0] for f in _DIGESTS.split(", "))


def manifest(rows: DataFrame, fields: Sequence[str], group: str, order: str, changed: dict[str, Column] | None = None,
             when: Column | None = None) -> DataFrame:
    """``order`` and ``group`` of every row, its leaf, its group's subroot, the root, the sha256 of its path's siblings,
    and what its leaf folds to: with ``changed`` columns in place of the originals where ``when`` holds.

    Rows of a group that tie in ``order`` (nulls first) stand in order of their leaves. A null group is a group of its own and
    comes first. An empty table has no rows. Only the named fields are read; a null field is
    encoded as such. Names that start with two underscores are the operator's own.
    """
    other = {**{f: F.col(f) for f in fields}, **(changed or {})}
    tampered = F.when(when, leaf_hash([other[f] for f in fields])) if when is not None else F.lit(None).cast("string")
    leaves = rows.select(F.col(group).alias("__group"), F.col(order).alias("__order"), leaf_hash([F.col(f) for f in fields]).alias("digest"),
                         tampered.alias("__tampered"))
    placed = in_order(leaves, [F.col("__order").asc_nulls_first(), F.col("digest")], "merkle", ["__group"])
    groups = shared_table(leaves_per(placed), "merkle-groups")
    named = encoded(F.col("__group"))
    trees = placed.withColumn("tree", named).join(groups.select("tree", "total"), "tree").select(
        "tree", "place", "total", "digest",
        F.struct(F.col("__order").alias("order"), F.col("__group").alias("group"), F.col("__tampered").alias("tampered")).alias("extra"))
    levels = build(trees, "merkle-tree")

    subroots = shared_table(roots(levels), "merkle-subroots")
    tops = in_order(groups.join(subroots, "tree").select("__group", "tree", "root"), [F.col("__group").asc_nulls_first()], "merkle-top")
    top_levels = build(tops.select(F.lit("").alias("tree"), "place", F.lit(groups.count()).cast("long").alias("total"),
                                   F.col("root").alias("digest"), F.struct("tree", "root").alias("extra")), "merkle-root")
    root = top_levels[-1].select(F.col("root").alias("__root"))
    top_paths = paths(top_levels, roots(top_levels).select("tree", F.lit("").alias("up")), "merkle-root")
    subs = shared_table(top_paths.select(F.col("extra.tree").alias("tree"), F.col("extra.root").alias("subroot"),
                                         F.col("path").alias("up")), "merkle-subpaths")
    all_paths = paths(levels, subs.select("tree", "up"), "merkle-tree").join(subs.select("tree", "subroot"), "tree")
    found = all_paths.select(F.col("extra.order").alias(order), F.col("extra.group").alias(group), F.col("digest"), F.col("extra.tampered"),
                             "subroot", F.lit((root.first() or [None])[0]).alias("root"), "path")
    schema = ", ".join(f"`{c}` {found.schema[c].dataType.simpleString()}" for c in (order, group))

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            proofs, folded = [], []
            for leaf, tampered, path in zip(*(b.column(i).to_pylist() for i in (2, 3, 6))):
                proofs.append(hashlib.sha256("".join(s for _, s in steps(path)).encode()).hexdigest())
                folded.append(fold(tampered or leaf, path))
            same = [f == r for f, r in zip(folded, b.column(5).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(4), b.column(5), pa.array(proofs, pa.string()),
                                              pa.array(folded, pa.string()), pa.array(same, pa.bool_())], [order, group, *_NEW])

    return found.mapInArrow(prove, f"{schema}, {_DIGESTS}")


def leaves_per(placed: DataFrame) -> DataFrame:
    """``(__group, tree, total)``, one row a group."""
    return placed.groupBy("__group").agg(F.count(F.lit(1)).alias("total")).select(
        "__group", encoded(F.col("__group")).alias("tree"), "total")


#: The same result in DuckDB SQL.
ORACLE_SQL = f"""
  WITH RECURSIVE c AS ({CRC_TABLE_SQL}),
       f AS (SELECT doc_id, lang, n_chars, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') AS f1, coalesce(strlen(source) || ':' || source, '-') AS f2,
                    coalesce(strlen(lang) || ':' || lang, '-') AS f3, coalesce(strlen(text) || ':' || text, '-') AS f5,
                    {crc_sql("doc_id::VARCHAR")} % 7 = 0 AS bad FROM documents, c),
       l AS (SELECT *, sha256(f1 || f2 || f3 || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || f5) AS leaf,
                    sha256(f1 || f2 || f3 || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || f5) AS other FROM f),
       p AS (SELECT doc_id, lang, f3 AS tree, leaf, CASE WHEN bad THEN other ELSE leaf END AS seen,
                    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM l),
       up AS (SELECT tree, lang, 0 AS lvl, i, leaf AS h, n FROM p
              UNION ALL SELECT tree, any_value(lang), lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2
                        FROM up WHERE n > 1 GROUP BY tree, lvl, i // 2),
       s AS (SELECT tree, any_value(lang) AS lang, arg_max(h, lvl) AS subroot, max(lvl) AS steps FROM up GROUP BY tree),
       t AS (SELECT *, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM s),
       ut AS (SELECT 0 AS lvl, i, subroot AS h, n FROM t
              UNION ALL SELECT lvl + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)), (any_value(n) + 1) // 2 FROM ut WHERE n > 1 GROUP BY lvl, i // 2),
       r AS (SELECT arg_max(h, lvl) AS root, max(lvl) AS steps FROM ut),
       e AS (SELECT row_number() OVER () AS id, p.doc_id, p.leaf, p.seen, p.tree, p.i, t.subroot, t.i AS ti, t.steps, r.root, r.steps AS tsteps
             FROM p JOIN t USING (tree), r),
       g AS (SELECT id, v.lvl, e.i >> v.lvl AS at, up.h FROM e, (SELECT unnest(range(64)) AS lvl) v
                    LEFT JOIN up ON up.tree = e.tree AND up.lvl = v.lvl AND up.i = xor(e.i >> v.lvl, 1) WHERE v.lvl < e.steps
             UNION ALL
             SELECT id, e.steps + v.lvl, e.ti >> v.lvl, ut.h FROM e, (SELECT unnest(range(64)) AS lvl) v
                    LEFT JOIN ut ON ut.lvl = v.lvl AND ut.i = xor(e.ti >> v.lvl, 1) WHERE v.lvl < e.tsteps),
       q AS (SELECT id, sha256(coalesce(string_agg(h, '' ORDER BY lvl), '')) AS proof FROM g GROUP BY id),
       w AS (SELECT id, 0 AS lvl, seen AS h FROM e
             UNION ALL SELECT w.id, w.lvl + 1, sha256(CASE WHEN g.at % 2 = 1 THEN coalesce(g.h, '') || w.h ELSE w.h || coalesce(g.h, '') END)
                       FROM w JOIN g ON g.id = w.id AND g.lvl = w.lvl),
       x AS (SELECT id, arg_max(h, lvl) AS folded FROM w GROUP BY id)
  SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded AS folded_root, folded = root AS verified
  FROM e LEFT JOIN q USING (id) JOIN x USING (id)"""
