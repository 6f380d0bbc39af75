"""Documents whose sets of word n-grams are similar: a blocked sparse matrix product.

The incidence of documents by n-grams is a sparse 0/1 matrix; the overlap of two
documents is an entry of its product with its transpose. Rows are dealt into blocks, and
the product is made block by block, overlaps being accumulated over blocks of columns. A
Jaccard similarity of t needs an overlap of at least t * n for either document of n
n-grams, and of t / (1 + t) times the sum of both sizes. These bounds discard, in turn,

1. rows: of the n-grams with the smallest hashes, it is counted how many
   occur in any other document; whoever shares fewer than any partner must is gone;
2. columns that no pair needs to meet in: n-grams of one remaining document only, and all but the
   rarest few of each document (those that suffice to meet any partner once);
3. parts of blocks: a row takes part in the product with another block only if one of its few
   columns has a row there, of such a size and with so many shared n-grams from there on that the bound can be met;
4. pairs, inside the product: an entry is dropped as soon as its sum and what is still to
   come stay below its bound.

A row is sent once to each block that it may have a link in, however many rows it meets
there, and every link is an entry of such a product.

Copies (equal sets) are one row of the matrix. Large groups of near copies are
contracted first: documents that share a MinHash are multiplied with one of them,
the one that shares most. The other blocks need entries only between the components so
found; that is all that the final components need.

The links themselves, all of them, are asked for by ``link_counts`` and ``links``.
Those between the contracted components are at hand. Those inside one are entries of
the product of its own rows: a component is dealt into cells of bounded size, by size
band and hash, and each pair of cells that sizes allow is one block of the product.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityscan.llm.common import (
    WordHash, connected_components, mixed, n_buckets, shared_table, text_bytes, window_hashes, with_ids)
from cityscan.llm.packed import ENTRY, Buckets, repeated_by_owner

_MINHASHES = 8
#: A cell has about so many n-grams and documents at most; a block of the product so many columns; a bundle of blocks so many n-grams.
_CELL_GRAMS, _CELL_ROWS, _COLUMNS, _BUNDLE_GRAMS = 1 << 17, 512, 4096, 1 << 20


def ngram_set(text: bytes | None, words: WordHash, k: int) -> np.ndarray:
    """Sorted hashes of the distinct ``k``-word runs; of the whole sequence if it is shorter; empty without words."""
    w = text.lower().split() if text else []
    h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
    return np.unique(window_hashes(h, min(k, len(w)))) if len(w) else h


def _class(grams: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(grams.tobytes())
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def _sizes(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        for b in batches:
            n, f = [], []
            for text in text_bytes(b.column("__text")):
                g = ngram_set(text, words, k)
                n.append(len(g))
                f.append(_class(g))
            yield pa.RecordBatch.from_arrays(
                [b.column("__id"), pa.array(n, pa.int64()), pa.array([x[0] for x in f], pa.int64()),
                 pa.array([x[1] for x in f], pa.int64())], names=["__id", "n", "f1", "f2"])

    return run


def _classed(k: int, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        for b in batches:
            sets = [ngram_set(t, words, k) for t in text_bytes(b.column("__text"))]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in names] + [pa.array([_class(g)[0] for g in sets], pa.int64()),
                                                pa.array([len(g) for g in sets], pa.int64())],
                names=[*names, "__f1", "__n"])

    return run


def _extra(n):
    """How many shared n-grams beyond the first the document filter asks for, of n."""
    return n // 10


def _least(n, percent):
    """ceil(percent / 100 * n) in whole numbers."""
    return (n * percent + 99) // 100


def _prefixes(k: int, percent: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, out, seen = WordHash(), Buckets(buckets), set()
        for b in batches:
            for text in text_bytes(b.column("__text")):
                g = ngram_set(text, words, k)
                if not len(g):
                    continue
                owner = _class(g)[0]
                if owner in seen:
                    continue
                if len(seen) < 1_000_000:
                    seen.add(owner)
                few = g[:len(g) - _least(len(g), percent) + 1 + _extra(len(g))]
                if out.add(few, owner, np.zeros(len(few))):
                    yield out.take()
        if out.size:
            yield out.take()

    return run


def _rows(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHash()
        salts = mixed(np.arange(1, _MINHASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for b in batches:
            nodes, grams, mins = [], [], []
            for text in text_bytes(b.column("__text")):
                g = ngram_set(text, words, k)
                nodes.append(_class(g)[0])
                grams.append(g.tobytes())
                mins.append([int(mixed(g ^ s).min().view(np.int64)) for s in salts] if len(g) else [])
            yield pa.RecordBatch.from_arrays(
                [pa.array(nodes, pa.int64()), pa.array(grams, pa.binary()), pa.array(mins, pa.list_(pa.int64()))],
                names=["node", "grams", "mins"])

    return run


def _entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row an n-gram of a document: the set entries of the incidence matrix."""
    for b in batches:
        for at in range(0, b.num_rows, 256):
            part = b.slice(at, 256)
            grams = [np.frombuffer(g.as_py(), np.int64) for g in part.column("grams")]
            node = np.repeat(part.column("node").to_numpy(), [len(g) for g in grams])
            n = np.repeat([len(g) for g in grams], [len(g) for g in grams])
            yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(n, pa.int64()), pa.array(np.concatenate(grams))],
                                             names=["node", "n", "g"])


def _bound(n: Column, percent: int) -> Column:
    return F.ceil(n * percent / F.lit(100.0 + percent) - 1e-9)


def _band(n: Column, percent: int) -> Column:
    """Sizes of a similar pair differ by the factor t at most, so they lie in the same or the next band
    (a band is a little wider than t, so that rounding cannot part them)."""
    return F.floor(F.log(n) / float(-np.log(percent / 100) * (1 + 1e-9)))


def _parts() -> Column:
    """How many cells hold the rows of a group, by their n-grams and their number."""
    return F.greatest(F.ceil(F.sum("n") / _CELL_GRAMS), F.ceil(F.count(F.lit(1)) / _CELL_ROWS)).cast("int").alias("parts")


def _with_leaders(rows: DataFrame, percent: int) -> DataFrame:
    """The links ``(a, b)`` of documents with leaders: of those that share a MinHash, the one that shares most n-grams.

    A leader's followers, dealt into cells, are multiplied with it.
    """
    m = rows.select("node", "n", "share", F.posexplode("mins").alias("i", "m"))
    lead = m.groupBy("i", "m").agg(F.max_by("node", F.struct("share", F.negate("node"))).alias("lead"))
    follow = shared_table(m.join(lead, ["i", "m"]).where("node <> lead").select("node", "n", "lead").distinct(), "ngram-followers")
    cells = follow.join(follow.groupBy("lead").agg(_parts()), "lead").select(
        "node", "lead", F.xxhash64("lead", F.pmod(F.xxhash64("node"), "parts")).alias("block"))
    asked = cells.select("node", "block", F.lit(0).alias("side")).unionByName(
        cells.select(F.col("lead").alias("node"), "block", F.lit(1).alias("side")).distinct())
    return _entries_of(shared_table(asked, "ngram-asked"), rows, percent, "pairs")


def _between(rows: DataFrame, comps: DataFrame, percent: int, give: str) -> DataFrame:
    """The links ``(a, b)`` between different components; as a ``forest``, pairs that connect what they connect."""
    e = rows.select("node", "grams").mapInArrow(_entries, "node long, n long, g long")
    common = e.groupBy("g").agg(F.count(F.lit(1)).alias("df")).where("df > 1")
    per = (e.join(common, "g").groupBy("node", "n").agg(F.sort_array(F.collect_list(F.struct("df", "g"))).alias("s")))
    per = per.withColumn("c", F.size("s").cast("long"))
    least = F.floor((F.col("n") * percent + 99) / 100)
    per = per.where(F.col("c") >= least).withColumn("few", F.slice("s", F.lit(1), (F.col("c") - least + 1).cast("int")))
    per = per.join(comps, "node", "left").withColumn("comp", F.coalesce("comp", "node")).withColumn("band", _band(F.col("n"), percent))

    # blocks of rows: by size band and smallest hash, which near copies mostly share, so that
    # a row and its partners lie in few blocks; a large family over several
    per = per.join(rows.select("node", F.element_at("mins", 1).alias("family")), "node")
    per = shared_table(per.select("node", "n", "c", "comp", "band", "family", "few"), "ngram-few")
    cells = per.groupBy("band", "family").agg(_parts())
    blocks = per.groupBy("band").agg(_parts().alias("blocks"))
    cell = F.pmod(F.xxhash64("node"), "parts")
    homes = per.join(cells, ["band", "family"]).join(F.broadcast(blocks), "band").select(  # a row a band: log of the sizes' ratio
        "node", "n", "c", "comp", "band", F.xxhash64("band", F.pmod(F.xxhash64("family", cell), "blocks")).alias("home"), "few")
    p = homes.select("node", "n", "c", "comp", "band", "home", F.posexplode("few").alias("at", "s")).select(
        "node", "n", "comp", "band", "home", F.col("s.g").alias("g"), (F.col("c") - F.col("at")).alias("rest"))
    p = shared_table(p, "ngram-columns")
    mixed_lists = p.groupBy("g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("g")
    p = shared_table(p.join(mixed_lists, "g", "left_semi"), "ngram-mixed")

    # which blocks a column meets; where a pair meets first, nothing before that place is
    # common: what stands from there on bounds the overlap
    met = p.groupBy("g", "band", "home").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min("n").alias("least_n"), F.max("rest").alias("most"))
    met = met.withColumnRenamed("home", "other").withColumn("band", F.explode(F.array(*[F.col("band") + i for i in (-1, 0, 1)])))
    need = _bound(F.col("n") + F.col("least_n"), percent)
    asked = p.join(met, ["g", "band"]).where(
        ((F.col("lo") != F.col("hi")) | (F.col("lo") != F.col("comp"))) & (F.least("rest", "most") >= need))
    asked = asked.select("node", "home", "other").distinct().select(
        "node", F.xxhash64(F.least("home", "other"), F.greatest("home", "other")).alias("block"),
        F.when(F.col("home") == F.col("other"), _OWN).otherwise((F.col("home") > F.col("other")).cast("int")).alias("side"))
    links = _entries_of(shared_table(asked, "ngram-asked"), rows, percent, give)
    if give == "forest":
        return links
    comp = comps.withColumnRenamed("comp", "of")
    for x in "ab":  # entries inside a component are not asked for here
        links = links.join(comp.withColumnsRenamed({"node": x, "of": f"of_{x}"}), x, "left")
    return links.where(F.coalesce("of_a", "a") != F.coalesce("of_b", "b")).select("a", "b")


#: The side of rows that meet each other; other blocks have a side 0 and a side 1.
_OWN = 2


def _block_links(a: list[np.ndarray], b: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers (i, j) of the similar pairs of ``a`` and ``b``: one block of the product.

    Overlaps are summed over blocks of the n-grams that two rows at least hold. A row
    leaves as soon as none of its pairs can reach its bound with the n-grams still to come.
    """
    na, nb = (np.array([len(g) for g in x]) for x in (a, b))
    ga, gb = np.concatenate(a), np.concatenate(b)
    if a is b:
        shared, times = np.unique(ga, return_counts=True)
        shared = shared[times > 1]
    else:
        shared = np.intersect1d(ga, gb)
    sides = []
    for g, n in ((ga, na), (gb, nb)):
        at = np.minimum(np.searchsorted(shared, g), max(0, len(shared) - 1))
        hit = np.flatnonzero(shared[at] == g) if len(shared) else np.zeros(0, np.int64)
        row, col = np.repeat(np.arange(len(n)), n)[hit], at[hit]
        order = np.argsort(col, kind="stable")
        sides.append((row[order], col[order], np.bincount(row, minlength=len(n))))
    (ra, ca, la), (rb, cb, lb) = sides
    sums = np.zeros((len(a), len(b)), np.int64)
    both = 100 + percent
    least = -(-percent * (na[:, None] + nb[None, :]) // both)
    for lo in range(0, len(shared), _COLUMNS):
        alive = sums + np.minimum(la[:, None], lb[None, :]) >= least
        ia, ib = np.flatnonzero(alive.any(1)), np.flatnonzero(alive.any(0))
        if not len(ia):
            break
        dense = []
        for row, col, left, kept in ((ra, ca, la, ia), (rb, cb, lb, ib)):
            x, y = np.searchsorted(col, [lo, lo + _COLUMNS])
            place = np.full(len(left), -1)
            place[kept] = np.arange(len(kept))
            r, c = place[row[x:y]], col[x:y] - lo
            m = np.zeros((len(kept), _COLUMNS), np.float32)
            m[r[r >= 0], c[r >= 0]] = 1
            dense.append(m)
            left -= np.bincount(row[x:y], minlength=len(left))
        sums[np.ix_(ia, ib)] += (dense[0] @ dense[1].T).astype(np.int64)
    similar = sums >= least
    return np.nonzero(np.triu(similar, 1) if a is b else similar)


def _forest(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs that connect what the links (p, q) connect: each node with the first one of its component."""
    nodes, at = np.unique(np.concatenate((p, q)), return_inverse=True)
    a, b, label = at[:len(p)], at[len(p):], np.arange(len(nodes))
    while True:
        least = label.copy()
        np.minimum.at(least, a, label[b])
        np.minimum.at(least, b, label[a])
        least = least[least]
        if (least == label).all():
            break
        label = least
    other = label != np.arange(len(nodes))
    return nodes[label[other]], nodes[other]


def _product(percent: int, give: str):
    """For one bundle of blocks: all ``pairs`` (a, b), a ``forest`` of pairs, or the ``counts`` of each node's links."""
    count = give == "counts"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        block, side = table.column("block").to_numpy(), table.column("side").to_numpy()
        node, grams = table.column("node").to_numpy(), table.column("grams").to_pylist()
        ends = np.flatnonzero(np.diff(block)) + 1
        found = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for x, y in zip([0, *ends], [*ends, len(block)]):
            own = side[x] == _OWN
            ia, ib = (np.flatnonzero(side[x:y] == s) + x for s in ((_OWN, _OWN) if own else (0, 1)))
            for i0 in range(0, len(ia), _CELL_ROWS):
                rows_a = ia[i0:i0 + _CELL_ROWS]
                a = [np.frombuffer(grams[i], np.uint64) for i in rows_a]
                for j0 in range(i0 if own else 0, len(ib), _CELL_ROWS):
                    rows_b = ib[j0:j0 + _CELL_ROWS]
                    same = own and i0 == j0
                    i, j = _block_links(a, a if same else [np.frombuffer(grams[k], np.uint64) for k in rows_b], percent)
                    p, q = node[rows_a[i]], node[rows_b[j]]
                    if count:
                        found.append(np.unique(np.concatenate((p, q)), return_counts=True))
                    elif give == "pairs":
                        found.append((np.minimum(p, q), np.maximum(p, q)))
                    else:
                        found.append(_forest(p, q))
        x, y = (np.concatenate(c) for c in zip(*found))
        return pa.table({"node" if count else "a": pa.array(x, pa.int64()), "n" if count else "b": pa.array(y, pa.int64())})

    return run


def _in_bundles(blocks: DataFrame, percent: int, give: str) -> DataFrame:
    """The product of blocks(block, side, node, n, grams), several a task."""
    total = blocks.agg(F.sum("n").alias("n")).first()["n"] or 0
    bundles = max(int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions")), int(total // _BUNDLE_GRAMS) + 1)
    return blocks.withColumn("bundle", F.pmod("block", F.lit(bundles))).drop("n").groupBy("bundle").applyInArrow(
        _product(percent, give), "node long, n long" if give == "counts" else "a long, b long")


def _entries_of(asked: DataFrame, rows: DataFrame, percent: int, give: str) -> DataFrame:
    """The links ``(a, b)`` of the blocks ``asked(node, block, side)``, each once: all ``pairs``, or a ``forest``
    that connects what they connect."""
    blocks = asked.join(rows.select("node", "n", "grams"), "node").select("block", "side", "node", "n", "grams")
    return _in_bundles(blocks, percent, give).distinct()


def _within(rows: DataFrame, comps: DataFrame, percent: int, count: bool) -> DataFrame:
    """All similar pairs ``(a, b)`` of one component, or ``(node, n)`` of them in each bundle."""
    r = rows.select("node", "n", "grams", _band(F.col("n"), percent).alias("band")).join(comps, "node")
    parts = shared_table(r.groupBy("comp", "band").agg(_parts()), "ngram-cells")
    for name, by in (("below", 1), ("above", -1)):
        r = r.join(parts.select("comp", (F.col("band") + by).alias("band"), F.col("parts").alias(name)), ["comp", "band"], "left")
    r = r.join(parts, ["comp", "band"]).withColumn("part", F.pmod(F.xxhash64("node"), "parts").cast("int"))

    def blocks(parts: str, of):
        last = F.coalesce(F.col(parts), F.lit(0)) - 1
        return F.when(last >= 0, F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), of)).otherwise(F.array())

    def block(band, kind, x, y, side):
        return F.struct(F.xxhash64("comp", band, F.lit(kind), x, y).alias("block"), side.cast("int").alias("side"))

    part, band = F.col("part"), F.col("band")
    r = r.select("node", "n", "grams", F.inline(F.concat(
        blocks("parts", lambda j: block(band, 0, F.least(part, j), F.greatest(part, j),
                                           F.when(part == j, _OWN).otherwise((part > j).cast("int")))),
        blocks("below", lambda j: block(band, 1, part, j, F.lit(0))),
        blocks("above", lambda j: block(band + 1, 1, j, part, F.lit(1))))))
    return _in_bundles(r.select("block", "side", "node", "n", "grams"), percent, "counts" if count else "pairs")


class _Join(NamedTuple):
    base: DataFrame  # (__id, n, f1, f2), a row a row of the documents
    classes: DataFrame  # (f1, f2, n, rep), a row a set
    rows: DataFrame  # (node, n, share, grams, mins) of the sets that may link
    near: DataFrame  # (node, comp) by the links with leaders only
    far: DataFrame  # all links (a, b) between different comps of near; as a forest, pairs that connect what they do
    comps: DataFrame  # (node, comp) by all links


def _joined(docs: DataFrame, doc_id: str, text: str, k: int, percent: int, give: str = "forest") -> _Join:
    d = docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("__text"))
    base = shared_table(d.mapInArrow(_sizes(k), d.schema["__id"].simpleString().replace("__id:", "__id ")
                                     + ", n long, f1 long, f2 long"), "ngram-sizes")
    named = d.where(F.col("__id").isNotNull())
    classes = base.where("n > 0 and __id is not null").groupBy("f1", "f2", "n").agg(F.min("__id").alias("rep"))

    # documents that share enough of their smallest hashes with others
    buckets = n_buckets(named, 1.0, "__text")
    prefixes = named.select("__text").mapInArrow(_prefixes(k, percent, buckets), ENTRY)
    shared = repeated_by_owner(prefixes, buckets).select("__row", (F.length("at") / 4).alias("shared"))
    n = F.col("n")
    least = F.floor((n * percent + 99) / 100)
    left = shared_table(
        classes.join(shared, F.col("f1") == F.col("__row"))
        .where(F.col("shared") >= F.floor(least / 10) + 1)
        .select(F.col("rep").alias("__id"), F.col("f1").alias("node"), "n",
                (F.col("shared") / (n - least + 1 + F.floor(n / 10))).alias("share")), "ngram-left")
    rows = with_ids(named, left.select("__id").distinct(), "__id").select("__text").mapInArrow(
        _rows(k), "node long, grams binary, mins array<long>")
    rows = shared_table(rows.join(left.drop("__id"), "node").dropDuplicates(["node"]), "ngram-rows")

    led = shared_table(_with_leaders(rows, percent), "ngram-links")
    comps = near = shared_table(connected_components(led), "ngram-components")
    far = shared_table(_between(rows, near, percent, give), "ngram-links")
    if not far.isEmpty():
        comps = shared_table(connected_components(led.unionByName(far)), "ngram-components")
    return _Join(base, classes, rows, near, far, comps)


def _labelled(join: _Join) -> DataFrame:
    """``(__id, n, f1, comp, rep, component)``: each row's class and its smallest id, its component's label and smallest id."""
    base, classes, comps = join.base, join.classes, join.comps
    labels = classes.join(comps, F.col("f1") == F.col("node"), "left").select(
        "f1", "f2", "n", "rep", F.coalesce("comp", "f1").alias("comp"), F.col("comp").isNotNull().alias("linked"))
    smallest = labels.where("linked").groupBy("comp").agg(F.min("rep").alias("least"))
    labels = labels.join(smallest, "comp", "left").select(
        "f1", "f2", "comp", "rep", F.when(F.col("linked"), F.col("least")).otherwise(F.col("rep")).alias("component"))
    return base.join(labels, ["f1", "f2"], "left").select(
        "__id", "n", "f1", "comp", "rep",
        F.when((F.col("n") > 0) & F.col("__id").isNotNull(), F.col("component")).otherwise(F.col("__id")).alias("component"))


def similar_components(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 4,
                       percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id)``, one row a row of ``docs``.

    Two documents link when 100 * intersection >= percent * union of their sets of
    ``k``-word runs (words split at ASCII white space, A-Z lowered; a shorter
    text is one run). component_id is the smallest id reachable by links, its own
    included. A text without words (null, empty) links with nothing. Rows may share an
    id; equal texts under any ids are one component. A row without id has a size but no
    component (null). Runs are compared by 64-bit hashes. Other columns do not matter.
    """
    return _labelled(_joined(docs, doc_id, text, k, percent)).select(
        F.col("__id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def link_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """``(doc_id, n_shingles, component_id, class_id, representative_id, n_links)``, one row a row of ``docs``.

    The first three as in ``similar_components``. Rows of equal sets of runs are one class:
    class_id names it, representative_id is its smallest id. n_links is the exact number of
    other classes that the class links with, so its sum over classes is twice the number
    of links. A row without words or without id is in no class (null) and has no links.
    Links are counted where they are found, so no row is made of each.
    """
    join = _joined(docs, doc_id, text, k, percent, "pairs")
    far = join.far.select(F.explode(F.array("a", "b")).alias("node")).withColumn("n", F.lit(1).cast("long"))
    n = _within(join.rows, join.near, percent, True).unionByName(far).groupBy("node").agg(F.sum("n").alias("__links"))
    free = (F.col("n") == 0) | F.col("__id").isNull()
    out = _labelled(join).join(n, F.col("f1") == F.col("node"), "left")
    return out.select(
        F.col("__id").alias(doc_id), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"),
        F.when(~free, F.col("f1")).alias("class_id"), F.when(~free, F.col("rep")).alias("representative_id"),
        F.when(~free, F.coalesce("__links", F.lit(0))).otherwise(0).cast("long").alias("n_links"))


def links(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 4, percent: int = 85) -> DataFrame:
    """``(class_a, class_b, representative_a, representative_b)``: every link once, class_a < class_b.

    Classes and membership are those of ``link_counts``. The rows are as many as the links,
    so a group of m near copies gives up to m (m - 1) / 2.
    """
    join = _joined(docs, doc_id, text, k, percent, "pairs")
    far = join.far.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    out = _within(join.rows, join.near, percent, False).unionByName(far)
    for x in "ab":
        out = out.join(join.classes.select(F.col("f1").alias(x), F.col("rep").alias(f"representative_{x}")), x)
    return out.select(F.col("a").alias("class_a"), F.col("b").alias("class_b"), "representative_a", "representative_b")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5,
                    percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component, one row of its smallest id.

    Rows without words or without id link with nothing and stay. Columns are kept. Where
    ids repeat, the rows of an id are told apart by their n-gram sets, and of equal rows one stays.
    """
    rows = shared_table(_labelled(_joined(docs, doc_id, text, k, percent)), "ngram-labelled")
    free = F.col("n").eqNullSafe(0) | F.col("__id").isNull()
    rows = rows.withColumn("__free", free)
    ids = rows.where("__id is not null").groupBy("__id").agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.col("__free") | (F.col("component") == F.col("__id"))).alias("stays"))
    ids = shared_table(ids, "ngram-ids")
    d = docs.withColumn("__id", F.col(doc_id))
    once = with_ids(d, shared_table(ids.where("rows = 1 and not stays").select("__id"), "ngram-gone"), "__id", "left_anti")
    many = shared_table(ids.where("rows > 1").select("__id"), "ngram-many")
    if many.isEmpty():
        return once.select(*docs.columns)
    once = with_ids(once, many, "__id", "left_anti")
    first = Window.partitionBy("comp").orderBy("f1")
    kept = rows.where("not __free and component = __id").withColumn("r", F.min("f1").over(first)).where("f1 = r")
    kept = shared_table(kept.select("__id", "f1").distinct(), "ngram-kept")
    names = [c for c in d.columns if c not in ("__f1", "__n")]
    again = with_ids(d, many, "__id").select(*names, F.col(text).alias("__text")).mapInArrow(
        _classed(k, names), d.select(*names).schema.add("__f1", "long").add("__n", "long"))
    one = (again.where("__n > 0").join(kept.select("__id", F.col("f1").alias("__f1")), ["__id", "__f1"], "left_semi")
           .dropDuplicates(["__id", "__f1"]))
    return (once.select(*docs.columns).unionByName(again.where("__n = 0").select(*docs.columns))
            .unionByName(one.select(*docs.columns)))


#: ``similar_components`` in DuckDB SQL, for unique ids.
ORACLE_SQL = r"""
  WITH RECURSIVE d AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
       s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
             FROM (SELECT doc_id, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM d WHERE len(w) > 0)),
       n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
       j AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
       l AS MATERIALIZED (SELECT a, b FROM j JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * j.n >= 85 * (x.n + y.n - j.n)),
       e AS MATERIALIZED (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
       c AS (SELECT doc_id AS id, doc_id AS root FROM d UNION SELECT e.b, c.root FROM c JOIN e ON e.a = c.id WHERE c.root < e.b)
  SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, r.root AS component_id
  FROM d LEFT JOIN n USING (doc_id) JOIN (SELECT id, min(root) AS root FROM c GROUP BY id) r ON r.id = d.doc_id"""
