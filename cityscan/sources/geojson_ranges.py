"""The features of GeoJSON documents, read by many tasks from byte ranges of one file.

A FeatureCollection may be one line of any length. The text reader cuts files at
``}``, so each task has the pieces of a byte range and no piece is longer than what lies
between two closing braces. A range does not know whether it starts inside a string or how
deep it is nested. So a first pass gives, for both answers to the first question, how
far the range goes up or down and whether it leaves inside a string; running sums over the ranges of
a file turn that into the true state at every range's start. A second pass then cuts
out the objects at the depth of features; what crosses range borders is put
together again by the range that it starts in.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityscan.session import materialize

# Functions that run in Python workers are pickled by value, so executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_PIECE_BYTES = 4 << 20
_ESCAPES = re.compile(rb'\\+"')
_FEATURES = re.compile(rb'"features"\s*:\s*$')

#: Nesting: the document is 1 deep, its features array 2, a feature 3.
_DOCUMENT, _ARRAY, _ITEM = 1, 2, 3


def _pieces(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(path, block, size, value): the text between closing braces, in order within a range of a file."""
    df = spark.read.option("lineSep", "}").text(paths)
    return df.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                     F.col("_metadata.file_size").alias("size"), "value")


def _runs(batches: Iterator[pa.RecordBatch], carried: int) -> Iterator[tuple[tuple, bytes]]:
    """The ranges' bytes in bounded parts, each with its first ``carried`` columns; the value is the column after."""
    key, parts, n = None, [], 0
    for batch in batches:
        columns = [batch.column(i).to_pylist() for i in range(carried)]
        values = batch.column(carried).cast(pa.large_binary())
        for i in range(batch.num_rows):
            at = tuple(c[i] for c in columns)
            if parts and (at != key or n >= _PIECE_BYTES):
                yield key, b"".join(parts)
                parts, n = [], 0
            key = at
            text = values[i].as_py() + b"}"
            parts.append(text)
            n += len(text)
    if parts:
        yield key, b"".join(parts)


def _brackets(data: bytes, inside: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and steps (up 1, down -1) of the brackets that are not in a string, and whether the data end inside one."""
    a = np.frombuffer(data, np.uint8)
    quotes = np.flatnonzero(a == 34)
    if b"\\" in data:
        escaped = [m.end() - 1 for m in _ESCAPES.finditer(data) if (m.end() - m.start()) % 2 == 0]
        quotes = np.setdiff1d(quotes, escaped, assume_unique=True)
    at = np.flatnonzero((a == 123) | (a == 125) | (a == 91) | (a == 93))
    at = at[(np.searchsorted(quotes, at) + inside) % 2 == 0]
    step = np.where((a[at] == 123) | (a[at] == 91), 1, -1)
    return at, step, (len(quotes) + inside) % 2


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row a range: bytes, whether it changes between in and out of a string, and, by how it starts, its rise and lowest point."""
    names = ["path", "block", "size", "bytes", "flips", "rise0", "low0", "rise1", "low1"]
    key, row = None, None

    def out():
        return pa.RecordBatch.from_arrays([pa.array([v]) for v in (*key, *row)], names)

    for at, data in _runs(batches, 3):
        if at != key:
            if key is not None:
                yield out()
            key, row = at, [0, 0, 0, 0, 0, 0]
        flips = row[1]
        for start in (0, 1):
            _, step, end = _brackets(data, (start + flips) % 2)
            path = np.cumsum(step)
            if len(path):
                row[3 + 2 * start] = min(row[3 + 2 * start], row[2 + 2 * start] + int(path.min()))
                row[2 + 2 * start] += int(path[-1])
            if start == 0:
                row[1] = end
        row[0] += len(data)
    if key is not None:
        yield out()


def _ranges(pieces: DataFrame) -> DataFrame:
    """(path, block, depth, inside, home, edge) of each range: its true state at the start, the range in which the item
    that it starts inside began, and whether it touches the document's own level. A broken document fails the query."""
    facts = pieces.mapInArrow(_measure, "path string, block long, size long, bytes long, flips long, rise0 long, low0 long, rise1 long, low1 long")
    order = Window.partitionBy("path").orderBy("block")
    before, upto = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    r = facts.withColumn("inside", (F.coalesce(F.sum("flips").over(before), F.lit(0)) % 2).cast("int"))
    for name in ("rise", "low"):
        r = r.withColumn(name, F.when(F.col("inside") == 0, F.col(f"{name}0")).otherwise(F.col(f"{name}1")))
    r = r.withColumn("depth", F.coalesce(F.sum("rise").over(before), F.lit(0)))
    r = r.withColumn("least", F.col("depth") + F.col("low")).withColumn("end", F.col("depth") + F.col("rise"))
    leaves = (F.col("least") < _ITEM) & (F.col("end") >= _ITEM)  # an item that starts here goes on in the next range
    r = r.withColumn("home", F.when(F.col("depth") >= _ITEM, F.last(F.when(leaves, F.col("block")), ignorenulls=True).over(before)))
    r = r.withColumn("edge", F.col("least") <= _DOCUMENT)
    # the reader drops the last brace or, after it, gives what follows as one more piece
    last = F.row_number().over(Window.partitionBy("path").orderBy(F.desc("block"))) == 1
    spare = F.sum("bytes").over(upto) - F.col("size")
    whole = ((spare == 0) & (F.col("end") == 0) & (F.col("least") >= 0)) | ((spare == 1) & (F.col("end") == -1) & (F.col("least") == -1))
    closed = whole & ((F.col("inside") + F.col("flips")) % 2 == 0)
    r = r.withColumn("bad", F.when(last, ~closed).otherwise((F.col("least") < 0) | (F.col("end") < 0)))
    said = F.concat(F.lit("malformed GeoJSON document: "), F.col("path"))
    path = F.when(F.col("bad"), F.raise_error(said)).otherwise(F.col("path"))
    return materialize(r.select(path.alias("path"), "block", "depth", "inside", "home", "edge"))


def _features_array(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Where arrays of the document itself close, and where the one named features opens."""
    key, state, open_ = None, None, False
    for at, data in _runs(batches, 4):
        path, block, depth, inside = at
        if at != key:
            key, state = at, [0, depth, inside]
        places, step, inside = _brackets(data, state[2])
        after = state[1] + np.cumsum(step)
        opens = places[(after == _ARRAY) & (step == 1)]
        opens = [p for p in opens.tolist() if data[p:p + 1] == b"[" and _FEATURES.search(data[max(0, p - 200):p])]
        closes = places[(after == _DOCUMENT) & (step == -1)].tolist()
        rows = [(state[0] + p, True) for p in opens] + [(state[0] + p, False) for p in closes]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array([path] * len(rows)), pa.array([block] * len(rows)), pa.array([x for x, _ in rows]),
                                              pa.array([x for _, x in rows])], ["path", "block", "place", "opens"])
        state = [state[0] + len(data), int(after[-1]) if len(after) else state[1], inside]


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The objects at the depth of features: (path, home, place, part, whole, text), in parts where they cross ranges."""
    names = ["path", "home", "place", "part", "whole", "text"]
    key, state = None, None

    def rows(found):
        return pa.RecordBatch.from_arrays([pa.array([r[i] for r in found], t) for i, t in enumerate(
            (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(), pa.string()))], names)

    def rest():
        # what is open at the end of a range: the start, or all, of the part that lies in it
        path, block, _, _, home = key
        return [(path, block if state["home"] is None else home, state["place"], block, False, b"".join(state["open"]).decode())]

    for at, data in _runs(batches, 5):
        path, block, depth, inside, home = at
        if at != key:
            if key is not None and state["open"] is not None:
                yield rows(rest())
            key = at
            # home: not None while the item that the range starts inside is open
            state = {"at": 0, "depth": depth, "inside": inside, "open": [] if depth >= _ITEM else None, "home": home, "place": None}
        places, step, state["inside"] = _brackets(data, state["inside"])
        after = state["depth"] + np.cumsum(step)
        edge = ((after == _ITEM) & (step == 1)) | ((after == _ARRAY) & (step == -1))
        found, begin = [], 0 if state["open"] is not None else None
        for p, up in zip(places[edge].tolist(), (step[edge] == 1).tolist()):
            if up:
                begin, state["open"], state["place"], state["home"] = p, [], state["at"] + p, None
            elif state["open"] is not None:
                text = b"".join([*state["open"], data[begin:p + 1]]).decode()
                if state["home"] is None:
                    found.append((path, block, state["place"], block, True, text))
                else:
                    found.append((path, home, None, block, False, text))
                begin, state["open"], state["home"] = None, None, None
        if state["open"] is not None:
            state["open"].append(data[begin:])
        state["at"] += len(data)
        state["depth"] = int(after[-1]) if len(after) else state["depth"]
        if found:
            yield rows(found)
    if key is not None and state["open"] is not None:
        yield rows(rest())


def feature_texts(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """``value``: the text of each feature of uncompressed GeoJSON documents, whatever their lines.

    Reads the files twice (and ranges at a document's own level once more); the ranges' states, a row
    a range, are made when the plan is built. A document that is truncated, unbalanced or
    without a features array fails.
    """
    pieces = _pieces(spark, paths)
    ranges = _ranges(pieces)
    state = F.broadcast(ranges) if ranges.count() <= 1_000_000 else ranges  # some 100 bytes a range
    with_state = pieces.join(state, ["path", "block"])
    level = materialize(with_state.where("edge").select("path", "block", "depth", "inside", "value").mapInArrow(
        _features_array, "path string, block long, place long, opens boolean"))
    at = F.struct("block", "place")
    opens = level.where("opens").groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min(at).alias("first"))
    closes = level.where("not opens").select("path", at.alias("close"))
    bounds = opens.join(closes, "path").where("close > first").groupBy("path").agg(
        F.min("close").alias("last"), F.any_value("first").alias("first"), F.any_value("n").alias("n"))
    bounds = ranges.select("path").distinct().join(bounds, "path", "left")
    said = F.concat(F.lit("malformed GeoJSON document (no features array, or more than one): "), F.col("path"))
    bounds = materialize(bounds.select(F.when(F.col("n").eqNullSafe(F.lit(1)), F.col("path")).otherwise(F.raise_error(said)).alias("path"),
                                       "first", "last"))
    items = with_state.select("path", "block", "depth", "inside", "home", "value").mapInArrow(
        _items, "path string, home long, place long, part long, whole boolean, text string")
    parts = items.where("not whole").groupBy("path", "home").agg(
        F.max("place").alias("place"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("part", "text"))), lambda p: p["text"]), "").alias("text"))
    every = items.where("whole").select("path", "home", "place", "text").unionByName(parts.select("path", "home", "place", "text"))
    every = every.join(bounds, "path")
    within = (F.struct(F.col("home").alias("block"), "place") > F.col("first")) & (F.struct(F.col("home").alias("block"), "place") < F.col("last"))
    return every.where(within).select(F.col("text").alias("value"))
