"""Removal of long repeated passages, found by difference-cover anchors.

A passage of ``window`` words that occurs twice starts at positions i and j. For
every pair of positions some shift d below the period makes both i + d and j + d
members, modulo the period, of the difference cover; so hashing short anchors
at cover positions only (5 of every 21) is enough: two occurrences share an
aligned anchor that lies wholly inside them. Anchors seen twice are extended to
every window around them, and a window counts as repeated if its own words occur
again.

Anchors and windows are shuffled packed, by hash bucket. A hash that a task meets
more than once is known to be repeated: one entry of it goes to its bucket, the
others pass through buckets dealt by document. So a passage that a third of all
documents share adds one entry a task to its bucket, not one a document.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityscan.llm.common import WordHash, drop_table, n_buckets, shared_table, text_bytes, window_hashes, with_ids
from cityscan.llm.packed import ENTRY, Buckets, repeated_by_owner

#: A perfect difference set; every residue mod 21 is a difference of two members.
PERIOD = 21
COVER = (3, 6, 7, 12, 14)

def cover_positions(n: int) -> np.ndarray:
    """The cover positions among 0 .. n - 1."""
    p = np.arange(max(0, n))
    return p[np.isin(p % PERIOD, COVER)]


def _anchors(buckets: int, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, out = WordHash(), Buckets(buckets)
        for b in batches:
            for doc, text in zip(b.column("__row").to_pylist(), text_bytes(b.column("__text"))):
                w = text.split() if text else []
                at = cover_positions(len(w) - width + 1)
                if not len(at):
                    continue
                h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
                if out.add(window_hashes(h, width)[at], doc, at):
                    yield out.take()
        if out.size:
            yield out.take()

    return run


def _windows(buckets: int, width: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, out = WordHash(), Buckets(buckets)
        for b in batches:
            for doc, text, at in zip(b.column("__row").to_pylist(), text_bytes(b.column("__text")), b.column("__at").to_pylist()):
                w = text.split()
                anchors = np.frombuffer(at, np.int32)
                # starts of the windows that hold an anchor
                near = np.zeros(len(w) + 1, np.int32)
                np.add.at(near, np.maximum(0, anchors - (window - width)), 1)
                np.add.at(near, anchors + 1, -1)
                starts = np.flatnonzero(np.cumsum(near[:-1])[:max(0, len(w) - window + 1)] > 0)
                if not len(starts):
                    continue
                h = np.fromiter(map(words.__getitem__, w), np.uint64, len(w))
                if out.add(window_hashes(h, window)[starts], doc, starts):
                    yield out.take()
        if out.size:
            yield out.take()

    return run


def covered(n: int, starts: np.ndarray, window: int) -> np.ndarray:
    """Which of ``n`` words lie in a window that begins at one of ``starts``."""
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, np.minimum(starts + window, n), -1)
    return np.cumsum(edge[:-1]) > 0


_NEW = ("n_words", "n_removed", "kept_sha256", "kept_text")


def _cleaned(window: int, kept: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, removed, digest, texts = [], [], [], []
            marks = b.column("__at").to_pylist() if "__at" in b.schema.names else [None] * b.num_rows
            for text, at in zip(text_bytes(b.column("__text")), marks):
                w = text.split() if text else []
                left = w
                if at:
                    gone = covered(len(w), np.frombuffer(at, np.int32), window)
                    left = [x for x, g in zip(w, gone) if not g]
                body = b" ".join(left)
                n.append(len(w))
                removed.append(len(w) - len(left))
                digest.append(hashlib.sha256(body).hexdigest())
                texts.append(body if at else text)
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in kept] + [pa.array(n, pa.int64()), pa.array(removed, pa.int64()),
                                               pa.array(digest, pa.string()), pa.array(texts, pa.binary()).cast(pa.string())],
                names=[*kept, *_NEW])

    return run


def _marks(entries: DataFrame, buckets: int, name: str) -> DataFrame:
    """``(row, at)``: the repeated positions of each row, packed."""
    return shared_table(repeated_by_owner(entries, buckets).withColumnRenamed("at", "__at"), name)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with n_words, n_removed, kept_sha256 and kept_text.

    Each word is removed that lies in a run of ``window`` words that also starts
    anywhere else, in the same document too; runs are judged on the input. A
    text that loses nothing is kept as it is, another is its kept words joined by
    blanks. A null or empty text has no words, and a text shorter than the window
    loses none. Rows that repeat an id and a text are copies of each other. Columns named
    like the new ones are replaced. Words are compared by 64-bit hashes of runs.
    """
    if window < PERIOD + 4:
        raise ValueError(f"the window must have at least {PERIOD + 4} words")
    width = window - PERIOD + 1
    kept = [c for c in docs.columns if c not in (*_NEW, "__row", "__text", "__at")]
    d = docs.select(*kept, F.xxhash64(doc_id, text).alias("__row"), F.col(text).alias("__text"))
    words = d.select("__row", "__text")
    buckets = n_buckets(words, 0.8, "__text")
    anchors = _marks(words.mapInArrow(_anchors(buckets, width), ENTRY), buckets, "substring-anchors")
    near = with_ids(words, anchors.select("__row"), "__row").join(anchors, "__row")
    marks = _marks(near.mapInArrow(_windows(buckets, width, window), ENTRY), buckets, "substring-windows")
    drop_table(anchors)

    schema = docs.select(*kept).schema
    for name, kind in zip(_NEW, ("long", "long", "string", "string")):
        schema = schema.add(name, kind)
    clean = _cleaned(window, kept)
    ids = marks.select("__row")
    return with_ids(d, ids, "__row", "left_anti").mapInArrow(clean, schema).unionByName(
        with_ids(d, ids, "__row").join(marks, "__row").mapInArrow(clean, schema))


#: The query's rows in DuckDB SQL, for unique ids.
ORACLE_SQL = r"""
  WITH d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
       p AS (SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
       s AS (SELECT r, i, array_to_string(w[i:i + 34], ' ') AS win FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
       t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY win) AS n FROM s) WHERE n > 1),
       c AS (SELECT p.r, p.i, p.word, coalesce(max(CASE WHEN t.i IS NOT NULL THEN 1 END) OVER (
                    PARTITION BY p.r ORDER BY p.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW), 0) AS gone
             FROM p LEFT JOIN t ON t.r = p.r AND t.i = p.i),
       k AS (SELECT r, sum(gone)::BIGINT AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (gone = 0) AS kept FROM c GROUP BY r)
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
  FROM d LEFT JOIN k USING (r)"""
