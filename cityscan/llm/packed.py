"""Which hashes occur more than once: packed entries by hash bucket.

An entry is (hash, owner, position). A task folds its entries first: of a hash that
it meets more than once, one entry, marked as known, goes to the hash's bucket;
the others need no comparison any more and pass through buckets dealt by owner. So
a hash that a third of all owners have adds one entry a block to its bucket.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from cityscan.llm.common import mixed

ENTRY = "bucket int, hash binary, doc binary, pos binary, known binary"


class Buckets:
    """Collects (hash, doc, pos) and gives them packed, a row a bucket."""

    def __init__(self, buckets: int, most: int = 400_000):
        self.buckets, self.most, self.parts, self.size = buckets, most, [], 0

    def add(self, h: np.ndarray, doc: int, pos: np.ndarray) -> bool:
        self.parts.append((h, np.full(len(h), doc, np.int64), pos.astype(np.int32)))
        self.size += len(h)
        return self.size >= self.most

    def _packed(self, bucket, h, d, p, known) -> list[tuple]:
        order = np.argsort(bucket, kind="stable")
        bucket, d, p = bucket[order], d[order], p[order]
        ends = np.flatnonzero(np.diff(bucket)) + 1
        cuts = zip([0, *ends], [*ends, len(bucket)])
        if h is None:
            return [(int(bucket[a]), b"", d[a:b].tobytes(), p[a:b].tobytes(), b"") for a, b in cuts]
        h, known = h[order], known[order]
        return [(int(bucket[a]), h[a:b].tobytes(), d[a:b].tobytes(), p[a:b].tobytes(), known[a:b].tobytes()) for a, b in cuts]

    def take(self) -> pa.RecordBatch:
        h, d, p = (np.concatenate(x) for x in zip(*self.parts))
        self.parts, self.size = [], 0
        order = np.argsort(h, kind="stable")
        h, d, p = h[order], d[order], p[order]
        first = np.append(True, h[1:] != h[:-1])
        known = first & np.append(~first[1:], False)
        rows = self._packed((h[first] >> np.uint64(33)) % np.uint64(self.buckets), h[first], d[first], p[first], known[first])
        if not first.all():
            d, p = d[~first], p[~first]
            rows += self._packed(mixed(d.view(np.uint64)) % np.uint64(self.buckets), None, d, p, None)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, pa.int32() if i == 0 else pa.binary()) for i, c in enumerate(zip(*rows))],
            names=["bucket", "hash", "doc", "pos", "known"])


def _cuts(key: np.ndarray) -> list[tuple[int, int]]:
    """Where runs of equal values of a sorted array begin and end."""
    if not len(key):
        return []
    ends = np.flatnonzero(np.diff(key)) + 1
    return list(zip([0, *ends], [*ends, len(key)]))


def _joined(t: pa.Table, name: str, kind) -> np.ndarray:
    return np.frombuffer(b"".join(t.column(name).to_pylist()), kind)


#: What ``repeated`` gives: the repeated (owner, position), packed by a part of the owners.
REPEATED = "part int, doc binary, pos binary"
#: What ``by_owner`` gives: one row an owner, its positions packed in order.
OWNERS = "__row long, at binary"


def repeated(parts: int):
    """For one bucket: the entries whose hash is known to be repeated or occurs more than once."""

    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        passed = [not x for x in table.column("hash").to_pylist()]
        through, table = table.filter(pa.array(passed)), table.filter(pa.array([not x for x in passed]))
        h, twice = _joined(table, "hash", np.uint64), _joined(table, "known", bool).copy()
        order = np.argsort(h, kind="stable")
        same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
        twice[order[same]] = True
        twice[order[same + 1]] = True
        d = np.concatenate((_joined(table, "doc", np.int64)[twice], _joined(through, "doc", np.int64)))
        p = np.concatenate((_joined(table, "pos", np.int32)[twice], _joined(through, "pos", np.int32)))
        part = (mixed(d.view(np.uint64)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, d, p = part[order], d[order], p[order]
        cuts = _cuts(part)
        return pa.table({"part": pa.array([int(part[a]) for a, _ in cuts], pa.int32()),
                         "doc": pa.array([d[a:b].tobytes() for a, b in cuts], pa.binary()),
                         "pos": pa.array([p[a:b].tobytes() for a, b in cuts], pa.binary())})

    return run


def by_owner(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """For one part of the owners: each owner's repeated positions."""
    d, p = _joined(table, "doc", np.int64), _joined(table, "pos", np.int32)
    order = np.lexsort((p, d))
    d, p = d[order], p[order]
    cuts = _cuts(d)
    return pa.table({"__row": pa.array([int(d[a]) for a, _ in cuts], pa.int64()),
                     "at": pa.array([p[a:b].tobytes() for a, b in cuts], pa.binary())})


def repeated_by_owner(entries: DataFrame, buckets: int) -> DataFrame:
    """Packed entries (``ENTRY``) to one row an owner with its repeated positions."""
    return (entries.groupBy("bucket").applyInArrow(repeated(buckets), REPEATED)
            .groupBy("part").applyInArrow(by_owner, OWNERS))
