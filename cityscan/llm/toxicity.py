"""A toxicity classifier that is held indifferent to which group a text names.

Features are the presence of each distinct word and of its first four and five
letters, hashed. The labelled rows are counted in full to choose the features that
tell the labels apart (chi-square); a logistic model over these is fitted on a
bounded sample. For each sampled text that names an identity term, copies are made
in which the term is swapped for each other term of its kind and for no term at
all, and the fit adds ``penalty`` times the mean squared change of the score. So
a group's name alone carries no weight, however often it stands in toxic rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityscan.llm.common import with_ids

#: Terms that name groups, by kind; swaps stay within a kind.
IDENTITY_TERMS = (
    ("women", "men", "girls", "boys", "females", "males"),
    ("woman", "man", "girl", "boy", "female", "male"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("black", "white", "asian", "latino", "african", "european", "arab"),
    ("gay", "straight", "lesbian", "bisexual", "transgender", "queer"),
    ("immigrants", "refugees", "foreigners", "natives", "citizens"),
    ("old", "young", "elderly", "teenage"),
    ("disabled", "deaf", "blind", "autistic"),
)

#: The least weight of a label's rows, of all: a rare label is not smoothed away.
LEAST_SHARE = 0.05

_SPACE_BITS = 20
_TOKEN = re.compile(r"\w+")


def _hash(text: str) -> int:
    return xxhash.xxh64_intdigest(text) & ((1 << _SPACE_BITS) - 1)


def word_features(word: str) -> tuple[int, ...]:
    """The hashed features of one lower-case word."""
    out = [_hash("w " + word)]
    if len(word) > 4:
        out.append(_hash("4 " + word[:4]))
    if len(word) > 5:
        out.append(_hash("5 " + word[:5]))
    return tuple(out)


class FeatureMap(dict):
    """word -> its features that the model uses (all if ``used`` is None), remembered up to a bound."""

    limit = 1 << 18

    def __init__(self, used: frozenset[int] | None = None):
        super().__init__()
        self.used = used

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = word_features(word)
        if self.used is not None:
            ids = tuple(i for i in ids if i in self.used)
        if len(self) < self.limit:
            self[word] = ids
        return ids


def distinct_words(text: str | None) -> set[str]:
    return set(_TOKEN.findall(text.lower())) if text else set()


def feature_set(words: set[str], features: FeatureMap) -> set[int]:
    return {i for ids in map(features.__getitem__, words) for i in ids}


def _texts(batch: pa.RecordBatch) -> Iterator[str | None]:
    for t in batch.column("text"):
        yield t.as_py()


def _count_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros((2, 1 << _SPACE_BITS), np.int32)
    features = FeatureMap()
    for b in batches:
        for y, text in zip(b.column("y").to_pylist(), _texts(b)):
            ids = feature_set(distinct_words(text), features)
            n[y, np.fromiter(ids, np.int64, len(ids))] += 1
    at = np.flatnonzero(n.sum(axis=0))
    for k in range(0, len(at), 50_000):
        a = at[k:k + 50_000]
        yield pa.RecordBatch.from_arrays(
            [pa.array(a), pa.array(n[0, a].astype(np.int64)), pa.array(n[1, a].astype(np.int64))],
            names=["feature", "n0", "n1"])


def swaps(words: set[str], kinds=IDENTITY_TERMS) -> list[set[str]]:
    """The word sets in which one identity term is swapped for another of its kind, or left out."""
    out = []
    for kind in kinds:
        for term in kind:
            if term in words:
                rest = words - {term}
                out.append(rest)
                out += [rest | {other} for other in kind if other not in words]
    return out


def _sample_rows(used: frozenset[int], kinds):
    def run(batches):
        features = FeatureMap(used)
        for b in batches:
            ys, xs, cs = b.column("y").to_pylist(), [], []
            for text in _texts(b):
                words = distinct_words(text)
                x = feature_set(words, features)
                xs.append(sorted(x))
                # a swap is the features that it takes away, then those that it brings
                cs.append([sorted(-1 - i for i in x - c) + sorted(c - x) for c in (feature_set(w, features) for w in swaps(words, kinds))])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ys, pa.int32()), pa.array(xs, pa.list_(pa.int32())),
                 pa.array(cs, pa.list_(pa.list_(pa.int32())))], names=["y", "x", "changes"])

    return run


@dataclass
class ToxicityModel:
    """Weights by feature and the intercept."""

    bias: float = -1.0
    weights: dict[int, float] = field(default_factory=dict)

    def score(self, words: set[str], features: FeatureMap) -> float:
        z = self.bias + sum(self.weights[i] for i in sorted(feature_set(words, features)))
        return float(1 / (1 + np.exp(-np.clip(z, -500, 500))))


class _Rows:
    """Sparse rows of 0, 1 and, for numbers below 0 (``-1 - i``), -1."""

    def __init__(self, rows: list[list[int]], width: int):
        self.width, self.n = width, len(rows)
        self.row = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
        col = np.array([c for r in rows for c in r], np.int64)
        self.sign = np.where(col < 0, -1.0, 1.0)
        self.col = np.where(col < 0, -1 - col, col)

    def dot(self, w):
        return np.bincount(self.row, self.sign * w[self.col], self.n)

    def back(self, g):
        return np.bincount(self.col, self.sign * g[self.row], self.width)


def fit_weights(x: list[list[int]], y: np.ndarray, changes: list[list[list[int]]], width: int,
                penalty: float, l2: float, steps: int = 500, times: np.ndarray | None = None) -> tuple[np.ndarray, float]:
    """Minimise mean log loss + l2 |w|^2 / 2 + penalty * mean (score change by a swap)^2, by Adam.

    A row counts ``times`` in the mean of the loss (once, if not given).
    """
    rows = _Rows(x, width)
    swaps_ = _Rows([s for group in changes for s in group], width)
    times = np.ones(len(y)) if times is None else times
    times = times / max(times.sum(), 1.0)
    w, bias = np.zeros(width), float(np.log(((times * y).sum() * len(y) + 0.5) / ((times * (1 - y)).sum() * len(y) + 1.5)))
    m, v = np.zeros(width + 1), np.zeros(width + 1)
    for step in range(1, steps + 1):
        z = rows.dot(w)
        r = (1 / (1 + np.exp(-np.clip(z + bias, -500, 500))) - y) * times
        g = rows.back(r) + l2 * w
        if swaps_.n:
            g += swaps_.back(2 * penalty * swaps_.dot(w) / swaps_.n)
        g = np.append(g, r.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        move = 0.05 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
        w, bias = w - move[:-1], bias - move[-1]
    return w, bias


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic",
          kinds=IDENTITY_TERMS, max_rows: int = 20_000, max_features: int = 4096, penalty: float = 10.0,
          l2: float = 1e-5) -> ToxicityModel:
    """Fit on the labelled rows of ``docs``.

    All labelled rows are counted to choose ``max_features`` features; the fit
    itself reads about ``max_rows`` of them (a documented bound), chosen by a
    hash of the id: half for each label, or all of a label that has fewer, so a rare label is
    not thinned out; rows count by the inverse of their label's share, a label's together at least ``LEAST_SHARE``. A row without label is left out, a repeated label counts as
    its largest, a null text has no features; no labelled rows give a score
    below 0.5 for every text.
    """
    lab = (labels.where(F.col(label).isNotNull() & F.col(doc_id).isNotNull())
           .groupBy(F.col(doc_id).alias("__id")).agg((F.max(label) > 0).cast("int").alias("y")))
    rows = with_ids(docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")), lab, "__id", "inner")
    counts = (rows.select("y", "text").mapInArrow(_count_features, "feature long, n0 long, n1 long")
              .groupBy("feature").agg(F.sum("n0").alias("a"), F.sum("n1").alias("b")))
    size = rows.groupBy("y").count().collect()
    n0, n1 = (sum(r["count"] for r in size if r["y"] == k) for k in (0, 1))
    if not n0 or not n1:
        return ToxicityModel(bias=float(np.log((n1 + 0.5) / (n0 + 1.5))))
    # chi-square of the 2 x 2 table, up to a constant
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    chi = F.pow(a * n1 - b * n0, 2) / ((a + b) * (n0 + n1 - a - b + 1))
    best = counts.select("feature", chi.alias("chi")).orderBy(F.desc("chi"), "feature").limit(max_features)
    used = frozenset([r["feature"] for r in best.collect()] +
                     [i for kind in kinds for term in kind for i in word_features(term)])
    few = min(n0, n1, max_rows // 2)
    quota = {0: min(n0, max(max_rows // 2, max_rows - few)), 1: min(n1, max(max_rows // 2, max_rows - few))}
    share = {0: quota[0] / n0, 1: quota[1] / n1}
    of_label = F.when(F.col("y") == 1, int(share[1] * (1 << 53))).otherwise(int(share[0] * (1 << 53)))
    sample = rows.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 53)) < of_label)
    got = (sample.select("y", "text")
           .mapInArrow(_sample_rows(used, kinds), "y int, x array<int>, changes array<array<int>>").toArrow())
    order = sorted(used)
    at = {f: i for i, f in enumerate(order)}
    at |= {-1 - f: -1 - i for f, i in at.items()}
    data = sorted(zip(got.column("x").to_pylist(), got.column("y").to_pylist(), got.column("changes").to_pylist()))
    x = [[at[f] for f in r[0]] for r in data]
    changes = [[[at[f] for f in s] for s in r[2]] for r in data]
    y = np.array([r[1] for r in data], float)
    each = [max(n, LEAST_SHARE * (n0 + n1)) / quota[k] for k, n in enumerate((n0, n1))]
    w, bias = fit_weights(x, y, changes, len(order), penalty, l2, times=np.where(y == 1, each[1], each[0]))
    return ToxicityModel(bias, {f: float(v) for f, v in zip(order, w) if abs(v) > 1e-6})


def score(docs: DataFrame, model: ToxicityModel, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1) and ``predicted`` (1 if score >= 0.5), in one pass.

    Whole texts are read; a null or empty text gets the score of no words.
    Columns named score or predicted are replaced.
    """
    kept = [c for c in docs.columns if c not in ("score", "predicted", "__text")]

    def run(batches):
        features = FeatureMap(frozenset(model.weights))
        for b in batches:
            s = [model.score(distinct_words(t.as_py()), features) for t in b.column("__text")]
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in kept] + [pa.array(s, pa.float64()), pa.array([int(v >= 0.5) for v in s], pa.int32())],
                names=[*kept, "score", "predicted"])

    schema = docs.select(*kept).schema.add("score", "double").add("predicted", "integer")
    return docs.select(*kept, F.col(text).alias("__text")).mapInArrow(run, schema)
