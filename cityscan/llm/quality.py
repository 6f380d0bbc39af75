"""Quality by ordinal regression on graded ratings (cumulative-link model).

One score s = w . x is shared by all grades, x being hashed features of the text;
ordered thresholds cut it: P(grade <= k) = sigmoid(t_k - s). A document gets
its expected grade and the probability of reaching the grade that is selected for.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityscan.llm.common import with_ids

#: The least weight of a grade's rows, of all: a rare grade is not smoothed away.
LEAST_SHARE = 0.05

_BITS = 15
_NEW = ("expected_grade", "tail_prob", "selected")
_LETTERS, _DIGITS, _RUNS = re.compile(r"[^\W\d_]+"), re.compile(r"\d+"), re.compile(r"(.)\1+")


class _Tokens(dict):
    """word -> hashed features (the word, its first four letters, its shape), remembered up to a bound."""

    limit = 1 << 18

    def __missing__(self, word: str) -> tuple[int, ...]:
        shape = _RUNS.sub(r"\1", _DIGITS.sub("9", _LETTERS.sub("a", word)))
        low = word.lower()
        ids = tuple(xxhash.xxh64_intdigest(x) & ((1 << _BITS) - 1) for x in ("s " + shape, "w " + low, "4 " + low[:4]))
        if len(self) < self.limit:
            self[word] = ids
        return ids


_REPEAT = xxhash.xxh64_intdigest("repeat") & ((1 << _BITS) - 1)


def text_features(text: str | None, tokens: _Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and the square roots of their shares of the words; none for no words."""
    words = text.split() if text else []
    if not words:
        return np.zeros(0, np.int64), np.zeros(0)
    n = Counter(words)
    ids = np.array([i for w in n for i in tokens[w]] + [_REPEAT], np.int64)
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    at, place = np.unique(ids, return_inverse=True)
    share = np.bincount(place, [c for w in n for c in [n[w]] * 3] + [repeats]) / len(words)
    has = share > 0
    return at[has], np.sqrt(share[has])


@dataclass
class OrdinalModel:
    """Shared weights and the ordered thresholds between ``grades``."""

    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray

    def cumulative(self, s: float) -> np.ndarray:
        """P(grade <= k) for each grade."""
        return np.append(1 / (1 + np.exp(-np.clip(self.thresholds - s, -500, 500))), 1.0)


def fit_ordinal(lengths: np.ndarray, col: np.ndarray, val: np.ndarray, y: np.ndarray, grades: list[int],
                times: np.ndarray | None = None, l2: float = 1e-4, steps: int = 250) -> OrdinalModel:
    """Maximum likelihood by Adam; thresholds are a first one plus exponentials, so they stay in order.

    Row i has ``lengths[i]`` of the features ``col`` with values ``val``; ``y`` numbers its grade; it
    counts ``times[i]`` times (once, if not given).
    """
    width, n, k = 1 << _BITS, len(y), len(grades)
    row = np.repeat(np.arange(n), lengths)
    part = np.full(n, 1 / n) if times is None else times / times.sum()
    share = np.cumsum(np.bincount(y, part, minlength=k))[:-1]
    t = np.log(share / (1 - share))
    p = np.concatenate((np.zeros(width), [t[0]], np.log(np.maximum(np.diff(t), 1e-3))))
    m, v = np.zeros_like(p), np.zeros_like(p)
    for step in range(1, steps + 1):
        t = np.cumsum(np.concatenate(([p[width]], np.exp(p[width + 1:]))))
        s = np.bincount(row, val * p[col], n)
        cum = 1 / (1 + np.exp(-np.clip(t[None, :] - s[:, None], -500, 500)))
        f = np.concatenate((np.zeros((n, 1)), cum, np.ones((n, 1))), axis=1)
        hi, lo = f[np.arange(n), y + 1], f[np.arange(n), y]
        prob = np.maximum(hi - lo, 1e-12)
        g = np.zeros_like(p)
        g[:width] = np.bincount(col, val * (-(hi + lo - 1) * part)[row], width) + l2 * p[:width]
        slope = f * (1 - f) / prob[:, None] * part[:, None]
        dt = np.zeros(k + 1)
        np.add.at(dt, y + 1, -slope[np.arange(n), y + 1])
        np.add.at(dt, y, slope[np.arange(n), y])
        dt = dt[1:-1]
        later = np.cumsum(dt[::-1])[::-1]
        g[width] = later[0]
        g[width + 1:] = later[1:] * np.exp(p[width + 1:])
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    t = np.cumsum(np.concatenate(([p[width]], np.exp(p[width + 1:]))))
    return OrdinalModel(grades, p[:width], t)


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens = _Tokens()
    for b in batches:
        got = [text_features(t.as_py(), tokens) for t in b.column("text")]
        yield pa.RecordBatch.from_arrays(
            [b.column("grade"), pa.array([g[0].astype(np.int32) for g in got], pa.list_(pa.int32())),
             pa.array([g[1].astype(np.float32) for g in got], pa.list_(pa.float32()))], names=["grade", "ids", "values"])


def _shares(counts: dict[int, int], most: int) -> dict[int, float]:
    """The part of each grade's rows to read: as large as ``most`` rows allow in all, but a rare grade's rows first."""
    left, out = most, {}
    for i, (g, n) in enumerate(sorted(counts.items(), key=lambda x: (x[1], x[0]))):
        out[g] = min(1.0, left / (len(counts) - i) / n)
        left -= out[g] * n
    return out


def train(docs: DataFrame, ratings: DataFrame, doc_id: str = "doc_id", text: str = "text", grade: str = "grade",
          max_rows: int = 8_000) -> OrdinalModel:
    """Fit on about ``max_rows`` rated rows (a documented bound), chosen by a hash of the id: as many of each
    grade, or all of a grade that has fewer; rows count by the inverse of their grade's share, a grade's together
    at least ``LEAST_SHARE``.

    Rows without a grade are left out and a repeated rating counts as its
    smallest. With fewer than two grades every text gets that grade (0 if none).
    """
    rated = (ratings.where(F.col(grade).isNotNull() & F.col(doc_id).isNotNull())
             .groupBy(F.col(doc_id).alias("__id")).agg(F.min(grade).cast("int").alias("grade")))
    rows = with_ids(docs.select(F.col(doc_id).alias("__id"), F.col(text).alias("text")), rated, "__id", "inner")
    counts = {r["grade"]: r["count"] for r in rows.groupBy("grade").count().collect()}
    share = _shares(counts, max_rows)
    of_grade = F.lit(0).cast("long")
    for g, s in share.items():
        of_grade = F.when(F.col("grade") == g, int(s * (1 << 53))).otherwise(of_grade)
    sample = rows.where(F.pmod(F.xxhash64("__id"), F.lit(1 << 53)) < of_grade)
    got = sample.select("grade", "text").mapInArrow(_features, "grade int, ids array<int>, values array<float>").toArrow()
    y = got.column("grade").to_numpy()
    grades = [int(g) for g in np.unique(y)]
    if len(grades) < 2:
        return OrdinalModel(grades or [0], np.zeros(1 << _BITS), np.zeros(0))
    ids, values = got.column("ids").combine_chunks(), got.column("values").combine_chunks()
    lengths = np.diff(ids.offsets.to_numpy())
    total = sum(counts.values())
    times = np.array([max(counts[g], LEAST_SHARE * total) / (share[g] * counts[g]) for g in y.tolist()])
    return fit_ordinal(lengths, ids.values.to_numpy(), values.values.to_numpy(), np.searchsorted(grades, y), grades, times)


def rate(docs: DataFrame, model: OrdinalModel, select_grade: int, text: str = "text", least: float = 0.5) -> DataFrame:
    """``docs`` with ``expected_grade``, ``tail_prob`` = P(grade >= select_grade) and ``selected``
    (tail_prob >= least), in one pass over whole texts.

    A null or empty text has no features and gets the thresholds' own probabilities.
    Columns of those names are replaced.
    """
    kept = [c for c in docs.columns if c not in (*_NEW, "__text")]
    grades = np.array(model.grades, float)

    def run(batches):
        tokens = _Tokens()
        for b in batches:
            mean, tail = [], []
            for t in b.column("__text"):
                ids, values = text_features(t.as_py(), tokens)
                p = np.diff(model.cumulative(float(values @ model.weights[ids])), prepend=0.0)
                mean.append(float(p @ grades))
                tail.append(float(min(1.0, p[grades >= select_grade].sum())))
            yield pa.RecordBatch.from_arrays(
                [b.column(c) for c in kept] + [pa.array(mean, pa.float64()), pa.array(tail, pa.float64()),
                                               pa.array([x >= least for x in tail], pa.bool_())],
                names=[*kept, *_NEW])

    schema = docs.select(*kept).schema
    schema = schema.add("expected_grade", "double").add("tail_prob", "double").add("selected", "boolean")
    return docs.select(*kept, F.col(text).alias("__text")).mapInArrow(run, schema)
