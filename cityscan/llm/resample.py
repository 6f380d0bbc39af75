"""Importance resampling towards a target distribution, with an exact threshold draw.

Features are the runs of 1 to ``runs`` consecutive words of a text, repeats
counted, each hashed into one of ``buckets``. A bucket's gain is the log ratio
of its smoothed share in the target texts to its share in the raw ones, in
thousandths; a document's weight is the sum of its features' gains. Adding Gumbel noise from
a hash of the id and taking the highest scores draws without replacement with
chances in proportion to exp(weight).

Feature counts are added up by bucket in the tasks before they are shuffled;
the gains, one number a bucket, go to the tasks as an array. The draw sorts
nothing: scores are written once, and the cutoff is found by bisection of the
score's range, each job counting exactly how many scores lie above several
thresholds; then the same for the ids (and the rows) that tie at the cutoff. Only the
drawn rows are range-partitioned, for their ranks.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityscan.llm.common import CRC_TABLE_SQL, crc_sql, in_order, shared_table, text_bytes

#: Fixed values of the query: buckets, run length, seed, least words, share drawn in percent.
BUCKETS = 10_000
RUNS = 1
SEED = "2024"
LEAST_WORDS = 20
PERCENT = 10

#: Thresholds whose counts one job takes: as many as give five halvings of the range.
_HALVINGS = 5

#: Bytes of UTF-8 to bytes of words: A-Z in lower case, digits, a-z and all that is not ASCII kept, the rest blanks.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_FOLD).split() if text else []


def features_of(words: list[bytes], runs: int) -> Iterator[bytes]:
    """The features of more than one word, in order."""
    for k in range(2, runs + 1):
        for i in range(len(words) - k + 1):
            yield b" ".join(words[i:i + k])


class _Remembered(dict):
    """feature -> a number of its bucket, worked out once for the first ``limit`` distinct features."""

    limit = 1 << 18

    def __init__(self, of_bucket: list[int]):
        self.of_bucket = of_bucket

    def __missing__(self, feature: bytes) -> int:
        v = self.of_bucket[zlib.crc32(feature) % len(self.of_bucket)]
        if len(self) < self.limit:
            self[feature] = v
        return v


def bucket_counts(df: DataFrame, text: str = "text", buckets: int = BUCKETS, runs: int = RUNS) -> np.ndarray:
    """How many features of all texts fall into each bucket; the driver gets one number a bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, seen = np.zeros(buckets, np.int64), Counter()

        def add():
            np.add.at(n, [zlib.crc32(f) % buckets for f in seen], list(seen.values()))
            seen.clear()

        for batch in batches:
            for t in text_bytes(batch.column(0)):
                words = words_of(t)
                seen.update(words)
                seen.update(features_of(words, runs))
                if len(seen) > 1 << 18:
                    add()
        if seen:
            add()
        has = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(has), pa.array(n[has])], ["bucket", "n"])

    parts = df.select(F.col(text).cast("string")).mapInArrow(count, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in parts.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Each bucket's log ratio of shares, add-one smoothed, in whole thousandths."""
    b, s, t = len(raw), int(raw.sum()), int(target.sum())
    return np.array([math.floor(1000.0 * math.log((y + 1.0) * (s + b) / ((x + 1.0) * (t + b))))
                     for x, y in zip(raw.tolist(), target.tolist())], np.int64)


def gumbel(doc_id: Column, seed: str = SEED) -> Column:
    """Gumbel noise in whole thousandths from the first 32 bits of a sha256 of the id."""
    digits = F.sha2(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digits, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def score(docs: DataFrame, gain: np.ndarray, text: str = "text", doc_id: str = "doc_id", runs: int = RUNS,
          seed: str = SEED) -> DataFrame:
    """``docs`` without the text, with n_words, n_features, weight and score."""
    kept = [c for c in docs.columns if c not in (text, "n_words", "n_features", "weight", "score")]
    src = docs.select(*kept, F.col(text).cast("string").alias("__text"))
    schema = ", ".join(f"`{c}` {src.schema[c].dataType.simpleString()}" for c in kept)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain_of = _Remembered(gain.tolist())
        for batch in batches:
            numbers = ([], [], [])
            for t in text_bytes(batch.column(batch.num_columns - 1)):
                words = words_of(t)
                more = list(features_of(words, runs))
                for column, v in zip(numbers, (len(words), len(words) + len(more), sum(map(gain_of.__getitem__, words + more)))):
                    column.append(v)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *[pa.array(x, pa.int64()) for x in numbers]],
                [*batch.schema.names[:-1], "n_words", "n_features", "weight"])

    out = src.mapInArrow(weigh, f"{schema}{', ' if kept else ''}n_words long, n_features long, weight long")
    return out.withColumn("score", (F.col("weight") + gumbel(F.col(doc_id), seed)).cast("long"))


def _least_reaching(rows: DataFrame, value: str, k: int) -> tuple[int, int]:
    """The smallest ``v`` with at least ``k`` rows of ``value <= v``, and the number of rows of ``value < v``."""
    lo, hi = rows.agg(F.min(value), F.max(value)).first()
    below = 0
    while lo < hi:
        # thresholds between lo and hi; the counts say which part holds the answer
        cuts = sorted({lo + (hi - lo) * i // (1 << _HALVINGS) for i in range(1 << _HALVINGS)})
        n = rows.agg(*[F.count(F.when(F.col(value) <= c, 1)) for c in cuts]).first()
        at = next((i for i in range(len(cuts)) if n[i] >= k), len(cuts))
        if at > 0:
            lo, below = cuts[at - 1] + 1, n[at - 1]
        if at < len(cuts):
            hi = cuts[at]
    return lo, below


def draw(scored: DataFrame, k: int, keys: list[str]) -> Column:
    """The condition that holds for exactly the first ``k`` rows of the written table ``scored`` in
    ascending order of ``keys``, integer columns without nulls of which the last tells all rows apart."""
    taken, ties, left, rows = F.lit(False), F.lit(True), k, scored
    if k <= 0:
        return taken
    for key in keys:
        v, below = _least_reaching(rows, key, left)
        taken = taken | (ties & (F.col(key) < v))
        ties = ties & (F.col(key) == v)
        rows, left = rows.where(F.col(key) == v), left - below
    return taken | ties


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, least_words: int = LEAST_WORDS,
             doc_id: str = "doc_id", text: str = "text", target_text: str = "text", buckets: int = BUCKETS,
             runs: int = RUNS, seed: str = SEED) -> DataFrame:
    """All rows of ``docs`` without the text, with n_words, n_features, weight, score and rank (null: not drawn).

    Of the N rows with at least ``least_words`` words, floor(percent * N / 100) are drawn: the
    highest scores, ties to the smaller ``doc_id`` (an integer, null last), then to a hash of the text; equal rows are
    drawn one by one. A null text has no words; a null id is hashed as empty text. An empty
    table, raw or target, counts no features. Columns of the input named like the new ones are
    replaced; names that start with two underscores are the operator's own.
    """
    if docs.schema[doc_id].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError(f"{doc_id} must be an integer column")
    gain = gains(bucket_counts(docs, text, buckets, runs), bucket_counts(target, target_text, buckets, runs))
    new = ("n_words", "n_features", "weight", "score", "rank")
    kept = [c for c in docs.columns if c not in (text, *new)]
    last = F.lit((1 << 63) - 1)
    keyed = docs.select(*kept, text, F.coalesce(F.col(doc_id).cast("long"), last).alias("__id"),
                        F.col(doc_id).isNull().cast("int").alias("__null"), F.xxhash64(F.col(text)).alias("__hash"))
    scored = shared_table(score(keyed, gain, text, doc_id, runs, seed).withColumn("__down", -F.col("score"))
                          .withColumn("__own", F.monotonically_increasing_id()), "resample-scores")
    able = scored.where(F.col("n_words") >= least_words)
    order = ["__down", "__null", "__id", "__hash", "__own"]
    drawn = (F.col("n_words") >= least_words) & draw(able, able.count() * percent // 100, order)
    ranked = in_order(scored.where(drawn), [F.col(c) for c in order], "resample", place="__place")
    cols = [*kept, "n_words", "n_features", "weight", "score"]
    return ranked.select(*cols, (F.col("__place") + 1).cast("long").alias("rank")).unionByName(
        scored.where(~drawn).select(*cols, F.lit(None).cast("long").alias("rank")))


#: The same result in DuckDB SQL, for texts whose words are single features.
ORACLE_SQL = rf"""
  WITH c AS ({CRC_TABLE_SQL}),
       w AS (SELECT 0 AS side, rowid AS doc, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM (SELECT row_number() OVER () AS rowid, text FROM documents)
             UNION ALL
             SELECT 1, 0, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) FROM benchmark),
       b AS (SELECT word, {crc_sql("word")} % 10000 AS bucket FROM (SELECT DISTINCT word FROM w), c),
       n AS (SELECT bucket, count(*) FILTER (side = 0) AS s, count(*) FILTER (side = 1) AS t FROM w JOIN b USING (word) GROUP BY bucket),
       g AS (SELECT bucket, floor(1000e0 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM n) + 10000)::DOUBLE)
                                              / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM n) + 10000)::DOUBLE)))::BIGINT AS gain FROM n),
       d AS (SELECT doc, count(*) AS n, sum(gain) AS weight FROM w JOIN b USING (word) JOIN g USING (bucket) WHERE side = 0 GROUP BY doc),
       x AS (SELECT doc_id, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
                    ('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT::DOUBLE AS h
             FROM (SELECT row_number() OVER () AS rowid, doc_id FROM documents) LEFT JOIN d ON doc = rowid),
       y AS (SELECT *, (weight + floor(-1000e0 * ln(-ln((h + 0.5e0) / 4294967296e0))))::BIGINT AS score FROM x),
       z AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS able FROM y WHERE n_features >= 20)
  SELECT y.doc_id, n_features, weight, score, CASE WHEN place <= able * 10 // 100 THEN place END::BIGINT AS rank
  FROM y LEFT JOIN z USING (doc_id)"""
