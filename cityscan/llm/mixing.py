"""Mixing sources to target weights by weighted sampling without replacement.

Targets: the sources, in order of code point with null last, weigh 5, 2, 1,
repeating, and share the words of all documents; a target stops at three times
its source's size and the excess is shared again by weight. That is a level
``t`` with target = min(3 * size, t * weight) and the targets adding up to all words.

Sample: a source's target is taken as whole epochs of all its documents first.
The rest is drawn after Efraimidis and Spirakis: each document gets the key
-ln(u) / weight, u being a hash of its id, and documents are taken in order of
key until the words taken meet the rest of the target; the last one is cut
where the target is met.

No source is sorted as a whole. Keys fall into bins of equal width in ln(key);
a bin holds less than 0.05 % of a source whatever the weights are. Words are
added up by (source, bin) before the shuffle, the bin in which the target is
met follows from those sums, and only its documents are sorted, by a range
partition: rows that share an id, and with it key and bin, are not one task's either.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityscan.llm.common import checked_broadcast, in_order, shared_table, split_words

#: Weights of the sources in turn, the most epochs, the key's seed.
WEIGHTS = (5, 2, 1)
MOST_EPOCHS = 3
SEED = "mix-1"

_BINS = 1024
_KEEP = ("size", "source_size", "target", "taken")


def quality_weight(text: Column, words: Column) -> Column:
    """A document's weight, 0.25 to 1: how near its mean word length is to six letters."""
    mean = (F.length(text) - words + 1) / F.greatest(words, F.lit(1))
    return F.coalesce(F.greatest(F.lit(0.25), F.lit(1.0) - F.abs(mean - 6.0) / 12.0), F.lit(0.25))


def sample_key(doc_id: Column, weight: Column) -> Column:
    """-ln(u) / weight with u in (0, 1) from the first 52 bits of an md5 of the id."""
    digits = F.substring(F.md5(F.concat(F.lit(SEED + "|"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(1 << 52)
    return -F.log(u) / weight


def source_targets(sizes: DataFrame) -> DataFrame:
    """``(source, size)`` with one row a source, to ``(source, size, target)``.

    The rows are one a source, so ordering them in one task is bounded by the number of sources.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(x) for x in WEIGHTS]), ((F.row_number().over(by_name) - 1) % len(WEIGHTS) + 1).cast("int"))
    s = sizes.withColumn("w", w).withColumn("cap", F.col("size") * MOST_EPOCHS)
    s = s.withColumn("level", F.col("cap") / F.col("w"))
    order = Window.orderBy("level", F.col("source").asc_nulls_last())
    capped = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("w").over(order.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    every = Window.partitionBy()
    s = s.withColumn("t", (F.sum("size").over(every) - capped) / left)
    s = s.withColumn("t", F.min(F.when(F.col("t") <= F.col("level"), F.struct("level", "source", "t"))).over(every)["t"])
    return s.select("source", "size", F.least(F.col("cap").cast("double"), F.col("t") * F.col("w")).alias("target"))


def mix(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
        weight=quality_weight) -> DataFrame:
    """All rows of ``docs`` with size, source_size, target and taken (words, repeats counted).

    ``weight(text, words)`` gives a document's quality weight; it must be positive.
    A null text has size 0 and takes 0; a null source is a source of its own.
    Rows that share an id are rows of their own, drawn one after the other; the
    result depends only on ids, texts and sources. An empty table stays empty.
    Columns of the input named like the new ones are replaced.
    """
    kept = [c for c in docs.columns if c not in _KEEP]
    words = F.size(split_words(F.col(text))).cast("long")
    d = docs.select(*kept, words.alias("size"), F.col(source).alias("__source"))
    d = d.withColumn("__key", sample_key(F.col(doc_id), weight(F.coalesce(F.col(text), F.lit("")), F.col("size"))))
    d = d.withColumn("__bin", F.coalesce(F.floor(F.log("__key") * _BINS), F.lit(0)))

    bins = shared_table(d.groupBy(F.col("__source").alias("source"), F.col("__bin").alias("bin"))
                        .agg(F.sum("size").alias("size")), "mix-bins")
    targets = source_targets(bins.groupBy("source").agg(F.sum("size").alias("size")))
    per = targets.select(
        F.col("source").alias("s2"), F.col("size").alias("total"), "target",
        F.when(F.col("size") > 0, F.floor(F.col("target") / F.col("size"))).otherwise(0).alias("epochs"))
    per = per.withColumn("rest", F.floor(F.col("target") - F.col("epochs") * F.col("total")))
    running = F.sum("size").over(Window.partitionBy("source").orderBy("bin"))
    edge = (bins.withColumn("upto", running)
            .join(per, F.col("source").eqNullSafe(F.col("s2")))
            .where(F.col("upto") > F.col("rest"))
            .groupBy("s2").agg(F.min(F.struct("bin", (F.col("upto") - F.col("size")).alias("before"))).alias("edge")))
    info = shared_table(
        per.join(edge.withColumnRenamed("s2", "s3"), F.col("s2").eqNullSafe(F.col("s3")), "left")
        .select(F.col("s2").alias("__s"), F.col("total").alias("source_size"), "target",
                F.col("epochs").alias("__epochs"), F.col("rest").alias("__rest"),
                F.col("edge.bin").alias("__edge"), F.col("edge.before").alias("__before")), "mix-targets")
    d = d.join(checked_broadcast(info), F.col("__source").eqNullSafe(F.col("__s")))

    whole = d.where(F.col("__edge").isNull() | (F.col("__bin") != F.col("__edge")))
    whole = whole.withColumn("__part", F.when(F.col("__edge").isNull() | (F.col("__bin") > F.col("__edge")), F.lit(0))
                             .otherwise(F.col("size")).cast("long"))
    at_edge = in_order(d.where(F.col("__bin") == F.col("__edge")).withColumn("__hash", F.xxhash64(text)),
                       [F.col("__key"), F.col(doc_id).asc_nulls_first(), F.col("__hash")], "mix-edge", ["__source"], "__earlier", "size")
    room = F.col("__rest") - F.col("__before") - F.col("__earlier")
    at_edge = at_edge.withColumn("__part", F.greatest(F.lit(0), F.least(F.col("size"), room)).cast("long"))
    taken = (F.col("__epochs") * F.col("size") + F.col("__part")).cast("long").alias("taken")
    cols = [*kept, "size", F.col("source_size").cast("long").alias("source_size"), "target", taken]
    return whole.select(*cols).unionByName(at_edge.select(*cols))


#: The same result in DuckDB SQL, with each source ordered as a whole.
ORACLE_SQL = r"""
  WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
                    length(coalesce(text, '')) AS chars, coalesce(doc_id::VARCHAR, '') AS id FROM documents),
       k AS (SELECT *, -ln((('0x' || substr(md5('mix-1|' || id), 1, 13))::BIGINT::DOUBLE + 0.5e0) / 4503599627370496e0)
                       / greatest(0.25e0, 1e0 - abs((chars - size + 1) / greatest(size, 1)::DOUBLE - 6e0) / 12e0) AS key FROM d),
       s AS (SELECT source, sum(size)::BIGINT AS size FROM d GROUP BY source),
       w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w FROM s),
       l AS (SELECT *, (3 * size)::DOUBLE / w AS level FROM w),
       o AS (SELECT *, coalesce(sum(3 * size) OVER (ORDER BY level, source NULLS LAST
                                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS capped,
                    sum(w) OVER (ORDER BY level, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open,
                    sum(size) OVER () AS total FROM l),
       t AS (SELECT *, (total - capped)::DOUBLE / open::DOUBLE AS t FROM o),
       g AS (SELECT t AS lift FROM t WHERE t <= level ORDER BY level, source NULLS LAST LIMIT 1),
       p AS (SELECT source, size AS source_size, least((3 * size)::DOUBLE, lift * w) AS target FROM t, g),
       e AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs FROM p),
       r AS (SELECT k.doc_id, k.size, e.source_size, e.target, e.epochs, floor(e.target - e.epochs * e.source_size) AS rest,
                    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id ROWS UNBOUNDED PRECEDING) - k.size AS before
             FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source)
  SELECT doc_id, size, source_size, target, (epochs * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM r"""
