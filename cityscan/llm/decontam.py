"""Benchmark decontamination: short test items inside long documents, in DataFrame functions only.

An item is found in a document if the document holds at least 80 % of its distinct
five-word shingles. Items are partitioned by size. A partition whose items have at
most u shingles gets MinHash sketches of u - ceil(0.8 u) + 1 values: the shingles
with the smallest hashes. A document with enough of an item's shingles lacks fewer
than that, so it holds one of the sketch at least: containment search by sketch
loses nothing, whatever the document's length. A document with fewer shingles
than the item needs is no candidate. Candidates are verified by the exact number of
the item's shingles, as text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cityscan.llm.common import checked_broadcast, shared_table, split_words, with_ids

SHINGLE_WORDS = 5
#: Containment of at least this many hundredths.
LEAST_PERCENT = 80

_KEY, _ITEM = "__doc_key", "__item_key"


def lower_words(text: Column) -> Column:
    """The words to shingle. Select this as a column first: inside a lambda it would be split anew for each shingle."""
    return split_words(F.lower(text))


def shingles(words: Column, of, k: int = SHINGLE_WORDS) -> Column:
    """``of(word, ..., word)`` for each run of ``k`` of the column ``words``, in order.

    Fewer words are one run, filled up with nulls; no word gives no run. Words are
    taken by place: slicing an array copies all of it each time. Explode the result with
    ``explode_outer`` and drop nulls: for a plain explode the optimizer adds a filter on
    the array's size, into which it writes out the words' whole expression.
    """
    n = F.size(words)
    first = F.sequence(F.lit(0), F.greatest(F.lit(0), n - k))
    runs = F.transform(first, lambda i: of(*[F.get(words, i + j) for j in range(k)]))
    return F.when(n > 0, runs).otherwise(F.slice(runs, 1, 0))


def as_text(*run: Column) -> Column:
    return F.concat_ws(" ", *run)


def least_shared(n: Column, percent: int = LEAST_PERCENT) -> Column:
    return F.ceil(n * percent / F.lit(100.0)).cast("long")


def document_runs(words: Column, of, short: list[int]) -> Column:
    """A document's shingles, and its runs of each of the ``short`` lengths that items have."""
    n, out = F.size(words), [shingles(words, of)]
    for m in short:
        runs = shingles(words, lambda *run, m=m: of(*run[:m], *[F.lit(None).cast("string")] * (SHINGLE_WORDS - m)), m)
        out.append(F.when(n > m, runs).otherwise(F.slice(runs, 1, 0)))
    return F.concat(*out) if short else out[0]


def item_shingles(items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """``(item key, item_id, shingle, m)``: the distinct shingles of each item and their number."""
    s = items.select(F.xxhash64(item_id, text).alias(_ITEM), F.col(item_id).alias("item_id"), lower_words(F.col(text)).alias("w"))
    s = s.select(_ITEM, "item_id", F.explode_outer(shingles(F.col("w"), as_text)).alias("shingle")).where(F.col("shingle").isNotNull()).distinct()
    return s.withColumn("m", F.count(F.lit(1)).over(Window.partitionBy(_ITEM, "item_id")))


def sketches(items: DataFrame, percent: int = LEAST_PERCENT) -> DataFrame:
    """``(item key, hash, need)``: of each item the smallest hashes, as many as its size partition asks for.

    Partitions end at powers of two. ``items`` is the output of ``item_shingles``.
    """
    upper = F.pow(F.lit(2.0), F.ceil(F.log2("m"))).cast("long")
    k = upper - least_shared(upper, percent) + 1
    words = F.split("shingle", " ")
    h = items.withColumn("hash", F.xxhash64(*[F.get(words, F.lit(j)) for j in range(SHINGLE_WORDS)]))
    rank = F.row_number().over(Window.partitionBy(_ITEM).orderBy("hash", "shingle"))
    return (h.withColumn("k", k).withColumn("r", rank).where("r <= k")
            .select(_ITEM, "hash", least_shared(F.col("m"), percent).alias("need")))


def contained(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
              item_id: str = "item_id", item_text: str = "text", percent: int = LEAST_PERCENT) -> DataFrame:
    """``(doc_id, item_id, n_item, n_shared, doc key)`` of every item found in a document.

    A document or item without words (null, empty) takes part in nothing. An item of
    fewer than five words is one run of words, and a document's runs of as many words are compared
    with it. Rows that repeat an id and a text count once; rows that share only
    the id are rows of their own.
    """
    d = docs.select(F.xxhash64(doc_id, text).alias(_KEY), F.col(doc_id).alias("doc_id"), F.col(text).alias("__text"))
    known = shared_table(item_shingles(items, item_id, item_text), "decontam-items")
    probe = shared_table(sketches(known, percent), "decontam-sketches")
    lengths = known.select(F.size(F.split("shingle", " ")).alias("k")).where(F.col("k") < SHINGLE_WORDS).distinct()
    short = sorted(r["k"] for r in lengths.collect())  # 1 to 4
    grams = d.select(_KEY, lower_words(F.col("__text")).alias("w")).select(_KEY, document_runs(F.col("w"), F.xxhash64, short).alias("s"))
    grams = grams.select(_KEY, F.size("s").alias("n"), F.explode_outer("s").alias("hash"))
    found = (grams.join(checked_broadcast(probe), "hash").where("n >= need").select(_KEY, _ITEM).distinct())
    found = shared_table(found, "decontam-candidates")

    # verification: only candidates' texts, only shingles of the items they may hold
    keys = shared_table(found.select(_KEY).distinct(), "decontam-documents")
    texts = with_ids(d, keys, _KEY).distinct()
    words = texts.select(_KEY, "doc_id", lower_words(F.col("__text")).alias("w")).select(
        _KEY, "doc_id", F.explode_outer(F.array_distinct(document_runs(F.col("w"), as_text, short))).alias("shingle"))
    hits = words.join(checked_broadcast(known), "shingle").groupBy(_KEY, "doc_id", _ITEM, "item_id").agg(
        F.count(F.lit(1)).alias("n_shared"), F.max("m").alias("n_item"))
    hits = hits.join(checked_broadcast(found), [_KEY, _ITEM], "left_semi")
    return hits.where(F.col("n_shared") >= least_shared(F.col("n_item"), percent)).select(
        "doc_id", "item_id", "n_item", "n_shared", F.col(_KEY).alias("doc_key"))


def without_items(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", **kw) -> DataFrame:
    """The rows of ``docs`` in which no item is found; columns and repeated rows are kept."""
    hit = shared_table(contained(docs, items, doc_id, text, **kw).select(F.col("doc_key").alias(_KEY)).distinct(),
                       "decontam-hits")
    return with_ids(docs.withColumn(_KEY, F.xxhash64(doc_id, text)), hit, _KEY, "left_anti").select(*docs.columns)


ORACLE_SQL = r"""
  WITH d AS (SELECT DISTINCT doc_id, text,
               list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
       b AS (SELECT DISTINCT item_id, text,
               list_filter(string_split_regex(lower(text), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
       ds AS (SELECT DISTINCT doc_id, text, array_to_string(w[i:i+4], ' ') AS s
              FROM (SELECT doc_id, text, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM d WHERE len(w) > 0)),
       bs AS (SELECT DISTINCT item_id, text, array_to_string(w[i:i+4], ' ') AS s
              FROM (SELECT item_id, text, w, unnest(range(1, greatest(1, len(w) - 4) + 1)) AS i FROM b WHERE len(w) > 0)),
       k AS (SELECT DISTINCT len(w) AS k FROM b WHERE len(w) BETWEEN 1 AND 4),
       es AS (SELECT * FROM ds UNION
              SELECT doc_id, text, array_to_string(w[i:i + k - 1], ' ')
              FROM (SELECT doc_id, text, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, k WHERE len(w) > k)),
       m AS (SELECT item_id, text, count(*) AS n FROM bs GROUP BY ALL)
  SELECT doc_id, item_id, n_item, n_shared
  FROM (SELECT es.doc_id, es.text AS t, bs.item_id, bs.text AS u, any_value(m.n)::BIGINT AS n_item, count(*)::BIGINT AS n_shared
        FROM es JOIN bs USING (s) JOIN m ON m.item_id = bs.item_id AND m.text = bs.text GROUP BY ALL)
  WHERE n_shared * 100 >= n_item * 80"""
