"""Helpers shared by the operators: words, folds, shared tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cityscan.session import checkpoint_dir

#: Fixed value: the ASCII white space that separates words.
SPACE = " \t\n\x0b\f\r"
WORD = r"[^\x20\x09-\x0D]+"

#: Bytes of rows, measured, that may be broadcast. Larger sides are shuffled.
BROADCAST_BYTES = 48 << 20


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column | str = "doc_id") -> Column:
    """The fold that no model learns from: crc32 of the id's text, mod 5, is 0."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) if isinstance(doc_id, str)
                      else F.crc32(doc_id.cast("string")), F.lit(0)) % 5 == 0


def split_words(text: Column) -> Column:
    """The words (runs of anything but ASCII white space) of a text; none for null."""
    trimmed = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))


# ---------------------------------------------------------------- tables


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path under the cluster's shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


#: The tables written inside the innermost ``scratch_tables``.
_scratch: list[list[DataFrame]] = []


def shared_table(df: DataFrame, name: str, kept: bool = False) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor rereads files, and the file sizes let
    AQE plan the joins that follow. ``kept``: not one of the enclosing ``scratch_tables``.
    """
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.table_path = path
    if _scratch and not kept:
        _scratch[-1].append(out)
    return out


@contextmanager
def scratch_tables() -> Iterator[None]:
    """Deletes, at its end, the shared tables written inside. What is still to be read has to be ``kept``."""
    _scratch.append([])
    try:
        yield
    finally:
        for table in _scratch.pop():
            drop_table(table)


def drop_table(table: DataFrame) -> None:
    """Delete a shared table that nothing still to be computed reads."""
    jvm = table.sparkSession._jvm
    path = jvm.org.apache.hadoop.fs.Path(table.table_path)
    path.getFileSystem(table.sparkSession._jsc.hadoopConfiguration()).delete(path, True)


def literal_table(spark: SparkSession, rows: list[tuple], schema: str) -> DataFrame:
    """A few constant rows as literals of the plan, without a Python task."""
    fields = ",".join(":".join(f.split()) for f in schema.split(","))
    rows_of = F.array(*[F.struct(*map(F.lit, r)) for r in rows]).cast(f"array<struct<{fields}>>")
    return spark.range(1, numPartitions=1).select(F.inline(rows_of))


def n_buckets(df: DataFrame, bytes_per_row_byte: float, text_col: str = "text",
              bucket_bytes: int = 8 << 20) -> int:
    """How many hash buckets keep one bucket near ``bucket_bytes``, from the whole text's size."""
    spark = df.sparkSession
    total = df.agg(F.sum(F.octet_length(text_col)).alias("n")).first()["n"] or 0
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(least, int(total * bytes_per_row_byte / bucket_bytes) + 1)


def row_bytes(df: DataFrame) -> int:
    """The bytes of all rows of a written table, some 32 a row besides its values."""
    size = F.lit(32)
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        each = (F.octet_length(f.name) if kind in ("string", "binary") else F.size(f.name) * 16 if kind == "array"
                else F.octet_length(F.to_json(f.name)) if kind in ("struct", "map") else F.lit(8))
        size = size + F.coalesce(each, F.lit(0))
    return int(df.agg(F.sum(size.cast("long")).alias("n")).first()["n"] or 0)


def checked_broadcast(table: DataFrame) -> DataFrame:
    """A written table, with the broadcast hint only if its measured bytes fit ``BROADCAST_BYTES``."""
    return F.broadcast(table) if row_bytes(table) <= BROADCAST_BYTES else table


def with_ids(df: DataFrame, ids: DataFrame, key: str | list[str], how: str = "left_semi") -> DataFrame:
    """Rows of ``df`` joined with the written table ``ids``, which is broadcast only if its
    measured bytes fit ``BROADCAST_BYTES``; beyond that both sides are shuffled."""
    return df.join(checked_broadcast(ids), key, how)


# ---------------------------------------------------------------- order


def in_order(df: DataFrame, keys: list[Column], name: str, group: list[str] | None = None,
             place: str = "place", value: str | None = None) -> DataFrame:
    """``df`` with ``place``: how many rows of the same ``group`` (of all, if none) stand before it in order of
    ``keys``, or the sum of their ``value``.

    Rows are range-partitioned on group, keys and a number that every row has alone, so neither a
    hot group nor equal rows meet in one task; only the partitions' sizes are added up. Equal rows
    stand in any order.
    """
    group = group or []
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = shared_table(df.withColumn("__alone", F.monotonically_increasing_id()), f"{name}-rows")
    order = [*[F.col(g).asc_nulls_first() for g in group], *keys, F.col("__alone")]
    row = F.monotonically_increasing_id()
    placed = shared_table(
        rows.repartitionByRange(n, *order).sortWithinPartitions(*order).drop("__alone")
        .withColumn("__part", F.shiftright(row, 33)).withColumn("__row", row.bitwiseAND(F.lit((1 << 33) - 1))), f"{name}-order")
    drop_table(rows)
    sizes = placed.groupBy("__part", *group).agg((F.sum(value) if value else F.count(F.lit(1))).alias("__n"), F.min("__row").alias("__first"))
    earlier = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.col("__part").alias("__p"), *[F.col(g).alias(f"__g{i}") for i, g in enumerate(group)], "__first",
                          F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__start"))
    same = F.col("__part") == F.col("__p")
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"__g{i}"))
    inside = F.col("__row") - F.col("__first")
    if value:  # a part's rows, bounded by the range partition, in their order
        inside = F.coalesce(F.sum(value).over(Window.partitionBy("__part", *group).orderBy("__row").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = placed.join(starts, same).withColumn(place, F.col("__start") + inside)
    out = out.select(*df.columns, place)
    out.table_path = placed.table_path
    return out


# ---------------------------------------------------------------- components


def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """``(node, comp)`` for every node of ``edges(a, b)``; comp is the smallest node reachable.

    Alternating large-star and small-star rounds, each written to a shared
    table; every round is grouped minima and joins, so a hub's edges are
    pre-aggregated and never meet in one task.
    """
    e = shared_table(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                     .where("a < b").distinct(), name)
    seen = None
    while True:
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(
            e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("m", "u").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).distinct()
        least = large.groupBy("b").agg(F.min("a").alias("m"))
        small = large.join(least, "b").select(
            F.col("m").alias("a"), F.when(F.col("a") == F.col("m"), F.col("b")).otherwise(F.col("a")).alias("b"))
        linked = large.join(least, "b").where("a != m").select(F.col("m").alias("a"), "b")
        new = shared_table(small.unionByName(linked).distinct(), name)
        state = new.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.col("a").cast("double"))).first()
        drop_table(e)
        e = new
        if state == seen:
            break
        seen = state
    roots = e.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct()
    return e.select(F.col("b").alias("node"), F.col("a").alias("comp")).unionByName(roots)


# ---------------------------------------------------------------- words in tasks


class WordHash(dict):
    """word (bytes) -> 64-bit hash, remembered for the first ``limit`` distinct words."""

    limit = 1 << 18

    def __missing__(self, word: bytes) -> int:
        h = xxhash.xxh64_intdigest(word)
        if len(self) < self.limit:
            self[word] = h
        return h


MIX = np.uint64(0x9E3779B97F4A7C15)


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def window_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """One 64-bit hash for each run of ``k`` consecutive word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = words[:n].copy()
    for j in range(1, k):
        h = mixed(h) * MIX + words[j:j + n]
    return mixed(h)


def text_bytes(column: pa.Array) -> Iterator[bytes | None]:
    """The UTF-8 bytes of each value of an Arrow string column, undecoded."""
    for x in column.cast(pa.large_binary()):
        yield x.as_py()


#: CRC-32 of text in DuckDB SQL: ``crc_table`` by its rule, and the fold over the UTF-8 bytes of a column.
CRC_TABLE_SQL = """SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                      lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS crc_table"""


def crc_sql(text: str) -> str:
    """The unsigned CRC-32 of a VARCHAR expression, where ``crc_table`` is in scope."""
    byte = f"('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT"
    return f"""xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, octet_length(encode({text})) + 1), lambda i: {byte})),
                   lambda a, b: xor(a >> 8, crc_table[(xor(a, b) & 255) + 1])), 4294967295)"""
