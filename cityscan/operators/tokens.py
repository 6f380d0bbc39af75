"""P3: frequency of codes packed in a space-separated field, with a lookup."""

from __future__ import annotations

import re
import uuid
import warnings

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cityscan.session import checkpoint_dir

# Join strategies a user can pick for the lookup join. "auto" leaves the
# choice to the planner (a small lookup is broadcast by its size estimate);
# the others force the named physical join.
STRATEGY_HINTS = {
    "auto": None,
    "merge": "merge",
    "shuffle_hash": "shuffle_hash",
    "broadcast": "broadcast",
}


def token_counts(df: DataFrame, text_col: str, token_col: str = "token", sep: str = " ") -> DataFrame:
    """Explode the tokens of ``text_col``, parted by the literal text ``sep``, and count each one.

    Empty tokens (from doubled or trailing separators) are dropped; a NULL
    field contributes nothing. Counting is partial per task before the
    shuffle, so a hot token costs one row per task, not one per occurrence.
    """
    return (
        df.select(F.explode(F.split(F.col(text_col), re.escape(sep))).alias(token_col))
        .where(F.col(token_col) != "")
        .groupBy(token_col)
        .agg(F.count(F.lit(1)).alias("count"))
    )


def with_lookup(
    counts: DataFrame,
    lookup: DataFrame,
    left_key: str,
    right_key: str,
    desc_col: str,
    strategy: str = "auto",
    broadcast_max_bytes: int = 64 << 20,
) -> DataFrame:
    """Inner join of token counts to a code list; codes with no description drop.

    ``strategy="broadcast"`` first measures the lookup (one aggregate over it); if
    its rows as text exceed ``broadcast_max_bytes`` it warns and leaves the
    join to the planner.
    """
    if strategy not in STRATEGY_HINTS:
        raise ValueError(
            f"strategy must be one of {sorted(STRATEGY_HINTS)}; all-pairs nested loops are not offered"
        )
    hint = STRATEGY_HINTS[strategy]
    left = counts
    if hint == "broadcast":
        size = lookup.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("n")).first()["n"] or 0
        if size <= broadcast_max_bytes:
            lookup = F.broadcast(lookup)
        else:
            warnings.warn(f"lookup of {size} bytes exceeds broadcast_max_bytes; the planner chooses the join", stacklevel=2)
    elif hint is not None:
        left = counts.hint(hint)
    joined = left.join(lookup, left[left_key] == lookup[right_key])
    return joined.select(left[left_key], lookup[desc_col], left["count"]).orderBy(
        F.desc("count"), F.asc(left_key)
    )


def save_bucketed(df: DataFrame, key: str, buckets: int = 64) -> DataFrame:
    """``df`` written once as a table bucketed and sorted by ``key``, under the shared checkpoint folder.

    Two such tables with as many buckets meet in a merge join, also again and again, without a shuffle or a
    sort: ``with_lookup(save_bucketed(counts, ...), save_bucketed(lookup, ...), ..., strategy="merge")``.
    A bucket is one file, so the table should hold one row a key, as counts and lookups do.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    path = f"{checkpoint_dir(spark).rstrip('/')}/{name}"
    (df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).format("parquet").saveAsTable(name))
    return spark.table(name)
