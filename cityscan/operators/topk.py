"""P2: top-k keys per period with their share of the period, then a lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def topk_share(
    df: DataFrame,
    period_col: str,
    key_col: str,
    k: int = 3,
    lookup: DataFrame | None = None,
    lookup_key: str | None = None,
    label_col: str | None = None,
    count_col: str = "count",
    out_label: str = "label",
    out_count: str = "count",
    out_share: str = "percent",
) -> DataFrame:
    """Count rows per (period, key); keep the k largest keys of each period.

    The period total and the rank are computed over **all** keys (NULL
    included) before the lookup; an inner lookup join then drops unmapped
    keys, so a period may show fewer than k rows. Ties in count are broken
    by the key (ascending, NULL first), so the result is deterministic.

    Output: period, label (or key), count, share text (two decimals with
    thousands separator), ``share_pct`` (double) and ``rank``; ordered by
    period descending, then rank.
    """
    counts = df.groupBy(period_col, key_col).agg(F.count(F.lit(1)).alias(count_col))
    # The total is an aggregate of its own: with no other window function beside
    # the rank, each task keeps its k largest keys of a period before the shuffle.
    totals = counts.groupBy(F.col(period_col).alias("_period")).agg(F.sum(count_col).alias("_total"))
    place = F.row_number().over(
        Window.partitionBy(period_col).orderBy(F.desc(count_col), F.asc_nulls_first(key_col)))
    best = counts.withColumn("rank", place).where(F.col("rank") <= k)
    share = F.col(count_col) / F.col("_total") * F.lit(100.0)
    ranked = best.join(totals, best[period_col].eqNullSafe(totals["_period"])).select(
        best["*"], share.alias("share_pct"), F.format_number(share, 2).alias(out_share))
    if lookup is not None:
        lk = lookup.select(
            F.col(lookup_key).alias("_lk"), F.col(label_col).alias(out_label)
        )
        ranked = ranked.join(lk, ranked[key_col] == lk["_lk"])
        label = F.col(out_label)
    else:
        label = F.col(key_col).alias(out_label)
    return ranked.select(
        period_col,
        label,
        F.col(count_col).alias(out_count),
        out_share,
        "share_pct",
        "rank",
    ).orderBy(F.desc(period_col), F.asc("rank"))
