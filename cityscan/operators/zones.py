"""P5/P6: zone attributes, per-zone and per-community roll-ups, correlations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cityscan.functions.clean import money_to_int
from cityscan.functions.stats import safe_corr


def zone_income(
    zones: DataFrame,
    income: DataFrame,
    zone_zip: str,
    income_zip: str,
    income_text: str,
    housing_col: str,
    out_col: str = "Income_per_block",
    check_unique: bool = True,
) -> DataFrame:
    """Join zones to a zip → median-income table; income per zone = housing × income.

    The zone zip is text: it is cast tolerantly, so a malformed code drops the
    zone (inner join) instead of failing the query. Income text such as
    ``"$52,806"`` is parsed; ``N/A`` gives a NULL income. With
    ``check_unique`` the lookup is reduced to one row per zip (zones are
    never duplicated) and a zone whose zip repeats raises when its income is
    computed, instead of silently picking one.
    """
    inc = income.select(
        F.col(income_zip).try_cast("int").alias("_zip"),
        money_to_int(F.col(income_text)).alias("_income"),
    )
    z = zones.withColumn("_zip", F.col(zone_zip).try_cast("int"))
    value = F.col(housing_col) * F.col("_income")
    if check_unique:
        # one row per zip, so a repeated zip can never repeat its zones; an
        # ambiguous income raises inside the query when it is used
        inc = inc.groupBy("_zip").agg(F.count(F.lit(1)).alias("_n"), F.first("_income").alias("_income"))
        value = F.when(F.col("_n") > 1, F.raise_error(
            F.concat(F.lit("income lookup has repeated zip code "), F.col("_zip").cast("string")))
        ).otherwise(value)
    out = z.join(inc, "_zip").withColumn(out_col, value)
    return out.drop("_zip", "_income", "_n")


def unique_zones(zones: DataFrame, zone_key: str) -> DataFrame:
    """One row per zone key.

    Rows that repeat a zone are merged; a key whose rows differ in any other
    column fails the query, so that no point or attribute counts twice. Rows
    without a key go.
    """
    others = [c for c in zones.columns if c != zone_key]
    state = F.xxhash64(*others)
    one = zones.where(F.col(zone_key).isNotNull()).withColumn("_state", state).groupBy(zone_key).agg(
        *[F.first(c).alias(c) for c in others], F.min("_state").alias("_lo"), F.max("_state").alias("_hi"))
    said = F.concat(F.lit("zone has conflicting rows: "), F.col(zone_key).cast("string"))
    key = F.when(F.col("_lo") != F.col("_hi"), F.raise_error(said)).otherwise(F.col(zone_key))
    return one.select(*[key.alias(c) if c == zone_key else F.col(c) for c in zones.columns])


def zone_counts(
    hits: DataFrame,
    zones: DataFrame,
    zone_key: str,
    attr_cols: Sequence[str],
    count_col: str = "crime_count",
    keep_empty_zones: bool = False,
    hits_col: str | None = None,
) -> DataFrame:
    """Points per zone, with zone attributes; ``zones`` has one row per key (:func:`unique_zones`).

    ``hits_col`` names the number of points that a row of ``hits`` stands for (``count_col`` of
    :func:`cityscan.operators.within.points_in_zones`); without it each stands for one.

    Zones with no point are absent, or counted 0 with ``keep_empty_zones``.
    Counting happens on the key alone (map-side partial hash aggregate); the
    attributes are joined back to the small per-zone result afterwards.
    """
    number = F.count(F.lit(1)) if hits_col is None else F.sum(hits_col)
    counts = hits.groupBy(zone_key).agg(number.alias(count_col))
    attrs = zones.select(zone_key, *[c for c in attr_cols if c != zone_key])
    if not keep_empty_zones:
        return counts.join(attrs, zone_key)
    return attrs.join(counts, zone_key, "left").withColumn(count_col, F.coalesce(F.col(count_col), F.lit(0)))


def zone_rollup(
    per_zone: DataFrame,
    group_col: str,
    pop_col: str,
    count_col: str,
    income_col: str,
) -> DataFrame:
    """Sum population, points and income per group; two per-person ratios.

    A zero total population gives NULL ratios (no DIVIDE_BY_ZERO).
    """
    return (
        per_zone.groupBy(group_col)
        .agg(
            F.sum(pop_col).alias("total_population"),
            F.sum(count_col).alias("total_crime_count"),
            F.sum(income_col).alias("total_income"),
        )
        .withColumn("crimes_per_person", F.try_divide(F.col("total_crime_count"), F.col("total_population")))
        .withColumn("income_per_capita", F.try_divide(F.col("total_income"), F.col("total_population")))
    )


def correlation(df: DataFrame, x: str, y: str, nulls: str = "skip", out_col: str = "correlation") -> DataFrame:
    """One-row DataFrame with the Pearson correlation of two columns."""
    return df.agg(safe_corr(x, y, nulls).alias(out_col))


def extremes(
    df: DataFrame, order_col: str, k: int, tie_cols: Sequence[str] = (), nulls_first_low: bool = True
) -> DataFrame:
    """Bottom k ∪ top k rows by ``order_col`` (UNION ALL: a row can appear twice).

    The low end sorts NULLs first (the default ascending order), so NULL
    values fill the "lowest" slots first; ``nulls_first_low=False`` skips
    them to the end instead. The low end comes first. ``df`` is planned and read once: both ends are kept in one pass.
    """
    both = F.explode(F.array(F.lit(True), F.lit(False)))
    ends = df.select("*", both.alias("__low")).withColumns({
        "__up": F.when(F.col("__low"), F.col(order_col)), "__down": F.when(~F.col("__low"), F.col(order_col))})
    up = F.asc_nulls_first("__up") if nulls_first_low else F.asc_nulls_last("__up")
    # at either end the other end's key is constant; a task passes on its own k rows of each end only
    order = Window.partitionBy("__low").orderBy(up, F.desc_nulls_last("__down"), *[F.asc(c) for c in tie_cols])
    ends = ends.withColumn("__place", F.row_number().over(order)).where(F.col("__place") <= k)
    return ends.orderBy(F.desc("__low"), "__place").select(*df.columns)
