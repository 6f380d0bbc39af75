"""P1: filtered bucket histogram."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

import cityscan.functions.buckets as _buckets
from cityscan.functions.buckets import AGE_ELSE, AGE_GROUPS, bucket_label_py, bucketize

# The UDF's helper travels with the UDF itself, so Python workers need no
# installed copy of this package.
cloudpickle.register_pickle_by_value(_buckets)


def bucket_udf(
    groups: Sequence[tuple[float, str]] = AGE_GROUPS,
    else_label: str = AGE_ELSE,
    null_label: str | None = None,
):
    """Arrow-batched Python twin of :func:`bucketize` (the UDF variant)."""
    groups = list(groups)

    @F.pandas_udf("string")
    def label(values: pd.Series) -> pd.Series:
        return bucket_label_py(values, groups, else_label, null_label)

    return label


def bucket_count(
    df: DataFrame,
    value_col: str,
    out_col: str = "Age_Group",
    text_col: str | None = None,
    contains: str | None = None,
    groups: Sequence[tuple[float, str]] = AGE_GROUPS,
    else_label: str = AGE_ELSE,
    null_label: str | None = None,
    engine: str = "native",
) -> DataFrame:
    """Rows whose ``text_col`` contains ``contains`` (case-sensitive), bucketed
    and counted, largest bucket first.

    ``engine="native"`` keeps the label in generated code; ``"udf"`` computes it
    in a pandas UDF (same labels, for comparison).
    """
    if contains is not None:
        if text_col is None:
            raise ValueError("contains needs text_col")
        df = df.where(F.col(text_col).contains(contains))
    if engine == "native":
        label: Column = bucketize(F.col(value_col), groups, else_label, null_label)
    elif engine == "udf":
        label = bucket_udf(groups, else_label, null_label)(F.col(value_col))
    else:
        raise ValueError(f"engine must be 'native' or 'udf', not {engine!r}")
    return (
        df.select(label.alias(out_col))
        .groupBy(out_col)
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(out_col))
    )
