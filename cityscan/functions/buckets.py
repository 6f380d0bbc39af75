"""Bucketing of a numeric column into labelled ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The age groups of the incident reports. Each entry is
# (exclusive upper bound, label); values at or above the last bound get
# ELSE_LABEL, and so does NULL unless a separate null label is given.
AGE_GROUPS: list[tuple[int, str]] = [
    (18, "0-17 Children"),
    (25, "18-24 Young Adults"),
    (65, "25-64 Adults"),
]
AGE_ELSE = "65+ Elderly"


def bucketize(
    value: Column | str,
    groups: Sequence[tuple[float, str]] = AGE_GROUPS,
    else_label: str = AGE_ELSE,
    null_label: str | None = None,
) -> Column:
    """``when`` chain over ascending exclusive upper bounds.

    With ``null_label=None`` a NULL value falls through to ``else_label``,
    the behaviour of a plain when/otherwise chain.
    """
    v = F.col(value) if isinstance(value, str) else value
    expr = None
    if null_label is not None:
        expr = F.when(v.isNull(), F.lit(null_label))
    for upper, label in groups:
        cond = v < F.lit(upper)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(else_label))


def bucket_label_py(
    values,
    groups: Sequence[tuple[float, str]] = AGE_GROUPS,
    else_label: str = AGE_ELSE,
    null_label: str | None = None,
):
    """Vectorised twin of :func:`bucketize` for a pandas Series (UDF path)."""
    import numpy as np
    import pandas as pd

    s = pd.to_numeric(values, errors="coerce")
    conds = [s.isna()] if null_label is not None else []
    choices = [null_label] if null_label is not None else []
    for upper, label in groups:
        conds.append(s < upper)
        choices.append(label)
    out = np.select(conds, choices, default=else_label)
    return pd.Series(out, index=values.index, dtype=object)
