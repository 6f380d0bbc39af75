"""ANSI-safe correlation with explicit NULL handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_corr(x: Column | str, y: Column | str, nulls: str = "skip") -> Column:
    """Pearson correlation as an aggregate column.

    ``nulls="skip"`` ignores rows where either side is NULL (``F.corr``);
    ``nulls="zero"`` treats NULL as 0.0 (``DataFrame.stat.corr``).
    Constant input or a single row gives NULL instead of raising
    DIVIDE_BY_ZERO under ANSI mode.
    """
    a, b = _c(x).cast("double"), _c(y).cast("double")
    if nulls == "zero":
        a, b = F.coalesce(a, F.lit(0.0)), F.coalesce(b, F.lit(0.0))
    elif nulls != "skip":
        raise ValueError(f"nulls must be 'skip' or 'zero', not {nulls!r}")
    both = a.isNotNull() & b.isNotNull()
    a2 = F.when(both, a)
    b2 = F.when(both, b)
    return F.try_divide(F.covar_pop(a2, b2), F.stddev_pop(a2) * F.stddev_pop(b2))
