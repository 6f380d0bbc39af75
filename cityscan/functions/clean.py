"""Tolerant parsing and validity predicates (ANSI-safe)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the text layout of the incident timestamps.
EVENT_TS_FORMAT = "yyyy MMM dd hh:mm:ss a"


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_ts(text: Column | str, fmt: str = EVENT_TS_FORMAT) -> Column:
    """Text → timestamp; unparsable text gives NULL instead of raising."""
    return F.try_to_timestamp(_c(text), F.lit(fmt))


def year_of(text: Column | str, fmt: str = EVENT_TS_FORMAT) -> Column:
    return F.year(parse_ts(text, fmt))


def year_in(ts: Column | str, years: Iterable[int]) -> Column:
    """``year(ts) IN years``.

    A stored column (given by name) is compared with half-open timestamp ranges,
    so Parquet can skip row groups. An expression, such as parsed text, is
    evaluated once, by its year.
    """
    wanted = sorted(set(int(y) for y in years))
    if not wanted:
        return F.lit(False)
    if not isinstance(ts, str):
        return F.year(ts).isin(wanted)
    cond = F.lit(False)
    for y in wanted:
        lo = F.lit(f"{y:04d}-01-01 00:00:00").cast("timestamp")
        hi = F.lit(f"{y + 1:04d}-01-01 00:00:00").cast("timestamp")
        cond = cond | ((F.col(ts) >= lo) & (F.col(ts) < hi))
    return cond


def valid_coords(lon: Column | str, lat: Column | str, drop_zero: bool = True) -> Column:
    """Both coordinates present (not NULL, not NaN); with ``drop_zero`` also
    both non-zero."""
    x, y = _c(lon), _c(lat)
    cond = x.isNotNull() & y.isNotNull() & ~F.isnan(x) & ~F.isnan(y)
    if drop_zero:
        cond = cond & (x != 0) & (y != 0)
    return cond


def money_to_int(text: Column | str) -> Column:
    """``"$52,806"`` → 52806; anything unparsable (``N/A``, empty) → NULL."""
    return F.regexp_replace(_c(text), r"[$,]", "").try_cast("int")
