"""Column-level building blocks (pure expressions, no actions)."""

from cityscan.functions.buckets import AGE_GROUPS, bucketize, bucket_label_py
from cityscan.functions.clean import money_to_int, parse_ts, valid_coords, year_in, year_of
from cityscan.functions.geo import (
    EARTH_RADIUS_M,
    haversine_km,
    point_in_polygon,
)
from cityscan.functions.stats import safe_corr

__all__ = [
    "AGE_GROUPS",
    "bucketize",
    "bucket_label_py",
    "money_to_int",
    "parse_ts",
    "valid_coords",
    "year_in",
    "year_of",
    "EARTH_RADIUS_M",
    "haversine_km",
    "point_in_polygon",
    "safe_corr",
]
