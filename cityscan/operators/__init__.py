"""Operators: lazy DataFrame → DataFrame building blocks of the pipelines."""

from cityscan.operators.buckets import bucket_count, bucket_udf
from cityscan.operators.nearest import nearest_site, site_cells, site_load
from cityscan.operators.tokens import save_bucketed, token_counts, with_lookup
from cityscan.operators.topk import topk_share
from cityscan.operators.within import points_in_zones, zone_cells
from cityscan.operators.zones import correlation, extremes, unique_zones, zone_counts, zone_income, zone_rollup

__all__ = [
    "bucket_count",
    "bucket_udf",
    "nearest_site",
    "site_cells",
    "site_load",
    "save_bucketed",
    "token_counts",
    "with_lookup",
    "topk_share",
    "points_in_zones",
    "zone_cells",
    "correlation",
    "extremes",
    "unique_zones",
    "zone_counts",
    "zone_income",
    "zone_rollup",
]
