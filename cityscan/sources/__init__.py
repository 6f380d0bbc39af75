"""Sources: CSV incident tables, code lists, delimited dimensions, GeoJSON."""

from cityscan.sources.csv import (
    INCIDENT_SCHEMA,
    codes_from_lines,
    ingest_incidents,
    read_code_lines,
    read_delimited,
    read_incidents,
    union_periods,
)
from cityscan.sources.geojson import features_to_zones, geometry_edges, read_geojson

__all__ = [
    "INCIDENT_SCHEMA",
    "codes_from_lines",
    "ingest_incidents",
    "read_code_lines",
    "read_delimited",
    "read_incidents",
    "union_periods",
    "features_to_zones",
    "geometry_edges",
    "read_geojson",
]
