"""The five incident analyses on the original file layouts.

Each function takes the paths a user of the original scripts has (incident
CSVs for one or more periods, the descent code CSV, the modus-operandi code
lines, the station CSV, the ';'-separated income CSV and the census-block
GeoJSON) and returns a lazy DataFrame. Pass Parquet written by
:func:`cityscan.sources.csv.ingest_incidents` through ``incidents=`` to skip
the CSV parse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityscan.functions.clean import parse_ts, valid_coords, year_in
from cityscan.operators.buckets import bucket_count
from cityscan.operators.nearest import nearest_site, site_load
from cityscan.operators.tokens import token_counts, with_lookup
from cityscan.operators.topk import topk_share
from cityscan.operators.within import points_in_zones
from cityscan.operators.zones import correlation, extremes, unique_zones, zone_counts, zone_income, zone_rollup
from cityscan.session import materialize
from cityscan.sources.csv import (
    DESCENT_SCHEMA,
    INCOME_SCHEMA,
    STATION_SCHEMA,
    canonical_incidents,
    read_code_lines,
    read_delimited,
    read_incidents,
)
from cityscan.sources.geojson import features_to_zones, read_geojson

# The incident description matched by the age-group report and
# the census-block properties the roll-up uses.
ASSAULT_TEXT = "AGGRAVATED ASSAULT"
BLOCK_PROPS = {"CITY": "string", "COMM": "string", "ZCTA20": "string", "POP20": "bigint", "HOUSING20": "bigint"}


def _incidents(spark: SparkSession, paths: str | Sequence[str] | None, incidents: DataFrame | None) -> DataFrame:
    if incidents is not None:
        return canonical_incidents(incidents)
    return read_incidents(spark, paths)


def _occurred(df: DataFrame):
    """Occurrence timestamp: the ingested column when present, else parsed text."""
    return F.col("ts_occ") if "ts_occ" in df.columns else parse_ts("DATE OCC")


def _in_years(df: DataFrame, ts, years: Sequence[int]):
    """Year filter; on ingested Parquet it hits the ``year`` partition column,
    so whole partitions are skipped."""
    if "year" in df.columns:
        return F.col("year").isin([int(y) for y in years])
    return year_in(ts, years)


def assault_age_groups(spark: SparkSession, crime_paths=None, engine: str = "native",
                       incidents: DataFrame | None = None) -> DataFrame:
    """Aggravated-assault victims per age group, largest first."""
    df = _incidents(spark, crime_paths, incidents)
    return bucket_count(df, "Vict Age", text_col="Crm Cd Desc", contains=ASSAULT_TEXT, engine=engine)


def top_descents_per_year(spark: SparkSession, descent_codes_path: str, crime_paths=None, k: int = 3,
                          incidents: DataFrame | None = None) -> DataFrame:
    """Top-k victim descents per year with their share of that year's victims."""
    df = _incidents(spark, crime_paths, incidents)
    events = df.select(F.year(_occurred(df)).alias("Year"), F.col("Vict Descent").alias("Vict_Descent"))
    codes = read_delimited(spark, descent_codes_path, DESCENT_SCHEMA).toDF("Vict_Descent", "Vict_Descent_Full")
    return topk_share(events, "Year", "Vict_Descent", k, codes, "Vict_Descent", "Vict_Descent_Full",
                      out_label="Vict_Descent_Full", out_count="Number_of_Victims", out_share="percent")


def mocode_frequency(spark: SparkSession, mo_codes_path: str, crime_paths=None, strategy: str = "auto",
                     truncate_at_comma: bool = False, incidents: DataFrame | None = None) -> DataFrame:
    """Occurrences of each modus-operandi code, with its description."""
    df = _incidents(spark, crime_paths, incidents)
    counts = token_counts(df, "Mocodes", token_col="Mocodes")
    codes = read_code_lines(spark, mo_codes_path, truncate_at_comma=truncate_at_comma)
    return with_lookup(counts, codes, "Mocodes", "Mocode", "Description", strategy=strategy)


def station_load(spark: SparkSession, stations_path: str, crime_paths=None, method: str = "auto",
                 top: int | None = None, incidents: DataFrame | None = None) -> DataFrame:
    """Nearest station per report number; crimes and mean distance (km) per division."""
    df = _incidents(spark, crime_paths, incidents)
    crimes = df.select("DR_NO", "LON", "LAT").where(valid_coords("LON", "LAT", drop_zero=True))
    stations = read_delimited(spark, stations_path, STATION_SCHEMA)
    near = nearest_site(crimes, stations, "LON", "LAT", "x", "y", site_key="FID", site_cols=["DIVISION"],
                        id_cols=["DR_NO"], method=method)
    return site_load(near, ["DIVISION"], avg_col="average_distance", count_col="number_of_crimes", top=top)


def community_income_crime(spark: SparkSession, income_path: str, blocks_path: str, crime_paths=None,
                           years: Sequence[int] = (2020, 2021), city: str = "Los Angeles",
                           geojson_layout: str = "document", incidents: DataFrame | None = None) -> DataFrame:
    """Crimes in census blocks rolled up per community: population, crimes,
    income, crimes per person and income per head."""
    df = _incidents(spark, crime_paths, incidents)
    crimes = (
        df.where(_in_years(df, _occurred(df), years))
        .select("DR_NO", "LON", "LAT")
        .where(valid_coords("LON", "LAT", drop_zero=False))
    )
    feats = read_geojson(spark, blocks_path, BLOCK_PROPS, layout=geojson_layout)
    blocks = features_to_zones(feats).where(F.col("CITY") == city)
    income = read_delimited(spark, income_path, INCOME_SCHEMA, sep=";")
    blocks = zone_income(blocks, income, "ZCTA20", "Zip Code", "Estimated Median Income", "HOUSING20")
    blocks = materialize(unique_zones(blocks, "zone_id"))  # zones are a bounded dimension: parse them once
    hits = points_in_zones(crimes, blocks, "LON", "LAT", ["zone_id"])
    per = zone_counts(hits, blocks, "zone_id", ["COMM", "POP20", "Income_per_block"])
    return zone_rollup(per, "COMM", "POP20", "crime_count", "Income_per_block")


def income_crime_correlations(rollup: DataFrame, k: int = 10, nulls: str = "zero") -> DataFrame:
    """Two rows (``subset``, ``correlation``): all communities, and the k
    poorest ∪ k richest. ``nulls="zero"`` reproduces ``DataFrame.stat.corr``."""
    x, y = "income_per_capita", "crimes_per_person"
    everyone = correlation(rollup, x, y, nulls).select(F.lit("all").alias("subset"), "correlation")
    ext = correlation(extremes(rollup, x, k, tie_cols=["COMM"]), x, y, nulls)
    return everyone.unionByName(ext.select(F.lit(f"lowest_{k}_and_highest_{k}").alias("subset"), "correlation"))
