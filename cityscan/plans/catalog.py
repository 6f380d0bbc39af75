"""The registered queries: each takes (spark, sf_dir) and returns a lazy DataFrame.

They run the library operators over the driver's whole test tables (or data
Spark derives from them). Doubles are rounded to 6 places at the end only.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cityscan.functions.clean import valid_coords, year_in, year_of
from cityscan.operators.buckets import bucket_count
from cityscan.operators.nearest import nearest_site, site_load
from cityscan.operators.tokens import save_bucketed, token_counts, with_lookup
from cityscan.operators.topk import topk_share
from cityscan.operators.within import points_in_zones
from cityscan.operators.zones import correlation, extremes, unique_zones, zone_counts, zone_income, zone_rollup
from cityscan.plans import inputs
from cityscan.plans.inputs import table
from cityscan.plans import sql as sqlq
from cityscan.functions.clean import money_to_int
from cityscan.session import checkpoint_dir, ensure_parallelism, materialize
from cityscan.sources.csv import INCIDENT_SCHEMA, INCOME_SCHEMA, codes_from_lines, parse_delimited, read_incidents, union_periods
from cityscan.sources.geojson import features_to_zones, parse_features, read_geojson

# ---------------------------------------------------------------- P1


def q_bucket_count(spark: SparkSession, d: str, engine: str = "native") -> DataFrame:
    part = table(spark, d, "part")
    return bucket_count(part, "p_size", out_col="size_group", text_col="p_name",
                        contains="ring", engine=engine)


def q_bucket_count_udf(spark: SparkSession, d: str) -> DataFrame:
    return q_bucket_count(spark, d, engine="udf")


def q_union_periods(spark: SparkSession, d: str) -> DataFrame:
    """Two 'period files' (before / from 1998), unioned by name, counted per year."""
    cut = F.lit("1998-01-01 00:00:00").cast("timestamp")
    early = table(spark, d, "orders").where(F.col("o_orderdate") < cut).select("o_orderkey", "o_orderdate")
    late = table(spark, d, "orders").where(F.col("o_orderdate") >= cut).select("o_orderkey", "o_orderdate")
    both = union_periods([early, late])
    return (both.groupBy(F.year("o_orderdate").alias("year"))
            .agg(F.count(F.lit(1)).alias("n_orders")).orderBy("year"))


def q_distinct_years(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    return (o.where(year_in("o_orderdate", [1995, 1996]))
            .select(F.year("o_orderdate").alias("year")).distinct().orderBy("year"))


# ---------------------------------------------------------------- P2


def _descent_events(spark: SparkSession, d: str) -> DataFrame:
    """(Year, Vict_Descent) per order: the year parsed from text, the customer's nation."""
    ev = inputs.event_text_dates(spark, d)
    cust = table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return ev.join(cust, ev["o_custkey"] == cust["c_custkey"]).select(
        year_of("DATE_OCC").alias("Year"), F.col("c_nationkey").alias("Vict_Descent")
    )


def _descent_lookup(spark: SparkSession, d: str) -> DataFrame:
    """Incomplete code list: nations outside region 2 only."""
    return table(spark, d, "nation").where(F.col("n_regionkey") != 2).select(
        F.col("n_nationkey").alias("Vict_Descent"), F.col("n_name").alias("Vict_Descent_Full")
    )


def _topk_out(df: DataFrame) -> DataFrame:
    return df.select(
        "Year", "Vict_Descent_Full", "Number_of_Victims", "percent",
        F.round("share_pct", 6).alias("share_pct"), F.col("rank").cast("int").alias("rank"),
    )


def q_topk_share_per_year(spark: SparkSession, d: str) -> DataFrame:
    res = topk_share(
        _descent_events(spark, d), "Year", "Vict_Descent", k=3,
        lookup=_descent_lookup(spark, d), lookup_key="Vict_Descent", label_col="Vict_Descent_Full",
        out_label="Vict_Descent_Full", out_count="Number_of_Victims", out_share="percent",
    )
    return _topk_out(res)


def q_topk_share_per_year_sql(spark: SparkSession, d: str) -> DataFrame:
    res = sqlq.topk_share_sql(spark, _descent_events(spark, d), _descent_lookup(spark, d), k=3)
    return _topk_out(res)


# ---------------------------------------------------------------- P3


def _code_lookup(spark: SparkSession) -> DataFrame:
    lines = spark.createDataFrame([(l,) for l in inputs.CODE_LINES], "value string")
    return codes_from_lines(lines, code_col="Mocode", desc_col="Description")


def _token_query(spark: SparkSession, d: str, strategy: str) -> DataFrame:
    part = table(spark, d, "part")
    counts = token_counts(part, "p_name", token_col="Mocodes")
    return with_lookup(counts, _code_lookup(spark), "Mocodes", "Mocode", "Description", strategy=strategy)


def q_token_count_lookup(spark: SparkSession, d: str) -> DataFrame:
    return _token_query(spark, d, "auto")


def q_token_join_merge(spark: SparkSession, d: str) -> DataFrame:
    return _token_query(spark, d, "merge")


def q_token_join_shuffle_hash(spark: SparkSession, d: str) -> DataFrame:
    return _token_query(spark, d, "shuffle_hash")


def q_token_join_broadcast(spark: SparkSession, d: str) -> DataFrame:
    return _token_query(spark, d, "broadcast")


def q_token_join_bucketed(spark: SparkSession, d: str) -> DataFrame:
    """Counts and lookup as bucketed tables: a merge join without a shuffle."""
    counts = save_bucketed(token_counts(table(spark, d, "part"), "p_name", token_col="Mocodes"), "Mocodes", 8)
    return with_lookup(counts, save_bucketed(_code_lookup(spark), "Mocode", 8), "Mocodes", "Mocode", "Description", strategy="merge")


# ---------------------------------------------------------------- P4


def _valid_customer_points(spark: SparkSession, d: str) -> DataFrame:
    p = inputs.customer_points(spark, d, specials=True)
    # the test tables are single files: spread the points over the cores
    return ensure_parallelism(p).where(valid_coords("lon", "lat", drop_zero=True))


def _nearest_query(spark: SparkSession, d: str, method: str) -> DataFrame:
    near = nearest_site(
        _valid_customer_points(spark, d), inputs.supplier_sites(spark, d),
        point_lon="lon", point_lat="lat", site_lon="lon", site_lat="lat",
        site_key="s_suppkey", site_cols=["s_name"], id_cols=["c_custkey"], method=method,
    )
    load = site_load(near, ["s_name"], avg_col="average_distance", count_col="number_of_points")
    return load.select(F.col("s_name").alias("site"), F.round("average_distance", 6).alias("average_distance"),
                       "number_of_points")


def q_nearest_site(spark: SparkSession, d: str) -> DataFrame:
    return _nearest_query(spark, d, "auto")


def q_nearest_site_grid(spark: SparkSession, d: str) -> DataFrame:
    return _nearest_query(spark, d, "grid")


def q_nearest_site_array(spark: SparkSession, d: str) -> DataFrame:
    return _nearest_query(spark, d, "array")


def q_nearest_site_sql(spark: SparkSession, d: str) -> DataFrame:
    pts = _valid_customer_points(spark, d).select("c_custkey", "lon", "lat")
    return sqlq.nearest_site_sql(spark, pts, inputs.supplier_sites(spark, d))


def _load(near: DataFrame) -> DataFrame:
    load = site_load(near, ["s_name"], avg_col="average_distance", count_col="number_of_points")
    return load.select(F.col("s_name").alias("site"), F.round("average_distance", 6).alias("average_distance"), "number_of_points")


def q_nearest_site_levels(spark: SparkSession, d: str) -> DataFrame:
    """The path for more sites than may be broadcast: shuffled joins level by level."""
    return _load(nearest_site(
        _valid_customer_points(spark, d), inputs.supplier_sites(spark, d), "lon", "lat", "lon", "lat", "s_suppkey", ["s_name"],
        id_cols=["c_custkey"], broadcast_sites=0))


def q_nearest_site_skewed(spark: SparkSession, d: str) -> DataFrame:
    return _load(nearest_site(
        _valid_customer_points(spark, d), inputs.skewed_sites(spark, d), "lon", "lat", "lon", "lat", "s_suppkey", ["s_name"],
        id_cols=["c_custkey"]))


def _supplier_load(points: DataFrame, sites: DataFrame) -> DataFrame:
    return _load(nearest_site(points, sites, "lon", "lat", "lon", "lat", "s_suppkey", ["s_name"], id_cols=["c_custkey"]))


def q_nearest_site_city(spark: SparkSession, d: str) -> DataFrame:
    return _supplier_load(_valid_customer_points(spark, d), inputs.city_sites(spark, d))


def q_nearest_site_stacked(spark: SparkSession, d: str) -> DataFrame:
    return _supplier_load(_valid_customer_points(spark, d), inputs.stacked_sites(spark, d))


def q_nearest_site_globe(spark: SparkSession, d: str) -> DataFrame:
    return _supplier_load(ensure_parallelism(inputs.globe_points(spark, d)), inputs.globe_sites(spark, d))


def q_nearest_site_city_sql(spark: SparkSession, d: str) -> DataFrame:
    return sqlq.nearest_site_sql(spark, _valid_customer_points(spark, d).select("c_custkey", "lon", "lat"), inputs.city_sites(spark, d))


def q_nearest_site_dup(spark: SparkSession, d: str, broadcast_sites: int = 100_000) -> DataFrame:
    """Site keys that repeat or are NULL, sites at one position, ids at several positions."""
    pts = _valid_customer_points(spark, d).select((F.col("c_custkey") % 500).alias("id"), "lon", "lat")
    near = nearest_site(pts, inputs.repeated_key_sites(spark, d), "lon", "lat", "lon", "lat", "key", ["s_name"], id_cols=["id"],
                        broadcast_sites=broadcast_sites)
    return near.select("id", "key", "s_name", F.round("distance_km", 6).alias("distance_km"))


def q_nearest_site_dup_levels(spark: SparkSession, d: str) -> DataFrame:
    return q_nearest_site_dup(spark, d, broadcast_sites=0)


def q_busiest_sites_sql(spark: SparkSession, d: str) -> DataFrame:
    """The twenty busiest sites, by SQL statements on staged relations."""
    near = nearest_site(_valid_customer_points(spark, d), inputs.supplier_sites(spark, d), "lon", "lat", "lon", "lat",
                        "s_suppkey", ["s_name"], id_cols=["c_custkey"])
    return sqlq.busiest_sites_sql(spark, near, k=20)


# ---------------------------------------------------------------- file parsing


def q_csv_incidents(spark: SparkSession, d: str) -> DataFrame:
    return _incident_rows(parse_delimited(inputs.incident_lines(spark, d), INCIDENT_SCHEMA, corrupt_column="_bad"))


def q_csv_files(spark: SparkSession, d: str) -> DataFrame:
    """The same cells by way of files: CSV with a header line each, read as one table."""
    path = inputs.incident_files(spark, d, f"{checkpoint_dir(spark).rstrip('/')}/incidents-{uuid.uuid4().hex}")
    return _incident_rows(read_incidents(spark, path).withColumn("_bad", F.lit(None))).drop("corrupt")


def _incident_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("DR_NO").alias("dr_no"), F.col("Crm Cd Desc").alias("description"), F.col("Vict Age").alias("age"), F.col("LAT").alias("lat"),
        F.col("LON").alias("lon"), year_of("DATE OCC").alias("year"), F.col("_bad").isNotNull().alias("corrupt"))


def q_csv_semicolon(spark: SparkSession, d: str) -> DataFrame:
    rows = parse_delimited(inputs.income_lines(spark, d), INCOME_SCHEMA, sep=";")
    return rows.select(F.col("Zip Code").alias("zip"), F.col("Community").alias("community"),
                       money_to_int("Estimated Median Income").alias("income"))


def q_code_lines(spark: SparkSession, d: str) -> DataFrame:
    lines = inputs.code_lines(spark, d)
    cut = codes_from_lines(lines, truncate_at_comma=True).select(F.col("Mocode").alias("code"), F.col("Description").alias("description"))
    whole = codes_from_lines(lines).select(F.col("Mocode").alias("code"), F.col("Description").alias("description"))
    return whole.withColumn("cut", F.lit(False)).unionByName(cut.withColumn("cut", F.lit(True)))


# ---------------------------------------------------------------- P5 / P6


def q_geojson_zones(spark: SparkSession, d: str) -> DataFrame:
    z = inputs.zones(spark, d)
    return z.select(
        "zone", F.size("edges").alias("n_edges"),
        *[F.round(c, 6).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")],
    )


def q_geojson_ranges(spark: SparkSession, d: str) -> DataFrame:
    """Documents of one line, written from the suppliers' shapes and read by byte ranges."""
    path = inputs.shape_documents(spark, d, f"{checkpoint_dir(spark).rstrip('/')}/geojson-{uuid.uuid4().hex}")
    zones = features_to_zones(read_geojson(spark, path, {"zone": "bigint"}, layout="ranges"), id_col="zone")
    return zones.select("zone", F.coalesce(F.size("edges"), F.lit(0)).alias("n_edges"),
                        *[F.round(c, 6).alias(c) for c in ("min_x", "min_y", "max_x", "max_y")])


def _blocks_with_income(spark: SparkSession, d: str) -> DataFrame:
    zones = inputs.zones(spark, d).where(F.col("CITY") == "Los Angeles")
    return zone_income(zones, inputs.zip_income(spark, d),
                       zone_zip="ZCTA20", income_zip="Zip_Code",
                       income_text="Estimated_Median_Income", housing_col="HOUSING20")


def q_zone_income(spark: SparkSession, d: str) -> DataFrame:
    return _blocks_with_income(spark, d).select("zone", "COMM", "POP20", "Income_per_block", "ZCTA20")


def _per_zone(spark: SparkSession, d: str) -> DataFrame:
    return _counted(spark, d, _blocks_with_income(spark, d))


def _counted(spark: SparkSession, d: str, blocks: DataFrame, keep_empty_zones: bool = False, points: DataFrame | None = None,
             **join) -> DataFrame:
    blocks = materialize(unique_zones(blocks, "zone"))  # zones are a bounded dimension: parse them once
    points = inputs.customer_points(spark, d, specials=True) if points is None else points
    pts = ensure_parallelism(points).where(valid_coords("lon", "lat", drop_zero=False))
    hits = points_in_zones(pts.select("c_custkey", "lon", "lat"), blocks, "lon", "lat", zone_cols=["zone"], **join)
    per = zone_counts(hits, blocks, "zone", ["COMM", "POP20", "Income_per_block"], keep_empty_zones=keep_empty_zones)
    return per.select("zone", "COMM", F.col("POP20").alias("block_population"), "Income_per_block", "crime_count")


def q_points_in_zones(spark: SparkSession, d: str) -> DataFrame:
    return _per_zone(spark, d)


def q_zones_with_empty(spark: SparkSession, d: str) -> DataFrame:
    """Every zone, those without a point (and one without an area) counted 0."""
    return _counted(spark, d, _blocks_with_income(spark, d), keep_empty_zones=True)


def q_points_in_zones_skewed(spark: SparkSession, d: str) -> DataFrame:
    """A third of the points in one cell, and zones shuffled: the heavy cell is measured and salted."""
    return _counted(spark, d, _blocks_with_income(spark, d), points=inputs.crowded_points(spark, d), broadcast_max_bytes=0, skew_sample=1.0)


def q_shapes(spark: SparkSession, d: str, broadcast_max_bytes: int = 256 << 20, engine: str = "native") -> DataFrame:
    """Concave, slanted, holed and multi-part zones, as many as suppliers, from GeoJSON lines; points on their edges."""
    parsed = features_to_zones(parse_features(inputs.shape_texts(spark, d), {"zone": "bigint"}), id_col="zone")
    zones = materialize(unique_zones(parsed, "zone"))
    hits = points_in_zones(ensure_parallelism(inputs.lattice_points(spark, d)), zones, "lon", "lat", ["zone"],
                           broadcast_max_bytes=broadcast_max_bytes, engine=engine, count_col="n")
    return zone_counts(hits, zones, "zone", [], "n_points", keep_empty_zones=True, hits_col="n")


def q_shapes_shuffled(spark: SparkSession, d: str) -> DataFrame:
    return q_shapes(spark, d, broadcast_max_bytes=0)


def q_shapes_arrow(spark: SparkSession, d: str) -> DataFrame:
    return q_shapes(spark, d, engine="arrow")


def _rollup(spark: SparkSession, d: str) -> DataFrame:
    return zone_rollup(_per_zone(spark, d), "COMM", "block_population", "crime_count", "Income_per_block")


def q_zone_rollup_dup(spark: SparkSession, d: str) -> DataFrame:
    """Every zone listed twice: each point and each zone's population still count once."""
    blocks = _blocks_with_income(spark, d)
    per = _counted(spark, d, blocks.unionByName(blocks))
    return _rollup_out(zone_rollup(per, "COMM", "block_population", "crime_count", "Income_per_block"))


def q_zone_rollup(spark: SparkSession, d: str) -> DataFrame:
    return _rollup_out(_rollup(spark, d))


def q_zone_rollup_sql(spark: SparkSession, d: str) -> DataFrame:
    """The zone pipeline as SQL statements on staged relations: blocks, points in them, the roll-up."""
    blocks = materialize(sqlq.blocks_sql(spark, inputs.zones(spark, d), inputs.zip_income(spark, d), "Los Angeles"))
    pts = ensure_parallelism(inputs.customer_points(spark, d, specials=True)).where(valid_coords("lon", "lat", drop_zero=False))
    hits = points_in_zones(pts.select("lon", "lat"), blocks, "lon", "lat", zone_cols=["zone"])
    return _rollup_out(sqlq.zone_rollup_sql(spark, hits, blocks))


def _rollup_out(r: DataFrame) -> DataFrame:
    return r.select("COMM", "total_population", "total_crime_count", "total_income",
                    F.round("crimes_per_person", 6).alias("crimes_per_person"),
                    F.round("income_per_capita", 6).alias("income_per_capita"))


def _corr_out(df: DataFrame) -> DataFrame:
    return df.select(F.round("correlation", 6).alias("correlation"))


def q_zone_corr(spark: SparkSession, d: str) -> DataFrame:
    return _corr_out(correlation(_rollup(spark, d), "income_per_capita", "crimes_per_person", nulls="skip"))


def q_zone_corr_nullzero(spark: SparkSession, d: str) -> DataFrame:
    return _corr_out(correlation(_rollup(spark, d), "income_per_capita", "crimes_per_person", nulls="zero"))


def q_zone_corr_extremes(spark: SparkSession, d: str) -> DataFrame:
    ext = extremes(_rollup(spark, d), "income_per_capita", 3, tie_cols=["COMM"])
    return _corr_out(correlation(ext, "income_per_capita", "crimes_per_person", nulls="zero"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "bucket_count": q_bucket_count,
    "bucket_count_udf": q_bucket_count_udf,
    "union_periods": q_union_periods,
    "distinct_years": q_distinct_years,
    "topk_share_per_year": q_topk_share_per_year,
    "topk_share_per_year_sql": q_topk_share_per_year_sql,
    "token_count_lookup": q_token_count_lookup,
    "token_join_merge": q_token_join_merge,
    "token_join_shuffle_hash": q_token_join_shuffle_hash,
    "token_join_broadcast": q_token_join_broadcast,
    "token_join_bucketed": q_token_join_bucketed,
    "nearest_site": q_nearest_site,
    "nearest_site_array": q_nearest_site_array,
    "nearest_site_grid": q_nearest_site_grid,
    "nearest_site_sql": q_nearest_site_sql,
    "nearest_site_levels": q_nearest_site_levels,
    "nearest_site_skewed": q_nearest_site_skewed,
    "nearest_site_city": q_nearest_site_city,
    "nearest_site_city_sql": q_nearest_site_city_sql,
    "nearest_site_stacked": q_nearest_site_stacked,
    "nearest_site_globe": q_nearest_site_globe,
    "nearest_site_dup": q_nearest_site_dup,
    "nearest_site_dup_levels": q_nearest_site_dup_levels,
    "busiest_sites_sql": q_busiest_sites_sql,
    "csv_incidents": q_csv_incidents,
    "csv_files": q_csv_files,
    "csv_semicolon": q_csv_semicolon,
    "code_lines": q_code_lines,
    "geojson_zones": q_geojson_zones,
    "geojson_ranges": q_geojson_ranges,
    "zones_with_empty": q_zones_with_empty,
    "zone_rollup_dup": q_zone_rollup_dup,
    "shapes": q_shapes,
    "shapes_shuffled": q_shapes_shuffled,
    "shapes_arrow": q_shapes_arrow,
    "points_in_zones_skewed": q_points_in_zones_skewed,
    "zone_income": q_zone_income,
    "points_in_zones": q_points_in_zones,
    "zone_rollup": q_zone_rollup,
    "zone_rollup_sql": q_zone_rollup_sql,
    "zone_corr": q_zone_corr,
    "zone_corr_nullzero": q_zone_corr_nullzero,
    "zone_corr_extremes": q_zone_corr_extremes,
}
