"""Inputs derived from the driver's test tables, standing in for the incident data.

The test tables hold no coordinates or polygons, so points, sites and zones
are derived arithmetically from table keys (the same formulas are written in
the DuckDB oracle). Everything here is a lazy Spark projection of a table,
so its size follows the table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityscan.session import ensure_parallelism
from cityscan.sources.csv import INCIDENT_SCHEMA
from cityscan.sources.geojson import features_to_zones, parse_features


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _lon_lat(key: Column, a: int, m: int, d: float, b: int, n: int, e: float) -> tuple[Column, Column]:
    lon = F.lit(-118.7) + ((key * a) % m) / F.lit(d)
    lat = F.lit(33.7) + ((key * b) % n) / F.lit(e)
    return lon, lat


def customer_points(spark: SparkSession, sf_dir: str, specials: bool = True) -> DataFrame:
    """(c_custkey, c_nationkey, lon, lat); every 50th customer at (0,0), the next NULL."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    k = F.col("c_custkey")
    lon, lat = _lon_lat(k, 7919, 1009, 2018.0, 104729, 997, 1661.0)
    if specials:
        zero, null = (k % 50) == 0, (k % 50) == 1
        lon = F.when(zero, F.lit(0.0)).when(null, F.lit(None).cast("double")).otherwise(lon)
        lat = F.when(zero, F.lit(0.0)).when(null, F.lit(None).cast("double")).otherwise(lat)
    return c.select("c_custkey", "c_nationkey", lon.alias("lon"), lat.alias("lat"))


def supplier_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(s_suppkey, s_name, lon, lat)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    lon, lat = _lon_lat(F.col("s_suppkey"), 6151, 1013, 2026.0, 3571, 991, 1652.0)
    return s.select("s_suppkey", "s_name", lon.alias("lon"), lat.alias("lat"))


# Fixed values of the zone lattice: 5 columns, cell pitch, square size, hole.
ZONE_COLS = 5
ZONE_DX, ZONE_DY = 0.1, 0.12
ZONE_W, ZONE_H = 0.08, 0.10
HOLE_X0, HOLE_X1, HOLE_Y0, HOLE_Y1 = 0.03, 0.05, 0.04, 0.06

ZONE_PROPS = {"zone": "int", "CITY": "string", "COMM": "int", "POP20": "bigint", "HOUSING20": "bigint",
              "ZCTA20": "string"}


_RING = "[" + ",".join(["[%s,%s]"] * 5) + "]"  # closed ring of a rectangle: 5 vertices


def zone_geojson_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON Feature text per nation: a square with a square hole.

    Even nations are written as Polygon, odd ones as a one-part MultiPolygon,
    so the reader's two geometry paths are both exercised. Coordinates are
    written as shortest round-trip decimals, so parsing returns the same
    doubles the oracle computes.
    """
    n = F.col("n_nationkey")
    base = table(spark, sf_dir, "nation").select(
        n,
        (F.lit(-118.7) + F.lit(ZONE_DX) * (n % ZONE_COLS)).alias("ox"),
        (F.lit(33.7) + F.lit(ZONE_DY) * F.floor(n / ZONE_COLS)).alias("oy"),
    )
    ox, oy = F.col("ox"), F.col("oy")
    x1, y1 = ox + ZONE_W, oy + ZONE_H
    hx0, hx1, hy0, hy1 = ox + HOLE_X0, ox + HOLE_X1, oy + HOLE_Y0, oy + HOLE_Y1
    outer = F.format_string(_RING, ox, oy, x1, oy, x1, y1, ox, y1, ox, oy)
    hole = F.format_string(_RING, hx0, hy0, hx0, hy1, hx1, hy1, hx1, hy0, hx0, hy0)
    rings = F.format_string("[%s,%s]", outer, hole)
    is_multi = (n % 2) == 1
    gtype = F.when(is_multi, F.lit("MultiPolygon")).otherwise(F.lit("Polygon"))
    coords = F.when(is_multi, F.format_string("[%s]", rings)).otherwise(rings)
    pop = F.when(n % 6 == 0, F.lit(0)).otherwise(F.lit(100) + n * 17).cast("bigint")
    housing = (F.lit(40) + n * 7).cast("bigint")
    zip_text = F.when(n == 13, F.lit("N/A9")).otherwise((F.lit(90000) + n).cast("string"))
    props = F.to_json(F.struct(
        n.alias("zone"), F.lit("Los Angeles").alias("CITY"), (n % 12).alias("COMM"), pop.alias("POP20"),
        housing.alias("HOUSING20"), zip_text.alias("ZCTA20"),
    ))
    text = F.format_string('{"type":"Feature","properties":%s,"geometry":{"type":"%s","coordinates":%s}}',
                           props, gtype, coords)
    return base.select(text.alias("feature"))


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed zones: properties as columns, ``edges`` and bbox."""
    feats = parse_features(zone_geojson_text(spark, sf_dir), ZONE_PROPS, "feature")
    return features_to_zones(feats, id_col="zone")


def zip_income(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(Zip_Code int, Community, Estimated_Median_Income text like "$52,806")."""
    n = F.col("n_nationkey")
    money = F.when(n == 7, F.lit("N/A")).otherwise(F.concat(
        F.lit("$"), (F.lit(20) + n).cast("string"), F.lit(","),
        F.lpad(((n * 137) % 1000).cast("string"), 3, "0"),
    ))
    return table(spark, sf_dir, "nation").select(
        (F.lit(90000) + n).cast("int").alias("Zip_Code"),
        F.col("n_name").alias("Community"),
        money.alias("Estimated_Median_Income"),
    )


def event_text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the order date rendered as incident-style text."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        "o_orderkey", "o_custkey",
        F.date_format("o_orderdate", "yyyy MMM dd hh:mm:ss a").alias("DATE_OCC"),
    )


# The code list standing in for the modus-operandi lookup, as
# "<code> <description>" lines; "zzz" never occurs, and most words of the
# part names have no entry.
CODE_LINES = [
    "cold Low temp",
    "hot High temp",
    "ring Closed loop",
    "bolt Fastener",
    "zzz Unused",
]


# ------------------------------------------------ text files rendered from tables


def incident_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident CSV line per customer: quoted commas and quotes, short rows, bad numbers."""
    k = F.col("c_custkey")
    age = F.when(k % 11 == 3, F.lit("abc")).when(k % 11 == 5, F.lit("")).otherwise((k % 90).cast("string"))
    text = F.when(k % 2 == 0, F.concat(F.lit('"AGGRAVATED ASSAULT, TYPE '), k.cast("string"), F.lit('"'))).otherwise(F.lit("THEFT"))
    head = F.concat_ws(",", k.cast("string"), F.lit("x"), F.date_format(
        F.timestamp_seconds(F.lit(1577836800) + k * 86400), "yyyy MMM dd hh:mm:ss a"), F.lit("930"), F.lit("1"), F.lit("Area"),
        F.lit("5"), F.lit("1"), F.lit("230"), text, F.lit("0416 1822"), age)
    rest = F.concat(F.lit("," * 14), F.lit(",34.5,-118.25"))
    return table(spark, sf_dir, "customer").select(
        F.when(k % 13 == 7, head).otherwise(F.concat(head, rest)).alias("value"))


def incident_files(spark: SparkSession, sf_dir: str, path: str, files: int = 3) -> str:
    """``incident_lines`` as CSV files with a header line each; returns the folder."""
    lines = incident_lines(spark, sf_dir).withColumn("part", F.pmod(F.xxhash64("value"), F.lit(files)).cast("int")).withColumn("n", F.lit(1))
    header = ",".join(f.name for f in INCIDENT_SCHEMA.fields)
    heads = spark.range(files, numPartitions=1).select(F.lit(header).alias("value"), F.col("id").cast("int").alias("part"), F.lit(0).alias("n"))
    rows = lines.unionByName(heads).repartition(files, "part").sortWithinPartitions("part", "n")
    rows.select("part", "value").write.partitionBy("part").text(path)
    return path


def income_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zip;community;income lines, one per customer; some without income, some with a bad zip."""
    k = F.col("c_custkey")
    zip_code = F.when(k % 17 == 4, F.lit("N/A")).otherwise((F.lit(90000) + k).cast("string"))
    money = F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(F.lit("$"), (k % 90 + 10).cast("string"), F.lit(",500")))
    return table(spark, sf_dir, "customer").select(
        F.concat_ws(";", zip_code, F.concat(F.lit("Town, "), (k % 7).cast("string")), money).alias("value"))


def code_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Code lines from parts: code, blank, a name with a comma; every ninth has no name."""
    k = F.col("p_partkey")
    name = F.concat(F.lit(" "), F.col("p_name"), F.lit(", more"))
    return table(spark, sf_dir, "part").select(
        F.concat(F.lpad(k.cast("string"), 6, "0"), F.when(k % 9 == 0, F.lit("")).otherwise(name)).alias("value"))


# ------------------------------------------------ sites and zones of harder shape


def skewed_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers crowded into a hundredth of the points' extent, and one stray site at (0, 0)."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    lon, lat = _lon_lat(F.col("s_suppkey"), 6151, 1013, 202600.0, 3571, 991, 165200.0)
    crowd = s.select("s_suppkey", "s_name", lon.alias("lon"), lat.alias("lat"))
    stray = s.where("s_suppkey = 1").select(
        F.lit(0).cast("long").alias("s_suppkey"), F.lit("stray").alias("s_name"), F.lit(0.0).alias("lon"), F.lit(0.0).alias("lat"))
    return crowd.unionByName(stray)


def repeated_key_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier sites whose key repeats (mod 7) or is NULL; pairs of suppliers share a position."""
    k = F.col("s_suppkey")
    lon, lat = _lon_lat(k - k % 2, 6151, 1013, 2026.0, 3571, 991, 1652.0)
    key = F.when(k % 5 == 0, F.lit(None)).otherwise(k % 7).cast("long")
    return table(spark, sf_dir, "supplier").select(key.alias("key"), "s_name", lon.alias("lon"), lat.alias("lat"))


def city_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every second supplier in one city, a hundredth of the points' extent; the others all over it."""
    k = F.col("s_suppkey")
    lon, lat = _lon_lat(k, 6151, 1013, 2026.0, 3571, 991, 1652.0)
    city_lon, city_lat = F.lit(-118.45) + ((k * 6151) % 1013) / F.lit(202600.0), F.lit(34.0) + ((k * 3571) % 991) / F.lit(165200.0)
    inside = k % 2 == 0
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.when(inside, city_lon).otherwise(lon).alias("lon"), F.when(inside, city_lat).otherwise(lat).alias("lat"))


def stacked_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every tenth supplier at one position; the others all over the points' extent."""
    k = F.col("s_suppkey")
    lon, lat = _lon_lat(k, 6151, 1013, 2026.0, 3571, 991, 1652.0)
    return table(spark, sf_dir, "supplier").select(
        "s_suppkey", "s_name", F.when(k % 10 == 0, F.lit(-118.5)).otherwise(lon).alias("lon"),
        F.when(k % 10 == 0, F.lit(34.0)).otherwise(lat).alias("lat"))


def globe_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers all over the globe."""
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", (F.lit(-180.0) + (k * 7919 % 3601) / F.lit(10.0)).alias("lon"), (F.lit(-89.95) + (k * 6007 % 1799) / F.lit(10.0)).alias("lat"))


def globe_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers around both poles and on both sides of the antimeridian."""
    k = F.col("s_suppkey")
    a, b = (k * 6151 % 3593) / F.lit(10.0), (k * 3571 % 991) / F.lit(1000.0)
    near = k % 4
    lon = F.when(near == 0, F.lit(-180.0) + a).when(near == 1, F.lit(-180.0) + a).when(near == 2, F.lit(179.0) + b).otherwise(F.lit(-180.0) + b)
    lat = F.when(near == 0, F.lit(89.0) + b).when(near == 1, F.lit(-89.0) - b).otherwise(a / 4.0 - 44.0)
    return table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", lon.alias("lon"), lat.alias("lat"))


def shape_documents(spark: SparkSession, sf_dir: str, path: str, documents: int = 4) -> str:
    """``shape_texts`` as FeatureCollection documents of one line each; returns the folder."""
    texts = shape_texts(spark, sf_dir).withColumn("n", F.get_json_object("value", "$.properties.zone").cast("long"))
    texts = texts.withColumn("doc", F.col("n") % documents)
    first = texts.groupBy("doc").agg(F.min("n").alias("n")).withColumn("lead", F.lit(
        '{"type":"FeatureCollection","crs":{"type":"name","properties":{"name":"a } \\" { b"}},"features":['))
    rows = texts.join(first.select("doc", "n", "lead"), ["doc", "n"], "left").select(
        "doc", "n", F.concat(F.coalesce("lead", F.lit(",")), F.col("value")).alias("value"))
    ends = first.select("doc", F.lit((1 << 62)).cast("long").alias("n"), F.lit('],"note":{"features":"none"}}').alias("value"))
    rows.unionByName(ends).repartition(documents, "doc").sortWithinPartitions("doc", "n").select("doc", "value").write.partitionBy("doc").option(
        "lineSep", " ").text(path)
    return path


# All coordinates are multiples of 1/1024, so edge tests are exact.
_UNIT = 1024.0


def lattice_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        "c_custkey", (F.lit(-118.0) + (k * 7919 % 256) / F.lit(_UNIT)).alias("lon"), (F.lit(34.0) + (k * 6007 % 256) / F.lit(_UNIT)).alias("lat"))


def crowded_points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer points of which a third stand at one place in zone 0."""
    k = F.col("c_custkey")
    p = customer_points(spark, sf_dir, specials=True)
    crowd = k % 3 == 0
    return p.select("c_custkey", F.when(crowd, F.lit(-118.69)).otherwise(F.col("lon")).alias("lon"),
                    F.when(crowd, F.lit(33.71)).otherwise(F.col("lat")).alias("lat"))


def shape_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One GeoJSON feature per supplier, by key mod 5: an L, a diamond with a diamond hole, two
    separate squares, a slanted triangle, and a feature without geometry."""
    k = F.col("s_suppkey")
    at = lambda dx, dy: F.format_string("[%s,%s]", F.col("ox") + F.lit(dx / _UNIT), F.col("oy") + F.lit(dy / _UNIT))
    ring = lambda pts: F.concat(F.lit("["), F.concat_ws(",", *[at(*p) for p in [*pts, pts[0]]]), F.lit("]"))
    ell = ring([(0, 0), (32, 0), (32, 16), (16, 16), (16, 32), (0, 32)])
    diamond, hole = ring([(16, 0), (32, 16), (16, 32), (0, 16)]), ring([(16, 8), (8, 16), (16, 24), (24, 16)])
    low, high = ring([(0, 0), (8, 0), (8, 8), (0, 8)]), ring([(16, 16), (32, 16), (32, 32), (16, 32)])
    triangle = ring([(0, 0), (32, 16), (0, 32)])
    wrap = lambda *parts: F.concat(F.lit("["), F.concat_ws(",", *parts), F.lit("]"))
    geometry = lambda kind, c: F.concat(F.lit('{"type":"%s","coordinates":' % kind), c, F.lit("}"))
    shape = (F.when(k % 5 == 0, geometry("Polygon", wrap(ell)))
             .when(k % 5 == 1, geometry("Polygon", wrap(diamond, hole)))
             .when(k % 5 == 2, geometry("MultiPolygon", wrap(wrap(low), wrap(high))))
             .when(k % 5 == 3, geometry("MultiPolygon", wrap(wrap(triangle)))).otherwise(F.lit("null")))
    # few bytes, much text: made by all cores, and once (a filter on an exploded column is not pushed below the exchange)
    base = ensure_parallelism(table(spark, sf_dir, "supplier").select("s_suppkey")).select(
        "s_suppkey", (F.lit(-118.0) + (k * 37 % 224) / F.lit(_UNIT)).alias("ox"), (F.lit(34.0) + (k * 53 % 224) / F.lit(_UNIT)).alias("oy"))
    return base.select(F.explode(F.array(F.concat(
        F.lit('{"type":"Feature","properties":{"zone":'), k.cast("string"), F.lit('},"geometry":'), shape, F.lit("}")))).alias("value"))
