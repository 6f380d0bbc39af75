"""GeoJSON polygons → zone rows with an edge array and a bounding box.

Geometry coordinates are read as raw JSON text and parsed by geometry type,
so one file may mix Polygon and MultiPolygon features (plain schema
inference cannot type such a column).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cityscan.functions.geo import edges_bbox, rings_to_edges
from cityscan.sources.geojson_ranges import feature_texts

_RINGS = "array<array<array<double>>>"
_PARTS = "array<array<array<array<double>>>>"


def _props_ddl(properties: Mapping[str, str] | str) -> str:
    if isinstance(properties, str):
        return properties
    return ", ".join(f"`{k}`: {v}" for k, v in properties.items())


def feature_schema(properties: Mapping[str, str] | str) -> str:
    """DDL of one GeoJSON feature with the listed properties only.

    Naming the properties up front prunes the nested scan to what is used.
    """
    return (
        "type string, "
        f"properties struct<{_props_ddl(properties)}>, "
        "geometry struct<type: string, coordinates: string>"
    )


# a feature's own type marker (not "FeatureCollection")
_FEATURE_MARK = r'"type"\s*:\s*"Feature"'
_CORRUPT = "_corrupt_record"


def _checked(feature: Column, text: Column, corrupt: Column) -> Column:
    """The feature, or an error in the query if its text is no whole GeoJSON feature."""
    bad = corrupt.isNotNull() | feature.isNull() | ~feature["type"].eqNullSafe(F.lit("Feature"))
    said = F.concat(F.lit("malformed GeoJSON feature: "), F.substring(F.coalesce(text, F.lit("null")), 1, 200))
    return F.when(bad, F.raise_error(said)).otherwise(feature)


def parse_features(lines: DataFrame, properties: Mapping[str, str] | str, line_col: str = "value") -> DataFrame:
    """Feature texts in a column to rows (type, properties, geometry).

    Blank lines are skipped; a malformed or truncated text fails the query. A null
    geometry is a feature like any other.
    """
    schema = f"{feature_schema(properties)}, {_CORRUPT} string"
    text = F.col(line_col)
    parsed = lines.where(F.trim(text) != "").select(
        text.alias("_text"), F.from_json(text, schema, {"columnNameOfCorruptRecord": _CORRUPT}).alias("_f"))
    whole = F.struct(F.col("_f.type").alias("type"), F.col("_f.properties").alias("properties"), F.col("_f.geometry").alias("geometry"))
    return parsed.select(_checked(whole, F.col("_text"), F.col(f"_f.{_CORRUPT}")).alias("f")).select("f.*")


def read_geojson(
    spark: SparkSession,
    paths: str | Sequence[str],
    properties: Mapping[str, str] | str,
    newline_delimited: bool = False,
    layout: str | None = None,
) -> DataFrame:
    """Read features as rows (type, properties, geometry).

    ``layout`` (``newline_delimited=True`` is the same as ``"sequence"``):

    * ``"document"`` (default): FeatureCollection documents, parsed whole -
      each file is one record in one task, fine for city-sized files; its
      features are then spread over the cluster.
    * ``"ranges"``: the same documents of any size, a single line included, read by
      many tasks from byte ranges (:mod:`cityscan.sources.geojson_ranges`).
    * ``"sequence"``: one feature per line (GeoJSON text sequence); splits
      across tasks.
    * ``"feature_lines"``: a FeatureCollection written one feature per line
      (the usual GDAL layout), read as splittable text.

    In every layout a malformed or truncated document, line or feature fails the
    query that reads it; nothing is dropped. No job runs here, but for the ranges' states.
    """
    layout = layout or ("sequence" if newline_delimited else "document")
    if layout == "sequence":
        return parse_features(spark.read.text(paths), properties)
    if layout == "ranges":
        return parse_features(feature_texts(spark, paths), properties)
    if layout == "document":
        schema = f"type string, features array<struct<{feature_schema(properties)}>>, {_CORRUPT} string"
        docs = spark.read.schema(schema).option("multiLine", True).option("columnNameOfCorruptRecord", _CORRUPT).json(paths)
        bad = F.col(_CORRUPT).isNotNull() | F.col("features").isNull()
        features = F.when(bad, F.raise_error(F.concat(
            F.lit("malformed GeoJSON document: "), F.substring(F.coalesce(_CORRUPT, F.lit("no features")), 1, 200)))
        ).otherwise(F.col("features"))
        f = docs.select(features.alias("_list")).select(F.explode_outer("_list").alias("f")).where("f is not null")
        f = f.select(_checked(F.col("f"), F.to_json("f"), F.lit(None).cast("string")).alias("f"))
        return f.repartition(spark.sparkContext.defaultParallelism).select("f.*")
    if layout == "feature_lines":
        lines = spark.read.text(paths)
        marks = F.size(F.split(F.col("value"), _FEATURE_MARK)) - 1
        one = F.when(marks > 1, F.raise_error(F.lit("features are not one per line; read with layout='document'")))
        text = one.otherwise(F.regexp_replace(F.trim("value"), r",$", ""))
        return parse_features(lines.where(marks > 0).select(text.alias("value")), properties)
    raise ValueError(f"unknown layout {layout!r}")


def geometry_edges(geom_type: Column, coords_json: Column) -> Column:
    """Polygon / MultiPolygon coordinate text → one flat edge array.

    A missing geometry gives NULL (it matches no point), as does another kind;
    coordinates that do not parse fail the query.
    """
    rings = (
        F.when(geom_type == "Polygon", F.from_json(coords_json, _RINGS))
        .when(geom_type == "MultiPolygon", F.flatten(F.from_json(coords_json, _PARTS)))
    )
    area = geom_type.isin("Polygon", "MultiPolygon")
    said = F.concat(F.lit("malformed coordinates: "), F.substring(F.coalesce(coords_json, F.lit("null")), 1, 200))
    return F.when(area & rings.isNull(), F.raise_error(said)).otherwise(rings_to_edges(rings))


def features_to_zones(
    feats: DataFrame, keep: Sequence[str] | None = None, id_col: str | None = None
) -> DataFrame:
    """Flatten ``properties.*`` to top-level columns and add edges + bbox.

    ``keep`` limits the property columns (default: all declared ones).
    ``id_col`` names an existing property to use as the zone key; without it
    ``zone_id`` is a digest of the geometry text (of the properties where there is
    none), stable across reruns. Features without an area keep their row, with
    NULL edges and bounds.
    """
    names = feats.schema["properties"].dataType.fieldNames()
    keep = list(keep) if keep is not None else names
    geom = F.col("geometry")
    digest = F.sha2(F.concat_ws(" ", geom["type"], geom["coordinates"]).cast("binary"), 256)
    own = F.sha2(F.coalesce(F.to_json("properties"), F.lit("")).cast("binary"), 256)
    z = feats.select(
        *[F.col(f"properties.`{n}`").alias(n) for n in keep],
        geometry_edges(geom["type"], geom["coordinates"]).alias("edges"),
        *([] if id_col else [F.when(geom["coordinates"].isNotNull(), digest).otherwise(own).alias("zone_id")]),
    )
    return z.withColumns(edges_bbox(F.col("edges")))
