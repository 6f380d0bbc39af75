"""Row-text sources: incident CSVs, delimited dimension tables, code lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cityscan.functions.clean import EVENT_TS_FORMAT, parse_ts

# The incident report layout, bound by position. One canonical
# schema: report number and modus-operandi codes stay text (the codes are a
# space-separated list), coordinates are read as double.
INCIDENT_COLUMNS: list[tuple[str, T.DataType]] = [
    ("DR_NO", T.StringType()),
    ("Date Rptd", T.StringType()),
    ("DATE OCC", T.StringType()),
    ("TIME OCC", T.IntegerType()),
    ("AREA", T.IntegerType()),
    ("AREA NAME", T.StringType()),
    ("Rpt Dist No", T.IntegerType()),
    ("Part 1-2", T.IntegerType()),
    ("Crm Cd", T.IntegerType()),
    ("Crm Cd Desc", T.StringType()),
    ("Mocodes", T.StringType()),
    ("Vict Age", T.IntegerType()),
    ("Vict Sex", T.StringType()),
    ("Vict Descent", T.StringType()),
    ("Premis Cd", T.IntegerType()),
    ("Premis Desc", T.StringType()),
    ("Weapon Used Cd", T.IntegerType()),
    ("Weapon Desc", T.StringType()),
    ("Status", T.StringType()),
    ("Status Desc", T.StringType()),
    ("Crm Cd 1", T.IntegerType()),
    ("Crm Cd 2", T.IntegerType()),
    ("Crm Cd 3", T.IntegerType()),
    ("Crm Cd 4", T.IntegerType()),
    ("LOCATION", T.StringType()),
    ("Cross Street", T.StringType()),
    ("LAT", T.DoubleType()),
    ("LON", T.DoubleType()),
]
INCIDENT_SCHEMA = T.StructType([T.StructField(n, t) for n, t in INCIDENT_COLUMNS])

STATION_SCHEMA = "x double, y double, FID int, DIVISION string, LOCATION string, PREC int"
INCOME_SCHEMA = "`Zip Code` int, Community string, `Estimated Median Income` string"
DESCENT_SCHEMA = "`Vict Descent` string, `Vict Descent Full` string"


def read_delimited(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType | str,
    sep: str = ",",
    header: bool = True,
    multiline: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """CSV scan with an explicit schema (no inference pass).

    Columns bind by position; the header row is skipped, not matched.
    ``multiline=False`` keeps files splittable (one task per block); turn it
    on only for data with quoted newlines.
    """
    r = (
        spark.read.option("header", header)
        .option("sep", sep)
        .option("mode", "PERMISSIVE")
        .option("multiLine", multiline)
        .option("enforceSchema", True)
    )
    if corrupt_column:
        if isinstance(schema, str):
            schema = spark.createDataFrame([], schema).schema
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType())])
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    p = [paths] if isinstance(paths, str) else list(paths)
    return r.schema(schema).csv(p)


def read_incidents(
    spark: SparkSession, paths: str | Sequence[str], multiline: bool = False, corrupt_column: str | None = None
) -> DataFrame:
    """Incident reports from one or more period files as one logical table.

    A malformed cell is read as NULL. ``corrupt_column`` adds a column with the
    whole text of such rows (NULL for good ones), see :func:`corrupt_rows`.
    """
    return read_delimited(spark, paths, INCIDENT_SCHEMA, multiline=multiline, corrupt_column=corrupt_column)


def corrupt_rows(df: DataFrame, corrupt_column: str) -> DataFrame:
    """One row: all rows read, and how many of them had a cell that did not parse."""
    # a CSV scan parses only the columns it is asked for, so all are referenced
    others = [F.col(f"`{c}`") for c in df.columns if c != corrupt_column]
    bad = F.when(F.col(corrupt_column).isNotNull(), 1).otherwise(0) + F.pmod(F.xxhash64(*others), F.lit(1))
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum(bad), F.lit(0)).cast("long").alias("n_corrupt"))


def parse_delimited(lines: DataFrame, schema: T.StructType | str, line_col: str = "value", sep: str = ",",
                    corrupt_column: str | None = None) -> DataFrame:
    """Lines already in a column to typed columns, by the rules of :func:`read_delimited`.

    Columns bind by position; short rows and cells that do not parse give NULL.
    """
    options = {"sep": sep, "mode": "PERMISSIVE"}
    fields = schema if isinstance(schema, str) else ", ".join(
        f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    if corrupt_column:
        fields += f", `{corrupt_column}` string"
        options["columnNameOfCorruptRecord"] = corrupt_column
    return lines.select(F.from_csv(line_col, fields, options).alias("_row")).select("_row.*")


def union_periods(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL of per-period tables, matched by column name."""
    if not frames:
        raise ValueError("no frames")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def read_code_lines(
    spark: SparkSession,
    paths: str | Sequence[str],
    code_col: str = "Mocode",
    desc_col: str = "Description",
    truncate_at_comma: bool = False,
) -> DataFrame:
    """Lines ``"<code> <description>"`` → (code, description).

    The whole line is kept by default; ``truncate_at_comma=True`` cuts the
    description at its first comma, as a one-column CSV read would. A line
    with no space gives a NULL description instead of an index error.
    """
    return codes_from_lines(spark.read.text(paths), "value", code_col, desc_col, truncate_at_comma)


def codes_from_lines(lines: DataFrame, line_col: str = "value", code_col: str = "Mocode",
                     desc_col: str = "Description", truncate_at_comma: bool = False) -> DataFrame:
    """Same split as :func:`read_code_lines` for lines already in a column."""
    text = F.split(F.col(line_col), ",", 2).getItem(0) if truncate_at_comma else F.col(line_col)
    parts = F.split(text, " ", 2)
    return lines.select(F.get(parts, 0).alias(code_col), F.get(parts, 1).alias(desc_col))


def ingest_columns(df: DataFrame, ts_format: str = EVENT_TS_FORMAT) -> DataFrame:
    """Typed, Parquet-friendly incident columns: parsed ``ts_occ``, ``year``,
    and names without spaces or dashes. Works on batch and streaming frames."""
    ts = parse_ts(F.col("DATE OCC"), ts_format)
    out = df.withColumn("ts_occ", ts).withColumn("year", F.year(ts))
    return out.toDF(*[c.replace(" ", "_").replace("-", "_") for c in out.columns])


def canonical_incidents(df: DataFrame) -> DataFrame:
    """Ingested incident Parquet → the canonical column names (``Vict_Age`` →
    ``Vict Age``); ``ts_occ`` and the ``year`` partition column are kept."""
    names = {n.replace(" ", "_").replace("-", "_"): n for n, _ in INCIDENT_COLUMNS}
    return df.withColumnsRenamed({c: names[c] for c in df.columns if c in names and names[c] != c})


def ingest_incidents(
    spark: SparkSession,
    paths: str | Sequence[str],
    out_path: str,
    ts_format: str = EVENT_TS_FORMAT,
    mode: str = "errorifexists",
    clustered: bool = True,
    out_partitions: int | None = None,
) -> None:
    """Parse the incident CSVs once into Parquet, partitioned by year.

    Timestamps are parsed here (tolerantly), so later queries filter on a
    typed column that Parquet can prune, instead of re-parsing text in
    every query.

    ``clustered=True`` range-partitions on (year, timestamp) before writing:
    sampled bounds split even a dominant year over many tasks, each task
    writes one or two files instead of one per year, and rows land sorted
    by time (tight min/max statistics). ``False`` writes straight from the
    scan tasks (no shuffle, many small files). The bounds are sampled by a
    pass of their own, so clustering reads and parses the CSVs twice.
    """
    clean = ingest_columns(read_incidents(spark, paths), ts_format)
    if clustered:
        n = out_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
        clean = clean.repartitionByRange(n, "year", "ts_occ").sortWithinPartitions("year", "ts_occ")
    clean.write.mode(mode).partitionBy("year").parquet(out_path)
