"""SQL twins of the DataFrame operators (Spark SQL with DataFrame parameters)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cityscan.functions.geo import EARTH_RADIUS_M
from cityscan.operators.nearest import PLACE_SQL, list_facts, site_cells, site_frame

# Shares of the largest keys of each period. Totals are a relation of their own,
# so the rank is the only window function and is cut per task before the shuffle.
TOPK_SHARE_SQL = """
SELECT best.period AS `{period}`, names.`{label}`, best.n AS `{count}`,
       format_number(100.0D * best.n / whole.n, 2) AS `{percent}`,
       100.0D * best.n / whole.n AS share_pct, best.place AS rank
FROM (
    SELECT period, code, n,
           row_number() OVER (PARTITION BY period ORDER BY n DESC, code NULLS FIRST) AS place
    FROM (SELECT `{period}` AS period, `{key}` AS code, count(1) AS n FROM {{events}} GROUP BY 1, 2)
) best
JOIN (SELECT `{period}` AS period, count(1) AS n FROM {{events}} GROUP BY 1) whole
  ON whole.period <=> best.period
JOIN {{lookup}} names ON names.`{key}` = best.code
WHERE best.place <= {k}
ORDER BY best.period DESC, best.place
"""


def topk_share_sql(spark: SparkSession, events: DataFrame, lookup: DataFrame, k: int = 3, period: str = "Year",
                   key: str = "Vict_Descent", label: str = "Vict_Descent_Full", count: str = "Number_of_Victims",
                   percent: str = "percent") -> DataFrame:
    """``events(period, key)``, ``lookup(key, label)``; the same rows as ``operators.topk_share``."""
    q = TOPK_SHARE_SQL.format(k=int(k), period=period, key=key, label=label, count=count, percent=percent)
    return spark.sql(q, events=events, lookup=lookup)


# Exact nearest site in one statement, on the staged relation of cells and the
# sites that can be nearest in them (operators.nearest.site_cells): a point has one
# cell, found by an equi-join on level and place, and takes the closest of its list;
# a window keeps one row an id. No point x site rows are formed.
NEAREST_SQL = """
WITH p AS (
    SELECT c_custkey, radians(lat) AS phi, radians(lon) AS lam FROM {points}
    WHERE lon IS NOT NULL AND lat IS NOT NULL AND NOT isnan(lon) AND NOT isnan(lat)
),
v AS (
    SELECT *, cos(phi) AS cphi, cos(phi) * cos(lam) AS _x, cos(phi) * sin(lam) AS _y, sin(phi) AS _z FROM p
),
at AS (
    SELECT *, PLACE AS place FROM v LATERAL VIEW explode(array(LEVELS)) l AS _level
),
best AS (
    SELECT /*+ HINT(c) */ at.c_custkey,
           array_min(transform(c._list, s -> struct(
               DISTANCE AS distance_km, s._site.k AS s_suppkey, s._site.c0 AS s_name))) AS b
    FROM at JOIN {cells} c ON c._level = at._level AND c._key = at.place
),
nearest AS (
    SELECT * FROM (
        SELECT c_custkey, b,
               ROW_NUMBER() OVER (PARTITION BY c_custkey ORDER BY b.distance_km, b.s_suppkey, b.s_name) AS rn
        FROM best
    ) WHERE rn = 1
)
SELECT b.s_name AS site, ROUND(AVG(b.distance_km), 6) AS average_distance,
       COUNT(*) AS number_of_points
FROM nearest
GROUP BY b.s_name
ORDER BY number_of_points DESC, site
"""
_DISTANCE = """{km}D * asin(least(sqrt(pow(sin((s._sphi - at.phi) * 0.5D), 2)
                   + at.cphi * s._scphi * pow(sin((s._slam - at.lam) * 0.5D), 2)), 1.0D))"""

# The load of each site, from a relation that an earlier statement or operator made.
LOAD_SQL = """
SELECT s_name AS site, round(avg(distance_km), 6) AS average_distance, count(1) AS number_of_points
FROM {nearest}
GROUP BY s_name
ORDER BY number_of_points DESC, site
"""

# A report on a staged relation: the busiest sites.
BUSIEST_SQL = "SELECT site, average_distance, number_of_points FROM {load} ORDER BY number_of_points DESC, site LIMIT {k}"


# Zones of each community with their points: population, points, income and the two ratios.
ROLLUP_SQL = """
WITH counted AS (
    SELECT zone, count(1) AS crimes FROM {hits} GROUP BY zone
),
summed AS (
    SELECT b.COMM, sum(b.POP20) AS total_population, sum(c.crimes) AS total_crime_count, sum(b.Income_per_block) AS total_income
    FROM {blocks} b JOIN counted c ON c.zone = b.zone
    GROUP BY b.COMM
)
SELECT *, try_divide(total_crime_count, total_population) AS crimes_per_person,
       try_divide(total_income, total_population) AS income_per_capita
FROM summed
"""

# Zones with the income of their zip code: malformed codes drop the zone, malformed income is NULL.
BLOCKS_SQL = """
SELECT z.*, z.HOUSING20 * i.income AS Income_per_block
FROM {zones} z
JOIN (SELECT Zip_Code, try_cast(regexp_replace(Estimated_Median_Income, '[$,]', '') AS INT) AS income FROM {incomes}) i
  ON try_cast(z.ZCTA20 AS INT) = i.Zip_Code
WHERE z.CITY = {city}
"""


def blocks_sql(spark: SparkSession, zones: DataFrame, incomes: DataFrame, city: str) -> DataFrame:
    """``zones(zone, CITY, COMM, POP20, HOUSING20, ZCTA20, ...)`` joined to ``incomes(Zip_Code, Estimated_Median_Income)``, one row a zip."""
    return spark.sql(BLOCKS_SQL.replace("{city}", ":city"), {"city": city}, zones=zones, incomes=incomes)


def zone_rollup_sql(spark: SparkSession, hits: DataFrame, blocks: DataFrame) -> DataFrame:
    """``hits(zone)``, a row a point, and ``blocks(zone, COMM, POP20, Income_per_block)``; the same rows as ``zone_rollup``."""
    return spark.sql(ROLLUP_SQL, hits=hits, blocks=blocks)


def busiest_sites_sql(spark: SparkSession, nearest: DataFrame, k: int = 20) -> DataFrame:
    """Two statements in a chain: the load of each site of ``nearest(s_name, distance_km)``, then its top ``k``."""
    load = spark.sql(LOAD_SQL, nearest=nearest)
    return spark.sql(BUSIEST_SQL.replace("{k}", str(int(k))), load=load)


def nearest_site_sql(spark: SparkSession, points: DataFrame, sites: DataFrame, radius_m: float = EARTH_RADIUS_M,
                     broadcast_max_bytes: int = 256 << 20) -> DataFrame:
    """``points(c_custkey, lon, lat)``; ``sites(s_suppkey, s_name, lon, lat)``.

    Same answers as ``nearest_site(..., id_cols=[c_custkey])`` and ``site_load``. One statement at any
    number of sites: the measured bytes of the cells' lists only choose its join hint.
    """
    st = site_frame(sites, "lon", "lat", "s_suppkey", ["s_name"])
    cells = site_cells(st, n_sites=st.count())
    levels, size = list_facts(cells)
    q = NEAREST_SQL.replace("DISTANCE", _DISTANCE.replace("{km}", repr(2 * radius_m / 1000.0)))
    q = q.replace("PLACE", PLACE_SQL)
    q = q.replace("LEVELS", ", ".join(map(str, levels)) or "0").replace("HINT(c)", "BROADCAST(c)" if size <= broadcast_max_bytes else "MERGE(c)")
    return spark.sql(q, points=points, cells=cells)
