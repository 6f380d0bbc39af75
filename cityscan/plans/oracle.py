"""Independent DuckDB SQL for every registered query (the correctness oracle).

Written from the query semantics, not from our Spark code: zones use the
closed form (strictly inside the square, outside the closed hole) rather than
an edge test, and nearest sites use a plain cross join + ROW_NUMBER.
"""

from __future__ import annotations

_CUST_POINTS = """
SELECT c_custkey, c_nationkey,
  CASE WHEN c_custkey % 50 = 0 THEN 0.0e0 WHEN c_custkey % 50 = 1 THEN NULL
       ELSE -118.7e0 + ((c_custkey * 7919) % 1009) / 2018.0e0 END AS lon,
  CASE WHEN c_custkey % 50 = 0 THEN 0.0e0 WHEN c_custkey % 50 = 1 THEN NULL
       ELSE 33.7e0 + ((c_custkey * 104729) % 997) / 1661.0e0 END AS lat
FROM customer
"""

_SUPP_SITES = """
SELECT s_suppkey, s_name,
  -118.7e0 + ((s_suppkey * 6151) % 1013) / 2026.0e0 AS lon,
  33.7e0 + ((s_suppkey * 3571) % 991) / 1652.0e0 AS lat
FROM supplier
"""

_ZONES = """
SELECT n_nationkey AS zone,
  CAST(n_nationkey % 12 AS INTEGER) AS COMM,
  CAST(CASE WHEN n_nationkey % 6 = 0 THEN 0 ELSE 100 + 17 * n_nationkey END AS BIGINT) AS POP20,
  CAST(40 + 7 * n_nationkey AS BIGINT) AS HOUSING20,
  CASE WHEN n_nationkey = 13 THEN 'N/A9' ELSE CAST(90000 + n_nationkey AS VARCHAR) END AS ZCTA20,
  -118.7e0 + 0.1e0 * (n_nationkey % 5) AS ox,
  33.7e0 + 0.12e0 * floor(n_nationkey / 5) AS oy
FROM nation
"""

_INCOME = """
SELECT CAST(90000 + n_nationkey AS INTEGER) AS Zip_Code,
  CASE WHEN n_nationkey = 7 THEN 'N/A'
       ELSE '$' || CAST(20 + n_nationkey AS VARCHAR) || ',' || lpad(CAST((n_nationkey * 137) % 1000 AS VARCHAR), 3, '0')
  END AS income_text
FROM nation
"""

_BLOCKS = f"""
SELECT z.*, CAST(z.HOUSING20 * TRY_CAST(regexp_replace(i.income_text, '[$,]', '', 'g') AS INTEGER) AS BIGINT)
         AS Income_per_block
FROM ({_ZONES}) z JOIN ({_INCOME}) i ON TRY_CAST(z.ZCTA20 AS INTEGER) = i.Zip_Code
"""

_PER_ZONE = f"""
SELECT b.zone, b.COMM, b.POP20 AS block_population, b.Income_per_block,
       CAST(count(*) AS BIGINT) AS crime_count
FROM ({_BLOCKS}) b
JOIN ({_CUST_POINTS}) p
  ON p.lon > b.ox AND p.lon < b.ox + 0.08e0 AND p.lat > b.oy AND p.lat < b.oy + 0.1e0
 AND NOT (p.lon >= b.ox + 0.03e0 AND p.lon <= b.ox + 0.05e0
          AND p.lat >= b.oy + 0.04e0 AND p.lat <= b.oy + 0.06e0)
WHERE p.lon IS NOT NULL AND p.lat IS NOT NULL
GROUP BY b.zone, b.COMM, b.POP20, b.Income_per_block
"""

_ROLLUP = f"""
SELECT COMM,
  CAST(sum(block_population) AS BIGINT) AS total_population,
  CAST(sum(crime_count) AS BIGINT) AS total_crime_count,
  CAST(sum(Income_per_block) AS BIGINT) AS total_income,
  sum(crime_count) / nullif(sum(block_population), 0) AS crimes_per_person,
  sum(Income_per_block) / nullif(sum(block_population), 0) AS income_per_capita
FROM ({_PER_ZONE}) t GROUP BY COMM
"""


def _corr(src: str, x: str, y: str, zero: bool) -> str:
    a = f"coalesce({x}, 0.0e0)" if zero else x
    b = f"coalesce({y}, 0.0e0)" if zero else y
    a2 = f"CASE WHEN ({a}) IS NOT NULL AND ({b}) IS NOT NULL THEN ({a}) END"
    b2 = f"CASE WHEN ({a}) IS NOT NULL AND ({b}) IS NOT NULL THEN ({b}) END"
    return (
        f"SELECT round(covar_pop({a2}, {b2}) / nullif(stddev_pop({a2}) * stddev_pop({b2}), 0), 6) "
        f"AS correlation FROM ({src}) s"
    )


_HAV = (
    "2.0e0 * 6371.008e0 * asin(sqrt(pow(sin(radians(s.lat - p.lat) / 2), 2) "
    "+ cos(radians(p.lat)) * cos(radians(s.lat)) * pow(sin(radians(s.lon - p.lon) / 2), 2)))"
)

_NEAREST = f"""
WITH pts AS (SELECT * FROM ({_CUST_POINTS}) c
             WHERE lon IS NOT NULL AND lat IS NOT NULL AND lon <> 0 AND lat <> 0),
pairs AS (SELECT p.c_custkey, s.s_suppkey, s.s_name, {_HAV} AS d
          FROM pts p CROSS JOIN ({_SUPP_SITES}) s),
ranked AS (SELECT *, row_number() OVER (PARTITION BY c_custkey ORDER BY d, s_suppkey) AS rn FROM pairs)
SELECT s_name AS site, round(avg(d), 6) AS average_distance, CAST(count(*) AS BIGINT) AS number_of_points
FROM ranked WHERE rn = 1 GROUP BY s_name
"""

_TS_FMT = "%Y %b %d %I:%M:%S %p"

_TOPK = f"""
WITH ev AS (
  SELECT CAST(year(try_strptime(strftime(o.o_orderdate, '{_TS_FMT}'), '{_TS_FMT}')) AS INTEGER) AS Year,
         c.c_nationkey AS descent
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey),
g AS (SELECT Year, descent, count(*) AS cnt FROM ev GROUP BY Year, descent),
w AS (SELECT *, sum(cnt) OVER (PARTITION BY Year) AS total,
             row_number() OVER (PARTITION BY Year ORDER BY cnt DESC, descent ASC NULLS FIRST) AS rnk
      FROM g)
SELECT w.Year, n.n_name AS Vict_Descent_Full, CAST(w.cnt AS BIGINT) AS Number_of_Victims,
       format('{{:,.2f}}', w.cnt * 100.0e0 / w.total) AS percent,
       round(w.cnt * 100.0e0 / w.total, 6) AS share_pct,
       CAST(w.rnk AS INTEGER) AS rank
FROM w JOIN nation n ON w.descent = n.n_nationkey AND n.n_regionkey <> 2
WHERE w.rnk <= 3
"""

_TOKENS = """
WITH toks AS (
  SELECT unnest(string_split(p_name, ' ')) AS tok FROM part),
counts AS (SELECT tok, CAST(count(*) AS BIGINT) AS cnt FROM toks WHERE tok <> '' GROUP BY tok),
codes(Mocode, Description) AS (VALUES ('cold', 'Low temp'), ('hot', 'High temp'),
  ('ring', 'Closed loop'), ('bolt', 'Fastener'), ('zzz', 'Unused'))
SELECT c.tok AS Mocodes, k.Description, c.cnt AS count
FROM counts c JOIN codes k ON c.tok = k.Mocode
"""

_BUCKETS = """
SELECT CASE WHEN p_size < 18 THEN '0-17 Children' WHEN p_size < 25 THEN '18-24 Young Adults'
            WHEN p_size < 65 THEN '25-64 Adults' ELSE '65+ Elderly' END AS size_group,
       CAST(count(*) AS BIGINT) AS count
FROM part WHERE contains(p_name, 'ring') GROUP BY 1
"""

_SKEWED = f"""
WITH pts AS (SELECT * FROM ({_CUST_POINTS}) c
             WHERE lon IS NOT NULL AND lat IS NOT NULL AND lon <> 0 AND lat <> 0),
sites AS (SELECT s_suppkey, s_name, -118.7e0 + ((s_suppkey * 6151) % 1013) / 202600.0e0 AS lon,
                 33.7e0 + ((s_suppkey * 3571) % 991) / 165200.0e0 AS lat FROM supplier
          UNION ALL SELECT 0, 'stray', 0.0e0, 0.0e0),
ranked AS (SELECT p.c_custkey, s.s_name, {_HAV} AS d,
                  row_number() OVER (PARTITION BY p.c_custkey ORDER BY {_HAV}, s.s_suppkey) AS rn
           FROM pts p CROSS JOIN sites s)
SELECT s_name AS site, round(avg(d), 6) AS average_distance, CAST(count(*) AS BIGINT) AS number_of_points
FROM ranked WHERE rn = 1 GROUP BY s_name
"""



def _load_of(sites: str, points: str = f"SELECT * FROM ({_CUST_POINTS}) c WHERE lon IS NOT NULL AND lat IS NOT NULL AND lon <> 0 AND lat <> 0") -> str:
    """Loads by a plain cross join of points and sites."""
    return f"""
        WITH pts AS ({points}), sites AS ({sites}),
        ranked AS (SELECT p.c_custkey, s.s_name, {_HAV} AS d,
                          row_number() OVER (PARTITION BY p.c_custkey ORDER BY {_HAV}, s.s_suppkey) AS rn
                   FROM pts p CROSS JOIN sites s)
        SELECT s_name AS site, round(avg(d), 6) AS average_distance, CAST(count(*) AS BIGINT) AS number_of_points
        FROM ranked WHERE rn = 1 GROUP BY s_name"""


_CITY = f"""
SELECT s_suppkey, s_name,
       CASE WHEN s_suppkey % 2 = 0 THEN -118.45e0 + ((s_suppkey * 6151) % 1013) / 202600.0e0 ELSE lon END AS lon,
       CASE WHEN s_suppkey % 2 = 0 THEN 34.0e0 + ((s_suppkey * 3571) % 991) / 165200.0e0 ELSE lat END AS lat
FROM ({_SUPP_SITES}) s
"""

_STACKED = f"""
SELECT s_suppkey, s_name, CASE WHEN s_suppkey % 10 = 0 THEN -118.5e0 ELSE lon END AS lon,
       CASE WHEN s_suppkey % 10 = 0 THEN 34.0e0 ELSE lat END AS lat FROM ({_SUPP_SITES}) s
"""

_GLOBE_POINTS = """
SELECT c_custkey, -180.0e0 + (c_custkey * 7919 % 3601) / 10.0e0 AS lon, -89.95e0 + (c_custkey * 6007 % 1799) / 10.0e0 AS lat FROM customer
"""

_GLOBE = """
SELECT s_suppkey, s_name,
       CASE s_suppkey % 4 WHEN 2 THEN 179.0e0 + b WHEN 3 THEN -180.0e0 + b ELSE -180.0e0 + a END AS lon,
       CASE s_suppkey % 4 WHEN 0 THEN 89.0e0 + b WHEN 1 THEN -89.0e0 - b ELSE a / 4.0e0 - 44.0e0 END AS lat
FROM (SELECT *, (s_suppkey * 6151 % 3593) / 10.0e0 AS a, (s_suppkey * 3571 % 991) / 1000.0e0 AS b FROM supplier) t
"""

_DUP = f"""
WITH pts AS (SELECT c_custkey % 500 AS id, lon, lat FROM ({_CUST_POINTS}) c
             WHERE lon IS NOT NULL AND lat IS NOT NULL AND lon <> 0 AND lat <> 0),
sites AS (SELECT CASE WHEN s_suppkey % 5 = 0 THEN NULL ELSE s_suppkey % 7 END AS key, s_name,
                 -118.7e0 + (((s_suppkey - s_suppkey % 2) * 6151) % 1013) / 2026.0e0 AS lon,
                 33.7e0 + (((s_suppkey - s_suppkey % 2) * 3571) % 991) / 1652.0e0 AS lat FROM supplier),
ranked AS (SELECT p.id, s.key, s.s_name, {_HAV} AS d,
                  row_number() OVER (PARTITION BY p.id ORDER BY {_HAV}, s.key NULLS FIRST, s.s_name) AS rn
           FROM pts p CROSS JOIN sites s)
SELECT id, CAST(key AS BIGINT) AS key, s_name, round(d, 6) AS distance_km FROM ranked WHERE rn = 1
"""

_SHAPES = """
WITH z AS (SELECT s_suppkey AS zone, s_suppkey % 5 AS kind, -118.0e0 + (s_suppkey * 37 % 224) / 1024.0e0 AS ox,
                  34.0e0 + (s_suppkey * 53 % 224) / 1024.0e0 AS oy FROM supplier),
p AS (SELECT -118.0e0 + (c_custkey * 7919 % 256) / 1024.0e0 AS lon, 34.0e0 + (c_custkey * 6007 % 256) / 1024.0e0 AS lat FROM customer),
j AS (SELECT zone, kind, (lon - ox) * 1024 AS x, (lat - oy) * 1024 AS y FROM z, p)
SELECT z.zone, CAST(count(j.zone) AS BIGINT) AS n_points
FROM z LEFT JOIN j ON j.zone = z.zone AND CASE z.kind
  WHEN 0 THEN (x > 0 AND x < 32 AND y > 0 AND y < 16) OR (x > 0 AND x < 16 AND y > 0 AND y < 32)
  WHEN 1 THEN abs(x - 16) + abs(y - 16) < 16 AND abs(x - 16) + abs(y - 16) > 8
  WHEN 2 THEN (x > 0 AND x < 8 AND y > 0 AND y < 8) OR (x > 16 AND x < 32 AND y > 16 AND y < 32)
  WHEN 3 THEN x > 0 AND y > x / 2 AND y < 32 - x / 2
  ELSE false END
GROUP BY z.zone
"""

_INCIDENTS = """
        SELECT CAST(c_custkey AS VARCHAR) AS dr_no,
               CASE WHEN c_custkey % 2 = 0 THEN 'AGGRAVATED ASSAULT, TYPE ' || c_custkey ELSE 'THEFT' END AS description,
               CASE WHEN c_custkey % 11 IN (3, 5) THEN NULL ELSE CAST(c_custkey % 90 AS INTEGER) END AS age,
               CASE WHEN c_custkey % 13 = 7 THEN NULL ELSE 34.5e0 END AS lat,
               CASE WHEN c_custkey % 13 = 7 THEN NULL ELSE -118.25e0 END AS lon,
               CAST(year(make_timestamp((1577836800 + c_custkey * 86400) * 1000000)) AS INTEGER) AS year,
               c_custkey % 11 = 3 OR c_custkey % 13 = 7 AS corrupt
        FROM customer"""

ORACLE_SQL: dict[str, str] = {
    "nearest_site_levels": _NEAREST,
    "nearest_site_skewed": _SKEWED,
    "nearest_site_city": _load_of(_CITY),
    "nearest_site_city_sql": _load_of(_CITY),
    "nearest_site_stacked": _load_of(_STACKED),
    "nearest_site_globe": _load_of(_GLOBE, _GLOBE_POINTS),
    "nearest_site_dup": _DUP,
    "nearest_site_dup_levels": _DUP,
    "busiest_sites_sql": f"SELECT * FROM ({_NEAREST}) t ORDER BY number_of_points DESC, site LIMIT 20",
    "csv_incidents": _INCIDENTS,
    "csv_files": f"SELECT * EXCLUDE (corrupt) FROM ({_INCIDENTS}) t",
    "csv_semicolon": """
        SELECT CASE WHEN c_custkey % 17 = 4 THEN NULL ELSE CAST(90000 + c_custkey AS INTEGER) END AS zip,
               'Town, ' || (c_custkey % 7) AS community,
               CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST((c_custkey % 90 + 10) * 1000 + 500 AS INTEGER) END AS income
        FROM customer""",
    "code_lines": """
        SELECT lpad(CAST(p_partkey AS VARCHAR), 6, '0') AS code,
               CASE WHEN p_partkey % 9 = 0 THEN NULL WHEN t.cut THEN p_name ELSE p_name || ', more' END AS description, t.cut
        FROM part CROSS JOIN (VALUES (false), (true)) t(cut)""",
    "zones_with_empty": f"""
        SELECT b.zone, b.COMM, b.POP20 AS block_population, b.Income_per_block, coalesce(t.crime_count, 0) AS crime_count
        FROM ({_BLOCKS}) b LEFT JOIN ({_PER_ZONE}) t ON t.zone = b.zone""",
    "shapes": _SHAPES,
    "shapes_shuffled": _SHAPES,
    "shapes_arrow": _SHAPES,
    "points_in_zones_skewed": _PER_ZONE.replace(_CUST_POINTS, f"""
        SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN -118.69e0 ELSE lon END AS lon,
               CASE WHEN c_custkey % 3 = 0 THEN 33.71e0 ELSE lat END AS lat FROM ({_CUST_POINTS}) c"""),
    "bucket_count": _BUCKETS,
    "bucket_count_udf": _BUCKETS,
    "union_periods": """
        SELECT CAST(year(o_orderdate) AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS n_orders
        FROM (SELECT o_orderdate FROM orders WHERE o_orderdate < TIMESTAMP '1998-01-01'
              UNION ALL
              SELECT o_orderdate FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01') t
        GROUP BY 1""",
    "distinct_years": """
        SELECT DISTINCT CAST(year(o_orderdate) AS INTEGER) AS year FROM orders
        WHERE year(o_orderdate) IN (1995, 1996)""",
    "topk_share_per_year": _TOPK,
    "topk_share_per_year_sql": _TOPK,
    "token_count_lookup": _TOKENS,
    "token_join_merge": _TOKENS,
    "token_join_shuffle_hash": _TOKENS,
    "token_join_broadcast": _TOKENS,
    "token_join_bucketed": _TOKENS,
    "nearest_site": _NEAREST,
    "nearest_site_array": _NEAREST,
    "nearest_site_grid": _NEAREST,
    "nearest_site_sql": _NEAREST,
    "geojson_zones": f"""
        SELECT zone, CAST(8 AS INTEGER) AS n_edges, round(ox, 6) AS min_x, round(oy, 6) AS min_y,
               round(ox + 0.08e0, 6) AS max_x, round(oy + 0.1e0, 6) AS max_y
        FROM ({_ZONES}) z""",
    "geojson_ranges": """
        SELECT zone, CAST(CASE kind WHEN 0 THEN 6 WHEN 1 THEN 8 WHEN 2 THEN 8 WHEN 3 THEN 3 ELSE 0 END AS INTEGER) AS n_edges,
               CASE WHEN kind < 4 THEN round(ox, 6) END AS min_x, CASE WHEN kind < 4 THEN round(oy, 6) END AS min_y,
               CASE WHEN kind < 4 THEN round(ox + 0.03125e0, 6) END AS max_x, CASE WHEN kind < 4 THEN round(oy + 0.03125e0, 6) END AS max_y
        FROM (SELECT s_suppkey AS zone, s_suppkey % 5 AS kind, -118.0e0 + (s_suppkey * 37 % 224) / 1024.0e0 AS ox,
                     34.0e0 + (s_suppkey * 53 % 224) / 1024.0e0 AS oy FROM supplier) t""",
    "zone_income": f"SELECT zone, COMM, POP20, Income_per_block, ZCTA20 FROM ({_BLOCKS}) b",
    "points_in_zones": _PER_ZONE,
    "zone_rollup": f"""
        SELECT COMM, total_population, total_crime_count, total_income,
               round(crimes_per_person, 6) AS crimes_per_person,
               round(income_per_capita, 6) AS income_per_capita
        FROM ({_ROLLUP}) r""",
    "zone_rollup_sql": f"""
        SELECT COMM, total_population, total_crime_count, total_income,
               round(crimes_per_person, 6) AS crimes_per_person,
               round(income_per_capita, 6) AS income_per_capita
        FROM ({_ROLLUP}) r""",
    "zone_rollup_dup": f"""
        SELECT COMM, total_population, total_crime_count, total_income,
               round(crimes_per_person, 6) AS crimes_per_person,
               round(income_per_capita, 6) AS income_per_capita
        FROM ({_ROLLUP}) r""",
    "zone_corr": _corr(_ROLLUP, "income_per_capita", "crimes_per_person", zero=False),
    "zone_corr_nullzero": _corr(_ROLLUP, "income_per_capita", "crimes_per_person", zero=True),
    "zone_corr_extremes": _corr(
        f"""(SELECT * FROM ({_ROLLUP}) a ORDER BY income_per_capita ASC NULLS FIRST, COMM LIMIT 3)
            UNION ALL
            (SELECT * FROM ({_ROLLUP}) b ORDER BY income_per_capita DESC NULLS LAST, COMM LIMIT 3)""",
        "income_per_capita", "crimes_per_person", zero=True),
}
