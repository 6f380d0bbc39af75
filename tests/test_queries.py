"""Every registered query against its DuckDB oracle at sf0.01, plus plan shapes."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from cityscan.plans.catalog import QUERIES
from cityscan.plans.oracle import ORACLE_SQL
from conftest import SF001, SF0001, plan_text

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    return v


def test_every_query_has_an_oracle():
    assert set(ORACLE_SQL) == set(QUERIES)
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE_SQL) <= set(E.oracle_sql())


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query_matches_oracle(spark, con, key):
    sdf = E.queries()[key](spark, SF001)
    cols = sorted(sdf.columns)
    srows = sorted((tuple(_norm(r[c]) for c in cols) for r in sdf.collect()), key=repr)
    rel = con.sql(E.oracle_sql()[key])
    assert sorted(rel.columns) == cols
    idx = [rel.columns.index(c) for c in cols]
    orows = sorted((tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()), key=repr)
    assert srows == orows


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["COMM", "total_population", "total_crime_count", "total_income",
                          "crimes_per_person", "income_per_capita"]
    assert df.count() >= 0


def test_published_expectations_sf001(spark):
    q = E.queries()
    got = {r.size_group: r["count"] for r in q["bucket_count"](spark, SF001).collect()}
    assert got == {"0-17 Children": 75, "18-24 Young Adults": 40, "25-64 Adults": 133}
    assert q["topk_share_per_year"](spark, SF001).count() == 15
    # published to 6 places; the last digit depends on the summation order
    assert abs(q["zone_corr"](spark, SF001).first()[0] - -0.816453) <= 1.5e-6
    assert abs(q["zone_corr_nullzero"](spark, SF001).first()[0] - 0.366441) <= 1.5e-6
    assert abs(q["zone_corr_extremes"](spark, SF001).first()[0] - 0.343290) <= 1.5e-6
    per = {r.zone: r.crime_count for r in q["points_in_zones"](spark, SF001).collect()}
    assert len(per) == 24 and 13 not in per and per[0] == 35 and per[1] == 39 and per[10] == 34


def test_plan_shapes(spark):
    q = E.queries()
    b = q["bucket_count"](spark, SF0001)
    b.collect()
    assert plan_text(b).count("HashAggregate") >= 2  # partial + final
    pz = q["points_in_zones"](spark, SF0001)
    pz.collect()
    p = plan_text(pz)
    assert "BroadcastNestedLoopJoin" not in p and "CartesianProduct" not in p
    ns = q["nearest_site_array"](spark, SF0001)
    ns.collect()
    assert "CartesianProduct" not in plan_text(ns)
    m = q["token_join_merge"](spark, SF0001)
    m.collect()
    assert "SortMergeJoin" in plan_text(m)
