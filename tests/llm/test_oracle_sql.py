"""The registered SQL against the Spark queries, in DuckDB."""

import duckdb
import pytest
from conftest import SF0001

from cityscan.llm import catalog


@pytest.mark.parametrize("name", sorted(catalog.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark", "embeddings", "pages"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF0001}/{t}.parquet')")
    df = catalog.QUERIES[name](spark, SF0001)
    rel = con.sql(catalog.ORACLE_SQL[name])
    cols = sorted(df.columns)
    assert sorted(rel.columns) == cols
    got = sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)
    at = [rel.columns.index(c) for c in cols]
    assert got == sorted((tuple(r[i] for i in at) for r in rel.fetchall()), key=repr) and got
