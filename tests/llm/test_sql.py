"""Queries of this subpackage against their SQL, on the smallest tables."""

import duckdb
import pytest

from tessera.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_against_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    got, want = queries.QUERIES[name](spark, SF), con.sql(queries.ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    assert sorted((tuple(r[c] for c in order) for r in got.collect()), key=str) == sorted((tuple(dict(zip(want.columns, r))[c] for c in order) for r in want.fetchall()), key=str)
