"""Each registered query against its SQL in DuckDB, on the smallest tables."""

import datetime

import duckdb
import pytest

from tessera.plans.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


def plain(x):
    return round(x, 9) if isinstance(x, float) else x.isoformat() if isinstance(x, datetime.datetime) else x


def rows(names, found):
    order = sorted(range(len(names)), key=lambda k: names[k])
    return sorted([[plain(r[k]) for k in order] for r in found], key=str)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got = QUERIES[name](spark, SF)
    assert name in ORACLES
    want = con.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())


def test_entry_imports():
    import __spark_entry__ as e

    assert set(e.oracle_sql()) <= set(e.queries()) and "consistency_best_match" in e.queries()
