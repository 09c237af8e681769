"""Queries over files against their SQL, on tables with nulls and odd values."""

import duckdb
import pytest

from tessera.plans.registry import ORACLES, QUERIES
from test_queries import rows

DOCUMENTS = """SELECT k - 70 AS doc_id, CASE WHEN k % 5 = 1 THEN NULL ELSE repeat('letters ', 40) END AS text, 'prose' AS source, CASE WHEN k % 5 = 1 THEN NULL WHEN k < 200 THEN 320 END AS n_chars,
       CASE k % 5 WHEN 0 THEN 'en' WHEN 1 THEN 'xx' WHEN 2 THEN 'a/b' WHEN 3 THEN '' END AS lang FROM range(400) t(k) UNION ALL SELECT NULL, 'no key', 'prose', 700, 'en'"""
CONVERSATIONS = """SELECT k // 3 AS conv_id, k % 3 AS turn, 'user' AS role, CASE WHEN k // 3 % 5 = 1 THEN NULL WHEN k // 3 % 5 = 2 THEN '' ELSE repeat('x', k + 1) END AS text FROM range(120) t(k)
       UNION ALL SELECT NULL, 0, 'user', 'no key'"""


@pytest.mark.parametrize("name", ["dataset_snapshot", "media_headers", "pdf_page_rows"])
def test_query_on_odd_tables(spark, tmp_path, name):
    con = duckdb.connect()
    for table, sql in (("documents", DOCUMENTS), ("conversations", CONVERSATIONS)):
        con.sql(f"COPY ({sql}) TO '{tmp_path}/{table}.parquet' (FORMAT parquet)")
        con.sql(f"CREATE VIEW {table} AS SELECT * FROM '{tmp_path}/{table}.parquet'")
    got, want = QUERIES[name](spark, str(tmp_path)), con.sql(ORACLES[name])
    found = rows(got.columns, [tuple(r) for r in got.collect()])
    assert len(found) > 1 and found == rows(want.columns, want.fetchall())
